"""Spelling variants against all pairs of words, and edge cases."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from brightledger.llm import plans, spelling

from .conftest import TEXTS


def near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    a, b = sorted((a, b), key=len)
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a != b and (a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :])


def by_definition(counts, least=5, ratio=5):
    vocabulary, forms, out = {w: n for w, n in counts.items() if w and n >= least}, {}, {}
    for w, n in vocabulary.items():
        found = [(-m, x) for x, m in vocabulary.items() if near(w, x)]
        best = min(found, default=(0, None))
        forms[w] = (best[1], -best[0]) if found and -best[0] >= ratio * n else (None, None)
        out[w] = len(found)
    rows = set()
    for w, n in vocabulary.items():
        root = w
        while forms[root][0] is not None:
            root = forms[root][0]
        rows.add((w, forms[w][0], root, n, out[w], forms[w][1]))
    return rows


@given(st.sets(st.text("abcé", min_size=1, max_size=7), min_size=1, max_size=60))
@settings(max_examples=150, deadline=None)
def test_searches_find_all_pairs(words):
    words = sorted(words)
    got = set()
    for turned, exact in ((lambda x: x, lambda n: n // 2), (lambda x: x[::-1], lambda n: n - n // 2)):
        index = spelling.FmIndex([turned(w) for w in words])
        for a, b in index.near([turned(w) for w in words], [exact(len(w)) for w in words]):
            got |= set(zip(a.tolist(), b.tolist()))
    assert got == {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if near(a, b)}


def test_intervals_are_suffix_ranks():
    """An interval is as wide as the number of words that begin so."""
    words = ["banana", "ban", "bandana", "anna", "band"]
    index = spelling.FmIndex(words)
    for start in ("b", "ban", "band", "an", "x"):
        low, high = index.narrow(np.array([0]), np.array([index.n]), 0)
        for c in start:
            symbol = index.letters.tolist().index(ord(c)) if ord(c) in index.letters else None
            low, high = index.narrow(low, high, symbol) if symbol is not None else (low, low)
        assert int(high[0] - low[0]) == sum(w.startswith(start) for w in words)
    with pytest.raises(ValueError, match="lacks"):
        index.codes(["zzz"])


@pytest.mark.parametrize("cell", [spelling.CELL, 3])
def test_variants_by_definition(spark, monkeypatch, cell):
    monkeypatch.setattr(spelling, "CELL", cell)  # divides cells; workers keep their own, so indexes stay large there
    rng = random.Random(cell)
    counts = Counter()
    for _ in range(300):
        counts["".join(rng.choice("abcé") for _ in range(rng.randrange(1, 8)))] += rng.choice([1, 4, 5, 9, 30, 200])
    for i in range(40):
        counts["same" * 5 + "abcd"[i % 4] + "abcdefghij"[i // 4]] += rng.choice([5, 6, 40, 300])
    counts["x" * 5_000], counts["x" * 5_000 + "y"] = 7, 99
    rows = [(w, n) for w, n in counts.items()] + [("abc", 3), (None, 9), ("", 9)]
    counts["abc"] += 3
    got = spelling.variants(spark.createDataFrame(rows, "word string, n long").repartition(3))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(set(got)) and set(got) == by_definition(counts)


def words_of(texts):
    counts = Counter()
    for i, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            run = run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                counts[run] += 1
    return counts


def test_words_by_definition(spark, edge, empty):
    rng = random.Random(4)
    extra = [(i, " ".join("".join(rng.choice("aBcÀé×÷ÿ") for _ in range(rng.randrange(1, 9))) for _ in range(400)), "x") for i in range(60)]
    docs = edge.select("doc_id", "text", "ids").unionByName(spark.createDataFrame(extra, "doc_id long, text string, ids string"))
    got = Counter()
    for r in spelling.count_words(docs, change=plans.dropped_letter).collect():
        got[r["word"]] += r["n"]
    assert got == words_of([(i, t) for i, t, *_ in TEXTS] + [x[:2] for x in extra])
    assert spelling.variants(spelling.count_words(empty)).count() == 0


def test_query_is_its_statement(spark):
    import check

    sf = "/root/testdata/sf0.01"
    assert check.compare(spark, check.duck(sf), sf, "op11_spelling_variants", plans.op11_spelling_variants, plans.VARIANTS) is None
