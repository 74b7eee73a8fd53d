"""Operators that read one text at a time: against the libraries, plain patterns, round trips and edge cases."""

import base64
import gc
import hashlib
import random
import re
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from brightledger.llm import bpe, licenses, pii, secrets, tokens

from .conftest import TEXTS

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PATTERN = public_tokenizers.PATTERN


def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts(n=150):
    rng = random.Random(5)
    out = [t or "" for _, t, _, _ in TEXTS] + ["<|endoftext|> a", "aaaa" * 99, "don't I'LL", "日本語 한국어 👩‍👩‍👧", "a\r\n\n  b   "]
    out += ["".join(rng.choice("abcdeinothrs ü🙂é.,1\n\t'") for _ in range(200)) for _ in range(n)]
    return out + ["".join(chr(rng.choice([rng.randrange(1, 0x250), rng.randrange(0x2000, 0x3100)])) for _ in range(100)) for _ in range(n)]


def test_transducer_is_the_library():
    pieces, lib = bpe.compiled(open(RANKS, "rb").read()), library()
    for text in odd_texts():
        assert [i for p in bpe.regex.findall(PATTERN, text) for i in pieces[p]] == lib.encode_ordinary(text)


def test_transducer_forgets_states_and_stays_right(monkeypatch):
    data = open(RANKS, "rb").read()
    monkeypatch.setattr(bpe, "MOVES", 200)
    monkeypatch.setattr(bpe, "PIECES", 50)
    pieces, lib = bpe.Pieces(bpe.Transducer(bpe.read_ranks(data))), library()
    for text in odd_texts(40):
        assert [i for p in bpe.regex.findall(PATTERN, text) for i in pieces[p]] == lib.encode_ordinary(text)


def test_quick_pattern_is_the_pattern():
    find, every = bpe.splitter(PATTERN), bpe.regex.compile(PATTERN).findall
    rng = random.Random(31)
    texts = ["".join(chr(rng.randrange(256)) for _ in range(rng.randrange(60))) for _ in range(2000)] + odd_texts(50)
    assert bpe.latin_pattern(PATTERN) and all(find(t) == every(t) for t in texts)
    assert bpe.latin_pattern(r"\d+") is None and bpe.latin_pattern(r"(?i:'s)") is None and bpe.latin_pattern(r"[a\S]") is None
    assert bpe.splitter(r"\d+|\D+")("a12") == ["a", "12"]


def test_long_piece_in_bounded_time_and_memory(monkeypatch):
    """A run of 500,000 letters takes time in proportion, and the table of moves stays bounded within it."""
    monkeypatch.setattr(bpe, "MOVES", 50_000)
    transducer = bpe.Transducer(bpe.read_ranks(open(RANKS, "rb").read()))
    rng = random.Random(8)
    piece = "".join(rng.choice("acgt") for _ in range(500_000)).encode()
    start = time.process_time()
    ids = transducer.encode(piece)
    assert time.process_time() - start < 30  # seconds on any machine; a quadratic loop takes minutes
    assert transducer.made_moves <= bpe.MOVES + bpe.STRETCH
    tokens = bpe.vocabulary(open(RANKS, "rb").read())
    assert b"".join(tokens[i] for i in ids) == piece
    assert list(transducer.encode(piece[:3000])) == library().encode_ordinary(piece[:3000].decode())


@given(st.binary(max_size=60), st.lists(st.integers(1, 7), max_size=30))
@settings(max_examples=300, deadline=None)
def test_utf8_stream_is_decoding_at_once(data, cuts):
    stream, out, at = bpe.Utf8Stream(), "", 0
    for n in cuts:
        out += stream.feed(data[at : at + n])
        at += n
    assert out + stream.feed(data[at:]) + stream.finish() == data.decode("utf-8", "replace")


def test_encode_and_decode_edges(edge, empty):
    coded = bpe.encode(edge, RANKS, PATTERN)
    back = {(r["doc_id"], r["text"]) for r in bpe.decode(coded, RANKS).collect()}
    assert sorted(map(repr, bpe.round_trip(edge, RANKS, PATTERN).select("doc_id", "n_tokens", "ids").collect())) == sorted(map(repr, coded.collect()))
    assert {(r["doc_id"], r["text"]) for r in bpe.round_trip(edge, RANKS, PATTERN).collect()} == back
    assert back == {(i, t or "") for i, t, _, _ in TEXTS}
    assert coded.count() == len(TEXTS)
    assert bpe.encode(empty, RANKS, PATTERN).count() == 0


def test_decode_of_null_and_wrong_ids(spark):
    assert bpe.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), RANKS).first()["text"] == ""
    with pytest.raises(Exception, match="negative"):
        bpe.decode(spark.createDataFrame([(1, [-1])], "doc_id long, ids array<int>"), RANKS).collect()


def test_counts_are_the_librarys(monkeypatch):
    merger, lib = tokens.WordMerger(open(WORDS, "rb").read()), Tokenizer.from_file(WORDS)
    texts = [*odd_texts(), "a<|endoftext|>b<|startoftext|>", "e<|endoftext|>́x", "İSTANBUL ΣΑΣ"]
    want = [len(lib.encode(t, add_special_tokens=False).ids) for t in texts]
    assert merger.counts(texts) == want
    monkeypatch.setattr(tokens, "KNOWN", 30)
    monkeypatch.setattr(tokens, "SYMBOLS", 40)
    assert [merger.counts([t])[0] for t in texts] == want


def test_count_tokens_edges(edge, empty):
    rows = tokens.count_tokens(edge, WORDS, 2048).collect()
    lib = Tokenizer.from_file(WORDS)
    want = sorted((i or 0, len((t or "").encode()), n := len(lib.encode(t or "", add_special_tokens=False).ids), n > 2048) for i, t, _, _ in TEXTS)
    assert sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows) == want
    assert tokens.count_tokens(empty, WORDS, 5).count() == 0




def plain_secrets(text):
    either = lambda w: "".join(f"[{c}{c.upper()}]" for c in w)
    names = "|".join([*map(either, ("password", "passwd", "secret", "token")), either("api") + "_?" + either("key")])
    out = [(m.start(), 0, m.end()) for m in re.finditer(rf"""({names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24])


PARTS = ["password", "PassWord=", "token", ": ", "=", "'", '"', "api_key", "APIKEY", "AKIA", "ABCDEFGHIJ0123456789", "deadbeef", "0123456789abcdef", " ", "\n", "é🙂", "ſecret", "x", "abcdef", "/+.-_"]


@given(st.lists(st.sampled_from(PARTS), max_size=14).map("".join))
@settings(max_examples=600, deadline=None)
def test_base_secrets_are_the_plain_patterns(text):
    assert secrets.base_spans(text) == plain_secrets(text)


def test_battery_tells_keys_from_words(spark):
    rng = random.Random(3)
    key = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(40))
    texts = [f"use {key} here", "aaaaaaaaaaaaaaaaaaaaaaaaaaa1", "VeryLongCamelCaseIdentifierNameForTests1", "Donaudampfschifffahrtsgesellschaft", "12345678901234567890123456", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in secrets.scan(docs).collect()}
    assert found[0] == [(4, 3, 44)]
    assert not any(kind == 3 for i in range(1, 7) for _, kind, _ in found[i])


def test_secret_scan_edges(edge, empty):
    assert secrets.scan(edge).count() == len(TEXTS)
    assert secrets.scan(empty).count() == 0


def plain_pii(text):
    def luhn(x):
        return sum((d * 2 - 9 * (d > 4)) if i % 2 else d for i, d in enumerate(map(int, reversed(x)))) % 10 == 0

    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return sorted(out + [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m)) <= 15])


def test_base_pii_is_the_plain_patterns(spark):
    rng = random.Random(8)
    parts = ["a", "b.c", "@", "x-y", ".", "com", "_", "%", " ", "-", "--", "1", "22", "333", "4111 1111 1111 1111", "4111111111111111", "255", "256", "0001", "+", "+49", "(0)", "\n", "é🙂", "a@b.com_x@y.org", "00000000000000"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 16))) for _ in range(1500)]
    texts += ["1" * 50_000, "1 " * 30_000, "a" * 50_000 + "@", "1." * 20_000, "+1" + "(" * 30_000, "a@b." * 3000, "1.2.3.4 " * 300]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = {r["doc_id"]: sorted(map(tuple, r["base"])) for r in pii.scan(docs).collect()}
    for i, text in enumerate(texts):
        assert found[i] == plain_pii(text), text[:200]


def test_pii_adds_what_labelers_agree_on(spark):
    yes = [f"Please call phone (0{20 + i % 70}) {100 + i} {2000 + i} soon" for i in range(60)] + [f"write a mail to jo{i} (at) site{i} (dot) com today" for i in range(40)]
    no = [f"isbn {1000000 + i * 7919} in the list" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate([*yes, *no])), "doc_id long, text string")
    added = {r["doc_id"] for r in pii.scan(docs).collect() if len(r["spans"]) > len(r["base"])}
    assert len(added & set(range(100))) >= 60
    assert len(added & set(range(100, 160))) <= 6


def test_pii_edges(edge, empty):
    assert pii.scan(edge).count() == len(TEXTS)
    assert pii.scan(empty).count() == 0


def test_pii_runs_no_python(edge):
    plan = pii.scan(edge)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_licenses_found_in_place_and_by_containment(spark):
    apache, mit = licenses.NOTICES["Apache-2.0 header"], licenses.NOTICES["MIT notice"]
    filler = "one two three four five six seven eight nine ten " * 30
    texts = [f"{filler}{mit} {filler}", f"{filler}{apache.replace('either express', 'whether express')}", "MIT", f"İ {mit}", None, "", filler, f"{mit}\n{filler}\n{mit.upper()}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: [(m["license"], texts[r["doc_id"]][m["start"] : m["end"]]) for m in r["matches"]] for r in licenses.scan(docs).collect()}
    assert found[0] == [("MIT notice", mit[:-1])]
    assert "Apache-2.0 header" in {x[0] for x in found[1]}
    assert [x[0] for x in found[7]] == ["MIT notice"] * 2
    assert not (found[2] or found[4] or found[5] or found[6])
    assert found[3][0][0] == "MIT notice"


def test_every_notice_is_retrieved_at_any_place():
    rng = np.random.default_rng(4)
    made, filler = licenses.Templates(licenses.NOTICES), [f"w{i}" for i in range(5000)]
    for name, text in licenses.NOTICES.items():
        for _ in range(12):
            n = int(rng.integers(0, 400))
            around = rng.choice(filler, n + 300)
            doc = " ".join([*around[:n], text, *around[n:]])
            assert name in {x[0] for x in made.search(doc, 0.8)}, name


def test_license_edges(edge, empty):
    assert licenses.scan(edge).count() == len(TEXTS)
    assert licenses.scan(empty).count() == 0
    with pytest.raises(ValueError, match="fewer"):
        licenses.Templates({"none": "!"})


def test_digests(spark):
    docs = spark.createDataFrame([(1, "secret=abcdef1")], "doc_id long, text string")
    row = secrets.scan(docs).select(F.sha2(secrets.listing("base", secrets.KINDS), 256).alias("x")).first()
    assert row["x"] == hashlib.sha256(b"assign:0:14").hexdigest()


def test_pieces_are_packed_and_the_collector_waits_for_the_batch():
    rng, lib = random.Random(9), library()
    texts = [" ".join("".join(rng.choice("abcdeéß") for _ in range(rng.randrange(1, 12))) for _ in range(200)) for _ in range(40)]
    pieces, runs = bpe.Pieces(bpe.Transducer(bpe.read_ranks(open(RANKS, "rb").read())), 400_000), []
    gc.callbacks.append(lambda phase, info: runs.append(phase))
    try:
        ids = bpe.ids_of_all(pa.array(texts), bpe.splitter(PATTERN), pieces)
        during = len(runs)
    finally:
        gc.callbacks.pop()
    assert gc.isenabled() and during <= 2  # at most one that begins when the collector is back
    assert [x.tolist() for x in ids] == [lib.encode_ordinary(t) for t in texts]
    assert pieces.older and all(isinstance(v, bytes) and len(v) % 4 == 0 for v in pieces.values())
