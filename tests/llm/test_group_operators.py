"""Operators that compare rows: against brute force on small corpora with planted cases, and edge cases."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from brightledger.llm import common, decontam, embeddings, graph, lines, minhash, quality

from .conftest import TEXTS


def words(rng, n, vocabulary=4000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def brute_components(texts, percent, k=5):
    """Smallest reachable id by comparing all pairs."""
    sets = {}
    for i, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return {i: (find(i), len(sets[i])) for i in ids}


def near_corpus():
    """A chain of edits, a star, exact copies, pairs just around the threshold and unrelated texts."""
    rng, out = random.Random(2), []
    base = words(rng, 120)
    chain = list(base)
    for _ in range(40):
        chain = list(chain)
        chain[rng.randrange(120)] = f"n{rng.randrange(9999)}"
        out.append(" ".join(chain))
    for _ in range(40):
        copy = list(base)
        for _ in range(rng.randrange(1, 5)):
            copy[rng.randrange(120)] = "edit"
        out.append(" ".join(copy))
    out += [" ".join(base).upper()] * 15 + ["a b c", "A B c", "a b", "", None]
    out += [" ".join(words(rng, rng.randrange(1, 300))) for _ in range(40)]
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_are_brute_force(spark, percent, monkeypatch):
    monkeypatch.setattr(minhash, "BUILD", 8)
    monkeypatch.setattr(minhash, "PROBE", 16)
    texts = near_corpus()
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    rows = minhash.near_duplicates(docs, percent).collect()
    want = brute_components(texts, percent)
    assert {r["doc_id"]: (r["component_id"], r["n_shingles"]) for r in rows} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_near_duplicates_edges(edge, empty):
    rows = minhash.near_duplicates(edge, 85).collect()
    assert len(rows) == len(TEXTS)
    by = {(r["doc_id"], r["component_id"]) for r in rows}
    assert {(1, 1), (2, 1), (3, 3), (4, 4), (5, 5), (6, 6), (7, 6), (None, None)} <= by
    assert minhash.near_duplicates(empty).count() == 0


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    edges = [*chain, *((7, i) for i in range(200, 260)), (5, 5), (None, 3), (260, 259)]
    found = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 100 for i in range(100, 161)}, **{i: 7 for i in [7, *range(200, 261)]}}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def sentences(rng, n):
    return [" ".join(words(rng, rng.randrange(4, 9))).capitalize() + "." for _ in range(n)]


def test_repeated_passages_go_and_first_ones_stay(spark):
    rng = random.Random(6)
    passage = " ".join(sentences(rng, 12))
    texts = [" ".join(sentences(rng, 8)) for _ in range(30)]
    own = [" ".join(sentences(rng, 3)) for _ in range(10)]
    for i in range(10):
        texts.append(f"{own[i]} {passage} {' '.join(sentences(rng, 2))}")
    texts += [texts[0], texts[0], f"{passage}\n{passage}", None, ""]
    docs = spark.createDataFrame([(i, t, "keep", i) for i, t in enumerate(texts)], "doc_id long, text string, h string, words_after int")
    rows = {r["doc_id"]: r for r in lines.drop_repeats(docs).collect()}
    assert len(rows) == len(texts)
    assert rows[30]["text"] == texts[30]
    for i in range(31, 40):
        assert passage[20:] not in rows[i]["text"] and rows[i]["text"].startswith(own[i - 30])
    assert rows[40]["text"].strip() == "" == rows[41]["text"].strip() and rows[0]["text"] == texts[0]
    assert rows[42]["text"].strip() == "" and rows[43]["text"] is None and rows[44]["text"] == ""
    for i in range(30):
        assert rows[i]["text"] == texts[i] and rows[i]["h"] == "keep"
    kept = {r["doc_id"] for r in lines.clean(docs).collect()}
    assert kept == set(range(40)) | {43, 44}


def test_text_found_nowhere_else_stays_in_the_stage_form(spark):
    rng = random.Random(16)
    sources = [" ".join(sentences(rng, 30)) for _ in range(4)]
    own = " ".join(sentences(rng, 10))
    texts = [*sources, " ".join([*sources, own]), " ".join(sources[:2])]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    kept = {r["doc_id"]: r["text"] for r in lines.clean(docs).collect()}
    assert set(kept) == {0, 1, 2, 3, 4} and kept[4].strip() == own


def brute_repeated(texts, least):
    """For each document, words of lines that are in a run of repeated lines found by comparing all earlier places."""
    seen, out = [], {}
    for i, t in sorted(texts):
        own = [x.strip() for x in lines.split_lines(t)]
        repeated = [False] * len(own)
        for other in [*seen, own]:
            for shift in range(-len(other), len(own)):
                if other is own and shift <= 0:
                    continue
                at = 0
                while at < len(own):
                    n = 0
                    while at + n < len(own) and 0 <= at + n - shift < len(other) and own[at + n] == other[at + n - shift]:
                        n += 1
                    if n >= lines.GUARANTEE:
                        repeated[at : at + n] = [True] * n
                    at += max(1, n)
        seen.append(own)
        out[i] = repeated
    return out


def test_runs_of_guaranteed_length_are_not_missed(spark):
    rng = random.Random(12)
    pool = [" ".join(sentences(rng, rng.randrange(3, 7))) for _ in range(6)]
    texts = [(i, " ".join([*sentences(rng, 3), rng.choice(pool), *sentences(rng, 2), rng.choice(pool)])) for i in range(25)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r["id"]: r["cuts"] for r in lines.repeats(docs, "doc_id", "text", least_words=1).collect()}
    for i, want in brute_repeated(texts, 0).items():
        ranges = got.get(i, [])
        covered = {x for a, b in zip(ranges[::2], ranges[1::2]) for x in range(a, b)}
        assert {n for n, r in enumerate(want) if r} <= covered


def test_passages_of_few_lines_go(spark):
    """50 words in parts of one, two or three long lines, without a whole line among them or with one."""
    rng = random.Random(21)
    shared = words(rng, 70)
    forms = [" ".join(shared), " ".join(shared[:35]) + ". " + " ".join(shared[35:]), " ".join(shared[:12]) + ", " + " ".join(shared[12:58]) + ", " + " ".join(shared[58:])]
    texts = []
    for form in forms:
        texts += [" ".join(words(rng, 15)) + " " + form + " " + " ".join(words(rng, 15)) + "." for _ in range(3)]
    docs = spark.createDataFrame([(i, t, "a", "b", "c") for i, t in enumerate(texts)], "doc_id long, text string, id string, __id string, __mark string")
    rows = {r["doc_id"]: r for r in lines.drop_repeats(docs).collect()}
    middle = " ".join(shared[20:30])
    for i in (1, 2, 4, 5, 7, 8):
        assert middle not in rows[i]["text"] and rows[i]["words_before"] - rows[i]["words_after"] >= 25
        assert rows[i]["text"].split()[:10] == texts[i].split()[:10] and rows[i]["__id"] == "b"
    assert rows[0]["text"] == texts[0] and rows[0]["words_before"] is None


def test_stretches_lose_no_run_and_are_short():
    """Runs found in what travels to a first document equal those found in all lines; one short passage takes few lines along."""
    rng, nrng = random.Random(31), np.random.default_rng(31)
    for _ in range(150):
        texts = [nrng.integers(0, rng.choice([3, 6, 40]), rng.randrange(1, 25)) * 7_919 for _ in range(6)]
        texts += [np.concatenate([texts[0][:9], texts[1][2:8], texts[0][4:]]), texts[2].copy()]
        counts = [np.array([1 + x % 30 for x in t.tolist()], np.int32) for t in texts]
        marks = {}
        for i, t in enumerate(texts):
            for h, p in zip(*lines.fingerprints(t, counts[i])):
                marks.setdefault(int(h), []).append((i, int(p)))
        for i, t in enumerate(texts):
            found = [(*min(at), p) for at in marks.values() for j, p in at if j == i and (i, p) != min(at)]
            firsts, first_places, places = np.array(found, np.int64).reshape(-1, 3).T
            want = {(int(f), *lines.extended(t, texts[f], p - q, p)) for f, q, p in found}
            got = set()
            for first, begins, ends, own, words, ps, qs, low, high in lines.stretches(t, counts[i], firsts, places, first_places):
                after = np.cumsum(ends - begins)
                assert [len(own), len(words)] == [after[-1]] * 2
                for p, q in zip(ps.tolist(), qs.tolist()):
                    k = int(np.searchsorted(begins, p, "right")) - 1
                    a, b = lines.extended(own[after[k] - (ends[k] - begins[k]) : after[k]], texts[first][low:high], p - q - int(begins[k]) + low, p - int(begins[k]))
                    got.add((first, int(a + begins[k]), int(b + begins[k])))
            assert got == {(f, int(a), int(b)) for f, a, b in want}
    (_, _, _, own, *_), = lines.stretches(np.arange(5000), np.ones(5000, np.int32), np.array([3]), np.array([70]), np.array([0]))
    assert own.tolist() == [69, 70, 71, 72]


def test_one_place_stands_for_a_run():
    """Places that lead on to one another travel as one; where rows share an id, one of them may be another row's, so all travel."""
    own, short = np.arange(30) * 7_919, np.full(30, 5)
    places, firsts = np.array([4, 5, 7, 8, 11, 20, 21]), np.full(7, 3)
    at = lambda **how: [(ps.tolist(), qs.tolist()) for *_, ps, qs, _, _ in lines.stretches(own, how.pop("words", short), firsts, places, places - 2, **how)]
    assert at() == [([4, 11, 20], [2, 9, 18])]
    assert at(unique_ids=False) == [(places.tolist(), (places - 2).tolist())]
    assert at(words=np.where(np.arange(30) == 5, 30, 5)) == [([4, 7, 11, 20], [2, 5, 9, 18])]  # a line that is matched alone says nothing of the next


def test_cuts_are_the_same_for_ids_that_fit_no_packed_number_and_for_repeated_ids(spark):
    rng = random.Random(41)
    pool = [" ".join(sentences(rng, 6)) for _ in range(4)]
    texts = [" ".join([*sentences(rng, 2), rng.choice(pool), *sentences(rng, 2), rng.choice(pool)]) for _ in range(20)]
    far = [(i - 10) * (1 << 59) for i in range(20)]
    kind = "doc_id long, text string"
    got = [{r["doc_id"]: r["text"] for r in lines.drop_repeats(spark.createDataFrame([*zip(ids, texts)], kind)).collect()} for ids in (range(20), far)]
    assert [*got[0].values()] != texts and [got[0][i] for i in range(20)] == [got[1][i] for i in far]
    rows = [*zip(range(20), texts), *zip(range(20), texts), (19, "Another text of the last id, with a few words.")]
    twice = {(r["doc_id"], r["text"]) for r in lines.drop_repeats(spark.createDataFrame(rows, kind)).collect()}
    assert {x for x in got[0].items() if x[0] < 19} == {x for x in twice if x[0] < 19}


def test_texts_are_not_shuffled_for_few_cuts(spark):
    rng = random.Random(43)
    passage = " ".join(sentences(rng, 12))
    docs = spark.createDataFrame([(i, f"{' '.join(sentences(rng, 3))} {passage}") for i in range(8)], "doc_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = lines.drop_repeats(docs)
        assert "Exchange hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()
        assert out.where("words_after < words_before").count() == 7
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_split_lines_joins_to_the_text():
    rng = random.Random(22)
    for _ in range(200):
        text = "".join(rng.choice(["a", "bc", " ", "  ", ". ", ",", "\n", "\t", "é "]) for _ in range(rng.randrange(400)))
        assert "".join(lines.split_lines(text)) == text


def test_line_dedup_edges(edge, empty):
    rows = lines.drop_repeats(edge).collect()
    assert len(rows) == len(TEXTS)
    assert sorted(r["text"] or "" for r in rows if r["doc_id"] in (3, 4, 5, 6, 7, None)) == sorted(t or "" for i, t, _, _ in TEXTS if i in (3, 4, 5, 6, 7, None))
    assert lines.drop_repeats(empty).count() == 0
    assert lines.clean(edge).columns == edge.columns


ITEM = "If Maria buys 12 apples for 3 euros each and sells 5 km of rope to Peter how much money does she have left at the end"


def test_leaks_with_other_values_and_consistent_slots(spark):
    rng = random.Random(4)
    fill = lambda: " ".join(words(rng, 40))
    same = ITEM
    changed = ITEM.replace("Maria", "Julia").replace("12", "40").replace("Peter", "Otto")
    # two numbers happen to be the same one, which a copy may have
    merged = ITEM.replace("12", "3")
    texts = [f"{fill()} and {same} {fill()}", f"{fill()}, {changed} {fill()}", f"{fill()} and {merged} {fill()}", fill(), None, "", ITEM[:30]]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, same)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, ITEM), (2, fill()), (3, None), (4, "too short"), (None, ITEM)], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontam.leaks(docs, bench).collect()}
    assert found == {(0, 1), (1, 1), (2, 1)}
    kept = sorted(r["doc_id"] if r["doc_id"] is not None else -1 for r in decontam.decontaminate(docs, bench).collect())
    assert kept == [-1, 3, 4, 5, 6]


def test_leaks_with_words_put_in_left_out_and_values_of_other_lengths(spark):
    rng = random.Random(14)
    fill = lambda: " ".join(words(rng, 40))
    plain = words(rng, 38, 10**6)
    edits = [[*plain[:19], "inserted", *plain[19:]], [*plain[:19], *plain[20:]], [*plain[:19], plain[19][:2], plain[19][2:], *plain[20:]]]
    own = ITEM.replace("12", "1200").replace("5 km", "5km")
    values = own.replace("Maria", "Mary Ann").replace("1200", "1 200").replace("5km", "5 km").replace("Peter", "Otto van Gogh".title())
    half = [*plain[:7], *words(rng, 31)]
    texts = [*(f"{fill()} {' '.join(e)} {fill()}" for e in edits), f"{fill()}, {values} {fill()}", f"{fill()} {' '.join(half)} {fill()}", f"{fill()} buy 7km now {fill()}"]
    bench = spark.createDataFrame([(1, " ".join(plain)), (2, own), (3, "then buy 5 km")], "item_id long, text string")
    docs = spark.createDataFrame([*enumerate(texts), (9, f"{fill()} then buy 8 km {fill()}")], "doc_id long, text string")
    found = {(r["doc_id"], r["item_id"]): (r["place"], r["share"]) for r in decontam.leaks(docs, bench).collect()}
    assert set(found) == {(0, 1), (1, 1), (2, 1), (3, 2), (9, 3)}
    assert {p for (d, _), (p, _) in found.items() if d != 3} == {40}


def test_leaks_are_brute_force_on_the_test_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs, bench = common.table(spark, sf, "documents"), common.table(spark, sf, "benchmark")
    found = {(r["doc_id"], r["item_id"]) for r in decontam.leaks(docs, bench).collect()}
    items = bench.collect()
    whole = {(d["doc_id"], b["item_id"]) for d in docs.collect() for b in items if d["text"] and b["text"] in d["text"]}
    assert whole <= found
    texts = {d["doc_id"]: set(d["text"].lower().split()) for d in docs.collect() if d["text"]}
    words_of = {b["item_id"]: set(b["text"].lower().split()) for b in items}
    assert all(len(texts[d] & words_of[b]) >= 0.4 * len(words_of[b]) for d, b in found)


def test_decontamination_edges(edge, empty, spark):
    bench = spark.createDataFrame([(1, TEXTS[0][1])], "item_id long, text string")
    assert {r["doc_id"] for r in decontam.leaks(edge, bench).collect()} == {1, 2}
    assert decontam.leaks(empty, bench).count() == 0
    assert decontam.leaks(edge, bench.where("false")).count() == 0
    assert decontam.decontaminate(edge, bench).columns == edge.columns
    plan = decontam.leaks(edge, bench)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def brute_links(ids, x, least):
    n = np.sqrt((x * x).sum(1))
    near = (x @ x.T) / (n[:, None] * n[None]) >= least
    np.fill_diagonal(near, False)
    label = ids.copy()
    while True:
        new = np.array([min([label[i], *label[near[i]]]) for i in range(len(ids))])
        if (new == label).all():
            return near.sum(1), label
        label = new


def test_embedding_links_are_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    rng = np.random.default_rng(3)
    groups = [rng.standard_normal(16) + rng.standard_normal((n, 16)) * 0.12 for n in (2, 3, 90, 12, 2, 2)]
    x = np.concatenate([*groups, rng.standard_normal((300, 16))])
    x = np.concatenate([x, x[:5], x[:1] * 2])
    ids = rng.permutation(len(x)).astype(np.int64)
    rows = [(int(i), [float(v) for v in row], 0) for i, row in zip(ids, x)]
    odd = [(1000, None, 1), (1001, [0.0] * 16, 1), (1002, [float("nan")] * 16, 1), (1003, [1.0, None] + [0.0] * 14, 1), (1004, [1.0] * 3, 1), (1005, [], 1), (1006, [float("inf")] * 16, 1), (None, rows[0][1], 1)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, id int").repartition(3)
    result = embeddings.near_duplicates(df, 0.95)
    got = {r["vec_id"]: r for r in result.collect()}
    links, label = brute_links(ids, x, 0.95)
    found = np.array([got[i]["n_links"] for i in ids.tolist()])
    assert (found <= links).all() and found.sum() >= 0.9 * links.sum()
    assert np.mean([got[i]["component_id"] == c for i, c in zip(ids.tolist(), label)]) > 0.95
    assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i and got[i]["kept"] for i in range(1000, 1007))
    assert got[None]["n_links"] == 0 and got[None]["component_id"] is None
    assert embeddings.audit(df, result, 64) >= 0.9
    assert embeddings.near_duplicates(df.where("false")).count() == 0


def test_dense_groups_joined_by_weaker_links_are_one(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 32)
    rng = np.random.default_rng(5)
    u, v, far = np.eye(16)[0], 0.96 * np.eye(16)[0] + 0.28 * np.eye(16)[1], np.eye(16)[2]
    x = np.concatenate([c + rng.standard_normal((80, 16)) * 0.002 for c in (u, v, far)])
    ids = np.arange(len(x))
    df = spark.createDataFrame([(int(i), [float(y) for y in row]) for i, row in zip(ids, x)], "vec_id long, embedding array<double>").repartition(3)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_duplicates(df, 0.95).collect()}
    links, label = brute_links(ids, x, 0.95)
    assert set(links.tolist()) == {159, 79} and got == {i: (int(n), int(c)) for i, n, c in zip(ids.tolist(), links, label)}


def test_search_goes_on_while_recall_is_low_and_grows_with_the_table(spark, monkeypatch):
    first, seen = embeddings.first_lists, []

    def none_at_first(*a, **k):
        seen.append(a)
        return first(*a, **k).where("true" if len(seen) > 1 else "false")

    monkeypatch.setattr(embeddings, "first_lists", none_at_first)
    monkeypatch.setattr(embeddings, "ROUNDS", 1)
    rng = np.random.default_rng(9)
    x = np.repeat(rng.standard_normal((30, 16)), 2, axis=0) + rng.standard_normal((60, 16)) * 0.02
    df = spark.createDataFrame([(i, [float(y) for y in row]) for i, row in enumerate(x)], "vec_id long, embedding array<double>")
    assert [r["n_links"] for r in embeddings.near_duplicates(df, 0.95).collect()] == [1] * 60 and len(seen) == 2
    for n in (2_000, 50_000, 10**6, 10**7):
        depth, trees = embeddings.cuts(n, 0.95)
        assert 1 - (1 - (1 - np.arccos(0.95) / np.pi) ** depth) ** trees >= 0.99


def test_classifier_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = common.table(spark, sf, "documents"), common.table(spark, sf, "labels")
    held = F.pmod(F.xxhash64("doc_id", F.lit("test")), F.lit(4)) == 0
    scored = quality.classify(docs, labels.where(~held)).withColumnRenamed("id", "doc_id")
    rows = scored.join(labels.where(held), "doc_id").collect()
    right = sum(r["kept"] == (r["quality"] == 1 and r["toxic"] == 0) for r in rows)
    assert len(rows) > 60 and right >= 0.88 * len(rows)


def test_sparse_sites_shrink_and_full_ones_speak(spark):
    rows = [("big", "p", 0.0)] * 300 + [("bad", "p", 6.0)] * 300 + [("bad", "q", 6.0)] + [("new", "p", 6.0)]
    coefs = np.zeros((2, 3 + len(quality.MEASURES) * (quality.BINS + 1)))
    assert coefs.shape[1] == 192
    scored = spark.createDataFrame([(h, p, x, x, [0] * 9) for h, p, x in rows], "host string, path string, sum_low double, sum_toxic double, bins array<int>")
    coefs[:, 1] = 1.0
    llr = quality.evidence(scored, coefs).groupBy("host").agg(F.avg("llr_low").alias("x")).collect()
    assert {r["host"]: round(r["x"], 6) for r in llr} == {"big": 0.0, "bad": 6.0, "new": 6.0}


def test_classifier_edges(edge, empty, spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 0, 1), (6, None, None)], "doc_id long, quality int, toxic int")
    assert quality.classify(edge, labels).count() == len(TEXTS)
    assert quality.classify(edge, labels.where("false")).where("NOT kept").count() == 0
    assert quality.classify(empty, labels).count() == 0
    assert quality.keep_good(edge, labels).columns == edge.columns
