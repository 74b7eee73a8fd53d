"""Conversation repair against a search over all edits, and its edge cases."""

import functools
import hashlib
import random
import zlib

import pyarrow as pa
import pytest

from brightledger.llm import plans, turns

ROLES = {"u": "user", "a": "assistant"}
NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}
EMPTY = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def by_definition(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, hash) of rows (turn, role, text) in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(turns.SPACE)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))

    @functools.cache
    def best(i, state, left):
        """(cost, audit, rows) from row ``i``; ``left`` rows may still be inserted here."""
        found = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        if left:
            r = NEXT[state][-1]
            cost, audit, out = best(i, r, left - 1)
            found.append((cost + 5, "I" + audit, (f"{ROLES[r]}:", *out)))
        if i < len(rows):
            _, role, text = rows[i]
            cost, audit, out = best(i + 1, state, 3)
            found.append((cost + 2, "D" + audit, out))
            if faults[i] not in ("blank", "duplicate"):
                late = 5 * (faults[i] == "truncated")
                for r in NEXT[state]:
                    if role[:1] == r:
                        cost, audit, out = best(i + 1, r, 3)
                        found.append((cost + late, "K" + audit, (f"{role}:{text}", *out)))
                    if r in ROLES:
                        cost, audit, out = best(i + 1, r, 3)
                        found.append((cost + late + 1, "R" + audit, (f"{ROLES[r]}:{text}", *out)))
        return min(found, default=(10**9, "", ()))

    for i in range(len(rows), 0, -1):  # from the end, so that calls don't nest
        for state in NEXT:
            best(i, state, 3)
    cost, audit, out = best(0, "", 3)
    known = [t for t, _, _ in rows if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    odd = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), odd, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


def random_rows(rng, n):
    roles, texts = ["user", "assistant", "system", "tool", "", "ux"], ["Yes.", "No!", "cut", "", " \n", "Well? ", "a b", " ", "Ünd."]
    return [(t, rng.choice(roles[: rng.choice([3, 6])]), rng.choice(texts) + rng.choice(["", "", f"{rng.randrange(99)}."])) for t in sorted(rng.sample(range(2 * n + 3), n))]


def answers(spark, talks):
    """The operator's answers for a list of conversations."""
    rows = [(i, *r) for i, talk in enumerate(talks) for r in talk]
    random.Random(3).shuffle(rows)
    found = turns.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3))
    hashes = {r["conv_id"]: r["sha256"] for r in turns.digests(found.rows).collect()}
    return {r["conv_id"]: (*r[1:], hashes.get(r["conv_id"], EMPTY[-1])) for r in found.conversations.collect()}


@pytest.mark.parametrize("block", [1, 2, 256])
def test_repair_is_the_cheapest_of_all(spark, block):
    rng = random.Random(block)
    talks = [random_rows(rng, rng.randrange(1, 12)) for _ in range(150)]
    want = {i: by_definition(t) for i, t in enumerate(talks)}
    solved = {}  # blocks of other lengths are cut here, as workers have their own BLOCK
    for i, talk in enumerate(talks):
        seen, letters = set(), []
        for _, role, text in talk:
            bare, c = text.strip(turns.SPACE), role[:1] if role[:1] in ("s", "u", "a") else "o"
            letters.append("x" if not bare or (role, text) in seen else c if bare[-1] in ".!?" else c.upper())
            seen.add((role, text))
        word = "".join(letters)
        parts = [word[j : j + block] for j in range(0, len(word), block)]
        for part in parts:
            if part not in solved:
                endings = turns.Endings()
                node = endings.read(part)[-1]
                solved[part] = (
                    [node.best[q][f][0] if f in node.best[q] else -1 for q in range(4) for f in range(4)],
                    [node.rank[q].get(f, -1) for q in range(4) for f in range(4)],
                    [endings.audit(q, f) if f in node.best[q] else None for q in range(4) for f in range(4)],
                )
        cost, at, extra = turns.chain([solved[p][0] for p in parts], [solved[p][1] for p in parts])
        assert (cost, "".join(solved[p][2][k] for p, k in zip(parts, at)) + "I" * extra) == want[i][5:7], word
    if block == 256:
        assert answers(spark, talks) == want


def test_endings_are_shared():
    """Sorted from their ends, signatures build each node once."""
    words = sorted({w[i:] for w in ("suauaxU", "uauaxU", "axU", "sUaxA") for i in range(len(w))}, key=lambda w: w[::-1])
    endings, made = turns.Endings(), []
    plain, turns.before = turns.before, lambda *a: made.append(a) or plain(*a)
    try:
        for w in words:
            endings.read(w)
    finally:
        turns.before = plain
    assert len(made) == len({w[i:] for w in words for i in range(len(w))})


def test_long_conversation_in_many_blocks(spark):
    rng = random.Random(9)
    talk = [(t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["ok.", "cut", "", f"{t}.", f"{t}"])) for t in range(0, 3000, 2)]
    other = random_rows(rng, 5)
    got = answers(spark, [talk, other])
    assert got[1] == by_definition(other)
    assert got[0] == by_definition(talk)


def test_edges(spark):
    rows = [(1, None, None, None, "x"), (1, None, "user", "Hi.", "x"), (1, 5, "user", "Hi.", "x"), (1, 5, "user", "Hi.", "x"), (None, 1, "assistant", "Yes." * 50_000, "x"), (None, 0, "user", "Go.", "x"),
            (2, None, "system", None, "x"), (3, 9, "system", "Be kind.", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, `key` string").withColumnsRenamed({"key": "conv"})
    found = turns.repair(df)
    got = {r["conv_id"]: tuple(r[1:]) for r in found.conversations.collect()}
    assert got == {1: (0, 1, 2, 0, 3, 8, "DDDD"), None: (0, 0, 0, 0, 0, 0, "KK"), 2: (0, 1, 0, 0, 0, 2, "D"), 3: (0, 0, 0, 0, 0, 2, "D")}
    lines = {(r["conv_id"], r["place"]): (r["edit"], r["role"], r["text"]) for r in found.rows.collect()}
    assert lines == {(None, 0): ("K", "user", "Go."), (None, 1): ("K", "assistant", "Yes." * 50_000)}
    assert list(turns.apply_audits(iter([]))) == []
    none = turns.repair(df.where("false"))
    assert none.conversations.count() == 0 and turns.digests(none.rows).count() == 0


def test_inserted_rows():
    """Inserts never pay here, as one more deletion is cheaper, so an audit with them is given."""
    rows = [(1, 0, "IKIRKI", "", "", ""), (1, 1, "", "assistant", "a", "a."), (1, 1, "", "tool", "o", "b."), (1, 1, "", "user", "u", "c."), (2, 0, "II", "", "", "")]
    names = ["conv", "kind", "audit", "role", "initial", "text"]
    batch = pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows])
    for size in (1, 2, 5):
        out = [tuple(r.values()) for b in turns.apply_audits(batch.slice(i, size) for i in range(0, 5, size)) for r in b.to_pylist()]
        assert out == [(1, 0, "I", "user", ""), (1, 1, "K", "assistant", "a."), (1, 2, "I", "user", ""), (1, 3, "R", "assistant", "b."), (1, 4, "K", "user", "c."), (1, 5, "I", "assistant", ""),
                       (2, 0, "I", "user", ""), (2, 1, "I", "assistant", "")]


def damage(rows):
    """The contract's damage, row by row."""
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def test_damage_is_the_contracts(spark):
    rows = [(c, t, r, x) for c in (None, 1, 2, 77) for t in (None, *range(40)) for r, x in [("assistant", "A. B! c?"), (None, None)]]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted(map(tuple, plans.damaged(df).collect()), key=repr) == sorted(damage(rows), key=repr)


def test_query_is_its_statement(spark):
    import check

    sf = "/root/testdata/sf0.01"
    assert check.compare(spark, check.duck(sf), sf, "op13_conversation_repair", plans.op13_conversation_repair, plans.REPAIRS) is None
