"""Conversation structure repair: the cheapest edits that make a conversation a well-formed exchange.

Each row of a conversation becomes one letter for its role and fault, so a conversation is a word, its signature. Many
conversations end alike. All signatures together form an automaton whose nodes are the different endings: two
conversations enter the same node as soon as what is left of them is the same, which makes it the smallest one that keeps them
apart. Signatures are sorted from their ends, so an automaton's nodes come up one after another, each once; there the
cost-to-go and the best edits are computed for each state of the grammar, from the node of the next shorter ending.

Long conversations are cut into blocks of BLOCK rows. A node therefore knows the costs from every grammar state to every other
one, and how the best edits to different states compare, so blocks are put together by numbers alone, from the last to the first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.targets import stage
from .common import runs, slices

#: Rows of a block.
BLOCK = 256
SPACE, ENDINGS = " \t\n\x0b\x0c\r", (".", "!", "?")
#: What the edits cost: delete, give another role, insert, and keep a truncated row.
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
#: Grammar states: nothing yet, a system row, a user row, an assistant row. A conversation may end in the first or last.
START, SYSTEM, USER, ASSISTANT = STATES = range(4)
GO = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Letters of a signature: roles, in capitals if the row is truncated; GONE must be deleted.
GONE, OTHER = "x", "o"


def inserted(state: int) -> int:
    """The state after the only row that may be inserted."""
    return GO.get((state, "u")) or GO[(state, "a")]


def finish(state: int) -> int:
    """Rows to insert at the end."""
    return {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}[state]


def row_moves(letter: str, state: int) -> dict[int, tuple[int, str]]:
    """State after a row -> the least (cost, edits), with rows inserted before it where that helps."""
    out: dict[int, tuple[int, str]] = {}
    for n in range(3):  # three inserted rows lead where one does
        extra = INSERT * n
        found = [(state, DELETE, "D")]
        if letter != GONE:
            late, role = TRUNCATED * letter.isupper(), letter.lower()
            found += [(GO[state, role], late, "K")] if (state, role) in GO else []
            found += [(GO[state, r], late + REROLE, "R") for r in "ua" if (state, r) in GO]
        for to, cost, edit in found:
            out[to] = min(out.get(to, (cost + extra, "I" * n + edit)), (cost + extra, "I" * n + edit))
        state = inserted(state)
    return out


MOVES = {letter: [row_moves(letter, q) for q in STATES] for letter in GONE + "suaoSUAO"}


class Node(NamedTuple):
    """An ending: for each grammar state, final state -> (cost, edits of its first row, next state), and final states by their edits' order."""

    best: list[dict[int, tuple[int, str, int]]]
    rank: list[dict[int, int]]


END = Node([{q: (0, "", q)} for q in STATES], [{q: 0} for q in STATES])


def before(letter: str, after: Node) -> Node:
    """The ending ``after`` with one more row in front."""
    best, rank = [], []
    for moves in MOVES[letter]:
        found: dict[int, tuple[int, str, int]] = {}
        for step, (cost, edits) in moves.items():
            for final, (rest, _, _) in after.best[step].items():
                found[final] = min(found.get(final, (cost + rest, edits, step)), (cost + rest, edits, step))
        # edits of one row are never the beginning of another's, so different ones decide
        order = sorted(found, key=lambda f: (found[f][1], after.rank[found[f][2]][f]))
        best.append(found)
        rank.append({f: i for i, f in enumerate(order)})
    return Node(best, rank)


class Endings:
    """The path of nodes from the end of the current signature to its beginning. Signatures come sorted from their ends, so a node that leaves the path is not needed again."""

    def __init__(self) -> None:
        self.word, self.path = "", [END]

    def read(self, signature: str) -> list[Node]:
        word = signature[::-1]
        same = next((i for i, (a, b) in enumerate(zip(word, self.word)) if a != b), min(len(word), len(self.word)))
        del self.path[same + 1 :]
        for letter in word[same:]:
            self.path.append(before(letter, self.path[-1]))
        self.word = word
        return self.path

    def audit(self, state: int, final: int) -> str:
        """The best edits of the current signature."""
        out = []
        for node in reversed(self.path[1:]):
            _, edits, state = node.best[state][final]
            out.append(edits)
        return "".join(out)


def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Costs, ranks and edits of distinct signatures, by 4 * state + final state; -1 and null where there is no way."""
    endings = Endings()
    for batch in slices(batches):
        costs, ranks, audits = [], [], []
        for signature in batch.column(0).to_pylist():
            node = endings.read(signature)[-1]
            pairs = [(q, f) for q in STATES for f in STATES]
            costs.append([node.best[q][f][0] if f in node.best[q] else -1 for q, f in pairs])
            ranks.append([node.rank[q].get(f, -1) for q, f in pairs])
            audits.append([endings.audit(q, f) if f in node.best[q] else None for q, f in pairs])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(costs, pa.list_(pa.int32())), pa.array(ranks, pa.list_(pa.int32())), pa.array(audits, pa.list_(pa.string()))], ["signature", "costs", "ranks", "audits"])


def chain(costs: list[list[int]], ranks: list[list[int]]) -> tuple[int, list[int], int]:
    """(cost, 4 * state + final state of each block, rows inserted at the end) of a conversation's blocks."""
    value = [INSERT * finish(q) for q in STATES]
    choice = []
    for cost, rank in zip(reversed(costs), reversed(ranks)):
        ways = [min((cost[4 * q + f] + value[f], rank[4 * q + f], f) for f in STATES if cost[4 * q + f] >= 0) for q in STATES]
        value = [w[0] for w in ways]
        choice.append([w[2] for w in ways])
    state, at = START, []
    for final in reversed(choice):
        at.append(4 * state + final[state])
        state = final[state]
    return value[START], at, finish(state)


def illegal(initials: str) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def cut_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of sorted rows (conv, turn, role, key, letter, initial, later). The number of a block grows along the partitions, which are sorted ranges."""
    part, n = TaskContext.get().partitionId() << 40, 0
    held: list = []
    last = None
    for batch in slices(batches):
        out = []
        rows = zip(*(batch.column(i).to_pylist() for i in range(7)))
        for conv, turn, _, key, letter, initial, later in rows:
            if held and (conv != held[0] or len(held[1]) == BLOCK):
                out.append(held)
                held = []
            if not held:
                held, n = [conv, [], [], part + n], n + 1
            held[1].append(GONE if later or last == (conv, turn, key) else letter)
            held[2].append(initial)
            last = (conv, turn, key)
        if out:
            yield block_batch(out, batch.schema.field(0).type)
        kind = batch.schema.field(0).type
    if held:
        yield block_batch([held], kind)


def block_batch(blocks: list[list], kind: pa.DataType) -> pa.RecordBatch:
    convs, letters, initials, numbers = zip(*blocks)
    words = ["".join(x) for x in initials]
    return pa.RecordBatch.from_arrays([pa.array(convs, kind), pa.array(numbers, pa.int64()), pa.array(["".join(x) for x in letters]), pa.array([illegal(w) for w in words], pa.int64()), pa.array([w[0] + w[-1] for w in words])], ["conv", "number", "signature", "illegal", "ends"])


def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks sorted by conversation and number -> the way through each block; whole-conversation figures stand on its first block."""
    for group in runs(batches, ["same"], 4096):
        costs, at, extra = chain(group["costs"].to_pylist(), group["ranks"].to_pylist())
        ends = group["ends"].to_pylist()
        odd = sum(group["illegal"].to_pylist()) + sum(illegal(a[1] + b[0]) for a, b in zip(ends, ends[1:]))
        n = len(at) - 1
        columns = [*(group[c].combine_chunks() for c in ("conv", "number", "signature")), pa.array(at, pa.int32()), pa.array([0] * n + [extra], pa.int32()), pa.array([costs] + [0] * n, pa.int64()), pa.array([odd] + [0] * n, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["conv", "number", "signature", "at", "extra", "cost", "illegal"])


def apply_audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv, kind, audit, role, initial, text), each conversation's audit first -> repaired rows in order."""
    conv = audit = None
    at = place = state = 0
    out: list[tuple] = []

    def insert() -> None:
        nonlocal at, place, state
        while audit[at : at + 1] == "I":
            state = inserted(state)
            out.append((conv, place, "I", NAMES[state], ""))
            at, place = at + 1, place + 1

    def ready(kind: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*out))
        out.clear()
        kinds = [kind, pa.int64(), pa.string(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["conv", "place", "edit", "role", "text"])

    for batch in slices(batches):
        kind = batch.schema.field(0).type
        for i, k, edits, role, initial, text in zip(*(batch.column(c).to_pylist() for c in range(6))):
            if k == 0:
                if audit is not None:
                    insert()
                conv, audit, at, place, state = i, edits, 0, 0, START
                continue
            insert()
            edit = audit[at]
            at += 1
            if edit == "D":
                continue
            state = GO[state, initial] if edit == "K" else inserted(state)
            out.append((conv, place, edit, role if edit == "K" else NAMES[state], text))
            place += 1
        if out:
            yield ready(kind)
    if audit is not None:
        insert()
    if out:
        yield ready(kind)


class Repaired(NamedTuple):
    """``conversations``: one row each with counts, cost and audit. ``rows``: (conversation, place, edit, role, text), each conversation's rows in order within one partition."""

    conversations: DataFrame
    rows: DataFrame


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> Repaired:
    """Faults and the cheapest repair of every conversation; ``conversations`` has gaps, blank, duplicate, truncated, illegal, cost and audit.

    Rows are taken by turn, nulls first; rows of one turn by role, then by a hash of role and text. A null role or text counts as one space. Rows
    with a null conversation form one conversation. A row's first fault counts: blank, a role and text seen earlier, or an end without
    full stop, exclamation or question mark. Repeated rows are duplicates of the first; an empty table gives empty results; texts of any length are
    read whole; other columns are not read. An audit has a letter for each edit: Keep, Rerole, Delete, Insert. The result has the
    roles (s?(ua)+)? by their initials; of equally cheap audits the first in ASCII order is taken.

    Rows of a long conversation are spread over sorted ranges and cut into blocks. Only its audit, about a byte for each row, and
    the stream of its repaired rows come together in one task, as both are one value of the result.
    """
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in (role_col, text_col))
    whole = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    initial = F.substring("role", 1, 1)
    whole = whole.withColumn("key", F.md5(F.concat_ws(":", F.length("role"), "role", "text"))).withColumn("initial", F.when(initial.isin(*"sua"), initial).otherwise(OTHER))
    end = F.rtrim("text", F.lit(SPACE))
    letter = F.when(end == "", GONE).when(F.substring(end, -1, 1).isin(*ENDINGS), F.col("initial")).otherwise(F.upper("initial"))
    narrow = stage(whole.select("conv", "turn", "role", "key", "initial", letter.alias("letter")))

    # faults by conversation: the first row of each role and text, and how often it comes
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    texts = stage(narrow.groupBy("conv", "key").agg(F.min(order).alias("first"), F.count("*").alias("n"), F.first("letter").alias("letter")))
    gone = F.col("letter") == GONE
    counts = texts.groupBy("conv").agg(*(F.coalesce(F.sum(F.when(when, n)), F.lit(0)).alias(name) for name, when, n in (
        ("blank", gone, F.col("n")), ("duplicate", ~gone, F.col("n") - 1), ("truncated", ~gone & (F.lower("letter") != F.col("letter")), F.lit(1)))))
    by_turn = narrow.groupBy("conv", "turn").agg(F.count("*").alias("n"))
    gaps = by_turn.groupBy("conv").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"))

    # signatures by blocks of each conversation's rows in order
    again = texts.where("n > 1").select(F.col("conv").alias("c"), F.col("key").alias("k"), "first")
    flagged = narrow.join(again, F.col("conv").eqNullSafe(F.col("c")) & (F.col("key") == F.col("k")), "left")
    flagged = flagged.select("conv", "turn", "role", "key", "letter", "initial", F.coalesce(order > F.col("first"), F.lit(False)).alias("later"))
    by = ["conv", "turn", "role", "key"]
    kind = rows.schema[conv_col].dataType.simpleString()
    ordered = flagged.repartitionByRange(*by).sortWithinPartitions(*by)
    blocks = stage(ordered.mapInArrow(cut_blocks, f"conv {kind}, number long, signature string, illegal long, ends string"))

    # the automaton over all signatures, sorted from their ends
    back = F.reverse("signature")
    words = blocks.select("signature").distinct().repartitionByRange(back).sortWithinPartitions(back)
    solved = stage(words.mapInArrow(solve, "signature string, costs array<int>, ranks array<int>, audits array<string>"))

    joined = blocks.join(solved.select("signature", "costs", "ranks"), "signature").select("conv", "number", "signature", "costs", "ranks", "illegal", "ends", F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit("")).alias("same"))
    joined = joined.repartition("conv").sortWithinPartitions("conv", "number")
    ways = stage(joined.mapInArrow(put_together, f"conv {kind}, number long, signature string, at int, extra int, cost long, illegal long"))
    edits = ways.join(solved.select("signature", "audits"), "signature").select("conv", "cost", "illegal", F.struct("number", F.concat(F.get("audits", F.col("at")), F.repeat(F.lit("I"), F.col("extra"))).alias("edits")).alias("part"))
    audits = edits.groupBy("conv").agg(F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"), F.array_join(F.sort_array(F.collect_list("part"))["edits"], "").alias("audit"))
    audits = stage(audits)

    def beside(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.withColumnRenamed("conv", "c")
        return left.join(right, F.col("conv").eqNullSafe(F.col("c"))).drop("c")

    found = beside(beside(audits, counts), gaps).select(F.col("conv").alias(conv_col), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    heads = audits.select("conv", F.lit(0).alias("kind"), "audit", F.lit(None).cast(rows.schema[turn_col].dataType).alias("turn"), *(F.lit("").alias(c) for c in ("role", "key", "initial", "text")))
    lines = whole.select("conv", F.lit(1).alias("kind"), F.lit("").alias("audit"), "turn", "role", "key", "initial", "text")
    stream = heads.unionByName(lines).repartition("conv").sortWithinPartitions("conv", "kind", "turn", "role", "key")
    fixed = stream.select("conv", "kind", "audit", "role", "initial", "text").mapInArrow(apply_audits, f"conv {kind}, place long, edit string, role string, text string")
    return Repaired(found, fixed.withColumnRenamed("conv", conv_col))


def digests(rows: DataFrame) -> DataFrame:
    """(first column, sha256) of ``Repaired.rows``: the hash of each conversation's ``role:text`` lines. Rows pass in the order they have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, total, kind = None, None, None

        def ready(done: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], kind), pa.array([h for _, h in done], pa.string())], ["conv", "sha256"])

        for batch in slices(batches):
            done, kind = [], batch.schema.field(0).type
            for i, place, _, role, text in zip(*(batch.column(c).to_pylist() for c in range(5))):
                if place == 0:
                    done += [(conv, total.hexdigest())] if total else []
                    conv, total = i, hashlib.sha256()
                total.update(f"{chr(10) if place else ''}{role}:{text}".encode())
            if done:
                yield ready(done)
        if total:
            yield ready([(conv, total.hexdigest())])

    first = rows.columns[0]
    return rows.mapInArrow(run, f"conv {rows.schema[first].dataType.simpleString()}, sha256 string").withColumnRenamed("conv", first)
