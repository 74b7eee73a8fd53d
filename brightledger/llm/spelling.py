"""Spelling variants: words one edit apart, found by search schemes over a bidirectional FM-index of the vocabulary.

Of two words one edit apart, either the first or the second half of the one stands unchanged in the other. A search therefore reads
one half exactly and goes on across the other half with one error allowed. Words stand in the index between delimiters. A step narrows
an interval of suffix ranks, so all words that begin alike are followed at once. Reading to the right uses the
index of the reversed words, reading to the left that of the words; the two together are the bidirectional index.

The vocabulary is dealt out by what must stand unchanged: a word is looked for in the cell of its first half and in that of its
second half, and lies in the cells of the halves of words as long as itself, or one longer or shorter. Cells with too many words are divided
in the same way: of the part that may hold the error, again either half stands unchanged. So every index is of bounded size, and no pair is missed.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.targets import stage
from .common import map_rows, slices

#: Words of a cell, and about those of an index. A cell whose part that may differ has one character holds fewer than this.
CELL = 20_000
#: Bytes of words at which an index is built in any case.
BYTES = 1 << 24
#: Searches that are followed at once.
SEARCHES = 4096
UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
END = 0


class FmIndex:
    """Intervals of suffix ranks over words that are read from left to right.

    The text is each word backwards and a delimiter, words in order, so that reading a word to the right is a backward search. Ranks of
    delimiters are those of the words that follow them.
    """

    def __init__(self, words: Sequence[str]):
        backward = [w[::-1] for w in words]
        self.order = sorted(range(len(words)), key=backward.__getitem__)
        codes = np.frombuffer("\0".join([*(backward[i] for i in self.order), ""]).encode("utf-32-le"), np.uint32)
        self.letters, text = np.unique(codes, return_inverse=True)
        self.n, text = len(text), text.astype(np.int64)
        ends = np.flatnonzero(text == END)
        rank = text + len(words)
        rank[ends] = np.r_[1 : len(words), 0] if len(words) else []
        width, top = 1, self.n + len(self.letters) + 1
        while len(np.unique(rank)) < self.n:  # ranks by ever longer beginnings
            rank = np.unique(rank * top + np.roll(rank, -width), return_inverse=True)[1].astype(np.int64)
            width *= 2
        rank = np.argsort(np.argsort(rank))
        before = np.empty(self.n, np.int64)
        before[rank] = np.roll(text, 1)
        self.before = before
        by_symbol = np.argsort(before, kind="stable")
        self.steps = before[by_symbol] * self.n + by_symbol

    def codes(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all words, each with the delimiter after it, and where each begins. Letters that the index lacks are refused."""
        flat = np.frombuffer("\0".join([*words, ""]).encode("utf-32-le"), np.uint32)
        at = np.searchsorted(self.letters, flat)
        if not np.array_equal(self.letters[np.minimum(at, len(self.letters) - 1)], flat):
            raise ValueError("a word has letters that the index lacks")
        return at.astype(np.int64), np.cumsum([0, *(len(w) + 1 for w in words)])[: len(words)]

    def narrow(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals after one more symbol."""
        return np.searchsorted(self.steps, symbol * self.n + low), np.searchsorted(self.steps, symbol * self.n + high)

    def following(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(interval, letter) for all letters that may come next; delimiters are left out."""
        size, symbols = high - low, len(self.letters)
        small = np.flatnonzero(size <= symbols)
        at = np.repeat(small, size[small])
        inside = np.arange(len(at)) - np.repeat(np.cumsum(size[small]) - size[small], size[small])
        seen = np.unique(at * symbols + self.before[low[at] + inside])
        large = np.flatnonzero(size > symbols)
        every = (large[:, None] * symbols + np.arange(symbols)).ravel()
        pairs = np.r_[seen, every]
        pairs = pairs[pairs % symbols != END]
        return pairs // symbols, pairs % symbols

    def near(self, words: Sequence[str], exact: Sequence[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(word asked, word of the index) one edit apart, both as numbers, where the first ``exact`` letters agree. Pairs may repeat. All words asked must be in the index."""
        for at in range(0, len(words), SEARCHES):
            a, b = self._near(words[at : at + SEARCHES], np.asarray(exact[at : at + SEARCHES], np.int64))
            if len(a):
                yield a + at, np.asarray(self.order)[b]

    def _near(self, words: Sequence[str], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        flat, starts = self.codes(words)
        lengths = np.array([len(w) for w in words], np.int64)
        ask = np.arange(len(words))
        low, high = self.narrow(np.zeros(len(words), np.int64), np.full(len(words), self.n), np.full(len(words), END))
        ready = []
        for place in range(int(exact.max(initial=0)) + 1):
            done = exact[ask] == place
            ready.append((ask[done], low[done], high[done]))
            ask, low, high = ask[~done], low[~done], high[~done]
            low, high = self.narrow(low, high, flat[starts[ask] + place])
            ask, low, high = _where(high - low > 1, ask, low, high)  # an interval of one is the word itself
        ask, low, high = (np.concatenate(x) for x in zip(*ready))
        ask, low, high = _where(high - low > 1, ask, low, high)
        place = exact[ask]
        late = tuple(np.empty(0, np.int64) for _ in range(4))  # searches that have had their error
        found = []
        while len(ask) or len(late[0]):
            if len(ask):
                own = flat[starts[ask] + place]
                state, letter = self.following(low, high)
                a, b = self.narrow(low[state], high[state], letter)
                state, letter, a, b = _where(b > a, state, letter, a, b)
                same, open_ = letter == own[state], place < lengths[ask]
                less = _where(open_, ask, place + 1, low, high)
                more = _where(~same, ask[state], place[state], a, b)
                other = _where(~same & open_[state], ask[state], place[state] + 1, a, b)
                late = tuple(np.concatenate(x) for x in zip(late, less, more, other))
                ask, place, low, high = _where(same & (b - a > 1), ask[state], place[state] + 1, a, b)
            i, p, a, b = late
            over = p == lengths[i]
            a, b = self.narrow(a, b, flat[starts[i] + p])  # the delimiter at the word's end
            late = _where((b > a) & ~over, i, p + 1, a, b)
            found.append(_where((b > a) & over, i, a))
        asked, hit = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 2
        return asked, hit


def _where(keep: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    return tuple(c[keep] for c in columns)


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6, change: Callable[[str, str], str] | None = None) -> DataFrame:
    """(word, n): runs of Latin letters, A-Z in lower case, of at least ``least_length`` code points; counts of equal words are to be added up.

    ``change(id, run)`` may give another, no longer word for a run of a document. Ids go in as text, a null id as an empty one. Null and
    empty texts have no words; repeated rows count each time; other columns are not read.
    """
    find = re.compile(f"[A-Za-zÀ-ÿ]{{{least_length},}}").findall

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        total: Counter[str] = Counter()
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own: Counter[str] = Counter()
            for word, n in Counter(find(text)).items():
                own[word.lower() if word.isascii() else word.translate(UPPER)] += n
            for word, n in own.items():
                total[change(i, word) if change else word] += n
        kept = {w: n for w, n in total.items() if len(w) >= least_length}
        return pa.RecordBatch.from_arrays([pa.array(list(kept), pa.string()), pa.array(list(kept.values()), pa.int64())], ["word", "n"])

    texts = docs.where(F.col(text_col) != "").select(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text_col))
    return map_rows(texts, run, "word string, n long", 2048)


def key() -> Column:
    """A cell: the length of the words asked for, and what stands unchanged at their beginning and end."""
    tail = F.expr("substring(word, length(word) - tail + 1, tail)")
    return F.xxhash64("size", "head", "tail", F.expr("substring(word, 1, head)"), tail)


def cells(vocabulary: DataFrame) -> DataFrame:
    """(key, size, head, tail, right, word, n, asks): where each word is asked for and where it lies."""
    length = F.length("word")
    sizes = F.expr("filter(array(named_struct('size', length(word), 'asks', true), named_struct('size', length(word) - 1, 'asks', false), named_struct('size', length(word), 'asks', false), named_struct('size', length(word) + 1, 'asks', false)), x -> x.size > 0)")
    rows = vocabulary.where(length > 0).select("word", "n", F.inline(sizes)).withColumn("right", F.explode(F.array(F.lit(True), F.lit(False))))
    half = F.expr("size div 2")
    rows = rows.withColumn("head", F.when(F.col("right"), half).otherwise(0).cast("int")).withColumn("tail", F.when(F.col("right"), 0).otherwise(F.col("size") - half).cast("int"))
    return rows.select(key().alias("key"), "size", "head", "tail", "right", "word", "n", "asks")


def divided(rows: DataFrame) -> DataFrame:
    """Rows of cells with too many words in smaller cells, until none has too many."""
    settled = []
    while True:
        full = stage(rows.where("NOT asks").groupBy("key", F.col("size").alias("s"), F.col("head").alias("h"), F.col("tail").alias("t")).agg(F.count("*").alias("words")).where((F.col("words") > CELL) & (F.col("s") - F.col("h") - F.col("t") > 1)).select("key"))
        if not full.take(1):
            break
        settled.append(stage(rows.join(full, "key", "left_anti")))
        parts = F.inline(F.expr("array(named_struct('head', head + (size - head - tail) div 2, 'tail', tail), named_struct('head', head, 'tail', size - head - (size - head - tail) div 2))"))
        rows = stage(rows.join(full, "key", "left_semi").select("size", "right", "word", "n", "asks", parts).select(key().alias("key"), "size", F.col("head").cast("int").alias("head"), F.col("tail").cast("int").alias("tail"), "right", "word", "n", "asks"))
    for part in settled:
        rows = rows.unionByName(part)
    return rows


def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, size, right, word, n, asks) sorted by key -> (word, n, near): for each row that asks, the words one edit away that the cell's index holds."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in slices(batches, CELL):
        held.append(batch)
        n += batch.num_rows
        if n < 2 * CELL and sum(b.nbytes for b in held) < BYTES:
            continue
        rows = pa.Table.from_batches(held).combine_chunks()
        keys = rows["key"].to_numpy()
        cut = int(np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])[-1])  # the last cell may go on
        if cut:
            yield from searched(rows.slice(0, cut))
        held = rows.slice(cut).to_batches()
        n = sum(b.num_rows for b in held)
    if held:
        yield from searched(pa.Table.from_batches(held))


def searched(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    sizes, right, words, counts, asks = (rows[c].to_pylist() for c in ("size", "right", "word", "n", "asks"))
    for side in (True, False):
        known = {w: n for w, n, r, a in zip(words, counts, right, asks) if r == side and not a}
        asked = [(w, n, s // 2 if side else s - s // 2) for w, n, r, a, s in zip(words, counts, right, asks, sizes) if r == side and a]
        if not asked:
            continue
        names = list(known)
        turned = (lambda x: x) if side else (lambda x: x[::-1])
        index = FmIndex([turned(w) for w in names])
        near: list[set[int]] = [set() for _ in asked]
        for a, b in index.near([turned(w) for w, _, _ in asked], [e for _, _, e in asked]):
            for i, j in zip(a.tolist(), b.tolist()):
                near[i].add(j)
        found = [[{"n": known[names[j]], "word": names[j]} for j in x] for x in near]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _, _ in asked], pa.string()), pa.array([n for _, n, _ in asked], pa.int64()), pa.array(found, pa.list_(pa.struct([("n", pa.int64()), ("word", pa.string())])))], ["word", "n", "near"])


def followed(links: DataFrame) -> DataFrame:
    """(word, root) for (word, form) links that lead to ever more frequent words; each turn doubles the steps that are taken."""
    links = stage(links.select("word", F.col("form").alias("root")))
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ahead = stage(links.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if not ahead.where("moved").take(1):
            return ahead.drop("moved")
        links = ahead.drop("moved")


def variants(words: DataFrame, least_count: int = 5, ratio: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words that occur ``least_count`` times in (word, n) rows; counts of equal words add up.

    ``n_near`` counts the words one inserted, deleted or replaced code point away. ``form`` is the most frequent of them, of equally
    frequent ones the first in code-point order, if it is at least ``ratio`` times as frequent, and ``form_n`` its count; ``root`` is where the forms lead. Null and empty words
    are dropped; no words give no rows. ``ratio`` must be over 1, so that forms lead to more frequent words.
    """
    vocabulary = words.where("word <> ''").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)
    rows = divided(cells(stage(vocabulary)))
    dealt = rows.select("key", "size", "right", "word", "n", "asks").repartition("key").sortWithinPartitions("key")
    found = dealt.mapInArrow(search, "word string, n long, near array<struct<n: long, word: string>>")
    near = found.groupBy("word", "n").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    best = F.array_min(F.transform("near", lambda x: F.struct((-x["n"]).alias("n"), x["word"].alias("word"))))
    best = F.when(-best["n"] >= ratio * F.col("n"), best)
    out = stage(near.select("word", "n", F.size("near").cast("long").alias("n_near"), best["word"].alias("form"), (-best["n"]).alias("form_n")))
    roots = followed(out.where("form IS NOT NULL"))
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
