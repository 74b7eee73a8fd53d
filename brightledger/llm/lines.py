"""Line dedup: winnowed fingerprints of line hashes find repeated runs, which are extended both ways and deleted where they come later.

A *line* here ends at a line break or after a punctuation mark with white space, so that passages are found wherever a
document's own line breaks fall; lines of LONG words or more are cut further after words that a hash picks, so that parts of one are found as well.
Lines are hashed; a fingerprint is the hash of two neighbouring lines, and of each window
of fingerprints only the smallest is kept. Every run of GUARANTEE lines that two documents share therefore has a common
fingerprint; so has every shared line, and every pair of neighbouring ones, of LEAST_WORDS words, as such fingerprints are always kept. Each fingerprint meets its first occurrence only (smallest document id, then place), so a passage in m
documents gives m - 1 matches. Along a match both documents' lines are compared as far as they agree. Lines that
repeat earlier ones form runs; runs of enough words are deleted, so the first occurrence of everything stays.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.targets import split_by, stage
from .common import few, list_column, map_rows, only, text_or_empty

#: Lines of a fingerprint, fingerprints of a window, and the length of runs that cannot be missed.
GRAM, WINDOW = 2, 2
GUARANTEE = GRAM + WINDOW - 1
#: Words of whole lines that a repeated run needs. A passage of 50 words may lose a part line at either end.
LEAST_WORDS = 25
#: A line's words as they travel with its hash; larger counts decide nothing.
MOST_COUNT = 32_000
#: Words of a line that is cut further, and the share of its words after which it is.
LONG, EVERY = 24, 8
#: What a character is: white space, ASCII white space (between words), a mark that ends a line before white space. The last entry is for all that follow.
SPACE, BLANK, MARK = 1, 2, 4
KINDS = np.array([chr(c).isspace() * SPACE | (c == 32 or 9 <= c <= 13) * BLANK | (chr(c) in ".!?,;:") * MARK for c in range(0x3002)], np.uint8)
LATIN = KINDS[:256].tobytes()


def spans(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of true begin and end (exclusive)."""
    edges = (mask[1:] != mask[:-1]).nonzero()[0] + 1
    if mask[0]:
        edges = np.concatenate([[0], edges])
    if mask[-1]:
        edges = np.concatenate([edges, [len(mask)]])
    return edges[::2], edges[1::2]


def counted_lines(text: str) -> tuple[list[str], np.ndarray]:
    """Lines with the white space after them, which joined are the text, and the number of words in each (runs without ASCII white space).

    A line ends with white space that follows a mark or holds a line break. A long line is cut by content, before words whose neighbour
    has ends and a length that a rule picks: one that shares a stretch with another long line is cut at the same places there.
    """
    if not text:
        return [], np.empty(0, np.int32)
    try:
        raw = text.encode("latin-1")
        codes, kinds = np.frombuffer(raw, np.uint8), np.frombuffer(raw.translate(LATIN), np.uint8)
    except UnicodeEncodeError:
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        kinds = KINDS.take(codes, mode="clip")
    first, after = spans(kinds & BLANK == 0)
    white, dark = spans(kinds & SPACE != 0)
    breaks = kinds[white - 1] & MARK != 0
    if len(white) and not white[0]:
        breaks[0] = False
    breaks[dark.searchsorted((codes == 10).nonzero()[0], "right")] = True
    cuts = np.concatenate([[0], dark[breaks]])
    if len(cuts) == 1 or cuts[-1] < len(text):
        cuts = np.concatenate([cuts, [len(text)]])
    held = first.searchsorted(cuts)
    words = held[1:] - held[:-1]
    if words.max() >= LONG:
        picked = (17 * codes[first].astype(np.int64) + 31 * codes[after - 1] + after - 1 - first) % EVERY == 0
        at = first[1:][picked[:-1]]
        line = cuts.searchsorted(at, "right") - 1
        at = at[(words[line] >= LONG) & (at > cuts[line])]
        cuts = np.sort(np.concatenate([cuts, at]))
        held = first.searchsorted(cuts)
        words = held[1:] - held[:-1]
    ends = cuts.tolist()
    return [text[a:b] for a, b in zip(ends, ends[1:])], words.astype(np.int32)


def split_lines(text: str) -> list[str]:
    return counted_lines(text)[0]


def line_hashes(lines: list[str]) -> np.ndarray:
    """White space at either end does not count."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, map(str.strip, lines)), np.uint64, len(lines)).view(np.int64)


def fingerprints(hashes: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, places) of the window minima, the rightmost of equal ones, and of all that stand for LEAST_WORDS words: single lines and pairs of lines.

    A text of under GRAM lines is one fingerprint; one of under WINDOW fingerprints gives its smallest.
    """
    h = hashes.view(np.uint64)
    if not len(h):
        return np.empty(0, np.int64), np.empty(0, np.int32)
    gram = np.full(max(1, len(h) - GRAM + 1), len(h) < GRAM, np.uint64)
    for i in range(min(GRAM, len(h))):
        gram = (gram ^ h[i : i + len(gram)]) * np.uint64(0x9E3779B97F4A7C15)
        gram ^= gram >> np.uint64(29)
    n = len(gram) - min(WINDOW, len(gram)) + 1
    low, at = gram[:n], np.arange(n)
    for i in range(1, len(gram) - n + 1):
        at = np.where(gram[i : i + n] <= low, np.arange(i, i + n), at)
        low = np.minimum(gram[i : i + n], low)
    kept = np.zeros(len(gram), bool)
    kept[at] = True
    if len(h) >= GRAM:
        kept |= sum((words[i : len(words) - GRAM + 1 + i] for i in range(1, GRAM)), words[: len(words) - GRAM + 1]) >= LEAST_WORDS
    places, alone = kept.nonzero()[0], (words >= LEAST_WORDS).nonzero()[0]
    if len(alone):
        single = (h[alone] ^ np.uint64(0x5851F42D4C957F2D)) * np.uint64(0x9E3779B97F4A7C15)
        return np.concatenate([gram[places], single]).view(np.int64), np.concatenate([places, alone]).astype(np.int32)
    return gram[places].view(np.int64), places.astype(np.int32)


def values(column: pa.ListArray) -> list[np.ndarray]:
    """The values of each row's list."""
    ends, flat = column.offsets.to_numpy(), column.values.to_numpy()
    return [flat[a:b] for a, b in zip(ends, ends[1:])]


def stretches(hashes: np.ndarray, words: np.ndarray, firsts: np.ndarray, places: np.ndarray, first_places: np.ndarray, unique_ids: bool = True) -> Iterator[tuple]:
    """What each of a document's matches can reach: per first document (its id, begins and ends of stretches of lines, their hashes and words, places, places there, begin and end of the lines there that they can reach).

    Of any three neighbouring lines of a run two are a fingerprint that both documents keep and that matches, if not this first document then an earlier one. So all
    lines of a run are at most one before or two after the place of a match, and a run lies in the stretch of such lines around its own match.
    Places at the same distance that lead on to one another are one run, for which the first of them stands: a line of under LEAST_WORDS words is matched together with the next.
    Where rows share an id all places are kept, as some may be those of another row's text.
    """
    known = places < len(hashes)  # others are of a row that shares the id
    firsts, places, first_places = firsts[known], places[known], first_places[known]
    if not len(places):
        return
    near = np.unique(places)
    low, high = np.maximum(near - 1, 0), np.minimum(near + GUARANTEE, len(hashes))
    apart = np.flatnonzero(low[1:] > high[:-1])
    begins, ends = low[np.concatenate([[0], apart + 1])], high[np.concatenate([apart, [-1]])]
    shifts = places - first_places
    order = np.lexsort((places, shifts, firsts))
    firsts, shifts, places = firsts[order], shifts[order], places[order]
    step, other = np.diff(places), firsts[1:] != firsts[:-1]
    alone = np.full(len(step), not unique_ids) | other | (shifts[1:] != shifts[:-1]) | (step > np.where(words[places[:-1]] < LEAST_WORDS, GRAM, 1))
    stands = np.concatenate([[True], alone])
    groups = np.concatenate([[0], np.flatnonzero(other[alone]) + 1, [stands.sum()]]).tolist()
    firsts, shifts, places = firsts[stands], shifts[stands], places[stands]
    arounds = begins.searchsorted(places, "right") - 1
    lows, highs = begins[arounds] - shifts, ends[arounds] - shifts
    for a, b in zip(groups, groups[1:]):
        met = np.unique(arounds[a:b]) if b - a > 1 else arounds[a:b]
        ranges = list(zip(begins[met].tolist(), ends[met].tolist()))
        taken = [np.concatenate([x[i:j] for i, j in ranges]) if len(ranges) > 1 else x[slice(*ranges[0])] for x in (hashes, words)]
        yield int(firsts[a]), begins[met], ends[met], *taken, places[a:b], places[a:b] - shifts[a:b], max(0, int(lows[a:b].min())), int(highs[a:b].max())


def extended(own: np.ndarray, other: np.ndarray, shift: int, place: int) -> tuple[int, int]:
    """First and last line (exclusive) of ``own`` around ``place`` that agree with ``other`` shifted by ``shift``."""
    low, high = max(0, shift), min(len(own), len(other) + shift)
    if not low <= place < high:
        return place, place
    same = own[low:high] == other[low - shift : high - shift]
    at = place - low
    if not same[at]:
        return place, place
    after, before = (~same[at:]).nonzero()[0], (~same[:at]).nonzero()[0]
    return low + (before[-1] + 1 if len(before) else 0), low + at + (after[0] if len(after) else len(same) - at)


def joined(ranges: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges in order, those that overlap or touch as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def runs_to_cut(ranges: list[tuple[int, int]], words: np.ndarray, least_words: int) -> np.ndarray:
    """Flat (first, last) lines of the runs that ranges of lines make together and that hold enough words."""
    return np.array([x for x in joined(ranges) if words[slice(*x)].sum() >= least_words], np.int32).reshape(-1)


def repeats(docs: DataFrame, id_col: str, text_col: str, least_words: int = LEAST_WORDS) -> DataFrame:
    """(id, mark, cuts): for each document that loses text, flat (first, last) pairs of the lines to cut; ``mark`` is a hash of its text."""

    def lines(batch: pa.RecordBatch) -> pa.RecordBatch:
        only("lines", lambda: None)
        hashes, words, found = [], [], []
        for x in batch.column(2):  # one by one, so that the lines of one text only are held
            split, counts = counted_lines(x.as_py())
            hashes.append(line_hashes(split))
            words.append(np.minimum(counts, MOST_COUNT).astype(np.int16))
            found.append(fingerprints(hashes[-1], counts))
        h, place = list_column([h for h, _ in found], pa.int64()), list_column([p for _, p in found], pa.int32())
        marks = pa.ListArray.from_arrays(h.offsets, pa.StructArray.from_arrays([h.values, place.values], ["h", "place"]))
        columns = [pa.array(map(len, hashes), pa.int32()), list_column(hashes, pa.int64()), list_column(words, pa.int16()), marks]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["id", "mark", "n", "hashes", "words", "marks"])

    def narrow(batch: pa.RecordBatch) -> pa.RecordBatch:
        met = batch.column("met")
        flat = met.values
        if fits:
            flat = flat.to_numpy()
            parts = (flat >> 2 * bits) + low, flat & (1 << bits) - 1, (flat >> bits) & (1 << bits) - 1
        else:
            parts = [flat.field(c).to_numpy() for c in ("id", "place", "first_place")]
        ends = met.offsets.to_numpy()
        rows = zip(*(values(batch.column(c)) for c in ("hashes", "words")), *([x[a:b] for a, b in zip(ends, ends[1:])] for x in parts))
        out = [(at, *x) for at, row in enumerate(rows) for x in stretches(*row, unique_ids)]
        at, firsts, *lists, lows, highs = zip(*out) if out else [()] * 10
        columns = [batch.column(c).take(pa.array(at, pa.int64())) for c in ("id", "mark")]
        columns += [pa.array(firsts, pa.int64()), *(list_column(x, kind) for x, kind in zip(lists, (pa.int32(), pa.int32(), pa.int64(), pa.int16(), pa.int32(), pa.int32())))]
        columns += [pa.array(lows, pa.int32()), pa.array(highs, pa.int32())]
        return pa.RecordBatch.from_arrays(columns, ["id", "mark", "first_id", "begins", "ends", "hashes", "words", "place", "first_place", "low", "high"])

    def extend(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = []
        lists = map(values, map(batch.column, ("begins", "ends", "hashes", "words", "place", "first_place", "others")))
        for begins, ends, hashes, words, places, firsts, other, low in zip(*lists, batch.column("low").to_pylist()):
            after = (ends - begins).cumsum().tolist()
            begins = begins.tolist()
            found: set[tuple[int, int]] = set()
            reach: dict[int, int] = {}
            for place, first in sorted(zip(places.tolist(), firsts.tolist())):
                shift = place - first
                if place < reach.get(shift, 0):
                    continue
                k = bisect_right(begins, place) - 1
                a, b = extended(hashes[after[k - 1] if k else 0 : after[k]], other, shift - begins[k] + low, place - begins[k])
                if b > a:
                    found.add((a + begins[k], b + begins[k]))
                    reach[shift] = b + begins[k]
            flat = joined(found)
            of_ranges = []
            for a, b in flat:
                k = bisect_right(begins, a) - 1
                start = (after[k - 1] if k else 0) - begins[k]
                of_ranges.append(words[a + start : b + start])
            # how many ranges, the ranges, and the words of their lines
            parts.append(np.concatenate([[len(flat)], np.array(flat, np.int32).reshape(-1), *of_ranges]).astype(np.int32) if flat else np.empty(0, np.int32))
        return pa.RecordBatch.from_arrays([batch.column("id"), batch.column("mark"), list_column(parts, pa.int32())], ["id", "mark", "part"])

    def decide(batch: pa.RecordBatch) -> pa.RecordBatch:
        cuts = []
        for parts in batch.column(2):
            flat, at, read = parts.values.to_numpy(), 0, []
            while at < len(flat):
                n = int(flat[at])
                ranges = flat[at + 1 : at + 1 + 2 * n].reshape(-1, 2)
                at += 1 + 2 * n
                for a, b in ranges.tolist():
                    read.append((a, b, flat[at : at + b - a]))
                    at += b - a
            words = np.zeros(max((b for _, b, _ in read), default=0), np.int32)
            for a, b, counts in read:
                words[a:b] = counts
            cuts.append(runs_to_cut([(a, b) for a, b, _ in read], words, least_words))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), list_column(cuts, pa.int32())], ["id", "mark", "cuts"])

    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_or_empty(text_col)), text_or_empty(text_col))
    held = stage(map_rows(texts, lines, "id long, mark long, n int, hashes array<long>, words array<short>, marks array<struct<h: long, place: int>>"))
    marks = held.select("id", F.inline("marks"))
    low, high, most, rows, ids = held.agg(F.min("id"), F.max("id"), F.max("n"), F.count("*"), F.count_distinct("id")).first()
    low, high, bits = low or 0, high or 0, (most or 0).bit_length()
    unique_ids = rows == ids
    # id and place, and both with a place of another document, as one number where they fit: an aggregate of numbers needs no sorting, and a list of them is short
    fits = (high - low + 1) << 2 * bits < 1 << 63
    where = F.shiftleft(F.col("id") - low, bits).bitwiseOR(F.col("place").cast("long")) if fits else F.struct("id", "place")
    firsts = stage(marks.groupBy("h").agg(F.min(where).alias("first"), F.max(where).alias("last")).where("first < last").select("h", "first"))
    # most fingerprints occur once; few of these pass the filter and are shuffled
    common, _ = split_by(marks.select("h", where.alias("at")), F.col("h"), firsts, "h")
    id_of = lambda c: F.shiftright(c, bits) + low if fits else F.col(f"{c}.id")
    met = F.shiftleft("first", bits).bitwiseOR(F.col("at").bitwiseAND((1 << bits) - 1)) if fits else F.struct("first.id", "at.place", F.col("first.place").alias("first_place"))
    matches = stage(common.join(firsts, "h").where("at <> first").groupBy(id_of("at").alias("id")).agg(F.collect_list(met).alias("met")))
    # each fingerprint that is kept occurs at two places at least, so that each of these documents is met
    asked = stage(firsts.select(id_of("first").alias("id")).distinct())

    single = held
    if not unique_ids:  # of the rows of each id one, by the hash of its text
        twice = stage(held.groupBy("id").count().where("count > 1").select("id"))
        several, single = split_by(held.drop("n", "marks"), F.col("id"), twice, "id")
        several = several.groupBy("id").agg(F.min(F.struct("mark", "hashes", "words")).alias("u")).select("id", "u.*")
        single = single.unionByName(several)
    own, _ = split_by(single.select("id", "mark", "hashes", "words"), F.col("id"), matches, "id")
    own = map_rows(own.join(matches, "id"), narrow, "id long, mark long, first_id long, begins array<int>, ends array<int>, hashes array<long>, words array<short>, place array<int>, first_place array<int>, low int, high int", 128)
    # read by the join itself, so that a first document that many others meet is split there
    others, _ = split_by(single.select(F.col("id").alias("first_id"), F.col("hashes").alias("others")), F.col("first_id"), asked, "id")
    both = own.join(others, "first_id").withColumn("others", F.slice("others", F.col("low") + 1, F.col("high") - F.col("low")))
    found = map_rows(both, extend, "id long, mark long, part array<int>").where("size(part) > 0")
    grouped = found.groupBy("id", "mark").agg(F.flatten(F.collect_list("part")).alias("parts"))
    return stage(map_rows(grouped, decide, "id long, mark long, cuts array<int>").where("size(cuts) > 0"))


def cut(text: str, cuts: np.ndarray) -> tuple[str, int, int]:
    """Text without the given lines; words before and after."""
    lines, words = counted_lines(text)
    drop = np.zeros(len(lines), bool)
    for a, b in zip(cuts[::2], cuts[1::2]):
        drop[a:b] = True
    return "".join(x for x, d in zip(lines, drop) if not d), int(words.sum()), int(words[~drop].sum())


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """The input rows with all their columns, later repeated runs cut from ``text_col``, and words_before, words_after.

    Both counts are null where nothing was cut. Null and empty texts stay as they are. Rows with a null id stay as they
    are and others are not compared with them. Of rows that repeat an id with different texts one is compared; equal
    rows are not matched with each other. An own column named like the two counts is replaced; all other names may occur. Only documents
    that may lose text are shuffled; the rest pass from the scan to the result.
    """
    added = ["words_before", "words_after"]
    keep = [c for c in docs.columns if c not in added]
    n, at, i = len(keep), keep.index(text_col), keep.index(id_col)
    plain = docs.select(*keep).toDF(*[f"c{k}" for k in range(n)])
    found = repeats(docs, id_col, text_col, least_words)
    maybe, rest = split_by(plain, F.col(f"c{i}").cast("long"), found, "id")
    same = (F.col(f"c{i}").cast("long") == F.col("id")) & (F.xxhash64(text_or_empty(f"c{at}")) == F.col("mark"))
    joined = maybe.join(few(found, cells="cuts"), same, "left").select(*plain.columns, "cuts")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, before, after = batch.column(at).to_pylist(), [None] * batch.num_rows, [None] * batch.num_rows
        for row, cuts in enumerate(batch.column(n)):
            if cuts.is_valid:
                texts[row], before[row], after[row] = cut(texts[row] or "", cuts.values.to_numpy())
        columns = batch.columns[:n]
        columns[at] = pa.array(texts, pa.string())
        return pa.RecordBatch.from_arrays([*columns, pa.array(before, pa.int64()), pa.array(after, pa.int64())], [f"c{k}" for k in range(n + 2)])

    kinds = [docs.schema[c].dataType.simpleString() for c in keep]
    out = map_rows(joined, run, ", ".join(f"c{k} {kind}" for k, kind in enumerate([*kinds, "long", "long"])))
    none = F.lit(None).cast("long")
    return out.unionByName(rest.select("*", none.alias(f"c{n}"), none.alias(f"c{n + 1}"))).toDF(*keep, *added)


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``drop_repeats`` as a stage: the same columns, without documents that had words and have none left."""
    out = drop_repeats(docs, id_col, text_col, **how)
    return out.where(F.coalesce((F.col("words_after") > 0) | (F.col("words_before") == 0), F.lit(True))).select(*docs.columns)
