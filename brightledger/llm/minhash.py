"""Near-duplicate documents: MinHash bands find candidates, odd sketches sift them, full shingle sets confirm them.

1. Each document's words become a set of hashed shingles; 128 minima of the set form 32 bands of four. The minima are also
   folded into an *odd sketch*, a bitmap in which each sample flips one bit: equal samples of two documents cancel in the
   XOR, so its population count tells how many samples differ, precisely so at high similarity.
2. Documents with equal sets are one class; only one of each class goes on.
3. In each bucket of a band all members are compared with one leader, so a group of m copies gives m pairs, not m squared.
   Pairs whose sketches allow the threshold are confirmed on the full sets and joined into components.
4. Buckets that still hold several components are finished exactly: every member outside the largest component meets all
   others as sketches, in blocks of bounded size. First only the most similar partner per block is confirmed, which joins
   most of what belongs together; then all pairs of different components that pass a finer sketch. No bucket is capped.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.targets import stage
from .common import few, list_column, map_rows, only, runs, text_or_empty
from .graph import components

BANDS, ROWS_PER_BAND = 32, 4
SAMPLES, BITS = BANDS * ROWS_PER_BAND, 512
#: Samples and bits of the finer sketch.
FINE_SAMPLES, FINE_BITS = 1024, 4096
#: Rounds that confirm the most similar partners only.
ROUNDS = 2
#: Members of a block in step 4.
BUILD, PROBE = 256, 1024
#: Word hashes a worker remembers.
WORDS = 250_000

_rng = np.random.default_rng(20240229)
MULTIPLY = (_rng.integers(0, 1 << 32, FINE_SAMPLES, np.uint64) | np.uint64(1)).astype(np.uint32)[:, None]
ADD = _rng.integers(0, 1 << 32, FINE_SAMPLES, np.uint64).astype(np.uint32)[:, None]
SALT = _rng.integers(0, 1 << 63, FINE_SAMPLES, np.uint64)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > WORDS:
            self.clear()
        self[word] = out = xxhash.xxh3_64_intdigest(word)
        return out


HASHES = WordHashes()


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingles(text: str, k: int) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles; of the whole sequence, if it is shorter. A-Z count as a-z, words end at ASCII white space."""
    only("words", HASHES.clear)
    words = text.encode().lower().split()  # on bytes both know ASCII only
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))
    k = min(k, len(words))
    out = np.full(len(words) - k + 1, k, np.uint64)
    for i in range(k):
        out = mix(out * np.uint64(0xD1B54A32D192ED03) + h[i : len(words) - k + 1 + i])
    return np.unique(out)


def minima(found: np.ndarray, samples: int = SAMPLES) -> np.ndarray:
    """Minima of a shingle set under that many hash functions, taken in blocks."""
    least = np.full((samples, 1), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(found), 4096):
        part = (found[at : at + 4096] >> np.uint64(32)).astype(np.uint32)
        least = np.minimum(least, (part * MULTIPLY[:samples] + ADD[:samples]).min(axis=1, keepdims=True))
    return least[:, 0]


def odd_sketch(least: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The samples' parity bitmap, as words of 64 bits."""
    bit = mix(least.astype(np.uint64) ^ SALT[: len(least)]) % np.uint64(bits)
    flips = np.bincount(bit.astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8)).view(np.uint64)


def most_bits(percent: int, samples: int = SAMPLES, bits: int = BITS) -> int:
    """Population count of the XOR up to which a pair may still reach the threshold: the estimate's error may be over five standard deviations."""
    margin = 5.5 * math.sqrt(0.25 / samples if percent <= 50 else percent / 100 * (1 - percent / 100) / samples)
    differ = 2 * samples * (1 - percent / 100 + margin)
    return math.ceil(bits / 2 * (1 - math.exp(-2 * differ / bits)))


def sketches(docs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n_shingles, key_a, key_b, bands, odd); the keys are a 128-bit digest of the set."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, keys, bands, odd = [], [], [], []
        for x in batch.column(1):
            found = shingles(x.as_py(), k)
            sizes.append(len(found))
            if not len(found):
                keys.append((0, 0))
                bands.append(np.empty(0, np.int64))
                odd.append(np.empty(0, np.int64))
                continue
            digest = xxhash.xxh3_128_digest(found.tobytes())
            keys.append((int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)))
            least = minima(found)
            rows = least.reshape(BANDS, ROWS_PER_BAND).astype(np.uint64)
            band = np.arange(BANDS, dtype=np.uint64)
            for i in range(ROWS_PER_BAND):
                band = mix(band * np.uint64(0xD1B54A32D192ED03) + rows[:, i])
            bands.append(band.view(np.int64))
            odd.append(odd_sketch(least).view(np.int64))
        a, b = (pa.array([x[i] for x in keys], pa.int64()) for i in (0, 1))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), a, b, list_column(bands, pa.int64()), list_column(odd, pa.int64())], ["id", "n_shingles", "key_a", "key_b", "bands", "odd"])

    return map_rows(docs.select(F.col(id_col).cast("long"), text_or_empty(text_col)), run, "id long, n_shingles long, key_a long, key_b long, bands array<long>, odd array<long>")


def confirmed(pairs: DataFrame, docs: DataFrame, k: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold. Only documents of some pair are read into sets."""
    ids = stage(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingles(x.as_py(), k).view(np.int64) for x in batch.column(1)]
        return pa.RecordBatch.from_arrays([batch.column(0), list_column(found, pa.int64())], ["id", "found"])

    texts = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text")).join(few(ids), "id", "left_semi")
    sets = stage(map_rows(texts, run, "id long, found array<long>"))
    left, right = (sets.select(F.col("id").alias(x), F.col("found").alias(f"set_{x}")) for x in "ab")
    both = F.size(F.array_intersect("set_a", "set_b"))
    return pairs.join(right, "b").join(left, "a").where(100 * both >= percent * (F.size("set_a") + F.size("set_b") - both)).select("a", "b").distinct()


def differing(x: str, y: str):
    return F.aggregate(F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda s, n: s + n)


def finer(members: DataFrame, docs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """(id, odd) with the finer sketch, for the documents of ``members``."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        odd = [odd_sketch(minima(shingles(x.as_py(), k), FINE_SAMPLES), FINE_BITS).view(np.int64) for x in batch.column(1)]
        return pa.RecordBatch.from_arrays([batch.column(0), list_column(odd, pa.int64())], ["id", "odd"])

    texts = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text")).join(few(members), "id", "left_semi")
    return map_rows(texts, run, "id long, odd array<long>")


def mixed_buckets(members: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Staged: members (h, id, c) of buckets that hold several components, and those buckets (h, top, blocks, probes) with their largest one."""
    held = members.join(labels, "id", "left").select("h", "id", F.coalesce("component", "id").alias("c"))
    sizes = held.groupBy("h", "c").agg(F.count("*").alias("n")).groupBy("h").agg(F.sum("n").alias("n"), F.count("*").alias("parts"), F.max(F.struct("n", "c")).alias("top"))
    mixed = sizes.where("parts > 1").select("h", F.col("top.c").alias("top"), F.ceil((F.col("n") - F.col("top.n")) / BUILD).alias("blocks"), F.ceil(F.col("n") / PROBE).alias("probes"))
    mixed = stage(mixed)
    return stage(held.join(mixed.select("h"), "h", "left_semi")), mixed


def across(held: DataFrame, mixed: DataFrame, sketch: DataFrame, bits: int, best: bool) -> DataFrame:
    """Pairs (a, b) of one bucket and different components whose sketches differ in at most ``bits`` bits.

    The members outside a bucket's largest component form blocks, and each block meets all members block by block; rows are
    repeated once per block on the other side, pairs are made and sifted inside numpy. ``best``: of each such member only
    the most similar partner in a block. Otherwise a pair comes from the first bucket that its members share, once only.
    """
    rows = held.join(mixed, "h").join(sketch, "id")
    own, other = F.pmod(F.xxhash64("id"), "blocks"), F.pmod(F.xxhash64("id", F.lit(1)), "probes")
    build = rows.where("c <> top").select("h", own.alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("probes") - 1)).alias("j"), F.lit(0).alias("side"), "id", "c", "odd", "bands")
    probe = rows.select("h", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("i"), other.alias("j"), F.lit(1).alias("side"), "id", "c", "odd", "bands")

    def run(batches):
        for group in runs(batches, ["h", "i", "j"], 4096):
            side = group.column("side").to_numpy()
            ids, parts = group.column("id").to_numpy(), group.column("c").to_numpy()
            odd = group.column("odd").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(ids), -1)
            build, probe = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            if not best:
                bands, h = group.column("bands").combine_chunks().flatten().to_numpy().reshape(len(ids), BANDS), group.column("h")[0].as_py()
            for at in range(0, len(build), 32):
                rows = build[at : at + 32]
                count = np.bitwise_count(odd[rows][:, None, :] ^ odd[probe][None, :, :]).sum(axis=2, dtype=np.int64)
                count[parts[rows][:, None] == parts[probe][None, :]] = bits + 1
                if best and len(probe):
                    x, y = np.arange(len(rows)), count.argmin(axis=1)
                    near = count[x, y] <= bits
                    x, y = x[near], y[near]
                else:
                    x, y = np.nonzero(count <= bits)
                    shared = bands[rows[x]] == bands[probe[y]]
                    first = bands[rows[x], shared.argmax(axis=1)] == h
                    x, y = x[first], y[first]
                if len(x):
                    a, b = ids[rows[x]], ids[probe[y]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    blocks = build.unionByName(probe).repartition("h", "i", "j").sortWithinPartitions("h", "i", "j")
    return blocks.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, percent: int = 80, k: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, n_shingles, component_id, kept): one row per input row with an id.

    Two documents are linked if their sets of ``k``-word shingles share at least ``percent`` in 100 of their union;
    ``component_id`` is the smallest id reachable. Null or wordless texts have no shingles and no links. Rows with a null id
    keep their count, have a null component and are kept. Rows that repeat an id are one node, linked by any of their texts.
    Ids are integers.
    """
    found = stage(sketches(docs, k, id_col, text_col))
    usable = found.where("n_shingles > 0 AND id IS NOT NULL")
    classes = stage(usable.groupBy("key_a", "key_b", "n_shingles").agg(F.min("id").alias("rep")))
    reps = stage(usable.select("id", "key_a", "key_b", "bands", "odd").join(classes.select(F.col("rep").alias("id"), "key_a", "key_b"), ["id", "key_a", "key_b"]).select("id", "bands", "odd"))
    buckets = reps.select("id", F.explode("bands").alias("h"))
    leaders = stage(buckets.groupBy("h").agg(F.min("id").alias("lead"), F.max("id").alias("last")).where("lead < last").select("h", "lead"))
    members = stage(buckets.join(leaders, "h").select("h", "id", "lead"))
    bits = most_bits(percent)
    pairs = members.where("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    odd = {x: reps.select(F.col("id").alias(x), F.col("odd").alias(f"odd_{x}")) for x in "ab"}
    tried = stage(pairs.join(odd["b"], "b").join(odd["a"], "a").where(differing("odd_a", "odd_b") <= bits).select("a", "b"))
    links = stage(confirmed(tried, docs, k, percent, id_col, text_col))
    labels = stage(components(links).withColumnRenamed("node", "id"))
    for step in range(ROUNDS + 1):
        held, mixed = mixed_buckets(members.select("h", "id"), labels)
        if not mixed.limit(1).count():
            break
        if step < ROUNDS:
            more = across(held, mixed, reps.select("id", "odd", F.lit(None).cast("array<long>").alias("bands")), bits, best=True)
        else:
            fine = stage(finer(stage(held.select("id").distinct()), docs, k, id_col, text_col).join(reps.select("id", "bands"), "id"))
            more = across(held, mixed, fine, most_bits(percent, FINE_SAMPLES, FINE_BITS), best=False)
        more = stage(more.join(tried, ["a", "b"], "left_anti"))
        if not more.limit(1).count():
            continue
        links = stage(links.unionByName(confirmed(more, docs, k, percent, id_col, text_col)))
        labels = stage(components(links).withColumnRenamed("node", "id"))
        tried = tried.unionByName(more)
    named = stage(classes.join(labels, classes.rep == labels["id"], "left").select("key_a", "key_b", "n_shingles", F.coalesce("component", "rep").alias("component_id")))
    out = found.select("id", "n_shingles", "key_a", "key_b").join(named, ["key_a", "key_b", "n_shingles"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))
