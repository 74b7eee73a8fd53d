"""Near-duplicate embeddings by NN-descent.

1. Equal vectors are one class; only one of each class goes on.
2. Random hyperplanes cut the vectors into small blocks, more times the deeper the cuts; each block gives its members first neighbours.
3. NN-descent: every vector introduces its neighbours (and those it is a neighbour of) to each other, block by block in
   numpy; lists keep the closest. A list that is full of links is enlarged, up to WIDE. Rounds end when lists that had
   room hardly gain links.
4. Links at the threshold, confirmed in double precision, form components. Vectors whose lists are full of links are
   compared with those of other components, block by block, so components that only weaker links join are joined. Within a
   component all pairs are compared in blocks of bounded size, so vectors with more links than any list holds are counted in full.
5. A bounded sample of vectors is compared with all others by brute force. While the result holds less than RECALL of
   their links, twice as many cuts are added and steps 3 and 4 repeated. ``audit`` gives the figure for any result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.targets import stage
from .common import map_rows, runs
from .graph import components

#: Length of a list, and of a list full of links; least trees and block size of the start; most members that meet at once.
NARROW, WIDE, TREES, LEAF, MEET = 8, 64, 6, 48, 64
#: Most rounds after a start, and the gain in links under which they end.
ROUNDS, GAIN = 6, 0.001
#: Share of a sample's links that must be found, its vectors, and the chance that a pair at the threshold shares a first block.
RECALL, SAMPLE, SHARED = 0.99, 128, 0.99
#: Members of a block when all pairs of a component are compared.
BLOCK = 512
#: Float32 lists take in links this far under the threshold; double precision decides.
SLACK = 1e-5


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec as doubles, k1, k2) of vectors that can link: not null or empty, all components finite, some not zero, of the most common length."""
    v = F.col(vec_col).cast("array<double>")
    rows = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), v.alias("vec"))
    good = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    rows = rows.where(F.col("vec").isNotNull() & good)
    size = rows.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), "size").first()
    rows = rows.where(F.size("vec") == (size["size"] if size else 0))
    return rows.select("id", "vec", F.xxhash64("vec").alias("k1"), F.xxhash64(F.reverse("vec"), F.lit(7)).alias("k2"))


def block_lists(ids: np.ndarray, x: np.ndarray, limit: float, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, neighbour, cosine): each member's closest members, NARROW of them and up to WIDE links, above its own ``floor``."""
    s = x @ x.T
    s[ids[:, None] == ids[None, :]] = -2
    width = min(WIDE, len(ids))
    near = np.argpartition(-s, width - 1, axis=1)[:, :width] if width < len(ids) else np.tile(np.arange(len(ids)), (len(ids), 1))
    values = np.take_along_axis(s, near, axis=1)
    order = np.argsort(-values, axis=1, kind="stable")
    near, values = np.take_along_axis(near, order, axis=1), np.take_along_axis(values, order, axis=1)
    keep = ((np.arange(width) < NARROW) | (values >= limit)) & (values > -2)
    if floor is not None:
        keep &= values > floor[:, None]
    a, b = np.nonzero(keep)
    return ids[a], ids[near[a, b]], values[a, b]


def matrix(group: pa.Table, column: str = "vec") -> np.ndarray:
    flat = group.column(column).combine_chunks().flatten().to_numpy()
    return flat.reshape(group.num_rows, -1)


def cuts(n: int, least: float) -> tuple[int, int]:
    """Planes of a random cut of ``n`` vectors, and the cuts after which a pair at ``least`` has met with a chance of SHARED."""
    depth = max(0, math.ceil(math.log2(max(1, n) / LEAF)))
    together = (1 - math.acos(max(-1.0, min(1.0, least))) / math.pi) ** depth
    return depth, max(TREES, math.ceil(math.log(1 - SHARED) / math.log(1 - together))) if 0 < together < 1 else TREES


def first_lists(nodes: DataFrame, n: int, limit: float, seed: int = 11, times: int = 1) -> DataFrame:
    """(id, to, sim) from the blocks of random cuts, ``times`` as many as ``cuts`` says; blocks of many members are split at random."""
    depth, trees = cuts(n, limit)
    trees *= times

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = matrix(pa.Table.from_batches([batch]))
        planes = np.random.default_rng(seed).standard_normal((x.shape[1], trees * depth)).astype(np.float32)
        bits = (x @ planes >= 0).reshape(len(x), trees, depth)
        codes = bits @ (1 << np.arange(depth, dtype=np.int64)) + (np.arange(trees, dtype=np.int64) << 48) if depth else np.zeros((len(x), 1), np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(codes), pa.list_(pa.int64()))], ["id", "codes"])

    def meet(batches):
        for group in runs(batches, ["code", "part"], 2048):
            a, b, s = block_lists(group.column("id").to_numpy(), matrix(group), limit)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(s, pa.float32())], ["id", "to", "sim"])

    coded = stage(map_rows(nodes.select("id", "unit").withColumnRenamed("unit", "vec"), cut, "id long, codes array<long>", 4096).select("id", F.explode("codes").alias("code")))
    sizes = stage(coded.groupBy("code").agg(F.ceil(F.count("*") / (4 * LEAF)).alias("parts")))
    rows = coded.join(sizes, "code").select("id", "code", F.pmod(F.xxhash64("id", "code"), "parts").alias("part")).join(nodes.select("id", F.col("unit").alias("vec")), "id")
    return rows.repartition("code", "part").sortWithinPartitions("code", "part").mapInArrow(meet, "id long, to long, sim float")


def merged(lists: DataFrame, limit: float) -> DataFrame:
    """(id, near array of (sim, to)): the closest, NARROW of them and up to WIDE links."""
    one = lists.repartition("id").groupBy("id", "to").agg(F.max("sim").alias("sim"))
    out = one.groupBy("id").agg(F.slice(F.sort_array(F.collect_list(F.struct("sim", "to")), asc=False), 1, WIDE).alias("near"))
    return out.select("id", F.filter("near", lambda x, i: (i < NARROW) | (x["sim"] >= limit)).alias("near"))


def introduced(graph: DataFrame, nodes: DataFrame, limit: float, turn: int) -> DataFrame:
    """(id, to, sim): what neighbours of a common neighbour gain from meeting. Of a vector with many of them, random groups of MEET meet, others each turn."""
    ways = graph.select("id", F.explode("near.to").alias("to"))
    ways = ways.unionByName(ways.select(F.col("to").alias("id"), F.col("id").alias("to"))).distinct()
    ways = stage(ways)
    parts = stage(ways.groupBy(F.col("id").alias("at")).agg(F.ceil(F.count("*") / MEET).alias("parts")))
    worst = F.when(F.size("near") >= NARROW, F.element_at("near", -1)["sim"]).otherwise(F.lit(-1.0)).cast("float")
    members = stage(nodes.select("id", F.col("unit").alias("vec")).join(graph.select("id", worst.alias("floor")), "id", "left").select("id", "vec", F.coalesce("floor", F.lit(-1.0).cast("float")).alias("floor")))
    rows = ways.join(parts, ways.id == parts["at"]).select("at", F.pmod(F.xxhash64("to", F.lit(turn)), "parts").alias("part"), F.col("to").alias("id")).join(members, "id")

    def meet(batches):
        for group in runs(batches, ["at", "part"], 2048):
            if group.num_rows > 1:
                a, b, s = block_lists(group.column("id").to_numpy(), matrix(group), limit, group.column("floor").to_numpy())
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(s, pa.float32())], ["id", "to", "sim"])

    return rows.repartition("at", "part").sortWithinPartitions("at", "part").mapInArrow(meet, "id long, to long, sim float")


def cosine(a: str, b: str):
    def dot(x, y):
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)

    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def counted(nodes: DataFrame, labels: DataFrame, least: float) -> DataFrame:
    """(id, links): links of each vector to others of its component, weighted by the size of their classes. Blocks of a component meet pairwise."""
    members = labels.join(nodes.select("id", "vec", "size"), "id").select("component", "id", "vec", "size")
    members = stage(members)
    sizes = stage(members.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")))
    rows = members.join(sizes, "component").withColumn("own", F.pmod(F.xxhash64("id"), "blocks"))
    all_blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    left = rows.select("component", F.col("own").alias("i"), all_blocks.alias("j"), F.lit(0).alias("side"), "id", "vec", "size")
    right = rows.select("component", all_blocks.alias("i"), F.col("own").alias("j"), F.lit(1).alias("side"), "id", "vec", "size")

    def compare(batches):
        for group in runs(batches, ["component", "i", "j"], 4096):
            side, ids, x = group.column("side").to_numpy(), group.column("id").to_numpy(), matrix(group)
            norm = np.sqrt((x * x).sum(axis=1))
            a, b, size = side == 0, side == 1, group.column("size").to_numpy()
            near = (x[a] @ x[b].T) / (norm[a][:, None] * norm[b][None, :]) >= least
            near &= ids[a][:, None] != ids[b][None, :]
            yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(near @ size[b])], ["id", "links"])

    met = left.unionByName(right).repartition("component", "i", "j").sortWithinPartitions("component", "i", "j")
    return met.mapInArrow(compare, "id long, links long").groupBy("id").agg(F.sum("links").alias("links"))


def bridges(graph: DataFrame, nodes: DataFrame, labels: DataFrame, least: float, limit: float) -> DataFrame | None:
    """(a, b): a link for each two blocks of different components that have one among vectors with lists full of links; None without two such components.

    A link that both lists dropped has two such ends, so none is missed. Blocks meet unless the angle between their centres
    less both radii is too wide for any link.
    """
    full = graph.where(F.size(F.filter("near", lambda x: x["sim"] >= limit)) >= WIDE).select("id")
    members = stage(full.join(labels, "id").join(nodes.select("id", "vec"), "id").select("component", "id", "vec"))
    sizes = stage(members.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")))
    if sizes.count() < 2:
        return None
    rows = stage(members.join(sizes, "component").select("component", F.pmod(F.xxhash64("id"), "blocks").alias("block"), "id", "vec"))

    def measured(batches):
        for group in runs(batches, ["component", "block"], 4096):
            x = matrix(group)
            x = x / np.sqrt((x * x).sum(axis=1))[:, None]
            mid = x.sum(axis=0)
            mid = mid / norm if (norm := np.sqrt(mid @ mid)) > 1e-9 else x[0]
            reach = float(np.arccos(np.clip(x @ mid, -1, 1)).max())
            yield pa.RecordBatch.from_arrays([group.column("component").combine_chunks().slice(0, 1), group.column("block").combine_chunks().slice(0, 1), pa.array([mid], pa.list_(pa.float64())), pa.array([reach])], ["component", "block", "mid", "reach"])

    blocks = stage(rows.repartition("component", "block").sortWithinPartitions("component", "block").mapInArrow(measured, "component long, block long, mid array<double>, reach double"))
    a, b = (blocks.toDF(*(f"{c}_{x}" for c in blocks.columns)) for x in "ab")
    dot = F.aggregate(F.zip_with("mid_a", "mid_b", lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)
    angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot)))
    close = angle - F.col("reach_a") - F.col("reach_b") <= math.acos(max(-1.0, min(1.0, least))) + 1e-6
    met = stage(a.join(b, (F.col("component_a") < F.col("component_b")) & close).select("component_a", "block_a", "component_b", "block_b"))
    keys = met.columns
    sides = [met.join(rows.toDF(f"component_{x}", f"block_{x}", "id", "vec"), [f"component_{x}", f"block_{x}"]).select(*keys, F.lit(i).alias("side"), "id", "vec") for i, x in enumerate("ab")]

    def compare(batches):
        for group in runs(batches, keys, 2048):
            side, ids, x = group.column("side").to_numpy(), group.column("id").to_numpy(), matrix(group)
            x = x / np.sqrt((x * x).sum(axis=1))[:, None]
            near = np.argwhere(x[side == 0] @ x[side == 1].T >= least)
            if len(near):
                yield pa.RecordBatch.from_arrays([pa.array(ids[side == 0][near[:1, 0]]), pa.array(ids[side == 1][near[:1, 1]])], ["a", "b"])

    return sides[0].unionByName(sides[1]).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(compare, "a long, b long")


def prepared(df: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, DataFrame]:
    """Staged: rows (id, k1, k2), and one node (id, vec, unit, size, k1, k2) of each class of equal vectors."""
    rows = stage(usable(df, id_col, vec_col))
    classes = stage(rows.groupBy("k1", "k2").agg(F.min("id").alias("id"), F.count("*").alias("size")))
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))
    nodes = rows.join(classes, ["id", "k1", "k2"]).dropDuplicates(["id"]).withColumn("norm", norm)
    return rows.drop("vec"), stage(nodes.select("id", "vec", F.transform("vec", lambda x: (x / F.col("norm")).cast("float")).alias("unit"), "size", "k1", "k2"))


def listed(graph: DataFrame) -> DataFrame:
    return graph.select("id", F.explode("near").alias("x")).select("id", "x.to", "x.sim")


def descended(starts: DataFrame, nodes: DataFrame, limit: float, seed: int) -> DataFrame:
    """Staged lists after rounds of introductions, until those that had room for links gain hardly any."""
    links = F.size(F.filter("near", lambda x: x["sim"] >= limit))
    graph = stage(merged(starts, limit))
    for turn in range(ROUNDS):
        gained = introduced(graph, nodes, limit, 1000 * seed + turn)
        new = stage(merged(gained.unionByName(listed(graph)), limit))
        both = new.select("id", links.alias("now")).join(graph.select("id", links.alias("before")), "id", "left").select("now", F.coalesce("before", F.lit(0)).alias("before"))
        now, before = both.where(F.col("before") < WIDE).agg(F.coalesce(F.sum("now"), F.lit(0)), F.coalesce(F.sum("before"), F.lit(0))).first()
        graph = new
        if turn and now - before <= GAIN * now:
            break
    return graph


def grouped(graph: DataFrame, nodes: DataFrame, least: float, limit: float) -> DataFrame:
    """Staged (id, k1, k2, n_links, component_id), one row per node."""
    near = graph.select("id", F.explode("near").alias("x")).where(F.col("x.sim") >= limit).select(F.least("id", "x.to").alias("a"), F.greatest("id", "x.to").alias("b")).distinct()
    vec = {x: nodes.select(F.col("id").alias(x), F.col("vec").alias(f"vec_{x}")) for x in "ab"}
    linked = near.join(vec["a"], "a").join(vec["b"], "b").where(cosine("vec_a", "vec_b") >= least).select("a", "b")
    linked = stage(linked)
    labels = stage(components(linked).withColumnRenamed("node", "id"))
    across = bridges(graph, nodes, labels, least, limit)
    if across is not None and (across := stage(across)).count():
        labels = stage(components(linked.unionByName(across)).withColumnRenamed("node", "id"))
    full = nodes.select("id", "size", "k1", "k2").join(labels, "id", "left").join(counted(nodes, labels, least), "id", "left")
    return stage(full.select("id", "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id")))


def near_duplicates(df: DataFrame, least: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(``id_col``, n_links, component_id, kept): one row per input row.

    Two vectors are linked if their cosine is at least ``least``. Vectors that are null, empty, zero, hold null or
    non-finite components, or have another length than most, have no links and are their own component. Rows with a null
    id have no links and a null component. Ids are integers; rows that repeat an id with equal vectors count as one link
    each.
    """
    rows, nodes = prepared(df, id_col, vec_col)
    n, limit, graph, times = nodes.count(), least - SLACK, None, 1
    while True:
        starts = first_lists(nodes, n, limit, 10 + times, times)
        graph = descended(starts if graph is None else starts.unionByName(listed(graph)), nodes, limit, times)
        full = grouped(graph, nodes, least, limit)
        if recall(nodes, full.select("id", "n_links"), SAMPLE, least + 1e-9) >= RECALL:  # rounding at the threshold can't ask for more rounds
            break
        times *= 2
    known = rows.join(full.drop("id"), ["k1", "k2"]).select("id", "n_links", "component_id")
    rest = df.select(F.col(id_col).cast("long").alias("id")).join(stage(rows.select("id").distinct()), "id", "left_anti")
    out = known.unionByName(rest.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def audit(df: DataFrame, result: DataFrame, sample: int = 128, least: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding") -> float:
    """Share of the true links of about ``sample`` vectors that ``result`` counts; each meets all rows by brute force, counts only are shuffled."""
    rows, nodes = prepared(df, id_col, vec_col)
    return recall(nodes, result.select(F.col(id_col).alias("id"), "n_links"), sample, least)


def recall(nodes: DataFrame, counts: DataFrame, sample: int, least: float) -> float:
    """Share of the true links of ``sample`` nodes in ``counts`` (id, n_links)."""
    some = nodes.orderBy(F.xxhash64("id", F.lit(5))).limit(sample).select("id", "vec").collect()
    if not some:
        return 1.0
    ids, x = np.array([r["id"] for r in some]), np.array([r["vec"] for r in some])
    shipped = nodes.sparkSession.sparkContext.broadcast((ids, x / np.sqrt((x * x).sum(axis=1))[:, None]))

    def compare(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, q = shipped.value
        y = matrix(pa.Table.from_batches([batch]))
        near = (q @ (y / np.sqrt((y * y).sum(axis=1))[:, None]).T) >= least
        return pa.RecordBatch.from_arrays([pa.array(own), pa.array(near @ batch.column(1).to_numpy())], ["id", "links"])

    true = map_rows(nodes.select("vec", "size").select(F.col("vec"), "size"), compare, "id long, links long", 4096).groupBy("id").agg((F.sum("links") - 1).alias("links"))
    both = true.join(counts, "id").agg(F.sum("links"), F.sum(F.least("links", "n_links"))).first()
    return 1.0 if not both[0] else both[1] / both[0]
