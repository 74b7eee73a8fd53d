"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.targets import stage

#: Rows handed to a function at once; a bound on memory, not on what is processed.
ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_HELD: list[tuple[str, Callable[[], None]]] = []


def only(name: str, clear: Callable[[], None]) -> None:
    """What operator ``name`` remembers may stay in this worker from task to task; what another one left goes first, back to the system, so that memories don't add up."""
    if _HELD and _HELD[0][0] != name:
        _HELD.pop()[1]()
        gc.collect()
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)
    if not _HELD:
        _HELD.append((name, clear))


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_rows(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, rows: int = ROWS) -> DataFrame:
    """``mapInArrow`` with a function from one small batch to one batch (or none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows):
            out = fn(batch)
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


def list_column(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list array from one numpy array per row."""
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))


def runs(batches: Iterator[pa.RecordBatch], keys: list[str], most: int) -> Iterator[pa.Table]:
    """Groups of consecutive rows with equal ``keys``. The caller's keys bound each group to ``most`` rows on average, so it fits in memory."""
    held: list[pa.RecordBatch] = []
    for batch in slices(batches, most):
        part = pa.Table.from_batches([*held, batch]) if held else pa.Table.from_batches([batch])
        held = []
        columns = [part.column(k).to_numpy(zero_copy_only=False) for k in keys]
        n = part.num_rows
        change = np.zeros(n - 1, bool) if n else np.zeros(0, bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), n]
        for a, b in zip(cuts[:-2], cuts[1:-1]):
            yield part.slice(a, b - a)
        held = part.slice(cuts[-2], n - cuts[-2]).to_batches()
    if held:
        yield pa.Table.from_batches(held)


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever its case."""
    held = {c.lower() for c in df.columns}
    while name.lower() in held:
        name += "_"
    return name


def without(docs: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """The rows, all columns as they are, whose id is not in the one column of ``ids``. Rows with a null id stay."""
    name = free_name(docs, "__gone")
    gone = stage(ids.toDF(name).where(F.col(name).isNotNull()).distinct())
    return docs.join(few(gone), F.col(id_col) == F.col(name), "left_anti")


def few(df: DataFrame, most: int = 200_000, cells: str | None = None) -> DataFrame:
    """A staged table of narrow rows, marked for broadcast only if it holds at most ``most`` rows; else it is joined by shuffle.

    ``cells`` names an array column: all its arrays together may then hold ten times ``most`` values at most.
    """
    n, values = df.agg(F.count("*"), F.coalesce(F.sum(F.size(cells)), F.lit(0)) if cells else F.lit(0)).first()
    return F.broadcast(df) if n <= most and values <= 10 * most else df
