"""Report tables: every update yields the full new content of the target.

Plain parquet tables know no row-level delete or merge, so a reload or merge is a
DataFrame from the old content and the new rows; ``publish`` then swaps it in.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.membership import bloom_filter, might_hold
from ..operators.relational import not_in


def overwrite(old: DataFrame, new: DataFrame) -> DataFrame:
    """Full refresh."""
    return new.select(*old.columns)


def reload_window(old: DataFrame, new: DataFrame, column: str, cutoff: date | datetime) -> DataFrame:
    """Replace rows at or after ``cutoff``. A null in ``column`` is not deleted."""
    # date-times without zone: a literal made from a Python datetime would depend on the session zone
    limit = F.lit(cutoff.isoformat(" ")).cast("timestamp_ntz") if isinstance(cutoff, datetime) else F.lit(cutoff)
    kept = old.where((F.col(column) < limit) | F.col(column).isNull())
    return kept.unionByName(new)


def reload_key(old: DataFrame, new: DataFrame, column: str, value) -> DataFrame:
    """Replace rows of one key. A null key is not deleted."""
    return old.where((F.col(column) != F.lit(value)) | F.col(column).isNull()).unionByName(new)


def newer_than(src: DataFrame, column: str, target: DataFrame, target_column: str | None = None) -> DataFrame:
    """Source rows beyond the target's high-water mark; an empty target passes nothing."""
    mark = target.agg(F.max(target_column or column)).scalar()
    return src.where(F.col(column) > mark)


def append_newer(target: DataFrame, src: DataFrame, column: str) -> DataFrame:
    return target.unionByName(newer_than(src, column, target))


def split_by(df: DataFrame, key: Column, values: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(rows that ``values`` may hold, rows that it surely lacks). Rows with a null key are among the latter.

    The filter is staged as one row; both parts read ``df`` on their own and are not shuffled.
    """
    built, n = bloom_filter(values, column)
    might = F.coalesce(might_hold(key, stage(built).scalar(), n), F.lit(False))
    return df.where(might), df.where(~might)


def append_new(target: DataFrame, src: DataFrame, key: str) -> DataFrame:
    """Append distinct source rows whose key the target lacks (``NOT IN`` rules for nulls).

    A membership filter of the target's keys tells most new rows, which then are not joined; the rest pass the exact anti join.
    """
    known = target.select(key)
    maybe, lacking = split_by(stage(src.distinct()), F.col(key), known, key)
    return target.unionByName(not_in(maybe, F.col(key), known, lacking))


def missing_nullsafe(src: DataFrame, target: DataFrame, keys: Sequence[str], nullsafe: Sequence[str]) -> DataFrame:
    """Source rows without a match in the target; only ``nullsafe`` keys let null equal null."""
    known = target.select(*[F.col(k).alias(f"__{k}") for k in [*keys, *nullsafe]]).distinct()
    conds = [F.col(k) == F.col(f"__{k}") for k in keys]
    conds += [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in nullsafe]
    return src.join(known, reduce(lambda a, b: a & b, conds), "left_anti")


def append_new_nullsafe(target: DataFrame, src: DataFrame, keys: Sequence[str], nullsafe: Sequence[str]) -> DataFrame:
    return target.unionByName(missing_nullsafe(src, target, keys, nullsafe).select(*target.columns))


def merge(target: DataFrame, src: DataFrame, on: Sequence[str], *, nullsafe: Sequence[str] = (),
          lower: Sequence[str] = (), update: Sequence[str] = (), update_when: Column | None = None,
          delete_when: Column | None = None, insert: bool = True) -> DataFrame:
    """New target content after a merge.

    ``on`` keys match by equality, ``nullsafe`` ones also on null and ``lower`` ones without
    regard to case. Conditions may name target columns as ``t_<name>`` and source columns as
    ``s_<name>``. Matched rows take ``update`` columns where ``update_when`` holds (always,
    if it is not given); otherwise they vanish where ``delete_when`` holds. Source columns
    the target lacks are ignored; missing ones are filled with null.
    """
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in target.columns], F.lit(True).alias("__t"))
    s = src.select(*[F.col(c).alias(f"s_{c}") for c in src.columns], F.lit(True).alias("__s"))
    conds = [F.col(f"t_{k}") == F.col(f"s_{k}") for k in on]
    conds += [F.col(f"t_{k}").eqNullSafe(F.col(f"s_{k}")) for k in nullsafe]
    conds += [F.lower(f"t_{k}") == F.lower(f"s_{k}") for k in lower]
    joined = t.join(s, reduce(lambda a, b: a & b, conds), "full" if insert else "left")
    matched = F.col("__t").isNotNull() & F.col("__s").isNotNull()
    changed = matched & (F.coalesce(update_when, F.lit(False)) if update_when is not None else F.lit(True))
    if delete_when is not None:
        joined = joined.where(~(matched & ~changed & F.coalesce(delete_when, F.lit(False))))
    fresh = F.col("__t").isNull()

    def value(c: str) -> Column:
        if c not in src.columns:
            return F.col(f"t_{c}")
        take = fresh | changed if c in update else fresh
        return F.when(take, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}"))

    return joined.select(*[value(c).alias(c) for c in target.columns])


def snapshot(df: DataFrame, as_of: date, column: str = "Cohort_Date") -> DataFrame:
    """Stamp rows with the day before ``as_of``."""
    return df.select(F.date_sub(F.lit(as_of), 1).alias(column), *[F.col(c) for c in df.columns])


def nth_row(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The n-th row (from 1) of a small sheet under a stated order."""
    return df.orderBy(*order).offset(n - 1).limit(1)


def _data_folder(new: DataFrame, path: str, partition_by: Sequence[str]) -> str:
    target = f"{path.rstrip('/')}/data-{uuid.uuid4().hex}"
    writer = new.write.partitionBy(*partition_by) if partition_by else new.write
    writer.parquet(target)
    return target


def _point(spark: SparkSession, path: str, version: str, folders: Sequence[str], marks: Mapping[str, str | None]) -> None:
    entries = [x for k, v in marks.items() for x in (F.lit(k), F.lit(v).cast("string"))]
    named = F.create_map(*entries) if entries else F.lit(None)
    pointer = spark.range(1).select(F.current_timestamp().alias("at"), F.lit(version).alias("version"), F.array(*map(F.lit, folders)).alias("folders"), named.cast("map<string,string>").alias("marks"))
    pointer.coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}/pointers")


def _marks(df: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """The largest value of each column, as text."""
    return df.agg(*[F.max(c).cast("string").alias(c) for c in columns]).first().asDict() if columns else {}


def publish(spark: SparkSession, new: DataFrame, path: str, version: str, partition_by: Sequence[str] = (), marks: Sequence[str] = ()) -> str:
    """Write a new version of a target beside the old ones, then add a row that points at it.

    Nothing that is being read is overwritten or deleted: the data go to a folder of their own, and the pointer is
    appended in one committed file. A job that fails before that leaves the old content current; a second run with the same
    version adds a newer one. With ``partition_by``, later scans read the partitions they ask for only. The pointer keeps the largest value of
    each column in ``marks``, so that a later append need not look for it.
    """
    target = _data_folder(new, path, partition_by)
    _point(spark, path, version, [target], _marks(spark.read.parquet(target), marks))
    return target


def _pointer(spark: SparkSession, path: str):
    """The newest pointer."""
    return spark.read.parquet(f"{path.rstrip('/')}/pointers").orderBy(F.desc("at"), F.desc("folders")).first()


def newer_than_published(spark: SparkSession, path: str, src: DataFrame, column: str) -> DataFrame:
    """``newer_than`` against the mark that the current version's pointer keeps: the target is not read. No mark passes nothing."""
    mark = (_pointer(spark, path)["marks"] or {}).get(column)
    return src.where(F.col(column) > F.lit(mark).cast(src.schema[column].dataType))


def publish_newer(spark: SparkSession, path: str, src: DataFrame, column: str, version: str) -> str:
    """Append the source rows beyond the mark of ``column``: the new version is the old folders and one with these rows, and the marks move on."""
    last = _pointer(spark, path)
    target = _data_folder(newer_than_published(spark, path, src, column), path, ())
    added = spark.read.parquet(target)
    old = dict(last["marks"] or {})
    new = _marks(added, list(old))
    kinds = {c: added.schema[c].dataType for c in old}
    marks = {}
    if old:
        later = [F.greatest(F.lit(old[c]).cast(kinds[c]), F.lit(new[c]).cast(kinds[c])).cast("string").alias(c) for c in old]
        marks = spark.range(1).select(*later).first().asDict()
    _point(spark, path, version, [*last["folders"], target], marks)
    return target


def replace_partitions(new: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Rewrite only the partitions of a date-keyed target that ``new`` has rows for; the others stay as they are."""
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def _partitions(df: DataFrame, column: str) -> list:
    """The partitions that rows fall into: as many values as the target has folders, not rows."""
    return [r[0] for r in df.select(column).distinct().collect()]


def within(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows of the given partitions; a scan of a folder partitioned by ``column`` reads no others."""
    known = [v for v in values if v is not None]
    cond = F.col(column).isin(known) if known else F.lit(False)
    return df.where(cond | F.col(column).isNull() if len(known) < len(values) else cond)


def _rewrite(spark: SparkSession, path: str, rows: DataFrame, column: str, touched: Sequence) -> None:
    """Put ``rows`` in place of the partitions ``touched``; one that is left without rows becomes an empty table."""
    rows = stage(rows)  # the write must not overwrite what it reads
    filled = set(_partitions(rows, column))
    replace_partitions(rows, path, [column])
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    for value in touched:
        if value not in filled:
            folder = escape(column, None if value is None else str(value))
            rows.drop(column).where("false").write.mode("overwrite").parquet(f"{path.rstrip('/')}/{folder}")


def merge_partitions(spark: SparkSession, path: str, src: DataFrame, on: Sequence[str], column: str, **how) -> list:
    """``merge`` into a folder partitioned by ``column``: only partitions that changes fall into are read whole and written.

    Those are the partitions of the source's rows and, where ``column`` is not one of the keys, the partitions in which the
    target has a row with a source row's keys; that search reads the keys alone. Returns the partitions rewritten. A run that fails
    leaves every partition either old or new, and a second run of the same merge gives the same content.
    """
    target = spark.read.parquet(path)
    src = stage(src)
    touched = set(_partitions(src, column))
    if column not in [*on, *how.get("nullsafe", ()), *how.get("lower", ())]:
        conds = [(k, F.col(k), F.col(f"__{k}"), Column.__eq__) for k in on]
        conds += [(k, F.col(k), F.col(f"__{k}"), Column.eqNullSafe) for k in how.get("nullsafe", ())]
        conds += [(k, F.lower(k), F.lower(F.col(f"__{k}")), Column.__eq__) for k in how.get("lower", ())]
        keys = src.select(*[F.col(k).alias(f"__{k}") for k, *_ in conds]).distinct()
        held = target.select(*{k: None for k, *_ in conds}, column)
        touched |= set(_partitions(held.join(keys, reduce(lambda a, b: a & b, [same(x, y) for _, x, y, same in conds]), "left_semi"), column))
    if touched:
        _rewrite(spark, path, merge(within(target, column, list(touched)), src, on, **how), column, list(touched))
    return sorted(touched, key=repr)


def reload_partitions(spark: SparkSession, path: str, new: DataFrame, column: str, cutoff, schema: StructType | None = None) -> list:
    """``reload_window`` in a folder partitioned by ``column``: partitions from ``cutoff`` on get the new rows, or none. Earlier ones must not come in.

    ``schema`` is the folder's, where partition names alone don't tell the type. Returns the partitions rewritten.
    """
    new = stage(new)
    if new.where(F.col(column).isNull() | (F.col(column) < F.lit(cutoff))).take(1):
        raise ValueError(f"rows before the cutoff {cutoff}, or without {column}")
    held = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    touched = set(_partitions(held.where(F.col(column) >= F.lit(cutoff)), column)) | set(_partitions(new, column))
    if touched:
        _rewrite(spark, path, new.select(*held.columns), column, list(touched))
    return sorted(touched)


def current(spark: SparkSession, path: str) -> DataFrame:
    """Read the version ``publish`` made current: the newest pointer's."""
    first, *others = _pointer(spark, path)["folders"]
    out = spark.read.parquet(first)
    for folder in others:
        out = out.unionByName(spark.read.schema(out.schema).parquet(folder))
    return out


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or the context's checkpoint folder. Raises where none is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("staging needs a folder that all executors share: set spark.checkpoint.dir")
    return folder.rstrip("/")


def local_shared_folder(spark: SparkSession) -> None:
    """For trials in one process: give a local session without a shared folder one. A cluster's session must name its own."""
    try:
        shared_folder(spark)
    except RuntimeError:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stage-"))


def scratch(spark: SparkSession) -> str:
    """A path in the shared folder for a target that lives as long as the driver."""
    path = f"{shared_folder(spark)}/target-{uuid.uuid4().hex}"
    _drop_at_end(spark, path)
    return path


def stage_partitioned(df: DataFrame, column: str) -> str:
    """Write an intermediate table partitioned by ``column`` to the shared folder; returns its path, for scans that prune."""
    path = f"{shared_folder(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.partitionBy(column).parquet(path)
    _drop_at_end(df.sparkSession, path)
    return path


def _drop_at_end(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)


def stage(df: DataFrame, codec: str | None = None) -> DataFrame:
    """Write an intermediate table to the folder of ``shared_folder``, with a ``codec`` other than the session's where one is given, and read it back.

    For results that several later steps read: the work is done once, lost executors do not
    undo it, and later scans read only the columns they need. The files go when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stage-{uuid.uuid4().hex}"
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    _drop_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)
