"""Helpers that several operators share: reading tables, written stages, the valid row of a key."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: A side is broadcast by hand only below this many rows (keys of a few dozen bytes: some MB).
BROADCAST_ROWS = 100_000


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A test table; with columns, only those are read."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


_own_dirs: dict[str, str] = {}
_stages: list[str] = []


def stage_dir(spark: SparkSession) -> str:
    """The shared folder for written stages: spark.checkpoint.dir of the session; a temporary folder only where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        app = spark.sparkContext.applicationId
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        if app not in _own_dirs:
            _own_dirs[app] = "file://" + tempfile.mkdtemp(prefix="stichos-")
        base = _own_dirs[app]
    return base.rstrip("/")


def written(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write df as Parquet to the shared folder and read it again: the lineage is cut and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{stage_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _stages.append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stages(spark: SparkSession) -> int:
    """Deletes the stages written so far, once no DataFrame that reads them is needed any more. Gives their number."""
    n = len(_stages)
    while _stages:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_stages.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return n


@contextmanager
def stages(spark: SparkSession) -> Iterator[None]:
    """What is written inside is deleted at the end: with stages(spark): query(..).write.."""
    held, _stages[:] = list(_stages), []
    try:
        yield
    finally:
        drop_stages(spark)
        _stages[:] = held


@atexit.register
def _drop_own_dirs() -> None:
    """The temporary folders of sessions without a shared folder go with the process."""
    for path in _own_dirs.values():
        shutil.rmtree(path.removeprefix("file://"), ignore_errors=True)


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast if the counted rows are under the bound; else the planner shuffles both sides."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def orderable(field: T.StructField) -> bool:
    return not isinstance(field.dataType, (T.MapType, T.VariantType))


def latest_rows(df: DataFrame, keys: list[str], order_col: str | None = "loaded_at") -> DataFrame:
    """One row of each key: the one with the latest order_col, ties broken by the other columns, descending, nulls last.

    A null key is a key of its own. The rank is cut to 1 before the shuffle as well (Spark's window group limit), so a
    key delivered in a third of all rows costs one row a task. Without order_col the largest row by all columns is kept.
    """
    rank = "__rank__"
    while rank in df.columns:
        rank += "_"
    first = [order_col] if order_col else []
    rest = [f.name for f in df.schema if f.name not in (*keys, *first) and orderable(f)]
    order = [F.col(f"`{c}`").desc_nulls_last() for c in (*first, *rest)] or [F.lit(0)]
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) == 1).drop(rank)


def month(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")
