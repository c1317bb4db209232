"""Sinks. Files of exact names are written by the tasks, a row a file; nothing passes through the driver."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stichos import catalog


def write_tokens(tokens: DataFrame, path: str) -> None:
    """The token table as Parquet by book, with the declared descriptions."""
    about = {f.name: f.metadata for f in catalog.TOKENS}
    for name in tokens.columns:
        if name in about:
            tokens = tokens.withMetadata(name, about[name])
    tokens.repartition("book_code", "chapter").write.mode("overwrite").partitionBy("book_code").parquet(path)


def write_named(rows: DataFrame, root: str) -> int:
    """rows: name (relative path), body. One file each, UTF-8, under root: a folder all executors share, or a URI (file, hdfs, s3, ..). Gives the number of files.

    A file appears whole: it is written beside its place and moved there, so a task run again does no harm. A null body is an empty file.
    """

    def put(batches):
        system, base = fs.FileSystem.from_uri(root) if ":/" in root else (fs.LocalFileSystem(), root)
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                target = f"{base.rstrip('/')}/{name}"
                system.create_dir(target.rpartition("/")[0], recursive=True)
                beside = f"{target}.{uuid.uuid4().hex}.part"
                with system.open_output_stream(beside) as f:
                    f.write((body or "").encode("utf-8"))
                system.move(beside, target)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    return rows.select("name", "body").filter("name is not null").mapInArrow(put, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def write_report(report: DataFrame, path: str) -> None:
    """A coverage report, a JSON row a book; non-ASCII stays as it is."""
    report.write.mode("overwrite").json(path)
