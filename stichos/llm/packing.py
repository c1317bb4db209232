"""Filling fixed-capacity containers: texts, measured in tokens of a public tokenizer, put together with little space left over.

Bounded-space online packing: every partition of the scan keeps `windows` open containers. A text goes into the open container it leaves
least space in; if none holds it, the fullest is closed and a new one opened. A text longer than the capacity fills containers of
its own, and only its last piece is placed like a text. The containers still open at the end of a partition are merged
in a second packing of containers into containers, repeated with ever fewer tasks until one task can take them, so what any
task holds is bounded by merge_rows, and the space left over does not grow with the number of partitions.

One pass reads and measures the texts, without a shuffle, and writes what it placed to the shared folder; the rest works on
container ids and sizes. A lost task is done again from the same rows in the same order, or read from the written stage.

Defined results: every row has a place, also each row of a repeated id or text; a null or blank-to-the-tokenizer text has
0 tokens, container null and offset null; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import base64
import bisect
import math
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stichos.common import small_side, written


#: How the public byte-level tokenizers cut a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def tokenizer(path: str, pattern: str = PATTERN):
    """Counts the tokens of texts: a list of texts to a list of counts. path: a .tiktoken file of ranks. A Python worker reads it once for all its tasks."""
    import tiktoken
    from tiktoken import registry

    name = f"{path} {pattern}"
    coder = registry.ENCODINGS.get(name)
    if coder is None:
        with open(path) as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        coder = registry.ENCODINGS[name] = tiktoken.Encoding(os.path.basename(path), pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return lambda texts: [len(coder.encode_ordinary(t)) for t in texts]


#: More tasks than a merge has.
LEVEL = 1 << 20


class Packer:
    """Open containers of one capacity, at most `windows` at a time. put returns (container, offset, closed containers)."""

    def __init__(self, capacity: int, windows: int):
        self.capacity, self.windows = capacity, windows
        self.open: list[tuple[int, int]] = []  # (space left, container), by space
        self.made = 0

    def put(self, size: int) -> tuple[int, int, int | None]:
        closed = None
        at = bisect.bisect_left(self.open, (size, -1))
        if at == len(self.open):
            if len(self.open) == self.windows:
                closed = self.open.pop(0)[1]
            space, name = self.capacity, self.made
            self.made += 1
        else:
            space, name = self.open.pop(at)
        if space > size:
            bisect.insort(self.open, (space - size, name))
        return name, self.capacity - space, closed


def place(df: DataFrame, id_col: str, text_col: str, capacity: int, windows: int, tokenizer_path: str) -> DataFrame:
    """First stage: id, piece, n_tokens, part, container (in its part, null for an empty text), at (offset in the container)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, packer, part = tokenizer(tokenizer_path), Packer(capacity, windows), TaskContext.get().partitionId()
        for batch in batches:
            rows, pieces, sizes, names, offsets = [], [], [], [], []
            for row, n in enumerate(count([t or "" for t in batch.column(1).to_pylist()])):
                piece = 0
                while True:
                    size = min(n, capacity)
                    name, offset, _ = packer.put(size) if size else (None, None, None)
                    for column, value in zip((rows, pieces, sizes, names, offsets), (row, piece, size, name, offset)):
                        column.append(value)
                    n, piece = n - size, piece + 1
                    if not n:
                        break
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int32())), pa.array(pieces, pa.int32()), pa.array(sizes, pa.int32()), pa.array([part] * len(rows), pa.int32()), pa.array(names, pa.int64()), pa.array(offsets, pa.int32())],
                names=["id", "piece", "n_tokens", "part", "container", "at"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, piece int, n_tokens int, part int, container long, at int")


def merge_containers(open_: DataFrame, capacity: int, windows: int, tasks: int, level: int) -> DataFrame:
    """Packs containers (part, container, used) into each other: part, container, into_part, into, base (offset in into).

    into_part also tells the level of the merge, so containers of different levels have different names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, part = Packer(capacity, windows), TaskContext.get().partitionId() + level * LEVEL
        for batch in batches:
            into, base = [], []
            for used in batch.column(2).to_pylist():
                name, offset, _ = packer.put(used)
                into.append(name)
                base.append(offset)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([part] * len(into), pa.int32()), pa.array(into, pa.int64()), pa.array(base, pa.int32())], names=["part", "container", "into_part", "into", "base"])

    # Largest first within a task; the shares are by hash, so any run again makes the same containers.
    spread = open_.select("part", "container", "used").repartition(tasks, F.xxhash64("part", "container")).sortWithinPartitions(F.desc("used"), "part", "container")
    return spread.mapInArrow(run, "part int, container long, into_part int, into long, base int")


def pack(
    df: DataFrame, id_col: str, text_col: str, tokenizer_path: str, capacity: int = 2048, windows: int = 64, merge_rows: int = 200_000, merge_windows: int = 4096,
) -> DataFrame:
    """id, piece, n_tokens, container (long), token_at: where the first token of the piece stands in its container, which also orders its pieces."""
    if capacity < 1 or windows < 1:
        raise ValueError("capacity and windows must be at least 1")
    put = written(place(df, id_col, text_col, capacity, windows, tokenizer_path), "packing-placed")
    fill = written(put.filter("container is not null").groupBy("part", "container").agg(F.sum("n_tokens").cast("int").alias("used")), "packing-fill")
    # Containers that still have room for the smallest use; those under 15/16 are worth a merge with others.
    poor = fill.filter(F.col("used") < capacity - capacity // 16)
    moves, n = None, poor.count()
    if n:
        now, level = poor, 0
        while True:
            level += 1
            tasks = max(1, math.ceil(n / merge_rows))
            step = written(merge_containers(now, capacity, merge_windows, tasks, level), "packing-merged")
            if moves is None:
                moves = step
            else:
                nxt = step.select(F.col("part").alias("into_part"), F.col("container").alias("into"), F.col("into_part").alias("p2"), F.col("into").alias("c2"), F.col("base").alias("b2"))
                moved = F.col("p2").isNotNull()
                moves = moves.join(nxt, ["into_part", "into"], "left").select("part", "container", F.when(moved, F.col("p2")).otherwise(F.col("into_part")).alias("into_part"), F.when(moved, F.col("c2")).otherwise(F.col("into")).alias("into"), (F.col("base") + F.coalesce("b2", F.lit(0))).alias("base"))
            if tasks == 1:
                break
            now = moves.join(now.select("part", "container", "used"), ["part", "container"]).groupBy(F.col("into_part").alias("part"), F.col("into").alias("container")).agg(F.sum("used").cast("int").alias("used"))
            now = written(now.filter(F.col("used") < capacity - capacity // 16), "packing-poor")
            before, n = n, now.count()
            if not n or n >= before:  # what is left doesn't fit together
                break
    # One name for each container: kept ones have even names, merged ones odd.
    name = (F.col("part").cast("long") * (1 << 34) + F.col("container")) * 2
    if moves is None:
        out = put.select("id", "piece", "n_tokens", name.alias("box"), F.col("at").alias("token_at"))
    else:
        merged = (F.col("into_part").cast("long") * (1 << 34) + F.col("into")) * 2 + 1
        out = put.join(small_side(moves, poor.count()), ["part", "container"], "left")
        out = out.select("id", "piece", "n_tokens", F.when(F.col("into").isNull(), name).otherwise(merged).alias("box"), (F.col("at") + F.coalesce("base", F.lit(0))).alias("token_at"))
    return out.select(F.col("id").alias(id_col), "piece", "n_tokens", F.col("box").alias("container"), "token_at")


def audit(packed: DataFrame, id_col: str, capacity: int, unused: float = 0.02) -> DataFrame:
    """One row on a packing: n_rows (texts), n_empty (texts with no container), and what must be 0 or true: n_over (containers over the
    capacity), n_gaps (pieces that don't begin where the piece before ends, or the container), n_split (texts whose pieces before the last are not
    full, or are not numbered from 0), full (the share left over is under unused, the last container aside). Ids are taken to be unique."""
    in_box = Window.partitionBy("container").orderBy("token_at")
    placed = packed.filter("container is not null")
    gap = F.col("token_at") != F.coalesce(F.lag(F.col("token_at") + F.col("n_tokens")).over(in_box), F.lit(0))
    boxes = placed.withColumn("gap", gap).groupBy("container").agg(F.sum("n_tokens").alias("used"), F.count_if("gap").alias("gaps"))
    spare = 1 - F.sum("used") / (F.greatest(F.count("*") - 1, F.lit(1)) * F.lit(capacity))
    told = boxes.agg(F.count_if(F.col("used") > capacity).alias("n_over"), F.coalesce(F.sum("gaps"), F.lit(0)).alias("n_gaps"), F.coalesce(spare < unused, F.lit(True)).alias("full"))
    full = F.count_if(F.col("n_tokens") == capacity)
    texts = packed.groupBy(id_col).agg(F.count("*").alias("n"), full.alias("n_full"), F.max("piece").alias("last"), F.countDistinct("piece").alias("n_pieces"))
    wrong = (F.col("n_full") < F.col("n") - 1) | (F.col("last") != F.col("n") - 1) | (F.col("n_pieces") != F.col("n"))
    sizes = texts.agg(F.count("*").alias("n_rows"), F.count_if(wrong).alias("n_split"))
    empty = packed.agg(F.count_if(F.col("container").isNull()).alias("n_empty"))
    one = sizes.unionByName(empty, True).unionByName(told, True)  # three rows
    return one.agg(*[F.max(c).alias(c) for c in ("n_rows", "n_empty", "n_over", "n_gaps", "n_split", "full")])
