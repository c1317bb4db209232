"""Parallel layers: left joins by verse and by line position, key remaps, coverage.

Layers are reduced to valid rows by the caller. Null texts count as empty; duplicate keys are the caller's business but for last_wins.
Blank slots inside a verse keep their place; rows with a null key pair with nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stichos.functions import text as X


def joined_verses(lines: DataFrame, keys: list[str], order: list[str], text: str) -> DataFrame:
    """One text for each key: the stripped, non-blank lines in order, joined by a space."""
    kept = lines.withColumn("__t", X.strip(F.coalesce(F.col(text), F.lit("")))).filter("__t <> ''")
    ordered = F.array_sort(F.collect_list(F.struct(*order, F.col("__t").alias("__t"))))
    return kept.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda x: x["__t"]), " ").alias("text"))


def verse_left_join(left: DataFrame, right: DataFrame, keys: list[str], value: str) -> DataFrame:
    """left with value of right, '' where right has none, and aligned (whether it has any text)."""
    r = right.select(*keys, F.col(value).alias("__v"))
    return left.join(r, keys, "left").withColumn(value, F.coalesce("__v", F.lit(""))).withColumn("aligned", F.col(value) != "").drop("__v")


def line_slots(lines: DataFrame, verse: list[str], order: list[str]) -> DataFrame:
    """Adds slot (from 0) to lines, without the blank lines at a verse's end; blank lines inside keep a slot."""
    w = Window.partitionBy(*verse).orderBy(*order)
    blank = X.strip(F.coalesce(F.col("text"), F.lit(""))) == ""
    slots = lines.withColumn("slot", F.row_number().over(w) - 1).withColumn("__last", F.max(F.when(~blank, F.col("slot"))).over(Window.partitionBy(*verse)))
    return slots.filter(F.col("slot") <= F.col("__last")).drop("__last")


def line_left_join(left: DataFrame, right: DataFrame, verse: list[str]) -> DataFrame:
    """Lines of both layers (with slot) by position; lines of right beyond left's are dropped."""
    r = right.select(*verse, "slot", F.col("text").alias("__r"))
    return left.join(r, [*verse, "slot"], "left").select(*verse, "slot", F.coalesce("text", F.lit("")).alias("left_text"), F.coalesce("__r", F.lit("")).alias("right_text"))


def remap(df: DataFrame, table: DataFrame, keys: list[str], number: str) -> DataFrame:
    """Renumbers by a table of rules (keys.., first, last, shift): numbers in first..last (null: without end) move by shift; a null shift drops the row."""
    t = table.select(*[F.col(k).alias(f"__{k}") for k in keys], "first", "last", "shift")
    on = [F.col(k) == F.col(f"__{k}") for k in keys] + [(F.col(number) >= F.col("first")) & (F.col(number) <= F.coalesce("last", F.col(number)))]
    out = df.join(F.broadcast(t), on, "left")  # one row a rule, whatever the data
    gone = F.col("first").isNotNull() & F.col("shift").isNull()
    return out.filter(~gone).withColumn(number, F.col(number) + F.coalesce("shift", F.lit(0))).select(*df.columns)


def coverage(aligned: DataFrame, by: list[str], flag: Column) -> DataFrame:
    """by.., n_verses, n_aligned, percent."""
    out = aligned.groupBy(*by).agg(F.count("*").alias("n_verses"), F.sum(F.when(flag, 1).otherwise(0)).alias("n_aligned"))
    return out.withColumn("percent", X.percent(F.col("n_aligned"), F.col("n_verses")))


def missing_refs(aligned: DataFrame, by: list[str], flag: Column, order: list[str], ref: Column, shown: int = 12) -> DataFrame:
    """by.., n_missing and the first refs in order: a top-k report. Ranks are cut before the shuffle, so a book of any size fits."""
    gaps = aligned.filter(~flag)
    counts = gaps.groupBy(*by).agg(F.count("*").alias("n_missing"))
    top = gaps.withColumn("__n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("__n") <= shown)
    refs = top.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__n", ref.alias("r")))), lambda x: x["r"]), ",").alias("first_refs"))
    return counts.join(refs, by)
