"""Gates: parity checks over whole corpora, each one row a key (gate, key, checked, bad, ok). Nulls count as empty texts.

Both sides are reduced to one row a key first, so the joins are one to one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def gate(rows: DataFrame, name: str, key: Column, bad: Column) -> DataFrame:
    out = rows.groupBy(key.alias("key")).agg(F.count("*").alias("checked"), F.sum(F.when(bad, 1).otherwise(0)).alias("bad"))
    return out.select(F.lit(name).alias("gate"), "key", "checked", "bad", (F.col("bad") == 0).alias("ok"))


def compare_sides(left: DataFrame, right: DataFrame, keys: list[str], value: str, how: str = "full") -> DataFrame:
    """keys.., left_value, right_value: '' for a missing side. how: full, or left to see left's keys only."""
    return left.select(*keys, F.col(value).alias("left_value")).join(right.select(*keys, F.col(value).alias("right_value")), keys, how).fillna("", ["left_value", "right_value"])


def shared(left: DataFrame, right: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides without the rows of files (keys) that only one of them has."""
    a, b = left.select(*keys).distinct(), right.select(*keys).distinct()
    both = a.join(b, keys, "left_semi")
    return left.join(both, keys, "left_semi"), right.join(both, keys, "left_semi")


def first_mismatches(rows: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first n differing rows, a top-k report."""
    return rows.filter("left_value <> right_value").orderBy(*order).limit(n)


def exit_code(gates: DataFrame) -> int:
    """0 if every gate holds, else 1."""
    return int(gates.filter("not ok").limit(1).count() > 0)
