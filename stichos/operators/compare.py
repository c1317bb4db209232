"""Differences between two copies of a dataset, field by field.

Both sides are reduced to the valid row of each key, hashed into buckets and cogrouped as Arrow tables. In a bucket the
keys are coded to integers and aligned by a sorted search; every field is compared at once by a null-aware mask; the
masked cells come out. The number of buckets follows the counted rows, so a bucket stays at rows_per_bucket rows, and as
each key has one row by then, no key can make a bucket hot.

Defined results: null equals null only, also in a key; NaN equals NaN; a field whose type differs between the sides is
compared as text; repeated deliveries count once; empty sides report every key of the other; further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stichos.common import latest_rows


def _codes(left: pa.Table, right: pa.Table, n_keys: int) -> tuple[np.ndarray, np.ndarray]:
    """Integer codes of the keys, equal where all key columns are equal."""
    total = np.zeros(left.num_rows + right.num_rows, dtype=np.int64)
    for i in range(n_keys):
        both = pa.chunked_array([*left.column(i).chunks, *right.column(i).chunks], type=left.schema.field(i).type).combine_chunks()
        coded = (both if isinstance(both, pa.Array) else pa.concat_arrays(both.chunks)).dictionary_encode()
        codes = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        _, total = np.unique(total * (len(coded.dictionary) + 1) + codes, return_inverse=True)
    return total[: left.num_rows], total[left.num_rows :]


def _unlike(a: pa.ChunkedArray, b: pa.ChunkedArray) -> np.ndarray:
    differs = pc.fill_null(pc.not_equal(a, b), False)
    if pa.types.is_floating(a.type):
        differs = pc.and_not(differs, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
    return pc.or_(differs, pc.xor(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False)


def copy_differences(
    left: DataFrame, right: DataFrame, keys: Sequence[str], fields: Sequence[str],
    names: tuple[str, str] = ("current", "snapshot"), order_col: str | None = "loaded_at", rows_per_bucket: int = 50_000,
) -> DataFrame:
    """keys.., diff, <left>_value, <right>_value (text of the cell). diff: <right>_missing, <left>_missing or the field's name."""
    keys, fields, (a, b) = list(keys), list(fields), names
    kinds = {c: (left.schema[c].dataType, right.schema[c].dataType) for c in (*keys, *fields)}

    def side(df: DataFrame, at: int) -> DataFrame:
        order = [order_col] if order_col else []
        valid = latest_rows(df.select(*keys, *fields, *[o for o in order if o not in (*keys, *fields)]), keys, order_col)
        cols = [F.col(c).cast("string") if kinds[c][0] != kinds[c][1] else F.col(c) for c in (*keys, *fields)]
        cols = [c.alias(f"v{i}") for i, c in enumerate(cols)]
        return valid.select(*cols).withColumn("bucket", F.pmod(F.xxhash64(*[F.col(f"v{i}") for i in range(len(keys))]), F.lit(buckets)))

    most = max(left.select(*keys).count(), right.select(*keys).count())
    buckets = max(1, math.ceil(most / rows_per_bucket))
    types = [left.schema[k].dataType.simpleString() if kinds[k][0] == kinds[k][1] else "string" for k in keys]
    schema = ", ".join([*[f"`{k}` {t}" for k, t in zip(keys, types)], "diff string", f"`{a}_value` string", f"`{b}_value` string"])
    n = len(keys)

    def differences(x: pa.Table, y: pa.Table) -> pa.Table:
        cx, cy = _codes(x, y, n)
        order = np.argsort(cy, kind="stable")
        at = np.searchsorted(cy[order], cx)
        inside = np.minimum(at, max(len(cy) - 1, 0))
        hit = (cy[order][inside] == cx) if len(cy) else np.zeros(len(cx), bool)
        missing_y, missing_x = np.flatnonzero(~hit), np.flatnonzero(~np.isin(cy, cx))
        px, py = np.flatnonzero(hit), (order[inside][hit] if len(cy) else np.zeros(0, np.int64))
        parts = []

        def emit(t: pa.Table, rows: np.ndarray, diff: str, va: pa.Array | None, vb: pa.Array | None) -> None:
            if len(rows):
                none = pa.nulls(len(rows), pa.string())
                parts.append([*[t.column(i).take(pa.array(rows)) for i in range(n)], pa.array([diff] * len(rows), pa.string()), none if va is None else va, none if vb is None else vb])

        emit(x, missing_y, f"{b}_missing", None, None)
        emit(y, missing_x, f"{a}_missing", None, None)
        for i, f in enumerate(fields, n):
            u, v = x.column(i).take(pa.array(px)), y.column(i).take(pa.array(py))
            mask = np.flatnonzero(_unlike(u, v))
            m = pa.array(mask)
            emit(x, px[mask], f, pc.cast(u.take(m), pa.string()), pc.cast(v.take(m), pa.string()))
        titles = [*keys, "diff", f"{a}_value", f"{b}_value"]
        key_types = [x.schema.field(i).type for i in range(n)]
        out = pa.schema([pa.field(c, t) for c, t in zip(titles, [*key_types, *[pa.string()] * 3])])
        made = [pa.Table.from_arrays([c if isinstance(c, pa.ChunkedArray) else pa.chunked_array([c]) for c in p], names=titles).cast(out) for p in parts]
        return pa.concat_tables(made) if made else out.empty_table()

    return side(left, 0).groupBy("bucket").cogroup(side(right, 1).groupBy("bucket")).applyInArrow(differences, schema)
