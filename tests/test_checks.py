"""Orphans, parsing and comparison of copies against brute force on small fixtures, with nulls, ties, repeats and extra columns."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stichos import common
from stichos.common import latest_rows
from stichos.operators import compare, orphans, parsing

DAY = dt.datetime(2024, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


def graph(spark, parents, children):
    p = spark.createDataFrame(parents, "id string, loaded_at timestamp, deleted_at timestamp, kind string")
    c = spark.createDataFrame(children, "id string, ref string, head string, loaded_at timestamp, kind string")
    tables = [orphans.Table("p", p, ["id"], deleted="deleted_at"), orphans.Table("c", c, ["id"], ["ref", "head"])]
    refs = [orphans.Reference("c", "ref", "p", lambda: [F.col("c_ref")]), orphans.Reference("c", "head", "c", lambda: [F.col("c_head")])]
    return tables, refs


def test_orphan_kinds(spark):
    parents = [("a", day(0), None, "x"), ("b", day(0), None, "x"), ("b", day(5), day(4), "x"), ("c", day(9), None, "x"), ("d", day(1), day(1), "x"), ("d", day(2), None, None), (None, day(0), None, "x")]
    children = [
        ("1", "a", None, day(3), "k"), ("1", "a", None, day(3), "k"), ("2", "b", "1", day(3), "k"), ("3", "c", "9", day(3), None), ("4", "zz", None, day(3), "k"), ("5", None, None, day(40), "k"),
        ("6", "d", None, day(3), "k"), (None, "zz", None, day(3), "k"), ("7", "zz", None, day(1), "k"), ("7", "a", None, day(2), "k"),
    ]
    got = {tuple(r) for r in orphans.orphans(*graph(spark, parents, children)).collect()}
    assert got == {("c", "2", "ref", "2024-01", "deleted"), ("c", "3", "ref", "2024-01", "late"), ("c", "3", "head", "2024-01", "missing"), ("c", "4", "ref", "2024-01", "missing")}


def test_cascade_against_walking(spark):
    r = random.Random(5)
    n = 80
    children = [(str(i), r.choice(["a"] * 9 + ["gone"]), None if r.random() < 0.2 else str(r.randint(0, n + 3)), day(1), "k") for i in range(n)]
    tables, refs = graph(spark, [("a", day(0), None, "x")], children)
    got = {x.row_key: (x.status, x.steps) for x in orphans.cascade(tables, refs).rows.filter("src = 'c'").collect()}
    ids = {c[0] for c in children}
    level = {c[0]: 0 for c in children if c[1] == "gone" or (c[2] is not None and c[2] not in ids)}
    step = 0
    while True:
        new = {c[0] for c in children if c[0] not in level and c[2] in level and level[c[2]] == step}
        if not new:
            break
        step += 1
        level |= {i: step for i in new}
    assert got == {i: ("direct" if s == 0 else "inherited", s) for i, s in level.items()}


def walked(tables, edges, direct):
    """Steps from the nearest direct orphan, level by level. edges: child -> parents."""
    level = {r: 0 for r in direct}
    step = 0
    while True:
        new = {c for c, ps in edges.items() if c not in level and any(level.get(p) == step for p in ps)}
        if not new:
            return level
        step += 1
        level |= {c: step for c in new}


@pytest.mark.parametrize("seed", [3])
def test_cascade_down_a_ring_of_tables(spark, seed):
    """A names A and B, B names A twice; chains of A are long and end in a missing row."""
    r = random.Random(seed)
    n, m = 40, 12
    a = [(f"a{i}", None if r.random() < 0.05 else f"a{i - r.choice([1, 1, 1, 2])}" if i > 2 else "gone" if r.random() < 0.5 else None, f"b{r.randrange(m)}" if r.random() < 0.1 else None, day(1)) for i in range(n)]
    b = [(f"b{i}", f"a{r.randrange(n)}" if r.random() < 0.6 else None, f"a{r.randrange(n)}" if r.random() < 0.3 else None, day(1)) for i in range(m)]
    ta = spark.createDataFrame(a, "id string, me string, x string, loaded_at timestamp")
    tb = spark.createDataFrame(b, "id string, y string, z string, loaded_at timestamp")
    tables = [orphans.Table("A", ta, ["id"], ["me", "x"]), orphans.Table("B", tb, ["id"], ["y", "z"])]
    column = lambda c: lambda: [F.col(f"c_{c}")]
    refs = [orphans.Reference("A", "me", "A", column("me")), orphans.Reference("A", "x", "B", column("x")), orphans.Reference("B", "y", "A", column("y")), orphans.Reference("B", "z", "A", column("z"))]
    edges = {k: [p for p in ps if p] for k, *ps, _ in a + b}
    want = walked(tables, edges, {k for k, ps in edges.items() if any(p not in edges for p in ps)})
    assert {x.row_key: x.steps for x in orphans.cascade(tables, refs).rows.collect()} == want and want


def test_a_row_through_another_table_is_nearer(spark):
    """The way up A's own chain is 20 steps long, the way through B is shorter; steps must be the least of both, found in later passes."""
    a = [("a0", "gone", None, day(1))] + [(f"a{i}", f"a{i - 1}", "b" if i == 20 else None, day(1)) for i in range(1, 25)]
    b = [("b", "a2", "a3", day(1))]
    ta = spark.createDataFrame(a, "id string, me string, x string, loaded_at timestamp")
    tb = spark.createDataFrame(b, "id string, y string, z string, loaded_at timestamp")
    tables = [orphans.Table("A", ta, ["id"], ["me", "x"]), orphans.Table("B", tb, ["id"], ["y", "z"])]
    column = lambda c: lambda: [F.col(f"c_{c}")]
    refs = [orphans.Reference("A", "me", "A", column("me")), orphans.Reference("A", "x", "B", column("x")), orphans.Reference("B", "y", "A", column("y")), orphans.Reference("B", "z", "A", column("z"))]
    got = {x.row_key: x.steps for x in orphans.cascade(tables, refs).rows.collect()}
    assert got["a20"] == 4 and got["b"] == 3 and got["a24"] == 8 and got["a19"] == 19


def test_orphans_of_empty_tables(spark):
    tables, refs = graph(spark, [], [])
    assert orphans.orphans(tables, refs).count() == 0 and orphans.cascade(tables, refs).rows.count() == 0


def parse(line):
    """The statement of the format, cell by cell. Gives cells or the reason."""
    cells, at = [], 0
    while True:
        if line[at : at + 1] == '"':
            out, k = "", at + 1
            while True:
                j = line.find('"', k)
                if j < 0:
                    return "quoting"
                if line[j + 1 : j + 2] == '"':
                    out, k = out + line[k:j] + '"', j + 2
                    continue
                out, k = out + line[k:j], j + 1
                break
            if line[k : k + 1] not in ("", "\t"):
                return "quoting"
            cells.append(out)
            at = k
        else:
            j = line.find("\t", at)
            j = len(line) if j < 0 else j
            cells.append(line[at:j])
            at = j
        if at >= len(line):
            return cells
        at += 1


@pytest.mark.parametrize("seed", [1, 2])
def test_cells_against_reading(spark, seed):
    r = random.Random(seed)
    rows = [(i, "".join(r.choice('ab"\t"') for _ in range(r.randint(0, 12)))) for i in range(400)]
    rows.append((1000, "\t".join(['"' + "x" * 20000 + '""' * 3000 + '"'] * 3)))
    df = spark.createDataFrame(rows, "id long, line string")
    for x in df.withColumn("c", parsing.cut_cells(F.col("line"))).collect():
        want = parse(x.line)
        got = "quoting" if x.c.bad or x.c.open is not None else x.c.cells
        assert got == want, x.line


def test_reject_reasons(spark):
    good = ["1", "a", "b", "c", "d", "e", "0", "f", "g", "x|Ref=GEN_1.2"]
    line = lambda **k: "\t".join(k.get(f"c{i}", v) for i, v in enumerate(good, 1))
    rows = [
        (1, line()), (2, line() + "\r"), (3, ""), (4, "  "), (5, "# no"), (6, None), (7, line(c1="1-2", c7="x", c10="_")), (8, line(c1="1.1")), (9, line(c1=" 1")), (10, line(c7="x", c10="Ref=gen_1.2|Ref=GEN_1.2")),
        (11, "1\ta"), (12, line(c2='"a')), (13, line(c2='"a"b')), (14, line(c2='"a\tb""c"')), (15, line(c7="_", c10='"Ref=GEN_1.2"')), (16, line(c10="Ref=GEN_1.2\r\r")), (17, line(c7="")), (18, line(c1="１")),
    ]
    df = spark.createDataFrame([(*r, "z") for r in rows], "line_id long, raw string, form string")
    got = sorted((r.line_id, r.reason) for r in parsing.reject_reasons(df, "line_id", "raw").collect())
    assert got == [(9, "id"), (10, "head"), (10, "ref"), (11, "column_count"), (12, "quoting"), (13, "quoting"), (16, "ref"), (17, "head"), (18, "id")]
    clean = {r.line_id: r for r in parsing.clean_rows(df, "line_id", "raw").collect()}
    assert set(clean) == {1, 2, 7, 8, 14, 15} and clean[14].cell_form == 'a\tb"c' and clean[14].form == "z"
    assert parsing.reject_reasons(df.limit(0), "line_id", "raw").count() == 0
    assert {r.line_id: r.reasons for r in parsing.rejected_rows(df, "line_id", "raw").collect()}[10] == ["head", "ref"]


def test_copies_against_dicts(spark):
    r = random.Random(3)
    value = lambda: r.choice([None, "", "a", "b"])
    side = lambda: [(r.choice([None, *range(60)]), value(), r.choice([None, 1.0, float("nan")]), day(r.randint(0, 3)), "x") for _ in range(120)]
    schema = "k long, a string, b double, loaded_at timestamp, bucket string"
    one, two = side(), side()
    x, y = spark.createDataFrame(one, schema), spark.createDataFrame(two, schema)
    valid = [{(q.k): (q.a, q.b) for q in latest_rows(z, ["k"]).collect()} for z in (x, y)]
    same = lambda u, v: u is None and v is None or (u is not None and v is not None and (u == v or (u != u and v != v)))
    want = {(k, "snapshot_missing") for k in valid[0].keys() - valid[1].keys()} | {(k, "current_missing") for k in valid[1].keys() - valid[0].keys()}
    want |= {(k, f) for k in valid[0].keys() & valid[1].keys() for f, u, v in zip("ab", valid[0][k], valid[1][k]) if not same(u, v)}
    got = compare.copy_differences(x, y, ["k"], ["a", "b"], rows_per_bucket=10).collect()
    assert {(g.k, g["diff"]) for g in got} == want and len(got) == len(want)
    assert compare.copy_differences(x, y.limit(0), ["k"], ["a"]).count() == len(valid[0])
    assert compare.copy_differences(x.limit(0), y.limit(0), ["k"], ["a"]).count() == 0


def test_copies_with_two_keys_and_other_types(spark):
    x = spark.createDataFrame([(1, "p", 5), (1, "q", 6)], "k int, l string, v int")
    y = spark.createDataFrame([(1, "p", "5"), (1, "q", "7"), (2, "p", "1")], "k long, l string, v string")
    got = {(r.k, r.l, r["diff"], r.current_value, r.snapshot_value) for r in compare.copy_differences(x, y, ["k", "l"], ["v"], order_col=None).collect()}
    assert got == {("1", "q", "v", "6", "7"), ("2", "p", "current_missing", None, None)}


def test_latest_row_ties(spark):
    rows = [(1, "a", day(1)), (1, "b", day(1)), (1, None, day(1)), (None, "n", None), (2, "x", None), (2, "y", day(0))]
    got = {(r.k, r.v) for r in latest_rows(spark.createDataFrame(rows, "k int, v string, loaded_at timestamp"), ["k"]).collect()}
    assert got == {(1, "b"), (None, "n"), (2, "y")}


def test_stages_go_to_the_folder_of_the_session(spark, tmp_path):
    where = spark.conf.get("spark.checkpoint.dir", None)
    base = common.stage_dir(spark)
    assert base == where.rstrip("/") if where else base.startswith("file:/") and base == common.stage_dir(spark)
    df = common.written(spark.range(3).toDF("n"), "test")
    path = df.inputFiles()[0].rpartition("/")[0].removeprefix("file://")
    assert path.startswith(base.removeprefix("file://")) and df.count() == 3
    assert common.drop_stages(spark) >= 1
    import os

    assert not os.path.exists(path)
