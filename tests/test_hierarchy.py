import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stichos.operators import hierarchy as H
from stichos.plans import checks

SCHEMA = "sent_id string, local_id int, head int, top string"


def brute(rows):
    """By walking up from each node."""
    parent = {(s, i): h for s, i, h in rows}
    out = {}
    for (s, i), h in parent.items():
        seen, at = [i], i
        while True:
            up = parent[(s, at)]
            if up == 0:
                out[(s, i)] = ("rooted", at, len(seen) - 1)
                break
            if up is None or (s, up) not in parent:
                out[(s, i)] = ("detached", at, len(seen) - 1)
                break
            if up in seen:
                ring = seen[seen.index(up):]
                steps = seen.index(up)
                out[(s, i)] = ("cycle" if steps == 0 else "below_cycle", min(ring), steps)
                break
            seen.append(up)
            at = up
    return out


def random_rows(seed, trees=12):
    r, rows = random.Random(seed), []
    for t in range(trees):
        n = r.choice([1, 2, 5, 30, 60])
        for i in range(1, n + 1):
            rows.append((f"s{t}", i, r.choice([0, None, r.randint(1, n), r.randint(1, n), r.randint(1, n), r.randint(1, n + 2), max(i - 1, 0), max(i - 1, 0)])))
    return rows


@pytest.mark.parametrize("limit", [200_000, 10])
def test_against_walking(spark, limit):
    rows = random_rows(3)
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    got = H.hierarchy(df, ["sent_id"], "local_id", "head", lists=True, carry=("head", "top"), rows_per_bucket=40, max_tree_rows=limit).collect()
    assert all(g.path_head == [{(s, i): h for s, i, h in rows}[(g.sent_id, p)] for p in g.path] and g.path_top == ["x"] * len(g.path) for g in got)
    want = brute(rows)
    assert {(g.sent_id, g.local_id): (g.status, g.top, g.steps) for g in got} == want
    by = {(g.sent_id, g.local_id): g for g in got}
    parent = {(s, i): h for s, i, h in rows}
    below = {k: set() for k in by}
    for g in got:
        assert g.path[-1] == g.local_id and len(g.path) == g.steps + 1
        assert all(parent[(g.sent_id, b)] == a for a, b in zip(g.path, g.path[1:]))
        assert g.exit - g.entry == 2 * g.n_below + 1
        for a in g.path[:-1]:
            below[(g.sent_id, a)].add(g.local_id)
            assert by[(g.sent_id, a)].entry < g.entry and g.exit < by[(g.sent_id, a)].exit
    assert all(set(g.descendants) == below[(g.sent_id, g.local_id)] and len(g.descendants) == g.n_below for g in got)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-1, 11), min_size=1, max_size=12))
def test_tours(parents):
    n = len(parents)
    parent = np.array([p if p < n else -1 for p in parents])
    cyclic = H.on_cycles(parent)
    for i in range(n):
        at, steps = parent[i], 0
        while at >= 0 and at != i and steps <= n:
            at, steps = parent[at], steps + 1
        assert cyclic[i] == (at == i)
    t = H.tours(np.where(cyclic, -1, parent))
    for i in range(n):
        depth, at = 0, i
        while not cyclic[at] and parent[at] >= 0:
            depth, at = depth + 1, parent[at]
        assert (t["depth"][i], t["top"][i]) == (depth, at)


def test_nulls_repeats_and_empty(spark):
    rows = [("a", 1, 0, None), ("a", 1, 0, None), ("a", 2, 1, "y"), (None, 1, 0, "x"), ("a", None, 1, "x"), ("b", 1, 1, "x")]
    got = H.hierarchy(spark.createDataFrame(rows, SCHEMA), ["sent_id"], "local_id", "head").collect()
    assert sorted((g.sent_id, g.local_id, g.status) for g in got) == [("a", 1, "rooted"), ("a", 2, "rooted"), ("b", 1, "cycle")]
    assert H.hierarchy(spark.createDataFrame([], SCHEMA), ["sent_id"], "local_id", "head", lists=True).count() == 0


def test_text_keys_and_a_deep_chain(spark):
    n = 3000
    df = spark.createDataFrame([("t", f"n{i:05d}", f"n{i - 1:05d}" if i else None) for i in range(n)], "t string, n string, p string")
    got = {r.n: r for r in H.hierarchy(df, ["t"], "n", "p", root_value=None).collect()}
    assert got["n02999"].steps == n - 1 and got["n02999"].top == "n00000" and got["n00000"].n_below == n - 1


def test_a_wide_parent_by_joins(spark):
    rows = [("t", 1, 0, None)] + [("t", i, 1, "x") for i in range(2, 900)] + [("t", 900, 5, "x"), ("t", 901, 902, "x"), ("t", 902, 901, "x"), ("t", 903, 901, "x"), ("t", 904, 999, "x")]
    got = {r.local_id: r for r in H.hierarchy(spark.createDataFrame(rows, SCHEMA), ["sent_id"], "local_id", "head", max_tree_rows=100).collect()}
    assert {k: (r.status, r.top, r.steps) for k, r in got.items()} == {i: v for (_, i), v in brute([r[:3] for r in rows]).items()}
    assert got[1].n_below == 899 and got[5].n_below == 1 and got[900].steps == 2


def test_every_word_has_a_path(spark, tmp_path):
    rows = [("r", 1, 0), ("r", 2, 1), ("d", 1, None), ("d", 2, 1), ("d", 3, 9), ("c", 1, 2), ("c", 2, 1), ("c", 3, 2), ("c", 4, 3)]
    spark.createDataFrame([(*r, None) for r in rows], "sent_id string, local_id int, head int, loaded_at timestamp").write.parquet(f"{tmp_path}/word.parquet")
    got = {(r.sent_id, r.local_id): (r.status, r.top_local, r.path, r.descendants) for r in checks.QUERIES["p2_paths"](spark, str(tmp_path)).collect()}
    assert got == {
        ("r", 1): ("rooted", 1, "1", "2"), ("r", 2): ("rooted", 1, "1/2", ""), ("d", 1): ("detached", 1, "1", "2"), ("d", 2): ("detached", 1, "1/2", ""), ("d", 3): ("detached", 3, "3", ""),
        ("c", 1): ("cycle", 1, "1", ""), ("c", 2): ("cycle", 1, "2", "3,4"), ("c", 3): ("below_cycle", 1, "2/3", "4"), ("c", 4): ("below_cycle", 1, "2/3/4", ""),
    }
    assert {(r.sent_id, r.local_id) for r in checks.p2_hierarchy(spark, str(tmp_path)).collect()} == {("r", 1), ("r", 2)}
