"""Parent-child links to full hierarchies: path, depth, root and descendants of every node, and the cycles.

A forest is many trees (tree columns) of nodes with a parent each. Leaves are peeled until only cycles are left; the
cycles are cut, and every remaining component hangs below a top: a root, a detached node (its parent is null or has no
row) or a node on a cycle. An Euler tour of arcs (down into a node, up out of it) is ranked by pointer jumping; a node's
entry and exit in the tour give its depth, its top, its ancestors (intervals around it) and its descendants (intervals in it).

Trees are hashed into buckets whose number follows the counted rows, and a bucket is ranked as one Arrow table with
numpy: as many jumps as the logarithm of the longest tour, over all trees of the bucket at once. A tree of more than
max_tree_rows rows is never brought into one task; `wide_nodes` ranks it by the same tours with joins (a jump is a self-join,
so a tree of n rows takes log2(2n) of them), where peeling, which takes a round for each level, is replaced by jumping along parents.

Defined results: a null parent makes a detached top; root_value marks a root; a node that names itself is a cycle of
one; a repeated node counts once (the caller passes valid rows; else the largest parent is kept); nodes with a null
key are left out, since nothing can name them; an empty input gives an empty output; further columns are not read.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stichos.common import small_side, written

ROOT, DETACHED, CYCLE = 0, 1, 2
#: Shares of one parent's children in a tree ranked by joins.
SHARES = 256
#: The most rows of a tree whose paths one task builds.
LIST_ROWS = 10_000
STATUS = np.array(["rooted", "detached", "cycle", "below_cycle"], dtype=object)


def jump(nxt: np.ndarray, *sums: np.ndarray) -> tuple[np.ndarray, ...]:
    """List ranking: for each element the last of its list and, for each weight, the sum from the element to the end.

    nxt of a last element is itself and its weights don't count.
    """
    sums = tuple(s.copy() for s in sums)
    ends = nxt == np.arange(len(nxt))
    for s in sums:
        s[ends] = 0
    while True:
        far = nxt[nxt]
        if np.array_equal(far, nxt):
            return (nxt, *sums)
        for s in sums:
            s += s[nxt]
        nxt = far


def on_cycles(parent: np.ndarray) -> np.ndarray:
    """Peels leaves (nodes that are nobody's parent) until none is left; what stays is on a cycle. parent: -1 for none."""
    n = len(parent)
    left = np.ones(n, bool)
    children = np.bincount(parent[parent >= 0], minlength=n)
    leaves = np.flatnonzero(children == 0)
    while len(leaves):
        left[leaves] = False
        up = parent[leaves]
        up = up[up >= 0]
        np.subtract.at(children, up, 1)
        up = np.unique(up)
        leaves = up[(children[up] == 0) & left[up]]
    return left


def tours(parent: np.ndarray) -> dict[str, np.ndarray]:
    """Euler tours of a forest (-1: a top). Per node: top, entry, exit (from 0 in its tour), depth, below (descendants)."""
    n = len(parent)
    down, up = np.arange(n), np.arange(n) + n
    order = np.lexsort((down, parent))
    by = parent[order]
    nxt = np.empty(2 * n, dtype=np.int64)
    nxt[down], nxt[up] = up, np.where(parent >= 0, parent + n, up)
    first = np.flatnonzero((by >= 0) & np.r_[True, by[1:] != by[:-1]]) if n else np.zeros(0, np.int64)
    nxt[by[first]] = order[first]
    pairs = np.flatnonzero((by[1:] == by[:-1]) & (by[1:] >= 0))
    nxt[order[pairs] + n] = order[pairs + 1]
    end, rank, level = jump(nxt, np.ones(2 * n, np.int64), np.r_[np.ones(n, np.int64), -np.ones(n, np.int64)])
    top = end[down] - n
    # The end of a tour is the way up out of the top, whose weight -1 isn't in the sums; before a node there were as many
    # ways down as its depth, so from it to the end (without it) there are depth more ways up.
    depth = 1 - level[down]
    length = rank[top]
    entry, leave = length - rank[down], length - rank[up]
    return {"top": top, "entry": entry, "exit": leave, "depth": depth, "below": (leave - entry - 1) // 2}


def _lists(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flat positions of the ranges [start, start + length), and the offsets of the lists."""
    offsets = np.r_[0, np.cumsum(lengths)]
    flat = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - starts, lengths)
    return values[flat], offsets


def paths(parent: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each node the nodes from its top to itself, flat, and the offsets."""
    offsets = np.r_[0, np.cumsum(depth + 1)]
    flat = np.empty(offsets[-1], dtype=np.int64)
    at, place = np.arange(len(parent)), offsets[1:] - 1
    while len(at):
        flat[place] = at
        more = parent[at] >= 0
        at, place = parent[at][more], place[more] - 1
    return flat, offsets


def _codes(table: pa.Table, names: list[str]) -> np.ndarray:
    total = np.zeros(table.num_rows, np.int64)
    for c in names:
        col = table.column(c).combine_chunks().dictionary_encode()
        codes = col.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        _, total = np.unique(total * (len(col.dictionary) + 1) + codes, return_inverse=True)
    return total


def _solve(table: pa.Table, trees: list[str], lists: bool, carry: list[str], out: pa.Schema) -> pa.Table:
    """One bucket of whole trees. Columns: trees.., node, parent, is_root."""
    n = table.num_rows
    if not n:
        return out.empty_table()
    tree = _codes(table, trees)
    both = pa.chunked_array([*table.column("node").chunks, *table.column("parent").chunks]).combine_chunks().dictionary_encode()
    codes = both.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    width = len(both.dictionary) + 1
    key, up = tree * width + codes[:n] + 1, tree * width + codes[n:] + 1
    order = np.argsort(key, kind="stable")
    at = np.minimum(np.searchsorted(key[order], up), n - 1)
    is_root = table.column("is_root").to_numpy(zero_copy_only=False).astype(bool)
    known = (key[order][at] == up) & (codes[n:] >= 0) & ~is_root
    parent = np.where(known, order[at], -1)
    cyclic = on_cycles(parent)
    cut = np.where(cyclic, -1, parent)
    t = tours(cut)
    top, steps = t["top"], t["depth"]
    kind = np.where(is_root, ROOT, np.where(cyclic, CYCLE, DETACHED))[top]
    # Rank the ids, so that the smallest on a cycle can be found; a cycle is followed by jumping.
    nodes = table.column("node").combine_chunks()
    low = np.arange(n)
    on = np.flatnonzero(cyclic)
    if len(on):
        sort = np.asarray(pa.compute.sort_indices(nodes.take(pa.array(on))))
        rank = np.empty(len(on), np.int64)
        rank[sort] = np.arange(len(on))
        back = np.full(n, -1)
        back[on] = np.arange(len(on))
        step = back[parent[on]]
        least = rank.copy()
        for _ in range(max(1, math.ceil(math.log2(len(on) + 1)))):
            least = np.minimum(least, least[step])
            step = step[step]
        at_rank = np.empty(len(on), np.int64)
        at_rank[rank] = on
        low[on] = at_rank[least]
    named = np.where(kind == CYCLE, low[top], top)
    status = STATUS[np.where((kind == CYCLE) & (steps > 0), 3, kind)]
    cols = [table.column(c) for c in trees] + [nodes, pa.array(status.tolist(), pa.string()), nodes.take(pa.array(named)), pa.array(steps, pa.int32()), pa.array(t["entry"]), pa.array(t["exit"]), pa.array(t["below"])]
    if lists:
        flat, offsets = paths(cut, steps)
        at, ends = pa.array(flat), pa.array(offsets, pa.int32())
        cols.append(pa.ListArray.from_arrays(ends, nodes.take(at)))
        carried = [pa.ListArray.from_arrays(ends, table.column(c).combine_chunks().take(at)) for c in carry]
        preorder = np.lexsort((t["entry"], top))
        place = np.empty(n, np.int64)
        place[preorder] = np.arange(n)
        flat, offsets = _lists(preorder, place + 1, t["below"])
        cols += [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), nodes.take(pa.array(flat))), *carried]
    return pa.Table.from_arrays([c if isinstance(c, pa.ChunkedArray) else pa.chunked_array([c]) for c in cols], names=out.names).cast(out)


def hierarchy(
    df: DataFrame, tree_cols: list[str], node: str, parent: str, root_value=0,
    lists: bool = False, carry: tuple[str, ...] = (), rows_per_bucket: int = 50_000, max_tree_rows: int = 200_000,
) -> DataFrame:
    """tree_cols.., node, status, top, steps, entry, exit, n_below; with lists also path and descendants (in tour order), and
    for each column of carry an array path_<column> of its values along the path.

    status: rooted, detached, cycle or below_cycle. top: the root, the detached node or the smallest node of the cycle.
    steps: parents followed to the top, or to the first node on the cycle. entry and exit count from the top, or from that node.
    With lists, descendants and paths are as large as the sum of the depths; without them the intervals say the same. A chain of n rows
    has n * n / 2 of them, so with lists trees over LIST_ROWS rows are ranked by joins already.
    """
    max_tree_rows = min(max_tree_rows, LIST_ROWS) if lists else max_tree_rows
    trees = [f"tree{i}" for i in range(len(tree_cols))]
    is_root = F.coalesce(F.col(parent) == F.lit(root_value), F.lit(False)) if root_value is not None else F.lit(False)
    rows = df.select(*[F.col(c).alias(t) for c, t in zip(tree_cols, trees)], F.col(node).alias("node"), F.col(parent).cast(df.schema[node].dataType).alias("parent"), is_root.alias("is_root"), *[F.col(c).alias(f"carry{i}") for i, c in enumerate(carry)])
    rows = rows.filter(" and ".join(f"{c} is not null" for c in (*trees, "node")))
    sizes = written(rows.groupBy(*trees).agg(F.count("*").alias("tree_rows")), "hierarchy-sizes")
    total, large = sizes.agg(F.coalesce(F.sum("tree_rows"), F.lit(0)), F.count(F.when(F.col("tree_rows") > max_tree_rows, 1))).first()
    narrow = rows
    if large:
        tall = small_side(sizes.filter(F.col("tree_rows") > max_tree_rows).select(*trees), large)
        narrow = rows.join(tall, trees, "left_anti")
    buckets = max(1, math.ceil(total / rows_per_bucket))
    kind, kinds = df.schema[node].dataType.simpleString(), [df.schema[c].dataType.simpleString() for c in tree_cols]
    schema = ", ".join([*[f"{t} {k}" for t, k in zip(trees, kinds)], f"node {kind}", "status string", f"top {kind}", "steps int", "entry long", "exit long", "n_below long"])
    if lists:
        schema += f", path array<{kind}>, descendants array<{kind}>"
        schema += "".join(f", path_{c} array<{df.schema[c].dataType.simpleString()}>" for c in carry)
    elif carry:
        raise ValueError("carry needs lists")
    extra = [f"carry{i}" for i in range(len(carry))]

    def solve(table: pa.Table) -> pa.Table:
        value, ids = table.schema.field("node").type, [pa.field(t, table.schema.field(t).type) for t in trees]
        out = pa.schema([*ids, ("node", value), ("status", pa.string()), ("top", value), ("steps", pa.int32()), ("entry", pa.int64()), ("exit", pa.int64()), ("n_below", pa.int64()), *([("path", pa.list_(value)), ("descendants", pa.list_(value)), *[(f"path_{c}", pa.list_(table.schema.field(e).type)) for c, e in zip(carry, extra)]] if lists else [])])
        first = table.group_by([*trees, "node"]).aggregate([("parent", "max"), ("is_root", "max"), *[(e, "max") for e in extra]])
        if first.num_rows < table.num_rows:  # repeated nodes
            table = pa.Table.from_arrays([*[first.column(t) for t in trees], first.column("node"), first.column("parent_max"), first.column("is_root_max"), *[first.column(f"{e}_max") for e in extra]], names=[*trees, "node", "parent", "is_root", *extra])
        return _solve(table, trees, lists, extra, out)

    bucket = F.pmod(F.xxhash64(*trees), F.lit(buckets))
    out = narrow.withColumn("bucket", bucket).groupBy("bucket").applyInArrow(lambda t: solve(t.drop_columns(["bucket"])), schema)
    if large:
        wide = written(rows.join(tall, trees, "left_semi"), "hierarchy-wide")
        tall_out = wide_nodes(wide, trees, lists)
        if carry:
            values = wide.groupBy(*trees, "node").agg(*[F.max(e).alias(e) for e in extra]).withColumnRenamed("node", "up")
            way = tall_out.select(*trees, "node", F.posexplode("path").alias("at", "up")).join(values, [*trees, "up"])
            way = way.groupBy(*trees, "node").agg(F.array_sort(F.collect_list(F.struct("at", *extra))).alias("way"))
            tall_out = tall_out.join(way.select(*trees, "node", *[F.col(f"way.{e}").alias(f"path_{c}") for c, e in zip(carry, extra)]), [*trees, "node"])
        out = out.unionByName(tall_out)
    return out.select(*[F.col(t).alias(c) for t, c in zip(trees, tree_cols)], F.col("node").alias(node), *[c for c in out.columns if c not in (*trees, "node")])


def wide_nodes(rows: DataFrame, trees: list[str], lists: bool) -> DataFrame:
    """The same result for trees too large for a task, by joins alone. rows: trees.., node, parent, is_root."""
    kind = rows.schema["node"].dataType.simpleString()
    key = [*trees, "node"]
    rows = rows.groupBy(*key).agg(F.max("parent").alias("parent"), F.max("is_root").alias("is_root"))
    there = rows.select(*[F.col(t).alias(f"p_{t}") for t in trees], F.col("node").alias("p_node"))
    cond = [F.col(t) == F.col(f"p_{t}") for t in trees] + [F.col("parent") == F.col("p_node"), ~F.col("is_root")]
    base = written(rows.join(there, cond, "left").select(*key, F.col("p_node").alias("parent"), "is_root"), "hierarchy-links")
    n = base.count()

    def jumped(live: DataFrame, to: DataFrame, cols: list, label: str) -> DataFrame:
        """One jump: cols make the new row from a (the node) and b (where it points)."""
        a, b = live.alias("a"), to.alias("b")
        on = [F.col(f"a.{t}") == F.col(f"b.{t}") for t in trees] + [F.col("a.to") == F.col("b.node")]
        return written(a.join(b, on).select(*[F.col(f"a.{k}").alias(k) for k in key], *cols), label)

    def follow(rows: DataFrame, cols: list, label: str) -> DataFrame:
        """Pointer jumping on (trees.., node, to, more..) until every row's `to` is null. Only rows that still point somewhere jump;
        those that don't are kept aside and joined as targets alone, so no join has a null key or a last node that all rows point at."""
        live, done = rows.filter("to is not null"), [rows.filter("to is null")]
        while live.limit(1).count():
            nxt = jumped(live, reduce(DataFrame.unionByName, [live, *done]), cols, label)
            live, done = nxt.filter("to is not null"), [*done, nxt.filter("to is null")]
        return reduce(DataFrame.unionByName, done)

    # 1. Cycles: after 2^k >= n steps along parents every node that still has somewhere to go stands below or on a cycle; where it points is on one.
    # A node whose way ends leaves by the inner join.
    far = base.filter("parent is not null").select(*key, F.col("parent").alias("to"))
    for _ in range(max(1, math.ceil(math.log2(n + 1)))):
        far = jumped(far, far, [F.col("b.to").alias("to")], "hierarchy-far")
        if not far.limit(1).count():
            break
    on = written(far.select(*trees, F.col("to").alias("node")).distinct(), "hierarchy-cycles")
    cyc = on.count()
    tops = base.select(*key, "parent", "is_root", F.lit(False).alias("cyclic"))
    low = None
    if cyc:
        tops = base.join(on.withColumn("c", F.lit(True)), key, "left").select(*key, F.when(F.col("c").isNull(), F.col("parent")).alias("parent"), "is_root", F.col("c").isNotNull().alias("cyclic"))
        ring = base.join(on, key, "left_semi").select(*key, F.col("parent").alias("to"), F.least("node", "parent").alias("low"))
        for _ in range(max(1, math.ceil(math.log2(cyc + 1)))):
            ring = jumped(ring, ring, [F.col("b.to").alias("to"), F.least("a.low", "b.low").alias("low")], "hierarchy-ring")
        low = ring.select(*key, "low")
    tops = written(tops, "hierarchy-tops")

    # 2. Euler tours: arc 0 goes down into a node, arc 1 up out of it; `to` names the next arc.
    # Siblings are linked within salted shares of a parent's children, and the shares with each other, so a parent of any number will do.
    share = [*trees, "parent", "salt"]
    kids = tops.filter("parent is not null").withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SHARES)))
    heads = kids.groupBy(*share).agg(F.min("node").alias("head"))
    first = heads.groupBy(*trees, F.col("parent").alias("node")).agg(F.min_by("head", "salt").alias("first_kid"))
    heads = heads.withColumn("next_head", F.lead("head").over(Window.partitionBy(*trees, "parent").orderBy("salt")))
    kids = kids.withColumn("next_kid", F.lead("node").over(Window.partitionBy(*share).orderBy("node"))).join(heads.select(*share, "next_head"), share)
    kids = kids.withColumn("next_kid", F.coalesce("next_kid", "next_head"))
    arc = f"struct<node:{kind},up:int>"

    def name(node: str, up: int):
        return F.struct(F.col(node).alias("node"), F.lit(up).alias("up")).cast(arc)

    down = tops.join(first, key, "left").select(*trees, name("node", 0).alias("node"), F.when(F.col("first_kid").isNotNull(), name("first_kid", 0)).otherwise(name("node", 1)).alias("to"), F.lit(1).alias("level"))
    sibs = tops.join(kids.select(*key, "next_kid"), key, "left")
    up = sibs.select(*trees, name("node", 1).alias("node"), F.when(F.col("next_kid").isNotNull(), name("next_kid", 0)).when(F.col("parent").isNotNull(), name("parent", 1)).alias("to"), F.lit(-1).alias("level"))
    # The last arc of a tour points nowhere and its weights don't count; `last` is the farthest arc reached. Jumps of one length reach different arcs.
    ends = F.col("to").isNull()
    arcs = down.unionByName(up).select(*key, "to", F.coalesce("to", "node").alias("last"), F.when(ends, 0).otherwise(1).cast("long").alias("rank"), F.when(ends, 0).otherwise(F.col("level")).cast("long").alias("level"))
    ranked = follow(
        written(arcs, "hierarchy-arcs"),
        [F.col("b.to").alias("to"), F.col("b.last").alias("last"), (F.col("a.rank") + F.col("b.rank")).alias("rank"), (F.col("a.level") + F.col("b.level")).alias("level")], "hierarchy-ranks",
    )
    d = ranked.filter("node.up = 0").select(*trees, F.col("node.node").alias("node"), F.col("last.node").alias("top"), F.col("rank").alias("r_down"), (1 - F.col("level")).cast("int").alias("steps"))
    u = ranked.filter("node.up = 1").select(*trees, F.col("node.node").alias("node"), F.col("rank").alias("r_up"))
    length = d.filter("node = top").select(*trees, F.col("node").alias("top"), F.col("r_down").alias("length"))
    out = d.join(u, key).join(length, [*trees, "top"])
    what = tops.select(*trees, F.col("node").alias("top"), "is_root", "cyclic")
    out = out.join(what, [*trees, "top"])
    if low is not None:
        out = out.join(low.withColumnRenamed("node", "top"), [*trees, "top"], "left")
    else:
        out = out.withColumn("low", F.lit(None).cast(kind))
    status = F.when(F.col("is_root"), "rooted").when(~F.col("cyclic"), "detached").when(F.col("steps") == 0, "cycle").otherwise("below_cycle")
    out = out.select(*key, status.alias("status"), F.coalesce("low", "top").alias("top"), "steps", (F.col("length") - F.col("r_down")).alias("entry"), (F.col("length") - F.col("r_up")).alias("exit"), F.floor((F.col("r_down") - F.col("r_up") - 1) / 2).cast("long").alias("n_below"))
    if not lists:
        return out

    # 3. Paths by doubling along parents; their sum is as large as the result itself. Descendants are the paths, turned round.
    walk = tops.select(*key, F.col("parent").alias("to"), F.array(F.col("node")).alias("path"))
    walk = follow(walk, [F.col("b.to").alias("to"), F.concat("b.path", "a.path").alias("path")], "hierarchy-paths")
    walk = walk.select(*key, "path")
    above = walk.select(*key, F.explode(F.slice("path", 1, F.size("path") - 1)).alias("above")).join(out.select(*key, "entry"), key)
    below = above.groupBy(*trees, F.col("above").alias("node")).agg(F.transform(F.array_sort(F.collect_list(F.struct("entry", "node"))), lambda x: x["node"]).alias("descendants"))
    return out.join(walk, key).join(below, key, "left").withColumn("descendants", F.coalesce("descendants", F.array().cast(f"array<{kind}>")))
