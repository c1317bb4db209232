"""Orphan references: rows that point at rows which are absent, deleted or later than themselves.

Tables and references form a foreign-key graph. Round 0 of the fixpoint finds the direct orphans of every reference.
Then the orphans cascade down the graph by semi-joins: the children of orphaned rows are inherited orphans, and so are
theirs, until no row is new and no row comes nearer to a direct orphan; each semi-join brings the steps to the nearest one along. A
table's references to itself make chains of any depth; each round squares the reference, so their number is the
logarithm of the depth, and carries only rows that are not settled and still have something above them: a chain that ended is in no
further join, and no join has a null key. The rows of a round are written to the shared folder. Joins are on whole keys; a key that many rows
point at is split by AQE's skew join, as the pointing rows are always the side that may be split.

Defined results: a null in any column of a reference is no reference; repeated deliveries of a key count once, as its
latest row; a key with a null column cannot be named by a row key and is neither pointing row nor target; empty
tables give empty reports. Further columns of the inputs are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stichos.common import latest_rows, month, written


@dataclass(frozen=True)
class Table:
    """A table with deliveries. columns: what references need besides the key. deleted: marks deleted rows, if any."""

    name: str
    rows: DataFrame
    key: Sequence[str]
    columns: Sequence[str] = ()
    loaded: str = "loaded_at"
    deleted: str | None = None

    def state(self) -> DataFrame:
        """A row for each key: k0.., c_<column> of the valid row, loaded (latest), arrived (earliest), gone (deleted).

        The valid row is ranked and the arrival aggregated over the same keys, both cut down before the shuffle, so the join of the two needs none.
        """
        gone = F.col(self.deleted).isNotNull() if self.deleted else F.lit(False)
        names = [f"k{i}" for i in range(len(self.key))]
        keys = [F.col(k).alias(n) for k, n in zip(self.key, names)]
        known = self.rows.filter(" and ".join(f"`{k}` is not null" for k in self.key))
        rows = known.select(*keys, *[F.col(c).alias(f"c_{c}") for c in self.columns], F.col(self.loaded).alias("loaded"), gone.alias("gone"))
        arrived = known.groupBy(*keys).agg(F.min(self.loaded).alias("arrived"))
        return latest_rows(rows, names, "loaded").join(arrived, names)

    def row_key(self) -> Column:
        return F.concat_ws("#", *[F.col(f"k{i}").cast("string") for i in range(len(self.key))])


@dataclass(frozen=True)
class Reference:
    """child.field points at parent: target makes, from the child's state (k0.., c_..), the parent's key columns.

    absent: a condition under which there is no reference, besides nulls. unknown: a condition under which the target
    cannot even be named, which is a missing target. within: key columns (k0..) of a table's reference to itself that are the same in
    the row and its target.
    """

    child: str
    field: str
    parent: str
    target: Callable[[], Sequence[Column]]
    absent: Callable[[], Column] = field(default=lambda: F.lit(False))
    unknown: Callable[[], Column] = field(default=lambda: F.lit(False))
    within: Sequence[str] = ()


def _pointing(states: dict[str, DataFrame], ref: Reference) -> DataFrame:
    child = states[ref.child]
    target, unknown = ref.target(), F.coalesce(ref.unknown(), F.lit(False))
    named = F.lit(True)
    for t in target:
        named = named & t.isNotNull()
    out = child.withColumns({f"t{i}": t for i, t in enumerate(target)} | {"unknown": unknown})
    return out.filter(~F.coalesce(ref.absent(), F.lit(False)) & (named | unknown))


def _on(a: DataFrame, b: DataFrame, n: int, left: str, right: str) -> Column:
    cond = a[f"{left}0"] == b[f"{right}0"]
    for i in range(1, n):
        cond = cond & (a[f"{left}{i}"] == b[f"{right}{i}"])
    return cond


def direct_orphans(tables: Sequence[Table], refs: Sequence[Reference], states: dict[str, DataFrame] | None = None) -> DataFrame:
    """Round 0: src, row_key, field, period (month of the pointing row), kind: missing, deleted or late, the first that fits; o0.. (the row's key)."""
    by = {t.name: t for t in tables}
    states = states or {t.name: t.state() for t in tables}
    found = None
    for ref in refs:
        child, parent = by[ref.child], by[ref.parent]
        n = len(parent.key)
        p = _pointing(states, ref)
        told = [
            F.lit(ref.child).alias("src"), child.row_key().alias("row_key"), F.lit(ref.field).alias("field"), month(F.col("loaded")).alias("period"), "kind",
            *[F.col(f"k{i}").alias(f"o{i}") if i < len(child.key) else F.lit(None).alias(f"o{i}") for i in range(max(len(t.key) for t in tables))],
        ]
        q = states[ref.parent].select(*[F.col(f"k{i}").alias(f"q{i}") for i in range(n)], F.col("arrived").alias("q_arrived"), F.col("gone").alias("q_gone"), F.lit(True).alias("q_there"))
        kind = F.when(F.col("q_there").isNull(), "missing").when(F.col("q_gone"), "deleted").when(F.col("q_arrived") > F.col("loaded"), "late")
        # Targets that cannot be named are null, so they stay out of the join.
        named = p.filter(~F.col("unknown"))
        rows = named.join(q, _on(named, q, n, "t", "q"), "left").withColumn("kind", kind).filter(F.col("kind").isNotNull()).select(*told)
        rows = rows.unionByName(p.filter("unknown").withColumn("kind", F.lit("missing")).select(*told))
        found = rows if found is None else found.unionByName(rows, allowMissingColumns=True)
    return found


def _table_order(names: Sequence[str], refs: Sequence[Reference]) -> tuple[list[str], bool]:
    """Parents before children, and whether that is possible (references of a table to itself don't count)."""
    needs = {n: {r.parent for r in refs if r.child == n and r.parent != n} for n in names}
    order: list[str] = []
    while free := [n for n in names if n not in order and needs[n] <= set(order)]:
        order += free
    return order + [n for n in names if n not in order], len(order) == len(names)


def _close_under_itself(state: DataFrame, base: DataFrame, ref: Reference, n_keys: int) -> DataFrame:
    """Orphans of a table (k.., steps) closed under its reference to itself.

    After r rounds all rows with an orphan less than 2^r references above are known. A round semi-joins the rows that are still open with
    the orphans 2^r references above, then squares the reference. A row whose steps are at most 2^(r + 1) can't come nearer, so it leaves, after
    it has lent its reference to those that point at it; so do rows with nothing that far above. Where the reference stays within the columns ref.within of the key, only their groups with an orphan take part.
    """
    keys, ups = [f"k{i}" for i in range(n_keys)], [f"t{i}" for i in range(n_keys)]
    p = _pointing({ref.child: state}, ref).filter(~F.col("unknown")).select(*keys, *ups)
    there = state.select(*[F.col(k).alias(t) for k, t in zip(keys, ups)])
    if ref.within:
        groups = base.select(*ref.within).distinct()
        p = p.join(groups, list(ref.within), "left_semi")
        there = there.join(groups.select(*[F.col(k).alias(k.replace("k", "t")) for k in ref.within]), [k.replace("k", "t") for k in ref.within], "left_semi")
    above = lambda df: df.select(*[F.col(k).alias(t) for k, t in zip(keys, ups)], F.col("steps").alias("u_steps"))
    links = p.join(there, ups, "left_semi").join(base.select(*keys, F.col("steps").alias("own")), keys, "left")
    least = lambda parts: reduce(DataFrame.unionByName, parts).groupBy(*keys).agg(F.min("steps").alias("steps"))
    parts, far, limit = [base.select(*keys, "steps")], 1, None
    while True:
        found = parts[0] if len(parts) == 1 else least(parts)
        # own: the steps known before; now: those of this round, if fewer.
        now = F.when(F.col("u_steps") + far < F.coalesce("own", F.lit(1 << 62)), F.col("u_steps") + far)
        links = links.join(above(found), ups, "left").select(*keys, *ups, "own", now.alias("now"))
        links = written(links.withColumn("open", F.coalesce(F.least("own", "now") > 2 * far, F.lit(True))), "orphans-links")
        n, n_new, n_open = links.agg(F.count("*"), F.count("now"), F.count_if("open")).first()
        if limit is None:  # no chain is longer
            limit = links.groupBy(*ref.within).count().agg(F.max("count")).first()[0] or 0 if ref.within else n
        if n_new:
            parts.append(links.filter("now is not null").select(*keys, F.col("now").alias("steps")))
        far *= 2
        # What still points somewhere after as many steps as a chain can have rows goes round a cycle.
        if far > limit or not n_open:
            return least(parts)
        open_ = links.filter("open").select(*keys, *ups, F.least("own", "now").alias("own"))
        nxt = links.select(*[F.col(k).alias(t) for k, t in zip(keys, ups)], *[F.col(t).alias(f"v{i}") for i, t in enumerate(ups)])
        links = open_.join(nxt, ups).select(*keys, *[F.col(f"v{i}").alias(t) for i, t in enumerate(ups)], "own")


@dataclass(frozen=True)
class Orphans:
    """direct: src, row_key, field, period, kind, a row for each orphaned reference. rows: src, row_key, period, status (direct or inherited),
    steps (references from the nearest direct orphan), one row for each orphaned row."""

    direct: DataFrame
    rows: DataFrame

    def by_table_and_period(self) -> DataFrame:
        """The report: rows of each table, period and status."""
        return self.rows.groupBy("src", "period", "status").agg(F.count("*").alias("n_rows"), F.max("steps").alias("max_steps"))


def cascade(tables: Sequence[Table], refs: Sequence[Reference]) -> Orphans:
    """The fixpoint. A row that is orphaned itself is direct, also if it hangs below another orphan.

    Tables are taken parents first, each is semi-joined with the orphans of its parents and closed under its reference to itself; if tables
    refer to each other in a ring, the passes repeat until no row is new and the sum of the steps stays.
    """
    by = {t.name: t for t in tables}
    states = {t.name: written(t.state(), f"orphans-{t.name}") for t in tables}
    order, acyclic = _table_order(list(by), refs)
    own = {name: [r for r in refs if r.child == name] for name in order}
    direct = {name: written(direct_orphans(tables, own[name], states), "orphans-direct") for name in order if own[name]}
    once = acyclic and all(sum(r.parent == name for r in own[name]) < 2 for name in order)
    orphaned: dict[str, DataFrame] = {}
    before = None
    while True:
        for name, found in direct.items():
            keys = [f"k{i}" for i in range(len(by[name].key))]
            selves = [r for r in own[name] if r.parent == name]
            base = found.select(*[F.col(f"o{i}").alias(k) for i, k in enumerate(keys)], F.lit(0).cast("long").alias("steps"))
            for ref in own[name]:
                if ref.parent in orphaned and (ref.parent != name or len(selves) > 1):
                    n = len(by[ref.parent].key)
                    f = orphaned[ref.parent].select(*[F.col(f"k{i}").alias(f"f{i}") for i in range(n)], (F.col("steps") + 1).alias("steps"))
                    p = _pointing(states, ref).filter(~F.col("unknown"))
                    base = base.unionByName(p.join(f, _on(p, f, n, "t", "f")).select(*keys, "steps"))
            base = base.groupBy(*keys).agg(F.min("steps").alias("steps"))
            if len(selves) == 1:
                base = _close_under_itself(states[name], written(base, "orphans-base"), selves[0], len(keys))
            read_again = not once or any(r.parent == name for o in own.values() for r in o)
            orphaned[name] = written(base, "orphans-closed") if read_again else base
        if once:
            break
        after = [tuple(x.agg(F.count("*"), F.coalesce(F.sum("steps"), F.lit(0))).first()) for x in orphaned.values()]
        if after == before:
            break
        before = after
    rows = references = None
    for name, closed in orphaned.items():
        keys = [f"k{i}" for i in range(len(by[name].key))]
        told = closed.join(states[name].select(*keys, "loaded"), keys)
        told = told.select(F.lit(name).alias("src"), by[name].row_key().alias("row_key"), month(F.col("loaded")).alias("period"), F.when(F.col("steps") == 0, "direct").otherwise("inherited").alias("status"), "steps")
        rows = told if rows is None else rows.unionByName(told)
        part = direct[name].select("src", "row_key", "field", "period", "kind")
        references = part if references is None else references.unionByName(part)
    return Orphans(references, rows)


def orphans(tables: Sequence[Table], refs: Sequence[Reference]) -> DataFrame:
    """The direct orphans of the cascade."""
    return cascade(tables, refs).direct
