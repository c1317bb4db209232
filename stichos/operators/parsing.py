"""Rows that fail to parse, told apart from the valid ones with every reason.

A line is cut into cells by a fold over its tab-separated pieces (quoted cells may hold tabs, doubled quotes stand for
one), the cells are exploded into (row, column, value), and a rule table is joined on the column. A rule is data: a
pattern that the value, or the first tagged element in it, must match whole. Failing cells are aggregated to reasons,
and the clean rows are the anti-join. All of it runs in the JVM; only failing cells are shuffled.

Defined results: a null or blank line (only spaces and tabs, after one carriage return at its end is dropped) and a line
that starts with `#` are neither valid nor rejected; an empty cell is an empty string; a line of any length is parsed
whole; repeated lines are judged each by its own id. Further columns are passed through by clean rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """The value in column must match pattern (a whole match is the pattern's business). With prefix, the first of its
    `|`-separated elements that starts so is matched instead. plain_only: asked only of rows whose first cell is digits."""

    column: int
    reason: str
    pattern: str
    prefix: str | None = None
    plain_only: bool = False


#: Column 0 holds the reason why a line has no cells.
STRUCTURE = (Rule(0, "quoting", r"\A(?!quoting\z)"), Rule(0, "column_count", r"\A(?!column_count\z)"))
PLAIN = r"\A[0-9]+\z"
#: The rules of the ten-column treebank format.
CONLLU_RULES = (
    *STRUCTURE,
    Rule(1, "id", r"\A[0-9]+([-.][0-9]+)?\z"),
    Rule(7, "head", r"\A([0-9]+|_)\z", plain_only=True),
    Rule(10, "ref", r"\ARef=[A-Z0-9]+_[0-9]+\.[0-9]+\z", prefix="Ref=", plain_only=True),
)
CONLLU_COLUMNS = ("id", "form", "lemma", "upos", "xpos", "feats", "head", "deprel", "deps", "misc")


def rule_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    rows = [(r.column, r.reason, r.pattern, r.prefix, r.plain_only) for r in rules]
    return spark.createDataFrame(rows, "col int, reason string, pattern string, prefix string, plain_only boolean")


def cut_cells(line: Column) -> Column:
    """struct<open, cells, bad>: open is not null if a quoted cell never closes, bad if text follows its closing quote."""
    pieces = F.split(line, "\t", -1)
    state = "struct<open:string,cells:array<string>,bad:boolean>"

    def to(open_: Column, cells: Column, bad: Column) -> Column:
        return F.struct(open_.cast("string").alias("open"), cells.alias("cells"), bad.alias("bad"))

    def step(s: Column, piece: Column) -> Column:
        text = F.when(s["open"].isNull(), piece).otherwise(F.concat(s["open"], F.lit("\t"), piece))
        quoted = s["open"].isNotNull() | piece.startswith('"')
        rest = F.replace(F.substring(text, 2, 2147483647), F.lit('""'), F.lit(""))  # pairs go; the first quote left closes
        at = F.instr(rest, '"')
        value = F.replace(F.substring(text, F.lit(2), F.length(text) - 2), F.lit('""'), F.lit('"'))
        return (
            F.when(s["bad"], s)
            .when(~quoted, to(F.lit(None), F.concat(s["cells"], F.array(piece)), F.lit(False)))
            .when(at == 0, to(text, s["cells"], F.lit(False)))
            .when(at == F.length(rest), to(F.lit(None), F.concat(s["cells"], F.array(value)), F.lit(False)))
            .otherwise(to(F.lit(None), s["cells"], F.lit(True)))
        )

    start = to(F.lit(None), F.array().cast("array<string>"), F.lit(False))
    plain = to(F.lit(None), pieces, F.lit(False)).cast(state)
    return F.when(line.contains('"'), F.aggregate(pieces, start.cast(state), lambda s, x: step(s, x).cast(state))).otherwise(plain)


def data_lines(df: DataFrame, line: str) -> DataFrame:
    """Adds __cut to the lines that are neither blank nor comments."""
    text = F.regexp_replace(F.col(line), r"\r\z", "")
    kept = df.withColumn("__text", text).filter(~F.col("__text").rlike(r"\A[ \t]*\z") & ~F.col("__text").startswith("#"))
    return kept.withColumn("__cut", cut_cells(F.col("__text"))).drop("__text")


def _why(n_columns: int) -> Column:
    return F.when(F.col("__cut.bad") | F.col("__cut.open").isNotNull(), "quoting").when(F.size("__cut.cells") != n_columns, "column_count")


def reject_reasons(df: DataFrame, id_col: str, line: str, rules: Sequence[Rule] = CONLLU_RULES, n_columns: int = len(CONLLU_COLUMNS), carry: Sequence[str] = ()) -> DataFrame:
    """Distinct (id_col, reason) of the lines that break a rule, and the columns of carry."""
    asked = sorted({r.column for r in rules if r.column})
    cells = F.when(_why(n_columns).isNotNull(), F.array(F.struct(F.lit(0).alias("col"), _why(n_columns).alias("value")))).otherwise(
        F.array(*[F.struct(F.lit(c).alias("col"), F.get("__cut.cells", F.lit(c - 1)).alias("value")) for c in asked])
    )
    own = [f"__carry{i}" for i in range(len(carry))]
    lines = df.select(F.col(id_col).alias("__id"), F.col(line).alias("__line"), *[F.col(c).alias(o) for c, o in zip(carry, own)])
    exploded = data_lines(lines, "__line").select(
        "__id", *own, F.coalesce(F.get("__cut.cells", F.lit(0)).rlike(PLAIN), F.lit(False)).alias("plain"), F.explode(cells).alias("c")
    )
    table = F.broadcast(rule_table(df.sparkSession, rules))  # one row a rule, whatever the data
    judged = exploded.select("__id", *own, "plain", "c.col", "c.value").join(table, "col")
    told = F.when(F.col("prefix").isNull(), F.col("value")).otherwise(F.get(F.filter(F.split("value", r"\|"), lambda x: x.startswith(F.col("prefix"))), F.lit(0)))
    ok = F.coalesce(F.rlike(told, F.col("pattern")), F.lit(False))
    return judged.filter((F.col("plain") | ~F.col("plain_only")) & ~ok).select(F.col("__id").alias(id_col), "reason", *[F.col(o).alias(c) for c, o in zip(carry, own)]).distinct()


def rejected_rows(df: DataFrame, id_col: str, line: str, rules: Sequence[Rule] = CONLLU_RULES, n_columns: int = len(CONLLU_COLUMNS)) -> DataFrame:
    """id_col, reasons (sorted array): one row for each rejected line."""
    return reject_reasons(df, id_col, line, rules, n_columns).groupBy(id_col).agg(F.array_sort(F.collect_set("reason")).alias("reasons"))


def clean_rows(df: DataFrame, id_col: str, line: str, rules: Sequence[Rule] = CONLLU_RULES, columns: Sequence[str] = CONLLU_COLUMNS) -> DataFrame:
    """The valid lines with their cells as columns (prefixed by cell_ where the input has the name already)."""
    bad = reject_reasons(df, id_col, line, rules, len(columns)).select(F.col(id_col).alias("__bad")).distinct()
    kept = data_lines(df, line).filter(_why(len(columns)).isNull())
    kept = kept.join(bad, F.col(id_col) == F.col("__bad"), "left_anti")
    names = [f"cell_{c}" if c in df.columns else c for c in columns]
    return kept.select(*df.columns, *[F.get("__cut.cells", F.lit(i)).alias(n) for i, n in enumerate(names)])
