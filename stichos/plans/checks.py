"""Queries of the data checks: orphan references (p1), hierarchies (p2), rows that fail to parse (p3), two copies (p5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stichos.common import latest_rows, read_table
from stichos.operators import compare, hierarchy, orphans, parsing


def corpus_references(spark: SparkSession, d: str) -> tuple[list[orphans.Table], list[orphans.Reference]]:
    """The foreign keys of the corpus: word.ref and break_candidate.ref name verses, word.head a word of the sentence."""
    book = read_table(spark, d, "book", "slug", "book_code").dropDuplicates(["slug"])
    slug = F.regexp_extract("chapter", r"\A(.*)-[0-9]+\z", 1)
    number = lambda c, p: F.regexp_extract(c, p, 1).cast("bigint").cast("string")
    cand = read_table(spark, d, "break_candidate", "cand_no", "chapter", "ref", "loaded_at").withColumn("slug", slug).join(F.broadcast(book), "slug", "left")  # one row a book
    chapter, verse = F.when(F.col("chapter").rlike(r"\A.*-[0-9]+\z"), number("chapter", r"-([0-9]+)\z")), F.when(F.col("ref").rlike(r"\A[0-9]+:[0-9]+\z"), number("ref", r":([0-9]+)\z"))
    cand = cand.withColumn("target", F.concat("book_code", F.lit("_"), chapter, F.lit("."), verse)).withColumn("points", F.col("chapter").isNotNull() & F.col("ref").isNotNull())
    tables = [
        orphans.Table("verse", read_table(spark, d, "verse", "ref", "loaded_at", "deleted_at"), ["ref"], deleted="deleted_at"),
        orphans.Table("word", read_table(spark, d, "word", "sent_id", "local_id", "ref", "head", "loaded_at"), ["sent_id", "local_id"], ["ref", "head"]),
        orphans.Table("break_candidate", cand, ["cand_no"], ["target", "points"]),
    ]
    refs = [
        orphans.Reference("word", "ref", "verse", lambda: [F.col("c_ref")]),
        orphans.Reference("word", "head", "word", lambda: [F.col("k0"), F.col("c_head")], absent=lambda: F.col("c_head") == 0, within=["k0"]),
        orphans.Reference("break_candidate", "ref", "verse", lambda: [F.col("c_target")], absent=lambda: ~F.col("c_points"), unknown=lambda: F.col("c_target").isNull()),
    ]
    return tables, refs


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Round 0 of the fixpoint, which runs to its end."""
    return orphans.cascade(*corpus_references(spark, d)).direct.distinct()


def p1_cascade(spark: SparkSession, d: str) -> DataFrame:
    return orphans.cascade(*corpus_references(spark, d)).by_table_and_period()


def valid_words(spark: SparkSession, d: str) -> DataFrame:
    return latest_rows(read_table(spark, d, "word", "sent_id", "local_id", "head", "loaded_at"), ["sent_id", "local_id"])


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    tree = hierarchy.hierarchy(valid_words(spark, d), ["sent_id"], "local_id", "head")
    return tree.filter("status <> 'rooted'").select("sent_id", "local_id", "status", F.col("top").alias("top_local"), "steps")


def p2_paths(spark: SparkSession, d: str) -> DataFrame:
    """Path and descendants of every valid word. The path begins at the root, at the detached top, or at the first word on the cycle; the
    cycle is cut there, so the descendants of a word on it are those that hang below it outside the cycle."""
    tree = hierarchy.hierarchy(valid_words(spark, d), ["sent_id"], "local_id", "head", lists=True)
    text = lambda c: F.array_join(F.col(c).cast("array<string>"), "/")
    return tree.select("sent_id", "local_id", "status", F.col("top").alias("top_local"), F.col("steps").alias("depth"), text("path").alias("path"), "n_below", F.array_join(F.array_sort("descendants").cast("array<string>"), ",").alias("descendants"))


def p2_hierarchy(spark: SparkSession, d: str) -> DataFrame:
    """The part of p2_paths below a root."""
    return p2_paths(spark, d).filter("status = 'rooted'").drop("status").withColumnRenamed("top_local", "root_local")


def conllu(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "conllu_raw", "line_id", "file_name", "line_no", "raw")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return parsing.reject_reasons(conllu(spark, d), "line_id", "raw")


def p3_clean(spark: SparkSession, d: str) -> DataFrame:
    rows = parsing.clean_rows(conllu(spark, d), "line_id", "raw")
    return rows.select("line_id", "file_name", "line_no", *parsing.CONLLU_COLUMNS)


def p3_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Reasons by file."""
    return parsing.reject_reasons(conllu(spark, d), "line_id", "raw", carry=["file_name"]).groupBy("file_name", "reason").agg(F.countDistinct("line_id").alias("n_lines"))


FIELDS = ["book_no", "slug", "chapter", "verse", "line_no", "text"]


def cells(spark: SparkSession, d: str) -> DataFrame:
    names = ["line_id", *FIELDS, "loaded_at"]
    return compare.copy_differences(read_table(spark, d, "eng_brenton_lines", *names), read_table(spark, d, "eng_brenton_snapshot", *names), ["line_id"], FIELDS)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return cells(spark, d).select("line_id", "diff").distinct()


def p5_cells(spark: SparkSession, d: str) -> DataFrame:
    return cells(spark, d).select("line_id", "diff", "current_value", "snapshot_value")


QUERIES = {f.__name__: f for f in (p1_found, p1_cascade, p2_found, p2_hierarchy, p2_paths, p3_found, p3_clean, p3_rejects, p5_found, p5_cells)}

_DIRECT = """
v as (select ref, arg_max(deleted_at is not null, loaded_at) gone, min(loaded_at) arrived from verse where ref is not null group by ref),
w0 as (select *, min(loaded_at) over (partition by sent_id, local_id) arrived, row_number() over (partition by sent_id, local_id order by loaded_at desc) rn
  from (select distinct sent_id, local_id, ref, head, loaded_at from word where sent_id is not null and local_id is not null)),
w as (select * from w0 where rn = 1),
c as (select distinct cand_no, chapter, break_candidate.ref, break_candidate.loaded_at,
    book_code || '_' || cast(cast(regexp_extract(chapter, '-([0-9]+)$', 1) as bigint) as varchar) || '.' || cast(cast(regexp_extract(ref, ':([0-9]+)$', 1) as bigint) as varchar) target
  from break_candidate left join book on slug = regexp_extract(chapter, '^(.*)-[0-9]+$', 1) where ref is not null and chapter is not null),
direct as (
  select 'word' src, sent_id || '#' || local_id row_key, 'ref' field, strftime(w.loaded_at, '%Y-%m') period,
    case when v.ref is null then 'missing' when v.gone then 'deleted' when v.arrived > w.loaded_at then 'late' end kind
  from w left join v on v.ref = w.ref where w.ref is not null
  union all
  select 'word', w.sent_id || '#' || w.local_id, 'head', strftime(w.loaded_at, '%Y-%m'),
    case when t.sent_id is null then 'missing' when t.arrived > w.loaded_at then 'late' end
  from w left join w t on t.sent_id = w.sent_id and t.local_id = w.head where w.head <> 0
  union all
  select 'break_candidate', cast(cand_no as varchar), 'ref', strftime(c.loaded_at, '%Y-%m'),
    case when v.ref is null then 'missing' when v.gone then 'deleted' when v.arrived > c.loaded_at then 'late' end
  from c left join v on v.ref = c.target)"""

_WORDS = """w as (select sent_id, local_id, head from (select *, row_number() over (partition by sent_id, local_id order by loaded_at desc) rn
  from (select distinct sent_id, local_id, head, loaded_at from word where sent_id is not null and local_id is not null)) where rn = 1)"""

_LINES = """cut as (select line_id, file_name, line_no, regexp_replace(raw, '\\r$', '') line from conllu_raw),
body as (select * from cut where not regexp_full_match(line, '[ \\t]*') and not starts_with(line, '#')),
f as (select *, regexp_full_match(line, '("([^"]|"")*"|([^"\\t][^\\t]*)?)(\\t("([^"]|"")*"|([^"\\t][^\\t]*)?))*', 's') ok,
    list_transform(regexp_extract_all(chr(9) || line, '\\t("(?:[^"]|"")*"|[^"\\t][^\\t]*|)', 1),
      lambda x: case when starts_with(x, '"') then replace(substr(x, 2, length(x) - 2), '""', '"') else x end) c from body),
reasons as (select line_id, file_name, unnest(case when not ok then ['quoting'] when len(c) <> 10 then ['column_count']
    when not regexp_full_match(c[1], '[0-9]+([-.][0-9]+)?') then ['id']
    when regexp_full_match(c[1], '[0-9]+') then list_filter([case when not regexp_full_match(c[7], '[0-9]+|_') then 'head' end,
      case when not coalesce(regexp_full_match(list_filter(string_split(c[10], '|'), lambda x: starts_with(x, 'Ref='))[1], 'Ref=[A-Z0-9]+_[0-9]+\\.[0-9]+'), false) then 'ref' end], lambda x: x is not null)
    else [] end) reason from f)"""

_CELLS = f"""l as (select * exclude (rn) from (select *, row_number() over (partition by line_id order by loaded_at desc) rn from eng_brenton_lines) where rn = 1),
s as (select * exclude (rn) from (select *, row_number() over (partition by line_id order by loaded_at desc) rn from eng_brenton_snapshot) where rn = 1),
cells as (select line_id, 'snapshot_missing' diff, cast(null as varchar) current_value, cast(null as varchar) snapshot_value from l anti join s using (line_id)
  union all select line_id, 'current_missing', null, null from s anti join l using (line_id)
  {" ".join(f"union all select line_id, '{f}', cast(l.{f} as varchar), cast(s.{f} as varchar) from l join s using (line_id) where l.{f} is distinct from s.{f}" for f in FIELDS)})"""

SQL = {
    "p1_found": f"with {_DIRECT} select distinct * from direct where kind is not null",
    "p1_cascade": f"""with recursive {_DIRECT},
      sizes as (select count(*) n from w group by sent_id),
      down as (select distinct src, row_key, 0 steps from direct where kind is not null
        union select 'word', w.sent_id || '#' || w.local_id, steps + 1 from down join w on down.src = 'word' and down.row_key = w.sent_id || '#' || w.head where w.head <> 0 and steps < (select max(n) from sizes)),
      least as (select src, row_key, min(steps) steps from down group by all),
      rows as (select 'word' src, sent_id || '#' || local_id row_key, loaded_at from w union all select 'break_candidate', cast(cand_no as varchar), loaded_at from c)
      select src, strftime(loaded_at, '%Y-%m') period, case when steps = 0 then 'direct' else 'inherited' end status, count(*) n_rows, max(steps) max_steps
      from least join rows using (src, row_key) group by all""",
    "p2_found": f"""with recursive {_WORDS},
      up as (select sent_id, local_id, local_id here, head, [local_id] seen, 0 steps from w
        union all select up.sent_id, up.local_id, w.local_id, w.head, list_append(seen, w.local_id), steps + 1
        from up join w on w.sent_id = up.sent_id and w.local_id = up.head where up.head <> 0 and not list_contains(seen, up.head)),
      ends as (select * from up where head is null or list_contains(seen, head) or (head <> 0 and not exists (select 1 from w where w.sent_id = up.sent_id and w.local_id = up.head)))
      select sent_id, local_id, case when not coalesce(list_contains(seen, head), false) then 'detached' when list_position(seen, head) = 1 then 'cycle' else 'below_cycle' end status,
        case when coalesce(list_contains(seen, head), false) then list_min(seen[list_position(seen, head):]) else here end top_local,
        case when coalesce(list_contains(seen, head), false) then list_position(seen, head) - 1 else steps end steps from ends""",
    "p2_hierarchy": f"""with recursive {_WORDS},
      t as (select sent_id, local_id, local_id root_local, 0 depth, cast(local_id as varchar) path from w where head = 0
        union all select w.sent_id, w.local_id, root_local, depth + 1, path || '/' || w.local_id from t join w on w.sent_id = t.sent_id and w.head = t.local_id where w.head <> 0),
      pairs as (select sent_id, local_id, cast(a.above as integer) above from t, unnest(string_split(path, '/')) a(above)),
      below as (select sent_id, above local_id, count(*) - 1 n_below, string_agg(local_id, ',' order by local_id) filter (local_id <> above) descendants from pairs group by 1, 2)
      select t.*, n_below, coalesce(descendants, '') descendants from t join below using (sent_id, local_id)""",
    "p2_paths": f"""with recursive {_WORDS},
      up as (select sent_id, local_id, local_id here, head, [local_id] seen from w
        union all select up.sent_id, up.local_id, w.local_id, w.head, list_append(seen, w.local_id)
        from up join w on w.sent_id = up.sent_id and w.local_id = up.head where up.head <> 0 and not list_contains(seen, up.head)),
      ends as (select *, coalesce(list_position(seen, head), 0) ring from up where head is null or head = 0 or list_contains(seen, head) or not exists (select 1 from w where w.sent_id = up.sent_id and w.local_id = up.head)),
      ways as (select sent_id, local_id, case when head = 0 then 'rooted' when ring = 0 then 'detached' when ring = 1 then 'cycle' else 'below_cycle' end status,
        case when ring > 0 then list_min(seen[ring:]) else here end top_local, list_reverse(case when ring > 0 then seen[:ring] else seen end) way from ends),
      pairs as (select sent_id, local_id, unnest(way) above from ways),
      below as (select sent_id, above local_id, count(*) - 1 n_below, string_agg(local_id, ',' order by local_id) filter (local_id <> above) descendants from pairs group by 1, 2)
      select sent_id, local_id, status, top_local, cast(len(way) - 1 as integer) depth, array_to_string(way, '/') path, n_below, coalesce(descendants, '') descendants from ways join below using (sent_id, local_id)""",
    "p3_found": f"with {_LINES} select distinct line_id, reason from reasons",
    "p3_clean": f"""with {_LINES} select line_id, file_name, line_no, c[1] id, c[2] form, c[3] lemma, c[4] upos, c[5] xpos, c[6] feats, c[7] head, c[8] deprel, c[9] deps, c[10] misc
      from f where line_id not in (select line_id from reasons)""",
    "p3_rejects": f"with {_LINES} select file_name, reason, count(distinct line_id) n_lines from reasons group by all",
    "p5_found": f"with {_CELLS} select distinct line_id, diff from cells",
    "p5_cells": f"with {_CELLS} select * from cells",
}
