"""Sources of text files, read by line; what runs on from line to line is a window over a file. Paths may be globs.

Lines end at \\n, \\r\\n or \\r. Files that match nothing give no rows where `optional` is true.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stichos.functions import text as X
from stichos.operators import parsing

FILE = r"([^/]+)-(\d+)\.txt$"


def file_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """path, line_no (from 1), line; the empty piece after the last newline is no line.

    Files are read by line and may be split: a line's number is its place in the block it was read in, and the lines of the file's blocks before.
    """
    at = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id")]
    raw = spark.read.text(paths).select(*at, F.col("value").alias("line"))
    blocks = raw.groupBy("path", "block").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.select("path", "block", (F.coalesce(before, F.lit(0)) - F.col("first") + 1).alias("shift"))
    return raw.join(blocks, ["path", "block"]).select("path", (F.col("id") + F.col("shift")).cast("int").alias("line_no"), "line")


def _fill(c: Column, w) -> Column:
    return F.last(c, ignorenulls=True).over(w)


def sense_line_rows(lines: DataFrame, file_col: str = "path") -> DataFrame:
    """file, chapter, verse, line_no (in the verse), text: ref lines c:v open a verse; inner blank lines are '' slots, those at a verse's end go;
    text before the first ref is ignored. Of a ref that comes twice the later block wins."""
    w = Window.partitionBy(file_col).orderBy("line_no")
    text = X.strip(F.col("line"))
    marked = lines.withColumn("__t", text).withColumn("__is", text.rlike(r"^\d+:\d+$"))
    marked = marked.withColumn("__ref", _fill(F.when(F.col("__is"), F.col("__t")), w)).withColumn("__at", _fill(F.when(F.col("__is"), F.col("line_no")), w)).filter("__ref is not null")
    last = marked.groupBy(file_col, "__ref").agg(F.max("__at").alias("__at"))
    body = marked.filter("not __is").select(file_col, "__ref", "__at", "line_no", "__t").join(last, [file_col, "__ref", "__at"], "left_semi")
    body = body.withColumn("__last", F.max(F.when(F.col("__t") != "", F.col("line_no"))).over(Window.partitionBy(file_col, "__ref"))).filter(F.col("line_no") <= F.col("__last"))
    number = lambda k: F.split_part("__ref", F.lit(":"), F.lit(k)).try_cast("int")
    return body.select(file_col, number(1).alias("chapter"), number(2).alias("verse"), (F.col("line_no") - F.col("__at")).cast("int").alias("line_no"), F.col("__t").alias("text"))


def discover(lines: DataFrame) -> DataFrame:
    """slug and chapter from the file name, split at its last dash; files named otherwise are dropped."""
    return lines.withColumns({"slug": F.regexp_extract("path", FILE, 1), "file_chapter": F.regexp_extract("path", FILE, 2).try_cast("int")}).filter("slug <> ''")


def conllu_tokens(lines: DataFrame, file_col: str = "path") -> DataFrame:
    """The tokens of treebank files: rows of other than ten fields and ids n-m, n.m are dropped; sentences end at blank lines.

    file, sent_no, sent_id (of the comment, else file#no), and the token table's columns; ref null where it doesn't parse.
    """
    w = Window.partitionBy(file_col).orderBy("line_no")
    text = F.regexp_replace("line", r"\r\z", "")
    x = lines.withColumn("__t", text).withColumn("__blank", F.trim(text) == "")
    x = x.withColumn("sent_no", F.sum(F.col("__blank").cast("int")).over(w)).withColumn("__sid", F.when(F.col("__t").startswith("# sent_id"), F.regexp_extract("__t", r"^# sent_id\s*=\s*(.*)$", 1)))
    x = x.withColumn("__sid", F.last("__sid", ignorenulls=True).over(Window.partitionBy(file_col, "sent_no").orderBy("line_no")))
    f = F.split("__t", "\t", -1)
    x = x.filter(~F.col("__blank") & ~F.col("__t").startswith("#")).withColumn("f", f).filter((F.size("f") >= 10) & F.get("f", F.lit(0)).rlike(parsing.PLAIN))
    cell = lambda k: F.get("f", F.lit(k))
    unless = lambda k, other: F.when(cell(k) == "_", other).otherwise(cell(k))
    ref = X.misc_ref(cell(9))
    head = F.coalesce(F.when(cell(6) == "_", F.lit(0)).otherwise(cell(6).try_cast("int")), F.lit(0))
    out = x.select(
        file_col, "line_no", F.coalesce("sent_no", F.lit(0)).alias("sent_no"), F.coalesce("__sid", F.concat(F.col(file_col), F.lit("#"), F.col("sent_no").cast("string"))).alias("sent_id"), cell(0).try_cast("int").alias("local_id"),
        X.nfc(cell(1)).alias("form"), X.nfc(unless(2, cell(1))).alias("lemma"), unless(3, F.lit("X")).alias("upos"), cell(4).alias("xpos"), unless(5, F.lit("")).alias("morph"), head.alias("head"), cell(7).alias("udrel"),
        F.when(cell(9).contains("SpaceAfter=No"), "").otherwise(" ").alias("after_text"), (head == 0).cast("int").alias("is_root"),
        X.ref_part(ref, 1).alias("book_code"), X.ref_part(ref, 2).try_cast("int").alias("chapter"), X.ref_part(ref, 3).try_cast("int").alias("verse"),
    )
    return out.withColumn("pos", F.when(F.col("verse").isNotNull(), F.row_number().over(Window.partitionBy("book_code", "chapter", "verse").orderBy(file_col, "line_no"))))


def usfm_verses(lines: DataFrame, file_col: str = "path") -> DataFrame:
    """file, chapter, verse, text of marked-up translations: the last of a repeated verse wins, empty ones are dropped.

    Paragraph markers go before lines are told apart; sub-verse lines (\\v 22a) are dropped and their wrapped lines join the verse before.
    """
    w = Window.partitionBy(file_col).orderBy("line_no")
    x = lines.withColumn("t", X.strip(F.regexp_replace("line", X.PARAGRAPH, ""))).filter("t <> ''").filter(~F.col("t").rlike(X.HEADERS) & ~F.col("t").rlike(r"^\\v\s+\d+[a-z]+\b"))
    is_c, is_v = F.col("t").rlike(r"^\\c\s+\d+"), F.col("t").rlike(r"^\\v\s+\d+")
    x = x.withColumns({"ch": F.when(is_c, F.regexp_extract("t", r"^\\c\s+(\d+)", 1).try_cast("int")), "at": F.when(is_c | is_v, F.col("line_no")), "v": F.when(is_c, F.lit(-1)).when(is_v, F.regexp_extract("t", r"^\\v\s+(\d+)", 1).try_cast("int"))})
    x = x.withColumns({"chapter": _fill(F.col("ch"), w), "verse": _fill(F.col("v"), w), "at": _fill(F.col("at"), w)}).filter(~is_c & (F.col("verse") >= 0) & F.col("chapter").isNotNull())
    piece = F.when(is_v, F.regexp_replace("t", r"^\\v\s+\d+\s*", "")).otherwise(F.col("t"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", piece.alias("s")))), lambda s: s["s"]), " ")
    verses = x.groupBy(file_col, "chapter", "verse", "at").agg(X.clean_markup(joined).alias("text")).filter("text <> ''")
    return verses.groupBy(file_col, "chapter", "verse").agg(F.max_by("text", "at").alias("text"))


def break_candidates(spark: SparkSession, path: str) -> DataFrame:
    """cand_no (place in the list), slug, chapter, verse, greek_left of {"survivors": [...]}; rows that don't parse are skipped."""
    rows = spark.read.option("multiLine", True).schema("survivors array<struct<chapter:string,ref:string,greek_left:string>>").json(path)
    x = rows.select(F.posexplode("survivors").alias("cand_no", "r")).select("cand_no", "r.*").filter(F.col("chapter").rlike(r"^([a-z0-9]+)-(\d+)$") & F.col("ref").rlike(r"^(\d+):(\d+)$"))
    return x.select("cand_no", F.regexp_extract("chapter", r"^(.*)-(\d+)$", 1).alias("slug"), F.regexp_extract("chapter", r"-(\d+)$", 1).try_cast("int").alias("chapter"), F.regexp_extract("ref", r":(\d+)$", 1).try_cast("int").alias("verse"), "greek_left")


def graph_features(spark: SparkSession, path: str, *features: str) -> DataFrame:
    """The token table with the named features only; the scan reads no other column."""
    df = spark.read.parquet(path)
    return df.select(*features) if features else df
