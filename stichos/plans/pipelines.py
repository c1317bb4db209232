"""From files to files: treebank to token table, tokens and a marked-up translation to aligned text files, aligned text files to HTML.

Each is one plan over all books. book and chapter select a part (null: all); on the token table, which is partitioned by book, the book becomes a
partition filter. An unknown book is an error. Empty inputs write nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stichos import catalog
from stichos.common import small_side, written
from stichos.functions import text as X
from stichos.operators import align, render, segment
from stichos.sources import files, sinks

CHAPTER, VERSE = ["slug", "chapter"], ["slug", "chapter", "verse"]
LAYERS = ("grk", "eng")


def select_place(df: DataFrame, book: str | None = None, chapter: int | None = None) -> DataFrame:
    """Rows of a book (its code, in any case) and chapter."""
    df = df if book is None else df.filter(F.col("book_code") == book.upper())
    return df if chapter is None else df.filter(F.col("chapter") == chapter)


def known_book(books: DataFrame, book: str | None, column: str = "book_code") -> None:
    if book is not None and not books.filter(F.col(column) == book).limit(1).count():
        raise ValueError(f"unknown book {book}")


def treebank(spark: SparkSession, paths: str | list[str], books: DataFrame, out: str, source: str = "gold", text: str = "text") -> None:
    """Treebank files to the token table at out. books: book_no, book_code, slug, book_name, one row a book; words of other books are left out, as are
    those whose ref doesn't parse. source, text: where syntax and text come from."""
    tokens = files.conllu_tokens(files.file_lines(spark, paths)).filter("verse is not null")
    names = small_side(books.select("book_code", "book_name").dropDuplicates(["book_code"]), books.count())
    tokens = tokens.join(names, "book_code").withColumns({"syn_source": F.lit(source), "text_source": F.lit(text)})
    sinks.write_tokens(tokens.select(*catalog.TOKENS.names), out)


def content(
    spark: SparkSession, tokens: str, translation: str | list[str] | None, books: DataFrame, out: str, candidates: DataFrame | None = None, rules: DataFrame | None = None,
    book: str | None = None, chapter: int | None = None, layers: tuple[str, ...] = LAYERS,
) -> DataFrame:
    """Token table and translation files (<slug>.<ending>) to out/<layer>/<NN>-<slug>/<slug>-<CC>.txt, a file a chapter. Gives the coverage by book.

    rules: renumbering of the translation (slug, first, last, shift, and chapter if it has one). A verse's translation stands beside its first line,
    the other lines get an empty one. layers: those to write.
    """
    known_book(books, book and book.upper())
    # The path of the table is the partition filter's: only the book's folder is read.
    words = select_place(files.graph_features(spark, tokens), book, chapter).withColumn("loaded_at", F.lit(None).cast("timestamp"))
    places = small_side(books.select("book_code", "slug", "book_no").dropDuplicates(["book_code"]), books.count())
    made = segment.segment(words, select_place(candidates, book, chapter) if candidates is not None else None)
    lines = written(made.join(places, "book_code").select("book_no", *VERSE, "line_no", F.col("text").alias("grk")), "content-lines")
    english = None
    if translation is not None:
        slug = F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1)
        english = files.usfm_verses(files.file_lines(spark, translation)).select(slug.alias("slug"), "chapter", "verse", F.col("text").alias("eng"))
        if rules is not None:
            english = align.remap(english, rules, [c for c in CHAPTER if c in rules.columns], "verse")
    verses = lines.select("book_no", *VERSE).distinct()
    english = verses.select(*VERSE).withColumn("eng", F.lit(None).cast("string")).limit(0) if english is None else english
    both = written(align.verse_left_join(verses, english, VERSE, "eng"), "content-verses")
    first = F.row_number().over(Window.partitionBy(*VERSE).orderBy("line_no")) == 1
    lines = lines.join(both.select(*VERSE, "eng"), VERSE).withColumn("eng", F.when(first, F.col("eng")).otherwise(""))
    ref = F.concat(F.col("chapter").cast("string"), F.lit(":"), F.col("verse").cast("string"))
    name = F.concat(X.padded(F.col("book_no")), F.lit("-"), F.col("slug"), F.lit("/"), F.col("slug"), F.lit("-"), X.padded(F.col("chapter")), F.lit(".txt"))
    for layer in layers:
        body = render.chapter_text(lines, ["book_no", *CHAPTER], "verse", ["line_no"], ref, layer)
        sinks.write_named(body.select(F.concat(F.lit(f"{layer}/"), name).alias("name"), "body"), out)
    return align.coverage(both, ["slug"], F.col("aligned"))


def layer_files(lines: DataFrame) -> DataFrame:
    """Lines of the files that belong to a layer's book: folder NN-slug, or slug where there is no such folder. Adds slug and folder's rank."""
    lines = files.discover(lines).withColumn("__dir", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1))
    lines = lines.withColumn("__rank", F.when(F.regexp_extract("__dir", r"^\d+-(.+)$", 1) == F.col("slug"), 1).when(F.col("__dir") == F.col("slug"), 2)).filter("__rank is not null")
    best = lines.groupBy("slug").agg(F.min("__rank").alias("__rank"))
    return lines.join(best, ["slug", "__rank"], "left_semi").drop("__dir", "__rank")


def books_html(spark: SparkSession, root: str, out: str, slug: str | None = None, layers: tuple[str, str] = LAYERS, parity: bool = False) -> int:
    """Aligned text files under root/<layer>/*/*.txt to out/<slug>.html, a file a book of the first layer. Gives the number of files."""
    def side(layer: str) -> DataFrame:
        lines = layer_files(files.file_lines(spark, f"{root}/{layer}/*/*.txt"))
        lines = lines if slug is None else lines.filter(F.col("slug") == slug)
        rows = files.sense_line_rows(lines.withColumn("file", F.concat("slug", F.lit("/"), F.col("file_chapter").cast("string"))).drop("path"), "file")
        return rows.select(F.split_part("file", F.lit("/"), F.lit(1)).alias("slug"), "chapter", "verse", (F.col("line_no") - 1).alias("slot"), "text")

    left = side(layers[0])
    known_book(left, slug, "slug")
    pairs = align.line_left_join(left, side(layers[1]), VERSE)
    html = render.book_html(render.chapter_html(pairs, ["slug"], "chapter", "verse", parity=parity), ["slug"], "chapter")
    return sinks.write_named(html.select(F.concat("slug", F.lit(".html")).alias("name"), F.col("html").alias("body")), out)
