"""Rendering of aligned lines: text blocks of chapters and HTML. A chapter is the unit of output, so a grouping holds one chapter's lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stichos.functions import text as X


def ordered_join(order: list[str], value: Column, by: str) -> Column:
    """Aggregate: value in the order of columns, joined."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, value.alias("__v")))), lambda x: x["__v"]), by)


def chapter_text(lines: DataFrame, chapter: list[str], verse: str, order: list[str], ref: Column, text: str) -> DataFrame:
    """chapter.., body: ref line, its lines, a blank line, for each verse; a newline at the end."""
    v = lines.withColumn("__ref", ref).groupBy(*chapter, verse, "__ref").agg(ordered_join(order, F.coalesce(F.col(text), F.lit("")), "\n").alias("__b"))
    block = F.concat("__ref", F.lit("\n"), "__b", F.lit("\n"))
    return v.groupBy(*chapter).agg(ordered_join([verse], block, "\n").alias("body"))


def console_text(lines: DataFrame, chapter: list[str], verse: str, order: list[str], header: Column, ref: Column, text: str) -> DataFrame:
    """chapter.., body: the header and a blank line, then each verse's ref once and its lines indented by two, verses parted by a blank line."""
    line = F.concat(F.lit("  "), F.coalesce(F.col(text), F.lit("")))
    v = lines.withColumns({"__header": header, "__ref": ref}).groupBy(*chapter, "__header", verse, "__ref").agg(F.concat("__ref", F.lit("\n"), ordered_join(order, line, "\n"), F.lit("\n")).alias("__b"))
    body = v.groupBy(*chapter, "__header").agg(ordered_join([verse], F.col("__b"), "\n").alias("__body"))
    return body.select(*chapter, F.concat("__header", F.lit("\n\n"), "__body").alias("body"))


def chapter_html(pairs: DataFrame, book: list[str], chapter: str, verse: str, slot: str = "slot", parity: bool = False) -> DataFrame:
    """book.., chapter, html. pairs: left_text and right_text by slot, as align.line_left_join makes them."""
    n = F.col(chapter)
    side = lambda c, marks, name: F.concat(F.lit(f'<span class="{name}">'), X.verse_markers(X.marked_line(F.col(c), marks, parity), n), F.lit("</span>"))
    line = F.concat(F.lit('    <span class="line">'), side("left_text", X.GREEK_MARKS, "grk"), side("right_text", X.ENGLISH_MARKS, "en"), F.lit("</span>"))
    verses = pairs.withColumn("__line", line).groupBy(*book, chapter, verse).agg(ordered_join([slot], F.col("__line"), "\n").alias("__lines"))
    number = F.concat(n.cast("string"), F.lit(":"), F.col(verse).cast("string"))
    block = F.concat(F.lit('  <div class="verse" id="v-'), F.replace(number, F.lit(":"), F.lit("-")), F.lit('"><span class="verse-num">'), number, F.lit("</span>\n"), F.col("__lines"), F.lit("\n  </div>"))
    out = verses.withColumn("__block", block).groupBy(*book, chapter).agg(ordered_join([verse], F.col("__block"), "\n").alias("__body"))
    return out.select(*book, chapter, F.concat(F.lit('<div class="chapter" id="ch-'), n.cast("string"), F.lit('">\n'), F.col("__body"), F.lit("\n</div>")).alias("html"))


def book_html(chapters: DataFrame, book: list[str], chapter: str) -> DataFrame:
    """book.., n_chapters, html: chapters in order, joined by a newline."""
    return chapters.groupBy(*book).agg(F.count("*").alias("n_chapters"), ordered_join([chapter], F.col("html"), "\n").alias("html"))
