"""Queries of the text operators: sentence alignment (p4), packing (p6), leaked passages (p7), spam pages (p8)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stichos.common import read_table, written
from stichos.llm import alignment, leaks, packing, spam


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return spam.spam_pages(read_table(spark, d, "documents", "doc_id", "text", "lang"), "doc_id", "text", "lang")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    lines = [read_table(spark, d, t, "line_id", "slug", "chapter", "verse", "line_no", "text", "loaded_at") for t in ("grk_lines", "eng_brenton_lines")]
    pairs = alignment.aligned_lines(*lines, read_table(spark, d, "word", "form", "lemma"), read_table(spark, d, "glossary", "lemma", "gloss"))
    return pairs.select(F.col("source_id").alias("grk_line_id"), F.col("target_id").alias("eng_line_id")).distinct()


TOKENIZER = os.environ.get("STICHOS_TOKENIZER", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
CAPACITY = 2048


def p6_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(read_table(spark, d, "documents", "doc_id", "text"), "doc_id", "text", TOKENIZER, CAPACITY)


def p6_audit(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of p6_containers; its SQL counts the texts and states the rest."""
    return packing.audit(written(p6_containers(spark, d), "packing-audit"), "doc_id", CAPACITY)


def p7_passages(spark: SparkSession, d: str) -> DataFrame:
    docs, items = read_table(spark, d, "documents", "doc_id", "text"), read_table(spark, d, "eval_item", "item_id", "lang", "text")
    return leaks.leaked_passages(docs, "doc_id", "text", items, "item_id", "text", "lang")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return p7_passages(spark, d).select("doc_id", "item_id").distinct()


def p7_verbatim(spark: SparkSession, d: str) -> DataFrame:
    """Of p7_passages those with 15 words of the item in a run, word for word. The SQL finds them by shingles of 15 words, so it tells what the search misses."""
    return p7_passages(spark, d).filter("n_run >= 15").select("doc_id", "item_id").distinct()


# The plain form of a text in SQL, stated apart from leaks.words.
_PLAIN = r"""list_filter(regexp_extract_all(replace(lower(strip_accents(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(replace(text, 'ﬁ', 'fi'), 'ﬂ', 'fl'),
  '\\f\s.*?\\f\*', ' ', 'gs'), '\\x\s.*?\\x\*', ' ', 'gs'), '\\\+?[a-z]+[0-9]?\*?|<[^<>\n]+>|&[a-z]{2,6};', ' ', 'g'), '(\p{L})[-‐\x{ad}][ \t]*\r?\n[ \t]*(\p{L})', '\1\2', 'g'), '[\x{ad}\x{200b}-\x{200d}\x{2060}\x{feff}]', '', 'g'))), 'ς', 'σ'), '\p{L}+'), lambda w: w <> '')"""
_SHINGLES = "(select distinct {0}, array_to_string(w[k:k + 14], ' ') g from (select {0}, w, unnest(range(1, len(w) - 13)) k from (select {0}, {1} w from {2} where text is not null)))"

QUERIES = {f.__name__: f for f in (p4_found, p6_containers, p6_audit, p7_found, p7_verbatim, p8_found)}
SQL: dict[str, str] = {
    "p6_audit": "select count(*) n_rows, count(*) filter (coalesce(text, '') = '') n_empty, 0::bigint n_over, 0::bigint n_gaps, 0::bigint n_split, true as \"full\" from documents",
    "p7_verbatim": f"select distinct doc_id, item_id from {_SHINGLES.format('doc_id', _PLAIN, 'documents')} join {_SHINGLES.format('item_id', _PLAIN, 'eval_item')} using (g)",
}
