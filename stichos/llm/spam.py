"""Keyword-stuffed and link-list pages: texts that repeat keywords, links or product tags instead of saying something.

A text is cut into blocks of lines, and each block is compressed. Its compression ratio is divided by the usual ratio of
blocks of the same language and length, which gives its redundancy: 1 is usual, less is repetitive. A redundant block is confirmed by a low density of
sentence punctuation, again divided by the usual density of its language; the end of a line with RUN words on end counts as a full stop, so verse needs none.
Both meet in one rule: the more sentence ends a block has, the more extreme its redundancy must be (under 0.9 with none, 0.6 with the usual number),
and with more than the usual number it is no spam by this rule; so litanies and genealogies aren't. Keywords stuffed into sentences have the usual
punctuation; there one word that makes up KEYWORD of an extremely redundant block (under STUFFED) confirms it instead. A text is spam if more than half of
its characters stand in such blocks. No list of words is used.

The language of a block is told from its bytes by a naive Bayes model of byte pairs, fitted on about `sample` labelled rows chosen by the hash of
their id; labels of under LEAST_SHARE of the sample are left out. Without labels all blocks count as one language. The usual values are measured
over the whole corpus: medians over distinct texts, each with one vote for a language and length however many copies or blocks it has.
The usual ratio is never taken below that of plain prose (PROSE), so a source of spam that rules its lengths doesn't pass for usual.

One pass of Arrow batches measures the blocks and is written to the shared folder; the medians are an aggregate of it by text, and the verdict is a
join with them and one aggregation by text. No row depends on another text but through the medians.

Defined results: null and blank texts are not spam; a text under min_words words (a link or tag counts as one) is not spam; every id with the text is
reported; texts of any length are measured whole; an empty table gives no rows; null labels are no labels; further columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stichos.common import written

WORD = re.compile(r"[^\W\d_]+")
LINK = re.compile(r"(?:https?://|www\.)[^\s\"<>)\]]+|\b[\w-]+\.(?:[a-z]{3,10})/[^\s\"<>)\]]*|<[^<>]*>")
MARK = re.compile(r"\\\+?[a-z]+\d?\*?")
#: A sentence ends after a word or a closing mark; numbers that begin a line don't count (a text is searched with a newline before it); in Greek also at ; and ·.
END = re.compile("[.!?](?<=[\\w\"'”’)»][.!?])(?<!\n\\d[.!?])(?<!\n\\d\\d[.!?])(?=[\\s\"'”’)»]|\\Z)|:(?<=[^\\W\\d_]:)(?=\\s|\\Z)|[。！？।؟۔]")
GREEK_END = re.compile(r"(?<=[^\W\d_])\s?[.!?;··]")
GREEK = re.compile(r"[Ͱ-Ͽἀ-῿]")
RUN = 5
RUNNING = re.compile(r"(?:[^\W\d_]+[ '’]+){%d}[^\W\d_]" % (RUN - 1))
BLOCK = 480
#: The rule: redundancy < LOOSE * exp(-WEIGHT * ends ** 1.5), where ends is the density of sentence ends against the usual, at most 1.
LOOSE, WEIGHT = 0.9, 0.4
STUFFED, KEYWORD, KEYWORD_WORDS = 0.6, 0.2, 16
#: Labels of a smaller share of the sample make no language; nor do those that name none (fixed values).
LEAST_SHARE, NO_LANGUAGE = 0.02, ("mul", "und", "zxx", "mis", "")
#: Packed bytes a character of plain prose (medians of sf0.1; the last two carried on), by half powers of two of the length from PROSE_FROM
#: on, and the share of them the usual ratio can't fall below. Other scripts take more bytes a character, so for them the first list is a low bound.
PROSE = [1.0, 1.0, 0.978, 0.902, 0.81, 0.756, 0.691, 0.64, 0.598, 0.567, 0.53, 0.5]
GREEK_PROSE = [1.89, 1.757, 1.674, 1.5, 1.355, 1.267, 1.126, 1.045, 0.983, 0.931, 0.9, 0.87]
PROSE_FROM, PROSE_SHARE = 9, 0.85

MEASURES = "copy bigint, n_chars int, n_bytes int, n_packed int, n_words int, n_ends int, n_top int, language int, greek boolean"


def blocks(text: str, size: int = BLOCK) -> Iterator[str]:
    """Whole lines of one paragraph, together up to size characters; a longer line is cut. Short paragraphs are joined."""
    kept, n = [], 0
    for para in re.split(r"\n\s*\n", text):
        for line in para.split("\n"):
            for at in range(0, len(line), size) if len(line) > size else (0,):
                part = line[at : at + size]
                if n + len(part) > size and n:
                    yield "\n".join(kept)
                    kept, n = [], 0
                kept.append(part)
                n += len(part)
        if n >= size // 6:
            yield "\n".join(kept)
            kept, n = [], 0
    if n:
        yield "\n".join(kept)


def pairs(raw: bytes) -> np.ndarray:
    """Codes of the byte pairs of a text, overlapping ones too."""
    return np.ndarray((len(raw) - 1,), "<u2", raw, strides=(1,))


def measure(block: str, table: np.ndarray | None = None) -> tuple:
    """table: log probabilities of byte pairs, a row a language, less those of the first language, which has no row."""
    if "\\" in block:
        block = MARK.sub("", block)
    low = block.lower()
    raw = low.encode("utf-8", "replace")
    plain = LINK.sub("\x01", low) if ("/" in low or "<" in low) else low
    words = WORD.findall(plain)
    n_words = len(words) + plain.count("\x01")
    n_top = max(Counter(words).values(), default=0)
    greek = 2 * len(GREEK.findall(block)) > len(block) / 2 if not block.isascii() else False
    end = GREEK_END if greek else END
    n_ends = len(end.findall("\n" + block)) + sum(1 for line in plain.split("\n") if RUNNING.search(line) and not end.search("a" + line.rstrip()[-3:]))
    language = 0
    if table is not None and len(raw) > 1:
        at = pairs(raw)
        odds = [row.take(at).sum() for row in table]
        language = 1 + int(np.argmax(odds)) if max(odds) > 0 else 0
    return len(block), len(raw), len(zlib.compress(raw, 6)) - 8, n_words, n_ends, n_top, language, greek


def language_model(df: DataFrame, id_col: str, text_col: str, lang_col: str, sample: int) -> np.ndarray | None:
    """Log probabilities of byte pairs by language (see `measure`), from about `sample` labelled rows: those whose id has a small hash.

    A label counts by its first part in lower case. Each label costs 64 K numbers; at most 1 / LEAST_SHARE labels are kept.
    """
    label = F.split_part(F.lower(F.trim(F.col(lang_col))), F.lit("-"), F.lit(1))
    rows = df.select(F.xxhash64(id_col).alias("h"), label.alias("label"), F.col(text_col).alias("text")).filter("text is not null and label is not null").filter(~F.col("label").isin(*NO_LANGUAGE))
    n = df.filter(F.col(lang_col).isNotNull()).count()
    if n > sample:
        rows = rows.filter(F.pmod("h", F.lit(1 << 30)) < int((1 << 30) * sample / n))

    def count(batches):
        held: dict[str, list] = {}
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                of = held.setdefault(label, [0, np.zeros(1 << 16, np.int64)])
                of[0] += 1
                raw = text.lower().encode("utf-8", "replace")
                if len(raw) > 1:
                    of[1] += np.bincount(pairs(raw), minlength=1 << 16)
        for label, (n_rows, counts) in held.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([label] * (len(at) + 1)), pa.array(np.r_[-1, at].astype(np.int32)), pa.array(np.r_[n_rows, counts[at]])], names=["label", "pair", "n"])

    told = written(rows.select("label", "text").mapInArrow(count, "label string, pair int, n bigint").groupBy("label", "pair").agg(F.sum("n").alias("n")), "spam-languages")
    sizes = {r.label: r.n for r in told.filter("pair = -1").orderBy(F.desc("n"), "label").limit(int(1 / LEAST_SHARE)).collect()}
    names = sorted(k for k, v in sizes.items() if v >= LEAST_SHARE * sum(sizes.values()))
    if len(names) < 2:
        return None
    counts = np.full((1 << 16, len(names)), 0.05)
    for r in told.filter(F.col("label").isin(names) & (F.col("pair") >= 0)).collect():
        counts[r.pair, names.index(r.label)] += r.n
    logs = np.log(counts / counts.sum(axis=0)).T
    return np.ascontiguousarray(logs[1:] - logs[0], np.float32)


def block_measures(df: DataFrame, id_col: str, text_col: str, table: np.ndarray | None = None) -> DataFrame:
    """A row for each block of each text: id and MEASURES. copy: the hash of the text, the same for all its copies."""
    held = df.sparkSession.sparkContext.broadcast(table)  # 256 KB a language

    def run(batches):
        table = held.value
        for batch in batches:
            ids, out = [], []
            for at, text in enumerate(batch.column(1).to_pylist()):
                if text:
                    for b in blocks(text):
                        if not b.isspace():
                            ids.append(at)
                            out.append(measure(b, table))
            cols = list(zip(*out)) if out else [[] for _ in range(8)]
            at = pa.array(ids, pa.int32())
            arrays = [batch.column(0).take(at), batch.column(2).take(at), *[pa.array(c, pa.int32()) for c in cols[:7]], pa.array(cols[7], pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "copy", "n_chars", "n_bytes", "n_packed", "n_words", "n_ends", "n_top", "language", "greek"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("copy")).filter("text is not null").mapInArrow(run, f"id {kind}, {MEASURES}")


def prose_ratio() -> Column:
    """The least ratio that counts as usual for a block of its script and length."""
    at = F.greatest(F.least(F.col("bucket").cast("int") - PROSE_FROM, F.lit(len(PROSE) - 1)), F.lit(0))
    listed = lambda values: F.get(F.array(*map(F.lit, values)), at)
    return PROSE_SHARE * F.when(F.col("greek"), listed(GREEK_PROSE)).otherwise(listed(PROSE)) * F.col("n_chars") / F.greatest("n_bytes", F.lit(1))


def spam_scores(df: DataFrame, id_col: str, text_col: str, lang_col: str | None = None, min_words: int = 12, share: float = 0.5, sample: int = 2000) -> DataFrame:
    """id, n_chars, spam_share (characters in spam blocks), redundancy (the least of a block), spam."""
    table = language_model(df, id_col, text_col, lang_col, sample) if lang_col else None
    words = F.greatest("n_words", F.lit(1))
    measured = {"ratio": F.col("n_packed") / F.greatest("n_bytes", F.lit(1)), "bucket": F.round(2 * F.log2(F.col("n_chars") + 1)), "ends": F.col("n_ends") / words}
    one = written(block_measures(df, id_col, text_col, table), "spam-blocks").withColumns(measured)
    # One row for each language, script and half power of two of the length of a block, which is bounded: a few dozen a language.
    kind = ["language", "greek"]
    votes = one.groupBy("copy", *kind, "bucket").agg(F.avg("ratio").alias("ratio"), F.avg("ends").alias("ends"))
    usual = votes.groupBy(*kind, "bucket").agg(F.percentile_approx("ratio", 0.5, 2000).alias("usual"))
    usual_ends = votes.groupBy(*kind).agg(F.percentile_approx("ends", 0.5, 2000).alias("usual_ends"))
    usual = usual.join(usual_ends, kind)
    red = F.col("ratio") / F.greatest("usual", prose_ratio(), F.lit(0.01))
    # Where sentence ends are unusual, their absence confirms nothing.
    ends = F.when(F.col("usual_ends") > 0, F.col("ends") / F.col("usual_ends")).otherwise(1.0)
    spam = (red < LOOSE * F.exp(-WEIGHT * F.pow(ends, F.lit(1.5)))) & (ends <= 1.0)
    spam = spam | ((red < STUFFED) & (F.col("n_top") >= KEYWORD * words) & (words >= KEYWORD_WORDS))
    told = one.join(F.broadcast(usual), [*kind, "bucket"]).select("id", "n_chars", "n_words", red.alias("red"), spam.alias("spam"))
    out = told.groupBy("id").agg(F.sum("n_chars").alias("n_chars"), F.sum("n_words").alias("n_words"), (F.sum(F.when(F.col("spam"), F.col("n_chars")).otherwise(0)) / F.sum("n_chars")).alias("spam_share"), F.min("red").alias("redundancy"))
    return out.select(F.col("id").alias(id_col), "n_chars", "spam_share", "redundancy", ((F.col("n_words") >= min_words) & (F.col("spam_share") > share)).alias("spam"))


def spam_pages(df: DataFrame, id_col: str, text_col: str, lang_col: str | None = None) -> DataFrame:
    return spam_scores(df, id_col, text_col, lang_col).filter("spam").select(id_col).distinct()
