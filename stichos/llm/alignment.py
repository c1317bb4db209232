"""Sentence alignment in bilingual documents: which lines of two layers of a chapter translate each other.

The target lines of a chapter are emissions of a hidden Markov model whose states are the source lines. A state may span up to max_span
lines running on, which decodes lines joined in the translation; a state may be used by several target lines, which decodes divided
ones; jumps of any distance, backward too, decode lines moved or left out; and every state has a null twin that emits lines
with no source. A target word comes from a word of the state's lines by the lexicon, or from the background. Viterbi decoding gives the
state of every target line; a pair comes out for each line of the state that shares a word with it, or stands between lines that do; a state whose lines share no word with it counts only where no line of the chapter shares one.

The lexicon (form to lemma by the treebank, lemma to glosses) goes to the tasks while its counted rows are under max_entries, else it is joined to the
source words by shuffle. The pairs of a first decoding teach it the words that glosses lack: each task counts its pairs by key and word, the
counts are added up over all lines, and a second decoding gives the result. Chapters
are cogrouped, after the lines of both layers are cut into overlapping windows of verses where a chapter has more than `lines` lines: a
window is decoded by itself and keeps only its middle, so a chapter of many verses is not brought into one task. A verse is not cut.
A line of such a chapter that has no verse, or no state in its window that would stand against all lines of the chapter, is searched in every
window (lines with no verse make one more) and takes its best state; so lines moved or numbered otherwise are found at any distance.

Defined results: null and blank lines pair with nothing; null chapters or slugs have no partner; notes and markup don't count as text;
repeated deliveries count once, by their latest row; a chapter in one layer only gives nothing; empty tables give no rows;
further columns are not read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stichos.common import latest_rows, written

#: Frequent English words, which say little about a line's source.
COMMON = frozenset("a all an and at because but by certain every for from he her his i in into is it its my of on our so she that the their them then there they this through to toward under until upon was we were while with yet you your it".split())
#: Weight of a gloss beside learned words, whose weight is their share of the lines.
GLOSS_WEIGHT = 0.4
#: Letters of the source script in the target's spelling of names.
LATIN = {"α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th", "ι": "i", "κ": "k", "λ": "l", "μ": "m", "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "σ": "s", "ς": "s", "τ": "t", "υ": "u", "φ": "ph", "χ": "ch", "ψ": "ps", "ω": "o"}


def spelled(name: str) -> str:
    """A name in the target's letters."""
    plain = "".join(c for c in unicodedata.normalize("NFD", name.lower()) if not unicodedata.combining(c))
    return "".join(LATIN.get(c, c) for c in plain).replace("ou", "u").replace("ei", "i").replace("ai", "e")


class Model:
    """common: frequent words of the target language, which say little about a line's source."""

    def __init__(self, max_span: int = 3, background: float = 0.35, null: float = 0.03, common: frozenset[str] = COMMON):
        self.max_span, self.background, self.null, self.common = max_span, background, null, common
        self.spans = np.log(np.array([0.88, 0.11, 0.01, 0.002][:max_span]))

    def jumps(self, d: np.ndarray) -> np.ndarray:
        """Log probability of a move by d lines from the last line of one state to the first of the next."""
        p = np.where(d == 1, 0.72, np.where(d == 0, 0.05, np.where(d == 2, 0.06, np.where(d == 3, 0.03, 0.018 * np.exp(-0.1 * np.abs(d - 1))))))
        return np.log(p)

    def emissions(self, sources: list[dict[str, float]], sizes: list[float], unknown: list[float], targets: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log probabilities (targets x states), of the null state (targets), and content words shared (targets x sources)."""
        n, m = len(sources), len(targets)
        vocabulary = {w: k for k, w in enumerate(sorted({w for t in targets for w in t}))}
        table, counts = np.zeros((n, len(vocabulary))), np.zeros((m, len(vocabulary)))
        for j, s in enumerate(sources):
            for w in s.keys() & vocabulary.keys():
                table[j, vocabulary[w]] = s[w]
        np.add.at(counts, (np.repeat(np.arange(m), [len(t) for t in targets]), [vocabulary[w] for t in targets for w in t]), 1)
        rare = np.array([w not in self.common for w in vocabulary], float)
        base = np.where(rare > 0, 0.0012, 0.03)
        size, free = np.array(sizes), np.array(unknown)
        # A common word comes from anywhere; a word with no gloss may mean any rare word.
        near = np.where(rare > 0, self.background, 0.85)
        states = []
        for span in range(1, min(self.max_span, n) + 1):
            total = sum(table[k : n - span + 1 + k] for k in range(span))
            words = sum(size[k : n - span + 1 + k] for k in range(span))
            blank = sum(free[k : n - span + 1 + k] for k in range(span))
            told = (total + (blank[:, None] * 2.5) * base * rare) / np.maximum(words, 1)[:, None]
            states.append((1 - near) * told + near * base)
        log = np.log(np.concatenate(states)) if states else np.zeros((0, len(vocabulary)))
        shared = (counts > 0) @ ((table > 0) * (0.15 + 0.85 * rare)).T
        return counts @ log.T, counts @ np.log(base), shared

    def far(self, n_lines: int) -> float:
        """Log odds against the null state from which a state stands at any place of a chapter: an even choice of its lines, and the moves there and back."""
        return np.log(n_lines) + 6

    def search(self, sources: list[dict[str, float]], sizes: list[float], unknown: list[float], targets: list[list[str]], chunk: int = 256) -> list[tuple[float, list[int]]]:
        """For each target by itself: the log odds of its best state, wherever it stands, and the state's lines that share a word with it."""
        n, out = len(sources), []
        if not n:
            return [(-np.inf, [])] * len(targets)
        first, span = self.states(n)
        for lo in range(0, len(targets), chunk):
            emit, null, shared = self.emissions(sources, sizes, unknown, targets[lo : lo + chunk])
            odds = emit + self.spans[span - 1] - null[:, None]
            for i, at in enumerate(odds.argmax(axis=1)):
                told = [int(j) for j in range(first[at], first[at] + span[at]) if shared[i, j] >= 1.0]
                out.append((float(odds[i, at]), list(range(told[0], told[-1] + 1)) if told else told))
        return out

    def states(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First line and number of lines of each state."""
        spans = range(1, min(self.max_span, n) + 1)
        return np.concatenate([np.arange(n - s + 1) for s in spans]), np.concatenate([np.full(n - s + 1, s) for s in spans])

    def decode(
        self, sources: list[dict[str, float]], sizes: list[float], unknown: list[float], targets: list[list[str]], verses: tuple[list[int], list[int]], odds: list[float] | None = None,
    ) -> list[tuple[int, int]]:
        """(source, target) pairs of one chapter. verses: of sources and of targets, a soft hint of place (-1: none). odds: filled with those of each paired target."""
        n, m = len(sources), len(targets)
        if not n or not m:
            return []
        emit, null, shared = self.emissions(sources, sizes, unknown, targets)
        first, span = self.states(n)
        last = first + span - 1
        va, vb = np.array(verses[0]), np.array(verses[1])
        off = np.maximum(np.maximum(va[first][None, :] - vb[:, None], vb[:, None] - va[last][None, :]), 0)
        told_by = emit
        emit = emit - 0.2 * np.minimum(np.where((va[first][None, :] < 0) | (vb[:, None] < 0), 0, off), 8)
        enter, stay, k = self.spans[span - 1] + np.log(1 - self.null), np.log(self.null), len(first)
        # A move depends on the last line left and the first line entered alone: of the states that end in a line only the best counts.
        move = self.jumps(np.arange(-n, n + 1))[n + np.arange(n)[None, :] - np.arange(n)[:, None]]
        ending = np.full((span[-1], n), k)
        ending[span - 1, last] = np.arange(k)
        # Columns 0..k-1: the state emitted the line; k..2k-1: its null twin, which remembers where it stands.
        score = np.concatenate([self.jumps(first + 1) + enter + emit[0], self.jumps(np.where(span == 1, first + 1, 99)) + stay + null[0]])
        back = np.zeros((m, 2 * k), np.int64)
        lines_, states_, best = np.arange(n), np.arange(k), np.full(k + 1, -np.inf)
        for i in range(1, m):
            from_null = score[k:] > score[:k]
            np.maximum(score[:k], score[k:], out=best[:k])
            left = best[ending]
            of = left.argmax(axis=0)
            through = left[of, lines_][:, None] + move
            arg = through.argmax(axis=0)
            came = ending[of[arg], arg]
            came = came + k * from_null[came]
            back[i, :k] = came[first]
            back[i, k:] = states_ + k * from_null
            score = np.concatenate([through[arg, lines_][first] + enter + emit[i], best[:k] + stay + null[i]])
        at, pairs = int(score.argmax()), []
        for i in range(m - 1, -1, -1):
            if at < k:
                lines = range(first[at], last[at] + 1)
                told = [j for j in lines if shared[i, j] >= 1.0] or ([j for j in lines if shared[i].max() < 1.0] if targets[i] else [])
                # A line between lines of the state that share a word belongs to it.
                told = list(range(told[0], told[-1] + 1)) if told else told
                pairs += [(int(j), i) for j in told]
                if told and odds is not None:
                    odds[i] = float(told_by[i, at] + self.spans[span[at] - 1] - null[i])
            at = back[i, at]
        return sorted(pairs)


def tokens(c: Column) -> Column:
    """Lower-case words of a marked-up line; notes and markup are dropped."""
    plain = F.regexp_replace(c, r"(?s)\\(f|x)\s.*?\\\1\*", " ")
    plain = F.regexp_replace(plain, r"\\\+?[A-Za-z]+[0-9]*\*?", " ")
    return F.filter(F.split(F.lower(plain), r"[^\p{L}\p{M}'’]+"), lambda w: w != "")


def lemma_keys(words: DataFrame) -> DataFrame:
    """form -> key: the lemma a form (lower case) has most often in the treebank."""
    n = words.filter("form is not null and lemma is not null").groupBy(F.lower("form").alias("lex_form"), "lemma").agg(F.count("*").alias("n"))
    return n.groupBy("lex_form").agg(F.max(F.struct("n", "lemma")).alias("m")).select("lex_form", F.col("m.lemma").alias("lemma"))


def _offsets(lists: pa.ListArray) -> pa.Array:
    """Offsets of lists without nulls, from 0."""
    at = np.asarray(lists.offsets)
    return pa.array(at - at[0], pa.int32())


def _dicts(table: pa.Table) -> Iterator[dict]:
    """Rows as dicts. Lists of text are cut out of their flat values, which is several times faster than to_pylist."""
    columns = []
    for c in table.columns:
        if pa.types.is_list(c.type):
            lists = c.combine_chunks() if c.num_chunks != 1 else c.chunk(0)
            flat, at = lists.flatten().to_pylist(), np.r_[0, np.cumsum(np.asarray(lists.value_lengths().fill_null(0)))].tolist()
            columns.append([flat[a:b] for a, b in zip(at, at[1:])])
        else:
            columns.append(c.to_pylist())
    return (dict(zip(table.column_names, r)) for r in zip(*columns))


def gloss_lexicon(glossary: DataFrame) -> DataFrame:
    """key, word, weight: the words of a lemma's glosses."""
    word = F.explode(F.split(F.lower(F.trim("gloss")), r"[^\p{L}'’]+"))
    return glossary.filter("lemma is not null and gloss is not null").select(F.col("lemma").alias("key"), word.alias("word")).filter("word <> ''").distinct().withColumn("weight", F.lit(GLOSS_WEIGHT))


def learned_lexicon(counts: DataFrame) -> DataFrame:
    """key, word, weight: target words that stand in an unusual share of the lines paired with lines of the key.

    counts: key, word, n: paired lines with both; with a null for those of the key or of the word alone, or of all. One round of re-estimation over all
    paired lines.
    """
    n = written(counts.groupBy("key", "word").agg(F.sum("n").alias("n")), "alignment-counts")
    of_key = n.filter("key is not null and word is null").select("key", F.col("n").alias("n_key"))
    of_word = n.filter("key is null and word is not null").select("word", F.col("n").alias("n_word"))
    total = n.filter("key is null and word is null").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    share = F.col("n") / F.col("n_key")
    out = n.filter("key is not null and word is not null and n >= 3").join(of_key, "key").join(of_word, "word").withColumn("weight", share)
    return out.filter((share >= 0.1) & (share * total >= 5 * F.col("n_word"))).select("key", "word", "weight")


def with_lexicon(source_words: DataFrame, entries: DataFrame) -> DataFrame:
    """line_id, glosses: for each word of a line in order its target words and weights as text. Shuffled by key, never collected."""
    own = entries.groupBy("key").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(" ", "word", F.col("weight").cast("string")))), " ").alias("glosses"))
    told = source_words.select("line_id", F.posexplode("keys").alias("at", "key")).join(own, "key", "left")
    ordered = F.array_sort(F.collect_list(F.struct("at", F.coalesce("glosses", F.lit("")).alias("glosses"))))
    return told.groupBy("line_id").agg(ordered.alias("words")).select("line_id", F.col("words.glosses").alias("glosses"))


def n_windows(lines: int) -> Column:
    """Windows of a chapter of n_lines."""
    return F.ceil(F.col("n_lines") / F.lit(lines)).cast("int")


def line_windows(df: DataFrame, lines: int, halo: int) -> DataFrame:
    """Adds window and core: the windows of a chapter a line belongs to, by its verse; chapters up to `lines` long have one.

    The place of a line is its share of the verses up to the chapter's last verse, which both sides know; in a chapter of more windows
    null verses have one of their own, -1.
    """
    verse = F.coalesce(F.col("verse"), F.lit(0))
    per = n_windows(lines)
    width = F.greatest(F.ceil((F.col("last_verse") + 1) / per), F.lit(1))
    home = F.least(F.floor(verse / width), per - 1).cast("int")
    lo = F.greatest(F.floor((verse - halo) / width), F.lit(0)).cast("int")
    hi = F.least(F.floor((verse + halo) / width), per - 1).cast("int")
    placed = F.sequence(F.least(lo, home), F.greatest(hi, home))
    own = F.col("verse").isNull() & (per > 1)
    return df.withColumn("window", F.explode(F.when(own, F.array(F.lit(-1))).otherwise(placed))).withColumn("core", F.col("window") == home)


def aligned_lines(
    source: DataFrame, target: DataFrame, words: DataFrame, glossary: DataFrame, model: Model | None = None, lines: int = 400, halo: int = 12, lines_per_group: int = 2000, learn: bool = True,
    spell: Callable[[str], str] = spelled, max_entries: int = 500_000,
) -> DataFrame:
    """source_id, target_id. source, target: line_id, slug, chapter, verse, line_no, text, loaded_at. learn: decode, learn a lexicon, decode again.

    spell: a name of the source language in the target's letters. max_entries: a lexicon of that many rows goes to the tasks (some 20 MB), a larger one is joined.
    """
    model = model or Model()
    spark = source.sparkSession
    cols = ["line_id", "slug", "chapter", "verse", "line_no", "text", "loaded_at"]
    src, tgt = (latest_rows(x.select(*cols), ["line_id"]).filter("slug is not null and chapter is not null and line_id is not null") for x in (source, target))
    tgt = written(tgt.filter("text is not null").withColumn("forms", tokens(F.col("text"))).filter(F.size("forms") > 0).drop("text", "loaded_at"), "alignment-target")
    forms = F.filter(F.split("text", r"[^\p{L}\p{M}'’]+"), lambda w: w != "")
    src = src.withColumn("forms", forms).drop("text", "loaded_at")
    # A form's lemma is looked up once for each form, not for each of its places.
    known = src.select(F.explode("forms").alias("form")).distinct().withColumn("lex_form", F.lower("form"))
    known = written(known.join(lemma_keys(words), "lex_form", "left").select("form", F.coalesce("lemma", "lex_form").alias("key")), "alignment-forms")
    if known.count() <= max_entries:
        lemma = spark.sparkContext.broadcast({r.form: r.key for r in known.collect()})

        def keyed(batches):
            get = lemma.value.get
            for batch in batches:
                lists = batch.column("forms")
                flat = pa.array([get(f) for f in lists.flatten().to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(_offsets(lists), flat)], names=[*batch.schema.names, "keys"])

        full = src.filter("forms is not null")
        src = full.mapInArrow(keyed, T.StructType([*full.schema.fields, T.StructField("keys", T.ArrayType(T.StringType()))])).unionByName(src.filter("forms is null").withColumn("keys", F.lit(None).cast("array<string>")))
    else:
        told = src.select("line_id", F.posexplode("forms").alias("at", "form")).join(known, "form").groupBy("line_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "key"))), lambda x: x["key"]).alias("keys"))
        src = src.join(told, "line_id", "left")
    src = written(src, "alignment-source")
    size = lambda df: df.groupBy("slug", "chapter").agg(F.count("*").alias("n"), F.max("verse").alias("v"))
    chapters = size(src).join(size(tgt).select("slug", "chapter", F.col("n").alias("n2"), F.col("v").alias("v2")), ["slug", "chapter"])
    chapters = written(chapters.select("slug", "chapter", F.greatest("n", "n2").alias("n_lines"), F.coalesce(F.greatest("v", "v2"), F.lit(0)).alias("last_verse")), "alignment-chapters")
    n_all, most = chapters.agg(F.coalesce(F.sum("n_lines"), F.lit(0)), F.coalesce(F.max("n_lines"), F.lit(0))).first()
    groups = max(1, -(-n_all // lines_per_group))
    key = F.pmod(F.xxhash64("slug", "chapter", "window"), F.lit(groups))
    kinds = (source.schema["line_id"].dataType.simpleString(), target.schema["line_id"].dataType.simpleString())

    def read(x: pa.Table, y: pa.Table, lexicon: dict[str, dict[str, float]] | None):
        """For each window of a bucket: source rows, target rows, and the source's words, sizes and unknown words."""
        by: dict[tuple, tuple[list, list]] = {}
        for at, table in ((0, x), (1, y)):
            for r in _dicts(table.drop_columns(["bucket"])):
                by.setdefault((r["slug"], r["chapter"], r["window"], r.get("part")), ([], []))[at].append(r)
        held: dict[tuple, tuple[dict, float, float]] = {}

        def means(form: str, of: str) -> tuple[dict, float, float]:
            """What a word may mean and how likely, its size, and its share of unknown words. of: its key, or its glosses as text."""
            if (form, of) not in held:
                if lexicon is None:
                    parts = of.split()
                    meant = dict(zip(parts[::2], map(float, parts[1::2])))
                else:
                    meant = dict(lexicon.get(of, ()))
                if form[:1].isupper():
                    meant.setdefault(spell(form), 0.5)
                total = max(sum(meant.values()), 0.5)
                guess = 0.0 if meant else 1.0 if len(form) > 4 else 0.0
                held[form, of] = {g: w / total for g, w in meant.items()}, 1.0 if meant else guess, guess
            return held[form, of]

        for one, other in by.values():
            one.sort(key=lambda r: (r["verse"] or 0, r["line_no"] or 0, r["line_id"]))
            other.sort(key=lambda r: (r["verse"] or 0, r["line_no"] or 0, r["line_id"]))
            sources, sizes, unknown = [], [], []
            for r in one:
                can: dict[str, float] = {}
                n, blank = 0.0, 0.0
                for form, of in zip(r["forms"] or (), (r["keys"] if lexicon is not None else r["glosses"]) or ()):
                    meant, one_n, one_blank = means(form, of)
                    for g, w in meant.items():
                        can[g] = can.get(g, 0.0) + w
                    n, blank = n + one_n, blank + one_blank
                sources.append(can)
                sizes.append(n)
                unknown.append(blank)
            yield one, other, (sources, sizes, unknown)

    def decoded(one: list[dict], other: list[dict], told: tuple, odds: list[float] | None = None) -> list[tuple[int, int]]:
        return model.decode(*told, [r["forms"] for r in other], tuple([-1 if r["verse"] is None else r["verse"] for r in z] for z in (one, other)), odds)

    def decode(x: pa.Table, y: pa.Table, lexicon) -> pa.Table:
        left, right, settled = [], [], []
        for one, other, told in read(x, y, lexicon):
            odds = [-np.inf] * len(other)
            for j, i in decoded(one, other, told, odds):
                if other[i]["core"]:
                    left.append(one[j]["line_id"])
                    right.append(other[i]["line_id"])
                    settled.append(odds[i] >= model.far(other[i]["n_lines"]))
        return pa.table({"source_id": pa.array(left, x.schema.field("line_id").type), "target_id": pa.array(right, y.schema.field("line_id").type), "settled": pa.array(settled, pa.bool_())})

    def count(x: pa.Table, y: pa.Table, lexicon) -> pa.Table:
        """Paired lines by key and word, by key, by word, and all (see learned_lexicon)."""
        keys: dict[str | None, int] = {None: 0}
        meant: dict[str | None, int] = {None: 0}
        told_of = []
        code = lambda names, by: np.array([0, *(by.setdefault(w, len(by)) for w in names)])
        for one, other, told in read(x, y, lexicon):
            k_of: dict[int, np.ndarray] = {}
            w_of: dict[int, np.ndarray] = {}
            for j, i in decoded(one, other, told):
                if not other[i]["core"]:
                    continue
                if j not in k_of:
                    k_of[j] = code({k for f, k in zip(one[j]["forms"], one[j]["keys"]) if len(f) > 3}, keys) << 32
                if i not in w_of:
                    w_of[i] = code({w for w in other[i]["forms"] if len(w) > 2 and w not in model.common}, meant)
                told_of.append(np.add.outer(k_of[j], w_of[i]).ravel())
        pair, n = np.unique(np.concatenate([np.zeros(0, np.int64), *told_of]), return_counts=True)
        names = [pa.array(list(by), pa.string()).take(pa.array(at)) for by, at in ((keys, pair >> 32), (meant, pair & 0xFFFFFFFF))]
        return pa.table({"key": names[0], "word": names[1], "n": pa.array(n.astype(np.int64))})

    def search(x: pa.Table, y: pa.Table, lexicon) -> pa.Table:
        left, right, best, window = [], [], [], []
        for one, other, told in read(x, y, lexicon):
            for r, (odds, lines_) in zip(other, model.search(*told, [r["forms"] for r in other])):
                if lines_ and odds >= model.far(r["n_lines"]):
                    left.append([one[j]["line_id"] for j in lines_])
                    right.append(r["line_id"])
                    best.append(odds)
                    window.append(r["window"])
        return pa.table({"source_ids": pa.array(left, pa.list_(x.schema.field("line_id").type)), "target_id": pa.array(right, y.schema.field("line_id").type), "odds": pa.array(best, pa.float64()), "window": pa.array(window, pa.int32())})

    def placed(entries: DataFrame):
        """Both sides in windows and buckets, and what gives the functions their lexicon."""
        entries = written(entries.groupBy("key", "word").agg(F.round(F.max("weight"), 4).alias("weight")), "alignment-lexicon")
        if entries.count() <= max_entries:
            lexicon: dict[str, dict[str, float]] = {}
            for r in entries.collect():
                lexicon.setdefault(r.key, {})[r.word] = r.weight
            held = spark.sparkContext.broadcast(lexicon)
            bind, s = lambda f: lambda x, y: f(x, y, held.value), src
        else:
            bind, s = lambda f: lambda x, y: f(x, y, None), src.join(with_lexicon(src, entries), "line_id", "left")
        a, b = (line_windows(x.join(chapters, ["slug", "chapter"]), lines, halo).drop("last_verse").withColumn("bucket", key) for x in (s, tgt))
        return a.drop("n_lines"), b, bind

    def learned(entries: DataFrame) -> DataFrame:
        a, b, bind = placed(entries)
        return learned_lexicon(a.groupBy("bucket").cogroup(b.filter("window >= 0").groupBy("bucket")).applyInArrow(bind(count), "key string, word string, n bigint"))

    def align(entries: DataFrame) -> DataFrame:
        a, b, bind = placed(entries)
        if most > lines:
            a, b = written(a, "alignment-windows"), b.filter("window >= 0")
        near = a.groupBy("bucket").cogroup(b.groupBy("bucket")).applyInArrow(bind(decode), f"source_id {kinds[0]}, target_id {kinds[1]}, settled boolean")
        if most <= lines:
            return near.drop("settled")
        near = written(near, "alignment-near")
        rest = tgt.join(chapters.filter(F.col("n_lines") > lines), ["slug", "chapter"]).drop("last_verse").join(near.filter("settled").select(F.col("target_id").alias("line_id")).distinct(), "line_id", "left_anti")
        rest = written(rest, "alignment-rest")
        # The lines searched in a window are shared out if they are many; each share gets the window's source lines.
        parts = rest.groupBy("slug", "chapter").agg(F.ceil(F.count("*") / F.lit(10 * lines_per_group)).cast("int").alias("parts"), F.first(n_windows(lines)).alias("windows"), F.count("*").alias("n_rest"))
        parts = written(parts, "alignment-parts")
        n_rest = parts.agg(F.coalesce(F.sum(F.col("n_rest") * (F.col("windows") + 1)), F.lit(0))).first()[0]
        bucket = F.pmod(F.xxhash64("slug", "chapter", "window", "part"), F.lit(max(1, -(-(n_rest + n_all) // lines_per_group))))
        y = rest.join(parts, ["slug", "chapter"]).withColumn("part", F.pmod(F.xxhash64("line_id"), F.col("parts")).cast("int")).withColumn("window", F.explode(F.sequence(F.lit(-1), F.col("windows") - 1)))
        x = a.join(parts, ["slug", "chapter"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        x, y = (z.drop("parts", "windows", "n_rest").withColumn("bucket", bucket) for z in (x, y))
        far = x.groupBy("bucket").cogroup(y.groupBy("bucket")).applyInArrow(bind(search), f"source_ids array<{kinds[0]}>, target_id {kinds[1]}, odds double, window int")
        far = written(far.groupBy("target_id").agg(F.max_by("source_ids", F.struct("odds", -F.col("window"))).alias("source_ids")), "alignment-far")
        found = far.select(F.explode("source_ids").alias("source_id"), "target_id")
        return near.drop("settled").join(far.select("target_id"), "target_id", "left_anti").select("source_id", "target_id").unionByName(found)

    entries = gloss_lexicon(glossary)
    return align(entries.unionByName(learned(entries)) if learn else entries)
