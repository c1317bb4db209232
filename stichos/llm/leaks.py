"""Evaluation texts leaking into training text: which documents hold passages of which held-out items.

Every item, and every document, is seen through windows of `window` words. A window's SimHash is the sign of the weighted sum of
its words' random vectors; the weight of a word falls with the share of items of its language that have it, so words of
every sentence hardly move a fingerprint. The item fingerprints are filed under radius + 1 blocks of their bits: two
fingerprints within the radius agree in one block at least, so looking up all blocks of a document's window and counting
differing bits finds every item window within the radius. Windows with two words that no item has, or of hardly any weight, are not looked up
(Settings). Windows found near each other in document and item are
a candidate, which an exact weighted alignment in order (words matched, replaced, left out, added) verifies; its pieces
are put together in the item's order. Windows are as long as a shingle, not as an item: a window as long as the item can't find a part of it.

The items are a held-out set whose index every task gets; its size is checked (max_item_words) and a larger set is done in slices, each
with its own pass. The words' weights are counted over all items by one aggregate and every slice gets the same table, so slices change no
result; the table holds the vocabulary of all items. Documents are never shuffled: a pass is a map over the scan, so no source or group of copies is hot.

Defined results: null and blank texts hold nothing; an item under min_words words can't be found; letter case, accents,
markup, numbers and words divided at a line's end don't count; repeated items are found each by its own id; texts of
any length are read whole; an empty side gives no rows; further columns are not read.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

NOTE = re.compile(r"\\(f|x)\s.*?\\\1\*", re.S)
MARK = re.compile(r"\\\+?[a-z]+\d?\*?|<[^<>\n]+>|&[a-z]{2,6};")
BROKEN = re.compile(r"(?<=[^\W\d_])[-‐\u00ad][ \t]*\r?\n[ \t]*(?=[^\W\d_])")
HIDDEN = re.compile("[\u0300-\u036f\u00ad\u200b-\u200d\u2060\ufeff]")
WORD = re.compile(r"[^\W\d_]+")


def words(text: str) -> list[str]:
    """The words of a text in their plainest form."""
    if "\\" in text:
        text = NOTE.sub(" ", text)
    if "\\" in text or "<" in text or "&" in text:
        text = MARK.sub(" ", text)
    if "\n" in text:
        text = BROKEN.sub("", text)
    if not text.isascii():
        text = HIDDEN.sub("", unicodedata.normalize("NFKD", text)).lower().replace("ς", "σ")
        return WORD.findall(text)
    return WORD.findall(text.lower())


@dataclass(frozen=True)
class Settings:
    """window and radius: of fingerprints. A window of a document is looked up if it has at most `unknown` words that no item has, and least_weight
    in all; windows near each other are aligned if they cover 3 places of the item, or 2 and pair_weight, or weigh dense_weight a window (strict:
    without it all are). A piece counts from piece_words words of the item on and piece_score; a case has
    min_words words of the item in all, min_score, and min_share of its weight matched. band: words an alignment may stray from the
    line through its windows, where the item and the document's part have more than 2 * band words; cells: of alignments done at once."""

    window: int = 5
    radius: int = 3
    piece_words: int = 9
    piece_score: float = 1.8
    min_words: int = 13
    min_score: float = 2.6
    min_share: float = 0.5
    unlike: float = 0.35
    left_out: float = 0.35
    added: float = 0.12
    unknown: int = 1
    least_weight: float = 0.9
    strict: bool = True
    pair_weight: float = 2.0
    dense_weight: float = 2.2
    band: int = 1000
    cells: int = 4_000_000
    max_item_words: int = 2_000_000


def word_weights(of_word: dict[str, dict[str, int]], of_lang: dict[str, int]) -> dict[str, float]:
    """Weight of each word, from the items of each language and those of them that have the word."""
    return {w: max(0.06, min(np.log(1 + of_lang[g] / k) / np.log(1 + of_lang[g]) for g, k in by.items())) for w, by in of_word.items()}


def count_words(rows: DataFrame) -> dict[str, float]:
    """word_weights of all items (g, t), counted in the cluster; the vocabulary comes to the driver."""

    def run(batches):
        for batch in batches:
            told = [(g or "", w) for g, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for w in set(words(t))]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in told], pa.string()) for k in (0, 1)], names=["g", "w"])

    of_lang = {r.g: r.n for r in rows.groupBy(F.coalesce("g", F.lit("")).alias("g")).agg(F.count("*").alias("n")).collect()}
    of_word: dict[str, dict[str, int]] = defaultdict(dict)
    for r in rows.select("g", "t").mapInArrow(run, "g string, w string").groupBy("w", "g").agg(F.count("*").alias("n")).collect():
        of_word[r.w][r.g] = r.n
    return word_weights(of_word, of_lang)


class Index:
    """The items: coded words, weights, and the fingerprints of all their windows by block."""

    def __init__(self, items: list[tuple[object, str, str]], s: Settings, weights: dict[str, float] | None = None):
        """weights: of the words of all items, where items is a slice of them."""
        self.s, self.ids = s, [i for i, _, _ in items]
        tokens = [words(t or "") for _, _, t in items]
        if weights is None:
            of_lang: dict[str, int] = defaultdict(int)
            of_word: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))
            for (_, lang, _), ws in zip(items, tokens):
                of_lang[lang] += 1
                for w in set(ws):
                    of_word[w][lang] += 1
            weights = word_weights(of_word, of_lang)
        self.code = {w: n + 1 for n, w in enumerate(sorted(weights))}
        self.weight = np.zeros(len(self.code) + 1, np.float32)
        for w, weight in weights.items():
            self.weight[self.code[w]] = weight
        self.items = [np.array([self.code[w] for w in ws], np.int32) for ws in tokens]
        bits = np.array([xxhash.xxh64_intdigest(w, seed=7) for w in self.code], np.uint64)
        signs = np.unpackbits(bits.view(np.uint8).reshape(-1, 8), axis=1).astype(np.int16) * 2 - 1
        self.vectors = np.zeros((len(self.code) + 1, 64), np.int16)
        if len(bits):
            self.vectors[1:] = signs * np.round(self.weight[1:, None] * 100).astype(np.int16)
        prints, item, at = [], [], []
        for k, ws in enumerate(self.items):
            if len(ws) >= s.window:
                prints.append(self.prints(ws)[0])
                item.append(np.full(len(ws) - s.window + 1, k))
                at.append(np.arange(len(ws) - s.window + 1))
        self.prints_, self.item, self.at = (np.concatenate(x) if x else np.zeros(0, d) for x, d in ((prints, np.uint64), (item, np.int64), (at, np.int64)))
        self.width = 64 // (s.radius + 1)
        self.blocks = []
        for b in range(s.radius + 1):
            key = self.block(self.prints_, b)
            order = np.argsort(key, kind="stable")
            self.blocks.append((order, np.searchsorted(key[order], np.arange((1 << self.width) + 1))))

    def block(self, prints: np.ndarray, b: int) -> np.ndarray:
        return ((prints >> np.uint64(b * self.width)) & np.uint64((1 << self.width) - 1)).astype(np.int64)

    def prints(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprint and weight of the window that starts at each word."""
        n = len(codes) - self.s.window + 1
        v, w = self.vectors[codes], self.weight[codes]
        total, weight = v[:n].copy(), w[:n].copy()
        for k in range(1, self.s.window):
            total += v[k : n + k]
            weight += w[k : n + k]
        return np.packbits(total > 0, axis=1).view(np.uint64).ravel(), weight

    def hits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (word of the document, item window) whose fingerprints differ in radius bits at most."""
        known = np.convolve(codes > 0, np.ones(self.s.window, np.int16), "valid")
        prints, weight = self.prints(codes)
        start = np.flatnonzero((known >= self.s.window - self.s.unknown) & (weight >= self.s.least_weight))
        prints = prints[start]
        where, what = [], []
        for b, (order, ends) in enumerate(self.blocks):
            key = self.block(prints, b)
            n = ends[key + 1] - ends[key]
            some = np.flatnonzero(n)
            n = n[some]
            flat = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(ends[key[some]], n)
            w = order[flat]
            p = np.repeat(some, n)
            near = np.bitwise_count(prints[p] ^ self.prints_[w]) <= self.s.radius
            where.append(start[p[near]])
            what.append(w[near])
        pairs = np.unique(np.concatenate(where) * max(len(self.prints_), 1) + np.concatenate(what))
        return pairs // max(len(self.prints_), 1), pairs % max(len(self.prints_), 1)

    def align(self, cases: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]) -> list[tuple[float, int, int, int, int, int, float, int]]:
        """The best local alignment of each (item, words of a document, windows in the item, windows in the words): score, first and last word
        (one past) in the item and in the document, words matched, weight matched, the longest run of words matched one after the other.

        Small cases are done together, as many as make `cells` cells; a large one by itself, in a band along its windows.
        """
        s, out = self.s, [None] * len(cases)
        size = lambda c: (len(self.items[cases[c][0]]), len(cases[c][1]))
        part: list[int] = []
        n = m = 0
        for c in sorted(range(len(cases)), key=size):
            a, b = size(c)
            if min(a, b) > 2 * s.band:
                out[c] = self.align_band(*cases[c])
                continue
            if part and (len(part) + 1) * (max(n, a) + 1) * (max(m, b) + 1) > s.cells:
                self.align_part(cases, part, n, m, out)
                part, n, m = [], 0, 0
            part.append(c)
            n, m = max(n, a), max(m, b)
        if part:
            self.align_part(cases, part, n, m, out)
        return out

    def align_part(self, cases: list[tuple], part: list[int], n: int, m: int, out: list) -> None:
        """Cases of at most n words of an item and m of a document, in whole tables."""
        s = self.s
        a, b = np.full((len(part), n), -1, np.int32), np.full((len(part), m), -2, np.int32)
        for r, c in enumerate(part):
            a[r, : len(self.items[cases[c][0]])] = self.items[cases[c][0]]
            b[r, : len(cases[c][1])] = cases[c][1]
        wa = np.where(a > 0, self.weight[a], 0.5).astype(np.float32)
        h = np.zeros((len(part), n + 1, m + 1), np.float32)
        gaps = (s.added * np.arange(m + 1)).astype(np.float32)
        for i in range(1, n + 1):
            w = wa[:, i - 1, None]
            diagonal = h[:, i - 1, :-1] + np.where(b == a[:, i - 1, None], w, -s.unlike * np.maximum(w, 0.25))
            row = np.maximum(0, np.maximum(diagonal, h[:, i - 1, 1:] - s.left_out * np.maximum(w, 0.2)))
            h[:, i, 1:] = np.maximum.accumulate(row + gaps[1:], axis=1) - gaps[1:]
        best = h.reshape(len(part), -1).argmax(axis=1)
        for r, c in enumerate(part):
            out[c] = self.trace(lambda i, j, r=r: h[r, i, j], a[r], wa[r], b[r], *divmod(int(best[r]), m + 1))

    def align_band(self, item: int, words_: np.ndarray, at_item: np.ndarray, at_words: np.ndarray) -> tuple[float, int, int, int, int, int, float, int]:
        """One case in a band of 2 * band + 1 words of the document along the line through its windows."""
        s, a, b = self.s, self.items[item], words_
        n, m, wide = len(a), len(b), 2 * self.s.band + 1
        order = np.argsort(at_item, kind="stable")
        places, first = np.unique(at_item[order], return_index=True)
        line = np.add.reduceat(at_words[order], first) / np.diff(np.r_[first, len(order)])
        # The line follows the median of the shifts around, as windows also match by chance elsewhere.
        line = places + np.median(np.lib.stride_tricks.sliding_window_view(np.pad(line - places, 50, mode="edge"), 101), axis=1)
        row_ = np.arange(n + 1)
        middle = np.interp(row_, places, line) + np.minimum(row_ - places[0], 0) + np.maximum(row_ - places[-1], 0)
        start = np.clip(np.maximum.accumulate(middle).astype(np.int64) - s.band, 0, max(m + 1 - wide, 0))
        wa = np.where(a > 0, self.weight[a], 0.5).astype(np.float64)
        # Column k of row i is word start[i] + k of the document; column 0 of the document is before its first word.
        h = np.zeros((n + 1, wide), np.float64)
        gaps = (s.added * np.arange(wide)).astype(np.float64)
        padded = np.r_[np.int32(-2), b, np.full(wide, -2, np.int32)]
        for i in range(1, n + 1):
            w, by = wa[i - 1], int(start[i] - start[i - 1])
            above = np.zeros(wide + 1, np.float64)
            held = h[i - 1, max(by - 1, 0) :][: wide + 1]
            above[(1 if by == 0 else 0) :][: len(held)] = held  # above[k]: the cell up and left of column k
            word = padded[start[i] : start[i] + wide]
            diagonal = above[:-1] + np.where(word == a[i - 1], w, -s.unlike * max(w, 0.25))
            row = np.maximum(0, np.maximum(diagonal, above[1:] - s.left_out * max(w, 0.2)))
            row[(start[i] + np.arange(wide) < 1) | (start[i] + np.arange(wide) > m)] = 0
            h[i] = np.maximum.accumulate(row + gaps) - gaps

        def cell(i: int, j: int) -> float:
            k = j - start[i]
            return h[i, k] if 0 <= k < wide else 0.0

        i, k = divmod(int(h.argmax()), wide)
        return self.trace(cell, a, wa, b, i, int(k + start[i]))

    def trace(self, h, a: np.ndarray, wa: np.ndarray, b: np.ndarray, i: int, j: int) -> tuple[float, int, int, int, int, int, float, int]:
        """The alignment that ends in cell (i, j) of h."""
        s, score = self.s, float(h(i, j))
        i1, j1, matched, weight, run, longest = i, j, 0, 0.0, 0, 0
        if score >= s.piece_score:
            while i and j and h(i, j) > 1e-4:
                w, same = float(wa[i - 1]), a[i - 1] == b[j - 1]
                v = h(i, j)
                if abs(v - (h(i - 1, j - 1) + (w if same else -s.unlike * max(w, 0.25)))) < 1e-3:
                    matched, weight, i, j = matched + bool(same), weight + w * bool(same), i - 1, j - 1
                    run = run + 1 if same else 0
                    longest = max(longest, run)
                elif abs(v - (h(i, j - 1) - s.added)) < 1e-3:
                    j, run = j - 1, 0
                else:
                    i, run = i - 1, 0
        return score, i, i1, j, j1, matched, weight, longest

    def pieces(self, codes: np.ndarray, bounds: np.ndarray) -> dict[tuple[int, int], list[tuple]]:
        """For many documents end to end (bounds: where each begins, and the end): (document, item) -> verified pieces."""
        s, found = self.s, defaultdict(list)
        if len(codes) < s.window or not len(self.prints_):
            return found
        at, win = self.hits(codes)
        doc = np.searchsorted(bounds, at, "right") - 1
        inside = at + s.window <= bounds[doc + 1]
        at, win, doc = at[inside], win[inside], doc[inside]
        item, i = self.item[win], self.at[win]
        weight = self.weight[codes]
        cum = np.r_[0, np.cumsum(weight)]
        while len(at):
            order = np.lexsort((at, item, doc))
            at, item, doc, i = at[order], item[order], doc[order], i[order]
            new = np.r_[True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (at[1:] - at[:-1] > 40)]
            first = np.flatnonzero(new)
            last = np.r_[first[1:], len(at)] - 1
            group = np.cumsum(new) - 1
            # Evidence of a candidate: the weight of the item's words under its windows, each word once.
            cover = np.bincount(group, minlength=len(first))
            span = cum[at[last] + s.window] - cum[at[first]]
            steps = np.zeros(len(first), np.int64)
            width = int(i.max()) + 1
            np.add.at(steps, np.unique(group * width + i) // width, 1)
            strong = cover > 0
            if s.strict:
                strong &= (steps >= 3) | ((steps >= 2) & (span >= s.pair_weight)) | (span / np.maximum(at[last] - at[first] + s.window, 1) * s.window >= s.dense_weight)
            keep = strong[group]
            chosen = np.flatnonzero(strong)
            cases, spots = [], []
            for g in chosen:
                k, f, e = int(item[first[g]]), int(first[g]), int(last[g])
                size = len(self.items[k])
                i_lo, i_hi = int(i[f : e + 1].min()), int(i[f : e + 1].max())
                lo = max(int(bounds[doc[f]]), int(at[f]) - int(1.3 * i_lo) - 8)
                hi = min(int(bounds[doc[f] + 1]), int(at[e]) + s.window + int(1.3 * (size - i_hi)) + 8)
                cases.append((k, codes[lo:hi], i[f : e + 1], at[f : e + 1] - lo))
                spots.append((f, lo))
            done = np.zeros(len(at), bool)
            for g, (f, lo), (score, i0, i1, j0, j1, matched, wt, run) in zip(chosen, spots, self.align(cases)):
                e = int(last[g]) + 1
                if score < s.piece_score or i1 - i0 < s.piece_words - 1:
                    done[f:e] = True
                    continue
                full = float(self.weight[self.items[int(item[f])][i0:i1]].sum())
                piece = (lo + j0, lo + j1, i0, i1, score, matched, wt, full, run)
                if wt / max(full, 1e-6) >= s.min_share:
                    found[(int(doc[f]), int(item[f]))].append(piece)
                    hit = (at[f:e] + s.window > lo + j0) & (at[f:e] < lo + j1)
                    done[f:e] = hit if hit.any() else True
                else:
                    done[f:e] = True
            keep &= ~done
            at, item, doc, i = at[keep], item[keep], doc[keep], i[keep]
        return found

    def verdict(self, pieces: list[tuple]) -> tuple[bool, int, float]:
        """Whether pieces make a case; words of the item and score of the best chain in the item's and the document's order."""
        pieces = sorted(set(pieces))
        best: list[tuple[float, int]] = []
        for k, p in enumerate(pieces):
            score, n = p[4], p[3] - p[2]
            more = [(best[j][0] + score, best[j][1] + n) for j, q in enumerate(pieces[:k]) if q[1] <= p[0] + 2 and q[3] <= p[2] + 3 and p[3] - p[2] >= self.s.piece_words and q[3] - q[2] >= self.s.piece_words]
            best.append(max([(score, n), *more], key=lambda x: x[1]))
        score, n = max(best, key=lambda x: x[1])
        return n >= self.s.min_words and score >= self.s.min_score, n, score


def leaked_passages(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, lang: str | None = None, settings: Settings | None = None) -> DataFrame:
    """doc_id, item_id, n_words (of the item), n_run (the most of them in a run, word for word), score: one row for each document and item with a case."""
    s = settings or Settings()
    rows = items.select(F.col(item_id).alias("i"), (F.col(lang) if lang else F.lit("")).alias("g"), F.col(item_text).alias("t")).filter("t is not null")
    total = rows.agg(F.coalesce(F.sum(F.size(F.split("t", r"\s+"))), F.lit(0))).first()[0]
    slices = max(1, -(-int(total) // s.max_item_words))
    kinds = (docs.schema[doc_id].dataType.simpleString(), items.schema[item_id].dataType.simpleString())
    item_type = to_arrow_type(items.schema[item_id].dataType)
    out = None
    weights = docs.sparkSession.sparkContext.broadcast(count_words(rows) if slices > 1 else None)
    for k in range(slices):
        part = rows if slices == 1 else rows.filter(F.pmod(F.xxhash64("i", "t"), F.lit(slices)) == k)
        # At most max_item_words words come to the driver and go to the tasks.
        held = docs.sparkSession.sparkContext.broadcast(sorted(((r.i, r.g or "", r.t) for r in part.collect()), key=repr))

        def run(batches, held=held):
            index = Index(held.value, s, weights.value)
            get = index.code.get
            ids = pa.array(index.ids, item_type)
            for batch in batches:
                docs_, items_, sizes, runs, scores = [], [], [], [], []
                texts, at = batch.column(1), 0
                while at < len(texts):
                    codes, bounds, begin = [], [0], at
                    while at < len(texts) and len(codes) < 100_000:
                        value = texts[at].as_py()
                        if value:
                            codes.extend([get(w, 0) for w in words(value)])
                        bounds.append(len(codes))
                        at += 1
                    for (d, i), pieces in index.pieces(np.array(codes, np.int32), np.array(bounds)).items():
                        case, n, score = index.verdict(pieces)
                        if case:
                            docs_.append(begin + d)
                            items_.append(i)
                            sizes.append(n)
                            runs.append(max(p[8] for p in pieces))
                            scores.append(score)
                found = ids.take(pa.array(items_, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(docs_, pa.int32())), found, pa.array(sizes, pa.int32()), pa.array(runs, pa.int32()), pa.array(scores, pa.float64())], names=["d", "i", "n_words", "n_run", "score"])

        told = docs.select(F.col(doc_id).alias("d"), F.col(text).alias("t")).filter("t is not null").mapInArrow(run, f"d {kinds[0]}, i {kinds[1]}, n_words int, n_run int, score double")
        out = told if out is None else out.unionByName(told)
    return out.select(F.col("d").alias(doc_id), F.col("i").alias(item_id), "n_words", "n_run", "score")
