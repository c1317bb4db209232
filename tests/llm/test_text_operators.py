"""Alignment, packing, leaks and spam on small fixtures and against plain versions."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stichos.llm import alignment, leaks, packing, spam

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
NOUNS = [f"w{c}{v}{d}" for c in "bdfgklmnprst" for v in "aeiou" for d in "nrst"]


def letters(w):
    return "".join(c if not c.isdigit() else "" for c in w)


def passage(r, n):
    return [r.choice(NOUNS) for _ in range(n)]


# Leaks.


def test_blocks_find_every_fingerprint_within_the_radius():
    r = random.Random(1)
    items = [(k, "en", " ".join(passage(r, 40))) for k in range(20)]
    ix = leaks.Index(items, leaks.Settings())
    text = [ix.code.get(w, 0) for k in range(20) for w in [*items[k][2].split()[5:25], *passage(r, 30)]]
    codes = np.array(text, np.int32)
    at, win = ix.hits(codes)
    prints, weight = ix.prints(codes)
    known = np.convolve(codes > 0, np.ones(5, int), "valid")
    want = {(i, j) for i in range(len(prints)) if known[i] >= 4 and weight[i] >= 0.9 for j in range(len(ix.prints_)) if bin(int(prints[i] ^ ix.prints_[j])).count("1") <= 3}
    assert set(zip(at.tolist(), win.tolist())) == want and len(want) >= 20 * 16


def documents(r):
    item = passage(r, 60)
    other = passage(r, 60)
    changed = [w if r.random() > 0.12 else r.choice(NOUNS) for w in item[10:50]]
    shuffled = item[:30]
    r.shuffle(shuffled)
    noise = lambda n: passage(r, n)
    docs = {
        1: " ".join(noise(50) + item[20:40] + noise(50)), 2: " ".join(noise(30) + changed + noise(10)), 3: " ".join(noise(40) + item[:8] + noise(40)), 4: " ".join(noise(20) + shuffled + noise(20)),
        5: " ".join(item[0:18] + noise(80) + item[20:38]), 6: "\n".join(f"{k} {w}" if k % 4 else f"{w[:2]}-\n{w[2:]}" for k, w in enumerate(item[5:35])), 7: None, 8: "", 9: "   ", 10: " ".join(other[:30]).upper(), 11: " ".join(noise(30000) + item[20:45] + noise(30000)),
    }
    return item, other, docs


def test_leaks(spark):
    item, other, docs = documents(random.Random(2))
    d = spark.createDataFrame([(k, v, "x") for k, v in docs.items()] + [(1, docs[1], None)], "doc_id long, text string, item_id string")
    i = spark.createDataFrame([(7, "en", " ".join(item)), (8, "en", " ".join(other)), (9, None, None), (10, "en", ""), (11, "en", " ".join(item))], "item_id long, lang string, text string")
    got = {(r.doc_id, r.item_id) for r in leaks.leaked_passages(d, "doc_id", "text", i, "item_id", "text", "lang").collect()}
    assert got == {(k, j) for k in (1, 2, 5, 6, 11) for j in (7, 11)} | {(10, 8)}
    few = leaks.Settings(max_item_words=50)
    assert {(r.doc_id, r.item_id) for r in leaks.leaked_passages(d, "doc_id", "text", i, "item_id", "text", "lang", few).collect()} >= {(1, 7), (10, 8)}
    assert leaks.leaked_passages(d.limit(0), "doc_id", "text", i, "item_id", "text", "lang").count() == 0
    assert leaks.leaked_passages(d, "doc_id", "text", i.limit(0), "item_id", "text", "lang").count() == 0


def test_slices_change_no_result(spark):
    item, other, docs = documents(random.Random(2))
    r = random.Random(3)
    d = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    rows = [(7, "en", " ".join(item)), (8, "en", " ".join(other)), (9, None, None), (10, "en", ""), (11, "en", " ".join(item)), (12, None, " ".join(passage(r, 40)))] + [(20 + k, "grc", " ".join(passage(r, 40))) for k in range(6)]
    i = spark.createDataFrame(rows, "item_id long, lang string, text string")
    run = lambda s: sorted((x.doc_id, x.item_id, x.n_words, round(x.score, 4)) for x in leaks.leaked_passages(d, "doc_id", "text", i, "item_id", "text", "lang", s).collect())
    assert run(leaks.Settings(max_item_words=50)) == run(leaks.Settings()) != []


def test_banded_alignment_is_the_whole_one():
    """Long enough to need the band, with words changed, left out and added, and a stretch of other text before and after."""
    r = random.Random(14)
    item = passage(r, 700)
    ix = leaks.Index([(1, "en", " ".join(item))], leaks.Settings(band=100))
    doc = []
    for w in item[40:660]:
        doc += [] if r.random() < 0.04 else [r.choice(NOUNS)] if r.random() < 0.06 else [w, *(["zz"] if r.random() < 0.04 else [])]
    codes = np.array([ix.code.get(w, 0) for w in passage(r, 120) + doc + passage(r, 150)], np.int32)
    at, win = ix.hits(codes)
    near = np.abs(at - win - 100) < 90
    case = (0, codes, ix.at[win[near]], at[near])
    whole: list = [None]
    ix.align_part([case], [0], len(item), len(codes), whole)
    assert ix.align([case])[0] == pytest.approx(whole[0], abs=1e-2) and whole[0][5] > 500


def test_a_long_item_is_aligned_in_bounded_space():
    import tracemalloc

    r = random.Random(15)
    item = passage(r, 20_000)
    ix = leaks.Index([(1, "en", " ".join(item))], leaks.Settings())
    codes = np.array([ix.code.get(w, 0) for w in passage(r, 500) + [w for w in item if r.random() > 0.03] + passage(r, 500)], np.int32)
    tracemalloc.start()
    found = ix.pieces(codes, np.array([0, len(codes)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert ix.verdict(found[(0, 0)])[0] and max(p[3] - p[2] for p in found[(0, 0)]) > 19_000 and peak < 1 << 30


def test_plain_words():
    assert leaks.words("\\add The\\add* μῆ͂νιν par-\ndoned <i>x</i> 3:4 \\f + \\ft Or, y.\\f* ΛΟΓΟΣ") == ["the", "μηνιν", "pardoned", "x", "λογοσ"]


# Packing.


@pytest.mark.parametrize("merge_rows", [200_000, 2])
def test_packing(spark, merge_rows):
    r = random.Random(4)
    texts = [None, "", " ", *[" ".join(passage(r, r.choice([1, 5, 30, 60, 200]))) for _ in range(120)]]
    rows = [(k % 100, t, "x") for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, piece string").repartition(6)
    cap = 256
    got = packing.pack(df, "doc_id", "text", TOKENIZER, cap, windows=4, merge_rows=merge_rows).collect()
    count = packing.tokenizer(TOKENIZER)
    sizes = count([t or "" for t in texts])
    want = sorted(min(cap, n - p * cap) for n in sizes for p in range(max(1, -(-n // cap))))
    assert sorted(g.n_tokens for g in got) == want
    boxes = {}
    for g in got:
        assert (g.container is None) == (g.n_tokens == 0) and (g.piece == 0 or g.n_tokens)
        if g.container is not None:
            boxes.setdefault(g.container, []).append((g.token_at, g.n_tokens))
    for box in boxes.values():
        at = 0
        for start, n in sorted(box):
            assert start == at
            at += n
        assert at <= cap
    if merge_rows > 2:
        assert len(boxes) <= 1.1 * sum(sizes) / cap + 2
    assert packing.pack(df.limit(0), "doc_id", "text", TOKENIZER, cap).count() == 0


def test_audit_sees_what_is_wrong(spark):
    rows = [(1, 0, 10, 2, 0), (1, 1, 3, 4, 0), (2, 0, 7, 4, 3), (3, 0, 0, None, None)]
    schema = "doc_id long, piece int, n_tokens int, container long, token_at int"
    told = lambda x: tuple(packing.audit(spark.createDataFrame(x, schema), "doc_id", 10, 0.1).first())
    assert told(rows) == (3, 1, 0, 0, 0, True)
    assert told([*rows, (4, 0, 1, 4, 9)]) == (4, 1, 1, 1, 0, True)
    assert told([(1, 0, 9, 2, 0), (1, 1, 3, 4, 0), (5, 1, 1, 6, 0)]) == (2, 0, 0, 0, 2, False)
    assert told([]) == (0, 0, 0, 0, 0, True)


def test_packer_is_best_fit_and_bounded():
    p = packing.Packer(10, 2)
    assert [p.put(n) for n in (6, 7, 3, 4, 5, 9)] == [(0, 0, None), (1, 0, None), (1, 7, None), (0, 6, None), (2, 0, None), (3, 0, None)]
    assert p.put(8) == (4, 0, 3) and len(p.open) == 2


# Spam.


def prose(r, n):
    return " ".join(f"The {r.choice(NOUNS)} of the {r.choice(NOUNS)} gave his {r.choice(NOUNS)} to {r.choice(NOUNS)}, and she {r.choice(NOUNS)} it." for _ in range(n))


def test_spam(spark):
    r = random.Random(6)
    link = lambda: f"https://{r.choice(NOUNS)}.test/{r.choice('ab')}-lamp.html"
    spam_ = ["cheap lamp online " * 60, "\n".join(link() for _ in range(40)), "lamp shop, " * 50, " | ".join(["Lamp Sale", "Buy Lamp"] * 30), "πύλη\nλύχνος\n" * 60]
    fine = [prose(r, 12) for _ in range(60)] + ["And Bel was the father of Kor. And Kor was the father of Nim, and Nim lived 40 years. " * 8, prose(r, 10) + "\n\n" + "\n".join(link() for _ in range(4)), "", " ", None, "lamp lamp", "\\add\\add*", "\x00", prose(r, 900)]
    rows = [(k, t, 0.5) for k, t in enumerate(spam_ + fine)] + [(0, spam_[0], 0.5), (1000, spam_[0], None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ratio double")
    assert {x.doc_id for x in spam.spam_pages(df, "doc_id", "text").collect()} == {*range(len(spam_)), 1000}
    assert spam.spam_pages(df.limit(0), "doc_id", "text").count() == 0


@pytest.mark.parametrize("templated", [False, True])
def test_spam_that_rules_its_lengths(spark, templated):
    """A third of all rows is one stuffed text, or a source that fills in one template."""
    r = random.Random(9)
    stuffed = lambda: " ".join(f"Cheap lamp shop {r.choice(NOUNS)}. Buy a cheap lamp in the lamp shop today, cheap lamp sale for your home." for _ in range(30))
    one = stuffed()
    fine = [prose(r, 3) for _ in range(80)]
    spam_ = [stuffed() if templated else one for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(spam_ + fine)), "doc_id long, text string")
    assert {x.doc_id for x in spam.spam_pages(df, "doc_id", "text").collect()} == set(range(40))


def test_verse_without_full_stops_is_not_spam(spark):
    """Verse in a language with no label of its own; the lines repeat a small vocabulary, but each is a line of running words."""
    r = random.Random(12)
    names, kinds, does = "Haus Baum Himmel Garten Vogel Licht Stein Wasser Feld Wind".split(), "alte stille helle dunkle ferne tiefe".split(), "singt liegt weht ruht leuchtet".split()
    verse = lambda end: "\n".join(f"{r.choice(['und', 'doch', 'wo'])} der {r.choice(kinds)} {r.choice(names)} {r.choice(['über', 'unter'])} dem {r.choice(names)} {r.choice(does)}{end}" for _ in range(24))
    rows = [(k, verse("." if k % 2 else ""), None) for k in range(10)] + [(100 + k, prose(r, 12), r.choice(["en", "EN-gb"])) for k in range(40)] + [(200, "Lampe kaufen " * 80, "de"), (201, verse(""), None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {x.doc_id for x in spam.spam_pages(df, "doc_id", "text", "lang").collect()} == {200}


def test_languages_are_told_from_the_text(spark):
    r = random.Random(13)
    greek = lambda: " ".join("".join(r.choice("αβγδεικλμνοπρστω") for _ in range(r.randint(2, 8))) for _ in range(60))
    rows = [(k, prose(r, 6) if k % 2 else greek(), ["grc", "En "][k % 2]) for k in range(80)] + [(100, greek(), "en"), (101, None, "en"), (102, "x", None), (103, greek(), "mul"), (104, prose(r, 2), "xx")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    table = spam.language_model(df, "doc_id", "text", "lang", 1000)
    assert table.shape == (1, 1 << 16)
    assert [spam.measure(t, table)[6] for t in (prose(r, 3), greek(), "", "z")] == [0, 1, 0, 0]
    assert spam.language_model(df.filter("lang = 'grc'"), "doc_id", "text", "lang", 1000) is None
    assert spam.language_model(df.limit(0), "doc_id", "text", "lang", 1000) is None


def test_blocks_keep_the_whole_text():
    r = random.Random(7)
    for text in (prose(r, 40), "a" * 5000, "x\n\ny\n\n" * 300, prose(r, 3).replace(". ", ".\n")):
        assert "".join("".join(spam.blocks(text)).split()) == "".join(text.split())


# Alignment.


def corpus(spark, chapters=3, hot=False):
    """Invented source words src<w>, their target w, lines moved, joined, divided, left out and added."""
    r = random.Random(8)
    src, tgt, want = [], [], set()
    sid, tid = 1, 1_000_000
    nouns = [w for w in NOUNS]
    for c in range(1, chapters + 1):
        n = 500 if hot and c == 1 else 24
        lines = [passage(r, 5) for _ in range(n)]
        plan, k = [], 0
        while k < n:
            what = r.choice(["one"] * 8 + ["join", "split", "drop", "add"])
            if what == "join" and k + 1 < n:
                plan.append(([k, k + 1], lines[k] + lines[k + 1], k))
                k += 2
                continue
            if what == "split":
                plan += [([k], lines[k][:3], k), ([k], lines[k][3:], k)]
            elif what == "add":
                plan += [([k], lines[k], k), ([], [f"zz{v}q" for v in "aei"] + ["zzuq"], k)]
            elif what == "one":
                plan.append(([k], lines[k], k))
            k += 1
        for i in range(3, len(plan) - 1, 11):
            plan[i], plan[i + 1] = plan[i + 1], plan[i]
        for k, ws in enumerate(lines):
            src.append((sid + k, "b", c, k // 2 + 1, k % 2 + 1, " ".join("σ" + w for w in ws), None, "x"))
        for i, (of, ws, k) in enumerate(plan):
            tgt.append((tid, "b", c, k // 2 + 1, i + 1, "The " + " ".join(ws) + "\\f + \\ft Or, q.\\f*.", None, "y"))
            want |= {(sid + j, tid) for j in of}
            tid += 1
        sid += n
    src += [(sid, "b", None, 1, 1, "σx", None, "x"), (sid + 1, "only", 1, 1, 1, "σx", None, "x"), src[0], (sid + 2, "b", 1, 1, 9, None, None, "x")]
    tgt += [(tid, "b", 1, None, 1, "", None, "y"), (tid + 1, "b", 1, 1, 99, None, None, "y"), tgt[0]]
    schema = "line_id long, slug string, chapter int, verse int, line_no int, text string, loaded_at timestamp, core string"
    words = [("σ" + w, "λ" + w) for w in nouns]
    gloss = [("λ" + w, w if k % 3 else f" {w.upper()} ") for k, w in enumerate(nouns)] + [("λx", None)]
    make = spark.createDataFrame
    return make(src, schema), make(tgt, schema), make(words, "form string, lemma string"), make(gloss, "lemma string, gloss string"), want


@pytest.mark.parametrize("hot", [False, True])
def test_alignment(spark, hot):
    src, tgt, words, gloss, want = corpus(spark, hot=hot)
    got = {tuple(r) for r in alignment.aligned_lines(src, tgt, words, gloss, lines=100).collect()}
    right = len(got & want)
    assert right / len(got) > 0.95 and right / len(want) > 0.95
    assert alignment.aligned_lines(src.limit(0), tgt, words, gloss).count() == 0
    assert alignment.aligned_lines(src, tgt.limit(0), words, gloss).count() == 0


def test_a_joined_lexicon_is_the_same(spark):
    """With no room for a lexicon in the tasks, forms and entries are joined."""
    src, tgt, words, gloss, _ = corpus(spark)
    one, two = ({tuple(r) for r in alignment.aligned_lines(src, tgt, words, gloss, max_entries=n).collect()} for n in (500_000, 0))
    assert one == two


def test_windows_reach_lines_with_no_verse_and_lines_moved_far(spark):
    """A chapter in windows: sources and targets with a null verse, and lines moved far, pair as the others do."""
    r = random.Random(10)
    n = 300
    lines = [r.sample(NOUNS, 5) for _ in range(n)]
    lost = {150, 200, 280}
    moved = {k: n - k for k in (20, 40, 60)}  # stand in a far verse
    schema = "line_id long, slug string, chapter int, verse int, line_no int, text string, loaded_at timestamp"
    src = spark.createDataFrame([(k, "b", 1, None if k in (100, 260) else k + 1, 1, " ".join("σ" + w for w in ws), None) for k, ws in enumerate(lines)], schema)
    tgt = spark.createDataFrame([(1000 + k, "b", 1, None if k in lost else moved.get(k, k + 1), 2 if k in moved else 1, "The " + " ".join(ws), None) for k, ws in enumerate(lines)], schema)
    words = spark.createDataFrame([("σ" + w, "λ" + w) for w in NOUNS], "form string, lemma string")
    gloss = spark.createDataFrame([("λ" + w, w) for w in NOUNS], "lemma string, gloss string")
    got = {tuple(x) for x in alignment.aligned_lines(src, tgt, words, gloss, lines=60).collect()}
    assert {(k, 1000 + k) for k in lost | set(moved) | {100, 260}} <= got
    assert len(got & {(k, 1000 + k) for k in range(n)}) >= 0.98 * n and len(got) <= 1.02 * n


def test_the_middle_line_of_a_state_is_paired():
    """Three lines joined; the middle one has no known word."""
    w = [f"w{k}" for k in range(12)]
    sources = [{w[0]: 1.0, w[1]: 1.0, w[2]: 1.0}, {}, {w[3]: 1.0, w[4]: 1.0, w[5]: 1.0}, {w[6]: 1.0, w[7]: 1.0, w[8]: 1.0}]
    sizes, unknown = [3.0, 2.0, 3.0, 3.0], [0.0, 2.0, 0.0, 0.0]
    targets = [[*w[:3], "zza", "zzb", *w[3:6]], w[6:9]]
    assert alignment.Model().decode(sources, sizes, unknown, targets, ([1, 2, 3, 4], [1, 4])) == [(0, 0), (1, 0), (2, 0), (3, 1)]
    assert alignment.Model().search(sources, sizes, unknown, targets[:1])[0][1] == [0, 1, 2]


def test_names_are_spelled():
    assert alignment.spelled("Θογουκον") == "thogukon" and alignment.spelled("Ἀβραάμ") == "abraam"


def test_tokens(spark):
    df = spark.createDataFrame([("\\add The\\add* king\\f + \\ft Or, x.\\f* didn't—go.",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(alignment.tokens(F.col("t"))).collect()] == [["the", "king", "didn't", "go"], None, []]


def test_tokenizer_path_is_a_parameter():
    assert packing.tokenizer(os.environ.get("STICHOS_TOKENIZER", TOKENIZER))(["a b", ""])[1] == 0
