"""Text functions, file scans, rendering and the segmentation on hand-made fixtures."""

import unicodedata

import pytest
from pyspark.sql import functions as F

from stichos.functions import text as X
from stichos.operators import align, gates, render, segment
from stichos.plans import corpus
from stichos.sources import files, sinks


def one(spark, expr, *values):
    df = spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(expr(*[F.col(f"c{i}") for i in range(len(values))])).first()[0]


@pytest.mark.parametrize(
    "f, given, want",
    [
        (X.strip, "  a b \n", "a b"), (X.squeeze, " a \t\n b ", "a b"), (X.squeeze, "", ""), (X.strip, None, None), (X.alnum_form, "Æ a-B 9", "ab9"), (X.alnum_form, None, ""), (X.greek_form, "Λόγος, x᾿", "λόγος᾿"),
        (X.html_escape, "<a & 'b\">", "&lt;a &amp; &#x27;b&quot;&gt;"), (lambda c: X.marked_line(c, X.ENGLISH_MARKS, True), "it's", 'it&#x27<span class="punct">;</span>s'),
        (lambda c: X.marked_line(c, X.ENGLISH_MARKS), "it's", 'it<span class="punct">&#x27;</span>s'), (lambda c: X.verse_markers(c, F.lit(3)), "a¹² b", 'a<sup class="verse-marker" id="v-3-12-inline">¹²</sup> b'),
        (lambda c: X.ref_part(c, 3), "GEN_1.12", "12"), (lambda c: X.ref_part(c, 3), "gen_1.12", None), (X.misc_ref, "SpaceAfter=No|Ref=GEN_1.2", "GEN_1.2"), (X.misc_ref, "_", ""),
        (lambda c: X.feature(c, "Person"), "Number=Sing|Person=1|Person=3", "Person=3"), (lambda c: X.feature(c, "Person"), None, ""),
        (X.clean_markup, r"\x + \xo 2:1 \xt Acts 4.\x* Why \add did\add* they\f + \fr 1 \ft Or, x.\f* go \sc A\sc* \zz", "Why did they go A"), (X.clean_markup, None, None),
    ],
)
def test_text(spark, f, given, want):
    assert one(spark, f, given) == want


def test_nfc_pads_percent(spark):
    raw = unicodedata.normalize("NFD", "ἀρχῇ")
    assert one(spark, X.nfc, raw) == unicodedata.normalize("NFC", raw)
    df = spark.createDataFrame([(7, 0, 3), (123, 4, 1)], "a int, n int, k int")
    assert [tuple(r) for r in df.select(X.padded(F.col("a")), X.percent(F.col("k"), F.col("n"))).collect()] == [("07", 0.0), ("123", 25.0)]


def test_finite(spark):
    rows = [("VERB", "VerbForm=Part"), ("VERB", None), ("AUX", ""), ("NOUN", "VerbForm=Fin"), (None, None), ("VERB", "VerbForm=Inf|VerbForm=Fin")]
    got = [r[0] for r in spark.createDataFrame(rows, "u string, m string").select(X.finite(F.col("u"), F.col("m"))).collect()]
    assert got == [False, True, True, True, False, True]


def text_file(tmp_path, name, body):
    p = tmp_path / name
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_text(body, encoding="utf-8", newline="")
    return str(p)


def test_sense_line_files(spark, tmp_path):
    text_file(tmp_path, "01-book/1book-two-03.txt", "stray\n3:1\n\n first\r\n\nsecond\n\n3:2\nold\n3:2\nnew\n\n")
    lines = files.discover(files.file_lines(spark, f"{tmp_path}/*/*.txt"))
    assert {(r.slug, r.file_chapter) for r in lines.collect()} == {("1book-two", 3)}
    got = [(r.chapter, r.verse, r.line_no, r.text) for r in files.sense_line_rows(lines).orderBy("verse", "line_no").collect()]
    assert got == [(3, 1, 1, ""), (3, 1, 2, "first"), (3, 1, 3, ""), (3, 1, 4, "second"), (3, 2, 1, "new")]


def test_conllu_files(spark, tmp_path):
    row = lambda *c: "\t".join(c)
    text = [
        "# sent_id = s1", "# text = x", row("1-2", "x", "_", "_", "_", "_", "_", "_", "_", "_"), row("1", "α", "_", "_", "_", "_", "_", "root", "_", "Ref=GEN_1.1"), row("2", "β", "b", "NOUN", "N", "A=B", "1", "obj", "_", "SpaceAfter=No|Ref=GEN_1.2"),
        row("2.1", "x", "_", "_", "_", "_", "_", "_", "_", "_"), row("3", "short"), "", row("1", "γ", "g", "VERB", "V", "_", "0", "root", "_", "_"),
    ]
    text_file(tmp_path, "a.conllu", "\n".join(text))
    t = files.conllu_tokens(files.file_lines(spark, f"{tmp_path}/a.conllu")).orderBy("line_no").collect()
    assert [(r.sent_no, r.local_id, r.form, r.lemma, r.upos, r.morph, r["head"], r.after_text, r.is_root, r.book_code, r.verse, r.pos) for r in t] == [
        (0, 1, "α", "α", "X", "", 0, " ", 1, "GEN", 1, 1), (0, 2, "β", "b", "NOUN", "A=B", 1, "", 0, "GEN", 2, 1), (1, 1, "γ", "g", "VERB", "", 0, " ", 1, None, None, None),
    ]
    assert t[0].sent_id == "s1"


def test_usfm_files(spark, tmp_path):
    body = "\\id GEN\n\\c 1\nlost\n\\p\n\\v 1 In \\add the\\add* start\nwrapped\\f + \\ft n.\\f*\n\\p And inline\n\\s Heading\n\\v 2 two\n\\v 2a sub\ncontinued\n\\v 3 \\nd\\nd*\n\\c 2\n\\v 1 first\n\\v 1 second\n"
    text_file(tmp_path, "a.usfm", body)
    got = {(r.chapter, r.verse): r.text for r in files.usfm_verses(files.file_lines(spark, f"{tmp_path}/a.usfm")).collect()}
    assert got == {(1, 1): "In the start wrapped And inline Heading", (1, 2): "two continued", (2, 1): "second"}


def test_candidates_and_sinks(spark, tmp_path):
    p = text_file(tmp_path, "c.json", '{"survivors": [{"chapter": "genesis-01", "ref": "1:2", "greek_left": "α β"}, {"chapter": "bad", "ref": "1:2"}, {"chapter": "ruth-02", "ref": null}]}')
    assert [tuple(r) for r in files.break_candidates(spark, p).collect()] == [(0, "genesis", 1, 2, "α β")]
    rows = spark.createDataFrame([("01-a/a-01.txt", "1:1\nλ\n")], "name string, body string")
    assert sinks.write_named(rows, str(tmp_path / "out")) == 1 and (tmp_path / "out/01-a/a-01.txt").read_text() == "1:1\nλ\n"
    t = spark.createDataFrame([("GEN", 1, "α")], "book_code string, chapter int, form string")
    sinks.write_tokens(t, str(tmp_path / "tok"))
    back = files.graph_features(spark, str(tmp_path / "tok"), "form", "book_code")
    assert back.first().form == "α" and back.schema["form"].metadata["description"]


def test_alignment(spark):
    rows = [("a", 1, 1, 1, None), ("a", 1, 1, 2, "x"), ("a", 1, 1, 3, " "), ("a", 1, 2, 1, "y")]
    lines = spark.createDataFrame(rows, "slug string, chapter int, verse int, line_no int, text string")
    slots = align.line_slots(lines, ["slug", "chapter", "verse"], ["line_no"])
    assert sorted((r.verse, r.slot, r.text) for r in slots.collect() if r.text) == [(1, 1, "x"), (2, 0, "y")] and slots.count() == 3
    pairs = align.line_left_join(slots, slots.filter("verse = 2"), ["slug", "chapter", "verse"])
    assert sorted((r.verse, r.slot, r.left_text, r.right_text) for r in pairs.collect()) == [(1, 0, "", ""), (1, 1, "x", ""), (2, 0, "y", "y")]
    html = render.chapter_html(pairs, ["slug"], "chapter", "verse").first().html
    assert html.startswith('<div class="chapter" id="ch-1">\n  <div class="verse" id="v-1-1"><span class="verse-num">1:1</span>\n    <span class="line"><span class="grk"></span>') and html.endswith("\n</div>")
    rules = spark.createDataFrame([("a", 1, 1, None), ("a", 2, 9, -1)], "slug string, first int, last int, shift int")
    assert [r.verse for r in align.remap(lines, rules, ["slug"], "verse").collect()] == [1]
    cov = align.coverage(lines.withColumn("ok", F.col("text").isNotNull()), ["slug"], F.col("ok")).first()
    assert (cov.n_verses, cov.n_aligned, cov.percent) == (4, 3, 75.0)
    g = gates.gate(gates.compare_sides(lines.filter("verse=2"), lines.limit(0), ["slug"], "text"), "g", F.col("slug"), F.col("left_value") != F.col("right_value"))
    assert (g.first().checked, g.first().bad, gates.exit_code(g)) == (1, 1, 1)


WORDS = "sent_id string, local_id int, head int, book_code string, chapter int, verse int, pos int, form string, lemma string, upos string, morph string, udrel string, after_text string, loaded_at timestamp, extra string"


def sentence(spark, rows):
    """rows: (head, form, lemma, upos, morph, udrel[, verse])."""
    out, at = [], {}
    for i, r in enumerate(rows, 1):
        v = r[6] if len(r) > 6 else 1
        at[v] = at.get(v, 0) + 1
        out.append(("s", i, r[0], "GEN", 1, v, at[v], r[1], r[2], r[3], r[4], r[5], " ", None, "x"))
    return spark.createDataFrame(out, WORDS)


FIN, PART = "VerbForm=Fin|Person=3|Number=Sing", "VerbForm=Part"


@pytest.mark.parametrize(
    "rows, node, rule",
    [
        ([(0, "a", "a", "VERB", FIN, "root"), (1, "b", "b", "VERB", FIN, "parataxis")], 2, "parataxis"),
        ([(0, "a", "a", "VERB", FIN, "root"), (1, "b", "b", "VERB", PART, "advcl")], 2, "non_finite"),
        ([(2, "b", "b", "VERB", FIN, "advcl"), (0, "a", "a", "VERB", FIN, "root")], 1, "finite_before"),
        ([(0, "a", "a", "VERB", FIN, "root"), (1, "b", "b", "VERB", FIN, "advcl")], 2, "finite_after"),
        ([(0, "a", "a", "VERB", FIN, "root"), (3, "o", "ὅτι", "SCONJ", "", "mark"), (1, "b", "b", "VERB", FIN, "advcl")], 3, "causal_ground"),
        ([(0, "a", "λέγω", "VERB", FIN, "root"), (3, "o", "ὅτι", "SCONJ", "", "mark"), (1, "b", "b", "VERB", FIN, "advcl")], 3, "finite_after"),
        ([(0, "a", "a", "VERB", FIN, "root"), (3, "o", "ὅτι", "SCONJ", "", "mark"), (1, "b", "b", "VERB", FIN, "advcl"), (3, "N", "N", "PROPN", "", "nsubj")], 3, "finite_after"),
        ([(0, "a", "λέγω", "VERB", FIN, "root"), (1, "b", "b", "VERB", FIN, "ccomp")], 2, "quote"),
        ([(0, "a", "a", "VERB", FIN, "root"), (1, "b", "b", "VERB", FIN, "ccomp")], 2, "bound_relation"),
        ([(0, "a", "a", "VERB", FIN, "root"), (1, "b", "b", "NOUN", "", "conj")], 2, "conj_non_finite"),
        ([(0, "a", "a", "VERB", FIN, "root"), (1, "b", "b", "VERB", FIN, "conj"), (2, "c", "c", "NOUN", "", "nsubj")], 2, "conj_own_subject"),
        ([(0, "a", "a", "VERB", FIN, "root"), (1, "b", "b", "VERB", FIN, "conj")], 2, "conj_stands"),
        ([(0, "a", "a", "VERB", FIN, "root"), (1, "b", "b", "VERB", PART, "advcl"), (2, "c", "c", "VERB", FIN, "conj")], 3, "conj_inherits"),
        ([(0, "a", "a", "VERB", FIN, "root"), (1, "b", "b", "VERB", FIN, "ccomp"), (2, "c", "c", "VERB", "VerbForm=Fin|Person=1", "conj")], 3, "conj_stands"),
    ],
)
def test_bind_rules(spark, rows, node, rule):
    t = segment.tokens(sentence(spark, rows))
    got = {r.local_id: r.rule for r in segment.bind_rules(t, segment.chains(t)).collect()}
    assert got[node] == rule


@pytest.mark.parametrize("seed", [1])
def test_facts_of_buckets_are_those_of_joins(spark, seed):
    """Random sentences over several chapters, with cycles, missing heads, verbs of content and causal marks."""
    import random

    r = random.Random(seed)
    rels = ["root", "conj", "conj", "conj", "parataxis", "acl", "ccomp", "csubj", "xcomp", "advcl", "advcl", "nsubj", "mark", "obj", ""]
    rows = []
    for k in range(120):
        n, chapter, verse, pos = r.randint(1, 25), r.randint(1, 3), 1, 0
        for i in range(1, n + 1):
            step = r.random()
            chapter, verse, pos = (chapter + 1, 1, 1) if step < 0.05 else (chapter, verse + 1, 1) if step < 0.12 else (chapter, verse, pos + 1)
            head = r.choice([0, None, n + 3]) if r.random() < 0.12 else r.randint(1, n)
            rel = r.choice(rels)
            lemma = r.choice(["ὅτι", "a"]) if rel == "mark" else r.choice(["λέγω", "a", "b", None])
            rows.append((f"s{k}", i, head, r.choice("AB"), chapter, verse, k * 100 + pos, "f", lemma, r.choice(["VERB", "NOUN", "PROPN", "AUX", None]), r.choice([FIN, PART, "VerbForm=Fin|Person=1", "", None]), rel, " ", None, "x"))
    t = segment.tokens(spark.createDataFrame(rows, WORDS))
    fast, slow = segment.word_facts(t, rows_per_bucket=300), segment.word_facts(t, max_rows=0)
    names = ["sent_id", "local_id", "rule", "bind", "unit", "clause", "n_sub", "any_finite", "any_propn", "nested_finite"]
    a, b = (sorted(map(tuple, x.select(*names).collect())) for x in (fast, slow))
    assert a == b and {x[2] for x in a} >= {"quote", "causal_ground", "conj_inherits", "conj_stands", "conj_own_subject", "conj_non_finite", "finite_before", "finite_after", "non_finite"}
    said = segment.word_facts(t, content=F.col("lemma") == "b")
    assert said.filter("rule = 'quote'").count() and said.select(*names).exceptAll(fast.select(*names)).count()


def text_of(spark, rows, candidates=None):
    c = spark.createDataFrame(candidates, "cand_no long, book_code string, chapter int, verse int, greek_left string") if candidates else None
    return [(r.verse, r.text) for r in segment.segment(sentence(spark, rows), c).orderBy("line_no").collect()]


def test_sense_lines(spark):
    rows = [
        (2, "καὶ", "καί", "CCONJ", "", "cc"), (0, "ἦλθεν", "x", "VERB", FIN, "root"), (2, "ὁ", "ὁ", "NOUN", "", "nsubj"), (2, ",", ",", "PUNCT", "", "punct"),
        (2, "εἶδεν", "y", "VERB", FIN, "parataxis"), (5, "φῶς", "z", "NOUN", "", "obj"), (2, "τέλος", "t", "NOUN", "", "obl", 2), (None, ".", ".", "PUNCT", "", "", 2),
    ]
    assert text_of(spark, rows) == [(1, "καὶ ἦλθεν ὁ ,"), (1, "εἶδεν φῶς"), (2, "τέλος .")]
    cut = [(1, "GEN", 1, 1, "χ καὶ ἦλθεν"), (2, "GEN", 1, 1, "ὁ"), (3, "GEN", 1, 1, None), (None, "GEN", 1, 1, "ὁ")]
    assert text_of(spark, rows, cut)[0] == (1, "καὶ ἦλθεν")


def test_function_lines_fold(spark):
    rows = [(0, "δέ", "δέ", "PART", "", "root"), (0, "α", "α", "NOUN", "", "root"), (0, "γάρ", "γάρ", "PART", "", "root"), (0, "καὶ", "καί", "CCONJ", "", "root"), (0, "β", "β", "NOUN", "", "root"), (0, "καὶ", "καί", "CCONJ", "", "root")]
    assert text_of(spark, rows) == [(1, "δέ α γάρ"), (1, "καὶ β καὶ")]


def test_segment_empty(spark):
    assert segment.segment(spark.createDataFrame([], WORDS)).count() == 0


def test_safe_cast_takes_every_int(spark, tmp_path):
    cells = ["1", "1000000000", "2147483647", "2147483648", "000000000012", "1-2", "-3", "", "7\n"]
    spark.createDataFrame([(k, f"{c}\tx") for k, c in enumerate(cells)], "line_id long, raw string").write.parquet(f"{tmp_path}/conllu_raw.parquet")
    got = {r.line_id: r.number for r in corpus.safe_cast(spark, str(tmp_path)).collect()}
    assert [got[k] for k in range(len(cells))] == [1, 1000000000, 2147483647, None, 12, None, None, None, None]


def test_coverage_report_lists_refs_by_book(spark, tmp_path):
    schema = "line_id long, slug string, chapter int, verse int, line_no int, text string, loaded_at timestamp"
    greek = [(1, "b", 1, 1), (2, "b", 1, 2), (3, "b", 10, 1), (4, "b", 2, 1), (5, "a", 1, 1), (6, "c", 1, 1)]
    english = [(1, "b", 1, 1, "x"), (2, "b", 1, 2, " "), (3, "c", 1, 1, "y")]
    spark.createDataFrame([(*g, 1, "g", None) for g in greek], schema).write.parquet(f"{tmp_path}/grk_lines.parquet")
    spark.createDataFrame([(*e[:4], 1, e[4], None) for e in english], schema).write.parquet(f"{tmp_path}/eng_brenton_lines.parquet")
    (row,) = corpus.QUERIES["coverage_report"](spark, str(tmp_path)).collect()
    assert row.report == '{"tf_verses":6,"eng_aligned":2,"eng_mismatches_total":4,"eng_mismatches_by_book":{"a":["1:1"],"b":["1:2","2:1","10:1"]}}'


def test_console_text(spark):
    df = spark.createDataFrame([("GEN", 1, 2, 1, "c"), ("GEN", 1, 1, 2, "b"), ("GEN", 1, 1, 1, "a"), ("GEN", 1, 10, 1, None)], "book string, chapter int, verse int, line_no int, text string")
    got = render.console_text(df, ["book", "chapter"], "verse", ["line_no"], F.concat(F.lit("=== "), "book", F.lit(" "), F.col("chapter").cast("string"), F.lit(" ===")), F.concat(F.col("chapter").cast("string"), F.lit(":"), F.col("verse").cast("string")), "text").first()
    assert got.body == "=== GEN 1 ===\n\n1:1\n  a\n  b\n\n1:2\n  c\n\n1:10\n  \n"


def test_files_to_files(spark, tmp_path):
    """Treebank and translation files to the token table, text files and HTML; one book, one chapter, one layer."""
    from stichos.plans import pipelines

    def words(book, chapter, verse, *forms):
        return "\n".join(f"{i}\t{f}\t_\tNOUN\t_\t_\t{0 if i == 1 else 1}\t{'root' if i == 1 else 'obj'}\t_\tRef={book}_{chapter}.{verse}" for i, f in enumerate(forms, 1)) + "\n\n"

    (tmp_path / "ud").mkdir()
    (tmp_path / "ud" / "a.conllu").write_text("# sent_id = 1\n" + words("AAA", 1, 1, "α", "β") + "# sent_id = 2\n" + words("AAA", 1, 2, "γ") + "# sent_id = 3\n" + words("AAA", 10, 1, "δ"), encoding="utf-8")
    (tmp_path / "ud" / "b.conllu").write_text("# sent_id = 4\n" + words("BBB", 1, 1, "ε") + words("ZZZ", 1, 1, "ζ"), encoding="utf-8")
    (tmp_path / "usfm").mkdir()
    (tmp_path / "usfm" / "aa.usfm").write_text("\\id AAA\n\\c 1\n\\p\n\\v 2 One \\add two\\add*.\n\\v 3 Three\n\\c 10\n\\v 1 Ten\n", encoding="utf-8")
    books = spark.createDataFrame([(1, "AAA", "aa", "Alpha"), (2, "BBB", "bb", "Beta")], "book_no int, book_code string, slug string, book_name string")
    table, out, html = (str(tmp_path / k) for k in ("tokens", "out", "html"))
    pipelines.treebank(spark, f"{tmp_path}/ud/*.conllu", books, table)
    got = spark.read.parquet(table)
    assert got.count() == 5 and {r.book_name for r in got.collect()} == {"Alpha", "Beta"} and set(got.columns) == set(segment.C.TOKENS.names)
    rules = spark.createDataFrame([("aa", 1, 2, None, -1)], "slug string, chapter int, first int, last int, shift int")
    cover = {r.slug: (r.n_verses, r.n_aligned) for r in pipelines.content(spark, table, f"{tmp_path}/usfm/*.usfm", books, out, rules=rules).collect()}
    assert cover == {"aa": (3, 3), "bb": (1, 0)}
    assert (tmp_path / "out/grk/01-aa/aa-01.txt").read_text(encoding="utf-8") == "1:1\nα β\n\n1:2\nγ\n"
    assert (tmp_path / "out/eng/01-aa/aa-01.txt").read_text(encoding="utf-8") == "1:1\nOne two.\n\n1:2\nThree\n"
    assert (tmp_path / "out/eng/02-bb/bb-01.txt").read_text(encoding="utf-8") == "1:1\n\n"
    assert pipelines.books_html(spark, out, html) == 2
    page = (tmp_path / "html/aa.html").read_text(encoding="utf-8")
    assert page.index('id="ch-1"') < page.index('id="ch-10"') and '<span class="grk">γ</span><span class="en">Three</span>' in page
    assert pipelines.books_html(spark, out, str(tmp_path / "one"), slug="bb") == 1
    part = str(tmp_path / "part")
    pipelines.content(spark, table, None, books, part, book="aaa", chapter=10, layers=("grk",))
    assert sorted(str(p.relative_to(part)) for p in (tmp_path / "part").rglob("*.txt")) == ["grk/01-aa/aa-10.txt"]
    plan = pipelines.select_place(spark.read.parquet(table), "AAA", 1)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(book_code" in plan and "PushedFilters: [IsNotNull(chapter)" in plan
    with pytest.raises(ValueError):
        pipelines.content(spark, table, None, books, part, book="ccc")
    with pytest.raises(ValueError):
        pipelines.books_html(spark, out, html, slug="cc")


def test_lines_are_numbered_across_blocks(spark, tmp_path):
    text = "".join(f"line {k}\n" if k % 7 else "\r\n" for k in range(3000))
    (tmp_path / "a.txt").write_bytes(text.encode())
    (tmp_path / "b.txt").write_bytes(b"x\ny")
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        got = sorted((r.path.rpartition("/")[2], r.line_no, r.line) for r in files.file_lines(spark, f"{tmp_path}/*.txt").collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    assert got == sorted([("a.txt", k + 1, line) for k, line in enumerate(text.replace("\r", "").split("\n")[:-1])] + [("b.txt", 1, "x"), ("b.txt", 2, "y")])


def test_stages_are_dropped_at_the_end(spark):
    import os

    from stichos import common

    with common.stages(spark):
        path = common.written(spark.range(2).toDF("n"), "test").inputFiles()[0].rpartition("/")[0].removeprefix("file://")
        assert os.path.exists(path)
    assert not os.path.exists(path)
