"""Queries of the corpus operators: scans, text functions, ordered aggregates, joins, alignment, segmentation, gates, rendering."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stichos import catalog as C
from stichos.common import latest_rows, read_table, written
from stichos.functions import text as X
from stichos.operators import align, gates, render, segment
from stichos.plans import pipelines
from stichos.plans.corpus_sql import SQL  # noqa: F401
from stichos.sources import files

LINE = ["line_id", "slug", "chapter", "verse", "line_no", "text", "loaded_at"]
VERSE = ["slug", "chapter", "verse"]
ORDER = ["line_no", "line_id"]
SAID = ["said", "called", "asked", "answered", "wrote", "saw", "heard", "knew"]


def lines(spark: SparkSession, d: str, table: str) -> DataFrame:
    return latest_rows(read_table(spark, d, table, *LINE), ["line_id"]).drop("loaded_at")


def placed(spark: SparkSession, d: str, table: str) -> DataFrame:
    """Lines with a full address."""
    return lines(spark, d, table).filter("slug is not null and chapter is not null and verse is not null")


def words(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "word")


def books(spark: SparkSession, d: str) -> DataFrame:
    return F.broadcast(read_table(spark, d, "book").dropDuplicates(["book_code"]))  # one row a book


# Text functions.


def norm_nfc(spark, d):
    return read_table(spark, d, "documents", "doc_id", "text").select("doc_id", X.nfc(F.col("text")).alias("nfc_text"))


def norm_alnum(spark, d):
    return lines(spark, d, "eng_brenton_lines").select("line_id", X.alnum_form(F.col("text")).alias("alnum"))


def norm_greek(spark, d):
    return words(spark, d).select("form").distinct().select("form", X.greek_form(F.col("form")).alias("greek"))


def squeeze_space(spark, d):
    return read_table(spark, d, "documents", "doc_id", "title").select("doc_id", X.squeeze(F.col("title")).alias("title"))


def html_escape(spark, d):
    return lines(spark, d, "eng_brenton_lines").select("line_id", X.html_escape(F.col("text")).alias("escaped"))


def punct_wrap(spark, d):
    """In parity mode: after escaping, so the ; of entities is wrapped as well."""
    return lines(spark, d, "eng_brenton_lines").select("line_id", X.marked_line(F.col("text"), X.ENGLISH_MARKS, parity=True).alias("wrapped"))


def ref_format(spark, d):
    v = read_table(spark, d, "verse", "book_code", "chapter", "verse").distinct()
    return v.select(X.make_ref(F.col("book_code"), F.col("chapter"), F.col("verse")).alias("ref"), F.concat(X.padded(F.col("chapter")), F.lit("-"), X.padded(F.col("verse"))).alias("padded"))


def ref_parse(spark, d):
    r = words(spark, d).select("ref").distinct()
    part = lambda k: X.ref_part(F.col("ref"), k)
    return r.select("ref", part(1).alias("book"), part(2).try_cast("int").alias("chapter"), part(3).try_cast("int").alias("verse"))


def skipped_refs(spark, d):
    """Tokens whose Ref doesn't parse, counted by file."""
    x = read_table(spark, d, "conllu_raw", "file_name", "raw").filter(~F.col("raw").startswith("#") & F.col("raw").contains("\t"))
    misc = F.element_at(F.split("raw", "\t", -1), -1)
    return x.groupBy("file_name").agg(F.count("*").alias("n_rows"), F.count_if(~F.coalesce(X.misc_ref(misc).rlike(X.REF), F.lit(False))).alias("n_skipped"))


def safe_cast(spark, d):
    x = read_table(spark, d, "conllu_raw", "line_id", "raw").filter(~F.col("raw").startswith("#"))
    cell = F.get(F.split("raw", "\t", -1), F.lit(0))
    return x.select("line_id", F.when(cell.rlike(r"\A[0-9]+\z"), cell.try_cast("int")).alias("number"))


def morph_features(spark, d):
    w = latest_rows(words(spark, d).select("sent_id", "local_id", "upos", "morph", "loaded_at"), ["sent_id", "local_id"])
    return w.select("sent_id", "local_id", X.feature(F.col("morph"), "Person").alias("person"), X.feature(F.col("morph"), "Number").alias("number"), X.finite(F.col("upos"), F.col("morph")).cast("int").alias("finite"))


def strip_markup(spark, d):
    return lines(spark, d, "eng_brenton_lines").select("line_id", X.clean_markup(F.col("text")).alias("plain"))


# Ordered scans.


def line_slots(spark, d):
    s = align.line_slots(placed(spark, d, "eng_brenton_lines"), VERSE, ORDER)
    return s.select("line_id", *VERSE, F.col("slot").cast("int").alias("slot"), F.coalesce("text", F.lit("")).alias("text"))


def current_lines(spark, d):
    """The lines of each treebank file as last delivered."""
    return latest_rows(read_table(spark, d, "conllu_raw", "file_name", "line_no", "raw", "loaded_at", "line_id"), ["file_name", "line_no"]).select("file_name", "line_no", F.col("raw").alias("line"))


def fill_forward(spark, d):
    """Each line with the sentence comment it stands under."""
    w = Window.partitionBy("file_name").orderBy("line_no")
    sid = F.when(F.col("line").startswith("# sent_id = "), F.substring("line", 13, 2147483647))
    return current_lines(spark, d).select("file_name", "line_no", F.last(sid, ignorenulls=True).over(w).alias("sent_id"))


def treebank_tokens(spark, d):
    t = files.conllu_tokens(current_lines(spark, d), "file_name")
    return t.select("file_name", "line_no", F.col("sent_no").cast("int").alias("sent_no"), "local_id", "form", "lemma", "upos", "xpos", "morph", "head", "udrel", "after_text", "is_root", "book_code", "chapter", "verse", "pos")


def sentence_ordinal(spark, d):
    w = latest_rows(words(spark, d).select("sent_id", "local_id", "loaded_at"), ["sent_id", "local_id"])
    return w.select("sent_id", "local_id", F.row_number().over(Window.partitionBy("sent_id").orderBy("local_id")).alias("ordinal"))


def key_listing(spark, d):
    return words(spark, d).select("book_code", "chapter").distinct()


def ref_once(spark, d):
    """Lines with their ref where it differs from the line before in the chapter, else ''."""
    w = Window.partitionBy("slug", "chapter").orderBy("verse", *ORDER)
    return placed(spark, d, "grk_lines").select("line_id", F.when(F.lag("verse").over(w).eqNullSafe(F.col("verse")), "").otherwise(F.concat(F.col("chapter").cast("string"), F.lit(":"), F.col("verse").cast("string"))).alias("shown"))


def event_runs(spark, d):
    """Gaps and islands: runs of one event type of a user."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = read_table(spark, d, "events", "event_id", "user_id", "ts", "event_type").withColumn("new", F.when(F.lag("event_type").over(w).eqNullSafe(F.col("event_type")), 0).otherwise(1))
    return e.withColumn("run", F.sum("new").over(w)).groupBy("user_id", "run").agg(F.first("event_type").alias("event_type"), F.count("*").alias("n"), F.min("event_id").alias("first_id"))


# Ordered aggregates.


def level_counts(spark, d):
    t = segment.with_governor(segment.tokens(words(spark, d)))  # a row a word still
    return t.agg(
        F.countDistinct("book_code").alias("books"), F.countDistinct("book_code", "chapter").alias("chapters"), F.countDistinct("book_code", "chapter", "verse").alias("verses"), F.count("*").alias("words"),
        F.count_if(F.col("head") == 0).alias("roots"), F.countDistinct("sent_id").alias("sentences"), F.count_if(F.coalesce("g_there", F.lit(False))).alias("edges"),
    )


def section_rollup(spark, d):
    n, c, o = read_table(spark, d, "nation"), read_table(spark, d, "customer", "c_custkey", "c_nationkey"), read_table(spark, d, "orders", "o_orderkey", "o_custkey")
    per = o.groupBy("o_custkey").agg(F.count("*").alias("n_orders"))
    x = c.join(per, c.c_custkey == per.o_custkey, "left").join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")).join(F.broadcast(read_table(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return x.groupBy("r_name", "n_name").agg(F.count("*").alias("n_customers"), F.sum(F.coalesce("n_orders", F.lit(0))).alias("n_orders"))


def verse_text(spark, d):
    return align.joined_verses(placed(spark, d, "eng_brenton_lines"), VERSE, ORDER, "text")


def verse_forms(spark, d):
    t = segment.tokens(words(spark, d))
    return t.groupBy("book_code", "chapter", "verse").agg(render.ordered_join(["pos", "sent_id", "local_id"], F.col("form"), " ").alias("forms"), F.count("*").alias("n_words"))


def first_seen(spark, d):
    return placed(spark, d, "grk_lines").groupBy(*VERSE).agg(F.min("line_id").alias("first_line"), F.count("*").alias("n_lines"))


def last_wins(spark, d):
    x = read_table(spark, d, "eng_brenton_lines", *LINE)
    return latest_rows(x, ["line_id"]).select("line_id", "text").join(x.groupBy("line_id").agg(F.count("*").alias("n_deliveries")), "line_id")


def quantifiers(spark, d):
    t = segment.tokens(words(spark, d))
    return t.groupBy("sent_id").agg(F.bool_or(X.finite(F.col("upos"), F.col("morph"))).cast("int").alias("any_finite"), F.bool_and(F.col("upos").isin(*C.FUNCTION_UPOS)).cast("int").alias("all_function"), F.bool_or(F.col("lemma").isin(*C.BACKWARD_LEMMAS)).cast("int").alias("any_backward"))


# Joins.


def governor_inner(spark, d):
    t = segment.tokens(words(spark, d))
    return segment.with_governor(t).filter("g_there").select("sent_id", "local_id", "head", "g_lemma", (F.col("o") < F.col("g_o")).cast("int").alias("precedes"))


def governor_left(spark, d):
    t = segment.tokens(words(spark, d))
    return segment.with_governor(t).select("sent_id", "local_id", F.coalesce(F.col("g_lemma").isin(*C.CONTENT_VERBS), F.lit(False)).cast("int").alias("content_governor"), F.coalesce("g_lemma", F.lit("")).alias("g_lemma"))


def children_exists(spark, d):
    c = segment.child_facts(segment.tokens(words(spark, d)))
    return c.select("sent_id", "local_id", F.col("own_subject").cast("int").alias("own_subject"), F.col("causal_mark").cast("int").alias("causal_mark"))


def remap_rules(spark):
    """The numbering of the English by the Greek one: rules as data, one row a stretch of verses."""
    return spark.createDataFrame([("telamar", 1, 1, None), ("telamar", 2, None, -1)], "slug string, first int, last int, shift int")


def bilingual(spark, d):
    """Verses of the Greek with their English, after the English is renumbered."""
    e = align.remap(placed(spark, d, "eng_brenton_lines"), remap_rules(spark), ["slug"], "verse")
    e = align.joined_verses(e, VERSE, ORDER, "text").withColumnRenamed("text", "english")
    g = placed(spark, d, "grk_lines").select(*VERSE).distinct()
    return align.verse_left_join(g, e, VERSE, "english")


def layer_left_join(spark, d):
    return bilingual(spark, d).select(*VERSE, "english", F.col("aligned").cast("int").alias("aligned"))


def slot_pairs(spark, d):
    g, e = (align.line_slots(placed(spark, d, t), VERSE, ORDER) for t in ("grk_lines", "eng_brenton_lines"))
    return align.line_left_join(g, e, VERSE)


def line_align(spark, d):
    return slot_pairs(spark, d).select(*VERSE, F.col("slot").cast("int").alias("slot"), "left_text", "right_text")


def snapshot_sides(spark, d, how):
    """full: verses of either side in the chapters that both have; left: all verses of the current lines."""
    sides = [placed(spark, d, t) for t in ("eng_brenton_lines", "eng_brenton_snapshot")]
    sides = gates.shared(*sides, ["slug", "chapter"]) if how == "full" else sides
    cur, snap = (align.joined_verses(x, VERSE, ORDER, "text").withColumn("alnum", X.alnum_form(F.col("text"))) for x in sides)
    return gates.compare_sides(cur, snap, VERSE, "alnum", how)


def snapshot_full_outer(spark, d):
    return snapshot_sides(spark, d, "full").filter("left_value <> right_value")


def missing_anti(spark, d):
    g, e = (placed(spark, d, t).select(*VERSE).distinct() for t in ("grk_lines", "eng_brenton_lines"))
    return g.join(e, VERSE, "left_anti")


def cross_verse_edges(spark, d):
    t = segment.tokens(words(spark, d))
    g = segment.with_governor(t).filter("g_there")
    return g.groupBy("book_code").agg(F.count("*").alias("edges"), F.count_if((F.col("o")["chapter"] != F.col("g_o")["chapter"]) | (F.col("o")["verse"] != F.col("g_o")["verse"])).alias("cross_verse"))


def book_names(spark, d):
    w = words(spark, d).select("book_code").distinct()
    return w.join(books(spark, d), "book_code", "left").select("book_code", "slug", "book_name", "book_no")


def clause_heads_of_content_verbs(spark, d):
    """Semi join: the words below a verb of saying or thinking (by English gloss, as the lemmas are invented)."""
    t = segment.tokens(words(spark, d))
    told = read_table(spark, d, "glossary", "lemma", "gloss").filter(F.lower(F.trim("gloss")).isin(*SAID)).select("lemma").distinct()
    verbs = t.join(told, "lemma", "left_semi").select("sent_id", F.col("local_id").alias("head"))
    return t.join(verbs, ["sent_id", "head"], "left_semi").select("sent_id", "local_id", "udrel")


# Alignment and coverage.


def key_remap(spark, d):
    return align.remap(placed(spark, d, "eng_brenton_lines").select("line_id", *VERSE), remap_rules(spark), ["slug"], "verse")


def first_line_placement(spark, d):
    """The verse's English beside its first Greek line, '' beside the others."""
    w = Window.partitionBy(*VERSE).orderBy(*ORDER)
    g = placed(spark, d, "grk_lines").join(bilingual(spark, d).select(*VERSE, "english"), VERSE)
    return g.select("line_id", F.when(F.row_number().over(w) == 1, F.col("english")).otherwise("").alias("english"))


def coverage_by_book(spark, d):
    return align.coverage(bilingual(spark, d), ["slug"], F.col("aligned"))


def refs_missing(spark, d):
    ref = F.concat(F.col("chapter").cast("string"), F.lit(":"), F.col("verse").cast("string"))
    return align.missing_refs(bilingual(spark, d), ["slug"], F.col("aligned"), ["chapter", "verse"], ref)


def coverage_json(spark, d):
    x = bilingual(spark, d).agg(F.count("*").alias("a"), F.sum(F.col("aligned").cast("int")).alias("b"))
    return x.select(F.to_json(F.struct(F.col("a").alias("tf_verses"), F.col("b").alias("eng_aligned"), (F.col("a") - F.col("b")).alias("eng_mismatches_total"))).alias("report"))


def coverage_report(spark, d):
    """coverage_json with the missing refs of each book, as the reference's report has them: one row, with a ref for each verse without English."""
    b = bilingual(spark, d)
    ref = F.concat(F.col("chapter").cast("string"), F.lit(":"), F.col("verse").cast("string"))
    counts = b.agg(F.count("*").alias("a"), F.count_if("aligned").alias("b"))
    gaps = b.filter(~F.col("aligned")).groupBy("slug").agg(F.transform(F.array_sort(F.collect_list(F.struct("chapter", "verse", ref.alias("r")))), lambda x: x["r"]).alias("refs"))
    by_book = gaps.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("slug", "refs")))).alias("by_book"))
    fields = [F.col("a").alias("tf_verses"), F.col("b").alias("eng_aligned"), (F.col("a") - F.col("b")).alias("eng_mismatches_total"), F.col("by_book").alias("eng_mismatches_by_book")]
    both = counts.unionByName(by_book, True).agg(F.max("a").alias("a"), F.max("b").alias("b"), F.first("by_book", ignorenulls=True).alias("by_book"))  # of two rows
    return both.select(F.to_json(F.struct(*fields)).alias("report"))


def any_english(spark, d):
    return bilingual(spark, d).groupBy("slug").agg(F.bool_or("aligned").cast("int").alias("has_english"))


# The segmentation.


def facts(spark, d):
    return segment.word_facts(segment.tokens(words(spark, d)))


def ancestor_closure(spark, d):
    return segment.closure(segment.tokens(words(spark, d)))


def subtree_facts(spark, d):
    return facts(spark, d).select("sent_id", "local_id", "n_sub", *[F.col(c).cast("int").alias(c) for c in ("any_finite", "any_propn", "nested_finite")])


def nearest_clause_head(spark, d):
    return facts(spark, d).select("sent_id", "local_id", "clause")


def bind_rules(spark, d):
    return facts(spark, d).filter("rule is not null").select("sent_id", "local_id", "rule", F.col("bind").cast("int").alias("bind"))


def unit_roots(spark, d):
    return facts(spark, d).select("sent_id", "local_id", "unit")


def bind_rules_said(spark, d):
    """The rules with other verbs of content: the lemmas glossed as a verb of saying or knowing, a set that these tables have."""
    told = read_table(spark, d, "glossary", "lemma", "gloss").filter(F.lower(F.trim("gloss")).isin(*SAID)).select("lemma").distinct().withColumn("content", F.lit(True))
    t = segment.tokens(words(spark, d)).join(F.broadcast(told), "lemma", "left")  # a row a lemma of the glossary
    return segment.word_facts(t, F.col("content")).filter("rule is not null").select("sent_id", "local_id", "rule", F.col("bind").cast("int").alias("bind"))


def candidates(spark, d):
    c = read_table(spark, d, "break_candidate", "cand_no", "chapter", "ref", "greek_left").filter(F.col("chapter").rlike(r"^[a-z0-9]+-\d+$") & F.col("ref").rlike(r"^\d+:\d+$"))
    c = c.select("cand_no", F.regexp_extract("chapter", r"^(.*)-\d+$", 1).alias("slug"), F.regexp_extract("chapter", r"-(\d+)$", 1).cast("int").alias("chapter"), F.regexp_extract("ref", r":(\d+)$", 1).cast("int").alias("verse"), "greek_left")
    return c.join(books(spark, d).select("slug", "book_code"), "slug").drop("slug")


def phrase_breaks(spark, d):
    return segment.phrase_breaks(segment.tokens(words(spark, d)), candidates(spark, d))


def sense_lines(spark, d):
    return segment.segment(words(spark, d), candidates(spark, d))


def book_sense_lines(spark, d, book="TEL", chapter=None):
    """One book, or one chapter of it; the filter is pushed into the scan. An unknown book is an error."""
    pipelines.known_book(read_table(spark, d, "book"), book.upper())
    return segment.segment(*[pipelines.select_place(x, book, chapter) for x in (words(spark, d), candidates(spark, d))])


def sense_lines_text(spark, d):
    """Chapters as text files: a ref line and the lines of each verse."""
    s = segment.segment(words(spark, d), candidates(spark, d)).join(books(spark, d).select("book_code", "slug", "book_no"), "book_code")
    body = render.chapter_text(s, ["book_no", "slug", "chapter"], "verse", ["line_no"], F.col("ref"), "text")
    name = F.concat(X.padded(F.col("book_no")), F.lit("-"), F.col("slug"), F.lit("/"), F.col("slug"), F.lit("-"), X.padded(F.col("chapter")), F.lit(".txt"))
    return body.select(name.alias("name"), "body")


# Gates.


def gate_roundtrip(spark, d):
    """Forms of each verse in the treebank files against the token table: the files hold a part of the chapters, so they lead."""
    src = files.conllu_tokens(current_lines(spark, d), "file_name").filter("verse is not null")
    a = src.groupBy("book_code", "chapter", "verse").agg(render.ordered_join(["pos"], F.col("form"), " ").alias("forms"))
    rows = gates.compare_sides(a, verse_forms(spark, d), ["book_code", "chapter", "verse"], "forms", "left")
    return gates.gate(rows, "roundtrip", F.col("book_code"), F.col("left_value") != F.col("right_value"))


def gate_segment(spark, d):
    """Words of the sense lines of each verse, in line order, against the verse's own words."""
    t = written(segment.tokens(words(spark, d)), "segment-tokens")
    s = segment.segment(None, candidates(spark, d), t)
    a = s.groupBy("book_code", "chapter", "verse").agg(render.ordered_join(["line_no"], F.col("text"), " ").alias("t"))
    b = t.groupBy("book_code", "chapter", "verse").agg(render.ordered_join(["pos", "sent_id", "local_id"], F.concat("form", "after_text"), "").alias("t"))
    plain = lambda x: x.select("book_code", "chapter", "verse", F.regexp_replace("t", r"\s+", "").alias("t"))
    rows = gates.compare_sides(plain(a), plain(b), ["book_code", "chapter", "verse"], "t")
    return gates.gate(rows, "segment", F.col("book_code"), F.col("left_value") != F.col("right_value"))


def gate_sequence(spark, d):
    """The words of the sense lines of each verse, by id and in line order, against the verse's own words in order."""
    t = written(segment.tokens(words(spark, d)), "segment-tokens")
    place = ["book_code", "chapter", "verse"]
    s = segment.segment(None, candidates(spark, d), t, ids=True)
    a = s.groupBy(*place).agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "ids"))), lambda x: x["ids"])).alias("made"))
    b = t.groupBy(*place).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "sent_id", "local_id"))), lambda x: F.struct(x["sent_id"], x["local_id"])).alias("own"))
    same = F.coalesce(F.col("made").cast("array<struct<a:string,b:int>>") == F.col("own").cast("array<struct<a:string,b:int>>"), F.lit(False))
    return gates.gate(a.join(b, place, "full"), "sequence", F.col("book_code"), ~same)


def gate_cross_sentence(spark, d):
    """Edges of the treebank files whose ends name different sentences: governors are looked up in the block of lines, sentences told by their comments."""
    t = files.conllu_tokens(current_lines(spark, d), "file_name").select("file_name", "sent_no", "sent_id", "local_id", "head")
    g = t.select("file_name", "sent_no", F.col("local_id").alias("head"), F.col("sent_id").alias("g_sent")).dropDuplicates(["file_name", "sent_no", "head"])
    return gates.gate(t.filter("head <> 0").join(g, ["file_name", "sent_no", "head"]), "cross_sentence", F.col("file_name"), F.col("sent_id") != F.col("g_sent"))


def gate_snapshot(spark, d):
    return gates.gate(snapshot_sides(spark, d, "full"), "snapshot", F.col("slug"), F.col("left_value") != F.col("right_value"))


def gate_source(spark, d):
    """One-sided, as the source gate is: verses of the snapshot alone aren't seen."""
    return gates.gate(snapshot_sides(spark, d, "left"), "source", F.col("slug"), F.col("left_value") != F.col("right_value"))


def gate_edges(spark, d):
    rows = segment.with_governor(segment.tokens(words(spark, d))).filter("head <> 0")
    return gates.gate(rows, "edges", F.col("book_code"), F.col("g_there").isNull())


def first_mismatches(spark, d):
    return gates.first_mismatches(snapshot_sides(spark, d, "full"), VERSE, 25)


# Rendering.


def chapter_text(spark, d):
    e = align.line_slots(placed(spark, d, "eng_brenton_lines"), VERSE, ORDER)
    ref = F.concat(F.col("chapter").cast("string"), F.lit(":"), F.col("verse").cast("string"))
    return render.chapter_text(e, ["slug", "chapter"], "verse", ["slot"], ref, "text")


def chapter_html(spark, d):
    return render.chapter_html(slot_pairs(spark, d), ["slug"], "chapter", "verse", parity=True)


def book_html(spark, d):
    return render.book_html(render.chapter_html(slot_pairs(spark, d), ["slug"], "chapter", "verse", parity=True), ["slug"], "chapter")


def layer_search(spark, d):
    """Lines of either layer that contain a phrase."""
    return slot_pairs(spark, d).filter(F.col("left_text").contains("τῆς") | F.lower("right_text").contains("mountain")).select(*VERSE, F.col("slot").cast("int").alias("slot"))


_ALL = (
    norm_nfc, norm_alnum, norm_greek, squeeze_space, html_escape, punct_wrap, ref_format, ref_parse, skipped_refs, safe_cast, morph_features, strip_markup,
    line_slots, fill_forward, treebank_tokens, sentence_ordinal, key_listing, ref_once, event_runs,
    level_counts, section_rollup, verse_text, verse_forms, first_seen, last_wins, quantifiers,
    governor_inner, governor_left, children_exists, layer_left_join, line_align, snapshot_full_outer, missing_anti, cross_verse_edges, book_names, clause_heads_of_content_verbs,
    key_remap, first_line_placement, coverage_by_book, refs_missing, coverage_json, coverage_report, any_english,
    ancestor_closure, subtree_facts, nearest_clause_head, bind_rules, bind_rules_said, unit_roots, phrase_breaks, sense_lines, book_sense_lines, sense_lines_text,
    gate_roundtrip, gate_segment, gate_sequence, gate_cross_sentence, gate_snapshot, gate_source, gate_edges, first_mismatches,
    chapter_text, chapter_html, book_html, layer_search,
)
QUERIES = {f.__name__: f for f in _ALL}
