"""Sense lines of annotated text: rules over the dependency trees, expressed as closure, joins, windows and groupings.

Every word belongs to a unit, named by a word of its tree. Clause heads stand for themselves or bind into their governor's
unit; external breaks divide units; punctuation follows the word before it; runs of one unit in a verse are lines; lines of function words alone
are folded into their neighbours. The rules over the trees take one shuffle by sentence, the lines one by verse. A sentence too large for a
task is taken through the ancestor closure (the exploded paths of the hierarchy operator) by joins; the facts are the same.

Defined results: null lemma, upos, morph and head take the defaults form, X, '' and root; a null udrel is no relation; heads on
cycles are cut; words with a null place (book, chapter, verse, pos) or key are in no line; repeated deliveries count once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from stichos import catalog as C
from stichos.common import latest_rows, small_side, written
from stichos.functions import text as X
from stichos.operators.hierarchy import hierarchy, jump, on_cycles, tours

NODE = ["sent_id", "local_id"]
PLACE = ["book_code", "chapter", "verse"]


def tokens(words: DataFrame) -> DataFrame:
    """Valid words with the defaults filled in, and order `o` within a book."""
    keep = [*NODE, *PLACE, "pos", "head", "form", "lemma", "upos", "morph", "udrel", "after_text", "loaded_at"]
    valid = latest_rows(words.select(*keep), NODE).filter(" and ".join(f"{c} is not null" for c in (*NODE, *PLACE, "pos")))
    return valid.select(
        *NODE, *PLACE, "pos", F.coalesce("head", F.lit(0)).alias("head"), F.coalesce("form", F.lit("")).alias("form"), F.coalesce("lemma", "form", F.lit("")).alias("lemma"), F.coalesce("upos", F.lit("X")).alias("upos"),
        F.coalesce("morph", F.lit("")).alias("morph"), F.coalesce("udrel", F.lit("")).alias("udrel"), F.coalesce("after_text", F.lit(" ")).alias("after_text"), F.struct("chapter", "verse", "pos").alias("o"),
    )


def closure(t: DataFrame) -> DataFrame:
    """sent_id, local_id, anc, depth (0 for itself): every word with its ancestors."""
    tree = hierarchy(t, ["sent_id"], "local_id", "head", lists=True)
    return tree.select(*NODE, F.posexplode(F.reverse("path")).alias("depth", "anc"))


def with_governor(t: DataFrame) -> DataFrame:
    """Left join to the governor: g_there, g_o, g_lemma, g_agree, and agree of the word (person and number)."""
    agree = F.concat_ws("/", X.feature(F.col("morph"), "Person"), X.feature(F.col("morph"), "Number"))
    g = t.select(F.col("sent_id"), F.col("local_id").alias("head"), F.lit(True).alias("g_there"), F.col("o").alias("g_o"), F.col("lemma").alias("g_lemma"), *[F.col(c).alias(f"g_{c}") for c in t.columns if c == "content"], agree.alias("g_agree"))
    return t.withColumn("agree", agree).join(g, ["sent_id", "head"], "left")


def is_clause() -> Column:
    return (F.col("head") == 0) | F.col("udrel").isin(*C.STAND_RELS, *C.BIND_RELS, *C.ADVERBIAL_RELS)


def chains(t: DataFrame) -> DataFrame:
    """The closure (sent_id, local_id, anc, depth) with what the rules ask of ancestors: a_udrel, a_clause, same (in the word's chapter), in_ch (the way too).

    The ancestors' values come along with the paths, so the closure is neither joined nor sorted.
    """
    home = F.concat_ws("/", "book_code", "chapter")
    tree = hierarchy(t.withColumns({"home": home, "clause": is_clause()}), ["sent_id"], "local_id", "head", lists=True, carry=("home", "udrel", "clause"))
    up = tree.select(*NODE, *[F.reverse(c).alias(c) for c in ("path", "path_home", "path_udrel", "path_clause")])
    same = F.transform("path_home", lambda h: h == F.get("path_home", F.lit(0)))
    up = up.withColumn("same", same).withColumn("leaves", F.array_position("same", F.lit(False)))  # 0: never; else the first place outside, from 1
    step = F.arrays_zip("path", "path_udrel", "path_clause", "same")
    out = up.select(*NODE, "leaves", F.posexplode(step).alias("depth", "a"))
    return out.select(*NODE, "depth", F.col("a.path").alias("anc"), F.col("a.path_udrel").alias("a_udrel"), F.col("a.path_clause").alias("a_clause"), F.col("a.same").alias("same"), ((F.col("leaves") == 0) | (F.col("depth") < F.col("leaves") - 1)).alias("in_ch"))


RELS = sorted({*C.STAND_RELS, *C.BIND_RELS, *C.ADVERBIAL_RELS, *C.SUBJECT_RELS, *C.NESTED_RELS})
#: Sentences with more words are taken through the closure by joins, which gives the same facts.
SENTENCE_ROWS = 200_000
FACTS = "rule string, bind boolean, unit int, clause int, n_sub bigint, any_finite boolean, any_propn boolean, nested_finite boolean"


def word_facts(t: DataFrame, content: Column | None = None, keep: list[str] | None = None, sizes: DataFrame | None = None, rows_per_bucket: int = 50_000, max_rows: int = SENTENCE_ROWS) -> DataFrame:
    """t with FACTS: what the rules decide of each word. rule and bind are null where the word is no clause head.

    Sentences are hashed into buckets, one shuffle; a bucket is one Arrow table, and every rule is evaluated over all its sentences at once: subtrees
    as ranges of an Euler tour within the chapter, ancestors by pointer jumping. Predicates on words are columns made before the shuffle.
    content: whether a word is a verb of content (saying, thinking, seeing), else its lemma tells. keep: columns of t to go with the facts (all but o and morph).
    sizes: rows whose sent_id are counted instead of those of t; it must have no fewer.
    """
    content = F.col("lemma").isin(*C.CONTENT_VERBS) if content is None else content
    is_ = lambda c: F.coalesce(c, F.lit(False))
    flags = {
        "__fin": X.finite(F.col("upos"), F.col("morph")), "__propn": F.col("upos") == "PROPN", "__clause": is_clause(), "__content": content,
        "__causal": (F.col("udrel") == "mark") & F.col("lemma").isin(*C.CAUSAL_MARKS),
    }
    agree = F.concat_ws("/", X.feature(F.col("morph"), "Person"), X.feature(F.col("morph"), "Number"))
    rel = F.array_position(F.array(*map(F.lit, RELS)), F.col("udrel")).cast("int")
    own = t.withColumns({k: is_(v) for k, v in flags.items()} | {"__agree": F.xxhash64(agree), "__home": F.xxhash64("book_code", "chapter"), "__rel": rel})
    keep = [c for c in t.columns if c not in ("o", "morph")] if keep is None else keep
    sizes = (t if sizes is None else sizes).filter("sent_id is not null").groupBy("sent_id").count()
    total, most = sizes.agg(F.coalesce(F.sum("count"), F.lit(0)), F.coalesce(F.max("count"), F.lit(0))).first()
    narrow = own
    if most > max_rows:
        wide = written(sizes.filter(F.col("count") > max_rows).select("sent_id"), "segment-wide")
        narrow, tall = own.join(wide, "sent_id", "left_anti"), written(t.join(wide, "sent_id", "left_semi"), "segment-tall")
    bucket = F.pmod(F.xxhash64("sent_id"), F.lit(max(1, -(-total // rows_per_bucket))))
    cols = list(dict.fromkeys([*keep, *NODE, "head", "chapter", "verse", "pos", *flags, "__agree", "__home", "__rel"]))
    schema = T.StructType([*[own.schema[c] for c in keep], *T.StructType.fromDDL(FACTS).fields])
    code = {r: i + 1 for i, r in enumerate(RELS)}
    out = narrow.select(*cols, bucket.alias("__bucket")).groupBy("__bucket").applyInArrow(lambda x: _with_facts(x, keep, code), schema)
    if most > max_rows:
        out = out.unionByName(_facts_by_joins(tall, content).select(*out.columns))
    return out


def _with_facts(x: pa.Table, keep: list[str], code: dict[str, int]) -> pa.Table:
    facts = _facts({c: x.column(c).combine_chunks() for c in x.column_names}, code)
    out = x.select(keep)
    for name, values in facts.items():
        out = out.append_column(name, values)
    return out


def _facts(c: dict[str, pa.Array], code: dict[str, int]) -> dict[str, pa.Array]:
    """FACTS of whole sentences."""
    value = lambda name: c[name].to_numpy(zero_copy_only=False)
    node, head, rel, home, agree = (value(k).astype(np.int64) for k in ("local_id", "head", "__rel", "__home", "__agree"))
    fin, propn, clause, content, causal = (value(k).astype(bool) for k in ("__fin", "__propn", "__clause", "__content", "__causal"))
    n = len(node)
    among = lambda names: np.isin(rel, [code[r] for r in names])
    adverbial, nested, subject, conj = among(C.ADVERBIAL_RELS), among(C.NESTED_RELS), among(C.SUBJECT_RELS), rel == code["conj"]

    # Governors by a sorted search; heads on a cycle are cut for everything that goes up the tree.
    sent = c["sent_id"].dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    low, width = int(min(node.min(), head.min())), int(max(node.max(), head.max())) - int(min(node.min(), head.min())) + 1
    key, up = sent * width + node - low, sent * width + head - low
    order = np.argsort(key, kind="stable")
    at = order[np.minimum(np.searchsorted(key[order], up), n - 1)]
    gov = np.where(key[at] == up, at, -1)
    there = gov >= 0
    g = np.maximum(gov, 0)
    parent = np.where(head == 0, -1, gov)
    parent = np.where(on_cycles(parent), -1, parent)

    # Subtrees within the chapter.
    same = there & (home[g] == home)
    t = tours(np.where((parent >= 0) & (home[np.maximum(parent, 0)] == home), parent, -1))
    preorder = np.lexsort((t["entry"], t["top"]))
    place = np.empty(n, np.int64)
    place[preorder] = np.arange(n)

    def below(flag: np.ndarray) -> np.ndarray:
        sums = np.r_[0, np.cumsum(flag[preorder])]
        return sums[place + t["below"] + 1] - sums[place]

    n_sub = t["below"] + 1
    any_fin, any_propn = below(fin) > 0, below(propn) > 0
    nested_fin = below(nested & fin) - (nested & fin) > 0
    child = same & (head != 0)
    own_subject, causal_mark = (np.bincount(g[child & f], minlength=n) > 0 for f in (subject, causal))

    # The bind rules.
    later = [value(k).astype(np.int64) for k in ("pos", "verse", "chapter")]
    precedes = np.zeros(n, bool)
    for v in later:
        precedes = (v < v[g]) | ((v == v[g]) & precedes)
    precedes &= there
    ground = causal_mark & ~(there & content[g]) & (n_sub <= C.GROUND_WORDS) & ~any_propn & ~nested_fin
    rules = [
        (head == 0, "root"), (rel == code["parataxis"], "parataxis"), (conj, "conj"), (adverbial & ~precedes & ground, "causal_ground"), (adverbial & fin & precedes, "finite_before"), (adverbial & fin, "finite_after"),
        (adverbial, "non_finite"), (among(["ccomp", "csubj", "csubj:pass"]) & there & content[g], "quote"), (among(C.BIND_RELS), "bound_relation"),
    ]
    rule = np.select([r for r, _ in rules], [name for _, name in rules], "standing").astype(object)
    bind = clause & np.isin(rule.astype(str), ["causal_ground", "finite_before", "non_finite", "bound_relation"])

    # Conjuncts look at the first ancestor that is none. Node n stands for none.
    above = np.r_[np.where(parent >= 0, parent, n), n]

    def nearest(flag: np.ndarray) -> np.ndarray:
        """The nearest node with flag on the way up, from the node itself; n if there is none."""
        return jump(np.where(np.r_[flag, True], np.arange(n + 1), above))[0]

    first = nearest(~conj)[above[:n]]
    has, f = first < n, np.minimum(first, n - 1)
    inherits = has & ~(clause[f] & ~(bind[f] & (home[f] == home)))
    asserts = there & (agree != agree[g]) & has & among(["ccomp", "acl", "acl:relcl"])[f]
    two = np.select([~any_fin, own_subject, inherits & ~asserts], ["conj_non_finite", "conj_own_subject", "conj_inherits"], "conj_stands").astype(object)
    second = rule == "conj"
    rule[second] = two[second]
    bind[second] = clause[second] & np.isin(two[second].astype(str), ["conj_non_finite", "conj_inherits"])

    # Units: the nearest standing clause head of the chapter, else the topmost clause head, else the word.
    stands = nearest(clause & ~bind)
    unit = stands[:n].copy()
    away = np.flatnonzero((unit < n) & (home[np.minimum(unit, n - 1)] != home))
    while len(away):
        unit[away] = stands[above[unit[away]]]
        away = away[(unit[away] < n) & (home[np.minimum(unit[away], n - 1)] != home[away])]
    best, far = np.r_[np.where(clause, np.arange(n), n), n], above
    while (far < n).any():
        best, far = np.where(best[far] < n, best[far], best), far[far]
    unit = np.where(unit < n, unit, np.where(best[:n] < n, best[:n], np.arange(n)))
    near = nearest(clause)[:n]
    near = np.where(near < n, near, np.arange(n))
    rule[~clause] = None
    ids = lambda x: pa.array(node[x].astype(np.int32))
    return {
        "rule": pa.array(rule.tolist(), pa.string()), "bind": pa.array(bind, mask=~clause), "unit": ids(unit), "clause": ids(near), "n_sub": pa.array(n_sub.astype(np.int64)),
        "any_finite": pa.array(any_fin), "any_propn": pa.array(any_propn), "nested_finite": pa.array(nested_fin),
    }


def _facts_by_joins(t: DataFrame, content: Column | None = None) -> DataFrame:
    """word_facts by the closure: joins and aggregates alone."""
    t = t.withColumn("content", F.col("lemma").isin(*C.CONTENT_VERBS) if content is None else content)
    chain = written(chains(t), "segment-chains")
    binds = written(bind_rules(t, chain), "segment-binds")
    near = chain.filter("a_clause").groupBy(*NODE).agg(F.min_by("anc", "depth").alias("clause"))
    out = t.join(binds, NODE, "left").join(unit_roots(chain, binds), NODE, "left").join(near, NODE, "left").join(subtree_facts(t, chain), NODE, "left")
    return out.withColumns({"unit": F.coalesce("unit", "local_id"), "clause": F.coalesce("clause", "local_id")})


def subtree_facts(t: DataFrame, chain: DataFrame) -> DataFrame:
    """Per word: n_sub, any_finite, any_propn, nested_finite (of another word) in its subtree within the chapter."""
    facts = t.select(*NODE, X.finite(F.col("upos"), F.col("morph")).alias("fin"), (F.col("upos") == "PROPN").alias("propn"), F.col("udrel").isin(*C.NESTED_RELS).alias("nested"))
    down = chain.filter("in_ch").select(*NODE, "anc").join(facts, NODE)
    return down.groupBy("sent_id", F.col("anc").alias("local_id")).agg(
        F.count("*").alias("n_sub"), F.bool_or("fin").alias("any_finite"), F.bool_or("propn").alias("any_propn"), F.bool_or((F.col("anc") != F.col("local_id")) & F.col("nested") & F.col("fin")).alias("nested_finite")
    )


def child_facts(t: DataFrame) -> DataFrame:
    """Per word with children in its chapter: own_subject, causal_mark."""
    p = t.select("sent_id", F.col("local_id").alias("head"), "book_code", "chapter")
    kids = t.filter("head <> 0").join(p, ["sent_id", "head", "book_code", "chapter"])
    return kids.groupBy("sent_id", F.col("head").alias("local_id")).agg(
        F.bool_or(F.col("udrel").isin(*C.SUBJECT_RELS)).alias("own_subject"), F.bool_or((F.col("udrel") == "mark") & F.col("lemma").isin(*C.CAUSAL_MARKS)).alias("causal_mark")
    )


def bind_rules(t: DataFrame, chain: DataFrame) -> DataFrame:
    """Per clause head: bind (joins its governor's unit) and the rule that decided. t: tokens, with content if the lemma doesn't tell."""
    t = t if "content" in t.columns else t.withColumn("content", F.col("lemma").isin(*C.CONTENT_VERBS))
    w = with_governor(t).join(subtree_facts(t, chain), NODE, "left").join(child_facts(t), NODE, "left")
    content = F.coalesce(F.col("g_content"), F.lit(False))
    precedes = F.coalesce(F.col("o") < F.col("g_o"), F.lit(False))
    ground = F.coalesce(F.col("causal_mark"), F.lit(False)) & ~content & (F.col("n_sub") <= C.GROUND_WORDS) & ~F.col("any_propn") & ~F.col("nested_finite")
    fin = X.finite(F.col("upos"), F.col("morph"))
    rel = F.col("udrel")
    rule = (
        F.when(F.col("head") == 0, "root").when(rel == "parataxis", "parataxis").when(rel == "conj", "conj")
        .when(rel.isin(*C.ADVERBIAL_RELS) & ~precedes & ground, "causal_ground").when(rel.isin(*C.ADVERBIAL_RELS) & fin, F.when(precedes, "finite_before").otherwise("finite_after")).when(rel.isin(*C.ADVERBIAL_RELS), "non_finite")
        .when(rel.isin("ccomp", "csubj", "csubj:pass") & content, "quote").when(rel.isin(*C.BIND_RELS), "bound_relation").otherwise("standing")
    )
    heads = w.filter(is_clause()).withColumn("rule", rule).withColumn("bind1", F.col("rule").isin("causal_ground", "finite_before", "non_finite", "bound_relation"))
    one = written(heads.select(*NODE, "book_code", "chapter", "rule", "bind1", F.coalesce("any_finite", F.lit(False)).alias("any_finite"), F.coalesce("own_subject", F.lit(False)).alias("own_subject"), F.coalesce(F.col("g_there"), F.lit(False)).alias("g_there"), "agree", "g_agree"), "segment-bind")
    # Second pass: conjuncts look at the first ancestor that is none.
    top = chain.filter((F.col("depth") >= 1) & (F.col("a_udrel") != "conj")).groupBy(*NODE).agg(F.min(F.struct("depth", "anc", "a_udrel", "a_clause")).alias("m"))
    top = top.select(*NODE, F.col("m.anc").alias("t_id"), F.col("m.a_udrel").alias("t_udrel"), F.col("m.a_clause").alias("t_clause"))
    theirs = one.select("sent_id", F.col("local_id").alias("t_id"), F.col("book_code").alias("t_book"), F.col("chapter").alias("t_chapter"), F.col("bind1").alias("t_bind"))
    two = one.filter("rule = 'conj'").join(top, NODE, "left").join(theirs, ["sent_id", "t_id"], "left")
    t_bind = F.coalesce(F.col("t_bind") & (F.col("t_book") == F.col("book_code")) & (F.col("t_chapter") == F.col("chapter")), F.lit(False))
    inherits = F.col("t_id").isNotNull() & ~(F.coalesce(F.col("t_clause"), F.lit(False)) & ~t_bind)
    asserts = F.col("g_there") & (F.col("agree") != F.col("g_agree")) & F.coalesce(F.col("t_udrel").isin("ccomp", "acl", "acl:relcl"), F.lit(False))
    two = two.withColumn("rule2", F.when(~F.col("any_finite"), "conj_non_finite").when(F.col("own_subject"), "conj_own_subject").when(inherits & ~asserts, "conj_inherits").otherwise("conj_stands"))
    two = two.select(*NODE, "rule2", F.col("rule2").isin("conj_non_finite", "conj_inherits").alias("bind2"))
    return one.join(two, NODE, "left").select(*NODE, F.coalesce("rule2", "rule").alias("rule"), F.coalesce("bind2", "bind1").alias("bind"))


def unit_roots(chain: DataFrame, binds: DataFrame) -> DataFrame:
    """Per word the local_id of its unit: the nearest standing clause head in the chapter, else the topmost clause head, else itself."""
    b = binds.select("sent_id", F.col("local_id").alias("anc"), "bind")
    up = chain.filter("a_clause").join(b, ["sent_id", "anc"], "left")
    stands = F.col("same") & ~F.coalesce(F.col("bind"), F.lit(False))
    got = up.groupBy(*NODE).agg(F.min_by("anc", F.when(stands, F.col("depth"))).alias("near"), F.max_by("anc", "depth").alias("topmost"))
    return got.select(*NODE, F.coalesce("near", "topmost").alias("unit"))


def phrase_breaks(t: DataFrame, candidates: DataFrame) -> DataFrame:
    """cand_no, sent_id, local_id: the word after the first place in the verse where the end of greek_left stands.

    candidates: cand_no, book_code, chapter, verse, greek_left. The last three words that have letters must follow each other; without such a
    place the last word alone is looked for; punctuation after it is passed over; nothing after a full match is no break.
    """
    words = F.filter(F.transform(F.split(F.coalesce("greek_left", F.lit("")), r"\s+"), X.greek_form), lambda x: x != "")
    c = candidates.select("cand_no", *PLACE, words.alias("all")).filter("cand_no is not null and book_code is not null and chapter is not null and verse is not null").dropDuplicates(["cand_no"])
    n = F.size("all")
    c = written(c.filter(n > 0).select("cand_no", *PLACE, F.slice("all", F.greatest(n - 2, F.lit(1)), F.lit(3)).alias("sig")), "segment-candidates")
    size = c.count()
    w = Window.partitionBy(*PLACE).orderBy("pos")
    after = Window.partitionBy(*PLACE).orderBy("pos").rowsBetween(1, Window.unboundedFollowing)
    named = t.join(small_side(c.select(*PLACE).distinct(), size), PLACE, "left_semi")
    named = named.withColumn("norm", X.greek_form(F.col("form")))
    for k in (1, 2):
        named = named.withColumn(f"n{k}", F.lead("norm", k).over(w))
    nxt = F.first(F.when(F.col("upos") != "PUNCT", F.struct("sent_id", "local_id")), ignorenulls=True).over(after)
    named = named.withColumn("next", nxt)
    for k in (1, 2):
        named = named.withColumn(f"next{k}", F.lead("next", k).over(w))
    both = c.join(named.select(*PLACE, "pos", "norm", "n1", "n2", "next", "next1", "next2"), PLACE)
    size = F.size("sig")
    full = (F.col("norm") == F.get("sig", F.lit(0))) & ((size < 2) | (F.col("n1") == F.get("sig", F.lit(1)))) & ((size < 3) | (F.col("n2") == F.get("sig", F.lit(2))))
    last = (F.col("norm") == F.get("sig", size - 1)) & F.col("next").isNotNull()
    end = F.when(size == 1, F.col("next")).when(size == 2, F.col("next1")).otherwise(F.col("next2"))
    found = both.groupBy("cand_no").agg(
        F.min(F.when(full, F.struct("pos", F.coalesce(end, F.struct(F.lit(None).cast("string").alias("sent_id"), F.lit(None).cast("int").alias("local_id"))).alias("at")))).alias("f"), F.min(F.when(last, F.struct("pos", F.col("next").alias("at")))).alias("l")
    )
    at = F.when(F.col("f").isNotNull(), F.col("f.at")).otherwise(F.col("l.at"))
    return found.select("cand_no", at["sent_id"].alias("sent_id"), at["local_id"].alias("local_id")).filter("sent_id is not null")


def sense_lines(w: DataFrame, breaks: DataFrame | None = None, ids: bool = False) -> DataFrame:
    """book_code, chapter, verse, line_no (in the chapter), ref, n_words, first_pos, text; with ids also the ids of the words in order.
    w: words with their unit (word_facts), and backward: whether the lemma belongs to the line before."""
    name = [F.struct(*NODE).alias("id")] if ids else []
    w = w.withColumn("unit", F.struct("sent_id", F.col("unit").alias("id")))
    by_unit = Window.partitionBy(*PLACE, "unit").orderBy("pos")
    if breaks is not None:
        cuts = written(breaks.groupBy(*NODE).agg(F.min("cand_no").alias("cand")), "segment-breaks")
        w = w.join(small_side(cuts, cuts.count()), NODE, "left").repartition(*PLACE)
        before = F.min("cand").over(by_unit.rowsBetween(Window.unboundedPreceding, -1))
        # A break on the unit's own root counts only after an earlier candidate has moved that root into another unit.
        real = F.col("cand").isNotNull() & ((F.col("unit.id") != F.col("local_id")) | F.coalesce(before < F.col("cand"), F.lit(False)))
        w = w.withColumn("broke", F.when(real, F.col("pos"))).withColumn("part", F.last("broke", ignorenulls=True).over(by_unit))
    else:
        w = w.repartition(*PLACE).withColumn("part", F.lit(None).cast("int"))
    verse = Window.partitionBy(*PLACE).orderBy("pos")
    label = F.struct("unit", F.coalesce("part", F.lit(-1)).alias("part"))
    w = w.withColumn("label", label).withColumn("rn", F.row_number().over(verse))
    w = w.withColumn("label", F.last(F.when((F.col("upos") != "PUNCT") | (F.col("rn") == 1), F.col("label")), ignorenulls=True).over(verse))
    w = w.withColumn("run", F.sum(F.when(F.lag("label").over(verse).eqNullSafe(F.col("label")), 0).otherwise(1)).over(verse))
    runs = w.groupBy(*PLACE, "run").agg(
        F.bool_or(~F.col("upos").isin(*C.FUNCTION_UPOS)).alias("content"), F.bool_or("backward").alias("backward"),
        F.array_sort(F.collect_list(F.struct("pos", *name, F.concat("form", "after_text").alias("s")))).alias("ws"),
    )
    order = Window.partitionBy(*PLACE).orderBy("run")
    runs = runs.withColumn("c", F.sum(F.col("content").cast("int")).over(order)).withColumn("total", F.sum(F.col("content").cast("int")).over(Window.partitionBy(*PLACE)))
    last = runs.select("book_code", "chapter", "verse").groupBy("book_code", "chapter").agg(F.max("verse").alias("last_verse"))
    runs = runs.join(last, ["book_code", "chapter"])
    group = (
        F.when(F.col("content") | (F.col("backward") & (F.col("c") >= 1)), F.col("c"))
        .when(F.col("c") < F.col("total"), F.col("c") + 1)
        .when((F.col("verse") == F.col("last_verse")) & (F.col("c") >= 1), F.col("c"))
        .otherwise(F.col("c") + 1)
    )
    lines = runs.withColumn("g", group).groupBy(*PLACE, "g").agg(F.array_sort(F.flatten(F.collect_list("ws"))).alias("ws"))
    number = F.row_number().over(Window.partitionBy("book_code", "chapter").orderBy("verse", "g"))
    return lines.select(*PLACE, number.alias("line_no"), F.concat(F.col("chapter").cast("string"), F.lit(":"), F.col("verse").cast("string")).alias("ref"), F.size("ws").alias("n_words"), F.get("ws", F.lit(0))["pos"].alias("first_pos"), X.strip(F.array_join(F.transform("ws", lambda x: x["s"]), "")).alias("text"), *[F.transform("ws", lambda x: x["id"]).alias("ids") for _ in name])


def segment(words: DataFrame | None, candidates: DataFrame | None = None, t: DataFrame | None = None, ids: bool = False) -> DataFrame:
    """The whole query: words to sense lines. t: the tokens of words, if they are there already."""
    sizes = words if t is None else t
    t = (tokens(words) if t is None else t).withColumn("backward", F.col("lemma").isin(*C.BACKWARD_LEMMAS))
    keep = [*NODE, *PLACE, "pos", "form", "after_text", "upos", "backward"]
    # Read by lines, last verses and breaks.
    w = written(word_facts(t, keep=keep, sizes=sizes).select(*keep, "unit"), "segment-units")
    return sense_lines(w, phrase_breaks(w, candidates) if candidates is not None else None, ids)
