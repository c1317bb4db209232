"""Text functions as columns: normal forms, refs, markup stripping, escaping. All run in the JVM but nfc.

Each gives null for null unless it says otherwise; texts of any length are treated whole.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITE = r"[\s\u0085\u00a0\u2028\u2029\u2000-\u200a\u3000\u001c-\u001f]"


def nfc(c: Column) -> Column:
    """Unicode NFC, by Arrow batches; Spark has no such function."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("string")
    def normal(s):
        return s.str.normalize("NFC")

    return normal(c)


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{WHITE}+|{WHITE}+$", "")


def squeeze(c: Column) -> Column:
    """White space runs become one space; none at the ends."""
    return strip(F.regexp_replace(c, f"{WHITE}+", " "))


def alnum_form(c: Column) -> Column:
    """Lower case ASCII letters and digits only; null counts as empty."""
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]", "")


def greek_form(c: Column) -> Column:
    """Lower case, Greek letters only (accents of precomposed letters stay); null counts as empty."""
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^\u0370-\u03ff\u1f00-\u1fff]", "")


def html_escape(c: Column) -> Column:
    for mark, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(mark), F.lit(entity))
    return c


def punct_wrap(c: Column, marks: str) -> Column:
    """Each of marks (the inside of a character class) goes into a span."""
    return F.regexp_replace(c, f"([{marks}])", '<span class="punct">$1</span>')


GREEK_MARKS, ENGLISH_MARKS = ",.;:?!·", ",.;:!?'\"\\-"
SUPERSCRIPTS, DIGITS = "⁰¹²³⁴⁵⁶⁷⁸⁹", "0123456789"


def marked_line(c: Column, marks: str, parity: bool = False) -> Column:
    """Escaped line with wrapped punctuation. parity: wrap after escaping, which also wraps the ; of entities."""
    if parity:
        return punct_wrap(html_escape(c), marks)
    # Escape piece by piece: marks first get a private sign, so that entities stay whole.
    held = F.regexp_replace(c, f"([{marks}])", "\ue000$1\ue001")
    return F.replace(F.replace(html_escape(held), F.lit("\ue000"), F.lit('<span class="punct">')), F.lit("\ue001"), F.lit("</span>"))


def verse_markers(c: Column, chapter: Column) -> Column:
    """Runs of superscript digits become anchors v-<chapter>-<digits>-inline."""
    runs = F.regexp_extract_all(c, F.lit(f"([{SUPERSCRIPTS}]+)"), F.lit(1))
    parts = F.split(c, f"[{SUPERSCRIPTS}]+", -1)
    tag = lambda r: F.concat(F.lit('<sup class="verse-marker" id="v-'), chapter.cast("string"), F.lit("-"), F.translate(r, SUPERSCRIPTS, DIGITS), F.lit('-inline">'), r, F.lit("</sup>"))
    return F.when(c.rlike(f"[{SUPERSCRIPTS}]"), F.array_join(F.zip_with(parts, runs, lambda p, r: F.concat(p, F.coalesce(tag(r), F.lit("")))), "")).otherwise(c)


def make_ref(book: Column, chapter: Column, verse: Column) -> Column:
    return F.concat(book, F.lit("_"), chapter.cast("string"), F.lit("."), verse.cast("string"))


REF = r"^([A-Z0-9]+)_(\d+)\.(\d+)$"


def ref_part(ref: Column, part: int) -> Column:
    """1 book, 2 chapter, 3 verse of BOOK_c.v; null if it doesn't parse. Numbers are text, see try_cast."""
    return F.when(ref.rlike(REF), F.regexp_extract(ref, REF, part))


def misc_ref(misc: Column) -> Column:
    return F.regexp_extract(misc, r"Ref=([^|\s]+)", 1)


def padded(n: Column, width: int = 2) -> Column:
    """Zero-padded to at least width digits; longer numbers stay whole."""
    text = n.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, 100.0 * part / whole).otherwise(F.lit(0.0))


def feature(morph: Column, name: str) -> Column:
    """The Name=Value element of a feature; the last one wins; '' if absent or null."""
    hits = F.filter(F.split(F.coalesce(morph, F.lit("")), r"\|"), lambda x: x.startswith(f"{name}="))
    return F.coalesce(F.get(hits, F.size(hits) - 1), F.lit(""))


def finite(upos: Column, morph: Column) -> Column:
    m = F.coalesce(morph, F.lit(""))
    return m.contains("VerbForm=Fin") | (F.coalesce(upos.isin("VERB", "AUX"), F.lit(False)) & ~m.contains("VerbForm=Part") & ~m.contains("VerbForm=Inf"))


# Markers of the marked-up translation.
PARAGRAPH = r"\\(?:p|m|q[0-9]*|li[0-9]*|pi[0-9]*|s[0-9]*|nb|b|cls|qm[0-9]*|qa|pc|pmo|pmc|pmr|cl|d)\b[ \t]*"
OPENERS = r"\\(sc|nd|wj|qt|tl|bd|it|em|bk|pn|qs|qac|add)\s+"
CLOSERS = r"\\(sc|nd|wj|qt|tl|bd|it|em|bk|pn|qs|qac|add)\*"
STRAY = r"\\[a-zA-Z][a-zA-Z0-9]*\*?"
HEADERS = r"^\\(?:id |h |toc|mt|rem|ide|usfm )"


def clean_markup(c: Column) -> Column:
    """Notes with their text, then openers, closers and stray markers go; white space is squeezed."""
    for pattern, by in ((r"(?s)\\f\s.*?\\f\*", ""), (r"(?s)\\x\s.*?\\x\*", ""), (OPENERS, ""), (CLOSERS, ""), (STRAY, "")):
        c = F.regexp_replace(c, pattern, by)
    return squeeze(c)
