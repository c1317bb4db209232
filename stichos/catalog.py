"""Declared schemas with descriptions, and the fixed word sets of the segmentation rules."""

from __future__ import annotations

from pyspark.sql import types as T


def _field(name: str, kind: T.DataType, about: str) -> T.StructField:
    return T.StructField(name, kind, True, {"description": about})


S, I = T.StringType(), T.IntegerType()  # noqa: E741

TOKENS = T.StructType(
    [
        _field("book_code", S, "code of the book in refs"), _field("book_name", S, "name of the book"), _field("chapter", I, "chapter number"), _field("verse", I, "verse number"),
        _field("pos", I, "place in the verse, from 1"), _field("sent_id", S, "sentence; sentences may cross verses"), _field("local_id", I, "id in the sentence"), _field("head", I, "local_id of the governor, 0 for a root"),
        _field("form", S, "surface form, NFC"), _field("lemma", S, "dictionary form, NFC; the form where unknown"), _field("upos", S, "universal part of speech, X where unknown"), _field("xpos", S, "part of speech of the treebank"),
        _field("morph", S, "features, Name=Value|..."), _field("udrel", S, "relation to the governor"), _field("after_text", S, "what follows the form: a space or nothing"), _field("is_root", I, "1 if head is 0"),
        _field("syn_source", S, "where the syntax comes from"), _field("text_source", S, "where the text comes from"),
    ]
)
LINES = T.StructType([_field("layer", S, "grk or eng"), _field("slug", S, "book"), _field("chapter", I, "chapter"), _field("verse", I, "verse"), _field("line_no", I, "line in the verse, from 1"), _field("text", S, "the line; empty for an empty slot")])

# Relations of clause heads, subjects and nested clauses, parts of speech of function words, and lemmas.
STAND_RELS = ["root", "conj", "parataxis"]
BIND_RELS = ["acl", "acl:relcl", "ccomp", "xcomp", "csubj", "csubj:pass"]
ADVERBIAL_RELS = ["advcl", "advcl:cmp", "advcl:relcl"]
SUBJECT_RELS = ["nsubj", "nsubj:pass", "csubj", "csubj:pass"]
NESTED_RELS = ["advcl", "advcl:cmp", "advcl:relcl", "ccomp", "acl", "acl:relcl", "conj", "csubj", "csubj:pass", "parataxis"]
FUNCTION_UPOS = ["ADP", "CCONJ", "SCONJ", "DET", "PART", "AUX", "PUNCT"]
CAUSAL_MARKS = ["ὅτι", "διότι", "ἐπεί", "ἐπειδή", "καθότι"]
BACKWARD_LEMMAS = ["δέ", "γάρ", "οὖν", "τε", "μέν", "ἄρα", "γε", "δή", "τοίνυν"]
CONTENT_VERBS = [
    "λέγω", "εἶπον", "λαλέω", "φημί", "ἀποκρίνομαι", "βοάω", "κράζω", "ἀναγγέλλω", "ἀπαγγέλλω", "διηγέομαι", "ὁμολογέω", "κηρύσσω", "μαρτυρέω", "γράφω", "ἐντέλλομαι", "κελεύω", "προστάσσω", "ἐρωτάω",
    "οἶδα", "γινώσκω", "ἐπίσταμαι", "νοέω", "συνίημι", "λογίζομαι", "νομίζω", "ἡγέομαι", "δοκέω", "πιστεύω", "μιμνήσκομαι", "μνημονεύω", "ἐνθυμέομαι", "κρίνω", "ἐλπίζω", "βούλομαι", "θέλω",
    "ὁράω", "εἶδον", "βλέπω", "ἀκούω", "θεωρέω", "αἰσθάνομαι",
    "χαίρω", "θαυμάζω", "φοβέομαι", "λυπέομαι", "ἀγαλλιάομαι", "δοξάζω",
]
GROUND_WORDS = 8
