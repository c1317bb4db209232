"""The same queries in SQL, written apart from the operators: common table expressions by name, and a final select each."""

from __future__ import annotations

# Fixed values, stated apart from those of the operators: relations, parts of speech and lemmas of the rules.
STAND_RELS = ["root", "conj", "parataxis"]
BIND_RELS = ["acl", "acl:relcl", "ccomp", "xcomp", "csubj", "csubj:pass"]
ADVERBIAL_RELS = ["advcl", "advcl:cmp", "advcl:relcl"]
SUBJECT_RELS = ["nsubj", "nsubj:pass", "csubj", "csubj:pass"]
NESTED_RELS = ["advcl", "advcl:cmp", "advcl:relcl", "ccomp", "acl", "acl:relcl", "conj", "csubj", "csubj:pass", "parataxis"]
FUNCTION_UPOS = ["ADP", "CCONJ", "SCONJ", "DET", "PART", "AUX", "PUNCT"]
CAUSAL_MARKS = ["ὅτι", "διότι", "ἐπεί", "ἐπειδή", "καθότι"]
BACKWARD_LEMMAS = ["δέ", "γάρ", "οὖν", "τε", "μέν", "ἄρα", "γε", "δή", "τοίνυν"]
CONTENT_VERBS = (
    "λέγω εἶπον λαλέω φημί ἀποκρίνομαι βοάω κράζω ἀναγγέλλω ἀπαγγέλλω διηγέομαι ὁμολογέω κηρύσσω μαρτυρέω γράφω ἐντέλλομαι κελεύω προστάσσω ἐρωτάω "
    "οἶδα γινώσκω ἐπίσταμαι νοέω συνίημι λογίζομαι νομίζω ἡγέομαι δοκέω πιστεύω μιμνήσκομαι μνημονεύω ἐνθυμέομαι κρίνω ἐλπίζω βούλομαι θέλω "
    "ὁράω εἶδον βλέπω ἀκούω θεωρέω αἰσθάνομαι χαίρω θαυμάζω φοβέομαι λυπέομαι ἀγαλλιάομαι δοξάζω"
).split()


def _in(values: list[str]) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


_GREEK = r"regexp_replace(lower(coalesce({}, '')), '[^\x{{0370}}-\x{{03ff}}\x{{1f00}}-\x{{1fff}}]', '', 'g')"
_FIN = "(contains({0}.morph, 'VerbForm=Fin') or ({0}.upos in ('VERB', 'AUX') and not contains({0}.morph, 'VerbForm=Part') and not contains({0}.morph, 'VerbForm=Inf')))"
_CLAUSE = "({0}.head = 0 or {0}.udrel in " + _in([*STAND_RELS, *BIND_RELS, *ADVERBIAL_RELS]) + ")"
_AGREE = "(coalesce(list_filter(string_split({0}.morph, '|'), lambda x: starts_with(x, 'Person='))[-1], '') || '/' || coalesce(list_filter(string_split({0}.morph, '|'), lambda x: starts_with(x, 'Number='))[-1], ''))"
_CUT = r"(?:p|m|q[0-9]*|li[0-9]*|pi[0-9]*|s[0-9]*|nb|b|cls|qm[0-9]*|qa|pc|pmo|pmc|pmr|cl|d)"
_MARKS = "(sc|nd|wj|qt|tl|bd|it|em|bk|pn|qs|qac|add)"
_PLAIN = rf"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({{}}, '\\f\s.*?\\f\*', '', 'gs'), '\\x\s.*?\\x\*', '', 'gs'), '\\{_MARKS}\s+', '', 'g'), '\\{_MARKS}\*', '', 'g'), '\\[a-zA-Z][a-zA-Z0-9]*\*?', '', 'g'), '\s+', ' ', 'g'))"
_ESC = """replace(replace(replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;')"""
_GM = """regexp_replace({}, '([,.;:?!·])', '<span class="punct">\\1</span>', 'g')"""
_EM = """regexp_replace({}, '([,.;:!?''"-])', '<span class="punct">\\1</span>', 'g')"""


def _valid(table: str, keys: str, order: str = "loaded_at desc") -> str:
    return f"(select * exclude (rn__) from (select *, row_number() over (partition by {keys} order by {order}) rn__ from {table}) where rn__ = 1)"


_CTE: dict[str, str] = {
    "g": f"select line_id, slug, chapter, verse, line_no, text from {_valid('grk_lines', 'line_id')}",
    "e": f"select line_id, slug, chapter, verse, line_no, text from {_valid('eng_brenton_lines', 'line_id')}",
    "s": f"select line_id, slug, chapter, verse, line_no, text from {_valid('eng_brenton_snapshot', 'line_id')}",
    "gp": "select * from g where slug is not null and chapter is not null and verse is not null",
    "ep": "select * from e where slug is not null and chapter is not null and verse is not null",
    "sp": "select * from s where slug is not null and chapter is not null and verse is not null",
    "er": "select * replace (case when slug = 'telamar' and verse >= 2 then verse - 1 else verse end as verse) from ep where not (slug = 'telamar' and verse = 1)",
    "erv": "select slug, chapter, verse, string_agg(trim(text), ' ' order by line_no, line_id) text from er where trim(coalesce(text, '')) <> '' group by all",
    "ev": "select slug, chapter, verse, string_agg(trim(text), ' ' order by line_no, line_id) text from ep where trim(coalesce(text, '')) <> '' group by all",
    "sv": "select slug, chapter, verse, string_agg(trim(text), ' ' order by line_no, line_id) text from sp where trim(coalesce(text, '')) <> '' group by all",
    "gv": "select distinct slug, chapter, verse from gp",
    "bi": "select gv.*, coalesce(erv.text, '') english, case when coalesce(erv.text, '') <> '' then 1 else 0 end aligned from gv left join erv using (slug, chapter, verse)",
    "inboth": "select distinct slug, chapter from ep intersect select distinct slug, chapter from sp",
    "sides": "select slug, chapter, verse, coalesce(regexp_replace(lower(ev.text), '[^a-z0-9]', '', 'g'), '') l, coalesce(regexp_replace(lower(sv.text), '[^a-z0-9]', '', 'g'), '') r, ev.text is not null has_l from ev full join sv using (slug, chapter, verse)",
    "sides2": "select sides.* from sides join inboth using (slug, chapter)",
    "gs": "select * from (select *, row_number() over v - 1 slot, max(case when trim(coalesce(text, '')) <> '' then 1 else 0 end) over (partition by slug, chapter, verse order by line_no desc, line_id desc) live from gp window v as (partition by slug, chapter, verse order by line_no, line_id)) where live = 1",
    "es": "select * from (select *, row_number() over v - 1 slot, max(case when trim(coalesce(text, '')) <> '' then 1 else 0 end) over (partition by slug, chapter, verse order by line_no desc, line_id desc) live from ep window v as (partition by slug, chapter, verse order by line_no, line_id)) where live = 1",
    "pairs": "select slug, chapter, verse, slot, coalesce(gs.text, '') left_text, coalesce(es.text, '') right_text from gs left join es using (slug, chapter, verse, slot)",
    "html": f"""select slug, chapter, '<div class="chapter" id="ch-' || chapter || '">' || chr(10) || string_agg(block, chr(10) order by verse) || chr(10) || '</div>' html from (
      select slug, chapter, verse, '  <div class="verse" id="v-' || chapter || '-' || verse || '"><span class="verse-num">' || chapter || ':' || verse || '</span>' || chr(10) || string_agg('    <span class="line"><span class="grk">'
        || {_GM.format(_ESC.format("left_text"))} || '</span><span class="en">' || {_EM.format(_ESC.format("right_text"))} || '</span></span>', chr(10) order by slot) || chr(10) || '  </div>' block from pairs group by slug, chapter, verse) group by slug, chapter""",
    "cur": f"select file_name, line_no, regexp_replace(raw, '\\r$', '') line from {_valid('conllu_raw', 'file_name, line_no', 'loaded_at desc, raw desc, line_id desc')}",
    "tb0": "select *, sum(case when trim(line) = '' then 1 else 0 end) over (partition by file_name order by line_no) sent_no, string_split(line, chr(9)) f from cur",
    "tb1": """select * from (select file_name, line_no, sent_no, line, f, try_cast(f[1] as integer) local_id, case when regexp_full_match(trim(f[7]), '[+-]?[0-9]+') then cast(trim(f[7]) as integer) else 0 end head,
      coalesce(last_value(case when starts_with(line, '# sent_id') then regexp_extract(line, '^# sent_id\\s*=\\s*(.*)$', 1) end ignore nulls) over (partition by file_name, sent_no order by line_no), file_name || '#' || sent_no) sid from tb0)
      where trim(line) <> '' and not starts_with(line, '#') and len(f) >= 10 and regexp_full_match(f[1], '[0-9]+')""",
    "tb": """select file_name, line_no, cast(sent_no as integer) sent_no, cast(f[1] as integer) local_id, nfc_normalize(f[2]) form, nfc_normalize(case when f[3] = '_' then f[2] else f[3] end) lemma, case when f[4] = '_' then 'X' else f[4] end upos, f[5] xpos,
      case when f[6] = '_' then '' else f[6] end morph, case when regexp_full_match(trim(f[7]), '[+-]?[0-9]+') then cast(trim(f[7]) as integer) else 0 end head, f[8] udrel, case when contains(f[10], 'SpaceAfter=No') then '' else ' ' end after_text, case when regexp_full_match(trim(f[7]), '[+-]?0*[1-9][0-9]*') then 0 else 1 end is_root,
      regexp_extract(f[10], 'Ref=([^|\\s]+)', 1) ref from tb0 where trim(line) <> '' and not starts_with(line, '#') and len(f) >= 10 and regexp_full_match(f[1], '[0-9]+')""",
    "tbr": """select * exclude (ref), case when p then regexp_extract(ref, '^([A-Z0-9]+)_', 1) end book_code, case when p then cast(regexp_extract(ref, '_(\\d+)\\.', 1) as integer) end chapter, case when p then cast(regexp_extract(ref, '\\.(\\d+)$', 1) as integer) end verse
      from (select *, regexp_full_match(ref, '[A-Z0-9]+_\\d+\\.\\d+') p from tb)""",
    "tokens": "select * exclude (p), case when verse is not null then row_number() over (partition by book_code, chapter, verse order by file_name, line_no) end pos from tbr",
    "t": f"""select sent_id, local_id, book_code, chapter, verse, pos, coalesce(head, 0) head, coalesce(form, '') form, coalesce(lemma, form, '') lemma, coalesce(upos, 'X') upos, coalesce(morph, '') morph, coalesce(udrel, '') udrel, coalesce(after_text, ' ') after_text,
      cast(chapter as bigint) * 1000000000 + verse * 100000 + pos o from {_valid('word', 'sent_id, local_id')} where sent_id is not null and local_id is not null and book_code is not null and chapter is not null and verse is not null and pos is not null""",
    "gov": f"select t.*, p.local_id is not null g_there, p.o g_o, p.verse g_verse, p.chapter g_chapter, p.lemma g_lemma, {_AGREE.format('t')} agree, {_AGREE.format('p')} g_agree from t left join t p on p.sent_id = t.sent_id and p.local_id = t.head",
    "walk": "select sent_id, local_id, head, [local_id] seen from t union all select k.sent_id, k.local_id, p.head, list_append(seen, p.local_id) from walk k join t p on p.sent_id = k.sent_id and p.local_id = k.head where k.head <> 0 and not list_contains(seen, k.head)",
    "ring": "select distinct sent_id, local_id from walk where head <> 0 and head = seen[1]",
    "up": "select t.sent_id, t.local_id, t.book_code, t.chapter, case when ring.local_id is null and t.head <> 0 then t.head end up from t left join ring using (sent_id, local_id)",
    "cl": """select sent_id, local_id, local_id anc, 0 depth, book_code wb, chapter wc, true in_ch, true same from up
      union all select c.sent_id, c.local_id, p.local_id, depth + 1, wb, wc, in_ch and p.chapter = wc and p.book_code = wb, p.chapter = wc and p.book_code = wb from cl c join up a on a.sent_id = c.sent_id and a.local_id = c.anc join up p on p.sent_id = a.sent_id and p.local_id = a.up""",
    "sub": f"select cl.sent_id, cl.anc local_id, count(*) n_sub, bool_or({_FIN.format('t')}) any_finite, bool_or(t.upos = 'PROPN') any_propn, bool_or(cl.anc <> cl.local_id and t.udrel in {_in(NESTED_RELS)} and {_FIN.format('t')}) nested_finite from cl join t using (sent_id, local_id) where in_ch group by 1, 2",
    "kid": f"select k.sent_id, k.head local_id, bool_or(k.udrel in {_in(SUBJECT_RELS)}) own_subject, bool_or(k.udrel = 'mark' and k.lemma in {_in(CAUSAL_MARKS)}) causal_mark from t k join t p on p.sent_id = k.sent_id and p.local_id = k.head and p.chapter = k.chapter and p.book_code = k.book_code where k.head <> 0 group by all",
    "b1": f"""select gov.sent_id, gov.local_id, gov.book_code, gov.chapter, gov.udrel, coalesce(any_finite, false) any_finite, coalesce(own_subject, false) own_subject, g_there, agree, g_agree,
      case when head = 0 then 'root' when udrel = 'parataxis' then 'parataxis' when udrel = 'conj' then 'conj'
        when udrel in {_in(ADVERBIAL_RELS)} and not coalesce(o < g_o, false) and coalesce(causal_mark, false) and not coalesce(g_lemma in {_in(CONTENT_VERBS)}, false) and n_sub <= 8 and not any_propn and not nested_finite then 'causal_ground'
        when udrel in {_in(ADVERBIAL_RELS)} and {_FIN.format('gov')} then case when coalesce(o < g_o, false) then 'finite_before' else 'finite_after' end when udrel in {_in(ADVERBIAL_RELS)} then 'non_finite'
        when udrel in ('ccomp', 'csubj', 'csubj:pass') and coalesce(g_lemma in {_in(CONTENT_VERBS)}, false) then 'quote' when udrel in {_in(BIND_RELS)} then 'bound_relation' else 'standing' end as rule
      from gov left join sub using (sent_id, local_id) left join kid using (sent_id, local_id) where {_CLAUSE.format('gov')}""",
    "b1b": "select *, rule in ('causal_ground', 'finite_before', 'non_finite', 'bound_relation') bind1 from b1",
    "tops": f"select cl.sent_id, cl.local_id, arg_min(cl.anc, depth) t_id, arg_min(t.udrel, depth) t_udrel, arg_min({_CLAUSE.format('t')}, depth) t_clause from cl join t on t.sent_id = cl.sent_id and t.local_id = cl.anc where depth >= 1 and t.udrel <> 'conj' group by 1, 2",
    "b2": """select b.sent_id, b.local_id, case when b.rule <> 'conj' then b.rule when not b.any_finite then 'conj_non_finite' when b.own_subject then 'conj_own_subject'
        when t_id is not null and not (t_clause and not coalesce(h.bind1 and h.book_code = b.book_code and h.chapter = b.chapter, false)) and not (b.g_there and b.agree <> b.g_agree and t_udrel in ('ccomp', 'acl', 'acl:relcl')) then 'conj_inherits' else 'conj_stands' end as rule
      from b1b b left join tops using (sent_id, local_id) left join b1b h on h.sent_id = b.sent_id and h.local_id = t_id""",
    "bd": "select *, rule in ('causal_ground', 'finite_before', 'non_finite', 'bound_relation', 'conj_non_finite', 'conj_inherits') bind from b2",
    "ur": f"""select t.sent_id, t.local_id, coalesce(u.near, u.topmost, t.local_id) unit from t left join (
      select cl.sent_id, cl.local_id, arg_min(cl.anc, depth) filter (same and not coalesce(bind, false)) near, arg_max(cl.anc, depth) topmost from cl join t a on a.sent_id = cl.sent_id and a.local_id = cl.anc left join bd on bd.sent_id = cl.sent_id and bd.local_id = cl.anc
      where {_CLAUSE.format('a')} group by 1, 2) u using (sent_id, local_id)""",
    "cand": f"""select cand_no, book_code, chapter, verse, sig[greatest(len(sig) - 2, 1):] sig from (select distinct cand_no, book_code, cast(regexp_extract(chapter, '-(\\d+)$', 1) as integer) chapter, cast(regexp_extract(ref, ':(\\d+)$', 1) as integer) verse,
      list_filter(list_transform(regexp_split_to_array(coalesce(greek_left, ''), '\\s+'), lambda x: {_GREEK.format('x')}), lambda x: x <> '') sig from break_candidate join book on slug = regexp_extract(chapter, '^(.*)-\\d+$', 1)
      where regexp_full_match(chapter, '[a-z0-9]+-\\d+') and regexp_full_match(ref, '\\d+:\\d+')) where len(sig) > 0""",
    "seq": f"select *, {_GREEK.format('form')} norm, min(case when upos <> 'PUNCT' then pos end) over (partition by book_code, chapter, verse order by pos rows between 1 following and unbounded following) nx from t",
    "seq3": "select *, lead(norm) over v n1, lead(norm, 2) over v n2, lead(nx) over v nx1, lead(nx, 2) over v nx2 from seq window v as (partition by book_code, chapter, verse order by pos)",
    "hit": """select cand_no, any_value(c.book_code) book_code, any_value(c.chapter) chapter, any_value(c.verse) verse, count(*) filter (norm = sig[1] and (len(sig) < 2 or n1 = sig[2]) and (len(sig) < 3 or n2 = sig[3])) n_full,
      arg_min(struct_pack(p := case len(sig) when 1 then nx when 2 then nx1 else nx2 end), seq3.pos) filter (norm = sig[1] and (len(sig) < 2 or n1 = sig[2]) and (len(sig) < 3 or n2 = sig[3])).p a, arg_min(nx, seq3.pos) filter (norm = sig[-1] and nx is not null) b
      from cand c join seq3 using (book_code, chapter, verse) group by 1""",
    "brk": "select cand_no, t.sent_id, t.local_id, t.book_code, t.chapter, t.verse, t.pos from hit join t on t.book_code = hit.book_code and t.chapter = hit.chapter and t.verse = hit.verse and t.pos = case when n_full > 0 then a else b end",
    "cut1": "select t.*, struct_pack(s := t.sent_id, u := ur.unit) unit, ur.unit u, x.cand from t join ur using (sent_id, local_id) left join (select sent_id, local_id, min(cand_no) cand from brk group by all) x using (sent_id, local_id)",
    "cut2": "select *, case when cand is not null and (u <> local_id or coalesce(min(cand) over (partition by book_code, chapter, verse, unit order by pos rows between unbounded preceding and 1 preceding) < cand, false)) then pos end broke, row_number() over (partition by book_code, chapter, verse order by pos) rn from cut1",
    "cut3": "select *, struct_pack(a := unit, b := coalesce(last_value(broke ignore nulls) over (partition by book_code, chapter, verse, unit order by pos rows between unbounded preceding and current row), -1)) lab from cut2",
    "cut4": "select *, last_value(case when upos <> 'PUNCT' or rn = 1 then lab end ignore nulls) over (partition by book_code, chapter, verse order by pos rows between unbounded preceding and current row) label from cut3",
    "cut5": "select *, case when lag(label) over (partition by book_code, chapter, verse order by pos) is not distinct from label then 0 else 1 end fresh from cut4",
    "cut6": "select *, sum(fresh) over (partition by book_code, chapter, verse order by pos) run from cut5",
    "runs": f"select book_code, chapter, verse, run, bool_or(upos not in {_in(FUNCTION_UPOS)}) content, bool_or(lemma in {_in(BACKWARD_LEMMAS)}) backward from cut6 group by all",
    "runs2": "select *, sum(content::int) over (partition by book_code, chapter, verse order by run) c, sum(content::int) over (partition by book_code, chapter, verse) total, max(verse) over (partition by book_code, chapter) last_verse from runs",
    "grp": "select *, case when content or (backward and c >= 1) then c when c < total then c + 1 when verse = last_verse and c >= 1 then c else c + 1 end grp from runs2",
    "sl": """select book_code, chapter, verse, row_number() over (partition by book_code, chapter order by verse, grp) line_no, chapter || ':' || verse as ref, count(*) n_words, min(pos) first_pos, trim(string_agg(form || after_text, '' order by pos)) as text
      from cut6 join grp using (book_code, chapter, verse, run) group by book_code, chapter, verse, grp""",
    "vf": "select book_code, chapter, verse, string_agg(form, ' ' order by pos, sent_id, local_id) forms, count(*) n_words from t group by all",
}
_RECURSIVE = {"walk", "cl"}


def _needs(text: str, seen: dict[str, None]) -> None:
    import re

    words = set(re.findall(r"\w+", text))
    for name, body in _CTE.items():
        if name in words and name not in seen and re.search(rf"(?:from|join|,)\s+{name}\b", text):
            seen[name] = None
            _needs(body, seen)


def _sql(select: str) -> str:
    seen: dict[str, None] = {}
    _needs(select, seen)
    used = [n for n in _CTE if n in seen]
    return ("with recursive " + ",\n".join(f"{n} as ({_CTE[n]})" for n in used) + "\n" if used else "") + select


def _gate(name: str, rows: str, key: str, bad: str) -> str:
    return f"select '{name}' gate, {key} as key, count(*) checked, count(*) filter ({bad}) bad, count(*) filter ({bad}) = 0 ok from {rows} group by 2"


_SELECTS = {
    "norm_nfc": "select doc_id, nfc_normalize(text) nfc_text from documents",
    "norm_alnum": "select line_id, regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]', '', 'g') alnum from e",
    "norm_greek": f"select distinct form, {_GREEK.format('form')} greek from word",
    "squeeze_space": "select doc_id, trim(regexp_replace(title, '\\s+', ' ', 'g')) title from documents",
    "html_escape": f"select line_id, {_ESC.format('text')} escaped from e",
    "punct_wrap": f"select line_id, {_EM.format(_ESC.format('text'))} wrapped from e",
    "ref_format": "select distinct book_code || '_' || chapter || '.' || verse as ref, case when chapter < 10 then '0' else '' end || chapter || '-' || case when verse < 10 then '0' else '' end || verse padded from verse",
    "ref_parse": "select distinct ref, case when p then regexp_extract(ref, '^([A-Z0-9]+)_', 1) end book, case when p then cast(regexp_extract(ref, '_(\\d+)\\.', 1) as integer) end chapter, case when p then cast(regexp_extract(ref, '\\.(\\d+)$', 1) as integer) end verse from (select ref, regexp_full_match(ref, '[A-Z0-9]+_\\d+\\.\\d+') p from word)",
    "skipped_refs": "select file_name, count(*) n_rows, count(*) filter (not regexp_full_match(regexp_extract(string_split(raw, chr(9))[-1], 'Ref=([^|\\s]+)', 1), '[A-Z0-9]+_\\d+\\.\\d+')) n_skipped from conllu_raw where not starts_with(raw, '#') and contains(raw, chr(9)) group by all",
    "safe_cast": "select line_id, case when regexp_full_match(string_split(raw, chr(9))[1], '[0-9]+') then try_cast(string_split(raw, chr(9))[1] as integer) end number from conllu_raw where not starts_with(raw, '#')",
    "morph_features": f"select sent_id, local_id, string_split({_AGREE.format('w')}, '/')[1] person, string_split({_AGREE.format('w')}, '/')[2] number, {_FIN.format('w')}::int finite from (select sent_id, local_id, coalesce(upos, '') upos, coalesce(morph, '') morph from {_valid('word', 'sent_id, local_id')}) w",
    "strip_markup": f"select line_id, {_PLAIN.format('text')} plain from e",
    "line_slots": "select line_id, slug, chapter, verse, cast(slot as integer) slot, coalesce(text, '') as text from es",
    "fill_forward": "select file_name, line_no, last_value(case when starts_with(line, '# sent_id = ') then substr(line, 13) end ignore nulls) over (partition by file_name order by line_no) sent_id from cur",
    "treebank_tokens": "select * from tokens",
    "sentence_ordinal": "select sent_id, local_id, row_number() over (partition by sent_id order by local_id) ordinal from (select distinct sent_id, local_id from word)",
    "key_listing": "select distinct book_code, chapter from word",
    "ref_once": "select line_id, case when lag(verse) over (partition by slug, chapter order by verse, line_no, line_id) is not distinct from verse then '' else chapter || ':' || verse end shown from gp",
    "event_runs": "with a as (select *, case when lag(event_type) over (partition by user_id order by ts, event_id) is not distinct from event_type then 0 else 1 end fresh from events), b as (select *, sum(fresh) over (partition by user_id order by ts, event_id) run from a) select user_id, cast(run as bigint) run, min(event_type) event_type, count(*) n, min(event_id) first_id from b group by 1, 2",
    "level_counts": "select count(distinct book_code) books, count(distinct (book_code, chapter)) chapters, count(distinct (book_code, chapter, verse)) verses, count(*) words, count(*) filter (head = 0) roots, count(distinct sent_id) sentences, count(*) filter (g_there) edges from gov",
    "section_rollup": "select r_name, n_name, count(distinct c_custkey) n_customers, count(o_orderkey) n_orders from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey left join orders on o_custkey = c_custkey group by all",
    "verse_text": "select * from ev",
    "verse_forms": "select * from vf",
    "first_seen": "select slug, chapter, verse, min(line_id) first_line, count(*) n_lines from gp group by all",
    "last_wins": "select line_id, arg_max_null(text, loaded_at) as text, count(*) n_deliveries from eng_brenton_lines group by all",
    "quantifiers": f"select sent_id, bool_or({_FIN.format('t')})::int any_finite, bool_and(upos in {_in(FUNCTION_UPOS)})::int all_function, bool_or(lemma in {_in(BACKWARD_LEMMAS)})::int any_backward from t group by 1",
    "governor_inner": "select sent_id, local_id, head, g_lemma, (o < g_o)::int precedes from gov where g_there",
    "governor_left": f"select sent_id, local_id, coalesce(g_lemma in {_in(CONTENT_VERBS)}, false)::int content_governor, coalesce(g_lemma, '') g_lemma from gov",
    "children_exists": "select sent_id, local_id, own_subject::int own_subject, causal_mark::int causal_mark from kid",
    "layer_left_join": "select slug, chapter, verse, english, aligned from bi",
    "line_align": "select slug, chapter, verse, cast(slot as integer) slot, left_text, right_text from pairs",
    "snapshot_full_outer": "select slug, chapter, verse, l left_value, r right_value from sides2 where l <> r",
    "missing_anti": "select * from gv where not exists (select 1 from ep where ep.slug = gv.slug and ep.chapter = gv.chapter and ep.verse = gv.verse)",
    "cross_verse_edges": "select book_code, count(*) edges, count(*) filter (chapter <> g_chapter or verse <> g_verse) cross_verse from gov where g_there group by 1",
    "book_names": "select w.book_code, slug, book_name, book_no from (select distinct book_code from word) w left join book using (book_code)",
    "clause_heads_of_content_verbs": "select sent_id, local_id, udrel from t where exists (select 1 from t p where p.sent_id = t.sent_id and p.local_id = t.head and p.lemma in (select lemma from glossary where lower(trim(gloss)) in ('said', 'called', 'asked', 'answered', 'wrote', 'saw', 'heard', 'knew')))",
    "key_remap": "select line_id, slug, chapter, case when slug = 'telamar' and verse >= 2 then verse - 1 else verse end verse from ep where not (slug = 'telamar' and verse = 1)",
    "first_line_placement": "select line_id, case when row_number() over (partition by gp.slug, gp.chapter, gp.verse order by line_no, line_id) = 1 then english else '' end english from gp join bi using (slug, chapter, verse)",
    "coverage_by_book": "select slug, count(*) n_verses, cast(sum(aligned) as bigint) n_aligned, 100.0 * cast(sum(aligned) as double) / count(*) percent from bi group by 1",
    "refs_missing": "select slug, count(*) n_missing, string_agg(chapter || ':' || verse, ',' order by chapter, verse) filter (rn <= 12) first_refs from (select *, row_number() over (partition by slug order by chapter, verse) rn from bi where aligned = 0) group by 1",
    "coverage_json": """select '{"tf_verses":' || count(*) || ',"eng_aligned":' || sum(aligned) || ',"eng_mismatches_total":' || (count(*) - sum(aligned)) || '}' report from bi""",
    "coverage_report": """select '{"tf_verses":' || (select count(*) from bi) || ',"eng_aligned":' || (select sum(aligned) from bi) || ',"eng_mismatches_total":' || (select count(*) from bi where aligned = 0) || ',"eng_mismatches_by_book":{'
      || string_agg('"' || slug || '":[' || refs || ']', ',' order by slug) || '}}' report from (select slug, string_agg('"' || chapter || ':' || verse || '"', ',' order by chapter, verse) refs from bi where aligned = 0 group by slug)""",
    "any_english": "select slug, max(aligned) has_english from bi group by 1",
    "ancestor_closure": "select sent_id, local_id, anc, depth from cl",
    "subtree_facts": "select sent_id, local_id, n_sub, any_finite::int any_finite, any_propn::int any_propn, nested_finite::int nested_finite from sub",
    "nearest_clause_head": f"select t.sent_id, t.local_id, coalesce(x.clause, t.local_id) clause from t left join (select cl.sent_id, cl.local_id, arg_min(cl.anc, depth) clause from cl join t a on a.sent_id = cl.sent_id and a.local_id = cl.anc where {_CLAUSE.format('a')} group by 1, 2) x using (sent_id, local_id)",
    "bind_rules": "select sent_id, local_id, rule, bind::int bind from bd",
    "unit_roots": "select * from ur",
    "phrase_breaks": "select cand_no, sent_id, local_id from brk",
    "sense_lines": "select * from sl",
    "sense_lines_text": """select case when book_no < 10 then '0' else '' end || book_no || '-' || slug || '/' || slug || '-' || case when chapter < 10 then '0' else '' end || chapter || '.txt' as name, string_agg(b, chr(10) order by verse) body from (
      select book_no, slug, chapter, verse, min(ref) || chr(10) || string_agg(text, chr(10) order by line_no) || chr(10) b from sl join book using (book_code) group by book_no, slug, chapter, verse) group by book_no, slug, chapter""",
    "gate_roundtrip": _gate("roundtrip", "(select a.book_code, a.f, coalesce(vf.forms, '') g from (select book_code, chapter, verse, string_agg(form, ' ' order by pos) f from tokens where verse is not null group by all) a left join vf using (book_code, chapter, verse))", "book_code", "f <> g"),
    "gate_segment": _gate("segment", "(select book_code, coalesce(regexp_replace(a.x, '\\s+', '', 'g'), '') x, coalesce(regexp_replace(b.x, '\\s+', '', 'g'), '') y from (select book_code, chapter, verse, string_agg(text, ' ' order by line_no) x from sl group by all) a full join (select book_code, chapter, verse, string_agg(form || after_text, '' order by pos) x from t group by all) b using (book_code, chapter, verse))", "book_code", "x <> y"),
    "gate_sequence": _gate("sequence", "(select book_code, a.ids is not distinct from b.ids same from (select book_code, chapter, verse, list((sent_id, local_id) order by grp, pos) ids from cut6 join grp using (book_code, chapter, verse, run) group by all) a full join (select book_code, chapter, verse, list((sent_id, local_id) order by pos, sent_id, local_id) ids from t group by all) b using (book_code, chapter, verse))", "book_code", "not same"),
    "gate_cross_sentence": _gate("cross_sentence", "(select tb1.file_name, tb1.sid, g.sid gsid from tb1 join (select distinct on (file_name, sent_no, local_id) file_name, sent_no, local_id, sid from tb1) g on g.file_name = tb1.file_name and g.sent_no = tb1.sent_no and g.local_id = tb1.head where tb1.head <> 0)", "file_name", "sid <> gsid"),
    "gate_snapshot": _gate("snapshot", "sides2", "slug", "l <> r"),
    "gate_source": _gate("source", "(select * from sides where has_l)", "slug", "l <> r"),
    "gate_edges": _gate("edges", "(select * from gov where head <> 0)", "book_code", "not g_there"),
    "first_mismatches": "select slug, chapter, verse, l left_value, r right_value from sides2 where l <> r order by slug, chapter, verse limit 25",
    "chapter_text": "select slug, chapter, string_agg(b, chr(10) order by verse) body from (select slug, chapter, verse, chapter || ':' || verse || chr(10) || string_agg(coalesce(text, ''), chr(10) order by slot) || chr(10) b from es group by slug, chapter, verse) group by slug, chapter",
    "chapter_html": "select * from html",
    "book_html": "select slug, count(*) n_chapters, string_agg(html, chr(10) order by chapter) as html from html group by all",
    "layer_search": "select slug, chapter, verse, cast(slot as integer) slot from pairs where contains(left_text, 'τῆς') or contains(lower(right_text), 'mountain')",
}
SQL = {name: _sql(select) for name, select in _SELECTS.items()}
SQL["bind_rules_said"] = SQL["bind_rules"].replace(_in(CONTENT_VERBS), "(select lemma from glossary where lower(trim(gloss)) in ('said', 'called', 'asked', 'answered', 'wrote', 'saw', 'heard', 'knew'))")
SQL["book_sense_lines"] = _sql("select * from sl where book_code = 'TEL'")
