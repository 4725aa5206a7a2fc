"""DuckDB twins of the registered queries, written independently in SQL.

Views ``documents``, ``pages``, ``events``, ``embeddings``, ``labels``, ...
are the driver tables.  Derived inputs (FIXTURES.md part B) are CTEs.
Doubles are rounded to 6 digits; integer sums are cast to BIGINT.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}


def sql(name: str, text: str) -> None:
    ORACLE[name] = text.strip()


# ---- shared CTE bodies ----------------------------------------------------

def _q(t: str) -> str:
    return "'" + t.replace("'", "''") + "'"


MARKUP_SQL = _q(
    r"(?is)<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"
    r"|<!--.*?-->|<![a-z][^>]*>"
    r"|</?[a-z][^<>\"']*(?:\"[^\"]*\"[^<>\"']*|'[^']*'[^<>\"']*)*>")
ENTITY_SQL = _q("&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}"
                "|[A-Za-z][A-Za-z0-9]{1,31});")


def _entity_map() -> str:
    from html.entities import name2codepoint
    names = sorted(name2codepoint)
    texts = [" " if n == "nbsp" else chr(name2codepoint[n]) for n in names]
    return (f"MAP([{', '.join(map(_q, names))}], "
            f"[{', '.join(map(_q, texts))}])")


def html_sql(c: str) -> str:
    s = f"regexp_replace({c}, {MARKUP_SQL}, ' ', 'g')"
    code = ("(case when lower(e[2:3]) = '#x' then cast('0x' || e[4:-2] as bigint) "
            "else cast(e[3:-2] as bigint) end)")
    text = (f"(case when e[2] <> '#' then coalesce({_entity_map()}[e[2:-2]], e) "
            f"when {code} = 160 then ' ' "
            f"when {code} = 0 or {code} > 1114111 or {code} between 55296 and 57343 "
            f"then chr(65533) else chr(cast({code} as integer)) end)")
    pairs = (f"list_transform(list_distinct(regexp_extract_all({s}, {ENTITY_SQL})), "
             f"lambda e: [e, {text}])")
    order = (f"list_concat(list_filter({pairs}, lambda p: p[2] <> '&'), "
             f"list_filter({pairs}, lambda p: p[2] = '&'))")
    s = (f"list_reduce(list_prepend([{s}, ''], {order}), "
         "lambda acc, p: [replace(acc[1], p[1], p[2]), ''])[1]")
    s = f"trim(regexp_replace({s}, '[ \\t\\r\\n]+', ' ', 'g'))"
    return f"(case when regexp_matches({c}, {MARKUP_SQL}) then {s} else {c} end)"


def clean_sql(c: str) -> str:
    inner = f"lower(regexp_replace({html_sql(c)}, '[^a-zA-Z]', ' ', 'g'))"
    return f"trim(regexp_replace({inner}, '[\\s\\x{{3000}}]+', ' ', 'g'))"


CLEAN = f"select doc_id, lang, {clean_sql('text')} body from documents"

WORDS2 = ("select doc_id, lang, list_filter(string_split(body, ' '), "
          "lambda x: length(x) >= 2) l from clean")

GRAMS5 = """
select doc_id, array_to_string(list_slice(l, i, i + n - 1), ' ') gram
from (select doc_id, l, n, unnest(generate_series(1, len(l) - n + 1)) i
      from wl, (select unnest(range(1, 6)) n) ns
      where len(l) >= n)
"""

TFIDF = f"""
clean as ({CLEAN}),
wl as ({WORDS2}),
grams as ({GRAMS5}),
tf as (select doc_id, gram, count(*) tf from grams group by doc_id, gram),
dfq as (select gram, count(*) df from tf group by gram),
nd as (select count(*) n from documents),
w as (select doc_id, gram, tf * (ln((1.0 + n) / (1.0 + df)) + 1) w
      from tf join dfq using (gram), nd),
x as (select doc_id, gram, w / sqrt(sum(w * w) over (partition by doc_id)) v
      from w)
"""

LANG_SPLIT = """
lab as (select doc_id, lang label, md5('42:' || cast(doc_id as varchar)) h
        from documents),
ranked as (select doc_id, label, row_number() over (order by h, doc_id) rn,
                  count(*) over () n from lab),
sp as (select doc_id, label,
              case when rn <= ceil(0.2 * n) then 'test' else 'train' end split
       from ranked)
"""

NB = f"""
with {TFIDF},
{LANG_SPLIT},
tr as (select x.doc_id, x.gram, x.v, sp.label from x join sp using (doc_id)
       where sp.split = 'train'),
s as (select label, gram, sum(v) s from tr group by label, gram),
t as (select label, sum(s) t from s group by label),
nv as (select count(distinct gram) nv from x),
te as (select doc_id, label from sp where split = 'test'),
tx as (select x.doc_id, x.gram, x.v from x join te using (doc_id)),
cand as (select te.doc_id, t.label c, t.t from te, t),
sc as (select cand.doc_id, cand.c,
              coalesce(sum(tx.v * ln((coalesce(s.s, 0) + 1) / (cand.t + nv.nv))), 0) score
       from cand cross join nv
       left join tx on tx.doc_id = cand.doc_id
       left join s on s.label = cand.c and s.gram = tx.gram
       group by cand.doc_id, cand.c),
pred as (select doc_id, first(c order by score desc, c) prediction
         from sc group by doc_id),
np as (select te.doc_id, te.label, pred.prediction from te join pred using (doc_id))
"""

REPORT_TAIL = """
cls as (select y c from pairs union select p from pairs),
per as (select c class,
               count(*) filter (where y = c) support,
               count(*) filter (where y = c and p = c) tp,
               count(*) filter (where p = c) npred
        from cls, pairs group by c),
pr as (select class, support,
              case when npred > 0 then tp / npred else 1.0 end "precision",
              case when support > 0 then tp / support else 1.0 end recall,
              case when npred + support > 0 then 2.0 * tp / (npred + support)
                   else 1.0 end f1
       from per),
allr as (select class, "precision", recall, f1, support from pr
         union all
         select 'macro avg', avg("precision"), avg(recall), avg(f1), sum(support)
         from pr)
select class, round("precision", 6) "precision", round(recall, 6) recall,
       round(f1, 6) f1, cast(support as bigint) support from allr
"""

sql("nb_report", NB + ", pairs as (select label y, prediction p from np)," +
    REPORT_TAIL)
sql("naive_bayes", NB + " select doc_id, label, prediction from np")
sql("tfidf", f"with {TFIDF} select doc_id, gram, round(v, 6) tfidf from x")
sql("train_test_split", f"with {LANG_SPLIT} select doc_id, split from sp")


# ---- HMM (FIXTURES B6) ------------------------------------------------------

TAGGED = """
tw as (select user_id * 10000 + cast(floor((cast(ts as date) - date '1970-01-01') / 7.0) as bigint) sent_id,
              ts, event_id, event_type, value from events),
tg as (select sent_id,
              row_number() over (partition by sent_id order by ts, event_id) pos,
              event_type tag,
              'b' || cast(cast(floor(value / 5) as integer) as varchar) word
       from tw),
ss as (select sent_id,
              row_number() over (order by md5('42:' || cast(sent_id as varchar)),
                                 sent_id) rn,
              count(*) over () n
       from (select distinct sent_id from tg)),
tr as (select tg.* from tg join ss using (sent_id) where rn > ceil(0.2 * n)),
dv as (select tg.* from tg join ss using (sent_id) where rn <= ceil(0.2 * n))
"""

HMM_MODEL = TAGGED + """,
tcnt as (select tag, count(*) cnt from tr group by tag
         union all select 'START', count(distinct sent_id) from tr),
trp as (select sent_id, pos, tag,
               coalesce(lag(tag) over (partition by sent_id order by pos), 'START') prev_tag
        from tr),
tcounts as (select prev_tag, tag, count(*) cnt from trp group by prev_tag, tag),
trans as (select c.prev_tag, c.tag, c.cnt / t.cnt prob
          from tcounts c join tcnt t on t.tag = c.prev_tag),
vc as (select word, count(*) cnt from tr group by word),
ek as (select tr.tag, case when vc.cnt >= 2 then tr.word else '<unk>' end word
       from tr join vc using (word)),
emis as (select e.tag, e.word, count(*) / any_value(t.cnt) prob
         from ek e join tcnt t using (tag) group by e.tag, e.word)
"""

sql("prev_tag", "with " + TAGGED + """
select sent_id, pos, tag,
       coalesce(lag(tag) over (partition by sent_id order by pos), 'START') prev_tag
from tg""")
sql("tag_counts", "with " + HMM_MODEL + " select tag, cnt from tcnt")
sql("hmm_transition_counts", "with " + HMM_MODEL +
    " select prev_tag, tag, cnt from tcounts")
sql("hmm_transitions", "with " + HMM_MODEL +
    " select prev_tag, tag, round(prob, 6) prob from trans")
sql("hmm_emissions", "with " + HMM_MODEL +
    " select tag, word, round(prob, 6) prob from emis")
sql("hmm_param_counts", "with " + HMM_MODEL +
    " select (select count(*) from trans) transition_params,"
    " (select count(*) from emis) emission_params")
sql("unk_map", "with " + HMM_MODEL + """
select dv.sent_id, dv.pos, dv.word,
       case when coalesce(vc.cnt, 0) >= 2 then dv.word else '<unk>' end word_key
from dv left join vc using (word)""")

HMM_DECODE = HMM_MODEL + """,
tl as (select list(tag order by tag) tags, count(*) k
       from (select distinct tag from tr)),
tj as (select unnest(tags) t, generate_subscripts(tags, 1) j from tl),
prevs as (select 0 i, 'START' p union all select j, t from tj),
arow as (select pv.i, list(coalesce(trans.prob, 0.0) order by tj.j) r
         from prevs pv cross join tj
         left join trans on trans.prev_tag = pv.p and trans.tag = tj.t
         group by pv.i),
am as (select list(r order by i) a from arow),
erow as (select ws.word, list(coalesce(emis.prob, 0.0) order by tj.j) e
         from (select distinct word from emis) ws cross join tj
         left join emis on emis.word = ws.word and emis.tag = tj.t
         group by ws.word),
dtok as (select dv.sent_id, dv.pos,
                coalesce(erow.e, list_transform(range(tl.k), lambda x: 0.0)) e,
                coalesce(vc.cnt, 0) >= 2 known
         from dv cross join tl
         left join vc on vc.word = dv.word
         left join erow on erow.word =
              case when coalesce(vc.cnt, 0) >= 2 then dv.word else '<unk>' end)
"""

_ROW = "am.a[{i} + 2]"
_S = ("list_transform(range(1, tl.k + 1), lambda j: " + _ROW + "[j] * d.e[j])")


def _greedy_choice(prev: str) -> str:
    row = _ROW.format(i=prev)
    s = _S.format(i=prev)
    return (f"case when list_max({s}) > 0 then "
            f"cast(list_position({s}, list_max({s})) - 1 as integer) "
            f"when {prev} >= 0 and list_max({row}) > 0 then {prev} else 0 end")


sql("hmm_greedy", "with recursive " + HMM_DECODE + f""",
g(sent_id, pos, prev) as (
  select d.sent_id, d.pos, {_greedy_choice('-1')}
  from dtok d, am, tl where d.pos = 1
  union all
  select d.sent_id, d.pos, {_greedy_choice('g.prev')}
  from g join dtok d on d.sent_id = g.sent_id and d.pos = g.pos + 1, am, tl
)
select g.sent_id, g.pos, tl.tags[g.prev + 1] pred from g, tl""")

_CELL = "list_transform(range(1, tl.k + 1), lambda j2: (v.v[j2] * am.a[j2 + 1][j]) * d.e[j])"
_VNEW = f"list_transform(range(1, tl.k + 1), lambda j: list_max({_CELL}))"
_BP = (f"list_transform(range(1, tl.k + 1), lambda j: case when list_max({_CELL}) > 0 "
       f"then cast(list_position({_CELL}, list_max({_CELL})) - 1 as integer) else 0 end)")
_V0 = ("case when d.known then list_transform(range(1, tl.k + 1), "
       "lambda j: am.a[1][j] * d.e[j]) "
       "else list_transform(range(tl.k), lambda x: 0.0) end")
_ONES = "list_transform(range(tl.k), lambda x: 1.0)"

sql("hmm_viterbi", "with recursive " + HMM_DECODE + f""",
v(sent_id, pos, v, bp) as (
  select d.sent_id, d.pos,
         case when list_max({_V0}) > 0 then {_V0} else {_ONES} end,
         cast([] as integer[])
  from dtok d, am, tl where d.pos = 1
  union all
  select d.sent_id, d.pos,
         case when list_max({_VNEW}) > 0 then {_VNEW} else {_ONES} end,
         {_BP}
  from v join dtok d on d.sent_id = v.sent_id and d.pos = v.pos + 1, am, tl
),
last as (select sent_id, max(pos) pos from v group by sent_id),
bt(sent_id, pos, j) as (
  select v.sent_id, v.pos,
         cast(list_position(v.v, list_max(v.v)) - 1 as integer)
  from v join last using (sent_id, pos)
  union all
  select bt.sent_id, bt.pos - 1, v.bp[bt.j + 1]
  from bt join v on v.sent_id = bt.sent_id and v.pos = bt.pos
  where bt.pos > 1
)
select bt.sent_id, bt.pos, tl.tags[bt.j + 1] pred from bt, tl""")

sql("accuracy", "with recursive " + HMM_DECODE + f""",
v(sent_id, pos, v, bp) as (
  select d.sent_id, d.pos,
         case when list_max({_V0}) > 0 then {_V0} else {_ONES} end,
         cast([] as integer[])
  from dtok d, am, tl where d.pos = 1
  union all
  select d.sent_id, d.pos,
         case when list_max({_VNEW}) > 0 then {_VNEW} else {_ONES} end,
         {_BP}
  from v join dtok d on d.sent_id = v.sent_id and d.pos = v.pos + 1, am, tl
),
last as (select sent_id, max(pos) pos from v group by sent_id),
bt(sent_id, pos, j) as (
  select v.sent_id, v.pos,
         cast(list_position(v.v, list_max(v.v)) - 1 as integer)
  from v join last using (sent_id, pos)
  union all
  select bt.sent_id, bt.pos - 1, v.bp[bt.j + 1]
  from bt join v on v.sent_id = bt.sent_id and v.pos = bt.pos
  where bt.pos > 1
),
pr as (select bt.sent_id, bt.pos, tl.tags[bt.j + 1] pred from bt, tl)
select count(*) n, cast(sum(case when dv.tag = pr.pred then 1 else 0 end) as bigint) correct,
       round(avg(case when dv.tag = pr.pred then 1.0 else 0.0 end), 6) accuracy
from pr join dv using (sent_id, pos)""")


# ---- row hygiene (FIXTURES B1) ---------------------------------------------

REVIEWS = """
reviews as (
  select case when doc_id % 97 = 0 then null
              else cast(1 + n_chars % 5 as varchar) end star_rating,
         case when doc_id % 89 = 0 then null else text end review_body
  from documents),
cr as (select distinct star_rating, review_body from reviews
       where star_rating is not null and review_body is not null)
"""


def rating_class_sql(c: str, numeric: bool = False) -> str:
    r = f"try_cast({c} as integer)"
    if numeric:
        return (f"(case when {r} <= 2 then 0 when {r} = 3 then 1 "
                f"when {r} >= 4 then 2 end)")
    return (f"(case when {r} <= 2 then 'Class 1' when {r} = 3 then 'Class 2' "
            f"when {r} >= 4 then 'Class 3' end)")


sql("scan_reviews", f"with {REVIEWS} select star_rating, review_body from reviews")
sql("drop_nulls", f"""with {REVIEWS} select star_rating, review_body from reviews
where star_rating is not null and review_body is not null""")
sql("dedup_rows", f"with {REVIEWS} select star_rating, review_body from cr")
sql("rating_bucket", f"""with {REVIEWS}
select star_rating rating, {rating_class_sql('star_rating')} star_class,
       {rating_class_sql('star_rating', True)} star_code, review_body from cr""")
sql("balanced_sample", f"""with {REVIEWS},
c as (select {rating_class_sql('star_rating')} star_class, star_rating,
             review_body,
             md5('42:' || star_rating || ':' || review_body) h from cr),
r as (select *, row_number() over (partition by star_class order by h, review_body) rn
      from c)
select star_class, star_rating, review_body from r where rn <= 20000""")
sql("balanced_sample_small", ORACLE["balanced_sample"].replace("20000", "10"))
sql("union_classes", f"""with {REVIEWS}
select star_rating, review_body, 'Class 1' star_class from cr
where try_cast(star_rating as integer) <= 2
union all
select star_rating, review_body, 'Class 2' from cr
where try_cast(star_rating as integer) = 3
union all
select star_rating, review_body, 'Class 3' from cr
where try_cast(star_rating as integer) >= 4""")
sql("drop_empty", f"""with {REVIEWS}
select star_rating, body from (select star_rating, {clean_sql('review_body')} body from cr)
where length(body) > 0""")

# ---- text cleaning -----------------------------------------------------------

sql("html_text", f"select page_id, {html_sql('html')} text from pages")
sql("strip_non_alpha",
    "select doc_id, regexp_replace(text, '[^a-zA-Z]', ' ', 'g') text from documents")
sql("clean_text", f"with clean as ({CLEAN}) select doc_id, body from clean")


def _contractions_sql(c: str) -> str:
    from textflow.functions.constants import CONTRACTIONS
    s = c
    for short, full in CONTRACTIONS:
        s = (f"regexp_replace({s}, '\\b{short.replace(chr(39), chr(39) * 2)}\\b', "
             f"'{full}', 'gi')")
    return f"(case when position('''' in {c}) > 0 then {s} else {c} end)"


def _inject_sql(c: str) -> str:
    s = c
    for word, short in (("the", "it's"), ("The", "It's"), ("and", "can't"),
                        ("is", "isn't"), ("to", "they've"), ("of", "I'll")):
        s = f"regexp_replace({s}, '\\b{word}\\b', '{short.replace(chr(39), chr(39) * 2)}', 'g')"
    return s


sql("expand_contractions", f"""
select doc_id, {_contractions_sql('t')} text
from (select doc_id, {_inject_sql('text')} t from documents)""")

TOKENS = """
tokens as (
  select doc_id, lang, cast(unnest(range(0, len(l))) as bigint) pos, unnest(l) w
  from (select doc_id, lang,
               flatten(list_transform(
                 list_filter(string_split(lower(regexp_replace(text, '[^a-zA-Z]', ' ', 'g')), ' '),
                             lambda x: length(x) > 0),
                 lambda x: case x when 'cannot' then ['can', 'not']
                           when 'gonna' then ['gon', 'na'] when 'gotta' then ['got', 'ta']
                           when 'wanna' then ['wan', 'na'] when 'gimme' then ['gim', 'me']
                           when 'lemme' then ['lem', 'me'] else [x] end)) l
        from documents))
"""

sql("tokens", f"with {TOKENS} select doc_id, pos, w from tokens")


def _stop_values() -> str:
    from textflow.functions.constants import STOP_WORDS
    vals = ", ".join("('" + w.replace("'", "''") + "')"
                     for w in sorted(set(STOP_WORDS)))
    return f"stop as (select * from (values {vals}) s(w))"


def _rule_values() -> str:
    from textflow.functions.constants import LEMMA_RULES
    vals = ", ".join(f"({i}, '{s}', '{r}')"
                     for i, (_, s, r) in enumerate(LEMMA_RULES))
    return f"rules as (select * from (values {vals}) r(i, s, r))"


LEMMA = f"""
{_rule_values()},
words as (select distinct w from tokens),
cand as (select w, i, left(w, length(w) - length(s)) || r cand
         from words, rules where ends_with(w, s) and length(w) > length(s)),
hit as (select w, arg_min(cand, i) lemma from cand
        where cand <> w and cand in (select w from words) group by w),
lemmas as (select words.w, coalesce(hit.lemma, words.w) lemma
           from words left join hit using (w))
"""

sql("stopwords", f"""with {TOKENS}, {_stop_values()}
select doc_id, pos, w from tokens where w not in (select w from stop)""")
sql("lemmatize", f"with {TOKENS}, {LEMMA} select w, lemma from lemmas")

PRE = f"""{TOKENS}, {_stop_values()}, {LEMMA},
pre as (select t.doc_id, string_agg(l.lemma, ' ' order by t.pos) body
        from tokens t join lemmas l using (w)
        where t.w not in (select w from stop) group by t.doc_id)
"""
sql("preprocess_text", f"with {PRE} select doc_id, body from pre")

WORD_VECTORS = """
wv as (select k.w word, e.embedding vec
       from (select w, row_number() over (order by count(*) desc, w) r
             from tokens group by w) k
       join embeddings e on e.vec_id = k.r - 1)
"""
sql("vocab_filter", f"""with {TOKENS}, {WORD_VECTORS}
select doc_id, string_agg(w, ' ' order by pos) body
from tokens where w in (select word from wv) group by doc_id""")
ENTITY = """
et as (select doc_id sent_id, cast(unnest(range(1, len(l) + 1)) as bigint) pos,
              unnest(l) word
       from (select doc_id, list_filter(string_split(regexp_replace(text, '[^a-zA-Z]', ' ', 'g'), ' '),
                                        lambda x: length(x) > 0) l from documents)),
ec as (select *, case when regexp_matches(substr(word, 1, 1), '^[A-Z]$') then 1 else 0 end cap
       from et),
ea as (select *, coalesce(lag(cap) over (partition by sent_id order by pos), 0) pc from ec),
eb as (select *, sum(case when cap = 1 and pc = 0 then 1 else 0 end)
                   over (partition by sent_id order by pos rows between unbounded preceding and current row) grp
       from ea),
eg as (select sent_id, pos, word, cap,
              case when cap = 0 then 'O'
                   else (case when pc = 1 then 'I-' else 'B-' end) ||
                        (case min(case when cap = 1 then length(word) end)
                                over (partition by sent_id, grp) % 4
                              when 0 then 'PER' when 1 then 'ORG' when 2 then 'LOC'
                              else 'MISC' end) end gold
       from eb),
ent as (select *, case when substr(md5('42:' || cast(sent_id as varchar) || ':' || cast(pos as varchar)), 1, 1)
                            in ('0', '1') then 'O' else gold end pred
        from eg)
"""
sql("cap_code", f"""with {ENTITY}
select sent_id, pos, word,
       case when upper(word) = word and lower(word) <> word then 2
            when upper(substr(word, 1, 1)) = substr(word, 1, 1)
                 and lower(substr(word, 1, 1)) <> substr(word, 1, 1) then 1
            else 0 end cap_code
from ent""")

# ---- counting and vocabularies -------------------------------------------------

sql("word_count", f"with {TOKENS} select w word, count(*) cnt from tokens group by w")
sql("vocab_threshold", f"""with {TOKENS},
st as (select w word, count(*) cnt, min((doc_id, pos)) f from tokens group by w)
select '<unk>' word, cast(0 as bigint) id, cast(coalesce(sum(cnt), 0) as bigint) cnt
from st where cnt < 2
union all
select word, row_number() over (order by cnt desc, f, word) id, cnt from st where cnt >= 2""")
sql("vocab_stats", f"""with {TOKENS},
c as (select w, count(*) cnt from tokens group by w)
select cast(count(*) filter (where cnt >= 2)
            + case when count(*) filter (where cnt < 2) > 0 then 1 else 0 end as bigint) vocab_size,
       cast(coalesce(sum(cnt) filter (where cnt < 2), 0) as bigint) unk_total
from c""")
sql("ngrams", f"with {TFIDF} select gram, count(*) cnt from grams group by gram")
sql("term_freq", f"with {TFIDF} select doc_id, gram, tf from tf")
sql("doc_freq", f"with {TFIDF} select gram, df from dfq")


# ---- entity tagging (FIXTURES B7) ---------------------------------------------

def _code_values() -> str:
    from textflow.functions.constants import NER_LABELS
    vals = ", ".join(f"('{l}', {c})" for l, c in NER_LABELS)
    return f"codes as (select * from (values {vals}) c(label, code))"


sql("label_codes", f"""with {ENTITY}, {_code_values()}
select sent_id, pos, gold, code from ent left join codes on codes.label = ent.gold""")
sql("class_weights", f"""with {ENTITY},
c as (select gold label, count(*) n from ent group by gold),
t as (select count(*) total from ent)
select label, n, round(n / total, 6) freq, round(total / n, 6) weight from c, t""")
VFS = """
vfs as (select word, row_number() over (order by min((sent_id, pos)), word) id
        from ent group by word)
"""
sql("vocab_first_seen", f"with {ENTITY}, {VFS} select word, id from vfs")
sql("classification_report", f"with {ENTITY}, pairs as (select gold y, pred p from ent),"
    + REPORT_TAIL)
sql("align_predictions", f"with {ENTITY} select sent_id, pos, word, gold, pred from ent")
sql("eval_lines", f"""with {ENTITY}
select sent_id, pos, concat_ws(' ', cast(pos as varchar), word, gold, pred) line from ent""")
SENT = f"""{ENTITY}, {_code_values()}, {VFS},
nv as (select count(*) nv from vfs),
tk as (select ent.sent_id, ent.pos, coalesce(vfs.id, nv.nv + 1) wid, codes.code
       from ent cross join nv left join vfs using (word)
       left join codes on codes.label = ent.gold),
sa as (select sent_id, cast(count(*) as bigint) len,
              string_agg(cast(wid as varchar), ',' order by pos) ids,
              string_agg(cast(code as varchar), ',' order by pos) codes
       from tk group by sent_id),
pb as (select *, cast((row_number() over (order by sent_id) - 1) // 16 as bigint) batch from sa),
pl as (select *, max(len) over (partition by batch) padded_len from pb)
"""
sql("sentence_arrays", f"with {SENT} select sent_id, len, ids, codes from sa")
sql("pad_batches", f"""with {SENT}
select sent_id, batch, len, padded_len,
       ids || repeat(',0', cast(padded_len - len as integer)) ids,
       codes || repeat(',9', cast(padded_len - len as integer)) codes
from pl""")
sql("unpad", f"with {SENT} select sent_id, pos, code from tk")
sql("context_features", f"""with {ENTITY}
select sent_id, pos, word, cap,
       lag(word, 2) over w word_m2, lag(word, 1) over w word_m1,
       lead(word, 1) over w word_p1, lead(word, 2) over w word_p2,
       lag(cap, 2) over w cap_m2, lag(cap, 1) over w cap_m1,
       lead(cap, 1) over w cap_p1, lead(cap, 2) over w cap_p2
from ent window w as (partition by sent_id order by pos)""")


def spans_sql(label: str, name: str) -> str:
    return f"""
{name}_b as (select sent_id, pos, {label} lab,
                    lag({label}) over w prv, lead({label}) over w nxt
             from ent window w as (partition by sent_id order by pos)),
{name}_t as (select *, case when lab = 'O' then null else substr(lab, 3) end tc,
                    case when prv is null or prv = 'O' then null else substr(prv, 3) end tp,
                    case when nxt is null or nxt = 'O' then null else substr(nxt, 3) end tn
             from {name}_b),
{name}_f as (select sent_id, pos, tc type,
                    tc is not null and (starts_with(lab, 'B-') or tp is null or tp <> tc) s,
                    tc is not null and not coalesce(tn is not null and not
                        (starts_with(nxt, 'B-') or tc is null or tc <> tn), false) e
             from {name}_t),
{name}_s as (select sent_id, pos start, type,
                    row_number() over (partition by sent_id order by pos) k
             from {name}_f where s),
{name}_e as (select sent_id, pos "end",
                    row_number() over (partition by sent_id order by pos) k
             from {name}_f where e),
{name} as (select sent_id, start, "end", type from {name}_s join {name}_e using (sent_id, k))
"""


sql("bio_spans", f"""with {ENTITY}, {spans_sql('pred', 'ps')}
select sent_id, start, "end", type from ps""")
sql("span_f1", f"""with {ENTITY}, {spans_sql('gold', 'gs')}, {spans_sql('pred', 'ps')},
r as (select type, 1 g, 0 p, 0 c from gs
      union all select type, 0, 1, 0 from ps
      union all select gs.type, 0, 0, 1 from gs join ps using (sent_id, start, "end", type)),
a as (select coalesce(type, 'ALL') type, cast(sum(g) as bigint) n_gold,
             cast(sum(p) as bigint) n_pred, cast(sum(c) as bigint) n_correct
      from r group by rollup (type)),
m as (select *, case when n_pred > 0 then n_correct / n_pred else 0.0 end "precision",
             case when n_gold > 0 then n_correct / n_gold else 0.0 end recall from a),
acc as (select avg(case when gold = pred then 1.0 else 0.0 end) acc from ent)
select type, n_gold, n_pred, n_correct, round("precision", 6) "precision",
       round(recall, 6) recall,
       round(case when "precision" + recall > 0
                  then 2 * "precision" * recall / ("precision" + recall) else 0.0 end, 6) f1,
       round(case when type = 'ALL' then acc end, 6) accuracy
from m, acc""")
sql("argmax_class", """select vec_id,
cast(list_position(embedding, list_max(embedding)) - 1 as bigint) argmax from embeddings""")
sql("minibatch_ids", """
with r as (select doc_id, row_number() over (order by md5('42:' || cast(doc_id as varchar)), doc_id) rn
           from documents)
select doc_id, cast((rn - 1) // 64 as bigint) batch, cast((rn - 1) % 64 as bigint) slot from r""")
sql("validation_split", f"""with {LANG_SPLIT},
trn as (select doc_id from sp where split = 'train'),
r as (select doc_id, row_number() over (order by md5('43:' || cast(doc_id as varchar)), doc_id) rn,
             count(*) over () n from trn)
select doc_id, case when rn <= ceil(0.1 * n) then 'val' else 'train' end split from r""")
sql("cross_entropy", NB + """,
lse as (select doc_id, max(score) mx from sc group by doc_id),
l2 as (select sc.doc_id, lse.mx, ln(sum(exp(sc.score - lse.mx))) l
       from sc join lse using (doc_id) group by sc.doc_id, lse.mx),
own as (select exp(sc.score - l2.mx - l2.l) p
        from sc join te on te.doc_id = sc.doc_id and te.label = sc.c
        join l2 on l2.doc_id = sc.doc_id)
select round(sum(-ln(p)) / count(*), 6) loss, count(*) n from own""")

# ---- word vectors (FIXTURES B8) ---------------------------------------------------

WV = f"""{TOKENS},
wvr as (select k.w word, list_transform(e.embedding, lambda x: cast(x as double)) vec, k.r
        from (select w, row_number() over (order by count(*) desc, w) r
              from tokens group by w) k
        join embeddings e on e.vec_id = k.r - 1),
dim as (select max(len(embedding)) d from embeddings)
"""
sql("doc_mean_vec", f"""with {WV},
j as (select t.doc_id, unnest(wvr.vec) x, generate_subscripts(wvr.vec, 1) - 1 dim
      from tokens t join wvr on wvr.word = t.w)
select doc_id, cast(dim as bigint) dim, round(avg(x), 6) value from j group by doc_id, dim""")
sql("doc_concat_vec", f"""with {WV},
f as (select t.doc_id, t.pos, wvr.vec,
             row_number() over (partition by t.doc_id order by t.pos) r
      from tokens t join wvr on wvr.word = t.w),
c as (select doc_id, flatten(list(vec order by r)) v from f where r <= 10 group by doc_id),
e as (select doc_id, coalesce(v, []) v from documents left join c using (doc_id)),
p as (select doc_id, list_concat(v, list_transform(range(10 * dim.d - len(v)), lambda x: 0.0)) v
      from e, dim)
select doc_id, cast(generate_subscripts(v, 1) - 1 as bigint) dim, round(unnest(v), 6) value from p""")
sql("doc_seq_vec", f"""with {WV},
docs as (select distinct doc_id from tokens),
grid as (select doc_id, cast(unnest(range(0, 20)) as bigint) step from docs),
f as (select t.doc_id, t.pos step, wvr.vec from tokens t
      left join wvr on wvr.word = t.w where t.pos < 20)
select g.doc_id, g.step,
       round(coalesce(list_sum(f.vec), 0.0), 6) total,
       round(coalesce(list_sum(list_transform(f.vec, lambda x: x * x)), 0.0), 6) sq
from grid g left join f using (doc_id, step)""")
sql("embedding_matrix", f"""with {ENTITY}, {VFS}, {WV},
m as (select vfs.id, vfs.word, case when wvr.vec is not null then
             list_concat(wvr.vec, [cast(case when upper(vfs.word) = vfs.word and lower(vfs.word) <> vfs.word then 2
                  when upper(substr(vfs.word, 1, 1)) = substr(vfs.word, 1, 1)
                       and lower(substr(vfs.word, 1, 1)) <> substr(vfs.word, 1, 1) then 1
                  else 0 end as double)])
             else list_transform(range(dim.d + 1), lambda x: 0.0) end v
      from vfs cross join dim left join wvr on wvr.word = lower(vfs.word)
      union all
      select unnest([0, (select count(*) + 1 from vfs)]), null,
             list_transform(range(dim.d + 1), lambda x: 0.0) from dim)
select cast(id as bigint) id, word, cast(len(v) as bigint) width, cast(v[-1] as bigint) cap_code,
       round(list_sum(v), 6) total, round(list_sum(list_transform(v, lambda x: x * x)), 6) sq
from m""")
sql("analogy_topk", f"""with {WV},
un as (select word, r, vec, sqrt(list_sum(list_transform(vec, lambda x: x * x))) n from wvr),
uu as (select word, r, list_transform(vec, lambda x: x / n) u from un),
qe as (select unnest(u) x, generate_subscripts(u, 1) i,
              case when r in (1, 3) then 1.0 else -1.0 end s from uu where r in (1, 2, 3)),
q as (select list(m order by i) q from (select i, sum(x * s) / 3 m from qe group by i)),
qn as (select q, sqrt(list_sum(list_transform(q, lambda x: x * x))) qn from q),
sim as (select word, list_sum(list_transform(list_zip(u, q), lambda z: z[1] * z[2])) / qn sim
        from uu, qn where r not in (1, 2, 3))
select word, round(sim, 6) similarity from sim order by sim desc, word limit 10""")

# ---- spelling ------------------------------------------------------------------------

SPELL = f"""{TOKENS},
wc as (select lang, w word, count(*) cnt from tokens group by lang, w),
dic as (select * from wc where cnt >= 20),
pr as (select * from wc where cnt < 20),
nb as (select doc_id, pos, lang, w, lead(w) over (partition by doc_id order by pos) nw
       from tokens)
"""
sql("spell_correct", f"""with {SPELL},
pairs as (select p.lang, p.word, d.word cand, d.cnt cc, levenshtein(p.word, d.word) dist
          from pr p join dic d on p.lang = d.lang
          and abs(length(p.word) - length(d.word)) <= 2)
select lang, word, first(cand order by dist, cc desc, cand) correction,
       cast(min(dist) as bigint) distance
from pairs where dist <= 2 group by lang, word""")
sql("spell_merge", f"""with {SPELL}
select doc_id, pos, lang, w, nw next_w, w || nw merged from nb m
where nw is not null
  and exists (select 1 from dic d where d.lang = m.lang and d.word = m.w || m.nw)
  and (not exists (select 1 from dic d where d.lang = m.lang and d.word = m.w)
       or not exists (select 1 from dic d where d.lang = m.lang and d.word = m.nw))""")
sql("spell_split", f"""with {SPELL},
cuts as (select lang, word, i, left(word, i) l, substr(word, i + 1) r
         from (select lang, word, unnest(range(1, length(word))) i from pr
               where length(word) >= 2)),
big as (select lang, w l, nw r, count(*) bc from nb where nw is not null group by lang, w, nw),
c as (select cuts.*, dl.cnt cl, dr.cnt cr, coalesce(big.bc, 0) bc
      from cuts join dic dl on dl.lang = cuts.lang and dl.word = cuts.l
      join dic dr on dr.lang = cuts.lang and dr.word = cuts.r
      left join big on big.lang = cuts.lang and big.l = cuts.l and big.r = cuts.r)
select lang, word, first(l order by bc desc, cl * cr desc, i) "left",
       first(r order by bc desc, cl * cr desc, i) "right"
from c group by lang, word""")


# ---- composed cleaning -----------------------------------------------------------

CORRECTIONS = SPELL + """,
pairs as (select p.lang, p.word, d.word cand, d.cnt cc, levenshtein(p.word, d.word) dist
          from pr p join dic d on p.lang = d.lang
          and abs(length(p.word) - length(d.word)) <= 2),
fixes as (select lang, word, first(cand order by dist, cc desc, cand) fix, min(dist) dist
          from pairs where dist <= 2 group by lang, word),
cuts as (select lang, word, i, left(word, i) l, substr(word, i + 1) r
         from (select lang, word, unnest(range(1, length(word))) i from pr
               where length(word) >= 2)),
big as (select lang, w l, nw r, count(*) bc from nb where nw is not null group by lang, w, nw),
cutc as (select cuts.*, dl.cnt cl, dr.cnt cr, coalesce(big.bc, 0) bc
      from cuts join dic dl on dl.lang = cuts.lang and dl.word = cuts.l
      join dic dr on dr.lang = cuts.lang and dr.word = cuts.r
      left join big on big.lang = cuts.lang and big.l = cuts.l and big.r = cuts.r),
splits as (select lang, word, first(l || ' ' || r order by bc desc, cl * cr desc, i) two,
                  first(bc order by bc desc, cl * cr desc, i) bc
           from cutc group by lang, word),
changes as (select lang, word,
                   case when two is not null and (dist is null or dist > 1 or bc > 0)
                        then two else fix end new
            from fixes full join splits using (lang, word))
"""


def _text_word() -> str:
    from textflow.functions.constants import CONTRACTIONS
    return _q(r"\b(?:" + "|".join(c for c, _ in CONTRACTIONS)
              + r")\b|[a-zA-Z]+").replace("\\b(?:", "(?i)\\b(?:", 1)


def _corrected_sql(text: str) -> str:
    """s1 (doc_id, t): every word of the text merged, corrected or cut."""
    return CORRECTIONS + f""",
src as (select doc_id, lang, {text} x from documents where text is not null),
lists as (select doc_id, lang, regexp_extract_all(x, {_text_word()}) l,
                 string_split_regex(x, {_text_word()}) g, x from src),
ws as (select doc_id, lang, unnest(l) raw, lower(unnest(l)) w,
              generate_subscripts(l, 1) pos, g
       from (select doc_id, lang, l, g from lists where len(l) > 0)),
nx as (select *, lead(w) over d nw, lead(raw) over d nraw
       from (select doc_id, lang, raw, w, pos, g[pos] gap from ws)
       window d as (partition by doc_id order by pos)),
mcand as (select nx.*, m.word is not null and (a.word is null or b.word is null) can
         from nx left join dic m on m.lang = nx.lang and m.word = nx.w || nx.nw
         left join dic a on a.lang = nx.lang and a.word = nx.w
         left join dic b on b.lang = nx.lang and b.word = nx.nw),
isl as (select *, pos - row_number() over (partition by doc_id, can order by pos) island
        from mcand),
mrg as (select *, can and row_number() over (
                 partition by doc_id, can, island order by pos) % 2 = 1 m
        from isl),
tk as (select *, coalesce(lag(m) over (partition by doc_id order by pos), false) gone
       from mrg),
nw as (select tk.*, case when m then tk.w || tk.nw else h.new end new,
              case when m then raw || nraw else raw end old
       from tk left join changes h on h.lang = tk.lang and h.word = tk.w),
pieces as (select doc_id, pos, case when gone then '' else gap || (
             case when new is null then raw
                  when length(old) > 1 and upper(old) = old then upper(new)
                  when lower(old[1]) <> old[1] then upper(new[1]) || new[2:]
                  else new end) end piece
           from nw),
joined as (select doc_id, string_agg(piece, '' order by pos) t from pieces group by doc_id),
s1 as (select doc_id, case when len(l) = 0 then x else t || g[len(l) + 1] end t
       from lists left join joined using (doc_id))"""


def _collapse_sql(c: str) -> str:
    return f"trim(regexp_replace({c}, '[\\s\\x{{3000}}\\p{{Z}}]+', ' ', 'g'))"


def _cleaned_sql(text: str) -> str:
    alpha = f"regexp_replace({_contractions_sql('t')}, '[^a-zA-Z]', ' ', 'g')"
    return _corrected_sql(text) + f""",
body as (select doc_id, {_collapse_sql(f"lower({alpha})")} body from s1),
bt as (select doc_id, unnest(l) w, generate_subscripts(l, 1) pos
       from (select doc_id, flatten(list_transform(
               list_filter(string_split(body, ' '), lambda x: length(x) > 0),
               lambda x: case x when 'cannot' then ['can', 'not']
                         when 'gonna' then ['gon', 'na'] when 'gotta' then ['got', 'ta']
                         when 'wanna' then ['wan', 'na'] when 'gimme' then ['gim', 'me']
                         when 'lemme' then ['lem', 'me'] else [x] end)) l from body))
"""


LEMMAS_2 = f"""{_cleaned_sql(html_sql('text'))}, {_stop_values()},
{LEMMA.replace('from tokens)', 'from bt)')},
pre as (select t.doc_id, string_agg(l.lemma, ' ' order by t.pos) body
        from bt t join lemmas l using (w)
        where t.w not in (select w from stop) group by t.doc_id)
"""
sql("clean_pipeline_lemmas", f"with {LEMMAS_2} select doc_id, body from pre")
sql("clean_pipeline_vectors", f"""with {_cleaned_sql(_collapse_sql(html_sql(_collapse_sql('text'))))},
{WORD_VECTORS}
select doc_id, string_agg(w, ' ' order by pos) body
from bt where w in (select word from wv) group by doc_id""")
sql("length_metrics", f"""with {LEMMAS_2},
d as (select doc_id, length(text) l_raw from documents),
c as (select doc_id, length(body) l_clean from body)
select round(avg(l_raw), 6) before_cleaning, round(avg(l_clean), 6) after_cleaning,
       round(avg(l_clean), 6) before_preprocessing,
       round(avg(coalesce(length(pre.body), 0)), 6) after_preprocessing
from d join c using (doc_id) left join pre using (doc_id)""")
sql("hmm_decode_saved", ORACLE["hmm_viterbi"])
sql("unk_ids", "with " + HMM_MODEL + """,
ids as (select word, row_number() over (order by min((sent_id, pos)), word) id
        from tr where pos > 1 group by word)
select dv.sent_id, dv.pos, dv.word, coalesce(ids.id, (select count(*) + 1 from ids)) wid
from dv left join ids using (word)""")


# ---- scans and sinks -----------------------------------------------------------------

_VIT_CTES = f"""
v(sent_id, pos, v, bp) as (
  select d.sent_id, d.pos,
         case when list_max({_V0}) > 0 then {_V0} else {_ONES} end,
         cast([] as integer[])
  from dtok d, am, tl where d.pos = 1
  union all
  select d.sent_id, d.pos,
         case when list_max({_VNEW}) > 0 then {_VNEW} else {_ONES} end,
         {_BP}
  from v join dtok d on d.sent_id = v.sent_id and d.pos = v.pos + 1, am, tl
),
last as (select sent_id, max(pos) pos from v group by sent_id),
bt(sent_id, pos, j) as (
  select v.sent_id, v.pos,
         cast(list_position(v.v, list_max(v.v)) - 1 as integer)
  from v join last using (sent_id, pos)
  union all
  select bt.sent_id, bt.pos - 1, v.bp[bt.j + 1]
  from bt join v on v.sent_id = bt.sent_id and v.pos = bt.pos
  where bt.pos > 1
),
pr as (select bt.sent_id, bt.pos, tl.tags[bt.j + 1] pred from bt, tl)
"""
sql("write_tagged", "with recursive " + HMM_DECODE + "," + _VIT_CTES + """
select pr.sent_id, string_agg(cast(pr.pos as varchar) || chr(9) || dv.word || chr(9) || pr.pred,
                              chr(10) order by pr.pos) block
from pr join dv using (sent_id, pos) group by pr.sent_id""")
sql("scan_tagged", "with " + TAGGED + """
select dense_rank() over (order by sent_id) sent_id, pos, pos idx, word, tag from tr""")
sql("scan_vectors", f"""with {WV},
e as (select word, unnest(vec) x, generate_subscripts(vec, 1) - 1 dim from wvr)
select word, cast(dim as bigint) dim, round(cast(cast(x as float) as double), 6) value from e""")
sql("hmm_roundtrip", "with " + HMM_MODEL + """
select 'transition' kind, prev_tag a, tag b, round(prob, 6) prob from trans
union all
select 'emission', tag, word, round(prob, 6) from emis""")
sql("scan_entity_tokens", f"""with {ENTITY}
select dense_rank() over (order by sent_id) sent_id, pos, pos idx, word from et""")


# ---- batch perceptron, 3 epochs unrolled ------------------------------------------


def _perceptron_sql(epochs: int = 3) -> str:
    parts = [f"with {TFIDF}", f"{LANG_SPLIT}", """
xtr as (select x.doc_id, x.gram, x.v from x join sp using (doc_id) where sp.split = 'train'),
xte as (select x.doc_id, x.gram, x.v from x join sp using (doc_id) where sp.split = 'test'),
trn as (select doc_id, label from sp where split = 'train'),
tst as (select doc_id, label from sp where split = 'test'),
classes as (select distinct label c from trn),
dc as (select t.doc_id, c.c, case when t.label = c.c then 1.0 else -1.0 end y
       from trn t cross join classes c),
w0 as (select cast(null as varchar) c, cast(null as varchar) gram, 0.0 w where false),
b0 as (select cast(null as varchar) c, 0.0 w where false)"""]
    for i in range(1, epochs + 1):
        p = i - 1
        parts.append(f"""
mm{i} as (select x.doc_id, w.c, sum(x.v * w.w) m from xtr x join w{p} w on w.gram = x.gram
          group by x.doc_id, w.c),
sc{i} as (select dc.doc_id, dc.c, dc.y, coalesce(mm.m, 0) + coalesce(b.w, 0) m
          from dc left join mm{i} mm on mm.doc_id = dc.doc_id and mm.c = dc.c
          left join b{p} b on b.c = dc.c),
wr{i} as (select doc_id, c, y from sc{i} where y * m <= 0),
up{i} as (select wr.c, x.gram, sum(wr.y * x.v) dw from wr{i} wr join xtr x on x.doc_id = wr.doc_id
          group by wr.c, x.gram),
w{i} as (select coalesce(a.c, u.c) c, coalesce(a.gram, u.gram) gram,
                coalesce(a.w, 0) + coalesce(u.dw, 0) w
         from w{p} a full outer join up{i} u on a.c = u.c and a.gram = u.gram),
bu{i} as (select c, sum(y) dw from wr{i} group by c),
b{i} as (select coalesce(a.c, u.c) c, coalesce(a.w, 0) + coalesce(u.dw, 0) w
         from b{p} a full outer join bu{i} u on a.c = u.c)""")
    k = epochs
    parts.append(f"""
tm as (select x.doc_id, w.c, sum(x.v * w.w) m from xte x join w{k} w on w.gram = x.gram
       group by x.doc_id, w.c),
ts as (select t.doc_id, t.label, c.c, coalesce(tm.m, 0) + coalesce(b.w, 0) m
       from tst t cross join classes c
       left join tm on tm.doc_id = t.doc_id and tm.c = c.c
       left join b{k} b on b.c = c.c)
select doc_id, label, first(c order by m desc, c) prediction from ts group by doc_id, label""")
    return ",".join(parts)


sql("perceptron", _perceptron_sql(3))


# ---- MLlib entries: what SQL can know, floors that can fail -------------------

_FLOORS = f"""with {LANG_SPLIT}
select label, count(*) support, true f1_ok from sp
where split = 'test' group by label"""
for _n in ("linear_svm", "linear_svm_tfidf", "logreg", "logreg_tfidf", "mlp",
           "mlp_concat", "perceptron_mixing", "perceptron_vectors"):
    sql(_n, _FLOORS)
sql("training_curves", """select split, cast(1 as bigint) first_epoch,
       true best_is_lowest, true stopped_by_rule, true best_kept
from (select unnest(['train', 'val', 'test']) split)""")
sql("model_roundtrip", f"""with {LANG_SPLIT}, {TOKENS}, {WORD_VECTORS}
select doc_id, true same from sp where split = 'test'
and doc_id in (select doc_id from tokens where w in (select word from wv))""")
sql("word2vec", f"""with {TOKENS}
select w word, cast(300 as bigint) dim from tokens group by w having count(*) >= 9""")


def _param_search_sql() -> str:
    from textflow.operators.train import search_params
    rows = ", ".join(f"({i}, {reg!r}, {enet!r}, {it})" for i, (reg, enet, it)
                     in enumerate(search_params(30), 1))
    return ("select cast(t as bigint) trial, round(cast(r as double), 6) reg_param, "
            "round(cast(e as double), 6) elastic_net, cast(m as bigint) max_iter, "
            f"true f1_ok from (values {rows}) v(t, r, e, m)")


sql("param_search", _param_search_sql())
sql("token_tagger", f"""with {ENTITY}, {spans_sql('gold', 'gs')},
lab as (select doc_id, md5('42:' || cast(doc_id as varchar)) h from documents),
rk as (select doc_id, row_number() over (order by h, doc_id) rn, count(*) over () n from lab),
te as (select doc_id from rk where rn <= ceil(0.2 * n)),
hs as (select gs.type from gs join te on te.doc_id = gs.sent_id)
select coalesce(type, 'ALL') type, count(*) n_gold, true f1_ok from hs group by rollup (type)""")
