"""SQL of the registered queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

from premia.llm import licenses, mixing, negatives, pivots, rules, trie

#: crc32 of an ASCII string ``{0}``, over the table ``crc`` that ``CRC_TABLE`` makes
CRC = """xor(4294967295, list_reduce(list_transform(string_split({0}, ''), lambda ch: ascii(ch)::bigint),
  lambda acc, x: xor(tab[(xor(acc, x) & 255) + 1], acc >> 8), 4294967295::bigint))"""
CRC_TABLE = """bits(i, k, c) as (select range, 0, range from range(256)
  union all select i, k + 1, case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end from bits where k < 8),
crc as (select list(c order by i) as tab from bits where k = 8)"""
_GAPS = r"\x20\x09-\x0D"


def rules_sql() -> str:
    names = list(rules.MEASURES)
    quartiles = ", ".join(f"quantile_disc({m}, 0.25::double) as {m}_lo, quantile_disc({m}, 0.75::double) as {m}_hi" for m in names)

    def pick(m: str, side: str) -> str:
        return f"case when g.n >= {rules.LEAST_ROWS} then g.{m}_{side} when l.n >= {rules.LEAST_ROWS} then l.{m}_{side} else o.{m}_{side} end"

    tests = []
    for m, (spread, sides) in rules.MEASURES.items():
        reach = f"{rules.WIDTH}::double * greatest(({pick(m, 'hi')}) - ({pick(m, 'lo')}), {spread}::double)"
        tests.append(f"p.{m} <= ({pick(m, 'hi')}) + {reach}")
        if sides == "both":
            tests.append(f"p.{m} >= ({pick(m, 'lo')}) - {reach}")
    return f"""
with t as (select doc_id, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text from documents),
w as (select *, regexp_extract_all(text, '[^{_GAPS}]+') as w,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^{_GAPS}]')) as lines from t),
tri as (select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from w) q),
twice as (select doc_id, i from tri qualify count(*) over (partition by doc_id, g) > 1),
covered as (select doc_id, count(distinct i + j) as n from twice, (values (0), (1), (2)) v(j) group by doc_id),
c as (select w.doc_id, lang, source, len(w)::bigint as n_words,
  length(regexp_replace(text, '[{_GAPS}]+', '', 'g'))::bigint as word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
  coalesce(n, 0)::bigint as n_repeat_words,
  length(regexp_replace(text, '[\\p{{L}}\\p{{M}}\\p{{N}}{_GAPS}]+', '', 'g')) as n_marks,
  length(regexp_replace(text, '\\P{{Lu}}+', '', 'g')) as n_capitals from w left join covered using (doc_id)),
f as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from c),
p as (select *, n_symbols / word_chars as symbol_share, n_marks / word_chars as mark_share, n_capitals / word_chars as capital_share,
  n_dup_lines / n_words as dup_line_share, n_repeat_words / n_words as repeat_share, word_chars / n_words as word_length from f where not base_failed),
g as (select lang, source, count(*) as n, {quartiles} from p group by lang, source),
l as (select lang, count(*) as n, {quartiles} from p group by lang),
o as (select {quartiles} from p),
good as (select p.doc_id, {" and ".join(tests)} as kept from p join g using (lang, source) join l on l.lang = p.lang cross join o)
select f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, coalesce(kept, false) as kept
from f left join good using (doc_id)"""


def licenses_sql() -> str:
    rows = [(*p, True) for p in licenses.PHRASES] + [(*n, False) for n in licenses.NOTICES]
    values = ", ".join(f"({i}, '{label}', {str(base).lower()}, '{text}')" for i, (label, text, base) in enumerate(rows))
    return f"""
with tpl as (select template, label, base, string_split(text, ' ') as w from (values {values}) v(template, label, base, text)),
grams as (select template, label, base, len(w) - 2 as grams, i - 1 as place, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as gram
  from (select *, unnest(range(1, len(w) - 1)) as i from tpl) q),
d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents),
said as (select doc_id, i - 1 as pos, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as gram from (select *, unnest(range(1, len(w) - 1)) as i from d) q),
votes as (select distinct doc_id, template, label, base, grams, place, pos - place as diagonal from said join grams using (gram)),
lines as (select doc_id, template, label, base, grams, diagonal, count(*) as votes, list(place) as places from votes group by all),
steps as (select *, coalesce(diagonal - lag(diagonal) over (partition by doc_id, template order by diagonal) > {licenses.GAP}, false)::int as new from lines where not base),
runs as (select *, sum(new) over (partition by doc_id, template order by diagonal) as run from steps),
near as (select doc_id, label, base, min(diagonal) as first_word, len(list_distinct(flatten(list(places)))) / grams as share
  from runs group by doc_id, template, label, base, grams, run),
spans as (select doc_id, label, base, diagonal as first_word, 1.0::double as share from lines where base and votes = grams
  union all select * from near where share >= {licenses.COVERAGE}::double),
found as (select doc_id, count(*) filter (where base) as n_base, min(first_word) filter (where base) as first_word, max(first_word) filter (where base) as last_word,
  string_agg(distinct label, ',' order by label) filter (where base) as base_labels, string_agg(distinct label, ',' order by label) as labels, max(share) as score from spans group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word, last_word::bigint as last_word,
  coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0)::double as score from d left join found using (doc_id)"""


def pivots_sql() -> str:
    """Every pair, by brute force: what the index has to find."""
    return f"""
with recursive v as (select vec_id, embedding::double[] as e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and list_cosine_similarity(a.e, b.e) >= {pivots.COSINE}::double),
reach(a, b) as (select vec_id, vec_id from embeddings union select r.a, l.b from reach r join links l on l.a = r.b),
low as (select a as vec_id, min(b) as component_id from reach group by a),
n as (select a as vec_id, count(*) as n from links group by a)
select vec_id, coalesce(n, 0)::bigint as n_links, component_id, vec_id = component_id as kept from low left join n using (vec_id)"""


def trie_sql() -> str:
    return f"""
with recursive {CRC_TABLE},
t as (select conv_id as c, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos,
  coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
h as (select c, c - c % {trie.REUSE_STEP} as base, {CRC.format("c::varchar")} % {trie.REUSE_TURNS} as h from (select distinct c from t) q, crc),
r as (select h.c, 0 as own, pos, role, text from h join t on t.c = base and pos <= h
  union all select h.c, 1, pos, role, text from h join t using (c) where pos > h),
s as (select h.c, list({{'name': md5(md5(role) || md5(text)), 'size': length(text)}} order by own, pos) filter (where r.c is not null) as turns from h left join r using (c) group by h.c),
m as (select c, d, coalesce(len(turns), 0) = d as last, md5(array_to_string(list_transform(turns[:d], lambda x: x.name), '')) as node,
  case when d > 0 then md5(array_to_string(list_transform(turns[:d - 1], lambda x: x.name), '')) end as above,
  case when d > 0 then turns[d].size else 0 end as size
  from (select c, turns, unnest(range(coalesce(len(turns), 0) + 1)) as d from s) q),
n as (select d, coalesce(node, '') as node, case when d > 0 then coalesce(above, '') end as above, min(c) as low, count(*) as n, (count(*) - 1) * any_value(size) as own,
  sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (where last), '')) as ends from m group by all),
kids as (select above as node, d - 1 as d, count(*) as n from n where d > 0 group by all),
owned as (select n.*, kids.n is null as leaf from n left join kids using (node, d)),
reach as (select up.d, coalesce(up.node, '') as node, sum(owned.own) as saved, count(*) filter (where leaf) as leaves
  from owned join m up on up.c = owned.low and up.d <= owned.d group by all)
select n.low as conv_id, n.d as depth, p.low as parent_conv_id, n.n as n_convs, coalesce(kids.n, 0) as n_children,
  reach.leaves as n_leaves, reach.saved::bigint as saved_tokens, n.ends as ends_sha256
from n left join n p on p.d = n.d - 1 and p.node = n.above left join kids on kids.node = n.node and kids.d = n.d join reach on reach.node = n.node and reach.d = n.d"""


def negatives_sql() -> str:
    """Every pair, by brute force."""
    low, high = negatives.WINDOW
    return f"""
with v as (select vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
  list_transform(embedding, lambda x: floor({negatives.SCALE} * x::double)) as e from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.id as anchor_id, a.label as label, b.id as other, b.label as other_label, list_inner_product(a.e, b.e)::bigint as score
  from v a join v b on a.id <> b.id where a.id % 50 = 0),
p as (select * from s where label = other_label qualify row_number() over (partition by anchor_id order by score desc, other) <= {negatives.POSITIVES}),
n as (select p.anchor_id, p.other as positive_id, row_number() over (partition by p.anchor_id, p.other order by s.score desc, s.other) as rank,
  s.other as negative_id, p.score as positive_score, s.score as negative_score from p join s on s.anchor_id = p.anchor_id and s.other_label <> s.label
  and {low} * p.score <= 100 * s.score and 100 * s.score <= {high} * p.score)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from n where rank <= {negatives.NEGATIVES}"""


SQL = {
    "op5_rules": rules_sql(), "op6_pivots": pivots_sql(), "op7_licenses": licenses_sql(), "op9_mixing": mixing.period_sql(),
    "op11_negatives": negatives_sql(), "op12_trie": trie_sql(),
}
