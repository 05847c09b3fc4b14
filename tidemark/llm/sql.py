"""The SQL (DuckDB) that queries of this subpackage are checked against."""

from __future__ import annotations

from tidemark.llm import chat, divergence, fill_middle, licences, mixing, near_copies, top_k
from tidemark.llm import quality_rules as rules

ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _class(ranges) -> str:
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges) + "]"


def quality_rules(docs: str = "documents") -> str:
    """Rows of op1, and the document's own columns, from a table or bracketed query."""
    per_char = ", ".join(f"('{k}')" for k in rules.CLASSES)
    counts = " ".join(
        f"when '{k}' then length(t) - length(regexp_replace(t, '{_class(r)}', '', 'g'))" if r else f"when '{k}' then length(regexp_replace(t, '{_class(sum(rules.CLASSES.values(), ()))}', '', 'g'))"
        for k, r in rules.CLASSES.items()
    )
    trimmed = rules.TRIMMED.decode().replace("'", "''")
    n = rules.WINDOW
    return f"""
with d as (select row_number() over () as rid, *, coalesce(text, '') as t from {docs}),
lists as (select rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws from d),
words as (select rid, unnest(ws) as w from lists),
windows as (select rid, p, array_to_string(list_slice(ws, p, p + {n - 1}), ' ') as g from (select rid, ws, unnest(range(1, len(ws) - {n - 2})) as p from lists)),
again as (select rid, p from (select rid, p, count(*) over (partition by rid, g) as n from windows) where n > 1),
repeated as (select rid, count(distinct p + k) as n_repeat_words from again, range({n}) r(k) group by rid),
lines as (select rid, count(*) - count(distinct l) as n_dup_lines from (select rid, unnest(string_split(t, chr(10))) as l from d)
  where regexp_matches(l, '[^\x20\x09-\x0D]') group by rid),
base as (select d.rid, len(ws) as n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint as word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols, coalesce(n_dup_lines, 0) as n_dup_lines,
    coalesce(n_repeat_words, 0) as n_repeat_words,
    len(ws) < {rules.MIN_BASE_WORDS} or 100 * coalesce(n_repeat_words, 0) > {rules.MAX_REPEATED_PERCENT} * len(ws) as base_failed
  from d join lists using (rid) left join repeated using (rid) left join lines using (rid)),
bins as (select 'c' as kind, unnest([{", ".join(f"'{k}'" for k in rules.CLASSES)}]) as bin
  union all select 'w', unnest([{", ".join(f"'{k}'" for k in rules.WORDS)}, '*'])),
common as (select rid, case when bin is null then '*' else bin end as bin, count(*) as n
  from (select rid, trim({ASCII_LOWER.format("w")}, '{trimmed}') as k from words) left join (select bin from bins where kind = 'w' and bin <> '*') on k = bin group by 1, 2),
histogram as (
  select rid, lang, kind, bin, case bin {counts} end as n from d, bins where kind = 'c'
  union all select d.rid, lang, kind, bins.bin, coalesce(n, 0) from d cross join bins left join common on common.rid = d.rid and common.bin = bins.bin where kind = 'w'),
firsts as (select min(rid) as rid from d join base using (rid) where not base_failed group by lang, t),
parts as (select rid, lang, kind, bin, n / sum(n) over (partition by rid, kind) as p, floor({rules.SCALE} * n / sum(n) over (partition by rid, kind))::bigint as share
  from histogram join base using (rid) where not base_failed),
sums as (select lang, kind, bin, sum(share)::bigint as s from parts join firsts using (rid) group by all),
pooled as (select kind, bin, sum(s)::bigint as s from sums group by all),
counts as (select lang, count(*) as docs from firsts join d using (rid) group by lang),
others as (select rid, coalesce(counts.docs, 0) - 1 >= {rules.MIN_DOCS} as known, case when known then counts.docs else (select sum(docs) from counts) end - 1 as n_docs
  from d left join counts on counts.lang = d.lang),
terms as (select rid, parts.kind, p, n_docs, (case when known then sums.s else pooled.s end - share) / nullif(n_docs, 0) / {rules.SCALE} as q
  from parts join others using (rid) join pooled on pooled.kind = parts.kind and pooled.bin = parts.bin
    left join sums on sums.lang = parts.lang and sums.kind = parts.kind and sums.bin = parts.bin),
distances as (select rid, kind, sqrt(greatest(0, sum((case when p > 0 then p * log2(2 * p / (p + q)) else 0 end + case when q > 0 then q * log2(2 * q / (p + q)) else 0 end) / 2))) as js
  from terms where n_docs > 0 group by all),
verdict as (select base.*, not base_failed and (word_chars < {rules.MIN_CHARS} or coalesce(c.js, 0) <= {rules.MAX_CHARS})
    and (n_words < {rules.MIN_WORDS} or coalesce(w.js, 0) <= {rules.MAX_WORDS} + {rules.WORDS_SLACK} / sqrt(n_words)) as kept
  from base left join distances c on c.rid = base.rid and c.kind = 'c' left join distances w on w.rid = base.rid and w.kind = 'w')
select d.* exclude (rid, t), verdict.* exclude (rid) from d join verdict using (rid)"""


OP1 = f"select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept from ({quality_rules()})"


def mixing_rows(docs: str = "documents") -> str:
    """Rows of op3 with the copies of each document, and the document's own columns, from a table or bracketed query."""
    k, w = mixing.MOST_COPIES, mixing.WEIGHTS
    return f"""
with d as (select row_number() over () as rid, *, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
    ((('0x' || substr(md5(concat_ws('|', '{mixing.SEED}', coalesce(doc_id::varchar, ''), md5(coalesce(text, '')))), 1, 13))::bigint) + 0.5) / {float(2**52)} as u
  from {docs}),
sized as (select *, length(bin(size)) as band from d),
sources as (select source, sum(size)::bigint as source_size from d group by source),
weighed as (select *, [{", ".join(map(str, w))}][(row_number() over (order by source nulls last) - 1) % {len(w)} + 1] as weight from sources),
steps as (select *, row_number() over o as number,
    (sum(source_size) over () - {k} * coalesce(sum(source_size) over (o rows between unbounded preceding and 1 preceding), 0))::bigint as "left",
    (sum(weight) over () - coalesce(sum(weight) over (o rows between unbounded preceding and 1 preceding), 0))::bigint as rest
  from weighed window o as (order by source_size / weight, source nulls last)),
final as (select "left" as l, rest as r from steps where not {k} * source_size * rest <= weight * "left" order by number limit 1),
goals as (select source, source_size, coalesce(least({k}.0::double * source_size, (weight * l)::double / r), {k}.0::double * source_size) as target
  from steps left join final on true),
bands as (select source, band, sum(size)::bigint as band_size, {mixing.BAND_FROM} + band as measure from sized group by source, band),
factors as (select b.*, source_size, target, (target - {k} * coalesce(sum(band_size) over (o rows between unbounded preceding and 1 preceding), 0))
    / nullif(sum(band_size * measure) over (partition by b.source) - coalesce(sum(band_size * measure) over (o rows between unbounded preceding and 1 preceding), 0), 0) as c
  from bands b join goals on b.source is not distinct from goals.source window o as (partition by b.source order by band desc)),
filled as (select *, coalesce(c * measure >= {k}, false) as filled from factors),
expected as (select *, least({k}.0::double, greatest(0.0, coalesce(case when filled then {k} else max(case when not filled then struct_pack(band := band, c := c) end) over (partition by source).c * measure end, 0))) as e from filled),
rules as (select source, band, band_size, source_size, target, floor(e)::bigint as whole, e - floor(e) as p from expected),
missing as (select source, max(target) - sum(whole * band_size) as missing from rules group by source),
ranked as (select rid, sized.source, size, case when p > 0 and size > 0 then u * (1 - p) / (u * (1 - p) + (1 - u) * p) end as rank from sized join rules on sized.source is not distinct from rules.source and sized.band = rules.band),
ranks as (select source, rank, sum(size) as words, count(*) as n from ranked where rank is not null group by all),
run as (select *, coalesce(sum(words) over (partition by source order by rank rows between unbounded preceding and 1 preceding), 0) as done from ranks),
taken as (select run.source, rank, floor((missing - done) / (words / n) + 0.5) as m from run join missing on run.source is not distinct from missing.source),
numbered as (select *, row_number() over (partition by source, rank order by rid) as number from ranked)
select d.* exclude (rid, u), source_size, target, case when d.size > 0 then whole + coalesce(number <= m, false)::bigint else 0 end as copies
from d join numbered using (rid) join rules on d.source is not distinct from rules.source and length(bin(d.size)) = rules.band
  left join taken on d.source is not distinct from taken.source and numbered.rank = taken.rank"""


OP3 = f"select doc_id, size, source_size, target, size * copies as taken from ({mixing_rows()})"


def licence_rows() -> str:
    grams = ", ".join(f"({t}, '{label}', {whole}, {n}, {k}, '{g}')" for t, label, whole, n, k, g in licences.template_grams())
    every = "|".join(licences.SAYS.values())
    said = f"regexp_extract(array_to_string(list_slice(ws, k + 1, k + 8), ' '), '^(?:(?:and )?(?:{every})(?: |$))*')"
    cc = " || ".join(["'cc-by'", *[f"case when regexp_matches(said, '\\b(?:{p})\\b') then '-{v}' else '' end" for v, p in licences.SAYS.items()]])
    families = ", ".join(f"'{f}'" for f in licences.FAMILIES)
    gnu = ", ".join(f"'{f}'" for f in licences.GNU)
    return f"""
with d as (select row_number() over () as rid, doc_id, regexp_extract_all({ASCII_LOWER.format("coalesce(text, '')")}, '{licences.LICENCE_WORD}') as ws from documents),
grams(template, label, whole, grams, place, gram) as (values {grams}),
places as (select rid, k - 1 as pos, array_to_string(list_slice(ws, k, k + {licences.K - 1}), ' ') as gram from (select rid, ws, unnest(range(1, len(ws) - {licences.K - 2})) as k from d)),
diagonals as (select rid, template, label, whole, grams, pos - place as diagonal, count(*) as votes, min(pos) as first, max(pos) as last, list(place) as places
  from places join grams using (gram) group by all),
runs as (select *, sum(apart) over (partition by rid, template order by diagonal) as run from
  (select *, coalesce((diagonal - lag(diagonal) over (partition by rid, template order by diagonal) > {licences.NEIGHBOUR})::int, 0) as apart from diagonals where not whole)),
voted as (
  select rid, label, whole, first as start, last + {licences.K} as stop, 1.0::double as score from diagonals where whole and votes = grams
  union all
  select rid, label, whole, start, last + {licences.K}, covered / grams from (
    select rid, template, label, whole, grams, run, min(first) as start, max(last) as last, len(list_distinct(flatten(list(places)))) as covered from runs group by all)
  where covered / grams >= {licences.COVERED} and covered >= {licences.DENSE} * (last - start + 1)),
words as (select rid, ws, k, ws[k] as w, coalesce(ws[k - 1], '') as before, coalesce(ws[k + 1], '') as after from (select rid, ws, unnest(range(1, len(ws) + 1)) as k from d where rid in (select rid from voted))),
named as (select rid, k - 1 as pos, case when w = 'general' and after = 'public' then case when before in ('lesser', 'library') then 'lgpl' when before = 'affero' then 'agpl' else 'gpl' end
    when w in ({gnu}) then w else {cc} end as variant
  from (select *, {said} as said from words where (w = 'general' and after = 'public') or (w = 'attribution' and before = 'commons') or (w = 'by' and before = 'cc') or (w in ({gnu}) and before = 'identifier'))),
spans as (select rid, label, whole, start, score from voted where whole or label not in ({families})
  union all select v.rid, variant, whole, start, score from voted v join named n on n.rid = v.rid and pos >= start and pos < stop where not whole and label in ({families})),
found as (select rid, count(*) filter (where whole) as n_base, min(start) filter (where whole) as first_word, max(start) filter (where whole) as last_word,
  string_agg(distinct label, ',' order by label) filter (where whole) as base_labels, string_agg(distinct label, ',' order by label) as labels, max(score) as score from spans group by rid)
select doc_id, len(ws)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word, last_word::bigint as last_word,
  coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0)::double as score
from d left join found using (rid)"""


OP4 = licence_rows()

OP5 = f"""
with v as (select vec_id, list_transform(embedding, lambda x: floor({top_k.SCALE} * x::double)) as x from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.x, c.x)::bigint as score from v q join v c on q.vec_id <> c.vec_id where q.vec_id % {top_k.QUERY_EVERY} = 0),
r as (select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score from s)
select query_id, rank, vec_id, score from r where rank <= {top_k.K}"""

OP8 = f"""
with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text, coalesce(floor(turn / {chat.STRETCH}), {chat.LAST})::bigint as part from conversations),
n as (select *, row_number() over w as place, count(*) over (partition by conv_id) as n from t window w as (partition by conv_id order by turn nulls last, role, text)),
p as (select *, md5(string_agg(md5(role) || md5(text), '' ) over (partition by conv_id order by place)) as h from n),
whole as (select min(conv_id) as conv_id, n, h, count(*) as copies from p where place = n group by n, h),
kept as (select conv_id, n as n_turns, copies from whole where not exists (select 1 from p where p.place < p.n and p.place = whole.n and p.h = whole.h)),
lines as (select n.conv_id, n.part, n_turns, copies, place, '{chat.OPEN}' || replace(role, '<|', '< |') || chr(10) || replace(text, '<|', '< |') || '{chat.CLOSE}' || chr(10) as line
  from n join kept on n.conv_id is not distinct from kept.conv_id),
cut as (select *, (row_number() over w - 1) // {chat.PART_ROWS} as by_rows, (sum(strlen(line)) over w - 1) // {chat.PART_BYTES} as by_size from lines window w as (partition by conv_id, part order by place)),
pieces as (select *, dense_rank() over (partition by conv_id, part order by by_rows, by_size) - 1 as piece from cut)
select conv_id, part, piece, n_turns, copies, string_agg(line, '' order by place) as text from pieces group by conv_id, part, piece, n_turns, copies"""

_N = near_copies.SHINGLE
#: Brute force over all pairs of documents with a shingle in common: for small tables.
OP10 = f"""
with recursive d as (select doc_id, regexp_extract_all({ASCII_LOWER.format("coalesce(text, '')")}, '{licences.LICENCE_WORD}') as ws from documents),
shingles as (select distinct doc_id, array_to_string(list_slice(ws, k, k + {_N - 1}), ' ') as s
  from (select doc_id, ws, unnest(range(1, greatest(1, len(ws) - {_N - 1}) + 1)) as k from d where len(ws) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as c from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by all),
links as (select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where {1 + near_copies.THRESHOLD} * c >= {near_copies.THRESHOLD} * (x.n + y.n) - 1e-6),
reach as (select doc_id, doc_id as other from d union select reach.doc_id, b from reach join links on other = a),
groups as (select doc_id, min(other) as class_id from reach group by doc_id),
counts as (select a as doc_id, count(*) as n_links from links group by a)
select d.doc_id, class_id, coalesce(n_links, 0)::bigint as n_links from d join groups using (doc_id) left join counts using (doc_id)"""

_F = "((p - q) * (p - q) // q)::bigint"
OP11 = f"""
with d as (select row_number() over () as rid, coalesce(lang, '') as lang, coalesce(source, '') as source, {ASCII_LOWER.format("coalesce(text, '')")} as text from documents),
occurrences as (select rid, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
counted as (select lang, source, term, count(*) as n from occurrences group by all),
kept as (select lang, term, count(*) as total from occurrences group by all having count(distinct rid) >= {divergence.LEAST_DOCUMENTS}),
langs as (select lang, count(*) as v, sum(total) as lang_n from kept group by all),
groups as (select lang, source, coalesce(group_n, 0) as group_n from (select distinct lang, source from d)
  left join (select lang, source, sum(n) as group_n from counted join kept using (lang, term) group by all) using (lang, source)),
shares as (select g.lang, g.source, kept.term, coalesce(n, 0) as n, (1 + {divergence.SCALE}::hugeint * (coalesce(n, 0) + 1) // (group_n + v))::hugeint as p,
    (1 + {divergence.SCALE}::hugeint * (total + 1) // (lang_n + v))::hugeint as q
  from groups g join langs using (lang) join kept using (lang) left join counted c on c.lang = g.lang and c.source = g.source and c.term = kept.term),
pairs as (select a.lang, a.source, b.source as item, coalesce(sum(f), 0)::bigint as value from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join (select lang, x.source, y.source as item, (x.p - y.p) * (x.p - y.p) // y.p as f from shares x join shares y using (lang, term)) t
    on t.lang = a.lang and t.source = a.source and t.item = b.source group by all),
terms as (select lang, source, term as item, {_F} as value from shares where n > 0 and p > q),
ranked as (
  select lang, source, 'pair' as part, item, value, row_number() over (partition by lang, source order by value desc, item)::int as rank from pairs
  union all select lang, source, 'term', item, value, row_number() over (partition by lang, source order by value desc, item)::int from terms)
select * from ranked where part = 'pair' or rank <= {divergence.TOP_TERMS}"""

_P, _S, _M = fill_middle.SENTINELS
OP12 = f"""
with d as (select doc_id, coalesce(text, '') as t, length(coalesce(text, '')) as n, sha256('{fill_middle.SEED}:' || coalesce(doc_id::varchar, '')) as h from documents),
hashes as (select *, {", ".join(f"('0x' || substr(h, {8 * k + 1}, 8))::bigint as h{k + 1}" for k in range(4))} from d),
places as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
    case when n = 0 or {" or ".join(f"contains(t, '{s}')" for s in fill_middle.SENTINELS)} or h3 % 100 >= {fill_middle.CUT_OF_100} then 'plain'
      when h4 % 100 < {fill_middle.SUFFIX_FIRST_OF_100} then 'spm' else 'psm' end as form from hashes),
parts as (select *, substr(t, 1, a) as prefix, substr(t, a + 1, b - a) as middle, substr(t, b + 1) as suffix from places),
made as (select *, case form when 'plain' then t when 'psm' then '{_P}' || prefix || '{_S}' || suffix || '{_M}' || middle
    else '{_S}' || suffix || '{_P}' || prefix || '{_M}' || middle end as output from parts),
found as (select *, strpos(output, '{_P}') as p, strpos(output, '{_S}') as s, strpos(output, '{_M}') as m from made),
back as (select *, case form when 'plain' then output
    when 'psm' then substr(output, 4, s - 4) || substr(output, m + 3) || substr(output, s + 3, m - s - 3)
    else substr(output, p + 3, m - p - 3) || substr(output, m + 3) || substr(output, 4, p - 4) end as restored from found)
select doc_id, n::bigint as n, form, case when form <> 'plain' then a end::bigint as prefix_chars, case when form <> 'plain' then b - a end::bigint as middle_chars,
  sha256(output) as output_sha256, sha256(restored) as restored_sha256 from back"""
