"""SQL for DuckDB of the queries that SQL can express."""

from __future__ import annotations

from . import licenses, quality, suffixdedup, urlfilter

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

TOP_K = """with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as (select q.vec_id as query_id, v.vec_id, cast(list_sum(list_transform(list_zip(q.e, v.e), lambda z: z[1] * z[2])) as bigint) as score from v q join v on q.vec_id <> v.vec_id where q.vec_id % 50 = 0)
select query_id, cast(rank as integer) as rank, vec_id, score from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from p) where rank <= 5"""


def url_filter() -> str:
    rules = sorted(urlfilter.RULES, key=lambda r: -len(r[0]))

    def case(value: int) -> str:
        parts = []
        for rule in rules:
            host, _, path = rule[0].partition("/")
            parts.append(f"when (host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '/{path}') then '{rule[value]}'")
        return "case " + " ".join(parts) + " end"

    listed = ", ".join(f"('{e.rstrip('/')}')" for e in urlfilter.LISTED)
    return rf"""with u as (select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
h as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from u),
b as (select *, regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '\.+$', '') as bare from h),
l as (select * from (values {listed}) t(entry)),
m as (select b.page_id, b.host, b.path, max(entry) as entry from b left join l on bare = entry or ends_with(bare, '.' || entry) group by all)
select page_id, host, path, {case(0)} as rule, coalesce({case(1)}, case when entry is null then 'allow' else 'block' end) as verdict, entry || '/' as listed from m"""


def quality_rules() -> str:
    q = quality
    return rf"""with d as (select doc_id, row_number() over () as r, coalesce(text, '') as t, {_WORDS} as w from documents),
x as (select *, cast(len(w) as bigint) as n_words, cast(length(list_aggregate(w, 'string_agg', '')) as bigint) as wc, cast(len(regexp_extract_all(t, '[#*$%&|<>]')) as bigint) as n_symbols,
  list_filter(string_split(t, chr(10)), lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) as ls from d),
g as (select r, unnest(range(1, n_words - 1)) as i, w from x where n_words >= 3),
k as (select r, i, count(*) over (partition by r, w[i], w[i + 1], w[i + 2]) as c from g),
c as (select r, count(distinct p) as n from (select r, unnest([i, i + 1, i + 2]) as p from k where c > 1) group by r),
y as (select doc_id, t, n_words, coalesce(wc, 0) as word_chars, n_symbols, cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines, cast(coalesce(c.n, 0) as bigint) as n_repeat_words, ls from x left join c using (r)),
z as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from y)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not (base_failed or n_symbols > {q.MAX_SYMBOLS_PER_WORD} * greatest(n_words, 1) or word_chars / greatest(n_words, 1) not between {q.MEAN_WORD[0]} and {q.MEAN_WORD[1]}
    or len(regexp_extract_all(t, '\p{{L}}')) < {q.MIN_LETTERS} * word_chars or n_dup_lines > {q.MAX_DUP_LINES} * greatest(len(ls), 1)
    or len(list_filter(ls, lambda s: regexp_matches(s, '(\.\.\.|…)\s*$'))) > {q.MAX_ELLIPSIS_LINES} * greatest(len(ls), 1)
    or len(list_filter(ls, lambda s: regexp_matches(s, '^\s*[-*•‣◦]\s'))) > {q.MAX_BULLET_LINES} * greatest(len(ls), 1)) as kept from z"""


# The distribution is summed as in the operator, so counts differ only where a hashed number lies within rounding of a threshold.
MIX_SOURCES = """with d as (select *, coalesce(source, '') as "of", coalesce(cast(doc_id as varchar), 'null') as id from documents),
n as (select "of", cast(sum(coalesce(length(text), 0)) as double) as n from d group by all),
r as (select "of", (select sum(n) from n where n > 0) * (1.0 / (select count(*) from n where n > 0)) / n as rate from n where n > 0),
k as (select "of", rate, unnest(range(0, cast(ceil(rate + 10 * sqrt(rate) + 20) as bigint) + 1)) as k from r),
g as (select "of", k, sum(case when k = 0 then -rate else ln(rate) - ln(k) end) over (partition by "of" order by k) as lg from k),
c as (select "of", sum(exp(lg)) over (partition by "of" order by k) as p from g),
u as (select *, row_number() over () as r, (cast('0x' || substr(md5('17:n:' || id), 1, 13) as bigint) + 0.5) / 4503599627370496.0 as u from d),
m as (select r, count(*) as n from u join c on u."of" = c."of" and c.p <= u.u group by r),
x as (select u.*, unnest(range(0, n)) as copy from u join m using (r))
select * exclude ("of", id, u, r), cast('0x' || substr(md5('17:o:' || id || ':' || copy), 1, 15) as bigint) as mix_key from x"""

NEAR_DUPLICATES = r"""with recursive w as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
s as (select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
  else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as sh from w),
n as (select doc_id, count(*) as n from s group by all),
p as (select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b on a.sh = b.sh and a.doc_id < b.doc_id group by all),
l as (select x, y from p join n a on x = a.doc_id join n b on y = b.doc_id where 100 * c >= 85 * (a.n + b.n - c)),
e as (select x, y from l union all select y, x from l),
reach(a, b) as (select doc_id, doc_id from w union select a, y from reach join e on b = x)
select a as doc_id, cast(coalesce(n, 0) as bigint) as n_shingles, min(b) as component_id, a = min(b) as kept from reach left join n on a = n.doc_id group by a, n"""


# Every window of every text, in hexadecimal, by its md5.
SUFFIX_DEDUP = f"""with d as (select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as h from documents),
w as (select r, i, md5(substr(h, 2 * i + 1, {2 * suffixdedup.LENGTH})) as k from (select r, h, unnest(range(0, length(h) // 2 - {suffixdedup.LENGTH - 1})) as i from d where length(h) >= {2 * suffixdedup.LENGTH})),
t as (select r, i from (select r, i, count(*) over (partition by k) as c from w) where c > 1),
g as (select r, i, sum(case when i > before + {suffixdedup.LENGTH} then 1 else 0 end) over (partition by r order by i) as g from (select *, lag(i) over (partition by r order by i) as before from t)),
s as (select r, min(i) as a, max(i) + {suffixdedup.LENGTH} as b from g group by r, g),
e as (select r, a, b, lag(b, 1, 0) over (partition by r order by a) as since from s),
k as (select r, string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' order by a) || substr(any_value(h), 2 * max(b) + 1) as kept, sum(b - a) as removed, count(*) as spans from e join d using (r) group by r)
select doc_id, cast(length(h) // 2 as bigint) as n_bytes, cast(coalesce(removed, 0) as bigint) as n_removed, cast(coalesce(spans, 0) as bigint) as n_spans, sha256(unhex(coalesce(kept, h))) as kept_sha256 from d left join k using (r)"""


def license_scan() -> str:
    """Every line window and text against every template, with no short cut."""
    rows, longest = [], 0
    for k, (name, text) in enumerate((*licenses.TEMPLATES, *licenses.FULL_TEXTS)):
        words = licenses._terms(text)
        short = k < len(licenses.TEMPLATES)
        longest = max(longest, len(words)) if short else longest
        rows += [f"({k}, '{name}', {short}, '{w}', {words.count(w)})" for w in sorted(set(words))]
    terms = lambda t: rf"list_filter(string_split_regex(lower({t}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"
    return rf"""with d as (select row_number() over () as r, doc_id, concat_ws('/', source, lang, cast(doc_id as varchar) || '.txt') as path, coalesce(text, '') as t from documents),
p as (select *, regexp_extract(path, '^(.*/)?') as dir from d),
c as (select term, count(*) as df from (select distinct r, unnest({terms('t')}) as term from d) group by term),
n as (select count(*) as n from d),
v(template, license, short, term, tf) as (values {', '.join(rows)}),
a as (select coalesce(c.term, v.term) as term, 1000 + cast(round(1000 * ln((1 + any_value(n)) / (1 + coalesce(any_value(df), 0)))) as bigint) as w from c full join v on c.term = v.term, n group by 1),
x as (select v.*, tf * w as x from v join a using (term)),
q as (select template, cast(sum(x * x) as double) as square from x group by all),
l as (select r, row_number() over (partition by r order by k) as i, ws, len(ws) as m from (select r, generate_subscripts(ls, 1) as k, unnest(ls) as ws from (select r, list_transform(string_split(t, chr(10)), lambda s: {terms('s')}) as ls from d)) where len(ws) > 0),
s as (select *, sum(m) over (partition by r order by i) as upto from l),
u as (select a.r, a.i as first, b.i as last from s a join s b on a.r = b.r and b.i >= a.i and (b.upto - b.m) - (a.upto - a.m) < {longest}),
g as (select u.r, first, last, term, count(*) as tf from u join (select r, i, unnest(ws) as term from l) k on u.r = k.r and i between first and last group by all
  union all select r, -1, -1, term, count(*) from (select r, unnest(ws) as term from l) group by all),
e as (select r, first, last, sum(cast(tf * w * tf * w as hugeint)) as own from g join a using (term) group by all),
o as (select r, first, last, template, license, cast(sum(cast(g.tf * w * x as hugeint)) as double) as dot from g join a using (term) join x using (term) where short or first = -1 group by all),
z as (select o.*, cast(floor(1000 * dot / sqrt(cast(own as double) * square) + 1e-9) as integer) as score from o join e using (r, first, last) join q using (template)),
h as (select *, first = -1 as whole from z where score >= {int(1000 * licenses.THRESHOLD)}),
f as (select r, license, score from h where whole qualify row_number() over (partition by r order by score desc, template) = 1),
b as (select r, license, score from h qualify row_number() over (partition by r order by score desc, whole desc, template) = 1),
m as (select dir as up, license as lent, score as lent_score from f join p using (r) qualify row_number() over (partition by dir order by score desc, license) = 1),
i as (select p.r, up, lent, lent_score from p join m on starts_with(dir, up) qualify row_number() over (partition by p.r order by length(up) desc) = 1)
select doc_id, path, coalesce(f.license, b.license, lent) as license, case when f.r is not null then 'file' when b.r is not null then 'header' when lent is not null then 'inherited' end as kind,
  coalesce(f.score, b.score, lent_score) as score, case when f.r is not null then dir when b.r is not null then path else up end as found_in from p left join f using (r) left join b using (r) left join i using (r)"""


def oracle_sql() -> dict[str, str]:
    return {"op1_license_scan": license_scan(), "op2_mix_sources": MIX_SOURCES, "op6_suffix_dedup": SUFFIX_DEDUP, "op8_near_duplicates": NEAR_DUPLICATES, "op3_top_k": TOP_K, "op5_url_filter": url_filter(), "op10_quality": quality_rules()}
