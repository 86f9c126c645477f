"""DuckDB SQL of the corpus queries that SQL can express on whole tables."""

from __future__ import annotations

#: space and U+0009..U+000D, as a character class of DuckDB's regular expressions
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def lowered(column: str) -> str:
    return f"translate({column}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


DECONTAMINATION = f"""
with d as (select doc_id, regexp_extract_all({lowered("coalesce(text, '')")}, '{WORD}') as w from documents),
b as (select item_id, regexp_extract_all({lowered("coalesce(text, '')")}, '{WORD}') as w from benchmark),
bs as (select distinct item_id, least(len(w), 5) as n, array_to_string(w[i : i + least(len(w), 5) - 1], ' ') as s
       from (select item_id, w, unnest(range(1, len(w) - least(len(w), 5) + 2)) as i from b where len(w) > 0)),
lengths as (select distinct n from bs),
ds as (select distinct doc_id, n, array_to_string(w[i : i + n - 1], ' ') as s
       from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, lengths where len(w) >= n)),
sizes as (select item_id, count(*) as n_item from bs group by item_id),
hits as (select ds.doc_id, bs.item_id, count(*) as n_found from ds join bs on ds.s = bs.s and ds.n = bs.n group by all)
select doc_id, item_id, n_item, n_found, n_found / n_item as containment
from hits join sizes using (item_id) where n_found * 5 >= n_item * 4
"""

LINE_DEDUP = f"""
with l as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
                  unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) as i from documents),
k as (select *, {lowered("regexp_replace(regexp_replace(line, '^" + BLANK + "+', ''), '" + BLANK + "+$', '')")} as key from l),
r as (select key, max(doc_id) as last from k where length(key) >= 20 group by key having count(distinct doc_id) >= 3),
j as (select k.*, r.key is not null and k.doc_id <> r.last as gone from k left join r on k.key = r.key)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
from j group by doc_id
"""

# five hex digits of the SHA-1 are four base-32 digits
WARC = """
with p as (select page_id, coalesce(html, '') as h from pages),
d as (select *, sha1(h) as x, min(page_id) over (partition by h) as first from p)
select page_id, strlen(h) as payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((cast('0x' || substr(x, 5 * (i // 4) + 1, 5) as integer) >> (15 - 5 * (i % 4))) & 31)::integer, 1)), '') as payload_digest,
       case when page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id = first then null else first end as refers_to
from d
"""

HARD_NEGATIVES = """
with e as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                  list_transform(embedding, lambda v: floor(256 * v::double)) as x
           from embeddings where vec_id is not null and label is not null and embedding is not null
             and len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0),
r as (select row_number() over () as k, * from e),
s as (select a.k as a, a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
             list_sum(list_transform(list_zip(a.x, b.x), lambda z: z[1] * z[2]))::bigint as score
      from r a join r b on a.k <> b.k and len(a.x) = len(b.x) where a.vec_id % 50 = 0),
p as (select *, row_number() over (partition by a order by score desc, other_id) as place from s where same),
n as (select p.anchor_id, p.other_id as positive_id, s.other_id as negative_id, p.score as positive_score, s.score as negative_score,
             row_number() over (partition by p.a, p.place order by s.score desc, s.other_id) as rank
      from p join s on p.a = s.a where p.place <= 5 and not s.same and 50 * p.score <= 100 * s.score and 100 * s.score <= 95 * p.score)
select anchor_id, positive_id, rank::integer as rank, negative_id, positive_score, negative_score from n where rank <= 3
"""

# texts with equal sets are one class; links are proved on whole sets of classes
MINHASH = f"""
with w as (select doc_id, regexp_extract_all({lowered("coalesce(text, '')")}, '{WORD}') as w from documents),
d as (select doc_id, list_sort(list_distinct(case when len(w) > 1 then list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) else w end)) as s from w),
c as (select s, min(doc_id) as id, len(s) as n from d where len(s) > 0 group by s),
i as (select id, n, unnest(s) as g from c),
l as (select a.id as a, b.id as b from i a join i b on a.g = b.g and a.id < b.id and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
      group by a.id, b.id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
linked as (select a, b from l union all select b, a from l),
walk as (with recursive reach(v, u) as (select id, id from c union select r.v, linked.b from reach r join linked on r.u = linked.a) select v, min(u) as root from reach group by v)
select d.doc_id, len(d.s) as n_shingles, coalesce(walk.root, d.doc_id) as component_id, d.doc_id = coalesce(walk.root, d.doc_id) as kept
from d left join c on d.s = c.s left join walk on c.id = walk.v
"""

REGISTRY = {
    "op1_decontamination": DECONTAMINATION,
    "op4_line_dedup": LINE_DEDUP,
    "op6_warc": WARC,
    "op12_hard_negatives": HARD_NEGATIVES,
    "op13_minhash_tensor": MINHASH,
}
