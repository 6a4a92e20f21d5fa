"""The rows of the two queries that cut repeats, in another engine's SQL: by the contracts, not by the operators' methods."""

from __future__ import annotations

#: Windows that begin in one piece of a text; a place is found faster in a short string.
PIECE = 300


def repeated_words(least: int = 50) -> str:
    """Words covered by a window that also starts in a document with a smaller id."""
    return rf"""with d as materialized (select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
 words as (select r, doc_id, unnest(w) as word, generate_subscripts(w, 1) as p from d),
 win as (select r, doc_id, p, count(*) over ahead as n, list(word) over ahead as ws from words
   window ahead as (partition by r order by p rows between current row and {least - 1} following)),
 keyed as (select r, doc_id, p, md5(array_to_string(ws, ' ')) as k from win where n = {least}),
 firsts as (select k, min(doc_id) as least from keyed group by k),
 hits as (select r, p from keyed join firsts using (k) where least < doc_id),
 gone as (select distinct r, unnest(range(p, p + {least})) as p from hits),
 kept as (select words.r, count(*) as n, count(gone.p) as removed, string_agg(word, ' ' order by words.p) filter (where gone.p is null) as t
   from words left join gone on gone.r = words.r and gone.p = words.p group by 1)
select doc_id, coalesce(n, 0)::bigint as n_words, coalesce(removed, 0)::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
from d left join kept using (r)"""


def repeated_bytes(least: int = 400) -> str:
    """Bytes covered by a string that also starts elsewhere; texts as hex digits, two for each byte."""
    return f"""with d as materialized (select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as h from documents),
 pieces as (select r, piece, substr(h, {2 * PIECE} * piece + 1, {2 * (PIECE + least - 1)}) as h from (select r, h, unnest(range(0, length(h) // {2 * PIECE} + 1)) as piece from d)),
 places as (select r, h, piece, unnest(range(1, least(length(h) // 2 - {least - 2}, {PIECE + 1}))) as i from pieces where length(h) >= {2 * least}),
 keyed as (select r, {PIECE} * piece + i as i, md5(substr(h, 2 * i - 1, {2 * least})) as k from places),
 twice as (select k from keyed group by k having count(*) > 1),
 hits as (select r, i from keyed semi join twice using (k)),
 marked as (select r, i, case when i <= lag(i) over (partition by r order by i) + {least} then 0 else 1 end as fresh from hits),
 grouped as (select r, i, sum(fresh) over (partition by r order by i) as g from marked),
 runs as (select r, min(i) as a, max(i) + {least - 1} as b from grouped group by r, g),
 parts as (select runs.r, a, b, substr(h, 2 * (coalesce(lag(b) over (partition by runs.r order by a), 0) + 1) - 1,
     2 * (a - 1 - coalesce(lag(b) over (partition by runs.r order by a), 0))) as t from runs join d using (r)),
 cut as (select r, sum(b - a + 1) as gone, count(*) as n, max(b) as last, string_agg(t, '' order by a) as t from parts group by r)
select doc_id, (length(h) // 2)::bigint as n_bytes, coalesce(gone, 0)::bigint as n_removed, coalesce(n, 0)::bigint as n_spans,
 sha256(unhex(case when n is null then h else t || substr(h, 2 * last + 1) end)) as kept_sha256
from d left join cut using (r)"""
