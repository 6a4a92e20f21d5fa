"""Pieces of oracle SQL: the same definitions spelled for the comparison engine."""

from __future__ import annotations

from loomdex.functions.text import HTML_STEPS, REMOVAL_PATTERNS

WS = (
    r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
LINE_END = r"\r\n|[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def replace_all(expr: str, pattern: str, to: str = "", flags: str = "g") -> str:
    return f"regexp_replace({expr}, {literal(pattern)}, {literal(to)}, '{flags}')"


def basic(expr: str) -> str:
    return f"trim({replace_all(expr, WS + '+', ' ')})"


def removed(expr: str) -> str:
    for pattern in REMOVAL_PATTERNS:
        expr = replace_all(expr, pattern, "", "gi")
    return expr


def stripped(expr: str) -> str:
    inside = WS[1:-1]
    return replace_all(expr, f"[^a-zA-Z0-9{inside}.,!?-]")


def spaced(expr: str) -> str:
    return replace_all(expr, WS + r"+([.,!?])", r"\1")


def advanced(expr: str) -> str:
    return spaced(stripped(removed(basic(expr))))


def tokens(expr: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({expr}), {literal(WS + '+')}), lambda t: t <> '')"


def html_text(expr: str) -> str:
    for pattern, to in HTML_STEPS:
        expr = replace_all(expr, pattern, to)
    return expr


def section(expr: str, marker: str = "Antrag Regierungsrat") -> str:
    m = literal(marker)
    rest = f"substr({expr}, strpos({expr}, {m}) + length({m}))"
    rest = replace_all(rest, f"^{WS}+|{WS}+$")
    lines = f"regexp_split_to_array({rest}, {literal(LINE_END)})[2:]"
    kept = f"list_filter({lines}, lambda l: regexp_matches(l, {literal('[^' + WS[1:])}))"
    cleaned = f"list_transform({kept}, lambda l: {basic('l')})"
    return f"coalesce(array_to_string({cleaned}, ' '), '')"


# Chains of common table expressions ---------------------------------------------------------

def vocabulary_ctes(cap: int, pad: bool) -> str:
    """From corpus(id, ord, text): toks, stats, vocab(idx, token, n, idf)."""
    padded = (
        f"select i.range as idx, coalesce(token, '') as token, coalesce(n, 0) as n, coalesce(idf, 0.0) as idf "
        f"from range({cap}) i left join ranked on ranked.idx = i.range"
        if pad
        else "select * from ranked"
    )
    return f"""toks as (select id, ord, unnest(ts) as token, generate_subscripts(ts, 1) as pos
   from (select id, ord, {tokens('text')} as ts from corpus)),
 firsts as (select token, count(*) as n, count(distinct id) as df, min((ord, pos)) as first from toks group by token),
 raws as (select *, ln((select count(*) from corpus) - df + 0.5) - ln(df + 0.5) as raw from firsts),
 idfs as (select *, case when raw < 0 then 0.25 * (select avg(raw) from raws) else raw end as idf from raws),
 ranked as (select row_number() over (order by n desc, first) - 1 as idx, token, n, idf from idfs
   order by n desc, first limit {cap}),
 vocab as ({padded})"""


def dense_ctes(source: str, prefix: str, dim: int) -> str:
    """From source(id, text): {prefix}vec(id, v) as hashed unit vectors of floats."""
    p = prefix
    return f"""{p}code as (select id, ('0x' || substr(md5(t), 1, 8))::bigint as h
   from (select id, unnest({tokens('text')}) as t from {source})),
 {p}sums as (select id, (h >> 1) % {dim} as b, sum(case when h % 2 = 0 then 1 else -1 end)::double as v from {p}code group by 1, 2),
 {p}norm as (select id, sqrt(sum(v * v)) as nv from {p}sums group by 1),
 {p}vec as (select s.id, list(coalesce(case when nv > 0 then (v / nv)::float else 0 end, 0)::double order by i.range) as v
   from (select distinct id from {source}) s cross join range({dim}) i
   left join {p}sums b on b.id = s.id and b.b = i.range left join {p}norm n on n.id = s.id group by 1)"""


def sparse_ctes(source: str, prefix: str, weight: str, toks: str = tokens("text")) -> str:
    """From source(id, ...) and vocab: {prefix}sp(id, w) with the given weight per known token."""
    p = prefix
    return f"""{p}has as (select distinct id, unnest({toks}) as token from {source}),
 {p}sp as (select s.id, list(case when h.token is not null then {weight} else 0.0 end order by v.idx) as w
   from (select distinct id from {source}) s cross join vocab v
   left join {p}has h on h.id = s.id and h.token = v.token and v.token <> '' group by 1)"""


def cosine(a: str, b: str) -> str:
    return f"round(coalesce(case when list_dot_product({a}, {a}) > 0 and list_dot_product({b}, {b}) > 0 then list_dot_product({a}, {b}) / (sqrt(list_dot_product({a}, {a})) * sqrt(list_dot_product({b}, {b}))) end, 0), 9)"


def prefix_ctes(prefixes: tuple[int, ...], quantised: tuple[int, ...]) -> str:
    """From vec(id, v): per prefix length n the vectors p{n}(id, v), decoded from codes if quantised."""
    parts = []
    for n in prefixes:
        if n not in quantised:
            parts.append(f"p{n} as (select id, v[1:{n}] as v from vec)")
            continue
        parts.append(
            f"""u{n} as (select id, list_transform(v[1:{n}], lambda x: case when nn > 0 then (x / nn)::float::double else 0.0 end) as v
   from (select id, v, sqrt(list_dot_product(v[1:{n}], v[1:{n}])) as nn from vec)),
 b{n} as (select min(list_min(v)) as lo, max(list_max(v)) as hi from u{n}),
 p{n} as (select id, list_transform(v, lambda x: lo + floor((x - lo) / (hi - lo) * 127 + 0.5) / 127 * (hi - lo)) as v from u{n}, b{n})"""
        )
    return ",\n ".join(parts)


def cascade_ctes(prefixes: tuple[int, ...], limits: tuple[int, ...]) -> str:
    """From p{n} and qvec(id, v): cascade(qid, id, score, rank)."""
    out, before = [], None
    for i, (n, limit) in enumerate(zip(prefixes, limits, strict=True), 1):
        score = cosine("p.v", f"q.v[1:{n}]")
        join = f"join c{i - 1} k on k.qid = q.id and k.id = p.id" if before else ""
        out.append(
            f"""c{i} as (select qid, id, score, r{i} as rank from (select qid, id, score, row_number() over (partition by qid order by score desc, id) as r{i}
   from (select q.id as qid, p.id as id, {score} as score from p{n} p cross join qvec q {join})) where r{i} <= {limit})"""
        )
        before = n
    return ",\n ".join(out) + f",\n cascade as (select * from c{len(prefixes)})"


def branch_cte(name: str, score: str, tables: str, limit: int, where: str = "") -> str:
    return f"""{name} as (select qid, id, score, r_{name} as rank from (select qid, id, score, row_number() over (partition by qid order by score desc, id) as r_{name}
   from (select q.id as qid, p.id as id, {score} as score from {tables}) {where}) where r_{name} <= {limit})"""


def fusion_ctes(branches: list[str], limit: int) -> str:
    union = " union all ".join(f"select qid, id, rank from {b}" for b in branches)
    return f"""fused as (select qid, id, round(sum(1.0 / (2 + rank - 1)), 9) as score from ({union}) group by 1, 2),
 hits as (select qid, rank, id, score from (select *, row_number() over (partition by qid order by score desc, id) as rank from fused) where rank <= {limit})"""


def hybrid_ctes(
    limit: int,
    dim: int = 1024,
    cap: int = 256,
    pad: bool = True,
    limits: tuple[int, ...] = (200, 100, 50),
    quantised: tuple[int, ...] = (64, 128),
    oversample: int = 2,
    query_weight: str = "1.0",
    query_tokens: str = tokens("text"),
    points: str = "corpus",
) -> str:
    """From corpus(id, ord, text) and asked(id, text): hits(qid, rank, id, score).

    ``points`` may name a part of the corpus that is searched, while statistics cover all of it.
    """
    return ",\n ".join(
        [
            vocabulary_ctes(cap, pad),
            dense_ctes(points, "", dim),
            dense_ctes("asked", "q", dim),
            sparse_ctes(points, "", "v.idf"),
            sparse_ctes("asked", "q", query_weight, query_tokens),
            prefix_ctes((64, 128, 256), quantised),
            cascade_ctes((64, 128, 256), limits),
            branch_cte("dense", cosine("p.v", "q.v"), "vec p cross join qvec q", limit * oversample),
            branch_cte("sparse", "round(list_dot_product(p.w, q.w), 9)", "sp p cross join qsp q", limit * oversample),
            fusion_ctes(["cascade", "dense", "sparse"], limit),
        ]
    )
