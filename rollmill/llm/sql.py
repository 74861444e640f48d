"""DuckDB SQL of the operators that it can express; loops of the methods are written out step by step."""

from __future__ import annotations

#: CRC-32 of a string, byte by byte; the table of its steps comes from the polynomial 0xEDB88320.
CRC_STEPS = "crc_steps as (select list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, n)) as steps)"


def crc(x: str) -> str:
    byte_list = f"list_transform(range(0, strlen({x})), lambda i: ('0x' || substr(hex({x}), (2 * i + 1)::int, 2))::int::bigint)"
    return f"xor(list_reduce({byte_list}, lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"


def rules(buckets: int, prior: int, least: float, unit: int, pair: int, least_words: int, most_repeated: int) -> str:
    return f"""
    with {CRC_STEPS}, docs as (
        select row_number() over () as r, d.doc_id, coalesce(text, '') as text, coalesce(good, 0) as good
        from documents d left join (select distinct doc_id, 1 as good from labels where quality > 0) l on d.doc_id = l.doc_id
    ), words as (
        select r, good, unnest(w) as word, unnest(range(len(w))) as i from (select r, good, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') as w from docs)
    ), codes as materialized (
        select word, {crc('word')} as code from (select distinct word from words), crc_steps
    ), coded as materialized (
        select r, good, i, code, coalesce(lead(code) over (partition by r order by i), 0) as next from words join codes using (word)
    ), grams as materialized (
        select r, good, code & {buckets - 1} as bucket from coded union all select r, good, (code * {pair} + next) & {buckets - 1} from coded
    ), counts as (
        select bucket, count(*) as n, sum(good)::bigint as t from grams group by bucket
    ), totals as (
        select sum(n)::double / nullif(sum(t), 0)::double as scale from counts
    ), weights as (
        select bucket, coalesce(round(ln((t * scale + {float(prior)}) / (n + {float(prior)})) * {unit}), 0)::bigint as weight from counts, totals
    ), scored as (
        select r, sum(weight)::bigint as total from grams join weights using (bucket) group by r
    ), runs as (
        select r, i, count(*) over (partition by r, a, b, c) as times from (
            select r, i, word as a, lead(word) over w as b, lead(word, 2) over w as c from words window w as (partition by r order by i)
        ) where c is not null
    ), repeated as (
        select r, count(distinct place) as n_repeat_words from (select r, i + unnest([0, 1, 2]) as place from runs where times > 1) group by r
    ), lines as (
        select r, count(*) - count(distinct line) as n_dup_lines from (select r, unnest(string_split(text, chr(10))) as line from docs)
        where regexp_matches(line, '[^\\x20\\x09-\\x0D]') group by r
    ), measured as (
        select doc_id, r, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'))::bigint as n_words,
            length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g'))::bigint as word_chars,
            (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
            coalesce(n_dup_lines, 0)::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words, coalesce(total, 0) as total
        from docs left join lines using (r) left join repeated using (r) left join scored using (r)
    )
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
        n_words < {least_words} or n_repeat_words * 100 > n_words * {most_repeated} as base_failed,
        case when n_words > 0 then total / (n_words * 2 * {unit}) else 0.0 end as log_ratio,
        not (n_words < {least_words} or n_repeat_words * 100 > n_words * {most_repeated}) and total >= n_words * 2 * {round(least * unit)} as kept
    from measured
    """


def k_means(k: int, rounds: int, dims: int) -> str:
    steps = []
    for n in range(rounds + 1):
        steps.append(f"""
        a{n} as materialized (
            select vec_id, cluster, distance from (
                select vec_id, cluster, distance, row_number() over (partition by vec_id order by distance, cluster) as place from (
                    select v.vec_id, c.cluster, sum((v.x - c.x) * (v.x - c.x))::bigint as distance from v join c{n} c on v.i = c.i group by v.vec_id, c.cluster
                )
            ) where place = 1
        )""")
        if n < rounds:
            steps.append(f"""
        c{n + 1} as materialized (
            select c.cluster, c.i, coalesce(m.x, c.x) as x from c{n} c left join (
                select cluster, i, ((s - (((s % n) + n) % n)) // n)::bigint as x from (select cluster, i, sum(x)::bigint as s, count(*) as n from a{n} join v using (vec_id) group by cluster, i)
            ) m on c.cluster = m.cluster and c.i = m.i
        )""")
    return f"""
    with kept as (
        select vec_id, embedding from embeddings where len(embedding) = {dims} and len(list_filter(embedding, lambda x: isfinite(x))) = {dims}
    ), v as materialized (
        select vec_id, unnest(range({dims})) as i, unnest(list_transform(embedding, lambda x: floor(1024 * x::double)::bigint)) as x from kept
    ), seeds as (
        select vec_id, row_number() over (order by sha256('3:' || vec_id)) - 1 as cluster from kept
    ), c0 as materialized (
        select cluster, i, x from v join seeds using (vec_id) where cluster < {k}
    ), {','.join(steps)},
    sums as (select cluster, sum(distance)::bigint as cluster_inertia from a{rounds} group by cluster),
    digests as (select cluster, sha256(string_agg(x::varchar, ',' order by i)) as centroid_sha256 from c{rounds} group by cluster)
    select vec_id, cluster::int as cluster, distance, cluster_inertia, (select sum(distance)::bigint from a{rounds}) as inertia, centroid_sha256
    from a{rounds} join sums using (cluster) join digests using (cluster)
    """


def merkle(fan: int, leaf_levels: int, top_levels: int) -> str:
    """Trees of up to fan ** leaf_levels leaves and fan ** top_levels groups."""

    def field(x: str) -> str:
        return f"coalesce(octet_length(encode({x}::varchar)) || ':' || {x}::varchar, '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(field(x) for x in ('doc_id', 'source', 'lang', 'n_chars', text))})"

    def tree(name: str, start: str, levels: int) -> str:
        parts = [f"{name}0 as materialized (select g, i, n, h from {start})"]
        for k in range(levels):
            parts.append(f"{name}{k + 1} as materialized (select g, i // {fan} as i, (n + {fan - 1}) // {fan} as n, case when n > 1 then sha256(string_agg(h, '' order by i)) else min(h) end as h from {name}{k} group by g, i // {fan}, n)")
            parts.append(f"{name}s{k} as (select x.g, x.i, coalesce(string_agg(y.h, '' order by y.i) filter (y.i < x.i), '') as l, coalesce(string_agg(y.h, '' order by y.i) filter (y.i > x.i), '') as r, max(x.n) > 1 as more from {name}{k} x join {name}{k} y on x.g = y.g and x.i // {fan} = y.i // {fan} group by x.g, x.i)")
        return ", ".join(parts)

    def climb(name: str, start: str, levels: int) -> str:
        parts, now = [], start
        for k in range(levels):
            parts.append(f"{name}p{k + 1} as (select d.* replace (case when more then sha256(l || f || r) else f end as f, p || case when more then l || r else '' end as p) from {now} d join {name}s{k} s on d.{name}g = s.g and d.{name}i // {fan**k} = s.i)")
            now = f"{name}p{k + 1}"
        return ", ".join(parts)

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
    with {CRC_STEPS}, docs as (
        select *, {leaf('text')} as leaf, case when {crc('doc_id::varchar')} % 3 = 0 then {leaf(lower)} else {leaf('text')} end as f from documents, crc_steps
    ), langs as (
        select lang, row_number() over (order by lang is not null, encode(lang)) - 1 as g, count(*) over () as n from (select distinct lang from docs)
    ), placed as materialized (
        select doc_id, leaf, f, langs.g, row_number() over (partition by langs.g order by doc_id nulls first, leaf) - 1 as i, count(*) over (partition by langs.g) as n, leaf as h
        from docs join langs on docs.lang is not distinct from langs.lang
    ), {tree('a', 'placed', leaf_levels)},
    subroots as (select 0 as g, langs.g as i, langs.n, h from langs join a{leaf_levels} x on langs.g = x.g),
    {tree('b', 'subroots', top_levels)},
    base as (select doc_id, leaf, f, '' as p, g as ag, i as ai, 0 as bg, g as bi from placed),
    {climb('a', 'base', leaf_levels)}, {climb('b', f'ap{leaf_levels}', top_levels)}
    select doc_id, leaf, subroots.h as subroot, b{top_levels}.h as root, sha256(p) as proof_sha256, f as folded_root, f = b{top_levels}.h as verified
    from bp{top_levels} d join subroots on d.bi = subroots.i, b{top_levels}
    """
