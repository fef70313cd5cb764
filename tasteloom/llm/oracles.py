"""DuckDB SQL for the queries of this package that SQL can state."""

from __future__ import annotations

from tasteloom.llm import clustering, licenses, lines, mixing, resampling

BLANK = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _license_sql() -> str:
    """Phrases by word positions; every window of a template's span against its words, without any filter."""
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    listed = lambda words: f"[{', '.join(map(_quoted, words))}]::varchar[]"
    phrases = ", ".join(f"({listed(p.split())}, {_quoted(label)})" for p, label in licenses.PHRASES.items())
    templates = ", ".join(
        f"({_quoted(label)}, {listed(sorted(set(t.split())))}, {listed(licenses.NAMES.get(label, '').split())}, "
        f"{licenses._span(t)}, {licenses._step(t)})"
        for label, t in licenses.TEMPLATES.items()
    )
    need = f"ceil(len(t.words) * {licenses.THRESHOLD} - 1e-9)"
    return f"""
        with phrases(words, label) as (values {phrases}),
        templates(label, words, names, span, step) as (values {templates}),
        texts as (
            select doc_id, coalesce(text, '') as text,
                regexp_extract_all({lower.format("coalesce(text, '')")}, '{ALNUM}') as w
            from documents
        ), tokens as (
            select doc_id, w, unnest(range(len(w))) as pos from texts
        ), places as (
            select t.doc_id, p.label, t.pos from tokens t
            join phrases p on t.w[t.pos + 1] = p.words[1] and t.w[t.pos + 1 : t.pos + len(p.words)] = p.words
        ), windows as (
            select x.doc_id, t.label, t.words, t.names, unnest(list_transform(
                range(0, greatest(len(x.w) - t.span + t.step - 1, 0) + 1, t.step),
                lambda i: x.w[i + 1 : i + t.span])) as own
            from texts x cross join templates t
            where list_has_all(x.w, t.names) and len(list_intersect(t.words, x.w)) >= {need}
        ), found as (
            select doc_id, label, max(len(list_intersect(t.words, t.own)) / len(t.words)) as share from windows t
            where list_has_all(t.own, t.names) and len(list_intersect(t.words, t.own)) >= {need}
            group by all
        ), base as (
            select doc_id, count(*) as n_base, min(pos) as first_word, max(pos) as last_word,
                string_agg(distinct label, ',' order by label) as base_labels
            from places group by doc_id
        ), labelled as (
            select doc_id, string_agg(distinct label, ',' order by label) as labels from (
                select doc_id, label from places union all select doc_id, label from found
            ) group by doc_id
        ), best as (
            select doc_id, max(share) as share from found group by doc_id
        )
        select x.doc_id, len(x.w) as n_words, coalesce(b.n_base, 0) as n_base, b.first_word, b.last_word,
            coalesce(b.base_labels, '') as base_labels, coalesce(l.labels, '') as labels,
            cast(case when b.n_base > 0 then 1.0 else coalesce(s.share, 0.0) end as double) as score
        from texts x left join base b using (doc_id) left join labelled l using (doc_id) left join best s using (doc_id)"""


REPEATS = f"""
    with texts as (
        select doc_id, regexp_extract_all(coalesce(text, ''), '{BLANK}') as w from documents
    ), starts as (
        select doc_id, unnest(range(len(w) - 19)) as pos, w from texts where len(w) >= 20
    ), windows as (
        select doc_id, pos, row_number() over (partition by md5(array_to_string(w[pos + 1 : pos + 20], ' '))
            order by doc_id, pos) > 1 as again
        from starts
    ), gone as (
        select distinct doc_id, unnest(range(pos, pos + 20)) as pos from windows where again
    ), tokens as (
        select doc_id, unnest(range(len(w))) as pos, unnest(w) as word from texts
    ), kept as (
        select t.doc_id, count(g.pos) as n_removed, string_agg(t.word, ' ' order by t.pos) filter (g.pos is null) as kept
        from tokens t left join gone g on t.doc_id = g.doc_id and t.pos = g.pos group by t.doc_id
    )
    select x.doc_id, cast(len(x.w) as bigint) as n_words, coalesce(k.n_removed, 0) as n_removed,
        sha256(coalesce(k.kept, '')) as kept_sha256
    from texts x left join kept k using (doc_id)"""

# The exact counts that the sketches stand for; the first place of a line stays.  White space at its ends does not count.
ENDS = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"
LINES = f"""
    with parts as (
        select doc_id, source, string_split(text, chr(10)) as parts from documents
    ), rows as (
        select doc_id, coalesce(source, '') as site, unnest(parts) as line, generate_subscripts(parts, 1) as pos
        from parts
    ), wide as (
        select trim(line, {ENDS}) as k from rows where trim(line, {ENDS}) <> ''
        group by 1 having count(distinct site) >= {lines.SITES}
    ), marked as (
        select r.doc_id, r.line, r.pos,
            w.k is not null and row_number() over (partition by trim(r.line, {ENDS}) order by r.doc_id, r.pos) > 1 as gone
        from rows r left join wide w on trim(r.line, {ENDS}) = w.k
    ), kept as (
        select doc_id, count(*) as n_lines, count(*) filter (gone) as n_removed,
            coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '') as text
        from marked group by doc_id
    )
    select d.doc_id, coalesce(k.n_lines, 0) as n_lines, coalesce(k.n_removed, 0) as n_removed,
        case when d.text is null then null else k.text end as text
    from documents d left join kept k on d.doc_id = k.doc_id"""

QUALITY = f"""
    with texts as (
        select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '{BLANK}') as w from documents
    ), starts as (
        select doc_id, unnest(range(len(w) - 4)) as pos, w from texts where len(w) >= 5
    ), windows as (
        select doc_id, pos, count(*) over (partition by doc_id, md5(array_to_string(w[pos + 1 : pos + 5], ' '))) as times
        from starts
    ), covered as (
        select doc_id, count(distinct pos) as n from (
            select doc_id, unnest(range(pos, pos + 5)) as pos from windows where times > 1
        ) group by doc_id
    ), parts as (
        select doc_id, unnest(string_split(text, chr(10))) as line from texts
    ), dups as (
        select doc_id, count(*) as lines, count(*) filter (regexp_matches(line, '{BLANK}'))
            - count(distinct line) filter (regexp_matches(line, '{BLANK}')) as n from parts group by doc_id
    ), measured as (
        select t.doc_id, cast(len(t.w) as bigint) as n_words,
            cast(length(array_to_string(t.w, '')) as bigint) as word_chars,
            cast(length(t.text) - length(regexp_replace(t.text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
            d.n as n_dup_lines, coalesce(c.n, 0) as n_repeat_words, d.lines
        from texts t left join covered c using (doc_id) left join dups d using (doc_id)
    ), judged as (
        select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from measured
    )
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        not base_failed and not (n_symbols * 10 > word_chars) and not (word_chars > n_words * 30)
            and not (lines >= 10 and n_dup_lines * 2 > lines) as kept
    from judged"""



def _clusters_sql() -> str:
    """Every vector against every centroid in each round, without any bound."""
    k = clustering
    far = "cast(list_sum(list_transform(list_zip({v}, {c}), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as bigint)"
    parts = []
    for i in range(k.ROUNDS + 1):
        parts.append(f"""
        a{i} as materialized (
            select row, arg_min(c, (d, c)) as c, min(d) as d from (
                select p.row, m.c, {far.format(v="p.v", c="m.v")} as d from kept p, c{i} m) group by row)""")
        if i < k.ROUNDS:
            parts.append(f"""
        c{i + 1} as materialized (
            select o.c, coalesce(n.v, o.v) as v from c{i} o left join (
                select c, list(cast((s - ((s % n + n) % n)) // n as bigint) order by i) as v from (
                    select a.c, e.i, sum(p.v[e.i]) as s, count(*) as n from a{i} a join kept p using (row),
                    range(1, {k.DIMS + 1}) e(i) group by all) group by c) n using (c))""")
    last = k.ROUNDS
    return f"""
        with whole as (
            select vec_id, list_transform(embedding, lambda x: cast(x as double) * {k.SCALE}) as v
            from embeddings where len(embedding) = {k.DIMS}
        ), kept as materialized (
            select row_number() over () as row, vec_id, list_transform(v, lambda x: cast(floor(x) as bigint)) as v
            from whole where len(list_filter(v, lambda x: x is null or not coalesce(abs(x) < {k.largest(k.DIMS)}, false))) = 0
        ), c0 as materialized (
            select row_number() over (order by sha256('{k.SEED}:' || vec_id), v) - 1 as c, v
            from kept order by sha256('{k.SEED}:' || vec_id), v limit {k.CENTROIDS}
        ), {",".join(parts)},
        sums as (select c, sum(d) as s from a{last} group by c)
        select p.vec_id, cast(a.c as integer) as cluster, a.d as distance, cast(s.s as bigint) as cluster_inertia,
            cast((select sum(s) from sums) as bigint) as inertia, sha256(array_to_string(m.v, ',')) as centroid_sha256
        from kept p join a{last} a using (row) join sums s on s.c = a.c join c{last} m on m.c = a.c"""


def _resampling_sql() -> str:
    """CRC-32 of every distinct word, byte by byte; then counts, gains and the draw."""
    r = resampling
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    step = "case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end"
    table = "n"
    for _ in range(8):
        table = f"list_transform([{table}], lambda x: {step})[1]"
    return f"""
        with crc as materialized (
            select list({table} order by n) as t from (select cast(range as bigint) as n from range(256))
        ), texts as materialized (
            select row_number() over () as row, doc_id, regexp_extract_all({lower}, '{ALNUM}') as w from documents
        ), own as (
            select row, unnest(w) as word from texts
        ), wanted as (
            select unnest(regexp_extract_all({lower}, '{ALNUM}')) as word from benchmark
        ), words as materialized (
            select word, xor(list_reduce(
                list_prepend(4294967295, list_transform(range(octet_length(encode(word))),
                    lambda i: cast('0x' || substr(hex(encode(word)), cast(2 * i + 1 as bigint), 2) as bigint))),
                lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % {r.BUCKETS} as bucket
            from (select word from own union select word from wanted), crc
        ), s as (
            select bucket, count(*) as n from own join words using (word) group by bucket
        ), t as (
            select bucket, count(*) as n from wanted join words using (word) group by bucket
        ), sums as (
            select (select coalesce(sum(n), 0) from s) + {r.BUCKETS}.0 as s, (select coalesce(sum(n), 0) from t) + {r.BUCKETS}.0 as t
        ), gains as materialized (
            select range as bucket, cast(floor(1000 * ln(
                cast(coalesce(t.n, 0) + 1 as double) * cast(sums.s as double)
                / (cast(coalesce(s.n, 0) + 1 as double) * cast(sums.t as double)))) as bigint) as gain
            from range({r.BUCKETS}) left join s on s.bucket = range left join t on t.bucket = range, sums
        ), weights as (
            select row, count(*) as n, sum(gain) as weight
            from own join words using (word) join gains using (bucket) group by row
        ), scored as (
            select x.doc_id, x.row, coalesce(g.n, 0) as n_features, cast(coalesce(g.weight, 0) as bigint) as weight,
                cast('0x' || substr(sha256('{r.SEED}:' || coalesce(cast(x.doc_id as varchar), '')), 1, 8) as bigint) as h
            from texts x left join weights g using (row)
        ), noisy as (
            select *, weight + cast(floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double))) as bigint) as score from scored
        ), ranked as (
            select *, row_number() over (partition by n_features >= {r.LEAST_WORDS} order by score desc, doc_id) as place,
                (select count(*) from noisy where n_features >= {r.LEAST_WORDS}) * {r.PERCENT} // 100 as drawn
            from noisy
        )
        select doc_id, n_features, weight, score,
            case when n_features >= {r.LEAST_WORDS} and place <= drawn then place end as rank
        from ranked"""


def _mixing_sql() -> str:
    """Shares are reshared often enough for twenty sources; the words taken are the first ones of each shuffled source."""
    m = mixing
    weights = "[" + ", ".join(map(str, m.WEIGHTS)) + "]"
    rounds = ", ".join(
        f"""
        r{i + 1} as materialized (
            select r.* replace (free and w * rest <= cap * left_w as free) from r{i} r, (
                select (select coalesce(sum(size), 0) from r{i}) - coalesce(sum(cap) filter (not free), 0) as rest,
                    coalesce(sum(w) filter (free), 0) as left_w from r{i})
        )"""
        for i in range(20)
    )
    return f"""
        with rows as materialized (
            select row_number() over () as row, doc_id, cast(len(regexp_extract_all(coalesce(text, ''), '{BLANK}')) as bigint) as size,
                coalesce('0' || source, '1') as key, md5('{m.SEED}:' || coalesce(cast(doc_id as varchar), '')) as mark
            from documents
        ), r0 as materialized (
            select key, size, {weights}[(number - 1) % {len(m.WEIGHTS)} + 1] as w, {m.MOST} * size as cap, true as free from (
                select key, sum(size) as size, row_number() over (order by key) as number from rows group by key)
        ), {rounds},
        last as (
            select (select coalesce(sum(size), 0) from r20) - coalesce(sum(cap) filter (not free), 0) as rest,
                coalesce(sum(w) filter (free), 0) as left_w from r20
        ), targets as (
            select key, cast(size as bigint) as source_size, cap,
                case when free then cast(rest as double) * cast(w as double) / greatest(cast(left_w as double), 1.0)
                    else cast(cap as double) end as target
            from r20, last
        ), laid as (
            select r.*, t.source_size, t.target, least(round(t.target), t.cap) as goal,
                sum(r.size) over (partition by key order by r.mark, r.doc_id nulls first, r.size, r.row) - r.size as start
            from rows r join targets t using (key)
        )
        select doc_id, size, source_size, target, cast(
            {" + ".join(f"greatest(least(goal - start - {i} * source_size, size), 0)" for i in range(m.MOST))} as bigint) as taken
        from laid"""


ORACLE = {
    "op1_license_scan": _license_sql(),
    "op4_substring_dedup": REPEATS,
    "op6_line_dedup": LINES,
    "op9_quality_rules": QUALITY,
    "op11_centroid_clustering": _clusters_sql(),
    "op12_importance_resampling": _resampling_sql(),
    "op13_source_mixing": _mixing_sql(),
}
