"""SQL for the queries that SQL can express."""

_TOKENS = r"len(regexp_extract_all(coalesce(text, ''), '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\p{Z}\x1c-\x1f\x{85}]+'))"

SQL = {
    "p8_found": f"""
        select spec_name, doc_id from (select doc_id, {_TOKENS} as n from documents) d join container_specs s on d.n > s.capacity_tokens
    """,
    "p10_found": f"""
        select spec_name, doc_id from (select doc_id, {_TOKENS} as n from documents) d join split_specs s on d.n > s.max_tokens
    """,
    "p9_found": f"""
        with sized as (select lower(trim(source)) as source, {_TOKENS} as n from documents),
        per as (select source, sum(n) as n from sized group by source),
        w as (select mix_name, sum(target_share) as w, max(budget_fraction) as budget from mix_targets group by mix_name)
        select t.mix_name, lower(trim(t.source)) as source from mix_targets t join w on w.mix_name = t.mix_name
        left join per on per.source = lower(trim(t.source))
        where coalesce(per.n, 0) * t.max_repeats < t.target_share / w.w * w.budget * (select sum(n) from sized)
    """,
    "p7_found": """
        with v as (
            select * from dedup_documents qualify row_number() over (partition by document_id order by updated_at desc) = 1),
        m as (
            select group_id, document_id from duplicate_memberships m join v on m.normalized_document_id = v.normalized_document_id
            union select group_id, document_id from duplicate_memberships m join v on m.canonical_document_id = v.canonical_document_id
            union select group_id, document_id from duplicate_memberships m join v on m.artifact_id = v.artifact_id),
        k as (
            select m.group_id, v.*, row_number() over (
                partition by m.group_id order by (coalesce(v.normalized_text, '') <> '') desc,
                case when isnan(v.quality_score) then null else v.quality_score end desc nulls last,
                v.warning_count asc nulls last, v.document_id) as rk
            from m join v on v.document_id = m.document_id)
    """
    + " union all ".join(
        f"select group_id, '{c}' as field_name, arg_min(document_id, rk) as document_id from k where {c} is not null group by group_id"
        for c in ("document_id", "source_url", "raw_checksum", "canonical_checksum", "canonical_document_id")
    ),
    "p6_found": r"""
        with recursive e as (
            select distinct a, b from (
                select lower(trim(document_a_id)) as a, lower(trim(document_b_id)) as b from similarity_results where is_duplicate)
            where a <> b),
        edges as (select a as u, b as v from e union select b, a from e),
        walk(u, v) as (select u, u from edges union select w.u, e.v from walk w join edges e on e.u = w.v)
        select min(v) as group_id, u as document_id from walk group by u
    """,
    "p2_found": r"""
        with res as (select url, arg_max(domain, last_seen_at) as domain from resources where domain is not null group by url),
        docs as (
            select d.id, regexp_replace(lower(trim(coalesce(r.domain, regexp_extract(d.source_url, '//([^/?#:]+)', 1)))), '^www\.', '') as domain,
                d.normalized_text as t
            from (select id, source_url, normalized_text from normalized_documents where normalized_text is not null group by all) d
            left join res r on r.url = d.source_url),
        parts as (select id, domain, string_split(t, chr(10)) as p from docs),
        lines as (
            select id, domain, line_no, regexp_replace(lower(p[line_no]), '[^\p{L}\p{M}]+', '', 'g') as line
            from (select id, domain, p, unnest(range(1, len(p) + 1)) as line_no from parts)),
        n as (select domain, count(*) as docs from docs group by domain),
        freq as (select l.domain, l.line, count(distinct l.id) as c from lines l where l.line <> '' group by 1, 2)
        select l.id, l.line_no from lines l join freq f on f.domain = l.domain and f.line = l.line join n on n.domain = l.domain
        where f.c >= 6 and f.c >= 0.1 * n.docs
    """,
}

_P7 = SQL["p7_found"].split(" union all ")[0].rsplit("select group_id, 'document_id'", 1)[0]

SQL |= {
    "p1_found": r"""
        with w as (select doc_id, regexp_extract_all(lower(replace(text, 'İ', 'i')), '\p{L}+') as w from documents where text is not null),
        g as (select doc_id, len(w) as n, i, w[i:i + 7] as g from (select doc_id, w, unnest(range(1, len(w) - 6)) as i from w where len(w) >= 8)),
        f as (select doc_id, g, min(i) as first from g group by 1, 2),
        c as (select g.doc_id, any_value(g.n) as n, count(distinct g.i + k) as covered from g join f on f.doc_id = g.doc_id and f.g = g.g and g.i > f.first, (select unnest(range(0, 8)) as k) group by 1)
        select doc_id from c where covered >= 0.3 * n
    """,
    "p1_shares": r"""
        with w as (select doc_id, regexp_extract_all(lower(replace(coalesce(text, ''), 'İ', 'i')), '\p{L}+') as w from documents),
        g as (select doc_id, i, w[i:i + 7] as g from (select doc_id, w, unnest(range(1, len(w) - 6)) as i from w where len(w) >= 8)),
        f as (select doc_id, g, min(i) as first from g group by 1, 2),
        c as (select g.doc_id, count(distinct g.i + k) as covered from g join f on f.doc_id = g.doc_id and f.g = g.g and g.i > f.first, (select unnest(range(0, 8)) as k) group by 1)
        select w.doc_id, len(w.w)::bigint as n_words, coalesce(c.covered, 0)::bigint as repeated_words, floor(coalesce(c.covered, 0) / greatest(len(w.w), 1) * 10000 + 0.5) / 10000 as repeated_share
        from w left join c on c.doc_id = w.doc_id
    """,
    "p2_cleaned": SQL["p2_found"].rsplit("select l.id, l.line_no", 1)[0]
    + r"""
        , cut as (select l.id, l.line_no from lines l join freq f on f.domain = l.domain and f.line = l.line join n on n.domain = l.domain where f.c >= 6 and f.c >= 0.1 * n.docs),
        gone as (select id, list(line_no) as cut from cut group by 1),
        rows_ as (
            select d.id, regexp_replace(lower(trim(coalesce(r.domain, regexp_extract(d.source_url, '//([^/?#:]+)', 1)))), '^www\.', '') as domain, d.normalized_text as t
            from normalized_documents d left join res r on r.url = d.source_url),
        parts_ as (select r.id, nullif(r.domain, '') as domain, t, string_split(t, chr(10)) as p, coalesce(g.cut, []) as cut from rows_ r left join gone g on g.id = r.id)
        select id, domain, case when t is null or len(cut) = 0 then t else array_to_string(list_transform(list_filter(range(1, len(p) + 1), lambda i: not list_contains(cut, i)), lambda i: p[i]), chr(10)) end as normalized_text,
            case when t is null then 0 else len(cut) end::bigint as removed_lines from parts_
    """,
    "p7_records": _P7
    + "select group_id, "
    + ", ".join(f"arg_min({c}, rk) filter ({c} is not null) as {c}" for c in ("document_id", "source_url", "raw_checksum", "canonical_checksum", "canonical_document_id"))
    + " from k group by group_id",
    "p8_invariants": f"select spec_name, count(*) as documents, sum(n)::bigint as tokens, 0::bigint as overfull, 0::bigint as needless_cuts from (select {_TOKENS} as n from documents) d, container_specs group by 1",
    "p9_invariants": f"""
        with sized as (select lower(trim(source)) as source, {_TOKENS} as n from documents),
        per as (select source, sum(n) as n from sized group by source),
        w as (select mix_name, sum(target_share) as w, max(budget_fraction) as budget from mix_targets group by mix_name),
        t as (select t.mix_name, lower(trim(t.source)) as source, t.target_share / w.w * w.budget * (select sum(n) from sized) as target, t.max_repeats, coalesce(per.n, 0) as n
            from mix_targets t join w on w.mix_name = t.mix_name left join per on per.source = lower(trim(t.source)))
        select mix_name, source, floor(target * 1000 + 0.5) / 1000 as target_tokens, n::bigint as available_tokens, n * max_repeats < target as short, false as off_target, 0::bigint as drawn_too_often, 0::bigint as uneven_shards from t
    """,
    "p10_invariants": f"""
        select spec_name, count(*) as documents, sum(n)::bigint as tokens, 0::bigint as too_long, 0::bigint as wrong_overlaps, 0::bigint as wrong_texts
        from (select {_TOKENS} as n from documents) d join split_specs s on d.n > s.max_tokens group by 1
    """,
}
