"""SQL that gives the rows of the core queries, where SQL can."""

_BLANK = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
_LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
_DIGIT = r"\p{Nd}²³¹⁰⁴-⁹₀-₉"
_ROUND = "floor({0} * 10000 + 0.5) / 10000"

_HOST = r"nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '')"
_PATH = "split_part(split_part(url, '?', 1), '#', 1)"
_EXT = f"case when contains({_PATH}, '.') then lower(regexp_extract({_PATH}, '([^.]*)$', 1)) end"
_MIME = "lower(trim(split_part(content_type, ';', 1)))"

# One row for each id, the one updated last.
_CORPUS = """
    corpus as (
        select id as doc_id, canonical_document_id, artifact_id, source_url, detected_format, source_mime_type, normalized_text, original_checksum as raw_checksum, normalized_checksum,
            case lower(trim(quality_signals.language.code)) when 'en' then 'English' when 'es' then 'Spanish' when 'fr' then 'French' when 'de' then 'German' when 'pt' then 'Portuguese'
                when 'it' then 'Italian' when 'nl' then 'Dutch' else quality_signals.language.code end as language,
            canonical_quality_signals.text_metrics.character_count as character_count, coalesce(len(warnings), 0)::bigint as warning_count, created_at, updated_at,
            coalesce(length(normalized_text), 0)::bigint as n,
            least(coalesce(canonical_quality_signals.text_metrics.character_count, 0) / 1000, 1.0)::double as score
        from normalized_documents qualify row_number() over (partition by id order by updated_at desc) = 1)
"""

_FORMAT_OK = "(contains(lower(coalesce(detected_format, '')), 'html') or contains(lower(coalesce(source_mime_type, '')), 'html') or contains(lower(coalesce(detected_format, '')), 'plain_text') or contains(lower(coalesce(source_mime_type, '')), 'plain_text') or contains(lower(coalesce(detected_format, '')), 'markdown') or contains(lower(coalesce(source_mime_type, '')), 'markdown'))"
_LANGUAGE_OK = "coalesce(lower(language) in ('english', 'french', 'spanish', 'german', 'dutch', 'en', 'fr', 'es', 'de', 'nl'), false)"

_STAGED = (
    _CORPUS
    + f""",
    staged as (
        select *, case when not {_FORMAT_OK} then 0 when not {_LANGUAGE_OK} then 1 when n < 100 or n > 10000 then 2 when score < 0.5 then 3 end as stage,
            case when not {_FORMAT_OK} then 'format:' || coalesce(nullif(detected_format, ''), source_mime_type, 'unknown')
                when not {_LANGUAGE_OK} then 'language:' || coalesce(language, 'unknown')
                when n < 100 then 'below_minimum:100' when n > 10000 then 'above_maximum:10000'
                when score < 0.5 then 'below_threshold:' || printf('%.2f', floor(score * 100 + 0.5) / 100) end as reason
        from corpus)
"""
)

# Decisions of the flagship build: rules, exact copies by raw and then by normalized checksum, the cap.
_DECIDED = (
    _CORPUS
    + f""",
    judged as (
        select *, list_filter([case when not {_FORMAT_OK} then 'unsupported_format' end, case when not {_LANGUAGE_OK} then 'wrong_language' end, case when n < 100 then 'content_too_short' end,
            case when n > 10000 then 'content_too_long' end, case when score < 0.5 then 'quality_below_threshold' end], lambda x: x is not null) as reasons
        from corpus),
    passed as (select * from judged where len(reasons) = 0),
    raw as (select raw_checksum, min(doc_id) as g from passed where raw_checksum is not null group by 1 having count(*) > 1),
    norm as (select normalized_checksum, min(doc_id) as g from passed where normalized_checksum is not null and normalized_text is not null group by 1 having count(*) > 1),
    grouped as (
        select p.*, case when raw.g is not null then 'raw_exact' when norm.g is not null then 'normalized_exact' end as tier,
            case when raw.g is not null then 'raw_exact:' || raw.g when norm.g is not null then 'normalized_exact:' || norm.g end as grp
        from passed p left join raw on raw.raw_checksum = p.raw_checksum left join norm on norm.normalized_checksum = p.normalized_checksum and p.normalized_text is not null),
    best as (
        select *, grp is null or row_number() over (partition by grp order by (normalized_text is null), score desc, warning_count, doc_id) = 1 as ok from grouped),
    ranked as (select *, case when ok then row_number() over (partition by ok order by score desc, doc_id) end as rk from best),
    decided as (
        select doc_id, 'rejected' as decision, array_to_string(reasons, ',') as reasons, language, n, score, normalized_text from judged where len(reasons) > 0
        union all
        select doc_id, case when ok and rk <= 400 then 'accepted' else 'rejected' end,
            case when not ok then case tier when 'raw_exact' then 'exact_duplicate' else 'normalized_duplicate' end when rk > 400 then 'record_limit_reached'
                when grp is null then 'dedup_unique' else 'dedup_representative' end, language, n, score, normalized_text
        from ranked)
"""
)

_LINES = f"""
    parts as (select doc_id, coalesce(text, '') as t, regexp_split_to_array(coalesce(text, ''), '{_LINE_END}') as p from documents),
    lined as (select doc_id, t, case when p[len(p)] = '' then p[1:len(p) - 1] else p end as l from parts)
"""




SQL = {
    "url_normalize": rf"""
        select distinct id, url,
            case when regexp_matches(trim(url), '^(?i:https?)://') then trim(url)
                when regexp_matches(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*:') then null when trim(url) <> '' then 'http://' || trim(url) end as full_url,
            {_HOST} as host, case when length({_EXT}) between 1 and 10 then {_EXT} end as file_extension
        from resources
    """,
    "domain_policy": rf"""
        with a as (select artifact_id, {_HOST} as host from artifacts)
        select artifact_id, coalesce(host in ('harbor-ledger.example', 'ga-tan-vel.example'), false) as allowed,
            coalesce(regexp_matches(host, '^(10|127|0)(\.\d+){{3}}$|^192\.168\.\d+\.\d+$|^169\.254\.\d+\.\d+$|^172\.(1[6-9]|2\d|3[01])\.\d+\.\d+$'), false) as private
        from a
    """,
    "content_type_policy": f"""
        with a as (select artifact_id, {_MIME} as m from artifacts)
        select artifact_id, coalesce(starts_with(m, 'text/') or m = 'application/json', false) as allowed,
            case when m is null or m = '' then 'unknown' when m = 'text/html' then 'html' when m in ('application/json', 'text/json') then 'json' when m in ('application/xml', 'text/xml') then 'xml'
                when starts_with(m, 'text/') then 'text' when m = 'application/pdf' then 'pdf' else 'binary' end as resource_class
        from a
    """,
    "materialized_artifacts": """
        select artifact_id, coalesce(octet_length(raw_data), 0)::bigint as payload_bytes, coalesce(sha256(raw_data) = lower(checksum_sha256), false) as checksum_verified,
            case when raw_data is null then 'missing' when sha256(raw_data) = lower(checksum_sha256) then 'completed' else 'failed' end as status
        from artifacts
    """,
    "artifacts_with_provenance": """
        with r as (select url, id, domain from resources where url is not null qualify row_number() over (partition by url order by last_seen_at desc) = 1)
        select a.artifact_id, a.url, r.id as resource_id, r.domain, a.size_bytes, a.checksum_sha256 from artifacts a join r on r.url = a.url
    """,
    "point_lookup": "select distinct id, url from resources where resource_type = 'web'",
    "any_reference_lookup": """
        with w as (select unnest([normalized_document_id, canonical_document_id, artifact_id]) as id from duplicate_memberships),
        k as (select distinct document_id, normalized_document_id, canonical_document_id, artifact_id from dedup_documents)
        select document_id from k where normalized_document_id in (select id from w where id is not null) or canonical_document_id in (select id from w where id is not null)
            or artifact_id in (select id from w where id is not null)
    """,
    "latest_documents": """
        select document_id, warning_count from dedup_documents qualify row_number() over (partition by document_id order by updated_at desc) = 1
    """,
    "upserted_resources": """
        select url, id, case when domain like '%.test' then upper(domain) else domain end as domain from resources
        qualify row_number() over (partition by url order by last_seen_at desc) = 1
    """,
    "ensured_resources": """
        with known as (select distinct id, url from resources),
        new as (select distinct url from (select url from artifacts union all select url from documents) where url is not null and url not in (select url from known where url is not null))
        select id, url from known union all select 'rs-' || sha256(url)[1:16], url from new
    """,
    "corpus_view": f"with {_CORPUS} select doc_id, language, character_count, detected_format, length(normalized_text)::bigint as text_length, warning_count from corpus",
    "artifact_availability": """
        select artifact_id, case when raw_data is null then 'unavailable' when lower(checksum_sha256) <> sha256(raw_data) then 'corrupted' else 'available' end as availability from artifacts
    """,
    "quality_scores": "select doc_id, least(coalesce(length(text), 0) / 1000, 1.0)::double as quality_score from documents",
    "text_metrics": rf"""
        with {_LINES}, f as (
            select doc_id, length(t) as c, len(regexp_extract_all(t, '[^{_BLANK}]+')) as w, len(l) as k, length(regexp_replace(t, '[{_BLANK}]+', '', 'g')) as v,
                coalesce(list_sum(list_transform(l, lambda x: length(x))), 0) as total, coalesce(list_min(list_transform(l, lambda x: length(x))), 0) as lo, coalesce(list_max(list_transform(l, lambda x: length(x))), 0) as hi
            from lined)
        select doc_id, c::bigint as character_count, w::bigint as word_count, k::bigint as line_count, greatest(w, c // 4)::bigint as estimated_token_count,
            case when w > 0 then v / w else 0.0 end::double as avg_word_length, case when k > 0 then total / k else 0.0 end::double as avg_line_length, lo::bigint as min_line_length, hi::bigint as max_line_length
        from f
    """,
    "content_composition": "with d as (select doc_id, coalesce(text, '') as t from documents) select doc_id, "
    + ", ".join(
        f"case when length(t) > 0 then {_ROUND.format(f'''(length(regexp_replace(t, '[^{c}]+', '', 'g')) / length(t))''')} else 0.0 end as {n}_ratio"
        for n, c in (("alphabetic", r"\p{L}"), ("numeric", _DIGIT), ("whitespace", _BLANK), ("punctuation", r"\p{P}"), ("symbol", r"\p{S}"))
    )
    + f", case when length(t) > 0 then {_ROUND.format('(len(list_distinct(regexp_extract_all(t, ' + chr(39) + '(?s).' + chr(39) + '))) / length(t))')} else 0.0 end as unique_char_ratio from d",
    "repetition_signals": rf"""
        with {_LINES},
        words as (select doc_id, regexp_extract_all(t, '[^{_BLANK}]+') as w from lined),
        li as (select doc_id, regexp_replace(unnest(l), '^[{_BLANK}]+|[{_BLANK}]+$', '', 'g') as x from lined),
        lc as (select doc_id, x, count(*) as c from li where x <> '' group by 1, 2),
        ls as (select doc_id, count(*) as k, count(*) filter (c > 1) as r, max(c) as m from lc group by 1),
        pi as (select doc_id, w[i] || ' ' || w[i + 1] as x from (select doc_id, w, unnest(range(1, len(w))) as i from words)),
        pc as (select doc_id, x, count(*) as c from pi group by 1, 2),
        ps as (select doc_id, count(*) as k, count(*) filter (c > 1) as r from pc group by 1),
        f as (
            select d.doc_id, coalesce(ls.k, 0) as dl, coalesce(ls.r, 0) as rl, coalesce(ls.m, 0) as ml, coalesce(ps.k, 0) as dp, coalesce(ps.r, 0) as rp, len(list_distinct(d.w)) as dw, len(d.w) as tw
            from words d left join ls on ls.doc_id = d.doc_id left join ps on ps.doc_id = d.doc_id),
        g as (select *, case when dl > 0 then rl / dl else 0.0 end::double as a, case when dp > 0 then rp / dp else 0.0 end::double as b, case when tw > 0 then dw / tw else 0.0 end::double as c from f)
        select doc_id, dl::bigint as distinct_lines, rl::bigint as repeated_lines, ml::bigint as max_line_repetition, dp::bigint as distinct_phrases, rp::bigint as repeated_phrases,
            dw::bigint as distinct_words, tw::bigint as total_words, a as repeated_line_ratio, b as repeated_phrase_ratio, c as vocabulary_diversity,
            a > 0.5 or b > 0.5 or (tw > 0 and c < 0.3) as suspicious_repetition
        from g
    """,
    "completeness_signals": rf"""
        with d as (select distinct artifact_id, coalesce(canonical_text, '') as t, coalesce(warnings, []) as w from extraction_results)
        select artifact_id, regexp_replace(t, '[{_BLANK}]+', '', 'g') = '' as is_empty, regexp_replace(t, '[{_BLANK}]+', '', 'g') <> '' and length(t) < 50 as is_short,
            len(list_filter(w, lambda x: contains(lower(x), 'truncat'))) > 0 as truncation_suspected,
            len(list_filter(w, lambda x: regexp_matches(lower(x), 'malformed|invalid|corrupt'))) > 0 as malformed_suspected
        from (select * from d)
    """,
    "language_pairs": r"""
        with d as (select LABEL as lang, regexp_replace(lower(text), '[^\p{L}]+', '', 'g') as t from documents where LABEL is not null and text is not null),
        p as (select lang, t[i:i + 1] as pair from (select lang, t, unnest(range(1, length(t))) as i from d))
        select lang, pair, count(*) as n from p group by 1, 2
    """,
    "language_detect": r"""
        with letters as (select doc_id, LABEL as lang, regexp_replace(lower(coalesce(text, '')), '[^\p{L}]+', '', 'g') as t from documents),
        pairs as (select doc_id, lang, t[i:i + 1] as pair from (select doc_id, lang, t, unnest(range(1, length(t))) as i from letters)),
        counts as (select doc_id, pair, count(*) as n from pairs group by 1, 2),
        labelled as (select lang, pair, count(*) as n from pairs where lang in ('en', 'es', 'fr', 'de', 'pt', 'it', 'nl') group by 1, 2),
        total as (select lang, sum(n) as total from labelled group by 1),
        profile as (
            select l.lang, l.pair, (l.n * 1000000 // t.total) / 10000 as w, list_position(['en', 'es', 'fr', 'de', 'pt', 'it', 'nl'], l.lang) as rk
            from labelled l join total t on t.lang = l.lang qualify row_number() over (partition by l.lang order by l.n desc, l.pair) <= 40),
        norm as (select lang, sqrt(sum(w * w)) as m from profile group by 1),
        own as (select doc_id, sqrt(sum(n * n)) as m from counts group by 1),
        score as (
            select c.doc_id, p.lang, p.rk, sum(c.n * p.w) / (any_value(o.m) * any_value(k.m)) as s
            from counts c join profile p on p.pair = c.pair join norm k on k.lang = p.lang join own o on o.doc_id = c.doc_id group by 1, 2, 3),
        best as (select doc_id, lang, s from score qualify row_number() over (partition by doc_id order by s desc, rk) = 1)
        select d.doc_id, case when length(d.t) < 2 then 'unknown' else case coalesce(b.lang, 'en') when 'en' then 'English' when 'es' then 'Spanish' when 'fr' then 'French' when 'de' then 'German'
                when 'pt' then 'Portuguese' when 'it' then 'Italian' else 'Dutch' end end as language,
            case when length(d.t) < 2 then 'unknown' else coalesce(b.lang, 'en') end as code,
            case when length(d.t) < 2 then 'unknown' when b.s >= 0.5 then 'high' when b.s >= 0.15 then 'medium' else 'low' end as confidence
        from letters d left join best b on b.doc_id = d.doc_id
    """,
    "normalized_documents": rf"""
        with a as (select doc_id, text as t0, nfc_normalize(text) as t1 from documents),
        b as (select *, regexp_replace(t1, '\r\n?', chr(10), 'g') as t2 from a),
        c as (select *, array_to_string(list_transform(string_split(t2, chr(10)), lambda x: regexp_replace(x, '[{_BLANK}]+$', '')), chr(10)) as t3 from b),
        e as (select *, regexp_replace(t3, '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{{9f}}\p{{Cf}}\p{{Co}}]', '', 'g') as t4 from c),
        f as (select *, case when t4 <> '' and not ends_with(t4, chr(10)) then t4 || chr(10) else t4 end as t5 from e),
        g as (select *, list_filter([case when t0 <> t1 then 'unicode_normalization' end, case when t1 <> t2 then 'line_ending_normalization' end, case when t2 <> t3 then 'trailing_whitespace_removal' end,
            case when t3 <> t4 then 'control_character_removal' end, case when t4 <> t5 then 'trailing_newline' end], lambda x: x is not null) as ops from f)
        select doc_id, t5 as normalized_text, sha256(t5) as normalized_checksum, len(ops) > 0 as content_changed, array_to_string(ops, ',') as operations from g
    """,
    "raw_exact_groups": """
        select min(doc_id) as group_id, count(*) as size, sha256(text) as checksum from documents where text is not null group by 3 having count(*) > 1
    """,
    "trigram_counts": rf"""
        with d as (select doc_id, text, lower(trim(regexp_replace(text, '[{_BLANK}]+', ' ', 'g'))) as t from documents where length(text) >= 3),
        g as (select doc_id, t[i:i + 2] as g from (select doc_id, t, unnest(range(1, length(t) - 1)) as i from d where length(t) >= 3))
        select doc_id, count(distinct g)::bigint as trigrams from g group by 1
    """,
    "keep_first": f"""
        with {_CORPUS}, r as (select *, row_number() over (partition by normalized_checksum order by created_at nulls first, doc_id) as rk from corpus)
        select doc_id, normalized_checksum from r where normalized_checksum is null or rk = 1
    """,
    "feasibility_stages": f"""
        with {_STAGED}, c as (select count(*) as n, count(*) filter (stage = 0) as r0, count(*) filter (stage = 1) as r1, count(*) filter (stage = 2) as r2, count(*) filter (stage = 3) as r3 from staged)
        select 'format' as stage, n as input_count, n - r0 as output_count, r0 as rejected_count from c union all select 'language', n - r0, n - r0 - r1, r1 from c
        union all select 'length', n - r0 - r1, n - r0 - r1 - r2, r2 from c union all select 'quality', n - r0 - r1 - r2, n - r0 - r1 - r2 - r3, r3 from c
    """,
    "feasibility_rejections": f"""
        with {_STAGED} select ['format', 'language', 'length', 'quality'][stage + 1] as stage, reason, count(*) as rejected from staged where stage is not null group by 1, 2
    """,
    "feasibility_dedup_impact": f"""
        with {_STAGED}, g as (select normalized_checksum as c, count(*) as n from staged where stage is null group by 1)
        select coalesce(sum(n), 0)::bigint as records, count(*) filter (c is not null and n > 1) as duplicate_groups, coalesce(sum(n - 1) filter (c is not null and n > 1), 0)::bigint as duplicates from g
    """,
    "feasibility_languages": f"with {_STAGED} select coalesce(language, 'unknown') as language, count(*) as n from staged where stage is null group by 1",
    "feasibility_quality": f"""
        with {_STAGED} select count(*) as records, coalesce(sum(n), 0)::bigint as total_characters, coalesce(sum(n) // count(*), 0)::bigint as average_characters,
            coalesce(sum(octet_length(encode(coalesce(normalized_text, '')))), 0)::bigint as estimated_bytes
        from staged where stage is null
    """,
    "build_decisions": f"with {_DECIDED} select doc_id, decision, reasons from decided",
    "rejection_reason_counts": f"""
        with {_DECIDED}, r as (select unnest(string_split(reasons, ',')) as reason from decided union all select 'accepted' from decided where decision = 'accepted')
        select reason, count(*) as n from r group by 1
    """,
    "build_statistics": f"""
        with {_DECIDED} select count(*) as considered, count(*) filter (decision = 'accepted') as accepted, count(*) filter (decision = 'rejected') as rejected,
            {_ROUND.format("(count(*) filter (decision = 'accepted') / count(*))")} as acceptance_rate from decided
    """,
    "top_k_selection": f"with {_CORPUS} select doc_id, score as quality_score from corpus order by score desc, doc_id limit 100",
    "build_records": f"with {_DECIDED} select doc_id as normalized_record_id, language, score as quality_score, n as text_length from decided where decision = 'accepted'",
    "manifest_checksum": f"""
        with {_DECIDED}, k as (select list(doc_id order by doc_id) as ids from decided where decision = 'accepted')
        select len(ids)::bigint as canonical_record_count, sha256('["' || array_to_string(ids, '", "') || '"]') as sha256 from k
    """,
    "export_statistics": f"""
        with {_DECIDED} select count(*) as records, sum(n)::bigint as total_characters, floor(sum(n) / count(*) * 100 + 0.5) / 100 as average_characters,
            {_ROUND.format("(sum(round(score * 1000000)::bigint) / count(*) / 1000000)")} as average_quality from decided where decision = 'accepted'
    """,
    "acceptance_filter": rf"""
        with {_CORPUS}, w as (select doc_id, language, coalesce(normalized_text, '') as t, len(regexp_extract_all(coalesce(normalized_text, ''), '[^{_BLANK}]+')) as w from corpus)
        select doc_id, concat_ws('; ', case when w < 50 then 'too_few_words' end, case when w > 1500 then 'too_many_words' end, case when not coalesce(language = 'English', false) then 'wrong_language' end,
            case when t = '' then 'empty_text' end) as reasons from w
    """,
    "acceptance_statistics": rf"""
        with {_CORPUS}, w as (select nullif(split_part(source_url, '/', 3), '') as source_domain, len(regexp_extract_all(coalesce(normalized_text, ''), '[^{_BLANK}]+'))::bigint as w from corpus)
        select source_domain, count(*) as documents, min(w) as min_words, max(w) as max_words, sum(w)::bigint as total_words from w group by 1
    """,
}

# Artifacts as text: UTF-8 where valid, else one character a byte.  No payload of the tables is well-formed XML.
_ARTIFACTS = r"""
    b as (select *, coalesce(raw_data, ''::blob) as r, hex(coalesce(raw_data, ''::blob)) as h from artifacts),
    u as (
        select *, try(decode(r)) as valid, array_to_string(list_transform(range(0, length(h) // 2), lambda i: chr(('0x' || h[2 * i + 1:2 * i + 2])::int)), '') as single from b),
    a as (
        select artifact_id, url, content_type, size_bytes, octet_length(r) as n, valid is not null as utf8, starts_with(h, 'EFBBBF') as marked, coalesce(valid, single) as t, coalesce(valid, single) as shown, h
        from u)
"""
_HEAD = r"regexp_replace(t, '^[\s\x0b]+', '')"
_FIRST = "string_split(t, chr(10))[1]"
_COMMAS = "length({0}) - length(replace({0}, ',', ''))"
_CSV = f"({_COMMAS.format('t')}) >= 2 and len(string_split(t, chr(10))) >= 2"
_VOTES = (
    _ARTIFACTS
    + rf""",
    v as (
        select *, case {_MIME} when 'text/html' then 'html' when 'application/xhtml+xml' then 'html' when 'text/plain' then 'plain_text' when 'text/markdown' then 'markdown' when 'application/json' then 'json'
                when 'application/xml' then 'xml' when 'text/xml' then 'xml' when 'text/csv' then 'csv' else case when starts_with({_MIME}, 'text/') then 'plain_text' end end as v1,
            case {_EXT} when 'html' then 'html' when 'htm' then 'html' when 'json' then 'json' when 'xml' then 'xml' when 'csv' then 'csv' when 'md' then 'markdown' when 'txt' then 'plain_text' end as v2,
            case when regexp_matches({_HEAD}, '^(<!DOCTYPE|<html|<HTML)') then 'html' when regexp_matches({_HEAD}, '^<[?]?xml') then 'xml'
                when {_CSV} and ({_COMMAS.format(_FIRST)}) = ({_COMMAS.format('string_split(t, chr(10))[2]')}) then 'csv' when starts_with(t, '#') then 'markdown' end as v3,
            case when not utf8 or not regexp_matches(h[1:64], '^(09|0A|0D|[2-6][0-9A-F]|7[0-9A-E])*$') then null
                when starts_with({_HEAD}, '<') and regexp_matches(lower(t), '<html|<body') then 'html'
                when {_CSV} and ({_COMMAS.format(_FIRST)}) >= 1 and len(list_filter(string_split(t, chr(10))[1:5], lambda x: trim(x) <> '' and length(x) - length(replace(x, ',', '')) <> {_COMMAS.format(_FIRST)})) = 0 then 'csv'
                when regexp_matches(t, '(?m)^#{{1,6}}\s') or regexp_matches(t, '(?m)^\s*[-*+]\s') then 'markdown' when regexp_matches(t, '<[a-zA-Z][^>]*>') then 'html' else 'plain_text' end as v4
        from a),
    w as (select *, list_filter([v1, v2, v3, v4], lambda x: x is not null) as votes, {_MIME} in ('text/html', 'application/xhtml+xml', 'text/plain', 'text/markdown', 'text/csv') and v1 is not null or v3 is not null as high from v),
    x as (select *, list_transform(range(1, len(votes) + 1), lambda i: len(list_filter(votes, lambda y: y = votes[i]))) as tally from w),
    c as (
        select *, list_max(tally) as best, votes[list_position(tally, list_max(tally))] as detected_format,
            case when len(votes) = 0 then 'unknown' when list_max(tally) >= 2 and high then 'high' when list_max(tally) >= 2 or high then 'medium' else 'low' end as format_confidence,
            case when n = 0 then null when marked then 'utf-8-sig' when utf8 then 'utf-8' else 'latin-1' end as encoding
        from x)
"""
)
_STRUCTURE = r"""case when n = 0 then null
    when detected_format = 'html' then case when regexp_matches(t, '(?i)<(?:article|main)\b') then 'article-like' when regexp_matches(t, '(?i)<(?:nav|menu)\b') then 'navigation-heavy'
        when regexp_matches(t, '(?i)<table\b') then 'structured-page' else 'document' end
    when detected_format = 'csv' then case when contains(trim(t, E' \n\r\t'), chr(10)) then 'tabular' else 'unknown-structured' end
    when detected_format = 'markdown' then case when regexp_matches(t, '(?m)^#{1,6}\s') then 'headings-paragraphs' when regexp_matches(t, '(?m)^\s*[-*+]\s') then 'list-structured' else 'prose' end
    when detected_format = 'plain_text' then case when length(t) - length(replace(t, chr(10), '')) > 1 then 'multi-line' else 'single-line' end end"""
_CHECKED = f"{_VOTES}, k as (select *, {_STRUCTURE} as structural_type, case when detected_format is null then 'unknown' else 'suitable' end as suitability from c)"

SQL["format_detection"] = f"""
    with {_CHECKED} select artifact_id, detected_format, format_confidence, len(votes)::bigint as vote_sources, coalesce(best, 0)::bigint as vote_count, case when length({_EXT}) between 1 and 10 then {_EXT} end as file_extension,
        suitability as extraction_suitability from k
"""
SQL["encoding_detection"] = f"with {_CHECKED} select artifact_id, encoding, case when n = 0 then 'unknown' when encoding = 'latin-1' then 'low' else 'high' end as encoding_confidence from k"
SQL["structure_and_type"] = rf"""
    with {_CHECKED}, h as (select *, list_filter([case when regexp_matches(t, '(?i)<article\b') then 'article' end, case when regexp_matches(t, '(?i)<form\b') then 'form' end,
        case when regexp_matches(t, '(?i)<table\b') then 'data-table' end, case when regexp_matches(t, '(?i)<pre\b|<code\b') then 'code-documentation' end], lambda x: x is not null) as d from k)
    select artifact_id, structural_type, case detected_format when 'html' then case when len(d) = 0 then 'webpage' else array_to_string(d, ',') end when 'csv' then 'tabular-data'
            when 'markdown' then case when regexp_matches(t, '(?m)^#{{1,6}}\s') then 'documentation,text' else 'text' end when 'plain_text' then 'text' else '' end as document_types,
        coalesce(v4 = 'html' and regexp_matches(t, '(?i)<title\b'), false) as title_indicators, coalesce(v4 = 'html' and regexp_matches(t, '(?i)charset\s*='), false) as encoding_declarations
    from h
"""
SQL["content_statistics"] = rf"""
    with {_CHECKED}, s as (select *, case when marked then substr(shown, 2) else shown end as z from k)
    select artifact_id, n::bigint as byte_count, case when n > 0 and detected_format is not null then length(z) else 0 end::bigint as character_count,
        case when n > 0 and detected_format is not null then length(z) - length(replace(z, chr(10), '')) + case when z <> '' and not ends_with(z, chr(10)) then 1 else 0 end else 0 end::bigint as line_count,
        case when n > 0 and detected_format is not null then len(regexp_extract_all(z, '[^{_BLANK}]+')) else 0 end::bigint as word_count,
        case when n > 0 and detected_format is not null then length(regexp_replace(z, '[\x00-\x7f]+', '', 'g')) else 0 end::bigint as non_ascii_count,
        case when n = 0 or detected_format is null then 'none' when n > 65536 then 'preview' else 'full' end as analysis_scope
    from s
"""
SQL["inventory_distributions"] = f"""
    with {_CHECKED}, f as (
        select 'format' as section, detected_format as key from k union all select 'mime_type', content_type from k union all select 'domain', coalesce({_HOST}, 'unknown') from k
        union all select 'size', case when coalesce(size_bytes, 0) < 1024 then '<1KB' when size_bytes < 10240 then '1KB-10KB' when size_bytes < 102400 then '10KB-100KB' when size_bytes < 1048576 then '100KB-1MB' else '>1MB' end from k
        union all select 'encoding', encoding from k union all select 'structural_type', structural_type from k union all select 'extraction_suitability', suitability from k)
    select section, key, count(*) as value from f where key is not null group by 1, 2
"""
SQL["format_conflicts"] = f"""
    with {_CHECKED}, e as (select *, {_MIME} as declared_mime, case {_MIME} when 'text/html' then 'html' when 'application/xhtml+xml' then 'html' when 'text/plain' then 'plain_text' when 'text/markdown' then 'markdown'
        when 'application/json' then 'json' when 'application/xml' then 'xml' when 'text/xml' then 'xml' when 'text/csv' then 'csv' when 'application/csv' then 'csv' end as promised from k)
    select artifact_id, declared_mime, detected_format, format_confidence as confidence from e where promised <> detected_format
"""
SQL["inventory_messages"] = f"""
    with {_CHECKED}, m as (select 'warning' as kind, 'Unable to determine format' as message from k where detected_format is null
        union all select 'warning', 'Unable to determine encoding' from k where encoding is null union all select 'error', 'unknown_format' from k where detected_format is null)
    select kind, message, count(*) as value from m group by 1, 2
"""
SQL["inventory_totals"] = f"""
    with s as ({SQL["content_statistics"]}) select count(*) as total_artifacts, count(s.artifact_id) as characterized_count, coalesce(sum(size_bytes), 0)::bigint as total_bytes,
        coalesce(sum(character_count), 0)::bigint as total_characters, coalesce(sum(size_bytes), 0) / greatest(count(*), 1) as average_bytes, count(s.artifact_id) / greatest(count(*), 1) as coverage
    from artifacts a left join s on s.artifact_id = a.artifact_id
"""

_LABEL = r"""coalesce(case lower(trim(lang)) when 'english' then 'en' when 'spanish' then 'es' when 'french' then 'fr' when 'german' then 'de' when 'portuguese' then 'pt' when 'italian' then 'it' when 'dutch' then 'nl' end,
    nullif(regexp_extract(lower(trim(lang)), '^(en|es|fr|de|pt|it|nl)([-_].*)?$', 1), ''))"""
SQL |= {n: SQL[n].replace("LABEL", _LABEL) for n in ("language_pairs", "language_detect")}
SQL["language_distribution"] = f"select language, count(*) as n from ({SQL['language_detect']}) group by 1"
SQL["normalized_exact_groups"] = f"select min(doc_id) as group_id, count(*) as size, normalized_checksum as checksum from ({SQL['normalized_documents']}) where normalized_text is not null group by 3 having count(*) > 1"
SQL["duplicate_memberships"] = f"""
    with n as ({SQL["normalized_documents"]}), d as (select n.doc_id, sha256(s.text) as r, n.normalized_checksum as c from n join documents s on s.doc_id = n.doc_id where s.text is not null),
    rg as (select r, min(doc_id) as g from d group by 1 having count(*) > 1), cg as (select c, min(doc_id) as g from d group by 1 having count(*) > 1)
    select 'raw_exact' as tier, g as group_id, doc_id from d join rg on rg.r = d.r union all select 'normalized_exact', g, doc_id from d join cg on cg.c = d.c
"""
SQL["representatives"] = f"""
    with n as ({SQL["normalized_documents"]}), d as (select n.doc_id, s.text, n.normalized_checksum as c from n join documents s on s.doc_id = n.doc_id where s.text is not null),
    g as (select c, min(doc_id) as group_id from d group by 1 having count(*) > 1),
    m as (select g.group_id, d.doc_id, least(length(d.text) / 1000, 1.0)::double as s from d join g on g.c = d.c),
    b as (select * from m qualify row_number() over (partition by group_id order by s desc, doc_id) = 1)
    select group_id, doc_id, 'has_normalized_text_' || case when s > 0 then 'quality_score_' || printf('%.2f', floor(s * 100 + 0.5) / 100) || '_' else '' end || 'no_warnings_stable_id' as selection_basis from b
"""


def _similar(threshold: float) -> str:
    return rf"""
        with d as (select doc_id, lower(trim(regexp_replace(text, '[{_BLANK}]+', ' ', 'g'))) as t from documents where length(text) >= 3),
        g as (select distinct doc_id, t[i:i + 2] as g from (select doc_id, t, unnest(range(1, length(t) - 1)) as i from d where length(t) >= 3)),
        s as (select doc_id, list_sort(list(g)) as gs, count(*) as n from g group by 1),
        c as (select min(doc_id) as id, any_value(n) as n, gs from s group by gs),
        p as (select id, n, unnest(gs) as g from c),
        x as (
            select a.id as a, b.id as b, any_value(a.n) as na, any_value(b.n) as nb, count(*) as k from p a join p b on a.g = b.g and a.id < b.id and least(a.n, b.n) >= {threshold} * greatest(a.n, b.n) - 1e-9 group by 1, 2)
        select a, b, floor(k / (na + nb - k) * 10000 + 0.5) / 10000 as similarity from x where k / (na + nb - k) >= {threshold}
    """


def _similar_groups(threshold: float) -> str:
    return rf"""
        with recursive d as (select doc_id, lower(trim(regexp_replace(text, '[{_BLANK}]+', ' ', 'g'))) as t from documents where length(text) >= 3),
        g as (select distinct doc_id, t[i:i + 2] as g from (select doc_id, t, unnest(range(1, length(t) - 1)) as i from d where length(t) >= 3)),
        s as (select doc_id, list_sort(list(g)) as gs from g group by 1),
        pairs as (select a, b from ({_similar(threshold)})),
        same as (select gs, min(doc_id) as m from s group by 1),
        e as (select s.doc_id as u, same.m as v from s join same on same.gs = s.gs where s.doc_id <> same.m union select a, b from pairs),
        edges as (select u, v from e union select v, u from e),
        walk(u, v) as (select u, u from edges union select w.u, x.v from walk w join edges x on x.u = w.v)
        select u as doc_id, min(v) as group_id from walk group by 1
    """


SQL |= {
    "near_dup_pairs": _similar(0.85),
    "near_dup_pairs_060": _similar(0.6),
    "near_dup_groups": _similar_groups(0.85),
    "near_dup_groups_060": _similar_groups(0.6),
    "near_group_statistics": f"""
        with recursive p as (select a, b, similarity from ({_similar(0.6)})), edges as (select a as u, b as v from p union select b, a from p),
        walk(u, v) as (select u, u from edges union select w.u, x.v from walk w join edges x on x.u = w.v), l as (select u, min(v) as g from walk group by 1),
        n as (select g, count(*) as size from l group by 1)
        select l.g as group_id, any_value(n.size) as size, count(*) as pair_count, max(similarity) as max_similarity, min(similarity) as min_similarity,
            floor(sum(floor(similarity * 1000000 + 0.5)::bigint) / count(*) / 1000000 * 10000 + 0.5) / 10000 as average_similarity
        from p join l on l.u = p.a join n on n.g = l.g group by 1
    """,
}

SQL["candidate_scan"] = """
    with e as (select distinct artifact_id, extraction_status, detected_format, canonical_checksum from extraction_results),
    r as (select url, arg_max(id, last_seen_at) as resource_id from resources where url is not null group by url)
    select e.artifact_id, e.extraction_status, a.url as artifact_url, a.content_type, a.size_bytes, r.resource_id
    from e left join artifacts a on a.artifact_id = e.artifact_id left join r on r.url = a.url
"""
SQL["artifact_states"] = f"""
    with {_CHECKED} select x.artifact_id, case when x.raw_data is null then 'unavailable' when lower(x.checksum_sha256) <> sha256(x.raw_data) then 'corrupted' when k.detected_format is null then 'unsupported' else 'available' end as availability
    from artifacts x join k on k.artifact_id = x.artifact_id
"""
SQL["raw_reference_groups"] = """
    with v as (select document_id, raw_checksum from dedup_documents qualify row_number() over (partition by document_id order by updated_at desc, raw_checksum desc nulls last) = 1)
    select min(document_id) as group_id, count(*) as size, raw_checksum as checksum from v where raw_checksum is not null group by 3 having count(*) > 1
"""
_JSON = "list_transform(json_keys(structured_data), lambda k: json_extract(structured_data, '$.\"' || k || '\"'))"
SQL["structured_signals"] = f"""
    with r as (select distinct artifact_id, structured_data, case when json_valid(structured_data) then json_type(structured_data) end as kind from extraction_results),
    v as (select *, case when kind = 'OBJECT' then {_JSON} end as vs, case when kind = 'ARRAY' then json_array_length(structured_data) end as len_ from r),
    n as (select *, len(vs) as k, len(list_filter(vs, lambda x: json_type(x) = 'NULL')) as nulls_, len(list_filter(vs, lambda x: x::varchar = '""')) as empty_ from v)
    select artifact_id, coalesce(k, len_)::bigint as items, nulls_::bigint as nulls, empty_::bigint as empty, case when k > 0 then floor(nulls_ / k * 10000 + 0.5) / 10000 when k = 0 then 0.0 end as null_ratio,
        case when k > 0 then floor(empty_ / k * 10000 + 0.5) / 10000 when k = 0 then 0.0 end as empty_ratio from n
"""
_BARE = "(trim(coalesce({0}, ''), E' \\t\\n\\r\\u00a0') = '')::bigint"
SQL["csv_signals"] = f"""
    with r as (select distinct id, {" + ".join(_BARE.format(c) for c in ("domain", "resource_type", "discovered_from"))} as e from resources)
    select distinct id, 3::bigint as columns, 1::bigint as rows, 3::bigint as items, e as empty, floor(e / 3 * 10000 + 0.5) / 10000 as empty_ratio from r
"""
SQL["xml_signals"] = f"""
    with r as (select distinct id, 1 + (domain is not null)::bigint + (resource_type is not null)::bigint as n, 1 + (domain is not null and {_BARE.format("domain")} = 1)::bigint + (resource_type is not null and {_BARE.format("resource_type")} = 1)::bigint as e from resources)
    select distinct id, 'resource' as root, true as has_attributes, n as items, e as empty, floor(e / n * 10000 + 0.5) / 10000 as empty_ratio from r
"""
SQL["dedup_result"] = f"""
    with m as ({SQL["duplicate_memberships"]}), n as (select count(*) as n, count(*) filter (coalesce(text, '') = '') as s from documents)
    select n as total_documents, s as documents_skipped, case when s > 0 then s || ' documents skipped (no normalized text)' end as warning,
        (select count(distinct group_id) from m where tier = 'raw_exact') as raw_exact_groups, (select count(distinct group_id) from m where tier = 'normalized_exact') as normalized_exact_groups, 0::bigint as near_duplicate_groups,
        (select count(*) from m where tier = 'raw_exact') as raw_exact_members, (select count(*) from m where tier = 'normalized_exact') as normalized_exact_members, 0::bigint as near_duplicate_members
    from n
"""
SQL["tiered_memberships"] = f"""
    with recursive m as ({SQL["duplicate_memberships"]}), rest as (select * from documents where doc_id not in (select doc_id from m)), near as ({_similar_groups(0.85).replace("from documents where", "from rest where").replace("with recursive d as", "with recursive d as")})
    select tier, group_id, doc_id from m union all select 'near_duplicate', group_id, doc_id from near
"""
SQL["decision_records"] = f"""
    with {_DECIDED} select d.doc_id as record_id, d.decision, d.reasons, d.n as character_count, d.language, d.score as quality_score, c.detected_format, c.normalized_checksum, c.extraction_status, c.size_bytes,
        'html,plain_text,markdown' as allowed_formats, 'English,French,Spanish,German,Dutch' as allowed_languages, 100::bigint as minimum_characters, 10000::bigint as maximum_characters, 0.5::double as minimum_score,
        'normalized' as deduplication_mode, 0.85::double as similarity_threshold, 400::bigint as maximum_records, 10::bigint as minimum_records
    from decided d join (select * from normalized_documents qualify row_number() over (partition by id order by updated_at desc) = 1) c on c.id = d.doc_id
"""
SQL["stored_build_decisions"] = """
    with v as (select * from dedup_documents qualify row_number() over (partition by document_id order by updated_at desc) = 1),
    m as (select distinct group_id, coalesce(normalized_document_id, canonical_document_id, artifact_id) as member, comparison_method, created_at from duplicate_memberships where group_id is not null),
    f as (select group_id, min(member) as first from m group by 1),
    x as (select m.*, f.first, m.member = f.first as rep from m join f on f.group_id = m.group_id where member is not null),
    p as (select * from x qualify row_number() over (partition by member order by rep, created_at desc nulls last, group_id desc) = 1),
    d as (select v.document_id, length(coalesce(v.normalized_text, '')) < 20 as short, p.* from v left join p on p.member = v.document_id)
    select document_id as doc_id, case when short or coalesce(not rep, false) then 'rejected' else 'accepted' end as decision,
        case when short then 'content_too_short' when not rep then case comparison_method when 'raw_exact' then 'exact_duplicate' when 'normalized_exact' then 'normalized_duplicate' else 'near_duplicate' end
            when rep then 'dedup_representative' else 'dedup_unique' end as reasons, first as representative_id from d
"""
_RECORDS = _DECIDED + ", records as (select d.*, c.canonical_document_id, c.artifact_id, c.source_url from decided d join corpus c on c.doc_id = d.doc_id where d.decision = 'accepted')"
_GAPS = lambda names: " or ".join(f"coalesce({n}, '') = ''" for n in names)
_FAULTS = f"""{_RECORDS}, faults as (
    select count(*) as n, count(*) filter ({_GAPS(("doc_id", "canonical_document_id", "artifact_id", "source_url", "normalized_text", "language", "reasons"))}) as schema_,
        count(*) filter ({_GAPS(("doc_id", "canonical_document_id", "artifact_id"))}) as lineage, count(*) filter ({_GAPS(("source_url", "artifact_id", "canonical_document_id"))}) as provenance,
        count(*) filter (language is not null and not {_LANGUAGE_OK}) as language_, count(*) filter (score < 0.5) as quality, count(*) filter (n < 100 or n > 10000) as size_, count(*) - count(distinct doc_id) as copies
    from records)"""
SQL["validation_checks"] = f"""
    with {_FAULTS}, c as (
        select unnest([('schema_validity', 'error', schema_), ('required_fields', 'error', lineage), ('record_counts', 'error', 0), ('duplicate_leakage', 'error', copies), ('language_compliance', 'error', language_),
            ('quality_compliance', 'error', quality), ('content_length', 'error', size_), ('provenance_completeness', 'warning', provenance), ('specification_compliance', 'error', 0), ('rejection_accounting', 'warning', 0)]) as r from faults)
    select r[1] as "check", r[2] as severity, r[3] = 0 as passed, r[3]::bigint as failures from c
"""
SQL["validation_status"] = f"""
    with c as ({SQL["validation_checks"]}), n as (select count(*) filter (severity = 'error' and not passed) as e, count(*) filter (severity = 'warning' and not passed) as w, count(*) filter (severity = 'info' and not passed) as i from c)
    select case when e > 0 then 'fail' when w > 0 then 'warn' else 'pass' end as status, case when e > 0 then 'invalid' when w > 0 then 'warnings' else 'valid' end as overall_status, e as error_count, w as warning_count, i as info_count from n
"""
_STRICT = {
    "schema_validity": _GAPS(("doc_id", "canonical_document_id", "artifact_id", "source_url", "normalized_text", "language", "reasons")), "required_fields": _GAPS(("doc_id", "canonical_document_id", "artifact_id")),
    "language_compliance": "lower(language) not in ('english', 'en')", "quality_compliance": "score < 0.9", "content_length": "n < 400 or n > 900", "provenance_completeness": _GAPS(("source_url", "artifact_id", "canonical_document_id")),
}
SQL["validation_details"] = f"with {_RECORDS} " + " union all ".join(
    f"""(select '{name}' as "check", doc_id as record_id from records where {bad} order by doc_id limit 20)""" for name, bad in _STRICT.items()
)
SQL["manifest_tree_checksum"] = f"""
    with {_DECIDED}, h as (select sha256(doc_id) as h from decided where decision = 'accepted'),
    r as (select ('0x' || h[1:3])::int as run, count(*) as n, {" || ',' || ".join(f"sum(('0x' || h[{1 + 8 * i}:{8 + 8 * i}])::bigint)::varchar" for i in range(8))} as sums from h group by 1)
    select sum(n)::bigint as canonical_record_count, sha256(string_agg(run || ':' || n || ':' || sums, chr(10) order by run)) as sha256 from r
"""

# The same conflicts if all artifacts were declared as JSON.
SQL["misdeclared_formats"] = f"""
    with {_CHECKED} select artifact_id, 'application/json' as declared_mime, detected_format, format_confidence as confidence from k where detected_format <> 'json'
"""
_LINE = {
    "record_id": "'build-' || d.doc_id", "source_record_id": "d.doc_id", "normalized_record_id": "d.doc_id", "canonical_record_id": "r.canonical_document_id", "raw_artifact_id": "r.artifact_id", "source_url": "r.source_url",
    "language": "d.language", "quality_score": "d.score", "selection_reason": "d.reasons", "dedup_group_id": "r.grp",
}
SQL["exported_rows"] = f"""
    with {_DECIDED} select '{{' || {" || ',' || ".join(f"'\"{k}\":' || coalesce(to_json({v})::varchar, 'null')" for k, v in _LINE.items())} || '}}' as value
    from decided d join ranked r on r.doc_id = d.doc_id where d.decision = 'accepted'
"""
