"""SQL texts of queries that SQL can express.

The other queries learn from data, draw by hash, tokenize or hash in ways that SQL does
not have; tests compare them with brute force.
"""

from __future__ import annotations

from rentlake.llm import secrets

_SPACE = r"\x20\x09-\x0D"

# The base kinds are spelled out here on their own; the weak parts are what the module says they are.
_SECRETS = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": "AKIA[A-Z0-9]+",
    "hex": "[0-9a-f]+",
    "identifier": secrets.IDENTIFIER,
    "secret": secrets.SECRET,
    "endpoint": secrets.ENDPOINT,
}
_COUNTS = {
    "assign": "length(regexp_extract(m, '{}', 2)) >= 8",
    "access": "length(m) >= 16",
    "hex": "length(m) >= 32",
    "secret": "regexp_matches(m, '[0-9]') and regexp_matches(m, '[A-Z]') and regexp_matches(m, '[a-z]')",
}


def _either_case(pattern: str) -> str:
    """A pattern whose part (?i:...) is spelled out for plain letters, in SQL quotes."""
    if "(?i:" in pattern:
        begin = pattern.index("(?i:")
        end = pattern.index(")", begin)
        words = pattern[begin + 4 : end]
        spelled = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)
        pattern = f"{pattern[:begin]}(?:{spelled}){pattern[end + 1:]}"
    return pattern.replace("'", "''")


def _hits(kind: str) -> str:
    """The matches of a kind: each follows the pieces and matches before it."""
    pattern = _either_case(_SECRETS[kind])
    good = _COUNTS.get(kind, "true").replace("{}", pattern)
    return f"""select doc_id, '{kind}' as kind, {secrets.KINDS.index(kind)} as rank, last - length(m) as start, last as "end" from (
        select doc_id, m, sum(length(gap) + length(m)) over (partition by doc_id order by k) as last from (
            select doc_id, unnest(regexp_extract_all(text, '{pattern}')) as m,
                unnest(string_split_regex(text, '{pattern}')[:len(regexp_extract_all(text, '{pattern}'))]) as gap,
                unnest(range(len(regexp_extract_all(text, '{pattern}')))) as k
            from (select doc_id, coalesce(text, '') as text from documents))) where {good}"""


_LISTED = """coalesce(string_agg(concat(kind, ':', start, ':', "end"), ',' order by start, rank), '')"""

_SECRET_SCAN = f"""with hits as ({" union all ".join(f"({_hits(kind)})" for kind in _SECRETS)}),
    base as (select * from hits where rank < {len(secrets.BASE)}),
    parts as (select *, case when kind in ('assign', 'hex', 'secret') then 'secret' when kind = 'access' then 'identifier'
            else kind end as role
        from hits h where rank < {len(secrets.BASE)} or not exists (
            select 1 from base b where b.doc_id = h.doc_id and b.start < h."end" and h.start < b."end")),
    spans as (select doc_id, kind, rank, start, "end" from parts p where rank < {len(secrets.BASE)} or exists (
        select 1 from parts o where o.doc_id = p.doc_id and greatest(o.start, p.start) - least(o."end", p."end") <= {secrets.SCOPE}
            and (p.role = 'secret') <> (o.role = 'secret'))),
    base_text as (select doc_id, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
        count(*) filter (kind = 'hex') as n_hex, {_LISTED} as listed from base group by doc_id),
    all_text as (select doc_id, {_LISTED} as listed from spans group by doc_id)
    select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
        sha256(coalesce(b.listed, '')) as base_sha256, coalesce(a.listed, '') as spans
    from documents d left join base_text b on b.doc_id = d.doc_id left join all_text a on a.doc_id = d.doc_id"""

_JACCARD = f"""with recursive words as (select doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^{_SPACE}]+') as w
        from documents),
    sets as (select doc_id, list_distinct(case when len(w) >= 3
            then list_transform(range(1, len(w) - 1), lambda i: concat(w[i], ' ', w[i + 1], ' ', w[i + 2]))
            when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as shingles from words),
    sizes as (select doc_id, len(shingles) as n from sets),
    entries as (select doc_id, unnest(shingles) as shingle from sets),
    pairs as (select a.doc_id as a, b.doc_id as b, count(*) as shared
        from entries a join entries b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by 1, 2),
    links as (select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b
        where 100 * shared >= 90 * (x.n + y.n - shared)),
    reached as (select doc_id, doc_id as other from sizes
        union select reached.doc_id, links.b from reached join links on links.a = reached.other),
    linked as (select a as doc_id, count(*) as n_links from links group by a)
    select doc_id, any_value(n) as n_shingles, min(other) as component_id, coalesce(any_value(n_links), 0) as n_links
    from reached join sizes using (doc_id) left join linked using (doc_id) group by doc_id"""

_LEXICAL = r"""with found as (select doc_id, 1 as one, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents),
    tf as (select doc_id, term, count(*) as tf from found group by all),
    lengths as (select doc_id, sum(tf)::bigint as n from tf group by all),
    corpus as (select count(*) as docs, sum(n)::bigint as terms from lengths),
    df as (select term, count(*) as df from tf group by all),
    damping as (select doc_id, 100 - 90 + ((90 * n * docs) // terms) as m from lengths, corpus),
    asked as (select distinct item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
    weights as (select item_id, term, floor(1000 * ln((2.0::double * docs + 2) / (2.0::double * df + 1)))::bigint as w
        from asked join df using (term), corpus),
    scores as (select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
        from weights join tf using (term) join damping using (doc_id) group by all)
    select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score
    from scores where score > 0 qualify rank <= 10"""

_FILL_MIDDLE = r"""with cut as (select doc_id, coalesce(text, '') as t, sha256('7:' || doc_id) as h,
        regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as units from documents),
    drawn as (select *, len(units) as n, ('0x' || h[1:8])::bigint % (len(units) + 1) as a,
        ('0x' || h[9:16])::bigint % (len(units) + 1) as b,
        case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') then 'plain'
            when ('0x' || h[25:32])::bigint % 100 < 50 then 'spm' else 'psm' end as form from cut),
    parts as (select *, array_to_string(units[1:least(a, b)], '') as prefix,
        array_to_string(units[least(a, b) + 1:greatest(a, b)], '') as middle,
        array_to_string(units[greatest(a, b) + 1:n], '') as suffix from drawn)
    select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars,
        case when form <> 'plain' then length(middle) end as middle_chars,
        sha256(case form when 'psm' then concat('<P>', prefix, '<S>', suffix, '<M>', middle)
            when 'spm' then concat('<S>', suffix, '<P>', prefix, '<M>', middle) else t end) as output_sha256,
        sha256(t) as restored_sha256 from parts"""

ORACLES: dict[str, str] = {
    "op2_secret_scan": _SECRET_SCAN,
    "op3_ngram_jaccard_join": _JACCARD,
    "op12_lexical_search": _LEXICAL,
    "op13_fill_in_middle": _FILL_MIDDLE,
}
