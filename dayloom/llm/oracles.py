"""SQL that computes, by plain definitions, what some of the operators return."""

from __future__ import annotations

from dayloom.llm.mixing import Plan
from dayloom.llm.url_filter import DEPTH, Rule, Settings

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SIMILAR_GROUPS = rf"""
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w
        FROM documents),
    shingle AS MATERIALIZED (
        SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)),
    size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
    shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
               FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
    link AS MATERIALIZED (
        SELECT a, b FROM shared JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
        WHERE 100 * shared.n >= 75 * (x.n + y.n - shared.n)),
    reach(doc_id, other) AS (
        SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, b FROM reach JOIN link ON a = other),
    least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM least LEFT JOIN size USING (doc_id)"""

NEAR_DUPLICATES = """
    WITH RECURSIVE v AS MATERIALIZED (
        SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        WHERE len(embedding) > 0 AND list_sum([CASE WHEN x IS NULL OR NOT isfinite(x) THEN 1 ELSE 0 END FOR x IN embedding]) = 0
          AND list_sum([abs(x) FOR x IN embedding]) > 0),
    link AS MATERIALIZED (
        SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON len(a.e) = len(b.e)
        WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
    reach(vec_id, other) AS (
        SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.vec_id, b FROM reach JOIN link ON a = other),
    least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
    links AS (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a)
    SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
    FROM least LEFT JOIN links USING (vec_id)"""


def _weight(level: str, values: dict[str, float], other: float) -> str:
    cases = " ".join(f"WHEN '{v}' THEN {w}" for v, w in values.items())
    return f"CAST(CASE {level} {cases} ELSE {other} END AS DOUBLE)" if values else f"CAST({other} AS DOUBLE)"


def source_mixing(plan: Plan) -> str:
    """The mixture of documents by domain (from the number of the source), language and source."""
    ctes, above = [], f"(SELECT {plan.share} * sum(tokens) AS budget FROM leaf)"
    weights = {"domain": plan.domains, "lang": plan.languages, "source": plan.sources}
    for depth, level in enumerate(weights):
        keys, parent = list(weights)[: depth + 1], list(weights)[:depth]
        same = " AND ".join(f"n.{k} IS NOT DISTINCT FROM p.{k}" for k in parent) or "true"
        part = f"PARTITION BY {', '.join(parent)}" if parent else ""
        order = f"{part} ORDER BY cap / weight NULLS LAST, {', '.join(f'{k} NULLS FIRST' for k in keys)}"
        before = f"({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        ctes.append(f"""
    node{depth} AS (
        SELECT n.*, p.budget AS total FROM
            (SELECT {', '.join(keys)}, sum(cap) AS cap, {_weight(level, weights[level], plan.other)} AS weight
             FROM leaf GROUP BY {', '.join(keys)}) n JOIN {above} p ON {same}),
    rate{depth} AS (
        SELECT *, row_number() OVER ({order}) AS place,
               greatest(total - coalesce(sum(cap) OVER {before}, 0), 0)
               / (sum(weight) OVER ({part}) - coalesce(sum(weight) OVER {before}, 0)) AS rate FROM node{depth}),
    first{depth} AS (
        SELECT *, rate * weight >= cap AS filled,
               min(struct_pack(place := place, rate := rate)) FILTER (rate * weight < cap) OVER ({part}) AS first
        FROM rate{depth}),
    level{depth} AS (
        SELECT {', '.join(keys)}, CASE WHEN filled THEN cap ELSE least(cap, first.rate * weight) END AS budget
        FROM first{depth})""")
        above = f"level{depth}"
    leaf_is = "d.domain IS NOT DISTINCT FROM p.domain AND d.lang IS NOT DISTINCT FROM p.lang AND d.source IS NOT DISTINCT FROM p.source"
    return rf"""
    WITH d AS MATERIALIZED (
        SELECT doc_id, md5(coalesce(text, '')) AS t5, lang, source,
               (['web', 'books', 'code', 'forum'])[TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) % 4 + 1] AS domain,
               CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens
        FROM documents),
    leaf AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS tokens,
                    CAST(sum(n_tokens) * {plan.max_epochs} AS DOUBLE) AS cap FROM d GROUP BY ALL),
    {','.join(ctes)},
    planned AS (
        SELECT p.*, tokens, CAST(floor(budget + 1e-6) AS BIGINT) AS whole FROM level2 p JOIN leaf d ON {leaf_is}),
    p AS MATERIALIZED (SELECT *, whole // tokens AS epochs, whole % tokens AS rest FROM planned WHERE tokens > 0),
    full_epochs AS (
        SELECT doc_id, d.domain, d.lang, d.source, n_tokens, unnest(range(1, epochs + 1)) AS epoch, n_tokens AS taken
        FROM d JOIN p ON {leaf_is}),
    last AS (
        SELECT doc_id, d.domain, d.lang, d.source, n_tokens, epochs + 1 AS epoch, rest,
               coalesce(sum(n_tokens) OVER (
                   PARTITION BY d.domain, d.lang, d.source
                   ORDER BY md5('{plan.seed}:' || (epochs + 1) || ':' || doc_id || ':' || t5)
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
        FROM d JOIN p ON {leaf_is})
    SELECT doc_id, domain, lang, source, n_tokens, CAST(epoch AS INTEGER) AS epoch, taken FROM full_epochs
    UNION ALL
    SELECT doc_id, domain, lang, source, n_tokens, CAST(epoch AS INTEGER), CAST(least(n_tokens, rest - before) AS BIGINT)
    FROM last WHERE before < rest"""


def url_filter(rules: list[Rule], settings: Settings = Settings()) -> str:
    """Verdicts on all pages: by the longest rule that fits, else by the purity of the url's template."""
    by_length = sorted(rules, key=lambda r: -len(r.name))

    def rule(of) -> str:
        fits = "(host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '{1}')"
        return "CASE " + " ".join(f"WHEN {fits.format(r.host, r.path)} THEN '{of(r)}'" for r in by_length) + " END"

    ctes, tree = [], "tree"
    for level in range(DEPTH + 1):
        ctes.append(rf"""
    child{level} AS (
        SELECT host, template, segments[{level + 1}] AS child, sum(n) AS n, sum(good) AS good, sum(bad) AS bad
        FROM {tree} WHERE len(segments) > {level} GROUP BY ALL),
    whole{level} AS (
        SELECT *, count(*) OVER node AS n_children, good + bad AS labelled,
               (sum(bad) OVER node + {settings.prior}) / (sum(good) OVER node + sum(bad) OVER node + 1) AS rate
        FROM child{level} WINDOW node AS (PARTITION BY host, template)),
    step{level} AS (
        SELECT host, template, child,
               CASE WHEN n_children = 1 THEN child
                    WHEN labelled = 0 THEN '?' || regexp_extract(child, '^\*(\.[A-Za-z]+)$', 1)
                    WHEN NOT abs(bad - labelled * rate) > {settings.z} * sqrt(labelled * rate * (1 - rate))
                    THEN '*' || regexp_extract(child, '^\*(\.[A-Za-z]+)$', 1) ELSE child END AS step
        FROM whole{level}),
    tree{level} AS (
        SELECT t.host, segments, n, good, bad, t.template || coalesce('/' || step, '') AS template
        FROM {tree} t LEFT JOIN step{level} s
        ON t.host = s.host AND t.template = s.template AND s.child = segments[{level + 1}])""")
        tree = f"tree{level}"
    return rf"""
    WITH rest AS (
        SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    split AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM rest),
    placed AS (
        SELECT page_id, translate(raw, '{_UPPER}', '{_LOWER}') AS host,
               regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM split),
    parts AS (
        SELECT *, {rule(lambda r: r.name)} AS rule, {rule(lambda r: r.verdict)} AS given,
               [x FOR x IN string_split(path, '/') IF x <> ''] AS parts FROM placed),
    url AS MATERIALIZED (
        SELECT page_id, host, path, rule, given,
               [CASE WHEN regexp_matches(x, '[0-9]') THEN '*' || regexp_extract(x, '(\.[A-Za-z]+)$', 1) ELSE x END
                FOR x IN parts[1:{DEPTH}]] || CASE WHEN len(parts) > {DEPTH} THEN ['**'] ELSE [] END AS segments FROM parts),
    tree AS (
        SELECT host, segments, '' AS template, count(*) AS n, count(*) FILTER (given = 'allow') AS good,
               count(*) FILTER (given = 'block') AS bad FROM url GROUP BY host, segments),
    {','.join(ctes)},
    pure AS (
        SELECT host, segments, template,
               (sum(bad) OVER t + {settings.strength * settings.prior}) / (sum(good) OVER t + sum(bad) OVER t + {settings.strength}) AS purity
        FROM {tree} WINDOW t AS (PARTITION BY host, template))
    SELECT page_id, host, path, rule,
           coalesce(given, CASE WHEN purity >= {settings.reject} THEN 'block' ELSE 'allow' END) AS verdict, template, purity
    FROM url JOIN pure USING (host, segments)"""
