"""The catalogue's queries in DuckDB's SQL. Shared steps are named once and put before each statement that uses them."""

from __future__ import annotations

import re

from pulsegrid.operators.categories import NOISE_PATTERNS
from pulsegrid.operators.evidence import TECHNICAL_NAMESPACES
from pulsegrid.operators.clusters import PROMPT, STEP
from pulsegrid.operators.narrative import INVENTED_TRAFFIC, PROHIBITED
from pulsegrid.plans.catalogue import CLUSTERS, GUARD, THRESHOLD
from pulsegrid.sources.testdata import AS_OF, PROJECT, TOP_N, UNAVAILABLE_DAYS

_NAMES = ", ".join(f"'{n}'" for n in TECHNICAL_NAMESPACES)
_NOISE = "|".join(NOISE_PATTERNS)
_OFF = ", ".join(f"DATE '{d}'" for d in UNAVAILABLE_DAYS)

STEPS = {
    "daily": "SELECT CAST(ts AS DATE) AS date, event_type AS project, concat('u', user_id, '_', event_id % 2) AS article, sum(CAST(round(value * 100) AS BIGINT)) AS c FROM events GROUP BY ALL",
    "raw": f"SELECT date, project, article, CAST(((c + 99) // 100) * 100 AS BIGINT) AS views_ceil FROM daily QUALIFY row_number() OVER (PARTITION BY date ORDER BY ((c + 99) // 100) DESC, article, project) <= {TOP_N}",
    "nominal": f"SELECT CAST(d AS DATE) AS date, CASE WHEN CAST(d AS DATE) <= DATE '{AS_OF}' - 9 THEN 'previous' ELSE 'current' END AS \"window\" FROM generate_series(DATE '{AS_OF}' - 15, DATE '{AS_OF}' - 2, INTERVAL 1 DAY) t(d)",
    "days": f"SELECT date, \"window\", CASE WHEN date IN ({_OFF}) THEN 'unavailable' ELSE 'successful' END AS status FROM nominal",
    "counted": "SELECT CAST(ts AS DATE) AS date, count(*) AS n FROM events GROUP BY ALL",
    "seen": "SELECT CAST(d AS DATE) AS date, CASE WHEN CAST(d AS DATE) <= newest - 8 THEN 'previous' ELSE 'current' END AS \"window\", CASE WHEN n % 5 > 0 THEN 'successful' ELSE 'unavailable' END AS status FROM (SELECT max(date) AS newest, unnest(generate_series(max(date) - 14, max(date) - 1, INTERVAL 1 DAY)) AS d FROM counted) LEFT JOIN counted ON date = CAST(d AS DATE)",
    "ok": "SELECT date, \"window\" FROM days WHERE status = 'successful'",
    "records": "SELECT raw.* FROM raw WHERE date IN (SELECT date FROM ok)",
    "own": f"SELECT * FROM records WHERE project = '{PROJECT}'",
    "cutoffs": "SELECT ok.date, min(views_ceil) AS cutoff FROM ok LEFT JOIN records USING (date) GROUP BY ok.date",
    "universe": "SELECT DISTINCT article FROM own",
    "aliases": "SELECT DISTINCT concat('u', user_id, '_', event_id % 2) AS alias, user_id AS page_id FROM events",
    "page": "SELECT doc_id AS page_id, CASE source WHEN 'src0' THEN concat('Special:Doc ', doc_id) WHEN 'src1' THEN 'Main Page' ELSE concat('Doc ', doc_id) END AS canonical_title, substring(text, 1, 600) AS lead, list_filter(string_split(substring(text, 1, 600), ' '), lambda w: w <> '') AS words, source, lang = 'de' AS unavailable FROM documents",
    "reasons": f"SELECT *, CASE WHEN lower(trim(replace(canonical_title, '_', ' '))) = 'main page' THEN 'main_page' WHEN contains(canonical_title, ':') AND lower(split_part(replace(canonical_title, '_', ' '), ':', 1)) IN ({_NAMES}) THEN concat('technical_namespace:', lower(split_part(replace(canonical_title, '_', ' '), ':', 1))) END AS excluded FROM page",
    "resolved": "SELECT u.article, a.page_id, r.canonical_title, CASE WHEN a.page_id IS NULL THEN 'unknown' WHEN coalesce(r.unavailable, true) THEN 'unavailable' ELSE r.excluded END AS reason FROM universe u LEFT JOIN aliases a ON a.alias = u.article LEFT JOIN reasons r ON r.page_id = a.page_id",
    "series": "SELECT page_id, date, CAST(sum(views_ceil) AS BIGINT) AS views_ceil FROM own JOIN aliases ON alias = article GROUP BY ALL",
    "members": f"SELECT DISTINCT format('cluster-{{:02d}}', page_id % {CLUSTERS}) AS cluster_id, page_id FROM series",
    "grid": "SELECT m.cluster_id, m.page_id, ok.date, ok.\"window\", s.views_ceil, CAST(CASE WHEN s.views_ceil IS NULL THEN 0 ELSE greatest(0, s.views_ceil - 99) END AS BIGINT) AS lower, coalesce(s.views_ceil, c.cutoff) AS upper FROM members m CROSS JOIN ok JOIN cutoffs c USING (date) LEFT JOIN series s ON s.page_id = m.page_id AND s.date = ok.date",
    "sums": "SELECT cluster_id, \"window\", count(DISTINCT date) AS successful_days, CAST(coalesce(sum(views_ceil), 0) AS BIGINT) AS observed_total, count(views_ceil) AS observed_page_days, CAST(sum(lower) AS BIGINT) AS minimum_total, CAST(sum(upper) AS BIGINT) AS maximum_total FROM grid GROUP BY ALL",
    "traffic": "SELECT p.cluster_id, p.observed_total AS p_total, c.observed_total AS c_total, p.observed_total * 7.0::DOUBLE / p.successful_days AS p7, c.observed_total * 7.0::DOUBLE / c.successful_days AS c7, p.observed_page_days AS p_seen, c.observed_page_days AS c_seen, p.successful_days AS p_days, c.successful_days AS c_days, CASE WHEN p.observed_total = 0 AND c.observed_total > 0 THEN 'sudden_growth' WHEN c.minimum_total * p.successful_days > p.maximum_total * c.successful_days THEN 'robust_growth' WHEN c.maximum_total * p.successful_days < p.minimum_total * c.successful_days THEN 'robust_shrinking' ELSE 'uncertain_direction' END AS direction FROM sums p JOIN sums c ON p.cluster_id = c.cluster_id AND p.\"window\" = 'previous' AND c.\"window\" = 'current'",
    "scored": "SELECT *, ln(1 + greatest(p7, c7)) * least(abs(log2((c7 + 1) / (p7 + 1))), 10.0::DOUBLE) AS score FROM traffic",
    "ranked": "SELECT *, row_number() OVER (ORDER BY score DESC, cluster_id) AS rank FROM scored WHERE direction IN ('robust_growth', 'robust_shrinking', 'sudden_growth') QUALIFY rank <= 10",
    "sizes": "SELECT cluster_id, count(*) AS n_members FROM members GROUP BY ALL",
    "items": "SELECT rank, cluster_id, direction, n_members, CASE WHEN p7 = 0 THEN NULL ELSE (c7 - p7) / p7 * 100 END AS percentage_change, p_seen::DOUBLE / (p_days * n_members) AS coverage_previous, c_seen::DOUBLE / (c_days * n_members) AS coverage_current, CASE WHEN direction = 'sudden_growth' THEN 'observed' ELSE 'robust' END AS confidence, score AS impact_score FROM ranked JOIN sizes USING (cluster_id)",
    "noisy": "SELECT page_id, canonical_title, lead, list_concat(list_append(words, source), [concat(1900 + page_id % 100, ' births'), 'Living people', 'All articles to check']) AS categories FROM page",
    "named": f"SELECT DISTINCT page_id, category FROM (SELECT page_id, unnest(categories) AS category FROM noisy) WHERE NOT regexp_matches(category, '{_NOISE}')",
    "idf": "SELECT category, count(*) AS df, ln((SELECT count(*) FROM noisy) / count(*)) AS idf FROM named GROUP BY category",
    "best": "SELECT page_id, category, row_number() OVER (PARTITION BY page_id ORDER BY idf DESC, category) AS place FROM named JOIN idf USING (category) QUALIFY place <= 5",
    "lists": "SELECT n.page_id, n.canonical_title, n.lead, coalesce(string_agg(category, chr(31) ORDER BY place), '') AS selected, coalesce(string_agg(category, ' | ' ORDER BY place), '(none)') AS shown FROM noisy n LEFT JOIN best b ON b.page_id = n.page_id GROUP BY ALL",
    "sized": "SELECT page_id, canonical_title, lead, categories, octet_length(encode(concat('{\"page_id\":', page_id, ',\"canonical_title\":', to_json(canonical_title), ',\"lead\":', to_json(lead), ',\"selected_categories\":[', listed, ']}'))) AS bytes FROM (SELECT n.page_id, n.canonical_title, n.lead, coalesce(string_agg(category, ',' ORDER BY place), '') AS categories, coalesce(string_agg(CAST(to_json(category) AS VARCHAR), ',' ORDER BY place), '') AS listed FROM noisy n LEFT JOIN best b ON b.page_id = n.page_id GROUP BY ALL)",
    "vec": "SELECT vec_id AS page_id, embedding::DOUBLE[] AS v, label FROM embeddings",
    "pairs": "SELECT a.page_id AS src, b.page_id AS dst, 0.7 * list_cosine_similarity(a.v, b.v) + 0.3 * (a.label = b.label)::INT AS similarity FROM vec a JOIN vec b ON a.page_id < b.page_id",
    "edges": f"SELECT * FROM pairs WHERE similarity >= {THRESHOLD}",
    "twoway": "SELECT src AS a, dst AS b FROM edges UNION SELECT dst, src FROM edges",
    "components": "SELECT v.page_id, coalesce(min(r.b), v.page_id) AS component FROM vec v LEFT JOIN reach r ON r.a = v.page_id AND r.b <= v.page_id GROUP BY v.page_id",
    "kept": "SELECT * FROM components QUALIFY count(*) OVER (PARTITION BY component) > 1",
    "cohesions": "SELECT a.component AS cluster, avg(similarity) AS cohesion FROM components a JOIN components b ON a.component = b.component AND a.page_id < b.page_id JOIN pairs p ON p.src = a.page_id AND p.dst = b.page_id GROUP BY ALL",
    "groups": "SELECT component, count(*) AS size, list_sort(list(page_id)) AS page_ids FROM kept GROUP BY component",
    "order_": "SELECT g.*, row_number() OVER (ORDER BY round(cohesion, 12) DESC NULLS LAST, size DESC, page_ids) AS rank FROM groups g JOIN cohesions ON cluster = component",
    "review": "SELECT rank, component, page_ids, size, format('preliminary-cluster-{:04d}', rank) AS cluster_id FROM order_",
    "each": "SELECT r.cluster_id, r.rank, p.page_id, coalesce(l.toxic, 0) = 1 AS toxic FROM (SELECT cluster_id, rank, unnest(page_ids) AS page_id FROM review) p JOIN review r USING (cluster_id, rank) LEFT JOIN labels l ON l.doc_id = p.page_id",
    "decided": "SELECT *, CASE WHEN count(*) FILTER (WHERE NOT toxic) OVER (PARTITION BY cluster_id) >= 2 AND NOT toxic THEN 'accepted' ELSE 'rejected' END AS assignment FROM each",
}
#: Steps after the others: parts of components at ever stricter thresholds, by the closure of the edges of every level.
_PARTS = f"""levels AS (SELECT 0 AS l, {THRESHOLD}::DOUBLE AS thr UNION ALL SELECT l + 1, least(1.0::DOUBLE, thr + {STEP}::DOUBLE) FROM levels WHERE thr < 1.0),
ways AS (SELECT l, src AS a, dst AS b FROM levels JOIN edges ON similarity >= thr UNION ALL SELECT l, dst, src FROM levels JOIN edges ON similarity >= thr),
closed AS (SELECT l, a, b FROM ways UNION SELECT c.l, c.a, w.b FROM closed c JOIN ways w ON w.l = c.l AND w.a = c.b),
leveled AS (SELECT l, thr, k.page_id, k.component, least(k.page_id, coalesce((SELECT min(b) FROM closed c WHERE c.l = levels.l AND c.a = k.page_id), k.page_id)) AS part FROM kept k CROSS JOIN levels),
fitting AS (SELECT *, {PROMPT} + 2 + sum(bytes) OVER (PARTITION BY l, part) + count(*) OVER (PARTITION BY l, part) - 1 <= {GUARD} AS fits FROM leveled JOIN sized USING (page_id)),
whole AS (SELECT page_id, component, arg_min(part, l) AS cluster, CASE WHEN min(l) > 0 THEN min(thr) END AS subdivision_threshold FROM fitting WHERE fits GROUP BY page_id, component),
queue AS (SELECT page_id, component, part, bytes, row_number() OVER (PARTITION BY part ORDER BY page_id) AS n FROM fitting WHERE l = (SELECT max(l) FROM levels) AND page_id NOT IN (SELECT page_id FROM whole)),
packed AS (SELECT part, n, page_id, component, page_id AS cluster, {PROMPT} + 2 + bytes AS used FROM queue WHERE n = 1
  UNION ALL SELECT q.part, q.n, q.page_id, q.component, CASE WHEN used + q.bytes + 1 <= {GUARD} THEN p.cluster ELSE q.page_id END, CASE WHEN used + q.bytes + 1 <= {GUARD} THEN used + q.bytes + 1 ELSE {PROMPT} + 2 + q.bytes END FROM packed p JOIN queue q ON q.part = p.part AND q.n = p.n + 1),
parts AS (SELECT * FROM whole UNION ALL SELECT page_id, component, cluster, 1.0::DOUBLE FROM packed)"""
_RECURSIVE = "reach AS (SELECT a, b FROM twoway UNION SELECT r.a, e.b FROM reach r JOIN twoway e ON e.a = r.b)"


def _needs(sql: str, found: list[str]) -> list[str]:
    for name in STEPS:
        if name not in found and re.search(rf"(?:FROM|JOIN|IN \(SELECT \w+ FROM|\(SELECT count\(\*\) FROM)\s+{name}\b", sql):
            _needs(STEPS[name], found)
            if name == "components" and "reach" not in found:
                _needs("FROM twoway FROM vec", found)
                found.append("reach")
            found.append(name)
    return found


def _with(sql: str) -> str:
    names = _needs(sql, [])
    recursive = "RECURSIVE " if "reach" in names else ""
    steps = ",\n".join(_RECURSIVE if n == "reach" else f"{n} AS MATERIALIZED ({STEPS[n]})" for n in names)
    return f"WITH {recursive}{steps}\n{sql}" if names else sql


_WINDOW = "SELECT cluster_id, \"window\", successful_days, observed_total, observed_page_days, minimum_total, maximum_total, round(observed_total * 7.0::DOUBLE / successful_days, 6) AS seven_day_equivalent, round(minimum_total * 7.0::DOUBLE / successful_days, 6) AS minimum, round(maximum_total * 7.0::DOUBLE / successful_days, 6) AS maximum FROM sums"
_SUMMARY = "CASE WHEN direction = 'sudden_growth' THEN concat('Attention to ', name, ' topics was suddenly trending in the supplied comparison.') ELSE concat('Attention to ', name, ' topics ', CASE WHEN direction = 'robust_growth' THEN 'rose' ELSE 'declined' END, ' in the supplied comparison.') END"



def _root(name: str, digests: str) -> str:
    """SQL of one row (root, n): the tree over a query's digests, as functions.digests has it."""
    level = lambda below, digits: f"SELECT substr(node, 1, {digits}) AS node, substr(node, 1, {digits}) || ':' || sha256(string_agg(line, ',' ORDER BY line)) AS line, sum(n) AS n FROM {below} GROUP BY ALL"
    lines = f"SELECT digest AS node, digest || ':' || count(*) AS line, count(*) AS n FROM ({digests}) GROUP BY digest"
    inner = level(f"({level(f'({lines})', 6).replace('GROUP BY ALL', 'GROUP BY substr(node, 1, 6)')})", 3).replace("GROUP BY ALL", "GROUP BY substr(node, 1, 3)")
    return f"SELECT '{name}' AS name, CAST(sum(n) AS BIGINT) AS n_rows, 'sha256:' || sha256(string_agg(line, ',' ORDER BY line)) AS fingerprint FROM ({inner})"


_PAGE_DIGEST = "SELECT sha256(CAST(to_json({'canonical_title': canonical_title, 'categories': list_sort(list_distinct(list_append(words, source))), 'lead': lead, 'page_id': page_id}) AS VARCHAR)) AS digest FROM page"

_PLAIN = {
    "semantic_fingerprint": f"SELECT fingerprint, n_rows AS n_pages FROM ({_root('pages', _PAGE_DIGEST)})",
    "stage_artifact_scan": _root("documents", "SELECT sha256(CAST(to_json({'doc_id': doc_id, 'lang': lang, 'source': source}) AS VARCHAR)) AS digest FROM documents") + " UNION ALL " + _root("labels", "SELECT sha256(CAST(to_json({'doc_id': doc_id, 'quality': quality, 'toxic': toxic}) AS VARCHAR)) AS digest FROM labels"),
    "event_guard": """WITH e AS (SELECT event_id, event_type AS run_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - CASE WHEN event_id % 41 = 0 THEN 5 ELSE 0 END AS sequence, CASE WHEN event_id % 31 > 0 THEN ts END AS at_, event_id % 37 = 0 AS other FROM events),
        f AS (SELECT *, CASE WHEN at_ IS NULL THEN 'timestamp' WHEN sequence < 1 THEN 'sequence' WHEN other THEN 'level' END AS shape FROM e)
        SELECT run_id, sequence, event_id, coalesce(shape, CASE WHEN sequence <= max(CASE WHEN shape IS NULL THEN sequence END) OVER (PARTITION BY run_id ORDER BY at_ NULLS FIRST, sequence ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 'order' END) AS fault FROM f""",
    "retry_delay": "SELECT event_id, round(CASE event_id % 4 WHEN 0 THEN event_id % 60 + 0.1 WHEN 1 THEN (event_id % 900) / 1000.0 + 0.1 WHEN 2 THEN least(pow(2, event_id % 7), 30) END::DOUBLE, 6) AS delay FROM events",
    "ledger_resume": "SELECT CAST(ts AS DATE) - min(CAST(min(ts) AS DATE)) OVER () + 1 AS sequence, CAST(CAST(ts AS DATE) AS VARCHAR) AS unit, concat(count(*), '/', count(DISTINCT user_id)) AS body FROM events GROUP BY CAST(ts AS DATE)",
    "narrative_revalidation": "SELECT cluster_id, CASE CAST(substr(cluster_id, 9) AS INTEGER) % 5 WHEN 1 THEN 'an attempt is not what validation finds' WHEN 2 THEN 'attempts are not numbered' WHEN 3 THEN 'not the last attempt alone is valid' ELSE 'another narrative is published' END AS fault FROM items WHERE CAST(substr(cluster_id, 9) AS INTEGER) % 5 > 0",
    "scan_raw_daily": "SELECT * FROM raw",
    "filter_project": f"SELECT * FROM raw WHERE project = '{PROJECT}'",
    "nominal_days": "SELECT date, \"window\" FROM seen",
    "guard_consecutive_days": "SELECT count(*) AS n_days, count(*) = 14 AND max(date) - min(date) = 13 AND count(DISTINCT date) = 14 AS consecutive FROM seen WHERE status = 'successful'",
    "daily_cutoffs": "SELECT * FROM cutoffs",
    "coverage": "SELECT \"window\", count(*) FILTER (WHERE status = 'successful') AS successful_days FROM seen GROUP BY ALL",
    "coverage_gate": "SELECT \"window\", count(*) FILTER (WHERE status = 'successful') AS successful_days, count(*) FILTER (WHERE status = 'successful') >= 4 AS accepted FROM seen GROUP BY ALL",
    "candidate_universe": "SELECT * FROM universe",
    "metadata_batches": "SELECT article, (row_number() OVER (ORDER BY article) - 1) // 50 AS batch FROM universe",
    "exclusion_reason": "SELECT page_id, excluded AS reason FROM reasons",
    "canonicalize": "SELECT * FROM resolved",
    "exclusion_counts": f"SELECT reason, count(*) AS n FROM resolved WHERE reason IS NOT NULL GROUP BY ALL UNION ALL SELECT 'other_project', count(*) FILTER (WHERE project <> '{PROJECT}') FROM records",
    "canonical_pages": "SELECT page_id, canonical_title, string_agg(DISTINCT article, ',' ORDER BY article) AS aliases FROM resolved WHERE reason IS NULL GROUP BY ALL",
    "evidence_artifact_scan": "SELECT p.*, n_days, views FROM (SELECT page_id, canonical_title, count(DISTINCT article) AS n_aliases FROM resolved WHERE reason IS NULL GROUP BY ALL) p LEFT JOIN (SELECT page_id, count(DISTINCT date) AS n_days, CAST(sum(views_ceil) AS BIGINT) AS views FROM own JOIN resolved USING (article) WHERE reason IS NULL GROUP BY ALL) USING (page_id)",
    "evidence_faults": """SELECT 'pages' AS part, CAST(page_id AS VARCHAR) AS "key", CASE page_id % 7 WHEN 0 THEN 'title' ELSE 'lead' END AS fault FROM (SELECT DISTINCT page_id FROM resolved WHERE reason IS NULL) WHERE page_id % 7 < 2
        UNION ALL SELECT 'observations', concat(page_id, '/', date + CASE page_id % 11 WHEN 1 THEN 30 ELSE 0 END), CASE page_id % 11 WHEN 0 THEN 'views' ELSE 'day' END FROM (SELECT DISTINCT page_id, date FROM own JOIN resolved USING (article) WHERE reason IS NULL) WHERE page_id % 11 < 2
        UNION ALL SELECT 'cutoffs', CAST(date AS VARCHAR), 'missing' FROM ok WHERE day(date) % 2 = 0""",
    "page_observations": "SELECT page_id, date, CAST(sum(views_ceil) AS BIGINT) AS views_ceil FROM own JOIN resolved USING (article) WHERE reason IS NULL GROUP BY ALL",
    "lead_truncate": "SELECT doc_id, substring(text, 1, 600) AS lead FROM documents",
    "category_prefix_strip": "SELECT doc_id, source AS category FROM documents",
    "merge_metadata": "SELECT page_id, canonical_title, lead, array_to_string(list_sort(list_distinct(list_slice(list_append(list_distinct_in_order, source), 1, 4))), ',') AS categories, false AS conflict FROM (SELECT *, list_filter(words, lambda w, i: list_position(words, w) = i) AS list_distinct_in_order FROM page)",
    "redirect_resolution": """WITH RECURSIVE link AS (SELECT doc_id AS source, CASE WHEN doc_id % 300 > 0 THEN doc_id - 1 ELSE doc_id + 1 END AS target FROM documents WHERE doc_id % 300 > 0 OR doc_id // 300 % 2 = 1),
        hop AS (SELECT doc_id AS start, doc_id AS pos FROM documents UNION SELECT start, target FROM hop JOIN link ON pos = source)
        SELECT concat('d', start) AS title, 'd' || max(pos) FILTER (pos NOT IN (SELECT source FROM link)) AS final FROM hop GROUP BY start""",
    "category_noise_filter": "SELECT n.page_id, CAST(count(category) AS INTEGER) AS n, coalesce(string_agg(category, chr(31) ORDER BY category), '') AS categories FROM noisy n LEFT JOIN named USING (page_id) GROUP BY ALL",
    "category_df": "SELECT category, df FROM idf",
    "category_idf": "SELECT category, df, round(idf, 6) AS idf FROM idf",
    "select_categories": "SELECT page_id, selected AS selected_categories FROM lists",
    "representations": "SELECT page_id, concat('Title: ', canonical_title, chr(10), 'Lead: ', lead) AS content_text, concat('Selected Categories: ', shown) AS category_text FROM lists",
    "scan_embeddings": "SELECT page_id, CAST(len(v) AS INTEGER) AS n, round(list_sum(v), 6) AS total FROM vec",
    "embed_texts": "SELECT doc_id, length(text) - length(replace(replace(text, 'a', ''), 'A', '')) AS a, length(text) - length(replace(replace(text, 'z', ''), 'Z', '')) AS z, length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS letters, (SELECT count(DISTINCT t) FROM (SELECT coalesce(text, '') AS t FROM documents) WHERE t NOT IN (SELECT coalesce(text, '') FROM documents WHERE doc_id % 2 = 0)) AS encoded FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)",
    "normalize_embeddings": "SELECT page_id, round(v[1] / sqrt(list_inner_product(v, v)), 6) AS first, round(v[64] / sqrt(list_inner_product(v, v)), 6) AS last FROM vec",
    "similarity_edges": "SELECT src, dst, round(similarity, 6) AS similarity FROM edges",
    "connected_components": "SELECT * FROM components",
    "cluster_cohesion": "SELECT component AS cluster, count(*) AS size, round(min(cohesion), 6) AS cohesion FROM components LEFT JOIN cohesions ON cluster = component GROUP BY component",
    "token_estimate": f"SELECT component, count(*) AS n, CAST(sum(bytes) + count(*) - 1 + 2 + {PROMPT} AS BIGINT) AS tokens FROM kept JOIN sized USING (page_id) GROUP BY component",
    "preliminary_clusters": "SELECT component, size, round(cohesion, 6) AS cohesion, array_to_string(page_ids, ',') AS page_ids FROM groups JOIN cohesions ON cluster = component",
    "rank_clusters": "SELECT CAST(rank AS INTEGER) AS rank, cluster_id, size, array_to_string(page_ids, ',') AS page_ids FROM review",
    "review_cap": "SELECT CAST(rank AS INTEGER) AS rank, cluster_id FROM review WHERE rank <= 10",
    "decision_validation": "SELECT cluster_id, 'valid' AS status, page_id, assignment, CASE WHEN assignment = 'rejected' THEN 'toxic' END AS reason FROM decided",
    "terminal_partition": "SELECT cluster_id, count(*) FILTER (WHERE page_id % 11 = 0 AND page_id % 13 > 0) AS missing, 0::BIGINT AS unknown, count(*) FILTER (WHERE page_id % 13 = 0 AND page_id % 11 > 0) AS repeated, count(*) FILTER (WHERE (page_id % 11 = 0) <> (page_id % 13 = 0)) = 0 AS exact FROM each GROUP BY cluster_id UNION ALL SELECT 'elsewhere', 0, count(*), 0, false FROM each WHERE page_id % 17 = 0 HAVING count(*) > 0",
    "decision_faults": "SELECT cluster_id, 'invalid' AS status, CASE page_ids[1] % 4 WHEN 0 THEN 'unknown_page_id:-1' WHEN 1 THEN concat('omitted_page_id:', page_ids[1]) WHEN 2 THEN concat('duplicate_page_id:', page_ids[1], ',multiply_assigned_page_id:', page_ids[1]) ELSE 'invalid_proposal_shape' END AS errors, unnest(page_ids) AS page_id, 'rejected' AS assignment FROM review WHERE size > 2",
    "landed_metadata": "SELECT concat('d', doc_id) AS alias, CASE WHEN doc_id % 10 <> 7 THEN doc_id END AS page_id, CASE WHEN doc_id % 10 <> 7 THEN CASE WHEN doc_id % 10 = 3 THEN concat('Doc ', doc_id) ELSE concat('D', doc_id) END END AS canonical_title, CASE WHEN doc_id % 10 <> 7 THEN substring(text, 1, 600) END AS lead, CASE WHEN doc_id % 10 <> 7 THEN source END AS categories FROM documents",
    "adjudication_counts": "SELECT count(DISTINCT cluster_id) AS reviewed_clusters, count(*) FILTER (WHERE assignment = 'accepted') AS accepted_pages, count(*) FILTER (WHERE assignment = 'rejected') AS rejected_pages, count(DISTINCT cluster_id) FILTER (WHERE assignment = 'accepted') AS final_clusters FROM decided",
    "assign_cluster_ids": "SELECT format('final-audience-cluster-{:04d}', row_number() OVER (ORDER BY cluster_id)) AS final_cluster_id, cluster_id, page_ids FROM (SELECT cluster_id, string_agg(page_id, ',' ORDER BY page_id) AS page_ids FROM decided WHERE assignment = 'accepted' GROUP BY cluster_id)",
    "model_visible_members": "SELECT cluster_id, page_id, canonical_title, lead, categories AS selected_categories FROM each JOIN sized USING (page_id)",
    "censored_grid": "SELECT * FROM grid",
    "window_traffic": _WINDOW,
    "window_traffic_grid": _WINDOW,
    "classify_direction": "SELECT cluster_id, direction FROM traffic",
    "impact_score": "SELECT cluster_id, round(score, 6) AS impact_score FROM scored",
    "qualify": "SELECT cluster_id, direction FROM traffic WHERE direction <> 'uncertain_direction'",
    "rank_portfolio": "SELECT CAST(rank AS INTEGER) AS rank, cluster_id, direction, round(score, 6) AS impact_score FROM ranked",
    "portfolio_items": "SELECT CAST(rank AS INTEGER) AS rank, cluster_id, direction, n_members, round(percentage_change, 6) AS percentage_change, round(coverage_previous, 6) AS coverage_previous, round(coverage_current, 6) AS coverage_current, confidence, round(impact_score, 6) AS impact_score FROM items",
    "validate_membership": "SELECT cluster_id, page_id * 7 AS page_id FROM members WHERE page_id * 7 NOT IN (SELECT doc_id FROM documents)",
    "validate_observation_dates": "SELECT date, count(*) AS n FROM raw WHERE date NOT IN (SELECT date FROM ok) GROUP BY date",
    "validate_cutoffs": "SELECT coalesce(o.date, g.date) AS date, CASE WHEN g.date IS NULL THEN 'missing' ELSE 'unexpected' END AS fault FROM (SELECT date FROM ok) o FULL JOIN (SELECT date FROM raw WHERE date >= DATE '2024-01-17' GROUP BY date) g ON o.date = g.date WHERE o.date IS NULL OR g.date IS NULL",
    "validate_duplicates": "SELECT date, article, count(*) AS n FROM raw GROUP BY ALL HAVING count(*) > 1",
    "narrative_templates": f"SELECT cluster_id, name, direction, 'Retail,Travel' AS brand_categories, rating AS buying_power_rating, {_SUMMARY} AS summary, 'Retail, Travel brands may find the supplied topic group commercially relevant.' AS commercial_interpretation, concat('The ', rating, ' rating is a qualitative assessment based on the supplied topics'' relevance to Retail, Travel.') AS buying_power_rationale FROM (SELECT *, concat('Group ', cluster_id) AS name, CASE WHEN rank % 2 = 0 THEN 'high' ELSE 'medium' END AS rating FROM items)",
    "xstage_formation": "SELECT page_id, CASE WHEN page_id % 10 = 0 THEN 'title' ELSE 'categories' END AS fault FROM page WHERE page_id % 10 = 0 OR page_id % 7 = 0",
    "xstage_members": "SELECT page_id, CASE WHEN page_id % 6 = 0 THEN 'unknown' ELSE 'differs' END AS fault FROM page WHERE page_id % 2 = 0 AND (page_id % 6 = 0 OR page_id % 10 = 0)",
    "xstage_traffic": "SELECT cluster_id, CASE WHEN cluster_id = 'cluster-03' THEN 'unknown' ELSE 'differs' END AS fault FROM traffic WHERE cluster_id IN ('cluster-03', 'cluster-05')",
    "xstage_portfolio": "SELECT CAST(rank AS INTEGER) AS rank, 'unknown' AS fault FROM items WHERE rank = 2",
    "xstage_ids": "SELECT CAST(rank AS INTEGER) AS rank, 'preliminary-cluster-0000' AS cluster_id, cluster_id AS expected FROM review WHERE rank % 5 = 0",
    "audit_redaction": "SELECT user_id, concat('[', string_agg(concat('{\"attempt\":', event_id, ',\"status\":\"', event_type, '\"}'), ',' ORDER BY event_id), ']') AS attempts FROM events GROUP BY user_id",
    "event_sequence_check": "SELECT run_id, count(*) AS n_events, min(s) AS first, max(s) AS last, count(*) FILTER (WHERE step <> 1) AS gaps, count(*) FILTER (WHERE step <> 1) = 0 AND min(s) = 1 AS contiguous FROM (SELECT run_id, s, s - lag(s) OVER (PARTITION BY run_id ORDER BY s) AS step FROM (SELECT event_type AS run_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) + CASE WHEN event_id % 97 = 0 THEN 1 ELSE 0 END AS s FROM events)) GROUP BY run_id",
    "event_global_sequence": "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id, event_type AS stage, event_id AS sequence, CAST(row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY event_type, event_id) AS INTEGER) AS global_sequence FROM events",
    "event_public_message": "SELECT event_id, concat('Stage ', event_type, ': load rows ', CASE event_type WHEN 'error' THEN 'failure' WHEN 'signup' THEN 'warning' ELSE 'update' END, '.') AS message FROM events",
    "event_daily_counts": "SELECT CAST(ts AS DATE) AS day, event_type AS module, count(*) AS n FROM events GROUP BY ALL",
    "revision_validation": "SELECT cluster_id, 'invalid' AS status, string_agg(concat('omitted_page_id:', page_id), ',' ORDER BY page_id) OVER (PARTITION BY cluster_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS errors, page_id, 'rejected' AS assignment, 'invalid_adjudication' AS reason FROM each",
    "critique_validation": "SELECT cluster_id, 'invalid' AS status, 'invalid_critique' AS errors, page_id, 'invalid_adjudication' AS reason FROM each",
}
_CLAIMS = ", ".join(f"CASE WHEN regexp_matches(told, '{pattern}', 'i') THEN '{name}' END" for name, pattern in [*((f"prohibited {k} claim", v) for k, v in PROHIBITED.items()), ("prohibited invented traffic claim", INVENTED_TRAFFIC)])
_PLAIN["narrative_validation"] = f"""SELECT cluster_id, array_to_string(list_filter([{_CLAIMS}, CASE WHEN given <> summary THEN 'summary is outside the bounded narrative template' END], lambda x: x IS NOT NULL), ';') AS errors
    FROM (SELECT cluster_id, summary, given, replace(concat_ws(' ', name, given, commercial_interpretation, 'Retail Travel', buying_power_rating, buying_power_rationale), name, '') AS told
    FROM (SELECT *, CASE WHEN buying_power_rating = 'high' THEN concat(summary, ' Views doubled because of fans.') ELSE summary END AS given FROM ({_PLAIN["narrative_templates"]})))"""
_PLAIN["portfolio_cards"] = """SELECT CAST(rank AS INTEGER) AS rank, cluster_id, CASE direction WHEN 'robust_shrinking' THEN 'Shrinking' WHEN 'robust_growth' THEN 'Growing' ELSE 'Suddenly trending' END AS heading,
    CASE WHEN percentage_change IS NULL THEN 'new' ELSE printf('%+.1f%%', round(percentage_change, 1)) END AS change, concat(CAST(round(coverage_current * 100) AS INTEGER), '%') AS coverage FROM items"""
_BY_LEVELS = {
    "subdivide_components": "SELECT * FROM parts",
    "formation_counts": """SELECT a.*, b.*, c.*, least(10, eligible_clusters) AS selected_clusters, greatest(0, eligible_clusters - 10) AS omitted_clusters FROM
        (SELECT count(*) AS components, count(*) FILTER (WHERE n = 1) AS singleton_components FROM (SELECT component, count(*) AS n FROM components GROUP BY component)) a,
        (SELECT count(DISTINCT component) AS subdivided_components, count(DISTINCT cluster) AS subdivisions FROM parts WHERE subdivision_threshold IS NOT NULL) b,
        (SELECT count(*) AS eligible_clusters, count(*) FILTER (WHERE n = 1) AS singleton_subdivisions FROM (SELECT cluster, count(*) AS n FROM parts GROUP BY cluster)) c""",
    "pack_members": f"""SELECT page_id, component, CAST(pack AS INTEGER) AS pack FROM lined""",
    "spanning_forest": "SELECT src, dst, round(similarity, 6) AS similarity FROM ordered e WHERE NOT EXISTS (SELECT 1 FROM paths p WHERE p.place = e.place AND p.b = e.dst)",
}
#: Every component's pages in a line, packed one after another.
_LINED = f"""line AS (SELECT component, page_id, bytes, row_number() OVER (PARTITION BY component ORDER BY page_id) AS n FROM kept JOIN sized USING (page_id)),
lined AS (SELECT component, n, page_id, 0 AS pack, {PROMPT} + 2 + bytes AS used FROM line WHERE n = 1
  UNION ALL SELECT q.component, q.n, q.page_id, CASE WHEN used + q.bytes + 1 <= {GUARD} THEN p.pack ELSE p.pack + 1 END, CASE WHEN used + q.bytes + 1 <= {GUARD} THEN used + q.bytes + 1 ELSE {PROMPT} + 2 + q.bytes END FROM lined p JOIN line q ON q.component = p.component AND q.n = p.n + 1)"""
#: Where an edge's first end leads by stronger edges alone; one that leads to its second end is not of the forest.
_PATHS = """ordered AS (SELECT *, row_number() OVER (ORDER BY similarity DESC, src, dst) AS place FROM edges),
paths AS (SELECT place, src AS b FROM ordered UNION SELECT p.place, CASE WHEN o.src = p.b THEN o.dst ELSE o.src END FROM paths p JOIN ordered o ON o.place < p.place AND p.b IN (o.src, o.dst))"""


def _by_levels(name: str, sql: str) -> str:
    more = _PATHS if name == "spanning_forest" else _LINED if name == "pack_members" else _PARTS
    head = _with("SELECT 1 FROM components JOIN kept USING (page_id) JOIN sized USING (page_id) JOIN edges ON true").rpartition("\n")[0]
    return f"{head},\n{more}\n{sql}"


ORACLES = {name: sql if sql.startswith("WITH") else _with(sql) for name, sql in _PLAIN.items()} | {name: _by_levels(name, sql) for name, sql in _BY_LEVELS.items()}
