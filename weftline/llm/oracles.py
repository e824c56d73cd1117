"""SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

from weftline.llm import urltree

#: Exact set join and transitive closure, for op5.
NEAR_DUPLICATES = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END) AS g FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN n na ON na.doc_id = a.doc_id JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  WHERE 100 * least(na.n, nb.n) >= 80 * greatest(na.n, nb.n)
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))
), reach AS (SELECT a AS doc, b AS other FROM links UNION SELECT r.doc, l.b FROM reach r JOIN links l ON l.a = r.other),
least_of AS (SELECT doc, min(other) AS other FROM reach GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(l.other, d.doc_id)) AS component_id, d.doc_id = least(d.doc_id, coalesce(l.other, d.doc_id)) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least_of l ON l.doc = d.doc_id
"""


def path_templates() -> str:
    """Rules, the template tree and its merged branches, level by level, for op6."""
    u = urltree
    rules = sorted(u.RULES, key=lambda r: -len(r[1]))
    fits = lambda text: "(host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '/{1}')".format(*text.split("/", 1))
    rule = "CASE " + " ".join(f"WHEN {fits(t)} THEN '{t}'" for _, t in rules) + " END"
    word = "CASE " + " ".join(f"WHEN {fits(t)} THEN '{w}'" for w, t in rules) + " ELSE by_template END"
    return f"""WITH RECURSIVE parsed AS (SELECT page_id, CASE WHEN contains(url, '://') THEN url[strpos(url, '://') + 3:] ELSE '' END AS rest FROM pages),
split AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*', 0) AS raw, rest FROM parsed),
page AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest[length(raw) + 1:], '^[^?#]*', 0) AS path FROM split),
level AS (
  SELECT page_id, host, path, list_filter(string_split(path, '/'), lambda x: x <> '') AS parts, '' AS template, 0 AS depth FROM page
  UNION ALL
  SELECT page_id, host, path, parts, template || '/' || CASE WHEN children >= {u.CHILDREN} AND urls < {u.URLS_EACH} * children THEN '*' || regexp_extract(parts[depth + 1], '(\\.[A-Za-z0-9]{{1,5}})$', 1) ELSE parts[depth + 1] END, depth + 1
  FROM (SELECT *, count(DISTINCT parts[depth + 1]) OVER node AS children, count(DISTINCT path) OVER node AS urls FROM level WHERE len(parts) > depth WINDOW node AS (PARTITION BY host, template))
), leaf AS (SELECT * FROM level WHERE depth = len(parts)),
known AS (SELECT doc_id, max(CAST(quality = 0 OR toxic = 1 AS INTEGER)) AS bad FROM labels GROUP BY 1),
counts AS (SELECT host, template, CAST(coalesce(sum(bad), 0) AS DOUBLE) AS bad, CAST(count(bad) AS DOUBLE) AS seen FROM leaf LEFT JOIN known ON doc_id = TRY_CAST(regexp_extract(path, '/([0-9]+)[^/]*/?$', 1) AS BIGINT) GROUP BY ALL),
grown AS (
  SELECT host, template, bad, seen, list_filter(string_split(template, '/'), lambda x: x <> '') AS parts, '' AS branch, 0 AS depth FROM counts
  UNION ALL
  SELECT host, template, bad, seen, parts, branch || '/' || CASE WHEN pow(b * all_seen - s * all_bad, 2) > {u.DIFFER} * (s * all_bad * (all_seen - all_bad)) THEN parts[depth + 1] ELSE '~' END, depth + 1
  FROM (SELECT *, sum(bad) OVER child AS b, sum(seen) OVER child AS s, sum(bad) OVER node AS all_bad, sum(seen) OVER node AS all_seen FROM grown WHERE len(parts) > depth
    WINDOW child AS (PARTITION BY host, branch, parts[depth + 1]), node AS (PARTITION BY host, branch))
), branched AS (SELECT * FROM grown WHERE depth = len(parts)),
prior AS (SELECT (sum(seen) - sum(bad) + 1) / (sum(seen) + 2) AS prior FROM counts),
merged AS (SELECT host, branch, sum(bad) AS bad, sum(seen) AS seen FROM branched GROUP BY ALL),
found AS (SELECT b.host, b.template, b.branch, coalesce((m.seen - m.bad + {u.PRIOR_WEIGHT} * prior) / (m.seen + {u.PRIOR_WEIGHT}), 0.5) AS purity FROM branched b JOIN merged m ON m.host = b.host AND m.branch = b.branch, prior),
judged AS (SELECT *, CASE WHEN purity >= {u.PURITY} THEN 'allow' ELSE 'block' END AS by_template FROM found)
SELECT page_id, host, path, {rule} AS rule, {word} AS verdict, template, branch, purity
FROM (SELECT l.page_id, l.host, l.path, j.template, j.branch, j.purity, j.by_template FROM leaf l JOIN judged j ON j.host = l.host AND j.template = l.template)"""


ORACLES = {"op5_hyperminhash": NEAR_DUPLICATES, "op6_path_templates": path_templates()}
