"""Queries over page nodes: masks, priors, assignment, evaluation, stability."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import text as tx
from weftline.operators import declarative, drift, evaluate, reason
from weftline.plans.registry import query
from weftline.sources.bridge import NODES_SQL, page_nodes, table

STRICT = r"(?i)([£$€₼]|AZN)\s*[0-9]+([.,][0-9]{1,2})?|[0-9]+([.,][0-9]{1,2})?\s*([£$€₼]|AZN)"
STOPS = " OR ".join(f"contains(lower(t), '{w}')" for w in tx.STOP_WORDS)

MASKED_SQL = f"""{NODES_SQL},
masked AS (
  SELECT *, greatest(1080.0, max(y + h) OVER (PARTITION BY page_id)) AS height FROM nodes
), flags AS (
  SELECT *, y > height * 0.80 AS in_footer, y > 500 AS out_of_zone, regexp_matches(text, '{STRICT}') AS price_ok, trim(text) AS t FROM masked
), priors AS (
  SELECT *, regexp_matches(text, '[0-9]') AND length(t) < 25 AS priceish,
    contains(t, '/') OR regexp_matches(t, '^[0-9]+$') OR length(t) < 3 OR {STOPS} AS navish FROM flags
), scored AS (
  SELECT *, CASE WHEN t = '' THEN p_price - 1.0 WHEN priceish THEN p_price + 0.3 ELSE p_price END AS s_price,
    CASE WHEN t = '' THEN p_title - 1.0
      WHEN priceish OR navish THEN (CASE WHEN lower(tag) = 'h1' THEN p_title + 0.3 ELSE p_title END) - 0.3
      WHEN lower(tag) = 'h1' THEN p_title + 0.3 ELSE p_title END AS s_title,
    p_other AS s_other FROM priors
)"""

EXACT_SQL = f"""{MASKED_SQL},
price_top AS (
  SELECT page_id, node_idx, text, s_price - s_other AS gain FROM scored
  WHERE NOT in_footer AND NOT out_of_zone AND price_ok AND s_price - s_other > 0
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY s_price - s_other DESC, node_idx) <= 2
), title_top AS (
  SELECT page_id, node_idx, text, s_title - s_other AS gain FROM scored
  WHERE NOT in_footer AND NOT out_of_zone AND s_title - s_other > 0
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY s_title - s_other DESC, node_idx) <= 2
), page AS (SELECT DISTINCT page_id FROM nodes),
p AS (SELECT * FROM price_top UNION ALL SELECT page_id, NULL, NULL, 0.0 FROM page),
t AS (SELECT * FROM title_top UNION ALL SELECT page_id, NULL, NULL, 0.0 FROM page),
exact AS (
  SELECT page_id, t.node_idx AS title_idx, t.text AS title, p.node_idx AS price_idx, p.text AS price, p.gain + t.gain AS gain
  FROM p JOIN t USING (page_id) WHERE p.node_idx IS NULL OR t.node_idx IS NULL OR p.node_idx <> t.node_idx
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY p.gain + t.gain DESC, p.node_idx NULLS LAST, t.node_idx NULLS LAST) = 1
), greedy AS (
  SELECT page_id, arg_min(node_idx, (-s_title, node_idx)) AS title_idx, arg_min(text, (-s_title, node_idx)) AS title,
    arg_min(node_idx, (-s_price, node_idx)) AS price_idx, arg_min(text, (-s_price, node_idx)) AS price FROM scored GROUP BY page_id
), margins AS (
  SELECT page_id, node_idx, list_sort([p_price, p_title, p_other], 'DESC')[1] - list_sort([p_price, p_title, p_other], 'DESC')[2] AS margin FROM nodes
), sigma AS (SELECT page_id, avg(margin) AS sigma FROM margins GROUP BY page_id)"""


def _round(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query("assign_exact", f"WITH {EXACT_SQL} SELECT page_id, title_idx, title, price_idx, price, round(gain, 6) AS gain, round(sigma, 6) AS sigma, round(sigma, 9) < 0.6 AS alert FROM exact JOIN sigma USING (page_id)")
def assign_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reason.records(page_nodes(spark, sf_dir))
    return _round(rows.withColumn("alert", F.round("sigma", 9) < reason.STABLE), "gain", "sigma")


@query("assign_greedy", f"WITH {EXACT_SQL} SELECT * FROM greedy")
def assign_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reason.assign_greedy(reason.scored(page_nodes(spark, sf_dir)))


@query("assign_fallback", f"""WITH {MASKED_SQL}, cls AS (
  SELECT *, CASE WHEN s_price >= s_title AND s_price >= s_other THEN 1 WHEN s_title >= s_other THEN 2 ELSE 3 END AS c FROM scored)
SELECT page_id, arg_min(node_idx, (-s_title, node_idx)) FILTER (WHERE c = 2) AS title_idx, arg_min(text, (-s_title, node_idx)) FILTER (WHERE c = 2) AS title,
  arg_min(node_idx, (-s_price, node_idx)) FILTER (WHERE c = 1) AS price_idx, arg_min(text, (-s_price, node_idx)) FILTER (WHERE c = 1) AS price
FROM cls GROUP BY page_id""")
def assign_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reason.assign_fallback(reason.scored(page_nodes(spark, sf_dir)))


@query("candidate_trace_top5", f"""WITH {MASKED_SQL}, long AS (
  SELECT page_id, 'title' AS field, node_idx, s_title AS score, text, in_footer, out_of_zone, false AS format FROM scored
  UNION ALL SELECT page_id, 'price', node_idx, s_price, text, in_footer, out_of_zone, NOT price_ok FROM scored)
SELECT page_id, field, CAST(row_number() OVER w AS INTEGER) AS rank, node_idx, round(score, 6) AS score, substr(text, 1, 28) AS excerpt,
  concat_ws('+', CASE WHEN in_footer THEN 'footer' END, CASE WHEN out_of_zone THEN 'zone' END, CASE WHEN format THEN 'format' END) AS flags
FROM long WINDOW w AS (PARTITION BY page_id, field ORDER BY score DESC, node_idx) QUALIFY row_number() OVER w <= 5""")
def candidate_trace_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(reason.candidate_trace(reason.scored(page_nodes(spark, sf_dir))), "score")


@query("constraint_violations", f"""WITH {MASKED_SQL} SELECT page_id, CAST(count(*) FILTER (WHERE in_footer) AS BIGINT) AS footer,
  CAST(count(*) FILTER (WHERE out_of_zone) AS BIGINT) AS zone, CAST(count(*) FILTER (WHERE NOT price_ok) AS BIGINT) AS format FROM scored GROUP BY page_id""")
def constraint_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = reason.with_masks(page_nodes(spark, sf_dir))
    return n.groupBy("page_id").agg(F.count_if("in_footer").alias("footer"), F.count_if("out_of_zone").alias("zone"), F.count_if(~F.col("price_ok")).alias("format"))


@query("proof_trace", f"""WITH {MASKED_SQL}, page AS (SELECT DISTINCT page_id FROM nodes)
SELECT page_id, CAST(NULL AS INTEGER) AS node_idx, id, 'satisfied' AS status, field FROM page, (VALUES ('integrity', NULL), ('unique', 'title'), ('unique', 'price')) v(id, field)
UNION ALL SELECT page_id, node_idx, 'footer', 'excluded', 'both' FROM scored WHERE in_footer
UNION ALL SELECT page_id, node_idx, 'zone', 'excluded', 'both' FROM scored WHERE out_of_zone
UNION ALL SELECT page_id, node_idx, 'format', 'excluded', 'price' FROM scored WHERE NOT price_ok""")
def proof_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reason.proofs(reason.with_masks(page_nodes(spark, sf_dir)))


@query("title_merge", f"""WITH {EXACT_SQL}, picked AS (SELECT e.page_id, e.title_idx, e.title, e.price, n.y AS title_y FROM exact e JOIN nodes n ON n.page_id = e.page_id AND n.node_idx = e.title_idx),
more AS (SELECT k.page_id, arg_min(n.text, n.node_idx) AS more FROM picked k JOIN nodes n ON n.page_id = k.page_id
  WHERE abs(n.y - k.title_y) <= 60 AND n.text <> k.title AND n.text IS DISTINCT FROM k.price AND NOT regexp_matches(n.text, '[0-9]') AND length(n.text) > 2 GROUP BY k.page_id)
SELECT page_id, CASE WHEN more IS NOT NULL THEN title || ' ' || more ELSE title END AS title FROM picked LEFT JOIN more USING (page_id)""")
def title_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = page_nodes(spark, sf_dir)
    return reason.merge_split_title(nodes, reason.assign_exact(reason.scored(nodes)))


#: Made-up labels: the first text without a digit and the first price of each page.
LABELLED_SQL = """expected AS (
  SELECT page_id, arg_min(text, node_idx) FILTER (WHERE NOT regexp_matches(text, '[0-9]')) AS want_title,
    arg_min(text, node_idx) FILTER (WHERE contains(text, '£')) AS want_price FROM nodes GROUP BY page_id)"""


def _expected(nodes: DataFrame) -> DataFrame:
    first = lambda ok: F.min(F.when(ok, F.struct("node_idx", "text")))["text"]
    return nodes.groupBy("page_id").agg(first(~tx.has_digit(F.col("text"))).alias("title"), first(F.col("text").contains("£")).alias("price"))


def _with_y(nodes: DataFrame, found: DataFrame) -> DataFrame:
    y = nodes.select("page_id", "node_idx", "y")
    t = y.select("page_id", F.col("node_idx").alias("title_idx"), F.col("y").alias("title_y"))
    p = y.select("page_id", F.col("node_idx").alias("price_idx"), F.col("y").alias("price_y"))
    return found.join(t, ["page_id", "title_idx"], "left").join(p, ["page_id", "price_idx"], "left")


def _judged_sql(name: str) -> str:
    clean = lambda c: f"replace(trim(lower(coalesce({c}, ''))), '£', '')"
    hit = lambda want, got: f"(substr({clean(want)}, 1, 8) <> '' AND contains({clean(got)}, substr({clean(want)}, 1, 8)))"
    return f"""SELECT '{name}' AS mode, CAST(count(*) FILTER (WHERE {hit('want_title', 'title')}) AS BIGINT) AS title_ok, CAST(count(*) FILTER (WHERE {hit('want_price', 'price')}) AS BIGINT) AS price_ok,
  CAST(count(*) FILTER (WHERE {hit('want_title', 'title')} AND {hit('want_price', 'price')}) AS BIGINT) AS both_ok,
  CAST(sum(CAST(coalesce(nt.y > 864, false) AS INTEGER) + CAST(coalesce(np.y > 864, false) AS INTEGER) + CAST(price IS NOT NULL AND NOT regexp_matches(price, '{STRICT}') AS INTEGER)) AS BIGINT) AS violations, CAST(count(*) AS BIGINT) AS pages
FROM expected LEFT JOIN {name} g USING (page_id) LEFT JOIN nodes nt ON nt.page_id = g.page_id AND nt.node_idx = g.title_idx LEFT JOIN nodes np ON np.page_id = g.page_id AND np.node_idx = g.price_idx"""


@query("ablation_metrics", f"WITH {EXACT_SQL}, {LABELLED_SQL} {_judged_sql('exact')} UNION ALL {_judged_sql('greedy')}")
def ablation_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = page_nodes(spark, sf_dir)
    rows, expected = reason.scored(nodes), _expected(nodes)
    out = None
    for mode, found in (("exact", reason.assign_exact(rows)), ("greedy", reason.assign_greedy(rows))):
        m = evaluate.metrics(evaluate.judge(expected, _with_y(nodes, found.drop("gain")))).select(F.lit(mode).alias("mode"), "*")
        out = m if out is None else out.unionByName(m)
    return out


@query("page_height", f"WITH {NODES_SQL} SELECT page_id, greatest(1080.0, max(y + h)) AS height, max(y + h) AS extent FROM nodes GROUP BY page_id")
def page_height(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = page_nodes(spark, sf_dir)
    extent = F.max(F.col("y") + F.col("h"))
    return nodes.groupBy("page_id").agg(F.greatest(F.lit(reason.LEAST_HEIGHT), extent).alias("height"), extent.alias("extent"))


@query("price_format", f"WITH {NODES_SQL} SELECT page_id, node_idx, regexp_matches(text, '{STRICT}') AS price_ok, regexp_matches(text, '[0-9]') AS has_digit FROM nodes")
def price_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return page_nodes(spark, sf_dir).select("page_id", "node_idx", tx.price_format(t).alias("price_ok"), tx.has_digit(t).alias("has_digit"))


@query("priors", f"WITH {MASKED_SQL} SELECT page_id, node_idx, round(s_price, 6) AS s_price, round(s_title, 6) AS s_title, round(s_other, 6) AS s_other FROM scored")
def priors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(reason.with_priors(page_nodes(spark, sf_dir)).select("page_id", "node_idx", "s_price", "s_title", "s_other"), "s_price", "s_title", "s_other")


@query("priors_legacy", f"""WITH {MASKED_SQL} SELECT page_id, node_idx,
  round(p_price + CASE WHEN t = '' THEN -100.0 ELSE CASE WHEN priceish THEN 20.0 ELSE 0.0 END + CASE WHEN in_footer THEN -30.0 ELSE 0.0 END END, 6) AS s_price,
  round(p_title + CASE WHEN t = '' THEN -100.0 ELSE CASE WHEN lower(tag) = 'h1' THEN 10.0 ELSE 0.0 END + CASE WHEN priceish THEN -20.0 WHEN navish THEN -5.0 ELSE 0.0 END + CASE WHEN in_footer THEN -30.0 ELSE 0.0 END END, 6) AS s_title
FROM scored""")
def priors_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reason.with_priors(reason.with_masks(page_nodes(spark, sf_dir)), legacy=True)
    return _round(rows.select("page_id", "node_idx", "s_price", "s_title"), "s_price", "s_title")


@query("page_stability", f"WITH {EXACT_SQL} SELECT page_id, round(sigma, 6) AS sigma FROM sigma")
def page_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(reason.stability(page_nodes(spark, sf_dir)), "sigma")


@query("drift_blend", f"WITH {EXACT_SQL} SELECT page_id, round((1 - 0.4) * sigma, 6) AS sigma FROM sigma")
def drift_blend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(reason.stability(reason.blend(page_nodes(spark, sf_dir), 0.4)), "sigma")


def _values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stability history: one value each, one history for each user."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"), F.col("user_id").alias("template"), F.concat(F.lit("page/"), F.col("event_id").cast("string")).alias("page_url"),
        (F.pmod(F.floor(F.col("value") * 100).cast("long"), F.lit(1000)) / 1000).alias("sigma"),
    )


VALUES_SQL = """v AS (SELECT event_id AS seq, user_id AS template, 'page/' || CAST(event_id AS VARCHAR) AS page_url,
  CAST(((CAST(floor(value * 100) AS BIGINT) % 1000) + 1000) % 1000 AS DOUBLE) / 1000 AS sigma FROM events)"""


@query("drift_history", f"WITH {VALUES_SQL} SELECT seq, template, page_url, sigma, round(avg(sigma) OVER (PARTITION BY template ORDER BY seq), 9) AS running_mean, sigma < 0.6 AS alert FROM v")
def drift_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.history(_values(spark, sf_dir), "template").withColumn("running_mean", F.round("running_mean", 9))


@query("drift_queue", f"WITH {VALUES_SQL} SELECT page_url, sigma AS stability_score, 'DRIFT_DETECTED: σ below threshold (preliminary signal).' AS reason, '2026-01-01T00:00:00Z' AS timestamp_utc FROM v WHERE sigma < 0.6")
def drift_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.queue(_values(spark, sf_dir), "2026-01-01T00:00:00Z")


@query("history_tail", f"WITH {VALUES_SQL} SELECT * FROM v ORDER BY seq DESC LIMIT 1000")
def history_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.tail(_values(spark, sf_dir))


SCHEMA = {
    "name": "product",
    "fields": [
        {"name": "price", "constraints": [{"type": "unique"}, {"type": "format", "pattern": "£"}]},
        {"name": "title", "required": True, "constraints": [{"type": "visual", "max_relative_y": 0.5}]},
        {"name": "note", "required": False, "constraints": [{"type": "format", "pattern": "/"}]},
    ],
}

CANDIDATES_SQL = """cands AS (
  SELECT n.page_id, f.field, f.field_pos, f.required, n.node_idx AS pos, n.text, n.y, n.h,
    CASE f.field WHEN 'price' THEN p_price WHEN 'title' THEN p_title ELSE p_other END AS score
  FROM nodes n, (VALUES ('price', 0, true), ('title', 1, true), ('note', 2, false)) f(field, field_pos, required)
  WHERE (n.node_idx + f.field_pos) % 2 = 0)"""


def _candidates(nodes: DataFrame) -> DataFrame:
    fields = F.explode(F.array(*(F.struct(F.lit(i).alias("k"), F.lit(n).alias("field"), F.col(c).alias("score")) for i, (n, c) in enumerate((("price", "p_price"), ("title", "p_title"), ("note", "p_other"))))))
    rows = nodes.select("page_id", F.col("node_idx").alias("pos"), F.col("node_idx").cast("string").alias("node_id"), "text", "x", "y", "w", "h", fields.alias("f"))
    return rows.where((F.col("pos") + F.col("f.k")) % 2 == 0).select("page_id", "f.field", "pos", "node_id", "text", "f.score", "x", "y", "w", "h")


@query("declarative_assign", f"""WITH {NODES_SQL}, {CANDIDATES_SQL}, ok AS (
  SELECT *, CASE field WHEN 'price' THEN contains(text, '£') WHEN 'title' THEN y / max(y + h) OVER (PARTITION BY page_id) <= 0.5 ELSE contains(text, '/') END AS ok FROM cands),
best AS (
  SELECT page_id, field, field_pos, required, arg_min(pos, (-score, pos)) AS top, max(score) AS top_score,
    arg_min(pos, (-score, pos)) FILTER (WHERE ok) AS good, max(score) FILTER (WHERE ok) AS good_score FROM ok GROUP BY ALL),
every AS (SELECT DISTINCT b.page_id, f.* FROM best b, (VALUES ('price', 0, true), ('title', 1, true), ('note', 2, false)) f(field, field_pos, required)),
state AS (
  SELECT e.page_id, e.field, e.required, b.top, b.top_score, b.good, b.good_score,
    coalesce(bool_or(e.required AND b.top IS NOT NULL AND b.good IS NULL) OVER (PARTITION BY e.page_id ORDER BY e.field_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS broken
  FROM every e LEFT JOIN best b ON b.page_id = e.page_id AND b.field = e.field),
chosen AS (SELECT *, CASE WHEN NOT broken AND good IS NOT NULL THEN good WHEN required THEN top END AS pos, CASE WHEN NOT broken AND good IS NOT NULL THEN good_score WHEN required THEN top_score END AS score FROM state)
SELECT c.page_id, c.field, CAST(c.pos AS VARCHAR) AS node_id, n.text, round(coalesce(c.score, 0.0), 6) AS confidence
FROM chosen c LEFT JOIN nodes n ON n.page_id = c.page_id AND n.node_idx = c.pos""")
def declarative_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(declarative.solve(_candidates(page_nodes(spark, sf_dir)), declarative.Schema.from_dict(SCHEMA)), "confidence")


@query("engine_stability", f"""WITH {NODES_SQL}, {CANDIDATES_SQL}, r AS (
  SELECT page_id, field, score, row_number() OVER (PARTITION BY page_id, field ORDER BY score DESC) AS k FROM cands),
top AS (SELECT page_id, field, greatest(0.0, max(score) FILTER (WHERE k = 1) - greatest(0.0, coalesce(max(score) FILTER (WHERE k = 2), 0.0))) AS lead, count(*) AS n FROM r GROUP BY ALL)
SELECT page_id, round(sum(lead) / sum(n), 6) AS sigma FROM top GROUP BY page_id""")
def engine_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(declarative.stability(_candidates(page_nodes(spark, sf_dir))), "sigma")


#: A label for each node, by its line.
def _labelled(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("label", F.when(F.col("tag") == "h1", "title").when(F.col("text").contains("£"), "price").when(F.col("tag") == "blink", "none").otherwise("other"))


NODE_LABEL_SQL = "labelled AS (SELECT *, CASE WHEN tag = 'h1' THEN 'title' WHEN contains(text, '£') THEN 'price' WHEN tag = 'blink' THEN 'none' ELSE 'other' END AS label FROM nodes)"


@query("label_counts", f"""WITH {NODES_SQL}, {NODE_LABEL_SQL}, c AS (
  SELECT page_id, CAST(count(*) FILTER (WHERE label = 'title') AS BIGINT) AS titles, CAST(count(*) FILTER (WHERE label = 'price') AS BIGINT) AS prices,
    CAST(count(*) FILTER (WHERE label NOT IN ('title', 'price')) AS BIGINT) AS others FROM labelled GROUP BY page_id) SELECT *, titles = 1 AND prices = 1 AS saveable FROM c""")
def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.label_counts(_labelled(page_nodes(spark, sf_dir)))


@query("saveable_pages", f"WITH {NODES_SQL}, {NODE_LABEL_SQL} SELECT page_id FROM labelled GROUP BY page_id HAVING count(*) FILTER (WHERE label = 'title') = 1 AND count(*) FILTER (WHERE label = 'price') = 1")
def saveable_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.label_counts(_labelled(page_nodes(spark, sf_dir))).where("saveable").select("page_id")


@query("class_recall", f"""WITH {NODES_SQL}, {NODE_LABEL_SQL}, g AS (
  SELECT CASE label WHEN 'price' THEN 0 WHEN 'title' THEN 1 ELSE 2 END AS class, CASE WHEN p_price >= p_title AND p_price >= p_other THEN 0 WHEN p_title >= p_other THEN 1 ELSE 2 END AS guess FROM labelled)
SELECT class, CAST(count(*) AS BIGINT) AS support, CAST(count(*) FILTER (WHERE class = guess) AS BIGINT) AS hits, round(CAST(count(*) FILTER (WHERE class = guess) AS DOUBLE) / count(*), 6) AS recall FROM g GROUP BY class""")
def class_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.array("p_price", "p_title", "p_other")
    rows = _labelled(page_nodes(spark, sf_dir)).select(evaluate.class_of(F.col("label")).alias("truth"), (F.array_position(p, F.array_max(p)) - 1).cast("int").alias("guess"))
    return _round(evaluate.recalls(rows, "truth", "guess"), "recall")


@query("first_labelled", f"""WITH {NODES_SQL}, {NODE_LABEL_SQL} SELECT page_id, arg_min(text, node_idx) FILTER (WHERE label = 'title') AS title, arg_min(text, node_idx) FILTER (WHERE label = 'price') AS price FROM labelled GROUP BY page_id""")
def first_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = lambda k: F.min(F.when(F.col("label") == k, F.struct("node_idx", "text")))["text"]
    return _labelled(page_nodes(spark, sf_dir)).groupBy("page_id").agg(first("title").alias("title"), first("price").alias("price"))


@query("quality_recall", """SELECT quality AS class, CAST(count(*) AS BIGINT) AS support, CAST(count(*) FILTER (WHERE guess = quality) AS BIGINT) AS hits, round(CAST(count(*) FILTER (WHERE guess = quality) AS DOUBLE) / count(*), 6) AS recall
FROM (SELECT quality, CASE WHEN n_chars >= 200 THEN 1 ELSE 0 END AS guess FROM labels JOIN documents USING (doc_id)) GROUP BY quality""")
def quality_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id").select(F.col("quality").alias("truth"), (F.col("n_chars") >= 200).cast("int").alias("guess"))
    return _round(evaluate.recalls(rows, "truth", "guess"), "recall")
