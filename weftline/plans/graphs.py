"""Queries over page graphs and node features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators import features, gcn, graph
from weftline.plans.registry import query
from weftline.sources.bridge import NODES_SQL, page_nodes, table

EDGES_SQL = f"""{NODES_SQL},
pairs AS (
  SELECT a.page_id, a.node_idx AS i, b.node_idx AS j, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) AS d2,
    a.x <= b.x AND a.y <= b.y AND a.x + a.w >= b.x + b.w AND a.y + a.h >= b.y + b.h AS holds
  FROM nodes a JOIN nodes b ON a.page_id = b.page_id AND a.node_idx <> b.node_idx
), near AS (SELECT page_id, i, j FROM pairs QUALIFY row_number() OVER (PARTITION BY page_id, i ORDER BY d2, j) <= 3),
knn AS (SELECT page_id, i AS src, j AS dst FROM near UNION SELECT page_id, j, i FROM near),
inside AS (SELECT page_id, i AS src, j AS dst FROM pairs WHERE holds UNION SELECT page_id, j, i FROM pairs WHERE holds),
joint AS (SELECT * FROM knn UNION SELECT * FROM inside),
graph AS (SELECT * FROM joint UNION ALL SELECT DISTINCT page_id, 0, 0 FROM nodes WHERE page_id NOT IN (SELECT page_id FROM joint)),
full_graph AS (SELECT * FROM graph UNION SELECT page_id, node_idx, node_idx FROM nodes),
degree AS (SELECT page_id, dst AS node, count(*) AS d FROM full_graph GROUP BY ALL),
norm AS (SELECT g.page_id, src, dst, 1 / sqrt(CAST(a.d AS DOUBLE) * b.d) AS weight FROM full_graph g JOIN degree a ON a.page_id = g.page_id AND a.node = g.dst JOIN degree b ON b.page_id = g.page_id AND b.node = g.src)"""


@query("knn_edges", f"WITH {EDGES_SQL} SELECT * FROM knn")
def knn_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.knn_edges(page_nodes(spark, sf_dir))


@query("containment_edges", f"WITH {EDGES_SQL} SELECT * FROM inside")
def containment_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.containment_edges(page_nodes(spark, sf_dir))


@query("page_graph", f"WITH {EDGES_SQL} SELECT * FROM graph")
def page_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.page_graph(page_nodes(spark, sf_dir))


@query("gcn_norm", f"WITH {EDGES_SQL} SELECT page_id, src, dst, round(weight, 6) AS weight FROM norm")
def gcn_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = page_nodes(spark, sf_dir)
    return graph.normalized(nodes, graph.page_graph(nodes)).withColumn("weight", F.round("weight", 6))


@query("gcn_propagate", f"""WITH {EDGES_SQL}, vals AS (SELECT page_id, node_idx, 0 AS dim, x / 1200 AS value FROM nodes UNION ALL SELECT page_id, node_idx, 1, y / 2400 FROM nodes)
SELECT n.page_id, n.dst AS node_idx, dim, round(sum(weight * value), 10) AS value FROM norm n JOIN vals v ON v.page_id = n.page_id AND v.node_idx = n.src GROUP BY ALL""")
def gcn_propagate(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = page_nodes(spark, sf_dir)
    v = nodes.select("page_id", "node_idx", F.posexplode(F.array(F.col("x") / 1200, F.col("y") / 2400)).alias("dim", "value"))
    return graph.propagate(v, graph.normalized(nodes, graph.page_graph(nodes))).withColumn("value", F.round("value", 10))


@query("text_hash", """WITH c AS (SELECT doc_id, trim(lower(coalesce(text, '')), E' \\t\\n\\r\\x0b\\x0c') AS t FROM documents),
p AS (SELECT doc_id, t, unnest(range(1, length(t))) AS i FROM c),
g AS (SELECT doc_id, (ord(substr(t, CAST(i AS INTEGER), 1)) * 31 + ord(substr(t, CAST(i + 1 AS INTEGER), 1))) % 128 AS b2,
  CASE WHEN i + 2 <= length(t) THEN ((ord(substr(t, CAST(i AS INTEGER), 1)) % 128) * 961 + (ord(substr(t, CAST(i + 1 AS INTEGER), 1)) % 128) * 31 + ord(substr(t, CAST(i + 2 AS INTEGER), 1))) % 128 END AS b3 FROM p)
SELECT doc_id, CAST(b AS INTEGER) AS bucket, CAST(count(*) AS BIGINT) AS n FROM (SELECT doc_id, b2 AS b FROM g UNION ALL SELECT doc_id, b3 FROM g WHERE b3 IS NOT NULL) GROUP BY ALL""")
def text_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.text_buckets(table(spark, sf_dir, "documents"), "doc_id")


@query("visual_features", f"WITH {NODES_SQL} SELECT page_id, node_idx, round(x / 1200, 6) AS fx, round(y / 2400, 6) AS fy, round(w / 1200, 6) AS fw, round(h / 2400, 6) AS fh FROM nodes")
def visual_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = features.visual()
    return page_nodes(spark, sf_dir).select("page_id", "node_idx", *(F.round(v[i], 6).alias(c) for i, c in enumerate(("fx", "fy", "fw", "fh"))))


@query("tag_onehot", f"""WITH {NODES_SQL}, t AS (SELECT page_id, node_idx, CASE lower(tag) WHEN 'div' THEN 0 WHEN 'span' THEN 1 WHEN 'p' THEN 4 WHEN 'h1' THEN 5 ELSE 13 END AS place FROM nodes)
SELECT page_id, node_idx, place, CAST(1.0 AS DOUBLE) AS value FROM t""")
def tag_onehot(spark: SparkSession, sf_dir: str) -> DataFrame:
    hot = page_nodes(spark, sf_dir).select("page_id", "node_idx", F.posexplode(features.tag_onehot(F.col("tag"))).alias("place", "value"))
    return hot.where("value <> 0")


@query("gcn_scores")
def gcn_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = page_nodes(spark, sf_dir)
    return gcn.score(features.vectors(nodes), graph.page_graph(nodes), gcn.Weights.random(0))


@query("embedding_centroid_margin", """WITH e AS (SELECT vec_id, label, generate_subscripts(embedding, 1) AS dim, unnest(embedding) AS v FROM embeddings),
c AS (SELECT label, dim, avg(CAST(v AS DOUBLE)) AS m FROM e GROUP BY ALL),
s AS (SELECT e.vec_id, c.label, sum(CAST(e.v AS DOUBLE) * c.m) AS s FROM e JOIN c USING (dim) GROUP BY ALL)
SELECT vec_id, round(max(s) - (list_sort(list(s), 'DESC'))[2], 5) AS margin FROM s GROUP BY vec_id""")
def embedding_centroid_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gap between a vector's two best class means (one row a class and dimension is broadcast)."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.posexplode("embedding").alias("dim", "v"))
    means = e.groupBy("label", "dim").agg(F.avg(F.col("v").cast("double")).alias("m")).groupBy("dim").agg(F.collect_list(F.struct("label", "m")).alias("ms"))
    s = e.select("vec_id", "dim", "v").join(means, "dim").select("vec_id", "v", F.explode("ms").alias("c")).groupBy("vec_id", "c.label").agg(F.sum(F.col("v").cast("double") * F.col("c.m")).alias("s"))
    top = F.sort_array(F.collect_list("s"), asc=False)
    return s.groupBy("vec_id").agg(top.alias("top")).select("vec_id", F.round(F.col("top")[0] - F.col("top")[1], 5).alias("margin"))
