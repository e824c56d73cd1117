"""Queries over fixtures made from the tables: sitemaps, artifacts, streams, crawls."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators import drift, index as ix
from weftline.plans.extraction import VALUES_SQL, _values
from weftline.plans.registry import query
from weftline.sources import readers, stores
from weftline.sources.bridge import NODES_SQL, page_nodes, table
from weftline.streaming import monitor


@query("sitemap_parse", """SELECT 'map' || CAST(page_id % 10 AS VARCHAR) AS sitemap, url AS loc, CASE WHEN page_id % 3 = 0 THEN '2026-06-01' END AS lastmod FROM pages""")
def sitemap_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page urls written into ten sitemaps and read back."""
    url = F.replace(F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    row = F.concat(F.lit("<url><loc> "), url, F.lit(" </loc>"), F.when(F.col("page_id") % 3 == 0, "<lastmod>2026-06-01</lastmod>").otherwise(""), F.lit("</url>"))
    maps = table(spark, sf_dir, "pages").groupBy(F.concat(F.lit("map"), (F.col("page_id") % 10).cast("string")).alias("sitemap")).agg(F.concat(F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), F.array_join(F.collect_list(row), ""), F.lit("</urlset>")).alias("xml"))
    return readers.sitemap_entries(maps)


@query("sitemap_walk", "SELECT 'root' AS sitemap UNION ALL SELECT DISTINCT 'n' || CAST(n_nationkey AS VARCHAR) FROM nation UNION ALL SELECT DISTINCT 'r' || CAST(r_regionkey AS VARCHAR) FROM region")
def sitemap_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions and their nations as a tree of sitemaps, with a link back to the root."""
    key = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    regions = table(spark, sf_dir, "region").select(F.lit("root").alias("sitemap"), key("r", "r_regionkey").alias("child"))
    nations = table(spark, sf_dir, "nation").select(key("r", "n_regionkey").alias("sitemap"), key("n", "n_nationkey").alias("child"))
    back = nations.select(F.col("child").alias("sitemap"), F.lit("root").alias("child"))
    return ix.walk(regions.unionByName(nations).unionByName(back), spark.createDataFrame([("root",)], "sitemap string"))


@query("jsonld_nodes", f"WITH {NODES_SQL} SELECT page_id AS artifact_id, node_idx, text, tag, x, y, w, h FROM nodes")
def jsonld_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page nodes written as linked-data artifacts and read back; tests hold them to the nodes."""
    n = page_nodes(spark, sf_dir)
    rect = F.concat(F.lit("r"), F.col("node_idx").cast("string"))
    node = F.to_json(F.struct(F.concat(F.lit("n"), F.col("node_idx").cast("string")).alias("@id"), F.col("text").alias("b:text"), F.col("tag").alias("b:htmlTagName"), F.struct(rect.alias("@id")).alias("b:bounds")))
    box = F.to_json(F.struct(rect.alias("@id"), F.struct(F.col("x").alias("@value")).alias("b:positionX"), F.col("y").alias("b:positionY"), F.col("w").alias("b:width"), F.col("h").alias("b:height")))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("node_idx", F.concat(node, F.lit(","), box).alias("j")))), lambda s: s["j"])
    docs = n.groupBy(F.col("page_id").alias("artifact_id")).agg(F.concat(F.lit('{"@graph":[{"@graph":['), F.array_join(listed, ","), F.lit("]}]}")).alias("doc"))
    return readers.artifact_nodes(docs)


@query("crawl_listings")
def crawl_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three listings over the customers' orders, read in turn."""
    o = table(spark, sf_dir, "orders")
    pages = o.groupBy(F.concat(F.lit("list"), (F.col("o_orderkey") % 3).cast("string")).alias("listing"), F.floor(F.col("o_orderkey") / 300).cast("int").alias("page_no")).agg(F.array_sort(F.collect_set(F.concat(F.lit("c"), (F.col("o_custkey") % 500).cast("string")))).alias("links"))
    return ix.crawl(pages, ["list0", "list1", "list2"], spark.createDataFrame([], "url string"))


@query("drift_stream", f"""WITH {VALUES_SQL} SELECT CAST(template AS VARCHAR) AS template, seq, page_url, sigma, round(avg(sigma) OVER (PARTITION BY template ORDER BY seq), 9) AS running_mean, sigma < 0.6 AS alert FROM v""")
def drift_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history of `drift_history` by a stream over the events file, with its result."""
    source = spark.readStream.schema(spark.read.parquet(f"{sf_dir}/events.parquet").schema).parquet(f"{sf_dir}/events.parquet*")
    values = source.select(F.col("event_id").alias("seq"), F.col("user_id").cast("string").alias("template"), F.concat(F.lit("page/"), F.col("event_id").cast("string")).alias("page_url"), (F.pmod(F.floor(F.col("value") * 100).cast("long"), F.lit(1000)) / 1000).alias("sigma"))
    at = stores.scratch(spark, "stream")
    run = monitor.monitored(values).writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema(monitor.OUTPUT).parquet(f"{at}/out").withColumn("running_mean", F.round("running_mean", 9))


@query("drift_daily", """WITH v AS (SELECT date_trunc('day', ts) AS day, CAST(((CAST(floor(value * 100) AS BIGINT) % 1000) + 1000) % 1000 AS DOUBLE) / 1000 AS sigma FROM events)
SELECT strftime(day, '%Y-%m-%d') AS day, round(avg(sigma), 6) AS sigma, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE sigma < 0.6) AS BIGINT) AS alerts FROM v GROUP BY day""")
def drift_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    sigma = F.pmod(F.floor(F.col("value") * 100).cast("long"), F.lit(1000)) / 1000
    rows = table(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day"), sigma.alias("sigma"))
    return rows.groupBy("day").agg(F.round(F.avg("sigma"), 6).alias("sigma"), F.count("*").alias("n"), F.count_if(F.col("sigma") < 0.6).alias("alerts"))


@query("drift_alert_counts", """WITH v AS (SELECT user_id AS template, CAST(((CAST(floor(value * 100) AS BIGINT) % 1000) + 1000) % 1000 AS DOUBLE) / 1000 AS sigma FROM events)
SELECT template, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE sigma < 0.6) AS BIGINT) AS alerts FROM v GROUP BY template""")
def drift_alert_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.history(_values(spark, sf_dir), "template").groupBy("template").agg(F.count("*").alias("n"), F.count_if("alert").alias("alerts"))
