"""Page nodes, url indexes and scores over the relational tables: every value is exact in SQL too."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Order of an order's lines: its nodes in document order.
LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate", "l_discount", "l_tax", "l_returnflag", "l_linestatus")


def page_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, node_idx, text, tag, x, y, w, h, p_price, p_title, p_other): orders as pages, lines as nodes."""
    # named before the window, so that later operators find its partitioning by page
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "page_id")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    idx = F.row_number().over(Window.partitionBy("page_id").orderBy(*LINE_ORDER)) - 1
    kind = F.col("l_linenumber") % 3
    price = F.concat(F.lit("£"), F.floor("l_extendedprice").cast("long").cast("string"), F.lit(".50"))
    text = F.when(kind == 0, price).when(kind == 1, F.coalesce("p_name", F.lit(""))).otherwise(F.concat("l_returnflag", F.lit("/"), "l_linestatus"))
    tag = F.element_at(F.array(*map(F.lit, ("h1", "p", "div", "SPAN", "blink"))), (F.col("l_linenumber") % 5 + 1).cast("int"))
    wp, wt, wo = 1 + F.col("l_partkey") % 7, 1 + F.col("l_suppkey") % 5, 1 + F.col("page_id") % 6
    total = wp + wt + wo
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left").select(
        "page_id", idx.cast("int").alias("node_idx"), text.alias("text"), tag.alias("tag"),
        (F.col("l_partkey") % 1200).cast("double").alias("x"),
        ((F.col("l_suppkey") * 97 + F.col("l_linenumber") * 53) % 1300).cast("double").alias("y"),
        (20 + F.col("l_partkey") % 300).cast("double").alias("w"),
        (10 + F.col("l_suppkey") % 60).cast("double").alias("h"),
        (wp / total).alias("p_price"), (wt / total).alias("p_title"), (wo / total).alias("p_other"),
    )


NODES_SQL = """
nodes AS (
  SELECT l_orderkey AS page_id,
    CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity,
      l_shipdate, l_discount, l_tax, l_returnflag, l_linestatus) - 1 AS INTEGER) AS node_idx,
    CASE l_linenumber % 3 WHEN 0 THEN '£' || CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR) || '.50'
      WHEN 1 THEN coalesce(p_name, '') ELSE l_returnflag || '/' || l_linestatus END AS text,
    CASE l_linenumber % 5 WHEN 0 THEN 'h1' WHEN 1 THEN 'p' WHEN 2 THEN 'div' WHEN 3 THEN 'SPAN' ELSE 'blink' END AS tag,
    CAST(l_partkey % 1200 AS DOUBLE) AS x, CAST((l_suppkey * 97 + l_linenumber * 53) % 1300 AS DOUBLE) AS y,
    CAST(20 + l_partkey % 300 AS DOUBLE) AS w, CAST(10 + l_suppkey % 60 AS DOUBLE) AS h,
    CAST(1 + l_partkey % 7 AS DOUBLE) / (3 + l_partkey % 7 + l_suppkey % 5 + l_orderkey % 6) AS p_price,
    CAST(1 + l_suppkey % 5 AS DOUBLE) / (3 + l_partkey % 7 + l_suppkey % 5 + l_orderkey % 6) AS p_title,
    CAST(1 + l_orderkey % 6 AS DOUBLE) / (3 + l_partkey % 7 + l_suppkey % 5 + l_orderkey % 6) AS p_other
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
)"""


def url_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as rows of a url index, each customer's page being a url."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("seq"),
        F.concat(F.lit("https://index.example/memes/c"), F.col("o_custkey").cast("string")).alias("url"),
        F.when(F.col("o_orderkey") % 5 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("ns"), (F.col("o_custkey") % 7).cast("string"))).alias("namespace"),
        (F.col("o_orderstatus") == "F").alias("Confirmed"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(None).cast("string")).otherwise(day).alias("lastmod"),
        F.when(F.col("o_orderkey") % 4 == 0, "meme").alias("page_template_type"),
        F.when(F.col("o_orderpriority").startswith("1"), day).alias("last_scraped"),
    )


def url_index(spark: SparkSession, sf_dir: str, old: bool) -> DataFrame:
    """(seq, url, namespace, Confirmed, lastmod, page_template_type, last_scraped) over the orders.

    The old index holds each customer's last even order; the new batch all odd ones, so a url can come
    several times, in the order of `seq`.
    """
    rows = url_rows(spark, sf_dir).where(F.col("seq") % 2 == (0 if old else 1))
    if not old:
        return rows
    return rows.groupBy("url").agg(F.max_by(F.struct(*(c for c in rows.columns if c != "url")), "seq").alias("r")).select("r.seq", "url", "r.namespace", "r.Confirmed", "r.lastmod", "r.page_template_type", "r.last_scraped")


INDEX_SQL = """
index_rows AS (
  SELECT o_orderkey AS seq, 'https://index.example/memes/c' || CAST(o_custkey AS VARCHAR) AS url,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'ns' || CAST(o_custkey % 7 AS VARCHAR) END AS namespace,
    o_orderstatus = 'F' AS confirmed,
    CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS lastmod,
    CASE WHEN o_orderkey % 4 = 0 THEN 'meme' END AS page_template_type,
    CASE WHEN o_orderpriority LIKE '1%' THEN strftime(o_orderdate, '%Y-%m-%d') END AS last_scraped
  FROM orders
), old_index AS (
  SELECT * FROM index_rows WHERE seq % 2 = 0 QUALIFY row_number() OVER (PARTITION BY url ORDER BY seq DESC) = 1
), new_batch AS (SELECT * FROM index_rows WHERE seq % 2 = 1)"""
