"""Readers: JSON collections, url indexes, sitemaps, robots files, page artifacts, HTML and models of pages."""

from __future__ import annotations

import gzip
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.functions import urls as u

URL_RECORD = "url string, namespace string, Confirmed boolean, lastmod string, page_template_type string, last_scraped string"
_SITEMAP = "url array<struct<loc:string,lastmod:string>>, sitemap array<struct<loc:string>>"


def json_records(spark: SparkSession, path: str, schema: str = URL_RECORD) -> DataFrame:
    """Records of a file or folder: `.jsonl` by lines, `.json` as an array or one object; blank urls go.

    A missing path raises.
    """
    if path.endswith(".jsonl"):
        rows = spark.read.schema(schema).json(path)
    elif path.endswith(".json"):
        rows = spark.read.schema(schema).json(path, multiLine=True)
    else:
        lines = spark.read.schema(schema).json(path, pathGlobFilter="*.jsonl")
        whole = spark.read.schema(schema).json(path, pathGlobFilter="*.json", multiLine=True)
        rows = whole.unionByName(lines)
    return rows.where(F.coalesce("url", F.lit("")) != "")


def url_index(spark: SparkSession, path: str) -> DataFrame:
    """An index file, as an envelope or a bare list; the last row of a url counts; malformed gives none."""
    text = spark.read.text(path, wholetext=True)
    record = "array<struct<url:string,namespace:string,Confirmed:boolean,lastmod:string,page_template_type:string,last_scraped:string>>"
    rows = F.coalesce(F.from_json("value", f"struct<urls:{record}>")["urls"], F.from_json("value", record))
    flat = text.select(F.posexplode(rows).alias("seq", "r")).where(F.coalesce("r.url", F.lit("")) != "")
    return flat.groupBy("r.url").agg(F.max_by("r", "seq").alias("r")).select("r.*")


def done_urls(spark: SparkSession, path: str) -> DataFrame:
    """Urls of an output file of documents; lines that aren't JSON are skipped."""
    rows = spark.read.option("mode", "DROPMALFORMED").schema("url string").json(path)
    return rows.where(F.col("url").isNotNull()).distinct()


def ungzip(raw: Column) -> Column:
    """Bytes, decompressed where they begin as gzip does."""

    @F.pandas_udf("binary")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda b: gzip.decompress(b) if b is not None and b[:2] == b"\x1f\x8b" else b)

    return F.when(F.substring(raw, 1, 2) == F.lit(b"\x1f\x8b"), run(raw)).otherwise(raw)


def sitemap_entries(documents: DataFrame) -> DataFrame:
    """(sitemap, loc, lastmod) of documents (sitemap, xml): what a urlset lists; blank locations go."""
    parsed = documents.select("sitemap", F.from_xml("xml", _SITEMAP).alias("x"))
    return parsed.select("sitemap", F.explode("x.url").alias("e")).select("sitemap", F.trim("e.loc").alias("loc"), F.trim("e.lastmod").alias("lastmod")).where("loc <> ''")


def sitemap_children(documents: DataFrame) -> DataFrame:
    """(sitemap, child) of what a sitemap index lists."""
    parsed = documents.select("sitemap", F.from_xml("xml", _SITEMAP).alias("x"))
    return parsed.select("sitemap", F.explode("x.sitemap").alias("e")).select("sitemap", F.trim("e.loc").alias("child")).where("child <> ''")


def robots_sitemaps(documents: DataFrame, fallback: str) -> DataFrame:
    """(site, sitemap) named by robots files (site, text); the fallback where none is."""
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\\r?\\n"), lambda x: F.lower(F.trim(x)).startswith("sitemap:"))
    named = F.filter(F.transform(lines, lambda x: F.trim(F.regexp_replace(x, "^[^:]*:", ""))), lambda x: x != "")
    return documents.select("site", F.explode(F.when(F.size(named) > 0, named).otherwise(F.array(F.lit(fallback)))).alias("sitemap"))


def labelled_pages(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, node_idx, id, text, tag, x, y, w, h, label) of a file of labelled pages."""
    schema = "url string, nodes array<struct<id:string,text:string,tag:string,bbox:array<double>,label:string>>"
    return nodes_of(spark.read.schema(schema).json(path, multiLine=True).select(F.col("url").alias("page_id"), "nodes"), label=True)


def nodes_of(pages: DataFrame, label: bool = False) -> DataFrame:
    """One row for each element of `nodes`; a box with fewer than four sides is all zero."""
    side = lambda i: F.when(F.size("n.bbox") >= 4, F.get("n.bbox", F.lit(i))).otherwise(0.0)
    more = [F.coalesce("n.label", F.lit("other")).alias("label")] if label else []
    return pages.select("page_id", F.posexplode("nodes").alias("node_idx", "n")).select("page_id", "node_idx", "n.id", "n.text", "n.tag", *(side(i).alias(c) for i, c in enumerate("xywh")), *more)


def offline_pages(spark: SparkSession, path: str) -> DataFrame:
    """(ordinal, url, title, price, synthetic, nodes) of a file that maps urls to pages, in its order."""
    page = "struct<title:string,price:string,synthetic:boolean,nodes:array<struct<id:string,text:string,tag:string,bbox:array<double>>>>"
    text = spark.read.text(path, wholetext=True)
    return text.select(F.posexplode(F.map_entries(F.from_json("value", f"map<string,{page}>"))).alias("ordinal", "e")).select("ordinal", F.col("e.key").alias("url"), "e.value.*")


def acquire(requests: DataFrame, pages: DataFrame) -> DataFrame:
    """Each requested url with its page, or with the first one if it isn't there; nulls where there is no page."""
    first = F.broadcast(pages.orderBy("ordinal").limit(1).select(F.struct(*pages.columns).alias("first")))
    hit = requests.select("url").join(pages.withColumnRenamed("url", "p_url"), F.col("url") == F.col("p_url"), "left").join(first, F.lit(True), "left")
    return hit.select("url", *(F.when(F.col("p_url").isNull(), F.col(f"first.{c}")).otherwise(F.col(c)).alias(c) for c in pages.columns if c != "url"))


def mock_page(spark: SparkSession) -> DataFrame:
    """The page of five nodes that stands in where no page can be had."""
    rows = [
        ("mock", 0, "101", "Tipping the Velvet", "h1", 200.0, 50.0, 600.0, 40.0), ("mock", 1, "102", "£53.74", "p", 200.0, 120.0, 100.0, 30.0),
        ("mock", 2, "103", "Contact us | Privacy Policy", "footer", 10.0, 950.0, 1000.0, 50.0), ("mock", 3, "104", "Similar product £12.99", "div", 800.0, 920.0, 200.0, 40.0),
        ("mock", 4, "105", "Add to basket", "button", 200.0, 200.0, 150.0, 40.0),
    ]
    return spark.createDataFrame(rows, "page_id string, node_idx int, id string, text string, tag string, x double, y double, w double, h double")


def _unwrap(v: Column) -> Column:
    """A value of a linked-data key: itself, or its `@value`; other objects give null."""
    return F.coalesce(F.try_variant_get(v, "$.@value", "string"), F.when(~F.schema_of_variant(v).startswith("OBJECT"), F.try_variant_get(v, "$", "string")))


def artifact_nodes(artifacts: DataFrame) -> DataFrame:
    """(artifact_id, node_idx, text, tag, x, y, w, h) of linked-data documents (artifact_id, doc).

    Nodes are elements with bounds, in document order, at the top or inside one nested graph. Bounds are
    `x,y,w,h` text, a rectangle, or the id of one in the document; a node without four numbers goes.
    The documents are read once: ids and references meet in one window, so artifacts that are dealt by
    their id already aren't dealt again.
    """
    graph = F.try_variant_get(F.try_parse_json("doc"), "$.@graph", "array<variant>")
    nested = lambda g: F.try_variant_get(g, "$.@graph", "array<variant>")
    items = artifacts.select("artifact_id", F.posexplode(graph).alias("outer", "g")).select(
        "artifact_id", "outer", F.posexplode(F.coalesce(nested("g"), F.array("g"))).alias("inner", "item")
    )
    fields = items.select("artifact_id", "outer", "inner", F.try_variant_get("item", "$", "map<string,variant>").alias("m")).where("m IS NOT NULL")
    value = lambda suffix: F.get(F.filter(F.map_entries("m"), lambda e: e["key"].endswith(suffix)), F.lit(0))["value"]
    number = lambda suffix: _unwrap(value(suffix)).try_cast("double")
    flat = fields.select(
        "artifact_id", "outer", "inner", F.try_variant_get(F.try_element_at("m", F.lit("@id")), "$", "string").alias("iri"), _unwrap(value("text")).alias("text"), _unwrap(value("htmlTagName")).alias("tag"),
        value("bounds").alias("bounds"), F.array(number("positionX"), number("positionY"), number("width"), number("height")).alias("rect"),
    )
    bound_text = F.when(~F.schema_of_variant("bounds").startswith("OBJECT"), F.try_variant_get("bounds", "$", "string"))
    ref = F.coalesce(F.try_variant_get("bounds", "$.@id", "string"), bound_text)
    # an element stands once under its own id and once, if it has bounds, under the one that it refers to
    held, asks = F.struct(F.col("iri").alias("key"), F.col("rect")), F.struct(ref.alias("key"), F.lit(None).cast("array<double>").alias("rect"))
    roles = F.filter(F.array(F.when(F.col("iri").isNotNull(), held), F.when(F.col("bounds").isNotNull(), asks)), lambda r: r.isNotNull())
    met = flat.select("artifact_id", "outer", "inner", "text", "tag", bound_text.alias("bound_text"), F.explode(roles).alias("r")).select(
        "artifact_id", "outer", "inner", "bound_text", "r.key", "r.rect", *(F.when(F.col("r.rect").isNull(), F.col(c)).alias(c) for c in ("text", "tag"))
    )
    order = F.struct("outer", "inner")
    last = F.max_by("rect", F.when(F.col("rect").isNotNull(), order)).over(Window.partitionBy("artifact_id", "key"))
    nodes = met.withColumn("found", last).where("rect IS NULL")
    parts = F.split(F.trim("bound_text"), r"[,\s]+")
    typed = F.when(F.size(parts) == 4, F.transform(parts, lambda s: s.try_cast("double")))
    whole = lambda a: F.when(~F.exists(a, lambda v: v.isNull()), a)
    kept = nodes.withColumn("box", F.coalesce(whole(typed), whole(F.col("found")))).where("box IS NOT NULL")
    idx = F.row_number().over(Window.partitionBy("artifact_id").orderBy(order)) - 1
    return kept.select("artifact_id", idx.cast("int").alias("node_idx"), "text", "tag", *(F.col("box")[i].alias(c) for i, c in enumerate("xywh")))


#: The size of a page that doesn't tell its own.
PAGE_SIZE = (1920.0, 1080.0)


def page_size(artifacts: DataFrame) -> DataFrame:
    """(artifact_id, width, height) of the first element whose type ends in `Page`, in document order.

    A side that is missing, zero or no number is that of PAGE_SIZE; so are both without such an element.
    """
    graph = F.try_variant_get(F.try_parse_json("doc"), "$.@graph", "array<variant>")
    nested = F.try_variant_get("g", "$.@graph", "array<variant>")
    items = artifacts.select("artifact_id", F.posexplode(graph).alias("outer", "g")).select("artifact_id", "outer", F.posexplode(F.coalesce(nested, F.array("g"))).alias("inner", "item"))
    fields = items.select("artifact_id", "outer", "inner", F.try_variant_get("item", "$", "map<string,variant>").alias("m")).where("m IS NOT NULL")
    side = lambda suffix: F.nullif(_unwrap(F.get(F.filter(F.map_entries("m"), lambda e: e["key"].endswith(suffix)), F.lit(0))["value"]).try_cast("double"), F.lit(0.0))
    pages = fields.where(_unwrap(F.try_element_at("m", F.lit("@type"))).endswith("Page"))
    first = pages.groupBy(F.col("artifact_id").alias("p_artifact")).agg(F.min_by(F.struct(side("width").alias("w"), side("height").alias("h")), F.struct("outer", "inner")).alias("s"))
    hit = artifacts.select("artifact_id").join(first, F.col("artifact_id") == F.col("p_artifact"), "left")
    return hit.select("artifact_id", F.coalesce("s.w", F.lit(PAGE_SIZE[0])).alias("width"), F.coalesce("s.h", F.lit(PAGE_SIZE[1])).alias("height"))


def artifact_for(artifacts: DataFrame, source_url: str, base: str) -> DataFrame:
    """(uri) of the last artifact (ordinal, id, source_url) of a url; the prefix `r:` is written out."""
    uri = F.regexp_replace("id", "^r:", base)
    return artifacts.where(F.col("source_url") == source_url).agg(F.max_by(uri, "ordinal").alias("uri")).where("uri IS NOT NULL")


def repository_id(repositories: DataFrame, description: str) -> DataFrame:
    """(id) of the first repository (ordinal, id, description) with that description."""
    return repositories.where(F.col("description") == description).agg(F.min_by("id", "ordinal").alias("id")).where("id IS NOT NULL")


def history_file(spark: SparkSession, path: str) -> DataFrame:
    """(seq, sigma) of a history file, `{"scores": [...]}` or a bare list; anything else gives none."""
    text = spark.read.text(path, wholetext=True)
    scores = F.coalesce(F.from_json("value", "struct<scores:array<double>>")["scores"], F.from_json("value", "array<double>"))
    return text.select(F.posexplode(scores).alias("seq", "sigma")).where("sigma IS NOT NULL")


def queue_file(spark: SparkSession, path: str) -> DataFrame:
    """Relabelling requests as the queue writes them; lines that aren't JSON are skipped."""
    schema = "page_url string, stability_score double, reason string, timestamp_utc string"
    return spark.read.option("mode", "DROPMALFORMED").schema(schema).json(path)


def bare_html(html: Column) -> Column:
    """HTML without comments, scripts and styles."""
    return F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>", " ")


def hrefs(html: Column) -> Column:
    """Values of quoted href attributes of anchors, in order."""
    return F.regexp_extract_all(bare_html(html), F.lit(r"(?i)<a\s[^>]*?href\s*=\s*[\"']([^\"']*)[\"']"), F.lit(1))


def links(html: Column, base: Column, keep: Callable[[Column], Column] | None = None) -> Column:
    """Distinct link targets in order of first sight, resolved, those that `keep` accepts."""
    found = F.transform(hrefs(html), lambda h: u.resolve(base, h))
    return F.array_distinct(F.filter(found, keep) if keep else found)


_NEXT = (
    r"(?is)<link\b(?=[^>]*\brel\s*=\s*[\"']?next\b)[^>]*?\bhref\s*=\s*[\"']([^\"']+)",
    r"(?is)<a\b(?=[^>]*\brel\s*=\s*[\"']?next\b)[^>]*?\bhref\s*=\s*[\"']([^\"']+)",
    r"(?is)<a\b(?=[^>]*\bclass\s*=\s*[\"'][^\"']*\bpagination__next\b)[^>]*?\bhref\s*=\s*[\"']([^\"']+)",
    r"(?is)<a\b(?=[^>]*\bclass\s*=\s*[\"'][^\"']*\bnext_page\b)[^>]*?\bhref\s*=\s*[\"']([^\"']+)",
    r"(?is)<a\b[^>]*?\bhref\s*=\s*[\"']([^\"']+)[\"'][^>]*>\s*(?:next|next page|next ›|›)\s*</a>",
)


def next_page(html: Column, base: Column) -> Column:
    """The following page of a listing: a next link, a next class, or an anchor that says so; else null."""
    text = bare_html(html)
    found = F.coalesce(*(F.nullif(F.regexp_extract(text, p, 1), F.lit("")) for p in _NEXT))
    return F.when(found.isNotNull(), u.resolve(base, found))


class _Anchors(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag == "a" and dict(attrs).get("href") is not None:
            self.found.append(dict(attrs)["href"])


def parsed_hrefs(html: Column) -> Column:
    """As `hrefs`, by a real parser: also unquoted attributes and entities."""

    @F.pandas_udf("array<string>")
    def run(pages: pd.Series) -> pd.Series:
        def one(text: str | None) -> list[str]:
            p = _Anchors()
            p.feed(text or "")
            return p.found

        return pages.map(one)

    return run(html)


def fetch(requests: DataFrame, get: Callable[[str], bytes], attempts: int = 5, wait: float = 4.0, delay: float = 0.5) -> DataFrame:
    """(url, body, error) by a function that gets a url: waits grow by powers, failures become rows."""
    import time

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for url in f["url"]:
                body, error = None, None
                for i in range(attempts):
                    try:
                        body, error = get(url), None
                        break
                    except Exception as e:  # a connector may fail in any way
                        error = f"{type(e).__name__}: {e}"
                        if i + 1 < attempts:
                            time.sleep(wait**i)
                out.append((url, body, error))
                time.sleep(delay)
            yield pd.DataFrame(out, columns=["url", "body", "error"])

    return requests.select("url").mapInPandas(run, "url string, body binary, error string")


def fetch_missing(requests: DataFrame, cache: DataFrame, get: Callable[[str], bytes], **how) -> DataFrame:
    """Bodies from the cache (url, body); only urls that it lacks are fetched."""
    missing = requests.select("url").distinct().join(cache.select("url"), "url", "left_anti")
    hit = requests.select("url").distinct().join(cache.select("url", "body"), "url")
    return hit.select("url", "body", F.lit(None).cast("string").alias("error")).unionByName(fetch(missing, get, **how))
