"""The url index: monotonic merges, sitemap diffs, taxonomy, listing crawls, pending work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions import urls as u
from weftline.scratch import written

#: A listing ends after so many pages in a row without a new url.
EMPTY_PAGES = 3
#: A prefix with fewer urls is no namespace.
LEAST_URLS = 2


def record(url: Column, lastmod: Column, prior_scraped: Column, confirmed: Column | None = None, namespaces=u.NAMESPACES) -> Column:
    """A discovery record: confirmed if it has a date, unless told; never a date without confirmation."""
    sure = lastmod.isNotNull() if confirmed is None else F.coalesce(confirmed, lastmod.isNotNull())
    return F.struct(
        url.alias("url"), u.namespace(u.path(url), namespaces).alias("namespace"), sure.alias("Confirmed"),
        F.when(sure, lastmod).alias("lastmod"), F.lit(None).cast("string").alias("page_template_type"), prior_scraped.alias("last_scraped"),
    )


def merge(old: DataFrame, new: DataFrame, present: tuple[str, ...] = ("namespace", "page_template_type"), last_only: bool = False) -> DataFrame:
    """(url, namespace, Confirmed, lastmod, page_template_type, last_scraped, batch_rows, existed).

    Confirmation never goes back. The first scrape time stays; a newer date wins while confirmed, and an
    unconfirmed step forgets it. Columns in `present` take the newest value even if it is null. Rows of
    one url inside the batch apply in the order of `seq`, or with `last_only` only the last one does.

    One exchange by url: the fold is written as aggregates over the steps, not as a loop over lists.
    """
    columns = ["url", "seq", "namespace", F.coalesce("Confirmed", F.lit(False)).alias("Confirmed"), "lastmod", "page_template_type", "last_scraped"]
    before = old.withColumn("seq", F.lit(None).cast("long")).select(*columns, F.lit(0).alias("fresh"))
    batch = new.withColumn("seq", F.col("seq").cast("long")).select(*columns, F.lit(1).alias("fresh"))
    # step 0 is the old row, 1 and up are the batch's; all windows and the aggregate share one exchange
    inside = Window.partitionBy("url").orderBy("fresh", "seq").rowsBetween(Window.unboundedPreceding, 0)
    rows = before.unionByName(batch).withColumn("step", F.sum("fresh").over(inside).cast("int"))
    if last_only:
        rows = rows.withColumn("last", F.max("step").over(Window.partitionBy("url"))).where("step = 0 OR step = last").withColumn("step", F.least("step", F.lit(1)))
    # the step from which dates survive: the first confirmed one; a date of the old row lasts one step more
    since = F.min(F.when(F.col("Confirmed"), F.col("step"))).over(Window.partitionBy("url"))
    rows = rows.withColumn("since", since)
    lives = F.col("lastmod").isNotNull() & ((F.col("step") >= F.col("since")) | ((F.col("step") == 0) & (F.col("since") == 1)))
    newest = lambda c: F.max_by(c, "step") if c in present else F.max_by(c, F.when(F.col("step") == 0, 1).otherwise(0))
    had = F.max(F.when(F.col("step") == 0, 1).otherwise(0)) == 1
    touched = F.count_if(F.col("step") > 0)
    return rows.groupBy("url").agg(
        newest("namespace").alias("namespace"),
        F.max("Confirmed").alias("Confirmed"),
        F.max_by(F.when(lives, F.col("lastmod")), F.when(lives, F.col("step"))).alias("merged"),
        F.max_by("lastmod", F.when(F.col("step") == 0, 0)).alias("own"),
        newest("page_template_type").alias("page_template_type"),
        F.min_by("last_scraped", F.when(F.col("last_scraped").isNotNull(), F.col("step"))).alias("last_scraped"),
        touched.alias("batch_rows"), had.alias("existed"),
    ).select("url", "namespace", "Confirmed", F.when(F.col("batch_rows") == 0, F.col("own")).otherwise(F.col("merged")).alias("lastmod"), "page_template_type", "last_scraped", "batch_rows", "existed")


def merge_stats(merged: DataFrame) -> DataFrame:
    """(added, updated, total): a url's first appearance counts as added, each further row as updated."""
    added = F.sum(F.when(~F.col("existed"), 1).otherwise(0))
    return merged.agg(added.alias("added"), (F.sum("batch_rows") - added).alias("updated"), F.count("*").alias("total"))


def sitemap_diff(old: DataFrame, entries: DataFrame) -> DataFrame:
    """(url, lastmod, Confirmed, change) for sitemap entries (seq, url, lastmod) against the index.

    The last entry of a url counts. An equal date is `skipped`, else the row is `updated` or `added`; a
    missing date erases the old one.
    """
    last = entries.groupBy("url").agg(F.max_by(F.struct("lastmod"), "seq").alias("n"))
    o = old.select(F.col("url").alias("o_url"), F.col("lastmod").alias("o_lastmod"), F.col("Confirmed").alias("o_confirmed"))
    both = last.join(o, F.col("url") == F.col("o_url"), "left")
    seen = F.col("o_url").isNotNull()
    new = F.col("n.lastmod")
    change = F.when(seen & new.eqNullSafe(F.col("o_lastmod")), "skipped").when(seen, "updated").otherwise("added")
    sure = F.coalesce("o_confirmed", F.lit(False)) | new.isNotNull()
    return both.select("url", new.alias("lastmod"), F.when(change == "skipped", F.coalesce("o_confirmed", F.lit(False))).otherwise(sure).alias("Confirmed"), change.alias("change"))


def taxonomy(urls: DataFrame, least: int = LEAST_URLS, always: str | None = "/memes/") -> DataFrame:
    """(prefix, namespace, urls): path prefixes of `least` urls or more; `always` is added if missing."""
    segs = u.path_segments(F.rtrim(F.col("url"), F.lit("/")))
    prefix = F.concat(F.lit("/"), F.array_join(F.slice(segs, F.lit(1), F.greatest(F.size(segs) - 1, F.lit(0))), "/"), F.lit("/"))
    counted = urls.where(F.size(segs) >= 2).groupBy(prefix.alias("prefix")).agg(F.count("*").alias("urls")).where(F.col("urls") >= least)
    if always:
        extra = urls.sparkSession.createDataFrame([(always, 0)], "prefix string, urls long")
        counted = counted.unionByName(extra.join(counted, "prefix", "left_anti"))
    return counted.select("prefix", F.btrim("prefix", F.lit("/")).alias("namespace"), "urls")


def longest_prefix(urls: DataFrame, prefixes: DataFrame) -> DataFrame:
    """(url, namespace): the longest of `prefixes` (prefix, namespace) that the path starts with.

    Each path is exploded into its own prefixes, so the join is on equality and scales with both sides.
    """
    segs = u.path_segments(F.rtrim(F.col("url"), F.lit("/")))
    own = F.transform(F.sequence(F.lit(1), F.greatest(F.size(segs) - 1, F.lit(1))), lambda i: F.concat(F.lit("/"), F.array_join(F.slice(segs, F.lit(1), i), "/"), F.lit("/")))
    long = urls.select("url", F.explode(own).alias("prefix")).join(prefixes.select("prefix", "namespace"), "prefix", "left")
    return long.groupBy("url").agg(F.max_by("namespace", F.when(F.col("namespace").isNotNull(), F.char_length("prefix"))).alias("namespace"))


def namespace_breakdown(index: DataFrame) -> DataFrame:
    return index.groupBy(F.coalesce("namespace", F.lit("unknown")).alias("namespace")).agg(
        F.count("*").alias("total"), F.count_if(F.col("Confirmed")).alias("confirmed"), F.count_if(F.col("lastmod").isNull()).alias("undated")
    )


def listings(urls: DataFrame, site: u.Site, defaults=u.LISTINGS) -> DataFrame:
    """(path, confirmed): the default listings and the status pages that the corpus shows."""
    segs = u.path_segments(F.rtrim(F.col("url"), F.lit("/")))
    first, second = F.try_element_at(segs, F.lit(1)), F.try_element_at(segs, F.lit(2))
    seen = urls.where((F.size(segs) == 2) & first.isin(*site.roots) & second.isin(*site.categories)).select(F.concat(F.lit("/"), F.array_join(segs, "/")).alias("path"), F.lit(False).alias("confirmed")).distinct()
    base = urls.sparkSession.createDataFrame([*defaults], "path string, confirmed boolean")
    return base.unionByName(seen.join(base.select("path"), "path", "left_anti"))


def listing_stop(pages: DataFrame, limit: int = EMPTY_PAGES) -> DataFrame:
    """The pages of each listing (listing, page_no, new_urls) that are read: up to `limit` empty ones in a row."""
    w = Window.partitionBy("listing").orderBy("page_no")
    empty = F.sum(F.when(F.col("new_urls") == 0, 1).otherwise(0)).over(w.rowsBetween(1 - limit, 0)) == limit
    before = F.coalesce(F.max(F.col("stops").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return pages.withColumn("stops", empty).withColumn("after", before).where("after = 0").select("listing", "page_no", "new_urls", "stops")


def first_seen(links: DataFrame) -> DataFrame:
    """(listing, page_no, url) of the first page by (listing order, page) that shows each url."""
    return links.groupBy("url").agg(F.min(F.struct("listing", "page_no")).alias("f")).select("f.listing", "f.page_no", "url")


def crawl(pages: DataFrame, order: list[str], seen: DataFrame, limit: int = EMPTY_PAGES) -> DataFrame:
    """(listing, page_no, url) found by reading the listings in turn, each until it stops giving new urls.

    Listings depend on one another, as urls past a stop stay unseen for the next listing, so the driver
    goes through the few listings; inside one everything is a set operation.
    """
    found = None
    known = seen.select("url")
    for name in order:
        links = pages.where(F.col("listing") == name).select("page_no", F.explode_outer("links").alias("url"))
        first = links.where(F.col("url").isNotNull()).groupBy("url").agg(F.min("page_no").alias("page_no")).join(known, "url", "left_anti")
        counts = pages.where(F.col("listing") == name).select("listing", "page_no").join(first.groupBy("page_no").agg(F.count("*").alias("n")), "page_no", "left")
        read = listing_stop(counts.select("listing", "page_no", F.coalesce("n", F.lit(0)).alias("new_urls")), limit)
        mine = first.join(read.select("page_no"), "page_no", "left_semi").select(F.lit(name).alias("listing"), "page_no", "url")
        found = mine if found is None else found.unionByName(mine)
        known = known.unionByName(mine.select("url"))
    return found


def walk(tree: DataFrame, roots: DataFrame) -> DataFrame:
    """(sitemap) reachable from `roots` over (sitemap, child), each once, however deep; a frontier is joined at a time.

    Frontiers are written, so neither plans nor memory grow with the depth.
    """
    seen = frontier = written(roots.select("sitemap").distinct(), "frontier")
    while not (frontier := written(tree.join(frontier, "sitemap").select(F.col("child").alias("sitemap")).distinct().join(seen, "sitemap", "left_anti"), "frontier")).isEmpty():
        seen = seen.unionByName(frontier)
    return seen


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """`rows` with `place`, from 1 in the given order, for any size: ranges are sorted side by side.

    One row for each range, so never more than there are partitions, is summed up.
    """
    ranged = written(rows.orderBy(*order).withColumn("at", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("at", 33)
    counts = ranged.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = counts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return ranged.withColumn("part", part).join(F.broadcast(before), "part").select(*rows.columns, (F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias("place"))


def summary(index: DataFrame) -> DataFrame:
    """(total, namespaces, confirmed): counts of an index; a null namespace is `unknown`."""
    return index.agg(F.count("*").alias("total"), F.countDistinct(F.coalesce("namespace", F.lit("unknown"))).alias("namespaces"), F.count_if(F.col("Confirmed")).alias("confirmed"))


def pending(records: DataFrame, done: DataFrame | None = None, only_confirmed: bool = True, force: bool = False) -> DataFrame:
    """Records still to annotate: with a url, not done or scraped unless forced, confirmed if asked."""
    rows = records.where(F.coalesce("url", F.lit("")) != "")
    if only_confirmed:
        rows = rows.where(F.coalesce("Confirmed", F.lit(False)))
    if not force:
        rows = rows.where(F.coalesce("last_scraped", F.lit("")) == "")
        if done is not None:
            rows = rows.join(done.select("url"), "url", "left_anti")
    return rows


def stamp(index: DataFrame, annotations: DataFrame) -> DataFrame:
    """The index with scrape time and template of its annotated urls; annotations of other urls do nothing."""
    a = annotations.select(F.col("url").alias("a_url"), F.col("last_scraped").alias("a_scraped"), F.col("page_template_type").alias("a_type"))
    hit = F.col("a_url").isNotNull()
    kept = [c for c in index.columns if c not in ("last_scraped", "page_template_type")]
    return index.join(a, F.col("url") == F.col("a_url"), "left").select(*kept, F.when(hit, F.col("a_type")).otherwise(F.col("page_template_type")).alias("page_template_type"), F.when(hit, F.col("a_scraped")).otherwise(F.col("last_scraped")).alias("last_scraped"))


def replace_by(rows: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't among the new ones, and the new ones."""
    return rows.join(new.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def envelope(index: DataFrame, source: str, generated_at: str) -> DataFrame:
    """One row: {metadata, urls} as JSON files hold it, urls by (namespace, url).

    An export for small indexes; large ones are written as plain tables (`sources.stores`).
    """
    body = index.agg(
        F.count("*").alias("n"), F.array_sort(F.collect_set(F.coalesce("namespace", F.lit("unknown")))).alias("names"),
        F.array_sort(F.collect_list(F.struct(F.coalesce("namespace", F.lit("")).alias("by"), F.col("url").alias("at"), F.struct(*index.columns).alias("r")))).alias("rows"),
    )
    return body.select(F.struct(F.lit(source).alias("source"), F.lit(generated_at).alias("generated_at"), F.col("n").alias("total_urls"), F.col("names").alias("namespaces")).alias("metadata"), F.transform("rows", lambda x: x["r"]).alias("urls"))
