"""URL filter: explicit rules first, then a tree of path templates for each host. DataFrame operations only.

Below each host the path's segments form a tree, as deep as the paths go. A node with many children of few
different urls each, on average, holds identifiers: they become one wildcard, which keeps the file
extension; how often a url is repeated doesn't matter. From the top down, branches under one node whose
share of bad labelled pages doesn't differ from that of the node's branches together are merged, and with
them what lies below. A template is rejected where its branch's smoothed share of good labelled pages falls
below PURITY.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import durable, fresh

#: A node is variable with so many different children ...
CHILDREN = 8
#: ... of fewer urls each than this, on average.
URLS_EACH = 4
#: Branches differ where the squared z score exceeds this (two-sided 5 %).
DIFFER = 3.8416
#: Pages that the host-wide prior counts as, and the share of good pages a template needs.
PRIOR_WEIGHT = 20
PURITY = 0.7

#: The rules of the query, as (verdict, host and path).
RULES = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
    ("allow", "com/fr/"), ("block", "com/de/"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first `://`, A-Z lower-cased, and the path after it; both empty without one."""
    u = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(u, "://") > 0, F.substring(u, F.instr(u, "://") + 3, F.char_length(u))).otherwise("")
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.char_length(raw) + 1, F.char_length(rest)), r"^[^?#]*", 0)
    return F.translate(raw, _UPPER, _LOWER), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null without one; of two equal rules the first.

    `rules` is a short list written out in the plan.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for word, text in reversed(sorted(rules, key=lambda r: -len(r[1]))):
        at, _, rest = text.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(word)).otherwise(verdict)
    return rule, verdict


def segments(path: Column) -> Column:
    """The path's segments; blank ones don't count."""
    return F.filter(F.split(path, "/"), lambda s: s != "")


def _shared(low: Column, high: Column) -> Column:
    """How many elements two lists have in common from the first on: with the least and the largest of some
    lists, what all of them have."""
    same = F.zip_with(F.slice(low, F.lit(1), F.least(F.size(low), F.size(high))), F.slice(high, F.lit(1), F.least(F.size(low), F.size(high))), lambda a, b: a == b)
    return F.coalesce(F.nullif(F.array_position(same, F.lit(False)), F.lit(0)) - 1, F.size(same)).cast("int")


def templates(rows: DataFrame) -> DataFrame:
    """`rows` (host, path and others) with `template`: the path with variable segments as wildcards.

    Node by node downwards, each step written before the next. Segments that all urls of a node share are
    taken at once, and a node with fewer urls than CHILDREN can't have a variable one below it, so its rows
    are finished at once: few steps, however deep the paths. A null host or path counts as empty; a path
    without a segment has an empty template; a table without rows gives none.
    """
    parts, deep, node_host, node, variable, jump, open_ = fresh(rows, "parts", "deep", "node_host", "node", "variable", "jump", "open")
    kept = [F.coalesce(c, F.lit("")).alias(c) if c in ("host", "path") else F.col(c) for c in rows.columns if c != "template"]
    names = [c for c in rows.columns if c != "template"]
    todo = durable(rows.select(*kept, F.lit("").alias("template"), F.lit(0).alias(deep)).withColumn(parts, segments(F.col("path"))).withColumn(open_, F.size(parts) > 0), "templates")
    done = todo.where(~F.col(open_))
    here, rest = F.get(parts, F.col(deep)), F.slice(parts, F.col(deep) + 1, F.size(parts))
    while not (todo := todo.where(open_)).isEmpty():
        urls = todo.select("host", "template", here.alias("part"), "path", rest.alias("rest")).distinct()
        children = urls.groupBy("host", "template", "part").agg(F.count("*").alias("urls"), F.min("rest").alias("low"), F.max("rest").alias("high"))
        nodes = children.groupBy("host", "template").agg(F.count("*").alias("children"), F.sum("urls").alias("urls"), F.min("low").alias("low"), F.max("high").alias("high"))
        nodes = nodes.where(F.col("urls") >= CHILDREN).select(
            F.col("host").alias(node_host), F.col("template").alias(node), ((F.col("children") >= CHILDREN) & (F.col("urls") < URLS_EACH * F.col("children"))).alias(variable), _shared(F.col("low"), F.col("high")).alias(jump)
        )
        # written, so that a host of very many pages can be split in the join
        at = todo.join(durable(nodes, "nodes"), (F.col("host") == F.col(node_host)) & (F.col("template") == F.col(node)), "left")
        wild = F.concat(F.lit("*"), F.regexp_extract(here, r"(\.[A-Za-z0-9]{1,5})$", 1))
        step = F.when(F.col(node).isNull(), F.size(parts)).otherwise(F.greatest(F.col(jump), F.lit(1)))
        grown = F.concat("template", F.lit("/"), F.when(F.col(variable), wild).otherwise(F.array_join(F.slice(parts, F.col(deep) + 1, step), "/")))
        todo = durable(at.select(*names, grown.alias("template"), (F.col(deep) + step).alias(deep), parts, (F.col(deep) + step < F.size(parts)).alias(open_)), "templates")
        done = done.unionByName(todo.where(~F.col(open_)))
    return done.select(*names, "template")


def _differ() -> Column:
    """(bad - seen * p)^2 > DIFFER * seen * p * (1 - p) for p = all_bad / all_seen, in whole numbers times all_seen^2."""
    gap = (F.col("bad") * F.col("all_seen") - F.col("seen") * F.col("all_bad")).cast("double")
    return gap * gap > DIFFER * (F.col("seen").cast("double") * F.col("all_bad") * (F.col("all_seen") - F.col("all_bad")))


def branches(counts: DataFrame) -> DataFrame:
    """(host, template, bad, seen) with `branch`: the template with merged segments as `~`.

    A segment is merged where the share of bad pages below it doesn't differ from that below its node;
    segments that all templates of a node share differ from nothing and are taken at once. Segments without
    labelled pages are merged; a table without rows gives none.
    """
    counts = counts.select("host", "template", "bad", "seen", segments(F.col("template")).alias("parts"), F.lit("").alias("branch"), F.lit(0).alias("deep"))
    todo = durable(counts.withColumn("open", F.size("parts") > 0), "branches")
    done = todo.where("NOT open")
    segment, rest = F.get("parts", F.col("deep")), F.slice("parts", F.col("deep") + 1, F.size("parts"))
    while not (todo := todo.where("open")).isEmpty():
        child = todo.groupBy("host", "branch", segment.alias("segment")).agg(F.sum("bad").alias("bad"), F.sum("seen").alias("seen"), F.min(rest).alias("low"), F.max(rest).alias("high"))
        node = child.groupBy("host", "branch").agg(F.sum("bad").alias("all_bad"), F.sum("seen").alias("all_seen"), F.min("low").alias("low"), F.max("high").alias("high"))
        decided = child.drop("low", "high").join(node, ["host", "branch"]).select("host", "branch", "segment", _differ().alias("differs"), _shared(F.col("low"), F.col("high")).alias("jump"))
        at = todo.withColumn("segment", segment).join(durable(decided, "decided"), ["host", "branch", "segment"])
        step = F.greatest(F.col("jump"), F.lit(1))
        grown = F.concat("branch", F.when(F.col("jump") > 0, F.repeat(F.lit("/~"), F.col("jump"))).when(F.col("differs"), F.concat(F.lit("/"), F.col("segment"))).otherwise("/~"))
        todo = durable(at.select("host", "template", "bad", "seen", "parts", grown.alias("branch"), (F.col("deep") + step).alias("deep"), (F.col("deep") + step < F.size("parts")).alias("open")), "branches")
        done = done.unionByName(todo.where("NOT open"))
    return done.drop("parts", "deep", "open")


def judged(counts: DataFrame) -> DataFrame:
    """(host, template, bad, seen) to (host, template, branch, purity, verdict), one row a template.

    `bad` and `seen` count the template's labelled pages and aren't null. A template has the purity of its
    branch: the share of good pages, smoothed by that of all pages. Without any labelled page every branch
    has a purity of one half. A table without rows gives none.
    """
    both = branches(counts)
    merged = both.groupBy("host", "branch").agg(F.sum("bad").alias("bad"), F.sum("seen").alias("seen"))
    prior = counts.agg(((F.sum("seen") - F.sum("bad") + 1) / (F.sum("seen") + 2)).alias("prior"))  # one row
    purity = (F.col("seen") - F.col("bad") + PRIOR_WEIGHT * F.col("prior")) / (F.col("seen") + PRIOR_WEIGHT)
    scored = merged.join(F.broadcast(prior)).select("host", "branch", F.coalesce(purity, F.lit(0.5)).alias("purity"))
    return both.select("host", "template", "branch").join(scored, ["host", "branch"]).select("host", "template", "branch", "purity", F.when(F.col("purity") >= PURITY, "allow").otherwise("block").alias("verdict"))


def judge(pages: DataFrame, evidence: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, branch, purity) of every row.

    `pages` has page_id and url, `evidence` (document, bad) says of some documents whether they are bad; a
    page shows the document whose number its path ends in. Urls that are null or have no `://` have an
    empty host and path and are judged by that template. Rows stay one to one, repeated ones too; an
    empty table gives no rows, and without evidence every template has the prior.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    number = F.expr("try_cast(regexp_extract(path, '/([0-9]+)[^/]*/?$', 1) AS BIGINT)")
    # a page without a number gets one that no document has, spread so that they don't meet in one task
    rows = templates(rows).withColumn("document", F.coalesce(number, -1 - F.pmod(F.xxhash64("page_id", "path"), F.lit(1 << 40))))
    rows = durable(rows, "judging")
    known = evidence.where(F.col("document") >= 0).groupBy("document").agg(F.max("bad").alias("bad"))
    seen = rows.select("host", "template", "document").join(durable(known, "evidence"), "document", "left")
    counts = durable(seen.groupBy("host", "template").agg(F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"), F.count("bad").alias("seen")), "evidence-counts")
    found = durable(judged(counts), "judged").withColumnRenamed("verdict", "by_template")
    rule, by_rule = rule_of(F.col("host"), F.col("path"), rules)
    return rows.join(found, ["host", "template"]).select("page_id", "host", "path", rule.alias("rule"), F.coalesce(by_rule, "by_template").alias("verdict"), "template", "branch", "purity")
