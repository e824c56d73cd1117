"""Choosing at most one node a field: page figures, masks, priors, exact and greedy assignment.

Nodes are rows (page_id, node_idx, text, tag, x, y, w, h, p_price, p_title, p_other). Every operator
needs one exchange by page at most; a page's few best candidates are kept, never its node list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions import text as tx

#: The footer begins at this share of the page's height.
FOOTER = 0.80
#: Fields are looked for above this many pixels.
ZONE = 500.0
#: A page is at least so high.
LEAST_HEIGHT = 1080.0
#: Pages less stable than this are queued for relabelling.
STABLE = 0.60


def page_height(nodes: DataFrame, least: float | None = LEAST_HEIGHT) -> DataFrame:
    """(page_id, height): the lowest edge of any node, `least` at least (None: no floor)."""
    low = F.max(F.col("y") + F.col("h"))
    return nodes.groupBy("page_id").agg((low if least is None else F.greatest(F.lit(least), low)).alias("height"))


def with_masks(nodes: DataFrame, least: float | None = LEAST_HEIGHT) -> DataFrame:
    """`nodes` with height, in_footer, out_of_zone and price_ok."""
    low = F.max(F.col("y") + F.col("h")).over(Window.partitionBy("page_id"))
    height = low if least is None else F.greatest(F.lit(least), low)
    return nodes.withColumn("height", height).withColumns({
        "in_footer": F.col("y") > F.col("height") * FOOTER,
        "out_of_zone": F.col("y") > ZONE,
        "price_ok": tx.price_format(F.col("text")),
    })


def blend(nodes: DataFrame, drift: float) -> DataFrame:
    """Probabilities mixed with the uniform distribution; missing ones are uniform."""
    mixed = {c: (1 - drift) * F.coalesce(c, F.lit(1 / 3)) + drift / 3 for c in ("p_price", "p_title", "p_other")}
    return nodes.withColumns(mixed)


def with_priors(nodes: DataFrame, legacy: bool = False) -> DataFrame:
    """`nodes` with s_price, s_title and s_other: probabilities plus bounded nudges.

    Blank text loses one in both fields. `legacy` gives the old scale of hundreds, with its own footer term
    (needs `in_footer`).
    """
    t = tx.strip(F.coalesce("text", F.lit("")))
    blank, price, nav = t == "", tx.price_like(F.col("text")), tx.navigation_like(F.col("text"))
    head = F.lower("tag") == "h1"
    if legacy:
        dp = F.when(blank, -100.0).otherwise(F.when(price, 20.0).otherwise(0.0) + F.when(F.col("in_footer"), -30.0).otherwise(0.0))
        dt = F.when(blank, -100.0).otherwise(F.when(head, 10.0).otherwise(0.0) + F.when(price, -20.0).when(nav, -5.0).otherwise(0.0) + F.when(F.col("in_footer"), -30.0).otherwise(0.0))
        return nodes.withColumns({"s_price": F.col("p_price") + dp, "s_title": F.col("p_title") + dt, "s_other": F.col("p_other")})
    s_price = F.when(blank, F.col("p_price") - 1.0).when(price, F.col("p_price") + 0.3).otherwise(F.col("p_price"))
    up = F.when(head, F.col("p_title") + 0.3).otherwise(F.col("p_title"))
    s_title = F.when(blank, F.col("p_title") - 1.0).when(price | nav, up - 0.3).otherwise(up)
    return nodes.withColumns({"s_price": s_price, "s_title": s_title, "s_other": F.col("p_other")})


def scored(nodes: DataFrame, least: float | None = LEAST_HEIGHT) -> DataFrame:
    return with_priors(with_masks(nodes, least))


def _margin() -> Column:
    """Gap between the two largest probabilities of a node."""
    p = F.sort_array(F.array("p_price", "p_title", "p_other"), asc=False)
    return p[0] - p[1]


def margins(nodes: DataFrame) -> DataFrame:
    return nodes.select("page_id", "node_idx", _margin().alias("margin"))


def stability(nodes: DataFrame) -> DataFrame:
    """(page_id, sigma): mean margin of the page's nodes, on raw probabilities."""
    return nodes.groupBy("page_id").agg(F.coalesce(F.avg(_margin()), F.lit(0.0)).alias("sigma"))


def assign_exact(nodes: DataFrame) -> DataFrame:
    """(page_id, title_idx, title, price_idx, price, gain): the assignment of the largest total score.

    At most one title and one price, never the same node; nodes in the footer or out of the zone hold
    neither, and a price needs the strict format. A field's best node is taken unless the other field
    took it, so the two best of each suffice. Ties go to the smaller price node, then title node; a gain
    of zero assigns nothing.
    """
    return _choose(_entries(nodes).groupBy("page_id").agg(*_tops()))


def _entries(nodes: DataFrame) -> DataFrame:
    """`nodes` with what each could give either field (null if it may not), and the page's best of that."""
    open_ = ~F.col("in_footer") & ~F.col("out_of_zone")
    page = Window.partitionBy("page_id")
    for field, ok in (("price", open_ & F.col("price_ok")), ("title", open_)):
        gain = F.col(f"s_{field}") - F.col("s_other")
        entry = F.when(ok & (gain > 0), F.struct((-gain).alias("loss"), F.col("node_idx").alias("idx"), F.col("text").alias("text")))
        nodes = nodes.withColumn(f"{field}_entry", entry)
    return nodes.withColumns({f"{field}_best": F.min(f"{field}_entry").over(page) for field in ("price", "title")})


def _tops() -> list[Column]:
    """Aggregates of the two best entries of either field: the least, and the least of those above it."""
    second = lambda f: F.min(F.when(F.col(f"{f}_entry") > F.col(f"{f}_best"), F.col(f"{f}_entry")))
    return [F.array_compact(F.array(F.min(f"{f}_entry"), second(f))).alias(f"{f}s") for f in ("price", "title")]


def _choose(top: DataFrame, *kept: str) -> DataFrame:
    """The best pair of each page's `prices` and `titles`, with the columns `kept`."""
    none = F.lit(None).cast("struct<loss:double,idx:int,text:string>")
    last = F.lit(2147483647)
    pairs = F.flatten(F.transform(F.concat("prices", F.array(none)), lambda p: F.transform(F.concat("titles", F.array(none)), lambda t: F.struct(
        (F.coalesce(p["loss"], F.lit(0.0)) + F.coalesce(t["loss"], F.lit(0.0))).alias("loss"),
        F.coalesce(p["idx"], last).alias("p_order"), F.coalesce(t["idx"], last).alias("t_order"),
        p.alias("p"), t.alias("t"),
    ))))
    valid = F.filter(pairs, lambda z: z["p"].isNull() | z["t"].isNull() | (z["p_order"] != z["t_order"]))
    b = F.col("best")
    return top.select("page_id", F.array_min(valid).alias("best"), *kept).select(
        "page_id", b["t"]["idx"].alias("title_idx"), b["t"]["text"].alias("title"), b["p"]["idx"].alias("price_idx"), b["p"]["text"].alias("price"), (0.0 - b["loss"]).alias("gain"), *kept
    )


def assign_greedy(nodes: DataFrame) -> DataFrame:
    """(page_id, title_idx, title, price_idx, price): each field's best score, first node on ties."""
    first = lambda s: F.min(F.struct((-F.col(s)).alias("loss"), F.col("node_idx").alias("idx"), F.col("text").alias("text")))
    best = nodes.groupBy("page_id").agg(first("s_title").alias("t"), first("s_price").alias("p"))
    return best.select("page_id", F.col("t.idx").alias("title_idx"), F.col("t.text").alias("title"), F.col("p.idx").alias("price_idx"), F.col("p.text").alias("price"))


def assign_fallback(nodes: DataFrame) -> DataFrame:
    """As greedy, but a node stands for its largest class only, the first class on ties."""
    s = F.array("s_price", "s_title", "s_other")
    cls = F.array_position(s, F.array_max(s))
    pick = lambda k, c: F.min(F.when(cls == k, F.struct((-F.col(c)).alias("loss"), F.col("node_idx").alias("idx"), F.col("text").alias("text"))))
    best = nodes.groupBy("page_id").agg(pick(2, "s_title").alias("t"), pick(1, "s_price").alias("p"))
    return best.select("page_id", F.col("t.idx").alias("title_idx"), F.col("t.text").alias("title"), F.col("p.idx").alias("price_idx"), F.col("p.text").alias("price"))


def candidate_trace(nodes: DataFrame, keep: int = 5) -> DataFrame:
    """(page_id, field, rank, node_idx, score, excerpt, flags): each field's best candidates and what bars them."""
    fields = F.explode(F.array(F.struct(F.lit("title").alias("field"), F.col("s_title").alias("score")), F.struct(F.lit("price").alias("field"), F.col("s_price").alias("score"))))
    long = nodes.select("page_id", "node_idx", "text", "in_footer", "out_of_zone", "price_ok", fields.alias("f"))
    order = Window.partitionBy("page_id", F.col("f.field")).orderBy(F.desc("f.score"), "node_idx")
    flags = F.concat_ws("+", F.when(F.col("in_footer"), "footer"), F.when(F.col("out_of_zone"), "zone"), F.when((F.col("f.field") == "price") & ~F.col("price_ok"), "format"))
    return long.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep).select(
        "page_id", F.col("f.field").alias("field"), "rank", "node_idx", F.col("f.score").alias("score"), F.substring(F.coalesce("text", F.lit("")), 1, 28).alias("excerpt"), flags.alias("flags")
    )


def merge_split_title(nodes: DataFrame, assigned: DataFrame, near: float = 60.0) -> DataFrame:
    """(page_id, title): the title joined by the first other node on its line.

    That node's text is neither the title's nor the price's, has no digit and more than two characters.
    """
    picked = assigned.where(F.col("title_idx").isNotNull()).select("page_id", "title_idx", "title", "price")
    with_y = nodes.select("page_id", "node_idx", "text", "y")
    both = with_y.join(picked, "page_id").withColumn("title_y", F.max(F.when(F.col("node_idx") == F.col("title_idx"), F.col("y"))).over(Window.partitionBy("page_id")))
    fits = (F.abs(F.col("y") - F.col("title_y")) <= near) & (F.col("text") != F.col("title")) & ~F.col("text").eqNullSafe(F.col("price")) & ~tx.has_digit(F.col("text")) & (F.char_length("text") > 2)
    joined = both.groupBy("page_id").agg(F.first("title").alias("title"), F.min(F.when(fits, F.struct("node_idx", "text"))).alias("more"))
    return joined.select("page_id", F.when(F.col("more").isNotNull(), F.concat("title", F.lit(" "), F.col("more.text"))).otherwise(F.col("title")).alias("title"))


def records(nodes: DataFrame, drift: float = 0.0, mode: str = "exact", priors: bool = True) -> DataFrame:
    """One extraction record a page: both fields, the gain, stability and whether it is to be relabelled.

    `mode` is `exact`, the best assignment under the constraints, or `greedy`, each field's best score
    without any; without `priors` the probabilities are the scores. Pages without nodes give no record.
    """
    if mode not in ("exact", "greedy"):
        raise ValueError(f"unknown mode {mode!r}")
    rows = with_masks(blend(nodes, drift))
    rows = with_priors(rows) if priors else rows.withColumns({f"s_{f}": F.col(f"p_{f}") for f in ("price", "title", "other")})
    if mode == "greedy":
        gain = F.col("t.gain") + F.col("p.gain")
        pick = lambda f: F.min(F.struct((-F.col(f"s_{f}")).alias("loss"), F.col("node_idx").alias("idx"), F.col("text").alias("text"), (F.col(f"s_{f}") - F.col("s_other")).alias("gain")))
        best = rows.groupBy("page_id").agg(pick("title").alias("t"), pick("price").alias("p"), F.coalesce(F.avg(_margin()), F.lit(0.0)).alias("sigma"))
        best = best.select("page_id", F.col("t.idx").alias("title_idx"), F.col("t.text").alias("title"), F.col("p.idx").alias("price_idx"), F.col("p.text").alias("price"), gain.alias("gain"), "sigma")
        return best.withColumn("alert", F.col("sigma") < STABLE)
    found = _entries(rows).groupBy("page_id").agg(*_tops(), F.coalesce(F.avg(_margin()), F.lit(0.0)).alias("sigma"))  # one pass
    return _choose(found, "sigma").withColumn("alert", F.col("sigma") < STABLE)


def proofs(nodes: DataFrame) -> DataFrame:
    """(page_id, node_idx, id, status, field): which constraints hold for a page and which bar a node.

    `integrity` and the two uniqueness rules hold for the page (node_idx null); footer, zone and format
    name each node that they bar.
    """
    page = nodes.select("page_id").distinct().select("page_id", F.lit(None).cast("int").alias("node_idx"), F.explode(F.array(
        *(F.struct(F.lit(i).alias("id"), F.lit("satisfied").alias("status"), F.lit(f).alias("field")) for i, f in (("integrity", None), ("unique", "title"), ("unique", "price")))
    )).alias("r")).select("page_id", "node_idx", "r.id", "r.status", F.col("r.field").cast("string").alias("field"))
    bar = lambda c, i, f: F.when(c, F.struct(F.lit(i).alias("id"), F.lit("excluded").alias("status"), F.lit(f).alias("field")))
    rows = F.explode(F.array_compact(F.array(bar(F.col("in_footer"), "footer", "both"), bar(F.col("out_of_zone"), "zone", "both"), bar(~F.col("price_ok"), "format", "price"))))
    return page.unionByName(nodes.select("page_id", "node_idx", rows.alias("r")).select("page_id", "node_idx", "r.id", "r.status", "r.field"))
