"""Extraction by declared schema: fields, constraints as data, compiled to column predicates.

Candidates are rows (page_id, field, pos, node_id, text, score, x, y, w, h).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A node lower than this share of the page breaks a visual constraint without a bound of its own.
MAX_RELATIVE_Y = 0.80


@dataclass(frozen=True)
class Constraint:
    """`holds` is a predicate on a candidate row that also has `height`, null where it is unknown."""

    kind: str
    field: str
    holds: Column


@dataclass(frozen=True)
class Field:
    name: str
    dtype: str = "string"
    required: bool = True


@dataclass(frozen=True)
class Schema:
    name: str
    fields: tuple[Field, ...]
    constraints: tuple[Constraint, ...] = field(default=())

    @classmethod
    def from_dict(cls, spec: dict) -> Schema:
        """From {name, fields: [{name, dtype, required, constraints}], constraints}."""
        fields, rules = [], []
        for f in spec["fields"]:
            fields.append(Field(f["name"], f.get("dtype", "string"), f.get("required", True)))
            rules += [compile_constraint({"field": f["name"], **c}) for c in f.get("constraints", [])]
        rules += [compile_constraint(c) for c in spec.get("constraints", [])]
        return cls(spec["name"], tuple(fields), tuple(rules))

    def admissible(self) -> Column:
        """Whether a candidate satisfies every constraint of its field."""
        out = F.lit(True)
        for c in self.constraints:
            out = out & ((F.col("field") != c.field) | F.coalesce(c.holds, F.lit(False)))
        return out


def _unique(_: dict) -> Column:
    return F.lit(True)  # one value a field is chosen, which is always unique


def _format(spec: dict) -> Column:
    return F.col("text").isNotNull() & F.coalesce("text", F.lit("")).rlike(spec["pattern"])


def _visual(spec: dict) -> Column:
    known = F.col("y").isNotNull() & F.col("height").isNotNull() & (F.col("height") > 0)
    return ~known | (F.col("y") / F.when(F.col("height") > 0, F.col("height")) <= spec.get("max_relative_y", MAX_RELATIVE_Y))


#: Constraint kinds; add to it for kinds of your own.
KINDS: dict[str, Callable[[dict], Column]] = {"unique": _unique, "format": _format, "visual": _visual}


def compile_constraint(spec: dict) -> Constraint:
    if spec["type"] not in KINDS:
        raise ValueError(f"unknown constraint type {spec['type']!r}")
    return Constraint(spec["type"], spec["field"], KINDS[spec["type"]](spec))


#: A selector proposes a field's candidates: from nodes to (page_id, node_id, text, score, x, y, w, h).
Selector = Callable[[DataFrame], DataFrame]


def by_score(score: str) -> Selector:
    """The plain selector: every node, with a column of its as the score."""
    return lambda nodes: nodes.select("page_id", F.col("node_idx").cast("string").alias("node_id"), "text", F.col(score).cast("double").alias("score"), "x", "y", "w", "h")


def propose(nodes: DataFrame, selectors: dict[str, Selector]) -> DataFrame:
    """The candidates of all fields, each field's by descending score; `pos` counts from 0, ties by node id."""
    order = Window.partitionBy("page_id", "field").orderBy(F.desc_nulls_last("score"), F.length("node_id"), "node_id")
    every = None
    for name, select in selectors.items():
        rows = select(nodes).select("page_id", F.lit(name).alias("field"), "node_id", "text", "score", "x", "y", "w", "h")
        every = rows if every is None else every.unionByName(rows)
    return every.withColumn("pos", (F.row_number().over(order) - 1).cast("int"))


def solve(candidates: DataFrame, schema: Schema) -> DataFrame:
    """(page_id, field, node_id, text, confidence): each field's best admissible candidate.

    A required field without one takes its best candidate anyway; from then on the page's assignment is
    broken, so later required fields take their best unchecked and later optional fields stay empty.
    """
    spark = candidates.sparkSession
    table = F.broadcast(spark.createDataFrame([(i, f.name, f.required) for i, f in enumerate(schema.fields)], "field_pos int, field string, required boolean"))
    height = F.max(F.col("y") + F.col("h")).over(Window.partitionBy("page_id"))
    rows = candidates.withColumn("height", height).join(table, "field").withColumn("ok", schema.admissible())
    entry = F.struct((-F.col("score")).alias("loss"), "pos", "node_id", "text")
    best = rows.groupBy("page_id", "field_pos", "field", "required").agg(F.min(entry).alias("top"), F.min(F.when(F.col("ok"), entry)).alias("good"))
    every = best.select("page_id").distinct().join(table)  # a handful of fields for each page
    full = every.join(best, ["page_id", "field_pos", "field", "required"], "left")
    lost = F.col("required") & F.col("top").isNotNull() & F.col("good").isNull()
    before = Window.partitionBy("page_id").orderBy("field_pos").rowsBetween(Window.unboundedPreceding, -1)
    broken = F.coalesce(F.max(lost.cast("int")).over(before) == 1, F.lit(False))
    pick = F.when(~F.col("broken") & F.col("good").isNotNull(), F.col("good")).when(F.col("required"), F.col("top"))
    chosen = full.withColumn("broken", broken).withColumn("pick", pick)
    return chosen.select("page_id", "field", F.col("pick.node_id").alias("node_id"), F.col("pick.text").alias("text"), F.coalesce(-F.col("pick.loss"), F.lit(0.0)).alias("confidence"))


def stability(candidates: DataFrame) -> DataFrame:
    """(page_id, sigma): how far each field's best stands above the rest, over all candidates.

    Only a field's best contributes: its score less the runner-up's, neither below zero.
    """
    order = Window.partitionBy("page_id", "field").orderBy(F.desc_nulls_last("score"))
    ranked = candidates.withColumn("rank", F.row_number().over(order))
    top = ranked.groupBy("page_id", "field").agg(F.max(F.when(F.col("rank") == 1, F.col("score"))).alias("best"), F.max(F.when(F.col("rank") == 2, F.col("score"))).alias("next"), F.count("*").alias("n"))
    lead = F.greatest(F.lit(0.0), F.col("best") - F.greatest(F.lit(0.0), F.coalesce("next", F.lit(0.0))))
    return top.withColumn("lead", lead).groupBy("page_id").agg((F.sum("lead") / F.sum("n")).alias("sigma"))
