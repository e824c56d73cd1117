"""Field specs of annotation payloads and the coercion of raw JSON into them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fields of an entry, with their kinds.
ENTRY_FIELDS = (
    ("title", "str"), ("aliases", "list[str]"), ("entry_type", "list[str]"), ("status", "str"), ("origin", "str"),
    ("year", "int"), ("region", "list[str]"), ("tags", "list[str]"), ("about", "str"), ("origin_description", "str"),
    ("spread_description", "str"), ("notable_examples", "list[obj]"), ("related_memes", "list[str]"),
    ("parent_meme", "str"), ("search_interest", "str"), ("external_references", "list[obj]"), ("nsfw", "bool"),
)
#: Fields of an editorial.
EDITORIAL_FIELDS = (
    ("title", "str"), ("subtitle", "str"), ("author", "str"), ("published_date", "str"), ("category", "str"),
    ("summary", "str"), ("body_excerpt", "str"), ("tags", "list[str]"), ("mentioned_memes", "list[str]"),
    ("related_articles", "list[obj]"),
)

_TYPES = {"str": T.StringType(), "int": T.IntegerType(), "bool": T.BooleanType(), "list[str]": T.ArrayType(T.StringType()), "list[obj]": T.ArrayType(T.StringType())}


def fields_of(family: str) -> tuple[tuple[str, str], ...]:
    return EDITORIAL_FIELDS if family == "editorial" else ENTRY_FIELDS


def payload_type(family: str) -> T.StructType:
    """The typed payload; objects in lists stay JSON text, their keys being free."""
    return T.StructType([T.StructField(n, _TYPES[k]) for n, k in fields_of(family)])


def default_of(kind: str) -> Column:
    empty = {"int": F.lit(0), "bool": F.lit(False), "str": F.lit("")}
    return empty[kind] if kind in empty else F.array().cast("array<string>")


def to_int(s: Column) -> Column:
    """The first four characters as a number, else 0."""
    return F.coalesce(F.substring(F.btrim(s), 1, 4).try_cast("int"), F.lit(0))


def to_bool(s: Column) -> Column:
    return F.coalesce(F.lower(F.btrim(s)).isin("true", "yes", "1", "nsfw"), F.lit(False))


def to_list(s: Column) -> Column:
    """A comma-separated text as trimmed, non-blank items."""
    return F.coalesce(F.filter(F.transform(F.split(s, ","), lambda x: F.btrim(x)), lambda x: x != ""), F.array().cast("array<string>"))


def coerced(raw: Column, name: str, kind: str) -> Column:
    """Field `name` of the JSON text `raw` in its kind; missing, null or malformed gives the default."""
    v = F.try_parse_json(raw)
    at = f"$.{name}"
    text = F.try_variant_get(v, at, "string")
    if kind == "str":
        return F.coalesce(text, F.lit(""))
    if kind == "int":
        return to_int(text)
    if kind == "bool":
        return to_bool(text)
    items = F.try_variant_get(v, at, "array<variant>")
    if kind == "list[obj]":
        objects = F.filter(items, lambda x: F.schema_of_variant(x).startswith("OBJECT"))
        return F.coalesce(F.transform(objects, lambda x: F.to_json(x)), F.array().cast("array<string>"))
    texts = F.transform(items, lambda x: F.coalesce(F.btrim(F.try_variant_get(x, "$", "string")), F.lit("None")))
    return F.coalesce(F.filter(texts, lambda x: x != ""), to_list(text))


def normalized(raw: Column, family: str) -> Column:
    """All fields of the family from JSON text, typed; extra keys go, anything but an object is all defaults."""
    return F.struct(*(coerced(raw, n, k).alias(n) for n, k in fields_of(family)))


def prompt(family: str, site: str = "the site") -> str:
    """The instruction for an annotator that reads pages, from the field list."""
    what = "editorial article" if family == "editorial" else "entry"
    keys = "\n".join(f"- {n}: {k}" for n, k in fields_of(family))
    return f"Extract one JSON object from this {what} of {site}, with these keys and no others:\n{keys}\nLeave missing values empty ('' for text, 0 for int, [] for lists, false for bool). Answer with the object only."
