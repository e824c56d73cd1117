"""Text and price expressions. All are native columns that stay in generated code where Spark can."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What counts as a price, strictly (currency on one side) and as a currency.
STRICT_PRICE = r"(?i)([£$€₼]|AZN)\s*[0-9]+([.,][0-9]{1,2})?|[0-9]+([.,][0-9]{1,2})?\s*([£$€₼]|AZN)"
#: Phrases of navigation and notices.
STOP_WORDS = (
    "warning", "notice", "in stock", "add to basket", "add to cart", "home", "sign in", "register", "this is a demo",
    "prices and ratings",
)
_SPACE = " \t\n\r\x0b\x0c"
#: Unicode's space separators.
_SPACES = " \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"


def strip(s: Column) -> Column:
    """Without ASCII white space on either side."""
    return F.btrim(s, F.lit(_SPACE))


def strip_spaces(s: Column) -> Column:
    """Without spaces of any width on either side."""
    return F.btrim(s, F.lit(_SPACES))


def price_format(text: Column) -> Column:
    """A currency right before or after digits."""
    return F.coalesce(text, F.lit("")).rlike(STRICT_PRICE)


def has_digit(text: Column) -> Column:
    """The loose price pattern: currency is optional on both sides, so any digit will do."""
    return F.coalesce(text, F.lit("")).rlike("[0-9]")


def price_like(text: Column) -> Column:
    """Short text with a digit."""
    t = strip(F.coalesce(text, F.lit("")))
    return has_digit(t) & (F.char_length(t) < 25)


def navigation_like(text: Column) -> Column:
    """A slash, digits only, fewer than three characters, or a stop phrase."""
    t = strip(F.coalesce(text, F.lit("")))
    low = F.lower(t)
    found = t.contains("/") | t.rlike("^[0-9]+$") | (F.char_length(t) < 3)
    for w in STOP_WORDS:
        found = found | low.contains(w)
    return found


def title_case(s: Column) -> Column:
    """Upper case for every letter that doesn't follow a letter, lower case for the others."""
    chars = F.split(s, "")
    letter = lambda c: c.rlike(r"^\p{L}$")
    prev = F.concat(F.array(F.lit("")), F.slice(chars, 1, F.greatest(F.size(chars) - 1, F.lit(0))))
    return F.array_join(F.transform(F.arrays_zip(chars.alias("c"), prev.alias("p")), lambda z: F.when(letter(z["p"]), F.lower(z["c"])).otherwise(F.upper(z["c"]))), "")


def matches(expected: Column, got: Column, prefix: int, lower: bool = True, drop_currency: bool = True) -> Column:
    """The first `prefix` characters of `expected` occur in `got`; blank expectations never match."""
    clean = lambda s: strip(F.lower(s) if lower else s)
    bare = lambda s: F.replace(clean(F.coalesce(s, F.lit(""))), F.lit("£"), F.lit("")) if drop_currency else clean(F.coalesce(s, F.lit("")))
    want = F.substring(bare(expected), 1, prefix)
    return (want != "") & bare(got).contains(want)
