"""URL expressions: parts, entry pages, namespaces, templates and resolution of links."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Scheme, authority and path of RFC 3986, appendix B.
PARTS = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)"

#: Sections whose deeper pages are entries.
ENTRY_ROOTS = ("memes", "cultures", "subcultures", "people", "sites", "events", "editorials", "videos", "photos", "sensitive")
#: Last segments that name listings, never entries.
CATEGORY_SEGMENTS = (
    "all", "new", "confirmed", "submissions", "submission", "deadpool", "researching", "newsworthy", "popular",
    "people", "events", "subcultures", "sites", "editorials", "videos", "photos", "cultures", "guides",
    "interviews", "page",
)
#: Namespace prefixes, the first that fits wins; a namespace is its prefix without outer slashes.
NAMESPACES = (
    "/sensitive/memes/events/", "/sensitive/memes/", "/sensitive/", "/memes/subcultures/", "/memes/events/",
    "/memes/people/", "/memes/sites/", "/memes/", "/editorials/guides/", "/editorials/interviews/",
    "/editorials/", "/cultures/", "/subcultures/", "/people/", "/events/", "/videos/", "/photos/",
)
#: Template of a page by its section.
TEMPLATES = {
    "memes": "meme", "cultures": "culture", "subcultures": "subculture", "people": "person", "sites": "site",
    "events": "event", "types": "type", "editorials": "editorial", "photos": "photo", "videos": "video",
}
#: Listings that are always crawled, and whether entries first seen there are confirmed.
LISTINGS = (("/memes/all", False), ("/memes/confirmed", True), ("/memes/submissions", False), ("/memes/researching", False), ("/memes/deadpool", False))


@dataclass(frozen=True)
class Site:
    """What the discovery rules need to know of a site."""

    hosts: tuple[str, ...]
    roots: tuple[str, ...] = ENTRY_ROOTS
    categories: tuple[str, ...] = CATEGORY_SEGMENTS
    namespaces: tuple[str, ...] = NAMESPACES
    templates: dict[str, str] = field(default_factory=lambda: dict(TEMPLATES))


def authority(url: Column) -> Column:
    return F.regexp_extract(url, PARTS, 2)


def path(url: Column) -> Column:
    return F.regexp_extract(url, PARTS, 3)


def path_segments(url: Column) -> Column:
    """Segments of the path that aren't blank."""
    return F.filter(F.split(path(url), "/"), lambda s: s != "")


def is_entry(url: Column, site: Site) -> Column:
    """On the site (or relative), two segments at least, in an entry section, not a listing or number."""
    segs = path_segments(url)
    last = F.try_element_at(segs, F.lit(-1))
    here = authority(url).isin("", *site.hosts)
    found = here & (F.size(segs) >= 2) & F.try_element_at(segs, F.lit(1)).isin(*site.roots) & ~last.isin(*site.categories) & ~last.rlike("^[0-9]+$")
    return F.coalesce(found, F.lit(False))


def namespace(path_: Column, prefixes=NAMESPACES) -> Column:
    """The first prefix that the path, without slashes at its end, starts with; null if none."""
    bare = F.rtrim(path_, F.lit("/"))
    out = F.lit(None).cast("string")
    for p in reversed(prefixes):
        out = F.when(bare.startswith(p), p.strip("/")).otherwise(out)
    return out


def template(url: Column, templates: dict[str, str] | None = None) -> Column:
    """The template by the first segment in lower case, else `unknown`; with no templates, always `unknown`."""
    first = F.lower(F.coalesce(F.try_element_at(path_segments(url), F.lit(1)), F.lit("")))
    out = F.lit("unknown")
    for section, name in (TEMPLATES if templates is None else templates).items():
        out = F.when(first == section, name).otherwise(out)
    return out


def family(template_: Column) -> Column:
    return F.when(template_ == "editorial", "editorial").otherwise("entry")


def document_id(url: Column) -> Column:
    return F.sha1(url)


def resolve(base: Column, href: Column) -> Column:
    """`href` seen from `base`, without query and fragment: absolute, `//`, `/`, empty and sibling forms.

    Dot segments are kept as they are.
    """
    bare = F.regexp_extract(href, r"^[^?#]*", 0)
    scheme = F.regexp_extract(base, PARTS, 1)
    root = F.concat(scheme, F.lit("://"), authority(base))
    folder = F.regexp_extract(path(base), r"^.*/", 0)
    return (
        F.when(bare.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), bare)
        .when(bare.startswith("//"), F.concat(scheme, F.lit(":"), bare))
        .when(bare.startswith("/"), F.concat(root, bare))
        .when(bare == "", F.concat(root, path(base)))
        .otherwise(F.concat(root, F.when(folder == "", "/").otherwise(folder), bare))
    )
