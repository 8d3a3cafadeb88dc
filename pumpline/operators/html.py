"""Extraction from raw page HTML: links and first-matching fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# A start tag after its name: values in quotes after "=" may hold ">", all else
# ends there.  Every repetition is possessive, so a match takes one step per
# character and no stack however long the tag; an unclosed tag matches too
# (without its ">") and is skipped as a whole, never scanned again.
_BODY = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+"""
# One attribute: a name, then perhaps "=" and a value in double, single or no quotes.
_ATTRIBUTE = r"""([^\s/>="'][^\s/>=]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]*+))?+"""


def start_tags(html: Column, tag: str) -> Column:
    """The text of every complete ``tag`` start tag, in order."""
    found = F.regexp_extract_all(html, F.lit(rf"(?i)<{tag}(?=[\s/>]){_BODY}>?+"), F.lit(0))
    return F.filter(found, lambda t: t.endswith(">"))


def attr_value(start_tag: Column, tag: str, attr: str) -> Column:
    """The value of the first attribute of that name in one start tag, without
    its quotes; null if it is missing or has no value."""
    inner = F.substr(start_tag, F.lit(len(tag) + 2), F.length(start_tag) - F.lit(len(tag) + 2))
    names = F.transform(F.regexp_extract_all(inner, F.lit(_ATTRIBUTE), F.lit(1)), F.lower)
    at = F.array_position(names, attr.lower()).cast("int") - 1
    return unquoted(F.nullif(F.get(F.regexp_extract_all(inner, F.lit(_ATTRIBUTE), F.lit(2)), at), F.lit("")))


def attr_values(html: Column, tag: str, attr: str) -> Column:
    """``attr_value`` of every start tag that has one, in order."""
    return F.filter(F.transform(start_tags(html, tag), lambda t: attr_value(t, tag, attr)), lambda v: v.isNotNull())


def unquoted(value: Column) -> Column:
    """An attribute value without the quotes around it."""
    quoted = value.startswith('"') | value.startswith("'")
    return F.when(quoted, F.substr(value, F.lit(2), F.length(value) - 2)).otherwise(value)


SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.-]*:"


URL_PARTS = r"^([a-zA-Z][a-zA-Z0-9+.-]*:(?://[^/?#]*)?)?([^?#]*)(.*)$"


def remove_dot_segments(url: Column) -> Column:
    """Resolve ``.`` and ``..`` path segments (RFC 3986 5.2.4) of a URL:
    the path is split into segments and folded with a stack
    (``aggregate`` over the array, JVM-side); a trailing ``.``/``..``
    leaves a trailing slash, and ``..`` above the root is dropped."""
    prefix = F.regexp_extract(url, URL_PARTS, 1)
    path = F.regexp_extract(url, URL_PARTS, 2)
    rest = F.regexp_extract(url, URL_PARTS, 3)
    segs = F.split(path, "/")
    folded = F.aggregate(
        segs, F.array().cast("array<string>"),
        lambda acc, seg: F.when(seg == "..", F.when(F.size(acc) > 1, F.slice(acc, 1, F.size(acc) - 1))
                                .otherwise(acc))
                          .when(seg == ".", acc)
                          .otherwise(F.concat(acc, F.array(seg))))
    last = F.element_at(segs, -1)
    folded = F.when(last.isin(".", ".."), F.concat(folded, F.array(F.lit("")))).otherwise(folded)
    new_path = F.when(path.rlike(r"(^|/)\.{1,2}(/|$)"), F.array_join(folded, "/")).otherwise(path)
    return F.concat(prefix, new_path, rest)


def resolve_url(base: Column, link: Column) -> Column:
    """Make ``link`` absolute against the page URL ``base``, as a browser
    (or ``urllib.parse.urljoin``) does.

    Handles absolute URLs, scheme-relative (//host/...), host-relative
    (/path), query-only (?q), fragment-only (#f) and relative paths (against
    the base's directory); paths resolved against the base lose their
    ``.``/``..`` segments.
    """
    origin = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*):", 1)
    no_frag = F.regexp_extract(base, r"^[^#]*", 0)
    no_query = F.regexp_extract(base, r"^[^?#]*", 0)
    base_dir = F.when(no_query == origin, F.concat(origin, F.lit("/"))).otherwise(
        F.regexp_extract(no_query, r"^(.*/)", 1))
    # Links that carry their own scheme or host are kept as written (as
    # urljoin does); links resolved against the base get dot segments removed.
    return (F.when(link.rlike(SCHEME), link)
             .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
             .when(link.startswith("/"), remove_dot_segments(F.concat(origin, link)))
             .when(link.startswith("?"), F.concat(no_query, link))
             .when(link.startswith("#"), F.concat(no_frag, link))
             .otherwise(remove_dot_segments(F.concat(base_dir, link))))


def page_links(pages: DataFrame, tag: str = "a", attr: str = "href", id_col: str = "page_id",
               url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Every ``attr`` URL of ``tag`` elements per page, made absolute, each
    URL once at the position of its first occurrence (0-based ``pos``).

    Pages are independent: the extraction is a per-row projection and the
    first-occurrence rule a group by (page, url) whose partial aggregation
    runs before the shuffle.
    """
    found = pages.select(id_col, url_col, F.posexplode(attr_values(F.col(html_col), tag, attr)).alias("raw_pos", "raw_link")) \
        .filter(F.col("raw_link") != "")
    resolved = found.withColumn("link", resolve_url(F.col(url_col), F.col("raw_link")))
    return resolved.groupBy(id_col, "link").agg(F.min("raw_pos").alias("first_pos"))


def attribute(tag: str, attr: str):
    """Finder of the first ``attr`` value of a ``tag``."""
    return lambda html: F.get(attr_values(html, tag, attr), 0)


def meta_content(name: str, value: str):
    """Finder of the content of the first meta tag whose ``name`` is ``value``."""
    def find(html: Column) -> Column:
        pairs = F.transform(start_tags(html, "meta"), lambda t: F.struct(F.lower(attr_value(t, "meta", name)).alias("n"),
                                                                        attr_value(t, "meta", "content").alias("v")))
        return F.get(F.filter(pairs, lambda p: (p["n"] == value.lower()) & p["v"].isNotNull()), 0)["v"]
    return find


def meta_charset(html: Column) -> Column:
    """The charset that the content of a meta tag names after a semicolon."""
    named = F.transform(attr_values(html, "meta", "content"), lambda v: F.regexp_extract(v, r"(?i);\s*+charset\s*+=\s*+([a-z0-9_-]++)", 1))
    return F.get(F.filter(named, lambda v: v != ""), 0)


def element_text(tag: str):
    """Finder of the text of the first ``tag`` that holds text only."""
    pattern = rf"(?i)<{tag}(?=[\s/>]){_BODY}(>[^<]*+</{tag}\s*+>)?+"

    def find(html: Column) -> Column:
        closed = F.filter(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)), lambda t: t != "")
        return F.regexp_extract(F.get(closed, 0), r"^>([^<]*+)<", 1)
    return find


# Ordered finders of the page fields (first match wins).
TITLE = [meta_content("property", "og:title"), element_text("title"), element_text("h1")]
CHARSET = [attribute("meta", "charset"), meta_charset]
LANG = [attribute("html", "lang")]


def first_match(text: Column, finders: list, group: int = 1) -> Column:
    """The first result that is not empty, else null.  A finder is a function
    of the text, or a pattern whose group ``group`` is taken."""
    found = [F.regexp_extract(text, f, group) if isinstance(f, str) else f(text) for f in finders]
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in found])


def first_match_extract(pages: DataFrame, fields: dict[str, list] | None = None,
                        id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """The named fields of every page, each by its ordered finders."""
    fields = fields or {"title": TITLE, "charset": CHARSET, "lang": LANG}
    return pages.select(id_col, *[first_match(F.col(html_col), finders).alias(name) for name, finders in fields.items()])
