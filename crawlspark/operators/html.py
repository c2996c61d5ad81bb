"""HTML operators: element scan, links, images and document references.

The scan is one left-to-right regular expression pass inside the JVM that follows the tokenizer of Python's
``html.parser``: comments, declarations, end tags and script or style text are stepped over, and each start tag is
returned. All loops are possessive, so long pages neither backtrack nor grow the stack. Comments and CDATA sections that
nothing closes are marked first, so no closing mark is looked for twice and the work grows with the text. It needs no shuffle
and no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark import constants as C
from crawlspark.functions import urls as U
from crawlspark.functions.entities import unescape
from crawlspark.functions.plan import computed_once
from crawlspark.operators import robots

_ATTRIBUTE = r"""(?<=['"\s/])([^\s/>][^\s/=>]*+)(?:\s*+=+\s*+('[^']*+'|"[^"]*+"|(?!['"])[^>\s]*+))?+"""
_ATTRIBUTES = r"(?:[\s/]|" + _ATTRIBUTE.replace("([^\\s/>]", "(?:[^\\s/>]").replace("('[^']", "(?:'[^']") + ")*+"
_TAG = r"<[a-zA-Z][^\t\n\r\f />\x00]*+" + _ATTRIBUTES + ">"
_RAW = "|".join(rf"<(?i:{n})(?=[\s/>]){_ATTRIBUTES}>(?:(?<=/>)|.*?(?:</\s*+(?i:{n})\s*+>|\z))"
                for n in ("script", "style"))
_BETWEEN = (r"(?:[^<]++|<!--(?:.*?--\s*+>|[^>]*+>?)|<!\[CDATA\[.*?\]\]>|<[!?/][^>]*+>?|<(?![a-zA-Z!?/])"
            rf"|(?!{_TAG})<[^>]*+>?)*+")
_SCAN = rf"(?s){_BETWEEN}(?:(?=({_TAG}))(?:{_RAW}|{_TAG})|\z)"


# Openings that need a closing mark, each with the text up to its last mark; a mark put into an opening voids it.
_CLOSED = {"<!--": r"(?s)\A.*--\s*+>", "<![CDATA[": r"(?s)\A.*\]\]>"}
_VOID = "\uffff"


def _voided(opening: str) -> str:
    return "<!" + _VOID + opening[2:]


def _void_unclosed(html: Column) -> Column:
    """Openings behind the last closing mark are made what they are to the tokenizer: declarations up to the next ``>``."""
    for opening, closed in _CLOSED.items():
        rest = F.regexp_replace(html, closed, "")
        head = F.substring(html, F.lit(1), F.length(html) - F.length(rest))
        html = F.when(html.contains(opening), F.concat(head, F.replace(rest, F.lit(opening), F.lit(_voided(opening))))).otherwise(html)
    return html


def start_tags(html: Column) -> Column:
    """Array of the start tag texts of a page, in document order."""
    tags = F.regexp_extract_all(_void_unclosed(html), F.lit(_SCAN), F.lit(1))

    def restored(tag: Column) -> Column:
        back = tag
        for opening in _CLOSED:
            back = F.replace(back, F.lit(_voided(opening)), F.lit(opening))
        return F.when(tag.contains(_VOID), back).otherwise(tag)

    return F.transform(F.filter(tags, lambda t: t != ""), restored)


def _unquote(raw: Column) -> Column:
    return F.regexp_replace(raw, r"""(?s)\A(['"])(.*)\1\z""", "$2")


def tag_name(tag: Column) -> Column:
    return F.lower(F.regexp_extract(tag, r"^<([a-zA-Z][^\t\n\r\f />\x00]*)", 1))


def _names(attributes: Column) -> Column:
    return F.transform(F.regexp_extract_all(attributes, F.lit("(?s)" + _ATTRIBUTE), F.lit(1)), F.lower)


def _raw_values(attributes: Column) -> Column:
    return F.regexp_extract_all(attributes, F.lit("(?s)" + _ATTRIBUTE), F.lit(2))


def _with_attributes(tags: DataFrame) -> DataFrame:
    """Stage attribute names and raw values of ``_tag``; the tag name is cut off first, as it may hold quotes."""
    rest = F.regexp_replace(F.col("_tag"), r"^<[a-zA-Z][^\t\n\r\f />\x00]*", "")
    tags = tags.withColumn("_rest", rest)
    return tags.withColumns({"_names": _names(F.col("_rest")), "_values": _raw_values(F.col("_rest"))})


def elements(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """One row per start tag: key, pos, tag, attrs (a repeated attribute keeps its last value, a bare one is '')."""
    tags = pages.select(key, F.posexplode(start_tags(F.col(html))).alias("pos", "_tag"))
    tags = _with_attributes(tags)
    names, values = F.col("_names"), F.col("_values")
    keep = F.array_distinct(names)
    last = F.transform(keep, lambda n: F.element_at(
        F.filter(F.arrays_zip(names.alias("n"), values.alias("v")), lambda p: p["n"] == n), -1)["v"])
    return tags.select(key, "pos", tag_name(F.col("_tag")).alias("tag"),
                       F.map_from_arrays(keep, F.transform(last, lambda v: unescape(_unquote(v)))).alias("attrs"))


def _attribute(name: str) -> Column:
    """Last value of one attribute from the staged ``_names`` and ``_values`` arrays; null if it is absent.

    Character references are still in it.
    """
    names, values = F.col("_names"), F.col("_values")
    at = F.size(names) - F.array_position(F.reverse(names), name).cast("int") + 1
    return F.when(F.array_contains(names, name), _unquote(F.element_at(values, at)))


def _selected(pages: DataFrame, carry: list[str], html: str, choose, columns: list[str]) -> DataFrame:
    """Explode only the chosen start tags, then read only the named attributes."""
    tags = pages.select(*carry, F.posexplode(F.filter(start_tags(F.col(html)), choose)).alias("pos", "_tag"))
    tags = _with_attributes(tags)
    tags = tags.select(*carry, "pos", tag_name(F.col("_tag")).alias("tag"), *[_attribute(c).alias(c) for c in columns])
    return computed_once(tags.withColumns({c: unescape(F.col(c)) for c in columns}))


def clickables(pages: DataFrame, carry: list[str], html: str = "html") -> DataFrame:
    """Anchors and elements with ``onclick``: carry columns, pos, tag, href, onclick."""
    found = _selected(pages, carry, html, lambda t: t.rlike(r"(?i)^<a[\s/>]|onclick"), ["href", "onclick"])
    return found.filter((F.col("tag") == "a") | F.col("onclick").isNotNull())


def onclick_assignment(onclick: Column) -> Column:
    """Target of ``location.href = "x"``; null if there is none, '' if the text is empty."""
    return F.when(onclick.rlike(C.ONCLICK_ASSIGN), F.regexp_extract(onclick, C.ONCLICK_ASSIGN, 1))


def onclick_call(onclick: Column) -> Column:
    """Target of ``location.assign('x')`` and the like."""
    return F.when(onclick.rlike(C.ONCLICK_CALL), F.regexp_extract(onclick, C.ONCLICK_CALL, 1))


def link_target(href: Column, onclick: Column) -> Column:
    """The href if it is a URL, else what ``onclick`` navigates to, else null."""
    return F.when(U.is_url(href), href).otherwise(F.coalesce(onclick_assignment(onclick), onclick_call(onclick)))


def link_candidates(pages: DataFrame, carry: list[str], html: str = "html") -> DataFrame:
    found = clickables(pages, carry, html)
    found = found.select(*carry, link_target(F.col("href"), F.col("onclick")).alias("target"))
    return computed_once(found).filter(F.col("target").isNotNull())


def filled_links(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
                 mode: str = "concat", pattern: str = C.ALLOWED_NETLOC) -> DataFrame:
    """Distinct completed links inside the allowed domains: key, host (of the source page), url.

    Only narrow columns leave the page scan, and equal links of one page fold before the shuffle.
    """
    based = pages.select(F.col(key), F.concat(U.scheme(F.col(url)), F.lit("://"), U.netloc(F.col(url))).alias("_base")
                         if mode == "concat" else F.col(url).alias("_base"), F.col(html))
    return _completed(link_candidates(based, [key, "_base"], html), key, mode, pattern)


def _completed(links: DataFrame, key: str, mode: str, pattern: str) -> DataFrame:
    links = links.select(key, U.netloc(F.col("_base")).alias("host"),
                         U.fill_url(F.col("target"), F.col("_base"), mode).alias("url"))
    return computed_once(links).filter(U.is_domain_allowed(F.col("url"), pattern)).distinct()


def scan(pages: DataFrame, carry: list[str], html: str = "html", extensions: list[str] | None = None) -> DataFrame:
    """What a crawl takes from a page, from one pass over its text: carry columns, pos, target, filename, content_type.

    One row per start tag that has a link target or is an image with a known extension; the same targets and images as
    :func:`link_candidates` and :func:`find_images` give. No shuffle: only these rows need to meet other tables.
    """
    found = _selected(pages, carry, html, lambda t: t.rlike(r"(?i)^<(?:a|img)[\s/>]|onclick"), ["href", "onclick", "src"])
    clickable = (F.col("tag") == "a") | F.col("onclick").isNotNull()
    found = found.select(*carry, "pos", F.when(clickable, link_target(F.col("href"), F.col("onclick"))).alias("target"),
                         F.when(F.col("tag") == "img", F.col("src")).alias("src"))
    found = computed_once(_named(found).withColumn("_known", F.lower("_ext").isin(extensions or C.IMAGE_EXTENSIONS)))
    found = found.filter(F.col("target").isNotNull() | F.col("_known"))
    return found.select(*carry, "pos", "target", F.when(F.col("_known"), _stem()).alias("filename"),
                        F.when(F.col("_known"), U.extension_type(F.col("_ext"))).alias("content_type"))


def scanned_links(scanned: DataFrame, pages: DataFrame, key: str, url: str, mode: str = "concat",
                  pattern: str = C.ALLOWED_NETLOC) -> DataFrame:
    """As :func:`filled_links`, of rows of :func:`scan` and the URLs of their pages."""
    base = F.concat(U.scheme(F.col(url)), F.lit("://"), U.netloc(F.col(url))) if mode == "concat" else F.col(url)
    targets = scanned.filter(F.col("target").isNotNull()).select(key, "target")
    return _completed(targets.join(pages.select(key, base.alias("_base")), key), key, mode, pattern)


def find_links(pages: DataFrame, policies: DataFrame | None = None, key: str = "page_id", url: str = "url",
               html: str = "html", mode: str = "concat", pattern: str = C.ALLOWED_NETLOC,
               robots_scope: str = "source") -> DataFrame:
    """Distinct canonical links per page: key, url. Robots and domain filters run on the uncanonical URL.

    ``policies`` (domain, policy) comes from :func:`crawlspark.operators.robots.policies`. With
    ``robots_scope="source"`` the rules of the page's own host judge every link; with ``"target"`` those of the link's.
    """
    links = filled_links(pages, key, url, html, mode, pattern)
    if policies is not None:
        source = robots_scope == "source"
        links = links.withColumn("domain", F.col("host") if source else U.netloc(F.col("url")))
        links = robots.filter_allowed(links, policies)
    return U.canonicalize(links.select(key, "url"), "url").distinct()


def find_images(pages: DataFrame, carry: list[str], html: str = "html",
                extensions: list[str] | None = None) -> DataFrame:
    """Images with a known extension: carry columns, pos, filename, content_type. Repeats stay."""
    found = _selected(pages, carry, html, lambda t: t.rlike(r"(?i)^<img[\s/>]"), ["src"])
    found = _named(found.filter(F.col("src").isNotNull()))
    return (found.filter(F.lower("_ext").isin(extensions or C.IMAGE_EXTENSIONS))
            .select(*carry, "pos", _stem().alias("filename"), U.extension_type(F.col("_ext")).alias("content_type")))


def _named(found: DataFrame) -> DataFrame:
    """Stage the file name and the extension of ``src``."""
    found = found.withColumn("_base", F.regexp_extract(U.path(F.col("src")), r"(?s)([^/]*)\z", 1))
    return found.withColumn("_ext", F.regexp_extract("_base", r"(?s)^\.*[^.].*?(\.[^.]*)\z", 1))


def _stem() -> Column:
    return F.substring(F.col("_base"), F.lit(1), F.length("_base") - F.length("_ext"))


def page_links(links: DataFrame) -> DataFrame:
    """Links that do not lead to documents."""
    return links.filter(~U.is_binary(F.col("url")))


def document_links(links: DataFrame, key: str = "page_id") -> DataFrame:
    """One row per distinct document URL of a page: key, url, data_type_code."""
    return (links.filter(U.is_binary(F.col("url")))
            .select(key, "url", U.document_type(F.col("url")).alias("data_type_code")))


def content_hash(html: Column) -> Column:
    return F.sha2(html, 256)


def link_counts(links: DataFrame, key: str = "page_id") -> DataFrame:
    """Links per page; ``links`` holds distinct (page, url) rows, so a plain count folds map-side."""
    return links.groupBy(key).agg(F.count(F.lit(1)).alias("n_links"))
