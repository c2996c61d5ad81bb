"""URL predicates and canonicalization as Spark columns.

Splitting follows RFC 3986 the way Python's ``urllib.parse`` applies it. ``parse_url`` is not used: it rejects URLs
with spaces and loses hosts with ``_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark import constants as C

# The parts of RFC 3986 appendix B, one pattern each so that none reads further than it must, and the
# schemes whose last path segment may carry ``;params``.
_SCHEME = r"^([a-zA-Z][a-zA-Z0-9+.\-]*+):"
_NETLOC = r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*+:)?+//([^/?#]*)"
_RAW_PATH = r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*+:)?+(?://[^/?#]*+)?+([^?#]*)"
_QUERY = r"^[^?#]*+\?([^#]*)"
_FRAGMENT = r"(?s)^[^#]*+#(.*)\z"
_PARAM_SCHEMES = ["", "ftp", "hdl", "prospero", "http", "https", "imap", "itms-services", "mms", "rtsp", "rtsps",
                  "rtspu", "sftp", "shttp", "sip", "sips", "tel"]
_PARAMS = r"(?s)^((?:.*/)?[^/;]*);([^/]*)\z"
_IP_LITERAL = r"^(?:[^@]*@)?\[(?:[0-9A-Fa-f:.]+(?:%[^\]]*)?|v[0-9A-Fa-f]+\.[^\]]+)\](?::[0-9]*)?$"

# Characters a canonical path keeps unescaped, besides letters, digits and ``_.-~``.
PATH_SAFE = "~:/?#[]@!$&'()*+,;="
_DOT_SCHEMES = ["", "http", "https", "ftp", "file"]


def _clean(url: Column) -> Column:
    """Leading control characters and spaces, and tabs or line breaks anywhere, are not part of a URL."""
    cleaned = F.translate(F.regexp_replace(url, r"^[\x00-\x20]+", ""), "\t\r\n", "")
    return F.when(url.rlike(r"^[\x00-\x20]|[\t\r\n]"), cleaned).otherwise(url)


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(_clean(url), _SCHEME, 1))


def netloc(url: Column) -> Column:
    return F.regexp_extract(_clean(url), _NETLOC, 1)


def raw_path(url: Column) -> Column:
    """Path with its ``;params`` still attached."""
    return F.regexp_extract(_clean(url), _RAW_PATH, 1)


def _has_params(url: Column) -> Column:
    return scheme(url).isin(_PARAM_SCHEMES) & raw_path(url).rlike(_PARAMS)


def path(url: Column) -> Column:
    p = raw_path(url)
    return F.when(_has_params(url), F.regexp_extract(p, _PARAMS, 1)).otherwise(p)


def params(url: Column) -> Column:
    p = raw_path(url)
    return F.when(_has_params(url), F.regexp_extract(p, _PARAMS, 2)).otherwise(F.lit(""))


def query(url: Column) -> Column:
    return F.regexp_extract(_clean(url), _QUERY, 1)


def fragment(url: Column) -> Column:
    return F.regexp_extract(_clean(url), _FRAGMENT, 1)


def split_url(url: Column) -> Column:
    """Struct of scheme, netloc, path, params, query and fragment; absent parts are empty strings."""
    return F.struct(scheme(url).alias("scheme"), netloc(url).alias("netloc"), path(url).alias("path"),
                    params(url).alias("params"), query(url).alias("query"), fragment(url).alias("fragment"))


def is_parseable(url: Column) -> Column:
    """False where a bracketed host is broken, which URL parsers reject."""
    host = netloc(url)
    return ~host.rlike(r"[\[\]]") | host.rlike(_IP_LITERAL)


def is_url(url: Column) -> Column:
    """http(s) or relative, with a host, a path or a fragment."""
    ok = (scheme(url).isin("", "http", "https") & is_parseable(url)
          & ((netloc(url) != "") | (path(url) != "") | (fragment(url) != "")))
    return F.coalesce(ok, F.lit(False))


def fill_url(url: Column, base: Column, mode: str = "concat") -> Column:
    """Complete a partial URL from ``base``.

    ``concat`` puts scheme and host of the base right before the text; ``rfc3986`` resolves the reference against the
    directory of the base path instead.
    """
    full = (scheme(url) != "") & (netloc(url) != "")
    origin = F.concat(scheme(base), F.lit("://"), netloc(base))
    if mode == "concat":
        return F.when(full, url).otherwise(F.concat(origin, url))
    if mode != "rfc3986":
        raise ValueError(f"unknown mode {mode!r}")
    p = raw_path(base)
    directory = F.when(p == "", F.lit("/")).otherwise(F.regexp_extract(p, r"(?s)^(.*/)?", 1))
    with_query = F.regexp_replace(base, r"(?s)#.*\z", "")
    without_query = F.regexp_replace(with_query, r"(?s)\?.*\z", "")
    return (F.when(scheme(url) != "", url)
            .when(url.startswith("//"), F.concat(scheme(base), F.lit(":"), url))
            .when(url.startswith("/"), F.concat(origin, url))
            .when((url == "") | url.startswith("#"), F.concat(with_query, url))
            .when(url.startswith("?"), F.concat(without_query, url))
            .otherwise(F.concat(origin, directory, url)))


def has_file_extension(url: Column) -> Column:
    """The last segment has a dot with something on both sides."""
    return url.rlike(r"/[^/]+\.[^/]+$")


def drop_query(url: Column) -> Column:
    return F.regexp_replace(url, r"(?s)\?.*\z", "")


def drop_fragment(url: Column) -> Column:
    return F.regexp_replace(url, r"(?s)#.*\z", "")


def end_with_slash(url: Column) -> Column:
    """Close every URL that is not a file with ``/``."""
    return F.when(has_file_extension(url) | url.endswith("/"), url).otherwise(F.concat(url, F.lit("/")))


def is_domain_allowed(url: Column, pattern: str = C.ALLOWED_NETLOC) -> Column:
    return netloc(url).rlike(pattern)


def document_type(url: Column, extensions: list[str] | None = None) -> Column:
    """Document type code when the URL ends with a known extension (case counts), else null."""
    names = [e[1:] for e in (extensions or C.BINARY_EXTENSIONS)]
    pattern = r"\.(" + "|".join(sorted(names, key=len, reverse=True)) + r")\z"
    found = F.regexp_extract(url, pattern, 1)
    return F.when(found != "", extension_type(F.concat(F.lit("."), found)))


def is_binary(url: Column, extensions: list[str] | None = None) -> Column:
    return document_type(url, extensions).isNotNull()


def extension_type(extension: Column) -> Column:
    """``.pdf`` to ``PDF``."""
    return F.upper(F.substring(extension, 2, 2147483647))


def needs_expansion(url: Column) -> Column:
    """True unless the URL is http(s) with a plain first label and at least two further letter-only labels."""
    return ~url.rlike(C.FULL_URL)


def site_key(host: Column) -> Column:
    return F.replace(host, F.lit("www."), F.lit(""))


def is_relative_path(url: Column) -> Column:
    return url.rlike(C.RELATIVE_URL)


def robots_url(url: Column) -> Column:
    return F.concat(scheme(url), F.lit("://"), netloc(url), F.lit("/robots.txt"))


def sitemap_url(url: Column) -> Column:
    return F.concat(scheme(url), F.lit("://"), netloc(url), F.lit("/sitemap.xml"))


def percent_decode(text: Column) -> Column:
    """Decode ``%XX`` as UTF-8; a ``%`` without two hex digits stays."""
    guarded = F.replace(F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25"), F.lit("+"), F.lit("%2B"))
    return F.when(text.contains("%"), F.url_decode(guarded)).otherwise(text)


def percent_encode(text: Column, safe: str = "/") -> Column:
    """Encode everything but letters, digits, ``_.-~`` and ``safe``; plain text takes the short way."""
    plain = "[A-Za-z0-9_.~" + "".join("\\" + c for c in safe) + "\\-]*"
    out = F.replace(F.url_encode(text), F.lit("+"), F.lit("%20"))
    if "*" not in safe:
        out = F.replace(out, F.lit("*"), F.lit("%2A"))
    for c in dict.fromkeys("~" + safe):
        if c != "*":
            out = F.replace(out, F.lit(f"%{ord(c):02X}"), F.lit(c))
    return F.when(text.rlike(rf"\A{plain}\z"), text).otherwise(out)


def composed(text: Column) -> Column:
    """Unicode's composed form (NFC) of a text, by the ICU library that Spark carries; plain ASCII takes the short way."""
    icu = F.try_reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text, F.lit(False))
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.coalesce(icu, text)).otherwise(text)


def remove_dot_segments(p: Column) -> Column:
    """Resolve ``.`` and ``..`` and merge repeated slashes. Only paths with a dot segment walk their segments."""
    merged = F.regexp_replace(p, "/{2,}", "/")
    last = F.element_at(F.split(p, "/"), -1)
    kept = F.aggregate(
        F.split(p, "/"),
        F.array().cast("array<string>"),
        lambda acc, part: F.when(part == "", F.when(F.size(acc) == 0, F.array(part)).otherwise(acc))
        .when(part == ".", acc)
        .when(part == "..", F.when(F.size(acc) > 1, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc))
        .otherwise(F.array_append(acc, part)))
    walked = F.array_join(F.when(last.isin(".", "..", ""), F.array_append(kept, F.lit(""))).otherwise(kept), "/")
    return F.when(p.rlike(r"(?:^|/)\.\.?(?:/|\z)"), walked).otherwise(merged)


def normalize_url(df: DataFrame, column: str, out: str | None = None, default_scheme: str = "https") -> DataFrame:
    """General normal form: scheme, case and IDNA form of the host, default port, composed and percent-encoded path, dot segments.

    A transform instead of a column, so that each part is computed once and read by name. Query and fragment are
    carried as they are. Names with non-ASCII letters go through the JDK's IDNA conversion, inside the JVM.
    """
    out = out or column
    u = F.col(column)
    schemeless = ~F.substring(u, 1, 7).contains(":")
    absolute = (F.when((u == "") | (u == "-") | ~schemeless, u)
                .when(u.startswith("//"), F.concat(F.lit(default_scheme + ":"), u))
                .when(u.startswith("/"), u)
                .otherwise(F.concat(F.lit(default_scheme + "://"), u)))
    tidy = F.trim(F.regexp_replace(F.replace(absolute, F.lit("#!"), F.lit("?_escaped_fragment_=")), "[?& ]+$", ""))
    df = df.withColumn("_nu", tidy)
    nu = F.col("_nu")
    df = df.withColumns({"_scheme": scheme(nu), "_netloc": netloc(nu), "_path": composed(percent_decode(raw_path(nu))),
                         "_rest": F.regexp_extract(nu, r"(?s)^[^?#]*(.*)\z", 1)})
    loc = F.col("_netloc")
    df = df.withColumns({
        "_user": F.regexp_extract(loc, r"^([^@]*@)?", 1),
        "_host": F.regexp_replace(F.lower(F.regexp_extract(loc, r"^(?:[^@]*@)?([^:]*)", 1)), r"^\.+|\.+$", ""),
        "_port": F.regexp_extract(loc, r"^(?:[^@]*@)?[^:]*:(.*)$", 1),
        "_path": percent_encode(F.col("_path"), PATH_SAFE),
    })
    host, port, sch, p = F.col("_host"), F.col("_port"), F.col("_scheme"), F.col("_path")
    df = df.withColumns({
        "_host": F.when(host.rlike(r"[^\x00-\x7F]"),
                        F.coalesce(F.try_reflect(F.lit("java.net.IDN"), F.lit("toASCII"), host), host))
        .otherwise(host),
        "_port": F.when(port.rlike("^[0-9]+$"), F.regexp_replace(port, "^0+(?=[0-9])", "")).otherwise(port),
        "_path": F.when(sch.isin(_DOT_SCHEMES), remove_dot_segments(p)).otherwise(p),
    })
    dropped = ((port == "") | ((sch == "http") & (port == "80")) | ((sch == "https") & (port == "443"))
               | ((sch == "ftp") & (port == "21")))
    user = F.when(F.col("_user").isin("@", ":@"), F.lit("")).otherwise(F.col("_user"))
    authority = F.concat(user, host, F.when(dropped, F.lit("")).otherwise(F.concat(F.lit(":"), port)))
    built = F.concat(
        F.when(sch != "", F.concat(sch, F.lit(":"))).otherwise(F.lit("")),
        F.when(authority != "", F.concat(F.lit("//"), authority)).otherwise(F.lit("")),
        F.when((p == "") & sch.isin("http", "https", "ftp", "file"), F.lit("/")).otherwise(p),
        F.col("_rest"))
    return (df.withColumn(out, F.when(nu == "", nu).otherwise(built))
            .drop("_nu", "_scheme", "_netloc", "_path", "_rest", "_user", "_host", "_port"))


def canonicalize(df: DataFrame, column: str, out: str | None = None, default_scheme: str = "https") -> DataFrame:
    """Canonical form: normal form without query and fragment, closed with ``/`` unless it is a file."""
    out = out or column
    df = normalize_url(df, column, out, default_scheme)
    df = df.withColumn(out, F.regexp_replace(F.col(out), r"(?s)[?#].*\z", ""))
    return df.withColumn(out, end_with_slash(F.col(out)))
