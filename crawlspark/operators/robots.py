"""robots.txt as tables: rules, verdicts, delays and sitemap names.

A robots file is one cell, so everything is computed inside its row with array functions and no shuffle. The text is
first rewritten to one tagged line per directive; a group is then "agent lines directly followed by rule lines".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark import constants as C
from crawlspark.functions import urls as U
from crawlspark.operators import skew

# Line ends, and the directive names with the tag each gets.
_LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"
_TAGS = {"user-agent": "A", "disallow": "D", "allow": "L", "crawl-delay": "C", "request-rate": "R", "sitemap": "S"}
_GROUP = r"(?md)^(?:A[^\n]*+\n)++(?:[DLCR][^\n]*+\n)++"
_EDGE_SPACE = r"(?U)^\s+|\s+$"


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, _EDGE_SPACE, "")


def _tidy_path(value: Column) -> Column:
    """A rule path without an empty query or fragment, percent-encoded."""
    return U.percent_encode(F.regexp_replace(F.regexp_replace(value, r"#\z", ""), r"\?(?=#|\z)", ""), "/")


def _directives(content: Column) -> Column:
    """Tagged lines: ``E`` for an empty line, tag and value for a directive; other lines are left out.

    Staged as one array function per step, so that no step is repeated in the expression of the next.
    """
    texts = F.transform(F.split(content, _LINE_END), lambda line: F.when(line == "", "\x00:").otherwise(
        _strip(F.regexp_replace(line, r"(?s)#.*\z", ""))))
    pairs = F.transform(texts, lambda text: F.struct(
        F.lower(_strip(F.regexp_extract(text, r"(?s)^([^:]*):", 1))).alias("name"),
        U.percent_decode(_strip(F.regexp_extract(text, r"(?s)^[^:]*:(.*)\z", 1))).alias("value")))
    tags = F.create_map(*[F.lit(x) for pair in {**_TAGS, "\x00": "E"}.items() for x in pair])
    lines = F.transform(pairs, lambda pair: F.concat(
        F.try_element_at(tags, pair["name"]),
        F.when(pair["name"].isin("allow", "disallow"), _tidy_path(pair["value"]))
        .otherwise(F.translate(pair["value"], "\n", " "))))
    return F.filter(lines, lambda x: x.isNotNull())


def _with_tag(lines: Column, letters: str) -> Column:
    return F.filter(lines, lambda x: F.lit(letters).contains(F.substring(x, 1, 1)) & (x != ""))


def _rest(line: Column) -> Column:
    return F.substring(line, 2, 2147483647)


def _group(block: Column) -> Column:
    lines = F.split(F.rtrim(block, F.lit("\n")), "\n")
    rules = F.transform(_with_tag(lines, "DL"), lambda x: F.struct(
        (x.startswith("L") | (x == "D")).alias("allow"), _rest(x).alias("path")))
    delays = F.filter(F.transform(_with_tag(lines, "C"), _rest), lambda x: x.rlike("^[0-9]+$"))
    rates = F.filter(F.transform(_with_tag(lines, "R"), _rest), lambda x: x.rlike(r"^\s*[0-9]+\s*/\s*[0-9]+\s*$"))
    return F.struct(F.transform(_with_tag(lines, "A"), _rest).alias("agents"), rules.alias("rules"),
                    F.try_element_at(delays, F.lit(-1)).try_cast("long").alias("delay"),
                    F.regexp_replace(F.try_element_at(rates, F.lit(-1)), r"\s|\b0+(?=[0-9])", "").alias("rate"))


def groups(content: Column) -> Column:
    """Array of (agents, rules, delay, rate) of a robots text; groups without agents or without rules are left out."""
    text = F.concat(F.array_join(_with_tag(_directives(content), "ADLCRE"), "\n"), F.lit("\n"))
    return F.transform(F.regexp_extract_all(text, F.lit(_GROUP), F.lit(0)), _group)


def robots_rules(files: DataFrame, domain: str = "domain", content: str = "content") -> DataFrame:
    """One row per rule: domain, group, agents, rule, allow, path, delay. Groups with only a delay keep one row."""
    found = files.select(domain, F.posexplode(groups(F.col(content))).alias("group", "_g"))
    found = found.select(domain, "group", F.col("_g.agents").alias("agents"), F.col("_g.delay").alias("delay"),
                         F.posexplode_outer("_g.rules").alias("rule", "_r"))
    return found.select(domain, "group", "agents", "rule", F.col("_r.allow").alias("allow"),
                        F.col("_r.path").alias("path"), "delay")


def _is_default(g: Column) -> Column:
    return F.array_contains(g["agents"], "*")


def _names(g: Column, agent: str) -> Column:
    ours = agent.split("/")[0].lower()
    return F.exists(g["agents"], lambda a: F.lit(ours).contains(F.lower(a)))


def chosen_group(found: Column, agent: str) -> Column:
    """First named group that fits ``agent``, else the first ``*`` group, else null."""
    return F.coalesce(F.get(F.filter(found, lambda g: ~_is_default(g) & _names(g, agent)), F.lit(0)),
                      F.get(F.filter(found, _is_default), F.lit(0)))


def mode(status: Column, content: Column) -> Column:
    """``none`` for 401, 403 and files that were not read, ``all`` for other 4xx, else ``rules``."""
    return (F.when(status.isin(401, 403), F.lit("none")).when(status.between(400, 499), F.lit("all"))
            .when(status.between(200, 399) & content.isNotNull(), F.lit("rules")).otherwise(F.lit("none")))


def with_policy(files: DataFrame, agent: str = C.DEFAULT_AGENT, status: Column | None = None,
                content: str = "content") -> DataFrame:
    """Add ``policy`` (mode, rules, delay) of one agent to each robots file."""
    files = files.withColumn("_groups", groups(F.col(content)))
    files = files.withColumn("_chosen", chosen_group(F.col("_groups"), agent))
    how = mode(F.col("http_status") if status is None else status, F.col(content))
    policy = F.struct(how.alias("mode"), F.col("_chosen.rules").alias("rules"),
                      F.when(how == "rules", F.col("_chosen.delay")).alias("delay"))
    return files.withColumn("policy", policy).drop("_groups", "_chosen")


def policies(files: DataFrame, agent: str = C.DEFAULT_AGENT) -> DataFrame:
    """domain, policy from ``robots_files`` (domain, http_status, content), one file per domain."""
    return with_policy(files, agent).select("domain", "policy")


def status_of(mode_name: Column) -> Column:
    """A status that stands for a kept mode: null counts as ``rules``."""
    return F.when(mode_name == "none", 403).when(mode_name == "all", 404).otherwise(200)


def saved_policies(sites: DataFrame, agent: str = C.DEFAULT_AGENT) -> DataFrame:
    """domain, policy from the robots text kept in ``site.robots_content``; the text alone doesn't tell why it is empty."""
    kept = with_policy(sites, agent, F.lit(200), "robots_content")
    return kept.select("domain", "policy")


def crawl_delays(files: DataFrame, agent: str = C.DEFAULT_AGENT, default: int = C.DEFAULT_DELAY_SECONDS) -> DataFrame:
    """domain, delay: the delay of the chosen group, or the default."""
    return policies(files, agent).select("domain", F.coalesce(F.col("policy.delay"), F.lit(default)).alias("delay"))


def _target(url: Column) -> Column:
    """What rules are matched against: everything behind the host, decoded once and encoded again."""
    behind = F.regexp_replace(U.percent_decode(url), r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?(?://[^/?#]*)?", "")
    encoded = _tidy_path(behind)
    return F.when(encoded == "", F.lit("/")).otherwise(encoded)


def can_fetch(policy: Column, target: Column) -> Column:
    """Verdict of a policy on a matching target: the first rule in file order that fits decides."""
    first = F.get(F.filter(policy["rules"], lambda r: F.startswith(target, r["path"])), F.lit(0))
    return (F.when(policy["mode"] == "all", True).when(policy["mode"] == "rules", F.coalesce(first["allow"], F.lit(True)))
            .otherwise(False))


def with_verdict(links: DataFrame, known: DataFrame, url: str = "url") -> DataFrame:
    """Add ``allowed`` to ``links`` (with column ``domain``). A domain without a policy was not read: not allowed.

    The rows of a large host are read by several tasks whatever they link to, so one link on all its pages is no hot key.
    """
    joined = skew.lookup(links.withColumn("_target", _target(F.col(url))), known, "domain")
    return joined.withColumn("allowed", can_fetch(F.col("policy"), F.col("_target"))).drop("_target", "policy")


def filter_allowed(links: DataFrame, known: DataFrame, url: str = "url") -> DataFrame:
    return with_verdict(links, known, url).filter("allowed").drop("allowed")


def sitemaps(content: Column) -> Column:
    """Array of the sitemap URLs a robots text names, in any group."""
    return F.transform(_with_tag(_directives(content), "S"), _rest)


def robots_sitemaps(files: DataFrame) -> DataFrame:
    """domain, pos, url of each sitemap line."""
    return files.filter(mode(F.col("http_status"), F.col("content")) == "rules").select(
        "domain", F.posexplode(sitemaps(F.col("content"))).alias("pos", "url"))


def sitemap_content(content: Column) -> Column:
    """Sitemap URLs joined by commas; null if there are none."""
    found = sitemaps(content)
    return F.when(F.size(found) > 0, F.array_join(found, ","))


def robots_text(content: Column) -> Column:
    """Normal form of a robots text: named groups in order, then the first ``*`` group; no sitemaps."""
    found = groups(content)
    ordered = F.concat(F.filter(found, lambda g: ~_is_default(g)), F.slice(F.filter(found, _is_default), 1, 1))

    def lines(g: Column) -> Column:
        return F.array_join(F.concat(
            F.transform(g["agents"], lambda a: F.concat(F.lit("User-agent: "), a)),
            F.array_compact(F.array(F.concat(F.lit("Crawl-delay: "), g["delay"].cast("string")),
                                    F.concat(F.lit("Request-rate: "), g["rate"]))),
            F.transform(g["rules"], lambda r: F.concat(
                F.when(r["allow"], F.lit("Allow")).otherwise(F.lit("Disallow")), F.lit(": "), r["path"]))), "\n")

    return F.array_join(F.transform(ordered, lines), "\n\n")


def site_columns(files: DataFrame) -> DataFrame:
    """domain, robots_content, sitemap_content as a site row keeps them."""
    read = mode(F.col("http_status"), F.col("content")) == "rules"
    return files.select("domain", F.when(read, robots_text(F.col("content"))).otherwise(F.lit("")).alias("robots_content"),
                        F.when(read, sitemap_content(F.col("content"))).alias("sitemap_content"))
