"""URL filters with redirect equivalence, in DataFrame operations only.

Rules are (host, path) prefixes that block or allow; the longest that fits a URL decides. Redirects and
canonical links make URLs aliases of each other: the distributed connected components over those edges are
found, and a URL that no rule fits takes the decision of its component: allow if an explicit allow rule fits
any member, else block if a block rule fits any member, else allow. A URL's own rule always stands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgrid.llm.common import ascii_lower, materialize
from loomgrid.llm.components import connected_components

#: Rules (host and path as one string, verdict) in one expression; more than this are joined.
MOST_RULES = 2000


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty if the URL is null or has none."""
    place = F.instr(url, "://")
    return F.when(place > 0, F.substring(url, place + F.lit(3), F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest fitting rule as a struct (rule, verdict), or null.

    A rule ``host/path`` fits a host that is its own or a subdomain, and paths that start with its path. Rules are tried
    from the longest on; of equal lengths, allow first, then by the string.
    """
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: (-len(r[0]), r[1] != "allow", r[0]), reverse=True):
        own_host, slash, own_path = rule.partition("/")
        fits = ((host == F.lit(own_host)) | F.endswith(host, F.lit("." + own_host))) & F.startswith(path, F.lit(slash + own_path))
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def with_rules(rows: DataFrame, rules: list[tuple[str, str]], most: int = MOST_RULES) -> DataFrame:
    """``rows(key, host, path)`` with the longest fitting rule as ``own``, as ``rule_for`` has it.

    Beyond ``most`` rules these are a table: each host meets the rules of its suffixes, which say at what lengths to cut the
    path, and host and cut path meet their rule. Both are joins on equal keys.
    """
    if len(rules) <= most:
        return rows.withColumn("own", rule_for(F.col("host"), F.col("path"), rules))
    parts = [(*(r.partition("/")[::2]), "/" in r, r, v) for r, v in rules]
    table = rows.sparkSession.createDataFrame([(h, ("/" if slash else "") + p, r, v) for h, p, slash, r, v in parts], "rule_host string, start string, rule string, verdict string")
    table = materialize(table.groupBy("rule_host", "start", "rule").agg(F.min("verdict").alias("verdict")))
    lengths = materialize(table.groupBy("rule_host").agg(F.collect_set(F.length("start")).alias("lengths")))
    places = materialize(rows.select("host", "path").distinct())
    labels = F.split("host", r"\.")
    suffixes = places.select("host", "path", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("rule_host"))
    cuts = suffixes.join(lengths, "rule_host").select("host", "path", "rule_host", F.explode("lengths").alias("length"))
    cuts = cuts.where(F.length("path") >= F.col("length")).withColumn("start", F.substring("path", F.lit(1), F.col("length")))
    # the longest; of equal ones allow, then by the string
    order = F.struct((-F.length("rule")).alias("a"), (F.col("verdict") != "allow").alias("b"), F.col("rule"))
    best = cuts.join(table, ["rule_host", "start"]).groupBy("host", "path").agg(F.min_by(F.struct("rule", "verdict"), order).alias("own"))
    return rows.join(materialize(best), ["host", "path"], "left")


def without_dots(path: Column) -> Column:
    """A path (and what follows it) without ``.`` and ``..`` segments."""
    plain, rest = F.regexp_extract(path, r"^[^?#]*", 0), F.regexp_extract(path, r"(?s)^[^?#]*(.*)$", 1)
    segments = F.split(F.substring(plain, F.lit(2), F.length(plain)), "/")
    step = lambda done, x: F.when(x == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).when(x == ".", done).otherwise(F.concat(done, F.array(x)))
    done = F.aggregate(segments, F.array().cast("array<string>"), step)
    ended = F.when(plain.rlike(r"/\.\.?$") & (F.size(done) > 0), F.lit("/")).otherwise(F.lit(""))
    return F.when(plain.rlike(r"^/(.*/)?\.\.?(/|$)"), F.concat(F.lit("/"), F.array_join(done, "/"), ended, rest)).otherwise(path)


def alias_key(url: Column) -> Column:
    """The node of a URL: host, path and query; the scheme and the fragment don't part aliases, nor do dot segments."""
    rest = F.regexp_extract(after_scheme(url), r"^[^/?#]*([^#]*)", 1)
    return F.concat(host_of(url), without_dots(F.when(F.startswith(rest, F.lit("/")), rest).otherwise(F.concat(F.lit("/"), rest))))


def resolve(base: Column, target: Column) -> Column:
    """A link's target as a URL without dot segments, seen from the page's own; null if it names no page."""
    target = F.replace(F.trim(target), F.lit("&amp;"), F.lit("&"))
    root = F.concat(F.lit("http://"), host_of(base))
    folder = F.regexp_extract(path_of(base), r"^(.*/)", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    whole = (
        F.when(target.rlike(r"^(?i)https?://"), target)
        .when(F.startswith(target, F.lit("//")), F.concat(F.lit("http:"), target))
        .when((target == "") | target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:") | F.startswith(target, F.lit("#")), F.lit(None))
        .when(F.startswith(target, F.lit("/")), F.concat(root, target))
        .otherwise(F.concat(root, folder, target))
    )
    front, rest = F.regexp_extract(whole, r"^[^:]*://[^/?#]*", 0), F.regexp_extract(whole, r"(?s)^[^:]*://[^/?#]*(.*)$", 1)
    return F.concat(front, without_dots(rest))


def link_edges(pages: DataFrame, url_column: str = "url", html_column: str = "html") -> DataFrame:
    """``(source, target)`` URLs of canonical links and of redirects (meta refresh, after whatever delay) in the pages, but not in their
    comments. Rows that repeat give their links again; pages without a URL or HTML, and empty tables, give none; HTML of any length is
    searched as a whole."""
    attribute = lambda name: rf"""(?is)\b{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    value = lambda tag, name: F.concat(*(F.regexp_extract(tag, attribute(name), k) for k in (1, 2, 3)))
    html = F.col(html_column)
    tags = (
        pages.where(F.col(url_column).isNotNull() & html.rlike(r"(?i)\bcanonical\b|\brefresh\b"))
        .select(F.col(url_column).alias("source"), F.explode(F.regexp_extract_all(F.regexp_replace(html, r"(?s)<!--.*?-->", ""), F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0))).alias("tag"))
    )
    canonical = F.when(F.lower(value(F.col("tag"), "rel")).rlike(r"(^|\s)canonical(\s|$)"), value(F.col("tag"), "href"))
    refresh = F.when(F.lower(value(F.col("tag"), "http-equiv")) == "refresh", F.regexp_extract(value(F.col("tag"), "content"), r"(?is)^[^;,]*[;,]\s*url\s*=\s*['\"]?([^'\"]*)", 1))
    target = resolve(F.col("source"), F.when(F.lower(F.col("tag")).startswith("<link"), canonical).otherwise(refresh))
    return tags.select("source", target.alias("target")).where(F.col("target").isNotNull())


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], edges: DataFrame, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """One row per page: ``<id>, host, path, rule, verdict, propagated`` (whether the component decided).

    ``edges(source, target)`` are aliases between URLs, whether or not ``pages`` has them. A null URL or one without
    ``://`` has an empty host and path, no rule and no aliases, and is allowed. Repeated pages are judged
    alike; other columns are ignored; empty tables give empty results.
    """
    url = F.col(url_column)
    named = pages.select(F.col(id_column).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"), F.when(host_of(url) != "", alias_key(url)).alias("key"))
    judged = with_rules(named, rules)
    linked = materialize(edges.select(alias_key(F.col("source")).alias("source"), alias_key(F.col("target")).alias("target"), F.explode(F.array("source", "target")).alias("url")))
    ends = with_rules(linked.select(alias_key(F.col("url")).alias("key"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")), rules)
    numbered = linked.select(F.xxhash64("source").alias("a"), F.xxhash64("target").alias("b"))
    parts = connected_components(numbered)
    # the decisions of a component: of its pages and of other ends of edges
    nodes = ends.select("key", "own")
    decided = nodes.union(judged.where(F.col("own").isNotNull() & F.col("key").isNotNull()).select("key", "own")).where(F.col("own").isNotNull())
    votes = (
        decided.select(F.xxhash64("key").alias("node"), (F.col("own.verdict") == "allow").alias("allow"))
        .groupBy("node").agg(F.max("allow").alias("allow"))
        .join(parts, "node")
        .groupBy("component")
        .agg(F.max("allow").alias("allow"))
    )
    verdicts = materialize(parts.join(votes, "component").select("node", F.when(F.col("allow"), "allow").otherwise("block").alias("verdict")))
    out = judged.withColumn("node", F.when(F.col("own").isNull(), F.xxhash64("key"))).join(verdicts, "node", "left")
    return out.select(
        F.col("id").alias(id_column),
        "host",
        "path",
        F.col("own.rule").alias("rule"),
        F.coalesce("own.verdict", "verdict", F.lit("allow")).alias("verdict"),
        (F.col("own").isNull() & F.col("verdict").isNotNull()).alias("propagated"),
    )
