"""URL filter with redirect equivalence.

Rules ``(host, path, verdict)`` fit a host and its subdomains where the
url's path starts with the rule's; the longest fitting rule decides. Pages
that no rule decides inherit a block through redirects: a page's canonical
link and refresh redirect join its url with the target, connected components
of these edges are aliases of one resource, and a component that holds a
blocked url blocks its undecided members, unless it also holds an explicitly
allowed one (allow takes precedence). All others are allowed.

Scale: rules are matched by an equi-join on the host's suffixes of the
distinct (host, path) pairs, so neither the rules nor the urls need to fit
in memory (the planner broadcasts a small rule table by its own size check).
Edges come from the pages that hold one, components are computed by
distributed star steps; nothing but counts reaches the driver. A url that
many pages share is one row until the last join, which AQE may split.

Defined cases: a null url, or one without ``://``, has an empty host and
path, fits no rule, has no edge and is allowed; a null html has no edge; a
relative target, also one of a query alone, is resolved against the page's url
and its dot segments; a target that is no http url is ignored; a rule given twice counts once, two rules of one host and
path with opposite verdicts allow; repeated pages each get a row; empty
tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendstats.llm.common import ascii_lower, cut
from trendstats.llm.graph import connected_components

_LINK = r"(?is)<link\b[^>]*>"
_META = r"(?is)<meta\b[^>]*>"
_CANONICAL = r"(?is)\brel\s*=\s*[\"']?\s*canonical\b"
_REFRESH = r"(?is)\bhttp-equiv\s*=\s*[\"']?\s*refresh\b"
_HREF = r"(?is)\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
_TARGET = r"(?is)\burl\s*=\s*[\"']?([^\"'>\s]+)"


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rule rows from ``(host, path, verdict)`` literals."""
    return spark.createDataFrame(rules, "rule_host string, rule_path string, rule_verdict string")


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.coalesce(ascii_lower(rest), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def dotless(path: Column) -> Column:
    """A path without ``.`` and ``..`` segments (those above the root go)."""
    parts = F.split(path, "/", -1)

    def step(acc: Column, x: Column) -> Column:
        up = F.regexp_replace(acc, "/[^/]*$", "")
        return F.when(x == ".", acc).when(x == "..", up).otherwise(F.concat(acc, F.lit("/"), x))

    short = F.aggregate(F.slice(parts, F.lit(2), F.size(parts)), F.lit(""), step)
    short = F.concat(short, F.when(path.rlike(r"/\.\.?\z"), "/").otherwise(""))
    return F.when(path.contains("/."), short).otherwise(path)


def node_of(url: Column) -> Column:
    """One name for the forms of a url: no scheme, host in lower case, no dot
    segments, no fragment; null where there is no host."""
    query = F.regexp_extract(url, r"(?s)\A[^?#]*(\?[^#]*)", 1)
    name = F.concat(host_of(url), dotless(path_of(url)), query)
    return F.when(host_of(url) != "", name)


def _href(tag: Column) -> Column:
    return F.concat(*[F.regexp_extract(tag, _HREF, g) for g in (1, 2, 3)])


def _resolved(target: Column, url: Column) -> Column:
    """Absolute form of a link target on the page ``url``."""
    target = F.replace(F.trim(target), F.lit("&amp;"), F.lit("&"))
    scheme = F.regexp_extract(url, r"(?s)\A(.*?)://", 1)
    site = F.regexp_extract(url, r"(?s)\A(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(url, r"(?s)\A(.*?://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    folder = F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/")))
    return (
        F.when(target.rlike(r"(?i)\Ahttps?://"), target)
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(site, target))
        .when(target.startswith("?"), F.concat(F.regexp_extract(url, r"(?s)\A(.*?://[^?#]*)", 1), target))
        .when((target != "") & ~target.rlike(r"\A(?:[A-Za-z][A-Za-z0-9+.-]*:|#)"), F.concat(folder, target))
    )


def page_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Edges ``(a, b)`` between url names from canonical links and refresh
    redirects in the html."""
    html, url = F.col(html_col), F.col(url_col)
    some = pages.where(html.rlike(_CANONICAL) | html.rlike(_REFRESH)).where(url.contains("://"))
    links = F.filter(F.regexp_extract_all(html, F.lit(_LINK), F.lit(0)), lambda t: t.rlike(_CANONICAL))
    metas = F.filter(F.regexp_extract_all(html, F.lit(_META), F.lit(0)), lambda t: t.rlike(_REFRESH))
    targets = F.concat(F.transform(links, _href), F.transform(metas, lambda t: F.regexp_extract(t, _TARGET, 1)))
    found = some.select(url.alias("u"), F.explode(targets).alias("t"))
    return found.select(node_of(F.col("u")).alias("a"), node_of(_resolved(F.col("t"), F.col("u"))).alias("b")).where(
        "a is not null and b is not null"
    )


def matched(places: DataFrame, rules: DataFrame) -> DataFrame:
    """The longest fitting rule of each distinct ``(host, path)``:
    ``host, path, rule, rule_verdict`` (pairs without a rule are left out)."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    probes = places.where(F.col("host") != "").select("host", "path", F.explode(suffixes).alias("rule_host"))
    fits = probes.join(rules, "rule_host").where(F.col("path").startswith(F.col("rule_path")))
    rule = F.concat("rule_host", "rule_path")
    best = F.max(F.struct(F.length(rule).alias("n"), (F.col("rule_verdict") == "allow").alias("allow"), rule.alias("rule")))
    return fits.groupBy("host", "path").agg(best.alias("best")).select(
        "host", "path", F.col("best.rule").alias("rule"), F.when(F.col("best.allow"), "allow").otherwise("block").alias("rule_verdict")
    )


def judge(
    pages: DataFrame,
    rules: DataFrame,
    redirects: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """``page_id, host, path, rule, verdict, component``: one row a page.
    ``redirects`` are further ``(from_url, to_url)`` edges."""
    rules = rules.select(ascii_lower(F.col("rule_host")).alias("rule_host"), "rule_path", "rule_verdict").distinct()
    edges = page_edges(pages, url_col, html_col)
    if redirects is not None:
        more = redirects.select(node_of(F.col("from_url")).alias("a"), node_of(F.col("to_url")).alias("b"))
        edges = edges.union(more.where("a is not null and b is not null"))
    aliases = connected_components(edges)

    url = F.col(url_col)
    slim = pages.select(
        F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), node_of(url).alias("node")
    )
    own = cut(matched(slim.select("host", "path").distinct(), rules))
    # every member of a component, page or bare target, with its own rule
    member = F.concat(F.lit("x://"), F.col("node"))
    members = aliases.select("component", host_of(member).alias("host"), path_of(member).alias("path"))
    decided = matched(members.select("host", "path").distinct(), rules)
    verdicts = members.join(decided, ["host", "path"]).groupBy("component").agg(
        F.max((F.col("rule_verdict") == "allow").cast("int")).alias("any_allow"),
        F.max((F.col("rule_verdict") == "block").cast("int")).alias("any_block"),
    )
    spread = aliases.join(verdicts, "component", "left").select(
        "node", "component", ((F.col("any_block") == 1) & (F.col("any_allow") == 0)).alias("blocked")
    )
    out = slim.join(own, ["host", "path"], "left").join(spread, "node", "left")
    inherited = F.when(F.coalesce("blocked", F.lit(False)), "block").otherwise("allow")
    return out.select(
        "page_id", "host", "path", "rule", F.coalesce("rule_verdict", inherited).alias("verdict"),
        F.coalesce("component", "node").alias("component"),
    )
