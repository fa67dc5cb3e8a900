"""URL filters with redirect equivalence.

Rules name a host and a path; a rule fits its host and all subdomains when the
url's path starts with the rule's path, and the longest fitting rule decides.
Urls that are one page under several names (a redirect by ``meta refresh`` or a
``rel=canonical`` link, read from the html) form components; a url without a
rule of its own takes its component's decision: allow where any member is
explicitly allowed, else block where any is blocked, else the default, allow.

The rules become one Spark expression; links are found with regular
expressions, and only pages that have any take part in the components.

Cases: a null url, or one without ``://``, has an empty host and path and no
rule, and is no alias of another. Relative link targets are resolved against the
page's url. Repeated rows get equal verdicts. Null or empty html has no links.
An empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .tables import col, materialize

#: (verdict, host, path)
Rule = tuple[str, str, str]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-cased (A-Z) host and the path of a url; both empty without ``://``."""
    rest = F.when(url.contains("://"), F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def deciding_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, null if none fits."""
    longest = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    out = F.lit(None)
    for verdict, name, start in reversed(longest):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out.cast("struct<rule:string,verdict:string>")


def alias_targets(html: Column) -> Column:
    """Targets of canonical links and refreshes, in order."""
    tags = F.regexp_extract_all(html, F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0))
    value = r"""(?is)\b{}\s*=\s*["']?\s*([^"'\s>]+)"""
    canonical = F.transform(F.filter(tags, lambda t: t.rlike(r"""(?is)\brel\s*=\s*["']?\s*canonical\b""")),
                            lambda t: F.regexp_extract(t, value.format("href"), 1))
    refresh = F.transform(F.filter(tags, lambda t: t.rlike(r"""(?is)\bhttp-equiv\s*=\s*["']?\s*refresh\b""")),
                          lambda t: F.regexp_extract(t, r"""(?is)\burl\s*=\s*["']?\s*([^"'\s>]+)""", 1))
    has = html.rlike("(?i)canonical|refresh")        # most pages stop here
    return F.when(has, F.filter(F.concat(canonical, refresh), lambda t: t != "")).otherwise(F.array().cast("array<string>"))


def resolved(target: Column, base: Column) -> Column:
    """A link target as an absolute url (scheme-relative, rooted and relative targets; ``..`` is left as it is)."""
    scheme = F.regexp_extract(base, r"^([^:/?#]+):", 1)
    root = F.regexp_extract(base, r"^[^:/?#]+://[^/?#]*", 0)
    folder = F.regexp_extract(F.regexp_extract(base, r"^[^?#]*", 0), r"^([^:/?#]+://[^/]*(?:/.*)?/)[^/]*$", 1)
    return (F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
            .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
            .when(target.startswith("/"), F.concat(root, target))
            .otherwise(F.concat(F.when(folder == "", F.concat(root, F.lit("/"))).otherwise(folder), target)))


def same_name(url: Column) -> Column:
    """The name a url is compared by: lower-case host, path, query; no scheme, no fragment."""
    host, path = host_and_path(url)
    query = F.regexp_extract(url, r"^[^?#]*(\?[^#]*)", 1)
    return F.concat(host, path, query)


def judged(pages: DataFrame, rules: list[Rule], id: str = "page_id", url: str = "url", html: str = "html",
           default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict for every page."""
    host, path = host_and_path(F.coalesce(col(url), F.lit("")))
    rows = pages.select(col(id).cast("long").alias("page_id"), col(url).alias("url"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("own", deciding_rule(F.col("host"), F.col("path"), rules))
    links = pages.filter(col(url).contains("://")).select(col(url).alias("url"), F.explode(alias_targets(col(html))).alias("target"))
    links = links.select("url", resolved(F.col("target"), F.col("url")).alias("target"))
    links = links.filter(F.col("target").contains("://"))
    edges, n = materialize(links.select(
        same_name(F.col("url")).alias("a"), same_name(F.col("target")).alias("b")).distinct(), "url-links", count=True)
    explicit = F.col("own.verdict")
    if not n:                                       # no link anywhere: every component is a single url
        verdict = F.coalesce(explicit, F.lit(default))
    else:
        known = connected_components(edges)
        h, p = host_and_path(F.concat(F.lit("x://"), F.col("node")))
        own = deciding_rule(h, p, rules)["verdict"]
        decided = known.select("component", own.alias("v")).groupBy("component").agg(
            F.max(F.col("v") == "allow").alias("allowed"), F.max(F.col("v") == "block").alias("blocked"))
        spread = F.when(F.col("allowed"), "allow").when(F.col("blocked"), "block")
        alias = known.join(decided, "component").select("node", spread.alias("alias")).filter("alias is not null")
        # Null urls and those without a host have no aliases; with a key of their own each they do not meet in a task.
        alone = F.concat(F.lit("\0"), F.monotonically_increasing_id().cast("string"))
        node = F.when(F.col("url").contains("://"), same_name(F.col("url"))).otherwise(alone)
        rows = rows.withColumn("node", node).join(materialize(alias, "url-aliases"), "node", "left")
        verdict = F.coalesce(explicit, F.col("alias"), F.lit(default))
    return rows.select("page_id", "host", "path", F.col("own.rule").alias("rule"), verdict.alias("verdict"))

