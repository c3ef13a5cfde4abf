"""URL rules, and block decisions carried over redirects and canonical links.

A url is judged by the longest rule that fits it.  A url without a rule is blocked if it is an
alias of a blocked one: urls are tied by redirects and canonical links, the connected parts of
that graph are found with Spark joins, and one blocked member blocks the rest of its part.  An
explicit allow is never overruled by such an alias.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkledger.llm.common import components, staged, wide_id

#: (allow or block, host, path prefix)
Rule = tuple[str, str, str]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\??[^#]*)"
#: Query parameters that name where a visitor came from, not a page.
TRACKING = r"(?i)(?<=[?&])(?:utm_[a-z]+|ref|fbclid|gclid)=[^&]*&?"
#: Rules up to this number are one expression; more are joined.
INLINE_RULES = 64


def _part(url: Column, group: int) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, group), F.lit(""))


def host_of(url: Column) -> Column:
    """From after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(_part(url, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; else empty."""
    return _part(url, 2)


def node_of(url: Column) -> Column:
    """The id of what a url names: without scheme, fragment and tracking parameters.

    Urls without a host have no id: they are aliases of nothing.
    """
    query = F.regexp_replace(F.regexp_replace(_part(url, 3), TRACKING, ""), "[?&]$", "")
    return F.when(host_of(url) != "", wide_id(F.concat(host_of(url), F.lit(" "), path_of(url), query)))


def _ranked(rules: list[Rule]) -> list[Rule]:
    """Longest first; of equally long ones an allow first, then by the rule's text."""
    return sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "allow", r[1] + r[2]))


def _inline(df: DataFrame, rules: list[Rule]) -> DataFrame:
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, host, path in reversed(_ranked(rules)):
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return df.withColumns({"rule": rule, "ruled": verdict})


def _joined(df: DataFrame, rules: DataFrame) -> DataFrame:
    """The same by equality of host ends and path beginnings, for rule tables of any size."""
    lengths = [r[0] for r in rules.select(F.length("path")).distinct().collect()]  # at most the longest rule's length
    table = rules.select(F.col("host").alias("_end"), F.col("path").alias("_start"), "verdict").distinct()
    labels = F.split("host", r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    pairs = (df.select("host", "path").distinct()
             .withColumn("_end", F.explode(ends)).withColumn("_n", F.explode(F.array(*[F.lit(n) for n in sorted(lengths)])))
             .filter(F.length("path") >= F.col("_n"))
             .withColumn("_start", F.substring("path", F.lit(1), F.col("_n"))))
    length = F.length("_end") + F.length("_start")
    best = (pairs.join(table, ["_end", "_start"]).groupBy("host", "path")
            .agg(F.min(F.struct(-length, F.col("verdict") != "allow", F.concat("_end", "_start").alias("rule"), "verdict"))
                 .alias("_best")))
    found = best.select("host", "path", F.col("_best.rule").alias("rule"), F.col("_best.verdict").alias("ruled"))
    return df.join(found, ["host", "path"], "left")


def judged(df: DataFrame, rules: list[Rule] | DataFrame, url: str = "url") -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule`` and ``ruled`` (the rule's verdict); both null without a rule.

    A rule fits its host and all hosts below it if the path starts with the rule's; the longest
    wins, of equally long ones an allow.  ``rules``: a list, or a DataFrame (verdict, host, path).
    """
    split = df.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    if isinstance(rules, list) and len(rules) > INLINE_RULES:
        rules = df.sparkSession.createDataFrame(rules, "verdict string, host string, path string")
    return _inline(split, rules) if isinstance(rules, list) else _joined(split, rules)


def _without_dots(path: Column) -> Column:
    """A path that begins with ``/``, without ``.`` and ``..`` segments; ``..`` does not go above the root."""
    names = F.split(F.substr(path, F.lit(2)), "/", -1)
    kept = F.aggregate(names, F.array().cast("array<string>"), lambda seen, x: F.when(x == ".", seen).when(
        x == "..", F.slice(seen, F.lit(1), F.greatest(F.size(seen) - 1, F.lit(0)))).otherwise(F.concat(seen, F.array(x))))
    end = F.when(path.rlike(r"/\.\.?$") & (F.size(kept) > 0), "/").otherwise("")
    return F.when(path.rlike(r"/\.\.?(?:/|$)"), F.concat(F.lit("/"), F.array_join(kept, "/"), end)).otherwise(path)


def _resolved(target: Column, url: Column) -> Column:
    """The url a target means on a page: absolute, or relative to the scheme, host, path or query of ``url``; null for other schemes."""
    scheme, host, path = F.regexp_extract(url, r"(?s)^(.*?)://", 1), _part(url, 1), path_of(url)
    name, rest = F.regexp_extract(target, r"(?s)^([^?#]*)", 1), F.regexp_extract(target, r"(?s)^[^?#]*(.*)$", 1)
    folder = F.when(path == "", "/").otherwise(F.regexp_extract(path, r"(?s)^(.*/)", 1))
    below = F.when(name == "", path).when(name.startswith("/"), _without_dots(name)).otherwise(_without_dots(F.concat(folder, name)))
    relative = F.when(host != "", F.concat(scheme, F.lit("://"), host, below, rest))
    return (F.when(target.rlike(r"(?i)^[a-z][a-z0-9+.-]*://"), target).when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
            .when(target.rlike(r"(?i)^[a-z][a-z0-9+.-]*:"), None).otherwise(relative))


def declared_links(html: Column, url: Column) -> Column:
    """Array of the urls a page names as its canonical form or refreshes to, made absolute; ``&amp;`` is decoded."""
    tags = F.when(html.rlike(r"(?i)canonical|refresh"), F.regexp_extract_all(html, F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0)))
    target = F.transform(F.coalesce(tags, F.array().cast("array<string>")), lambda tag: F.when(
        tag.rlike(r"(?i)\brel\s*=\s*[\"']?canonical\b"), F.regexp_extract(tag, r"(?i)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1)).when(
        tag.rlike(r"(?i)\bhttp-equiv\s*=\s*[\"']?refresh\b"), F.regexp_extract(tag, r"(?i)\burl\s*=\s*['\"]?([^\"'\s>]+)", 1)))
    named = F.filter(target, lambda t: F.coalesce(t, F.lit("")) != "")
    absolute = F.transform(named, lambda t: _resolved(F.regexp_replace(t, "(?i)&(?:amp|#38|#x26);", "&"), url))
    return F.filter(absolute, lambda t: t.isNotNull())


def filter_urls(pages: DataFrame, rules: list[Rule] | DataFrame, redirects: DataFrame | None = None,
                key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``(page_id, host, path, rule, verdict, aliased)`` for each row of ``pages``.

    ``verdict`` is the rule's where one fits.  Else it is ``block`` if any url tied to this one
    (``aliased`` is then true) is blocked by a rule, and ``allow`` otherwise.  Ties are the links
    pages declare, ``redirects`` (two columns: from, to) and equal urls but for scheme, fragment
    and tracking parameters; their targets need not be pages themselves.

    Null urls and urls without ``://`` have an empty host and path, no rule and no ties, and are
    allowed.  Null html declares nothing.  Repeated rows are judged each.
    """
    rows = staged(judged(pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"),
                                      declared_links(F.col(html), F.col(url)).alias("links")), rules)
                  .withColumn("node", node_of(F.col("url"))), "urls")
    declared = rows.filter(F.size("links") > 0).select("url", F.explode("links").alias("target"))
    if redirects is not None:
        declared = declared.unionAll(redirects.select(*[F.col(c).alias(a) for c, a in zip(redirects.columns, ("url", "target"))]))
    ties = staged(declared.distinct(), "url-ties")
    parts = components(ties.select(node_of(F.col("url")).alias("a"), node_of(F.col("target")).alias("b")), "a", "b", "urls")
    # what rules block: pages, and ends of ties that are no pages
    ends = judged(ties.select(F.explode(F.array("url", "target")).alias("url")).distinct(), rules)
    blocked = (rows.filter("ruled = 'block'").select("node")
               .unionAll(ends.filter("ruled = 'block'").select(node_of(F.col("url")).alias("node")))
               .filter("node IS NOT NULL").distinct())
    bad = parts.join(blocked, "node", "left_semi").select("component").distinct()
    reached = blocked.unionAll(parts.join(bad, "component", "left_semi").select("node")).distinct()
    # only urls without a rule ask for their aliases
    asked = F.when(F.col("ruled").isNull(), F.col("node"))
    marked = (rows.withColumn("_asked", asked)
              .join(reached.select(F.col("node").alias("_asked"), F.lit(True).alias("_hit")), "_asked", "left"))
    aliased = F.coalesce("_hit", F.lit(False))
    verdict = F.coalesce("ruled", F.when(aliased, "block").otherwise("allow"))
    return marked.select("page_id", "host", "path", "rule", verdict.alias("verdict"), aliased.alias("aliased"))
