"""Block and allow decisions on urls, carried over redirects and canonical links.

A rule names a host and the beginning of a path; the longest rule that fits a
url decides it.  Urls that redirect to each other or name each other as canonical
are one resource under several addresses: connected components over those
links are its classes.  A url without a rule of its own takes the decision of
its class: block if a member is blocked by a rule, but allow as soon as a member
is explicitly allowed; without either it is allowed.  A rule of a url's own
always holds.

Everything is DataFrame expressions: no Python runs on the executors.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.components import connected_components
from basketry.llm.shared import save

#: (verdict, host and beginning of the path); fixed by the contract of the query.
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]

_COMMENT = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
_LINK = r"(?i)<link\s[^>]*>"
_META = r"(?i)<meta\s[^>]*>"
_CANONICAL = r"""(?i)\srel\s*=\s*["']?\s*canonical\s*(["'\s/>])"""
_REFRESH = r"""(?i)\shttp-equiv\s*=\s*["']?\s*refresh\s*(["'\s/>])"""
_HREF = r"""(?i)\shref\s*=\s*["']?\s*([^"'\s>]+)"""
_TARGET = r"""(?i)[;,"'\s]url\s*=\s*["']?\s*([^"'\s>]+)"""


def with_parts(rows: DataFrame, url: str) -> DataFrame:
    """``rows`` with ``host`` (A-Z lower-cased) and ``path`` of a url column; both
    are empty for null and without ``://``."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))
    split = rows.withColumn("_rest", rest)
    split = split.withColumn("host", F.translate(F.regexp_extract("_rest", "^([^/?#]*)", 1), ascii_uppercase, ascii_lowercase))
    return split.withColumn("path", F.regexp_extract("_rest", "^[^/?#]*([^?#]*)", 1)).drop("_rest")


def with_rule(rows: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """``rows`` with ``rule``, the longest that fits ``host`` and ``path``, and its
    verdict ``own``; both null if none fits.  Of two equally long rules an
    allowing one comes first."""
    by_length = sorted(rules, key=lambda r: (-len(r[1]), r[0] != "allow"))
    found, decided = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, text in reversed(by_length):
        name, slash, start = text.partition("/")
        on_host = (F.col("host") == name) | F.col("host").endswith(f".{name}")
        found = F.when(on_host & F.col("path").startswith(slash + start), text).otherwise(found)
    for text, decision in {text: decision for decision, text in reversed(by_length)}.items():
        decided = F.when(F.col("rule") == text, decision).otherwise(decided)
    return rows.withColumn("rule", found).withColumn("own", decided)


def with_address(rows: DataFrame, url: str, name: str) -> DataFrame:
    """``rows`` with the url as its server sees it: scheme and host lower-cased,
    without the part after ``#``; null without ``://``."""
    rows = rows.withColumn("_plain", F.regexp_extract(F.trim(F.col(url)), "^([^#]*)", 1))
    rows = rows.withColumn("_head", F.regexp_extract("_plain", "^([^:/?#]+://[^/?#]*)", 1))
    rows = rows.withColumn("_rest", F.substring("_plain", F.length("_head") + 1, F.length("_plain")))
    lowered = F.translate("_head", ascii_uppercase, ascii_lowercase)
    whole = F.concat(lowered, F.when(F.col("_rest") == "", "/").otherwise(F.col("_rest")))
    return rows.withColumn(name, F.when(F.col("_head") != "", whole)).drop("_plain", "_head", "_rest")


def _resolved(target: Column, base: Column) -> Column:
    """The url that ``target`` means on the page at the address ``base``."""
    site = F.regexp_extract(base, "^([^:]+://[^/?#]*)", 1)
    return (
        F.when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.startswith("//"), F.concat(F.regexp_extract(base, "^([^:]+:)", 1), target))
        .when(target.startswith("/"), F.concat(site, target))
        .when(target.startswith("?"), F.concat(F.regexp_extract(base, "^([^?#]*)", 1), target))
        .when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None).cast("string"))  # mailto:, javascript:
        .otherwise(F.concat(F.regexp_extract(base, "^([^:]+://[^/?#]*[^?#]*/)", 1), target))
    )


def alias_links(pages: DataFrame) -> DataFrame:
    """``(a, b)``: the address of a page and one that it redirects to (a meta
    refresh) or names as canonical.  Comments, scripts and styles are no markup.
    Pages without url or html have no links."""
    html = F.when(F.col("html").rlike("(?i)canonical|refresh"), F.regexp_replace("html", _COMMENT, ""))
    canonical = F.transform(
        F.filter(F.regexp_extract_all(html, F.lit(_LINK), F.lit(0)), lambda t: t.rlike(_CANONICAL)),
        lambda t: F.regexp_extract(t, _HREF, 1),
    )
    refresh = F.transform(
        F.filter(F.regexp_extract_all(html, F.lit(_META), F.lit(0)), lambda t: t.rlike(_REFRESH)),
        lambda t: F.regexp_extract(t, _TARGET, 1),
    )
    tags = pages.filter("url IS NOT NULL").select("url", F.explode(F.concat(canonical, refresh)).alias("target"))
    found = with_address(tags, "url", "a").withColumn("target", F.replace(F.trim("target"), F.lit("&amp;"), F.lit("&")))
    meant = F.when(F.col("target") != "", _resolved(F.col("target"), F.col("a")))
    found = with_address(found.withColumn("meant", meant), "meant", "b")
    # written before it is filtered: a filter pushed below would repeat all these expressions
    return save(found.select("a", "b"), "alias-links").filter("a IS NOT NULL AND b IS NOT NULL AND a != b")


def judged(pages: DataFrame, rules: list[tuple[str, str]], links: DataFrame | None = None) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for every row of ``pages (page_id, url, html)``.

    ``links``: further redirects as ``(a, b)`` urls, such as a crawler's log.  A
    null url, or one without ``://``, has no rule and no class: it is allowed.
    Rows that repeat a page_id or a url are judged one by one; other columns of
    ``pages`` are not read.  A column of classes is joined by address, so a
    very frequent address is left to skew-join handling; rows that need no class
    carry keys of their own and meet in no task.
    """
    edges = alias_links(pages)
    if links is not None:
        given = with_address(with_address(links.select("a", "b"), "a", "a"), "b", "b")
        edges = edges.union(given.filter("a IS NOT NULL AND b IS NOT NULL AND a != b"))
    members = save(connected_components(edges), "aliases")
    classes = with_rule(with_parts(members, "node"), rules).groupBy("component").agg(
        F.max(F.col("own") == "allow").alias("allowed"), F.max(F.col("own") == "block").alias("blocked")
    )
    spread = classes.filter("blocked AND NOT coalesce(allowed, false)").select("component")
    blocked = members.join(spread, "component", "left_semi").select(F.col("node").alias("key"), F.lit("block").alias("carried"))

    rows = with_rule(with_parts(pages.select("page_id", "url"), "url"), rules)
    rows = with_address(rows, "url", "key")
    alone = F.concat_ws(" ", F.lit("row"), F.col("page_id"), F.col("url"))  # no address: it has no scheme before ://
    rows = rows.withColumn("key", F.coalesce(F.when(F.col("rule").isNull(), F.col("key")), alone))
    kept = rows.drop("url").join(blocked, "key", "left")
    return kept.select("page_id", "host", "path", "rule", F.coalesce("own", "carried", F.lit("allow")).alias("verdict"))
