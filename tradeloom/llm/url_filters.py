"""URL filters whose block decisions reach a blocked page's aliases.

A rule names a host and the start of a path; it fits the host and all its subdomains, and of the
rules that fit a URL the longest decides. Redirects and canonical links make URLs equivalent:
their connected components are found over all edges, and a URL that no rule fits takes the
decision of its component. An explicit allow comes before a block there, as a rule of the URL
itself comes before both; URLs without either are allowed.

Edges are a page's canonical link, its refresh target, any table of redirects, and the forms of
a URL that servers redirect to each other (scheme, ``www.``, fragment, tracking parameters, a
closing slash, ``index.html``, ``.html``).

Targets are resolved against the page as a browser does: whole URLs, ``//host``, ``/path``, ``?query``,
``../path``, ``path``; entities of the ampersand are decoded. An empty target, a fragment alone and other
schemes (``mailto:``) are no links; on a page without a host only whole URLs are.

NULL URLs and URLs without ``://`` have an empty host and path, fit no rule, have no aliases and
are allowed. Repeated pages get a row each. NULL or empty HTML has no links.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import sized
from tradeloom.llm.components import components
from tradeloom.session import written

#: Action, host, start of the path.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Query parameters that do not change the page.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"


def _rest(url: Column) -> Column:
    at = F.locate("://", F.coalesce(url, F.lit("")))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), CAPITALS, SMALL)


def path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def form(url: Column) -> Column:
    """The form of a URL that its variants redirect to; NULL without a host."""
    name = F.regexp_replace(F.regexp_replace(host(url), r":(80|443)$", ""), r"^www\.", "")
    place = F.regexp_replace(path(url), r"(/index)?(\.html)?/*$", "")
    asked = F.split(F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1), "&")
    kept = F.array_join(F.array_sort(F.filter(asked, lambda x: (x != "") & ~x.rlike(TRACKING))), "&")
    return F.when(name != "", F.concat(F.lit("https://"), name, place, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit(""))))


def resolved(page: Column, target: Column) -> Column:
    """The URL that a link on a page leads to; NULL if it leads nowhere."""
    target = F.trim(F.regexp_replace(F.coalesce(target, F.lit("")), r"(?i)&(amp|#38|#x26);", "&"))
    whole, site = target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), F.regexp_extract(page, r"^[^/?#]*://[^/?#]+", 0)
    scheme, here = F.regexp_extract(page, r"^[^/?#]*:", 0), path(page)
    asked, own = F.regexp_extract(target, r"^[^?#]*(.*)$", 1), F.regexp_extract(target, r"^[^?#]*", 0)
    folder = F.concat(F.when(here.startswith("/"), F.lit("")).otherwise(F.lit("/")), F.regexp_extract(here, r"^.*/", 0))
    place = F.when(own == "", here).when(own.startswith("/"), own).otherwise(F.concat(folder, own))
    up = lambda kept, x: F.when(x == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))).when(x == ".", kept).otherwise(F.array_append(kept, x))
    parts = F.aggregate(F.split(F.regexp_replace(place, r"^/", ""), "/"), F.array().cast("array<string>"), up)
    # A path that ends in a dot segment is a folder.
    straight = F.concat(F.lit("/"), F.array_join(parts, "/"), F.when(place.rlike(r"/\.\.?$") & (F.size(parts) > 0), F.lit("/")).otherwise(F.lit("")))
    dotted = place.rlike(r"(^|/)\.\.?(/|$)")
    return (
        F.when((target == "") | target.startswith("#"), None)
        .when(whole, target)
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:") | (site == ""), None)
        .when(target.startswith("//"), F.concat(scheme, target))
        .otherwise(F.concat(site, F.when(dotted, straight).otherwise(place), asked))
    )


def page_links(pages: DataFrame) -> DataFrame:
    """Canonical links and refresh targets as edges ``(a, b)`` of URLs."""

    def target(tag: str, attribute: str) -> Column:
        # A quoted value may hold blanks and the other quote.
        found = F.regexp_extract("html", tag, 0)
        values = [F.regexp_extract(found, attribute + value, 1) for value in (r"\s*'([^']*)'", r'\s*"([^"]*)"', r"\s*([^\"'\s>]+)")]
        return resolved(F.col("url"), F.coalesce(*[F.nullif(v, F.lit("")) for v in values]))

    canonical = target(r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>", r"(?is)\bhref\s*=")
    refresh = target(r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>", r"(?is)\burl\s*=")
    return pages.filter(F.col("html").rlike(r"(?i)canonical|refresh")).select(F.col("url").alias("a"), F.explode(F.array(canonical, refresh)).alias("b")).filter("b IS NOT NULL")


def longest_rules(urls: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``(url, rule, action)`` for the distinct URLs that a rule fits; ``urls`` has url, host, path."""
    known = urls.sparkSession.createDataFrame(list(rules), "action string, rule_host string, start string").distinct()
    labels = F.split("host", r"\.")
    last = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(labels, i, last), "."))
    tried = urls.select("url", "path", F.explode(suffixes).alias("rule_host"))
    fit = tried.join(sized(known, len(rules), 256), "rule_host").filter(F.col("path").startswith(F.col("start")))
    rule = F.concat("rule_host", "start")
    best = fit.groupBy("url").agg(F.max(F.struct(F.length(rule).alias("n"), rule.alias("rule"), "action")).alias("best"))
    return best.select("url", "best.rule", "best.action")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict. ``redirects`` has columns a and b."""
    links = written(page_links(pages), "page_links")
    if redirects is not None:
        links = links.unionByName(redirects.select("a", "b"))
    named = pages.select("url").unionByName(links.select(F.explode(F.array("a", "b")).alias("url"))).filter("url IS NOT NULL").distinct()
    urls = written(named.select("url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), form(F.col("url")).alias("form")), "urls")
    ruled = longest_rules(urls, rules)
    same = components(links.unionByName(urls.filter("form IS NOT NULL").select(F.col("url").alias("a"), F.col("form").alias("b"))), "a", "b")
    placed = urls.join(same.withColumnRenamed("node", "url"), "url", "left").join(ruled, "url", "left")
    placed = written(placed.select("url", "host", "path", "rule", "action", F.coalesce("component", "url").alias("component")), "placed")
    decided = placed.filter("action IS NOT NULL").groupBy("component").agg(F.max(F.col("action") == "allow").alias("allowed"))
    verdict = F.coalesce("action", F.when(F.col("allowed"), F.lit("allow")).when(~F.col("allowed"), F.lit("block")), F.lit("allow"))
    judged = written(placed.join(decided, "component", "left").select("url", "host", "path", "rule", verdict.alias("verdict")), "judged")
    out = pages.select("page_id", "url").join(sized(judged, judged.count(), 400), "url", "left")
    return out.select("page_id", F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"))
