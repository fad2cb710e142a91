"""Line dedup by site-relative frequency, in DataFrame operations only.

Pages are grouped by the host of their URL. A line's frequency on a site is the number of the
site's pages that contain it over the number of its pages. Lines that repeat on the site, on a share
of its pages over ``ratio``, are boilerplate and are dropped from all its pages, whatever its size:
two pages that share a line lose it if they are the site.

Lines are the text blocks of the HTML (or of plain text), without markup, with white space
collapsed; blank lines are not lines. NULL or empty HTML has no lines and still counts as a
page. NULL URLs and URLs without a host are one site with the host ''. Repeated pages count
each; a line that a page repeats counts once, and all its repeats go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import sized
from tradeloom.llm.url_filters import host
from tradeloom.session import written

#: On the given pages lines with a larger share are few and are the same on most sites; below it the counts soar.
RATIO = 0.1
#: Patterns of markup, in the order in which they are replaced.
MARKUP = [
    (r"(?is)<(script|style)\b.*?</(script|style)\s*>", "\n"),
    (r"(?s)<!--.*?-->", "\n"),
    (r"(?i)</?(address|article|aside|blockquote|body|br|dd|div|dl|dt|figure|footer|form|h1|h2|h3|h4|h5|h6|head|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)\b[^>]*>", "\n"),
    (r"<[^>]*>", ""),
]
#: Entities, in the order in which they are replaced.
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]


def lines(html: Column) -> Column:
    text = F.coalesce(html, F.lit(""))
    for pattern, by in MARKUP:
        text = F.regexp_replace(text, pattern, by)
    for entity, by in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(by))
    text = F.regexp_replace(F.regexp_replace(text, r"[ \t\r\f]+", " "), r" ?\n ?", "\n")
    return F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def digest(line: Column) -> Column:
    return F.unhex(F.md5(line.cast("binary")))


def dedup(pages: DataFrame, ratio: float = RATIO) -> DataFrame:
    """One row per page: page_id, host, lines, dropped, text (the lines that stay)."""
    own = pages.select("page_id", host(F.col("url")).alias("host"), lines(F.col("html")).alias("own"))
    # Pages of a site with equal lines lose the same ones, so these name a page's content.
    base = written(own.withColumn("content", digest(F.array_join("own", "\n"))), "lines")
    each = base.select("host", "content", F.explode(F.array_distinct("own")).alias("line")).select("host", "content", digest(F.col("line")).alias("line"))
    counts = each.groupBy("host", "line").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    sites = written(base.groupBy("host").agg(F.count("*").alias("pages")), "sites")
    common = counts.join(sized(sites, sites.count(), 200), "host").filter(F.col("n") > F.lit(ratio) * F.col("pages")).select("host", "line")
    common = written(common, "common")
    hit = each.join(sized(common, common.count(), 200), ["host", "line"], "left_semi")
    drops = written(hit.groupBy("host", "content").agg(F.collect_set("line").alias("drop")), "drops")
    found = base.join(sized(drops, drops.count(), 400), ["host", "content"], "left")
    stay = F.when(F.col("drop").isNull(), F.col("own")).otherwise(F.filter("own", lambda x: ~F.array_contains(F.col("drop"), digest(x))))
    left = found.select("page_id", "host", F.size("own").alias("lines"), stay.alias("stay"))
    return left.select("page_id", "host", "lines", (F.col("lines") - F.size("stay")).alias("dropped"), F.array_join("stay", "\n").alias("text"))
