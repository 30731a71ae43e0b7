"""Line dedup by site-relative frequency (native)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.session import stage

# What ends a line in a page, and what holds no text. A comment, script or
# style that is not closed hides the rest of the page, and no tag holds a '<': so no
# pattern looks ahead over what another attempt will read again.
HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<script[^<>]*>.*?(?:</script>|\z)|<style[^<>]*>.*?(?:</style>|\z)"
BREAKS = r"(?i)</?(?:address|article|aside|blockquote|body|br|div|dd|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)(?:[\x20\x09-\x0D/][^<>]*)?>"
TAGS = r"<[^<>]*>"
SPACE = r"[\x20\x09-\x0D]+"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"

BROADCAST_BYTES = 32 << 20  # of common lines; beyond it pages meet them in a shuffle join


def host_of(url: Column) -> Column:
    """Lower-case host; '' for a null or malformed address, which form one site."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


def lines_of(html: Column) -> Column:
    """The page's text lines in order: block tags and newlines end a line, inline
    tags vanish, blanks are squeezed, empty lines are left out. Null: no lines."""
    t = F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, "\n")
    t = F.regexp_replace(F.regexp_replace(t, BREAKS, "\n"), TAGS, "")
    lines = F.transform(F.split(t, "\n"), lambda x: F.trim(F.regexp_replace(x, SPACE, " ")))
    return F.filter(lines, lambda x: x != "")


def drop_site_boilerplate(pages: DataFrame, ratio: float = 0.2, least_pages: int = 3, key: str = "page_id",
                          url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: key, host, n_lines, n_dropped, text (the lines kept).

    A line is boilerplate on a site when over ``ratio`` of the site's pages hold it, and
    at least ``least_pages`` do: the ratio holds for sites of every size, and what one or
    two pages share is no evidence. A page counts a line once however often it repeats it,
    and loses every copy. Repeated rows count as pages. A null page has no lines; an empty
    table gives an empty result; other columns are not read.

    Pages are parsed once into a staged table. Counting is a partial aggregation on
    (host, line). A site has fewer than (mean lines of a page) / ratio such lines, so they
    fit one array per site. The arrays are broadcast where their bytes are few, so pages
    are not moved; else the staged sides are joined, where Spark splits a site's pages."""
    base = stage(pages.select(F.col(key).alias("key"), host_of(F.col(url)).alias("host"), lines_of(F.col(html)).alias("lines")),
                 "page_lines")
    totals = base.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= least_pages)
    counts = (base.select("host", F.explode(F.array_distinct("lines")).alias("line"))
              .groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_pages))
    common = stage(counts.join(totals, "host").where(F.col("n") > F.lit(ratio) * F.col("pages"))
                   .groupBy("host").agg(F.collect_set("line").alias("common")), "site_lines")
    size = common.agg(F.sum(F.octet_length("host") + F.aggregate(
        "common", F.lit(0).cast("long"), lambda n, x: n + F.octet_length(x) + 16))).first()[0] or 0
    small = F.broadcast(common) if size <= BROADCAST_BYTES else common
    kept = F.when(F.col("common").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda x: ~F.array_contains(F.col("common"), x)))
    return (base.join(small, "host", "left").withColumn("kept", kept)
            .select(F.col("key").alias(key), "host", F.size("lines").alias("n_lines"),
                    (F.size("lines") - F.size("kept")).alias("n_dropped"),
                    F.array_join("kept", "\n").alias("text")))
