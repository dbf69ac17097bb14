"""Boilerplate lines by site-relative frequency.

Method.  A page's visible lines come from its HTML.  Per host, each distinct
line's pages are counted (a line once per page, partial counts before the
shuffle) and divided by the host's pages; a line on more than ``ratio`` of them
is boilerplate and goes from every page of that host.  A host has at most
(lines per page / ratio) such lines, so they fit an array per host, which is
looked up by host: broadcast while the hosts are few, else with a hot host's
pages dealt over salts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import lookup, stored

# Parts of a page that are cut out in this order (what replaces them; the
# last place where one can end), the line break and the host of a URL.
_NAMES = (r"address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol"
          r"|option|p|pre|section|table|td|th|title|tr|ul")
PARTS = (
    (r"(?is)<script\b.*?</script\s*>", "", r"(?is)^.*</script\s*>"),
    (r"(?is)<style\b.*?</style\s*>", "", r"(?is)^.*</style\s*>"),
    (r"(?s)<!--.*?-->", "", r"(?s)^.*-->"),
    (rf"(?i)</?(?:{_NAMES})\b[^>]*>", "\n", r"(?s)^.*>"),
    (r"<[^>]*>", "", r"(?s)^.*>"),
)
LINE_BREAK = r"[\n\r]"
HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]+)"


def host_of(url: Column) -> Column:
    """Lower-case host of a URL; empty where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit("")))


def _cut(text: Column, part: str, by: str, last: str) -> Column:
    """``text`` with every ``part`` replaced.  Only what lies before the last possible
    end is searched: there each opening finds its end, so openings without an end
    (a megabyte of ``<``) cost no search of their own and time stays linear."""

    def one(x):
        head = F.regexp_extract(x, last, 0)
        return F.struct(x.alias("x"), head.alias("head"))

    def joined(s):
        return F.concat(F.regexp_replace(s["head"], part, by), F.substr(s["x"], F.length(s["head"]) + 1))

    # lambdas bind the text and its head once each
    return F.transform(F.transform(F.array(text), one), joined)[0]


def page_lines(html: Column) -> Column:
    """The visible lines of a page, trimmed, without empty ones: scripts, styles and
    comments go in this order, block tags end a line, other tags go.  What is
    opened and not closed stays."""
    text = F.coalesce(html, F.lit(""))
    for part, by, last in PARTS:
        text = _cut(text, part, by, last)
    return F.filter(F.transform(F.split(text, LINE_BREAK), lambda x: F.trim(x)), lambda x: x != "")


def _mark(line: Column) -> Column:
    """Two independent 64-bit hashes of a line."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def site_lines(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, host (empty: none) and lines of each page."""
    return pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), page_lines(F.col(html_col)).alias("lines"))


def boilerplate(rows: DataFrame, ratio: float = 0.5, min_pages: int = 1) -> DataFrame:
    """host, host_pages and bad (the marks of its boilerplate lines; null for
    none) of every host, from ``site_lines``.  A line on a single page is never
    boilerplate; hosts under ``min_pages`` pages have none, pages without a host are
    no site."""
    rows = rows.where("host != ''")
    totals = rows.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    marks = rows.select("host", F.explode_outer(F.array_distinct(F.transform("lines", _mark))).alias("m")).where("m is not null")
    counts = marks.groupBy("host", "m.a", "m.b").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    frequent = counts.join(totals, "host").where((F.col("n") > F.col("host_pages") * ratio) & (F.col("host_pages") >= min_pages))
    bad = frequent.groupBy("host").agg(F.collect_list(F.struct("a", "b")).alias("bad"))
    return totals.join(bad, "host", "left")


def drop_boilerplate(pages: DataFrame, ratio: float = 0.5, min_pages: int = 1, id_col: str = "page_id", url_col: str = "url",
                     html_col: str = "html") -> DataFrame:
    """One row per page: page_id, host, host_pages, n_lines, n_dropped and
    kept_text (kept lines joined by newlines).

    Lines are extracted once and stored.  Hosts of any size lose their repeated
    lines (``min_pages`` exempts smaller hosts, if wanted); pages without a host (host
    empty) keep all, with host_pages 0.  Null HTML has no lines.  Repeated rows count
    as pages of their own.  Other columns are not read.
    """
    rows = stored(site_lines(pages, id_col, url_col, html_col), "page-lines")
    sites = stored(boilerplate(rows, ratio, min_pages), "sites")
    both = lookup(rows, sites.withColumnRenamed("host", "site"), "host", "site", sites.count(), ["page_id", "lines"])
    kept = F.when(F.col("bad").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda x: ~F.array_contains(F.col("bad"), _mark(x))))
    out = both.withColumn("kept", kept)
    return out.select("page_id", "host", F.coalesce("host_pages", F.lit(0).cast("long")).alias("host_pages"), F.size("lines").cast("long").alias("n_lines"),
                      (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"), F.array_join("kept", "\n").alias("kept_text"))
