"""Boilerplate lines of a site, by the share of its pages that hold them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.common import SPACES, packed, unpacked
from lodestrata.session import cut_lineage

BLANKS = SPACES.decode()
#: Copies of the lists of boilerplate lines, among which the pages of a host are dealt.
SPREAD = 16


def solid(line: Column) -> Column:
    return F.length(F.translate(line, BLANKS, "")) > 0


def digest(line: Column) -> Column:
    """Sixteen bytes that stand for a line."""
    return F.unhex(F.md5(line))


def site_lines(df: DataFrame, host: str, text: str, ratio: float, least: int) -> DataFrame:
    """Digests of each host's boilerplate lines, as one array a host (``_host``, ``_drop``).

    Since the lines on a page are few on average, a host has at most that average divided by
    ``ratio`` such lines, however many pages it has.
    """
    pages = df.select(F.col(f"`{host}`").alias("__host"), F.split(F.col(f"`{text}`"), "\n").alias("__lines")).filter(F.col("__host").isNotNull())
    totals = pages.groupBy("__host").agg(F.count("*").alias("__pages"))
    each = pages.select("__host", F.explode(F.array_distinct(F.filter("__lines", solid))).alias("__line"))
    found = each.select("__host", digest(F.col("__line")).alias("__line")).groupBy("__host", "__line").agg(F.count("*").alias("__on")).filter(F.col("__on") >= least)
    high = found.join(totals, "__host").filter(F.col("__on") > F.lit(ratio) * F.col("__pages"))
    return high.groupBy("__host").agg(F.collect_set("__line").alias("__drop"))


def drop_site_lines(df: DataFrame, host: str, text: str, ratio: float = 0.1, least: int = 2) -> DataFrame:
    """``df`` without the lines found on more than ``ratio`` of their host's pages.

    Each row is a page. A line counts once a page; it is dropped from all pages of the host if
    the pages with it are at least ``least`` and more than ``ratio`` of the host's pages. ``least`` only
    says that a line is repeated; with more, small hosts keep lines that the ratio would drop. Lines are
    compared as they are; lines of white space only are never dropped. Added are ``n_lines`` and
    ``n_dropped`` (long), in place of columns of these names.

    Rows with a NULL host belong to no site and stay whole; NULL texts stay NULL with zero lines
    (an empty text is one line) but count as pages; repeated rows are pages of their own; a
    page of boilerplate only stays as a row with an empty text. Other columns may have any names; an empty
    table gives an empty one. A text of any length is one row, split where it lies. ``df`` should be a scan or a stored table.

    The lists are stored, so their size is known: small ones are broadcast and no page moves.
    """
    # pages go to where the lists are in turn, so the pages of one host are dealt to many tasks where lists are too large to be sent round
    spread = F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1)))
    drop = cut_lineage(site_lines(df, host, text, ratio, least).withColumn("_turn", spread))
    kept = df.drop("n_lines", "n_dropped")
    pages = packed(kept, _host=host, _text=text).withColumn("_own", F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD)).cast("int"))
    joined = pages.join(drop, (F.col("_host") == F.col("__host")) & (F.col("_own") == F.col("_turn")), "left").withColumn("_lines", F.split("_text", "\n"))
    stays = F.filter("_lines", lambda x: ~solid(x) | ~F.array_contains(F.col("__drop"), digest(x)))
    cut = joined.withColumn("_stay", F.when(F.col("__drop").isNotNull(), stays).otherwise(F.col("_lines")))
    total = F.coalesce(F.size("_lines"), F.lit(0)).cast("long")
    total = F.when(F.col("_lines").isNull(), F.lit(0).cast("long")).otherwise(total)
    gone = F.when(F.col("_lines").isNull(), F.lit(0).cast("long")).otherwise((F.size("_lines") - F.size("_stay")).cast("long"))
    new_text = F.when(gone > 0, F.array_join("_stay", "\n")).otherwise(F.col("_text"))
    return unpacked(cut, kept, {text: new_text, "n_lines": total, "n_dropped": gone}, _host=host, _text=text)
