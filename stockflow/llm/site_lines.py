"""Lines that too large a part of a site's pages repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.words import BLANK
from stockflow.storage import stored

# A line on more than this part of a host's pages is boilerplate …
MAX_RATIO = 0.05
# … if it is on so many pages at least, so that small hosts lose nothing by chance.
MIN_PAGES = 3


def line_key(line):
    """What makes two lines the same: their words."""
    return F.trim(F.regexp_replace(line, f"{BLANK}+", " "))


def without_boilerplate(pages: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                        host_column: str = "source", max_ratio: float = MAX_RATIO,
                        min_pages: int = MIN_PAGES) -> DataFrame:
    """(id, host, text, n_lines, n_dropped): each page without its site's common lines.

    For every host the pages that contain a line are divided by the host's pages; lines
    above the ratio go, wherever they stand; the others stay as they were. Lines are
    equal if their words are; lines without words stay. Pages are counted by row, a line
    once for each. Null hosts are one host. A null text comes back empty, as does a text
    that loses all its lines. Repeated rows are pages of their own. Columns besides the
    three named are not read. An empty table gives no rows.

    Counting shuffles one 8-byte key per distinct line and host of a map task, so
    neither a common line nor a large host meets in one task. Only boilerplate is
    listed: lines above ratio r are at most (lines per page) / r for a host, whatever
    its size, so the list joined back grows with hosts and not with pages.
    """
    rows = pages.select(
        F.col(id_column).alias("id"),
        F.col(host_column).alias("host"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    )
    keys = F.array_distinct(
        F.transform(
            F.split("text", "\n"),
            lambda line: F.xxhash64(line_key(line)),
        )
    )
    blank = F.xxhash64(F.lit(""))
    counted = rows.select("host", F.explode(keys).alias("line")).where(F.col("line") != blank)
    counted = counted.groupBy("host", "line").agg(F.count("*").alias("n"))
    counted = counted.where(F.col("n") >= min_pages)
    totals = rows.groupBy("host").agg(F.count("*").alias("pages"))
    common = counted.join(
        totals.select(F.col("host").alias("of"), "pages"), F.col("host").eqNullSafe(F.col("of"))
    ).where(F.col("n") > max_ratio * F.col("pages"))
    common = stored(common.select("host", "line"), "boilerplate")
    lists = common.groupBy(F.col("host").alias("of")).agg(F.collect_set("line").alias("drop"))
    found = rows.join(lists, F.col("host").eqNullSafe(F.col("of")), "left")
    drop = F.coalesce("drop", F.array().cast("array<bigint>"))
    lines = F.split("text", "\n")
    kept = F.filter(lines, lambda line: ~F.array_contains(drop, F.xxhash64(line_key(line))))
    return found.select(
        "id",
        "host",
        F.concat_ws("\n", kept).alias("text"),
        F.size(lines).cast("bigint").alias("n_lines"),
        (F.size(lines) - F.size(kept)).cast("bigint").alias("n_dropped"),
    )
