"""Line dedup by site-relative frequency: lines that too large a share of a host's pages have.

A line counts once for each page it is on. Its pages are divided by all pages of the host; above the
boilerplate ratio, and on some least number of pages, the line is dropped from the host's pages.
Lines are counted by 64-bit hashes with partial sums, so a line that a third of all pages have is one
row per task. A host has at most (lines per page / ratio) such lines; they come back to the pages in one
row per host, in a join that Spark can broadcast when that table is small and split when it is not.

Defined cases: a null host is a host of its own; a null text stays null; blank lines are kept and not
counted; white space at a line's ends does not matter to its identity; kept lines stay as they are;
repeated rows are pages of their own; other columns are untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from celltide.llm.frames import as_text, load, materialize, packed

RATIO, LEAST_PAGES = 0.1, 5
BLANKS = " \t\r"


def _key(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def frequent_lines(pages: DataFrame, host="source", text="text", ratio=RATIO, least=LEAST_PAGES) -> DataFrame:
    """host, lines: hashes of the lines to drop."""
    rows = pages.select(F.col(host).cast("string").alias("host"), as_text(pages, text).alias("text"))
    keys = F.array_distinct(F.transform(F.split("text", "\n"), lambda x: F.when(
        F.length(_key(x)) > 0, F.xxhash64(_key(x)))))
    # An outer explode gives a row to every page; the null line counts the pages of the host.
    lines = rows.select("host", F.explode(F.concat(F.array(F.lit(None).cast("bigint")), F.filter(
        keys, lambda x: x.isNotNull()))).alias("line"))
    counts = materialize(lines.groupBy("host", "line").agg(F.count("*").alias("n")).where(
        (F.col("n") >= least) | F.col("line").isNull()), "lines")
    total = counts.where("line IS NULL").select(F.col("host").alias("h"), F.col("n").alias("pages"))
    often = counts.where("line IS NOT NULL").join(total, F.col("host").eqNullSafe(F.col("h")))
    return often.where(F.col("n") > F.lit(ratio) * F.col("pages")).groupBy("host").agg(
        F.collect_list("line").alias("lines"))


def drop_lines(pages: DataFrame, host="source", text="text", ratio=RATIO, least=LEAST_PAGES) -> DataFrame:
    """row (the input row), kept (its text without boilerplate lines), n_lines, n_dropped."""
    often = materialize(frequent_lines(pages, host, text, ratio, least), "frequent")
    rows = packed(pages, host=F.col(host).cast("string"), text=F.when(
        F.col(text).isNotNull(), as_text(pages, text)))
    often = often.select(F.col("host").alias("h"), "lines")
    found = rows.join(often, F.col("host").eqNullSafe(F.col("h")), "left")
    lines = F.split("text", "\n")
    keep = F.filter(lines, lambda x: (F.length(_key(x)) == 0) | ~F.array_contains(
        F.coalesce("lines", F.array().cast("array<bigint>")), F.xxhash64(_key(x))))
    found = found.select("row", "text", "lines", F.when(F.col("lines").isNotNull(), keep).alias("keep"))
    n = F.coalesce(F.size(lines).cast("bigint"), F.lit(0).cast("bigint"))
    hit = F.col("lines").isNotNull() & F.col("text").isNotNull()
    return found.select(
        "row", F.when(hit, F.array_join("keep", "\n")).otherwise(F.col("text")).alias("kept"),
        F.when(F.col("text").isNull(), 0).otherwise(n).cast("bigint").alias("n_lines"),
        F.when(hit, n - F.size("keep")).otherwise(0).cast("bigint").alias("n_dropped"),
    )


def without_lines(pages: DataFrame, host="source", text="text", **options) -> DataFrame:
    """The pages with their columns, boilerplate lines gone from the text."""
    found = drop_lines(pages, host, text, **options)
    return found.select(*[
        F.col("kept").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in pages.columns])


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_lines(load(spark, sf_dir, "documents"))
    return found.select("row.doc_id", "row.source", F.col("kept").alias("text"), "n_lines", "n_dropped")


ORACLE = f"""
WITH lines AS (
  SELECT DISTINCT doc_id, source, trim(line, E' \\t\\r') AS line
  FROM (SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents)
  WHERE trim(line, E' \\t\\r') <> ''
), pages AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
often AS (
  SELECT l.source, list(l.line) AS lines
  FROM (SELECT source, line, count(*) AS n FROM lines GROUP BY source, line) l
  JOIN pages p ON l.source IS NOT DISTINCT FROM p.source
  WHERE n >= {LEAST_PAGES} AND n > {RATIO} * pages GROUP BY l.source
), split AS (
  SELECT d.doc_id, d.source, d.text, string_split(d.text, chr(10)) AS lines,
    list_filter(string_split(d.text, chr(10)),
      lambda x: NOT list_contains(coalesce(o.lines, []), trim(x, E' \\t\\r'))) AS keep
  FROM documents d LEFT JOIN often o ON d.source IS NOT DISTINCT FROM o.source
)
SELECT doc_id, source, array_to_string(keep, chr(10)) AS text,
  coalesce(len(lines), 0)::BIGINT AS n_lines, coalesce(len(lines) - len(keep), 0)::BIGINT AS n_dropped
FROM split
"""
