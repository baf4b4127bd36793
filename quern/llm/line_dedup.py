"""Line dedup by the spread of a line over sites, in DataFrame functions only.

Each task folds the sites of a line into a HyperLogLog sketch and aggregation
merges the sketches by line hash, so a line in a third of all rows still costs
one small row per task. Lines whose estimate is clear of the threshold are
decided by it; the others get an exact distinct count. A line on ``min_sites``
sites or more is boilerplate: its earliest occurrence stays, every other one
is removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import row_key
from quern.session import ScratchTables

MIN_SITES = 10
LG_K = 12  # of the sketches: a relative standard error of 1.6 %
MARGIN = 0.1  # six standard errors


def normal(line: Column) -> Column:
    """A line as it is compared: trimmed of blanks and lower-cased."""
    return F.lower(F.btrim(line, F.lit(" \t\r")))


def lines_of(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """``r1, r2, doc_id, site, line_no, h1, h2`` of every line with a visible
    character; no line text goes on."""
    cut = docs.select(
        *row_key(F.col(id_col), F.col(text_col)),
        F.col(id_col).alias("doc_id"),
        F.col(site_col).cast("string").alias("site"),
        F.posexplode(F.split(text_col, "\n", -1)).alias("line_no", "line"),
    ).withColumn("line", normal(F.col("line")))
    return cut.where("line != ''").select(
        "r1", "r2", "doc_id", "site", "line_no", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")
    )


def spread(lines: DataFrame) -> DataFrame:
    """``h1, h2, sketch, first`` of every line: its sites as a sketch, and its
    earliest (doc_id, line_no)."""
    return lines.groupBy("h1", "h2").agg(
        F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"), F.min(F.struct("doc_id", "line_no")).alias("first")
    )


def boilerplate(lines: DataFrame, min_sites: int, tables: ScratchTables) -> DataFrame:
    """``h1, h2, first`` of the lines on at least ``min_sites`` sites."""
    low, high = min_sites * (1 - MARGIN) - 1, min_sites * (1 + MARGIN) + 1
    wide = spread(lines).withColumn("sites", F.hll_sketch_estimate("sketch")).where(F.col("sites") >= low)
    wide = tables.put(wide.select("h1", "h2", "first", (F.col("sites") <= high).alias("near")), "wide")
    near = wide.where("near").select("h1", "h2")
    # each (line, site) once before the join: no line has more rows than there are sites
    exact = (
        lines.where("site IS NOT NULL").groupBy("h1", "h2", "site").agg(F.count(F.lit(1)).alias("n"))
        .join(near, ["h1", "h2"], "left_semi")
        .groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("sites"))
        .where(F.col("sites") >= min_sites)
    )
    near_ok = wide.where("near").join(exact.select("h1", "h2"), ["h1", "h2"], "left_semi")
    return tables.put(wide.where("NOT near").unionByName(near_ok).select("h1", "h2", "first"), "boilerplate")


def dedup(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
    min_sites: int = MIN_SITES,
) -> DataFrame:
    """``row`` (all columns of ``docs`` as a struct), ``text`` without the
    removed lines, ``n_lines`` and ``n_removed``.

    Lines are cut at ``\\n`` and compared trimmed and lower-cased; blank
    lines are never removed. The earliest occurrence is that of the lowest
    (doc_id, line number), a null id first; rows of one id rank alike. A null
    site is no site. A null text stays null and has no lines. Equal rows are
    treated alike.
    """
    tables = ScratchTables(docs.sparkSession, "line-dedup")
    # hashes and places only, written once: the text is cut into lines a single time
    lines = tables.put(lines_of(docs, id_col, text_col, site_col), "lines")
    flagged = boilerplate(lines, min_sites, tables)
    tables.keep(lines, flagged)
    drops = (
        lines.drop("site")
        .join(flagged, ["h1", "h2"])
        .where(~F.struct("doc_id", "line_no").eqNullSafe(F.col("first")))
        .groupBy("r1", "r2")
        .agg(F.collect_set("line_no").alias("drop"))  # of one text
    )
    base = docs.select(
        *row_key(F.col(id_col), F.col(text_col)),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.split(text_col, "\n", -1).alias("lines"),
    )
    kept = F.expr("array_join(transform(array_except(sequence(0, size(lines) - 1), drop), i -> lines[i]), '\\n')")
    return base.join(drops, ["r1", "r2"], "left").select(
        "row",
        F.when(F.col("drop").isNull(), F.col(f"row.`{text_col}`")).otherwise(kept).alias("text"),
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_removed"),
    )


def digest(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_removed, text``."""
    return dedup(docs).select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_removed", "text")


def clean(docs: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the lines removed (``n_chars`` counted anew, if there is
    such a column); a document that loses all its visible lines goes."""
    done = dedup(docs, text_col=text_col, **options)
    left = done.where((F.col("n_removed") == 0) | (F.btrim(F.translate("text", "\n\t\r", "   ")) != ""))

    def value(c: str) -> Column:
        if c == text_col:
            return F.col("text").alias(c)
        if c == "n_chars":
            counted = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col(f"row.`{c}`"))
            return counted.cast(docs.schema[c].dataType).alias(c)
        return F.col(f"row.`{c}`").alias(c)

    return left.select(*map(value, docs.columns))


#: DuckDB SQL for ``digest`` over ``documents``, with exact counts throughout.
ORACLE = r"""
WITH l AS (
  SELECT doc_id, text, source, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS line_no
  FROM documents),
n AS (SELECT *, lower(trim(line, ' ' || chr(9) || chr(13))) AS k FROM l),
b AS (SELECT k, min((doc_id, line_no)) AS first FROM n WHERE k <> '' GROUP BY k HAVING count(DISTINCT source) >= 10),
m AS (SELECT n.*, b.k IS NOT NULL AND (n.doc_id, n.line_no) IS DISTINCT FROM b.first AS gone FROM n LEFT JOIN b ON n.k = b.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
       coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT gone), '') AS text
FROM m GROUP BY doc_id
"""
