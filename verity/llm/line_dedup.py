"""Removal of boilerplate lines by the number of distinct sites they spread over.

A line is what stands between line feeds; blank lines are left alone.  Lines are compared by a
64-bit hash of their bytes.  HyperLogLog sketches of the sites of each line merge by aggregation
(map-side first).  A line whose estimate lies near ``min_sites`` gets an exact distinct count;
beyond the margin, over six standard errors of the sketch, the estimate decides.  A line that
reaches ``min_sites`` is boilerplate: the document of smallest doc_id that has it keeps it, all
others lose it, so no passage leaves the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verity.llm.common import tidy, unused
from verity.session import checkpoint

MIN_SITES = 10
#: log2 of the sketch's size: a standard error of 1.6 %.
SKETCH_LG = 12
MARGIN = 0.1
WORD = r"[^\x20\x09-\x0D]"

#: The same for DuckDB.
ORACLE = f"""
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents WHERE text IS NOT NULL
), spread AS (
  SELECT line, min(doc_id) AS holder FROM lines
  WHERE regexp_matches(line, '{WORD}') GROUP BY line HAVING count(DISTINCT source) >= {MIN_SITES}
), marked AS (
  SELECT l.doc_id, l.line, l.pos, regexp_matches(l.line, '{WORD}') AS full_line,
         s.line IS NOT NULL AND l.doc_id <> s.holder AS gone
  FROM lines l LEFT JOIN spread s ON l.line = s.line
)
SELECT d.doc_id, coalesce(m.n_lines, 0) AS n_lines, coalesce(m.n_removed, 0) AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN coalesce(m.text, '') END AS text
FROM documents d LEFT JOIN (
  SELECT doc_id, CAST(sum(CASE WHEN full_line THEN 1 ELSE 0 END) AS BIGINT) AS n_lines,
         CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_removed,
         string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone) AS text
  FROM marked GROUP BY doc_id
) m ON d.doc_id = m.doc_id
"""


def _hash(line: str) -> int:
    value = xxhash.xxh64_intdigest(line.encode("utf-8", "surrogatepass"), seed=42)
    return value - (1 << 64) if value >> 63 else value


def spread_lines(lines: DataFrame, min_sites: int) -> DataFrame:
    """(line, holder) of the lines on at least ``min_sites`` distinct sites; ``lines``: doc_id, site, line."""
    sketched = lines.groupBy("line").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", SKETCH_LG)).alias("estimate"), F.min("doc_id").alias("holder")
    )
    low, high = min_sites * (1 - MARGIN) - 1, min_sites * (1 + MARGIN) + 1
    wide = checkpoint(sketched.filter(F.col("estimate") >= low))
    near = wide.filter(F.col("estimate") <= high)
    # Of a line's rows one a site is left before they meet by line, so a line costs its sites, not its documents.
    pairs = lines.filter("site IS NOT NULL").select("line", "site").distinct()
    exact = (
        pairs.join(near.select("line"), "line", "left_semi").groupBy("line").agg(F.count(F.lit(1)).alias("sites"))
        .filter(F.col("sites") >= min_sites)
    )
    return wide.filter(F.col("estimate") > high).select("line", "holder").unionByName(near.join(exact, "line").select("line", "holder"))


def _without(batches: Iterator[pa.RecordBatch], text: str, gone: str, left: str, removed: str) -> Iterator[pa.RecordBatch]:
    """Take the marked lines out of ``text``; ``left``: whether words are left; ``removed``: lines taken out."""
    for batch in batches:
        column, marks = batch.column(text), batch.column(gone)
        marked = pc.and_(pc.is_valid(marks), pc.is_valid(column))
        texts, counts, full = [], [0] * batch.num_rows, [True] * batch.num_rows
        for i in pc.indices_nonzero(marked).to_pylist():
            hashes = set(marks[i].as_py())
            kept = []
            for line in column[i].as_py().split("\n"):
                if _hash(line) in hashes:
                    counts[i] += 1
                else:
                    kept.append(line)
            texts.append("\n".join(kept))
            full[i] = counts[i] == 0 or any(c not in " \t\n\v\f\r" for c in texts[-1])
        column = pc.replace_with_mask(column, marked, pa.array(texts, column.type))
        arrays = [column if n == text else pa.array(full) if n == left else pa.array(counts, pa.int64()) if n == removed else batch.column(n) for n in batch.schema.names]
        yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)


def line_dedup(docs: DataFrame, min_sites: int = MIN_SITES, site: str = "source", added: tuple[str, str, str] = ("n_lines", "n_removed", "words_left")) -> DataFrame:
    """``docs`` (doc_id, text, a site column; others pass through) with boilerplate lines taken out
    of text, and three columns more, named by ``added``: lines with words before, lines taken out, and
    whether words are left or no line was taken out.  ``added`` must not name columns of ``docs``.

    A null text stays null, with no lines.  A null site is none.  A row with a null doc_id never
    holds a line.  Rows that repeat a doc_id count as one document.  An empty table gives none.
    """
    n_lines, n_removed, left = added
    doc, gone = (unused([*docs.columns, *added], x) for x in ("doc", "gone"))
    lines = checkpoint(
        docs.select("doc_id", F.col(site).cast("string").alias("site"), F.explode(F.split("text", "\n")).alias("line"))
        .filter(F.col("line").rlike(WORD))
        .select("doc_id", "site", F.xxhash64("line").alias("line"))
    )
    spread = checkpoint(spread_lines(lines, min_sites))
    marks = (
        lines.join(spread, "line").filter(~F.col("doc_id").eqNullSafe(F.col("holder")))
        .groupBy(F.col("doc_id").alias(doc)).agg(F.collect_set("line").alias(gone))
    )
    full = F.size(F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)))
    joined = (
        docs.join(marks, F.col("doc_id").eqNullSafe(F.col(doc)), "left").drop(doc)
        .withColumn(n_lines, F.when(F.col("text").isNull(), 0).otherwise(full).cast("bigint"))
        .withColumn(n_removed, F.lit(0).cast("bigint")).withColumn(left, F.lit(True))
    )
    return joined.mapInArrow(tidy(lambda x: _without(x, "text", gone, left, n_removed)), joined.schema).drop(gone)
