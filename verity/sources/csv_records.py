"""CSV with quoted line ends, split over tasks.

Spark's reader needs ``multiLine`` for quoted line ends, with which a file is one task whatever its size.
Here files are read as lines, so they split anywhere, also inside a quoted field.  A line takes the parser
from one of two states (outside or inside quotes) to one of two states; composing the lines of a split says
what the split does to either state.  These summaries, one short row per split, are folded in file order, so
each split knows the state it starts in.  A second scan parses the records that lie within a split; what
crosses a split boundary, at most two pieces per split, is put together by file and order.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from verity.session import pinned_splits, ship_package

_QUOTED = r'"(?:[^"]++|"")*+"[^,]*+'
_FIELDS = rf"(?:{_QUOTED}|[^\",][^,]*+)?+"
#: A line that starts outside (inside) quotes and ends outside.
_FROM_OUTSIDE = re.compile(rf"{_FIELDS}(?:,{_FIELDS})*+", re.S)
_FROM_INSIDE = re.compile(rf'(?:[^"]++|"")*+"[^,]*+(?:,{_FIELDS})*+', re.S)
_PIECES = "file string, block bigint, seq int, opens boolean, first boolean, piece string"


def ends_inside(line: str, inside: bool) -> bool:
    """The state after a line."""
    if '"' not in line:
        return inside
    return not (_FROM_INSIDE if inside else _FROM_OUTSIDE).fullmatch(line)


def _split_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, list[str]]]:
    """(file, block, lines) of runs of rows of one split."""
    for batch in batches:
        file, block, lines = (batch.column(c).to_pylist() for c in ("file", "block", "value"))
        lo = 0
        for i in range(1, len(lines) + 1):
            if i == len(lines) or file[i] != file[lo] or block[i] != block[lo]:
                yield file[lo], block[lo], lines[lo:i]
                lo = i


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, out0, out1): the state after a split that starts outside (inside) quotes."""
    told: dict[tuple[str, int], tuple[bool, bool]] = {}
    for file, block, lines in _split_lines(batches):
        states = told.get((file, block), (False, True))
        for line in lines:
            if '"' in line:
                states = tuple(ends_inside(line, s) for s in states)
        told[file, block] = states
    if told:
        keys, states = zip(*told.items(), strict=True)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys], pa.int64()),
                                          pa.array([s[0] for s in states]), pa.array([s[1] for s in states])], names=["file", "block", "out0", "out1"])


def _parsed(lines: list[str], columns: list[str]) -> list[tuple]:
    """Whole records' lines -> rows; a short row has nulls, surplus fields go, blank lines are no rows."""
    csv.field_size_limit(2**31 - 1)
    n, ends = len(columns), ["\n"] * (len(lines) - 1) + [""]
    return [tuple(r[:n]) + (None,) * (n - len(r)) for r in csv.reader(x + end for x, end in zip(lines, ends, strict=True)) if r]


def _rows(found: list[tuple], columns: list[str]) -> pa.RecordBatch:
    fields = list(zip(*found, strict=True)) if found else [[] for _ in columns]
    return pa.RecordBatch.from_arrays([pa.array(f, pa.string()) for f in fields], names=columns)


class _Split:
    """The records of one split, its state carried from batch to batch."""

    def __init__(self, file: str, block: int, inside: bool):
        self.key, self.inside, self.first = (file, block), inside, block == 0
        self.pending: list[str] = []
        self.tail = inside  # what comes first belongs to a record of an earlier split

    def take(self, lines: list[str], pieces: list[tuple]) -> list[str]:
        """The lines of the records that end in ``lines``."""
        whole: list[str] = []
        for line in lines:
            self.pending.append(line)
            self.inside = ends_inside(line, self.inside)
            if not self.inside:
                if self.tail:
                    pieces.append((*self.key, 0, False, False, "\n".join(self.pending)))
                    self.tail = False
                elif not self.first:
                    whole += self.pending
                self.first = False
                self.pending = []
        return whole

    def close(self, pieces: list[tuple]) -> None:
        if self.pending:
            pieces.append((*self.key, 0 if self.tail else 1, not self.tail, self.first, "\n".join(self.pending)))


def read_csv_records(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The records of CSV files with a header record each, as string ``columns`` in order.

    Equal to a dict reader: a quote opens a field only at its start, doubled quotes are one, quoted fields
    may hold commas and line ends, a short row has nulls, surplus fields are dropped, blank lines are
    skipped.  Lines end in ``\\n`` or ``\\r\\n``.  A file of any size is read by as many tasks as it has splits.
    """
    ship_package(spark)
    own = pinned_splits(spark)
    lines = own.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    states: dict[tuple[str, int], bool] = {}
    file, inside = None, False
    summaries = lines.mapInArrow(_summaries, "file string, block bigint, out0 boolean, out1 boolean")
    for r in sorted(summaries.collect()):
        inside = inside and r.file == file
        file, states[r.file, r.block] = r.file, inside
        inside = r.out1 if inside else r.out0
    start = spark.sparkContext.broadcast(states)

    def splits(batches, want_pieces):
        split, pieces = None, []
        for f, b, part in _split_lines(batches):
            if split is None or split.key != (f, b):
                if split is not None:
                    split.close(pieces)
                split = _Split(f, b, start.value[f, b])
            whole = split.take(part, pieces)
            if whole and not want_pieces:
                yield _rows(_parsed(whole, columns), columns)
        if split is not None:
            split.close(pieces)
        if pieces and want_pieces:
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*pieces, strict=True), kinds, strict=True)],
                                             names=["file", "block", "seq", "opens", "first", "piece"])

    schema = ", ".join(f"`{c}` string" for c in columns)
    within = lines.mapInArrow(lambda x: splits(x, False), schema)
    if not any(states.values()) and not inside:
        return within
    place = Window.partitionBy("file").orderBy("block", "seq")
    pieces = lines.mapInArrow(lambda x: splits(x, True), _PIECES).withColumn("record", F.sum(F.col("opens").cast("int")).over(place))
    joined = pieces.groupBy("file", "record").agg(F.max("first").alias("first"), F.array_sort(F.collect_list(F.struct("block", "seq", "piece"))).alias("all")) \
        .filter("NOT first").select(F.array_join(F.col("all.piece"), "\n").alias("text"))

    def stitched(batches):
        for batch in batches:
            yield _rows([r for text in batch.column("text").to_pylist() for r in _parsed(text.split("\n"), columns)], columns)

    return within.unionByName(joined.mapInArrow(stitched, schema))
