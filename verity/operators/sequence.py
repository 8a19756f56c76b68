"""Skew-safe ordered scans per key, with one exchange.

Several operators need "the previous row of the same key", "the position of
a row within its key" or "the last flagged row before this one".  A plain
``Window.partitionBy(key)`` sends every row of a key to one task, so one hot
key holding a third of the data would run in a single task.

Here the rows are range-partitioned by (key, order) with sampled splitters, so
every task gets about as many rows however they spread over keys and time, and
a hot key is cut wherever a splitter falls.  Each task sorts its range and
scans it as Arrow batches: a vectorised segmented scan that carries the key,
the position, the last flag and the running sums from batch to batch.  That is
the only exchange of the data: a window per (key, partition) would need a
second one, since a range partitioning does not tell Spark that the rows of
(key, partition) lie together.

A partition boundary cuts one key at most, so a task ends with a summary of its
first and its last key.  The summaries, at most two rows per partition whatever
the data, are folded on the driver into what each partition carries in, one
row per partition, which is joined as a broadcast.  The scan is materialised
once, so the input is read and exchanged once for both.

NULL keys and NULL order values are keys and values like others (NULL first).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from verity.session import checkpoint, ship_package


def _starts(columns: list[pa.Array], last: list | None) -> np.ndarray:
    """Where a row's key differs from the row before (``last``: the key before the batch)."""
    n = len(columns[0]) if columns else 0
    new = np.zeros(n, bool)
    for i, column in enumerate(columns):
        after, before = column[1:], column[:-1]
        try:
            unequal = pc.not_equal(after, before)
        except pa.ArrowNotImplementedError:
            unequal = pa.array([None if x is None or y is None else x != y
                                for x, y in zip(after.to_pylist(), before.to_pylist(), strict=True)], pa.bool_())
        if pa.types.is_floating(column.type):  # NaN is one key
            unequal = pc.and_(unequal, pc.invert(pc.and_(pc.is_nan(after), pc.is_nan(before))))
        one_null = pc.xor(after.is_null(), before.is_null())
        new[1:] |= np.asarray(pc.coalesce(unequal, one_null))
        if last is not None:
            x, y = column[0].as_py(), last[i]
            new[0] |= not (x == y or (x != x and y != y))
    if n and last is None:
        new[0] = True
    return new


def _shifted(column: pa.Array, before: pa.Array, new: np.ndarray) -> pa.Array:
    """The value one row earlier; null where a key begins."""
    return pc.take(pa.concat_arrays([before, column]), pa.array(np.arange(len(column)), mask=new))


def _segmented(values: np.ndarray, new: np.ndarray, carried, add: np.ufunc, minus: np.ufunc):
    """Running total strictly before each row within its key, and the total after the last row."""
    upto = add.accumulate(values)
    before = minus(upto, values)
    start = np.maximum.accumulate(np.where(new, np.arange(len(values)), -1))
    own = start >= 0
    out = minus(before, np.where(own, before[np.maximum(start, 0)], 0).astype(values.dtype))
    out = np.where(own, out, add(out, values.dtype.type(carried)))
    return out, add(out[-1], values[-1])


class _Scan:
    """The scan of one partition; state is what the rows seen so far of the current key tell."""

    def __init__(self, keys, lags, leads, flagged, sums, xors, gap, p):
        self.keys, self.lags, self.leads, self.flagged = keys, lags, leads, flagged
        self.sums, self.xors, self.gap, self.p = sums, xors, gap, p
        self.key = None
        self.count = 0
        self.mflag = None  # position of the key's last flagged row
        self.prev: dict[str, pa.Array] = {}
        self.first: dict[str, pa.Array] = {}
        self.total = dict.fromkeys((*sums, *xors), 0)
        self.in_first = True

    def batch(self, table: pa.RecordBatch) -> dict[str, pa.Array]:
        """The added columns of a batch (but for the leads, which need the batch after)."""
        p, n = self.p, table.num_rows
        columns = [table.column(k) for k in self.keys]
        if columns:
            new = _starts(columns, self.key)
        else:
            new = np.zeros(n, bool)
            new[0] = self.key is None
        at = np.arange(n)
        start = np.maximum.accumulate(np.where(new, at, -1))
        lpos = np.where(start >= 0, at - start + 1, at + self.count + 1)
        first = np.zeros(n, bool)
        if self.in_first:
            later = np.flatnonzero(new) if self.key is not None else np.flatnonzero(new)[1:]
            edge = int(later[0]) if len(later) else n
            first[:edge] = True
            self.in_first = edge == n
        out = {f"{p}lpos": pa.array(lpos, pa.int64()), f"{p}inner": pa.array(first)}
        for c in {*self.lags, *([self.gap[0]] if self.gap else [])}:
            column = table.column(c)
            before = self.prev.get(c, pa.nulls(1, column.type))
            shifted = _shifted(column, before, new)
            if c in self.lags:
                out[f"{p}lag_{c}"] = shifted
            if self.gap and c == self.gap[0]:
                leads = np.array(pc.fill_null(pc.greater(pc.subtract(column, shifted), self.gap[1]), True))
                leads |= new
                if self.key is None:
                    leads[0] = False  # known once the partition before is
            self.prev[c] = column[n - 1:]
        flag = leads if self.gap else np.asarray(pc.fill_null(table.column(f"{p}flag"), False)) if self.flagged else None
        if flag is not None:
            seen = np.maximum.accumulate(np.where(flag, at, -1))
            if not self.gap:
                seen = np.concatenate(([-1], seen[:-1]))
            here = seen >= np.maximum(start, 0)
            value = np.where(here, lpos[np.maximum(seen, 0)], self.mflag or 0)
            out[f"{p}lflag"] = pa.array(value, pa.int64(), mask=~here & ((start >= 0) | (self.mflag is None)))
            if self.gap:
                out[f"{p}leads"] = pa.array(flag)
            own = np.flatnonzero(flag[max(int(start[-1]), 0):])
            if len(own):
                self.mflag = int(lpos[max(int(start[-1]), 0) + own[-1]])
            elif start[-1] >= 0:
                self.mflag = None
        for c in (*self.sums, *self.xors):
            add, minus = (np.bitwise_xor, np.bitwise_xor) if c in self.xors else (np.add, np.subtract)
            column = table.column(c)
            kind = np.float64 if pa.types.is_floating(column.type) else np.int64
            values = np.asarray(pc.fill_null(column.cast(pa.from_numpy_dtype(kind)), 0)).astype(kind)
            running, total = _segmented(values, new, self.total[c], add, minus)
            out[f"{p}run_{c}"] = pa.array(running)
            self.total[c] = total
        for c in self.leads:
            if start[-1] >= 0:
                self.first[c] = table.column(c)[int(start[-1]):int(start[-1]) + 1]
        self.key = [c[n - 1].as_py() for c in columns]
        self.count = int(lpos[-1])
        return out


def _scanner(schema: pa.Schema, names: list[str], keys: list[str], lags: list[str], leads: list[str],
             flagged: bool, sums: list[str], xors: list[str], gap: tuple[str, int] | None,
             p: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        part = TaskContext.get().partitionId()
        scan = _Scan(keys, lags, leads, flagged, sums, xors, gap, p)
        held = None

        def finished(table, added, after):
            n = table.num_rows
            for c in leads:
                column = table.column(c)
                new = _starts([table.column(k) for k in keys], None) if keys else np.zeros(n, bool)
                new = np.concatenate((new[1:], [True]))
                tail = pa.nulls(1, column.type)
                if after is not None:
                    same = not keys or not _starts([after.column(k)[:1] for k in keys],
                                                   [table.column(k)[n - 1].as_py() for k in keys])[0]
                    if same:
                        tail, new[-1] = after.column(c)[:1], False
                added[f"{p}lead_{c}"] = pc.take(pa.concat_arrays([column[1:], tail]), pa.array(np.arange(n), mask=new))
            tail = np.zeros(n, bool)
            tail[-1] = after is None
            return rows(table, {**added, f"{p}tail": pa.array(tail)}, n, 0)

        def rows(table, added, n, kind):
            columns = []
            for field in schema:
                if field.name == f"{p}part":
                    column = pa.array(np.full(n, part), pa.int32())
                elif field.name == f"{p}kind":
                    column = pa.array(np.full(n, kind), pa.int32())
                elif field.name in added:
                    column = added[field.name]
                elif table is not None and field.name in names:
                    column = table.column(field.name)
                else:
                    column = pa.nulls(n, field.type)
                columns.append(column.cast(field.type) if column.type != field.type else column)
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        def summary(inner, tail):
            added = {f"{p}lpos": pa.array([scan.count], pa.int64()), f"{p}inner": pa.array([inner]), f"{p}tail": pa.array([tail])}
            kinds = {f.name: f.type for f in schema}
            for k, value in zip(keys, scan.key, strict=True):
                added[k] = pa.array([value], kinds[k])
            for c in lags:
                added[f"{p}lag_{c}"] = scan.prev[c]
            for c in leads:
                added[f"{p}lead_{c}"] = scan.first[c]
            if flagged or gap:
                added[f"{p}lflag"] = pa.array([scan.mflag], pa.int64())
            for c in (*sums, *xors):
                added[f"{p}run_{c}"] = pa.array([scan.total[c]])
            if gap:
                added[f"{p}gap_first"], added[f"{p}gap_last"] = gap_first, scan.prev[gap[0]]
            return rows(None, added, 1, 1)

        first_done, gap_first = False, None
        for batch in batches:
            if not batch.num_rows:
                continue
            pieces = [batch]
            if not first_done:  # the first key's rows apart, so that its summary is told at its end
                columns = [batch.column(k) for k in keys]
                new = _starts(columns, scan.key) if keys else np.zeros(batch.num_rows, bool)
                cut = np.flatnonzero(new) if scan.key is not None else np.flatnonzero(new)[1:]
                if gap and gap_first is None:
                    gap_first = batch.column(gap[0])[:1]
                if len(cut):
                    pieces = [batch[:int(cut[0])], batch[int(cut[0]):]] if cut[0] else [batch]
            for i, piece in enumerate(pieces):
                if not first_done and (i == 1 or (len(pieces) == 1 and keys and scan.key is not None and new[0])):
                    yield summary(True, False)
                    first_done = True
                if held is not None:
                    yield finished(*held, piece)
                held = (piece, scan.batch(piece))
        if held is not None:
            yield finished(*held, None)
            yield summary(not first_done, True)

    return run


def _carries(summaries: list[dict], keys: list[str], lags: list[str], leads: list[str], flagged: bool,
             sums: list[str], xors: list[str], gap: tuple[str, int] | None, p: str) -> tuple[list[dict], list[dict]]:
    """What partitions carry in for their first key, and the values after their last row."""
    same = lambda a, b: all(x == y or (x != x and y != y) for x, y in ((a[k], b[k]) for k in keys))
    into, beyond, state, before = [], [], None, None
    for row in sorted(summaries, key=lambda r: (r[f"{p}part"], not r[f"{p}inner"])):
        if before is not None and same(before, row):
            if leads:
                beyond.append({f"{p}part": before[f"{p}part"], **{f"{p}next1_{c}": row[f"{p}lead_{c}"] for c in leads}})
        else:
            state = {"off": 0, "flag": None, **dict.fromkeys((*sums, *xors), 0)}
        if row[f"{p}inner"]:
            carry = {f"{p}part": row[f"{p}part"], f"{p}off": state["off"]}
            for c in lags:
                carry[f"{p}prev1_{c}"] = before[f"{p}lag_{c}"] if state["off"] else None
            for c in (*sums, *xors):
                carry[f"{p}run1_{c}"] = state[c]
            if gap:
                x, y = row[f"{p}gap_first"], before[f"{p}gap_last"] if state["off"] else None
                carry[f"{p}lead1"] = x is None or y is None or x - y > gap[1]
                if carry[f"{p}lead1"]:
                    state["flag"] = state["off"] + 1
            if flagged or gap:
                carry[f"{p}flag1"] = state["flag"]
            if state["off"] or gap:
                into.append(carry)
        if row.get(f"{p}lflag") is not None:
            state["flag"] = state["off"] + row[f"{p}lflag"]
        state["off"] += row[f"{p}lpos"]
        for c in sums:
            state[c] += row[f"{p}run_{c}"]
        for c in xors:
            state[c] ^= row[f"{p}run_{c}"]
        before = row
    return into, beyond


def keyed_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    lag_cols: Sequence[str] = (),
    lead_cols: Sequence[str] = (),
    flag: Column | None = None,
    prefix: str = "_",
    cumsum: str | None = None,
    cumxor: Sequence[str] = (),
    gap: tuple[str, int] | None = None,
) -> DataFrame:
    """Add ordered-scan columns per key; no row is dropped.

    Adds ``{prefix}pos`` (1-based position within ``keys`` by ``order``),
    ``{prefix}prev_<c>`` / ``{prefix}next_<c>`` (value of ``c`` on the previous
    / next row of the key) and, when ``flag`` is given, ``{prefix}lastflag``
    (position of the last row strictly before with ``flag`` true, else null)
    and, when ``cumsum`` names a numeric column, ``{prefix}csum`` (its sum over
    the key's rows strictly before), and ``{prefix}cxor_<c>`` for each bigint
    column of ``cumxor`` (its bitwise exclusive or over the rows strictly
    before).  ``gap`` = (integer column, width) instead of ``flag``: a row
    *leads* when it is its key's first, or its value or the one before is null,
    or lies more than ``width`` above the one before; adds ``{prefix}leads`` and
    ``{prefix}seg``, the position of the last leading row up to and with this one.

    ``order`` should be a total order within a key; a NULL flag counts as
    false.  All columns of ``df`` pass through, so callers select what they need.
    """
    if gap is not None and flag is not None:
        raise ValueError("flag and gap exclude each other")
    ship_package(df.sparkSession)
    keys, order, p = list(keys), list(order), prefix
    lags, leads, xors = list(lag_cols), list(lead_cols), list(cumxor)
    sums = [cumsum] if cumsum is not None else []
    names = df.columns
    kinds = {f.name: f.dataType for f in df.schema}
    if flag is not None:
        df = df.withColumn(f"{p}flag", F.coalesce(flag, F.lit(False)))
    by = [F.col(c) for c in (*keys, *order)]
    ranged = df.repartitionByRange(*by).sortWithinPartitions(*by)

    added = [(f"{p}part", T.IntegerType()), (f"{p}kind", T.IntegerType()), (f"{p}lpos", T.LongType()),
             (f"{p}inner", T.BooleanType()), (f"{p}tail", T.BooleanType())]
    added += [(f"{p}lag_{c}", kinds[c]) for c in lags] + [(f"{p}lead_{c}", kinds[c]) for c in leads]
    if flag is not None or gap:
        added.append((f"{p}lflag", T.LongType()))
    summed = {c: T.DoubleType() if isinstance(kinds[c], (T.FloatType, T.DoubleType)) else T.LongType() for c in (*sums, *xors)}
    added += [(f"{p}run_{c}", summed[c]) for c in (*sums, *xors)]
    if gap:
        added += [(f"{p}leads", T.BooleanType()), (f"{p}gap_first", kinds[gap[0]]), (f"{p}gap_last", kinds[gap[0]])]
    schema = T.StructType([T.StructField(c, kinds[c]) for c in names] + [T.StructField(c, k) for c, k in added])
    run = _scanner(to_arrow_schema(schema), names, keys, lags, leads, flag is not None, sums, xors, gap, p)
    scanned = checkpoint(ranged.mapInArrow(run, schema))

    told = [*keys, *[c for c, _ in added if c != f"{p}leads"]]
    summaries = [r.asDict() for r in scanned.filter(F.col(f"{p}kind") == 1).select(*told).collect()]
    into, beyond = _carries(summaries, keys, lags, leads, flag is not None, sums, xors, gap, p)
    out = scanned.filter(F.col(f"{p}kind") == 0)
    part = F.col(f"{p}part")
    carried = [(f"{p}off", T.LongType())] + [(f"{p}prev1_{c}", kinds[c]) for c in lags]
    carried += [(f"{p}run1_{c}", summed[c]) for c in (*sums, *xors)]
    if gap:
        carried.append((f"{p}lead1", T.BooleanType()))
    if flag is not None or gap:
        carried.append((f"{p}flag1", T.LongType()))
    out = _with(out, into, carried, p, F.col(f"{p}inner"))
    out = out.withColumn(f"{p}off", F.coalesce(f"{p}off", F.lit(0)).cast("long"))
    off, lpos = F.col(f"{p}off"), F.col(f"{p}lpos")
    exprs = [(off + lpos).alias(f"{p}pos")]
    edge = F.col(f"{p}inner") & (lpos == 1)
    exprs += [F.when(edge, F.col(f"{p}prev1_{c}")).otherwise(F.col(f"{p}lag_{c}")).alias(f"{p}prev_{c}") for c in lags]
    if leads:
        out = _with(out, beyond, [(f"{p}next1_{c}", kinds[c]) for c in leads], p, F.col(f"{p}tail"))
        exprs += [F.when(F.col(f"{p}tail"), F.col(f"{p}next1_{c}")).otherwise(F.col(f"{p}lead_{c}")).alias(f"{p}next_{c}")
                  for c in leads]
    if flag is not None:
        exprs.append(F.coalesce(off + F.col(f"{p}lflag"), F.col(f"{p}flag1")).alias(f"{p}lastflag"))
    if gap:
        exprs.append(F.coalesce(F.when(edge, F.col(f"{p}lead1")), F.col(f"{p}leads")).alias(f"{p}leads"))
        exprs.append(F.coalesce(off + F.col(f"{p}lflag"), F.col(f"{p}flag1")).alias(f"{p}seg"))
    exprs += [(F.col(f"{p}run_{c}") + F.coalesce(f"{p}run1_{c}", F.lit(0))).alias(f"{p}csum") for c in sums]
    exprs += [F.col(f"{p}run_{c}").bitwiseXOR(F.coalesce(f"{p}run1_{c}", F.lit(0).cast("long"))).alias(f"{p}cxor_{c}") for c in xors]
    return out.select(*names, *exprs)


def _with(rows: DataFrame, carried: list[dict], columns: list[tuple[str, T.DataType]], p: str, where: Column) -> DataFrame:
    """``rows`` with the columns carried per partition (one row each, broadcast) where ``where`` holds."""
    if not carried:
        return rows.select("*", *[F.lit(None).cast(k).alias(c) for c, k in columns])
    schema = T.StructType([T.StructField(f"{p}part1", T.IntegerType())] + [T.StructField(c, k) for c, k in columns])
    one = rows.sparkSession.createDataFrame([(r[f"{p}part"], *[r[c] for c, _ in columns]) for r in carried], schema)
    return rows.join(F.broadcast(one), where & (F.col(f"{p}part") == F.col(f"{p}part1")), "left").drop(f"{p}part1")

