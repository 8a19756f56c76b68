"""Near-duplicate groups by MinHash signatures in an LSH forest, links confirmed on full sets.

Documents with equal sets of 5-word shingles are one class.  A class has a signature of ``VALUES``
MinHash values (one byte each).  The forest keeps ``ORDERS`` sorted orders of all signatures, each
beginning at another value and wrapping around: rows are range-partitioned and sorted by the rotated
signature, so classes with a long common prefix are neighbours, and a task that streams its range sees
candidates side by side.

The classes that share the first ``DEPTH`` values of an order form a region.  Depth adapts to the
region: in one of up to ``WINDOW + 1`` classes all are candidates of each other; in a denser one a
class takes the neighbours with the longest common prefix, ``WINDOW`` to look at and the ``BEST`` of
them, as deep as its region is dense.  A region cut by a partition boundary is stitched from the rows
beside the cut.  Candidates whose signatures or sizes speak against the link are dropped at once, then
those that bitmaps of the sets rule out.

Links are confirmed on full sets: first the best candidates of each class.  What dense regions then leave
open, classes of one region in different components, is settled exactly by the size-aware join on these
classes alone, so the window drops no link between texts that any order brings together.  Of the
candidates met outside of dense regions, those whose ends still lie in different components are confirmed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verity.llm.common import few_tasks, shingle_sets, tidy
from verity.llm.graph import components
from verity.llm.ngram_join import _close, _linked, _sets_of, bitmap, class_id, ngram_components
from verity.session import checkpoint, ship_package

WIDTH = 5
PERCENT = 85
#: MinHash values of a signature, sorted orders of it (their beginnings lie apart), and values that
#: candidates share at the beginning of an order.  Two sets at 0.85 miss all orders with probability
#: (1 - 0.85 ** 4) ** 20 = 4e-7.
VALUES, ORDERS, DEPTH = 100, 20, 4
#: Of 100 values at 0.85, fewer than 66 agree with a probability of about 1e-7.
AGREE = 66
WINDOW, BEST = 64, 4
FIRST_LINKS = 4
#: Classes (with signature and bitmap) that a task takes at most, where few tasks suffice.
CLASSES_A_TASK = 8_192

_FOUND = "kind int, a bigint, b bigint, agree int, key binary, n bigint"
_NAMES = ["kind", "a", "b", "agree", "key", "n"]

_rng = np.random.default_rng(131)
_FLIP = _rng.integers(0, 1 << 32, VALUES, dtype=np.uint32)
_TIMES = _rng.integers(0, 1 << 31, VALUES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def signature(tokens: np.ndarray) -> bytes:
    """One byte of each MinHash value of a set of 64-bit shingle hashes."""
    least = np.full(VALUES, 0xFFFFFFFF, np.uint32)
    x = (tokens >> np.uint64(32)).astype(np.uint32)
    for lo in range(0, len(x), 2048):
        part = x[lo : lo + 2048]
        np.minimum(least, ((part[None, :] ^ _FLIP[:, None]) * _TIMES[:, None]).min(axis=1), out=least)
    least = least * np.uint32(0x9E3779B1)
    least ^= least >> np.uint32(15)
    return (least * np.uint32(0x85EBCA77) >> np.uint32(24)).astype(np.uint8).tobytes()


def _members(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The size, class, signature and bitmap of each document's set."""
    for batch in batches:
        n, cid = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
        sig: list[bytes | None] = [None] * batch.num_rows
        bits: list[bytes | None] = [None] * batch.num_rows
        for i, own in shingle_sets(batch.column("text"), width):
            if len(own):
                n[i], cid[i], sig[i], bits[i] = len(own), class_id(own), signature(own), bitmap(own)
        columns = [batch.column("doc_id"), pa.array(n), pa.array(cid), pa.array(sig, pa.binary()), pa.array(bits, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "cid", "sig", "bits"])


def _orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, cid, n) of each class per order: the order's number and the signature from its beginning on."""
    for batch in batches:
        m = batch.num_rows
        if not m:
            continue
        sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint8).reshape(m, VALUES)
        for t in range(ORDERS):
            key = np.empty((m, VALUES + 1), np.uint8)
            key[:, 0] = t
            key[:, 1:] = np.roll(sig, -t * VALUES // ORDERS, axis=1)
            blobs = pa.Array.from_buffers(pa.binary(), m, [None, pa.py_buffer((np.arange(m + 1) * (VALUES + 1)).astype(np.int32)), pa.py_buffer(key.tobytes())])
            yield pa.RecordBatch.from_arrays([blobs, batch.column("cid"), batch.column("n")], names=["key", "cid", "n"])


def _regions(key: np.ndarray) -> np.ndarray:
    value = np.zeros(len(key), np.int64)
    for k in range(DEPTH + 1):
        value = value << 8 | key[:, k]
    return value


def _neighbours(batches: Iterator[pa.RecordBatch], percent: int, edges: bool) -> Iterator[pa.RecordBatch]:
    """Of rows in sorted order.  Kind 0: a pair of classes with the number of values that agree, ``n`` 1 if its
    region is dense by now; 1: a class ``a`` of a dense region ``b``; 2 (if ``edges``): a row beside the partition's ends, where its region may go on."""
    key, cid, n = np.zeros((0, VALUES + 1), np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
    region, place = np.zeros(0, np.int64), np.zeros(0, np.int64)
    opening = None

    def edge_rows(at):
        blobs = pa.array([key[i].tobytes() for i in at], pa.binary())
        m = len(at)
        return pa.RecordBatch.from_arrays([pa.array(np.full(m, 2, np.int32)), pa.array(cid[at]), pa.array(region[at]), pa.nulls(m, pa.int32()), blobs, pa.array(n[at])], names=_NAMES)

    for batch in batches:
        if not batch.num_rows:
            continue
        old, m = len(cid), batch.num_rows
        fresh = np.frombuffer(b"".join(batch.column("key").to_pylist()), np.uint8).reshape(m, VALUES + 1)
        key, cid = np.concatenate((key, fresh)), np.concatenate((cid, batch.column("cid").to_numpy()))
        n, region = np.concatenate((n, batch.column("n").to_numpy())), np.concatenate((region, _regions(fresh)))
        begin = np.concatenate(([True], region[1:] != region[:-1]))
        start = np.maximum.accumulate(np.where(begin, np.arange(len(cid)), 0))
        ahead = place[0] - 1 if old else 0  # rows of the first region that have left the buffer
        place = np.arange(len(cid)) - start + 1 + np.where(start == 0, ahead, 0)
        if opening is None:
            opening = region[0]
        if edges and region[old] == opening and place[old] <= WINDOW:
            yield edge_rows(old + np.flatnonzero((region[old:] == opening) & (place[old:] <= WINDOW)))
        # Pairs of a new row with the rows before it in its region, agreements counted; -1: none.
        new = np.arange(old, len(cid))
        agree = np.full((m, WINDOW), -1, np.int16)
        for k in range(1, WINDOW + 1):
            new = new[np.minimum(place[new] - 1, new) >= k]
            if not len(new):
                break
            other = new - k
            fits = 100 * np.minimum(n[new], n[other]) >= percent * np.maximum(n[new], n[other])
            own, other = new[fits], other[fits]
            for x in range(0, len(own), 20_000):
                i, j = own[x : x + 20_000], other[x : x + 20_000]
                same = (key[i, 1:] == key[j, 1:]).sum(axis=1)
                agree[i - old, k - 1] = np.where(same >= AGREE, same, -1)
        dense = place[old:] > WINDOW + 1
        if dense.any():
            rows = np.flatnonzero(dense)
            part = agree[rows]
            least = np.sort(part, axis=1)[:, -BEST][:, None]
            agree[rows] = np.where((part >= least) & (np.cumsum(part == least, axis=1) * (part == least) <= BEST), part, -1)
        last = np.append(np.flatnonzero(begin)[1:], len(cid)) - 1
        crowded = np.repeat(place[last] > WINDOW + 1, np.diff(np.append(-1, last)))
        i, k = np.nonzero(agree >= 0)
        if len(i):
            x, y = cid[i + old], cid[i + old - k - 1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(i), np.int32)), pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)), pa.array(agree[i, k].astype(np.int32)),
                 pa.nulls(len(i), pa.binary()), pa.array(crowded[i + old].astype(np.int64))], names=_NAMES)
        if crowded.any():
            at = np.flatnonzero(crowded)
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(at), np.int32)), pa.array(cid[at]), pa.array(region[at]), pa.nulls(len(at), pa.int32()),
                                              pa.nulls(len(at), pa.binary()), pa.nulls(len(at), pa.int64())], names=_NAMES)
        keep = slice(max(0, len(cid) - WINDOW - 1), None)
        key, cid, n, region, place = key[keep].copy(), cid[keep], n[keep], region[keep], place[keep]
    if edges and len(cid):
        at = np.flatnonzero(region == region[-1])[-WINDOW:]
        yield edge_rows(at)


def _same_class(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """(cid as doc_id, text) of the rows whose text is of class ``cid``."""
    for batch in batches:
        want, own = batch.column("cid").to_numpy(), np.zeros(batch.num_rows, np.int64)
        for i, tokens in shingle_sets(batch.column("text"), width):
            own[i] = class_id(tokens) if len(tokens) else want[i] + 1
        yield pa.RecordBatch.from_arrays([batch.column("cid"), batch.column("text")], names=["doc_id", "text"]).filter(pa.array(want == own))


def _confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, percent: int, width: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets link.  Bitmaps of the sets, whose bits that differ bound
    the symmetric difference from below, are compared first."""
    side = lambda x: classes.select(F.col("cid").alias(x), F.col("n").alias(f"{x}n"), F.col("doc_id").alias(f"{x}doc"), F.col("bits").alias(f"{x}bits"))
    known = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    known = few_tasks(checkpoint(known.mapInArrow(tidy(lambda x: _close(x, percent)), "a bigint, b bigint, adoc bigint, bdoc bigint")))
    ids = known.select(F.col("adoc").alias("doc_id")).unionByName(known.select(F.col("bdoc").alias("doc_id")))
    sets = _sets_of(docs, ids, width).dropDuplicates(["cid"])
    rows = known.select("a", "b").join(sets.select(F.col("cid").alias("a"), F.col("tokens").alias("at")), "a") \
        .join(sets.select(F.col("cid").alias("b"), F.col("tokens").alias("bt")), "b").select("a", "b", "at", "bt")
    return few_tasks(checkpoint(rows.mapInArrow(tidy(lambda x: _linked(x, percent)), "a bigint, b bigint")))


def forest_candidates(classes: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Of classes (cid, n, sig): the candidate pairs (a, b, agree, apart), and (cid, region) of the classes of dense
    regions.  ``apart``: the pair was met outside of dense regions, so no region settles it."""
    rows = classes.select("cid", "n", "sig").mapInArrow(tidy(_orders), "key binary, cid bigint, n bigint")
    ranged = rows.repartitionByRange("key").sortWithinPartitions("key")
    found = few_tasks(checkpoint(ranged.mapInArrow(tidy(lambda x: _neighbours(x, percent, True)), _FOUND)))
    beside = found.filter("kind = 2").select("key", F.col("a").alias("cid"), "n", F.col("b").alias("region")).distinct()
    cuts = beside.repartition("region").sortWithinPartitions("key").select("key", "cid", "n")
    stitched = cuts.mapInArrow(tidy(lambda x: _neighbours(x, percent, False)), _FOUND)
    every = found.filter("kind < 2").unionByName(stitched)
    pairs = every.filter("kind = 0 AND a <> b").groupBy("a", "b").agg(F.max("agree").alias("agree"), (F.min("n") == 0).alias("apart"))
    dense = every.filter("kind = 1").select(F.col("a").alias("cid"), F.col("b").alias("region")).distinct()
    return few_tasks(checkpoint(pairs)), few_tasks(checkpoint(dense))


def forest_components(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, component_id, kept per row of ``docs`` (columns doc_id, text; others ignored).

    Null, empty and blank texts have an empty set and link with nothing.  A text of fewer than
    ``width`` words is one shingle.  Rows that repeat a doc_id are separate rows.  A row with a null
    doc_id is returned and kept, makes no links, and its component_id is null.  An empty table gives none.
    """
    ship_package(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    members = checkpoint(docs.mapInArrow(tidy(lambda x: _members(x, width)), "doc_id bigint, n bigint, cid bigint, sig binary, bits binary"))
    known = members.filter("n > 0 AND doc_id IS NOT NULL")
    classes = known.groupBy("cid", "n").agg(F.min(F.struct("doc_id", "sig", "bits")).alias("first")).select("cid", "n", "first.*")
    classes = few_tasks(checkpoint(classes), CLASSES_A_TASK)
    pairs, dense = forest_candidates(classes, percent)

    both = pairs.select("a", "b", "agree").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "agree"))
    best = Window.partitionBy("a").orderBy(F.desc("agree"), "b")
    early = both.withColumn("k", F.row_number().over(best)).filter(F.col("k") <= FIRST_LINKS)
    early = few_tasks(checkpoint(early.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()))
    links = _confirmed(early, classes, docs, percent, width)

    def placed(edges):
        return few_tasks(checkpoint(components(edges).select(F.col("node").alias("cid"), F.col("component").alias("label"))))

    near = placed(links)
    named = dense.join(near, "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    undecided = named.groupBy("region").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x <> y").select("region")
    undecided = few_tasks(checkpoint(dense.join(undecided, "region", "left_semi").select("cid").distinct()))
    side = lambda x: near.select(F.col("cid").alias(x), F.col("label").alias(f"{x}label"))
    across = pairs.filter("apart").join(side("a"), "a", "left").join(side("b"), "b", "left") \
        .filter(F.coalesce("alabel", "a") != F.coalesce("blabel", "b")).select("a", "b").join(early, ["a", "b"], "left_anti")
    more = []
    if undecided.head(1):
        # Pairs of two such classes are left to the exact join.
        open_end = lambda x: undecided.select(F.col("cid").alias(x), F.lit(True).alias(f"{x}open"))
        across = across.join(open_end("a"), "a", "left").join(open_end("b"), "b", "left").filter("aopen IS NULL OR bopen IS NULL").select("a", "b")
        wanted = undecided.join(classes, "cid").select("doc_id", "cid")
        texts = docs.join(wanted, "doc_id").select("cid", "text").mapInArrow(tidy(lambda x: _same_class(x, width)), "doc_id bigint, text string")
        settled = ngram_components(few_tasks(checkpoint(texts), CLASSES_A_TASK), percent, width)
        more.append(settled.filter("doc_id <> component_id").select(F.col("component_id").alias("a"), F.col("doc_id").alias("b")).distinct())
    across = few_tasks(checkpoint(across))
    if across.head(1):
        more.append(_confirmed(across, classes, docs, percent, width))
    if more:
        # What is linked already enters as one edge a class.
        every = near.filter("cid <> label").select(F.col("label").alias("a"), F.col("cid").alias("b"))
        for links in more:
            every = every.unionByName(links)
        near = placed(every)

    groups = few_tasks(checkpoint(classes.select("cid", "doc_id").join(near, "cid", "left").withColumn("label", F.coalesce("label", "cid"))))
    least = groups.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce(F.when(F.col("n") > 0, F.col("component_id")), F.col("doc_id")))
    out = members.join(groups.join(least, "label").select("cid", "component_id"), "cid", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")) \
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
