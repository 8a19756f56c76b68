"""Near-duplicate join on word shingles: size-aware, heavy and light sets apart.

A document's set holds its distinct 5-word shingles; two documents link when
``100 * |A and B| >= percent * |A or B|``.  Sets of sizes a and b then share at least
``c(a, b) = ceil(percent * (a + b) / (100 + percent))`` shingles.

* *Light* sets (size up to a boundary) enumerate their c(a, b)-subsets for every admissible
  partner size; equal subsets meet under one key.
* *Heavy* sets scan inverted lists: each lists the first ``n - ceil(percent * n / 100) + 1`` of its
  shingles in one global order (rare before frequent), and a position bound prunes a list.
* The boundary minimises the summed cost: keys enumerated against expected postings scanned, from
  the histogram of small sizes and the lengths of all lists, counted over all classes by 42 bits of a
  shingle.  The same counts tell the frequent shingles.

Equal sets are one class and enter once.  Short lists pair up directly.  In a long list (a
frequent passage, a large group of copies) the classes first link to one centre per key; then only
pairs from different components are tried, the list's dominant component being joined by the
others and never with itself.  So no link between components is lost and a group's pairs are not
enumerated.

Candidates are first held against a bitmap of each set (the parity of shingles per bucket, about a
bit per shingle): bits that differ bound the symmetric difference from below, so the bound drops
no link.  The rest are checked on the full sets, which are made anew from the texts concerned: a
Bloom filter of bounded size over their ids goes to the scan, so no text is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verity.llm.common import few_tasks, mix, shingle_sets, tidy, unused
from verity.llm.graph import components
from verity.session import checkpoint

WIDTH = 5
PERCENT = 75
#: Shingles listed by at least so many classes come last in the global order.
FREQUENT = 8
#: Bound of the frequent shingles sent to every task (16 bytes each).  It changes the order only.
MOST_FREQUENT = 1 << 20
#: Lists up to this length pair up at once; longer ones take the component-aware way.
SHORT_LIST = 16
#: First links come from so many lists of each class: its first in the global order.
FIRST_LINKS = 4
#: Sets above this size are heavy whatever the cost, which bounds the subsets of one set.
LIGHT_BOUND = 24
FLUSH = 300_000
#: Bits of the Bloom filter over the ids of texts to check, by their count; at most 8 MB.
BLOOM_BITS = (20, 26)
BLOOM_BLOCK = 1 << 16
#: Ids that a task puts into its share of the filter at most, where few tasks suffice.
IDS_A_TASK = 1 << 17

_POSTINGS = "kind int, bucket int, blob binary"
_LISTS = "kind int, token bigint, a bigint, an int, apos int, b bigint, bn int"


def least_overlap(a, b, percent: int):
    """Shared shingles that sets of sizes a and b need (ints or arrays)."""
    return -((-percent * (a + b)) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    return n + ((-percent * n) // 100) + 1


def partner_sizes(n: int, percent: int) -> range:
    return range(-((-percent * n) // 100), 100 * n // percent + 1)


def enumeration_cost(n: int, percent: int) -> int:
    return sum(comb(n, int(least_overlap(n, b, percent))) for b in partner_sizes(n, percent))


def class_id(tokens: np.ndarray) -> int:
    """64-bit fingerprint of a set, its size mixed in; equal sets are one class."""
    total = mix(tokens ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64, keepdims=True)
    return int(mix(total + np.uint64(len(tokens)))[0].astype(np.int64))


def bitmap(tokens: np.ndarray) -> bytes:
    """The parity of a set's shingles per bucket; the buckets are a power of two, one per shingle."""
    buckets = 1 << max(6, (len(tokens) - 1).bit_length())
    at = (tokens & np.uint64(buckets - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=buckets).astype(np.uint8) & 1, bitorder="little").tobytes()


def _code(token: np.ndarray) -> np.ndarray:
    """The bits of a shingle by which its classes are counted: a bucket and 32 more."""
    return token >> np.uint64(22)


def _members(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The size, class and bitmap of each document's set."""
    for batch in batches:
        n, cid = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
        bits: list[bytes | None] = [None] * batch.num_rows
        for i, own in shingle_sets(batch.column("text"), width):
            if len(own):
                n[i], cid[i], bits[i] = len(own), class_id(own), bitmap(own)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), pa.array(cid), pa.array(bits, pa.binary())], names=["doc_id", "n", "cid", "bits"])


def _occurrences(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """How many classes of a part have each shingle, packed per bucket: the codes met once, and
    apart from them (``hits`` not empty) those met more often with their counts."""
    seen: set[int] = set()

    def packed(pile):
        code, hits = np.unique(_code(np.concatenate(pile)), return_counts=True)
        for chosen in (hits == 1, hits > 1):
            if not chosen.any():
                continue
            own, many = code[chosen], hits[chosen].astype(np.uint32)
            bucket, own = own >> np.uint64(32), own.astype(np.uint32)
            edge = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
            cuts = list(zip(edge, np.append(edge[1:], len(own)), strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[edge].astype(np.int32)), pa.array([own[x:y].tobytes() for x, y in cuts], pa.binary()),
                 pa.array([many[x:y].tobytes() if many[x] > 1 else b"" for x, y in cuts], pa.binary())],
                names=["bucket", "codes", "hits"],
            )

    pile, held = [], 0
    for batch in batches:
        for _, own in shingle_sets(batch.column("text"), width):
            if len(own) and (key := class_id(own)) not in seen:
                seen.add(key)
                pile.append(own)
                held += len(own)
                if held >= 4 * FLUSH:
                    yield from packed(pile)
                    pile, held = [], 0
    if pile:
        yield from packed(pile)


def _counted(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """(code, hits) of the shingles that at least ``least`` classes have; and, code null, this
    partition's number of postings and sum of squared list lengths."""
    names = ["code", "hits", "squares"]
    parts: dict[int, list] = {}
    for batch in batches:
        for bucket, codes, hits in zip(batch.column("bucket").to_pylist(), batch.column("codes"), batch.column("hits"), strict=True):
            parts.setdefault(bucket, []).append((np.frombuffer(codes.as_buffer(), np.uint32), np.frombuffer(hits.as_buffer(), np.uint32)))
    postings = squares = 0
    for bucket in sorted(parts):
        own = parts.pop(bucket)
        code = np.concatenate([c for c, _ in own])
        hits = np.concatenate([h if len(h) else np.ones(len(c), np.uint32) for c, h in own]).astype(np.int64)
        order = np.argsort(code, kind="stable")
        code, hits = code[order], hits[order]
        edge = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
        code, hits = code[edge], np.add.reduceat(hits, edge)
        postings, squares = postings + int(hits.sum()), squares + int((hits * hits).sum())
        often = hits >= least
        code = code[often].astype(np.int64) | bucket << 32
        yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(hits[often]), pa.nulls(len(code), pa.int64())], names=names)
    yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.array([postings]), pa.array([squares])], names=names)


def _ordered(own: np.ndarray, frequent: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, int]:
    """``own`` with its frequent shingles last (least frequent first); how many are not frequent."""
    if not len(frequent):
        return own, len(own)
    code = _code(own)
    at = np.minimum(np.searchsorted(frequent, code), len(frequent) - 1)
    hot = frequent[at] == code
    if not hot.any():
        return own, len(own)
    late = own[hot][np.argsort(rank[at[hot]], kind="stable")]
    return np.concatenate([own[~hot], late]), int(len(own) - len(late))


def _subset_keys(own: np.ndarray, percent: int) -> np.ndarray:
    """A key per (own size, partner size, subset of the least shared size)."""
    n, parts, value = len(own), [], mix(own)
    for b in partner_sizes(n, percent):
        c = int(least_overlap(n, b, percent))
        if c > min(n, b):
            continue
        picks = np.array(list(combinations(range(n), c)), dtype=np.int64)
        low, high = min(n, b), max(n, b)
        parts.append(mix(value[picks].sum(axis=1, dtype=np.uint64) + np.uint64(low * 1_000_003 + high)))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def _postings(batches: Iterator[pa.RecordBatch], width: int, percent: int, frequent: np.ndarray, rank: np.ndarray, boundary: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Postings packed per bucket of keys.  Kind 0: ordinary keys; 1: frequent shingles, dealt by class."""
    seen: set[int] = set()

    def flush(pile):
        for kind in (0, 1):
            chosen = [x for x in pile if x[0] == kind and len(x[1])]
            if not chosen:
                continue
            token = np.concatenate([x[1] for x in chosen])
            many = np.array([len(x[1]) for x in chosen])
            cid = np.repeat(np.array([x[2] for x in chosen], np.int64), many)
            n = np.repeat(np.array([x[3] for x in chosen], np.int32), many)
            pos = np.concatenate([x[4] for x in chosen])
            bucket = (mix(token) if kind == 0 else cid.view(np.uint64)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            token, cid, n, pos, bucket = token[order], cid[order], n[order], pos[order], bucket[order]
            edge = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
            end = np.append(edge[1:], len(bucket))
            blobs = [token[x:y].tobytes() + cid[x:y].tobytes() + n[x:y].tobytes() + pos[x:y].tobytes() for x, y in zip(edge, end, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(edge), kind, np.int32)), pa.array(bucket[edge].astype(np.int32)), pa.array(blobs, pa.binary())],
                names=["kind", "bucket", "blob"],
            )

    pile, held = [], 0
    light_partner = partner_sizes(boundary + 1, percent).start if boundary else 0
    for batch in batches:
        for _, own in shingle_sets(batch.column("text"), width):
            n = len(own)
            if not n or (cid := class_id(own)) in seen:
                continue
            seen.add(cid)
            if n <= boundary:
                keys = _subset_keys(own, percent)
                pile.append((0, keys, cid, n, np.zeros(len(keys), np.int32)))
                held += len(keys)
            if n > boundary or n >= light_partner:
                ordered, plain = _ordered(own, frequent, rank)
                p = prefix_length(n, percent)
                plain = min(plain, p)
                pile.append((0, ordered[:plain], cid, n, np.arange(plain, dtype=np.int32)))
                pile.append((1, ordered[plain:p], cid, n, np.arange(plain, p, dtype=np.int32)))
                held += p
            if held >= FLUSH:
                yield from flush(pile)
                pile, held = [], 0
    yield from flush(pile)


def _lists(batches: Iterator[pa.RecordBatch], percent: int, short: int) -> Iterator[pa.RecordBatch]:
    """Scan the inverted lists of one partition.  Kind 0: a pair of classes (apos 0 if it makes a
    first link); 1: a posting of a long list.  All postings of a key lie in one partition, except
    those of frequent shingles, which pass on as they are."""
    names = ["kind", "token", "a", "an", "apos", "b", "bn"]

    def posting_rows(token, cid, n, pos):
        for x in range(0, len(token), 50_000):
            part = slice(x, x + 50_000)
            m = len(token[part])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ones(m, np.int32)), pa.array(token[part].view(np.int64)), pa.array(cid[part]), pa.array(n[part]), pa.array(pos[part]), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int32())],
                names=names,
            )

    def pair_rows(a, an, b, bn, first):
        for x in range(0, len(a), 50_000):
            part = slice(x, x + 50_000)
            m = len(a[part])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(m, np.int32)), pa.nulls(m, pa.int64()), pa.array(a[part]), pa.array(an[part]), pa.array(first[part]), pa.array(b[part]), pa.array(bn[part])],
                names=names,
            )

    held: dict[int, list] = {}
    for batch in batches:
        for kind, bucket, blob in zip(batch.column("kind").to_pylist(), batch.column("bucket").to_pylist(), batch.column("blob"), strict=True):
            raw = blob.as_buffer()
            m = len(raw) // 24
            columns = (np.frombuffer(raw, np.uint64, m), np.frombuffer(raw, np.int64, m, 8 * m), np.frombuffer(raw, np.int32, m, 16 * m), np.frombuffer(raw, np.int32, m, 20 * m))
            if kind:
                yield from posting_rows(*columns)
            else:
                held.setdefault(bucket, []).append(columns)
    for bucket in sorted(held):
        found, rest = _bucket_pairs(*(np.concatenate(x) for x in zip(*held.pop(bucket), strict=True)), percent, short)
        yield from posting_rows(*rest)
        yield from pair_rows(*found)


def _bucket_pairs(token, cid, n, pos, percent: int, short: int) -> tuple[tuple, tuple]:
    """Of the postings of a bucket: the pairs (a, an, b, bn, first) of its short lists, and the
    postings of its long ones."""
    order = np.lexsort((pos, cid, token))
    token, cid, n, pos = token[order], cid[order], n[order], pos[order]
    new = np.concatenate(([True], (token[1:] != token[:-1]) | (cid[1:] != cid[:-1])))
    token, cid, n, pos = token[new], cid[new], n[new], pos[new]
    start = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
    length = np.diff(np.append(start, len(token)))
    long = np.repeat(length > short, length)
    rest = (token[long], cid[long], n[long], pos[long])
    empty = np.zeros(0, np.int64)
    found = [(empty, empty.astype(np.int32), empty, empty.astype(np.int32), empty.astype(np.int32))]
    for m in range(2, short + 1):
        at = start[length == m]
        for i, j in combinations(range(m), 2):
            x, y = at + i, at + j
            need = least_overlap(n[x].astype(np.int64), n[y].astype(np.int64), percent)
            ok = np.minimum(n[x] - pos[x], n[y] - pos[y]) >= need
            x, y = x[ok], y[ok]
            first = np.where((i == 0) & (pos[x] < FIRST_LINKS) & (pos[y] < FIRST_LINKS), 0, 1).astype(np.int32)
            found.append((cid[x], n[x], cid[y], n[y], first))
    a, an, b, bn, first = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((first, b, a))
    a, an, b, bn, first = a[order], an[order], b[order], bn[order], first[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return (a[new], an[new], b[new], bn[new], first[new]), rest


def _close(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The pairs whose bitmaps allow a link."""
    for batch in batches:
        an, bn = (batch.column(x).to_numpy() for x in ("an", "bn"))
        most = an + bn - 2 * least_overlap(an, bn, percent)
        keep = np.zeros(batch.num_rows, bool)
        for i, (x, y) in enumerate(zip(batch.column("abits"), batch.column("bbits"), strict=True)):
            p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            while len(p) > len(q):
                p = p[: len(p) // 2] ^ p[len(p) // 2 :]
            while len(q) > len(p):
                q = q[: len(q) // 2] ^ q[len(q) // 2 :]
            keep[i] = int(np.bitwise_count(p ^ q).sum()) <= most[i]
        yield batch.select(["a", "b", "adoc", "bdoc"]).filter(pa.array(keep))


def _bloom_at(ids: np.ndarray, bits: int) -> list[np.ndarray]:
    value = ids.astype(np.int64).view(np.uint64)
    return [(mix(value + np.uint64(k * 0x9E3779B9 + 1)) & np.uint64((1 << bits) - 1)).astype(np.int64) for k in range(3)]


def _bloom_blocks(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """This task's share of a Bloom filter, in blocks (those with a bit set)."""
    field = np.zeros((1 << bits) // 8, np.uint8)
    for batch in batches:
        for at in _bloom_at(batch.column("doc_id").to_numpy(), bits):
            np.bitwise_or.at(field, at >> 3, (1 << (at & 7)).astype(np.uint8))
    parts = field.reshape(-1, BLOOM_BLOCK)
    used = np.flatnonzero(parts.any(axis=1))
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array([parts[x].tobytes() for x in used], pa.binary())], names=["block", "bits"])


def _bloom_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, part in zip(batch.column("block").to_pylist(), batch.column("bits"), strict=True):
            own = np.frombuffer(part.as_buffer(), np.uint8)
            total[block] = total[block] | own if block in total else own.copy()
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["block", "bits"])


def _sets_of(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(cid, tokens) of the documents with these ids, and of a few more."""
    ids = checkpoint(ids.select("doc_id").distinct())
    count = ids.count()
    ids = ids.coalesce(count // IDS_A_TASK + 1)
    low, high = BLOOM_BITS
    bits = min(max(low, (16 * count).bit_length()), high)
    kind = "block int, bits binary"
    field = np.zeros((1 << bits) // 8, np.uint8)
    for r in ids.mapInArrow(tidy(lambda x: _bloom_blocks(x, bits)), kind).repartition("block").mapInArrow(tidy(_bloom_joined), kind).collect():
        field[r["block"] * BLOOM_BLOCK : (r["block"] + 1) * BLOOM_BLOCK] = np.frombuffer(r["bits"], np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def sets(batches):
        names = ["cid", "tokens"]
        for batch in batches:
            inside = np.ones(batch.num_rows, bool)
            for at in _bloom_at(batch.column("doc_id").to_numpy(), bits):
                inside &= shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1
            cids, blobs, size = [], [], 0
            for _, own in shingle_sets(batch.column("text").filter(pa.array(inside)), width):
                if not len(own):
                    continue
                cids.append(class_id(own))
                blobs.append(own.tobytes())
                size += len(blobs[-1])
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(cids, pa.int64()), pa.array(blobs, pa.binary())], names=names)
                    cids, blobs, size = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(cids, pa.int64()), pa.array(blobs, pa.binary())], names=names)

    return docs.filter("doc_id IS NOT NULL").mapInArrow(tidy(sets), "cid bigint, tokens binary")


def _linked(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = np.zeros(batch.num_rows, bool)
        for i, (x, y) in enumerate(zip(batch.column("at"), batch.column("bt"), strict=True)):
            p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            both = np.sort(np.concatenate([p, q]))
            shared = int((both[1:] == both[:-1]).sum())
            keep[i] = 100 * shared >= percent * (len(p) + len(q) - shared)
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, percent: int, width: int) -> DataFrame:
    """The pairs (a, b) of classes that link."""
    side = lambda x: classes.select(F.col("cid").alias(x), F.col("n").alias(f"{x}n"), F.col("doc_id").alias(f"{x}doc"), F.col("bits").alias(f"{x}bits"))
    known = pairs.join(side("a"), "a").join(side("b"), "b")
    close = few_tasks(checkpoint(known.mapInArrow(tidy(lambda x: _close(x, percent)), "a bigint, b bigint, adoc bigint, bdoc bigint")))
    sets = _sets_of(docs, close.select(F.col("adoc").alias("doc_id")).unionByName(close.select(F.col("bdoc").alias("doc_id"))), width)
    rows = (
        close.select("a", "b").join(sets.select(F.col("cid").alias("a"), F.col("tokens").alias("at")), "a")
        .join(sets.select(F.col("cid").alias("b"), F.col("tokens").alias("bt")), "b")
        .select("a", "b", "at", "bt")
    )
    return few_tasks(checkpoint(rows.mapInArrow(tidy(lambda x: _linked(x, percent)), "a bigint, b bigint")))


def _boundary(counted: DataFrame, classes: DataFrame, percent: int) -> int:
    """The size up to which enumerating subsets costs less than scanning lists (both summed)."""
    sizes = {r["n"]: r["count"] for r in classes.filter(F.col("n") <= LIGHT_BOUND).groupBy("n").count().collect()}
    row = counted.filter("code IS NULL").agg(F.sum("squares").cast("double"), F.sum("hits").cast("double")).first()
    scanned = row[0] / row[1] if row[1] else 1.0
    best, cost, boundary = 0.0, 0.0, 0
    for n in range(1, LIGHT_BOUND + 1):
        cost += sizes.get(n, 0) * (enumeration_cost(n, percent) - prefix_length(n, percent) * scanned)
        if cost < best:
            best, boundary = cost, n
    return boundary


def _classes_and_labels(docs: DataFrame, percent: int, width: int) -> tuple[DataFrame, DataFrame]:
    """members (doc_id, n, cid, bits) per row of ``docs``, and groups (cid, doc_id, label): the classes of
    equal sets, their smallest doc_id and what tells their component."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    buckets = 16 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    members = checkpoint(docs.mapInArrow(tidy(lambda x: _members(x, width)), "doc_id bigint, n bigint, cid bigint, bits binary"))
    known = members.filter("n > 0 AND doc_id IS NOT NULL")
    first = known.groupBy("cid", "n").agg(F.min(F.struct("doc_id", "bits")).alias("first"))
    classes = checkpoint(first.select("cid", "n", "first.doc_id", "first.bits"))
    met = docs.filter("doc_id IS NOT NULL").select("text").mapInArrow(tidy(lambda x: _occurrences(x, width)), "bucket int, codes binary, hits binary")
    counted = checkpoint(met.repartition("bucket").mapInArrow(tidy(lambda x: _counted(x, FREQUENT)), "code bigint, hits bigint, squares bigint"))
    top = counted.filter("code IS NOT NULL").orderBy(F.desc("hits"), "code").limit(MOST_FREQUENT).select("code").toArrow()
    code = top.column("code").to_numpy().view(np.uint64)
    order = np.argsort(code)
    frequent = spark.sparkContext.broadcast((code[order], np.arange(len(code))[::-1][order].copy()))
    boundary = _boundary(counted, classes, percent)

    def postings(batches):
        hot, rank = frequent.value
        return _postings(batches, width, percent, hot, rank, boundary, buckets)

    packed = docs.filter("doc_id IS NOT NULL").select("text").mapInArrow(tidy(postings), _POSTINGS)
    lists = checkpoint(packed.repartition("bucket").mapInArrow(tidy(lambda x: _lists(x, percent, SHORT_LIST)), _LISTS))
    short = lists.filter("kind = 0").groupBy("a", "b").agg(F.min("apos").alias("first"))
    long = lists.filter("kind = 1").select("token", "a", "an", "apos").distinct()

    # A group of copies has its frequent shingles after each copy's own; the copy with the fewest of
    # its own, where the shingle comes first, is the most central.
    order = Window.partitionBy("a").orderBy("apos", "token")
    early = long.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= FIRST_LINKS).drop("k")
    centres = long.groupBy("token").agg(F.min(F.struct("apos", "a", "an")).alias("c"))
    need = lambda x, y: F.ceil(percent * (F.col(x) + F.col(y)) / (100 + percent) - F.lit(1e-9))
    star = (
        early.join(centres, "token").select(F.col("c.a").alias("a"), F.col("c.an").alias("bn"), F.col("c.apos").alias("bpos"), F.col("a").alias("b"), "an", "apos")
        .filter((F.col("a") != F.col("b")) & (F.least(F.col("an") - F.col("apos"), F.col("bn") - F.col("bpos")) >= need("an", "bn")))
        .select("a", "b")
    )
    links = _verified(short.filter("first = 0").select("a", "b").unionByName(star).distinct(), classes, docs, percent, width)
    near = few_tasks(checkpoint(components(links)))

    # Whatever lies in different components, through short lists and long ones.
    left = near.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    right = near.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    later = (
        short.filter("first > 0").join(left, "a", "left").join(right, "b", "left")
        .filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
    )
    placed = long.join(left, "a", "left").withColumn("c", F.coalesce("ca", "a"))
    per_token = placed.groupBy("token", "c").agg(F.count(F.lit(1)).alias("m"))
    largest = per_token.groupBy("token").agg(F.max(F.struct("m", "c")).alias("top"), F.count(F.lit(1)).alias("groups")).filter("groups > 1")
    placed = checkpoint(placed.join(largest, "token").withColumn("other", F.col("c") != F.col("top.c")).drop("top", "groups", "ca"))
    placed = few_tasks(placed)
    others = placed.filter("other").select("token", "a", "an", "apos", F.col("c").alias("ca"))
    every = placed.select("token", F.col("a").alias("b"), F.col("an").alias("bn"), F.col("apos").alias("bpos"), F.col("c").alias("cb"), "other")
    across = (
        others.join(every, "token")
        .filter((F.col("ca") != F.col("cb")) & (~F.col("other") | (F.col("a") < F.col("b"))))
        .filter(F.least(F.col("an") - F.col("apos"), F.col("bn") - F.col("bpos")) >= need("an", "bn"))
        .select("a", "b")
    )
    rest = _verified(later.unionByName(across).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), classes, docs, percent, width)
    label = components(links.unionByName(rest)).select(F.col("node").alias("cid"), F.col("component").alias("label"))

    groups = checkpoint(classes.join(label, "cid", "left").select("cid", "doc_id", F.coalesce("label", "cid").alias("label")))
    return members, groups


def ngram_components(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, component_id per row of ``docs`` (columns doc_id, text; others ignored).

    Null, empty and blank texts have an empty set and link with nothing.  A text of fewer than
    ``width`` words is one shingle.  Rows that repeat a doc_id are separate rows.  A row with a null
    doc_id is returned, makes no links, and its component_id is null.  An empty table gives none.
    """
    members, groups = _classes_and_labels(docs, percent, width)
    least = groups.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    named = groups.join(least, "label").select("cid", "component_id")
    return (
        members.join(named, "cid", "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce(F.when(F.col("n") > 0, F.col("component_id")), F.col("doc_id"))).alias("component_id"))
    )


def _of_class(batches: Iterator[pa.RecordBatch], width: int, wanted: str) -> Iterator[pa.RecordBatch]:
    """The rows whose text is of the class in column ``wanted`` (0: without shingles)."""
    for batch in batches:
        own = np.zeros(batch.num_rows, np.int64)
        for i, tokens in shingle_sets(batch.column("text"), width):
            own[i] = class_id(tokens) if len(tokens) else 0
        yield batch.filter(pa.array(own == batch.column(wanted).to_numpy()))


def keep_one(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """``docs`` with one document of each group of near duplicates: the one of smallest doc_id.

    Columns pass through.  Rows that repeat a doc_id are separate: each group's leading class keeps one
    row of its doc_id (smallest hash of its text), so unlike texts under one doc_id all stay, and copies
    of a text go with their group.  Of rows that repeat a doc_id with blank texts one stays.  Rows with a
    null doc_id belong to no group and stay.
    """
    members, groups = _classes_and_labels(docs, percent, width)
    members = members.filter("doc_id IS NOT NULL")
    lead = groups.groupBy("label").agg(F.min(F.struct("doc_id", "cid")).alias("lead")).select("lead.doc_id", "lead.cid")
    lead = lead.unionByName(members.filter("n = 0").select("doc_id", F.lit(0).cast("bigint").alias("cid")).distinct())
    often = members.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("doc_id")
    often = checkpoint(often)
    once = docs.filter("doc_id IS NOT NULL").join(lead.select("doc_id").join(often, "doc_id", "left_anti"), "doc_id", "left_semi")
    kept = once.select(*docs.columns).unionByName(docs.filter("doc_id IS NULL"))
    if not often.head(1):
        return kept
    wanted, place = unused(docs.columns, "wanted"), unused(docs.columns, "place")
    again = docs.join(lead.join(often, "doc_id", "left_semi").withColumnRenamed("cid", wanted), "doc_id").select(*docs.columns, wanted)
    same = again.mapInArrow(tidy(lambda x: _of_class(x, width, wanted)), again.schema)
    by = Window.partitionBy("doc_id", wanted).orderBy(F.xxhash64("text"), F.length("text"))
    one = same.withColumn(place, F.row_number().over(by)).filter(F.col(place) == 1)
    return kept.unionByName(one.select(*docs.columns))
