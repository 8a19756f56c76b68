"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

1. *Random indexing* over all documents.  Every word has a fixed sparse ternary index vector, drawn
   from its hash.  The vector of a word is the sum of the index vectors of its neighbours (two on
   each side), kept per hash bucket of the word and, in a second table, of its last three bytes.
   Sums are integers, so they do not depend on the order of tasks.  The tables have a fixed size
   (2 x ``BUCKETS`` x ``DIM``), so a task sends, and the driver gets, a bounded amount.
2. *Pooling*: a document is the mean of its words' vectors from both tables, the mean of their
   index vectors, that mean's squared norm (high where words repeat), its log length and the share
   of words whose index vector is that of the word before.
3. *Network* (numpy): one hidden layer, trained on at most ``TRAIN_ROWS`` labelled documents that
   are not held out; a temperature fitted on a part set aside calibrates the probabilities.

Inputs of a score come from the text alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verity.llm.common import mix, tidy, word_slices

BUCKETS = 1 << 14
DIM = 64
NONZERO = 2
BLOCK_ROWS = 256
#: Bound of the labelled documents that the network is trained on.
TRAIN_ROWS = 20_000
HIDDEN = 32
THRESHOLD = 0.3
#: Table entries that wait, for both tables and directions together, before they are counted.
WAITING = 4_000_000
FEATURES = 3 * DIM + 3


def _index(value: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Position and sign of the k-th non-zero entry of each word's index vector."""
    bits = value >> np.uint64(16 + 7 * k)
    return (bits & np.uint64(DIM - 1)).astype(np.int64), 1.0 - 2.0 * ((bits >> np.uint64(6)) & np.uint64(1)).astype(np.float64)


def _rows(value: np.ndarray, tail: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a word in the two tables."""
    return (value % np.uint64(BUCKETS)).astype(np.int64), (mix(tail) % np.uint64(BUCKETS)).astype(np.int64)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """This task's share of both tables, in blocks."""
    size = BUCKETS * DIM
    tables = [np.zeros(size, np.int64), np.zeros(size, np.int64)]
    # Entries wait until they are worth a count over a table: place, and size more if negative.
    waiting: list[list[np.ndarray]] = [[], []]
    held = 0

    def count():
        for table, places in zip(tables, waiting, strict=True):
            if places:
                found = np.bincount(np.concatenate(places), minlength=2 * size)
                table += found[:size]
                table -= found[size:]
                places.clear()

    for batch in batches:
        for _, _, value, counts, tail in word_slices(batch.column("text"), lower=False, tails=True):
            if len(value) < 2:
                continue
            doc = np.repeat(np.arange(len(counts)), counts)
            rows = [(row * DIM).astype(np.int32) for row in _rows(value, tail)]
            entries = [(at + size * (sign < 0)).astype(np.int32) for at, sign in (_index(value, k) for k in range(NONZERO))]
            for gap in (1, 2):
                if len(value) <= gap:
                    continue
                left = np.flatnonzero(doc[gap:] == doc[:-gap])
                for row, places in zip(rows, waiting, strict=True):
                    for entry in entries:
                        places.append(row[left] + entry[left + gap])
                        places.append(row[left + gap] + entry[left])
                        held += len(left)
            if held >= WAITING:
                count()
                held = 0
    count()
    blocks = BUCKETS // BLOCK_ROWS
    for t, table in enumerate(tables):
        parts = table.reshape(blocks, -1)
        used = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array((t * blocks + used).astype(np.int32)), pa.array([parts[b].tobytes() for b in used], pa.binary())], names=["block", "sums"]
        )


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, part in zip(batch.column("block").to_pylist(), batch.column("sums"), strict=True):
            sums = np.frombuffer(part.as_buffer(), np.int64)
            total[block] = total[block] + sums if block in total else sums.copy()
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["block", "sums"]
    )


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The two tables of unit vectors (2, BUCKETS, DIM), from the contexts of all documents."""
    kind = "block int, sums binary"
    blocks = docs.select("text").mapInArrow(tidy(_contexts), kind).repartition("block").mapInArrow(tidy(_summed), kind).collect()
    tables = np.zeros((2 * (BUCKETS // BLOCK_ROWS), BLOCK_ROWS * DIM))
    for r in blocks:
        tables[r["block"]] += np.frombuffer(r["sums"], np.int64)
    tables = tables.reshape(2, BUCKETS, DIM)
    size = np.linalg.norm(tables, axis=2, keepdims=True)
    return (tables / np.where(size > 0, size, 1)).astype(np.float32)


def pooled(column: pa.Array, tables: np.ndarray) -> np.ndarray:
    """The feature row of each text."""
    out = np.zeros((len(column), FEATURES), np.float32)
    for lo, hi, value, counts, tail in word_slices(column, lower=False, tails=True):
        full = np.flatnonzero(counts)
        if not len(full):
            continue
        many = counts[full]
        start = np.concatenate(([0], np.cumsum(many)[:-1]))
        own = out[lo:hi]
        # A long text is summed in pieces, so memory stays bounded.
        step = 200_000
        for x in range(0, len(value), step):
            y = min(x + step, len(value))
            inside = np.flatnonzero((start < y) & (start + many > x))
            edges = np.maximum(start[inside], x) - x
            for t, row in enumerate(_rows(value[x:y], tail[x:y])):
                vectors = tables[t][row]
                for i, a, b in zip(full[inside].tolist(), edges.tolist(), [*edges[1:].tolist(), y - x], strict=True):
                    own[i, t * DIM : (t + 1) * DIM] += vectors[a:b].sum(axis=0)
            who = np.repeat(np.arange(len(inside)), np.diff(np.append(edges, y - x)))
            sums = np.zeros(len(inside) * DIM)
            for k in range(NONZERO):
                at, sign = _index(value[x:y], k)
                sums += np.bincount(who * DIM + at, sign, len(sums))
            own[full[inside], 2 * DIM : 3 * DIM] += sums.reshape(-1, DIM).astype(np.float32)
        own[full, : 3 * DIM] /= many[:, None]
        own[full, 3 * DIM] = (own[full, 2 * DIM : 3 * DIM] ** 2).sum(axis=1)
        own[full, 3 * DIM + 1] = np.log1p(many)
        doc = np.repeat(np.arange(len(counts)), counts)
        alike = (value[1:] == value[:-1]) & (doc[1:] == doc[:-1])
        own[:, 3 * DIM + 2] = np.bincount(doc[1:][alike], minlength=len(counts)) / np.maximum(counts, 1)
    return out


class Network:
    """Two layers; scores are calibrated probabilities of label 1."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 7, epochs: int = 40, rate: float = 2e-3, decay: float = 1e-4):
        rng = np.random.default_rng(seed)
        self.base = float((y.sum() + 1) / (len(y) + 2))
        self.mean, self.scale = (x.mean(axis=0), x.std(axis=0) + 1e-4) if len(x) else (np.zeros(FEATURES), np.ones(FEATURES))
        self.temperature = 1.0
        self.weights = None
        if len(y) < 20 or y.min() == y.max():
            return
        z = ((x - self.mean) / self.scale).clip(-8, 8).astype(np.float32)
        order = rng.permutation(len(y))
        aside, own = order[: len(y) // 6], order[len(y) // 6 :]
        shape = (z.shape[1], HIDDEN)
        w = [rng.normal(0, np.sqrt(2 / shape[0]), shape), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.zeros(1)]
        w = [v.astype(np.float32) for v in w]
        first, second, step = [np.zeros_like(v) for v in w], [np.zeros_like(v) for v in w], 0
        for _ in range(epochs):
            for part in np.array_split(rng.permutation(own), max(1, len(own) // 128)):
                h = np.maximum(z[part] @ w[0] + w[1], 0)
                d = ((1 / (1 + np.exp(-(h @ w[2] + w[3])))) - y[part]).astype(np.float32) / len(part)
                dh = np.outer(d, w[2]) * (h > 0)
                grads = [z[part].T @ dh + decay * w[0], dh.sum(axis=0), h.T @ d + decay * w[2], d.sum(keepdims=True)]
                step += 1
                for i, g in enumerate(grads):
                    first[i] = 0.9 * first[i] + 0.1 * g
                    second[i] = 0.999 * second[i] + 0.001 * g * g
                    w[i] -= rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
        self.weights = w
        if len(aside):
            logit, target = self.logits(x[aside]), y[aside]
            grid = np.exp(np.linspace(np.log(0.5), np.log(8), 60))
            self.temperature = float(grid[np.argmin([np.mean(np.logaddexp(0, logit / t) - target * logit / t) for t in grid])])

    def logits(self, x: np.ndarray) -> np.ndarray:
        w = self.weights
        z = ((x - self.mean) / self.scale).clip(-8, 8).astype(np.float32)
        return (np.maximum(z @ w[0] + w[1], 0) @ w[2] + w[3]).astype(np.float64)

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.base)
        return 1 / (1 + np.exp(-self.logits(x) / self.temperature))


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> tuple[np.ndarray, Network]:
    """Word vectors from all of ``docs``, and the network from labelled rows that are not held out.

    Of conflicting labels of a doc_id the lower counts; null labels and ids do not.
    """
    tables = word_vectors(docs)
    shared = docs.sparkSession.sparkContext.broadcast(tables)
    known = (
        labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.min(F.col("quality").cast("int")).alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("doc_id", "y", "text")

    def features(batches):
        for batch in batches:
            x = pooled(batch.column("text"), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array([v.tobytes() for v in x], pa.binary())], names=["doc_id", "y", "x"])

    found = sorted((r["doc_id"], r["y"], bytes(r["x"])) for r in rows.mapInArrow(tidy(features), "doc_id bigint, y int, x binary").collect())
    x = np.array([np.frombuffer(r[2], np.float32) for r in found]).reshape(-1, FEATURES)
    return tables, Network(x, np.array([r[1] for r in found], np.float64))


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted per row of ``docs`` (columns doc_id, text; others ignored).

    Null, empty and blank texts are scored as a text without words.  A null doc_id is not held out.
    Without labels of both kinds every score is the smoothed share of label 1.  Rows that repeat a
    doc_id are separate rows; an empty table gives none.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    tables, network = train(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast((tables, network))

    def score(batches):
        tables, network = shared.value
        for batch in batches:
            s = network.scores(pooled(batch.column("text"), tables))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return docs.withColumn("held_out", held_out()).mapInArrow(tidy(score), "doc_id bigint, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches ``threshold``."""
    tables, network = train(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), labels)
    shared = docs.sparkSession.sparkContext.broadcast((tables, network))

    def chosen(batches):
        tables, network = shared.value
        for batch in batches:
            yield batch.filter(pa.array(network.scores(pooled(batch.column("text"), tables)) >= threshold))

    return docs.mapInArrow(tidy(chosen), docs.schema)
