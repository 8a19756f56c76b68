"""Byte-level BPE encoding and decoding by DuckDB queries inside each Spark task.

The distinct words of a slice of texts (matches of the split pattern) become rows of tokens, one
character per token, starting with their bytes.  A recursive query joins the rows of token
positions with the merge table, takes each word's leftmost pair of minimum rank, contracts it, and
goes on with the words that changed until none does.  Ids are kept per word in a bounded cache, so
a word is encoded once per worker.  Decoding joins (row, position, id) with the vocabulary and
aggregates the bytes in order.

A word of more than ``LONG_WORD`` bytes would need as many rounds as it has merges, each over the
whole word; it is merged with a heap instead, by the same rule.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Token i is written as this code point plus i: below the surrogates if all fit, else beyond them.
FIRST_LOW, FIRST_HIGH, SURROGATES = 0x100, 0x10000, 0xD800
CHUNK_WORDS = 50_000
CACHE_WORDS = 600_000
LONG_WORD = 256
SLICE_CHARS = 2_000_000
#: A text beyond that size is encoded so many words at a time; ids are decoded so many at a time.
PIECE_WORDS = 100_000
PIECE_IDS = 400_000
_POSITIONS = 1 << 20

_FIXPOINT = f"""
WITH RECURSIVE state(word, s) AS (
  SELECT word, s FROM words
  UNION ALL
  SELECT word, substr(s, 1, best % {_POSITIONS} - 1) || chr(CAST({{first}} + best // {_POSITIONS} AS INTEGER)) || substr(s, best % {_POSITIONS} + 2)
  FROM (
    SELECT r.word, any_value(r.s) AS s, min(m.rank * {_POSITIONS} + r.pos) AS best
    FROM (SELECT word, s, unnest(range(1, length(s))) AS pos FROM state) r
    JOIN merges m ON substr(r.s, r.pos, 2) = m.pair
    GROUP BY r.word
  )
)
SELECT word, arg_min(s, length(s)) AS s FROM state GROUP BY word
"""

#: One sort of all ids: sorting within the aggregate costs three times as much.  One thread reads them, in that order.
_DECODE = "SELECT row, string_agg(hex, '') AS hex FROM (SELECT row, pos, v.hex FROM ids JOIN vocabulary v USING (id) ORDER BY pos) GROUP BY row"


class Codec:
    """A rank file's vocabulary in an in-process DuckDB of one worker."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern = regex.compile(pattern)
        first = self.first = FIRST_LOW if FIRST_LOW + max(self.ranks.values()) < SURROGATES else FIRST_HIGH
        self.fixpoint = _FIXPOINT.format(first=first)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        made = [(a, b, i) for t, i in self.ranks.items() for k in range(1, len(t)) if (a := self.ranks.get(t[:k])) is not None and (b := self.ranks.get(t[k:])) is not None]
        self._load("merges", pair=[chr(first + a) + chr(first + b) for a, b, _ in made], rank=pa.array([i for *_, i in made], pa.int64()))
        self._load("vocabulary", id=pa.array(self.ranks.values(), pa.int32()), hex=[t.hex() for t in self.ranks])
        self.byte = {b: chr(first + self.ranks[bytes([b])]) for b in range(256)}
        self.ints = list(range(max(self.ranks.values()) + 1))  # shared by all cached words
        self.text = [str(i) for i in self.ints]
        self.cache: dict[str, tuple] = {}

    def _load(self, name: str, **columns) -> None:
        self.db.register("loaded", pa.table(columns))
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM loaded")
        self.db.unregister("loaded")

    def _heap(self, word: bytes) -> tuple:
        """Leftmost pair of minimum rank first, for one long word."""
        parts: list[bytes | None] = [word[i : i + 1] for i in range(len(word))]
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        pairs = [(r, i) for i in range(len(parts) - 1) if (r := self.ranks.get(parts[i] + parts[i + 1])) is not None]
        heapq.heapify(pairs)
        while pairs:
            rank, i = heapq.heappop(pairs)
            j = after[i]
            if parts[i] is None or j >= len(parts) or self.ranks.get(parts[i] + parts[j]) != rank:
                continue
            parts[i] += parts[j]
            parts[j] = None
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < len(parts) and (r := self.ranks.get(parts[x] + parts[y])) is not None:
                    heapq.heappush(pairs, (r, x))
        return tuple(self.ints[self.ranks[p]] for p in parts if p is not None)

    def _learn(self, words: set[str]) -> None:
        if len(self.cache) + len(words) > CACHE_WORDS:
            self.cache.clear()
        todo = []
        for word in words:
            raw = word.encode()
            known = self.ranks.get(raw)
            if known is not None:
                self.cache[word] = (self.ints[known],)
            elif len(raw) > LONG_WORD:
                self.cache[word] = self._heap(raw)
            else:
                todo.append((word, raw))
        ints, first = self.ints, self.first
        for x in range(0, len(todo), CHUNK_WORDS):
            part = todo[x : x + CHUNK_WORDS]
            rows = pa.table({"word": pa.array(range(len(part)), pa.int32()), "s": [raw.decode("latin1").translate(self.byte) for _, raw in part]})
            self.db.register("words", rows)
            for i, s in self.db.execute(self.fixpoint).fetchall():
                self.cache[part[i][0]] = tuple([ints[ord(c) - first] for c in s])
            self.db.unregister("words")

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        split = [self.pattern.findall(t) if t else [] for t in texts]
        distinct = set().union(*split)
        new = distinct - self.cache.keys()
        if len(self.cache) + len(new) > CACHE_WORDS:
            new = distinct  # the cache starts anew
        if new:
            self._learn(new)
        return [list(chain.from_iterable(map(self.cache.__getitem__, words))) for words in split]

    def pieces(self, text: str) -> Iterator[list[int]]:
        """The ids of one long text, some words at a time."""
        words = (m.group() for m in self.pattern.finditer(text))
        while part := list(islice(words, PIECE_WORDS)):
            new = set(part) - self.cache.keys()
            if len(self.cache) + len(new) > CACHE_WORDS:
                new = set(part)
            if new:
                self._learn(new)
            yield list(chain.from_iterable(map(self.cache.__getitem__, part)))

    def decode(self, rows: list[list[int]]) -> list[bytes]:
        """The bytes of each row of ids, in queries of at most ``PIECE_IDS`` ids."""
        out: list[list[bytes]] = [[] for _ in rows]
        at, held, size = [], [], 0
        for i, row in enumerate(rows):
            for x in range(0, len(row), PIECE_IDS):
                part = row[x : x + PIECE_IDS]
                if held and size + len(part) > PIECE_IDS:
                    for k, data in zip(at, self._decoded(held), strict=True):
                        out[k].append(data)
                    at, held, size = [], [], 0
                at.append(i)
                held.append(part)
                size += len(part)
        for k, data in zip(at, self._decoded(held), strict=True):
            out[k].append(data)
        return [b"".join(parts) for parts in out]

    def _decoded(self, rows: list[list[int]]) -> list[bytes]:
        out = [b""] * len(rows)
        many = [len(r) for r in rows]
        ids = pa.table({
            "row": np.repeat(np.arange(len(rows), dtype=np.int32), many),
            "pos": np.arange(sum(many), dtype=np.int64),
            "id": pa.array(np.fromiter(chain.from_iterable(rows), np.int32, sum(many))),
        })
        self.db.register("ids", ids)
        for i, text in self.db.execute(_DECODE).fetchall():
            out[i] = bytes.fromhex(text)
        self.db.unregister("ids")
        return out


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec per worker and file."""
    return Codec(path, pattern)


def _slices(batch: pa.RecordBatch, column: str, most: int) -> Iterator[tuple[list, list]]:
    """(doc_ids, values) of parts of a batch whose values are at most ``most`` long together, or one value."""
    ids, values, held = [], [], 0
    for doc_id, value in zip(batch.column("doc_id").to_pylist(), batch.column(column), strict=True):
        value = value.as_py()
        size = len(value) if value else 0
        if ids and held + size > most:
            yield ids, values
            ids, values, held = [], [], 0
        ids.append(doc_id)
        values.append(value)
        held += size
    if ids:
        yield ids, values


def _long(texts: list[str | None]) -> bool:
    """Whether a slice is one text beyond the usual size."""
    return len(texts) == 1 and len(texts[0] or "") > SLICE_CHARS


def _keyed(docs: DataFrame, column: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), column)


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids (array<int>) per row of ``docs`` (doc_id, text).

    A null or empty text has no ids.  Rows with a null or repeated doc_id are rows like others.
    """

    def run(batches):
        for batch in batches:
            for ids, texts in _slices(batch, "text", SLICE_CHARS):
                own = codec(path, pattern)
                if _long(texts):
                    found = pa.chunked_array([pa.array(x, pa.int32()) for x in own.pieces(texts[0])], pa.int32()).combine_chunks()
                    found = [found]
                else:
                    found = own.encode(texts)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return _keyed(docs, "text").mapInArrow(run, "doc_id bigint, ids array<int>")


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, data (binary) per row of ``encoded`` (doc_id, ids); null ids decode to no bytes."""

    def run(batches):
        for batch in batches:
            for ids, rows in _slices(batch, "ids", SLICE_CHARS):
                data = codec(path, pattern).decode([r or [] for r in rows])
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(data, pa.binary())], names=["doc_id", "data"])

    return _keyed(encoded, "ids").mapInArrow(run, "doc_id bigint, data binary")


def round_trip_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 per row of ``docs``: encoded, then decoded from the ids.

    Both steps run in one Python worker, so ids do not travel.  Nulls and repeats as above; an empty
    table gives no rows.
    """
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    sha = lambda data: hashlib.sha256(data).hexdigest()

    def run(batches):
        for batch in batches:
            for ids, texts in _slices(batch, "text", SLICE_CHARS):
                own = codec(path, pattern)
                if _long(texts):
                    n, named, data = 0, hashlib.sha256(), hashlib.sha256()
                    for piece in own.pieces(texts[0]):
                        if piece:
                            named.update((("," if n else "") + ",".join(map(own.text.__getitem__, piece))).encode())
                            data.update(own.decode([piece])[0])
                            n += len(piece)
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([n], pa.int64()), pa.array([named.hexdigest()]), pa.array([data.hexdigest()])], names=names)
                    continue
                found = own.encode(texts)
                written = [sha(",".join(map(own.text.__getitem__, r)).encode()) for r in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array([len(r) for r in found], pa.int64()), pa.array(written), pa.array([sha(d) for d in own.decode(found)])],
                    names=names,
                )

    return _keyed(docs, "text").mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
