"""Hierarchical multi-length packing of tokenised documents into training sequences.

Windows come in tiers of 1024, 512, 256, 128 and 64 tokens.  A document fills whole 1024-windows
first; its remainder is routed to the smallest tier that holds it.  The longest remainder opens a
window of its tier; the gap is filled from shorter ones, the largest that fits first, and when none
fits one is cut to fill it exactly, its rest going back to its own tier.  So every window is full.
What is left when a task ends, less than one window, is cut into powers of two.  Windows of a tier
form step groups of equal token counts (``STEP_TOKENS``).

Each task packs its own rows, in bounded slices, and holds at most one window's worth of ids
between slices: there is no shuffle, and no group grows with the data.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verity.llm.common import tidy

WINDOW = 1024
TIERS = (1024, 512, 256, 128, 64)
STEP_TOKENS = 16_384
END = 0
SLICE_TOKENS = 2_000_000
_SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, tier int, step_group bigint"


def _byte_of() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves, others from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return table | {chr(0x100 + i): b for i, b in enumerate(rest)}


def encoder(path: str) -> Callable[[str], np.ndarray]:
    """text -> ids of the tokenizer file at ``path``, without added special tokens.

    A plain byte-level BPE file whose merges are ranked in id order gives the same ids through
    ``tiktoken``, about four times as fast; any other file, and a text that names one of the
    file's special tokens, goes through ``tokenizers``.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = [t["content"] for t in spec.get("added_tokens") or []]
    slow = lambda text: np.array(full.encode(text, add_special_tokens=False).ids, np.uint32)
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
        return slow
    byte_of = _byte_of()
    vocab = {k: v for k, v in model["vocab"].items() if k not in special}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    made = [vocab.get(a + b) for a, b in merges]
    if None in made or any(x >= y for x, y in zip(made, made[1:])) or any(c not in byte_of for k in vocab for c in k):
        return slow
    ranks = {bytes(byte_of[c] for c in k): v for k, v in vocab.items()}
    fast = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if any(s in text for s in special):
            return slow(text)
        return fast.encode_to_numpy(text, disallowed_special=())

    return encode


class Packer:
    """Packs pieces of documents into full windows; ``rows`` takes what is ready."""

    def __init__(self, first_sequence: int = 0):
        self.by_length: list[list[tuple]] = [[] for _ in range(WINDOW)]
        self.present = 0  # bit n: by_length[n] is not empty
        self.sequence = first_sequence
        self.first = first_sequence
        self.per_tier: dict[int, int] = {}
        self.rows: list[tuple] = []

    def _put(self, piece: tuple) -> None:
        n = len(piece[2])
        self.by_length[n].append(piece)
        self.present |= 1 << n

    def _take(self, n: int) -> tuple:
        piece = self.by_length[n].pop()
        if not self.by_length[n]:
            self.present &= ~(1 << n)
        return piece

    def _emit(self, pieces: list[tuple]) -> None:
        tier = sum(len(p[2]) for p in pieces)
        index = self.per_tier.get(tier, 0)
        self.per_tier[tier] = index + 1
        group = self.first + (tier.bit_length() << 27) + index // max(1, STEP_TOKENS // tier)
        offset = 0
        for doc_id, start, ids, total in pieces:
            n = len(ids)
            self.rows.append((doc_id, start, n, zlib.crc32(ids), total, self.sequence, offset, tier, group))
            offset += n
        self.sequence += 1

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        total, x = len(ids), 0
        while total - x >= WINDOW:
            self._emit([(doc_id, x, ids[x : x + WINDOW], total)])
            x += WINDOW
        if x < total:
            self._put((doc_id, x, ids[x:], total))

    def pack(self) -> None:
        """Fill windows until what is left makes none."""
        while self.present:
            longest = self.present.bit_length() - 1
            pieces = [self._take(longest)]
            gap = max(TIERS[-1], 1 << (longest - 1).bit_length()) - longest
            while gap:
                fits = self.present & ((1 << (gap + 1)) - 1)
                if fits:
                    piece = self._take(fits.bit_length() - 1)
                elif self.present:
                    longer = self.present >> (gap + 1)
                    doc_id, start, ids, total = self._take(gap + (longer & -longer).bit_length())
                    piece = (doc_id, start, ids[:gap], total)
                    self._put((doc_id, start + gap, ids[gap:], total))
                else:
                    for p in pieces:
                        self._put((p[0], p[1], p[2].copy(), p[3]))
                    return
                pieces.append(piece)
                gap -= len(piece[2])
            self._emit(pieces)

    def finish(self) -> None:
        """Cut what is left, less than a window, into sequences of powers of two."""
        self.pack()
        pieces = []
        while self.present:
            pieces.append(self._take(self.present.bit_length() - 1))
        left = sum(len(p[2]) for p in pieces)
        while left:
            need = 1 << (left.bit_length() - 1)
            left -= need
            own = []
            while need:
                doc_id, start, ids, total = pieces.pop(0)
                own.append((doc_id, start, ids[:need], total))
                if len(ids) > need:
                    pieces.insert(0, (doc_id, start + need, ids[need:], total))
                need -= len(own[-1][2])
            self._emit(own)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group"]
    kinds = [pa.int32() if n == "tier" else pa.int64() for n in names]
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def pack_documents(docs: DataFrame, path: str) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, then
    tier (the sequence's length) and step_group.  ``docs`` needs doc_id and text.

    A document's ids are those of its whole text and then ``END``; a null or empty text has that
    one id.  A null doc_id stays null.  Rows that repeat a doc_id are packed separately.  An empty
    table gives no rows.  Every sequence has a power-of-two length, so none is padded.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        packer = Packer(TaskContext.get().partitionId() << 34)
        held = 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = np.append(encode(text.as_py() or ""), np.uint32(END)).astype("<u4", copy=False)
                packer.add(doc_id, ids)
                held += len(ids)
                if held >= SLICE_TOKENS:
                    packer.pack()
                    yield _batch(packer.rows)
                    packer.rows, held = [], 0
        packer.finish()
        yield _batch(packer.rows)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(tidy(run), _SCHEMA)
