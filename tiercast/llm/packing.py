"""Packing: bounded-space online packing of token ids into windows.

Each task keeps a fixed number of open windows. A document longer than a window is cut into
full ones; its rest goes to the open window that it fits best. Where none fits, the fullest
window is topped up with the head of the rest and emitted, and the tail opens a new window.
At the end of a task its open windows are merged by refilling, which leaves at most one
partial window; those leftovers, at most one per task, are merged in groups of tasks.

A finished window needs no more than its pieces' numbers, so memory is the open windows plus
one block of texts. Pieces are staged, since finished ones and leftovers are both read from them.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiercast.llm import words as W
from tiercast.llm.tables import ship
from tiercast.llm.tokens import WordIds, packed_ids
from tiercast.plans.staging import stage

WINDOW = 4096
OPEN_WINDOWS = 32
# A gap under this many ids is padded and not filled with a splinter of a document.
LEAST_PIECE = 8
TASKS_PER_GROUP = 256

_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("ids", pa.binary()),
    ]
)
_SPARK = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


class Packer:
    """Open windows of pieces ``(doc_id, start, ids, doc_tokens)``, and rows of the finished ones."""

    def __init__(self, window: int, open_windows: int, first_sequence: int):
        self.window, self.limit, self.sequence = window, open_windows, first_sequence
        self.open: list[tuple[int, list]] = []
        self.rows: list[tuple] = []

    def _emit(self, pieces: list, with_ids: bool = False) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            data = ids.tobytes()
            self.rows.append((doc, start, len(ids), zlib.crc32(data), total, None if with_ids else self.sequence, offset, data if with_ids else None))
            offset += len(ids)
        self.sequence += 1

    def add(self, doc, ids: np.ndarray, start: int = 0, total: int | None = None) -> None:
        total = len(ids) if total is None else total
        at = 0
        while len(ids) - at >= self.window:
            self._emit([(doc, start + at, ids[at : at + self.window], total)])
            at += self.window
        while at < len(ids):
            rest = len(ids) - at
            fitting = [i for i, (fill, _) in enumerate(self.open) if fill + rest <= self.window]
            if fitting:
                best = max(fitting, key=lambda i: self.open[i][0])
                fill, pieces = self.open[best]
            elif len(self.open) < self.limit:
                best, fill, pieces = len(self.open), 0, []
                self.open.append((0, pieces))
            else:
                best = max(range(len(self.open)), key=lambda i: self.open[i][0])
                fill, pieces = self.open.pop(best)
                gap = self.window - fill
                if gap >= LEAST_PIECE:
                    pieces.append((doc, start + at, ids[at : at + gap], total))
                    at += gap
                self._emit(pieces)
                continue
            pieces.append((doc, start + at, ids[at:].copy(), total))
            at = len(ids)
            if fill + rest == self.window:
                self._emit(pieces)
                self.open.pop(best)
            else:
                self.open[best] = (fill + rest, pieces)

    def merge(self) -> list:
        """Refill the open windows one after another; what is left of them is one partial window."""
        queue = [p for _, pieces in sorted(self.open, key=lambda w: -w[0]) for p in pieces]
        self.open, fill, pieces = [], 0, []
        for doc, start, ids, total in queue:
            while len(ids):
                part = ids[: self.window - fill]
                pieces.append((doc, start, part, total))
                fill, start, ids = fill + len(part), start + len(part), ids[len(part) :]
                if fill == self.window:
                    self._emit(pieces)
                    fill, pieces = 0, []
        return pieces

    def batches(self, everything: bool = False) -> Iterator[pa.RecordBatch]:
        if self.rows and (everything or len(self.rows) >= 10_000):
            columns = zip(*self.rows)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PIECES)], schema=_PIECES)
            self.rows = []


# Words of small a-z and small Latin-1 letters: normalised as they are, and one piece before merging.
_PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _encoder(path: str):
    """Encode distinct words. Plain ones are a single piece each and go to the merges at once."""
    from tokenizers import Tokenizer, pre_tokenizers

    tokenizer = Tokenizer.from_file(path)
    merges = tokenizer.model
    level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    letters = [bytes([b]).decode() for b in range(97, 123)] + [bytes([195, b]).decode() for b in range(159, 192) if b != 183]
    as_bytes = str.maketrans({c: level.pre_tokenize_str(c)[0][0] for c in letters})

    def encode(items: list[bytes]) -> list[bytes]:
        out = [packed_ids([t.id for t in merges.tokenize(w.decode().translate(as_bytes))]) if _PLAIN.fullmatch(w) else None for w in items]
        rest = [k for k, ids in enumerate(out) if ids is None]
        for k, e in zip(rest, tokenizer.encode_batch_fast([items[k].decode() for k in rest], add_special_tokens=False)):
            out[k] = packed_ids(e.ids)
        return out

    return encode


@lru_cache(maxsize=1)
def _word_ids(path: str) -> WordIds:
    """One encoder for all tasks of a worker, with what it remembers."""
    return WordIds(_encoder(path))


def _parted(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words with a full stop or comma behind a letter parted from it, as the tokenizer does."""
    mark = (ends - starts > 1) & ((raw[ends - 1] == 46) | (raw[ends - 1] == 44))
    before = raw[np.maximum(ends - 2, 0)]
    mark &= (before >= 97) & (before <= 122)
    at = np.flatnonzero(mark)
    cut = ends[at] - 1
    new_starts = np.insert(starts, at + 1, cut)
    new_ends = np.insert(ends, at, cut)
    return new_starts, new_ends, np.insert(owner, at, owner[at])


def token_blocks(batches, path: str, end_id: int) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """Per block of texts: the document ids, all token ids with an end id per text, and the bounds per text.

    This holds for a tokenizer like the given one: lower case, white space parts words and
    leaves no ids of its own, and letters are parted from punctuation.
    """
    encode = _word_ids(path)
    for table in W.blocks(batches, size=4 << 20):
        raw, offsets = W.text_bytes(table.column("text"))
        if b"<|" not in raw.tobytes():  # else a special token's text might come up that was not there
            raw = _LOWER[raw]
        starts, ends, owner = _parted(raw, *W.word_ranges(raw, offsets))
        ids, lengths = encode(raw, starts, ends)
        n = table.num_rows
        per_text = np.bincount(owner, weights=lengths, minlength=n).astype(np.int64) if len(owner) else np.zeros(n, np.int64)
        bounds = np.concatenate([[0], np.cumsum(per_text + 1)])
        out = np.full(int(bounds[-1]), end_id, "<u4")
        out[W.spread(bounds[:-1], per_text)] = ids
        yield table.column("doc_id").to_pylist(), out, bounds


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 2,
    window: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
) -> DataFrame:
    """A row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A null or empty text is its end id alone. Null ids are kept as null, repeated rows are
    packed one by one, other columns are ignored, an empty table gives an empty result.
    ``tokenizer`` is the path of a tokenizer file that every executor can read.
    """

    def in_task(batches):
        packer = Packer(window, open_windows, TaskContext.get().partitionId() << 36)
        for names, ids, bounds in token_blocks(batches, tokenizer, end_id):
            for k, doc in enumerate(names):
                packer.add(doc, ids[bounds[k] : bounds[k + 1]])
                yield from packer.batches()
        left = packer.merge()
        if left:
            packer._emit(left, with_ids=True)
        yield from packer.batches(everything=True)

    ship(docs.sparkSession)
    task = F.spark_partition_id()
    pieces = stage(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .mapInArrow(in_task, _SPARK)
        .withColumn("bin", F.when(F.col("ids").isNotNull(), F.floor(task / TASKS_PER_GROUP).cast("long"))),
        "pieces",
    )

    def refill(table: pa.Table) -> pa.Table:
        packer = Packer(window, 0, (1 << 62) | (table.column("bin")[0].as_py() << 36))
        held = [(r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4"), r["doc_tokens"]) for r in table.to_pylist()]
        packer.open = [(0, held)]
        left = packer.merge()
        if left:
            packer._emit(left)
        return pa.Table.from_batches(list(packer.batches(everything=True)), _PIECES)

    merged = pieces.where("ids is not null").groupBy("bin").applyInArrow(refill, _SPARK)
    return pieces.where("ids is null").drop("bin").unionByName(merged).drop("ids")
