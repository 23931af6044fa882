"""SentencePiece encoding and decoding on the tokenizers library.

The model file is a protobuf message; its pieces, scores, kinds and normaliser settings are
read field by field, and the same model is rebuilt for the tokenizers library: the metaspace
marker for spaces, unigram scores or merges derived from scores, and byte fallback. Texts are
cut before each run of spaces, which no piece crosses (checked when the model is read), so
each distinct cut is encoded once per block, in multithreaded batches. Parity with the
sentencepiece library is verified for every distinct cut; decoding goes back through the
pieces, and each text is compared with what went in.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiercast.llm import words as W
from tiercast.llm.tables import ship
from tiercast.llm.tokens import WordIds, packed_ids

MARK = "▁"
# Fixed values of the message format: kinds of piece and of model.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


@dataclass
class Model:
    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    trim: bool = True
    escape: bool = True
    suffix: bool = False


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and raw value of every field of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        wire = tag & 7
        if wire == 0:
            yield tag >> 3, varint()
            continue
        if wire not in (1, 2, 5):
            raise ValueError(f"wire type {wire} is not part of a model file")
        size = varint() if wire == 2 else 8 if wire == 1 else 4
        yield tag >> 3, data[at : at + size]
        at += size


def parse(data: bytes) -> Model:
    """Read a model file (fields: 1 pieces, 2 trainer settings, 3 normaliser settings)."""
    model = Model()
    for number, value in fields(data):
        if number == 1:
            piece = dict(fields(value))
            model.pieces.append(piece.get(1, b"").decode())
            model.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
            model.kinds.append(piece.get(3, NORMAL))
        elif number == 2:
            settings = dict(fields(value))
            model.kind = settings.get(3, UNIGRAM)
            model.byte_fallback = bool(settings.get(35, 0))
            model.suffix = bool(settings.get(24, 0))
        elif number == 3:
            settings = dict(fields(value))
            model.charsmap = settings.get(2, b"")
            model.dummy_prefix = bool(settings.get(3, 1))
            model.trim = bool(settings.get(4, 1))
            model.escape = bool(settings.get(5, 1))
    if model.kind not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are known")
    if model.suffix or not model.escape:
        raise ValueError("the space marker must stand before words")
    if any(MARK in p.lstrip(MARK) for p, k in zip(model.pieces, model.kinds) if k in (NORMAL, USER)):
        raise ValueError("a piece crosses a space, so texts cannot be cut there")
    return model


def normalised(model: Model, texts: list[str]) -> list[str]:
    """The model's normaliser: its character map, spaces trimmed and joined if it says so, and the leading space."""
    if model.charsmap:
        from tokenizers.normalizers import Precompiled

        step = Precompiled(model.charsmap)
        texts = [step.normalize_str(t) for t in texts]
    out = []
    for t in texts:
        t = t.replace(MARK, " ")
        if model.trim:
            t = " ".join(x for x in t.split(" ") if x)
        out.append(" " + t if t and model.dummy_prefix else t)
    return out


def tokenizer_of(model: Model):
    """The same model for the tokenizers library; its input is a cut with markers in place of spaces."""
    from tokenizers import Tokenizer, models

    unknown = model.kinds.index(UNKNOWN)
    if model.kind == UNIGRAM:
        # Control and unused pieces never come out of a text, so they get a score out of reach.
        least = min(model.scores, default=0.0) - 1e6
        usable = (NORMAL, USER, BYTE, UNKNOWN)
        vocabulary = [(p, s if k in usable else least) for p, s, k in zip(model.pieces, model.scores, model.kinds)]
        return Tokenizer(models.Unigram(vocabulary, unknown, model.byte_fallback))
    ids = {p: i for i, (p, k) in enumerate(zip(model.pieces, model.kinds)) if k in (NORMAL, USER)}
    ranked = sorted(ids, key=lambda p: (-model.scores[ids[p]], ids[p]))
    merges = [(p[:i], p[i:]) for p in ranked for i in range(1, len(p)) if p[:i] in ids and p[i:] in ids]
    vocabulary = {p: i for i, p in enumerate(model.pieces)}
    return Tokenizer(
        models.BPE(vocabulary, merges, unk_token=model.pieces[unknown], fuse_unk=True, byte_fallback=model.byte_fallback)
    )


class Codec:
    """Encoder and decoder of one model file."""

    def __init__(self, data: bytes):
        import sentencepiece

        self.model = parse(data)
        self.tokenizer = tokenizer_of(self.model)
        self.other = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.differ = 0
        self.ids = WordIds(self._encode)
        pieces = [
            bytes([int(p[3:5], 16)]) if k == BYTE else (b"" if k in (CONTROL, UNUSED) else (" ⁇ ".encode() if k == UNKNOWN else p.replace(MARK, " ").encode()))
            for p, k in zip(self.model.pieces, self.model.kinds)
        ]
        self.piece_sizes = np.array([len(p) for p in pieces], np.int64)
        self.piece_starts = np.cumsum(self.piece_sizes) - self.piece_sizes
        self.piece_bytes = np.frombuffer(b"".join(pieces), np.uint8)

    def _encode(self, cuts: list[bytes]) -> list[bytes]:
        """Encode distinct cuts and verify each against the sentencepiece library; its answer wins a dispute.

        Before a cut's ids stands 1 if the libraries differ on it, else 0, so the mark is remembered with them.
        """
        texts = [c.decode() for c in cuts]
        mine = [e.ids for e in self.tokenizer.encode_batch_fast([t.replace(" ", MARK) for t in texts], add_special_tokens=False)]
        # The other library puts the leading space there by itself.
        lead = self.model.dummy_prefix
        theirs = self.other.encode([t[1:] if lead and t[:1] == " " else t for t in texts], num_threads=1)
        if lead and " " in texts:  # alone it would be an empty text there
            theirs[texts.index(" ")] = self.other.encode("a ")[len(self.other.encode("a")) :]
        out = []
        for a, b in zip(mine, theirs):
            self.differ += a != b
            out.append(packed_ids([1, *b] if a != b else [0, *a]))
        return out

    def encode(self, texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids, the bounds per text, and whether the libraries agree on all cuts of a text."""
        plain = ["" if t is None else t for t in texts.to_pylist()]
        raw, offsets = W.text_bytes(pa.array(normalised(self.model, plain), pa.large_string()))
        starts, ends, owner = cuts_of(raw, offsets)
        ids, lengths = self.ids(raw, starts, ends)
        n = len(plain)
        marks = np.cumsum(lengths) - lengths
        apart = np.bincount(owner, weights=ids[marks], minlength=n) if len(owner) else np.zeros(n)
        per_text = np.bincount(owner, weights=lengths - 1, minlength=n).astype(np.int64) if len(owner) else np.zeros(n, np.int64)
        return np.delete(ids, marks), np.concatenate([[0], np.cumsum(per_text)]), apart == 0

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The texts of ids: pieces joined as bytes, broken byte runs replaced, the leading space gone."""
        sizes = self.piece_sizes[ids]
        flat = self.piece_bytes[W.spread(self.piece_starts[ids], sizes)].tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])[bounds]
        texts = [flat[a:b].decode(errors="replace") for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        return [t[1:] if self.model.dummy_prefix and t[:1] == " " else t for t in texts]


def cuts_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts cut before each run of spaces: starts, ends and the text of each cut."""
    space = raw == 32
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    begins[offsets[:-1][offsets[:-1] < len(raw)]] = True
    starts = np.flatnonzero(begins)
    ends = np.append(starts[1:], len(raw)) if len(starts) else starts
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


@lru_cache(maxsize=1)
def codec(path: str) -> Codec:
    with open(path, "rb") as file:
        return Codec(file.read())


def encode(docs: DataFrame, path: str) -> DataFrame:
    """A row per document: ``doc_id, ids, parity, restored``.

    ``parity``: every cut of the text has the same ids in both libraries. ``restored``: decoding
    the ids gives the normalised text back. A null or empty text has no ids. Null ids of
    documents stay null, repeated rows are encoded one by one, other columns are ignored.
    ``path`` is a model file that every executor can read.
    """

    def in_task(batches):
        tool = codec(path)
        for table in W.blocks(batches):
            ids, bounds, parity = tool.encode(table.column("text"))
            plain = ["" if t is None else t for t in table.column("text").to_pylist()]
            want = [t[1:] if tool.model.dummy_prefix and t else t for t in normalised(tool.model, plain)]
            back = tool.decode(ids, bounds)
            yield pa.RecordBatch.from_arrays(
                [
                    table.column("doc_id").combine_chunks(),
                    pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.view(np.int32), pa.int32())),
                    pa.array(parity, pa.bool_()),
                    pa.array([a == b for a, b in zip(back, want)], pa.bool_()),
                ],
                names=["doc_id", "ids", "parity", "restored"],
            )

    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(in_task, "doc_id long, ids array<int>, parity boolean, restored boolean")


def decode(rows: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` of rows with ``doc_id, ids``; null ids of tokens give an empty text."""

    def in_task(batches):
        tool = codec(path)
        for batch in batches:
            lists = batch.column("ids").to_pylist()
            sizes = [len(x or ()) for x in lists]
            ids = np.fromiter((i for x in lists for i in x or ()), np.int64, sum(sizes))
            texts = tool.decode(ids, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    ship(rows.sparkSession)
    return rows.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(in_task, "doc_id long, text string")
