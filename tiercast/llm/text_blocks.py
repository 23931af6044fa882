"""Blocks of whole texts, staged once for operators that pass over the corpus more than once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiercast.llm import words as W
from tiercast.llm.tables import stage_by


def stage_blocks(docs: DataFrame, size: int) -> DataFrame:
    """A row per block of about ``size`` bytes of text: ``block, words, head, text``, bucketed by block."""

    def in_task(batches):
        task = TaskContext.get().partitionId()
        for k, table in enumerate(W.blocks(batches, size=size)):
            raw, offsets = W.text_bytes(table.column("text"))
            ids = table.column("doc_id")
            known = ids.fill_null(0).to_numpy().astype(np.int64)
            head = W.squeeze(known, ids.is_null().to_numpy().astype(np.uint8), np.diff(offsets))
            text = zstandard.ZstdCompressor(level=6).compress(raw.tobytes())
            words = len(W.word_ranges(raw, offsets)[0])
            values = ([task << 24 | k], [words], [head], [text])
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, (pa.int64(), pa.int64(), pa.binary(), pa.binary()))], names=["block", "words", "head", "text"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return stage_by(rows.mapInArrow(in_task, "block long, words long, head binary, text binary"), "block", "blocks")


def key_ranges(blocks: DataFrame, block_bytes: int, range_bytes: int) -> int:
    """So many ranges of hashed keys that each gets the keys of about ``range_bytes`` of text, whatever the corpus."""
    least = 4 * int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-blocks.count() * block_bytes // range_bytes))


def opened(head: bytes, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A block's ids, null flags, bytes and offsets."""
    ids, missing, lengths = W.unsqueeze(head, np.int64, np.uint8, np.int64)
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(text), np.uint8)
    return ids, missing, raw, np.concatenate([[0], np.cumsum(lengths)])
