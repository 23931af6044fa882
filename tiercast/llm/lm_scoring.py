"""LM scoring: stupid-backoff scores from n-gram counts of the whole corpus, document left out.

A word scores by the longest n-gram that ends in it and occurs outside its own document:
``backoff ** k * c(n-gram) / c(context)`` with ``k`` orders backed off, counts without the
document's own. At the end stands ``max(c(word), 1) / max(words, 1)``. Scores are summed as whole
millionths of natural log units, so the sum does not depend on any order.

The relations are those of the textbook plan - n-grams exploded per document, count table
partitioned by hash, join, sum - but each side travels as sorted, compressed runs:

* texts are staged as *blocks* (compressed text of many documents, one row each), so that both
  passes see the same blocks whatever becomes of executors, and bucketed by block, so that no
  text moves when its answers come back;
* each block asks for its distinct n-grams once, a run per key range with its own counts. A
  frequent n-gram is one key per block, so no key can make a range hot;
* each key range adds up its runs - that is its part of the count table - and answers each run;
* answers meet their block again, n-grams are exploded, looked up, and summed per document.

Memory of a task: one block, or one key range. ``ranges`` and ``block_bytes`` set their sizes;
the corpus decides how many there are.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiercast.llm import words as W
from tiercast.llm.tables import ship
from tiercast.llm.text_blocks import key_ranges, opened, stage_blocks

ORDER = 3
BACKOFF = 0.4
BLOCK_BYTES = 4 << 20  # of text in a block
RANGE_BYTES = 16 << 20  # of text for each key range of the count tables
# Keys are the upper 56 bits of a hash: of 10 ** 13 n-grams one in 7,000 would share its count with another.
KEY_BITS = 56
MICRO = 1_000_000


def _grams(head: bytes, text: bytes, order: int):
    """Ids, null flags, and per order the key and document of every n-gram (by the position of its last word)."""
    ids, missing, raw, offsets = opened(head, text)
    starts, ends, owner = W.word_ranges(raw, offsets)
    one = W.range_hashes(raw, starts, ends)
    bounds = W.segments(owner, len(ids))
    place = np.arange(len(owner)) - bounds[owner]
    keys = [one]
    for k in range(1, order):
        # The n-gram that ends here is the shorter one that ends a word before, and this word.
        longer = np.zeros(len(one), W.U64)
        longer[1:] = W.mix(keys[-1][:-1] * W.U64(0xC2B2AE3D27D4EB4F) + one[1:])
        keys.append(longer)
    shift = W.U64(64 - KEY_BITS)
    return ids, missing, owner, place, [k >> shift for k in keys]


def _distinct(place: np.ndarray, keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The block's distinct n-grams of all orders, sorted, and how often each occurs."""
    return np.unique(np.concatenate([k[place >= n] for n, k in enumerate(keys)]), return_counts=True)


def _cuts(keys: np.ndarray, ranges: int) -> np.ndarray:
    """The bounds of each key range in sorted keys."""
    edges = [(r << KEY_BITS) // ranges for r in range(ranges)]
    return np.append(np.searchsorted(keys, np.array(edges, W.U64)), len(keys))


def ngram_runs(blocks: DataFrame, ranges: int, order: int = ORDER) -> DataFrame:
    """A row per block and key range: ``range, block, run`` (steps between sorted keys, and counts)."""

    def in_task(batches):
        for batch in batches:
            for block, head, text in zip(*(batch.column(c).to_pylist() for c in ("block", "head", "text"))):
                _, _, _, place, keys = _grams(head, text, order)
                distinct, counts = _distinct(place, keys)
                cuts = _cuts(distinct, ranges)
                some = [r for r in range(ranges) if cuts[r + 1] > cuts[r]]
                runs = []
                for r in some:
                    part = distinct[cuts[r] : cuts[r + 1]]
                    runs.append(W.squeeze(np.diff(part, prepend=W.U64(0)), counts[cuts[r] : cuts[r + 1]].astype(np.uint32)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int32()), pa.array([block] * len(some), pa.int64()), pa.array(runs, pa.binary())], names=["range", "block", "run"]
                )

    return blocks.select("block", "head", "text").mapInArrow(in_task, "range int, block long, run binary")


def _answer(table: pa.Table) -> pa.Table:
    """Add up one key range's runs and answer each: the corpus count of each of its keys, in its order."""
    parts = [W.unsqueeze(r, np.uint64, np.uint32) for r in table.column("run").to_pylist()]
    keys = [np.cumsum(steps, dtype=np.uint64) for steps, _ in parts]
    every, back = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.bincount(back, weights=np.concatenate([c for _, c in parts]), minlength=len(every)).astype(np.int64)
    ends = np.cumsum([len(k) for k in keys])
    counts = [W.squeeze(totals[back[e - len(k) : e]]) for k, e in zip(keys, ends)]
    return pa.table({"range": table.column("range"), "block": table.column("block"), "counts": pa.array(counts, pa.binary())})


def _block_scores(head: bytes, text: bytes, runs: list[bytes], total: int, order: int, backoff: float):
    ids, missing, owner, place, keys = _grams(head, text, order)
    n = len(ids)
    words = np.bincount(owner, minlength=n)
    score = np.zeros(n, np.int64)
    if len(owner):
        distinct, _ = _distinct(place, keys)
        corpus = np.concatenate([W.unsqueeze(r, np.int64)[0] for r in runs])
        outside = []
        for k, key in enumerate(keys):
            here = np.flatnonzero(place >= k)
            at = np.searchsorted(distinct, key[here])
            _, back, own = np.unique(at * n + owner[here], return_inverse=True, return_counts=True)
            left = np.zeros(len(key), np.int64)
            left[here] = corpus[at] - own[back]
            outside.append(left)
        rest = np.maximum(total - words, 1)[owner]
        value = np.log(np.maximum(outside[0], 1) / rest)
        depth = np.minimum(place, order - 1)
        value += depth * math.log(backoff)
        for k in range(1, order):
            seen = outside[k] > 0
            context = np.concatenate([[1], outside[k - 1][:-1]])
            value[seen] = np.log(outside[k][seen] / context[seen]) + (depth[seen] - k) * math.log(backoff)
        np.add.at(score, owner, np.rint(value * MICRO).astype(np.int64))
    return ids, missing, words, score


def scores(docs: DataFrame, order: int = ORDER, backoff: float = BACKOFF, ranges: int | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row per document: ``doc_id, n_words, score_micro`` (the sum of log scores, in millionths).

    Words are what ASCII white space separates. A null or empty text has no words and scores
    0. Null ids are kept as null, repeated rows are documents of their own (and count for each
    other), other columns are ignored, an empty table gives an empty result. ``ranges`` is the
    number of key ranges of the count tables, by default one for ``RANGE_BYTES`` of text, and four
    for each shuffle partition at least.
    """
    spark = docs.sparkSession
    ship(spark)
    blocks = stage_blocks(docs, block_bytes)
    ranges = ranges or key_ranges(blocks, block_bytes, RANGE_BYTES)
    total = blocks.agg(F.sum("words")).first()[0] or 0
    answers = ngram_runs(blocks, ranges, order).groupBy("range").applyInArrow(_answer, "range int, block long, counts binary")

    def of_block(left: pa.Table, right: pa.Table) -> pa.Table:
        runs = right.sort_by("range").column("counts").to_pylist()
        done = [_block_scores(h, t, runs, total, order, backoff) for h, t in zip(left.column("head").to_pylist(), left.column("text").to_pylist())]
        columns = [np.concatenate(c) for c in zip(*done)] if done else [np.zeros(0, np.int64)] * 4
        return pa.table(
            {
                "doc_id": pa.array(columns[0], pa.int64(), mask=columns[1].astype(bool)),
                "n_words": pa.array(columns[2], pa.int64()),
                "score_micro": pa.array(columns[3], pa.int64()),
            }
        )

    texts = blocks.select("block", "head", "text").groupBy("block")
    return texts.cogroup(answers.groupBy("block")).applyInArrow(of_block, "doc_id long, n_words long, score_micro long")
