"""Quality classifier: hierarchical empirical Bayes over a document classifier.

1. Two logistic regressions on hashed features (words, runs of symbols, a few shape features),
   one for junk and one for toxic texts, are fitted on a bounded sample of labelled rows; their
   fixed-size weights give every document's evidence that it should go.
2. The evidence is summed per path and per host by grouped aggregation. A host's posterior is
   shrunk toward the global rate, a path's toward its host's, each with a prior strength
   estimated from the spread between groups; sparse sites stay near their prior.
3. The document's log odds are moved by its path's posterior, in which the document itself
   does not count.

Texts are read once for evidence; everything after works on four narrow columns.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiercast.llm import words as W
from tiercast.llm.tables import ship, text_of, unpacked
from tiercast.plans.staging import stage

# The sample that the weights are fitted on: at most so many labelled rows, by least hash of their id.
TRAIN_ROWS = 20_000
FEATURES = 1 << 20
LEAST_Z = 5.0
THRESHOLD = 0.5
# How much of the site's log odds counts.
SITE_WEIGHT = 0.5

_CLASSES = np.full(256, 2, np.uint8)  # symbols
_CLASSES[[9, 10, 11, 12, 13, 32]] = 0
for _first, _last in ((48, 57), (65, 90), (97, 122), (128, 255)):
    _CLASSES[_first : _last + 1] = 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def features(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed features of each text, flat, and the bounds per text."""
    raw, offsets = W.text_bytes(texts)
    n = len(offsets) - 1
    raw = _LOWER[raw]
    starts, ends, owner = W.class_runs(raw, offsets, _CLASSES)
    hashes = W.range_hashes(raw, starts, ends)
    symbol = _CLASSES[raw[starts]] == 2
    counts = np.bincount(owner, minlength=n)
    safe = np.maximum(counts, 1)
    # Shape: share of symbol runs, of words that repeat the one before, of distinct words, and the length.
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    keys, first = np.unique(W.mix(hashes ^ W.mix(owner.astype(W.U64))), return_index=True)
    distinct = np.bincount(owner[first], minlength=n)
    shape = [
        np.bincount(owner, weights=symbol, minlength=n) / safe * 10,
        np.bincount(owner, weights=again, minlength=n) / safe * 10,
        distinct / safe * 5,
        np.log2(counts + 1),
    ]
    extra = [W.mix(np.floor(s).astype(W.U64) + W.U64(1000 * (k + 1))) for k, s in enumerate(shape)]
    order = np.argsort(owner[first], kind="stable")
    values = np.concatenate([hashes[first][order], *extra])
    whose = np.concatenate([owner[first][order], *[np.arange(n)] * len(extra)])
    by_text = np.argsort(whose, kind="stable")
    bounds = np.concatenate([[0], np.cumsum(np.bincount(whose, minlength=n))])
    return (values[by_text] & W.U64(FEATURES - 1)).astype(np.int32), bounds


def fit(flat: np.ndarray, bounds: np.ndarray, bad: np.ndarray, rounds: int = 300, decay: float = 1e-5) -> tuple[np.ndarray, float]:
    """Logistic regression by full-batch Adam over the features that tell the classes apart: weights and bias.

    A feature takes part if the number of bad documents that have it is ``LEAST_Z`` deviations
    off what the share of bad documents makes expect; the weights of all others stay 0.
    """
    row = np.repeat(np.arange(len(bad)), np.diff(bounds))
    if not bad.any() or bad.all():
        return np.zeros(FEATURES), 30.0 if len(bad) and bad.all() else -30.0
    share = bad.mean()
    have = np.bincount(flat, minlength=FEATURES)
    off = np.bincount(flat, weights=bad[row], minlength=FEATURES) - have * share
    telling = np.abs(off) >= LEAST_Z * np.sqrt(np.maximum(have, 1) * share * (1 - share))
    places = np.flatnonzero(telling)
    used = telling[flat]
    row, flat = row[used], np.searchsorted(places, flat[used])
    w, bias = np.zeros(len(places)), math.log(share / (1 - share))
    first, second = np.zeros(len(places)), np.zeros(len(places))
    for k in range(1, rounds + 1):
        margin = np.bincount(row, weights=w[flat], minlength=len(bad)) + bias
        error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - bad
        slope = np.bincount(flat, weights=error[row], minlength=len(places)) / len(bad) + decay * w
        first += 0.1 * (slope - first)
        second += 0.001 * (slope * slope - second)
        w -= 0.1 * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.999**k)) + 1e-8)
        bias -= error.mean()
    weights = np.zeros(FEATURES)
    weights[places] = w
    return weights, bias


def _junk() -> Column:
    return F.coalesce(F.col("quality"), F.lit(1)) == 0


def _toxic() -> Column:
    return F.coalesce(F.col("toxic"), F.lit(0)) == 1


def bad_label() -> Column:
    """A label says that a document should go if its quality is 0 or it is toxic; null says nothing."""
    return F.when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), (_junk() | _toxic()).cast("int"))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> list[tuple[np.ndarray, float]]:
    """Weights for junk and for toxic texts, from at most ``rows`` labelled documents; without any, nothing is rejected."""
    known = labels.select("doc_id", bad_label().alias("bad"), _junk().alias("junk"), _toxic().alias("toxic")).where("doc_id is not null and bad is not null")
    one = known.groupBy("doc_id").agg((F.max(F.col("junk").cast("int")) + 2 * F.max(F.col("toxic").cast("int"))).alias("bad"))
    sample = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)  # the documented bound of what is sent to every task
    labelled = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(sample), "doc_id")

    def in_task(batches):
        for table in W.blocks(batches):
            flat, bounds = features(table.column("text"))
            yield pa.RecordBatch.from_arrays(
                [table.column("bad").combine_chunks().cast(pa.int32()), pa.array([flat[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())],
                names=["bad", "features"],
            )

    ship(docs.sparkSession)
    got = labelled.mapInArrow(in_task, "bad int, features binary").toArrow()
    if not got.num_rows:
        return [(np.zeros(FEATURES), -30.0)] * 2
    lists = got.column("features").to_pylist()
    # In an order that does not depend on the partitions, as sums of floats do.
    order = sorted(range(len(lists)), key=lambda k: lists[k])
    flat = np.frombuffer(b"".join(lists[k] for k in order), np.int32)
    bounds = np.concatenate([[0], np.cumsum([len(lists[k]) // 4 for k in order])])
    bad = got.column("bad").to_numpy()[order]
    return [fit(flat, bounds, (bad & bit > 0).astype(float)) for bit in (1, 2)]


def evidence(docs: DataFrame, model: list[tuple[np.ndarray, float]], host: str = "source", path: str = "lang", carry: bool = False) -> DataFrame:
    """Staged, a row per document: ``doc_id, text_key, host, path, margin`` (log odds that it should go for either reason).

    With ``carry`` the whole row stands beside them as ``_row``.
    """
    weights = np.stack([w for w, _ in model]).astype(np.float32)
    biases = [b for _, b in model]
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long"), F.xxhash64(text_of()).alias("text_key"), name(host).alias("host"), name(path).alias("path"), F.col("text").cast("string"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")] if carry else []),
    )
    told = ["doc_id", "text_key", "host", "path", *(["_row"] if carry else [])]
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # a fixed size: one number per hashed feature

    def in_task(batches):
        w = shared.value
        for table in W.blocks(batches):
            flat, bounds = features(table.column("text"))
            row = np.repeat(np.arange(table.num_rows), np.diff(bounds))
            clean = np.ones(table.num_rows)
            for head, bias in zip(w, biases):
                z = np.clip(np.bincount(row, weights=head[flat], minlength=table.num_rows) + bias, -30, 30)
                clean = clean / (1 + np.exp(z))
            margin = np.log1p(-clean) - np.log(clean)
            kept = [table.column(c).combine_chunks() for c in told]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(margin, pa.float64())], names=[*told, "margin"])

    schema = T.StructType([rows.schema[c] for c in told] + [T.StructField("margin", T.DoubleType())])
    return stage(rows.mapInArrow(in_task, schema), "evidence")


def _strength(rate: float, groups: float, between: float, within: float) -> float:
    """Prior strength in documents, by moments: what is left of the spread between groups when chance is taken off."""
    spread = between - within
    if groups < 2 or spread <= 0 or rate <= 0 or rate >= 1:
        return 1e6
    return min(max(rate * (1 - rate) / spread - 1, 1.0), 1e6)


def posteriors(found: DataFrame) -> tuple[DataFrame, float]:
    """Staged, per path: ``host, path, n, s, host_rate, prior`` (its prior strength); and the global rate."""
    p = 1 / (1 + F.exp(-F.col("margin")))
    paths = found.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum(p).alias("s"))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s"))
    total = hosts.agg(F.sum("host_n").alias("n"), F.sum("host_s").alias("s"), F.count(F.lit(1)).alias("g")).first()
    rate = total.s / total.n if total.n else 0.5
    chance = rate * (1 - rate)
    off = F.col("host_s") / F.col("host_n") - rate
    of_hosts = hosts.agg(F.avg(off * off).alias("b"), F.avg(F.lit(chance) / F.col("host_n")).alias("w")).first()
    k_host = _strength(rate, total.g or 0, of_hosts.b or 0.0, of_hosts.w or 0.0)
    hosts = hosts.withColumn("host_rate", (F.col("host_s") + k_host * rate) / (F.col("host_n") + k_host))
    both = paths.join(hosts, "host")
    off = F.col("s") / F.col("n") - F.col("host_rate")
    of_paths = both.agg(F.avg(off * off).alias("b"), F.avg(F.lit(chance) / F.col("n")).alias("w"), F.count(F.lit(1)).alias("g")).first()
    k_path = _strength(rate, of_paths.g or 0, of_paths.b or 0.0, of_paths.w or 0.0)
    # Its size on disk lets Spark send it to the documents, or split the paths that hold most of them.
    return stage(both.select("host", "path", "n", "s", "host_rate", F.lit(k_path).alias("prior")), "paths"), rate


def scored(
    docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", threshold: float = THRESHOLD, train_rows: int = TRAIN_ROWS
) -> DataFrame:
    """A row per document: ``doc_id, text_key, evidence, host_rate, path_rate, bad, keep``.

    ``bad`` is the probability that the document should go; it stays under ``threshold``. A
    null or empty text has only the shape features of an empty one. Null hosts and paths are
    groups of the empty name, null ids are kept as null, repeated rows are scored one by one,
    other columns are ignored; without labels every document stays.
    """
    found = evidence(docs, train(docs, labels, train_rows), host, path)
    rows = judged(found)
    return rows.withColumn("keep", F.col("bad") < threshold)


def judged(found: DataFrame) -> DataFrame:
    """``doc_id, text_key, evidence, host_rate, path_rate, bad`` of documents with their ``margin``.

    A document's own evidence is taken out of its path's, and what the rest of the path says moves its log odds.
    Whole rows (``_row``) come along where they are there.
    """
    groups, rate = posteriors(found)
    p = 1 / (1 + F.exp(-F.col("margin")))
    logit = lambda c: F.log(c / (1 - c))
    inside = lambda c: F.greatest(F.least(c, F.lit(1 - 1e-6)), F.lit(1e-6))
    path_rate = inside((F.col("s") - p + F.col("prior") * F.col("host_rate")) / (F.col("n") - 1 + F.col("prior")))
    base = min(max(rate, 1e-6), 1 - 1e-6)
    moved = F.col("margin") + SITE_WEIGHT * (logit(path_rate) - math.log(base / (1 - base)))
    return found.join(groups, ["host", "path"]).select(
        "doc_id", "text_key", F.col("margin").alias("evidence"), "host_rate", path_rate.alias("path_rate"), (1 / (1 + F.exp(-moved))).alias("bad"),
        *[c for c in found.columns if c == "_row"],
    )


def keep(
    docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", threshold: float = THRESHOLD, train_rows: int = TRAIN_ROWS
) -> DataFrame:
    """The documents that stay, with all their columns.

    Rows are scored and filtered where they lie: the evidence is written with the whole row beside it, and
    only the posteriors of paths travel.
    """
    found = evidence(docs, train(docs, labels, train_rows), host, path, carry=True)
    return unpacked(judged(found).where(F.col("bad") < threshold))
