"""MinHash near-dedup: improved consistent weighted sampling over TF-IDF shingles.

Shingles are runs of five words (white space separates words, case counts); a shorter text is
one shingle. A shingle weighs ``tf * idf`` with ``idf = 1 + min(ln(N / df), ln 1000) / ln 1000``:
from 1 for one that every document has to 2 for all that fewer than one in a thousand have.
Two texts are near duplicates if their weighted Jaccard similarity is at least 0.8; classes
are what such links connect.

1. Document frequencies of all shingles of all documents are counted in a count-min sketch of
   fixed width. Its error is in proportion to the number of documents, and so is the range that
   the idf distinguishes; the same width serves any corpus, and its size is a constant.
2. Every text is sampled (improved consistent weighted sampling: two texts draw the same sample
   with their weighted Jaccard similarity as probability); four samples make a band key. At
   similarity 0.8 a pair shares one of the 14 bands with probability 0.9994, at 0.85 0.99997.
   Texts with the same weighted shingles become one vertex, by a 128-bit key.
3. In each bucket of equal band keys every vertex meets the bucket's least vertex: a group of any
   size gives one pair per member. Links join vertices to classes.
4. Buckets that still hold several classes are compared whole, every pair across classes. Members of a
   bucket are cut into blocks by the size of their texts, and blocks meet in pairs, so that no task holds
   more than two blocks of a bucket.

Similarities are computed where vertices meet: a vertex brings its weighted shingles, made once from
its whole text, and what leaves a meeting is at most one link per class that it joins to another. So no
row is made for a pair, and one rule holds for buckets of every size.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiercast.llm import words as W
from tiercast.llm.tables import packed, ship, stage_by, text_of, unpacked, wide_hash
from tiercast.plans.staging import stage

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 14, 4
SKETCH = 1 << 20
PART = 1 << 15  # counters that travel together
# A block of a bucket has about so many shingles, and members, at most.
BLOCK_SHINGLES = 1 << 16
BLOCK_MEMBERS = 256
CHUNK_SHINGLES = 1 << 18  # shingles of the meetings that one call compares, on average
SALTS = 64
FILTER_BITS = 1 << 26  # of the filter that tells which texts may be wanted again
_RARE = math.log(1000)


def counted(texts: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Distinct shingles of each text, in order of the texts: hash, text and count; and the number of texts."""
    raw, offsets = W.text_bytes(texts)
    n = len(offsets) - 1
    starts, ends, owner = W.word_ranges(raw, offsets)
    hashes, whose = W.shingle_hashes(W.range_hashes(raw, starts, ends), owner, SHINGLE, n)
    _, first, tf = np.unique(W.mix(hashes ^ W.mix(whose.astype(W.U64) + W.U64(1))), return_index=True, return_counts=True)
    order = np.lexsort((hashes[first], whose[first]))
    first, tf = first[order], tf[order]
    return hashes[first], whose[first], tf, n


def _cells(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a shingle is counted: a cell in each of the two rows."""
    return (hashes >> W.U64(44)).astype(np.int64), SKETCH + ((hashes >> W.U64(20)) & W.U64(SKETCH - 1)).astype(np.int64)


def frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """The sketch over all documents (two rows of fixed width), and how many have a shingle."""
    ship(docs.sparkSession)

    def count(batches):
        cells, texts = np.zeros(2 * SKETCH, np.int64), 0
        for table in W.blocks(batches):
            hashes, whose, _, _ = counted(table.column("text"))
            for cell in _cells(hashes):
                cells += np.bincount(cell, minlength=2 * SKETCH)
            texts += len(np.unique(whose))
        if texts:
            parts = range(2 * SKETCH // PART)
            data = [W.squeeze(cells[p * PART : (p + 1) * PART]) for p in parts]
            yield pa.RecordBatch.from_arrays([pa.array([*parts, -1], pa.int32()), pa.array([*data, W.squeeze(np.array([texts]))], pa.binary())], names=["part", "data"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, data in zip(*(batch.column(c).to_pylist() for c in ("part", "data"))):
                new = W.unsqueeze(data, np.int64)[0]
                sums[part] = sums[part] + new if part in sums else new
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([W.squeeze(v) for v in sums.values()], pa.binary())], names=["part", "data"])

    schema = "part int, data binary"
    counts = docs.select(F.col("text").cast("string")).mapInArrow(count, schema)
    # In two levels, so that a task adds up the sketches of a share of the input tasks only.
    some = counts.withColumn("salt", F.spark_partition_id() % SALTS).repartition("part", "salt").select("part", "data").mapInArrow(add, schema)
    got = some.repartition("part").mapInArrow(add, schema)
    cells, texts = np.zeros(2 * SKETCH, np.int64), 0
    for row in got.collect():  # a fixed number of counters
        values = W.unsqueeze(bytes(row.data), np.int64)[0]
        if row.part < 0:
            texts = int(values[0])
        else:
            cells[row.part * PART : (row.part + 1) * PART] = values
    return cells, texts


class Weights:
    """Weights of shingles from a sketch."""

    def __init__(self, cells: np.ndarray, texts: int):
        self.texts = max(texts, 1)
        rows = []
        for row in (cells[:SKETCH], cells[SKETCH:]):
            rows.append(np.maximum(row - (row.sum() - row) / (SKETCH - 1), 1))  # less what others are expected to leave in a cell
        self.cells = np.concatenate(rows).astype(np.float32)

    def __call__(self, hashes: np.ndarray, tf: np.ndarray) -> np.ndarray:
        a, b = _cells(hashes)
        df = np.minimum(self.cells[a], self.cells[b])
        idf = np.clip(np.log(self.texts / df), 0, _RARE)
        return (tf * (1 + idf / _RARE)).astype(np.float32)


def _gamma_quantiles(n: int) -> np.ndarray:
    """Quantiles of Gamma(2, 1), by bisection."""
    want = (np.arange(n) + 0.5) / n
    low, high = np.zeros(n), np.full(n, 64.0)
    for _ in range(60):
        middle = (low + high) / 2
        below = 1 - np.exp(-middle) * (1 + middle) < want
        low, high = np.where(below, middle, low), np.where(below, high, middle)
    return high.astype(np.float32)


_R = _gamma_quantiles(4096)
_BETA = ((np.arange(4096) + 0.5) / 4096).astype(np.float32)
_SEEDS = W.mix(np.arange(1, BANDS * ROWS + 1, dtype=W.U64) * W.U64(0x9E3779B97F4A7C15)) | W.U64(1)


def samples(hashes: np.ndarray, weights: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Consistent weighted samples of each text (texts x samples); every text must have a shingle.

    For shingle and sample the hash fixes r and c from Gamma(2, 1) and beta from [0, 1); the
    sample is the shingle of least ``ln c - r * (t - beta + 1)``, ``t = floor(ln w / r + beta)``,
    together with its ``t``.
    """
    n = len(bounds) - 1
    out = np.empty((n, len(_SEEDS)), W.U64)
    log_w = np.log(weights)
    low = W.U64(0xFFFFF)
    first = 0
    while first < n:
        # Whole texts of about 2 ** 14 shingles at a time, so that all arrays stay in the cache.
        last = max(int(np.searchsorted(bounds, bounds[first] + (1 << 14), side="right")) - 1, first + 1)
        a, b = bounds[first], bounds[last]
        h, lw, starts = hashes[a:b], log_w[a:b], bounds[first:last] - bounds[first]
        sizes = np.diff(bounds[first : last + 1])
        for k, seed in enumerate(_SEEDS):
            g = h * seed
            g ^= g >> W.U64(32)
            g *= W.U64(0xD6E8FEB86659FD93)
            g ^= g >> W.U64(29)
            r = _R[g >> W.U64(52)]
            beta = _BETA[(g >> W.U64(40)) & W.U64(4095)]
            u = ((g & low) + W.U64(1)).astype(np.float32) * (((g >> W.U64(20)) & low) + W.U64(1)).astype(np.float32)
            c = np.log(np.maximum(-np.log(u * np.float32(2.0**-40)), np.float32(1e-7)))
            t = np.floor(lw / r + beta)
            value = c - r * (t - beta + np.float32(1))
            least = np.minimum.reduceat(value, starts)
            hit = np.flatnonzero(value == np.repeat(least, sizes))
            owner = np.searchsorted(starts, hit, side="right") - 1
            one = np.ones(len(hit), bool)
            one[1:] = owner[1:] != owner[:-1]
            hit = hit[one]
            out[first:last, k] = W.mix(h[hit] ^ W.mix(t[hit].astype(np.int64).view(W.U64) + seed))
        first = last
    return out


def keys_of(hashes: np.ndarray, tf: np.ndarray, bounds: np.ndarray) -> list[bytes | None]:
    """128 bits of each text's counted shingles, null for a text without any."""
    some = np.flatnonzero(np.diff(bounds))
    out: list[bytes | None] = [None] * (len(bounds) - 1)
    if len(some):
        one = W.mix(hashes + W.mix(tf.astype(W.U64)))
        halves = [np.add.reduceat(x, bounds[:-1][some]) for x in (one, W.mix(one ^ W.U64(0x5EED)))]
        for k, a, b in zip(some.tolist(), halves[0], halves[1]):
            out[k] = a.tobytes() + b.tobytes()
    return out


def signatures(docs: DataFrame, weights: Weights) -> DataFrame:
    """Staged: ``doc_id, at, key, bands, size``; key and bands are null for a text without words.

    ``at`` is a 128-bit hash of the text, ``size`` the number of its different shingles.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # a fixed number of counters

    def in_task(batches):
        weigh = shared.value
        for table in W.blocks(batches):
            hashes, whose, tf, n = counted(table.column("text"))
            bounds = W.segments(whose, n)
            some = np.flatnonzero(np.diff(bounds))
            bands: list[np.ndarray | None] = [None] * n
            if len(some):
                drawn = samples(hashes, weigh(hashes, tf), np.append(bounds[:-1][some], bounds[-1]))
                key = np.zeros((len(some), BANDS), W.U64)
                for row in range(ROWS):
                    key = W.mix(key * W.U64(0xC2B2AE3D27D4EB4F) + drawn[:, row::ROWS])
                key = W.mix(key + np.arange(BANDS, dtype=W.U64))
                for k, values in zip(some.tolist(), key.view(np.int64)):
                    bands[k] = values
            yield pa.RecordBatch.from_arrays(
                [
                    table.column("doc_id").combine_chunks(),
                    table.column("at").combine_chunks(),
                    pa.array(keys_of(hashes, tf, bounds), pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(np.diff(bounds).astype(np.int64)),
                ],
                names=["doc_id", "at", "key", "bands", "size"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), text_hash().alias("at"), F.col("text").cast("string"))
    return stage(rows.mapInArrow(in_task, "doc_id long, at struct<a:long,b:long>, key binary, bands array<long>, size long"), "signatures")


def text_hash():
    return wide_hash(text_of())


def vertices_of(rows: DataFrame) -> DataFrame:
    """Staged: ``v, key, rep, at, bands, size, n`` of texts with the same weighted shingles, of signatures.

    ``rep`` and ``at`` lead to the text that speaks for the vertex: that of the least id, whatever ids are
    null or repeated.
    """
    order = F.struct(F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("id"), F.col("at"))
    alike = rows.where("key is not null").groupBy("key").agg(F.min(order).alias("best"), F.first("bands").alias("bands"), F.first("size").alias("size"), F.count(F.lit(1)).alias("n"))
    return stage(alike.select(F.monotonically_increasing_id().alias("v"), "key", F.col("best.id").alias("rep"), "best.at", "bands", "size", "n"), "vertices")


def filter_of(wanted: DataFrame) -> np.ndarray:
    """A Bloom filter of fixed size over the text hashes ``at``: two bits each."""
    words = FILTER_BITS // 64

    def mark(batches):
        bits = np.zeros(words, W.U64)
        for batch in batches:
            for half in ("a", "b"):
                _set(bits, batch.column(half).to_numpy().view(W.U64))
        if bits.any():
            parts = range(0, words, PART)
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array([W.squeeze(bits[p : p + PART]) for p in parts], pa.binary())], names=["part", "data"])

    def merge(batches):
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, data in zip(*(batch.column(c).to_pylist() for c in ("part", "data"))):
                new = W.unsqueeze(data, W.U64)[0]
                found[part] = found[part] | new if part in found else new
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([W.squeeze(v) for v in found.values()], pa.binary())], names=["part", "data"])

    schema = "part int, data binary"
    marked = wanted.select("at.a", "at.b").mapInArrow(mark, schema)
    some = marked.withColumn("salt", F.spark_partition_id() % SALTS).repartition("part", "salt").select("part", "data").mapInArrow(merge, schema)
    bits = np.zeros(words, W.U64)
    for row in some.repartition("part").mapInArrow(merge, schema).collect():  # a fixed number of bits
        bits[row.part : row.part + PART] = W.unsqueeze(bytes(row.data), W.U64)[0]
    return bits


def _places(half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = W.mix(half) & W.U64(FILTER_BITS - 1)
    return (place >> W.U64(6)).astype(np.int64), W.U64(1) << (place & W.U64(63))


def _set(bits: np.ndarray, half: np.ndarray) -> None:
    word, bit = _places(half)
    np.bitwise_or.at(bits, word, bit)


def _has(bits: np.ndarray, half: np.ndarray) -> np.ndarray:
    word, bit = _places(half)
    return (bits[word] & bit) != 0


def shingled(docs: DataFrame, vertices: DataFrame, weights) -> DataFrame:
    """Staged by ``v``: ``v, hashes, weights`` with the weighted shingles of each vertex's whole text.

    Texts are scanned where they lie. A filter of fixed size passes those that may be wanted; only their
    shingles travel to be told apart by id and text hash. (For very many vertices it fills up and passes
    more: that costs time, and changes no result.)
    """
    wanted = stage(vertices.select("v", "rep", "at"), "wanted")
    bits = docs.sparkSession.sparkContext.broadcast(filter_of(wanted))  # FILTER_BITS
    texts = docs.select(F.col("doc_id").cast("long").alias("d"), text_hash().alias("h"), text_of().alias("text"))

    def in_task(batches):
        weigh, held = weights.value, bits.value

        def passed():
            for batch in batches:
                h = batch.column("h")
                yield batch.filter(pa.array(_has(held, h.field("a").to_numpy().view(W.U64)) & _has(held, h.field("b").to_numpy().view(W.U64))))

        for table in W.blocks(passed()):
            hashes, whose, tf, n = counted(table.column("text"))
            weighed, bounds = weigh(hashes, tf), W.segments(whose, n)
            cut = lambda values: pa.array([values[a:b].tobytes() for a, b in zip(bounds, bounds[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([*(table.column(c).combine_chunks() for c in ("d", "h")), cut(hashes), cut(weighed)], names=["d", "h", "hashes", "weights"])

    made = texts.mapInArrow(in_task, "d long, h struct<a:long,b:long>, hashes binary, weights binary")
    named = made.join(wanted, F.col("rep").eqNullSafe(F.col("d")) & (F.col("at") == F.col("h"))).select("v", "hashes", "weights")
    # Rows that repeat an id and a text give a vertex several times.
    return stage_by(named.dropDuplicates(["v"]), "v", "shingled")


class Members:
    """The vertices of one meeting, with their shingles side by side."""

    def __init__(self, v: np.ndarray, label: np.ndarray, hashes: list[np.ndarray], weights: list[np.ndarray]):
        self.v, self.label, self.hashes, self.weights = v, label, hashes, weights
        self.total = np.array([w.sum(dtype=np.float64) for w in weights])

    def links(self, left: np.ndarray, right: np.ndarray, similarity: float) -> list[tuple[int, int]]:
        """Links of ``left`` with ``right`` (row numbers) that each join two classes; labels follow."""
        found, label = [], self.label
        shingles, at = np.unique(np.concatenate([self.hashes[j] for j in right]), return_inverse=True)
        held = np.zeros((len(shingles), len(right)), np.float32)
        held[at, np.repeat(np.arange(len(right)), [len(self.hashes[j]) for j in right])] = np.concatenate([self.weights[j] for j in right])
        total = self.total[right]
        for i in left:
            # Different class, and light and heavy enough to reach the similarity at all.
            other = np.flatnonzero((label[right] != label[i]) & (np.minimum(total, self.total[i]) >= similarity * np.maximum(total, self.total[i])))
            if not len(other):
                continue
            place = np.searchsorted(shingles, self.hashes[i])
            known = place < len(shingles)
            known[known] = shingles[place[known]] == self.hashes[i][known]
            rows = held[place[known]] if len(other) == len(right) else held[np.ix_(place[known], other)]
            # Weights are 32-bit numbers, so sums of them in 64 bits are exact.
            both = np.minimum(rows, self.weights[i][known][:, None]).sum(axis=0, dtype=np.float64)
            for j in other[both >= similarity * (total[other] + self.total[i] - both)]:
                j = right[j]
                if label[j] != label[i]:
                    found.append((i, j))
                    label[label == label[j]] = label[i]
        return found


def met(sent: DataFrame, shingles: DataFrame, similarity: float) -> DataFrame:
    """``a, b`` with the labels of vertices that meetings link, of ``bucket, one, two, side, v, label, size``.

    Rows of equal ``bucket, one, two`` meet: side 0 with side 1, or all of side -1 with each other. At most
    one link per class leaves a meeting.
    """
    total = sent.agg(F.sum("size")).first()[0] or 0
    chunk = F.pmod(F.xxhash64("bucket", "one", "two"), F.lit(max(1, -(-total // CHUNK_SHINGLES)))).alias("chunk")

    def in_task(key, table):
        columns = {c: table.column(c).to_numpy() for c in ("bucket", "one", "two", "side", "v", "label")}
        order = np.lexsort([columns[c] for c in ("v", "side", "two", "one", "bucket")])
        columns = {c: x[order] for c, x in columns.items()}
        hashes, weights = (table.column(c).to_pylist() for c in ("hashes", "weights"))
        change = np.zeros(len(order), bool)
        for c in ("bucket", "one", "two"):
            change[1:] |= columns[c][1:] != columns[c][:-1]
        edges = [0, *np.flatnonzero(change).tolist(), len(order)] if len(order) else []
        out = []
        for first, last in zip(edges, edges[1:]):
            rows = np.arange(first, last)
            side, label = columns["side"][rows], columns["label"][rows]
            if len(rows) < 2 or (label == label[0]).all():
                continue
            mine = Members(columns["v"][rows], label.copy(), [np.frombuffer(hashes[order[r]], W.U64) for r in rows], [np.frombuffer(weights[order[r]], np.float32) for r in rows])
            every = np.arange(len(rows))
            own = side[0] < 0
            left, right = (every, every) if own else (every[side == 0], every[side == 1])
            if len(left) and len(right):
                out += [(label[i], label[j]) for i, j in mine.links(left, right, similarity)]
        a, b = np.array(out, np.int64).reshape(-1, 2).T
        return pa.table({"a": pa.array(a), "b": pa.array(b)})

    joined = sent.join(shingles, "v").select(chunk, "bucket", "one", "two", "side", "v", "label", "hashes", "weights")
    return stage(joined.groupBy("chunk").applyInArrow(in_task, "a long, b long").distinct(), "links")


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``v, label`` for every vertex with a link: the least vertex it is connected with.

    Each round takes the least label of all neighbours and then follows labels once, so chains
    shrink by half; rounds are staged.
    """
    both = stage(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "both-ways")
    labels = stage(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("v").alias("b"), "label"), "b").groupBy(F.col("a").alias("v")).agg(F.min("label").alias("near"))
        step = labels.join(near, "v").select("v", F.col("label").alias("old"), F.least("label", "near").alias("next"))
        follow = labels.select(F.col("v").alias("next"), F.col("label").alias("further"))
        new = stage(step.join(follow, "next", "left").select("v", "old", F.least("next", F.coalesce("further", "next")).alias("label")), "labels")
        if new.where("old <> label").isEmpty():
            return new.select("v", "label")
        labels = new.select("v", "label")


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Staged: ``v, label`` after links ``a, b`` between labels."""
    roots = components(labels.sparkSession, links).select(F.col("v").alias("label"), F.col("label").alias("root"))
    return stage(labels.join(roots, "label", "left").select("v", F.coalesce("root", "label").alias("label")), "all-labels")


def links(docs: DataFrame, vertices: DataFrame, weights, similarity: float, block_shingles: int = BLOCK_SHINGLES, block_members: int = BLOCK_MEMBERS) -> DataFrame:
    """Classes of vertices, ``v, label``, by all links within buckets."""
    bucket = vertices.select("v", "size", F.explode("bands").alias("bucket"))
    labels = vertices.select("v", F.col("v").alias("label"))
    block = lambda n: F.pmod(F.xxhash64("v"), n)

    # Every vertex of a bucket with the least one: that one comes to all blocks of the vertices it is least for.
    busy = bucket.groupBy("bucket").agg(F.min("v").alias("hub"), F.max("v").alias("last")).where("hub < last").select("bucket", "hub")
    held = stage(bucket.join(stage(busy, "busy"), "bucket").where("v <> hub"), "members")
    if held.isEmpty():
        return labels
    pairs = held.select("hub", "v", "size").distinct()
    pairs = stage(pairs, "pairs")
    shingles = shingled(docs, vertices.join(pairs.select("v").union(pairs.select("hub")).distinct(), "v", "left_semi"), weights)
    groups = pairs.groupBy("hub").agg(F.greatest(F.ceil(F.sum("size") / block_shingles), F.ceil(F.count(F.lit(1)) / block_members)).alias("blocks"))
    members = pairs.join(groups, "hub").select("hub", block(F.col("blocks")).alias("one"), "v", "size")
    meeting = lambda df, side: df.select(F.col("hub").alias("bucket"), "one", F.lit(-1).cast("long").alias("two"), F.lit(side).alias("side"), "v", F.col("v").alias("label"), "size")
    hubs = members.select("hub", "one").distinct().join(vertices.select(F.col("v").alias("hub"), "size"), "hub").withColumn("v", F.col("hub"))
    sent = meeting(members, 1).unionByName(meeting(hubs, 0))
    labels = joined(labels, met(stage(sent, "meetings"), shingles, similarity))

    # Buckets that still hold several classes, whole. All pairs with the least vertex are known by now, so it
    # stays away, and buckets of the same members are one.
    labelled = held.join(labels, "v")
    whose = F.xxhash64("v")
    several = labelled.groupBy("bucket").agg(
        F.min("label").alias("x"), F.max("label").alias("y"), F.sum("size").alias("sizes"), F.count(F.lit(1)).alias("members"),
        F.bit_xor(whose).alias("a"), F.sum(whose.cast("decimal(38,0)")).alias("b"),
    ).where("x < y")
    each_set = several.groupBy("members", "a", "b").agg(F.min("bucket").alias("bucket"), F.first("sizes").alias("sizes"))
    mixed = stage(each_set.select("bucket", F.greatest(F.ceil(F.col("sizes") / block_shingles), F.ceil(F.col("members") / block_members)).alias("blocks")), "mixed")
    if mixed.isEmpty():
        return labels
    placed = labelled.join(mixed, "bucket").select("bucket", "blocks", block(F.col("blocks")).alias("block"), "v", "label", "size")
    each = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    one, two = F.least("block", "other"), F.greatest("block", "other")
    side = F.when(one == two, -1).otherwise((F.col("block") == two).cast("int"))
    sent = each.select("bucket", one.alias("one"), two.alias("two"), side.alias("side"), "v", "label", "size")
    return joined(labels, met(stage(sent, "meetings"), shingles, similarity))


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """A row per document: ``doc_id, class_id, class_size, kept``.

    ``class_id`` is the least document id of the class, and that document stays. A null or empty
    text, or one of white space only, has no shingles and is a class of its own; null ids come
    last and are kept as null. Rows that repeat an id and a text are marked alike; other columns are ignored; an
    empty table gives an empty result.
    """
    weigh = Weights(*frequencies(docs))
    rows = signatures(docs, weigh)
    vertices = vertices_of(rows)
    labels = links(docs, vertices, docs.sparkSession.sparkContext.broadcast(weigh), similarity)
    named = vertices.select("v", "key", "rep", "n").join(labels, "v")
    order = F.struct(F.col("rep").isNull().alias("z"), F.col("rep").alias("id"))
    tops = named.groupBy("label").agg(F.min(order).alias("top"), F.sum("n").alias("class_size"))
    of_key = named.join(tops, "label").select("key", F.col("top.id").alias("class_id"), "class_size")
    wordless = F.col("key").isNull()
    joined = rows.select("doc_id", "key").join(of_key, "key", "left")
    class_id = F.when(wordless, F.col("doc_id")).otherwise(F.col("class_id"))
    return joined.select(
        "doc_id",
        class_id.alias("class_id"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
        F.col("doc_id").eqNullSafe(class_id).alias("kept"),
    )


def keep(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each class, with all columns.

    Where rows repeat an id, a row stays if one of them does.
    """
    found = classes(docs, similarity)
    gone = found.groupBy("doc_id").agg(F.max(F.col("kept").cast("int")).alias("stays")).where("stays = 0").select(F.col("doc_id").alias("_gone"))
    gone = stage(gone, "gone")  # its size on disk lets Spark choose whether texts must move
    return unpacked(packed(docs).join(gone, F.col("_row.doc_id").eqNullSafe(F.col("_gone")), "left_anti"))
