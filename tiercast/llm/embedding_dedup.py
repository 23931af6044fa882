"""Embedding near-dedup: random-hyperplane sign hashing, exact cosines, connected components.

1. Equal vectors become one vertex (grouped, combined before the exchange), so a vector of any
   number of copies is hashed and compared once.
2. Every vertex gets one hash a table: the signs of ``bits`` random hyperplanes. Two vectors at an
   angle agree in one sign with probability ``1 - angle / pi``, so ``tables_for`` gives the number
   of tables at which a pair right at the threshold shares one with the wanted probability. The
   bits grow with the logarithm of the number of vertices (``bits_for``), so a bucket that is
   shared by chance stays rare at any size.
3. Buckets with one member are dropped by key alone; vectors travel only into buckets with several.
   Those are cut into blocks of ``BLOCK`` members, and blocks of one bucket meet in pairs, so that
   no task holds more than a fixed number of vectors. Meetings are dealt over tasks by hash.
4. In a task, cosines are exact (double precision). A pair that meets in several tables counts in
   the first one only, which the hashes of both tell. What leaves a task is a count per vertex and a
   spanning forest of the links it found: never more rows than came in.
5. Components come from rounds of large-star and small-star steps over the forests' edges, each round
   written out.

Counting the links of a group of near copies takes time in proportion to its pairs; no row is
made for them.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiercast.llm.ann import usable
from tiercast.llm.tables import ship, wide_hash
from tiercast.plans.staging import stage

COSINE = 0.95
MISS = 0.001  # share of pairs right at the threshold that no table brings together
SPARE_BITS = 6  # hash bits beyond the logarithm of the number of vertices
BLOCK = 1024
CHUNK_ROWS = 4096  # members that a task compares at a time, on average
SEED = 23
_NEAR = 1e-9  # matrix products this near the threshold are computed again term by term
_PAIRS = 1 << 16


def bits_for(vertices: int) -> int:
    return min(63, max(8, math.ceil(math.log2(max(vertices, 1))) + SPARE_BITS))


def tables_for(bits: int, cosine: float, miss: float = MISS) -> int:
    agree = (1 - math.acos(cosine) / math.pi) ** bits
    return max(1, math.ceil(math.log(miss) / math.log1p(-agree)))


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors times a power of two that brings their largest component near one, exactly."""
    exponent = np.frexp(np.abs(vectors).max(axis=1))[1]
    return np.ldexp(vectors, -exponent[:, None])


def hashes(vectors: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Vectors x tables: the signs as one number each."""
    dim = vectors.shape[1]
    planes = np.random.default_rng([SEED, dim]).standard_normal((tables, dim, bits))
    weight = np.left_shift(np.int64(1), np.arange(bits, dtype=np.int64))
    return np.stack([((vectors @ p) > 0) @ weight for p in planes], axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)


def vertices(rows: DataFrame, cosine: float) -> tuple[DataFrame, DataFrame]:
    """Distinct vectors of ``vec_id, x``, both staged: ``v, key, id, n``, and ``v, n, dim, x, codes``."""
    ship(rows.sparkSession)
    order = F.struct(F.col("vec_id").isNull().alias("z"), F.col("vec_id").alias("id"))
    alike = rows.groupBy("x").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("n"))
    alike = stage(alike.select(F.monotonically_increasing_id().alias("v"), wide_hash(F.col("x")).alias("key"), "best.id", "n", F.size("x").alias("dim"), "x"), "vectors")
    bits = bits_for(alike.count())
    tables = tables_for(bits, cosine)

    def in_task(batches):
        for batch in batches:
            codes: list = [None] * batch.num_rows
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                mine = np.flatnonzero(dims == dim)
                found = hashes(scaled(_matrix(batch.column("x").take(pa.array(mine)))), bits, tables)
                for k, code in zip(mine.tolist(), found):
                    codes[k] = code
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.list_(pa.int64()))], names=[*batch.schema.names, "codes"])

    kind = alike.schema["x"].dataType.simpleString()
    coded = alike.select("v", "n", "dim", "x").mapInArrow(in_task, f"v bigint, n bigint, dim int, x {kind}, codes array<bigint>")
    return alike.select("v", "key", "id", "n"), stage(coded, "codes")


def meetings(coded: DataFrame, block: int = BLOCK) -> DataFrame:
    """Staged: who comes to which meeting, ``t, bucket, one, two, block, v``; vertices without a mate in any bucket do not occur."""
    each = coded.select("v", "dim", F.posexplode("codes").alias("t", "code"))
    keyed = each.select("v", "t", F.xxhash64("dim", "t", "code").alias("bucket"))
    busy = stage(keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "busy")
    blocks = F.ceil(F.col("n") / block)
    members = keyed.join(busy, "bucket").select("v", "t", "bucket", blocks.alias("blocks"), F.pmod(F.xxhash64("v"), blocks).alias("block"))
    sent = members.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    return stage(sent.select("t", "bucket", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block", "v"), "meetings")


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least index that each of ``n`` is connected with by the pairs."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def pairs_of(group: np.ndarray, side: np.ndarray, x: np.ndarray, cosine: float, small: int = 8):
    """Linked pairs of row numbers, of rows sorted by group; within a group all of one side, or one side against the other."""
    length = np.sqrt((x * x).sum(axis=1))
    exact = lambda a, b: (x[a] * x[b]).sum(axis=1) / (length[a] * length[b])
    edges = np.append(np.flatnonzero(np.r_[True, group[1:] != group[:-1]]), len(group))
    sizes = np.diff(edges)
    # Groups of a few rows all at once: every row with the one that comes ``step`` later.
    few = np.repeat(sizes <= small, sizes)
    for step in range(1, small):
        a = np.flatnonzero(few[:-step] & (group[:-step] == group[step:])) if step < len(group) else np.zeros(0, np.int64)
        b = a + step
        wanted = (side[a] < 0) | (side[a] != side[b])
        a, b = a[wanted], b[wanted]
        for i in range(0, len(a), _PAIRS):
            p, q = a[i : i + _PAIRS], b[i : i + _PAIRS]
            hit = exact(p, q) >= cosine
            yield p[hit], q[hit]
    for first, last in zip(edges[:-1][sizes > small], edges[1:][sizes > small]):
        rows = np.arange(first, last)
        own = side[first] < 0
        left, right = (rows, rows) if own else (rows[side[rows] == 0], rows[side[rows] == 1])
        for i in range(0, len(left), 256):
            some = left[i : i + 256]
            value = (x[some] @ x[right].T) / (length[some][:, None] * length[right])
            p, q = np.nonzero(value >= cosine - _NEAR)
            sure = value[p, q] >= cosine + _NEAR
            p, q = some[p], right[q]
            if own:
                later = q > p
                p, q, sure = p[later], q[later], sure[later]
            again = np.flatnonzero(~sure)
            if len(again):
                sure[again] = exact(p[again], q[again]) >= cosine
            yield p[sure], q[sure]


def compared(coded: DataFrame, met: DataFrame, cosine: float, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Staged: ``v, other, links``: counts of links (``other`` null), and links that span what was found (``links`` 0)."""
    chunks = max(1, -(-met.count() // chunk_rows))
    chunk = F.pmod(F.xxhash64("bucket", "one", "two"), F.lit(chunks))
    rows = met.join(coded, "v").select(chunk.alias("chunk"), "dim", "t", "bucket", "one", "two", "block", "v", "n", "x", "codes")

    def in_task(key, table):
        out_v, out_other, out_links = [], [], []
        dims = table.column("dim").to_numpy()
        for dim in np.unique(dims):
            part = table.filter(pa.array(dims == dim)).combine_chunks()
            names = ("t", "bucket", "one", "two", "block", "v", "n")
            t, bucket, one, two, block, v, n = (part.column(c).to_numpy() for c in names)
            order = np.lexsort((v, block, two, one, bucket, t))
            t, bucket, one, two, block, v, n = (c[order] for c in (t, bucket, one, two, block, v, n))
            x = scaled(_matrix(part.column("x").combine_chunks()))[order]
            codes = np.asarray(part.column("codes").combine_chunks().flatten(), np.int64).reshape(len(v), -1)[order]
            changes = np.zeros(len(v), bool)
            for c in (t, bucket, one, two):
                changes[1:] |= c[1:] != c[:-1]
            side = np.where(one == two, -1, (block == two).astype(np.int64))
            links = np.zeros(len(v), np.int64)
            ends: list[tuple[np.ndarray, np.ndarray]] = []
            for a, b in pairs_of(np.cumsum(changes), side, x, cosine):
                ends.append((a, b))
                for i in range(0, len(a), _PAIRS):
                    p, q = a[i : i + _PAIRS], b[i : i + _PAIRS]
                    met_before = (codes[p] == codes[q]) & (np.arange(codes.shape[1]) < t[p][:, None])
                    new = ~met_before.any(axis=1)
                    np.add.at(links, p[new], n[q[new]])
                    np.add.at(links, q[new], n[p[new]])
            some = np.flatnonzero(links)
            out_v.append(v[some])
            out_links.append(links[some])
            out_other.append(np.full(len(some), -1))
            if ends:
                # Rows of one vertex in several meetings are one vertex.
                ids, at = np.unique(v, return_inverse=True)
                a, b = (at[np.concatenate(e)] for e in zip(*ends))
                root = forest(a, b, len(ids))
                tied = np.flatnonzero(root != np.arange(len(ids)))
                out_v.append(ids[tied])
                out_other.append(ids[root[tied]])
                out_links.append(np.zeros(len(tied), np.int64))
        columns = [pa.array(np.concatenate(c).astype(np.int64)) for c in (out_v, out_other, out_links)]
        return pa.table(dict(zip(("v", "other", "links"), columns)))

    found = rows.groupBy("chunk").applyInArrow(in_task, "v bigint, other bigint, links bigint")
    return stage(found.select("v", F.when(F.col("other") >= 0, F.col("other")).alias("other"), "links"), "links")


def components(edges: DataFrame) -> DataFrame:
    """``v, root`` of every vertex with an edge ``a, b`` to another: the least vertex it is connected with.

    Large-star: every greater neighbour of a vertex is tied to the least of all its neighbours.
    Small-star: so are the lesser neighbours. Each halves what is between a vertex and its root;
    when nothing changes any more, all edges end at roots.
    """
    now = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = lambda df: df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    before = mark(now)
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.min("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = stage(large, "large-star")  # a > b holds in all rows
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        tied = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        now = stage(tied.union(least.select("a", F.col("m").alias("b"))).distinct(), "small-star")
        after = mark(now)
        if after == before:
            return now.select(F.col("a").alias("v"), F.col("b").alias("root")).union(now.select(F.col("b"), F.col("b")).distinct())
        before = after


def classes(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """A row per vector of ``vec_id, embedding``: ``vec_id, n_links, component_id, kept``.

    ``n_links`` counts the other rows whose vector has at least the given cosine, ``component_id`` is
    the least id that links lead to. Vectors that are null, zero, empty, or hold a null or a
    component that is no finite number link with nothing, nor do vectors of different lengths. Rows
    that repeat a vector are linked, also if they repeat an id; a null id comes last, and a
    component of null ids only has a null id. ``kept`` rows have the id of their component. Other
    columns are ignored; an empty table gives an empty result.
    """
    plain = F.transform(F.col("embedding"), lambda c: c + F.lit(0).cast("float"))  # no negative zeros; a float stays one
    rows = vectors.select("vec_id", F.when(usable(F.col("embedding")), plain).alias("x"))
    alike, coded = vertices(rows.where("x is not null"), cosine)
    found = compared(coded, meetings(coded, block), cosine)
    links = found.where("other is null").groupBy("v").agg(F.sum("links").alias("links"))
    roots = components(found.where("other is not null").select(F.col("v").alias("a"), F.col("other").alias("b")))
    named = stage(alike.select("v", "key", "id", "n").join(links, "v", "left").join(roots, "v", "left").withColumn("root", F.coalesce("root", "v")), "named")
    order = F.struct(F.col("id").isNull().alias("z"), F.col("id").alias("id"))
    tops = named.groupBy("root").agg(F.min(order).alias("top"))
    told = stage(named.join(tops, "root").select("key", F.col("top.id").alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")), "told")
    keyed = rows.select("vec_id", F.when(F.col("x").isNotNull(), wide_hash(F.col("x"))).alias("key"))
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return keyed.join(told, "key", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept")
    )
