"""Approximate nearest neighbours by inner product: a hash-prefix forest.

Every tree has its own long hash string for a vector. A symbol of it tells which of the signed axes
of a random rotation into ``AXES`` dimensions is nearest (a cross-polytope hash: it parts the near from
the far better than signs of single hyperplanes). A tree is the array of strings, sorted and cut into
nodes: a leaf is a prefix that at most ``leaf_limit`` vectors share, so prefixes are longer where
vectors lie dense. (Vectors are lengthened to one common norm for hashing, so that nearness by angle is
nearness by inner product whatever the norms.)

1. Equal vectors are one vertex, hashed and scored once, however many rows repeat it.
2. A query descends in all trees to its longest prefix matches, then ascends in all of them together:
   of all nodes of all trees it opens the one whose symbols are least worse than its own, until it
   holds ``wanted(n)`` candidates. Node sizes come from a table that is counted once. A query that
   finds hardly any ascends to shorter prefixes, up to the root. Where vectors lie so dense that
   leaves have longer prefixes, the ascent opens prefixes of those lengths too, in one order of costs.
3. Nodes that some query opened are cut into blocks of at most ``BLOCK`` members and ``BLOCK`` queries on
   average, which meet in pairs, and every tree's meetings are dealt over tasks by hash. A task scores
   a meeting by one matrix product and leaves the best few of each query, scored again term by term.

Nothing goes to every shard: rows moved are vectors x trees and queries x opened nodes. How many
candidates the wanted recall takes depends on how far neighbours stand out: for vectors spread evenly
over a sphere, the worst case, ``wanted`` is what the tests' recall of 0.9 needs.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiercast.llm.tables import ship, wide_hash
from tiercast.plans.staging import stage

TREES = 16
AXES = 16
LETTER = 5  # bits of a symbol: one of 2 x AXES signed axes
SYMBOLS = 8
OPENED = 650  # nodes that a query opens on average, at most, where prefixes are longer than two symbols
LEAF = 4096  # a node with more, and with four times the average, is parted by the next symbol, if there is one
BLOCK = 4096
CHUNK_ROWS = 65536  # members of one tree that a task holds at a time, on average
K = 20
SEED = 11
_STEP = 256  # rows hashed at a time


def wanted(n: int) -> int:
    """Candidates that the ascent gathers among ``n`` vectors; those found in several trees count in each.

    The second term leads from about 52,000 vectors on, where nodes of two symbols hold more and more.
    """
    return math.ceil(max(2.8 * n**0.8, 1.81 * n**0.84))


def depth(n: int) -> int:
    """Symbols in the prefixes that an ascent starts from; none where all vectors are wanted.

    A query opens ``wanted`` candidates' worth of nodes, so nodes must grow with the table: with one
    more symbol it would open 32 times as many, nearly all of them with hardly a member.
    """
    if wanted(n) >= n:
        return 0
    return min(SYMBOLS, max(2, math.floor(math.log(OPENED * n / wanted(n), 2 * AXES))))


def leaf_limit(n: int) -> int:
    """Members of a leaf at most, if there is a further symbol."""
    return max(LEAF, 4 * n // (2 * AXES) ** depth(n))


def planes(dim: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim + 1, TREES * SYMBOLS * AXES)).astype(np.float32)


def nearness(points: np.ndarray) -> np.ndarray:
    """Points x trees x symbols x letters: how near each signed axis is."""
    along = (points @ planes(points.shape[1] - 1)).reshape(len(points), TREES, SYMBOLS, AXES)
    return np.concatenate([along, -along], axis=3)


def strings(near: np.ndarray) -> np.ndarray:
    """Points x trees: the hash strings as numbers, first symbol highest."""
    weight = np.left_shift(np.int64(1), LETTER * np.arange(SYMBOLS - 1, -1, -1, dtype=np.int64))
    return near.argmax(axis=3) @ weight


def lengthened(vectors: np.ndarray, norm: float) -> np.ndarray:
    """One more component, so that all vectors have norm one and keep their angles' order."""
    x = vectors / norm
    rest = np.sqrt(np.maximum(1 - (x * x).sum(axis=1), 0))
    return np.column_stack([x, rest]).astype(np.float32)


def ascent(near: np.ndarray, length: int, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each point the ``count`` nearest prefixes of all trees: trees, strings and costs, nearest first.

    A prefix costs the squares of what its letters lack to the best ones. Costs only add, so the best
    ``count`` prefixes of every length hold the beginnings of the best of the next.
    """
    n = len(near)
    best = near.max(axis=3, keepdims=True)
    own = np.broadcast_to(strings(near)[:, :, None], (n, TREES, 1))
    lacks = (best - near) ** 2
    tree = np.broadcast_to(np.arange(TREES), (n, TREES))
    code = own[:, :, 0]
    cost = np.zeros((n, TREES))
    rows = np.arange(n)[:, None]
    for s in range(length):
        shift = LETTER * (SYMBOLS - 1 - s)
        more = (cost[:, :, None] + lacks[rows, tree, s]).reshape(n, -1)
        letters = np.arange(2 * AXES, dtype=np.int64)
        codes = ((code & ~(np.int64(2 * AXES - 1) << shift))[:, :, None] | (letters << shift)).reshape(n, -1)
        trees = np.repeat(tree, 2 * AXES, axis=1)
        some = np.argpartition(more, count - 1, axis=1)[:, :count] if count < more.shape[1] else np.broadcast_to(np.arange(more.shape[1]), more.shape)
        cost, code, tree = more[rows, some], codes[rows, some], trees[rows, some]
    order = np.argsort(cost, axis=1, kind="stable")
    return tree[rows, order], code[rows, order], cost[rows, order]


def usable(vector: Column) -> Column:
    """Not null, not zero, and all components finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(flat), -1)


def _node(length: int) -> Column:
    return F.xxhash64("dim", "t", F.lit(length), F.shiftright("code", LETTER * (SYMBOLS - length)))


def _in_trees(rows: DataFrame, first: int, last: int) -> DataFrame:
    """Rows of ``dim, t, code`` with the ``node`` of each length; the root is that of one tree only."""
    if last == 0:
        return rows.where("t = 0").withColumn("node", _node(0))
    return rows.withColumn("node", F.explode(F.array(*[_node(s) for s in range(first, last + 1)])))


def vertices(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of usable ``vec_id, embedding``: staged ``key, vec_id`` with ``copies``, and staged vectors ``v, key, least, dim, x``."""
    plain = F.transform(F.col("embedding"), lambda c: c + F.lit(0).cast("float"))  # no negative zeros; a float stays one
    good = rows.select(F.col("vec_id").cast("long"), plain.alias("x")).where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    names = stage(good.groupBy(wide_hash(F.col("x")).alias("key"), "vec_id").agg(F.count(F.lit(1)).alias("copies")), "names")
    alike = good.groupBy("x").agg(F.min("vec_id").alias("least"))
    return names, stage(alike.select(F.monotonically_increasing_id().alias("v"), wide_hash(F.col("x")).alias("key"), "least", F.size("x").alias("dim"), "x"), "vectors")


@dataclass
class Forest:
    """Staged tables of the index: ``names`` and ``vectors`` (see ``vertices``), ``strings`` ``v, dim, codes``, ``leaves`` ``node, n``."""

    names: DataFrame
    vectors: DataFrame
    strings: DataFrame
    leaves: DataFrame
    size: int
    first: int  # the shortest prefix of a leaf
    last: int  # and the longest

    def entries(self) -> DataFrame:
        return self.strings.select("v", "dim", F.posexplode("codes").alias("t", "code"))

    def members(self, length: int) -> DataFrame:
        """``node, v, n`` of all leaves, or of all nodes of a shorter prefix."""
        if length == self.first:
            return _in_trees(self.entries(), self.first, self.last).join(self.leaves, "node").select("node", "t", "v")
        return _in_trees(self.entries(), length, length).select("node", "t", "v")

    def sizes(self, length: int) -> DataFrame:
        return self.leaves if length == self.first else stage(self.members(length).groupBy("node").agg(F.count(F.lit(1)).alias("n")), "nodes")


def index(vectors: DataFrame, leaf: int | None = None) -> Forest:
    """The forest of all usable rows of ``vec_id, embedding``; ``leaf`` is by default ``leaf_limit`` of their number."""
    ship(vectors.sparkSession)
    names, alike = vertices(vectors)
    size = F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double")))
    norms = stage(alike.groupBy("dim").agg(F.max(size).alias("norm")), "norms")

    def in_task(batches):
        for batch in batches:
            dims, norm = batch.column("dim").to_numpy(), batch.column("norm").to_numpy()
            codes = np.empty((batch.num_rows, TREES), np.int64)
            for dim in np.unique(dims):
                mine = np.flatnonzero(dims == dim)
                for at in range(0, len(mine), _STEP):
                    some = mine[at : at + _STEP]
                    x = _matrix(batch.column("x").take(pa.array(some)))
                    codes[some] = strings(nearness(lengthened(x, norm[some[0]])))
            data = pa.ListArray.from_arrays(pa.array(np.arange(0, codes.size + 1, TREES), pa.int32()), pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("v"), batch.column("dim"), data], names=["v", "dim", "codes"])

    coded = stage(alike.join(norms, "dim").select("v", "dim", "norm", "x").mapInArrow(in_task, "v bigint, dim int, codes array<bigint>"), "strings")
    count = coded.count()
    leaf = leaf or leaf_limit(count)
    first = last = depth(count)
    active = coded.select("dim", F.posexplode("codes").alias("t", "code"))
    parts = []
    while True:
        sizes = stage(_in_trees(active, last, last).groupBy("node").agg(F.count(F.lit(1)).alias("n")), "sizes")
        if last == SYMBOLS or last == 0:
            parts.append(sizes)
            break
        parts.append(sizes.where(F.col("n") <= leaf))
        dense = sizes.where(F.col("n") > leaf)
        if dense.isEmpty():
            break
        active = _in_trees(active, last, last).join(dense, "node", "left_semi").drop("node")
        last += 1
    leaves = reduce(DataFrame.unionByName, parts)
    return Forest(names, alike, coded, leaves, count, first, last)


def _opened(forest: Forest, asked: DataFrame, k: int, want: int) -> list[tuple[int, DataFrame]]:
    """For prefixes of each length in use the nodes that queries ``v, dim, x`` open: staged ``q, node, t, n``."""
    out = []
    length, waiting = forest.first, asked
    while True:
        nodes = TREES * (2 * AXES) ** length
        count = min(nodes, math.ceil(1.3 * want * (2 * AXES) ** length / max(forest.size, 1)) + TREES)

        last = forest.last if length == forest.first else length

        def in_task(batches, lengths=range(length, last + 1), count=count):
            for batch in batches:
                dims = batch.column("dim").to_numpy()
                for dim in np.unique(dims):
                    mine = np.flatnonzero(dims == dim)
                    for at in range(0, len(mine), _STEP // 8):
                        some = pa.array(mine[at : at + _STEP // 8])
                        q, x = batch.column("v").take(some).to_numpy(), _matrix(batch.column("x").take(some))
                        x = x / np.abs(x).max(axis=1)[:, None]
                        near = nearness(np.column_stack([x / np.sqrt((x * x).sum(axis=1))[:, None], np.zeros(len(x))]).astype(np.float32))
                        for m in lengths:
                            tree, code, cost = ascent(near, m, count)
                            each, size = tree.shape[1], tree.size
                            columns = (np.repeat(q, each), np.full(size, dim, np.int32), tree.ravel().astype(np.int32), np.full(size, m, np.int32), code.ravel(), cost.ravel())
                            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["q", "dim", "t", "length", "code", "cost"])

        found = waiting.select("v", "dim", "x").mapInArrow(in_task, "q bigint, dim int, t int, length int, code bigint, cost double")
        tree, code = (F.lit(0), F.lit(0).cast("long")) if last == 0 else (F.col("t"), F.expr(f"shiftright(code, {LETTER} * ({SYMBOLS} - length))"))
        sized = found.select("q", F.xxhash64("dim", tree.cast("int"), "length", code).alias("node"), tree.cast("int").alias("t"), "cost").join(forest.sizes(length), "node")
        sized = sized.where("cost = 0").dropDuplicates(["q", "node"]) if last == 0 else sized
        before = F.sum("n").over(Window.partitionBy("q").orderBy("cost", "node").rowsBetween(Window.unboundedPreceding, -1))
        held = stage(sized.withColumn("before", before).where(F.coalesce("before", F.lit(0)) < want).select("q", "node", "t", "n"), "opened")
        out.append((length, held))
        enough = held.groupBy(F.col("q").alias("v")).agg(F.sum("n").alias("n")).where(F.col("n") >= min(want // 2, 4 * TREES * k))
        if length == 0:
            return out
        waiting = stage(waiting.join(enough, "v", "left_anti"), "waiting")
        if waiting.isEmpty():
            return out
        length -= 1


def _met(forest: Forest, asked: DataFrame, opened: list[tuple[int, DataFrame]], k: int, block: int, chunk_rows: int) -> DataFrame:
    """Queries' best ``k`` vertices of each task, with scores: ``q, v, score``."""
    probes = reduce(DataFrame.unionByName, [held for _, held in opened])
    open_nodes = stage(probes.groupBy("node").agg(F.count(F.lit(1)).alias("nq"), F.max("n").alias("n")), "open")
    blocks = lambda c: F.ceil(F.col(c) / block).cast("int")
    spread = open_nodes.select("node", blocks("n").alias("mine"), blocks("nq").alias("theirs"))
    rows = open_nodes.agg(F.sum(F.col("n") * blocks("nq"))).first()[0] or 0
    chunks = max(1, -(-rows // (TREES * chunk_rows)))  # of each tree
    chunk = (F.col("t") * chunks + F.pmod(F.xxhash64("node", "mb", "qb"), F.lit(chunks))).alias("chunk")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    cut = lambda c, of: F.pmod(F.xxhash64(c), F.col(of)).cast("int")
    members = reduce(DataFrame.unionByName, [forest.members(length) for length, _ in opened]).join(spread, "node")
    members = members.select("node", "t", "v", cut("v", "mine").alias("mb"), every("theirs").alias("qb")).select(chunk, "node", "mb", "qb", "v")
    sent = probes.join(spread, "node").select("node", "t", "q", cut("q", "theirs").alias("qb"), every("mine").alias("mb"))
    sent = stage(sent.select(chunk, "node", "mb", "qb", "q"), "probes")
    none = F.lit(None)
    vectors = members.join(forest.vectors.select("v", "least", "dim", "x"), "v").select("chunk", "node", "mb", "qb", "v", "least", "dim", "x")
    heads = sent.select("chunk", F.col("q").alias("v")).distinct().join(asked.select("v", "dim", "x"), "v")
    heads = heads.select("chunk", none.cast("long").alias("node"), none.cast("int").alias("mb"), none.cast("int").alias("qb"), "v", none.cast("long").alias("least"), "dim", "x")

    def in_task(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        head = left.column("node").is_null()
        both, asking = left.filter(pc.invert(head)), left.filter(head)
        names = [c.to_numpy() for c in (right.column("node"), right.column("mb"), right.column("qb"), right.column("q"))]
        for dim in pc.unique(asking.column("dim")).to_pylist():
            heads = asking.filter(pc.equal(asking.column("dim"), dim))
            part = both.filter(pc.equal(both.column("dim"), dim))
            if not len(part):
                continue
            q_ids, q = heads.column("v").to_numpy(), _matrix(heads.column("x"))
            by = np.argsort(q_ids)
            q_ids, q = q_ids[by], q[by]
            v, least, x = part.column("v").to_numpy(), part.column("least").to_numpy(), _matrix(part.column("x"))
            meeting = np.concatenate([np.stack([part.column(c).to_numpy() for c in ("node", "mb", "qb")], 1), np.stack(names[:3], 1)]).astype(np.int64)
            _, label = np.unique(meeting, axis=0, return_inverse=True)
            label = label.ravel()
            known = np.minimum(np.searchsorted(q_ids, names[3]), len(q_ids) - 1)
            ours = q_ids[known] == names[3]
            out.append(best_of(label[: len(v)], label[len(v) :][ours], known[ours], q_ids, q, v, least, x, k))
        columns = [np.concatenate(c) for c in zip(*out)] or [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table(dict(zip(("q", "v", "score"), (pa.array(c) for c in columns))))

    return vectors.unionByName(heads).groupBy("chunk").cogroup(sent.groupBy("chunk")).applyInArrow(in_task, "q bigint, v bigint, score double")


def best_of(member_of, probe_of, probe, q_ids, q, v, least, x, k):
    """Each query's best ``k`` of the members of its meetings: query ids, vertices and scores, ties to the smaller ``least``."""
    by, to = np.argsort(member_of, kind="stable"), np.argsort(probe_of, kind="stable")
    slack = 1e-12 * np.sqrt((q * q).sum(axis=1)) * np.sqrt((x * x).sum(axis=1).max())
    slack[~np.isfinite(slack)] = 0  # squares beyond the range of doubles
    found = []
    for one in np.unique(probe_of):
        m = by[slice(*np.searchsorted(member_of[by], [one, one + 1]))]
        p = probe[to[slice(*np.searchsorted(probe_of[to], [one, one + 1]))]]
        if len(m) and len(p):
            scores = q[p] @ x[m].T
            if len(m) > k:
                a, b = np.nonzero(scores >= np.partition(scores, len(m) - k, axis=1)[:, len(m) - k, None] - slack[p][:, None])
            else:
                a, b = (i.ravel() for i in np.indices(scores.shape))
            found.append((p[a], m[b], scores[a, b]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    a, b, score = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((v[b], a))  # a vertex of several trees counts once
    a, b, score = a[order], b[order], score[order]
    new = np.append(True, (a[1:] != a[:-1]) | (v[b][1:] != v[b][:-1]))
    a, b, score = a[new], b[new], score[new]
    a, b, score = _first(a, b, score, (-score,), k, slack)
    # Row by row in one fixed order of terms, so equal vectors have equal scores.
    score = np.concatenate([(x[b[i : i + 65536]] * q[a[i : i + 65536]]).sum(axis=1) for i in range(0, len(a), 65536)])
    a, b, score = _first(a, b, score, (least[b], -score), k)
    return q_ids[a], v[b], score


def _first(a, b, score, keys, k, slack=None):
    """The first ``k`` of each ``a`` by the keys, and with ``slack`` those hardly worse than the last of them."""
    order = np.lexsort((*keys, a))
    a, b, score = a[order], b[order], score[order]
    begin = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
    size = np.diff(np.append(begin, len(a)))
    keep = np.arange(len(a)) - np.repeat(begin, size) < k
    if slack is not None:
        last = score[begin + np.minimum(size, k) - 1]
        keep |= score >= np.repeat(last, size) - slack[a]
    return a[keep], b[keep], score[keep]


def search(forest: Forest, queries: DataFrame, k: int = K, want: int | None = None, block: int = BLOCK, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's ``k`` best found, nearest first, ties to the smaller id.

    Vectors that are null, zero or not finite, and rows without an id take no part; vectors of
    another length are never compared. A query does not find rows of its own id; queries that
    repeat an id and a vector are answered once, repeated candidates each count. (Where one id has several
    vectors, these are answered as one query, and rows of its own id may take places of others.) Fewer
    candidates than ``k`` are all returned; an empty table gives an empty result. ``want`` is the
    number of candidates that the ascent gathers, by default ``wanted`` of the number of vectors.
    """
    names, asked = vertices(queries)
    want = want or wanted(forest.size)
    opened = _opened(forest, asked, k, want)
    found = _met(forest, asked, opened, k + 1, block, chunk_rows)
    ordered = Window.partitionBy("q").orderBy(F.desc("score"), "least")
    once = found.groupBy("q", "v").agg(F.first("score").alias("score")).join(forest.vectors.select("v", "key", "least"), "v")
    best = once.withColumn("rank", F.row_number().over(ordered)).where(F.col("rank") <= k + 1).select("q", "key", "score")
    few = forest.names.withColumn("at", F.row_number().over(Window.partitionBy("key").orderBy("vec_id"))).where(F.col("at") <= k + 1)
    each = F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)).cast("int")))
    named = best.join(few.select("key", "vec_id", "copies"), "key").select("q", "vec_id", "score", each.alias("copy"))
    asking = asked.select(F.col("v").alias("q"), "key").join(names.select("key", F.col("vec_id").alias("query_id")), "key").select("q", "query_id")
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    answers = named.join(asking, "q").where("query_id <> vec_id").withColumn("rank", F.row_number().over(nearest))
    return answers.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
