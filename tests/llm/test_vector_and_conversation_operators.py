"""Embedding near-dedup, conversation repair and centroid clustering against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.compare import compare
from tests.llm.cases import CLASHING
from tiercast.llm import centroids, conversations, embedding_dedup
from tiercast.llm.queries import ORACLES, QUERIES

VECTORS = "vec_id long, embedding array<double>, label int"
TURNS = "conv_id long, turn long, role string, text string"
NAN, INF = float("nan"), float("inf")


@pytest.mark.parametrize("name", ["op11_embedding_dedup", "op12_conversations", "op13_centroids"])
def test_new_queries_against_sql(spark, name):
    assert compare(spark, "/root/testdata/sf0.01", QUERIES[name], ORACLES[name]) == []


def with_clashes(df):
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHING], F.lit(1).alias("v"), F.lit(2).alias("x"), F.lit(3).alias("c"), F.lit(4).alias("at"))


# --- embedding near-dedup


def groups_of_vectors(seed=3, dim=64):
    """Copies, near copies at several distances, chains and strangers."""
    rng = np.random.default_rng(seed)
    out = []
    for size, noise in [(40, 0.02), (60, 0.12), (150, 0.17), (30, 0.22), (30, 0.3)]:
        centre = rng.standard_normal(dim)
        out += [centre + noise * rng.standard_normal(dim) * rng.uniform(0.2, 1.5) for _ in range(size)]
    out += [rng.standard_normal(dim) for _ in range(200)]
    chain = rng.standard_normal(dim)
    for _ in range(40):  # neighbours link, ends do not
        chain = chain + 0.2 * rng.standard_normal(dim)
        out.append(chain)
    out += [out[0]] * 30 + [out[100] * 7.5, out[100] * 1e-200, out[100] * 1e200]
    return [v.tolist() for v in out]


def brute_classes(rows, cosine):
    """Links and components of all pairs, in plain numpy."""
    ok = [i for i, (_, v) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and np.any(v)]
    unit = {i: np.array(rows[i][1]) / np.abs(rows[i][1]).max() for i in ok}
    unit = {i: u / np.sqrt((u * u).sum()) for i, u in unit.items()}
    near = defaultdict(set)
    for dim in {len(u) for u in unit.values()}:
        mine = [i for i in ok if len(unit[i]) == dim]
        x = np.array([unit[i] for i in mine])
        for a, b in zip(*np.nonzero(x @ x.T >= cosine)):
            if a != b:
                near[mine[a]].add(mine[b])
    root = {}
    for i in range(len(rows)):
        if i not in root:
            todo, members = [i], {i}
            while todo:
                for j in near[todo.pop()] - members:
                    members.add(j)
                    todo.append(j)
            least = min((rows[j][0] is None, rows[j][0] or 0, rows[j][0]) for j in members)[2]
            root.update({j: least for j in members})
    return sorted(((rows[i][0], len(near[i]), root[i], rows[i][0] == root[i]) for i in range(len(rows))), key=str)


@pytest.mark.parametrize("block", [16, 1024])
def test_embedding_classes(spark, block):
    rows = list(enumerate(groups_of_vectors()))
    random.Random(5).shuffle(rows)
    got = embedding_dedup.classes(with_clashes(spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)), block=block)
    want = brute_classes(rows, embedding_dedup.COSINE)
    assert sum(w[1] for w in want) > 10_000 and len({w[2] for w in want}) > 200
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_embedding_recall(spark):
    """Of pairs right above the threshold, which the tables find least often, hardly one is lost."""
    rng = np.random.default_rng(9)
    rows = []
    for k in range(1500):
        a, b = rng.standard_normal((2, 64))
        a /= np.linalg.norm(a)
        b -= a * (a @ b)
        b /= np.linalg.norm(b)
        rows += [(2 * k, a.tolist(), 0), (2 * k + 1, (0.9501 * a + np.sqrt(1 - 0.9501**2) * b).tolist(), 0)]
    got = embedding_dedup.classes(spark.createDataFrame(rows, VECTORS))
    assert got.where("n_links = 1").count() >= 0.995 * len(rows)
    below = [(i, (np.array(v) if i % 2 == 0 else np.array(v) + 0.02 * np.array(rows[i - 1][1]) * -1).tolist(), 0) for i, v, _ in rows]
    assert embedding_dedup.classes(spark.createDataFrame(below, VECTORS)).where("n_links > 0").count() == 0


def test_embedding_odd_rows(spark):
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [1.0, NAN]), (6, [INF, 1.0]),
        (7, [1.0, 0.0]), (7, [1.0, 0.0]), (None, [2.0, 0.0]), (None, [3.0, 0.0]), (9, [1.0, -0.0]),
        (None, [0.0, 5.0]), (10, [1.0, 0.0, 0.0]), (11, [-1.0, 0.0]), (1, None),
    ]
    got = embedding_dedup.classes(with_clashes(spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)))
    want = [(1, 0, 1, True)] * 2 + [(k, 0, k, True) for k in (2, 3, 4, 5, 6, 10, 11)]
    want += [(7, 4, 7, True)] * 2 + [(9, 4, 7, False)] + [(None, 4, 7, False)] * 2 + [(None, 0, None, True)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert embedding_dedup.classes(spark.createDataFrame([], VECTORS)).collect() == []


def test_components(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + k) for k in range(1, 50)] + [(5000, 4000), (4000, 4500), (7, 7)]
    got = embedding_dedup.components(spark.createDataFrame(edges, "a long, b long"))
    root = {r.v: r.root for r in got.collect()}
    assert got.count() == len(root)
    assert root == {**{i: 0 for i in range(301)}, **{1000 + k: 1000 for k in range(50)}, 4000: 4000, 4500: 4000, 5000: 4000}


# --- conversation repair


def brute_repair(signs):
    """The cheapest edits of all there are, by trying them."""
    best = None

    def go(i, out, cost, audit, inserted):
        nonlocal best
        if not re.fullmatch("(s?(ua)*u?)?", out) or (best is not None and cost > best[0]):
            return
        if i == len(signs) and re.fullmatch("(s?(ua)+)?", out) and (best is None or (cost, audit) < best):
            best = (cost, audit)
        if inserted < 3:
            for role in "ua":
                go(i, out + role, cost + 3, audit + "I", inserted + 1)
        if i < len(signs):
            fault, role = divmod(int(signs[i], 16), 4)
            go(i + 1, out, cost + 4, audit + "D", 0)
            if fault < 2:
                go(i + 1, out + "suax"[role], cost + 3 * fault, audit + "K", 0)
                for new in "ua":
                    go(i + 1, out + new, cost + 3 * fault + 3, audit + "R", 0)

    go(0, "", 0, "", 0)
    return best


def test_repair_against_all_edits():
    draw = random.Random(1)
    for n in range(6):
        for _ in range(40):
            signs = "".join(draw.choice("0123456789abcdef" if draw.random() < 0.3 else "0123") for _ in range(n))
            want = brute_repair(signs)
            assert conversations.whole(signs) == want, signs
            for k in range(1, n):  # cut in two or three segments
                for pieces in [(signs[:k], signs[k:]), (signs[: k - 1], signs[k - 1 : k], signs[k:])]:
                    cost, parts = conversations.joined([conversations.across(p) for p in pieces], n)
                    assert (cost, "".join(letters for _, letters in parts)) == want, pieces


def plain_report(rows):
    """The contract row by row, with the solver for the audit."""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        hit = zlib.crc32(name.encode()) % 20
        if hit:
            text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
            by[conv] += [(turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    out = []
    for conv in {r[0] for r in rows}:
        mine = sorted(by[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = {r[0] for r in mine} - {None}
        signs, seen, faults = "", set(), [0, 0, 0, 0]
        for _, role, text in mine:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            fault = 2 if not bare else 3 if (role, text) in seen else 0 if bare[-1] in ".!?" else 1
            seen.add((role, text))
            faults[fault] += 1
            signs += f"{4 * fault + ('sua'.index(role[0]) if role and role[0] in 'sua' else 3):x}"
        cost, audit = conversations.whole(signs)
        lines, k, last = [], 0, ""
        for letter in audit:
            if letter == "K":
                last = mine[k][1][0]
                lines.append(f"{mine[k][1]}:{mine[k][2]}")
            elif letter in "RI":
                last = "a" if last == "u" else "u"
                lines.append({"u": "user:", "a": "assistant:"}[last] + (mine[k][2] if letter == "R" else ""))
            k += letter != "I"
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv, gaps, faults[2], faults[3], faults[1], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


ODD_TURNS = [
    (None, None, None, None), (None, 1, "user", "x."), (1, None, "tool", "\x85"), (1, None, "", None),
    (1, 3, "user", "a?\x85"), (1, 3, "user", "a?\x85"), (1, 9, "assistant", "b. \t"), (2, 5, "System", "x"),
    (3, 0, "system", ""), (4, 0, "system", "s."), (4, 1, "user", "long words. " * 100_000), (4, 2, "assistant", "\x00."),
    (5, -7, "user", "u:\na."), (5, 4, "assistant", "𝒳!"),
]


@pytest.mark.parametrize("bits", [1, 3, 12])
def test_repair_report(spark, bits):
    long = [(7, i // 2, "user" if i % 3 else "assistant", f"t{i % 50}." if i % 7 else "") for i in range(700)]
    for rows in (ODD_TURNS + long, [(k, 0, "user", "same.") for k in range(40)]):
        table = spark.createDataFrame(rows, TURNS)
        got = conversations.report(with_clashes(table.repartition(3)), bits)
        assert sorted(map(tuple, got.collect()), key=str) == plain_report(rows)


def test_repair_of_tables(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    got = conversations.report(table, 2)
    assert sorted(map(tuple, got.collect()), key=str) == plain_report([tuple(r) for r in table.collect()])
    assert conversations.report(table.limit(0)).collect() == []


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "s."), (1, 1, "assistant", "a."), (1, 2, "tool", "t."), (1, 3, "assistant", "b.")]
    placed, plan = conversations.repair(spark.createDataFrame(rows, TURNS))
    made = conversations.repaired(placed, plan).orderBy("c", "place").collect()
    assert [r.audit for r in plan.collect()] == ["KIKRK"]
    assert [(r.role, r.text) for r in made] == [("system", "s."), ("user", ""), ("assistant", "a."), ("user", "t."), ("assistant", "b.")]


# --- centroid clustering


def brute_clusters(rows, k=16, rounds=3):
    kept = [(i, [int(np.floor(64 * c)) for c in v]) for i, v in rows if v and len(v) == 64 and None not in v and np.isfinite(v).all()]
    name = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    middle = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]
    for step in range(rounds + 1):
        found = [min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(middle)) for _, v in kept]
        if step < rounds:
            for c in range(len(middle)):
                mine = [v for (_, v), (_, at) in zip(kept, found) if at == c]
                if mine:
                    middle[c] = [sum(x) // len(mine) for x in zip(*mine)]
    inertia = defaultdict(int)
    for d, c in found if kept else []:
        inertia[c] += d
    sha = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in middle]
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), sha[c]) for (i, _), (d, c) in zip(kept, found)), key=str) if kept else []


def test_popcounts():
    draw = np.random.default_rng(4)
    for planes, top in [(1, 1), (2, 2), (8, 128), (28, 1 << 27)]:
        x, c = draw.integers(-top, max(top, 1), (50, 64)), draw.integers(-top, max(top, 1), (3, 64))
        if planes == 1:
            x, c = -np.abs(x) % 2 * -1, -np.abs(c) % 2 * -1
        p, q = centroids.pack(x, planes), centroids.pack(c, planes)
        for k in range(3):
            assert (centroids.dot(p, q[k]) == x @ c[k]).all()
        assert (centroids.norms(p) == (x * x).sum(axis=1)).all()
        counts, sums = centroids.sums_of(p, np.arange(50, dtype=np.int32) % 3, 4)
        assert counts.tolist() == [17, 17, 16, 0] and (sums[1] == x[1::3].sum(axis=0)).all() and not sums[3].any()


def cluster_rows(rows, spark):
    got = centroids.report(with_clashes(spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)))
    return sorted(map(tuple, got.collect()), key=str)


@pytest.mark.parametrize("spread", [0.1, 30.0, 20_000.0])
def test_clusters(spark, spread):
    draw = np.random.default_rng(8)
    vectors = (draw.standard_normal((300, 64)) * spread).tolist()
    rows = list(enumerate(vectors)) + [(400 + k, vectors[0]) for k in range(50)] + [(5, vectors[9]), (5, vectors[9]), (None, vectors[3]), (None, [0.0] * 64)]
    rows += [(900, None), (901, []), (902, [1.0] * 63), (903, [NAN] * 64), (904, [None] * 64), (905, [INF] + [0.0] * 63), (906, [1.0] * 65)]
    assert cluster_rows(rows, spark) == brute_clusters(rows)


def test_few_vectors(spark):
    rows = [(k, [float(k)] * 64) for k in range(3)] + [(9, [1.0] * 64)]
    assert cluster_rows(rows, spark) == brute_clusters(rows)
    assert cluster_rows([(1, [0.0] * 64)], spark) == brute_clusters([(1, [0.0] * 64)])
    assert cluster_rows([(1, [1.0])], spark) == []
    assert centroids.report(spark.createDataFrame([], VECTORS)).collect() == []
    with pytest.raises(ValueError, match="do not fit"):
        centroids.report(spark.createDataFrame([(1, [1e9] * 64, 0)], VECTORS))
