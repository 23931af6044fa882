"""LM scoring, near dedup, suffix dedup, the classifier, nearest neighbours and the pipeline against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.cases import DOC_SCHEMA, awkward, clashing, table
from tiercast.llm import ann, exact_dedup, lm_scoring, near_dedup, quality, secret_scans, suffix_dedup
from tiercast.llm.text_blocks import key_ranges
from tiercast.llm.words import blocks, unsqueeze, squeeze

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"


def documents(spark, folder=SMALL):
    return spark.read.parquet(f"{folder}/documents.parquet")


def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


# --- LM scoring


def brute_scores(rows, order, backoff):
    grams = [[tuple(w[i - k + 1 : i + 1]) for i in range(len(w)) for k in range(1, min(i + 1, order) + 1)] for w in (t.split() if t else [] for _, t in rows)]
    total = Counter(g for doc in grams for g in doc)
    words = sum(n for g, n in total.items() if len(g) == 1)
    out = Counter()
    for (doc_id, text), doc in zip(rows, grams):
        own = Counter(doc)
        out_of = lambda g: total[g] - own[g]
        w = text.split() if text else []
        score = 0
        for i in range(len(w)):
            top = min(i + 1, order)
            for k in range(top, 0, -1):
                g = tuple(w[i - k + 1 : i + 1])
                if k == 1:
                    s = max(out_of(g), 1) / max(words - len(w), 1)
                elif out_of(g) > 0:
                    s = out_of(g) / out_of(g[:-1])
                else:
                    continue
                score += round((math.log(s) + (top - k) * math.log(backoff)) * 1_000_000)
                break
        out[(doc_id, len(w), score)] += 1
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores(spark, order):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("the of and x y zeta") for _ in range(rng.randrange(40)))) for i in range(60)]
    rows += [(60, None), (61, ""), (None, "the of and"), (3, rows[3][1]), (3, rows[3][1])]
    docs = clashing(table(spark, rows)).repartition(4)
    got = Counter((r.doc_id, r.n_words, r.score_micro) for r in lm_scoring.scores(docs, order, 0.4, block_bytes=300).collect())
    want = brute_scores(rows, order, 0.4)
    assert got == want
    assert lm_scoring.scores(empty(spark)).count() == 0


def test_scores_of_awkward_rows(spark):
    assert lm_scoring.scores(awkward(spark)).count() == 11


# --- suffix dedup


def brute_suffixes(rows, width=50):
    big = 1 << 62
    first = {}
    for d, t in sorted(((big if d is None else d), t or "") for d, t in rows):
        b = t.encode()
        for p in range(len(b) - width + 1):
            first.setdefault(b[p : p + width], d)
    out = Counter()
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - width + 1):
            if first[b[p : p + width]] < (big if d is None else d):
                gone[p : p + width] = b"\1" * width
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[(d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())] += 1
    return out


def answers(df):
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def passages():
    """Texts of few letters, so that passages repeat, overlap and repeat inside a text in every way."""
    rng = random.Random(9)
    pool = ["".join(rng.choice("ab é") for _ in range(rng.randrange(30, 160))) for _ in range(12)]
    rows = []
    for i in range(80):
        parts = []
        for _ in range(rng.randrange(4)):
            p = rng.choice(pool)
            a = rng.randrange(len(p))
            parts += [p[a : a + rng.randrange(20, 140)], "".join(rng.choice("cdef") for _ in range(rng.randrange(3)))]
        rows.append((rng.randrange(60), "".join(parts)))
    return rows + [(None, pool[0] * 3), (None, pool[0] * 2), (70, None), (71, ""), (72, "x" * 300), (73, "x" * 120), (74, "x" * 49)]


@pytest.mark.parametrize("block_bytes", [400, 1 << 20])
def test_suffixes(spark, block_bytes):
    rows = passages()
    docs = clashing(table(spark, rows)).repartition(3)
    assert answers(suffix_dedup.dedup(docs, block_bytes=block_bytes)) == brute_suffixes(rows)
    assert suffix_dedup.dedup(empty(spark)).count() == 0


def test_suffixes_of_given_table(spark):
    docs = documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = suffix_dedup.dedup(docs.repartition(4), block_bytes=1 << 16)
    assert answers(got) == brute_suffixes(rows)
    texts = dict(rows)
    for r in got.where("n_removed > 0").limit(20).collect():
        raw = texts[r.doc_id].encode()
        edges = [0, *r.spans, len(raw)]
        assert b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])) == bytes(r.kept)


def test_key_ranges_follow_the_corpus(spark):
    least = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert key_ranges(spark.range(3), 1 << 20, 16 << 20) == least
    assert key_ranges(spark.range(10_000), 1 << 20, 16 << 20) == 625


def suffix(anchor, run):
    return np.array([anchor.ljust(16, b"\0") + bytes([run]) * 8], "S24")


def test_family_merges_geometrically():
    family = suffix_dedup.Family(11)
    for k in range(11):
        family.add(suffix(b"%d" % k, 1), np.array([k]))
    assert [len(level) for level in family.levels] == [8, 2, 1]
    assert all((level.suffixes[1:] > level.suffixes[:-1]).all() for level in family.levels)
    family.add(suffix(b"3", 1), np.array([3]))  # known: no level is touched
    assert [len(level) for level in family.levels] == [8, 2, 1]


@pytest.mark.parametrize("batch", [1, 2, 7, 50, 1000])
def test_family_answers_on_arrival(batch):
    """Whatever the batches and the levels that they meet: the first equal entry, and all anchors with several runs."""
    rng = np.random.default_rng(batch)
    n = 1000
    wide = np.stack([rng.integers(0, 9, n), rng.integers(0, 9, n) << 56, rng.integers(0, 4, n) << 56], axis=1).astype(np.uint64)
    rows = wide.view("S24").ravel()
    family = suffix_dedup.Family(n)
    for at in range(0, n, batch):
        come = np.arange(at, min(at + batch, n))
        family.add(rows[come], come)
        now = family.answers()[0][come].tolist()  # answered when it comes, and not changed later
        assert [wide[i].tolist() for i in now] == wide[come].tolist() and all(i <= k for i, k in zip(now, come))
    first, several = family.answers()
    leads, runs = {}, {}
    for i, (a, b, r) in enumerate(wide.tolist()):
        leads.setdefault((a, b, r), i)
        runs.setdefault((a, b), set()).add(r)
    assert first.tolist() == [leads[tuple(x)] for x in wide.tolist()]
    assert several.tolist() == [len(runs[(a, b)]) > 1 for a, b, _ in wide.tolist()]
    assert sum(len(level) for level in family.levels) == len(leads)


@pytest.mark.parametrize("batch", [3, 64])
def test_suffixes_in_small_batches(spark, batch):
    """Documents that lie in no order, with many batches and levels in every key range."""
    rows = passages()
    texts = [t for _, t in rows]
    random.Random(4).shuffle(texts)
    rows += list(zip(range(200, 200 + len(texts)), texts))
    random.Random(5).shuffle(rows)
    docs = table(spark, rows).repartition(5)
    assert answers(suffix_dedup.dedup(docs, ranges=2, block_bytes=300, batch=batch)) == brute_suffixes(rows)


def test_hot_anchor_windows():
    """The runs of one anchor, far more windows than are compared at a time: right answers in little memory."""
    rng = np.random.default_rng(6)
    n, width, span = 40_000, suffix_dedup.WIDTH, suffix_dedup.SPAN
    heads, tails = (["".join(w) for w in rng.choice(list("abcd"), (300, span - 1))] for _ in range(2))
    texts, rows = [], []
    for i in range(n):
        place = int(rng.integers(span // 2, span))
        count = int(rng.integers(span // 4, place + 2))
        around = heads[rng.integers(300)] + "=" * suffix_dedup.ANCHOR + tails[rng.integers(300)]
        texts.append(around[span - 1 - place :][: count + width - 1].encode())
        rows.append((7, int(rng.integers(2000)), count, place))
    least = {}
    for t, (_, doc, count, _) in zip(texts, rows):
        for k in range(count):
            least[t[k : k + width]] = min(doc, least.get(t[k : k + width], doc))
    data, raw = [], []
    for at in range(0, n, 4000):
        key, doc, count, place = (np.array(c) for c in zip(*rows[at : at + 4000]))
        data.append(squeeze(np.diff(key.astype(np.uint64), prepend=np.uint64(0)), doc, count.astype(np.uint8), place.astype(np.uint8)))
        raw.append(squeeze(np.frombuffer(b"".join(texts[at : at + 4000]), np.uint8)))
    asked = pa.table({"block": range(len(data)), "range": [0] * len(data), "data": pa.array(data, pa.binary()), "bytes": pa.array(raw, pa.binary())})
    tracemalloc.start()
    answered = suffix_dedup._answer_windows(asked)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    masks = np.concatenate([unsqueeze(d, np.uint64)[0] for d in answered.column("data").to_pylist()]).tolist()
    assert sum(r[2] for r in rows) > 2 * suffix_dedup.WINDOWS
    assert masks == [sum(1 << k for k in range(r[2]) if least[t[k : k + width]] < r[1]) for t, r in zip(texts, rows)]
    assert peak < 45_000_000


# --- near dedup


def shingles(text):
    w = (text or "").split()
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def brute_classes(rows):
    sets = [shingles(t) for _, t in rows]
    df = Counter(s for c in sets for s in c)
    n = sum(1 for c in sets if c)
    idf = {s: 1 + min(math.log(n / f), math.log(1000)) / math.log(1000) for s, f in df.items()}
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for i, c in enumerate(sets):
        for s in c:
            where[s].append(i)
    for i, c in enumerate(sets):
        for j in {j for s in c for j in where[s] if j > i}:
            either = {*c, *sets[j]}
            both = sum(min(c[s], sets[j][s]) * idf[s] for s in either)
            if both >= 0.8 * sum(max(c[s], sets[j][s]) * idf[s] for s in either):
                parent[top(j)] = top(i)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[top(i)].append(rows[i][0])
    return sorted(sorted(g) for g in groups.values())


def found_classes(df):
    groups = defaultdict(list)
    for r in df.collect():
        groups[r.class_id].append(r.doc_id)
        assert r.kept == (r.doc_id == r.class_id) and r.class_id <= r.doc_id
    return sorted(sorted(g) for g in groups.values())


def test_near_classes_of_given_table(spark):
    docs = documents(spark, MIDDLE)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found_classes(near_dedup.classes(docs)) == brute_classes(rows)


def mutated(rng, words, share):
    return [rng.choice("pqrst") * 3 if rng.random() < share else w for w in words]


def test_one_large_group(spark):
    """A third of the rows are near copies of one text, beside texts that share a long passage."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base, passage = [word() for _ in range(400)], [word() for _ in range(120)]
    rows = [(i, " ".join(mutated(rng, base, 0.003))) for i in range(150)]
    rows += [(150 + i, " ".join(passage + [word() for _ in range(120)])) for i in range(150)]
    rows += [(300 + i, " ".join(word() for _ in range(60))) for i in range(150)]
    got = found_classes(near_dedup.classes(clashing(table(spark, rows)).repartition(4)))
    assert got == brute_classes(rows)


def passages_with_pairs(seed):
    """Texts just under the similarity that share a passage, and one near copy of each."""
    rng = random.Random(seed)
    passage = [rng.choice("abcdefgh") * 3 + str(rng.randrange(900)) for _ in range(200)]
    rows = []
    for i in range(40):
        own = [f"w{i}x{k}" for k in range(60)]
        rows += [(2 * i, " ".join(passage + own)), (2 * i + 1, " ".join(passage + own[:-1] + ["other"]))]
    return rows


@pytest.mark.parametrize("shingles, members", [(600, 256), (1 << 16, 3), (1 << 16, 256)])
def test_divided_buckets(spark, monkeypatch, shingles, members):
    """Buckets of one block, or of many that meet in pairs."""
    rows = passages_with_pairs(4)
    docs = table(spark, rows)
    monkeypatch.setattr(near_dedup.links, "__defaults__", (shingles, members))
    assert found_classes(near_dedup.classes(docs)) == brute_classes(rows)


@pytest.mark.parametrize("members", [8, 1024])
def test_pairs_of_one_band(spark, members):
    """Links are found although their ends share one band only, and that with all others."""
    rows = passages_with_pairs(5)
    docs = table(spark, rows)
    weigh = near_dedup.Weights(*near_dedup.frequencies(docs))
    one_band = F.expr("transform(bands, (x, i) -> if(i = 0, 0L, v * 100 + i))")
    vertices = near_dedup.vertices_of(near_dedup.signatures(docs, weigh)).withColumn("v", F.col("rep")).withColumn("bands", one_band)
    labels = near_dedup.links(docs, vertices, spark.sparkContext.broadcast(weigh), near_dedup.SIMILARITY, block_members=members)
    assert {r.v: r.label for r in labels.collect()} == {i: i - i % 2 for i in range(80)}


def test_meetings_leave_no_row_per_pair(spark):
    """A group of which all pairs are links leaves as many links as it has members, less one."""
    rng = random.Random(6)
    base = [f"w{k}" for k in range(300)]
    rows = [(i, " ".join(mutated(rng, base, 0.004))) for i in range(120)]
    docs = table(spark, rows)
    weigh = near_dedup.Weights(*near_dedup.frequencies(docs))
    vertices = near_dedup.vertices_of(near_dedup.signatures(docs, weigh))
    shingles = near_dedup.shingled(docs, vertices, spark.sparkContext.broadcast(weigh))
    sent = vertices.select(F.lit(0).cast("long").alias("bucket"), F.lit(0).alias("one"), F.lit(0).alias("two"), F.lit(-1).alias("side"), "v", F.col("v").alias("label"), "size")
    n = vertices.count()
    assert near_dedup.met(sent, shingles, 0.5).count() == n - 1 > 60


def test_near_rows_with_many_equal_ids(spark):
    """Rows without an id, or with one id, are led to their own text."""
    rows = passages_with_pairs(7)
    docs = table(spark, [(None, t) for _, t in rows] + [(7, t) for _, t in rows[:20]] + [(None, rows[0][1])] * 50)
    got = Counter((r.doc_id, r.class_id, r.class_size, r.kept) for r in near_dedup.classes(docs).collect())
    assert got == {(7, 7, 4, True): 18, (None, 7, 4, False): 18, (7, 7, 54, True): 2, (None, 7, 54, False): 52, (None, None, 2, True): 60}


def test_near_awkward_rows(spark):
    docs = clashing(awkward(spark))
    got = Counter((r.doc_id, r.class_id, r.class_size) for r in near_dedup.classes(docs).collect())
    assert got[(1, 1, 3)] == 2 and got[(2, 1, 3)] == 1
    assert got[(3, 3, 1)] == got[(4, 4, 1)] == got[(5, 5, 1)] == 1
    assert got[(None, None, 2)] == 2
    assert near_dedup.keep(docs).columns == docs.columns
    assert near_dedup.classes(empty(spark)).count() == 0


def test_near_columns_do_not_depend_on_the_plan(spark):
    """How many links get verified depends on partitions, so no column counts them."""
    docs = documents(spark)
    few, many = (Counter(map(tuple, near_dedup.classes(docs.repartition(n)).collect())) for n in (1, 7))
    assert few == many
    assert near_dedup.classes(empty(spark)).columns == ["doc_id", "class_id", "class_size", "kept"]


# --- quality classifier


def test_classifier_on_held_out_labels(spark):
    docs = documents(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    fitted_on = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(2000).select("doc_id")
    scored = quality.scored(docs, labels, train_rows=2000).join(labels, "doc_id").join(fitted_on, "doc_id", "left_anti")
    rates = {(r.quality, r.toxic): r.kept for r in scored.groupBy("quality", "toxic").agg(F.avg(F.col("keep").cast("int")).alias("kept")).collect()}
    assert rates[(1, 0)] > 0.99 and rates[(0, 0)] < 0.03 and rates[(1, 1)] < 0.12


def test_sparse_sites_shrink(spark):
    """A large bad site stays bad; a single bad document of a small site hardly moves its rate."""
    rows = [(i, "big", "a", 5.0) for i in range(500)] + [(1000 + i, "clean", "a", -5.0) for i in range(500)] + [(2000, "tiny", "b", 5.0), (2001, "clean", "b", 5.0)]
    found = spark.createDataFrame([(d, 0, h, p, m) for d, h, p, m in rows], "doc_id long, text_key long, host string, path string, margin double")
    groups, rate = quality.posteriors(found)
    hosts = {r.host: r.host_rate for r in groups.collect()}
    assert hosts["big"] > 0.95 and hosts["clean"] < 0.05
    assert abs(hosts["tiny"] - rate) < abs(0.99 - rate)


def brute_judged(rows):
    """Posteriors and moved log odds written out: rows of (host, path, margin)."""
    p = [1 / (1 + math.exp(-m)) for _, _, m in rows]
    rate = sum(p) / len(p)
    sums = lambda key: {k: (sum(1 for r in rows if key(r) == k), sum(x for x, r in zip(p, rows) if key(r) == k)) for k in {key(r) for r in rows}}

    def strength(groups, centre):
        between = sum((s / n - centre(k)) ** 2 for k, (n, s) in groups.items()) / len(groups)
        within = sum(rate * (1 - rate) / n for n, _ in groups.values()) / len(groups)
        if len(groups) < 2 or between <= within or not 0 < rate < 1:
            return 1e6
        return min(max(rate * (1 - rate) / (between - within) - 1, 1.0), 1e6)

    hosts, paths = sums(lambda r: r[0]), sums(lambda r: r[:2])
    k_host = strength(hosts, lambda k: rate)
    host_rate = {k: (s + k_host * rate) / (n + k_host) for k, (n, s) in hosts.items()}
    k_path = strength(paths, lambda k: host_rate[k[0]])
    clip = lambda x: min(max(x, 1e-6), 1 - 1e-6)
    out = []
    for (host, path, margin), own in zip(rows, p):
        n, s = paths[(host, path)]
        path_rate = clip((s - own + k_path * host_rate[host]) / (n - 1 + k_path))
        moved = margin + quality.SITE_WEIGHT * (math.log(path_rate / (1 - path_rate)) - math.log(clip(rate) / (1 - clip(rate))))
        out.append((margin, host_rate[host], path_rate, 1 / (1 + math.exp(-moved))))
    return out


@pytest.mark.parametrize("seed, sites", [(1, 30), (2, 3), (3, 1)])
def test_posteriors_and_moved_odds(spark, seed, sites):
    rng = random.Random(seed)
    lean = {h: rng.uniform(-6, 3) for h in range(sites)}
    rows = [(f"h{h}", f"p{rng.randrange(4)}", rng.gauss(lean[h], 2)) for h in (min(int(rng.expovariate(0.2)), sites - 1) for _ in range(600))]
    found = spark.createDataFrame([(i, 0, *r) for i, r in enumerate(rows)], "doc_id long, text_key long, host string, path string, margin double")
    got = {r.doc_id: (r.evidence, r.host_rate, r.path_rate, r.bad) for r in quality.judged(found).collect()}
    for i, want in enumerate(brute_judged(rows)):
        assert got[i] == pytest.approx(want, rel=1e-9, abs=1e-12)


def test_classifier_awkward_rows(spark):
    docs = clashing(awkward(spark))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.keep(docs, none).count() == docs.count()
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 1), (6, None, None), (7, 0, None), (7, 0, None)], "doc_id long, quality int, toxic int")
    assert quality.scored(docs, labels).count() == docs.count()
    assert quality.keep(docs, labels).columns == docs.columns
    assert quality.scored(empty(spark), labels).count() == 0


# --- nearest neighbours


def brute_nearest(rows, queries, k):
    out = {}
    for name, q in queries:
        found = sorted((-float(np.dot(q, v)), i) for i, v in rows if i != name)
        out[name] = [i for _, i in found[:k]]
    return out


@pytest.mark.parametrize("folder", [MIDDLE, "/root/testdata/sf0.1"])
def test_recall(spark, folder):
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in vectors.collect()]
    want = brute_nearest(rows, [r for r in rows if r[0] % 20 == 0], ann.K)
    got = defaultdict(dict)
    by_id = dict(rows)
    for r in ann.search(ann.index(vectors), vectors.where("vec_id % 20 = 0")).collect():
        got[r.query_id][r.rank] = r.vec_id
        assert abs(r.score - float(np.dot(by_id[r.query_id], by_id[r.vec_id]))) < 1e-12
    assert got.keys() == want.keys()
    assert all(sorted(g) == list(range(1, ann.K + 1)) for g in got.values())
    assert np.mean([len({*got[q].values()} & {*want[q]}) / ann.K for q in want]) >= 0.9


def measured(x, asked, k):
    """Recall of the numpy side of the forest, and the share of all vectors that is scored."""
    near = ann.nearness(np.column_stack([x[asked], np.zeros(len(asked))]).astype(np.float32))
    codes = np.concatenate([ann.strings(ann.nearness(ann.lengthened(x[i : i + 1024], 1.0))) for i in range(0, len(x), 1024)])
    want, length = ann.wanted(len(x)), ann.depth(len(x))
    shift = ann.LETTER * (ann.SYMBOLS - length)
    trees, opened, _ = ann.ascent(near, length, min(ann.TREES * (2 * ann.AXES) ** length, 2 * want * (2 * ann.AXES) ** length // len(x)))
    recall, share = [], []
    for row, tree, code in zip(asked, trees, opened >> shift):
        score = x @ x[row]
        score[row] = -np.inf
        held, total = np.zeros(len(x), bool), 0
        for t, c in zip(tree, code):
            if total >= want:
                break
            mine = codes[:, t] >> shift == c
            held |= mine
            total += mine.sum()
        recall.append(held[np.argsort(-score)[:k]].mean())
        share.append(held.mean())
    return np.mean(recall), np.mean(share)


def test_share_of_pairs_scored():
    """Vectors spread evenly over a sphere, the worst case: recall stays while the share of pairs scored falls."""
    shares = []
    for n in (2000, 12000):
        x = np.random.default_rng(n).standard_normal((n, 64))
        x /= np.sqrt((x * x).sum(axis=1))[:, None]
        recall, share = measured(x, np.arange(0, n, n // 40), ann.K)
        assert recall >= 0.9
        shares.append(share)
    assert shares[0] < 0.5 and shares[1] < 0.36


def test_opened_nodes_do_not_jump():
    """A query opens a few hundred nodes on average however many vectors there are, and recall stays."""
    for n in (2_000, 51_282, 61_440, 61_536, 250_000, 2_500_000, 10**8):
        nodes = (2 * ann.AXES) ** ann.depth(n)
        assert ann.wanted(n) * nodes / n < 650
        assert ann.leaf_limit(n) >= 4 * n // nodes  # or else most leaves would be parted, and few of their parts opened
    n = 61_536
    x = np.random.default_rng(n).standard_normal((n, 64))
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    recall, share = measured(x, np.arange(0, n, n // 40), ann.K)
    assert recall >= 0.9 and share < 0.3


def test_ascent_takes_the_cheapest_prefixes():
    near = ann.nearness(np.random.default_rng(3).standard_normal((3, 9)).astype(np.float32))
    lacks = (near.max(axis=3, keepdims=True) - near) ** 2
    own = ann.strings(near)
    for count in (1, 7, 500):
        trees, codes, told = ann.ascent(near, 2, count)
        for q in range(3):
            all_costs = sorted(a + b for t in range(ann.TREES) for a in lacks[q, t, 0] for b in lacks[q, t, 1])
            top, rest = codes[q] >> ann.LETTER * (ann.SYMBOLS - 2), (1 << ann.LETTER * (ann.SYMBOLS - 2)) - 1
            costs = [lacks[q, t, 0, c >> ann.LETTER] + lacks[q, t, 1, c & (2 * ann.AXES - 1)] for t, c in zip(trees[q], top)]
            assert np.allclose(costs, told[q]) and np.allclose(costs, all_costs[:count]) and len({*zip(trees[q].tolist(), top.tolist())}) == count
            assert ((codes[q] & rest) == (own[q, trees[q]] & rest)).all()


def test_nearest_dense_and_copied(spark):
    """A third are copies of one vector, a third lie close together; small blocks, all wanted: exact."""
    rng = np.random.default_rng(8)
    centre = rng.standard_normal(8)
    x = np.concatenate([np.tile(centre, (120, 1)), centre + 0.01 * rng.standard_normal((120, 8)), rng.standard_normal((120, 8)) * 2])
    rows = list(enumerate(x))
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id long, embedding array<double>")
    queries = vectors.where("vec_id % 20 = 0")
    got = defaultdict(list)
    for r in ann.search(ann.index(vectors), queries, k=5, want=10**9, block=16, chunk_rows=200).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    for i in range(0, 360, 20):
        exact = sorted((-float((x[j] * x[i]).sum()), j) for j in range(360) if j != i)[:5]
        assert [g[0] for g in got[i]] == [j for _, j in exact]
        assert np.allclose([g[1] for g in got[i]], [-s for s, _ in exact], rtol=1e-14)


def test_nearest_in_parted_leaves(spark):
    """Half of the vectors lie in five dense bundles whose nodes are parted by further symbols."""
    rng = np.random.default_rng(9)
    bundles = np.repeat(rng.standard_normal((5, 16)), 60, axis=0) + 0.3 * rng.standard_normal((300, 16))
    x = np.concatenate([bundles, rng.standard_normal((300, 16))])
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    forest = ann.index(vectors, leaf=10)
    assert forest.last > forest.first > 0
    found = defaultdict(set)
    for r in ann.search(forest, vectors.where("vec_id % 20 = 0"), k=5, chunk_rows=50).collect():
        found[r.query_id].add(r.vec_id)
    recall = []
    for i in range(0, 600, 20):
        score = x @ x[i]
        score[i] = -2
        recall.append(len(found[i] & {*np.argsort(-score)[:5].tolist()}) / 5)
    assert all(len(f) == 5 for f in found.values()) and np.mean(recall) >= 0.9


@pytest.mark.parametrize("size", [1e200, 1e-200])
def test_nearest_of_extreme_lengths(spark, size):
    """Products beyond the range of doubles are ties at infinity or zero."""
    vectors = spark.createDataFrame([(i, [size * (1 + i % 3), size]) for i in range(30)], "vec_id long, embedding array<double>")
    got = ann.search(ann.index(vectors), vectors.where("vec_id % 20 = 0"), k=4).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id) for r in got] == [(0, i) for i in (1, 2, 3, 4)] + [(20, i) for i in (0, 1, 2, 3)]
    assert {r.score for r in got} == {math.inf if size > 1 else 0.0}


def test_nearest_awkward_rows(spark):
    inf, nan = math.inf, math.nan
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0])]
    rows += [(8, [1.0, 0.0, 0.0]), (None, [9.0, 0.0]), (9, [-1.0, 5.0]), (9, [-1.0, 5.0]), (20, [0.0, 0.0])]
    vectors = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, shard string")
    got = ann.search(ann.index(vectors), vectors.where("vec_id % 20 = 0")).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(0, 1, 1, 2.0), (0, 2, 2, 2.0), (0, 3, 9, -1.0), (0, 4, 9, -1.0)]
    none = vectors.limit(0)
    assert ann.search(ann.index(none), none).count() == 0


# --- pipeline


def test_stages(spark, tmp_path):
    """Each stage on what the one before kept, against the operators' own marks and the rules of the stage."""
    docs = documents(spark)
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    columns = docs.columns
    kept = {}
    for k, (name, step) in enumerate(corpus_pipeline.STAGES):
        out = step(spark, docs, SMALL)
        path = str(tmp_path / str(k))
        out.write.parquet(path)
        out = spark.read.parquet(path)
        before, after = {r.doc_id: r for r in docs.collect()}, out.collect()
        kept[name] = {r.doc_id for r in after}
        if name == "quality_classifier":
            marks = {r.doc_id: r.keep for r in quality.scored(docs, labels).collect()}
            assert kept[name] == {d for d, good in marks.items() if good}
        elif name == "exact_dedup":
            assert kept[name] == {r.doc_id for r in exact_dedup.groups(docs).where("kept").collect()}
        elif name == "near_dedup":
            assert kept[name] == {g[0] for g in brute_classes([(d, r.text) for d, r in before.items()])}
        elif name == "secret_scans":
            assert kept[name] == set(before)
            left = secret_scans.report(out).where("n_live > 0").count()
            assert left == 0
            assert all(before[r.doc_id].text == r.text or secret_scans.REDACTED in r.text for r in after)
        else:
            assert kept[name] == set(before)
        if name != "packing":
            assert out.columns == columns
        docs = out
    whole = corpus_pipeline.run(spark, SMALL)
    assert {r.doc_id for r in whole.collect()} == kept["packing"]


# --- helpers


def test_squeeze():
    a, b = np.arange(1000, dtype=np.uint64) << np.uint64(40), np.arange(1000, dtype=np.uint8)
    x, y = unsqueeze(squeeze(a, b), np.uint64, np.uint8)
    assert (x == a).all() and (y == b).all()
    assert all(len(z) == 0 for z in unsqueeze(squeeze(a[:0], b[:0]), np.uint64, np.uint8))


def test_blocks():
    import pyarrow as pa

    texts = ["x" * n for n in (5, 0, 30, 1, 1, 1, 90, 2)] + [None]
    batches = [pa.RecordBatch.from_pydict({"text": pa.array(texts[a : a + 4], pa.string())}) for a in range(0, len(texts), 4)]
    made = [t.column("text").to_pylist() for t in blocks(batches, size=20)]
    assert [t for part in made for t in part] == texts
    assert all(sum(len(t or "") for t in part) <= 20 or len(part) == 1 for part in made)
