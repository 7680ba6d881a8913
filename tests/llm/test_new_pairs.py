"""MinHash near-duplicates, centroid clusters and importance resampling against plain versions."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from compare import duck, rows

from audiweave.llm import centroids as C
from audiweave.llm import minhash as H
from audiweave.llm import resample as R
from test_pairs_and_packing import low, plain_join


def near_plain(docs, words=2, percent=80):
    return sorted([(i, n, c, i == c) for i, n, c, _ in plain_join(docs, words, percent)], key=str)


def near_rows(spark, docs):
    got = H.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    return sorted(map(tuple, got.collect()), key=str)


def edited(rng, base, most):
    text = list(base)
    for _ in range(rng.randrange(0, most + 1)):
        text[rng.randrange(len(text))] = f"n{rng.randrange(10**6)}"
    return text


@pytest.mark.parametrize("tile", [1 << 16, 100])
def test_near_copies_chains_and_sizes_near_the_bound(spark, monkeypatch, tile):
    monkeypatch.setattr(H, "TILE", tile)
    monkeypatch.setattr(H, "HELD", 4 * tile)
    rng, docs, k = random.Random(3), [], 0
    for size in (1, 2, 3, 6, 11, 12, 20, 41, 80, 133, 300):
        base = [f"w{size}x{j}" for j in range(size)]
        for _ in range(14):
            text = edited(rng, base, max(1, size // 12))
            docs.append((k, " ".join(text)))
            k += 1
            base = text if rng.random() < 0.5 else base
    docs += [(None, docs[5][1]), (k, docs[7][1].upper()), (k, docs[9][1]), (k + 1, "  "), (k + 2, None)]
    assert near_rows(spark, docs) == near_plain(docs)


@pytest.mark.parametrize("tile", [1 << 16, 200])
def test_classes_that_meet_but_do_not_link_with_the_least(spark, monkeypatch, tile):
    """Pairs at 60 to 80 % meet in tables: what links only apart from a bucket's least class must be found in blocks."""
    monkeypatch.setattr(H, "TILE", tile)
    rng, docs, k = random.Random(5), [], 0
    shared = [f"s{j}" for j in range(75)]
    for family in range(8):
        own = [f"f{family}w{j}" for j in range(25)]
        for _ in range(9):
            docs.append((k, " ".join(shared + edited(rng, own, 4))))
            k += 1
    docs += [(k + j, " ".join(shared + [f"z{j}y{i}" for i in range(25)])) for j in range(20)]
    rng.shuffle(docs)
    assert near_rows(spark, docs) == near_plain(docs)


def test_op11_equals_sql(spark, sf_dir):
    assert rows(H.op11_minhash_dedup(spark, sf_dir).toPandas()) == rows(duck(sf_dir, H.ORACLE))


def test_op11_edges(spark, edges, empty):
    got = H.near_duplicates(edges).collect()
    docs = [(r.doc_id, r.text) for r in edges.collect()]
    assert sorted(map(tuple, got), key=str) == near_plain(docs)
    assert H.near_duplicates(empty).count() == 0


def test_sub_keys_meet_as_often_as_said():
    rng = np.random.default_rng(2)
    for s, low_bound, high in ((0.8, 0.99, 1.0), (0.15, 0.0, 0.05)):
        n, both = 600, 0
        for _ in range(200):
            share = round(2 * n * s / (1 + s)) if s < 1 else n
            x = rng.integers(0, 2**63, 2 * n - share, dtype=np.uint64)
            keys = H.sub_keys(np.concatenate([x[:n], x[n - share :]]), np.array([n, n]))
            same = keys[0] == keys[1]
            both += same[: H.SIDE].any() and same[H.SIDE :].any()
        assert low_bound <= both / 200 <= high


def cluster_plain(vectors, k=8, rounds=10):
    kept = [(i, [math.floor(1024 * float(v)) for v in x]) for i, x in vectors if x is not None and len(x) == 64 and all(v is not None and math.isfinite(v) for v in x)]
    bound = lambda v: max(-C.LARGEST, min(C.LARGEST, v))
    kept = [(i, [bound(v) for v in x]) for i, x in kept]
    start = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))[:k]
    cents = [x for _, x in start]
    square = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c, strict=True))
    nearest = lambda: [min((square(x, c), j) for j, c in enumerate(cents)) for _, x in kept]
    for _ in range(rounds):
        at = [j for _, j in nearest()]
        for j in range(len(cents)):
            own = [x for (_, x), c in zip(kept, at, strict=True) if c == j]
            if own:
                cents[j] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    last = nearest()
    per = collections.Counter()
    for d, j in last:
        per[j] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    fits = lambda n: n if n < 1 << 63 else None
    return sorted([(i, j, d, fits(per[j]), fits(sum(per.values())), digest[j]) for (i, _), (d, j) in zip(kept, last, strict=True)], key=str)


VECTORS = "label string, vec_id long, embedding array<double>, cluster int, x double"


def test_clusters_with_ties_copies_and_odd_vectors(spark):
    rng = random.Random(8)
    vectors = [(k, [rng.gauss(k % 5, 0.3) for _ in range(64)]) for k in range(150)]
    vectors += [(200 + k, vectors[0][1]) for k in range(60)] + [(7, vectors[7][1]), (None, vectors[9][1]), (None, vectors[3][1])]
    vectors += [(300, None), (301, []), (302, [1.0] * 63), (303, [1.0] * 65), (304, [1.0] * 63 + [None]), (305, [float("nan")] * 64), (306, [float("inf")] + [0.0] * 63), (307, [0.0] * 64), (308, [-0.0] * 64)]
    df = spark.createDataFrame([("n", i, x, 1, None) for i, x in vectors], VECTORS)
    got = C.cluster_vectors(df)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == cluster_plain(vectors)


def test_clusters_of_few_empty_and_huge_vectors(spark):
    few = [(1, [1.0] * 64), (2, [2.0] * 64), (2, [2.0] * 64)]
    df = spark.createDataFrame([("n", i, x, 1, None) for i, x in few], VECTORS)
    assert sorted(map(tuple, C.cluster_vectors(df).collect()), key=str) == cluster_plain(few)
    assert C.cluster_vectors(df.limit(0)).count() == 0
    huge = [(k, [(-1) ** (k + j) * 10.0 ** (k + 2) for j in range(64)]) for k in range(12)] + [(20, [1e300] * 64), (21, [-1e300] * 64)]
    df = spark.createDataFrame([("n", i, x, 1, None) for i, x in huge], VECTORS)
    assert sorted(map(tuple, C.cluster_vectors(df).collect()), key=str) == cluster_plain(huge)


def test_incremental_dots_are_exact():
    rng = np.random.default_rng(4)
    x, old, new = rng.integers(-(2**27), 2**27, (50, 64)), rng.integers(-(2**27), 2**27, (8, 64)), rng.integers(-(2**27), 2**27, (8, 64))
    new[:, ::3] = old[:, ::3]
    assert (C.moved_dots(x @ old.T, x, new - old) == x @ new.T).all()


def test_op12_equals_sql(spark, sf_dir):
    assert rows(C.op12_centroid_clusters(spark, sf_dir).toPandas()) == rows(duck(sf_dir, C.ORACLE))


def resample_plain(docs, target):
    def features(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))
        return len(w), [zlib.crc32(f.encode()) % 10000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]]

    own, other = [features(t) for _, t in docs], [features(t) for t in target]
    s, t = (collections.Counter(b for _, f in x for b in f) for x in (own, other))
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in range(10000)]
    out = []
    for (i, _), (n, f) in zip(docs, own, strict=True):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= 20])
    drawn = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[2], r[1]))
    rank = {id(r): k + 1 for k, r in enumerate(drawn[: 25 * len(drawn) // 100])}
    return sorted([(*r[:4], rank.get(id(r))) for r in out], key=str)


def test_op13_equals_plain(spark, sf_dir):
    got = R.op13_importance_resampling(spark, sf_dir)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and all(k == "bigint" for _, k in got.dtypes)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert sorted(map(tuple, got.collect()), key=str) == resample_plain(docs, target)


@pytest.mark.parametrize("samples", [1 << 20, 40])
def test_resampling_of_ties_copies_and_null_ids(spark, monkeypatch, samples):
    monkeypatch.setattr(R, "SAMPLES", samples)
    rng = random.Random(6)
    same = "same text " * 15
    docs = [(k, " ".join(rng.choice("ab cd é😀 Ef 12 g-h".split()) for _ in range(rng.randrange(0, 60)))) for k in range(300)]
    docs += [(None, same)] * 200 + [(5, same)] * 100 + [(900, None), (901, ""), (902, "x" * 5000 + " y"), (903, "word " * 30_000)]
    rng.shuffle(docs)
    target = ["ab ab cd", None, "", "é😀 12"]
    got = R.resample(spark.createDataFrame(docs, "doc_id long, text string").repartition(7), spark.createDataFrame([(t,) for t in target], "text string"))
    assert sorted(map(tuple, got.collect()), key=str) == resample_plain(docs, target)


def test_op13_edges(spark, edges, empty):
    docs = [(r.doc_id, r.text) for r in edges.collect()]
    assert sorted(map(tuple, R.resample(edges, edges).collect()), key=str) == resample_plain(docs, [t for _, t in docs])
    assert R.resample(empty, edges).count() == 0
    assert sorted(map(tuple, R.resample(edges, empty).collect()), key=str) == resample_plain(docs, [])


def test_crc_of_features_of_any_length():
    words = ["a", "é" * 80, "b" * (R.LONG + 1), "c" * R.LONG, "d1"]
    row, bucket, n = R.feature_buckets(pa.array([" ".join(words), None, "A--b"]), 3, 1 << 31)
    runs = [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)] + ["a", "b", "a b"]
    assert sorted(bucket.tolist()) == sorted(zlib.crc32(x.encode()) % (1 << 31) for x in runs) and n.tolist() == [5, 0, 2]
    assert row.tolist().count(1) == 0


def test_splitters_cut_equal_segments():
    runs = [sorted(random.Random(k).sample(range(10**6), 4000)) for k in range(9)]
    samples = [((v,), 40) for run in runs for v in run[::40]]
    cuts = R.splitters(samples, 20)
    every = sorted(v for run in runs for v in run)
    sizes = np.diff([0, *(np.searchsorted(every, c[0]) for c in cuts), len(every)])
    assert len(cuts) == 19 and sizes.max() < 2 * len(every) / 20
