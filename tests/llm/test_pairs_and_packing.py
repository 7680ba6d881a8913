"""N-gram Jaccard join and best-fit packing against plain versions."""

import random
import re
import zlib

import numpy as np
import pytest
from compare import duck, rows

from audiweave.llm import components
from audiweave.llm import jaccard_join as J
from audiweave.llm import packing as K
from audiweave.llm.components import connected_components
from audiweave.llm.textbytes import U


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_join(docs, n=3, percent=90):
    sets = []
    for _, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", low(t))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set()))
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * len(docs)
    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    out = []
    for k, (i, _) in enumerate(docs):
        own = [docs[j][0] for j in range(len(docs)) if find(j) == find(k) and docs[j][0] is not None]
        out.append((i, len(sets[k]), (min(own) if own else None) if sets[k] else i, links[k]))
    return sorted(out, key=str)


def test_op4_equals_sql(spark, sf_dir):
    assert rows(J.op4_jaccard_join(spark, sf_dir).toPandas()) == rows(duck(sf_dir, J.ORACLE))


@pytest.mark.parametrize("tile", [1 << 16, 60])
def test_join_of_copies_chains_and_sizes_near_the_bound(spark, monkeypatch, tile):
    monkeypatch.setattr(J, "TILE", tile)
    rng = random.Random(1)
    docs, k = [], 0
    for size in (3, 9, 10, 11, 12, 19, 20, 21, 22, 40, 41, 80, 95, 133):
        base = [f"w{size}x{j}" for j in range(size + 2)]
        for _ in range(12):
            text = list(base)
            for _ in range(rng.randrange(0, 3)):
                text[rng.randrange(len(text))] = f"n{rng.randrange(10**6)}"
            cut = rng.randrange(0, max(1, size // 8) + 1)
            docs.append((k, " ".join(text[: len(text) - cut])))
            k += 1
            base = text if rng.random() < 0.4 else base
    docs += [(None, docs[5][1]), (k, docs[7][1].upper()), (k, docs[9][1]), (k + 1, "  "), (k + 2, None)]
    got = J.jaccard_join(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=str) == plain_join(docs)


def passages():
    """Unlike texts with a common passage, and near copies between the limits of op4 and those of the pipeline."""
    rng = random.Random(4)
    shared = " ".join(f"s{j}" for j in range(30))
    docs = []
    for k in range(60):
        own = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice((4, 30, 80)))]
        docs.append((3 * k, " ".join(own) + " " + shared))
        if k % 3 == 0:
            for i in (1, 2):
                own = [x if rng.random() > 0.02 else f"n{rng.randrange(10**6)}" for x in own]
                docs.append((3 * k + i, " ".join(own) + " " + shared))
    return docs


def test_join_at_five_words_and_80_percent(spark):
    docs = passages()
    got = sorted(map(tuple, J.jaccard_join(spark.createDataFrame(docs, "doc_id long, text string"), words=5, percent=80).collect()), key=str)
    assert got == plain_join(docs, 5, 80) != plain_join(docs)


def test_stage_drops_near_copies_of_80_percent(spark):
    import corpus_pipeline

    docs = passages()
    own = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(docs, "doc_id long, text string"), "")
    stay = [i for i, _, c, _ in plain_join(docs, 5, 80) if i == c]
    assert sorted(r.doc_id for r in own.collect()) == sorted(stay)
    assert len(stay) < sum(i == c for i, _, c, _ in plain_join(docs))


def chosen(spark, docs, words, percent):
    """(classes, candidates, families) of the join's own steps."""
    from pyspark.sql import functions as F

    texts = spark.createDataFrame(docs, "doc_id long, text string").withColumn("h", F.xxhash64("text"))
    classes = texts.select("doc_id", "h", "text").mapInArrow(J._class_rows(words), "doc_id long, h long, n_shingles long, a long, b long")
    byclass = J.keep(classes.where("n_shingles > 0").selectExpr("a", "b", "h", "n_shingles as n").distinct(), "byclass")
    met = J.keep(J.candidates(texts, byclass, words, percent), "met")
    sets = texts.join(met.select("h", "a", "b"), "h").select("text", "a", "b").mapInArrow(J._set_rows(words), "a long, b long, n long, grams binary")
    return byclass.count(), met.count(), J.families(J.keep(sets, "sets"), percent)[0].groupBy("family").count().collect()


@pytest.mark.parametrize("words, percent", [(3, 90), (5, 80)])
def test_unlike_texts_are_no_candidates_and_no_family(spark, words, percent):
    rng = random.Random(8)
    shared = " ".join(f"s{j}" for j in range(40))
    own = lambda n: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    few = [own(rng.choice((9, 100, 1000))) for _ in range(3000)] + [own(400) + " " + shared for _ in range(500)]
    n, met, families = chosen(spark, list(enumerate(few)), words, percent)
    assert (n, met, families) == (3500, 0, [])
    # most of these is a passage in common, so they stay candidates; counts tell them apart
    n, met, families = chosen(spark, list(enumerate(own(12) + " " + shared for _ in range(300))), words, percent)
    assert met > 250 and families == []


def test_common_shingles_leave_a_chunk_in_few_rows(monkeypatch):
    gram, a = np.repeat(np.arange(5, dtype=U), 1000), np.tile(np.arange(1, 1001), 5)
    key, shingle, owner, weight = J.counted_rows(gram, a)
    assert len(key) == 5005 and len(np.unique(key)) == 5005 and (weight[owner == 0] == -J.COMMON).all()
    doc = np.repeat(np.arange(1000), 5)
    key, owner, known = J.shared_prefixes(doc, np.tile(np.arange(5, dtype=U), 1000), np.full(1000, 5), np.arange(1, 1001), 80)
    assert (known > 0).sum() == 1000 and (known == 0).sum() == 2 * len(np.unique(key[known == 0]))


def test_token_rows_hold_a_shingle_once():
    """Only a common shingle, whose rows leave under other keys, is written beside its key."""
    import pyarrow as pa

    sets = [np.arange(k, k + 5 + k % 2, dtype=U) for k in range(0, 1000, 5)] + [np.array([7], U)] * J.COMMON
    batch = pa.record_batch([pa.array(range(1, len(sets) + 1)), pa.array([x.tobytes() for x in sets])], names=["a", "grams"])
    own = [r for x in J._token_rows(iter([batch])) for r in x.to_pylist()]
    told = [(r["gram"] if r["gram"] is not None else r["key"], r["a"]) for r in own if r["weight"] > 0]
    assert sorted(told) == sorted((int(g), a) for a, x in enumerate(sets, 1) for g in x)
    assert sum(r["gram"] is not None for r in own) == J.COMMON + 1


def test_a_kept_step_leaves_no_shuffle_files(spark):
    """They don't wait for the driver's garbage collection, and the session's setting is as before."""
    import glob
    import time

    from pyspark.sql import functions as F

    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*.data")}
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    counts = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count().repartition(3, "count")
    before, own = files(), spark.conf.get(setting)
    counts.collect()
    assert files() - before, "this test looks in other folders than Spark's"
    before |= files()
    kept = J.keep(counts, "counts")
    end = time.time() + 5
    while files() - before and time.time() < end:
        time.sleep(0.1)
    assert not files() - before and spark.conf.get(setting) == own and kept.count() == 100


def test_tiles_that_share_no_first_shingle_make_no_block(spark):
    """A family chained link by link: blocks are as many as shared shingles, not as pairs of its tiles."""
    from pyspark.sql import functions as F

    tiled = spark.range(4000).select(F.col("id").alias("a"), F.lit(7).cast("long").alias("family"), F.floor(F.col("id") / 10).alias("tile"), F.lit(50).cast("long").alias("n"))
    early = spark.range(4000).select(F.col("id").alias("a"), F.explode(F.array("id", F.col("id") + 1)).alias("gram"))
    got = J.tile_pairs(tiled, early, 90)
    assert sorted(tuple(r)[1:] for r in got.collect()) == sorted([(k, k) for k in range(400)] + [(k, k + 1) for k in range(399)])
    small = tiled.withColumn("n", F.when(F.col("tile") % 2 == 0, 50).otherwise(20).cast("long"))
    assert J.tile_pairs(small, early, 90).where("i <> j").isEmpty()


def test_join_edges(edges, empty):
    docs = [tuple(r)[:2] for r in edges.collect()]
    assert sorted(map(tuple, J.jaccard_join(edges).collect()), key=str) == plain_join(docs)
    assert J.jaccard_join(empty).count() == 0


def test_overlaps_in_small_column_blocks(monkeypatch):
    monkeypatch.setattr(J, "COLUMNS", 64)
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 500, 300).astype(U)) for _ in range(6)]
    sets += [np.unique(np.concatenate([sets[0][:-3], [U(900), U(901)]]))]
    got = J.overlaps(sets, sets, 90)
    for a in range(7):
        for b in range(7):
            true = len(np.intersect1d(sets[a], sets[b]))
            assert got[a, b] <= true
            if 100 * true >= 90 * (len(sets[a]) + len(sets[b]) - true):
                assert got[a, b] == true


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (5, 5), (None, 1), *((k, k + 1) for k in range(100, 140))]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8, **{k: 100 for k in range(100, 141)}}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_a_round_of_components_reads_its_edges_four_times(spark, tmp_path):
    """Each star reads what it ties for the least and for the join with it. Plans of 16 reads filled the driver's memory."""
    spark.createDataFrame([(1, 2), (2, 3)], "u long, v long").write.parquet(f"{tmp_path}/edges")
    star = components._small_star(components._large_star(spark.read.parquet(f"{tmp_path}/edges")))
    assert sorted(map(tuple, star.collect())) == [(2, 1), (3, 1)]
    assert star._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 4


def plain_pieces(docs, capacity=2048):
    import public_tokenizers
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = []
    for i, t in docs:
        ids = [*coder.encode(t or "", add_special_tokens=False).ids, 0]
        cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
        out += [(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    return sorted(out, key=str)


def hold(packed, capacity=2048):
    """Pieces fill their sequences from 0 without a gap and within capacity."""
    for _, own in packed.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own["offset"].tolist() == [0, *own["length"].cumsum().tolist()[:-1]] and own["length"].sum() <= capacity


def test_op3_ids_equal_those_of_tokenizers(spark, sf_dir):
    got = K.op3_best_fit_packing(spark, sf_dir).toPandas()
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got[names].values.tolist()), key=str) == plain_pieces(docs)
    hold(got)
    assert got["sequence_id"].nunique() <= got["length"].sum() / 2048 * 1.02 + 1


def test_packing_edges(edges, empty):
    got = K.pack(edges).toPandas()
    docs = [tuple(r)[:2] for r in edges.collect()] + []
    own = got.astype(object).where(got.notna(), None)
    assert sorted((tuple(None if x is None else int(x) for x in r) for r in own[["doc_id", "piece", "start", "length", "ids_crc32"]].values.tolist()), key=str) == plain_pieces(docs)
    hold(got)
    assert K.pack(empty).count() == 0


def test_ids_of_random_texts_with_markers_equal_those_of_tokenizers(spark):
    rng = random.Random(5)
    signs = ["<|endoftext|>", "<|endoftext", "|>", " ", "  ", "\n", "é", "😀", "don't", "a1b2", "WORD", "word", "12345", "\t", "ß", "<", "'ll", "\u00a0", "中文"]
    docs = [(k, "".join(rng.choices(signs, k=rng.randrange(0, 40)))) for k in range(400)]
    got = K.token_pieces(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=str) == plain_pieces(docs)


def test_pack_gives_added_tokens_the_ids_of_tokenizers(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, f"{end}{end} ", f"x{end}y", f"  {end}\n\n{end}é", "<|endoftext", f"<|endo{end}ftext|>", "plain text"]
    got = {r.doc_id: (r.length, r.ids_crc32) for r in K.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    ids = [[*coder.encode(t, add_special_tokens=False).ids, 0] for t in texts]
    assert got == {k: (len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for k, x in enumerate(ids)}
    assert ids[0] == [64, 220, 50256, 275, 0]


def test_plan_is_best_fit():
    rng = random.Random(3)
    counts = {rng.randrange(1, 101): rng.randrange(1, 50) for _ in range(40)}
    bins = []
    for n in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
        fit = min((r for r in bins if r >= n), default=None)
        if fit is not None:
            bins.remove(fit)
        bins.append((100 if fit is None else fit) - n)
    used = {s + x // per for _, _, n, per, s, _ in K.plan_slots(counts, 100) for x in range(n)}
    assert len(used) == len(bins)


def test_ids_of_long_blank_runs_equal_those_of_tokenizers(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    slow, encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), K.encoder(K.tokenizer_path(), K.added_tokens())
    for text in (" " * 1_000_000, "\n" * 1_000_000, " " * 1_000_000 + "a<|endoftext|>b", "a" + "\t" * K.BLANKS + "b", "a" + " \r\n" * K.BLANKS, " " * (K.BLANKS - 1) + "x", "0" * 1_000_000):
        assert encode(text) == slow.encode(text, add_special_tokens=False).ids
    got = K.pack(spark.createDataFrame([(1, " " * 1_000_000), (2, "a")], "doc_id long, text string")).collect()
    assert sum(r.length for r in got if r.doc_id == 1) == 1_000_001
