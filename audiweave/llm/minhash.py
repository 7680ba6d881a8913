"""Near-duplicates by tensored MinHash banding, every link confirmed on full sets.

1. Every text becomes a set of shingle hashes; equal sets are one *class*.
2. A class has two collections of ``SIDE`` sub-keys, each of ``WIDTH`` minhashes.
   A table key combines one sub-key of either collection, so SIDE^2 tables of
   bands of 2 WIDTH minhashes cost 2 SIDE WIDTH minhashes and not SIDE^2 2 WIDTH.
   Sets of similarity s meet in a table with probability
   (1 - (1 - s^WIDTH)^SIDE)^2: 0.99998 at 0.8, 0.999999 at 0.85, 0.003 at 0.15.
   Only sub-keys that several classes hold are combined, which leaves the tables
   unchanged and most classes without any row.
3. In each bucket of a table all classes are held against its least one, on full
   sets. A bucket whose classes these links join into one group is settled.
4. The classes of the other buckets lie in tiles. Two tiles that meet in a bucket,
   and aren't of one group, are one block: a sparse product counts all overlaps.
   So every pair that meets in a bucket is confirmed, or joined already.

Pairs of a bucket are never emitted: step 3 has a row for a class and a bucket's
least class, step 4 returns a spanning forest of a block's links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audiweave.llm.components import connected_components
from audiweave.llm.jaccard_join import ROWS, TILE, class_keys, forest, overlaps
from audiweave.llm.scratch import drop, keep
from audiweave.llm.textbytes import U, chunks, mix

#: Sub-keys of each collection, and minhashes of a sub-key.
SIDE, WIDTH = 16, 3
#: Shingles that one task holds against least classes, about.
HELD = 1 << 18
_RNG = np.random.default_rng(1109)
_SEED = _RNG.integers(0, 2**63, (2 * SIDE * WIDTH, 2), dtype=np.uint64)


def sub_keys(gram: np.ndarray, count: np.ndarray) -> np.ndarray:
    """(2 SIDE) sub-keys of each non-empty set; ``gram`` has the sets one after the other."""
    first = np.cumsum(count) - count
    out = np.zeros((2 * SIDE, len(count)), U)
    for k, (add, times) in enumerate(_SEED):
        least = np.minimum.reduceat((gram ^ add) * (times | U(1)), first)
        out[k // WIDTH] = mix(out[k // WIDTH] + least + U(k))
    return out.T


def _class_rows(words: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                _, gram, count, a, b = class_keys(part.column("text"), words)
                some = count > 0
                keys = np.zeros((len(count), 2 * SIDE), U)
                if some.any():
                    keys[some] = sub_keys(gram, count[some])
                listed = pa.ListArray.from_arrays(pa.array(np.arange(len(count) + 1, dtype=np.int32) * (2 * SIDE)), pa.array(keys.view(np.int64).ravel()))
                yield pa.record_batch([part.column("doc_id"), part.column("h"), pa.array(count), pa.array(a), pa.array(b), listed], names=["doc_id", "h", "n_shingles", "a", "b", "keys"])

    return rows


def _set_rows(words: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                _, gram, count, a, b = class_keys(part.column("text"), words)
                first = np.concatenate([[0], np.cumsum(count)])
                sets = [gram[i:j].tobytes() for i, j in zip(first[:-1], first[1:], strict=True)]
                mine = (a == part.column("a").to_numpy()) & (b == part.column("b").to_numpy())
                yield pa.record_batch([pa.array(a), pa.array(count), pa.array(sets, pa.binary())], names=["a", "n", "grams"]).filter(pa.array(mine))

    return rows


def buckets(byclass: DataFrame) -> DataFrame:
    """(key, a, least): classes of every table bucket with two classes or more, and its least class."""
    slots = byclass.select("a", F.posexplode("keys").alias("slot", "key"))
    subkey = ["slot", "key"]
    met = slots.groupBy(*subkey).agg(F.min("a").alias("low"), F.max("a").alias("high")).where("low < high").select(*subkey)
    shared = slots.join(met, subkey).groupBy("a").agg(F.collect_set(F.struct(*subkey)).alias("own"))
    side = lambda first: F.filter("own", lambda x: (x["slot"] < SIDE) == F.lit(first))
    tables = F.flatten(F.transform(side(True), lambda x: F.transform(side(False), lambda y: F.xxhash64(x["slot"], x["key"], y["slot"], y["key"]))))
    keyed = shared.select("a", F.explode(tables).alias("key"))
    keyed = keep(keyed, "tables")
    full = keyed.groupBy("key").agg(F.min("a").alias("least"), F.max("a").alias("high")).where("least < high").select("key", "least")
    out = keep(keyed.join(full, "key"), "buckets")
    drop(keyed)
    return out


def _held_rows(percent: int):
    def links(table: pa.Table) -> pa.Table:
        """(u, v) of the classes that link with the least class they are held against."""
        table = table.sort_by([("least", "ascending"), ("part", "ascending"), ("head", "descending")])
        head = table.column("head").to_numpy()
        a, least = table.column("a").to_numpy(), table.column("least").to_numpy()
        grams = table.column("grams").combine_chunks() if isinstance(table.column("grams"), pa.ChunkedArray) else table.column("grams")
        sets = [np.frombuffer(x.as_py(), U) for x in grams]
        u, v = [], []
        cuts = [*np.flatnonzero(head).tolist(), len(sets)]
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            size = np.array([len(x) for x in sets[i + 1 : j]], np.int64)
            if not len(size):
                continue
            own, every = sets[i], np.concatenate(sets[i + 1 : j])
            place = np.minimum(np.searchsorted(own, every), len(own) - 1)
            both = np.bincount(np.repeat(np.arange(len(size)), size), weights=own[place] == every, minlength=len(size)).astype(np.int64)
            linked = 100 * both >= percent * (len(own) + size - both)
            u += a[i + 1 : j][linked].tolist()
            v += least[i + 1 : j][linked].tolist()
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return links


def _held_links(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Links among ``pairs`` (a, least). Rows of a least class are split by shingles, with its set in each part."""
    sized = keep(pairs.join(sets.select("a", "n"), "a"), "sized")
    load = sized.groupBy("least").agg(F.sum("n").alias("load"), F.count("*").alias("rows"))
    parts = (F.floor(F.greatest(F.col("load") / HELD, F.col("rows") / 4096)) + 1).alias("parts")
    dealt = sized.join(load.select("least", parts), "least").withColumn("part", F.pmod(F.xxhash64("a"), F.col("parts")))
    dealt = keep(dealt.select("a", "least", "part"), "held")
    total = sized.agg(F.sum("n")).first()[0] or 0
    drop(sized)
    bins = max(64, total // HELD)
    heads = dealt.select(F.col("least").alias("a"), "least", "part", F.lit(1).alias("head")).distinct()
    rows = dealt.withColumn("head", F.lit(0)).union(heads).join(sets.select("a", "grams"), "a")
    rows = rows.withColumn("bin", F.pmod(F.xxhash64("least", "part"), F.lit(bins)))
    out = keep(rows.groupBy("bin").applyInArrow(_held_rows(percent), "u long, v long"), "links")
    drop(dealt)
    return out


def _block_rows(percent: int):
    def links(table: pa.Table) -> pa.Table:
        """A spanning forest of the links of one block."""
        tile, other = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        at, name = table.column("tile").to_numpy(), table.column("a").to_numpy()
        sets = [np.frombuffer(x.as_py(), U) for x in table.column("grams")]
        li, ri = np.flatnonzero(at == tile), np.flatnonzero(at == other)
        counts = overlaps([sets[x] for x in li], [sets[x] for x in ri], percent)
        size = np.array([len(x) for x in sets])
        linked = 100 * counts >= percent * (size[li][:, None] + size[ri][None, :] - counts)
        if tile == other:
            linked = np.triu(linked, 1)
        r, c = np.nonzero(linked)
        edges = forest(li[r], ri[c], name)
        return pa.table({"u": pa.array([x for x, _ in edges], pa.int64()), "v": pa.array([y for _, y in edges], pa.int64())})

    return links


def _open_links(sets: DataFrame, met: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Links between groups of one bucket. ``met`` (key, a, least); ``groups`` (a, group) of the linked classes."""
    grouped = met.join(groups, "a", "left").withColumn("group", F.coalesce("group", "a"))
    mixed = grouped.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low < high").select("key")
    rows = keep(grouped.join(mixed, "key").select("key", "a", "least", "group"), "open")
    # classes that can meet are near in tiles: by family, by group where it fills tiles, by part
    families = connected_components(rows.where("a <> least").select(F.col("a").alias("u"), F.col("least").alias("v"))).select(F.col("node").alias("a"), F.col("label").alias("family"))
    member = rows.select("a", "group").distinct().join(families, "a").join(sets.select("a", "n"), "a")
    size = F.greatest(F.sum("n") / TILE, F.count("*") / ROWS)
    by_group = member.groupBy("family", "group").agg(size.alias("load"))
    own = F.when(F.col("load") > 0.5, F.col("group")).alias("own")
    member = member.join(by_group.select("family", "group", own), ["family", "group"])
    by_own = member.groupBy("family", "own").agg((F.floor(size) + 1).alias("parts")).withColumnsRenamed({"family": "in_family", "own": "of"})
    same = (F.col("family") == F.col("in_family")) & F.col("own").eqNullSafe(F.col("of"))
    tile = F.xxhash64("family", "own", F.pmod(F.xxhash64("a"), F.col("parts"))).alias("tile")
    tiled = keep(member.join(by_own, same).select("a", "own", tile), "tiles")
    seats = keep(rows.select("key", "a").join(tiled, "a").select("key", "tile", "own").distinct(), "seats")
    left, right = seats.select("key", F.col("tile").alias("i"), F.col("own").alias("own_i")), seats.select("key", F.col("tile").alias("j"), F.col("own").alias("own_j"))
    blocks = left.join(right, "key").where("i <= j and not coalesce(own_i = own_j, false)").select("i", "j").distinct()
    blocks = keep(blocks, "blocks")
    places = blocks.select(F.col("i").alias("tile"), "i", "j").union(blocks.where("i < j").select(F.col("j").alias("tile"), "i", "j"))
    dealt = sets.select("a", "grams").join(tiled.select("a", "tile"), "a").join(places, "tile")
    out = keep(dealt.groupBy("i", "j").applyInArrow(_block_rows(percent), "u long, v long"), "links")
    for table in (rows, tiled, seats, blocks):
        drop(table)
    return out


def near_duplicates(docs: DataFrame, words: int = 2, percent: int = 80) -> DataFrame:
    """Components of the graph that links documents of alike shingle sets.

    Takes doc_id bigint and text; other columns are ignored. Returns a row per
    input row: doc_id, n_shingles, component_id (least doc_id reachable by
    links), kept (whether doc_id is component_id). Links are those among pairs
    that meet in a table of the banding, each confirmed on full sets; a pair
    at the bound is missed with probability 2e-5, a closer one more rarely. A null or
    wordless text has an empty set and links with nothing: its component is its
    own doc_id. Rows of a null doc_id link like others but name no component
    (null where no row of the component has an id, and these are kept). Rows
    that repeat the least doc_id of their component are all kept.
    """
    texts = docs.select("doc_id", F.xxhash64("text").alias("h"), "text")
    classes = keep(texts.mapInArrow(_class_rows(words), "doc_id long, h long, n_shingles long, a long, b long, keys array<long>"), "classes")
    some = classes.where("n_shingles > 0")
    named_by = F.min(F.struct(F.isnull("doc_id").alias("void"), "doc_id", "h")).alias("by")
    byclass = keep(some.groupBy("a", "b").agg(named_by, F.min("keys").alias("keys")), "byclass")
    met = buckets(byclass)

    picked = byclass.join(met.select("a").distinct(), "a").select(F.col("by.doc_id").alias("id"), F.col("by.h").alias("t"), "a", "b")
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("h") == F.col("t"))
    sets = texts.hint("merge").join(picked, same).select("text", "a", "b").mapInArrow(_set_rows(words), "a long, n long, grams binary")
    sets = keep(sets.dropDuplicates(["a"]), "sets")

    held = _held_links(sets, met.where("a <> least").select("a", "least").distinct(), percent)
    groups = keep(connected_components(held).select(F.col("node").alias("a"), F.col("label").alias("group")), "groups")
    more = _open_links(sets, met, groups, percent)
    labels = connected_components(held.union(more)).select(F.col("node").alias("a"), "label")

    group = F.coalesce("label", "a")
    named = byclass.select("a", "b", F.col("by.doc_id").alias("first")).join(labels, "a", "left").withColumn("group", group)
    ids = named.groupBy("group").agg(F.min("first").alias("component_id"))
    named = keep(named.join(ids, "group").select("a", "b", "component_id"), "named")
    for table in (met, sets, held, groups, more, byclass):
        drop(table)
    out = classes.select("doc_id", "n_shingles", "a", "b").join(named, ["a", "b"], "left")
    out = out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 2 THEN [w[1]]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS g FROM w
), n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
o AS (SELECT x.doc_id AS u, y.doc_id AS v, count(*) AS i FROM g x JOIN g y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT u, v FROM o JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * i >= 80 * (a.n + b.n - i)),
r AS (SELECT u, u AS c FROM l UNION SELECT r.u, l.v FROM r JOIN l ON r.c = l.u),
m AS (SELECT u, min(c) AS c FROM r GROUP BY u)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.c, d.doc_id) AS component_id, coalesce(m.c, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.u = d.doc_id
"""


def op11_minhash_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
