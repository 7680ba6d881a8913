"""N-gram Jaccard join by blocked sparse matrix products.

1. Every text becomes a set of shingle hashes. Equal sets are one *class*, so
   a group of exact copies costs one set, however large.
2. A set of n shingles links only with sets that lack at most
   ``lack = n - ceil(percent n / 100)`` of them. In the order of hashes, two
   linking sets share ``spare`` of the first lack + spare shingles of either
   (prefix filter). Classes that share fewer with all others are done.
3. Shingles of the rest are counted exactly over all of these. One that a single
   class holds is lacked by every other, so a class with more than ``lack`` of
   them is done too. In the order of counts, rare ones first, linking sets share
   one of their first lack + 1; classes that do are put in one *family*.
4. Within a family, classes of about one size form tiles of bounded rows and
   shingles. A pair of tiles whose sizes can link, and which share one of those
   first shingles, is one block: the product of the two sparse document by shingle
   incidence matrices is accumulated over column blocks, and pairs that can't
   reach their size-derived bound are discarded.
5. Blocks return a spanning forest of their links, never the pairs. Its
   components are the components of the join.

No step holds a whole group: a shingle that many classes of a chunk of texts
share is counted there, and few rows of it leave the chunk.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from audiweave.llm.components import connected_components
from audiweave.llm.scratch import drop, keep
from audiweave.llm.textbytes import U, chunks, mix, shingle_sets

#: Shingles and classes of one tile, about.
TILE, ROWS = 1 << 16, 512
#: Shingles of one column block of a product, about.
COLUMNS = 1 << 17
#: Counts from here on are one in the order of shingles.
COMMON = 16
#: Parts of a common shingle's classes that tasks tie together.
SALTS = 64
#: Bytes of text whose shingles are counted together before they leave a task.
CHUNK = 1 << 21


def lack(n, percent: int):
    """Shingles of a set of ``n`` that a linking set may lack."""
    return n - -(-percent * n // 100)


def spare(n, percent: int):
    """Shingles of its longer prefix that a set of ``n`` shares with a linking set, at least; never falls as n grows."""
    return np.minimum(1 + n // 8, n - lack(n, percent))


def _fresh(seen: set[int], a: np.ndarray) -> np.ndarray:
    """Classes that this partition hasn't met yet: copies add nothing."""
    return np.array([not (x in seen or seen.add(x)) for x in a.tolist()], dtype=bool)


def class_keys(column: pa.Array, n: int) -> tuple[np.ndarray, ...]:
    doc, gram = shingle_sets(column, n)
    count = np.bincount(doc, minlength=len(column)).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(count)])
    sums = []
    for salt in (0x51ED270B0A1F39C1, 0x2545F4914F6CDD1D):
        total = np.concatenate([[U(0)], np.cumsum(mix(gram ^ U(salt)), dtype=U)])
        sums.append(mix(total[first[1:]] - total[first[:-1]] + count.astype(U)))
    return doc, gram, count, sums[0].view(np.int64), sums[1].view(np.int64)


def _class_rows(n: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                _, _, count, a, b = class_keys(part.column("text"), n)
                yield pa.record_batch([part.column("doc_id"), part.column("h"), pa.array(count), pa.array(a), pa.array(b)], names=["doc_id", "h", "n_shingles", "a", "b"])

    return rows


def _order(gram: np.ndarray) -> np.ndarray:
    return mix(gram + U(0x1B873593))


def shared_prefixes(doc: np.ndarray, gram: np.ndarray, count: np.ndarray, a: np.ndarray, percent: int) -> tuple[np.ndarray, ...]:
    """(key, class, known) of the sets of one chunk.

    Prefix shingles that several of the sets hold are known to be shared: each
    class has a row of how many of its own are (under a key of its own), and
    two rows of such a shingle stand for all, so that every class elsewhere
    meets another than itself. Shingles of one set have a row.
    """
    order = np.lexsort((_order(gram), doc))
    doc, gram = doc[order], gram[order]
    first = np.cumsum(count) - count
    early = np.arange(len(doc)) - first[doc] < (lack(count, percent) + spare(count, percent))[doc]
    doc, gram = doc[early], gram[early]
    order = np.argsort(gram, kind="stable")
    doc, gram = doc[order], gram[order]
    new = np.ones(len(gram), dtype=bool)
    new[1:] = gram[1:] != gram[:-1]
    group = np.cumsum(new) - 1
    size = np.bincount(group)[group]
    place = np.arange(len(gram)) - np.flatnonzero(new)[group]
    known = np.bincount(doc[size > 1], minlength=len(a))
    some = np.flatnonzero(known)
    sent = place < 2
    key = np.concatenate([gram[sent], mix(a[some].view(U) ^ U(0x632BE59BD9B4E019))])
    return key.view(np.int64), np.concatenate([a[doc[sent]], a[some]]), np.concatenate([np.zeros(int(sent.sum()), np.int64), known[some]])


def _prefix_rows(n: int, percent: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in chunks(batch, "text", CHUNK):
                doc, gram, count, a, _ = class_keys(part.column("text"), n)
                new = _fresh(seen, a)
                doc, gram, count = doc[new[doc]], gram[new[doc]], np.where(new, count, 0)
                yield pa.record_batch([pa.array(x) for x in shared_prefixes(doc, gram, count, a, percent)], names=["key", "a", "known"])

    return rows


def _set_rows(n: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                _, gram, count, a, b = class_keys(part.column("text"), n)
                first = np.concatenate([[0], np.cumsum(count)])
                sets = [gram[i:j].tobytes() for i, j in zip(first[:-1], first[1:], strict=True)]
                mine = (a == part.column("a").to_numpy()) & (b == part.column("b").to_numpy())
                yield pa.record_batch([pa.array(a), pa.array(b), pa.array(count), pa.array(sets, pa.binary())], names=["a", "b", "n", "grams"]).filter(pa.array(mine))

    return rows


def counted_rows(gram: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, ...]:
    """(key, shingle, class, weight) of the sets of one chunk, a row for each shingle of a class.

    A shingle that ``COMMON`` classes hold here is common everywhere: its rows
    leave under keys of their own with that weight, and one row without a class
    (0, weight -COMMON) tells it to the rows of other chunks.
    """
    order = np.argsort(gram, kind="stable")
    gram, a = gram[order], a[order]
    new = np.ones(len(gram), dtype=bool)
    new[1:] = gram[1:] != gram[:-1]
    group = np.cumsum(new) - 1
    common = np.bincount(group)[group] >= COMMON if len(group) else new
    key = np.where(common, mix(mix(gram) ^ a.view(U)), gram)
    told = gram[common & new]
    weight = np.where(common, COMMON, 1)
    none = np.zeros(len(told), np.int64)
    return tuple(np.concatenate(x) for x in ((key.view(np.int64), told.view(np.int64)), (gram.view(np.int64), told.view(np.int64)), (a, none), (weight, none - COMMON)))


def _token_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, "grams", 2 * CHUNK):
            own = part.column("grams").to_pylist()
            gram = np.frombuffer(b"".join(own), U)
            a = np.repeat(part.column("a").to_numpy(), [len(x) // 8 for x in own])
            key, gram, a, weight = counted_rows(gram, a)
            # most shingles are their own key: written once
            yield pa.record_batch([pa.array(key), pa.array(gram, mask=gram == key), pa.array(a), pa.array(weight)], names=["key", "gram", "a", "weight"])


def overlaps(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    """Overlap counts of two lists of sets, accumulated over column blocks.

    The incidence matrices stay sparse: (column, row) entries sorted by column.
    A column block is multiplied entry by entry where few rows hold its columns,
    and as a small dense product where many do. Between blocks, rows all of
    whose pairs fall short of their bound are left out; they keep a lower count.
    """
    nl, nr = np.array([len(x) for x in left], np.int64), np.array([len(x) for x in right], np.int64)
    column = np.concatenate([*left, *right])
    row = np.repeat(np.arange(len(left) + len(right)), np.concatenate([nl, nr]))
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    new = np.ones(len(column), dtype=bool)
    new[1:] = column[1:] != column[:-1]
    column = np.cumsum(new) - 1
    at_left = row < len(left)
    ls, rs = np.bincount(column[at_left], minlength=column[-1] + 1), np.bincount(column[~at_left], minlength=column[-1] + 1)
    both = (ls > 0) & (rs > 0)
    # rare columns first: they discard most pairs at least cost
    rank = np.argsort(np.where(both, ls * rs, 0), kind="stable")
    place = np.empty_like(rank)
    place[rank] = np.arange(len(rank))
    own = both[column]
    column, row = place[column[own]], row[own]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    need = -(-percent * (nl[:, None] + nr[None, :]) // (100 + percent))
    counts = np.zeros((len(left), len(right)), np.int64)
    rest = np.bincount(row, minlength=len(left) + len(right))
    alive = np.ones(len(rest), dtype=bool)
    start = 0
    while start < len(column):
        can = counts + np.minimum(rest[: len(left), None], rest[None, len(left) :]) >= need
        alive[: len(left)] &= can.any(axis=1)
        alive[len(left) :] &= can.any(axis=0)
        if not alive.any():
            break
        end = int(np.searchsorted(column, column[min(start + COLUMNS, len(column)) - 1], side="right"))
        r, c = row[start:end], column[start:end]
        rest = rest - np.bincount(r, minlength=len(rest))
        r, c = r[alive[r]], c[alive[r]]
        _add_block(counts, r, c, len(left))
        start = end
    return counts


def _add_block(counts: np.ndarray, row: np.ndarray, column: np.ndarray, nl: int) -> None:
    """Adds the product of one column block, given as entries sorted by column."""
    if not len(row):
        return
    new = np.ones(len(column), dtype=bool)
    new[1:] = column[1:] != column[:-1]
    column = np.cumsum(new) - 1
    at_left = row < nl
    lr, lc, rr, rc = row[at_left], column[at_left], row[~at_left] - nl, column[~at_left]
    ls, rs = np.bincount(lc, minlength=column[-1] + 1), np.bincount(rc, minlength=column[-1] + 1)
    wide = ls * rs > 64
    first = np.cumsum(rs) - rs
    thin = ~wide[lc]
    times = rs[lc[thin]]
    entry = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(first[lc[thin]], times)
    pair = np.repeat(lr[thin], times) * counts.shape[1] + rr[entry]
    counts += np.bincount(pair, minlength=counts.size).reshape(counts.shape)
    used = np.flatnonzero(wide)
    if len(used):
        name = np.zeros(len(wide), np.int64)
        name[used] = np.arange(len(used))
        hl, hr = np.unique(lr[wide[lc]]), np.unique(rr[wide[rc]])
        for lo in range(0, len(used), 2048):
            width = min(2048, len(used) - lo)
            dense = []
            for own, r, c in ((hl, lr, lc), (hr, rr, rc)):
                some = wide[c]
                some[some] = (name[c[some]] >= lo) & (name[c[some]] < lo + width)
                m = np.zeros((len(own), width), np.float32)
                m[np.searchsorted(own, r[some]), name[c[some]] - lo] = 1
                dense.append(m)
            counts[np.ix_(hl, hr)] += (dense[0] @ dense[1].T).astype(np.int64)


def forest(rows: np.ndarray, cols: np.ndarray, names: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of links between positions."""
    root = np.arange(len(names))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for x, y in zip(rows.tolist(), cols.tolist(), strict=True):
        p, q = find(x), find(y)
        if p != q:
            root[q] = p
            out.append((int(names[x]), int(names[y])))
    return out


def _block(percent: int):
    def links(table: pa.Table) -> pa.Table:
        """Forest edges (u, v, 0) and link counts (u, null, links) of one block."""
        tile, other = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        table = table.sort_by([("a", "ascending")])
        at, name = table.column("tile").to_numpy(), table.column("a").to_numpy()
        new = np.ones(len(name), dtype=bool)
        new[1:] = name[1:] != name[:-1]
        copies = table.column("copies").to_numpy()
        sets = [np.frombuffer(x.as_py(), U) for x in table.column("grams")]
        li, ri = np.flatnonzero(new & (at == tile)), np.flatnonzero(new & (at == other))
        counts = overlaps([sets[x] for x in li], [sets[x] for x in ri], percent)
        size = np.array([len(x) for x in sets])
        linked = 100 * counts >= percent * (size[li][:, None] + size[ri][None, :] - counts)
        if tile == other:
            np.fill_diagonal(linked, False)
        r, c = np.nonzero(linked)
        edges = forest(li[r], ri[c], name)
        u, v, k = [x for x, _ in edges], [y for _, y in edges], [0] * len(edges)
        sides = [(li, linked @ copies[ri])] + ([] if tile == other else [(ri, linked.T @ copies[li])])
        for own, total in sides:
            some = total > 0
            u += name[own[some]].tolist()
            v += [None] * int(some.sum())
            k += total[some].tolist()
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64()), "links": pa.array(k, pa.int64())})

    return links


def candidates(texts: DataFrame, byclass: DataFrame, words: int, percent: int) -> DataFrame:
    """Classes of ``byclass`` that share enough of their longer prefix with others. A shingle's classes are met by the least
    and greatest of them; a shingle of every chunk has two rows of each. The rows are dealt by shingle once, for these and for the
    join with them: a partial aggregate of shingles that hardly repeat would only write them a second time."""
    rows = keep(texts.select("text").mapInArrow(_prefix_rows(words, percent), "key long, a long, known long"), "prefixes")
    single, known = rows.where("known = 0").select("key", "a"), rows.where("known > 0").select("a", F.col("known").alias("k"))
    # neither is ever null; both sides of the join say so, or their plans would differ and deal the rows twice
    single = single.where("key is not null and a is not null").repartition("key")
    met = single.groupBy("key").agg(F.min("a").alias("low"), F.max("a").alias("high")).where("low < high").select("key")
    shared = single.join(met.hint("merge"), "key").distinct().groupBy("a").agg(F.count("*").alias("k")).union(known)
    shared = shared.groupBy("a").agg(F.sum("k").alias("k"))
    partner = F.ceil(F.col("n") * percent / 100)
    least = F.least(1 + F.floor(partner / 8), F.ceil(partner * percent / 100))
    out = keep(byclass.join(shared, "a").where(F.col("k") >= least).drop("k"), "candidates")
    drop(rows)
    return out


def families(sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(a, family): classes that share a shingle among their first in the order of exact counts; and (a, gram), these shingles."""
    rows = keep(sets.select("a", "grams").mapInArrow(_token_rows, "key long, gram long, a long, weight long"), "tokens")
    total = rows.groupBy("key").agg(F.sum(F.abs("weight")).alias("total")).where("total > 1")
    shared = rows.where("weight > 0").join(total, "key").select("a", F.coalesce("gram", "key").alias("gram"), F.least("total", F.lit(COMMON)).cast("int").alias("rank"))
    by_class = Window.partitionBy("a")
    placed = shared.withColumns({"own": F.count("*").over(by_class), "at": F.row_number().over(by_class.orderBy("rank", F.xxhash64("gram"), "gram"))})
    lacking = F.col("n") - F.ceil(F.col("n") * percent / 100)
    alone = F.col("n") - F.col("own")
    early = placed.join(sets.select("a", "n"), "a").where(F.col("at") <= lacking + 1 - alone)
    early = keep(early.select("a", "gram"), "early")
    # the classes of a shingle are tied to the least of their part, and these to the least of all, so a common one is no single task
    parted = early.withColumn("part", F.pmod(F.xxhash64("a"), F.lit(SALTS)))
    parts = parted.groupBy("gram", "part").agg(F.min("a").alias("v"))
    tops = parts.groupBy("gram").agg(F.min("v").alias("w"))
    edges = parted.join(parts, ["gram", "part"]).select(F.col("a").alias("u"), "v").union(parts.join(tops, "gram").select(F.col("v").alias("u"), F.col("w").alias("v")))
    edges = keep(edges.where("u <> v").distinct(), "chain")
    out = connected_components(edges).withColumnsRenamed({"node": "a", "label": "family"})
    drop(rows)
    return out, early


def tile_pairs(tiled: DataFrame, early: DataFrame, percent: int) -> DataFrame:
    """(family, i, j), i <= j: tiles of sizes that can link and which share one of the first shingles of their classes."""
    seats = early.join(tiled.select("a", "family", "tile"), "a").select("family", "gram", "tile").distinct()
    sizes = tiled.groupBy("family", "tile").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    seats = keep(seats.join(sizes, ["family", "tile"]), "seats")
    upper = seats.select("family", "gram", F.col("tile").alias("j"), F.col("low").alias("low_j"), F.col("high").alias("high_j"))
    alike = f"j >= i and {percent} * low_j <= 100 * high and {percent} * low <= 100 * high_j"
    out = keep(seats.withColumnRenamed("tile", "i").join(upper, ["family", "gram"]).where(alike).select("family", "i", "j").distinct(), "blocks")
    drop(seats)
    return out


def jaccard_rows(docs: DataFrame, words: int = 3, percent: int = 90) -> DataFrame:
    """What ``jaccard_join`` returns, with ``h`` (xxhash64 of the text) and ``group``
    (a name of the row's component; null for an empty set)."""
    texts = docs.select("doc_id", F.xxhash64("text").alias("h"), "text")
    classes = keep(texts.mapInArrow(_class_rows(words), "doc_id long, h long, n_shingles long, a long, b long"), "classes")
    some = classes.where("n_shingles > 0")
    named_by = F.min(F.struct(F.isnull("doc_id").alias("void"), "doc_id", "h")).alias("by")
    byclass = keep(some.groupBy("a", "b").agg(F.count("*").alias("copies"), named_by, F.max("n_shingles").alias("n")), "byclass")

    met = candidates(texts, byclass, words, percent)
    picked = met.select(F.col("by.doc_id").alias("id"), F.col("by.h").alias("t"), "a", "b")
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("h") == F.col("t"))
    sets = texts.hint("merge").join(picked, same).select("text", "a", "b").mapInArrow(_set_rows(words), "a long, b long, n long, grams binary")
    sets = keep(sets.dropDuplicates(["a", "b"]), "sets")

    # a tile is a part by hash of a size class of a family, so no task orders a whole family
    level = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent))
    family, early = families(sets, percent)
    placed = keep(met.join(family, "a").select("family", "n", "a", "b", "copies", level.alias("level")), "placed")
    parts = F.floor(F.greatest(F.sum("n") / TILE, F.count("*") / ROWS)) + 1
    parts = placed.groupBy("family", "level").agg(parts.alias("parts"))
    tiled = placed.join(parts, ["family", "level"]).withColumn("tile", F.col("level") * F.lit(1 << 40) + F.pmod(F.xxhash64("a", "b"), F.col("parts")))
    tiled = keep(tiled.select("family", "tile", "n", "a", "b", "copies"), "tiled")
    blocks = tile_pairs(tiled, early, percent)
    places = blocks.select("family", F.col("i").alias("tile"), "i", "j").union(blocks.where("i < j").select("family", F.col("j").alias("tile"), "i", "j"))
    dealt = sets.drop("n").join(tiled, ["a", "b"]).join(places, ["family", "tile"])
    found = keep(dealt.groupBy("family", "i", "j").applyInArrow(_block(percent), "u long, v long, links long"), "links")
    labels = connected_components(found.where("v is not null").select("u", "v"))
    totals = found.where("v is null").groupBy(F.col("u").alias("a")).agg(F.sum("links").alias("links"))

    named = byclass.select("a", "b", "copies", F.col("by.doc_id").alias("least")).join(labels.withColumnRenamed("node", "a"), "a", "left").join(totals, "a", "left")
    group = F.coalesce("label", "a")
    ids = named.groupBy(group.alias("group")).agg(F.min("least").alias("component_id"))
    named = keep(named.withColumn("group", group).join(ids, "group").select("a", "b", "group", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "named")
    for table in (met, sets, placed, tiled, found, byclass, early, blocks):
        drop(table)
    return classes.join(named, ["a", "b"], "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), "h", "group",
    )


def jaccard_join(docs: DataFrame, words: int = 3, percent: int = 90) -> DataFrame:
    """Components of the graph that links documents of alike shingle sets.

    Takes doc_id bigint and text; other columns are ignored. Returns one row
    per input row: doc_id, n_shingles, component_id (least doc_id reachable by
    links), n_links (other rows that the row links with). A null or wordless
    text has an empty set and links with nothing, so its component is its own
    doc_id. Rows of a null doc_id link like others but name no component (it
    is null where no row of the component has an id). Rows that repeat a
    doc_id count as separate texts.
    """
    return jaccard_rows(docs, words, percent).drop("h", "group")


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM w
), n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
o AS (SELECT x.doc_id AS u, y.doc_id AS v, count(*) AS i FROM g x JOIN g y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT u, v FROM o JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * i >= 90 * (a.n + b.n - i)),
r AS (SELECT u, u AS c FROM l UNION SELECT r.u, l.v FROM r JOIN l ON r.c = l.u),
m AS (SELECT u, min(c) AS c FROM r GROUP BY u),
k AS (SELECT u, count(*) AS k FROM l GROUP BY u)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.c, d.doc_id) AS component_id, coalesce(k.k, 0) AS n_links
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.u = d.doc_id LEFT JOIN k ON k.u = d.doc_id
"""


def op4_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_join(spark.read.parquet(f"{sf_dir}/documents.parquet"))
