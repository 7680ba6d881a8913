"""Operators that judge each row: quality, rules, licenses, language, URLs, chats; and the pipeline."""

import collections
import re

import numpy as np
import pytest

from audiweave.llm import chat, language, licenses, quality, rules, urls


def pairs(df, name):
    return collections.Counter((r.doc_id, r[name]) for r in df.collect())


@pytest.fixture(scope="module")
def larger(spark):
    return "/root/testdata/sf0.01"


def test_op2_held_out_accuracy(spark, larger):
    got = quality.op2_quality_classifier(spark, larger).toPandas()
    labels = spark.read.parquet(f"{larger}/labels.parquet").toPandas()
    both = got[got.held_out].merge(labels, on="doc_id")
    assert len(got) == spark.read.parquet(f"{larger}/documents.parquet").count() and got.score.between(0, 1).all()
    assert ((both.score >= 0.3) == (both.quality == 1)).mean() > 0.93
    assert ((got.score >= 0.3) == (got.predicted == 1)).all()


def test_op2_learns_nothing_from_held_out_labels(spark, larger):
    import zlib

    marks = quality.learned_marks(spark, larger).collect()
    assert marks and all(zlib.crc32(str(r.doc_id).encode()) % 5 for r in marks)


def test_quality_learns_from_arrow_columns(spark, larger, monkeypatch):
    """Rows collected as Python objects are memory that the driver doesn't get back."""
    docs, marks = spark.read.parquet(f"{larger}/documents.parquet"), quality.learned_marks(spark, larger)
    for name in ("toPandas", "collect"):
        monkeypatch.setattr(type(docs), name, lambda _: pytest.fail("numbers reach the driver as Python objects"))
    table, network = quality.learn(docs, marks)
    assert np.isfinite(table).all() and table.any() and network.temperature != 1


def test_quality_edges(spark, edges, empty):
    marks = spark.createDataFrame([(3, 1), (4, 0), (None, 1), (5, None)], "doc_id long, label int")
    model = quality.learn(edges, marks)
    got = quality.score_quality(edges, model)
    assert got.columns == ["doc_id", "text", "in_score", "tile", "base", "score"] and got.where("score is null or score < 0 or score > 1").count() == 0
    assert {r.in_score for r in got.collect()} == {"n"} and got.count() == edges.count()
    assert quality.score_quality(empty, quality.learn(empty, marks.limit(0))).count() == 0


def plain_pooled(texts, table):
    """A row per text: root mean squares and means of its words' bucket vectors, one word at a time."""
    import pyarrow as pa

    from audiweave.llm.textbytes import U

    out = []
    for text in texts:
        bucket = [int(quality._tokens(pa.array([w]))[1].hash[0] % U(quality.BUCKETS)) for w in re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+|[!-/:-@\[-`{-~\x7f]+", text)]
        own = [table[b] for b in bucket]
        mean = np.mean(own, axis=0)
        out.append([*mean, *np.sqrt(np.mean(np.square(own), axis=0)), np.sqrt((mean**2).sum()), np.log(len(own) + 1), np.log(len(set(bucket)) + 1) - np.log(len(own) + 1)])
    return np.array(out)


def test_word_vectors_pooling_and_scores_equal_plain_ones(spark):
    import pyarrow as pa

    texts = ["a b c a, d", "b b!! x", "c d e f g h a b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = quality.word_vectors(docs)
    sums, seen = np.zeros((quality.BUCKETS, quality.WIDTH)), np.zeros(quality.BUCKETS)
    for text in texts:
        bucket, words = quality._tokens(pa.array([text]))
        at, plus = quality.index_vectors(words.hash)
        for i, b in enumerate(bucket):
            seen[b] += 1
            for j in range(max(0, i - quality.REACH), min(len(bucket), i + quality.REACH + 1)):
                for k in range(quality.NONZERO if j != i else 0):
                    sums[b, at[j, k]] += 1 if plus[j, k] else -1
    mean = sums / np.maximum(seen, 1)[:, None]
    share = seen / seen.sum()
    mean -= share @ mean
    table = np.where(seen[:, None] > 0, mean / np.where(np.sqrt(share @ mean**2) > 0, np.sqrt(share @ mean**2), 1), 0) * (0.01 / (0.01 + share))[:, None]
    assert np.allclose(got, table, atol=1e-5)
    assert np.allclose(quality.pooled(pa.array(texts), got), plain_pooled(texts, got), atol=1e-5)
    net = quality.Network(np.random.default_rng(1).normal(size=(40, 2 * quality.WIDTH + 3)), np.arange(40) % 2.0)
    x = quality.pooled(pa.array(texts), got)
    plain = [1 / (1 + np.exp(-(sum(net.w2[h] * np.tanh(sum(z * w for z, w in zip(row, net.w1[:, h], strict=True)) + net.b1[h]) for h in range(quality.HIDDEN)) + net.b2[0]) / net.temperature)) for row in np.clip((x - net.mean) / net.scale, -8, 8)]
    scored = {r.doc_id: r.score for r in quality.score_quality(docs, (got, net)).collect()}
    assert np.allclose([scored[k] for k in range(3)], plain)


def plain_counts(t):
    t = t or ""
    w, seen, dup = re.findall(r"[^\x20\x09-\x0D]+", t), set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    c = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    m = {j for i in range(len(w) - 4) if c[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(m)


def test_rules_counts(spark, sf_dir, edges, empty):
    more = spark.createDataFrame([(20, "a\n\na\n \n a\na"), (21, "é😀 x\ry\x0bz\n" * 7), (22, "\n"), (23, "x\nx"), (24, "a b c d e\na b c d e\n")], "doc_id long, text string")
    for docs in (spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), edges.select("doc_id", "text"), more.coalesce(1)):
        got = collections.Counter(tuple(r)[:6] for r in rules.quality_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect())
        assert got == collections.Counter((i, *plain_counts(t)) for i, t in docs.collect())
    assert rules.quality_rules(empty).count() == 0


def test_rules_verdicts(spark):
    import random

    rng = random.Random(5)
    prose = " ".join("".join(rng.choice("bcdfghklmnprstvw") + rng.choice("aeiou") for _ in range(rng.randrange(1, 5))) for _ in range(900))
    docs = [(1, prose), (2, "same words again " * 300), (3, " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", k=60)) for _ in range(40)))]
    got = {r.doc_id: r.kept for r in rules.quality_rules(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: True, 2: False, 3: False}


def test_op7_bands_catch_bad_texts_that_the_base_rules_pass(spark):
    larger = "/root/testdata/sf0.1"
    got = rules.op7_quality_rules(spark, larger).toPandas()
    labels = spark.read.parquet(f"{larger}/labels.parquet").toPandas()
    both = got.merge(labels, on="doc_id")
    passed = both[~both.base_failed]
    assert (~passed.kept[passed.quality == 0]).mean() > 0.3 and passed.kept[passed.quality == 1].mean() > 0.97


def test_op7_verdicts_equal_plain_ones(spark, larger, monkeypatch):
    """Limits from sorted ratios and verdicts from one text at a time."""
    import math
    import zlib

    import zstandard

    monkeypatch.setattr(rules, "LABELLED", 10)
    size = lambda x: len(zstandard.ZstdCompressor(level=3).compress(x))
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{larger}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{larger}/labels.parquet").collect() if zlib.crc32(str(r.doc_id).encode()) % 5}
    failed = {}
    for i, t in docs.items():
        n, _, _, _, again = plain_counts(t.decode())
        failed[i] = n < 10 or 100 * again > 20 * n
    band = lambda t: math.floor(2 * math.log2(max(len(t), 1)))
    by_band = collections.defaultdict(lambda: ([], []))
    for i, y in labels.items():
        if i in docs and not failed[i]:
            by_band[band(docs[i])][y].append(round(1000 * size(docs[i]) / len(docs[i])) / 1000)
    limits = {k: [next((x, y) for b, x, y in rules.BANDS if 2 ** (k / 2) < b)][0] for k in range(60)}
    for k, (bad, good) in by_band.items():
        if len(good) >= rules.LABELLED:
            good.sort()
            out = int(rules.LOSS * len(good))
            low, high = good[out] - rules.SLACK, good[len(good) - 1 - out] + rules.SLACK
            limits[k] = max(limits[k][0], low) if min(bad, default=9) < low else limits[k][0], min(limits[k][1], high) if max(bad, default=0) > high else limits[k][1]
    got = {r.doc_id: r.kept for r in rules.op7_quality_rules(spark, larger).collect()}
    for i, t in docs.items():
        low, high = limits[band(t)]
        windows = [t[k : k + rules.CHUNK] for k in range(0, len(t) - rules.CHUNK + 1, rules.CHUNK)] + ([t[-rules.CHUNK :]] if len(t) > rules.CHUNK and len(t) % rules.CHUNK else [])
        odd = [not rules.CHUNK_BAND[0] <= size(w) / rules.CHUNK <= rules.CHUNK_BAND[1] for w in windows]
        whole = size(t) / len(t) if t else 1.0
        assert got[i] == (not failed[i] and low <= whole <= high and sum(odd) <= rules.CHUNK_SHARE * max(len(odd), 1)), i


def test_licenses_equal_containment(spark, sf_dir, edges, empty):
    def own(t):
        return re.findall(r"[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    grams = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    known = {k: grams(own(v)) for k, v in licenses.TEMPLATES.items()}
    filler = " ".join(f"f{k}" for k in range(50))
    docs = [(k, f"{filler} {v.upper()} {filler}") for k, v in enumerate(licenses.TEMPLATES.values())] + [(99, filler), (98, licenses.TEMPLATES["bsd"].replace("binary", "other"))]
    tables = [spark.createDataFrame(docs, "doc_id long, text string").coalesce(1), spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), edges.select("doc_id", "text")]
    for table in tables:
        expected = collections.Counter((i, ",".join(sorted(k for k, g in known.items() if len(g & grams(own(t))) >= 0.8 * len(g)))) for i, t in table.collect())
        assert pairs(licenses.license_scan(table), "licenses") == expected
    assert licenses.license_scan(empty).count() == 0


def test_altered_licenses_are_recalled_with_their_spans(spark):
    """Copies of every template with 80 to 99 % of its shingles left, somewhere in a text: nine of ten at least are found, in their place."""
    import random

    rng = random.Random(7)
    docs, true = [], {}
    grams = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    for name, text in licenses.TEMPLATES.items():
        words = re.findall("[a-z0-9]+", text.lower())
        whole = grams(words)
        for _ in range(40):
            own = list(words)
            for _ in range(rng.randrange(0, max(1, len(words) // 25) + 1)):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
            if 0.8 * len(whole) <= len(whole & grams(own)) < len(whole):
                before = rng.randrange(0, 300)
                docs.append((len(docs), " ".join([f"f{rng.randrange(10**6)}" for _ in range(before)] + own + [f"g{rng.randrange(10**6)}" for _ in range(rng.randrange(0, 300))])))
                hit = [i for i in range(len(own) - 4) if tuple(own[i : i + 5]) in whole]
                true[len(docs) - 1] = name, before + hit[0], before + hit[-1] + 5, len(whole & grams(own)) / len(whole)
    assert len({n for n, *_ in true.values()}) > 12 and len(true) > 200
    got = {r.doc_id: r for r in licenses.license_scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    found = [i for i, (name, *_) in true.items() if name in got[i].licenses.split(",")]
    assert len(found) >= 0.95 * len(true)
    right = [i for i in found if any((x.license, x.start, x.end) == true[i][:3] and abs(x.containment - true[i][3]) < 1e-9 for x in got[i].spans)]
    assert len(right) >= 0.9 * len(true)


def test_op9_held_out_accuracy(spark, larger):
    got = language.op9_language_id(spark, larger).toPandas()
    docs = spark.read.parquet(f"{larger}/documents.parquet").toPandas()
    both = got[got.held_out].merge(docs, on="doc_id")
    assert len(got) == len(docs) and (both.lang_pred == both.lang).mean() > 0.97


def test_language_of_switched_text_and_edges(spark, larger, edges, empty):
    field = language.learn(spark.read.parquet(f"{larger}/documents.parquet"))
    import pyarrow as pa

    en, de = "the and that of with was this " * 10, "und der nicht ist von mit sich " * 5
    shares, runs = field.label(pa.array([en + de, "", None]))
    shares = dict(zip(field.labels, shares[0], strict=True))
    assert shares["en"] > 0.55 and shares["de"] > 0.2
    assert [(x, i, j) for x, i, j in runs[0] if j - i > 5] and runs[0][0][:2] == ("en", 0) and runs[0][-1][0] == "de" and runs[0][-1][2] == 105 and runs[1:] == [[], []]
    got = language.identify(edges, field).collect()
    assert len(got) == edges.count() and {r.lang_pred for r in got if r.doc_id in (1, 2, 3)} == {"und"}
    assert language.identify(empty, field).count() == 0
    none = language.learn(empty.selectExpr("doc_id", "text", "base as lang"))
    assert {r.lang_pred for r in language.identify(edges, none).collect()} == {"und"}


def plain_posteriors(scores, move):
    """Forward-backward of one chain, a word at a time, in logarithms."""
    alpha, beta = [scores[0]], [np.zeros(scores.shape[1])]
    for e in scores[1:]:
        alpha.append(e + np.logaddexp.reduce(alpha[-1][:, None] + move, axis=0))
    for e in scores[:0:-1]:
        beta.append(np.logaddexp.reduce(move + (e + beta[-1])[None, :], axis=1))
    total = np.array(alpha) + np.array(beta[::-1])
    return np.exp(total - np.logaddexp.reduce(total, axis=1)[:, None])


def test_long_chains_equal_unbroken_ones(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(9)
    field = language.Field(["a", "b", "c"], [])
    field.weights, field.move = rng.normal(0, 0.4, field.weights.shape), rng.normal(0, 2, (3, 3))
    texts = [" ".join(f"{chr(97 + x % 26)}{chr(97 + x // 26)}" for x in rng.integers(0, 600, n)) for n in (1000, 1, 128, 129, 300, 0)]
    words = language.Words(pa.array(texts), member=language.LETTERS, fold=language.LOWER)
    post = field.posteriors(words)
    entries, first = language.features(words, np.arange(len(words.doc)))
    scores = np.add.reduceat(field.weights[entries], first[:-1], axis=0)
    for k in range(5):
        own = slice(words.first[k], words.first[k + 1])
        assert np.allclose(post[own], plain_posteriors(scores[own], field.move))


def test_gradient_equals_finite_differences():
    import pyarrow as pa

    rng = np.random.default_rng(3)
    field = language.Field(["a", "b"], [])
    field.weights, field.move = rng.normal(0, 0.3, field.weights.shape), rng.normal(0, 1, (2, 2))
    words = language.Words(pa.array(["der die das the of und", "and a"]), member=language.LETTERS, fold=language.LOWER)
    want, size = np.array([0, 1, 1, 0, 0, 1, 0, 1]), 5
    entries, first = language.features(words, np.arange(8))

    def likelihood():
        scores = np.add.reduceat(field.weights[entries], first[:-1], axis=0)
        total = 0.0
        for i in range(0, 8, size):
            own, y = scores[i : i + size], want[i : i + size]
            alpha = own[0]
            for e in own[1:]:
                alpha = e + np.logaddexp.reduce(alpha[:, None] + field.move, axis=0)
            total += own[np.arange(len(y)), y].sum() + sum(field.move[p, q] for p, q in zip(y, y[1:], strict=False)) - np.logaddexp.reduce(alpha)
        return total

    weights, moves = field.gradient(words, want, size)
    for table, slopes, cells in ((field.weights, weights, [(int(e), k) for e in entries[:6] for k in (0, 1)]), (field.move, moves, [(0, 0), (0, 1), (1, 0), (1, 1)])):
        for cell in cells:
            at = table[cell]
            table[cell] = at + 1e-5
            up = likelihood()
            table[cell] = at - 1e-5
            down = likelihood()
            table[cell] = at
            assert np.isclose((up - down) / 2e-5, slopes[cell], atol=1e-5)


def test_op9_equals_plain_field(spark, sf_dir):
    import pyarrow as pa

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    field = language.learn(docs.where("crc32(cast(doc_id as string)) % 3 <> 1"))
    got = {r.doc_id: r for r in language.op9_language_id(spark, sf_dir).collect()}
    for r in docs.collect():
        words = language.Words(pa.array([r.text or ""]), member=language.LETTERS, fold=language.LOWER)
        if not len(words.doc) or not any(map(str.isalpha, r.text or "")):
            assert got[r.doc_id].lang_pred == "und" and got[r.doc_id].score == 0
            continue
        entries, first = language.features(words, np.arange(len(words.doc)))
        share = plain_posteriors(np.add.reduceat(field.weights[entries], first[:-1], axis=0), field.move).mean(axis=0)
        assert got[r.doc_id].lang_pred == field.labels[int(share.argmax())] and np.isclose(got[r.doc_id].score, share.max())


def test_forward_backward_equals_enumeration():
    import itertools

    rng = np.random.default_rng(4)
    scores, move = rng.normal(size=(1, 4, 3)), rng.normal(size=(3, 3))
    paths = list(itertools.product(range(3), repeat=4))
    weight = np.exp([sum(scores[0, t, p[t]] for t in range(4)) + sum(move[a, b] for a, b in zip(p, p[1:], strict=False)) for p in paths])
    weight /= weight.sum()
    true = np.array([[sum(w for p, w in zip(paths, weight, strict=True) if p[t] == k) for k in range(3)] for t in range(4)])
    post, moves = language.forward_backward(scores, np.array([4]), move)
    assert np.allclose(post[0], true) and np.isclose(moves.sum(), 3)


def plain_rule(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [(own + start, v) for own, start, v in urls.RULES if (host == own or host.endswith("." + own)) and path.startswith(start)]
    return (host, path, *(max(fits, key=lambda r: len(r[0])) if fits else (None, None)))


def test_url_rules_and_edges(spark, sf_dir):
    odd = [(1, None), (2, "nope"), (3, "HTTP://A.Example.NET/EN/x?y"), (4, "http://net"), (5, "http://net/"), (6, "a://b://c/de/"), (7, "http://x.example.net/en/1"), (8, "http://xexample.com/de/1"), (8, "http://e.com/a/b/c/d/e/f/g"), (None, "http://x.org/fr/")]
    for pages in (spark.createDataFrame(odd, "page_id long, url string"), spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")):
        got = urls.url_verdicts(pages).collect()
        assert collections.Counter((r.page_id, r.host, r.path, r.rule) for r in got) == collections.Counter((i, *plain_rule(u)[:3]) for i, u in pages.collect())
        verdict = {r: v for _, _, r, v in (plain_rule(u) for _, u in pages.collect()) if r}
        assert all(r.verdict == verdict[r.rule] if r.rule else r.verdict in ("allow", "block") for r in got)
    assert urls.url_verdicts(spark.createDataFrame([], "page_id long, url string")).count() == 0


def plain_urls(pages, rules):
    """{(page_id, url): (template, verdict)} from the tree of each host, one node at a time."""
    shapes, seen = collections.defaultdict(lambda: [0, 0, 0]), {}
    for i, u in pages:
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", u or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fits = [(own + start, v) for own, start, v in rules if (host == own or host.endswith("." + own)) and path.startswith(start)]
        rule = max(fits, key=lambda r: len(r[0])) if fits else (None, None)
        key = host, tuple([x for x in re.sub("[0-9]+", "*", path).split("/") if x] or [""])
        seen[i, u] = (key, rule[1])
        for k, more in enumerate((1, rule[1] == "block", rule[1] is not None)):
            shapes[key][k] += more
    place = {}

    def walk(host, prefix, keys, level):
        here = [k for k in keys if len(k[1]) > level]
        place.update({k: prefix for k in keys if len(k[1]) <= level})
        children = collections.Counter()
        for k in here:
            children[k[1][level]] += shapes[k][0]
        f = sum(n == 1 for n in children.values())
        wild = f - 2 * f**0.5 >= urls.NOVEL * sum(children.values())
        for own in {"*"} if wild and here else set(children):
            walk(host, prefix + "/" + own, [k for k in here if wild or k[1][level] == own], level + 1)

    for host in {k[0] for k in shapes}:
        walk(host, "", [k for k in shapes if k[0] == host], 0)
    nodes = collections.defaultdict(lambda: [0, 0])
    for k, t in place.items():
        nodes[k[0], t][0] += shapes[k][1]
        nodes[k[0], t][1] += shapes[k][2]
    b, n = (sum(v[k] for v in nodes.values()) for k in (0, 1))
    prior = (b + 1) / (n + 2)
    usual = {t: (sum(v[0] for k, v in nodes.items() if k[1] == t) + urls.SMOOTH * prior) / (sum(v[1] for k, v in nodes.items() if k[1] == t) + urls.SMOOTH) for t in {k[1] for k in nodes}}
    scored = {}
    for (host, t), (b, n) in nodes.items():
        branch, parts = t, t.split("/")
        for at, own in enumerate(parts):
            if n < 5 or own in ("", "*", "**"):
                continue
            near = [v for (h, x), v in nodes.items() if h == host and v[1] >= 5 and len(x.split("/")) == len(parts) and x.split("/")[at] not in ("", "*", "**") and [*x.split("/")[:at], *x.split("/")[at + 1 :]] == [*parts[:at], *parts[at + 1 :]]]
            nb, nn = sum(v[0] for v in near), sum(v[1] for v in near)
            p = (nb + 0.5) / (nn + 1)
            chi = sum((v[0] - v[1] * p) ** 2 / (v[1] * p * (1 - p)) for v in near)
            if len(near) >= 2 and chi <= len(near) - 1 + 2 * (2 * (len(near) - 1)) ** 0.5:
                branch, b, n = "/".join([*parts[:at], "*", *parts[at + 1 :]]), nb, nn
                break
        scored[host, t] = branch, round((b + urls.SMOOTH * usual[t]) / (n + urls.SMOOTH), 6)
    out = {}
    for key, (shape, ruled) in seen.items():
        branch, purity = scored[shape[0], place[shape]]
        out[key] = branch, ruled or ("block" if purity >= urls.REJECT else "allow")
    return out


def test_templates_merges_and_verdicts_equal_plain_ones(spark, sf_dir):
    import random

    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    made = []
    for k in range(900):
        host = rng.choice(("a.org", "b.net", "c.com"))
        made.append((k, f"http://{host}/{rng.choice('xyz')}/{rng.choice(('en', 'de', 'fr'))}/p/q/{rng.choice(('news', 'spam', word()))}/{word()}/{rng.choice(('', 'end'))}"))
    rules = (("b.net", "/", "block"), ("a.org", "/x/", "block"), ("a.org", "/y/en/", "allow"), ("c.com", "/z/", "block"), ("c.com", "/x/de/", "allow"))
    given = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url").collect()]
    for pages, own in ((made, rules), (given, urls.RULES)):
        got = urls.url_verdicts(spark.createDataFrame(pages, "page_id long, url string"), own).collect()
        plain = plain_urls(pages, own)
        assert collections.Counter((r.page_id, r.template, r.verdict) for r in got) == collections.Counter((i, *plain[i, u]) for i, u in pages)
    deep = [p for p in plain_urls(made, rules).values() if p[0].count("/") > 5]
    assert any("/*/" in t or t.endswith("/*") for t, _ in deep)


def test_slugs_become_wildcards_and_purity_rejects(spark):
    pages = [(k, f"http://a.org/{'spam' if k % 2 else 'news'}/slug-{chr(97 + k % 26)}{'x' * (k // 26)}") for k in range(200)] + [(900, "http://a.org/spam/another"), (901, "http://a.org/news/another")]
    rule = (("a.org", "/spam/slug", "block"), ("a.org", "/news/slug", "allow"))
    got = {r.page_id: (r.template, r.verdict) for r in urls.url_verdicts(spark.createDataFrame(pages, "page_id long, url string"), rule).collect()}
    assert got[900] == ("/spam/*", "block") and got[901] == ("/news/*", "allow")


def test_chat_roles_and_markers(spark):
    rows = [(1, 0, None, "User: hi?\nAssistant: - a\n- b\nUser: bye"), (3, 5, "system", "### System\nbe good\n<|im_start|>user\nq<|im_end|>"), (None, None, "zzz", None), (2, 0, "user", ""), (2, 0, "user", ""), (4, 1, "system", "x"), (4, 2, "user", "y")]
    got = sorted(((r.conv_id or -1, r.turn or -1, r.seg, r.role_pred, r.rendered) for r in chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()))
    assert [g[3:] for g in got if g[0] == 1] == [("user", "<|user|>\nhi?\n<|end|>\n"), ("assistant", "<|assistant|>\n- a\n- b\n<|end|>\n"), ("user", "<|user|>\nbye\n<|end|>\n")]
    assert [g[3] for g in got if g[0] == 3] == ["system", "user"] and len(got) == 10
    assert chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_op1_recovers_roles(spark, larger):
    got = chat.op1_chat_format(spark, larger).toPandas()
    turns = spark.read.parquet(f"{larger}/conversations.parquet").toPandas()
    both = got.merge(turns, on=["conv_id", "turn"])
    assert len(both) == len(turns) and (both.role == both.role_pred).mean() > 0.9


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.keep(stage(spark, docs, sf_dir), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and docs.count() <= before
        before = docs.count()
    packed = corpus_pipeline.packing(spark, docs, sf_dir)
    assert packed.select("doc_id").distinct().count() == before > 0
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0


def test_url_trees_of_large_hosts_and_of_deep_paths(spark, monkeypatch):
    import time

    rng = np.random.default_rng(3)
    made = [(k, f"https://h{k % 3}.com/" + "/".join(rng.choice([["a", "b"], ["x", "y", f"s{k}"], [f"t{k}", "p"]][j % 3]) for j in range(rng.integers(0, 6)))) for k in range(900)]
    df = spark.createDataFrame(made, "page_id long, url string")
    rules_here = (("h0.com", "/a/", "block"), ("h1.com", "/b/", "allow"))
    walked = sorted(map(tuple, urls.url_verdicts(df, rules_here).collect()))
    monkeypatch.setattr(urls, "WALKED", 250)
    assert sorted(map(tuple, urls.url_verdicts(df, rules_here).collect())) == walked
    assert any("*" in r[5] for r in walked)
    trap = [(k, "https://trap.com/" + "/".join(["d"] * 5000) + f"/{'abcdefghijkl'[k]}") for k in range(12)]
    trap = spark.createDataFrame([(*r, "clash", 1) for r in trap], "page_id long, url string, host string, purity int")
    began = time.time()
    for most in (250, 5):
        monkeypatch.setattr(urls, "WALKED", most) if most == 250 else None
        assert {r.template.count("/") for r in urls.url_verdicts(trap, rules_here).collect()} == {5001}
    assert time.time() - began < 120


def test_a_rare_language_is_learned(spark):
    rng = np.random.default_rng(6)
    common, rare = "the and of house water people time".split(), "zxu qyo wvezz kjua ploxx".split()
    rows = [(k, " ".join(rng.choice(common, 12)), "en") for k in range(4000)] + [(9000 + k, " ".join(rng.choice(rare, 12)), "xx") for k in range(2)] + [(9500, None, "en"), (9501, "text", None)]
    field = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 60)
    assert field.labels == ["en", "xx"]
    got = language.identify(spark.createDataFrame([(1, "kjua zxu wvezz qyo ploxx zxu"), (2, "the people of time and water")], "doc_id long, text string"), field).collect()
    assert [r.lang_pred for r in sorted(got)] == ["xx", "en"]
    assert language.shares_of({"a": 5000, "b": 2, "c": 100}, 1000) == {"b": 2, "c": 100, "a": 898} and sum(language.shares_of(dict.fromkeys("abcdefg", 900), 1000).values()) == 1000
