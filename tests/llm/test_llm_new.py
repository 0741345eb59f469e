"""Boosted quality classifier, embedding whitening and phrase collocations: brute force, enumeration, odd rows."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import zstandard
from conftest import SF0001
from odd import ROWS, no_documents, odd_documents

from folio.llm import boosting, collocations, registry, whitening
from folio.oracle.compare import compare, duckdb_connection

SF001 = SF0001.replace("0.001", "0.01")


# Phrase collocations


def brute(rows, max_words=3, least=10, cover=50, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\v\f\r]", lower):
            words = [w for w in re.split("[ \t]", piece) if w]
            totals[lang] += len(words)
            for n in range(1, max_words + 1):
                counts[lang].update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, count in counts.items():
        often = {g: a for g, a in count.items() if len(g) > 1 and a >= least}
        covered = defaultdict(int)
        for g, a in often.items():
            for n in range(2, len(g)):
                for i in range(len(g) - n + 1):
                    covered[g[i:i + n]] = max(covered[g[i:i + n]], a)
        best = []
        for g, a in often.items():
            if 100 * covered[g] >= cover * a:
                continue
            score, _, left, right = min((10**6 * a * a // (count[g[:k]] * count[g[k:]]), k, count[g[:k]], count[g[k:]]) for k in range(1, len(g)))
            best.append((-score, -a, " ".join(g).encode(), left, right))
        best.sort()
        out += [(lang, i, p.decode(), -a, left, right, totals[lang], -s) for i, (s, a, p, left, right) in enumerate(best[:top], 1)]
    return sorted(out)


def test_collocations_match_brute_force(spark):
    rng = np.random.default_rng(1)
    words = ["of", "The", "the", "é", "x1", "Ab", "ab", "\x1c", "zz"]
    rows = [(["en", None, "und", "de"][rng.integers(4)],
             "".join(words[min(int(rng.geometric(0.3)) - 1, 8)] + [" ", " ", " ", "\t ", ". ", ",", "\n", " ?! "][rng.integers(8)] for _ in range(rng.integers(0, 60))))
            for _ in range(200)]
    rows += [("en", "one hot phrase of words " * 30)] * 40 + [("en", None), (None, ""), ("fr", "...")]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    for setting in ({"least": 3, "block_bytes": 300, "partition_mass": 500}, {"least": 10, "top": 4}, {"least": 2, "max_words": 4, "block_bytes": 1000}):
        got = sorted(map(tuple, collocations.collocations(docs, **setting).collect()))
        assert got == brute(rows, **{k: v for k, v in setting.items() if k not in ("block_bytes", "partition_mass")})


def test_collocations_odd_rows(spark):
    got = collocations.collocations(odd_documents(spark), least=2).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert sorted(map(tuple, got.collect())) == brute([(r[2], r[1]) for r in ROWS], least=2)
    assert collocations.collocations(no_documents(spark)).count() == 0


def test_collocations_query_equals_sql(spark):
    result = compare("op13", registry.QUERIES["op13_collocations"](spark, SF0001), duckdb_connection(SF0001), registry.SQL["op13_collocations"])
    assert result.ok, result


def test_collocations_query_sends_small_batches(spark, monkeypatch):
    """Blocks of some MB stand in the JVM and twice in a worker: the query asks for small batches, where the session left Spark's sizes."""
    names = [f"spark.sql.execution.arrow.{x}" for x in ("maxRecordsPerBatch", "maxBytesPerBatch")]
    before = [spark.conf.get(x) for x in names]
    monkeypatch.setattr(collocations, "documents", lambda spark, sf_dir: None)
    monkeypatch.setattr(collocations, "collocations", lambda docs: None)
    try:
        for x in names:
            spark.conf.unset(x)
        collocations.op13_collocations(spark, "")
        assert [int(spark.conf.get(x).rstrip("b")) for x in names] == [2000, 8 << 20]
    finally:
        for x, y in zip(names, before):
            spark.conf.set(x, y)


@pytest.mark.parametrize("seed", range(6))
def test_merged_summaries_keep_every_frequent_key(seed):
    """Any merge order, with far more keys than counters: who reaches the threshold is never lost."""
    rng = np.random.default_rng(seed)
    least, true, pieces = int(rng.integers(2, 12)), Counter(), []
    for _ in range(30):
        keys = np.unique(rng.integers(0, 3000, rng.integers(1, 400)).astype(np.uint32) if rng.random() < 0.7 else rng.integers(0, 20, 30).astype(np.uint32))
        counts = rng.integers(1, 4, len(keys))
        true.update(dict(zip(keys.tolist(), counts.tolist())))
        pieces.append(collocations.press_counts(keys, counts))
        back = collocations.unpress_counts(pieces[-1])
        assert (back[0] == keys).all() and (back[1] == counts).all()
    capacity = sum(true.values()) // least
    kept = collocations.summary(pieces, capacity, at_once=int(rng.integers(1, 2000)))
    assert len(kept) <= capacity
    assert {k for k, c in true.items() if c >= least} <= set(kept.tolist())
    keys, counts = collocations.merge([collocations.unpress_counts(p) for p in pieces], capacity)
    assert all(true[k] - least < c <= true[k] for k, c in zip(keys.tolist(), counts.tolist()))


def test_words_are_sent_for_frequent_ngrams_alone(spark):
    """Much mass on few words leaves counters to rare n-grams as well; the second pass must not hear of those."""
    rows = [("en", "hot " * 200 + f"rare{i} word{i // 4} word{i // 4}") for i in range(40)] + [("de", f"hot hot rare{i}") for i in range(9)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    blocks = collocations.stored(collocations.to_blocks(docs, 3000), "test-blocks")
    here, total = [], Counter()
    for r in blocks.collect():
        count = Counter()
        for piece in zstandard.ZstdDecompressor().decompress(r.body).decode().split(" . "):
            w = piece.split(" ")
            count.update((r.lang, *w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1))
        here.append(count)
        total.update(count)
    frequent = {g for g, f in total.items() if f >= 8}
    answers = collocations.survivors(blocks, 3, 8, 2).collect()
    told = sum(int(np.unpackbits(np.frombuffer(m.mask, np.uint8)).sum()) for r in answers for m in r.masks)
    assert len(here) > 5 and 0 < len(frequent) < len(total)
    assert told == sum(len(frequent & set(count)) for count in here)


def test_sums_of_kept_keys_hear_every_count():
    """A key may come twice from one block (two n-grams of one hash) and from many blocks; keys without a counter are not looked at."""
    pieces = [collocations.press_counts(np.array(k, np.uint32), np.array(c)) for k, c in (([1, 5, 5, 9], [2, 3, 4, 9]), ([5, 7], [1, 7]), ([], []), ([1, 2**32 - 1], [5, 8]))]
    kept = np.array([1, 5, 7, 2**32 - 1], np.uint32)
    assert collocations.reaching(pieces, kept, 8).tolist() == [5, 2**32 - 1]
    assert collocations.reaching(pieces, kept, 7).tolist() == [1, 5, 7, 2**32 - 1]
    assert collocations.reaching(pieces, kept[:0], 1).tolist() == []


def test_long_text_is_cut_between_pieces():
    body = collocations.normal("a b. c d; e f\ng " * 50)
    parts = list(collocations.parts_of(body, 30))
    assert len(parts) > 3 and b" . ".join(parts) == body


# Whitening


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.standard_normal((30, 30)))[0]
    a = (q * np.linspace(-2, 5, 30)) @ q.T
    b = rng.standard_normal((30, 4))
    b[:, 2] = 0
    assert np.allclose(whitening.minres(lambda x: a @ x, b, 40), np.linalg.solve(a, b), atol=1e-8)


@pytest.mark.parametrize("shape", ["flat", "steep", "clustered", "rank"])
def test_jacobi_davidson_reaches_double_precision(shape):
    """A space far smaller than the dimension, so that corrections and restarts decide."""
    rng, d, k = np.random.default_rng(4), 300, 10
    e = {"flat": np.linspace(1, 2, d), "steep": 0.8 ** np.arange(d), "clustered": np.concatenate([[5, 5, 5, 4.999, 4.999], np.linspace(0, 4, d - 5)]),
         "rank": np.concatenate([np.arange(1, 13.0), np.zeros(d - 12)])}[shape]
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    a = (q * e) @ q.T
    calls = []

    def apply(x):
        calls.append(x.shape[1])
        return a @ x

    values, vectors, errors = whitening.jacobi_davidson(apply, d, k, guard=4, room=20, inner=10)
    assert np.allclose(values, np.sort(e)[::-1][:k], rtol=1e-12)
    assert np.abs(a @ vectors - vectors * values).max() < 1e-13 * e.max() * 10 and errors.max() <= whitening.DOUBLE
    assert np.allclose(vectors.T @ vectors, np.eye(k), atol=1e-13) and max(calls) < 40


SCHEMA = "vec_id long, embedding array<double>, label int"


def test_whitening_matches_numpy_with_odd_rows(spark):
    rng = np.random.default_rng(5)
    good = [(i % 90, [float(v) for v in rng.standard_normal(6) * [3, 1, 1, 0.5, 0.5, 0.1]], 0) for i in range(100)] + [(None, [0.0] * 6, 1)]
    bad = [(500, None, 0), (501, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0), (502, [float("nan")] * 6, 0), (503, [float("inf")] + [0.0] * 5, None), (504, [1.0, 2.0], 0), (505, [], 0),
           (506, [1e300] * 6, 0)]
    table = spark.createDataFrame(good + bad, SCHEMA).repartition(4)
    table = table.selectExpr("*", "'own' as key", "'own' as whitened", "1 as component", "2 as n")
    got = whitening.whiten(table, components=4).toPandas()
    x = np.floor(64 * np.array([g[1] for g in good])).astype(np.int64) + 1000000
    n, s = len(x), x.sum(axis=0)
    y = x - s / n
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1][:4], u[:, ::-1][:, :4]
    assert len(got) == 4 * n and set(got["n"]) == {n} and got["identity_error"].max() < 1e-9 and got["residual"].max() <= whitening.DOUBLE
    assert sorted(got[got.component == 1]["deviation"]) == sorted(((n * x - s) ** 2).sum(axis=1).tolist())
    for j in range(4):
        mine = got[got.component == j + 1]
        assert np.allclose(mine["explained"], e[j] / np.trace(y.T @ y / n), rtol=1e-9)
        want, found = np.sort(y @ u[:, j] / np.sqrt(e[j])), np.sort(mine["whitened"])
        assert np.allclose(found, want, atol=1e-7) or np.allclose(found, -want[::-1], atol=1e-7)


def test_whitening_without_spread_or_rows(spark):
    same = spark.createDataFrame([(1, [1.0, 2.0], 0)] * 5, SCHEMA)
    assert whitening.whiten(same).count() == 0 and whitening.whiten(same.where("false")).count() == 0
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 7.0], 0) for i in range(9)], SCHEMA)
    assert whitening.whiten(line).select("component").distinct().count() == 1


def test_whitening_deviation_beyond_products_of_64_bits(spark):
    """n * x - S and its square leave 64 bits on the way only where they fit into the result."""
    table = spark.createDataFrame([(i, [2.0 ** 24 * (i % 2), float(i)], 0) for i in range(4)], SCHEMA)
    got = whitening.whiten(table).where("component = 1").toPandas().sort_values("vec_id")
    x = [[(1 << 30) * (i % 2) + 1000000, 64 * i + 1000000] for i in range(4)]
    s = [sum(c) for c in zip(*x)]
    assert got["deviation"].tolist() == [sum((4 * v - t) ** 2 for v, t in zip(row, s)) for row in x]


# Boosted trees


def test_forest_walks_like_nested_ifs():
    rng = np.random.default_rng(6)
    x = rng.standard_normal((3000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] * x[:, 2] > 0.2)).astype(float)
    forest = boosting.grow(x, y, trees=40, depth=3, bins=32, rate=0.3)
    assert ((forest.scores(x) >= 0.5) == y).mean() > 0.93

    def walk(row):
        total = forest.prior
        for t in range(len(forest.feature)):
            node = 0
            while node < forest.feature.shape[1]:
                node = 2 * node + (1 if row[forest.feature[t, node]] <= forest.cut[t, node] else 2)
            total += forest.leaf[t, node - forest.feature.shape[1]]
        return total

    assert np.allclose(forest.margins(x[:50]), [walk(r) for r in x[:50]])


def test_first_cut_is_the_best_of_all_cuts():
    """The root of one tree against every feature and edge, by the gain's definition."""
    rng = np.random.default_rng(7)
    x = rng.integers(0, 12, (400, 3)).astype(float)
    y = (x[:, 1] + rng.standard_normal(400) > 7).astype(float)
    forest = boosting.grow(x, y, trees=1, depth=1, bins=64)
    p = (y.sum() + 1) / (len(y) + 2)
    g, h = p - y, np.full(len(y), p * (1 - p))
    part = lambda m: g[m].sum() ** 2 / (h[m].sum() + boosting.RIDGE)
    best = max((part(x[:, j] <= c) + part(x[:, j] > c), j, c) for j in range(3) for c in range(11))
    assert (forest.feature[0, 0], int(forest.cut[0, 0])) == best[1:]


def test_one_kind_of_label_or_none():
    x = np.zeros((8, len(boosting.STATISTICS)))
    assert np.allclose(boosting.grow(x, np.ones(8)).scores(x), 0.9)
    assert np.allclose(boosting.grow(x[:0], np.ones(0)).scores(x), 0.5)


def test_classifier_on_held_out_labels(spark):
    got = {r["doc_id"]: r for r in registry.QUERIES["op11_quality_classifier"](spark, SF001).collect()}
    labels = spark.read.parquet(f"{SF001}/labels.parquet").collect()
    assert len(got) == 1000 and all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for i, r in got.items())
    held = [r for r in labels if got[r["doc_id"]]["held_out"]]
    assert sum(got[r["doc_id"]]["predicted"] == r["quality"] for r in held) >= 0.93 * len(held)


def test_held_out_labels_change_nothing(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    labels = spark.read.parquet(f"{SF0001}/labels.parquet").select("doc_id", "quality")
    turned = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - quality else quality end as quality")
    order = lambda df: df.select("doc_id", "score").orderBy("doc_id").collect()
    assert order(boosting.classify(docs, labels)) == order(boosting.classify(docs, turned))


def test_classifier_odd_rows(spark):
    labels = spark.createDataFrame([(5, 1), (5, 0), (None, 1), (11, 1), (20, 0), (16, 1), (3, None), (777, 1)], "doc_id long, quality int")
    got = boosting.classify(odd_documents(spark), labels).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in ROWS)
    assert all(0 <= r["score"] <= 1 for r in got) and len({r["score"] for r in got if r["doc_id"] == 11}) == 1
    assert {r["score"] for r in boosting.classify(odd_documents(spark), labels.where("false")).collect()} == {0.5}
    assert boosting.classify(no_documents(spark), labels).count() == 0
