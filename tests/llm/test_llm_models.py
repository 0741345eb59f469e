"""Trained operators: exact recursions against enumeration, held-out figures, odd rows; and the pipeline."""

import itertools
import zlib
from collections import Counter

import numpy as np
import pytest
from odd import ROWS, no_documents, odd_documents
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF0001
from folio.llm import hmm, langid, registry
from folio.llm.chain import Chain
from folio.llm.common import documents, fold_of

SF001 = SF0001.replace("0.001", "0.01")


@pytest.mark.parametrize("n", [1, 2, 5, 9])
def test_chain_matches_enumeration(n):
    rng = np.random.default_rng(n)
    k = 3
    A, pi, E = rng.random((k, k)), rng.random(k), rng.random((n, k)) + 0.01
    starts = rng.random(n) < 0.3
    starts[0] = True
    _, log, gamma, counts = Chain(A, pi).run(E, starts)
    cuts = [*np.flatnonzero(starts), n]
    want_counts = np.zeros((k, k))
    for a, b in zip(cuts, cuts[1:]):
        total, seen = 0.0, np.zeros((b - a, k))
        steps = np.zeros((k, k))
        for path in itertools.product(range(k), repeat=b - a):
            p = pi[path[0]] * np.prod([A[i, j] for i, j in zip(path, path[1:])]) * np.prod([E[a + t, s] for t, s in enumerate(path)])
            total += p
            for t, s in enumerate(path):
                seen[t, s] += p
            for i, j in zip(path, path[1:]):
                steps[i, j] += p
        assert np.isclose(log[a:b].sum(), np.log(total)) and np.allclose(gamma[a:b], seen / total)
        want_counts += steps / total
    assert np.allclose(counts, want_counts)


def test_chain_does_not_underflow_on_long_sequences():
    rng = np.random.default_rng(0)
    E = rng.random((50_000, 4)) * 1e-12
    starts = np.zeros(50_000, bool)
    starts[0] = True
    A = rng.dirichlet(np.ones(4), 4)
    alpha, log, gamma, _ = Chain(A, np.ones(4) / 4).run(E, starts)
    now, want = None, 0.0
    for t in range(len(E)):
        now = (np.ones(4) / 4 if t == 0 else now @ A) * E[t]
        want += np.log(now.sum())
        now /= now.sum()
    assert np.isclose(log.sum(), want) and np.isfinite(gamma).all()


# Language model ---------------------------------------------------------------------------------------

def brute_base(rows, held_out):
    tokens = {k: (t or "").encode().lower().split() + [b" "] for k, (_, t) in enumerate(rows)}
    c = Counter(w for k, (i, _) in enumerate(rows) if not held_out(i) for w in tokens[k])
    n, v = sum(c.values()), len(c)
    return sorted((("" if i is None else str(i)), len(w), sum(c[x] > 0 for x in w), n, round(sum(np.log10((c[x] + 1) / (n + v + 1)) for x in w), 6))
                  for k, (i, _) in enumerate(rows) for w in [tokens[k]])


@pytest.mark.parametrize("heads", [hmm.HEADS, 40])
def test_base_scores_on_odd_rows(spark, heads):
    got = hmm.score(odd_documents(spark), fold_of("doc_id", 7) != 2, heads=heads).collect()
    rows = [(r[0], r[1]) for r in ROWS]
    fold = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    have = sorted((("" if r["doc_id"] is None else str(r["doc_id"])), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got)
    for a, b in zip(have, brute_base(rows, fold), strict=True):
        assert a[:4] == b[:4] and np.isclose(a[4], b[4])
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_lm_without_training_rows_or_rows(spark):
    assert all(np.isfinite(r["score"]) for r in hmm.score(odd_documents(spark), F.lit(False)).collect())
    assert hmm.score(no_documents(spark), F.lit(True)).count() == 0


def test_lm_is_a_distribution_over_words(spark):
    """The chances of all known words and one unknown word for each tail class, after an empty text, sum to one."""
    words = ["the", "house", "garden", "stone", "river", "alone", "bone"]
    train = [(i, " ".join(words[:1 + i % 7])) for i in range(60)]
    # An unseen word of each tail class stands for all unseen words of that class.
    seen, extra, k = {hash_tail(w) for w in [*words]}, {}, 0
    while len(extra) < hmm.TAILS and k < 400_000:
        w = f"q{k}"
        extra.setdefault(hash_tail(w), w)
        k += 1
    assert seen
    probes = [(1000 + i, w) for i, w in enumerate([*words, *extra.values()])]
    docs = spark.createDataFrame(train + probes, "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in hmm.score(docs, F.col("doc_id") < 1000, heads=4).collect()}
    # P(word, end) for one-word texts and P(end) for the empty text: all texts of at most one word hold less than one.
    assert 0 < sum(10 ** got[i] for i, _ in probes) < 1


def hash_tail(w):
    import xxhash

    return xxhash.xxh32_intdigest(w.encode()[-hmm.SUFFIX:]) % hmm.TAILS


def test_lm_beats_the_base_on_held_out_texts(spark):
    got = registry.QUERIES["op4_hmm_scoring"](spark, SF001).where("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert got[0] - got[1] > 0.1 * got[2]


# Language identification ------------------------------------------------------------------------------

def test_languages_of_held_out_texts(spark):
    got = (registry.QUERIES["op1_language_id"](spark, SF001).where("held_out")
           .join(documents(spark, SF001).select("doc_id", "lang"), "doc_id").where("lang is not null"))
    right, n = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 200 and right > 0.97


def test_languages_of_odd_rows(spark):
    got = langid.identify(odd_documents(spark)).collect()
    none = {3, 9, 7, 15}
    assert len(got) == len(ROWS)
    assert all((r["lang_pred"] == "und" and r["score"] == 0) == (r["doc_id"] in none) for r in got)
    assert all(0 <= r["score"] <= 1 and r["held_out"] == (zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 3 == 1) for r in got)
    kept = langid.keep_identified(odd_documents(spark))
    assert kept.columns == odd_documents(spark).columns and not {r["doc_id"] for r in kept.collect()} & none
    assert langid.identify(no_documents(spark)).count() == 0
    unlabelled = odd_documents(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.identify(unlabelled).collect()} == {"und"}


def test_every_label_is_learned(spark, monkeypatch):
    """More labels than MANY, the last ones of fewest texts."""
    monkeypatch.setattr(langid, "BITS", 12)
    monkeypatch.setattr(langid.train, "__defaults__", (600, 12, 3, 0.3, 7))
    rng = np.random.default_rng(3)
    words = ["".join(map(chr, rng.integers(97, 123, 6))) for _ in range(70 * 12)]
    rows = [(i * 100 + j, " ".join(rng.choice(words[12 * i:12 * i + 12], 20)), f"l{i:02}") for i in range(70) for j in range(9 if i < 64 else 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs).collect()}
    assert {r[2] for r in rows} == set(got.values()) and sum(got[i] == lang for i, _, lang in rows) > 0.95 * len(rows)


def test_spans_follow_a_language_switch(spark):
    docs = documents(spark, SF001)
    crf = langid.learn(docs)
    texts = {x: docs.where((F.col("lang") == x) & (fold_of() == 1) & (F.col("n_chars") > 800)).orderBy("doc_id").first()["text"][:400] for x in ("de", "es")}
    mixed = spark.createDataFrame([(1, texts["de"] + " " + texts["es"])], "doc_id long, text string")
    spans = langid.language_spans(mixed, crf).orderBy("first_word").collect()
    n = len(langid.words_of(texts["de"]))
    right = sum(max(0, min(r["first_word"] + r["n_words"], n) - r["first_word"]) for r in spans if r["lang"] == "de")
    right += sum(max(0, r["first_word"] + r["n_words"] - max(r["first_word"], n)) for r in spans if r["lang"] == "es")
    assert right > 0.9 * sum(r["n_words"] for r in spans)


# Pipeline ---------------------------------------------------------------------------------------------

def test_pipeline_equals_its_operators(spark):
    """Each stage keeps just what its operator's own query says of the documents before it."""
    from test_llm_rows import brute_components, brute_contamination, brute_figures

    docs = documents(spark, SF0001)
    items = [tuple(r) for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        docs = stage(spark, docs, SF0001)
        assert docs.columns == columns
        after = sorted(r["doc_id"] for r in docs.collect())
        if name == "quality_rules":
            failed = {i for i, t in before if (f := brute_figures(t))[0] < 10 or 100 * f[4] > 20 * f[0]}
            assert not failed & set(after)
            labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF0001}/labels.parquet").collect()}
            assert all(labels.get(i, 1) == 1 for i in after)
            assert all(i in after for i, _ in before if labels.get(i) == 1 and i not in failed)
        elif name == "language_id":
            assert after == sorted(i for i, _ in before)
        elif name == "ngram_jaccard_join":
            assert after == sorted(i for i, n, c in brute_components(before) if i == c or not n)
        else:
            assert after == sorted(r[0] for r in brute_contamination(before, items) if not r[-1])
    out = corpus_pipeline.run(spark, SF0001).collect()
    assert sorted(r["doc_id"] for r in out) == after and len({r["doc_id"] for r in out}) == len(out)


def test_pipeline_drops_near_copies_by_five_words_and_80_percent(spark):
    words = [f"w{i}" for i in range(200)]
    changed = [f"x{i}" if i in (40, 80, 120, 160) else w for i, w in enumerate(words)]  # 0.815 by five words, 0.8498 by four
    more = [f"x{i}" if i in (20, 40, 80, 120, 160) else w for i, w in enumerate(f"o{i}" for i in range(200))]  # 0.774 by five words
    texts = [words, changed, [f"o{i}" for i in range(200)], more]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    stage = dict(corpus_pipeline.STAGES)["ngram_jaccard_join"]
    assert sorted(r["doc_id"] for r in stage(spark, docs, SF0001).collect()) == [0, 2, 3]


def test_pipeline_on_odd_rows(spark):
    for make in (odd_documents, no_documents):
        docs = make(spark)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF0001)
            docs.collect()


def test_tail_words_learn_their_counts_from_any_partition(spark, tmp_path):
    """Each block asks once for each distinct tail word; all hash partitions answer in the order asked, with 0 for words never seen in training."""
    rng = np.random.default_rng(3)
    docs = [(i, " ".join(f"w{x}" for x in rng.integers(0, 400, 50))) for i in range(60)]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    blocks = hmm.stored_blocks(table, F.col("doc_id") < 40)
    counts = hmm.word_counts(blocks)
    true = {r["word"]: r["c"] for r in counts.collect()}
    heads = np.sort(np.array(list(true)[:20], np.int64).view(np.uint64))
    asked = 0
    told = {r["block"]: {m["part"]: m["counts"] for m in r["answers"]} for r in hmm.told_counts(
        blocks, counts.where(~F.col("word").isin([int(x) for x in heads.view(np.int64)])), heads, 7).collect()}
    for r in blocks.collect():
        block = hmm.Block(r)
        tails, parts = block.tail_words(block.classes(heads), len(heads), 7)
        assert len(parts) > 1 and len(set(tails.tolist())) == len(tails) == len(block.words) - np.isin(block.words, heads).sum()
        for p, a, b in parts:
            assert np.frombuffer(told[r["block"]][p], "<i8").tolist() == [true.get(w, 0) for w in block.words[tails[a:b]].view(np.int64).tolist()]
            asked += b - a
    assert asked < 2000  # 3060 pairs of a text and a tail word at least
    assert all("/share=" in f for f in blocks.inputFiles())  # a round over a share reads its files alone


def test_lm_query_sends_small_batches(spark, monkeypatch):
    """The query asks for small batches of whole texts, where the session left Spark's sizes as they are."""
    names = [f"spark.sql.execution.arrow.{x}" for x in ("maxRecordsPerBatch", "maxBytesPerBatch")]
    before = [spark.conf.get(x) for x in names]
    monkeypatch.setattr(hmm, "documents", lambda spark, sf_dir: None)
    monkeypatch.setattr(hmm, "score", lambda docs, train: spark.range(1).selectExpr(
        "id as doc_id", "true as trained", "1 as n_tokens", "1 as n_known", "1 as train_tokens", "0d as base_score", "0d as score"))
    try:
        for x in names:
            spark.conf.unset(x)
        hmm.op4_hmm_scoring(spark, "")
        assert [int(spark.conf.get(x).rstrip("b")) for x in names] == [2000, 8 << 20]
    finally:
        for x, y in zip(names, before):
            spark.conf.set(x, y)
