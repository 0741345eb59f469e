"""Operators whose result is checked row by row against a brute-force version on odd rows."""

import hashlib
import itertools
import random
import re
import struct
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from odd import COPY, ROWS, key, no_documents, odd_documents
from tokenizers import Tokenizer

from conftest import SF0001
from folio.llm import bpe, chat, common, decontam, ngram_join, planes, quality, registry, shards, tagpath

TEXTS = [(r[0], r[1]) for r in ROWS]


def rows(df, *cols):
    return sorted(((tuple(r)) for r in (df.select(*cols) if cols else df).collect()), key=key)


# Sharding -------------------------------------------------------------------------------------------

def brute_shards(texts, n):
    items = sorted(((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts), key=key)
    total, at, out, slots = sum(x[1] for x in items), 0, [], Counter()
    for i, size, crc in items:
        shard = min(n - 1, (2 * at + size) * n // (2 * total))
        out.append((i, size, crc, shard, slots[shard]))
        slots[shard] += 1
        at += size
    return sorted(out, key=key)


@pytest.mark.parametrize("n", [1, 3, 24])
def test_shards_match_brute_force(spark, n):
    got = shards.byte_shards(odd_documents(spark), n)
    assert rows(got, "doc_id", "size", "text_crc32", "shard", "slot") == brute_shards(TEXTS, n)


def test_shards_balance_and_are_contiguous(spark):
    got = registry.QUERIES["op2_sharding"](spark, SF0001).toPandas().sort_values(["shard", "slot"])
    assert got["doc_id"].is_monotonic_increasing and set(got["law"]) == {"bytes"} and got["grown_shard"].isna().all()
    by = got.groupby("shard")
    assert all(list(x) == list(range(len(x))) for _, x in by["slot"])
    assert (by["size"].sum() - got["size"].sum() / 24).abs().max() <= got["size"].max()


def test_shards_are_written_whole(spark):
    docs = odd_documents(spark)
    path = common.new_path(spark, "t")
    shards.write_shards(docs, path, 3)
    assert rows(spark.read.parquet(path), *docs.columns) == rows(docs)


# Chat formatting ------------------------------------------------------------------------------------

CHATS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 1, "assistant", "tie"), (1, 1, "assistant", "tie"), (1, None, "system", ""),
    (2, 5, "assistant", "</turn>"), (2, 6, "odd: role\n</turn>### x", "### user: hi</turn>\n### assistant: "), (2, 7, None, "\\b\\l\\h\\\\"),
    (3, 0, "user", "#### </turn</turn>></turn>\n"), (3, 1, "assistant", "é🎉" * 30000), (None, 0, "user", "no id"), (4, 0, "assistant", "\\"),
    (5, 0, "user", "###"), (5, 1, "assistant", " ### "), (6, 0, "user", "</turn"), (6, 1, "user", ">"), (7, 0, "user", "a\\lb"),
]


def test_chats_read_back(spark):
    given = spark.createDataFrame([(*r, "own") for r in CHATS], "conv_id long, turn long, role string, text string, formatted string")
    got = {r["conv_id"]: r for r in chat.read_chats(common.stored(chat.format_chats(given), "t")).collect()}
    want = {}
    for c, t, role, text in sorted(CHATS, key=lambda r: ((r[1] is not None, r[1] or 0), r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert set(got) == set(want)
    for c, turns in want.items():
        assert [tuple(t) for t in got[c]["turns"]] == turns
        assert got[c]["loss_text"] == "".join(t for r, t in turns if r == "assistant")
        assert got[c]["formatted"].count(chat.END) == got[c]["formatted"].count(chat.HEAD) == len(turns)
        assert got[c]["level"] == (0 if not any(re.search(r"</turn>|### |\\[blh]", t) for _, t in turns) else 1)


def test_no_chats(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_chats(chat.format_chats(empty)).count() == 0


# Token ids ------------------------------------------------------------------------------------------

def test_planes_read_back(spark):
    library = Tokenizer.from_file(P.path(planes.VOCABULARY))
    library.encode_special_tokens = True
    extra = odd_documents(spark)
    order = sorted(enumerate(TEXTS), key=lambda x: ((x[1][0] is not None, x[1][0] or 0), x[0]))
    want, at = [], 0
    for _, (i, t) in order:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        want.append((None if i is None else str(i), at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    for bits, block, segment in ((False, 1 << 14, 1 << 20), (True, 64, 300)):
        path = common.new_path(spark, "t")
        planes.write_ids(extra, path, P.path(planes.VOCABULARY), block, segment, bits)
        assert sorted(rows(planes.read_digests(spark, path)), key=lambda r: r[1]) == want
        assert planes.read_ids(spark, path).count() == len(want)
    path = common.new_path(spark, "t")
    planes.write_ids(no_documents(spark), path, P.path(planes.VOCABULARY))
    assert planes.read_digests(spark, path).count() == 0


@pytest.mark.parametrize("bits", [False, True])
def test_planes_round_trip(bits):
    ids = np.random.default_rng(0).integers(0, 2 ** 32, 1000, dtype=np.uint32)
    assert (planes.unpack(*planes.pack(ids, 64, bits), bits) == ids).all()
    assert len(planes.unpack(*planes.pack(ids[:0], 64, bits), bits)) == 0


@pytest.mark.parametrize("size, overlap", [(bpe.CHUNK, bpe.OVERLAP), (300, 40), (64, 24)])
def test_bpe_matches_the_library(spark, size, overlap):
    ranks = bpe.load_ranks(P.path(bpe.RANKS))
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, t in TEXTS:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    got = bpe.bpe_digests(odd_documents(spark), P.path(bpe.RANKS), size=size, overlap=overlap)
    assert rows(got) == sorted(want, key=key)
    assert bpe.bpe_digests(no_documents(spark), P.path(bpe.RANKS)).count() == 0


def test_bpe_chunks_are_not_joined(spark):
    """Texts that cannot be stitched are marked where their chunks are stitched: no join deals all chunks again."""
    coded = bpe.bpe_digests(odd_documents(spark), P.path(bpe.RANKS))
    assert "Join" not in coded._jdf.queryExecution().toString()


# Quality rules --------------------------------------------------------------------------------------

def brute_figures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    count = Counter(windows)
    repeated = {j for i, w in enumerate(windows) if count[w] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(repeated))


def test_figures_match_brute_force(spark):
    got = odd_documents(spark).select("doc_id", quality.figures("text").alias("f")).select(
        "doc_id", "f.n_words", "f.word_chars", "f.n_symbols", "f.n_dup_lines", "f.n_repeat_words")
    assert rows(got) == sorted(((i, *brute_figures(t)) for i, t in TEXTS), key=key)


def test_votes_weigh_by_accuracy():
    rng = np.random.default_rng(3)
    good = rng.random(4000) < 0.8
    wrong = np.array([0.004, 0.004, 0.3])  # chance that a rule rejects a good document
    right = np.array([0.9, 0.8, 0.35])
    bad_vote = rng.random((4000, 3)) < np.where(good[:, None], wrong, right)
    votes = np.where(rng.random((4000, 3)) < 0.1, quality.ABSTAIN, np.where(bad_vote, quality.BAD, quality.GOOD))
    patterns, at, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    model = quality.fit_votes(patterns, counts.astype(float))
    assert ((model["posterior"][at.ravel()] >= 0.5) == good).mean() > 0.96
    assert abs(model["prior"] - 0.8) < 0.08


def test_quality_keeps_columns_and_clean_rows(spark):
    odd = odd_documents(spark).withColumn("doc_id", F.col("doc_id") + 1_000_000)
    docs = odd.unionByName(common.documents(spark, SF0001), allowMissingColumns=True)
    got = quality.keep_good(docs)
    assert got.columns == docs.columns
    kept = {r["doc_id"] - 1_000_000 for r in got.where("doc_id > 900000").collect()}
    assert {5, 11, 16} <= kept and not kept & {3, 9, 7, 15, 13, 21}
    assert quality.keep_good(odd).count() <= odd.count()
    assert quality.keep_good(no_documents(spark)).count() == 0


# N-gram Jaccard join --------------------------------------------------------------------------------

def brute_components(texts):
    sets = []
    for _, t in texts:
        w = [x.decode() for x in (t or "").encode().lower().split()]
        sets.append({tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set())
    up = list(range(len(texts)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * len(sets[i] | sets[j]):
                up[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(texts):
        ids = [texts[j][0] for j in range(len(texts)) if find(j) == find(i) and texts[j][0] is not None]
        out.append((d, len(sets[i]), min(ids) if ids and sets[i] else d))
    return sorted(out, key=key)


def test_components_match_brute_force_on_odd_rows(spark):
    assert rows(ngram_join.jaccard_components(odd_documents(spark))) == brute_components(TEXTS)
    assert ngram_join.jaccard_components(no_documents(spark)).count() == 0


@pytest.mark.parametrize("seed, rounds", [(0, 2), (1, 0), (2, 1)])
def test_components_match_brute_force_on_copies(spark, seed, rounds, monkeypatch):
    """Chains of ever more edited copies, a common passage, many short texts of few words."""
    monkeypatch.setattr(ngram_join.linked_sets, "__defaults__", (rounds,))
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 500)
    rng = np.random.default_rng(seed)
    passage = [f"p{i}" for i in range(30)]
    texts = []
    for g in range(12):
        words = [f"w{x}" for x in rng.integers(0, 300, rng.integers(20, 150))]
        for _ in range(rng.integers(1, 9)):
            texts.append(" ".join(words + (passage if g % 3 == 0 else [])))
            for _ in range(rng.integers(0, 3)):
                words[rng.integers(len(words))] = f"e{rng.integers(1000)}"
    texts += [" ".join(f"s{x}" for x in rng.integers(0, 3, rng.integers(1, 9))) for _ in range(40)]
    data = [(int(i), t) for i, t in zip(rng.permutation(len(texts)), texts)]
    got = ngram_join.jaccard_components(spark.createDataFrame(data, "doc_id long, text string").repartition(5))
    assert rows(got) == brute_components(data)


@pytest.mark.parametrize("seed", [0, 1])
def test_crowds_of_near_copies_are_not_paired(spark, seed, monkeypatch):
    """Copies around the bound, of which many link to nobody: all links are found, by few pairs a row, without any star round."""
    monkeypatch.setattr(ngram_join.linked_sets, "__defaults__", (0,))
    rng = np.random.default_rng(seed)
    base, other = [f"w{x}" for x in range(150)], [f"v{x}" for x in range(150)]
    texts = []
    for i in range(240):
        words = list(base if i % 4 else other)
        for p in rng.integers(0, len(words), rng.integers(0, 9)):
            words[p] = f"e{rng.integers(40 if i % 3 else 100000)}"
        texts.append(" ".join(words[:len(words) - int(rng.integers(0, 6))]))
    data = [(int(i), t) for i, t in zip(rng.permutation(len(texts)), texts)]
    counted, linking = [], ngram_join.linking

    def counting(pairs, cells, num, den):
        counted.append(pairs.count())
        return linking(pairs, cells, num, den)

    monkeypatch.setattr(ngram_join, "linking", counting)
    got = rows(ngram_join.jaccard_components(spark.createDataFrame(data, "doc_id long, text string").repartition(5)))
    want = brute_components(data)
    assert got == want
    assert sum(1 for d, _, c in want if d == c) > 40  # many rows stay alone
    assert sum(counted) < 4 * len(data)


def test_phases_without_links_start_few_jobs(spark):
    """Each job's plan and tasks stay in the driver for a while: sums are taken while tables are written, and phases without links end."""
    docs = spark.createDataFrame([(i, " ".join(f"u{i}_{j}" for j in range(30))) for i in range(50)], "doc_id long, text string").repartition(3)
    spark.sparkContext.setJobGroup("few-jobs", "few-jobs")
    try:
        assert ngram_join.keep_one(docs).count() == 50
    finally:
        for key in ("spark.jobGroup.id", "spark.job.description"):
            spark.sparkContext.setLocalProperty(key, None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("few-jobs")) <= 60


def test_accumulated_counts_decide(spark):
    """Cells of four blocks: the first block's counts drop no pair that links, and most of those that cannot."""
    rng = np.random.default_rng(5)
    top = [int(x) for x in rng.integers(0, 1 << 64, 400, dtype=np.uint64)]
    sets = [set(top[i:i + 100]) for i in [*range(0, 20, 2), *range(30, 300, 15)]] + [set(top[200:201]), set(top[200:203]), set(top[200:203])]
    cells = [(i, len(s), b, [x - (1 << 64) if x >> 63 else x for x in sorted(s) if x >> 62 == b]) for i, s in enumerate(sets) for b in range(4)]
    pairs = [(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets))]
    cells = spark.createDataFrame(cells, "sig long, n int, block int, hashes array<long>")
    pairs, links = spark.createDataFrame(pairs, "a long, b long"), [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    assert rows(ngram_join.linking(pairs, cells, 85, 100)) == links
    left = {(r["a"], r["b"]): r["overlap"] for r in ngram_join.first_counts(pairs, cells, 85, 100).collect()}
    assert set(links) <= set(left) and 2 * len(left) < pairs.count()
    assert all(n == len([x for x in sets[a] & sets[b] if x >> 62 == 0]) for (a, b), n in left.items())


@pytest.mark.parametrize("large", [2, 1 << 10])
def test_components_large_and_small(spark, large, monkeypatch):
    monkeypatch.setattr(ngram_join, "LARGE", large)
    data = [(None, " ".join(f"c{j}" for j in range(9)))] + [(100 - i, " ".join(f"c{j}" for j in range(9))) for i in range(50)]
    data += [(200 + i, f"p{i // 3} q{i // 3}") for i in range(9)] + [(300, "alone here"), (301, None), (301, None), (None, "nobody else")]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    assert rows(ngram_join.jaccard_components(docs)) == brute_components(data)
    assert sorted(((r[0],) for r in ngram_join.keep_one(docs).select("doc_id").collect()), key=key) == sorted(
        [(51,), (200,), (203,), (206,), (300,), (301,), (301,), (None,)], key=key)


def test_one_of_each_group_stays(spark):
    docs = odd_documents(spark)
    got = ngram_join.keep_one(docs)
    assert got.columns == docs.columns
    ids = [r["doc_id"] for r in got.collect()]
    assert ids.count(2) == 1 and 16 not in ids and 17 not in ids and ids.count(11) == 1 and ids.count(9) == 2 and 3 in ids and None in ids
    assert ids.count(-5) == 1 and -4 not in ids


@pytest.fixture
def shifting(spark, monkeypatch, tmp_path):
    """A file read whose splits, and with them the places of its rows, are others after each table that is stored."""
    texts = [" ".join(f"t{i // 2}w{j}" for j in range(60)) for i in range(80)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/docs")
    cores = itertools.cycle(["1", "5", "9"])
    write = common.stored

    def stored(df, name, *how):
        spark.conf.set("spark.sql.files.minPartitionNum", next(cores))
        return write(df, name, *how)

    for module in (common, ngram_join, decontam):
        monkeypatch.setattr(module, "stored", stored)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield spark.read.parquet(f"{tmp_path}/docs"), list(enumerate(texts))
    for k in ("spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes"):
        spark.conf.unset(k)


def test_rows_keep_their_numbers_when_splits_change(spark, shifting):
    docs, texts = shifting
    assert rows(ngram_join.keep_one(docs), "doc_id") == [(i,) for i in range(0, 80, 2)]
    items = spark.createDataFrame([(1, texts[5][1]), (2, texts[61][1])], "item_id long, text string")
    assert rows(decontam.drop_contaminated(docs, items), "doc_id") == [(i,) for i in range(80) if i // 2 not in (2, 30)]


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, x) for x in range(101, 130)] + [(500, 400)]
    got = dict(rows(ngram_join.components(spark.createDataFrame(links, "a long, b long"))))
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 130)}, 400: 400, 500: 400}


# Decontamination ------------------------------------------------------------------------------------

ITEMS = [(1, " ".join(f"word{i}" for i in range(3, 25))), (2, "one two"), (2, "three four"), (3, None), (4, "..."), (5, "hello"), (None, "hund und"),
         (6, "zzz the quick"), (7, "word1 word2 word3 word1 word2 word3 word1 word2 word3 word1"), (5, "hello")]


def brute_contamination(texts, items):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower().decode())
    out = []
    for i, t in texts:
        w, hit, named = cut(t), set(), set()
        at = {}
        for p, x in enumerate(w):
            at.setdefault(x, []).append(p)
        for item, text in items:
            v = cut(text)
            n = min(10, len(v))
            for s in range(len(v) - n + 1 if n else 0):
                for p in at.get(v[s], []):
                    if w[p:p + n] == v[s:s + n]:
                        hit.update(range(p, p + n))
                        named.add("" if item is None else str(item))
        out.append((i, len(w), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=key)


def test_contamination_matches_brute_force(spark):
    docs = odd_documents(spark)
    items = spark.createDataFrame([(*r, 1, 2) for r in ITEMS], "item_id long, text string, row long, off long")
    got = decontam.contamination(docs, items).drop("row")
    assert rows(got) == brute_contamination(TEXTS, ITEMS)
    assert decontam.contamination(no_documents(spark), items).count() == 0
    assert not any(r["contaminated"] for r in decontam.contamination(docs, items.where("false")).collect())
    clean = decontam.drop_contaminated(docs, items)
    assert clean.columns == docs.columns and clean.count() == sum(not r[-1] for r in brute_contamination(TEXTS, ITEMS))


def brute_near(texts, items, slop, width):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower().decode())
    count = Counter(x for _, t in texts for x in cut(t))
    out = []
    for i, t in texts:
        w, named = cut(t), set()
        at = {}
        for p, x in enumerate(w):
            at.setdefault(x, []).append(p)
        for item, text in items:
            v = cut(text)
            n = min(width, len(v))
            for s in range(len(v) - n + 1 if n else 0):
                offs = range(s, s + n)
                if all(count[v[o]] for o in offs):
                    rare = min(offs, key=lambda o: (count[v[o]], o))
                    if any(all(any(abs(q - (p - rare + o)) <= slop for q in at.get(v[o], [])) for o in offs) for p in at.get(v[rare], [])):
                        named.add("" if item is None else str(item))
        out.append((i, len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()))
    return sorted(out, key=key)


@pytest.mark.parametrize("slop,width", [(0, 10), (1, 3), (3, 10), (3, 4)])
def test_proximity_matches_brute_force(spark, slop, width):
    rnd = random.Random(slop * 100 + width)
    passage = [f"p{i}" for i in range(14)]
    texts = list(TEXTS)
    for i in range(40):  # passages with words inserted, left out, exchanged
        w = list(passage)
        for _ in range(rnd.randint(0, 4)):
            at = rnd.randrange(len(w))
            w[at:at + rnd.randint(0, 1)] = rnd.choice([[], ["x"], ["x", "y", "z"], [w[at - 1]]])
        texts.append((1000 + i, " ".join(["a"] * rnd.randint(0, 5) + w + ["p3"] * rnd.randint(0, 2))))
    items = [*ITEMS, (9, " ".join(passage)), (10, "p3 p3 p4"), (11, "never seen"), (12, "x y z x y z")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = decontam.contamination(docs, spark.createDataFrame(items, "item_id long, text string"), width, slop=slop)
    assert rows(got, "doc_id", "n_near", "near_sha256") == brute_near(texts, items, slop, width)
    if not slop:
        assert not got.where("n_near <> n_items or near_sha256 <> items_sha256").count()


def test_long_item_is_checked_around_its_seeds(spark):
    long = [f"w{i}" for i in range(50_000)]
    docs = spark.createDataFrame([(1, " ".join(long[200:215])), (2, "w7 " + "w8 " * 9), (3, " ".join(long[30_000:31_000]))], "doc_id long, text string")
    got = decontam.contamination(docs, spark.createDataFrame([(1, " ".join(long))], "item_id long, text string"), slop=2)
    assert rows(got, "doc_id", "n_hit", "n_near") == [(1, 15, 1), (2, 0, 0), (3, 1000, 1)]


# Pages ----------------------------------------------------------------------------------------------

PAGE = """<html><head><title>T</title></head><body><header class="site"><h1>Site, name.</h1></header><div id="cookie-banner">We use cookies, OK?</div>
<nav><ul><li><a href=/x>Menu</a></ul></nav><{0}><h1>Title here</h1><p>First para, with &eacute; text. And   more.<p>Second &lt;b&gt; para, <b>short.
<ul><li>one item, yes<li>two items</ul><form><p>Sign, up, please, now.</p><input></form><p>Ok.</p><div class="comments"><p>Nice, post! really.</p></div></{1}>
<aside><p>Related, stuff. here.</p></aside><script>var x = "<p>no</p>";</script><!-- <p>no</p> --><footer><p>(c) me, you. them.</p></footer></body></html>"""
MAIN = "Title here\n\nFirst para, with é text. And more.\n\nSecond <b> para, short.\n\none item, yes\n\ntwo items\n\nOk."


@pytest.mark.parametrize("open_, close", [("article", "article"), ("main", "main"), ('div class="content"', "div"), ('div class="post-body"', "div"), ("section", "section")])
def test_main_text(open_, close):
    assert tagpath.main_text(PAGE.format(open_, close)) == MAIN


def test_pages_with_odd_rows(spark):
    pages = [(1, "u", PAGE.format("article", "article")), (2, None, None), (None, "u", ""), (3, "u", "just text < 3 &amp; more"), (3, "u", "<p>a<br>b</p><!-- x"),
             (4, "u", "<article>" + "<p>word, word.</p>" * 20000), (5, "u", "<nav>menu</nav>"), (6, "u", "<p>it's <a title=it's href=x>l</a> don't")]
    got = tagpath.main_texts(spark.createDataFrame([(*p, "own") for p in pages], "page_id long, url string, html string, text string"))
    want = [MAIN, "", "", "just text < 3 & more", "a b", "\n\n".join(["word, word."] * 20000), "", "it's l don't"]
    assert rows(got) == sorted(((p[0], p[1], t, len(t)) for p, t in zip(pages, want)), key=key)
    assert tagpath.main_texts(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("open_, close", [("article", "article"), ("div", "div")])
@pytest.mark.parametrize("middle", [
    "<ul>" + "<li>an item of thirty characters</li>" * 40 + "</ul>", "<table>" + "<tr><td>cell</td><td>7</td></tr>" * 25 + "</table>",
    "<pre>" + "one long line, of code. " * 210 + "</pre>", "<blockquote>" + "a word, a word. " * 630 + "</blockquote>"])
def test_lists_tables_and_paragraphs_stay_beside_long_blocks(open_, close, middle):
    before = "".join(f"<p>{i} " + "Some plain words, and more of them. " * n + "</p>" for i, n in enumerate([14] * 10 + [8] * 20))
    menu = "<section><ul>" + "<li><a href=/x>Some menu item</a></li>" * 9 + "</ul></section>"
    want = re.sub(r"(\s*<[^>]*>\s*)+", "\n\n", before + middle + before).strip()
    assert tagpath.main_text(f"<body>{menu}<{open_}>{before}{middle}{before}</{close}></body>") == want


BODY = "<p>First para, with some text.</p><p>Second, as well.</p>"


@pytest.mark.parametrize("page, want", [
    *((f'<div class="{c}"><{e}>{BODY}</{e}></div>', BODY) for e in ("article", "main", 'div class="post"', "section")
      for c in ("content has-sidebar", "layout no-sidebar", "with-banner", "page-search-off", "post share-enabled")),
    *((f'<div class="{c}"><{e}>{BODY}</{e}></div>', BODY) for e in ("article", "main") for c in ("sidebar-right", "page search", "paywall")),
    *((f'<{e} class="{c}"><h1>A title</h1></{e}><div class="entry">{BODY}</div>', "<h1>A title</h1>" + BODY) for e in ("div", "header")
      for c in ("entry-header", "post-header")),
    (f'<article><div class="entry-header"><h1>A title</h1></div>{BODY}</article>', "<h1>A title</h1>" + BODY),
    # What is other stays out: teasers, comments, menus, banners.
    (f'<article>{BODY}<div class="comments"><article><p>Nice.</p></article></div></article>', BODY),
    (f'<main>{BODY}<div class="related"><article><p>Teaser.</p></article></div></main>', BODY),
    (f'<div class="sidebar"><div class="post">Old, post.</div></div><article>{BODY}</article>', BODY),
    (f'<div class="cookie-banner">We, use.</div><header class="site-header">Site.</header><nav><article>x</article></nav><div>{BODY}</div>', BODY)])
def test_names_of_layout_do_not_empty_a_page(page, want):
    assert tagpath.main_text(f"<html><body>{page}</body></html>") == re.sub(r"(<[^>]*>)+", "\n\n", want).strip()


# SQL ------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_matches_its_sql(spark, name):
    got = registry.QUERIES[name](spark, SF0001)
    c = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        c.execute(f"create view {t} as select * from '{SF0001}/{t}.parquet'")
    want = c.execute(registry.SQL[name])
    cols = [x[0] for x in want.description]
    assert set(cols) == set(got.columns)
    assert rows(got, *cols) == sorted(want.fetchall(), key=key)
