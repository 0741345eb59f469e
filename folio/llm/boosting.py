"""A quality classifier: histogram gradient-boosted trees over statistics of a document.

Every whole text becomes one short row of statistics, written once. Trees are grown on a bounded sample
of labelled rows: the statistics are cut into bins at their quantiles, and each level of a tree adds up
gradients and curvatures of all its nodes by (node, bin) and takes the best cut of every node. The
forest is two arrays over complete binary trees, so a batch of documents walks all trees at once, one
numpy step a level.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.llm.common import documents, fold_of, ship, stored

#: Labelled rows to learn from, at most, chosen by hash.
SAMPLE_ROWS = 40_000
TREES, DEPTH, BINS = 60, 4, 64
RATE, RIDGE, LEAST_WEIGHT = 0.15, 1.0, 2.0
ACCEPTED = 0.3

STATISTICS = ["log_words", "log_chars", "word_length", "longest_word", "upper", "digits", "signs", "marks", "stops", "beyond_ascii", "lines_a_word",
              "dup_lines", "ended_lines", "distinct_words", "top_word", "short_words", "repeated_windows", "shouted", "bare_signs", "runs", "capitals",
              "bytes_entropy", "packed", "word_spread"]

_UPPER, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
_SIGNS, _MARKS, _STOPS = b"#*$%&|<>=~^_\\{}[]@/+", b"!?", b".,;:"
_ASCII = bytes(range(128))
_PUNCTUATION = bytes([*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)])
_RUN = re.compile(rb"([!-/:-@\[-`{-~])\1")
WINDOW = 4


def statistics(text: str | None, press) -> list[float]:
    """The statistics of one text; ``press`` compresses bytes."""
    raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""
    words = raw.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n, size = len(words), len(raw)
    part = lambda drop: (size - len(raw.translate(None, drop))) / size
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    often = np.bincount(ids)
    # Repeated windows of WINDOW words, by hash.
    h = np.zeros(max(0, n - WINDOW + 1), np.uint64)
    for i in range(WINDOW):
        h = (h + ids[i:i + len(h)].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    tally = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    p = tally[tally > 0] / size
    bare = sum(not w.translate(None, _PUNCTUATION) for w in number)
    return [np.log1p(n), np.log1p(size), lengths.mean(), np.log1p(lengths.max()), part(_UPPER), part(_DIGITS), part(_SIGNS), part(_MARKS), part(_STOPS),
            1 - part(_ASCII), len(lines) / n, 1 - len(set(lines)) / len(lines), sum(x.rstrip()[-1:] in b".!?" for x in lines) / len(lines), len(number) / n,
            often.max() / n, float((lengths <= 3).mean()), 1 - len(np.unique(h)) / len(h) if len(h) else 0.0, raw.count(b"!!") / n, bare / n,
            len(_RUN.findall(raw)) / n, sum(w[:1].isupper() for w in words) / n, float(-(p * np.log2(p)).sum()), len(press(raw)) / size, float(lengths.std())]


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def statistics_of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The statistics of each text, in the order of ``STATISTICS``; all zero for a text without words."""
    import zstandard

    press = zstandard.ZstdCompressor(level=1).compress
    for some in texts:
        yield pd.Series([statistics(t, press) for t in some])


def _leaf(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return -g / (h + RIDGE)


class Forest:
    """Complete binary trees in arrays: node i has the children 2i + 1 (at most the cut) and 2i + 2."""

    def __init__(self, prior: float, feature: np.ndarray, cut: np.ndarray, leaf: np.ndarray):
        self.prior, self.feature, self.cut, self.leaf = prior, feature, cut, leaf

    def arrays(self) -> tuple:
        return self.prior, self.feature, self.cut, self.leaf

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Log odds of each row."""
        out = np.full(len(x), self.prior)
        trees, depth = np.arange(len(self.feature)), int(np.log2(self.leaf.shape[1])) if self.leaf.size else 0
        for i in range(0, len(x), 4096):
            some = x[i:i + 4096]
            at, row = np.zeros((len(some), len(trees)), np.int64), np.arange(len(some))[:, None]
            for _ in range(depth):
                at = 2 * at + 1 + (some[row, self.feature[trees, at]] > self.cut[trees, at])
            out[i:i + 4096] += self.leaf[trees, at - (2 ** depth - 1)].sum(axis=1)
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -500, 500)))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE) -> Forest:
    """Boosted trees for labels 0 and 1 by the second-order log loss. The prior is the smoothed share of
    ones; with one class alone it is the whole forest."""
    prior = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    if not len(y) or y.min() == y.max():
        return Forest(prior, np.zeros((0, 2 ** depth - 1), np.int64), np.zeros((0, 2 ** depth - 1)), np.zeros((0, 2 ** depth)))
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(e, column) for e, column in zip(edges, x.T)], axis=1)  # bin b holds values up to edge b
    n, m = x.shape
    feature = np.zeros((trees, 2 ** depth - 1), np.int64)
    cut = np.full((trees, 2 ** depth - 1), np.inf)  # an uncut node sends all to the left
    leaf = np.zeros((trees, 2 ** depth))
    margin = np.full(n, prior)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            width, first = 2 ** level, 2 ** level - 1
            place = (node - first) * bins
            best = np.full(width, 1e-6)
            total_g, total_h = np.bincount(node - first, g, width), np.bincount(node - first, h, width)
            for j in range(m):
                sum_g = np.bincount(place + binned[:, j], g, width * bins).reshape(width, bins).cumsum(axis=1)[:, :-1]
                sum_h = np.bincount(place + binned[:, j], h, width * bins).reshape(width, bins).cumsum(axis=1)[:, :-1]
                rest_g, rest_h = total_g[:, None] - sum_g, total_h[:, None] - sum_h
                gain = sum_g ** 2 / (sum_h + RIDGE) + rest_g ** 2 / (rest_h + RIDGE) - (total_g ** 2 / (total_h + RIDGE))[:, None]
                gain[(sum_h < LEAST_WEIGHT) | (rest_h < LEAST_WEIGHT)] = 0
                gain[:, len(edges[j]):] = 0
                at = gain.argmax(axis=1)
                better = np.flatnonzero(gain[np.arange(width), at] > best)
                best[better] = gain[better, at[better]]
                feature[t, first + better], cut[t, first + better] = j, edges[j][at[better]]
            node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > cut[t, node])
        ends = node - (2 ** depth - 1)
        leaf[t] = rate * _leaf(np.bincount(ends, g, 2 ** depth), np.bincount(ends, h, 2 ** depth))
        margin += leaf[t, ends]
    return Forest(prior, feature, cut, leaf)


def learn(measured: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, fold: int = 5, held_out: int = 0) -> Forest:
    """A forest from stored statistics (doc_id, x) and ``labels`` (doc_id, quality), without the held-out fold. At
    most ``sample_rows`` labelled ids are used, those of the smallest hashes; an id labelled twice counts as its lowest label."""
    usable = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (fold_of("doc_id", fold) != held_out))
    chosen = (usable.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
              .orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(sample_rows))
    # Rows of one id are reduced to one before they leave their task.
    rows = (measured.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(F.min("x").alias("x"))
            .orderBy("doc_id").select("quality", "x").collect())  # at most sample_rows
    x = np.array([r["x"] for r in rows], float).reshape(-1, len(STATISTICS))
    return grow(x, np.array([r["quality"] > 0 for r in rows], float))


def classify(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, accepted: float = ACCEPTED) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row.

    Defined cases: a null or empty text, or one of white space, has statistics of zero and gets their
    score; without labelled rows every score is 0.5, with labels of one kind their smoothed share; null ids are
    scored but never learned from; repeated rows are scored alike; a long text is measured whole; an empty
    table gives no rows; other columns are ignored.
    """
    measured = stored(docs.select("doc_id", statistics_of("text").alias("x")), "text-statistics")
    arrays = measured.sparkSession.sparkContext.broadcast(learn(measured, labels, sample_rows).arrays())  # TREES * 2 ** DEPTH numbers

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        forest = Forest(*arrays.value)
        for rows in parts:
            yield pd.Series(forest.scores(np.stack(rows.to_numpy())) if len(rows) else [], dtype=float)

    scored = measured.select("doc_id", (fold_of("doc_id", 5) == 0).alias("held_out"), score("x").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= accepted).cast("int"))


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


ship(__name__)
