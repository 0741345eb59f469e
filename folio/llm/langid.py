"""Language identification by a linear-chain conditional random field over words.

Every word of a text gets a label. A word's evidence is the sum of learned weights of its byte
n-grams inside begin and end marks (those that touch a mark are its affixes) and of the word itself
(the lexicon); learned transitions tie neighbouring words. Forward-backward gives each word's label
chances, so a text that switches its language is labelled piece by piece; the text's language is
the label with the largest share of the words' chances.

Features are hashed to a fixed number of weights, so the model has one size for any corpus.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.llm.chain import Chain
from folio.llm.common import documents, fold_of, give_back, ship

#: The bounded training sample: texts of each label, fewer (but LEAST_TEXTS) if there are more labels than MANY, and
#: characters taken from a text. All labels are learned.
TEXTS_PER_LABEL = 800
LEAST_TEXTS = 50
MANY = 64
SNIPPET = 400
#: Hashed weights of each label, fewer beyond MANY labels, so that the model's size stays; n-gram sizes in bytes, marks included.
BITS = 18
ORDERS = (1, 2, 3, 4, 5)
#: Words times labels of one forward-backward call, so that its arrays stay alike for any number of labels; a longer text is one call.
BATCH_CELLS = 1 << 19
UNKNOWN = "und"

_BEGIN, _END = b"\x02", b"\x03"
#: ASCII that is neither letter nor white space does not help.
_DROP = bytes(c for c in range(128) if not chr(c).isalpha() and chr(c) not in " \t\n\v\f\r")


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(None, _DROP).split()


def bits_of(labels: int) -> int:
    """Bits of the hash for so many labels: each doubling beyond MANY takes one, but 10 stay."""
    return max(min(10, BITS), BITS - max(0, (labels - 1) // MANY).bit_length())


def _hash(x: np.ndarray, salt: int, bits: int) -> np.ndarray:
    return ((x + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)


def features(words: list[bytes], bits: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Hashed n-gram ids of each order at each byte of the marked words (2 ** bits where the word
    ends before), the first byte of each word, and the ids of the words themselves."""
    raw = np.frombuffer(_BEGIN + (_END + _BEGIN).join(words) + _END, np.uint8).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words])
    at = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    place = np.arange(len(raw)) - np.repeat(at, sizes)
    left = np.repeat(sizes, sizes) - place  # bytes from here to the word's end
    ids, h = [], np.zeros(len(raw), np.uint64)
    for order in range(1, max(ORDERS) + 1):
        h = h * np.uint64(0x100000001B3) + np.uint64(1)
        h[:len(raw) - order + 1] += raw[order - 1:]
        if order in ORDERS:
            ids.append(np.where(left >= order, _hash(h, order, bits), np.uint64(1 << bits)).astype(np.int64))
    power = np.multiply.accumulate(np.full(sizes.max(), 0x100000001B3, np.uint64))
    return ids, at, _hash(np.add.reduceat(raw * power[place], at), 99, bits).astype(np.int64)


@dataclass
class Crf:
    labels: list[str]
    weights: np.ndarray  # feature (one more row, of zeros), label
    lexicon: np.ndarray  # word id, label
    log_steps: np.ndarray  # from, to
    log_start: np.ndarray

    def scores(self, words: list[bytes]) -> np.ndarray:
        """Evidence of each word for each label."""
        out = np.empty((len(words), len(self.labels)))
        for i in range(0, len(words), 1 << 15):
            part = words[i:i + (1 << 15)]
            ids, at, own = features(part, len(self.lexicon).bit_length() - 1)
            total = sum(self.weights[x] for x in ids)
            out[i:i + len(part)] = np.add.reduceat(total, at, axis=0) + self.lexicon[own]
        return out

    def arrays(self) -> tuple:
        """The model as plain lists and arrays, which a worker without this package can unpickle."""
        return self.labels, self.weights, self.lexicon, self.log_steps, self.log_start

    def chain(self) -> Chain:
        return Chain(np.exp(self.log_steps), np.exp(self.log_start))

    def label(self, texts: list[list[bytes]]) -> Iterator[np.ndarray]:
        """Per text the chances (word, label) of its words; none for a text without words."""
        chain, number = self.chain(), defaultdict()
        number.default_factory = number.__len__
        ids = [np.fromiter(map(number.__getitem__, t), np.int64, len(t)) for t in texts]
        if not number or not self.labels:
            yield from (np.empty((0, len(self.labels))) for _ in texts)
            return
        known = self.scores(list(number))
        known = np.exp(np.maximum(known - known.max(axis=1, keepdims=True), -50))
        sizes = np.array([len(t) for t in texts])
        starts = np.zeros(sizes.sum(), bool)
        at = np.concatenate([[0], np.cumsum(sizes)])
        starts[at[:-1][sizes > 0]] = True
        gamma = chain.run(known[np.concatenate(ids)], starts)[2]
        yield from (gamma[a:b] for a, b in zip(at[:-1], at[1:]))


def train(samples: list[tuple[str, list[bytes]]], sequences: int = 4000, segment: int = 12, rounds: int = 12, rate: float = 0.3,
          seed: int = 7) -> Crf:
    """Fit a CRF on labelled word lists by AdaGrad on the log likelihood.

    Training sequences switch languages: each joins a few segments of random texts of random
    labels, so the transitions learn that neighbours mostly agree and sometimes do not.
    """
    rng = np.random.default_rng(seed)
    labels = sorted({x for x, w in samples if w})
    k, bits = len(labels), bits_of(len(labels))
    sequences = max(sequences, sequences * k // MANY)
    by = [[w for x, w in samples if x == label and w] for label in labels]
    crf = Crf(labels, np.zeros(((1 << bits) + 1, k)), np.zeros((1 << bits, k)), np.log(np.full((k, k), 1 / max(1, k))), np.log(np.full(k, 1 / max(1, k))))
    if k < 2:
        return crf
    made = []
    for _ in range(sequences):
        words, truth = [], []
        for _ in range(1 + rng.poisson(1)):
            y = rng.integers(k)
            text = by[y][rng.integers(len(by[y]))]
            n = 1 + rng.geometric(1 / segment)
            i = rng.integers(max(1, len(text) - n + 1))
            words += text[i:i + n]
            truth += [y] * len(text[i:i + n])
        made.append((words, np.array(truth)))
    squares = [np.full_like(x, 1e-2) for x in (crf.weights, crf.lexicon, crf.log_steps, crf.log_start)]
    batches = np.array_split(np.arange(len(made)), 8)
    ready = []
    for batch in batches:
        number = defaultdict()
        number.default_factory = number.__len__
        ids = np.concatenate([[number[w] for w in made[i][0]] for i in batch])
        truth = np.concatenate([made[i][1] for i in batch])
        starts = np.zeros(len(ids), bool)
        starts[np.cumsum([0] + [len(made[i][0]) for i in batch[:-1]])] = True
        ready.append((list(number), ids, truth, starts, features(list(number), bits)))
    for r in range(rounds * len(ready)):
        words, ids, truth, starts, (grams, at, own) = ready[r % len(ready)]
        known = crf.scores(words)
        known = np.exp(np.maximum(known - known.max(axis=1, keepdims=True), -50))
        _, _, gamma, steps = crf.chain().run(known[ids], starts)
        miss = np.eye(k)[truth] - gamma
        word_miss = np.stack([np.bincount(ids, miss[:, y], len(words)) for y in range(k)], axis=1)
        spread = np.repeat(word_miss, np.diff(np.concatenate([at, [len(grams[0])]])), axis=0)
        gradient = [np.zeros_like(crf.weights), np.zeros_like(crf.lexicon)]
        for y in range(k):
            for x in grams:
                gradient[0][:, y] += np.bincount(x, spread[:, y], (1 << bits) + 1)
            gradient[1][:, y] = np.bincount(own, word_miss[:, y], 1 << bits)
        gradient[0][-1] = 0
        real = np.zeros((k, k))
        np.add.at(real, (truth[:-1][~starts[1:]], truth[1:][~starts[1:]]), 1)
        gradient += [real - steps, miss[starts].sum(axis=0)]
        n = starts.sum()
        for x, g, s in zip((crf.weights, crf.lexicon, crf.log_steps, crf.log_start), gradient, squares):
            g = g / n - 1e-6 * x
            s += g * g
            x += rate * g / np.sqrt(s)
    # Steps and starts as chances: scaling a row changes no label's share once the weights are fitted.
    crf.log_start -= np.log(np.exp(crf.log_start).sum())
    return crf


def learn(docs: DataFrame, texts_per_label: int = TEXTS_PER_LABEL, fold: int = 3, held_out: int = 1) -> Crf:
    """Fit on a bounded sample of the labelled texts outside the held-out fold: at most
    ``texts_per_label`` texts of each label (fewer beyond ``MANY`` labels), those of the
    smallest hashes, copies of a text taken once, and ``SNIPPET`` characters from a hashed place in each."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold_of("doc_id", fold) != held_out))
    hashed = usable.select("lang", "text", F.xxhash64("text").alias("h"))
    counts = hashed.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("n")).collect()  # one row a label, as in the model
    if not counts:
        return train([])
    texts_per_label = min(texts_per_label, max(LEAST_TEXTS, texts_per_label * MANY // len(counts)))
    # Twice the wanted texts by a share of the hashes (with many copies of a text it is one), then the smallest hashes of each label.
    share = usable.sparkSession.createDataFrame([(r["lang"], min(1.0, 2 * texts_per_label / r["n"])) for r in counts], "lang string, share double")
    smallest = Window.partitionBy("lang").orderBy("place", "h")
    drawn = (hashed.join(F.broadcast(share), "lang")
             .withColumn("place", F.expr("pmod(h, 1048576)")).where(F.expr("place < share * 1048576"))
             .select("lang", "h", "place", F.expr(f"substring(text, 1 + cast(pmod(h div 1048576, greatest(length(text) - {SNIPPET}, 1)) as int), {SNIPPET})").alias("snippet"))
             .groupBy("lang", "place", "h").agg(F.min("snippet").alias("snippet"))
             .withColumn("at", F.row_number().over(smallest)).where(F.col("at") <= 2 * texts_per_label).select("lang", "h", "snippet").collect())
    drawn.sort(key=lambda r: (r["lang"], r["h"], r["snippet"]))
    taken: dict[str, list] = defaultdict(list)
    for r in drawn:
        words = words_of(r["snippet"])[1:-1] or words_of(r["snippet"])  # the cut may have hit the outer words
        if words and len(taken[r["lang"]]) < texts_per_label:
            taken[r["lang"]].append((r["lang"], words))
    crf = train([x for label in sorted(taken) for x in taken[label]])
    del drawn, taken
    give_back()  # the driver's: its Python stays beside the later stages of a session
    return crf


def _batches(texts: pd.Series, labels: int) -> Iterator[list[list[bytes]]]:
    batch, size, most = [], 0, BATCH_CELLS // max(4, labels)
    for t in texts:
        words = words_of(t) if isinstance(t, str) and any(map(str.isalpha, t)) else []
        if batch and size + len(words) > most:
            yield batch
            batch, size = [], 0
        batch.append(words)
        size += len(words)
    if batch:
        yield batch


def predictor(spark: SparkSession, crf: Crf):
    """A column function: text -> struct(lang_pred, score)."""
    model = spark.sparkContext.broadcast(crf.arrays())  # (2 ** 19 + 1) * MANY weights at most, until bits_of ends

    @F.pandas_udf("lang_pred string, score double")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        crf = Crf(*model.value)
        for texts in parts:
            out = []
            for batch in _batches(texts, len(crf.labels)):
                for chances in crf.label(batch):
                    if not len(chances) or not crf.labels:
                        out.append((UNKNOWN, 0.0))
                    else:
                        share = chances.mean(axis=0)
                        best = int(share.argmax())
                        out.append((crf.labels[best], float(min(1.0, share[best]))))
            yield pd.DataFrame(out, columns=["lang_pred", "score"])
        crf = texts = batch = chances = None
        give_back()

    return predict


def language_spans(docs: DataFrame, crf: Crf) -> DataFrame:
    """Runs of words with one label: ``doc_id, first_word, n_words, lang``, one row a run."""
    model = docs.sparkSession.sparkContext.broadcast(crf.arrays())

    def spans(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        crf = Crf(*model.value)
        for rows in frames:
            done = 0
            for batch in _batches(rows["text"], len(crf.labels)):
                out = []
                for key, chances in zip(rows["key"].iloc[done:done + len(batch)], crf.label(batch)):
                    best = chances.argmax(axis=1) if len(chances) else np.empty(0, int)
                    cuts = [0, *(np.flatnonzero(np.diff(best)) + 1), len(best)] if len(best) else [0]
                    out += [(key, int(a), int(b - a), crf.labels[best[a]]) for a, b in zip(cuts, cuts[1:])]
                done += len(batch)
                yield pd.DataFrame(out, columns=["key", "first_word", "n_words", "lang"])

    tagged = docs.select(F.col("doc_id").cast("string").alias("key"), "text").mapInPandas(spans, "key string, first_word long, n_words long, lang string")
    return tagged.select(F.col("key").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "first_word", "n_words", "lang")


def identify(docs: DataFrame, crf: Crf | None = None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row.

    Defined cases: a null text and one without a letter is ``und`` with score 0, and so is every
    text if no labelled text can be learned from; with one label all others get it; equal shares go to
    the smaller label; repeated rows are predicted alike; a long text is labelled whole; other columns are ignored.
    """
    crf = crf or learn(docs)
    return (docs.select("doc_id", (fold_of() == 1).alias("held_out"), predictor(docs.sparkSession, crf)("text").alias("p"))
            .select("doc_id", "held_out", "p.lang_pred", "p.score"))


#: Below this share of the words' chances no language holds a text.
MIN_SHARE = 0.35


def keep_identified(docs: DataFrame, min_share: float = MIN_SHARE) -> DataFrame:
    """The documents with a language: not ``und``, and its share at least ``min_share``.

    Defined cases: a null text and one without a letter goes; without labelled texts all go; repeated rows
    stay or go together; an empty table stays empty; all columns pass through, and names cannot clash (the input row
    is carried as a struct).
    """
    carried = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), predictor(docs.sparkSession, learn(docs))("text").alias("p"))
    return carried.where((F.col("p.lang_pred") != UNKNOWN) & (F.col("p.score") >= min_share)).select("row.*")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir))


ship(__name__)
