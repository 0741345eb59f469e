"""Hidden Markov language model over word tokens.

Texts become blocks of token numbers once (words and one end token a text), written to the shared
folder; all later passes read them. A state emits a word's class, and the class the word:

* words with at least ``1 / HEADS`` of all training tokens are classes of their own (so there are
  at most ``HEADS``, whatever the corpus);
* all others fall into ``TAILS`` classes by a hash of their last bytes, which carry their
  inflection; inside a class a word has its training count plus one, and one more unit stands for
  every word not seen.

Both tables are bounded, so any vocabulary fits. Baum-Welch starts from class frequencies, shaken at random.
Its first rounds take one share of the blocks each, a share that lies in all partitions and grows with the corpus; when
every block was used once, full rounds follow until a token's log likelihood gains less than a tolerance.
In a round each task adds up its expected counts, the counts of all partitions are
summed in slices, and the driver turns them into chances. A text's score is its exact log
likelihood by the scaled forward recursion, times its words' chances inside their classes. Counts
of tail words are never broadcast: each block asks hash partitions for its distinct words.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.chain import Chain
from folio.llm.common import documents, fold_of, give_back, new_path, ship, small_batches, stored

STATES = 6
HEADS = 1 << 16
TAILS = 1 << 14
SUFFIX = 4  # bytes
BLOCK_TOKENS = 1 << 17
#: Shares of the blocks that the first rounds take one by one; then full rounds until the gain a token (nats) is below TOLERANCE, at most ROUNDS.
SHARES = 16
TOLERANCE = 0.005
ROUNDS = 12
#: In a round over a share, this part of the emissions follows the classes' frequency in the whole corpus, as a share sees few of the classes.
SPREAD = 0.1
#: Added to every expected count.
PRIOR = 0.05
SLICES = 16
#: Blocks that a task of a full round adds up (about), as each sends a whole model's counts; training tokens of a hash partition of tail words.
TASK_BLOCKS = 20
PARTITION_TOKENS = 1 << 23

_END = b" "  # no word holds a space
BLOCKS = ("block long, share int, keys array<string>, train array<boolean>, rows array<long>, lengths array<long>, words binary, tails binary, ids binary")


def words_of(text: str) -> list[bytes]:
    """Lower-cased (A-Z) words of a text and the end token."""
    out = text.encode("utf-8", "surrogatepass").lower().split()
    out.append(_END)
    return out


def _block(rows: list[tuple], block: int, share: int) -> pd.DataFrame:
    """Rows (key, train, row number, words) as one block: each distinct word once by hash and tail
    class, the tokens by their number among them."""
    import xxhash

    number = defaultdict()
    number.default_factory = number.__len__
    ids = [np.fromiter(map(number.__getitem__, w), np.uint32, len(w)) for *_, w in rows]
    vocabulary = list(number)
    ids = np.concatenate(ids)
    tails = [0 if w is _END else xxhash.xxh32_intdigest(w[-SUFFIX:]) % TAILS for w in vocabulary]
    return pd.DataFrame({
        "block": block, "share": share, "keys": [[r[0] for r in rows]], "train": [[bool(r[1]) for r in rows]], "rows": [[r[2] for r in rows]], "lengths": [[len(r[3]) for r in rows]],
        "words": [np.array([xxhash.xxh3_64_intdigest(w) for w in vocabulary], "<u8").tobytes()], "tails": [np.array(tails, "<u2").tobytes()],
        "ids": [ids.astype("<u2" if len(vocabulary) <= 1 << 16 else "<u4").tobytes()]})


def to_blocks(docs: DataFrame, train) -> DataFrame:
    """Token blocks of all rows; ``train`` marks the rows to learn from. A block ends after
    ``BLOCK_TOKENS`` tokens, at a text's end. The blocks of a task belong to the shares in turn."""
    def blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        task, made = TaskContext.get().partitionId(), 0
        rows, size = [], 0
        for frame in frames:
            for r in frame.itertuples(index=False):
                rows.append((r.key, r.train, r.row, words_of(r.text)))
                size += len(rows[-1][3])
                if size >= BLOCK_TOKENS:
                    yield _block(rows, (task << 32) + made, (task + made) % SHARES)
                    rows, size, made = [], 0, made + 1
        if rows:
            yield _block(rows, (task << 32) + made, (task + made) % SHARES)
        rows = frame = r = None
        give_back()

    return docs.select(F.col("doc_id").cast("string").alias("key"), train.alias("train"), F.monotonically_increasing_id().alias("row"),
                       F.coalesce("text", F.lit("")).alias("text")).mapInPandas(blocks, BLOCKS)


def stored_blocks(docs: DataFrame, train) -> DataFrame:
    """``to_blocks`` in the shared folder, by share: a round over one share reads that share's files alone."""
    made, path = to_blocks(docs, train), new_path(docs.sparkSession, "hmm-blocks")
    made.write.partitionBy("share").parquet(path)
    return docs.sparkSession.read.schema(made.schema).parquet(path)


class Block:
    """A block read back."""

    def __init__(self, r):
        self.id, self.keys, self.rows = r.block, r.keys, np.asarray(r.rows, np.int64)
        self.lengths, self.train = np.asarray(r.lengths, np.int64), np.asarray(r.train, bool)
        self.words, self.tails = np.frombuffer(r.words, "<u8"), np.frombuffer(r.tails, "<u2").astype(np.int64)
        n = int(self.lengths.sum())
        self.ids = np.frombuffer(r.ids, "<u2" if len(r.ids) == 2 * n else "<u4").astype(np.int64)
        self.text = np.repeat(np.arange(len(self.lengths)), self.lengths)
        self.starts = np.zeros(n, bool)
        self.starts[np.cumsum(self.lengths) - self.lengths] = True

    def classes(self, heads: np.ndarray) -> np.ndarray:
        """Class of each distinct word: its place among the (sorted) heads, else its tail class behind them."""
        at = np.searchsorted(heads, self.words)
        at[at == len(heads)] = 0
        own = heads[at] == self.words if len(heads) else np.zeros(len(self.words), bool)
        return np.where(own, at, len(heads) + self.tails)

    def tail_words(self, classes: np.ndarray, heads: int, partitions: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        """Numbers of the block's tail words by hash partition, and each partition's first and last place among them."""
        mine = np.flatnonzero(classes >= heads)
        part = (self.words[mine] >> np.uint64(20)) % np.uint64(partitions)
        order = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[order], np.arange(partitions + 1, dtype=np.uint64))
        return mine[order], [(p, int(edges[p]), int(edges[p + 1])) for p in np.flatnonzero(np.diff(edges)).tolist()]


def read_blocks(frames: Iterator[pd.DataFrame]) -> Iterator[Block]:
    for rows in frames:
        for r in rows.itertuples(index=False):
            yield Block(r)


@dataclass
class Hmm:
    heads: np.ndarray  # word hashes, sorted
    start: np.ndarray
    steps: np.ndarray
    emit: np.ndarray  # class, state

    def arrays(self) -> tuple:
        """The model as plain arrays, which a worker without this package can unpickle."""
        return self.heads, self.start, self.steps, self.emit

    def expect(self, block: Block) -> tuple[np.ndarray, ...]:
        """Expected (starts, steps, emissions by class and state) of a block's training texts, their tokens and log likelihood."""
        use = block.train[block.text]
        k, n = len(self.start), len(self.emit)
        if not use.any():
            return np.zeros(k), np.zeros((k, k)), np.zeros((n, k)), np.zeros(2)
        ids, starts = block.ids[use], block.starts[use]
        classes = block.classes(self.heads)
        _, log, gamma, steps = Chain(self.steps, self.start).run(self.emit[classes][ids], starts)
        out = np.empty((n, k))
        for j in range(k):
            out[:, j] = np.bincount(classes, np.bincount(ids, gamma[:, j], len(classes)), n)
        return gamma[starts].sum(axis=0), steps, out, np.array([len(ids), log.sum()])

    def updated(self, starts: np.ndarray, steps: np.ndarray, emissions: np.ndarray) -> Hmm:
        norm = lambda x, axis: (x + PRIOR) / (x + PRIOR).sum(axis=axis, keepdims=True)
        return Hmm(self.heads, norm(starts, 0), norm(steps, 1), norm(emissions, 0))


def start_model(heads: np.ndarray, class_counts: np.ndarray, states: int, seed: int = 11) -> Hmm:
    """Class frequencies shaken at random, and sticky states."""
    rng = np.random.default_rng(seed)
    emit = (class_counts[:, None] + PRIOR) * rng.gamma(4, 0.25, (len(class_counts), states))
    steps = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(steps, 0.9)
    return Hmm(heads, np.full(states, 1 / states), steps / steps.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def one_round(blocks: DataFrame, model: Hmm, spread: np.ndarray | None = None) -> tuple[Hmm, float]:
    """One Baum-Welch round over the training texts in ``blocks``: the next model, and the log likelihood
    a token under the one given. With ``spread`` (a chance for each class) a part of the emissions follows it. Each task sums its own counts and sends them
    in slices; a slice's sum is one task's work, of bounded size."""
    shared = blocks.sparkSession.sparkContext.broadcast(model.arrays())  # (HEADS + TAILS) * STATES doubles at most

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, total = Hmm(*shared.value), None
        for block in read_blocks(frames):
            one = model.expect(block)
            total = one if total is None else tuple(a + b for a, b in zip(total, one))
        if total is not None:
            flat = np.concatenate([x.ravel() for x in total])
            yield pd.DataFrame({"slice": np.arange(SLICES, dtype=np.int32), "counts": [x.tobytes() for x in np.array_split(flat, SLICES)]})
        model = total = block = one = flat = None
        give_back()

    def add(key: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for frame in frames:
            for x in frame["counts"]:
                total = np.frombuffer(x).copy() if total is None else total + np.frombuffer(x)
        yield pd.DataFrame({"slice": [key[0]], "counts": [total.tobytes()]})

    # Sums of a few tasks each first, so that no task receives from all.
    per_task = blocks.mapInPandas(count, "slice int, counts binary")
    groups = (per_task.withColumn("group", (F.spark_partition_id() / 32).cast("int")).groupBy("slice", "group")
              .applyInPandas(add, "slice int, counts binary"))
    rows = groups.groupBy("slice").applyInPandas(add, "slice int, counts binary").collect()  # the model's size
    shared.destroy()
    if not rows:
        return model, 0.0
    flat = np.concatenate([np.frombuffer(r["counts"]) for r in sorted(rows, key=lambda r: r["slice"])])
    k = len(model.start)
    emissions, (tokens, log) = flat[k + k * k:-2].reshape(-1, k), flat[-2:]
    if not tokens:
        return model, 0.0
    if spread is not None:
        emissions = emissions + SPREAD * spread[:, None] * emissions.sum(axis=0)
    return model.updated(flat[:k], flat[k:k + k * k].reshape(k, k), emissions), log / tokens


def fit(blocks: DataFrame, model: Hmm, class_counts: np.ndarray, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> tuple[Hmm, list[float]]:
    """The fitted model, and the log likelihood a token before each full round."""
    spread = (class_counts + PRIOR) / (class_counts + PRIOR).sum()
    for share in range(SHARES):
        model, _ = one_round(blocks.where(F.col("share") == share), model, spread)
    logs: list[float] = []
    whole = blocks.coalesce(max(blocks.sparkSession.sparkContext.defaultParallelism, -(-blocks.count() // TASK_BLOCKS)))
    while len(logs) < rounds:
        model, log = one_round(whole, model)
        logs.append(log)
        if len(logs) > 1 and logs[-1] - logs[-2] < tolerance:
            break
    return model, logs


def word_counts(blocks: DataFrame) -> DataFrame:
    """``word, tail, c``: training count of every distinct word (by hash) of the training texts."""
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in read_blocks(frames):
            c = np.bincount(block.ids[block.train[block.text]], minlength=len(block.words))
            yield pd.DataFrame({"word": block.words.view(np.int64)[c > 0], "tail": block.tails[c > 0].astype(np.int32), "c": c[c > 0]})
        block = c = None
        give_back()

    return blocks.mapInPandas(count, "word long, tail int, c long").groupBy("word").agg(F.first("tail").alias("tail"), F.sum("c").alias("c"))


def told_counts(blocks: DataFrame, counts: DataFrame, heads: np.ndarray, partitions: int) -> DataFrame:
    """``block, answers``: per block and hash partition the training counts of the block's tail words, in the order of
    ``Block.tail_words``. Each block asks for a word once, in one row a partition; ``counts`` (word, c) has the tail words."""
    shared = blocks.sparkSession.sparkContext.broadcast(heads)

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in read_blocks(frames):
            tails, parts = block.tail_words(block.classes(shared.value), len(shared.value), partitions)
            yield pd.DataFrame({"part": [p for p, _, _ in parts], "block": block.id, "words": [block.words[tails[a:b]].tobytes() for _, a, b in parts]})
        block = tails = parts = None
        give_back()

    def answer(asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(known["word"].to_numpy())
        words, c = known["word"].to_numpy()[order], known["c"].to_numpy()[order]
        out = []
        for raw in asked["words"]:
            w = np.frombuffer(raw, "<i8")
            at = np.minimum(np.searchsorted(words, w), max(0, len(words) - 1))
            out.append((np.where(words[at] == w, c[at], 0) if len(words) else np.zeros(len(w), np.int64)).astype("<i8").tobytes())
        found = pd.DataFrame({"block": asked["block"], "part": asked["part"], "counts": out})
        order = words = c = known = asked = None
        give_back()
        return found

    part = F.expr(f"cast(((word >> 20) & {(1 << 44) - 1}) % {partitions} as int)")  # of the unsigned hash, as in tail_words
    asked = blocks.select("block", "words", "tails", "ids", "lengths", "train", "rows", "keys").mapInPandas(ask, "part int, block long, words binary")
    return (asked.groupBy("part").cogroup(counts.select(part.alias("part"), "word", "c").groupBy("part"))
            .applyInPandas(answer, "block long, part int, counts binary")
            .groupBy("block").agg(F.collect_list(F.struct("part", "counts")).alias("answers")))


def score(docs: DataFrame, train, states: int = STATES, rounds: int = ROUNDS, heads: int = HEADS) -> DataFrame:
    """Train on the rows that ``train`` marks and score every row:
    ``doc_id, trained, n_tokens, n_known, train_tokens, base_score, score`` (log10).

    Defined cases: a null or empty text is its end token alone; without training rows all counts are
    zero and every state emits every class alike; repeated rows count and are scored each; a long text
    is one sequence; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    blocks = stored_blocks(docs, train)
    counts = stored(word_counts(blocks), "hmm-counts")
    total, vocabulary = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = {r["word"]: r["c"] for r in counts.where(F.col("c") * heads >= total).select("word", "c").collect()}  # at most `heads`
    head_words = np.sort(np.array(list(top), np.int64).view(np.uint64))
    head_counts = np.array([top[int(x)] for x in head_words.view(np.int64)], float)
    tail_counts, tail_words = np.zeros(TAILS), np.zeros(TAILS)
    for r in counts.where(F.col("c") * heads < total).groupBy("tail").agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect():  # at most TAILS
        tail_counts[r["tail"]], tail_words[r["tail"]] = r["c"], r["n"]

    class_counts = np.concatenate([head_counts, tail_counts])
    model, _ = fit(blocks, start_model(head_words, class_counts, states), class_counts, rounds)

    shared = spark.sparkContext.broadcast((model.arrays(), head_counts, np.log10(tail_counts + tail_words + 1)))
    partitions = max(1, -(-int(total) // PARTITION_TOKENS))
    told = told_counts(blocks, counts.where(F.col("c") * heads < total), head_words, partitions)
    base = float(np.log10(total + vocabulary + 1))

    def texts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Per text the forward score of its classes, the log chance that its tail words' classes
        spread over their words, and what its words add to the base."""
        arrays, head_counts, log_mass = shared.value
        model = Hmm(*arrays)
        for rows in frames:
            for r in rows.itertuples(index=False):
                block = Block(r)
                classes = block.classes(model.heads)
                log = Chain(model.steps, model.start).run(model.emit[classes][block.ids], block.starts, backward=False)[1]
                is_head = classes < len(model.heads)
                own = np.zeros(len(classes))
                own[is_head] = head_counts[classes[is_head]]
                tails, parts = block.tail_words(classes, len(model.heads), partitions)
                answers = {m["part"]: m["counts"] for m in r.answers} if r.answers is not None else {}
                for p, a, b in parts:
                    own[tails[a:b]] = np.frombuffer(answers[p], "<i8")
                add, mass = np.log10(own + 1), np.zeros(len(classes))
                mass[~is_head] = log_mass[classes[~is_head] - len(model.heads)]
                n = len(block.lengths)
                per = lambda x: np.bincount(block.text, x, n)
                tail_logs = per(np.where(is_head, 0, add)[block.ids])
                yield pd.DataFrame({"key": list(block.keys), "trained": block.train, "n_tokens": block.lengths,
                                    "n_known": per((own > 0)[block.ids].astype(float)).astype(np.int64), "base_score": per(add[block.ids]) - block.lengths * base,
                                    "score": per(log) / np.log(10) - per(mass[block.ids]) + tail_logs})
        rows = r = block = classes = log = own = add = mass = answers = None
        give_back()

    scored = blocks.join(told, "block", "left").mapInPandas(texts, "key string, trained boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select(F.col("key").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "trained", "n_tokens", "n_known",
                         F.lit(int(total)).cast("long").alias("train_tokens"), "base_score", "score")


def op4_hmm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return score(documents(spark, sf_dir), fold_of("doc_id", 7) != 2).select(
        "doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


ship(__name__)
