"""Weak supervision of text quality: rules vote or abstain, expectation-maximisation weighs them.

Each rule looks at one figure of a document and votes good, bad or abstains. Per rule and class
the model holds the rule's accuracy, the chance that a vote it casts is right; abstaining says
nothing about the class. EM fits accuracies and the share of good documents on the counts of the
vote patterns of all documents. A document's posterior chance of being good
then follows from its pattern alone. There are at most 3 ** rules patterns, whatever the input,
so fitting takes a bounded table and is exact.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.llm.common import documents, ship, stored

#: Words in a repeated window, and the base rule's bounds.
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = "#*$%&|<>"

FIGURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_letters",
           "n_shout", "n_ended", "n_bare", "n_runs"]

#: (name, votes good when, votes bad when) over the figures; neither: the rule abstains.
RULES = [
    ("length", "n_words >= 40", "n_words < 10"),
    ("symbols", "100 * n_symbols <= 2 * n_words", "10 * n_symbols > n_words"),
    ("repeats", "100 * n_repeat_words <= 5 * n_words", "100 * n_repeat_words > 30 * n_words"),
    ("lines", "n_lines >= 3 and n_dup_lines = 0", "10 * n_dup_lines > 4 * n_lines"),
    ("case", "100 * n_upper <= 8 * n_letters", "10 * n_upper > 4 * n_letters"),
    ("shouting", "n_words >= 10 and n_shout = 0", "10 * n_shout > n_words"),
    ("endings", "10 * n_ended >= 9 * n_lines", "10 * n_ended < 3 * n_lines"),
    ("bare", "100 * n_bare <= n_words", "10 * n_bare > n_words"),
    ("runs", "100 * n_runs <= n_words", "10 * n_runs > n_words"),
    ("letters", "n_letters * 100 >= 75 * word_chars", "n_letters * 100 < 50 * word_chars"),
]
GOOD, BAD, ABSTAIN = 1, 2, 0

#: Bytes of ASCII capitals, letters, and all of ASCII.
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123))
_ASCII = bytes(range(128))
#: A word of ASCII punctuation alone.
_BARE = re.compile(rb"(?<![^ \t-\r])[!-/:-@\[-`{-~]+(?![^ \t-\r])")
#: One ASCII punctuation character three times or more.
_RUN = re.compile(rb"([!-/:-@\[-`{-~])\1\1+")


def _repeated(words: list[bytes], width: int) -> int:
    """Words that lie in a ``width``-word window found twice or more in the text."""
    windows = list(zip(*(words[i:] for i in range(width))))
    seen = Counter(windows)
    if len(seen) == len(windows):
        return 0
    covered, upto = 0, 0
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered += i + width - max(i, upto)
            upto = i + width
    return covered


def _figures(text: str) -> tuple:
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # cuts at the six ASCII spaces only
    lines = [x for x in raw.split(b"\n") if x.split()]
    rest = "" if text.isascii() else raw.translate(None, _ASCII).decode("utf-8", "surrogatepass")
    n_upper = len(raw) - len(raw.translate(None, _UPPER)) + sum(map(str.isupper, rest))
    n_letters = len(raw) - len(raw.translate(None, _LETTERS)) + sum(map(str.isalpha, rest))
    return (len(words), len(text) - sum(map(text.count, " \t\n\v\f\r")), sum(map(text.count, SYMBOLS)), len(lines),
            len(lines) - len(set(lines)), _repeated(words, WINDOW), n_upper, n_letters,
            text.count("!!"), sum(x.rstrip()[-1:] in b".!?" for x in lines), len(_BARE.findall(raw)), len(_RUN.findall(raw)))


@F.pandas_udf(T.StructType([T.StructField(c, T.LongType()) for c in FIGURES]))
def figures(text: pd.Series) -> pd.DataFrame:
    """The figures of each text; a null text has none (all zero)."""
    return pd.DataFrame([_figures(x) if isinstance(x, str) else (0,) * len(FIGURES) for x in text], columns=FIGURES)


def votes() -> list[Column]:
    return [F.expr(f"case when {bad} then {BAD} when {good} then {GOOD} else {ABSTAIN} end").alias(f"vote_{name}")
            for name, good, bad in RULES]


BASE_FAILED = f"(n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words)"


def fit_votes(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, tol: float = 1e-10) -> dict:
    """EM over vote patterns (rows of ABSTAIN / GOOD / BAD) with their counts.

    Starts from the belief that a pattern with a bad vote is bad; add-one smoothing keeps every
    chance above zero. Returns the prior of good, per rule the accuracy of its votes on good and on
    bad documents, and each pattern's posterior of good.
    """
    good = np.where((patterns == BAD).any(axis=1), 0.1, 0.9)
    cast = np.stack([patterns == GOOD, patterns == BAD]).astype(float)  # vote, pattern, rule
    prior, chance = 0.5, np.full((2, 2, patterns.shape[1]), 0.5)
    for _ in range(rounds):
        weight = np.stack([good, 1 - good]) * counts
        chance = np.einsum("cp,vpr->cvr", weight, cast) + 1
        chance /= chance.sum(axis=1, keepdims=True)
        prior = (weight[0].sum() + 1) / (counts.sum() + 2)
        log = np.einsum("cvr,vpr->cp", np.log(chance), cast) + np.log([[prior], [1 - prior]])
        new = 1 / (1 + np.exp(np.clip(log[1] - log[0], -500, 500)))
        moved, good = np.abs(new - good).max(initial=0), new
        if moved < tol:
            break
    return {"prior": prior, "accuracy": np.stack([chance[0, 0], chance[1, 1]]), "posterior": good}


def learn(figured: DataFrame) -> tuple[DataFrame, dict]:
    """Fit the vote model on all rows of a table of figures. Returns the table of patterns with
    their posterior (at most 3 ** rules rows) and the fitted model."""
    names = [f"vote_{r[0]}" for r in RULES]
    rows = figured.select(*votes()).groupBy(*names).count().collect()  # at most 3 ** len(RULES) rows
    patterns = np.array([[r[c] for c in names] for r in rows], dtype=int).reshape(-1, len(names))
    model = fit_votes(patterns, np.array([r["count"] for r in rows], dtype=float))
    table = figured.sparkSession.createDataFrame(
        [(*map(int, p), float(g)) for p, g in zip(patterns, model["posterior"])],
        ", ".join(f"{c} int" for c in names) + ", posterior double")
    return table, model


def judge(figured: DataFrame, posterior: DataFrame) -> DataFrame:
    """Adds votes, ``posterior``, ``base_failed`` and ``kept`` to a table of figures.

    Defined cases: figures of zero (a null text or one without words) fail the base rule whatever the model says; a
    vote pattern that ``posterior`` lacks is not kept; other columns stay, unless their names are those added.
    """
    names = [f"vote_{r[0]}" for r in RULES]
    return (figured.select("*", *votes()).join(F.broadcast(posterior), names, "left")
            .withColumn("base_failed", F.expr(BASE_FAILED))
            .withColumn("kept", F.expr("not base_failed and coalesce(posterior, 0) >= 0.5")))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that the fitted rules keep, with all their columns.

    Each text is measured once: rows and figures are written together, and the model is fitted to and
    applied to that table.

    Defined cases: a null or empty text has no words and fails the base rule; a text without a
    break is one line; repeated rows are judged alike; an empty table stays empty; other columns
    pass through, and names cannot clash (the input row is carried as a struct).
    """
    measured = stored(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("carried"), figures("text").alias("f")), "quality-figures", "zstd")
    figured = measured.select("carried", "f.*")
    posterior, _ = learn(figured)
    return judge(figured, posterior).where("kept").select("carried.*")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures, base rule, verdict, posterior and votes of every document.

    Defined cases: a null or empty text, or one of white space, has figures of zero and fails the base rule; repeated
    rows and ids have a row each; a long text is measured whole; an empty table gives no rows.
    """
    figured = stored(documents(spark, sf_dir).select("doc_id", figures("text").alias("f")).select("doc_id", "f.*"), "quality-figures")
    posterior, _ = learn(figured)
    return judge(figured, posterior).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior",
        *[f"vote_{r[0]}" for r in RULES])


ship(__name__)
