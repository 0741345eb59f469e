"""Rows that an operator must survive: nulls, empty and long texts, ties, repeats, clashing columns."""

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

LONG = "The quick onder thentin of an ereat, and the lazy dog. " * 4000
COPY = " ".join(f"word{i}" for i in range(120))

ROWS = [
    (5, "Hello there, this is a small text of the house and the garden. It ends here.", "en", "a", 10),
    (3, None, None, None, None),
    (None, "A text without an id and with some more words in it.", "en", None, None),
    (9, "", "de", "b", 0),
    (9, "", "de", "b", 0),
    (7, " \t\n\r ", "fr", "b", 0),
    (11, "Der Hund und die Katze sind im Haus. Das ist gut für ein Kind.", "de", "c", 5),
    (11, "Der Hund und die Katze sind im Haus. Das ist gut für ein Kind.", "de", "c", 5),
    (12, "Émile a dit: «ça va» 12 ½ 中文 🎉 <|endoftext|> it's", None, "c", 5),
    (13, LONG, "en", "a", 1),
    (14, "### Assistant: </turn> \\b \\l \\h", "en", "a", 1),
    (15, "12 34 !! 56", None, "a", 1),
    (16, COPY, "en", "a", 1),
    (17, COPY + " tail", "en", "a", 1),
    (2, COPY.upper(), "en", "a", 1),
    (-4, "one two", "en", "a", 1),
    (-5, "One Two", "en", "a", 1),
    (20, "x" * 70000, "en", "a", 1),
    (21, "word1 word2 word3\nword1 word2 word3\nword1 word2 word3", "en", "a", 1),
]

#: Names that the operators use inside.
CLASHES = ["row", "key", "uid", "part", "place", "size", "sig", "n", "term", "word", "posterior", "kept", "vote_length", "n_words", "shard",
           "slot", "lang_pred", "score", "carried", "text_crc32", "comp", "hashes", "trained", "segment", "start"]


def odd_documents(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHES])


def no_documents(spark):
    return odd_documents(spark).where("false")


def key(x):
    return tuple((v is not None, v) for v in x)
