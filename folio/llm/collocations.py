"""Phrase collocations from mergeable Misra-Gries summaries and an exact second pass.

Texts are cut into pieces and words once and written as blocks of one language. First pass: each
block's distinct n-grams go, as sorted hashes with counts, to hash partitions whose number grows with the
corpus. A partition merges them into one Misra-Gries summary: counters are added, and whatever exceeds the
capacity is paid for by lowering all counters by the largest one that has to go. A summary of capacity C
over mass M misses each n-gram by at most M / (C + 1); with C = M // threshold that is less than the
threshold, so every n-gram that reaches it keeps a counter. Most counters belong to n-grams that do not: the
partition adds up all counts it was sent for the hashes that have one, and keeps those whose sum reaches the
threshold (no less than any of their n-grams' counts). It answers each block with one bit for each hash the
block sent. Second pass: a block reads its bits and sends the words and counts of the
surviving n-grams alone; their sums are exact, since hashes only chose them.

Nothing grows with the corpus but the number of partitions and of blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.llm.common import documents, give_back, ship, small_batches, stored

MAX_WORDS = 3
LEAST = 10
#: A candidate leaves when a longer one that holds it has at least COVER / 100 of its occurrences.
COVER = 50
TOP = 2000
UNKNOWN = "und"
#: Bytes of a block's words; occurrences of n-grams in a hash partition (about, a hot n-gram aside); counters merged at once.
BLOCK_BYTES = 1 << 22
PARTITION_MASS = 1 << 24
MERGED = 1 << 21
#: Rows that ask for a word's count come from so many tasks at least; a language's ranking is cut in so many parts first.
SALTS = 16

_BREAK = b"."
_BREAKS = bytes.maketrans(b",;:!?\n\v\f\r", _BREAK * 9)


def normal(text: str) -> bytes:
    """The words of a text, lower-cased (A-Z), by one space; pieces by the word ``.``, which no word can be."""
    pieces = (b" ".join(p.split()) for p in text.encode("utf-8").lower().translate(_BREAKS).split(_BREAK))
    return b" . ".join(filter(None, pieces))


def parts_of(body: bytes, size: int) -> Iterator[bytes]:
    """A long text's words in parts of about ``size`` bytes, cut between pieces."""
    at = 0
    while len(body) - at > 2 * size and (cut := body.find(b" . ", at + size)) >= 0:
        yield body[at:cut]
        at = cut + 3
    yield body[at:]


def to_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``block, lang, n_words, body``: the words of whole texts, packed by language."""
    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard
        from pyspark import TaskContext

        press, task, made = zstandard.ZstdCompressor(level=1), TaskContext.get().partitionId() << 32, 0
        open_blocks: dict[str, list] = {}
        sizes: dict[str, int] = {}

        def close(lang: str) -> pd.DataFrame:
            body = b" . ".join(open_blocks.pop(lang))
            del sizes[lang]
            n = body.count(b" ") + 1 - body.count(b" . ")
            return pd.DataFrame({"block": [task + made], "lang": [lang], "n_words": [n], "body": [press.compress(body)]})

        for rows in frames:
            for lang, text in zip(rows["lang"], rows["text"]):
                for body in parts_of(normal(text), block_bytes):
                    if not body:
                        continue
                    open_blocks.setdefault(lang, []).append(body)
                    sizes[lang] = sizes.get(lang, 0) + len(body) + 3
                    full = lang if sizes[lang] >= block_bytes else max(sizes, key=sizes.get) if sum(sizes.values()) > 4 * block_bytes else None
                    if full is not None:
                        yield close(full)
                        made += 1
        for lang in list(open_blocks):
            yield close(lang)
            made += 1
        rows = text = body = None
        give_back()

    return docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text").where("text is not null").mapInPandas(
        pack, "block long, lang string, n_words long, body binary")


class Grams:
    """The distinct n-grams of a block in the order in which their hash partitions hear of them."""

    def __init__(self, lang: str, body: bytes, max_words: int, partitions: int):
        import pyarrow as pa
        import pyarrow.compute as pc
        import xxhash
        import zstandard

        raw = pa.array([zstandard.ZstdDecompressor().decompress(body)], pa.large_binary())
        coded = pc.split_pattern(raw, b" ").values.dictionary_encode()
        codes, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        self.words, v = words.cast(pa.large_string()), len(words)
        is_word = pc.not_equal(words, pa.scalar(_BREAK, pa.large_binary())).to_numpy(zero_copy_only=False)
        seed = xxhash.xxh3_64_intdigest(lang.encode("utf-8"))
        named = np.fromiter((xxhash.xxh3_64_intdigest(w, seed=seed) for w in words.to_numpy(zero_copy_only=False)), np.uint64, v)
        word = is_word[codes]
        del raw, coded, words
        at = np.flatnonzero(word)  # first positions of the n-grams of one size
        found, self.columns, hashes, counts, sizes = codes[at], [], [], [], []
        spans, names = np.zeros((v, 0), np.int64), np.zeros(0, np.uint64)
        for n in range(1, max_words + 1):
            if n > 1:  # an n-gram is a shorter one's number and one more word
                more = at + n - 1 < len(codes)
                at, found = at[more], found[more]
                whole = word[at + n - 1]
                at, found = at[whole], found[whole] * v + codes[at[whole] + n - 1]
            if n == 1:  # words have numbers already
                keys, count = np.flatnonzero(is_word), np.bincount(found, minlength=v)[is_word]
                found = (np.cumsum(is_word) - 1)[found]
            elif n < max_words:
                keys, found, count = np.unique(found, return_inverse=True, return_counts=True)
            else:
                keys, count = np.unique(found, return_counts=True)
            last = keys % v if n > 1 else keys
            spans = np.column_stack([spans[keys // v], last]) if n > 1 else last[:, None]
            names = (names[keys // v] if n > 1 else np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15) + named[last]
            names ^= names >> np.uint64(31)
            self.columns.append(spans.astype(np.int32))
            hashes.append(names * np.uint64(0xBF58476D1CE4E5B9))
            counts.append(count)
            sizes.append(np.full(len(keys), n, np.int16))
        del codes, word, at, found, keys, last, spans, names, count, is_word, named
        h = np.concatenate(hashes)
        del hashes
        h ^= h >> np.uint64(29)
        place = (((h >> np.uint64(40)) % np.uint64(partitions)) << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))
        del h
        order = np.argsort(place)  # n-grams of one hash may lie in any order: their bits are equal
        self.place, self.counts, self.sizes = place[order], np.concatenate(counts)[order], np.concatenate(sizes)[order]
        self.own = np.concatenate([np.arange(len(c), dtype=np.int32) for c in self.columns])[order]
        edges = np.searchsorted(self.place, np.arange(partitions + 1, dtype=np.uint64) << np.uint64(32))
        self.parts = [(p, int(edges[p]), int(edges[p + 1])) for p in np.flatnonzero(np.diff(edges)).tolist()]

    def phrases(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words, size and count of the n-grams at ``chosen`` (places in the order)."""
        import pyarrow as pa
        import pyarrow.compute as pc

        out, sizes, counts, space = [], [], [], pa.scalar(" ", pa.large_string())
        for n, spans in enumerate(self.columns, 1):
            mine = chosen[self.sizes[chosen] == n]
            rows = spans[self.own[mine]]
            out.append(pc.binary_join_element_wise(*(self.words.take(rows[:, i]) for i in range(n)), space).to_numpy(zero_copy_only=False))
            sizes.append(np.full(len(mine), n))
            counts.append(self.counts[mine])
        return np.concatenate(out), np.concatenate(sizes), np.concatenate(counts)


def press_counts(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted 32-bit keys with their counts as compressed byte planes of key gaps and counts."""
    import zstandard

    gaps = np.diff(keys, prepend=np.uint32(0)).astype("<u4")
    return zstandard.ZstdCompressor(level=1).compress(np.stack([gaps, np.minimum(counts, 0xFFFFFFFF).astype("<u4")]).view(np.uint8).reshape(2, -1, 4).transpose(0, 2, 1).tobytes())


def unpress_counts(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    import zstandard

    both = np.ascontiguousarray(np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(2, 4, -1).transpose(0, 2, 1)).view("<u4")[:, :, 0]
    return np.cumsum(both[0], dtype=np.uint32), both[1].astype(np.int64)


def merge(summaries: list[tuple[np.ndarray, np.ndarray]], capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """One Misra-Gries summary (sorted keys, counters) of several: counters of equal keys are added; if
    more than ``capacity`` are left, all are lowered by the largest that has to go, and those at zero go."""
    keys, counts = (np.concatenate(x) for x in zip(*summaries))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    keys, counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts
    if len(keys) > capacity:
        counts = counts - np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1]
        keys, counts = keys[counts > 0], counts[counts > 0]
    return keys, counts


def summary(pressed, capacity: int, at_once: int = MERGED) -> np.ndarray:
    """Keys of the summary of all counts in ``pressed``, merged in steps of bounded size."""
    held, waiting, size = (np.zeros(0, np.uint32), np.zeros(0, np.int64)), [], 0
    for raw in pressed:
        waiting.append(unpress_counts(raw))
        size += len(waiting[-1][0])
        if size >= at_once:
            held, waiting, size = merge([held, *waiting], capacity), [], 0
    return merge([held, *waiting], capacity)[0]


def found_at(kept: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the sorted ``keys`` are among the sorted ``kept``, and the places of those there."""
    if not len(kept):
        return np.zeros(len(keys), bool), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(kept, keys), len(kept) - 1)
    found = kept[at] == keys
    return found, at[found]


def reaching(pressed, kept: np.ndarray, least: int) -> np.ndarray:
    """Those of the sorted keys ``kept`` whose counts in ``pressed`` add up to ``least``."""
    sums = np.zeros(len(kept), np.int64)
    for raw in pressed:
        keys, counts = unpress_counts(raw)
        found, at = found_at(kept, keys)
        np.add.at(sums, at, counts[found])  # a block may send a key twice, for n-grams of one hash
    return kept[sums >= least]


def survivors(blocks: DataFrame, max_words: int, least: int, partitions: int) -> DataFrame:
    """``block, masks``: per block and hash partition, which of the block's n-grams have hashes that occur ``least`` times."""
    def tell(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in frames:
            for r in rows.itertuples(index=False):
                g = Grams(r.lang, r.body, max_words, partitions)
                low = (g.place & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                yield pd.DataFrame({"part": [p for p, _, _ in g.parts], "block": r.block, "mass": [int(g.counts[a:b].sum()) for _, a, b in g.parts],
                                    "counts": [press_counts(low[a:b], g.counts[a:b]) for _, a, b in g.parts]})
                g = low = None
        rows = r = None
        give_back()

    def answer(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        kept = reaching(rows["counts"], summary(rows["counts"], int(rows["mass"].sum()) // least), least)
        bits = [np.packbits(found_at(kept, unpress_counts(raw)[0])[0]).tobytes() if len(kept) else b"" for raw in rows["counts"]]
        kept = None
        give_back()
        return pd.DataFrame({"block": rows["block"], "part": key[0], "mask": bits})

    return (blocks.mapInPandas(tell, "part int, block long, mass long, counts binary")
            .groupBy("part").applyInPandas(answer, "block long, part int, mask binary")
            .groupBy("block").agg(F.collect_list(F.struct("part", "mask")).alias("masks")))


def frequent_phrases(blocks: DataFrame, max_words: int = MAX_WORDS, least: int = LEAST, partition_mass: int = PARTITION_MASS) -> DataFrame:
    """``lang, size, phrase, f`` of every n-gram of up to ``max_words`` words that occurs ``least`` times in its
    language, exactly counted, from a stored table of blocks."""
    words = blocks.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    partitions = max(1, math.ceil(max_words * words / partition_mass))
    masks = stored(survivors(blocks, max_words, least, partitions), "phrase-masks")

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in frames:
            for r in rows.itertuples(index=False):
                g = Grams(r.lang, r.body, max_words, partitions)
                kept = np.zeros(len(g.place), bool)
                bits = {m["part"]: m["mask"] for m in r.masks}
                for p, a, b in g.parts:
                    if bits.get(p):
                        kept[a:b] = np.unpackbits(np.frombuffer(bits[p], np.uint8), count=b - a).astype(bool)
                phrases, sizes, counts = g.phrases(np.flatnonzero(kept))
                yield pd.DataFrame({"lang": r.lang, "size": sizes.astype(np.int32), "phrase": phrases, "f": counts.astype(np.int64)})
                g = kept = bits = phrases = None
        rows = r = None
        give_back()

    counted = blocks.join(masks, "block").select("lang", "body", "masks").mapInPandas(count, "lang string, size int, phrase string, f long")
    return counted.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, least: int = LEAST, cover: int = COVER, top: int = TOP,
                 block_bytes: int = BLOCK_BYTES, partition_mass: int = PARTITION_MASS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of 2 to ``max_words`` words of each language.

    A phrase's score is that of its weakest cut into two parts, floor(10^6 * a * a / (l * r)), in whole
    numbers of 38 digits. Phrases that a longer frequent one covers are left out.

    Defined cases: a null or empty text has no words; a null language is ``und``, together with texts so
    labelled; repeated rows count each; ties go by count, then phrase in byte order; a long text is cut
    between pieces, so one piece alone must fit into a task; an empty table gives no rows; other columns are ignored.
    """
    blocks = stored(to_blocks(docs, block_bytes), "phrase-blocks")
    counts = stored(frequent_phrases(blocks, max_words, least, partition_mass), "phrase-counts")
    candidates = counts.where("size > 1").select("lang", "size", "phrase", F.col("f").alias("a"))

    # Counts of the parts. Few words begin or end many phrases: their counts stand in SALTS places.
    words = F.split("phrase", " ")
    part = lambda start, n: F.array_join(F.slice(words, start, n), " ")
    cuts = (candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
            .select("*", part(F.lit(1), F.col("cut")).alias("left"), part(F.col("cut") + 1, F.col("size") - F.col("cut")).alias("right"),
                    F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int").alias("salt")))
    parts = (counts.where(F.col("size") < max_words).withColumn("salt", F.explode(F.expr(f"case when size = 1 then sequence(0, {SALTS - 1}) else array(-1) end"))))
    lefts = parts.select("lang", F.col("phrase").alias("left"), F.col("salt").alias("left_salt"), F.col("f").alias("l"))
    rights = parts.select("lang", F.col("phrase").alias("right"), F.col("salt").alias("right_salt"), F.col("f").alias("r"))
    known = (cuts.withColumn("left_salt", F.expr("case when cut = 1 then salt else -1 end"))
             .withColumn("right_salt", F.expr("case when cut = size - 1 then salt else -1 end"))
             .join(lefts, ["lang", "left", "left_salt"]).join(rights, ["lang", "right", "right_salt"]))
    wide = lambda c: f"cast({c} as decimal(18, 0))"
    score = F.expr(f"(cast(1000000 as decimal(7, 0)) * {wide('a')} * {wide('a')}) div ({wide('l')} * {wide('r')})")
    scored = (known.withColumn("score", score).groupBy("lang", "size", "phrase", "a")
              .agg(F.min(F.struct("score", "cut", "l", "r")).alias("m")).select("lang", "size", "phrase", "a", "m.l", "m.r", "m.score"))

    inner = (candidates.where("size > 2").withColumn("n", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
             .withColumn("start", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("n") + 1)))
             .select("lang", part(F.col("start"), F.col("n")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    left = scored.join(inner, ["lang", "phrase"], "left").where(F.expr(f"longer is null or 100 * longer < {cover} * a"))

    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    left = left.withColumn("bucket", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = left.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "bucket").orderBy(*best))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    totals = blocks.groupBy("lang").agg(F.sum("n_words").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return collocations(documents(spark, sf_dir))


OP13_SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang,
    unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents where text is not null),
spans as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
totals as (select lang, cast(sum(len(w)) as bigint) as n from spans group by lang),
grams as (
  select lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) as phrase
  from spans, (values (1), (2), (3)) as s(size) where len(w) >= size),
counts as (select lang, size, phrase, count(*) as f from grams group by all having count(*) >= 10),
cuts as (
  select lang, size, phrase, f as a, k, string_split(phrase, ' ') as w
  from counts, (values (1), (2)) as c(k) where size > 1 and k < size),
scored as (
  select cuts.lang, cuts.size, cuts.phrase, a, k, x.f as l, y.f as r,
    cast((1000000 * cast(a as hugeint) * a) // (cast(x.f as hugeint) * y.f) as bigint) as score
  from cuts join counts x on x.lang = cuts.lang and x.phrase = array_to_string(w[1:k], ' ')
    join counts y on y.lang = cuts.lang and y.phrase = array_to_string(w[k + 1:], ' ')),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inner_parts as (
  select lang, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '), array_to_string(string_split(phrase, ' ')[2:3], ' ')]) as phrase, f
  from counts where size = 3),
longer as (select lang, phrase, max(f) as f from inner_parts group by all),
left_over as (
  select best.* from best left join longer using (lang, phrase) where longer.f is null or 100 * longer.f < 50 * a),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from left_over)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000
"""

ship(__name__)
