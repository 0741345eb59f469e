"""Byte-level BPE by overlapping chunks.

A text is cut into chunks that overlap their right neighbour. Chunks are cut into pre-tokens on
their own, wherever Spark puts them. Two neighbours are stitched at the first boundary in the
overlap that both found: pre-tokens are matched forward only, so from a common boundary on both
give the same ones. Each chunk then encodes the pieces between its two stitches, and a text's ids
are its chunks' ids in order. Texts of one chunk skip the stitching. Decoding joins the ids' bytes.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from struct import pack

import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.llm.common import documents, give_back, ship, stored

#: Characters of a chunk, and of its overlap with the next one.
CHUNK = 1 << 14
OVERLAP = 1 << 9
#: A boundary is certain when this many characters behind it are in view: matches look ahead
#: by less (the longest fixed alternative has three characters, the lookahead one).
MARGIN = 8
#: Distinct pre-tokens a task remembers before it starts anew.
REMEMBERED = 1 << 18

RANKS = "byte_bpe_50k.tiktoken"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Coder:
    """Cuts, encodes and decodes by one rank file. Ids are kept as little-endian unsigned 32-bit bytes.

    Each distinct pre-token is encoded once (by the library, which finds it to be one match again).
    """

    def __init__(self, ranks_path: str, pattern: str):
        import regex
        import tiktoken

        ranks = load_ranks(ranks_path)
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.merge = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.cut = regex.compile(pattern)
        self.known: dict[str, bytes] = {}

    def _encode_piece(self, piece: str) -> bytes:
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        ids = self.merge(piece)
        out = self.known[piece] = pack(f"<{len(ids)}I", *ids)
        return out

    def encode(self, text: str) -> bytes:
        get, slow = self.known.get, self._encode_piece
        return b"".join([get(p) or slow(p) for p in self.cut.findall(text)])

    def ends(self, text: str) -> list[int]:
        return [m.end() for m in self.cut.finditer(text)]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, memoryview(ids).cast("I").tolist()))


def chunks(texts: DataFrame, size: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row a chunk: ``uid, key, part, start, chunk``; a chunk reaches ``overlap`` characters into the next one."""
    parts = (texts.select("uid", "key", "text", F.length("text").alias("n"))
             .select("uid", "key", "text", F.expr(f"explode(sequence(0, cast((greatest(n, 1) - 1) div {size} as int)))").alias("part")))
    return parts.select("uid", "key", "part", (F.col("part") * size).alias("start"),
                        F.expr(f"substring(text, part * {size} + 1, {size + overlap})").alias("chunk"))


def pre_tokenise(frames: Iterator[pd.DataFrame], coder: Callable[[], Coder], size: int, overlap: int) -> Iterator[pd.DataFrame]:
    """Adds to each chunk its certain boundaries (places in the whole text) that its left and its
    right neighbour may know as well: those in its first and in its last ``overlap`` characters."""
    own = coder()
    for rows in frames:
        head, tail = [], []
        for start, chunk in zip(rows["start"], rows["chunk"]):
            ends = own.ends(chunk)
            last = len(chunk) - MARGIN
            head.append([start + e for e in ends if e <= min(overlap, last)])
            tail.append([start + e for e in ends if size <= e <= last])
        yield rows.assign(head=head, tail=tail)
    own = rows = head = tail = None
    give_back()


def encode_texts(texts: DataFrame, ranks_path: str, pattern: str, summarise: Callable[[bytes, Coder], tuple],
                 columns: str, size: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Encode every row of ``texts`` (``uid, key, text``; uid unique, key a string, text not null) and
    reduce each text's ids in the task that made them: ``key`` and the ``columns`` that
    ``summarise(ids, coder)`` returns.

    Texts longer than a chunk go through overlapping chunks. Where two neighbours find no common
    boundary in their overlap (one pre-token fills it), the text is encoded in one piece.
    """
    def coder() -> Coder:
        return Coder(ranks_path, pattern)

    names = [c.split()[0] for c in columns.split(",")]

    def frame(keys, ids: Iterator[bytes], own: Coder) -> pd.DataFrame:
        return pd.DataFrame([(k, *summarise(x, own)) for k, x in zip(keys, ids)], columns=["key", *names])

    def whole(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = coder()
        for rows in frames:
            yield frame(rows["key"], map(own.encode, rows["text"]), own)
        own = rows = None
        give_back()

    def bounds(frames):
        return pre_tokenise(frames, coder, size, overlap)

    def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = coder()
        for rows in frames:
            ids = [own.encode(c[int(a) - s:int(b) - s]) for s, c, a, b in zip(rows["start"], rows["chunk"], rows["from"], rows["to"])]
            yield pd.DataFrame({"uid": rows["uid"], "key": rows["key"], "part": rows["part"], "ids": ids})
        own = rows = ids = None
        give_back()

    def join(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = coder()
        for rows in frames:
            yield frame(rows["key"], map(b"".join, rows["ids"]), own)
        own = rows = None
        give_back()

    out = f"key string, {columns}"
    short = texts.where(F.length("text") <= size)
    long = texts.where(F.length("text") > size)
    cut = chunks(long, size, overlap).repartition("uid", "part").mapInPandas(
        bounds, "uid long, key string, part int, start int, chunk string, head array<int>, tail array<int>")
    row = Window.partitionBy("uid").orderBy("part")
    # The left neighbour's certain boundaries in the overlap, and this chunk's own.
    stitched = (cut.withColumn("from", F.when(F.col("part") == 0, F.lit(0)).otherwise(
                    F.array_min(F.array_intersect(F.lag("tail").over(row), "head"))))
                .withColumn("last", F.lead("part").over(row).isNull())
                .withColumn("to", F.when(F.col("last"), F.col("start") + F.length("chunk")).otherwise(F.lead("from").over(row)))
                .withColumn("lost", F.max(F.col("from").isNull()).over(Window.partitionBy("uid")))
                .drop("head", "tail"))
    stitched = stored(stitched, "bpe-chunks", "zstd")
    many = (stitched.where("not lost").mapInPandas(pieces, "uid long, key string, part int, ids binary")
            .groupBy("uid", "key").agg(F.expr("transform(array_sort(collect_list(struct(part, ids))), x -> x.ids)").alias("ids"))
            .mapInPandas(join, out))
    unstitched = (stitched.where("lost").groupBy("uid", "key")
                  .agg(F.expr(f"concat_ws('', transform(array_sort(collect_list(struct(part, substring(chunk, 1, {size}) as c))), x -> x.c))").alias("text"))
                  .mapInPandas(whole, out))
    return short.select("uid", "key", "text").mapInPandas(whole, out).unionByName(many).unionByName(unstitched)


def digest(ids: bytes, coder: Coder) -> tuple:
    """Count and digest of the ids, and the digest of the bytes they decode to."""
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(coder.decode(ids)).hexdigest()


def bpe_digests(docs: DataFrame, ranks_path: str, pattern: str = public_tokenizers.PATTERN, size: int = CHUNK,
                overlap: int = OVERLAP) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row of ``docs``.

    Defined cases: a null text is encoded as the empty text (no ids); a long text is encoded whole,
    by chunks; repeated rows, equal and null ids each give their own row; an empty table gives no
    rows; other columns are ignored.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("string").alias("key"),
                       F.coalesce("text", F.lit("")).alias("text"))
    coded = encode_texts(rows, ranks_path, pattern, digest, "n_tokens long, ids_sha256 string, decoded_sha256 string", size, overlap)
    return coded.select(F.col("key").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(documents(spark, sf_dir), public_tokenizers.path(RANKS))


ship(__name__)
