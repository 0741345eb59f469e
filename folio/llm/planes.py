"""Token ids in plane-shuffled, compressed files.

Documents are range-partitioned and sorted by id, encoded by the tokenizers library, and their
ids written as segments. A segment holds whole documents; its ids are cut into blocks of a fixed
size, each block is transposed into byte planes (or bit planes), and each plane is compressed by
zstandard on its own: the high planes of small ids are nearly empty, the low ones keep their
statistics. The chunk index gives every plane's place, so a reader can fetch single blocks.

Segments are rows of a Parquet table in the shared folder, committed by Spark: a lost executor's
part is written again, and any file system that Spark reaches will do.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.llm.common import documents, new_path, per_process, ship

BLOCK = 1 << 14  # ids in a block
SEGMENT = 1 << 20  # ids after which a segment is closed
LEVEL = 3
END_ID = 0
REMEMBERED = 1 << 20
VOCABULARY = "byte_bpe_50k.json"

SEGMENT_COLUMNS = ("part int, segment int, n_ids long, bits boolean, keys array<string>, lengths array<long>, "
                   "block_ids array<int>, plane_ends array<int>, payload binary")


def split_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """The byte planes (4) or bit planes (32) of unsigned 32-bit ids, lowest first."""
    raw = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if not bits:
        return [np.ascontiguousarray(raw[:, k]).tobytes() for k in range(4)]
    flat = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(flat[:, k], bitorder="little").tobytes() for k in range(32)]


def join_planes(planes: list[bytes], n: int, bits: bool) -> np.ndarray:
    if not bits:
        return np.ascontiguousarray(np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)).view("<u4").reshape(-1)
    flat = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in planes], axis=1)
    return np.packbits(flat, axis=1, bitorder="little").view("<u4").reshape(-1)


def pack(ids: np.ndarray, block: int, bits: bool, level: int = LEVEL) -> tuple[list[int], list[int], bytes]:
    """Ids of each block, end of each plane in the payload, payload."""
    import zstandard

    press = zstandard.ZstdCompressor(level=level)
    sizes, ends, out, at = [], [], [], 0
    for i in range(0, len(ids), block):
        sizes.append(len(ids[i:i + block]))
        for plane in split_planes(ids[i:i + block], bits):
            out.append(press.compress(plane))
            ends.append(at := at + len(out[-1]))
    return sizes, ends, b"".join(out)


def unpack(sizes, ends, payload: bytes, bits: bool) -> np.ndarray:
    import zstandard

    press, width, at, out = zstandard.ZstdDecompressor(), 32 if bits else 4, 0, []
    for k, n in enumerate(sizes):
        planes = []
        for end in ends[k * width:(k + 1) * width]:
            planes.append(press.decompress(payload[at:end]))
            at = end
        out.append(join_planes(planes, n, bits))
    return np.concatenate(out) if out else np.empty(0, "<u4")


#: The library's pattern over U+0000-024F without the separators 1C-1F: letters, numbers, white space there.
_L = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f"
_N = "0-9\xb2\xb3\xb9\xbc-\xbe"
_S = "\\t-\\r \x85\xa0"
LATIN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
BEYOND = "[^\x00-\x1b\x20-\u024f]"


class LibraryCoder:
    """The tokenizers library, asked once for each distinct pre-token.

    Texts are cut by the library's own pattern, written out for Latin letters; a text with other
    characters goes to the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model = self.library.model
        self.cut = re.compile(LATIN).findall
        self.odd = re.compile(BEYOND).search
        self.known: dict[str, bytes] = {}
        # The library's model reads bytes as characters: those that print as themselves, the others from 256 on.
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        hidden = [b for b in range(256) if b not in shown]
        self.shown = {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}

    def _whole(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _piece(self, piece: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(self.shown))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        if self.odd(text):
            return self._whole(text)
        pieces = self.cut(text)
        if new := set(pieces).difference(self.known):
            if len(self.known) + len(new) > REMEMBERED:
                self.known.clear()
                new = set(pieces)
            self.known.update((p, self._piece(p)) for p in new)
        return b"".join(map(self.known.__getitem__, pieces))


def write_ids(docs: DataFrame, path: str, vocabulary: str, block: int = BLOCK, segment: int = SEGMENT, bits: bool = False,
              end_id: int = END_ID) -> None:
    """Write the ids of every document, each followed by ``end_id``, in ascending order of doc_id.

    Defined cases: null ids come first; rows with equal ids keep their order in the input, so
    repeated rows are written again; a null or empty text is the end id alone; a long text makes a long
    segment; an empty table writes no segment; other columns are ignored.
    """
    end = end_id.to_bytes(4, "little")

    def segments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        # Vocabulary and remembered pieces are kept for all tasks of the worker.
        coder, part, n = per_process(("coder", vocabulary), lambda: LibraryCoder(vocabulary)), TaskContext.get().partitionId(), 0
        keys, ids, size = [], [], 0

        def close() -> pd.DataFrame:
            sizes, ends, payload = pack(np.frombuffer(b"".join(ids), "<u4"), block, bits)
            return pd.DataFrame({"part": [part], "segment": [n], "n_ids": [sum(sizes)], "bits": [bits], "keys": [keys],
                                 "lengths": [[len(x) // 4 for x in ids]], "block_ids": [sizes], "plane_ends": [ends],
                                 "payload": [payload]})

        for rows in frames:
            for key, text in zip(rows["key"], rows["text"]):
                keys.append(key)
                ids.append(coder.encode(text) + end)
                size += len(ids[-1]) // 4
                if size >= segment:
                    yield close()
                    keys, ids, size, n = [], [], 0, n + 1
        if keys:
            yield close()

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("place"))
    (rows.repartitionByRange("doc_id", "place").sortWithinPartitions("doc_id", "place")
     .select(F.col("doc_id").cast("string").alias("key"), "text")
     .mapInPandas(segments, SEGMENT_COLUMNS).write.parquet(path))


def _spans(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    for rows in frames:
        for r in rows.itertuples(index=False):
            ids = unpack(r.block_ids, r.plane_ends, r.payload, r.bits)
            yield r, ids, np.concatenate([[0], np.cumsum(r.lengths)]).astype(np.int64)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: ``key, start, n_tokens, ids_crc32``; start counts the ids before it in all files."""
    def digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for r, ids, at in _spans(frames):
            raw = ids.astype("<u4").tobytes()
            yield pd.DataFrame({"part": r.part, "segment": r.segment, "key": list(r.keys), "inside": at[:-1], "n_tokens": r.lengths,
                                "ids_crc32": [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at[:-1], at[1:])]})

    files = spark.read.parquet(path)
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    # Offsets of the parts: one row a part. Offsets inside a part: one row a segment.
    parts = (files.groupBy("part").agg(F.sum("n_ids").alias("n"))
             .select("part", F.coalesce(F.sum("n").over(before().orderBy("part")), F.lit(0)).alias("part_start")))
    starts = (files.select("part", "segment", F.coalesce(F.sum("n_ids").over(before("part").orderBy("segment")), F.lit(0)).alias("segment_start"))
              .join(parts, "part").select("part", "segment", (F.col("part_start") + F.col("segment_start")).alias("start0")))
    read = files.mapInPandas(digests, "part int, segment int, key string, inside long, n_tokens long, ids_crc32 long")
    return read.join(starts, ["part", "segment"]).select("key", (F.col("start0") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: ``key, ids``."""
    def arrays(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for r, ids, at in _spans(frames):
            yield pd.DataFrame({"key": list(r.keys), "ids": [ids[a:b].astype(np.int64) for a, b in zip(at[:-1], at[1:])]})

    return spark.read.parquet(path).mapInPandas(arrays, "key string, ids array<long>")


def op5_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    path = new_path(spark, "token-planes")
    write_ids(docs, path, public_tokenizers.path(VOCABULARY))
    return read_digests(spark, path).select(F.col("key").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "start", "n_tokens", "ids_crc32")


ship(__name__)
