"""N-gram Jaccard join as a blocked sparse product of the document by n-gram incidence.

The incidence matrix is cut into blocks of columns (n-grams, by hash). A first pass over the blocks
adds up, per document, how many of its n-grams occur in another document; who has fewer than the
threshold's share can link to nobody and leaves. That takes out nearly all rows of a corpus at the price of
one packed shuffle.

Of the rest, each distinct set of n-grams is one row. Columns are ordered from the rarest. Sizes na
and nb ask for an overlap of at least ``o``, so two rows that link share one of the first
``na - o + 1`` columns of the one and ``nb - o + 1`` of the other. Pairs of admissible sizes that meet
there are the places of the product that are computed. A row is stored as one cell for each of ``CELLS``
column blocks. Counts of the first block leave out every pair that cannot reach ``o`` even if all its
other columns were shared; counts of the other blocks are added up for the rest, and the sum decides.

Only links between different components matter for components. So the columns first link each row to
one other row (stars, not all pairs), in a few rounds with other centres; all pairs of a column follow only
where it still holds rows of different components. A crowd of rows that such columns connect is not paired by its common
columns at all: its rows are told by their differences from the columns that most of them have (``crowd_links``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import broadcast_if_small, counted, documents, give_back, numbered, ship, stored

#: The query's n-grams and bound: link when DEN * intersection >= NUM * union. The pipeline gives its own.
N = 4
NUM, DEN = 85, 100
#: Shingles of a column block, and of a packed piece.
BLOCK_SHINGLES = 1 << 21
PIECE = 1 << 18
REMEMBERED = 1 << 18
STAR_ROUNDS = 2
#: Centres that the rows of a group of copies meet in a round, over all their columns: few at first, as one is
#: enough for most; the rows left meet GROWTH times as many in the next round, and at most CENTRES.
GROWTH = 8
CENTRES = 64
#: Column blocks that a row's cells are cut into for the counts; the hash's highest bits name the block.
CELLS = 4
#: Rows up to which a counted table is broadcast.
SMALL = 1 << 21
#: Rows from which on those that open columns connect are a crowd.
CROWD = 32
#: A component is large from this many rows on, and from one row in HEAD: so at most HEAD are large.
LARGE = 1 << 10
HEAD = 1 << 16


class Shingler:
    """Sorted distinct hashes of a text's word n-grams; of the whole text if it has fewer words."""

    def __init__(self, n: int):
        import xxhash

        self.n, self.digest, self.known = n, xxhash.xxh3_64_intdigest, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split() if isinstance(text, str) else []
        if not words:
            return np.empty(0, np.uint64)
        known = self.known
        if new := set(words).difference(known):
            if len(known) + len(new) > REMEMBERED:
                known.clear()
                new = set(words)
            known.update((w, self.digest(w)) for w in new)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        width = min(self.n, len(words))
        out = h[:len(h) - width + 1] + np.uint64(width)
        for i in range(1, width):
            out = (out ^ (out >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - width + 1 + i]
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return np.unique(out ^ (out >> np.uint64(32)))

    def signature(self, hashes: np.ndarray) -> int:
        """Names a set of hashes by 63 bits."""
        return self.digest(hashes.tobytes()) >> 1


def signatures(docs: DataFrame, n: int) -> DataFrame:
    """``row, key, n, sig`` of every row of ``docs`` (row, key, text): size and name of its set."""
    def sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle = Shingler(n)
        for rows in frames:
            sets = [shingle(t) for t in rows["text"]]
            yield pd.DataFrame({"row": rows["row"], "key": rows["key"], "n": [len(s) for s in sets], "sig": [shingle.signature(s) for s in sets]})
        give_back()

    return docs.select("row", "key", "text").mapInPandas(sign, "row long, key string, n int, sig long")


def sharers(docs: DataFrame, n: int, blocks: int, num: int, den: int) -> DataFrame:
    """``sig`` of the rows of which at least num / den of the n-grams occur in another row too.

    Each task packs its hashes by column block; a block's task sorts them and marks those that
    occur twice; the marks are summed per document. Hashes are cut to 32 bits inside a block: a
    collision can only let a row stay.
    """
    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash
        from pyspark import TaskContext

        shingle, task, piece = Shingler(n), TaskContext.get().partitionId(), 0

        def close(sets: list[np.ndarray]) -> pd.DataFrame:
            sigs = np.array([shingle.signature(s) for s in sets], "<i8")
            home = xxhash.xxh3_64_intdigest(sigs.tobytes(), seed=(task << 20) + piece) >> 1
            hashes = np.concatenate(sets)
            column = ((hashes >> np.uint64(40)) % np.uint64(blocks)).astype(np.int32)
            order = np.argsort(column, kind="stable")
            low = (hashes & np.uint64(0xFFFFFFFF)).astype("<u4")[order]
            doc = np.repeat(np.arange(len(sets), dtype="<u2"), [len(s) for s in sets])[order]
            ends = np.searchsorted(column[order], np.arange(blocks + 1))
            used = np.flatnonzero(np.diff(ends))
            sizes = np.array([len(s) for s in sets], "<i4")
            return pd.DataFrame({"block": [*used.tolist(), -1 - home % blocks], "home": home,
                                 "hashes": [*(low[ends[b]:ends[b + 1]].tobytes() for b in used), sigs.tobytes()],
                                 "docs": [*(doc[ends[b]:ends[b + 1]].tobytes() for b in used), sizes.tobytes()]})

        sets, size = [], 0
        for rows in frames:
            for text in rows["text"]:
                if len(s := shingle(text)):
                    sets.append(s)
                    size += len(s)
                    if size >= PIECE or len(sets) == 1 << 16:
                        yield close(sets)
                        sets, size, piece = [], 0, piece + 1
        if sets:
            yield close(sets)
        del sets, shingle
        give_back()

    def mark(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        if key[0] < 0:  # names and sizes pass through
            return pd.DataFrame({"home": rows["home"], "names": rows["hashes"], "counts": rows["docs"]})
        low = np.concatenate([np.frombuffer(x, "<u4") for x in rows["hashes"]])
        order = np.argsort(low, kind="stable")
        same = low[order][1:] == low[order][:-1]
        twice = np.zeros(len(low), bool)
        twice[order[1:]] = same
        twice[order[:-1]] |= same
        at, out = 0, []
        for x in rows["docs"]:
            doc = np.frombuffer(x, "<u2")
            out.append(np.bincount(doc[twice[at:at + len(doc)]]).astype("<i4").tobytes())
            at += len(doc)
        return pd.DataFrame({"home": rows["home"], "names": None, "counts": out})

    def keep(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        names = rows["names"].notna()
        sigs = np.frombuffer(rows["names"][names].iloc[0], "<i8")
        sizes = np.frombuffer(rows["counts"][names].iloc[0], "<i4")
        shared = np.zeros(len(sigs), np.int64)
        for x in rows["counts"][~names]:
            c = np.frombuffer(x, "<i4")
            shared[:len(c)] += c
        return pd.DataFrame({"sig": sigs[den * shared >= num * sizes.astype(np.int64)]})

    packed = docs.select("text").mapInPandas(pack, "block int, home long, hashes binary, docs binary")
    return (packed.groupBy("block").applyInPandas(mark, "home long, names binary, counts binary")
            .groupBy("home").applyInPandas(keep, "sig long"))


def components(links: DataFrame) -> DataFrame:
    """``node, comp`` for the nodes of undirected ``links`` (a, b): the smallest node reachable.

    Rounds of taking the neighbours' smallest label and then that label's own label; each round's
    labels are a written table. Long paths halve in each round, stars take two.
    """
    edges = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("comp"))
    labels = stored(labels, "labels")
    while True:
        near = (edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near")))
        lower = labels.join(near, "node").select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        of_label = labels.select(F.col("node").alias("comp"), F.col("comp").alias("above"))
        moved = lower.join(of_label, "comp", "left").select("node", "old", F.least("comp", F.coalesce("above", "comp")).alias("comp"))
        moved, changed = counted(moved, "labels", F.expr("cast(old <> comp as int)"))
        labels = moved.select("node", "comp")
        if not changed:
            return labels


def _prefix(n: str, num: int, den: int) -> str:
    """SQL of the longest prefix of columns that a row of size n needs with any partner."""
    return f"least({n}, {n} - cast(ceil({num} * {n} / {den}) as long) + 1)"


def _least(num: int, den: int) -> str:
    """SQL of the least overlap with which sizes na and nb link."""
    return f"cast(ceil({num} * (na + nb) / {num + den}) as long)"


def first_counts(pairs: DataFrame, cells: DataFrame, num: int, den: int) -> DataFrame:
    """``a, b, na, nb, overlap`` of the pairs (a, b) that may still link: overlap in the first column block. The
    columns of the other blocks bound what can be added."""
    first = cells.where("block = 0")
    left = first.select(F.col("sig").alias("a"), F.col("n").alias("na"), F.col("hashes").alias("ha"))
    right = first.select(F.col("sig").alias("b"), F.col("n").alias("nb"), F.col("hashes").alias("hb"))
    counted = pairs.select("a", "b").join(left, "a").join(right, "b").withColumn("overlap", F.size(F.array_intersect("ha", "hb")).cast("long"))
    return counted.where(f"overlap + least(na - size(ha), nb - size(hb)) >= {_least(num, den)}").select("a", "b", "na", "nb", "overlap")


def linking(pairs: DataFrame, cells: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that link, by overlap counts accumulated over the column blocks of ``cells``
    (sig, n, block, hashes; each row has a cell, if an empty one, in each block)."""
    rest = cells.where("block > 0")
    left = rest.select(F.col("sig").alias("a"), "block", F.col("hashes").alias("ha"))
    right = rest.select(F.col("sig").alias("b"), "block", F.col("hashes").alias("hb"))
    added = (first_counts(pairs, cells, num, den).join(left, "a").join(right, ["b", "block"])
             .groupBy("a", "b", "na", "nb", "overlap").agg(F.sum(F.size(F.array_intersect("ha", "hb"))).alias("more")))
    return added.where(f"{den} * (overlap + more) >= {num} * (na + nb - overlap - more)").select("a", "b")


def linked_sets(cells: DataFrame, num: int, den: int, rounds: int = STAR_ROUNDS) -> DataFrame:
    """``node, comp`` over the rows of ``cells`` (sig, n, block, hashes), of all that link to another."""
    least = _least(num, den)
    sizes = f"({den} * least(na, nb) >= {num} * greatest(na, nb))"
    entries = cells.select("sig", "n", F.explode("hashes").alias("h"))
    often = entries.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    shared = entries.join(often, "h").groupBy("sig", "n").agg(F.array_sort(F.collect_list(F.struct("df", "h"))).alias("own"))
    # A row's columns that only it has come first in its order; they fill the prefix but match nobody.
    room = f"{_prefix('n', num, den)} - (n - size(own))"
    size_class = f"cast(floor(ln(n) / ln({den / num})) as int)"
    prefix = (shared.where(f"{room} > 0")
              .select("sig", "n", F.expr(size_class).alias("own_class"), F.expr("n - size(own)").alias("alone"),
                      F.expr(f"posexplode(slice(own, 1, cast(least({room}, size(own)) as int)))").alias("i", "c"))
              .select("sig", "n", "own_class", F.col("c.h").alias("h"), (F.col("alone") + F.col("i")).alias("at"), F.explode(F.array(F.col("own_class"), F.col("own_class") - 1)).alias("k")))
    # A column's rows by neighbouring size classes: rows of admissible sizes meet in (h, the smaller class).
    prefix = stored(prefix, "prefixes")

    labels = cells.sparkSession.createDataFrame([], "node long, comp long")
    for r in range(rounds):
        centres = min(GROWTH ** r, CENTRES)
        now = prefix.join(labels.withColumnRenamed("node", "sig"), "sig", "left").withColumn("comp", F.coalesce("comp", "sig"))
        centre = (now.groupBy("h", "k").agg(F.min(F.struct(F.xxhash64("sig", F.lit(r), F.expr(f"pmod(h, {centres})")).alias("x"), "sig", "n", "comp")).alias("m"),
                                            F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi"))
        pairs = (now.join(centre.select("h", "k", "m"), ["h", "k"]).where("comp <> m.comp")
                 .select(F.least("sig", "m.sig").alias("a"), F.greatest("sig", "m.sig").alias("b"), F.col("n").alias("na"), F.col("m.n").alias("nb"))
                 .where(sizes).dropDuplicates(["a", "b"]))
        labels, new = merged(labels, linking(pairs, cells, num, den))
        if not new and centres == CENTRES:
            break

    now = prefix.join(labels.withColumnRenamed("node", "sig"), "sig", "left").withColumn("comp", F.coalesce("comp", "sig"))
    mixed = now.groupBy("h", "k").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("h", "k")
    now, entries = counted(now.join(mixed, ["h", "k"]), "open-columns")
    if not entries:
        return labels
    crowds, many = crowded(now)
    if many:
        crowds = broadcast_if_small(crowds, SMALL, many)
        labels = crowd_links(labels, crowds, cells, num, den)
        now = now.join(crowds.select("sig"), "sig", "left_anti")
    side = lambda x: now.select("h", "k", F.col("sig").alias(x), F.col("n").alias(f"n{x}"), F.col("comp").alias(f"c{x}"), F.col("own_class").alias(f"k{x}"), F.col("at").alias(f"at{x}"))
    early = f"ata <= na - {least} and atb <= nb - {least}"
    pairs = (side("a").join(side("b"), ["h", "k"]).where(f"a < b and ca <> cb and k = least(ka, kb) and {sizes} and {early}")
             .select("a", "b").distinct())
    return merged(labels, linking(pairs, cells, num, den))[0]


def crowded(now: DataFrame) -> tuple[DataFrame, int]:
    """``sig, crowd, many`` of the rows of open columns (sig, h, k) of which at least ``CROWD`` are connected by such columns; their number."""
    first = now.groupBy("h", "k").agg(F.min("sig").alias("b"))
    connected = components(now.join(first, ["h", "k"]).where("sig <> b").select(F.col("sig").alias("a"), "b").distinct())
    crowds = connected.groupBy("comp").agg(F.count("*").alias("many")).where(f"many >= {CROWD}")
    return counted(connected.join(crowds, "comp").select(F.col("node").alias("sig"), F.col("comp").alias("crowd"), "many"), "crowds")


def crowd_links(labels: DataFrame, crowds: DataFrame, cells: DataFrame, num: int, den: int) -> DataFrame:
    """``labels`` and all links inside the ``crowds`` (sig, crowd, many).

    Each row of a crowd is held against the crowd's reference, the columns that more than half of its rows have; ``d`` counts
    the differences, missing and own columns alike. Rows a and b differ in da + db - 2 x places if x differences are common to
    both, so they link when ea + eb <= 2 (num + den) x with e = (num + den) d - (den - num) n. With x = 0, both then link to the row of
    the least e as well: a star is enough. All other links need common differences, by the same bounds on
    prefixes and places as columns (rarest first); columns that all rows share are in no difference and pair nobody.
    """
    total = num + den
    own = stored(cells.join(crowds, "sig"), "crowd-cells")
    common = (own.select("crowd", "many", "block", F.explode("hashes").alias("h")).groupBy("crowd", "many", "block", "h").agg(F.count("*").alias("c"))
              .where("2 * c > many").groupBy("crowd", "block").agg(F.collect_list("h").alias("ref")))
    common, size = counted(common, "crowd-references", F.size("ref"))
    ref = F.coalesce("ref", F.expr("cast(array() as array<long>)"))
    differences = stored(own.join(broadcast_if_small(common, SMALL, size), ["crowd", "block"], "left")
                         .select("sig", "crowd", "n", F.concat(F.array_except("hashes", ref), F.array_except(ref, "hashes")).alias("hashes")), "differences")
    rows = stored(differences.groupBy("sig", "crowd", "n").agg(F.sum(F.size("hashes")).cast("long").alias("d"))
                  .withColumn("e", F.expr(f"{total} * d - {den - num} * n")), "crowd-rows")
    least, crowd_count = counted(rows.groupBy("crowd").agg(F.min(F.struct("e", "sig")).alias("m")), "crowd-least")
    rows = rows.join(broadcast_if_small(least, SMALL, crowd_count), "crowd")
    stars = rows.where("sig <> m.sig and e + m.e <= 0").select(F.col("sig").alias("a"), F.col("m.sig").alias("b"))
    labels, _ = merged(labels, stars)

    entries = differences.select("sig", "crowd", F.explode("hashes").alias("h"))
    often = entries.groupBy("crowd", "h").agg(F.count("*").alias("df")).where("df > 1")
    shared = entries.join(often, ["crowd", "h"]).groupBy("sig").agg(F.array_sort(F.collect_list(F.struct("df", "h"))).alias("own"))
    # With any partner at least this many differences must be common.
    room = f"d - greatest(1, cast(ceil((e + m.e) / {2 * total}) as long)) + 1 - (d - size(own))"
    prefix = (shared.join(rows, "sig").where(f"{room} > 0")
              .select("sig", "crowd", "n", "d", "e", F.expr("d - size(own)").alias("alone"), F.expr(f"posexplode(slice(own, 1, cast(least({room}, size(own)) as int)))").alias("i", "c"))
              .select("sig", "crowd", "n", "d", "e", F.col("c.h").alias("h"), (F.col("alone") + F.col("i")).alias("at")))
    now, left = counted(prefix.join(labels.withColumnRenamed("node", "sig"), "sig", "left").withColumn("comp", F.coalesce("comp", "sig")), "crowd-prefixes")
    if not left:
        return labels
    mixed = now.groupBy("crowd", "h").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("crowd", "h")
    now = now.join(mixed, ["crowd", "h"])
    side = lambda x: now.select("crowd", "h", *[F.col(c).alias(c[0] + x if c != "at" else f"at{x}") for c in ("n", "d", "e", "comp", "at")], F.col("sig").alias(x))
    needed = f"cast(ceil((ea + eb) / {2 * total}) as long)"
    pairs = (side("a").join(side("b"), ["crowd", "h"])
             .where(f"a < b and ca <> cb and {den} * least(na, nb) >= {num} * greatest(na, nb) and ata <= da - {needed} and atb <= db - {needed}")
             .select("a", "b").distinct())
    return merged(labels, linking(pairs, cells, num, den))[0]


def merged(labels: DataFrame, links: DataFrame) -> tuple[DataFrame, int]:
    """``node, comp`` of old labels and new links (a, b), and the number of the links: they join whole components, so only their
    labels are walked."""
    def label(x: str) -> DataFrame:
        return labels.select(F.col("node").alias(x), F.col("comp").alias(f"c{x}"))

    between = (links.join(label("a"), "a", "left").join(label("b"), "b", "left")
               .select("a", "b", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb")))
    between, new = counted(between, "links")
    if not new:
        return labels, 0
    joined = components(between.select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct())
    nodes = labels.union(between.select("a", "ca")).union(between.select("b", "cb")).distinct()
    return stored(nodes.join(joined.select(F.col("node").alias("old"), F.col("comp").alias("least")), F.col("comp") == F.col("old"), "left")
                  .select("node", F.coalesce("least", "comp").alias("comp")), "labels"), new


def classes(docs: DataFrame, n: int = N, num: int = NUM, den: int = DEN) -> DataFrame:
    """``row, key, n, comp`` of every row of ``docs`` (row, key, text; stored, as it is read again by row): set size, and the
    name of its component (null for an empty set)."""
    signed, total = counted(signatures(docs, n), "signatures", F.col("n"))
    blocks = max(1, math.ceil(total / BLOCK_SHINGLES))
    stays = sharers(docs, n, blocks, num, den).distinct()
    chosen, sets = counted(signed.join(stays, "sig").groupBy("sig").agg(F.min("row").alias("row")), "sharers")

    def hashes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle = Shingler(n)
        for rows in frames:
            sets = [shingle(t) for t in rows["text"]]
            cuts = [np.split(s.view(np.int64), np.searchsorted(s, ends)) for s in sets]
            yield pd.DataFrame({"sig": np.repeat(rows["sig"].to_numpy(), CELLS), "n": np.repeat([len(s) for s in sets], CELLS),
                                "block": np.tile(np.arange(CELLS), len(sets)), "hashes": [c for row in cuts for c in row]})
        give_back()

    ends = np.array([(i << 64) // CELLS for i in range(1, CELLS)], np.uint64)
    cells = stored(docs.join(broadcast_if_small(chosen, SMALL, sets), "row").select("sig", "text")
                   .mapInPandas(hashes, "sig long, n int, block int, hashes array<long>"), "cells")
    found = linked_sets(cells, num, den).select(F.col("node").alias("sig"), "comp")
    return signed.join(found, "sig", "left").select("row", "key", "n", F.when(F.col("n") > 0, F.coalesce("comp", "sig")).alias("comp"))


def with_first(rows: DataFrame, order: Column) -> DataFrame:
    """``rows`` (stored) that have a ``comp``, each with its component's least ``order`` as ``first`` (null: the row is alone).

    Components are reduced before they are joined. The large ones, at most ``HEAD``, are broadcast, so their rows stay where
    they are; the rows of the others are dealt by component."""
    reduced = rows.where("comp is not null").groupBy("comp").agg(F.min(order).alias("first"), F.count("*").alias("many")).where("many > 1")
    reduced, bound = stored(reduced, "firsts"), max(LARGE, rows.count() // HEAD)
    large = F.broadcast(reduced.where(f"many >= {bound}").select("comp", "first"))
    some = rows.where("comp is not null")
    return (some.join(large, "comp")
            .unionByName(some.join(large, "comp", "left_anti").join(reduced.where(f"many < {bound}").select("comp", "first"), "comp", "left")))


def texts(table: DataFrame) -> DataFrame:
    """``row, key, text`` of a numbered table: doc_id as text."""
    return table.select("row", F.col("carried.doc_id").cast("string").alias("key"), "carried.text")


def jaccard_components(docs: DataFrame, n: int = N, num: int = NUM, den: int = DEN) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs``.

    Defined cases: a null or empty text, or one of white space, has no n-grams and links with nothing;
    equal texts and repeated rows link; a row without links is its own component; null ids are not
    counted for the smallest id unless a component has no other; an empty table gives no rows; other
    columns are ignored. Sets are compared by 64-bit hashes.
    """
    table, kind = numbered(docs, ["doc_id", "text"]), docs.schema["doc_id"].dataType
    rows = stored(classes(texts(table), n, num, den).withColumn("doc_id", F.col("key").cast(kind)), "classes")
    size = F.col("n").cast("long").alias("n_shingles")
    return (with_first(rows, F.col("doc_id")).select("doc_id", size, F.coalesce("first", "doc_id").alias("component_id"))
            .unionByName(rows.where("comp is null").select("doc_id", size, F.col("doc_id").alias("component_id"))))


def keep_one(docs: DataFrame, n: int = N, num: int = NUM, den: int = DEN) -> DataFrame:
    """One document of each component, that of the smallest id (then the first row).

    Defined cases: documents without n-grams (null, empty, white space) all stay; of a component with null ids one
    with an id stays, if there is any; repeated rows are one component; an empty table stays empty; all columns pass through, and names
    cannot clash (the input row is carried as a struct).
    """
    table, kind = numbered(docs), docs.schema["doc_id"].dataType
    rows = stored(classes(texts(table), n, num, den).withColumn("doc_id", F.col("key").cast(kind)), "classes")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    gone, many = counted(with_first(rows, order).where("row <> first.row").select("row"), "copies")
    return table.join(broadcast_if_small(gone, SMALL, many), "row", "left_anti").select("carried.*")


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir))


OP10_SQL = r"""
with recursive lower as (
  select doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
words as (select doc_id, regexp_extract_all(coalesce(t, ''), '[^\x20\x09-\x0D]+') as w from lower),
sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) end as s from words),
shingles as (select doc_id, unnest(s) as g from sets),
overlap as (
  select x.doc_id as a, y.doc_id as b, count(*) as i from shingles x join shingles y using (g) where x.doc_id < y.doc_id group by 1, 2),
links as (
  select a, b from overlap join sets p on p.doc_id = a join sets q on q.doc_id = b where 100 * i >= 85 * (len(p.s) + len(q.s) - i)),
edges as (select a, b from links union all select b, a from links),
reach as (
  select doc_id as a, doc_id as b from sets
  union
  select reach.a, edges.b from reach join edges on edges.a = reach.b)
select sets.doc_id, cast(len(any_value(s)) as bigint) as n_shingles, min(reach.b) as component_id
from sets join reach on reach.a = sets.doc_id group by sets.doc_id
"""

ship(__name__)
