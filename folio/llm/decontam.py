"""Benchmark decontamination by a positional inverted index (DataFrame functions only).

The index is a stored table of postings: a row for each occurrence of a benchmark term in the
training texts, with the text's row number and the word's place, and one row a text that marks its
end. Every window of a test item is looked up from its rarest term: that term's postings, moved
back by its offset, give the places where the window could begin; the second rarest term's list, moved
by its own offset, is intersected with them; the places left are checked against all terms. A
place of which enough neighbouring offsets match is an exact occurrence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.llm.common import broadcast_if_small, documents, numbered, stored

WINDOW = 10
#: Places by which a word of a proximity match may be off.
SLOP = 3
#: Rows up to which a counted table is broadcast.
SMALL = 1 << 18

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What separates words: ASCII other than digits and (lower-cased) letters.
_GAP = r"[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words(text: str) -> Column:
    """The lower-cased (A-Z) words of a text, in order; null has none. lower() is used where it can change only A-Z."""
    low = f"if(octet_length({text}) = char_length({text}), lower({text}), translate({text}, '{_UPPER}', '{_UPPER.lower()}'))"
    return F.expr(f"coalesce(array_remove(split({low}, '{_GAP}'), ''), array())")


def item_terms(items: DataFrame, width: int = WINDOW) -> DataFrame:
    """``iid, item_id, off, term, n``: the words of each distinct item (by id and text) in order; stored, so that
    ``iid`` is one number for an item in every use."""
    named = stored(items.select("item_id", "text").distinct().withColumn("iid", F.monotonically_increasing_id()), "items")
    return (named.select("iid", "item_id", words("text").alias("w")).where("size(w) > 0")
            .select("iid", "item_id", F.size("w").alias("n"), F.posexplode("w").alias("off", "term")))


def build_index(docs: DataFrame, terms: DataFrame, row: Column | None = None) -> DataFrame:
    """Stored postings ``term, row, pos, doc_id`` of the ``terms`` (a column term) in ``docs``. A text's last
    posting has the empty term: its pos is the number of words and it alone carries doc_id. Rows are numbered by
    the column ``row``, or here, then the numbers mean nothing outside the postings."""
    wanted = stored(terms.select("term").union(terms.sparkSession.createDataFrame([("",)], "term string")).distinct(), "terms")
    tokens = (docs.select((F.monotonically_increasing_id() if row is None else row).alias("row"), "doc_id", F.concat(words("text"), F.array(F.lit(""))).alias("w"))
              .select("row", "doc_id", F.posexplode("w").alias("pos", "term")))
    found = tokens.join(broadcast_if_small(wanted, SMALL), "term", "left_semi")
    return stored(found.select("term", "row", "pos", F.expr("if(term = '', doc_id, null)").alias("doc_id")), "postings")


def term_counts(index: DataFrame) -> DataFrame:
    return stored(index.where("term <> ''").groupBy("term").agg(F.count("*").alias("df")), "term-counts")


def rarest(terms: DataFrame, counts: DataFrame, width: int = WINDOW) -> DataFrame:
    """One row a window of an item whose terms all occur: ``iid, start, size, a_off, a_term, b_off, b_term``, a the
    rarest and b the second rarest of its words (b null for a window of one word)."""
    ahead = Window.partitionBy("iid").orderBy("off").rowsBetween(0, width - 1)
    known = terms.join(counts, "term", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    ranked = known.withColumn("by", F.array_sort(F.collect_list(F.struct("df", "off", "term")).over(ahead)))
    return (ranked.where(f"off <= greatest(n - {width}, 0) and by[0].df > 0")
            .select("iid", F.col("off").alias("start"), F.size("by").alias("size"), F.expr("by[0].off").alias("a_off"),
                    F.expr("by[0].term").alias("a_term"), F.expr("get(by, 1).off").alias("b_off"), F.expr("get(by, 1).term").alias("b_term")))


def seeded(index: DataFrame, terms: DataFrame, width: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """The windows (``rarest``), and ``row, iid, a_off, b_off, b_term, shift``: the places at which a rarest term puts its item, both stored."""
    windows = stored(rarest(terms, term_counts(index), width), "windows")
    # Rarest lists, moved back by their offsets: where each item could lie in each text.
    seeds = windows.select("iid", "a_off", F.col("a_term").alias("term")).distinct()
    at = (_lists(index).join(broadcast_if_small(seeds, SMALL), "term").select("row", "iid", "a_off", (F.col("pos") - F.col("a_off")).alias("shift"))
          .where("shift >= -a_off"))
    pairs = windows.select("iid", "a_off", "b_off", "b_term").distinct()
    return windows, stored(at.join(broadcast_if_small(pairs, SMALL), ["iid", "a_off"]), "seeds")


def _lists(index: DataFrame) -> DataFrame:
    return index.where("term <> ''").select("term", "row", "pos")


def _seconds(index: DataFrame, windows: DataFrame) -> DataFrame:
    """The lists of the second rarest terms."""
    terms = stored(windows.where("b_term is not null").select(F.col("b_term").alias("term")).distinct(), "second-terms")
    return _lists(index).join(broadcast_if_small(terms, SMALL), "term", "left_semi")


def _of_rows(index: DataFrame, places: DataFrame) -> DataFrame:
    """The lists, of the rows in ``places`` alone."""
    rows = stored(places.select("row").distinct(), "place-rows")
    return _lists(index).join(broadcast_if_small(rows, 1 << 21), "row", "left_semi")


def occurrences(index: DataFrame, terms: DataFrame, windows: DataFrame, at: DataFrame, width: int = WINDOW) -> DataFrame:
    """Maximal runs of exact matches: ``row, iid, item_id, first, last`` (places of words in the text). Each run
    holds at least ``width`` words of the item, or the whole item if that is shorter."""
    # Intersected with the second rarest lists, moved by their offsets.
    both = (at.where("b_term is not null").select("row", "iid", "a_off", "shift", F.col("b_term").alias("term"), (F.col("shift") + F.col("b_off")).alias("pos"))
            .join(_seconds(index, windows), ["row", "pos", "term"], "left_semi").select("row", "iid", "a_off", "shift"))
    places = stored(both.union(at.where("b_term is null").select("row", "iid", "a_off", "shift"))
                    .groupBy("row", "iid", "shift").agg(F.collect_set("a_off").alias("seeds")), "places")

    # The words around the seeds (a window holds its seed), at the places left.
    around = F.expr(f"explode(array_distinct(flatten(transform(seeds, s -> sequence(greatest(s - {width - 1}, 0), s + {width - 1})))))")
    expected = (places.select("row", "iid", "shift", around.alias("off")).join(broadcast_if_small(terms, SMALL), ["iid", "off"])
                .withColumn("pos", F.col("shift") + F.col("off")))
    matched = expected.join(_of_rows(index, places), ["row", "pos", "term"], "left_semi")
    order = Window.partitionBy("row", "iid", "shift").orderBy("off")
    return (matched.withColumn("run", F.col("off") - F.row_number().over(order))
            .groupBy("row", "iid", "item_id", "shift", "run").agg(F.min("pos").alias("first"), F.max("pos").alias("last"), F.first("n").alias("n"))
            .where(f"last - first + 1 >= least({width}, n)").select("row", "iid", "item_id", "first", "last"))


def nearby(index: DataFrame, terms: DataFrame, windows: DataFrame, at: DataFrame, slop: int, width: int = WINDOW) -> DataFrame:
    """Proximity matches: ``row, item_id``, the texts in which every word of some window stands at most ``slop``
    places from where the window's rarest word puts it (inserted, left out or exchanged words between). Exact matches are among them."""
    # A word expected at e is met in the cells of 2 * slop + 1 places that e - slop and e + slop lie in: two at most.
    cell = lambda at: F.floor(at / (2 * slop + 1))

    def meet(expected: DataFrame, lists: DataFrame) -> DataFrame:
        """The rows of ``expected`` (row, term, e) with the term at most ``slop`` places from e; some of them twice."""
        spread = expected.withColumn("cell", F.explode(F.array_distinct(F.array(cell(F.col("e") - slop), cell(F.col("e") + slop)))))
        return (spread.join(lists.withColumn("cell", cell(F.col("pos"))), ["row", "term", "cell"]).where(f"abs(pos - e) <= {slop}"))

    key = ["row", "iid", "a_off", "shift"]
    second = meet(at.where("b_term is not null").select(*key, F.col("b_term").alias("term"), (F.col("shift") + F.col("b_off")).alias("e")), _seconds(index, windows))
    places = stored(second.select(*key).union(at.where("b_term is null").select(*key)).distinct(), "near-places")
    expected = (places.withColumn("off", F.expr(f"explode(sequence(greatest(a_off - {width - 1}, 0), a_off + {width - 1}))"))
                .join(broadcast_if_small(terms.select("iid", "off", "term"), SMALL), ["iid", "off"]).withColumn("e", F.col("shift") + F.col("off")))
    found = meet(expected, _of_rows(index, places)).groupBy(*key).agg(F.collect_set("off").alias("offs"))
    whole = "size(array_except(sequence(start, start + size - 1), offs)) = 0"
    rows = found.join(broadcast_if_small(windows.select("iid", "start", F.col("size").cast("int").alias("size"), "a_off"), SMALL), ["iid", "a_off"]).where(whole)
    named = stored(terms.select("iid", "item_id").distinct(), "item-names")
    return rows.select("row", "iid").distinct().join(broadcast_if_small(named, SMALL), "iid").select("row", "item_id")


def _named(found: DataFrame, name: str) -> DataFrame:
    """``row, name``: the sorted distinct item ids of each row of ``found`` (row, item_id)."""
    return (found.select("row", F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item")).distinct()
            .groupBy("row").agg(F.array_sort(F.collect_list("item")).alias(name)))


def _digest(ids: Column) -> Column:
    return F.sha2(F.array_join(ids, ",").cast("binary"), 256)


def contamination(docs: DataFrame, items: DataFrame, width: int = WINDOW, row: Column | None = None, slop: int | None = None) -> DataFrame:
    """``row, doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every row of ``docs``; with ``slop`` also
    ``n_near, near_sha256``, the items of its proximity matches (``nearby``).

    Defined cases: a null or empty text has no words and no hit; items without words are ignored; items with
    equal id and text are one, those with an equal id count once; a null item id is written as empty
    text; repeated rows each get a row; empty tables give no rows, or no hits; other columns are ignored.
    """
    terms = stored(item_terms(items, width), "item-terms")
    index = build_index(docs, terms, row)
    windows, at = seeded(index, terms, width)
    runs = stored(occurrences(index, terms, windows, at, width), "runs")
    hit = (runs.select("row", F.explode(F.sequence("first", "last")).alias("pos")).distinct().groupBy("row").agg(F.count("*").alias("n_hit")))
    ends = index.where("term = ''").select("row", "doc_id", F.col("pos").cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    found = F.coalesce("found", none)
    out = (ends.join(hit, "row", "left").join(_named(runs, "found"), "row", "left")
           .select("row", "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(found).cast("long").alias("n_items"),
                   _digest(found).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated")))
    if slop is None:
        return out
    near = F.coalesce("near", none)
    return (out.join(_named(nearby(index, terms, windows, at, slop, width), "near"), "row", "left")
            .select(*out.columns, F.size(near).cast("long").alias("n_near"), _digest(near).alias("near_sha256")))


def drop_contaminated(docs: DataFrame, items: DataFrame, width: int = WINDOW) -> DataFrame:
    """The documents without a benchmark window, with all their columns."""
    table = numbered(docs)
    found = contamination(table.select("row", "carried.doc_id", "carried.text"), items, width, F.col("row"))
    gone = stored(found.where("contaminated").select("row"), "contaminated")
    return table.join(broadcast_if_small(gone, 1 << 21), "row", "left_anti").select("carried.*")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), slop=SLOP).drop("row")


OP8_SQL = r"""
with docs as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
items as (
  select row_number() over () as i, item_id, w from (select distinct item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark)),
sizes as (select i, item_id, w, least(10, len(w)) as size from items where len(w) > 0),
grams as (
  select distinct item_id, size, array_to_string(w[s:s + size - 1], ' ') as g
  from (select item_id, w, size, unnest(range(1, len(w) - size + 2)) as s from sizes)),
places as (
  select r, w, size, unnest(range(1, len(w) - size + 2)) as s from docs, (select distinct size from sizes) where len(w) >= size),
found as (
  select r, s, size, item_id from (select r, s, size, array_to_string(w[s:s + size - 1], ' ') as g from places) join grams using (size, g)),
hits as (select r, count(distinct p) as n_hit from (select r, unnest(range(s, s + size)) as p from found) group by r),
named as (
  select r, count(*) as n_items, string_agg(item, ',' order by item) as ids
  from (select distinct r, cast(item_id as varchar) as item from found) group by r),
tokens as (select r, unnest(w) as term, unnest(range(len(w))) as pos from docs),
counts as (select term, count(*) as df from tokens group by term),
slots as (
  select i, item_id, s, size, unnest(range(s, s + size)) as off, unnest(w[s + 1:s + size]) as term
  from (select i, item_id, w, size, unnest(range(0, len(w) - size + 1)) as s from sizes)),
anchors as (
  select i, s, size, off, term from (
    select slots.*, bool_and(df is not null) over (partition by i, s) as known, row_number() over (partition by i, s order by df, off) as k
    from slots left join counts using (term)) where known and k = 1),
laid as (select i, s, size, r, pos - off as shift from anchors join tokens using (term)),
met as (
  select laid.i, laid.s, laid.r, laid.shift, any_value(slots.item_id) as item_id from laid
  join slots on slots.i = laid.i and slots.s = laid.s
  join tokens t on t.r = laid.r and t.term = slots.term and t.pos between laid.shift + slots.off - 3 and laid.shift + slots.off + 3
  group by laid.i, laid.s, laid.r, laid.shift, laid.size having count(distinct slots.off) = laid.size),
nears as (
  select r, count(*) as n_near, string_agg(item, ',' order by item) as near_ids
  from (select distinct r, cast(item_id as varchar) as item from met) group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, n_hit is not null as contaminated,
  cast(coalesce(n_near, 0) as bigint) as n_near, sha256(coalesce(near_ids, '')) as near_sha256
from docs left join hits using (r) left join named using (r) left join nears using (r)
"""
