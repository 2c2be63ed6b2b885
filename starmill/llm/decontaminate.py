"""Benchmark decontamination over a positional inverted index of the corpus.

``build_index`` stores the postings (document, position, term) of every word.
A search takes the words of the benchmark items, counts how often each stands
in the corpus, and for every window of an item fetches the lists of its rarest
terms. A posting at p of the term at place q of an item says that the item
would begin at p - q; lists shifted by their places are intersected on that
beginning. What is left is compared word by word, again from the postings.

A proximity match needs the rarest terms of a window only near where they
would stand: their beginnings may differ by the slop.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.common import fitting, lower_ascii, row_key, same, text_of, words_of, written


@dataclass
class PositionalIndex:
    """``postings``: doc_id, key, at, term, n_words (of the document). ``documents``: doc_id, key of every row, words or not."""

    postings: DataFrame
    documents: DataFrame


def build_index(docs: DataFrame) -> PositionalIndex:
    """Stores the postings of whole texts in the shared folder, by document; nothing is shuffled.

    ``key`` is a hash of the text, so that rows with one id and different
    texts stay apart; equal rows have equal postings. Null texts have none.
    """
    text = text_of()
    docs = docs.select("doc_id", row_key(text).alias("key"), text.alias("text"))
    words = docs.select("doc_id", "key", words_of(lower_ascii(F.col("text"))).alias("words"))
    postings = words.select("doc_id", "key", F.size("words").alias("n_words"), F.posexplode("words").alias("at", "term"))
    return PositionalIndex(written(postings, "postings"), docs.select("doc_id", "key"))


def _units(items: DataFrame, length: int) -> DataFrame:
    """unit, item, words, size: every different item that has words, and how many of them make a window."""
    items = items.select(F.col("item_id").cast("string").alias("item"), words_of(lower_ascii(text_of())).alias("words"))
    items = items.where(F.size("words") > 0).withColumn("unit", F.xxhash64("item", "words"))
    return items.dropDuplicates(["unit"]).select("unit", "item", "words", F.least(F.size("words"), F.lit(length)).alias("size"))


def _rarest(index: PositionalIndex, units: DataFrame, rarest: int) -> tuple[DataFrame, DataFrame]:
    """The words of the items by place, and the places of the rarest words of each window.

    A window with a word that the corpus doesn't have occurs nowhere and is left out.
    """
    words = units.select("unit", "size", F.posexplode("words").alias("place", "term"))
    terms = fitting(written(words.select("term").distinct(), "terms"))
    counts = index.postings.join(terms, "term").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    words = written(words.join(fitting(written(counts, "term-counts")), "term", "left"), "item-words")
    by_place = words.groupBy("unit", "size").agg(F.sort_array(F.collect_list(F.struct("place", F.coalesce("n", F.lit(0)).alias("n")))).alias("each"))
    windows = by_place.select("unit", F.explode(F.sequence(F.lit(0), F.size("each") - F.col("size"))).alias("window"), "each", "size")
    windows = windows.select("unit", F.expr("slice(each, window + 1, size)").alias("each")).where(F.expr("forall(each, e -> e.n > 0)"))
    order = F.sort_array(F.transform("each", lambda e: F.struct(e["n"].alias("n"), e["place"].alias("place"))))
    return words, written(windows.select("unit", F.slice(order, 1, rarest)["place"].alias("places")), "rarest-places")


def search(index: PositionalIndex, items: DataFrame, length: int = 10, rarest: int = 3, slop: int = 20) -> tuple[DataFrame, DataFrame]:
    """Phrase matches and proximity matches of the windows of ``items`` (item_id, text).

    Phrase: doc_id, key, unit, item, begins, positions - the words of the
    document that stand in an occurrence of a window, where the item would begin
    at ``begins``. Proximity: doc_id, key, unit, item - the ``rarest`` rarest
    words of some window, or all of a shorter one, stand so that the beginnings
    they speak for differ by ``slop`` at most. An item of fewer words than ``length`` is one window; one
    without words matches nothing. Items with one id and different texts are
    units of their own, repeated ones are one unit; a null id is a null item.
    """
    units = written(_units(items, length), "units")
    words, windows = _rarest(index, units, rarest)
    sets = windows.groupBy("unit").agg(F.collect_set("places").alias("needed"), F.min(F.size("places")).alias("least"))
    needed = fitting(written(sets, "needed-places"))
    places = windows.select("unit", F.explode("places").alias("place")).distinct()
    wanted = fitting(written(places.join(words.select("unit", "place", "term"), ["unit", "place"]), "rarest-terms"))
    shifted = index.postings.join(wanted, "term").select("doc_id", "key", "unit", (F.col("at") - F.col("place")).alias("begins"), "place")
    lists = written(shifted.groupBy("doc_id", "key", "unit", "begins").agg(F.collect_set("place").alias("found")), "shifted-lists")
    whole = F.expr("size(found) >= least AND exists(needed, n -> size(array_except(n, found)) = 0)")
    starts = lists.join(needed, "unit").where(whole).select("doc_id", "key", "unit", "begins")

    # the words that stand where a start puts the item
    sizes = units.select("unit", "size", F.size("words").alias("n_words"))
    starts = fitting(written(starts.join(fitting(sizes), "unit"), "starts"))
    postings = index.postings
    inside = same(postings, starts, "doc_id", "key") & (postings["at"] >= starts["begins"]) & (postings["at"] < starts["begins"] + starts["n_words"])
    hits = postings.join(starts, inside).select(starts["doc_id"], starts["key"], "unit", "begins", "size", "term", (F.col("at") - F.col("begins")).alias("place"))
    agreed = hits.join(fitting(words.select("unit", "place", "term")), ["unit", "place", "term"])
    runs = agreed.groupBy("doc_id", "key", "unit", "begins", "size").agg(F.array_sort(F.collect_set("place")).alias("places"))
    # places are sorted and distinct: a window begins where the list's entry size - 1 further on is size - 1 larger
    runs = runs.withColumn("windows", F.expr("filter(places, (p, i) -> get(places, i + size - 1) = p + size - 1)")).where(F.size("windows") > 0)
    covered = F.expr("array_distinct(flatten(transform(windows, w -> sequence(w + begins, w + begins + size - 1))))")
    phrases = runs.select("doc_id", "key", "unit", "begins", covered.alias("positions"))

    # a frame holds the beginnings from one to slop further on, each once, so it never has more than slop + 1 rows
    ahead = Window.partitionBy("doc_id", "key", "unit").orderBy("begins").rangeBetween(0, slop)
    near = lists.withColumn("found", F.array_distinct(F.flatten(F.collect_list("found").over(ahead))))
    near = near.join(needed, "unit").where(whole).select("doc_id", "key", "unit").distinct()
    ids = fitting(units.select("unit", "item"))
    return written(phrases.join(ids, "unit"), "phrases"), near.join(ids, "unit")


def contamination(docs: DataFrame, items: DataFrame, length: int = 10, slop: int = 20) -> DataFrame:
    """One row per row of ``docs``: doc_id, key, n_words, n_hit, n_items, items_sha256, contaminated, n_near_items.

    ``n_near_items`` counts the items with a proximity match within ``slop``,
    those with a phrase match among them. Null and empty texts have no words and
    no hits. Items with a null id hit words, but are not counted or named. Other
    columns are left out.
    """
    index = build_index(docs)
    phrases, near = search(index, items, length, slop=slop)
    sizes = index.postings.where("at = 0").groupBy("doc_id", "key").agg(F.max("n_words").cast("long").alias("n_words"))
    hits = phrases.select("doc_id", "key", F.explode("positions").alias("position")).distinct().groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("n_hit"))
    ids: Column = F.array_join(F.sort_array(F.collect_set("item")), ",")
    named = phrases.groupBy("doc_id", "key").agg(F.size(F.collect_set("item")).cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"))
    close = near.groupBy("doc_id", "key").agg(F.size(F.collect_set("item")).cast("long").alias("n_near_items"))
    out = index.documents
    for part in (sizes, hits, named, close):
        part = part.withColumnsRenamed({"doc_id": "part_id", "key": "part_key"})
        out = out.join(part, F.col("doc_id").eqNullSafe(F.col("part_id")) & (F.col("key") == F.col("part_key")), "left").drop("part_id", "part_key")
    zero = F.lit(0).cast("long")
    return out.select(
        "doc_id",
        "key",
        F.coalesce("n_words", zero).alias("n_words"),
        F.coalesce("n_hit", zero).alias("n_hit"),
        F.coalesce("n_items", zero).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (F.coalesce("n_hit", zero) > 0).alias("contaminated"),
        F.coalesce("n_near_items", zero).alias("n_near_items"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, length: int = 10) -> DataFrame:
    """The rows of ``docs`` without any occurrence of a window of ``items``, with all their columns."""
    phrases, _ = search(build_index(docs), items, length)
    bad = phrases.select(F.col("doc_id").alias("bad_id"), F.col("key").alias("bad_key"))
    bad = fitting(written(bad.distinct(), "contaminated"))
    return docs.join(bad, docs["doc_id"].eqNullSafe(F.col("bad_id")) & (row_key(text_of()) == F.col("bad_key")), "left_anti")
