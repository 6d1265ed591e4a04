"""Benchmark decontamination by a distributed positional inverted index.

The index has the places of test terms in the training texts: the rarest two of each benchmark window,
by their count in the corpus. Lists are shifted by the term's place in the item, so places of one copy
agree; where both lists of a window meet, the rest of the window is compared word by word.
DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayside.llm.shared import ascii_lower, free, small_enough, stored

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text: runs of letters a to z (A to Z lower-cased), digits and characters beyond ASCII."""
    return F.array_remove(F.split(ascii_lower(text), SEPARATORS), "")


def count_words(text: Column) -> Column:
    """How many ``words`` a text has, zero if it is NULL; it need not be lower-cased for that."""
    return F.coalesce(F.size(F.array_remove(F.split(text, ANY_CASE_SEPARATORS), "")), F.lit(0))


KEY = ["version", "check"]


def version(text: str) -> list[Column]:
    """The columns ``KEY``: two hashes that name a text. Results follow from the text alone, so copies share them."""
    return [F.xxhash64(text).alias("version"), F.hash(text).alias("check")]


def test_windows(benchmark: DataFrame, window: int, id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Items (``item``, ``item_id``, ``words``), and the places of their words in windows (``item``, ``start``, ``size``, ``at``, ``term``)."""
    items = benchmark.select(F.xxhash64(id, text).alias("item"), F.col(id).alias("item_id"), words(F.col(text)).alias("words"))
    items = stored(items.where(F.size("words") > 0).dropDuplicates(["item"]), "items")
    size = F.least(F.size("words"), F.lit(window))
    starts = items.select("item", "words", size.alias("size"), F.explode(F.sequence(F.lit(0), F.size("words") - size)).alias("start"))
    places = starts.select("item", "start", "size", F.posexplode(F.slice("words", F.col("start") + 1, F.col("size"))).alias("at", "word"))
    return items, places.select("item", "start", "size", (F.col("start") + F.col("at")).alias("at"), F.xxhash64("word").alias("term"))


def corpus_terms(docs: DataFrame) -> DataFrame:
    """Each word of each text: ``KEY``, ``pos``, ``term`` (its hash)."""
    return docs.select(*KEY, F.posexplode(words(F.col("text"))).alias("pos", "word")).select(*KEY, "pos", F.xxhash64("word").alias("term"))


def rarest(docs: DataFrame, places: DataFrame, lists: int) -> DataFrame:
    """Of each window the ``lists`` places whose terms are the rarest in the corpus: ``item``, ``start``, ``size``, ``at``, ``term``."""
    wanted = stored(places.select("term").distinct(), "terms")
    counts = corpus_terms(docs).join(small_enough(wanted), "term").groupBy("term").agg(F.count("*").alias("n"))
    # A plain side: if the counts are many, Spark can split the places of a hot term.
    ranked = places.join(small_enough(stored(counts, "counts")), "term", "left").fillna(0, ["n"])
    # An item's window has a handful of words, so each group is small.
    rank = F.row_number().over(Window.partitionBy("item", "start").orderBy("n", "term", "at"))
    return ranked.withColumn("rank", rank).where(F.col("rank") <= lists).drop("rank", "n")


def aligned(docs: DataFrame, seeds: DataFrame) -> DataFrame:
    """Where indexed terms meet items: ``KEY``, ``item``, ``shift`` (place in the text less place in the item), ``ats``.

    ``ats`` are the places in the item that a posting of the document has at this shift. This table is
    the intersection of the shifted lists of an item. A hot term has a row per posting and place.
    """
    terms = stored(seeds.select("term").distinct(), "seed-terms")
    postings = corpus_terms(docs).join(small_enough(terms), "term")
    spots = small_enough(stored(seeds.select("term", "item", "at").distinct(), "spots"))
    hits = postings.join(spots, "term").select(*KEY, "item", (F.col("pos") - F.col("at")).alias("shift"), "at")
    return stored(hits.groupBy(*KEY, "item", "shift").agg(F.collect_set("at").alias("ats")), "aligned")


def phrases(docs: DataFrame, items: DataFrame, seeds: DataFrame, lists: DataFrame) -> DataFrame:
    """Exact occurrences of windows: ``KEY``, ``item``, ``pos`` (first word in the text) and ``size``."""
    windows = seeds.groupBy("item", "start", "size").agg(F.collect_set("at").alias("need"))
    # Whole windows that all their lists agree on, per alignment.
    per_item = windows.groupBy("item").agg(F.collect_list(F.struct("start", "size", "need")).alias("windows"))
    per_item = small_enough(stored(per_item, "windows"), "windows")  # a plain side, so that Spark can split a hot item
    whole = F.transform(F.filter("windows", lambda w: F.size(F.array_except(w["need"], F.col("ats"))) == 0), lambda w: w.dropFields("need"))
    found = lists.join(per_item, "item").select(*KEY, "item", "shift", whole.alias("windows")).where(F.size("windows") > 0)
    found = stored(found, "candidates")
    suspects = stored(found.select(*KEY).distinct(), "suspects")
    texts = docs.join(small_enough(suspects), KEY, "left_semi").select(*KEY, words(F.col("text")).alias("its")).dropDuplicates(KEY)
    both = found.join(texts, KEY).join(items.select("item", "words"), "item")

    def same(w: Column) -> Column:
        here = F.col("shift") + w["start"]
        return (here >= 0) & (F.slice("its", F.greatest(here, F.lit(0)) + 1, w["size"]) == F.slice("words", w["start"] + 1, w["size"]))

    hits = both.select(*KEY, "item", "shift", F.explode(F.filter("windows", same)).alias("w"))
    return hits.select(*KEY, "item", (F.col("shift") + F.col("w.start")).alias("pos"), F.col("w.size").alias("size"))


def near_items(lists: DataFrame, seeds: DataFrame, slop: int, near_share: float, near_terms: int) -> DataFrame:
    """Proximity matches: ``KEY`` and ``item`` where enough rare places of the item lie in the text in about their order
    and distance: their shifts fall into one band of ``slop`` + 1, with bands at two offsets. Enough is ``near_share`` of
    the item's indexed places, two at least and ``near_terms`` at most, each by a word of its own in the text."""
    enough = F.greatest(F.lit(2), F.least(F.lit(near_terms), F.ceil(F.count_distinct("at") * near_share)))
    needed = small_enough(stored(seeds.groupBy("item").agg(enough.alias("needed")), "needed"))
    band = F.explode(F.array(F.floor(F.col("shift") / (2 * slop + 2)) * 2, F.floor((F.col("shift") + slop + 1) / (2 * slop + 2)) * 2 + 1))
    banded = lists.select(*KEY, "item", "shift", "ats", band.alias("band"))
    spread = banded.select(*KEY, "item", "band", "shift", F.explode("ats").alias("at")).withColumn("pos", F.col("shift") + F.col("at"))
    met = spread.groupBy(*KEY, "item", "band").agg(F.size(F.collect_set("at")).alias("n"), F.size(F.collect_set("pos")).alias("n_pos"))
    met = met.where("n >= 2 AND n_pos >= 2").join(needed, "item")
    return met.where(F.least("n", "n_pos") >= F.col("needed")).select(*KEY, "item").distinct()


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = 13, one_in: int = 20, lists: int = 2, slop: int = 4,
    near_terms: int = 6, text: str = "text", item_id: str = "item_id", item_text: str = "text", near_share: float = 0.5,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``n_items``, ``items``, ``near`` and ``contaminated``.

    A window is ``window`` words of an item in a row; an item with fewer words is one window, one without
    words none. A word of a document is hit if it lies in an occurrence of a window. ``items`` are the
    different ids, as text and sorted, of the items with an occurring window, ``n_items`` their number.
    ``near`` are likewise the items of which enough rare words occur about as far apart as in the item (within
    ``slop`` words), though no window occurs: ``near_share`` of the item's indexed places, two at least and
    ``near_terms`` at most. An item of one word has no such match. A document is contaminated if a word
    is hit and one in ``one_in`` of its words or more are.

    Everything depends on the text alone, so repeated rows agree, whatever their id. A NULL or empty text
    has no words. An item without id hits words but is not listed; repeated items count once. Empty tables:
    no documents, no rows; no items, no hits. Other columns stay; those named as the result's are replaced.
    The benchmark may grow: it is broadcast only if small enough, and a hot word meets it in a join
    whose large side Spark splits.
    """
    rows = docs.where(F.col(text).isNotNull()).select(*version(text), F.col(text).alias("text"))
    items, places = test_windows(benchmark, window, item_id, item_text)
    seeds = stored(rarest(rows, places, lists), "seeds")
    meeting = aligned(rows, seeds)
    exact = stored(phrases(rows, items, seeds, meeting), "phrases")
    spans = exact.select(*KEY, "pos", "size").distinct().groupBy(*KEY).agg(F.collect_list(F.sequence(F.col("pos"), F.col("pos") + F.col("size") - 1)).alias("spans"))
    hit = spans.select(*KEY, F.size(F.array_distinct(F.flatten("spans"))).cast("long").alias("n_hit"))
    names = items.select("item", F.col("item_id").cast("string").alias("name"))

    def listed(matches: DataFrame, to: str) -> DataFrame:
        found = matches.select(*KEY, "item").distinct().join(names, "item")
        return found.groupBy(*KEY).agg(F.array_sort(F.collect_set("name")).alias(to))

    apart = near_items(meeting, seeds, slop, near_share, near_terms).join(exact.select(*KEY, "item").distinct(), [*KEY, "item"], "left_anti")
    facts = hit.join(listed(exact, "items"), KEY, "left").join(listed(apart, "near"), KEY, "full")
    mine = {c: free(docs, c) for c in (*KEY, "n_hit", "items", "near")}
    facts = stored(facts.select(*[F.col(c).alias(name) for c, name in mine.items()]), "facts")
    named = {c: free(docs, f"its_{c}") for c in KEY}
    counted = docs.withColumns({"n_words": count_words(F.col(text)).cast("long"), named["version"]: F.xxhash64(text), named["check"]: F.hash(text)})
    # Columns, not expressions: else a shuffle for this join would carry the texts along.
    on = (F.col(named["version"]) == F.col(mine["version"])) & (F.col(named["check"]) == F.col(mine["check"]))
    facts = small_enough(facts, mine["items"], mine["near"])
    joined = counted.join(facts, on, "left")
    none = F.array().cast("array<string>")
    out = joined.withColumns({
        "n_hit": F.coalesce(mine["n_hit"], F.lit(0).cast("long")),
        "items": F.coalesce(mine["items"], none),
        "near": F.coalesce(mine["near"], none),
    })
    out = out.drop(*named.values(), *(name for c, name in mine.items() if name not in ("n_hit", "items", "near")))
    bad = (F.col("n_hit") > 0) & (F.col("n_hit") * one_in >= F.col("n_words"))
    return out.withColumns({"n_items": F.size("items").cast("long"), "contaminated": bad})
