"""Line dedup: winnowed fingerprints of line hashes, joined by position, extended both ways word by word.

A text is cut into units: its lines, the sentences of a line, as a passage may be copied into the middle of one, and
long sentences after words that a hash picks, so that text without sentence ends has units too. A unit keeps the
white space after it, so the units of a text put together are the text. Places with equal fingerprints are candidates;
what is deleted was compared word by word with its earlier copy. DataFrame operations only.
"""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.shared import free, let, small_enough, stored

MARK = "\x01"
ENDS = ("\n", ". ", "! ", "? ")
END = r"(?<=\n|[.!?] )"
LONG = 32  # blanks of a sentence that is cut further
ONE_IN = 8  # words of a long sentence, one of which ends a unit
REACH = 2  # units on either side of a common run that are compared word by word
UPPER = 32  # bits of a slot, above which its earlier place is
KEY = ["doc_id", "version"]


def _nothing(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def _upto(size: Column) -> Column:
    """0 to ``size`` - 1."""
    return F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(_nothing("int"))


def _long(unit: Column) -> Column:
    """Whether a unit has ``LONG`` blanks."""
    size = F.octet_length(unit)
    return (size >= 2 * LONG) & (F.octet_length(F.substring_index(unit, " ", LONG)) < size)


def units(text: Column) -> Column:
    """The units of a text."""
    marked = text
    for end in ENDS:
        marked = F.replace(marked, F.lit(end), F.lit(end + MARK))
    parts = F.when(F.contains(text, F.lit(MARK)), F.split(text, END)).otherwise(F.split(marked, MARK))
    return F.flatten(F.transform(parts, lambda u: F.when(_long(u), shorter(u)).otherwise(F.array(u))))


def shorter(unit: Column) -> Column:
    """A long unit cut after each word whose hash is 0 modulo ``ONE_IN``: at the same words wherever it is copied to."""

    def of(words: Column) -> Column:
        inner = F.sequence(F.lit(0), F.size(words) - 3)
        chosen = F.filter(inner, lambda i: (words[i] != "") & (F.pmod(F.xxhash64(words[i]), F.lit(ONE_IN)) == 0))
        return let(F.concat(chosen, F.array(F.size(words) - 1)), lambda ends: F.transform(ends, lambda end, i: piece(words, ends, end, i)))

    def piece(words: Column, ends: Column, end: Column, i: Column) -> Column:
        start = F.when(i == 0, 0).otherwise(F.get(ends, i - 1) + 1)
        joined = F.array_join(F.slice(words, start + 1, end - start + 1), " ")
        return F.when(end < F.size(words) - 1, F.concat(joined, F.lit(" "))).otherwise(joined)

    return let(F.split(unit, " "), of)


def bare(unit: Column) -> Column:
    return F.btrim(unit, F.lit(" \n"))


def words(text: Column) -> Column:
    """The words of a text, which blanks and line feeds separate."""
    return F.array_remove(F.split(F.replace(text, F.lit("\n"), F.lit(" ")), " "), "")


def fingerprints(docs: DataFrame, window: int, long_words: int) -> DataFrame:
    """Selected places: ``gram``, ``KEY``, ``pos`` (first unit), ``size`` (units), ``room``, ``back``.

    A gram is two units in a row. Of each ``window`` grams in a row the one with the least hash is
    selected (all of equal ones), which depends on those grams alone: two copies of a run of
    ``window`` + 1 units have a selected gram in common. A unit of ``long_words`` words or more is
    selected besides, as a gram of its own. ``room`` is the words there and in ``REACH`` units on either side, or a few more; ``back`` the ``pos`` of
    the place before it in the text that has the same gram, if there is one.

    At first a text's units are arrays of numbers: hashes ``h``, words ``n`` (at most), ``grams`` and the ``least`` of each window. Its
    places are then listed by slots, two a unit, for the gram that starts there and for the unit alone; what is done a place is compiled.
    """
    size, n_grams, slot = F.size("h"), F.size("grams"), F.col("slot")

    def pos(slot: Column) -> Column:
        return F.shiftright(slot, 1).cast("int")

    def alone(slot: Column) -> Column:
        return slot.bitwiseAND(F.lit(1)) == 1

    def selected(slot: Column) -> Column:
        least = [F.get("grams", pos(slot)) == F.get("least", pos(slot) - k) for k in range(window)]
        return F.when(alone(slot), F.get("n", pos(slot)) >= long_words).otherwise(reduce(or_, least))

    def gram(slot: Column) -> Column:
        return F.when(alone(slot), F.xxhash64(F.lit(1), F.get("h", pos(slot)))).otherwise(F.get("grams", pos(slot)))

    def with_back() -> Column:
        """The selected slots; those whose gram was there before have the ``back`` (plus one) in the upper half."""

        def named(gram: Column, slot: Column) -> Column:
            return F.struct(gram.alias("gram"), slot.cast("long").alias("slot"))

        def of(p: Column, x: Column, i: Column) -> Column:
            before = F.when(F.get(p, i - 1)["gram"] == x["gram"], F.shiftleft(F.shiftright(F.get(p, i - 1)["slot"], 1) + 1, UPPER))
            return x["slot"] + F.coalesce(before, F.lit(0).cast("long"))

        two = F.transform("grams", lambda g, i: F.when(reduce(or_, [g == F.get("least", i - k) for k in range(window)]), named(g, 2 * i)))
        one = F.transform("n", lambda n, i: F.when(n >= long_words, named(F.xxhash64(F.lit(1), F.get("h", i)), 2 * i + 1)))
        places = F.sort_array(F.concat(F.array_compact(two), F.array_compact(one)))
        return let(places, lambda p: F.transform(p, lambda x, i: of(p, x, i)))

    def twice(hashes: Column) -> Column:
        return F.size(F.array_distinct(hashes)) < F.size(hashes)

    rows = docs.select(*KEY, units(F.col("text")).alias("parts"))
    rows = rows.select(*KEY, "parts", F.transform("parts", lambda u: F.replace(u, F.lit(" "), F.lit(""))).alias("solid"))
    n = F.zip_with("parts", "solid", lambda u, s: F.octet_length(u) - F.octet_length(s) + 1)
    rows = rows.select(*KEY, F.transform("solid", lambda s: F.xxhash64(F.replace(s, F.lit("\n"), F.lit("")))).alias("h"), n.alias("n"))
    pairs = F.zip_with(F.slice("h", 1, size - 1), F.slice("h", 2, size - 1), lambda a, b: F.xxhash64(a, b))
    rows = rows.select(*KEY, "h", "n", pairs.alias("grams"))
    windows = [F.slice("grams", k + 1, n_grams - (window - 1)) for k in range(window)]
    least = F.when(n_grams < window, F.array(F.array_min("grams"))).otherwise(reduce(lambda one, other: F.zip_with(one, other, lambda a, b: F.least(a, b)), windows))
    rows = rows.select(*KEY, "h", "n", "grams", least.alias("least"))
    slots = F.sequence(F.lit(0).cast("long"), 2 * size.cast("long") - 1)
    repeats = twice(F.col("h")) & (twice(F.col("grams")) | twice(F.filter("h", lambda h, i: F.get("n", i) >= long_words)))
    rows = rows.select("*", F.when(repeats, with_back()).otherwise(slots).alias("slots"))
    rows = rows.select(*KEY, "h", "n", "grams", "least", F.explode_outer("slots").alias("at"))
    rows = rows.select("*", F.col("at").bitwiseAND(F.lit((1 << UPPER) - 1)).alias("slot")).where(selected(slot))
    rows = rows.select(*KEY, "n", gram(slot).alias("gram"), pos(slot).alias("pos"), F.when(alone(slot), 1).otherwise(2).alias("size"), (F.shiftright("at", UPPER) - 1).cast("int").alias("back"))
    near = [F.get("n", F.col("pos") + k) for k in range(-REACH, REACH + 1)] + [F.when(F.col("size") == 2, F.get("n", F.col("pos") + REACH + 1))]
    room = reduce(add, [F.coalesce(n, F.lit(0)) for n in near])
    return rows.select(*KEY, "gram", "pos", "size", room.alias("room"), F.when(F.col("back") >= 0, F.col("back")).alias("back"))


def common_runs(docs: DataFrame, window: int, min_words: int, long_words: int) -> DataFrame:
    """``KEY``, ``f_doc``, ``f_version``, ``lag``, ``lo``, ``hi``: units lo to hi - 1 look like those ``lag`` before them in a first copy.

    A place whose gram came before in the same text is one with the place before; of the others, each but the first of its gram
    is joined with the first. Places of one document, one such copy and one lag that touch are a run; one of another copy never adds
    to it. A place has one partner, so a hot line gives a row per place, not per pair, and a line repeated over and over one run. Runs that cannot have ``min_words`` words are left out.
    """
    places = stored(fingerprints(docs, window, long_words), "places")
    at = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "version", "pos")
    once = places.where("back IS NULL")
    first = once.groupBy("gram").agg(F.min(at).alias("first"), F.count("*").alias("n_places")).where("n_places > 1").select("gram", "first")
    first = stored(first, "first")  # so that the join below has two plain sides, and Spark can split a hot gram
    found = once.join(first, "gram")
    later = ~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("version") == F.col("first.version")) & (F.col("pos") == F.col("first.pos")))
    place = F.struct(F.col("pos").alias("lo"), (F.col("pos") + F.col("size")).alias("hi"), "room")
    copy = [F.col("first.doc_id").alias("f_doc"), F.col("first.version").alias("f_version"), (F.col("pos") - F.col("first.pos")).alias("lag")]
    again = [F.col("doc_id").alias("f_doc"), F.col("version").alias("f_version"), (F.col("pos") - F.col("back")).alias("lag")]
    met = found.where(later).select(*KEY, *copy, place.alias("p")).unionByName(places.where("back IS NOT NULL").select(*KEY, *again, place.alias("p")))
    listed = met.groupBy(*KEY, "f_doc", "f_version", "lag").agg(F.sort_array(F.collect_list("p")).alias("p"))

    def runs(p: Column) -> Column:
        def end(i: Column) -> Column:
            """Up to place ``i``; a place is two units long at most, so the one before it may reach further, no other."""
            return F.greatest(F.get(p, i)["hi"], F.get(p, i - 1)["hi"])

        def run(start: Column, j: Column, starts: Column) -> Column:
            last = F.coalesce(F.get(starts, j + 1), F.size(p)) - 1
            own = F.slice(p, start + 1, last - start + 1)
            room = F.aggregate(own, F.lit(0), lambda a, x: a + x["room"])
            return F.struct(p[start]["lo"].alias("lo"), end(last).alias("hi"), room.alias("room"))

        starts = F.filter(_upto(F.size(p)), lambda i: (i == 0) | (p[i]["lo"] > end(i - 1)))
        return let(starts, lambda s: F.transform(s, lambda start, j: run(start, j, s)))

    found = listed.select(*KEY, "f_doc", "f_version", "lag", F.inline(let(F.col("p"), runs)))
    return stored(found.where(F.col("room") >= min_words).drop("room"), "runs")


def _named(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of the documents that ``keys`` names."""
    wanted = small_enough(stored(keys.distinct().toDF("k_doc", "k_version"), "keys"))
    return docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["k_doc"]) & (docs["version"] == wanted["k_version"]), "left_semi")


def _equal(one: Column, other: Column) -> Column:
    """How many of the first words of two lists agree."""
    same = F.zip_with(one, other, lambda a, b: a.eqNullSafe(b))
    return let(same, lambda s: let(F.array_position(s, False), lambda off: F.when(off == 0, F.size(s)).otherwise(off - 1).cast("int")))


def _around(parts: Column, lo: Column, hi: Column) -> Column:
    """The text of units ``lo`` to ``hi`` - 1, and of the ``REACH`` units on either side, as far as there are any."""
    start = F.greatest(lo - REACH, F.lit(0))
    texts = {"before": F.slice(parts, start + 1, lo - start), "core": F.slice(parts, lo + 1, hi - lo), "after": F.slice(parts, hi + 1, F.lit(REACH))}
    return F.struct(*[F.array_join(own, "").alias(name) for name, own in texts.items()])


def repeated_ranges(docs: DataFrame, window: int, min_words: int, long_words: int) -> DataFrame:
    """``KEY`` and ``ranges``: what of a document occurs earlier in ``min_words`` words or more in a row, as places of words.

    A range goes from ``start`` (a unit, and a word in it) up to ``end``. The runs that look alike are compared with their
    first copy word by word, outwards from the first unit, ``REACH`` units beyond the run; compared runs of one copy and
    one lag are one where they touch, and those with enough words count, whatever the copy.
    """
    runs = common_runs(docs, window, min_words, long_words)
    lo, hi = F.col("lo") - F.col("lag"), F.col("hi") - F.col("lag")
    copies = _named(docs, runs.select("f_doc", "f_version")).groupBy(*KEY).agg(F.min("text").alias("text"))
    copies = copies.select(F.col("doc_id").alias("c_doc"), F.col("version").alias("c_version"), units(F.col("text")).alias("c_units"))
    met = runs.join(copies, F.col("f_doc").eqNullSafe(F.col("c_doc")) & (F.col("f_version") == F.col("c_version")))
    run = F.struct("f_doc", "f_version", "lag", "lo", "hi", _around(F.col("c_units"), lo, hi).alias("copy"))
    listed = met.select(*KEY, run.alias("run")).groupBy(*KEY).agg(F.collect_list("run").alias("runs"))
    listed = stored(listed.select(F.col("doc_id").alias("r_doc"), F.col("version").alias("r_version"), "runs"), "compared")
    # Texts are cut after the shuffle, which takes each once, and repeated rows are compared each for itself.
    texts = _named(docs, runs.select(*KEY)).select(*KEY, "text")
    found = texts.join(listed, F.col("doc_id").eqNullSafe(F.col("r_doc")) & (F.col("version") == F.col("r_version")))

    def point(unit: Column, word: Column) -> Column:
        return F.struct(unit.cast("int").alias("unit"), word.cast("int").alias("word"))

    def compared(parts: Column, run: Column) -> Column:
        def size(i: Column) -> Column:
            return F.when(i >= 0, F.size(words(F.coalesce(F.get(parts, i), F.lit(""))))).otherwise(0)

        def start(left: Column) -> Column:
            def back(near: Column) -> Column:
                far = point(run["lo"] - 2, size(run["lo"] - 2) - (left - near))
                return F.when(left <= near, point(run["lo"] - 1, near - left)).otherwise(far)

            return F.when(left == 0, point(run["lo"], F.lit(0))).otherwise(let(size(run["lo"] - 1), back))

        def end(since: Column, right: Column) -> Column:
            """The place ``right`` words after the start of unit ``since``."""

            def step(at: Column, unit: Column) -> Column:
                n = F.when(at["stop"], 0).otherwise(F.size(words(unit)))
                return let(n, lambda n: let(~at["stop"] & (at["word"] > 0) & (at["word"] >= n), lambda on: moved(at, n, on)))

            def moved(at: Column, n: Column, on: Column) -> Column:
                return F.struct((at["unit"] + on.cast("int")).alias("unit"), (at["word"] - F.when(on, n).otherwise(0)).alias("word"), (~on).alias("stop"))

            first = F.struct(since.alias("unit"), right.alias("word"), F.lit(False).alias("stop"))
            beyond = F.slice(parts, since + 1, run["hi"] + REACH - since)
            return F.aggregate(beyond, first, step, lambda at: point(at["unit"], at["word"]))

        def agree(own: Column) -> Column:
            copy = run["copy"]
            left = _equal(F.reverse(words(own["before"])), F.reverse(words(copy["before"])))
            # Mostly the units are equal as they are, and only the words after them need to be looked at.
            after = let(_equal(words(own["after"]), words(copy["after"])), lambda n: end(run["hi"], n))
            whole = [F.concat(x["core"], x["after"]) for x in (own, copy)]
            word_by_word = let(_equal(words(whole[0]), words(whole[1])), lambda n: end(run["lo"], n))
            return F.struct(let(left, start).alias("start"), F.when(own["core"] == copy["core"], after).otherwise(word_by_word).alias("end"))

        name = F.struct(run["f_doc"].alias("f_doc"), run["f_version"].alias("f_version"), run["lag"].alias("lag"))
        both = let(_around(parts, run["lo"], run["hi"]), agree)
        return let(both, lambda r: F.struct(name.alias("copy"), r["start"].alias("start"), r["end"].alias("end")))

    def united(ranges: Column, alike) -> Column:
        """Sorted ranges with those that touch, and are ``alike``, put together."""

        def joined(done: Column, new: Column) -> Column:
            last = F.element_at(done, -1)
            longer = F.struct(last["copy"].alias("copy"), last["start"].alias("start"), F.greatest(last["end"], new["end"]).alias("end"))
            touch = (F.size(done) > 0) & alike(last, new) & (new["start"] <= last["end"])
            return F.when(touch, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(F.concat(done, F.array(new)))

        return let(ranges, lambda r: F.aggregate(F.slice(r, 2, F.size(r)), F.slice(r, 1, 1), joined))

    def long_enough(text: Column) -> Column:
        """Whether a text has ``min_words`` words; most show it in their first characters, of which the last word may be cut."""
        return (F.size(words(F.substring(text, F.lit(1), F.lit(10 * min_words)))) > min_words) | (F.size(words(text)) >= min_words)

    def ranges(parts: Column, runs: Column) -> Column:
        one = united(F.sort_array(F.transform(runs, lambda run: compared(parts, run))), lambda a, b: a["copy"] == b["copy"])
        enough = F.filter(one, lambda r: let(between(parts, r["start"], r["end"]), long_enough))
        plain = F.transform(enough, lambda r: F.struct(F.lit(0).alias("copy"), r["start"].alias("start"), r["end"].alias("end")))
        return F.transform(united(F.sort_array(plain), lambda a, b: F.lit(True)), lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end")))

    found = found.select(*KEY, let(units(F.col("text")), lambda parts: ranges(parts, F.col("runs"))).alias("ranges"))
    return found.dropDuplicates(KEY).where(F.size("ranges") > 0)


def _tokens(unit: Column) -> Column:
    """Words with the white space after them; the first also has what stands before it."""
    return F.split(unit, r"(?<=\S[ \n]{1,9})(?=[^ \n])|(?<=[ \n]{10})(?=[^ \n])")


def between(parts: Column, a: Column, b: Column) -> Column:
    """The text from one place, a unit and a word in it, to another."""

    def head(at: Column) -> Column:
        """A unit's text up to a word; nothing if there is no such unit."""
        return F.when(at["word"] == 0, F.lit("")).otherwise(F.array_join(F.slice(_tokens(F.get(parts, at["unit"])), 1, at["word"]), ""))

    def tail(at: Column) -> Column:
        unit = F.coalesce(F.get(parts, at["unit"]), F.lit(""))
        return F.when(at["word"] == 0, unit).otherwise(let(_tokens(unit), lambda t: F.array_join(F.slice(t, at["word"] + 1, F.size(t)), "")))

    within = let(_tokens(F.get(parts, a["unit"])), lambda t: F.array_join(F.slice(t, a["word"] + 1, b["word"] - a["word"]), ""))
    inner = F.array_join(F.slice(parts, a["unit"] + 2, F.greatest(b["unit"] - a["unit"] - 1, F.lit(0))), "")
    return F.when(a == b, F.lit("")).when(a["unit"] == b["unit"], within).otherwise(F.concat(tail(a), inner, head(b)))


def edited(parts: Column, ranges: Column) -> Column:
    """``text`` without the ranges, and the texts of the ``deleted`` ones."""

    def place(unit: Column) -> Column:
        return F.struct(unit.alias("unit"), F.lit(0).alias("word"))

    def gap(i: Column) -> Column:
        """What is left before range ``i``, or after the last one."""
        start = F.when(i == 0, place(F.lit(0))).otherwise(F.get(ranges, i - 1)["end"])
        return between(parts, start, F.coalesce(F.get(ranges, i)["start"], place(F.size(parts))))

    left = F.transform(F.sequence(F.lit(0), F.size(ranges)), gap)
    return F.struct(F.array_join(left, "").alias("text"), F.transform(ranges, lambda r: between(parts, r["start"], r["end"])).alias("deleted"))


def dedup_lines(docs: DataFrame, window: int = 2, min_words: int = 25, long_words: int = 16, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with later repeated runs deleted from ``text``, and ``n_deleted`` (words) and ``deleted`` (texts, in order).

    A run is a sequence of words, which blanks and line feeds separate, that occurs in the same order at an earlier place,
    whatever the white space; "earlier" goes by id, then by place in the text, so the first copy stays, also within one
    document. Runs of fewer than ``min_words`` words stay as they are: a common header is no repeated passage. Ranges of several
    copies that overlap are deleted together, but each is long enough for itself.

    A copy with ``window`` + 1 whole units in it, or with a unit of ``long_words`` words, is sure to be found at the earliest place
    of one of these, and goes there from its first word to its last, up to ``REACH`` units beyond the units found. Where a part
    of a run has an earlier copy elsewhere, that part is compared there.

    Documents are never dropped: a document that is a copy throughout ends with an empty text. A NULL or
    empty text stays, without deletions. NULL ids come last in order. Repeated rows (the same id and text)
    count as one document and get the same result; rows with one id and different texts are ordered by a
    hash of the text. An empty table gives no rows. Other columns stay; those named as the result's are replaced.
    """
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")).withColumn("version", F.hash("text"))
    found = repeated_ranges(rows.where("text IS NOT NULL"), window, min_words, long_words)
    _id, _version, _ranges = free(docs, "id"), free(docs, "version"), free(docs, "ranges")
    found = small_enough(stored(found.toDF(_id, _version, _ranges), "ranges"), *[_ranges] * 4)  # four numbers a range
    keyed = docs.withColumns({_version: F.hash(text)})
    both = keyed.join(found, keyed[id].eqNullSafe(found[_id]) & (keyed[_version] == found[_version]), "left")
    both = both.select(*[keyed[f"`{c}`"] for c in docs.columns], found[_ranges])

    _edit = free(docs, "edit")
    untouched = F.struct(F.col(text).alias("text"), _nothing("string").alias("deleted"))
    edit = F.when(F.col(_ranges).isNull(), untouched).otherwise(let(units(F.col(text)), lambda parts: edited(parts, F.col(_ranges))))
    n_deleted = F.aggregate(F.col(_edit)["deleted"], F.lit(0), lambda a, t: a + F.size(words(t)))
    out = both.withColumn(_edit, edit).withColumns({"n_deleted": n_deleted, "deleted": F.col(_edit)["deleted"], text: F.col(_edit)["text"]})
    return out.drop(_ranges, _edit)
