"""Document fingerprints that add up: wide vectors hashed from paragraphs, summed modulo powers of two.

A paragraph is a line of a text. Its vector has three parts: lanes of seeded hashes of the whole paragraph, which
tell texts apart; for each bit of a hash how many of its runs of three words have that bit set; and the number of
those runs. A text's vector is the sum of its paragraphs' vectors, each lane modulo 2 ** 32: whatever
their order, equal paragraphs give equal vectors, and a paragraph is inserted or deleted by adding or subtracting
its vector. Over random signs, the second part's inner products estimate how many word runs two
texts share. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayside.llm.shared import let, small_enough, stored

SEEDS = 8  # hashes of a paragraph; each fills two lanes
SIGNS = 64  # lanes for word runs, one for each bit of a hash
RUN = 3  # words of a run
MODULUS = 1 << 32
LANES = 2 * SEEDS + SIGNS + 1
#: Eight counters of a byte in a long: up to so many hashes can be counted without one running over.
PACKED, FULL = 0x0101010101010101, 127


def _range(size: Column) -> Column:
    """0 to ``size`` - 1; ``size`` is one at least."""
    return F.sequence(F.lit(0), size - 1)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def paragraphs(text: Column) -> Column:
    """The lines of a text; an empty text has one, which is empty."""
    return F.split(text, "\n")


def run_hashes(lines: Column) -> Column:
    """A hash for each ``RUN`` words in a row within a line, or for the whole of a shorter one."""

    def of(words: Column) -> Column:
        starts = _range(F.greatest(F.size(words) - (RUN - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(RUN)]))

    return F.flatten(F.transform(lines, lambda line: let(F.split(line, " "), of)))


def bit_counts(hashes: Column) -> Column:
    """For each of the ``SIGNS`` bits how many hashes have it set: counted eight at once, ``FULL`` hashes at a time."""

    def packed(part: Column) -> Column:
        one = F.lit(PACKED).cast("long")

        def eighth(bit: int) -> Column:
            return F.aggregate(part, F.lit(0).cast("long"), lambda a, h: a + F.shiftrightunsigned(h, bit).bitwiseAND(one))

        return F.array(*[eighth(bit) for bit in range(8)])

    def unpacked(parts: Column) -> Column:
        def one(bit: Column) -> Column:
            lane = F.transform(parts, lambda p: F.call_function("shiftrightunsigned", p[bit % 8], bit - bit % 8).bitwiseAND(F.lit(255).cast("long")))
            return _total(lane)

        return F.transform(_range(F.lit(SIGNS)), one)

    pieces = _range(F.ceil(F.size(hashes) / FULL).cast("int"))
    return let(F.transform(pieces, lambda i: packed(F.slice(hashes, i * FULL + 1, FULL))), unpacked)


def whole_hashes(lines: Column) -> Column:
    """Sums over the lines of ``SEEDS`` hashes, two lanes each."""
    low = F.lit(MODULUS - 1).cast("long")

    def halves(hashes: Column) -> Column:
        return F.array(_total(F.transform(hashes, lambda h: h.bitwiseAND(low))), _total(F.transform(hashes, lambda h: F.shiftrightunsigned(h, 32))))

    def seeded(seed: Column) -> Column:
        return let(F.transform(lines, lambda line: F.xxhash64(seed, line)), halves)

    return F.flatten(F.transform(_range(F.lit(SEEDS)), seeded))


def _modulo(lanes: Column) -> Column:
    return F.transform(lanes, lambda x: F.pmod(x, F.lit(MODULUS).cast("long")))


def vector(lines: Column) -> Column:
    """The sum of the vectors of an array of paragraphs: ``LANES`` numbers; zeros if there is none."""

    def of(lines: Column) -> Column:
        runs = let(run_hashes(lines), lambda hashes: F.concat(bit_counts(hashes), F.array(F.size(hashes).cast("long"))))
        none = F.array_repeat(F.lit(0).cast("long"), LANES)
        return F.when(F.size(lines) > 0, _modulo(F.concat(whole_hashes(lines), runs))).otherwise(none)

    return let(lines, of)


def added(one: Column, other: Column) -> Column:
    """The vector of the paragraphs of both."""
    return _modulo(F.zip_with(one, other, lambda a, b: a.cast("long") + b))


def removed(whole: Column, part: Column) -> Column:
    """The vector of the paragraphs of ``whole`` without those of ``part``."""
    return _modulo(F.zip_with(whole, part, lambda a, b: a.cast("long") - b))


def shown(vector: Column) -> Column:
    """A vector as text, eight hexadecimal digits a lane."""
    return F.lower(F.array_join(F.transform(vector, lambda x: F.lpad(F.hex(x), 8, "0")), ""))


def signs(vector: Column) -> Column:
    """The lanes of word runs as sums of random signs: those with a bit set less those without."""
    return let(vector, lambda v: F.transform(F.slice(v, 2 * SEEDS + 1, SIGNS), lambda c: (2 * c - v[LANES - 1]).cast("double")))


def likeness(one: Column, other: Column) -> Column:
    """Twice the word runs that two texts share over the runs of both, estimated from their ``signs``; 0 to 1."""

    def product(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    size = product(one, one) + product(other, other)
    return F.when(size == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2 * product(one, other) / size)))


KEY = ["row", "check"]


def followers(keys: DataFrame) -> DataFrame:
    """``KEY`` and the key before it in ascending order (``asker``, ``asker_check``), with its ``asker_chars``; the first follows the last.

    ``keys`` (``KEY``, ``place``, ``n_chars``; places differ) are dealt to parts by range of their places; within a part a window
    finds what comes next, and the last one of a part is followed by the first of the next part, of which there are as
    many as parts.
    """
    dealt = stored(keys.repartitionByRange("place").withColumn("part", F.spark_partition_id()), "keys")
    key = F.struct(*KEY)
    firsts = dealt.groupBy("part").agg(F.min(F.struct("place", key.alias("key"))).alias("first"))
    overall = F.min("first").over(Window.partitionBy())
    beyond = F.coalesce(F.lead("first").over(Window.orderBy("part")), overall)
    firsts = stored(firsts.select("part", beyond["key"].alias("beyond")), "parts")
    within = dealt.withColumn("next", F.lead(key).over(Window.partitionBy("part").orderBy("place")))
    found = within.join(small_enough(firsts), "part").withColumn("next", F.coalesce("next", "beyond"))
    return found.select(*[F.col(f"next.{c}").alias(c) for c in KEY], F.col("row").alias("asker"), F.col("check").alias("asker_check"), F.col("n_chars").alias("asker_chars"))


def with_parts(text: Column, edit_share: int) -> Column:
    """The vectors of the paragraphs that an edit of the last characters leaves (``before``) and of the others (``gone``), as integers.

    ``rest`` is what the cut leaves of the paragraph that it falls into.
    """

    def of(text: Column) -> Column:
        kept = F.substring(text, F.lit(1), cut(F.char_length(text), edit_share))
        return let(F.struct(kept.alias("kept"), F.substring_index(kept, "\n", -1).alias("rest")), lambda x: parts(text, x["kept"], x["rest"]))

    def parts(text: Column, kept: Column, rest: Column) -> Column:
        stays = F.char_length(kept) - F.char_length(rest)
        before = F.when(stays > 0, paragraphs(F.substring(text, F.lit(1), stays - 1))).otherwise(F.array().cast("array<string>"))
        gone = paragraphs(F.substring(text, stays + 1, F.char_length(text)))
        return F.struct(narrow(vector(before)).alias("before"), narrow(vector(gone)).alias("gone"))

    return let(text, of)


def cut(n_chars: Column, edit_share: int) -> Column:
    """How many characters an edit leaves."""
    return n_chars - F.floor(n_chars / edit_share).cast("int")


def narrow(vector: Column) -> Column:
    """The lanes as signed integers of 32 bits, half as wide; ``added`` takes them as they are."""
    return F.transform(vector, lambda x: F.when(x >= MODULUS // 2, x - MODULUS).otherwise(x).cast("int"))


def fingerprints(docs: DataFrame, edit_share: int = 4, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_chars``, ``vector``, ``edited``, ``edited_vector``, ``near_edited``, ``near_next``.

    ``edited`` is the text with its last ``n_chars`` / ``edit_share`` characters (rounded down) replaced by the first as
    many, or all, of the next document. ``edited_vector`` follows from the text's own: the paragraphs from the cut on
    are deleted, those that take their place inserted. ``near_edited`` and ``near_next`` are the ``likeness`` of the
    text's vector to that of the edited text and of the next document.

    The next document is the one with the next larger id, after the last the first; of documents with one id the one with the
    next larger hash of its text. A NULL id comes last. Repeated rows, those of one id and text, are one place in that
    order and agree; a document alone is its own next one. A NULL text counts as empty; an empty text is one
    empty paragraph. Long texts are taken whole. An empty table gives no rows; other columns are not looked at.
    Ids must be of a type that can be ordered.

    Texts are shuffled once, by row key, with the vectors of their parts and with copies of a row put together before; only
    the beginnings of documents go on to the documents before them.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.xxhash64(id, content).alias("row"), F.hash(id, content).alias("check"), F.col(id).alias("doc_id"), content.alias("text"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64("text").alias("version"), *KEY)
    keys = rows.select(*KEY, place.alias("place"), F.char_length("text").alias("n_chars"))
    keys = stored(keys.groupBy(*KEY).agg(F.min("place").alias("place"), F.max("n_chars").alias("n_chars"), F.count("*").alias("copies")), "documents")
    whole = F.struct("text", "doc_id", with_parts(F.col("text"), edit_share).alias("parts"))
    single = rows.select(*KEY, whole.alias("whole")).groupBy(*KEY).agg(F.min("whole").alias("whole"))
    single = single.select(*KEY, "whole.text", "whole.doc_id", F.col("whole.parts.before").alias("before"), F.col("whole.parts.gone").alias("gone"))

    asked = single.join(followers(keys.drop("copies")), KEY)
    taken = F.floor(F.col("asker_chars") / edit_share).cast("int")
    heads = asked.select("asker", "asker_check", F.substring("text", F.lit(1), taken).alias("head"), signs(added(F.col("before"), F.col("gone"))).alias("next_signs"))
    found = single.join(heads, (F.col("row") == F.col("asker")) & (F.col("check") == F.col("asker_check")))
    found = found.withColumn("kept", F.substring("text", F.lit(1), cut(F.char_length("text"), edit_share)))
    come = vector(paragraphs(F.concat(F.substring_index("kept", "\n", -1), "head")))
    found = found.select(
        *KEY, "doc_id", F.char_length("text").cast("long").alias("n_chars"), "next_signs", F.concat("kept", "head").alias("edited"),
        added(F.col("before"), F.col("gone")).alias("vector"), "gone", come.alias("come"),
    )
    found = found.withColumn("edited_vector", added(removed(F.col("vector"), F.col("gone")), F.col("come")))
    near = let(signs(F.col("vector")), lambda own: F.struct(likeness(own, signs(F.col("edited_vector"))).alias("edited"), likeness(own, F.col("next_signs")).alias("next")))
    out = found.withColumn("near", near)
    out = out.select(*KEY, "doc_id", "n_chars", "vector", "edited", "edited_vector", F.col("near.edited").alias("near_edited"), F.col("near.next").alias("near_next"))
    if (keys.agg(F.max("copies")).first()[0] or 1) > 1:
        out = rows.select(*KEY).join(out, KEY)  # a hot row on the side that Spark splits
    return out.drop(*KEY)
