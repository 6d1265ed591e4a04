"""SimHash near-duplicates by a self-join of a binary trie of fingerprints."""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.components import components
from quayside.llm.shared import ASCII_LOWER, free, row_hash, small_enough, stored

SEED = 42
PIECE = 16384  # shingles whose bits are counted at a time
CHUNK = 16  # trie levels that one round of the traversal goes down
HALF = 32


def simhash(text: bytes | None, size: int) -> int:
    """The 64-bit fingerprint as a signed number; zero for a text without words.

    Words are separated by ASCII white space, lower-cased from A to Z; a shingle is ``size`` words
    joined by spaces (all words if there are fewer), counted as often as it occurs, hashed by XXH64.
    A bit is set if it is set in over half of the hashes.
    """
    words = (text or b"").translate(ASCII_LOWER).split()
    if not words:
        return 0
    size = min(size, len(words))
    line = b" ".join(words)
    ends = list(accumulate(len(word) + 1 for word in words))
    starts = [0, *ends]
    count = len(words) - size + 1
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, count, PIECE):
        to = min(count, at + PIECE)
        digests = [xxhash.xxh64_intdigest(line[a : b - 1], SEED) for a, b in zip(starts[at:to], ends[at + size - 1 : to + size - 1])]
        bits = np.unpackbits(np.array(digests, dtype=">u8").view(np.uint8)).reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big", signed=True)


def fingerprint(text: str, size: int) -> Column:
    """The fingerprint of a text column, as bigint. NULL counts as a text without words."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(bytes(x) if x is not None else None, size) for x in texts], dtype="int64")

    return of(F.col(text).cast("binary"))


def node(leaf: Column, depth: int) -> Column:
    return F.shiftrightunsigned(leaf, 64 - depth)


def traverse(leaves: DataFrame, bits: int) -> DataFrame:
    """Pairs ``a``, ``b`` of leaves that differ in ``bits`` bits at most, ``bits // 2`` of them in the first half.

    Goes down the trie by pairs of nodes of one depth, each pair once, with the number of bits its
    paths differ in. A pair's children are reached from the child of the one node and the bits that
    may still differ, and stay if the other node has that child. Thus no pair beyond the budget is made.
    """
    budget = bits // 2
    flips = F.array(*[F.lit(sum(1 << i for i in chosen)).cast("long") for n in range(budget + 1) for chosen in combinations(range(CHUNK), n)])
    pairs = None
    for depth in range(CHUNK, HALF + 1, CHUNK):
        nodes = leaves.select(node(F.col("leaf"), depth).alias("x")).distinct()
        parent = F.shiftrightunsigned("x", CHUNK)
        if pairs is None:
            children = nodes.select("x", F.lit(0).cast("long").alias("b"), F.lit(0).alias("diff"))
        else:
            children = pairs.join(nodes.withColumn("a", parent), "a").select("x", "b", "diff")
        flipped = children.withColumn("flip", F.explode(F.filter(flips, lambda m: F.bit_count(m) <= budget - F.col("diff"))))
        sides = flipped.select(
            F.col("x").alias("a"),
            F.shiftleft("b", CHUNK).bitwiseOR(F.col("x").bitwiseAND((1 << CHUNK) - 1).bitwiseXOR(F.col("flip"))).alias("b"),
            (F.col("diff") + F.bit_count("flip")).alias("diff"),
        ).where("a <= b")
        pairs = sides.join(nodes.select(F.col("x").alias("b")), "b").select("a", "b", "diff")
    left = leaves.select(node(F.col("leaf"), HALF).alias("a"), F.col("leaf").alias("one"))
    right = leaves.select(node(F.col("leaf"), HALF).alias("b"), F.col("leaf").alias("other"))
    differ = F.bit_count(F.col("one").bitwiseXOR(F.col("other")))
    below = pairs.join(left, "a").select("a", "b", "one")
    near = (below["b"] == right["b"]) & (differ <= bits) & ((F.col("a") < below["b"]) | (F.col("one") < F.col("other")))
    return below.join(right, near).select(F.col("one").alias("a"), F.col("other").alias("b"))


def links(prints: DataFrame, bits: int) -> DataFrame:
    """Pairs ``a``, ``b`` of different values of ``prints`` (one bigint column) that differ in ``bits`` bits at most.

    Two fingerprints within the budget differ in half of it at most in one of their halves. So one
    trie of the fingerprints and one with the halves swapped together have every pair, and in each
    the traversal stays narrow: a node has a few dozen partners, not thousands. ``bits`` is below 8.
    """
    leaves = prints.toDF("leaf").where("leaf IS NOT NULL").distinct()

    def swapped(c: str) -> Column:
        return F.shiftleft(c, HALF).bitwiseOR(F.shiftrightunsigned(c, HALF))

    first = traverse(leaves, bits)
    second = traverse(leaves.select(swapped("leaf").alias("leaf")), bits).select(swapped("a").alias("a"), swapped("b").alias("b"))
    return first.union(second)


def fingerprints(docs: DataFrame, size: int = 3, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Stored ``doc_id``, ``row`` (a hash of the whole row) and ``print`` of each row."""
    return stored(docs.select(F.col(id).alias("doc_id"), row_hash(docs).alias("row"), fingerprint(text, size).alias("print")), "prints")


def groups(prints: DataFrame, bits: int = 3) -> DataFrame:
    """``print`` and ``root`` of the fingerprints that have a link to another one."""
    found = components(links(prints.select("print"), bits))
    return found.select(F.col("node").alias("print"), "root")


def near_duplicates(docs: DataFrame, size: int = 3, bits: int = 3, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``print`` (bigint) and ``component_id``.

    ``component_id`` is the smallest id among the documents that a chain of links reaches, the
    document itself included; equal fingerprints are linked. Copies are handled once, by their
    fingerprint. A NULL or empty text, or one of white space only, has fingerprint zero and is linked
    like any other. Rows with a NULL id get a component as well, but their id is no candidate (NULL if
    there is no other). Repeated rows give repeated results. Other columns are not looked at. An
    empty table gives no rows.
    """
    prints = fingerprints(docs, size, id, text)
    # The roots take part as a small table: one row per linked fingerprint. The group of an unlinked one is itself.
    rooted = prints.groupBy("print").agg(F.min("doc_id").alias("first")).join(groups(prints, bits), "print", "left")
    rooted = rooted.select("print", "first", F.coalesce("root", "print").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stored(rooted.join(smallest, "root").select("print", "component_id"), "named")
    return prints.join(named, "print").select("doc_id", "print", "component_id")


def keep_one(docs: DataFrame, size: int = 3, bits: int = 3, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with one document of each group of near-duplicates: that with the smallest id.

    Groups as in ``near_duplicates``. Ids that are NULL come last; among rows of one id that with the
    smallest hash of all columns stays, and of wholly equal rows one.
    """
    prints = fingerprints(docs, size, id, text)
    rooted = prints.join(groups(prints, bits), "print", "left").select(F.coalesce("root", "print").alias("root"), "doc_id", "row")
    rows = rooted.groupBy("root", "doc_id", "row").agg(F.count("*").alias("n"))
    best = rows.groupBy("root").agg(F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "row", "n")).alias("best"))
    best = stored(best.select("root", "best.doc_id", "best.row", "best.n"), "best")
    _id, _row = free(docs, "id"), free(docs, "row")
    first = best.select("root", F.struct("doc_id", "row").alias("first"))
    others = rows.join(first, "root").where(~F.struct("doc_id", "row").eqNullSafe(F.col("first"))).select(F.col("doc_id").alias(_id), F.col("row").alias(_row))
    marked = docs.withColumn(_row, row_hash(docs))

    def among(some: DataFrame, chosen: DataFrame, how: str) -> DataFrame:
        chosen = small_enough(chosen)
        return some.join(chosen, some[_row].eqNullSafe(chosen[_row]) & some[id].eqNullSafe(chosen[_id]), how)

    kept = among(marked, stored(others, "others"), "left_anti")
    repeated = best.where("n > 1").select(F.col("doc_id").alias(_id), F.col("row").alias(_row))
    if repeated.limit(1).count():
        kept = among(kept, repeated, "left_anti").union(among(kept, repeated, "left_semi").dropDuplicates())
    return kept.drop(_row)
