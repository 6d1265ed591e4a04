"""Ranked lexical search: documents grouped by which terms of an item they hold, groups looked at from the most promising on.

Documents are indexed block by block: the postings of the items' terms, and each document's length. For an item, the postings
of a block set bits in its documents' masks. All documents of one mask score at most the sum, over the mask's terms,
of the block's largest contribution of the term; masks are evaluated by falling bound until none can reach the
best found so far.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quayside.llm.decontaminate import words
from quayside.llm.shared import stored

#: Signs that end a term, as a blank; A to Z as a to z. Bytes beyond ASCII belong to terms.
TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
BLOCK = "ids array<long>, sizes array<int>, terms array<int>, starts array<int>, docs array<int>, times array<int>"
FIRST_LOOK = 64  # documents that are evaluated before the bounds are looked at for the first time
SALTS = 32


@dataclass(frozen=True)
class Items:
    """Some of the items: their ids, the numbers of their terms, and the number of each term."""

    ids: list
    terms: list[np.ndarray]
    numbers: dict[bytes, int]


def item_terms(items: DataFrame, id: str, text: str) -> DataFrame:
    """``item`` and ``term``: the different terms of all texts of an id; without those that have no id."""
    rows = items.where(F.col(id).isNotNull()).select(F.col(id).alias("item"), words(F.col(text)).alias("terms"))
    return rows.select("item", F.explode("terms").alias("term")).distinct()


def collected(terms: DataFrame) -> Items:
    """The items of a batch, whose size the caller bounds."""
    rows = terms.groupBy("item").agg(F.array_sort(F.collect_list(F.col("term").cast("binary"))).alias("terms")).toArrow()
    numbers: dict[bytes, int] = {}
    ids, lists = rows.column(0).to_pylist(), rows.column(1).to_pylist()
    return Items(ids, [np.array([numbers.setdefault(bytes(t), len(numbers)) for t in own], dtype=np.int64) for own in lists], numbers)


def lists(values: list[np.ndarray]) -> list[pa.Array]:
    """Each array as one row of a list column."""
    return [pa.ListArray.from_arrays(pa.array([0, len(v)], type=pa.int32()), pa.array(v, type=pa.int32())) for v in values]


def indexed(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """A row per block of documents: ids, sizes (terms with repeats), and the postings of the numbered terms.

    ``docs`` has ``doc_id`` (long) and ``text`` (binary). A block is an Arrow batch: 10,000 documents or 64 MB
    at most, by Spark's settings, or one text. Term ``terms[i]`` has the postings from ``starts[i]`` on.
    """
    known = docs.sparkSession.sparkContext.broadcast(numbers)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value.get
        for batch in batches:
            count = batch.num_rows
            if not count:
                continue
            sizes, found = np.zeros(count, dtype=np.int64), []
            for i, text in enumerate(batch.column(1)):
                own = (text.as_py() or b"").translate(TERM_BYTES).split()
                sizes[i] = len(own)
                found.append(np.fromiter(map(number, own, repeat(-1)), dtype=np.int64, count=len(own)))
            of, term = np.repeat(np.arange(count), sizes), np.concatenate(found)
            both, times = np.unique((term * count + of)[term >= 0], return_counts=True)
            terms, starts = np.unique(both // count, return_index=True)
            ids = pa.ListArray.from_arrays(pa.array([0, count], type=pa.int32()), batch.column(0))
            yield pa.RecordBatch.from_arrays([ids, *lists([sizes, terms, starts, both % count, times])], schema=pa.schema([(n, t) for n, t in zip(names, kinds)]))

    names = ["ids", "sizes", "terms", "starts", "docs", "times"]
    kinds = [pa.list_(pa.int64()), *[pa.list_(pa.int32())] * 5]
    return docs.mapInArrow(index, BLOCK)


def statistics(blocks: DataFrame) -> tuple[int, int, dict[int, int]]:
    """Documents with a term, all terms with repeats, and in how many documents each numbered term is."""
    with_terms = F.size(F.filter("sizes", lambda n: n > 0)).cast("long")
    all_terms = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, n: a + n)
    documents, length = blocks.agg(F.coalesce(F.sum(with_terms), F.lit(0)), F.coalesce(F.sum(all_terms), F.lit(0))).first()
    until = lambda i: F.coalesce(F.get("starts", i + 1), F.size("docs"))
    own = F.transform("terms", lambda t, i: F.struct(t.alias("term"), (until(i) - F.get("starts", i)).cast("long").alias("n")))
    counts = blocks.select(F.inline(own)).groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    return documents, length, dict(zip(counts.column(0).to_pylist(), counts.column(1).to_pylist()))


@dataclass(frozen=True)
class Weights:
    documents: int
    length: int
    weights: np.ndarray  # by term number


class Best:
    """The ``k`` best documents of an item so far: higher scores first, then smaller ids, NULL last."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.ids, self.none = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    @property
    def least(self) -> int:
        """The score that a further document must reach."""
        return max(1, int(self.scores[-1])) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, none: np.ndarray) -> None:
        ok = scores >= self.least
        scores, ids, none = (np.concatenate(x) for x in ((self.scores, scores[ok]), (self.ids, ids[ok]), (self.none, none[ok])))
        order = np.lexsort((ids, none, -scores))[: self.k]
        self.scores, self.ids, self.none = scores[order], ids[order], none[order]


class Block:
    """The postings of a block with what each contributes to a score."""

    def __init__(self, row: dict[str, np.ndarray], weights: Weights):
        sizes, self.terms, starts, self.docs, times = (row[c].astype(np.int64) for c in ("sizes", "terms", "starts", "docs", "times"))
        self.ids, self.none = row["ids"], row["none"]
        self.bounds = np.append(starts, len(self.docs))
        per_posting = np.repeat(weights.weights[self.terms], np.diff(self.bounds))
        m = 50 + (50 * sizes * weights.documents) // weights.length
        self.worth = per_posting * ((1_000_000_000 * times) // (1000 * times + 20 * m[self.docs]))
        self.most = np.maximum.reduceat(self.worth, starts) if len(starts) else np.empty(0, np.int64)

    def masks(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bits of the different masks over the terms ``at`` (their places here), and the documents in the order of their masks, with mask.

        Bit j of a document's mask says whether it holds term j. Documents without any are left out.
        """
        words_of = np.zeros((-(-len(at) // 64), len(self.ids)), dtype=np.uint64)
        for j, t in enumerate(at):
            words_of[j // 64, self.docs[self.bounds[t] : self.bounds[t + 1]]] |= np.uint64(1 << (j % 64))
        holding = np.flatnonzero(words_of.any(axis=0))
        words_of = words_of[:, holding]
        group = np.zeros(len(holding), dtype=np.int64)
        for word in words_of:  # one after the other, so that equal masks get one number
            different, inverse = np.unique(word, return_inverse=True)
            group = np.unique(group * len(different) + inverse, return_inverse=True)[1]
        _, first = np.unique(group, return_index=True)
        bits = np.stack([(words_of[j // 64, first] >> np.uint64(j % 64)) & np.uint64(1) for j in range(len(at))], axis=1).astype(np.int64)
        order = np.argsort(group, kind="stable")
        return bits, holding[order], group[order]

    def scores(self, docs: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Scores of the documents ``docs`` (sorted) over the terms ``at``."""
        total = np.zeros(len(docs), dtype=np.int64)
        for t in at:
            own = self.docs[self.bounds[t] : self.bounds[t + 1]]
            place = np.searchsorted(own, docs)
            hit = place < len(own)
            hit[hit] = own[place[hit]] == docs[hit]
            total[hit] += self.worth[self.bounds[t] + place[hit]]
        return total

    def search(self, terms: np.ndarray, best: Best) -> int:
        """Add the block's best documents for an item; the number of documents that were evaluated."""
        at = np.searchsorted(self.terms, terms)
        inside = at < len(self.terms)
        inside[inside] = self.terms[at[inside]] == terms[inside]
        at = at[inside]
        if not len(at) or self.most[at].sum() < best.least:
            return 0
        bits, docs, group = self.masks(at)
        bound = bits @ self.most[at]
        starts = np.searchsorted(group, np.arange(len(bits) + 1))
        order, looked, step, n = np.argsort(-bound, kind="stable"), 0, FIRST_LOOK, 0
        while n < len(order) and bound[order[n]] >= best.least:
            end, take = n, 0
            while end < len(order) and take < step and bound[order[end]] >= best.least:
                take += starts[order[end] + 1] - starts[order[end]]
                end += 1
            some = np.sort(np.concatenate([docs[starts[g] : starts[g + 1]] for g in order[n:end]]))
            best.add(self.scores(some, at), self.ids[some], self.none[some])
            n, step, looked = end, 2 * step, looked + len(some)
        return looked


def rows_of(batch: pa.RecordBatch) -> Iterator[dict[str, np.ndarray]]:
    """The blocks of a batch as arrays; NULL ids in ``none``."""
    for i in range(batch.num_rows):
        row = {name: batch.column(c)[i].values for c, name in enumerate(batch.schema.names)}
        none = row["ids"].is_null().to_numpy(zero_copy_only=False)
        yield {name: v.fill_null(0).to_numpy(zero_copy_only=False) for name, v in row.items()} | {"none": none}


def evaluated(blocks: DataFrame, items: Items, weights: Weights, k: int, item_type: T.DataType) -> DataFrame:
    """``item_id``, ``doc_id`` and ``score``: for each item the ``k`` best documents of the blocks that a task has."""
    shared = blocks.sparkSession.sparkContext.broadcast((items.ids, items.terms, weights))
    schema = T.StructType([T.StructField("item_id", item_type), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, terms, weighed = shared.value
        best = [Best(k) for _ in ids]
        for batch in batches:
            for row in rows_of(batch):
                block = Block(row, weighed)
                for own, found in zip(terms, best):
                    block.search(own, found)
        for i in range(0, len(ids), 10_000):
            some = best[i : i + 10_000]
            of = np.repeat(np.arange(i, i + len(some)), [len(b.scores) for b in some])
            docs = pa.array(np.concatenate([b.ids for b in some]), mask=np.concatenate([b.none for b in some]))
            yield pa.RecordBatch.from_arrays([pa.array([ids[j] for j in of]), docs, pa.array(np.concatenate([b.scores for b in some]))], names=schema.names)

    return blocks.mapInArrow(search, schema)


def top(found: DataFrame, k: int, *by: str | Column) -> DataFrame:
    """The ``k`` first rows for each of ``by``, with ``rank``."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def search(
    docs: DataFrame, items: DataFrame, k: int = 50, batch_terms: int = 200_000,
    id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id`` and ``score``: for each item its ``k`` highest-scoring documents, all if fewer.

    Terms are runs of letters, digits and characters beyond ASCII, A to Z lower-cased, of whole texts. With N documents that
    have a term, L terms in all, n in a document, a term in df documents and tf times in this one, its weight is
    floor(1000 ln((2 N + 2) / (2 df + 1))), a document's m is 50 + 50 n N div L, and the score sums weight *
    (10^9 tf div (1000 tf + 20 m)) over an item's different terms. Only scores above 0 count; ties go to the smaller id,
    a NULL id last. Ids of documents are whole numbers.

    A NULL or empty text has no terms. Every row is a document: repeated rows are ranked one after the other. Texts of one item id
    are one item; an item without id or terms has no rows, nor has one that no document matches. Empty tables give no
    rows. Other columns are not looked at.

    Items go through in batches of about ``batch_terms`` terms, which is what the driver and each task hold of them, however many
    there are; for each batch the documents are indexed and searched anew. A task hands on ``k`` rows an
    item; these are reduced to ``k`` in two steps, so that no task gets all of a frequent item.
    """
    spark = docs.sparkSession
    kind = items.schema[item_id].dataType
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    terms = stored(item_terms(items, item_id, item_text), "item-terms")
    batches = max(1, -(-terms.count() // batch_terms))
    found = None
    for number in range(batches):
        some = collected(terms.where(F.pmod(F.xxhash64("item"), F.lit(batches)) == number))
        if not some.ids:
            continue
        blocks = stored(indexed(rows, some.numbers), "blocks")
        documents, length, counts = statistics(blocks)
        if not length:
            break
        weights = np.zeros(len(some.numbers), dtype=np.int64)
        for term, n in counts.items():
            weights[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1)))
        own = evaluated(blocks, some, Weights(documents, length, weights), k, kind)
        found = own if found is None else found.unionByName(own)
    if found is None:
        schema = T.StructType([T.StructField("item_id", kind), *[T.StructField(c, t) for c, t in (("rank", T.IntegerType()), ("doc_id", T.LongType()), ("score", T.LongType()))]])
        return spark.createDataFrame([], schema)
    few = top(found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))), k, "item_id", "salt").drop("salt", "rank")
    return top(few, k, "item_id").select("item_id", "rank", "doc_id", "score")
