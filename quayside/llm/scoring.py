"""Cross-entropy difference of matched target and background bigram models over one vocabulary.

Texts are packed into batches of about a million words. Each batch asks for the counts of its different words and pairs,
one sorted and compressed list per range of their hashes; the lists of a range are summed in one task, and the sums go back
in the order they were asked for. So a word or pair crosses the network once per batch, in some six bytes, and its counts
come back in about one; texts are moved once, compressed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.shared import ASCII_LOWER, stored

MIX = np.uint64(0x9E3779B97F4A7C15)
AT_ONCE = 1_000_000  # words of a batch; a longer text is a batch of its own
PER_RANGE = 2_000_000  # words of the whole input for each range of hashes, of which pairs and words have one each
PER_PIECE = 2  # full batches in a piece of the last shuffle
REMEMBERED = 500_000  # words whose hash a task remembers
COUNTED, TARGET, ASKED = 1, 2, 4  # what a text is there for


def numbers(text: bytes, known: dict[bytes, int]) -> np.ndarray:
    """The words of a text, A to Z lower-cased, as hashes; ``known`` remembers those of a task."""
    words = text.translate(ASCII_LOWER).split()
    for word in set(words):
        if word not in known:
            known[word] = xxhash.xxh64_intdigest(word)
    return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))


def paired(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    """A hash of each word and the one before it."""
    x = before * MIX + words
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def packed(*arrays: np.ndarray) -> bytes:
    """Number arrays of one length, byte plane after byte plane, as the upper ones are mostly zero, compressed."""
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpacked(data: bytes, *kinds: type) -> list[np.ndarray]:
    """The arrays of ``packed``, given their types."""
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    sizes = [np.dtype(kind).itemsize for kind in kinds]
    n, at, out = len(raw) // sum(sizes), 0, []
    for kind, size in zip(kinds, sizes):
        out.append(np.ascontiguousarray(raw[at : at + n * size].reshape(size, n).T).view(kind).ravel())
        at += n * size
    return out


@dataclass
class Words:
    """The words of a batch's texts: different hashes of words and pairs, and which of them stands where."""

    sizes: np.ndarray  # words of each text
    word: np.ndarray  # different words, ascending
    word_at: np.ndarray  # for each place
    pair: np.ndarray  # different pairs, ascending
    pair_at: np.ndarray  # for each place that is not the first of its text
    inner: np.ndarray  # which places those are


def words_of(texts: bytes, sizes: list[int], known: dict[bytes, int]) -> Words:
    """``sizes`` has the bytes of each text, ``texts`` all of them, compressed."""
    data, at, lists = zstandard.ZstdDecompressor().decompress(texts), 0, []
    for size in sizes:
        lists.append(numbers(data[at : at + size], known))
        at += size
        if len(known) > REMEMBERED:
            known.clear()
    lengths = np.array([len(x) for x in lists], dtype=np.int64)
    words = np.concatenate([*lists, np.empty(0, dtype=np.uint64)])
    inner = np.ones(len(words), dtype=bool)
    inner[(np.cumsum(lengths) - lengths)[lengths > 0]] = False
    pairs = paired(words[:-1], words[1:])[inner[1:]] if len(words) else words
    word, word_at = np.unique(words, return_inverse=True)
    pair, pair_at = np.unique(pairs, return_inverse=True)
    return Words(lengths, word, word_at, pair, pair_at, inner)


def batches(rows: DataFrame) -> DataFrame:
    """Stored batches of ``rows`` (``id``, ``text`` as binary, ``kind``): ``batch``, ``ids``, ``sizes``, ``kinds``, ``texts``, and sums of words.

    ``n_counted`` and ``n_target`` are the words that count in the background and in the target model, ``n_words`` all.
    """
    of = dict(rows.dtypes)["id"]
    schema = f"ids array<{of}>, sizes array<int>, kinds array<int>, texts binary, n_words long, n_counted long, n_target long"

    def pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[pa.Array] = []
        texts: list[bytes] = []
        kinds: list[int] = []
        words: list[int] = []

        def row() -> pa.RecordBatch:
            own = pa.concat_arrays(ids)
            lists = [pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), pa.array(x, pa.int32()) if isinstance(x, list) else x) for x in (own, [len(x) for x in texts], kinds)]
            sums = [sum(words)] + [sum(n for n, kind in zip(words, kinds) if kind & bit) for bit in (COUNTED, TARGET)]
            data = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
            columns = [*lists, pa.array([data], pa.binary()), *[pa.array([x], pa.int64()) for x in sums]]
            for held in (ids, texts, kinds, words):
                held.clear()
            return pa.RecordBatch.from_arrays(columns, names=["ids", "sizes", "kinds", "texts", "n_words", "n_counted", "n_target"])

        held = 0
        for part in parts:
            start = 0
            for i, (text, kind) in enumerate(zip(part.column(1), part.column(2).to_pylist())):
                data = bytes(text.as_py() or b"")
                n = len(data.split())
                texts.append(data)
                kinds.append(kind)
                words.append(n)
                held += max(n, 1)
                if held >= AT_ONCE:
                    ids.append(part.column(0).slice(start, i + 1 - start))
                    yield row()
                    start, held = i + 1, 0
            if start < len(part):
                ids.append(part.column(0).slice(start))
        if texts:
            yield row()

    return stored(rows.mapInArrow(pack, schema).withColumn("batch", F.monotonically_increasing_id()), "batches")


def requests(packs: DataFrame, bits: int) -> DataFrame:
    """``size`` (1 for words, 2 for pairs), ``range`` (the first ``bits`` bits of the hashes), ``batch``, ``asked`` and ``payload``.

    The payload has the batch's different hashes in that range, ascending, as steps from one to the next, and how often
    each occurs in the texts of the batch that count, and in those of the target.
    """
    schema = "size int, range int, batch long, asked boolean, payload binary"
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.empty(0, dtype=np.uint64)

    def ask(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for part in parts:
            for row in part.to_pylist():
                words = words_of(row["texts"], row["sizes"], known)
                kinds = np.repeat(np.array(row["kinds"], dtype=np.int64), words.sizes)
                asked = any(kind & ASKED for kind in row["kinds"])
                out = []
                for size, grams, at, its in ((1, words.word, words.word_at, kinds), (2, words.pair, words.pair_at, kinds[words.inner])):
                    n, mine = [np.bincount(at[(its & bit) > 0], minlength=len(grams)).astype(np.uint32) for bit in (COUNTED, TARGET)]
                    cuts = [0, *np.searchsorted(grams, edges).tolist(), len(grams)]
                    for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                        if lo < hi:
                            steps = np.diff(grams[lo:hi], prepend=np.uint64(0))
                            out.append((size, i, row["batch"], asked, packed(steps, n[lo:hi], mine[lo:hi])))
                if out:
                    kinds_of = (pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.binary())
                    columns = [pa.array(column, kind) for column, kind in zip(zip(*out), kinds_of)]
                    yield pa.RecordBatch.from_arrays(columns, names=["size", "range", "batch", "asked", "payload"])

    return packs.select("batch", "sizes", "kinds", "texts").mapInArrow(ask, schema)


def answers(asked: DataFrame, least_n: float) -> DataFrame:
    """``size``, ``range``, ``batch`` and ``payload``: the counts in all batches of what a batch asked for, in its order.

    A row without batch has, for each range, the ``different`` hashes that occur ``least_n`` times at least, and how
    often these occur in all and in the target (``inside``, ``inside_target``). A range holds a bounded share of all words, and of one word or
    pair a row per batch at most, however hot it is.
    """
    schema = "size int, range int, batch long, payload binary, different long, inside long, inside_target long"

    def summed(rows: pa.Table) -> pa.Table:
        size, at = rows["size"][0].as_py(), rows["range"][0].as_py()
        lists = [unpacked(x.as_py(), np.uint64, np.uint32, np.uint32) for x in rows["payload"]]
        different, place = np.unique(np.concatenate([np.cumsum(x[0]) for x in lists]), return_inverse=True)
        n, mine = [np.bincount(place, weights=np.concatenate([x[i] for x in lists]), minlength=len(different)).astype(np.int64) for i in (1, 2)]
        inside = (n > 0) & (n >= least_n)
        out = [(size, at, None, None, int(inside.sum()), int(n[inside].sum()), int(mine[inside].sum()))]
        start = 0
        for own, batch, wanted in zip(lists, rows["batch"].to_pylist(), rows["asked"].to_pylist()):
            its = place[start : start + len(own[0])]
            start += len(its)
            if wanted:
                out.append((size, at, batch, packed(n[its], mine[its]), None, None, None))
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
        names = ["size", "range", "batch", "payload", "different", "inside", "inside_target"]
        return pa.Table.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*out), kinds)], names=names)

    return stored(asked.groupBy("size", "range").applyInArrow(summed, schema), "counts")


@dataclass(frozen=True)
class Models:
    """The texts that the target model and the background model count, and what they leave out."""

    corpus: DataFrame
    least_share: float  # words that make up less of all words are one word
    least_pair_share: float  # pairs that make up less of all words count as unseen
    target: str
    text: str


def train(docs: DataFrame, least_share: float = 0.0, least_pair_share: float = 0.0, target: str = "target", text: str = "text") -> Models:
    """Bigram models of the target texts and of all texts (the background), counted over the whole of every text.

    Both share one vocabulary: all words, or those that make up ``least_share`` of all words at least; the others
    are one word. All pairs count, or those that make up ``least_pair_share`` at least. Nothing runs yet: ``score`` counts
    what it scores and what it counts in one go.
    """
    return Models(docs, least_share, least_pair_share, target, text)


def score(docs: DataFrame, models: Models, weight: float = 0.5, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``target_loss``, ``background_loss`` (per word) and ``difference``.

    ``difference`` is the mean over a text's words of target loss less background loss: the lower, the more the
    text is like the target. The probability of a word mixes its share among all words with its share after the word before
    it, by ``weight``, where that word is in the vocabulary; the same way in both models. All words count, one by one, those
    outside the vocabulary as the one word they are.

    A NULL or empty text, one without words, and models of an empty corpus give NULL losses and zero words.
    NULL ids are kept, repeated rows agree, an empty table gives no rows, other columns are not looked at. Documents that
    are the models' corpus themselves (the same frame) are read once. Words and pairs are known by 64 bits of a hash. What the driver gets is a
    few sums.
    """
    none = F.lit(None).cast("double")
    counted = F.lit(COUNTED) + F.when(F.col(models.target), TARGET).otherwise(0)
    own = models.corpus is docs and models.text == text
    rows = docs.select(F.col(id).alias("id"), F.col(text).cast("binary").alias("text"), ((counted if own else F.lit(0)) + ASKED).alias("kind"))
    if not own:
        corpus = models.corpus.select(F.col(models.text).cast("binary").alias("text"), counted.alias("kind"))
        rows = rows.unionByName(corpus.where("text IS NOT NULL").select(F.lit(None).cast(rows.schema["id"].dataType).alias("id"), "text", "kind"))
    packs = batches(rows)
    n_words, *total = packs.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_words", "n_target", "n_counted")]).first()
    if not total[1]:
        return docs.select(F.col(id).alias("doc_id"), F.lit(0).cast("long").alias("n_words"), *[none.alias(c) for c in ("target_loss", "background_loss", "difference")])
    least_n, least_pair_n = models.least_share * total[1], models.least_pair_share * total[1]
    bits = (n_words // PER_RANGE).bit_length()
    # As many shuffle pieces as there are ranges, and one for some batches, so that they do not grow with the input.
    found = answers(requests(packs, bits).repartition(1 << bits, "size", "range"), least_n)
    sums = found.where("batch IS NULL AND size = 1").agg(F.sum("inside_target"), F.sum("inside"), F.sum("different")).first()
    rest, different = (total[0] - sums[0], total[1] - sums[1]), sums[2]
    smooth = 0.5
    schema = f"doc_id {dict(rows.dtypes)['id']}, n_words long, target_loss double, background_loss double"

    def losses(pack: pa.Table, given: pa.Table) -> pa.Table:
        row = pack.select(["sizes", "kinds", "texts"]).to_pylist()[0]
        words = words_of(row["texts"], row["sizes"], {})
        lists: dict[int, list] = {1: [], 2: []}
        for size, _, data in sorted(zip(given["size"].to_pylist(), given["range"].to_pylist(), given["payload"].to_pylist())):
            lists[size].append(unpacked(data, np.int64, np.int64))
        counts = {size: [np.concatenate([np.empty(0, dtype=np.int64), *[x[i] for x in of]]) for i in (0, 1)] for size, of in lists.items()}
        inside = (counts[1][0] > 0) & (counts[1][0] >= least_n)
        at, inner = words.word_at, words.inner
        before, after = at[:-1][inner[1:]], at[inner]
        seen = inside[before] & inside[after] & (counts[2][0][words.pair_at] >= least_pair_n)
        texts = np.repeat(np.arange(len(words.sizes)), words.sizes)
        out = []
        for model, i in ((0, 1), (1, 0)):  # the target's counts come second
            alone = (np.where(inside, counts[1][i], rest[model]) + smooth) / (total[model] + smooth * (different + 1))
            p = alone[at]
            times = np.where(inside[before], counts[1][i][before], 0)
            share = np.where(seen, counts[2][i][words.pair_at], 0) / np.maximum(times, 1)
            p[inner] = np.where(times > 0, weight * share + (1 - weight) * p[inner], p[inner])
            with np.errstate(invalid="ignore"):
                out.append(np.bincount(texts, weights=-np.log(p), minlength=len(words.sizes)) / words.sizes)
        wanted = pa.array([bool(kind & ASKED) for kind in row["kinds"]])
        columns = [pack["ids"].combine_chunks().flatten(), pa.array(words.sizes), *[pa.array(x, from_pandas=True) for x in out]]
        return pa.Table.from_arrays(columns, names=["doc_id", "n_words", "target_loss", "background_loss"]).filter(wanted)

    asking = packs.where(F.exists("kinds", lambda kind: kind >= ASKED)).select("batch", "ids", "sizes", "kinds", "texts")
    replies = found.where("batch IS NOT NULL").select("batch", "size", "range", "payload")
    pieces = 1 + n_words // (PER_PIECE * AT_ONCE)
    asking, replies = asking.repartition(pieces, "batch"), replies.repartition(pieces, "batch")
    scored = asking.groupBy("batch").cogroup(replies.groupBy("batch")).applyInArrow(losses, schema)
    return scored.withColumn("difference", F.col("target_loss") - F.col("background_loss"))
