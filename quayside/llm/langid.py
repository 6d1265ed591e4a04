"""Language ID by bit-sliced Bloom filters over character n-grams.

One filter per language, all of the same size and hashes. Slice ``i`` has bit ``i`` of every filter, so
ANDing the slices of an n-gram's few positions gives at once the set of languages that contain it.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.shared import stored

UNKNOWN = "und"
SIZE = 3  # characters of an n-gram; a word is framed by spaces
HASHES = 4
BITS_PER_GRAM = 12
MOST_WORDS = 1 << 23  # masks of all slices, eight bytes each
#: Letters and digits that are neither a letter nor a decimal digit: fractions, superscripts, Roman numerals and the like.
NUMBER_SIGNS = {c: " " for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum() and not c.isalpha() and not c.isdecimal()}
WORDS = re.compile(r"[^\W\d_]+")  # runs of letters, in text without such signs
PIECE = 1 << 20  # characters of a text that are looked at together; a piece begins where a word does
MIX = np.uint64(0x9E3779B97F4A7C15)


def pieces(text: str) -> Iterator[str]:
    """The text in parts that end after a letter run, so that n-grams are the same as of the whole."""
    at = 0
    while at < len(text):
        end = at + PIECE
        while end < len(text) and text[end].isalpha():
            end += 1
        yield text[at:end]
        at = end


def grams(text: str) -> np.ndarray:
    """The n-grams of a piece of text, one number each (21 bits a character), as often as they occur."""
    text = text.lower()
    if not text.isascii() and not NUMBER_SIGNS.keys().isdisjoint(set(text)):
        text = text.translate(str.maketrans(NUMBER_SIGNS))
    words = WORDS.findall(text)
    if not words:
        return np.empty(0, dtype=np.uint64)
    codes = np.frombuffer((" " + "  ".join(words) + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    if len(codes) < SIZE:
        return np.empty(0, dtype=np.uint64)
    out = (codes[:-2] << np.uint64(42)) | (codes[1:-1] << np.uint64(21)) | codes[2:]
    space = np.uint64(32)
    return out[(codes[1:-1] != space)]


def hashed(values: np.ndarray) -> np.ndarray:
    """64 well mixed bits of each number."""
    x = values * MIX
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def positions(values: np.ndarray, size: int) -> np.ndarray:
    """The ``HASHES`` places of each n-gram in a filter of ``size`` bits, a power of two."""
    h = hashed(values)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return np.stack([(h + np.uint64(k) * step) & np.uint64(size - 1) for k in range(HASHES)])


def gram_counts(docs: DataFrame) -> DataFrame:
    """``gram``, ``lang`` and ``n``, in how many documents of the language the n-gram is; from whole texts."""
    schema = "gram long, lang string, n long"

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, list[np.ndarray]] = {}
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
                own = [np.unique(grams(piece)) for piece in pieces(text.as_py())]
                by_lang.setdefault(lang, []).append(np.unique(np.concatenate(own)) if own else np.empty(0, dtype=np.uint64))
            for lang, lists in by_lang.items():
                found, n = np.unique(np.concatenate(lists), return_counts=True)
                columns = [pa.array(found.astype(np.int64)), pa.array([lang] * len(found), pa.string()), pa.array(n.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["gram", "lang", "n"])

    return docs.select("text", "lang").mapInArrow(counted, schema).groupBy("gram", "lang").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Filters:
    """``slices``: per bit position and group of 64 languages a mask of languages; ``rates``: each filter's false positive rate."""

    languages: tuple[str, ...]
    size: int
    slices: bytes
    rates: tuple[float, ...]


def train(docs: DataFrame, least_docs: int = 1, least_ratio: float = 0.1, most_languages: int = 512, lang: str = "lang", text: str = "text") -> Filters:
    """Filters from the texts of ``docs`` whose language is known; all of them, whole.

    A language contains an n-gram if ``least_docs`` of its documents have it and their share of all its documents is
    ``least_ratio`` of that in any other language at least: however rare it is, unless it is another language's, as what
    quotations bring in is. Only the ``most_languages`` with most documents are learned (of as many, those first by name), which bounds
    what a dirty column can add; and filters have ``MOST_WORDS`` masks at most, beyond which they only get fuller, and
    the correction larger. A language whose texts have no letters is learned with an empty filter. The filters are filled
    by Spark; the driver gets the slices that are not zero.
    """
    known = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    counted = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most_languages)
    sizes = {row["lang"]: row["n"] for row in counted.collect()}
    languages = tuple(sorted(sizes))
    if not languages:
        return Filters((), 64, b"", ())
    order = docs.sparkSession.createDataFrame([(name, i, sizes[name]) for i, name in enumerate(languages)], "lang string, number int, docs long")
    shares = gram_counts(known).where(F.col("n") >= least_docs).join(F.broadcast(order), "lang")
    frequent = shares.select("gram", "number", (F.col("n") / F.col("docs")).alias("share"))
    top = F.collect_list(F.struct("number", "share"))
    listed = frequent.groupBy("gram").agg(top.alias("all"), F.max("share").alias("most"))
    own = F.filter("all", lambda x: x["share"] >= least_ratio * F.col("most"))
    members = stored(listed.select("gram", F.transform(own, lambda x: x["number"]).alias("numbers")), "grams")
    largest = members.select(F.explode("numbers").alias("number")).groupBy("number").count().agg(F.max("count")).first()[0] or 1
    groups = (len(languages) + 63) // 64
    size = 1 << max(6, min(int(np.ceil(np.log2(BITS_PER_GRAM * largest))), int(np.log2(MOST_WORDS // groups))))

    @F.pandas_udf("array<int>")
    def places(values: pd.Series) -> pd.Series:
        return pd.Series(list(positions(values.to_numpy().astype(np.uint64), size).T.astype(np.int32)), dtype=object)

    bits = members.select(F.explode(places("gram")).alias("place"), "numbers").select("place", F.explode("numbers").alias("number"))
    masks = bits.groupBy("place", F.floor(F.col("number") / 64).alias("group")).agg(F.bit_or(F.expr("shiftleft(1L, number % 64)")).alias("mask"))
    table = masks.select("place", F.col("group").cast("int").alias("group"), "mask").toArrow()
    slices = np.zeros((size, groups), dtype=np.uint64)
    slices[table["place"].to_numpy(), table["group"].to_numpy()] = table["mask"].to_numpy().astype(np.uint64)
    fill = [np.count_nonzero((slices[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)) / size for i in range(len(languages))]
    return Filters(languages, size, slices.tobytes(), tuple(float(f) ** HASHES for f in fill))


@lru_cache(maxsize=2)
def sliced(slices: bytes, size: int) -> np.ndarray:
    return np.frombuffer(slices, dtype=np.uint64).reshape(size, -1)


def judge(text: str | None, filters: Filters) -> tuple[str, float]:
    """The language whose filter has most of a text's n-grams, and the share it has.

    Of ``n`` n-grams, a filter with false positive rate f that holds c of them is expected to have truly
    (c - n f) / (1 - f); ties go to the language that comes first by name.
    """
    total = 0
    hits = np.zeros(len(filters.languages))
    for piece in pieces(text or ""):
        own = grams(piece)
        total += len(own)
        if not len(own) or not filters.languages:
            continue
        different, times = np.unique(own, return_counts=True)
        at = positions(different, filters.size)
        table = sliced(filters.slices, filters.size)
        masks = table[at[0]]
        for place in at[1:]:
            masks = masks & table[place]
        for i in range(len(hits)):
            hits[i] += times[((masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).astype(bool)].sum()
    if not total or not filters.languages:
        return UNKNOWN, 0.0
    rates = np.array(filters.rates)
    true = np.clip((hits - total * rates) / np.maximum(1 - rates, 1e-9), 0, total) / total
    best = int(np.argmax(true))
    return filters.languages[best], float(true[best])


def identify(docs: DataFrame, filters: Filters, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``lang_pred`` and ``score``, from the text alone.

    ``lang_pred`` is a learned language, or ``und`` with score 0 if the text is NULL or empty or has no
    letter, or nothing was learned. Texts are judged whole, piece by piece. NULL ids are kept, repeated rows
    agree, an empty table gives no rows, other columns are not looked at.
    """

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def judged(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([judge(x, filters) for x in texts], columns=["lang_pred", "score"])

    return docs.select(F.col(id).alias("doc_id"), judged(F.col(text)).alias("j")).select("doc_id", "j.lang_pred", "j.score")


def held_out(id: str = "doc_id") -> Column:
    """Whether a document is kept from training: the CRC-32 of its id as text leaves 2 when divided by 4. A NULL id is not."""
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 4 == 2, F.lit(False))

