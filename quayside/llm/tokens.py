"""Token counts per section: whole documents encoded once, tokens attributed by their character spans."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the vocabulary's makers cut text before merging: a fixed value.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RULES = ("first", "last", "most")


@lru_cache(maxsize=2)
def encoder(ranks: bytes) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoder of a rank file, and the number of bytes of each token."""
    listed = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines()) if token}
    sizes = np.zeros(max(listed.values()) + 1, dtype=np.int64)
    for token, rank in listed.items():
        sizes[rank] = len(token)
    return tiktoken.Encoding("sections", pat_str=PATTERN, mergeable_ranks=listed, special_tokens={}), sizes


def spans(text: str, ranks: bytes) -> np.ndarray:
    """First and last character of each token of a text: those that its first and last byte belong to."""
    encoding, sizes = encoder(ranks)
    ends = np.cumsum(sizes[np.array(encoding.encode_ordinary(text), dtype=np.int64)])
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    character = np.cumsum((data & 0xC0) != 0x80) - 1
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    return np.stack([character[starts], character[ends - 1]]) if len(ends) else np.empty((2, 0), dtype=np.int64)


def lines(text: str) -> np.ndarray:
    """The character after each line; a line ends with its line feed."""
    ends = [i + 1 for i in np.flatnonzero(np.array(list(map(ord, text)), dtype=np.int64) == 10)] if "\n" in text else []
    return np.array(ends if ends and ends[-1] == len(text) else [*ends, len(text)], dtype=np.int64)


def attribute(first: np.ndarray, last: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and how many of them reach into another one: an interval join of sorted spans.

    ``ends`` has the character after each section. A token that lies in several sections goes to that of
    its first character, of its last one, or to the one with most of its characters (the first of several).
    """
    one, other = np.searchsorted(ends, first, side="right"), np.searchsorted(ends, last, side="right")
    chosen = other if rule == "last" else one.copy()
    if rule == "most":
        for i in np.flatnonzero(one != other):
            bounds = np.clip(np.concatenate([[first[i]], ends[one[i] : other[i] + 1]]), first[i], last[i] + 1)
            chosen[i] = one[i] + int(np.argmax(np.diff(bounds)))
    return np.bincount(chosen, minlength=len(ends)), np.bincount(chosen[one != other], minlength=len(ends))


def section_counts(docs: DataFrame, vocabulary: str = VOCABULARY, rule: str = "first", id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document and section: ``doc_id``, ``section`` (from 0), ``start``, ``end`` (characters), ``tokens``, ``crossing``.

    Sections are the lines of a text. Each text is encoded once and as a whole, as its tokens depend on
    what surrounds them; a token across a boundary is counted once, by ``rule``: ``first`` (the section
    of its first character), ``last`` or ``most``. So the counts of a document add up to its tokens.

    A text without characters has one section without tokens, a NULL text no row. A NULL id is kept.
    Repeated rows give repeated results. Other columns are not looked at. The vocabulary, about a MB,
    is read by the driver and sent along, so executors need no copy.
    """
    if rule not in RULES:
        raise ValueError(f"rule {rule!r} is none of {RULES}")
    ranks = Path(vocabulary).read_bytes()
    kind = docs.schema[id].dataType
    schema = T.StructType([T.StructField("doc_id", kind), *[T.StructField(c, T.LongType()) for c in ("section", "start", "end", "tokens", "crossing")]])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: list[list[np.ndarray]] = [[] for _ in range(5)]
            source: list[int] = []
            for i, value in enumerate(batch.column(1)):
                content = value.as_py()
                ends = lines(content)
                tokens, crossing = attribute(*spans(content, ranks), ends, rule)
                for part, column in zip(parts, (np.arange(len(ends)), np.concatenate([[0], ends[:-1]]), ends, tokens, crossing)):
                    part.append(column)
                source += [i] * len(ends)
            ids = batch.column(0).take(pa.array(source, type=pa.int64()))
            columns = [pa.array(np.concatenate(part) if part else [], type=pa.int64()) for part in parts]
            yield pa.RecordBatch.from_arrays([ids, *columns], names=schema.names)

    return docs.where(F.col(text).isNotNull()).select(F.col(id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(counted, schema)
