"""Cross-tokenizer alignment: tokens of two tokenizers linked where they end together, links counted over the corpus.

Links are records of a pair of ids and a document. Each task sorts its records into runs, side-major (by the second
tokenizer's id, then the first's), cut by radix of that id and compressed by zstandard. Sums of the runs are
merged k at a time by heap until each radix has one; side-major order then yields each id's highest count. The
records are read once more against these counts, and what each contributes goes back to its document.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.shared import stored

FIRST = "/opt/tokenizers/byte_bpe_50k.json"
SECOND = "/opt/tokenizers/piece_bpe_32k.model"
ID_BITS = 28  # a pair is radix, second id and first id in one number, so that numbers sort side-major
RADIXES = 64
RUN = 2_000_000  # links of a run; a document is in one run
FAN_IN = 64  # runs that are merged at a time
REMEMBERED, LONGEST = 200_000, 64  # pieces of text that a task remembers, and their characters
AT_ONCE = 1 << 20  # characters of texts whose pieces are looked up together
#: Before a blank that follows something else than white space, words of both tokenizers end.
BREAK = re.compile(r"(?<=\S)(?= )")
BLANK = "▁"  # how the second tokenizer writes a blank: a fixed value


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones for themselves, the rest by turn from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in set(plain))
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoders:
    """Both tokenizers, the bytes of their tokens, and whether texts may be encoded in pieces."""

    def __init__(self, first: bytes, second: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_str(first.decode())
        self.first.encode_special_tokens = True
        letters = byte_letters()
        vocabulary = self.first.get_vocab(with_added_tokens=True)
        self.first_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.first_bytes[number] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.second = SentencePieceProcessor(model_proto=second)
        pieces = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        self.second_bytes = [bytes([int(p[3:5], 16)]) if self.second.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)]
        if max(len(self.first_bytes), len(pieces)) > 1 << ID_BITS or not all(self.first_bytes) or not all(self.second_bytes):
            raise ValueError(f"ids of {ID_BITS} bits at most, and tokens of a byte at least")
        self.first_sizes, self.second_sizes = list(map(len, self.first_bytes)), list(map(len, self.second_bytes))
        set_up = json.loads(first)
        before = set_up["pre_tokenizer"] or {}
        by_words = set_up["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
        self.in_pieces = bool(by_words) and not any(BLANK in p.lstrip(BLANK) for p in pieces)

    def pieces(self, text: str) -> list[str]:
        """A blank and the text, cut where no token of either tokenizer goes across; the second adds a blank by itself, so each begins with one."""
        text = f" {text}"
        if not self.in_pieces:
            return [text]
        found = BREAK.split(text)
        if found[-1] == " " and len(found) > 1:  # nothing would be left to encode
            found[-2:] = [found[-2] + found[-1]]
        return found

    def aligned(self, pieces: list[str]) -> list[tuple | None]:
        """For each piece how many tokens, groups and links it has, the groups as text, and the links; None if the bytes differ."""
        first = [e.ids for e in self.first.encode_batch_fast(pieces, add_special_tokens=False)]
        second = self.second.encode([p[1:] for p in pieces], num_threads=1)
        if self.sound(pieces, first, self.first_bytes, self.first_sizes) and self.sound(pieces, second, self.second_bytes, self.second_sizes):
            return self.groups(first, second)
        if len(pieces) == 1:
            return [None]
        half = len(pieces) // 2  # look for the piece that differs
        return self.aligned(pieces[:half]) + self.aligned(pieces[half:])

    def sound(self, pieces: list[str], ids: list[list[int]], known: list[bytes], sizes: list[int]) -> bool:
        """Whether the tokens' bytes are those of the pieces, all of them."""
        lengths = [len(p) if p.isascii() else len(p.encode()) for p in pieces]
        return lengths == [sum(map(sizes.__getitem__, own)) for own in ids] and b"".join(map(known.__getitem__, chain.from_iterable(ids))) == "".join(pieces).encode()

    def groups(self, first: list[list[int]], second: list[list[int]]) -> list[tuple]:
        """Two lists of tokens for each piece, cut where tokens of both end; as no token is empty, a group's last tokens are its link."""
        out = []
        first_sizes, second_sizes = self.first_sizes, self.second_sizes
        for a, b in zip(first, second):
            shown, links, j, j_since, i_since = [], [], 0, 0, 0
            y = b[0]
            ahead = -second_sizes[y]  # bytes of the first side's tokens less those of the second's, up to and with y
            for i, x in enumerate(a, 1):
                ahead += first_sizes[x]
                while ahead > 0:
                    j += 1
                    y = b[j]
                    ahead -= second_sizes[y]
                if ahead == 0:
                    links.append((y % RADIXES) << 2 * ID_BITS | y << ID_BITS | x)
                    j += 1
                    left = f"{x}" if i == i_since + 1 else ",".join(map(str, a[i_since:i]))
                    shown.append(f"{left}|{y}" if j == j_since + 1 else f"{left}|{','.join(map(str, b[j_since:j]))}")
                    i_since, j_since = i, j
                    if j < len(b):
                        y = b[j]
                        ahead = -second_sizes[y]
            out.append((len(a), len(b), len(shown), ";".join(shown), tuple(links)))
        return out


@lru_cache(maxsize=1)
def encoders(first: bytes, second: bytes) -> Encoders:
    return Encoders(first, second)


class Memory:
    """What was found for pieces of text lately: in the current generation or the one before, ``REMEMBERED`` pieces each."""

    def __init__(self, own: Encoders):
        self.own, self.known, self.older = own, {}, {}

    def look_up(self, texts: list[str]) -> list[list[tuple | None]]:
        pieces = [self.own.pieces(text) for text in texts]
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        new = {p for own in pieces for p in own if p not in known}
        known.update((p, older[p]) for p in new & older.keys())
        new = [p for p in new if p not in older]
        known.update(zip(new, self.own.aligned(new)) if new else ())
        found = [list(map(known.__getitem__, own)) for own in pieces]
        for p in new:
            if len(p) > LONGEST:
                del known[p]
        return found


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers as a zstandard frame."""
    head = np.array([len(arrays), *(x for a in arrays for x in (a.dtype.itemsize, len(a)))], dtype=np.int64)
    return zstandard.ZstdCompressor(level=1).compress(b"".join([head.tobytes(), *(a.tobytes() for a in arrays)]))


def unpacked(data: bytes) -> list[np.ndarray]:
    plain = zstandard.ZstdDecompressor().decompress(data)
    count = int(np.frombuffer(plain, np.int64, 1)[0])
    shapes, at, out = np.frombuffer(plain, np.int64, 2 * count, 8).reshape(-1, 2), 8 + 16 * count, []
    for size, length in shapes.tolist():
        out.append(np.frombuffer(plain, f"i{size}", length, at))
        at += size * length
    return out


def changes(values: np.ndarray) -> np.ndarray:
    """Where a sorted array has another value than before."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.empty(0, np.int64)


def sorted_run(pairs: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
    """Radix, sums and records of a run: pairs with their sums; and for each pair its documents (as steps) and times."""
    order = np.argsort(pairs, kind="stable")
    pairs, at = pairs[order], at[order]
    first = np.flatnonzero(np.concatenate([[True], (pairs[1:] != pairs[:-1]) | (at[1:] != at[:-1])]))
    times = np.diff(np.append(first, len(pairs)))
    pairs, at = pairs[first], at[first]
    by_radix = changes(pairs >> 2 * ID_BITS)
    for begin, end in zip(by_radix, np.append(by_radix[1:], len(pairs))):
        own, docs, n = pairs[begin:end], at[begin:end], times[begin:end]
        starts = changes(own)
        steps = np.diff(docs, prepend=0)
        steps[starts] = docs[starts]
        records = packed(own[starts], np.diff(np.append(starts, len(own))).astype(np.int32), steps.astype(np.int32), n.astype(np.int32))
        yield int(own[0] >> 2 * ID_BITS), packed(own[starts], np.add.reduceat(n, starts)), records


FACTS = ["n_a", "n_b", "n_groups", "n_links"]


def encoded(docs: DataFrame, first: bytes, second: bytes) -> DataFrame:
    """``docs`` (``doc_id``, ``text``) encoded and aligned: a row per document, and rows with the sums and records of runs.

    ``kind`` is doc, sums or records. A document's ``run`` and ``at`` (its place there) name it.
    """
    kind = docs.schema["doc_id"].dataType
    fields = [("kind", T.StringType()), ("run", T.LongType()), ("at", T.IntegerType()), ("doc_id", kind), *[(c, T.LongType()) for c in FACTS]]
    fields += [("groups_sha256", T.StringType()), ("radix", T.IntegerType()), ("payload", T.BinaryType())]
    schema = T.StructType([T.StructField(name, t) for name, t in fields])
    shared = docs.sparkSession.sparkContext.broadcast((first, second))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Memory(encoders(*shared.value))
        run, count, held, links = 0, 0, 0, []

        def blocks(id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
            pairs, at = np.concatenate([p for _, p in links]), np.repeat([i for i, _ in links], [len(p) for _, p in links])
            for radix, sums, records in sorted_run(pairs, at):
                empty = [pa.nulls(2, pa.int32()), pa.nulls(2, id_type), *[pa.nulls(2, pa.int64())] * 4, pa.nulls(2, pa.string())]
                columns = [pa.array(["sums", "records"]), pa.array([run] * 2), *empty, pa.array([radix] * 2, pa.int32()), pa.array([sums, records], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

        def parts(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str]]]:
            """The texts of a batch, some at a time, with the place of the first."""
            begin, size, texts = 0, 0, []
            for i, text in enumerate(batch.column(1)):
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= AT_ONCE:
                    yield begin, texts
                    begin, size, texts = i + 1, 0, []
            if texts:
                yield begin, texts

        id_type = pa.null()
        for batch in batches:
            id_type = batch.column(0).type
            for begin, texts in parts(batch):
                if held >= RUN:
                    yield from blocks(id_type)
                    count, held, links = 0, 0, []
                if not count:
                    run = batch.column(2)[begin].as_py()
                facts, prints = [], []
                for text, found in zip(texts, memory.look_up(texts)):
                    if not text or None in found:
                        facts.append((0, 0, 0, 0))
                        prints.append("")
                    else:
                        a, b, groups, shown, pairs = zip(*found)
                        own = np.fromiter(chain.from_iterable(pairs), dtype=np.int64)
                        facts.append((sum(a), sum(b), sum(groups), len(own)))
                        prints.append(hashlib.sha256(";".join(shown).encode()).hexdigest())
                        links.append((count + len(facts) - 1, own))
                        held += len(own)
                n = len(texts)
                columns = [pa.array(["doc"] * n), pa.array([run] * n), pa.array(np.arange(count, count + n, dtype=np.int32)), batch.column(0).slice(begin, n)]
                columns += [pa.array(x, pa.int64()) for x in zip(*facts)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(prints), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=schema.names)
                count += n
        if links:
            yield from blocks(id_type)

    return docs.withColumn("row", F.monotonically_increasing_id()).mapInArrow(encode, schema)


def merged(runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs and sums of several sorted runs, by a heap of their heads."""
    pairs, sums, last = [], [], None
    for pair, n in heapq.merge(*[zip(p.tolist(), s.tolist()) for p, s in map(unpacked, runs)]):
        if pair == last:
            sums[-1] += n
        else:
            pairs.append(pair)
            sums.append(n)
            last = pair
    return np.array(pairs, dtype=np.int64), np.array(sums, dtype=np.int64)


def highest(pairs: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Whether a pair has the highest sum of all with its second id, ties included; pairs are sorted side-major."""
    starts = changes(pairs >> ID_BITS)
    return sums == np.repeat(np.maximum.reduceat(sums, starts), np.diff(np.append(starts, len(pairs))))


def counted(sums: DataFrame, runs: int) -> DataFrame:
    """``radix`` and ``payload``: all pairs of a radix with their counts and whether they are highest; from ``radix``, ``run``, ``payload``.

    Rounds of merges, ``FAN_IN`` runs of a radix at a time on average, until each radix has one run: what a task holds depends on how
    many different pairs there are, not on how often one occurs or in how many documents.
    """
    while True:
        parts, last = max(1, -(-runs // FAN_IN)), runs <= FAN_IN

        def merge(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
            pairs, n = merged(rows.column("payload").to_pylist())
            payload = packed(pairs, n, highest(pairs, n).astype(np.int8)) if last else packed(pairs, n)
            return pa.table({"radix": pa.array([key[0].as_py()], pa.int32()), "run": pa.array([key[1].as_py()], pa.int64()), "payload": pa.array([payload], pa.binary())})

        part = F.pmod(F.xxhash64("run"), F.lit(parts)).alias("part")
        dealt = sums.select("radix", part, "payload")
        sums = stored(dealt.groupBy("radix", "part").applyInArrow(merge, "radix int, run long, payload binary"), "sums")
        if last:
            return sums.select("radix", "payload")
        runs = parts


def contributions(records: DataFrame, counts: DataFrame, runs: int) -> DataFrame:
    """``run``, ``at``, ``n_best`` and ``count_sum`` of each document with links, from the records of the runs and ``counted``.

    The blocks of a radix are dealt to parts of about ``FAN_IN`` runs, each with its copy of the radix' counts; what a block gives its
    documents is summed there, and then over the blocks of a run.
    """
    parts = max(1, -(-runs // FAN_IN))
    dealt = records.withColumn("part", F.pmod(F.xxhash64("run"), F.lit(parts)).cast("int"))
    copies = counts.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def give(blocks: pa.Table, counts: pa.Table) -> pa.Table:
        runs, payloads = [], []
        if blocks.num_rows:
            pairs, sums, best = unpacked(counts.column("payload")[0].as_py())
        for run, block in zip(blocks.column("run").to_pylist(), blocks.column("payload")):
            own, lengths, steps, times = unpacked(block.as_py())
            of = np.searchsorted(pairs, own)
            starts = np.concatenate([[0], np.cumsum(lengths[:-1])]).astype(np.int64)
            total = np.cumsum(steps, dtype=np.int64)
            at = total - np.repeat(total[starts] - steps[starts], lengths)
            n = times.astype(np.int64)
            into, place = np.unique(at, return_inverse=True)
            n_best, count_sum = np.zeros(len(into), np.int64), np.zeros(len(into), np.int64)
            np.add.at(count_sum, place, n * np.repeat(sums[of], lengths))
            np.add.at(n_best, place, n * np.repeat(best[of], lengths))
            runs.append(run)
            payloads.append(packed(into.astype(np.int32), n_best, count_sum))
        return pa.table({"run": pa.array(runs, pa.int64()), "payload": pa.array(payloads, pa.binary())})

    def add(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        given = [unpacked(x.as_py()) for x in rows.column("payload")]
        into, place = np.unique(np.concatenate([at for at, *_ in given]), return_inverse=True)
        both = []
        for side in (1, 2):
            total = np.zeros(len(into), np.int64)
            np.add.at(total, place, np.concatenate([g[side] for g in given]))
            both.append(pa.array(total))
        return pa.table({"run": pa.array([key[0].as_py()] * len(into), pa.int64()), "at": pa.array(into, pa.int32()), "n_best": both[0], "count_sum": both[1]})

    blocks = dealt.select("radix", "part", "run", "payload").groupBy("radix", "part")
    given = blocks.cogroup(copies.groupBy("radix", "part")).applyInArrow(give, "run long, payload binary")
    return given.groupBy("run").applyInArrow(add, "run long, at int, n_best long, count_sum long")


def align(docs: DataFrame, first: str = FIRST, second: str = SECOND, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``.

    A blank and the text are encoded by ``first`` (a byte-level tokenizers file; A) and by ``second`` (a sentencepiece model that adds the
    blank itself; B), without special tokens: their strings in a text are plain text. Where tokens of both end, a group ends; pairs of
    tokens that end there together are links. A pair of ids counts as often as links of all documents hold it; ``count_sum`` sums this
    over a document's links, ``n_best`` are those whose count is the highest that their B id has with any A id.

    Texts that are NULL or empty, or whose tokens' bytes are not the blank and the text (B writes its own sign for blanks like a blank),
    have zeros, an empty ``groups_sha256`` and no links. Repeated rows count each and agree; NULL ids are kept; an empty table gives
    no rows; other columns are not looked at. Texts of any length are taken whole. The driver reads both files, a few
    MB, and sends them along.
    """
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    found = stored(encoded(rows, Path(first).read_bytes(), Path(second).read_bytes()), "encoded")
    own = found.where("kind = 'doc'").select("run", "at", "doc_id", *FACTS, "groups_sha256")
    sums = found.where("kind = 'sums'").select("radix", "run", "payload")
    runs = sums.agg(F.count_distinct("run")).first()[0]
    if not runs:
        zero = F.lit(0).cast("long")
        return own.select("doc_id", *FACTS, zero.alias("n_best"), zero.alias("count_sum"), "groups_sha256")
    given = contributions(found.where("kind = 'records'").select("radix", "run", "payload"), counted(sums, runs), runs)
    back = own.join(given, ["run", "at"], "left")
    more = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")]
    return back.select("doc_id", *FACTS, *more, "groups_sha256")
