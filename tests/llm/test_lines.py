from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quayside.llm import lines


def prose(number: int, words: int = 60, every: int = 8) -> str:
    """Different words for each number, in sentences of eight."""
    listed = [f"w{number}x{i}" for i in range(words)]
    return " ".join(word + ("." if i % every == every - 1 else "") for i, word in enumerate(listed)) + "."


def words_of(text):
    return (text or "").replace("\n", " ").split()


def common(rows):
    """For each document the word places that lie in common runs, as (length of the longest run there) by place: the definition itself."""
    docs = [(d, words_of(t)) for d, t in sorted(rows)]
    out = {}
    for d, (name, mine) in enumerate(docs):
        longest = [0] * len(mine)
        for e, (_, its) in enumerate(docs[: d + 1]):
            before = {}
            for j, word in enumerate(its):
                before.setdefault(word, []).append(j)
            length: dict[tuple[int, int], int] = {}
            for i, word in enumerate(mine):
                for j in before.get(word, ()):
                    if e == d and j >= i:
                        continue
                    length[i, j] = length.pop((i - 1, j - 1), 0) + 1
                    if i + 1 == len(mine) or j + 1 == len(its) or mine[i + 1] != its[j + 1] or (e == d and j + 1 >= i + 1):
                        n = length[i, j]
                        for k in range(i - n + 1, i + 1):
                            longest[k] = max(longest[k], n)
        out[name] = longest
    return out


def gone_of(before, after, deleted):
    """Which words of a text are gone: the places of the deleted texts, in order, between which the edited text is left."""

    def place(at, left, k):
        if k == len(deleted):
            return [] if before[at:] == after[left:] else None
        starts = [i for i in range(at, len(before)) if before.startswith(deleted[k], i) and before[at:i] == after[left : left + i - at]]
        for start in reversed(starts):  # of a line over and over, the first copies stay
            more = place(start + len(deleted[k]), left + start - at, k + 1)
            if more is not None:
                return [start, *more]
        return None

    gone, at = [], 0
    starts = place(0, 0, 0)
    assert starts is not None
    for start, part in zip(starts, deleted):
        gone += [False] * len(words_of(before[at:start])) + [True] * len(words_of(part))
        at = start + len(part)
    return gone + [False] * len(words_of(before[at:]))


def check(rows, found):
    """Nothing goes but what lies in a run of 25 words that occurs earlier. How many words are gone."""
    longest = common(rows)
    edited = {r["doc_id"]: (r["text"], r["deleted"], r["n_deleted"]) for r in found.collect()}
    removed = 0
    for name, text in rows:
        after, deleted, n = edited[name]
        gone = gone_of(text, after, deleted)
        assert n == sum(gone) == sum(len(words_of(part)) for part in deleted)
        assert words_of(after) == [w for w, g in zip(words_of(text), gone) if not g]
        assert all(run >= 25 for run, g in zip(longest[name], gone) if g), name
        removed += n
    return removed


@pytest.mark.parametrize("parts_of_passages", [False, True])
def test_every_long_run_goes_and_nothing_else(documents, parts_of_passages):
    """Passages cut inside sentences. Of several that overlap, a part is compared with its own first copy, so some words may stay."""
    pick = random.Random(3)
    passages = [prose(i, pick.choice([30, 60, 120, 300]), [4, 8, 13, 200][i % 4]).split(" ") for i in range(8)]
    passages = [listed[pick.randrange(8) :] for listed in passages]
    rows = []
    for i in range(40):
        parts = [prose(1000 + i, pick.randrange(5, 80), pick.choice([3, 8, 100]))]
        for _ in range(pick.randrange(4)):
            some = pick.choice(passages)
            if parts_of_passages:
                some = some[pick.randrange(len(some) // 2) :][: pick.choice([20, 26, 60, 500])]
            parts.insert(pick.randrange(len(parts) + 1), " ".join(some))
            parts.append(pick.choice(["Les.", "De la.", "Short header line"]))
        rows.append((i, pick.choice(["\n", " ", "\n\n", "  "]).join(parts)))
    rows += [(90, "same line again\n" * 50), (91, "Les. De la. Les. De la. " * 30), (92, "")]
    found = lines.dedup_lines(documents(*rows)).cache()
    assert check(rows, found) > 1000
    if not parts_of_passages:
        left = Counter(word for r in found.collect() for word in words_of(r["text"]))
        used = Counter(word for _, text in rows for word in words_of(text))
        long = [word for listed in passages if len(listed) > 50 for word in listed]
        assert max(used[word] for word in long) > 3 and {word for word in long if left[word] != 1} == {word for word in long if not used[word]}


def test_pieces_from_several_places_are_no_run(documents):
    """Six sentences that occur earlier, but only in pairs of 16 words, stay."""
    sentences = [prose(i, 8) for i in range(6)]
    first = "\n".join(f"{sentences[i]} {sentences[i + 1]}\n{prose(100 + i, 8)} {prose(200 + i, 8)}" for i in range(0, 6, 2))
    rows = [(0, first), (1, " ".join(sentences))]
    assert check(rows, lines.dedup_lines(documents(*rows))) == 0


def test_a_copy_on_a_line_without_sentence_ends(documents):
    shared = " ".join(f"shared{i}" for i in range(300))
    rows = [(0, f"{prose(1, 50, 999)} {shared} {prose(2, 50, 999)}"), (1, f"other start {shared} other end")]
    assert check(rows, lines.dedup_lines(documents(*rows))) >= 300
    found = {r["doc_id"]: r["text"] for r in lines.dedup_lines(documents(*rows)).collect()}
    assert found == {0: rows[0][1], 1: "other start other end"}


def test_both_sides_of_a_changed_sentence_go(documents):
    text = prose(1, 160)
    rows = [(1, text), (2, text.replace("w1x75 ", "changed "))]
    found = {r["doc_id"]: (r["text"], r["n_deleted"]) for r in lines.dedup_lines(documents(*rows)).collect()}
    assert found == {1: (text, 0), 2: ("changed ", 159)}


def test_passage_inside_a_line_is_found(documents):
    passage = prose(1, 70)
    rows = [(2, f"{prose(5)} {passage} {prose(6)}"), (1, f"some words before {passage}"), (3, prose(7))]
    found = {r["doc_id"]: r for r in lines.dedup_lines(documents(*rows)).collect()}
    assert found[1]["text"] == rows[1][1] and found[3]["text"] == rows[2][1]
    assert found[2]["text"] == f"{prose(5)} {prose(6)}" and found[2]["deleted"] == [f"{passage} "]


def test_wording_counts_not_white_space(documents):
    passage = prose(1, 64)
    rows = [(1, passage), (2, passage.replace(". ", ".\n")), (3, passage.replace(" ", "  "))]
    found = lines.dedup_lines(documents(*rows)).cache()
    assert check(rows, found) == 128 and [r["text"] for r in found.orderBy("doc_id").collect()] == [passage, "", ""]


def test_equal_hashes_are_not_enough(documents, monkeypatch):
    """Were all fingerprints equal, still only equal words would go."""
    monkeypatch.setattr(lines.F, "xxhash64", lambda *columns: F.lit(7).cast("long"))
    rows = [(1, prose(1, 80)), (2, prose(2, 80)), (3, f"{prose(3, 16)} {prose(1, 80)}")]
    found = {r["doc_id"]: r["n_deleted"] for r in lines.dedup_lines(documents(*rows)).collect()}
    assert found[1] == found[2] == 0


def test_copies_nulls_repeated_rows_and_other_columns(spark):
    text = prose(1)
    rows = [(1, text, 5), (1, text, 5), (2, text, 6), (None, text, 7), (None, None, 8), (4, None, 9), (5, "", 9), (6, "a\x01b. \x01c", 9), (3, "x" * 300_000, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, version long")
    found = sorted(((r["doc_id"] or 0, r["version"], r["text"]) for r in lines.dedup_lines(docs).collect()), key=str)
    kept = {(1, text), (5, ""), (6, "a\x01b. \x01c"), (3, "x" * 300_000)}
    expected = sorted(((d or 0, v, t if (d, t) in kept or t is None else "") for d, t, v in rows), key=str)
    assert found == expected


def test_units_put_together_are_the_text(spark):
    texts = ["", " ", "\n\n", "a. b! c? d\n e", "a\x01b. c\x01", prose(1, 200, 999), "  " + " ".join(f"v{i}" for i in range(90)) + "  ", "x " * 60, "é𝄞. " * 40]
    table = spark.createDataFrame([(t,) for t in texts], "text string")
    for row in table.select("text", lines.units(F.col("text")).alias("u")).collect():
        assert "".join(row["u"]) == row["text"]


def test_empty_table(documents):
    assert lines.dedup_lines(documents().limit(0)).collect() == []


def test_no_python_in_the_plan(documents):
    plan = lines.dedup_lines(documents((1, "a. b. c."), (2, "a. b. c.")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def with_versions(docs):
    return docs.withColumn("version", F.hash("text"))


def test_places_are_listed_in_compiled_code(documents):
    """A lambda a place took most of the operator's time."""
    found = lines.fingerprints(with_versions(documents((1, prose(1)))), 2, 16)
    assert re.search(r"\*\(\d+\) Generate explode", found._jdf.queryExecution().executedPlan().toString())


def test_texts_are_cut_after_the_shuffle(documents):
    """Units of a text were shuffled once more after its text, with more bytes."""
    rows = [(i, f"{prose(1)} {prose(10 + i)}") for i in range(4)]
    plan = lines.repeated_ranges(with_versions(documents(*rows)), 2, 25, 16)._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" in plan and "split(" not in plan[plan.index("Join") :]


@pytest.mark.parametrize("window", [1, 2, 3])
def test_selected_places_are_those_of_the_definition(documents, spark, window):
    pick = random.Random(window)
    texts = ["", "one.", "one. two.", "a. b. c.", "x\n" * 30, "p. q. " * 9 + prose(4, 20, 20), prose(2, 90, 200), prose(5) + "\n\n" + prose(5)]
    texts += [pick.choice([" ", "\n"]).join(pick.choice(["a b.", "c.", "d e f!", prose(3, 17, 99)]) for _ in range(pick.randrange(2, 30))) for _ in range(20)]
    docs = with_versions(documents(*enumerate(texts)))
    solid = F.btrim(F.replace("unit", F.lit(" "), F.lit("")), F.lit("\n"))
    cut = docs.select("doc_id", F.posexplode(lines.units(F.col("text"))).alias("i", "unit")).select("doc_id", "i", "unit", F.xxhash64(solid).alias("h"))
    units = {}
    for r in cut.orderBy("doc_id", "i").collect():
        units.setdefault(r["doc_id"], []).append((r["h"], r["unit"].count(" ") + 1))
    two = [(d, i, own[i][0], own[i + 1][0]) for d, own in units.items() for i in range(len(own) - 1)]
    grams = {(d, i): g for d, i, g in spark.createDataFrame(two, "d int, i int, a long, b long").select("d", "i", F.xxhash64("a", "b")).collect()}
    expected = set()
    for d, own in units.items():
        listed = [grams[d, i] for i in range(len(own) - 1)]
        windows = [range(s, min(s + window, len(listed))) for s in range(max(1, len(listed) - window + 1))] if listed else []
        chosen = sorted({i for w in windows for i in w if listed[i] == min(listed[j] for j in w)})
        places = [(listed[i], i, 2) for i in chosen] + [(("alone", h), i, 1) for i, (h, n) in enumerate(own) if n >= 16]
        before = {}
        for gram, i, size in places:
            room = sum(n for _, n in own[max(0, i - lines.REACH) : i + size + lines.REACH])
            expected.add((d, i, size, room, before.get(gram)))
            before[gram] = i
    found = [tuple(r) for r in lines.fingerprints(docs, window, 16).select("doc_id", "pos", "size", "room", "back").collect()]
    assert len(found) == len(set(found)) and set(found) == expected


def test_repeated_rows_are_edited_alike(documents):
    text = f"{prose(1)} {prose(2)}"
    rows = [(1, prose(1)), (2, text), (2, text), (2, text), (3, text)]
    found = sorted((r["doc_id"], r["text"], r["n_deleted"]) for r in lines.dedup_lines(documents(*rows)).collect())
    assert [(d, n) for d, _, n in found] == [(1, 0), (2, 60), (2, 60), (2, 60), (3, 120)] and {t for d, t, _ in found if d == 2} == {prose(2)}
