from __future__ import annotations

import hashlib
import random
import re

from quayside.llm import decontaminate, queries


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def by_hand(text, items, window=13):
    own, hit, names = words(text), set(), set()
    for name, item in items:
        its = words(item)
        size = min(len(its), window)
        for start in range(len(its) - size + 1 if its else 0):
            for at in range(len(own) - size + 1):
                if own[at : at + size] == its[start : start + size]:
                    hit |= set(range(at, at + size))
                    names |= {str(name)} - {"None"}
    return len(own), len(hit), sorted(names), bool(hit) and 20 * len(hit) >= len(own)


def test_as_by_hand(spark, documents):
    pick = random.Random(3)

    def text(n, vocabulary=30):
        return " ".join(pick.choice(["The", "of", "É", "x1"]) + str(pick.randrange(vocabulary)) for _ in range(n))

    items = [(i, text(pick.choice([4, 13, 14, 30, 45]))) for i in range(8)]
    items += [(20, items[3][1]), (20, items[3][1]), (None, "unnamed item with four"), (21, ""), (22, None), (23, "!!"), (24, "the " * 20), (100, "Two words")]
    rows = []
    for i in range(40):
        parts = [text(pick.randrange(60))]
        for _ in range(pick.randrange(3)):
            its = words(pick.choice(items)[1])
            low = pick.randrange(max(1, len(its) - 10))
            parts.append(pick.choice([", ", "\n", " - "]).join(its[low : low + pick.choice([5, 12, 13, 20, 40])]).upper())
            parts.append(text(pick.randrange(200)))
        rows.append((i, " ".join(parts)))
    rows += [(50, None), (51, ""), (52, "the The THE " * 30), (53, "say unnamed, item with FOUR!"), (None, items[1][1]), (5, rows[5][1]), (5, rows[5][1]), (54, text(20_000) + " two words")]
    rows += [(60, " ".join(text(9, 900) for _ in range(20)) + " two words " * 10), (61, "w " * 18 + "two words"), (62, "w " * 39 + "two words")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contamination(documents(*rows), benchmark).collect()
    shown = sorted(((r["doc_id"] is None, r["doc_id"] or 0, (r["n_words"], r["n_hit"], r["items"], r["contaminated"]), r["n_items"]) for r in found), key=str)
    expected = [(d is None, d or 0, by_hand(t, items)) for d, t in rows]
    assert shown == sorted(((a, b, c, len(c[2])) for a, b, c in expected), key=str)
    assert sum(c[3] for *_, c in expected) > 5


def test_proximity(spark, documents):
    item = " ".join(f"rare{i}" for i in range(20))
    broken = " ".join(f"rare{i}" + (" and" if i % 5 == 4 else "") for i in range(20))
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(1, f"well {broken} then"), (2, f"well {item} then"), (3, "rare1 " + "far " * 100 + "rare2"), (4, "nothing")]
    found = {r["doc_id"]: (r["near"], r["items"]) for r in decontaminate.contamination(documents(*rows), benchmark, lists=13).collect()}
    assert found == {1: (["1"], []), 2: ([], ["1"]), 3: ([], []), 4: ([], [])}


def test_proximity_with_the_defaults(spark, documents):
    items = {n: [f"item{n}w{i}" for i in range(n)] for n in (2, 5, 13, 14, 20, 29, 60)} | {1: ["single"]}
    benchmark = spark.createDataFrame([(n, " ".join(own)) for n, own in items.items()] + [(99, "same same")], "item_id long, text string")

    def broken(own):
        return " ".join(word + (" and" if i % 5 == 4 or len(own) < 5 or i == 1 else "") for i, word in enumerate(own))

    rows = [(n, f"well {broken(own)} then") for n, own in items.items() if n > 1]
    rows += [(100 + n, "well " + (" far" * 30 + " ").join(own) + " then") for n, own in items.items() if n > 1]
    rows += [(200 + n, f"well {' '.join(own)} then") for n, own in items.items()]
    rows += [(300, "the same once"), (301, "the same and same"), (302, None)]
    found = {r["doc_id"]: (r["near"], r["items"]) for r in decontaminate.contamination(documents(*rows), benchmark).collect()}
    expected = {n: ([str(n)], []) for n in items if n > 1} | {100 + n: ([], []) for n in items if n > 1} | {200 + n: ([], [str(n)]) for n in items}
    assert found == expected | {300: ([], []), 301: (["99"], []), 302: ([], [])}


def test_a_query_returns_proximity_matches(spark, tmp_path, documents):
    item = [f"rare{i}" for i in range(20)]
    broken = " ".join(word + (" and" if i % 5 == 4 else "") for i, word in enumerate(item))
    documents((1, f"well {broken} then"), (2, "nothing")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, " ".join(item))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = {r["doc_id"]: (r["n_near"], r["near_sha256"]) for r in queries.QUERIES["op6_proximity"](spark, str(tmp_path)).collect()}
    assert found == {1: (1, hashlib.sha256(b"7").hexdigest()), 2: (0, hashlib.sha256(b"").hexdigest())}


def test_empty_tables_and_clashing_names(spark, documents):
    benchmark = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    assert decontaminate.contamination(documents().limit(0), benchmark).collect() == []
    clean = decontaminate.contamination(documents((1, "one two three")), benchmark.limit(0)).first()
    assert (clean["n_words"], clean["n_hit"], clean["contaminated"]) == (3, 0, False)
    clash = spark.createDataFrame([(1, "one two three", 5, 6, "x")], "doc_id long, text string, version long, n_hit long, items string")
    found = decontaminate.contamination(clash, benchmark).first()
    assert (found["version"], found["n_hit"], found["items"], found["contaminated"]) == (5, 3, ["1"], True)


def test_no_python_and_no_texts_in_the_last_shuffle(documents, spark):
    benchmark = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    found = decontaminate.contamination(documents((1, "one two three")), benchmark)
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
