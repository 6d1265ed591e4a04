from __future__ import annotations

import random
from collections import defaultdict

import pytest

from quayside.llm import mixing


def rows(count=600):
    pick = random.Random(4)
    out = []
    for i in range(count):
        lang = pick.choice(["en", "en", "de", None])
        source = "hot" if pick.random() < 0.4 else pick.choice(["a", "b", "c"])
        out.append((i, "word " * pick.randrange(1, 30), lang, source, None))
    return out


def test_expected_shares_meet_the_targets(documents):
    found = mixing.mix(documents(*rows()), {"source": 0.5, "lang": 0.7}, tolerance=1e-9).collect()
    for dimension, power in (("source", 0.5), ("lang", 0.7)):
        before, after = defaultdict(float), defaultdict(float)
        for r in found:
            before[r[dimension]] += r["tokens"]
            after[r[dimension]] += r["tokens"] * r["probability"]
        raised = {k: v**power for k, v in before.items()}
        for k in raised:
            assert after[k] / sum(after.values()) == pytest.approx(raised[k] / sum(raised.values()), rel=1e-6)
    assert max(r["probability"] for r in found) == pytest.approx(1)
    by_cell = defaultdict(list)
    for r in found:
        by_cell[(r["source"], r["lang"])].append(r)
    assert all(len({r["probability"] for r in cell}) == 1 for cell in by_cell.values())
    share = sum(r["sampled"] for r in found) / sum(r["probability"] for r in found)
    assert 0.85 < share < 1.15


def test_sampling_repeats_and_given_targets(spark, documents):
    docs = documents(*rows())
    targets = {"source": spark.createDataFrame([("=hot", 0.5), ("=a", 0.5)], "category string, share double")}
    first = mixing.mix(docs, {"source": 1.0}, targets, seed=3).select("doc_id", "source", "probability", "sampled").collect()
    again = mixing.mix(docs.repartition(5), {"source": 1.0}, targets, seed=3).select("doc_id", "source", "probability", "sampled").collect()
    assert sorted(first) == sorted(again)
    assert {r["source"] for r in first if r["sampled"]} == {"hot", "a"}
    assert {r["probability"] for r in first if r["source"] in "bc"} == {0.0}


def test_slow_tables_are_raked_to_the_end_and_targets_out_of_reach_are_told(spark, documents):
    def given(**shares):
        return spark.createDataFrame([(f"={k}", v) for k, v in shares.items()], "category string, share double")

    docs = documents(*((i, "word " * n, lang, source, None) for i, (n, source, lang) in enumerate([(300, "a", "x"), (1, "a", "y"), (300, "b", "y")])))
    targets = {"source": given(a=0.55, b=0.45), "lang": given(x=0.45, y=0.55)}
    found = mixing.mix(docs, {"source": 1.0, "lang": 1.0}, targets, tolerance=1e-4).collect()
    mass = {(r["source"], r["lang"]): r["tokens"] * r["probability"] for r in found}
    assert (mass["a", "x"] + mass["a", "y"]) / sum(mass.values()) == pytest.approx(0.55, rel=1e-4)
    assert mass["a", "x"] / sum(mass.values()) == pytest.approx(0.45, rel=1e-4)
    assert all(r["residual"] <= 1e-4 for r in found)

    apart = documents((1, "word " * 10, "x", "a", None), (2, "word " * 10, "y", "b", None))
    with pytest.warns(UserWarning, match="miss their targets"):
        found = mixing.mix(apart, {"source": 1.0, "lang": 1.0}, {"source": given(a=0.5, b=0.5), "lang": given(x=0.9, y=0.1)}).collect()
    assert len(found) == 2 and all(r["residual"] > 0.1 for r in found)


def test_nulls_empty_texts_and_names(spark, documents):
    found = mixing.mix(documents((1, None), (2, ""), (None, "a b"), (3, "a b"), (3, "a b")), {"source": 0.5, "lang": 0.5}).collect()
    assert sorted((r["doc_id"] or 0, r["tokens"], r["probability"], r["sampled"]) for r in found) == [(0, 2, 1.0, True), (1, 0, 1.0, True), (2, 0, 1.0, True), (3, 2, 1.0, True), (3, 2, 1.0, True)]
    assert mixing.mix(documents().limit(0), {"source": 0.5}).collect() == []
    assert [r["probability"] for r in mixing.mix(documents((1, "")), {"source": 0.5}).collect()] == [0.0]
    clash = spark.createDataFrame([(1, "a b", "s", 9.0, 8, 7)], "doc_id long, text string, source string, chance double, d0 int, tokens int")
    row = mixing.mix(clash, {"source": 0.5}).first()
    assert (row["chance"], row["d0"], row["tokens"], row["probability"]) == (9.0, 8, 2, 1.0)


def test_topics(spark, documents):
    vectors = spark.createDataFrame([(1, 4), (1, 2), (None, 3), (9, 9)], "vec_id long, label int")
    found = mixing.with_topic(documents((1, "a"), (2, "b"), (None, "c")), vectors)
    assert sorted((r["text"], r["topic"]) for r in found.collect()) == [("a", 2), ("b", None), ("c", None)]
