from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from quayside.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def by_hand(docs, items, k):
    counts = [(i, Counter(terms_of(t))) for i, t in docs]
    n_docs = sum(bool(c) for _, c in counts)
    length = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = defaultdict(set)
    for item, text in items:
        if item is not None:
            asked[item] |= set(terms_of(text))
    out = []
    for item, terms in asked.items():
        scored = []
        for doc, c in counts:
            m = 50 + 50 * sum(c.values()) * n_docs // length if length else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if c[t])
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank + 1, doc, -score) for rank, (score, _, _, doc) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out)


def corpus(seed, count):
    pick = random.Random(seed)
    word = lambda: pick.choice(["é", "Wort", "x", "the", "ü2"]) + str(int(pick.expovariate(0.05)))
    docs = [(i, pick.choice([" ", "-", ", "]).join(word() for _ in range(pick.randrange(0, 60)))) for i in range(count)]
    docs += [(count + i, docs[3][1]) for i in range(30)]  # ties
    docs += [(5, "the0 again"), (5, "the0 again"), (None, docs[4][1]), (-7, docs[4][1]), (900, None), (901, ""), (902, "... !"), (903, "The0 " * 50_000 + "x1")]
    items = [(i, " ".join(word() for _ in range(pick.randrange(1, 25)))) for i in range(25)]
    items += [(30, " ".join(f"the{j} x{j} Wort{j}" for j in range(60))), (31, None), (32, "?"), (33, "nowhere at all"), (None, "the0"), (34, "THE0 the0"), (35, "x1"), (35, "x2")]
    return docs, items


@pytest.mark.parametrize("k, batch_terms", [(3, 200_000), (50, 40)])
def test_as_by_hand(spark, settings, k, batch_terms):
    settings(spark__sql__execution__arrow__maxRecordsPerBatch="70")
    docs, items = corpus(1, 400)
    found = lexical.search(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"), k=k, batch_terms=batch_terms,
    )
    assert sorted((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in found.collect()) == by_hand(docs, items, k)


def test_other_ids_clashing_names_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b", 1, 2, 3), (2, "b c", 1, 2, 3), (3, "d", 1, 2, 3)], "doc_id int, text string, term int, score int, item_id int")
    items = spark.createDataFrame([("p", "a c", 1, 2), ("q", "zzz", 1, 2)], "item_id string, text string, doc_id int, rank int")
    rows = [(1, "a b"), (2, "b c"), (3, "d")]
    assert sorted(map(tuple, lexical.search(docs, items).collect())) == by_hand(rows, [("p", "a c")], 50)
    assert lexical.search(docs.limit(0), items).collect() == []
    assert lexical.search(docs, items.limit(0)).collect() == []
    assert lexical.search(docs.selectExpr("doc_id", "CAST(NULL AS STRING) AS text"), items).collect() == []


def test_masks_that_cannot_win_are_not_evaluated():
    pick = np.random.default_rng(3)
    held = pick.random((40, 5000)) < np.linspace(0.001, 0.7, 40)[:, None]  # rare terms first
    docs = np.concatenate([np.flatnonzero(own) for own in held])
    row = {
        "ids": np.arange(5000), "none": np.zeros(5000, bool), "sizes": np.full(5000, 100), "terms": np.arange(40),
        "starts": np.concatenate([[0], np.cumsum(held.sum(axis=1))[:-1]]), "docs": docs, "times": np.ones(len(docs), np.int64),
    }
    weights = np.array([math.floor(1000 * math.log(10002 / (2 * n + 1))) for n in held.sum(axis=1)])
    block, best = lexical.Block(row, lexical.Weights(5000, 500_000, weights)), lexical.Best(10)
    looked = block.search(np.arange(0, 40, 2), best)
    full = block.scores(np.arange(5000), np.arange(0, 40, 2))
    order = np.lexsort((np.arange(5000), -full))[:10]
    assert list(best.ids) == list(order) and list(best.scores) == list(full[order])
    assert looked < 1000
