"""Quality classifier, language ID and LM scoring: held-out accuracy, and plain versions of the formulas."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from quayside.llm import langid, quality, scoring

SYLLABLES = {"en": ["th", "er", "on", "ing", "ous"], "de": ["sch", "ung", "ver", "keit", "ein"], "fr": ["eau", "eux", "tre", "ment", "elle"]}


def text(pick, lang, n):
    return " ".join("".join(pick.choice(SYLLABLES[lang]) for _ in range(pick.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def graded_rows():
    pick = random.Random(5)
    rows = []
    for i in range(600):
        grade = pick.choice([0, 1, 2, 2, 2])
        words = text(pick, "en", pick.randrange(20, 200)).split()
        for _ in range(4):
            words.insert(pick.randrange(len(words)), {0: "awful", 1: "||| ###", 2: "and"}[grade])
        rows.append((i, " ".join(words), grade))
    return rows


def test_quality_on_held_out_documents(spark, graded_rows):
    docs = spark.createDataFrame(graded_rows, "doc_id long, text string, grade int")
    model = quality.train(docs.drop("grade"), docs.where("doc_id % 2 = 0").select("doc_id", "grade"))
    assert model.grades == (0.0, 1.0, 2.0) and model.thresholds[0] < model.thresholds[1]
    found = quality.graded(docs, model, keep_grade=2).where("doc_id % 2 = 1").collect()
    assert np.mean([r["keep"] == (r["grade"] == 2) for r in found]) > 0.97
    for r in found:
        assert 1 >= r["tails"][0] >= r["tails"][1] >= 0 and r["expected_grade"] == pytest.approx(sum(r["tails"]))


def test_quality_gradient_is_that_of_the_loss():
    pick = np.random.default_rng(6)
    rows, features = np.repeat(np.arange(30), 3), pick.integers(0, 5, 90)
    grades = pick.integers(0, 3, 30)
    weights, thresholds = quality.fit(rows, features, grades, 5, 0.01, 4000)

    def loss(w, t):
        score = np.bincount(rows, weights=w[features], minlength=30)
        below = 1 / (1 + np.exp(-(t[None, :] - score[:, None])))
        chance = np.diff(np.hstack([np.zeros((30, 1)), below, np.ones((30, 1))]), axis=1)[np.arange(30), grades]
        return -np.log(chance).mean() + 0.005 * (w**2).sum()

    best = loss(weights, thresholds)
    for i in range(5):
        for step in (-0.05, 0.05):
            assert loss(weights + step * np.eye(5)[i], thresholds) >= best - 1e-6
    assert all(loss(weights, thresholds + np.array(d)) >= best - 1e-6 for d in ([0.05, 0], [-0.05, 0], [0, 0.05], [0, -0.05]))


def test_quality_odd_rows(spark, graded_rows):
    docs = spark.createDataFrame(graded_rows, "doc_id long, text string, grade int").drop("grade")
    ratings = spark.createDataFrame([(1, None), (None, 2), (-5, 1), (3, 2), (3, 0), (4, 2)], "doc_id long, grade int")
    model = quality.train(docs, ratings)
    assert model.grades == (0.0, 2.0)
    assert quality.train(docs, ratings.where("doc_id = 4")).grades == (2.0,)
    assert quality.train(docs, ratings.limit(0)).grades == ()
    odd = spark.createDataFrame([(None, None, 1.0, "a"), (1, "", 2.0, "b"), (1, "", 2.0, "b"), (2, "x " * 200_000, 3.0, "c")], "doc_id long, text string, score double, keep string")
    for m in (model, quality.train(docs, ratings.limit(0))):
        found = quality.graded(odd, m, keep_grade=2).collect()
        assert len(found) == 4 and sorted(r["score"] for r in found) == [1.0, 2.0, 2.0, 3.0]
        assert all(isinstance(r["keep"], bool) for r in found)
    assert quality.graded(odd.limit(0), model, 2).collect() == []


def test_repeated_ids_do_not_pass_the_bound_on_training_rows(spark, graded_rows, monkeypatch):
    docs = spark.createDataFrame(graded_rows, "doc_id long, text string, grade int")
    ratings, texts = docs.select("doc_id", "grade"), docs.select("doc_id", "text")
    sizes = []

    def counted(rows, features, seen, grades):
        sizes.append(len(grades))
        return associated(rows, features, seen, grades)

    associated = quality.associated
    monkeypatch.setattr(quality, "associated", counted)
    plain = quality.train(texts, ratings)
    repeated = texts.union(texts.where("doc_id = 3").join(spark.range(500)).drop("id"))
    assert quality.train(repeated, ratings) == plain
    hot = texts.union(spark.range(900).selectExpr("3L", "concat('other text ', id)"))
    quality.train(hot, ratings)
    quality.train(hot, ratings, train_rows=700)
    assert sizes == [600, 600, 1500, 700]


def test_languages_of_held_out_documents(spark):
    pick = random.Random(7)
    rows = [(i, text(pick, lang, pick.randrange(5, 80)), lang) for i in range(300) for lang in [pick.choice(list(SYLLABLES))]]
    rows += [(1000, text(pick, "de", 60) + " " + text(pick, "fr", 20), "de"), (1001, "?! 123", "en"), (1002, None, "en"), (1003, "", "en"), (None, text(pick, "fr", 30), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    filters = langid.train(docs.where(~langid.held_out()))
    assert filters.languages == ("de", "en", "fr") and all(rate < 0.2 for rate in filters.rates)
    found = langid.identify(docs, filters).collect()
    truth = {d: lang for d, _, lang in rows} | {1001: "und", 1002: "und", 1003: "und", None: "fr"}
    assert len(found) == len(rows)
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in found]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in found)
    assert langid.identify(docs.limit(0), filters).collect() == []
    assert {r["lang_pred"] for r in langid.identify(docs, langid.train(docs.limit(0))).collect()} == {"und"}


def test_filters_hold_every_member_and_pieces_add_up():
    pick = random.Random(8)
    long = text(pick, "fr", 300_000)
    assert len(long) > langid.PIECE
    assert Counter(langid.grams(long).tolist()) == sum((Counter(langid.grams(p).tolist()) for p in langid.pieces(long)), Counter())
    assert "".join(langid.pieces(long)) == long


def test_many_languages_need_more_than_one_mask(spark):
    rows = [(i, f"zz{chr(97 + i // 26)}{chr(97 + i % 26)} " * 3, f"l{i:03}") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs, langid.train(docs)).collect()}
    assert found == {i: lang for i, _, lang in rows}


def test_languages_without_letters_and_number_signs(spark):
    rows = [(1, "hello world", "en"), (2, "123", "fr"), (3, "", "fr"), (4, "½ ² ⅷ ①", "de"), (5, "guten tag", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    only_numbers = langid.train(docs.where("lang = 'fr'"))
    assert only_numbers.languages == ("fr",) and langid.judge("hello", only_numbers) == ("fr", 0.0)
    filters = langid.train(docs)
    assert filters.languages == ("de", "en", "fr")
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(docs, filters).collect()}
    assert found == {1: ("en", 1.0), 2: ("und", 0.0), 3: ("und", 0.0), 4: ("und", 0.0), 5: ("de", 1.0)}


def test_filters_agree_with_plain_sets(spark):
    """Popcounts less false positives against sets of n-grams, for rare words and short texts too."""
    pick = random.Random(12)
    rows = [(i, text(pick, lang, pick.randrange(5, 60)), lang) for i in range(200) for lang in [pick.choice(list(SYLLABLES))]] + [(900, "qzx rare", "fr"), (901, "rare qzx", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    filters = langid.train(docs, least_docs=2, least_ratio=0.0)
    sets = {lang: Counter(g for _, t, of in rows if of == lang for g in set(langid.grams(t).tolist())) for lang in SYLLABLES}
    asked = [*[text(pick, lang, n) for lang in SYLLABLES for n in (1, 2, 3, 40)], "qzx", "never zzz"]
    for t in asked:
        grams = langid.grams(t).tolist()
        shares = {lang: sum(c[g] >= 2 for g in grams) / len(grams) for lang, c in sets.items()}
        lang, score = langid.judge(t, filters)
        assert score == pytest.approx(max(shares.values()), abs=0.05) and shares[lang] >= max(shares.values()) - 0.05, t
    assert langid.judge("qzx", filters)[0] == "fr"


def test_a_dirty_language_column_is_bounded(spark):
    rows = [(i, "some words here", f"junk {i}") for i in range(50)] + [(100 + i, "autres mots", "fr") for i in range(5)]
    filters = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), most_languages=3)
    assert filters.languages == ("fr", "junk 0", "junk 1")


def test_scores_as_by_hand(spark):
    pick = random.Random(9)
    rows = [(i, text(pick, "en", pick.randrange(1, 40)).upper() if i % 3 else text(pick, "de", 20), i % 3 == 0) for i in range(60)]
    rows += [(100, None, True), (101, "", None), (None, "THE end", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, target boolean")
    found = scoring.score(docs, scoring.train(docs, least_share=0.01, least_pair_share=0.002)).collect()

    everything = [([w.lower() for w in (t or "").split()], bool(target)) for _, t, target in rows]
    words, pairs = [Counter(), Counter()], [Counter(), Counter()]
    for own, target in everything:
        for model in (0, 1) if target else (1,):
            words[model].update(own)
    total = [sum(c.values()) for c in words]
    vocabulary = {w for w, n in words[1].items() if n >= 0.01 * total[1]}
    for own, target in everything:
        for model in (0, 1) if target else (1,):
            pairs[model].update((a, b) for a, b in zip(own, own[1:]) if a in vocabulary and b in vocabulary)
    kept = {p for p, n in pairs[1].items() if n >= 0.002 * total[1]}

    def loss(own, model):
        rest = total[model] - sum(words[model][w] for w in vocabulary)
        norm = total[model] + 0.5 * (len(vocabulary) + 1)
        sums = 0.0
        for before, w in zip([None, *own], own):
            alone = ((words[model][w] if w in vocabulary else rest) + 0.5) / norm
            if before in vocabulary and words[model][before] > 0:
                after = pairs[model][before, w] / words[model][before] if (before, w) in kept else 0
                alone = 0.5 * after + 0.5 * alone
            sums -= math.log(alone)
        return sums / len(own)

    by_id = {r["doc_id"]: r for r in found}
    assert len(found) == len(rows)
    for (d, t, _), (own, _) in zip(rows, everything):
        r = by_id[d]
        assert r["n_words"] == len(own)
        if own:
            assert r["target_loss"] == pytest.approx(loss(own, 0)) and r["background_loss"] == pytest.approx(loss(own, 1))
            assert r["difference"] == pytest.approx(r["target_loss"] - r["background_loss"])
        else:
            assert r["difference"] is None
    assert np.mean([by_id[i]["difference"] for i in range(0, 60, 3)]) < np.mean([by_id[i]["difference"] for i in range(1, 60, 3)])


def test_scores_without_a_corpus(spark):
    docs = spark.createDataFrame([(1, "a b", True)], "doc_id long, text string, target boolean")
    assert scoring.score(docs, scoring.train(docs.limit(0))).first()["difference"] is None
    assert scoring.score(docs.limit(0), scoring.train(docs)).collect() == []


def test_rare_words_and_pairs_count_at_any_size(spark):
    """A word that makes up less than 1e-5 of all words, in the target only, and pairs of it."""
    pick = random.Random(10)
    filler = [(i, " ".join(f"w{pick.randrange(40)}" for _ in range(10_000)), False) for i in range(30)]
    own = [(1000, "zebra quagga", True), (1001, "w1 w2", True)]
    docs = spark.createDataFrame([*filler, *own], "doc_id long, text string, target boolean")
    models = scoring.train(docs)
    asked = spark.createDataFrame([(1, "zebra quagga"), (2, "quagga zebra"), (3, "never seen"), (4, "w1 never w2"), (5, "zebra quagga"), (6, None)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in scoring.score(asked, models).collect()}

    words, pairs = [Counter(), Counter()], [Counter(), Counter()]
    for _, t, target in [*filler, *own]:
        for model in (0, 1) if target else (1,):
            words[model].update(t.split())
            pairs[model].update(zip(t.split(), t.split()[1:]))

    def loss(t, model):
        total, sums = sum(words[model].values()), 0.0
        for before, w in zip([None, *t.split()], t.split()):
            p = (words[model][w] + 0.5) / (total + 0.5 * (len(words[1]) + 1))
            if words[model][before]:
                p = 0.5 * pairs[model][before, w] / words[model][before] + 0.5 * p
            sums -= math.log(p)
        return sums / len(t.split())

    for r in asked.where("text IS NOT NULL").collect():
        got = found[r["doc_id"]]
        assert got["n_words"] == len(r["text"].split())
        assert got["target_loss"] == pytest.approx(loss(r["text"], 0)) and got["background_loss"] == pytest.approx(loss(r["text"], 1))
    assert found[6]["n_words"] == 0 and found[6]["difference"] is None
    assert found[5]["n_words"] == 2 and found[5]["difference"] == pytest.approx(found[1]["difference"])


def test_scores_do_not_depend_on_batches_and_ranges(spark, monkeypatch):
    pick = random.Random(12)
    rows = [(i, text(pick, "en", pick.randrange(0, 60)), i % 3 == 0, "x", 1) for i in range(80)]
    rows += [(200, "long " * 5000 + "end", False, "y", 2), (200, "long " * 5000 + "end", False, "y", 2), (201, "  ", True, None, None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, target boolean, batch string, size int").coalesce(2)
    whole = {tuple(r) for r in scoring.score(docs, scoring.train(docs, least_share=0.001)).collect()}
    asked = docs.drop("target").where("doc_id < 30 OR doc_id > 100")
    apart = {tuple(r) for r in scoring.score(asked, scoring.train(docs, least_share=0.001)).collect()}
    monkeypatch.setattr(scoring, "AT_ONCE", 100)
    monkeypatch.setattr(scoring, "PER_RANGE", 500)
    packs = scoring.batches(docs.selectExpr("doc_id AS id", "CAST(text AS BINARY) AS text", "5 AS kind"))
    assert packs.count() > 10 and packs.agg({"n_words": "sum"}).first()[0] == packs.agg({"n_counted": "sum"}).first()[0]
    cut = {tuple(r) for r in scoring.score(docs, scoring.train(docs, least_share=0.001)).collect()}
    for found in (cut, apart):
        mine = {r[0]: r for r in whole if any(r[0] == other[0] for other in found)}
        assert len(found) == len(mine)
        for r in found:
            assert r == pytest.approx(mine[r[0]]) if r[2] is not None else r == mine[r[0]]
    assert {r[0]: r[1] for r in cut}[200] == 5001 and {r[0]: r[2] for r in cut}[201] is None
