from __future__ import annotations

import base64
import random
from pathlib import Path

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from quayside.llm import licenses, mtree, tokens


def best_by_hand(rows, asked, k):
    usable = {(i, tuple(int(np.floor(1024 * np.float64(np.float32(x)))) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for q, v in usable:
        if q % asked == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q)
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("count", [3, 1500])
def test_search_as_by_hand(spark, count, monkeypatch):
    pick = np.random.default_rng(10)
    rows = [(int(i), [float(x) for x in pick.normal(size=8) * pick.choice([0.1, 1, 3])]) for i in range(count)]
    same = [float(x) for x in pick.normal(size=8)]
    rows += [(5000 + i, same) for i in range(count // 3)]  # ties
    rows += [(6000, None), (6020, [None, *[1.0] * 7]), (6040, [float("nan")] * 8), (6060, [float("inf")] * 8), (None, same), (6080, [0.5, 0.5]), (6100, []), (20, same), (20, same)]
    monkeypatch.setattr(mtree, "PAGE", 32)
    monkeypatch.setattr(mtree, "GROUP_PAGES", 8)
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, page int")
    found = sorted(tuple(r) for r in mtree.top_k(table, F.col("vec_id") % 20 == 0, k=10, routing=40).collect())
    assert found == best_by_hand(rows, 20, 10)


def test_every_row_is_a_candidate_but_the_query_itself(spark, tmp_path, monkeypatch):
    from quayside.llm.queries import QUERIES

    pick = np.random.default_rng(12)
    rows = [(int(i), [float(x) for x in pick.normal(size=4)]) for i in range(250)]
    rows += [rows[100], rows[100], rows[200], rows[7], rows[7], *[(300, [2.0, 2.0])] * 12, (300, [2.0, 2.0, 0.0]), (300, [-1.0, 0.5, 3.0, 1.0])]
    rows += [(100, [9.0, 9.0, 9.0, 9.0]), (None, [9.0, 9.0, 9.0, 9.0]), (400, None)]
    monkeypatch.setattr(mtree, "PAGE", 32)
    monkeypatch.setattr(mtree, "GROUP_PAGES", 2)
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    whole = [(i, [int(np.floor(1024 * np.float64(np.float32(x)))) for x in v]) for i, v in rows if i is not None and v is not None]
    wanted = []
    for at, (query, v) in enumerate(whole):
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for n, (i, w) in enumerate(whole) if n != at)[:10]
        wanted += [(query, rank, i, -s) for rank, (s, i) in enumerate(scored, 1) if query % 100 == 0]
    found = QUERIES["op3_topk_search"](spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in found) == sorted(wanted)


def test_search_in_an_empty_table(spark):
    table = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert mtree.top_k(table, F.lit(True)).collect() == []
    one = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<float>")
    assert mtree.top_k(one, F.lit(True)).collect() == []
    assert mtree.top_k(one, F.lit(False)).collect() == []


def test_pruning_skips_pages_but_no_result(monkeypatch):
    import pandas as pd

    pick = np.random.default_rng(11)
    vectors = np.rint(np.vstack([pick.normal(size=(50, 4)) + 40 * c for c in pick.normal(size=(20, 4))]) * 10).astype(np.int64)
    longest = float((vectors**2).sum(axis=1).max())
    lifted = mtree.lifted(vectors, longest)
    pages = []
    for at in range(0, 1000, 50):
        centre = lifted[at : at + 50].mean(axis=0)
        apart = mtree.distances(lifted[at : at + 50], centre[None, :])[:, 0]
        pages.append((centre.tolist(), apart.max(), list(range(at, at + 50)), vectors[at : at + 50].ravel().tolist(), apart.tolist()))
    frame = pd.DataFrame(pages, columns=["centre", "radius", "ids", "entries", "apart"])
    looked = []
    plain = mtree.products
    monkeypatch.setattr(mtree, "products", lambda a, b, e: looked.append(len(b)) or plain(a, b, e))
    queries = pd.DataFrame({"query_id": [0], "key": [1], "v": [vectors[0].tolist()], "least": [-np.inf]})
    found = mtree.best_first(frame, queries, 5, 4, longest)
    scores = vectors @ vectors[0]
    order = sorted((-s, i) for i, s in enumerate(scores.tolist()) if i)[:5]
    assert list(zip(found["score"], found["vec_id"])) == [(-s, i) for s, i in order]
    assert sum(looked) < 500


VOCABULARY = Path(tokens.VOCABULARY)


@pytest.mark.skipif(not VOCABULARY.exists(), reason="no vocabulary")
@pytest.mark.parametrize("rule", tokens.RULES)
def test_tokens_as_by_hand(spark, documents, rule):
    pick = random.Random(12)
    pool = ["word", "Ünïcödé", "𝔘𝔫", "\n", "\n\n\n", " ", "  \n ", "'ll", "1234", "\r\n", "!?", "漢字", "x" * 300]
    rows = [(i, "".join(pick.choice(pool) for _ in range(pick.randrange(60)))) for i in range(60)] + [(100, None), (101, ""), (None, "no id\n"), (3, "twice"), (3, "twice"), (102, "long line " * 30_000)]
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in VOCABULARY.read_bytes().splitlines())}
    encoding = tiktoken.Encoding("test", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = []
    for doc, text in rows:
        if text is None:
            continue
        owner = []
        section = 0
        for c in text:
            owner.append(section)
            section += c == "\n"
        count = (owner[-1] if owner else 0) + 1
        sums, over = [0] * count, [0] * count
        per_byte = [o for c, o in zip(text, range(len(text))) for _ in c.encode()]
        at = 0
        for token in encoding.encode_ordinary(text):
            size = len(encoding.decode_single_token_bytes(token))
            inside = [owner[c] for c in range(per_byte[at], per_byte[at + size - 1] + 1)]
            at += size
            chosen = {"first": inside[0], "last": inside[-1], "most": max(dict.fromkeys(inside), key=inside.count)}[rule]
            sums[chosen] += 1
            over[chosen] += inside[0] != inside[-1]
        expected += [(str(doc), i, n, o) for i, (n, o) in enumerate(zip(sums, over))]
    found = tokens.section_counts(documents(*rows), rule=rule).collect()
    assert sorted((str(r["doc_id"]), r["section"], r["tokens"], r["crossing"]) for r in found) == sorted(expected)
    whole = {d: t for d, t in rows if d != 3}
    for r in found:
        if r["doc_id"] != 3 and whole[r["doc_id"]]:
            line = whole[r["doc_id"]][r["start"] : r["end"]]
            assert line and "\n" not in line[:-1]


def test_tokens_of_an_empty_table_and_a_wrong_rule(documents):
    assert tokens.section_counts(documents().limit(0)).collect() == []
    with pytest.raises(ValueError):
        tokens.section_counts(documents((1, "a")), rule="middle")


def test_each_template_is_found_among_others(documents):
    pick = random.Random(13)
    filler = [" ".join(f"w{pick.randrange(99)}" for _ in range(40)) for _ in licenses.TEMPLATES]
    rows = [(i, f"{a}\n{text}\n{a}") for i, (a, text) in enumerate(zip(filler, licenses.TEMPLATES.values()))]
    found = licenses.scan_licenses(documents(*rows)).collect()
    assert sorted((r["doc_id"], r["license"], r["exact"], r["missing"], r["added"]) for r in found) == [(i, name, True, [], []) for i, name in enumerate(licenses.TEMPLATES)]
    assert all(r["given_bytes"] < r["plain_bytes"] for r in found)
    assert all(rows[r["doc_id"]][1][r["start"] :].startswith(licenses.TEMPLATES[r["license"]][:20]) for r in found)


def test_changed_wordings_two_notices_and_odd_rows(spark):
    changed = licenses.TEMPLATES["MIT-permission"].replace("free of charge", "free of any charge").upper()
    both = "RELEASED under the mit license. Some words between. Licensed under CC BY-SA 4.0."
    rows = [(1, changed), (2, both), (3, "Ask for a license before you use this."), (None, "All rights reserved."), (4, None), (5, ""), (6, "a " * 200_000 + "All rights reserved."), (6, "All rights reserved."), (6, "All rights reserved.")]
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, license string, start int")
    found = licenses.scan_licenses(docs).collect()
    assert sorted((str(r["doc_id"]), r["start"], r["license"], r["missing"], r["added"], r["exact"]) for r in found) == [
        ("1", 0, "MIT-permission", [], ["any"], False),
        ("2", 0, "MIT", [], [], True),
        ("2", 52, "CC-BY-SA-4.0", [], [], True),
        ("6", 0, "rights-reserved", [], [], True),
        ("6", 0, "rights-reserved", [], [], True),
        ("6", 400_000, "rights-reserved", [], [], True),
        ("None", 0, "rights-reserved", [], [], True),
    ]
    assert licenses.scan_licenses(docs.limit(0)).collect() == []


def test_wrapped_and_commented_notices(documents):
    permission = licenses.TEMPLATES["MIT-permission"]
    wrapped = ["All rights\nreserved.", "# All rights\r\n#   reserved.", "/* All rights\n *\treserved. */", "All rights\u00a0reserved.", "_All rights_ _reserved._"]
    rows = [(i, f"x = 1\n{text}\ny = 2") for i, text in enumerate(wrapped)]
    rows += [(10, permission.replace("hereby granted", "hereby\ngranted")), (11, "# " + permission.replace("hereby ", "hereby\n# ").replace("copy ", "copy\n# "))]
    found = licenses.scan_licenses(documents(*rows)).collect()
    expected = [(i, "rights-reserved", True) for i in range(len(wrapped))] + [(i, "MIT-permission", True) for i in (10, 11)]
    assert sorted((r["doc_id"], r["license"], r["exact"]) for r in found) == expected


def test_notices_in_a_row_are_found_one_by_one_whatever_the_length(documents):
    """Half a megabyte of notices without a paragraph between them: each at its place, as when it stands alone."""
    pick = random.Random(14)
    names, text, expected = list(licenses.TEMPLATES), "", []
    while len(text) < 500_000:
        name = pick.choice(names)
        expected.append((len(text), name))
        text += licenses.TEMPLATES[name] + pick.choice([" ", "\n", " ; ", " and so on "])
    found = licenses.scan_licenses(documents((1, text))).collect()
    assert [(r["start"], r["license"]) for r in found] == expected and all(r["exact"] for r in found)


def test_a_block_of_several_windows_is_cut_between_notices():
    """Whatever stands before it, a notice is found whole, also where a window ends in it."""
    scanner = licenses.Scanner(licenses.TEMPLATES, 0.2)
    header = licenses.TEMPLATES["Apache-2.0-header"]
    for n in range(0, 4 * scanner.reach, 7):
        before = ("licence " * 500)[: 2 * scanner.reach + n]
        found = scanner.scan(before + " " + header + " licence" * 300)
        assert [(r[0], r[1], r[-1]) for r in found] == [(len(before) + 1, "Apache-2.0-header", True)], n
    assert scanner.scan("licence " * 50_000) == []
