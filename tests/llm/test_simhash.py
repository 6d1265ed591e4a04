from __future__ import annotations

import random
from collections import Counter

import xxhash

from quayside.llm import simhash
from quayside.llm.components import components


def by_hand(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def groups_by_hand(rows):
    prints = [by_hand(text) for _, text in rows]
    group = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if bin(a ^ b).count("1") <= 3:
                    group[i] = group[j] = min(group[i], group[j])
    ids = {g: min((d for (d, _), h in zip(rows, group) if h == g and d is not None), default=None) for g in group}
    return Counter((d, f"{p:016x}", ids[g]) for (d, _), p, g in zip(rows, prints, group))


def test_near_duplicates_as_by_hand(documents):
    pick = random.Random(1)
    base = [f"word{pick.randrange(500)}" for _ in range(400)]
    rows = [(None, "Nobody knows"), (7, None), (3, ""), (9, " \t\x0b "), (4, "Ää BB"), (4, "Ää bb"), (4, "Ää bb"), (8, "Ää bb cc dd ee")]
    for i in range(40):
        words = list(base)
        for _ in range(i % 4):
            words[pick.randrange(400)] = f"other{i}"
        rows.append((100 + i, " ".join(words)))
    rows += [(200 + i, " ".join(f"w{pick.randrange(9)}" for _ in range(6))) for i in range(40)]
    rows.append((300, "long " * 50_000))
    found = simhash.near_duplicates(documents(*rows))
    shown = Counter((r["doc_id"], f"{r['print'] & (1 << 64) - 1:016x}", r["component_id"]) for r in found.collect())
    assert shown == groups_by_hand(rows)


def test_links_lose_no_pair(spark):
    pick = random.Random(2)
    values = {pick.getrandbits(64) for _ in range(40)}
    for value in list(values):
        for bits in (1, 2, 3, 4):
            values.add(value ^ sum(1 << b for b in pick.sample(range(64), bits)))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    table = spark.createDataFrame([(v,) for v in [*signed, *signed[:3], None]], "print long")
    found = {frozenset((r["a"], r["b"])) for r in simhash.links(table, 3).collect()}
    mask = (1 << 64) - 1
    assert found == {frozenset((a, b)) for a in signed for b in signed if a != b and bin((a ^ b) & mask).count("1") <= 3}


def test_keep_one_of_each_group(spark, documents):
    rows = [(5, "a b c d e"), (2, "a b c d e"), (2, "a b c d e"), (None, "a b c d e"), (1, "other words are here"), (None, "no id at all x"), (9, None), (8, "")]
    kept = simhash.keep_one(documents(*rows))
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter([(2, "a b c d e"), (1, "other words are here"), (None, "no id at all x"), (8, "")])


def test_clashing_names_and_empty_tables(spark, documents):
    empty = documents().limit(0)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0
    clash = spark.createDataFrame([(1, "x y z", 5, 6, 7), (2, "x y z", 5, 6, 7)], "doc_id long, text string, row long, id long, root long")
    assert [tuple(r) for r in simhash.keep_one(clash).collect()] == [(1, "x y z", 5, 6, 7)]


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 40)] + [(None, 7), (50, 50)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 100 for i in range(100, 161)} | {i: 7 for i in range(7, 40)} | {50: 50}
