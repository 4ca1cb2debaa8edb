"""Ranked search against scoring every document, and the limit on accumulators."""

import random
import re
from collections import Counter
from math import floor, log

import numpy as np
import pytest

from ledgerfall.llm import ranked_terms as R
from tests.llm.cases import SCHEMA, awkward, documents, sentence

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k):
    bags = [(i, Counter(terms(text))) for i, text in docs if terms(text)]
    n, total = len(bags), sum(sum(bag.values()) for _, bag in bags)
    df = Counter(t for _, bag in bags for t in bag)
    out = []
    for item, text in items:
        scored = []
        for i, bag in bags:
            m = 100 - 50 + (50 * sum(bag.values()) * n) // total
            score = sum(
                floor(1000 * log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 20 * m))
                for t in set(terms(text)) if t in bag
            )
            if score > 0:
                scored.append((-score, i is not None, i or 0))
        out += [(item, rank, i if named else None, -s) for rank, (s, named, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(docs, items, k, spark):
    queries = spark.createDataFrame([(i, t, "extra") for i, t in items], "item_id long, text string, score string")
    return sorted((tuple(r) for r in R.top_k(docs, queries, k).collect()), key=str)


def vocabulary(seed, words=60):
    return sentence(seed, words).split()


def drawn(seed, count, words):
    choose = random.Random(seed)
    common = vocabulary(5)
    return [" ".join(choose.choices(common, [1 / (j + 1) for j in range(60)], k=choose.randint(1, words))) for _ in range(count)]


@pytest.mark.parametrize("shard", [7, 8192])
def test_against_scoring_all(spark, monkeypatch, shard):
    monkeypatch.setattr(R, "SHARD_DOCS", shard)
    docs = [(i, text) for i, text in enumerate(drawn(1, 300, 40))]
    items = [(i, text) for i, text in enumerate(drawn(2, 12, 15))]
    for k in (1, 5, 50):
        assert found(documents(spark, *docs), items, k, spark) == plain(docs, items, k)


def test_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(R, "BLOCK_TERMS", 10)
    docs = [(i, text) for i, text in enumerate(drawn(3, 60, 30))]
    items = [(i % 5, text) for i, text in enumerate(drawn(4, 7, 12))]  # ids repeat
    assert found(documents(spark, *docs), items, 4, spark) == plain(docs, items, 4)


def test_awkward(spark):
    rows = [*awkward(), (50, "ÀÉ àé A-b_c 1x２ \x00z"), (51, "ÀÉ àé a B C"), (52, "--- !!! \x7f")]
    docs = [(r[0], r[1]) for r in rows]
    items = [(1, "àé ÀÉ b"), (2, None), (3, ""), (4, "two ONE"), (5, sentence(2, 60)), (6, "日本"), (None, "one"), (7, "?!")]
    assert found(documents(spark, *rows), items, 3, spark) == plain(docs, items, 3)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert found(none, [(1, "a")], 3, spark) == []
    assert R.top_k(documents(spark, (1, "a")), spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_accumulators_stop():
    """A rare term's documents lead; what only has the frequent term gets no accumulator, but the leaders are completed."""
    rare = (np.array([3, 9]), np.array([1000, 900]))
    common = (np.arange(100), np.full(100, 50))
    work = R.Work()
    places, scores = R.search_shard([rare, common], 100, 2, 0, work)
    assert dict(zip(places.tolist(), scores.tolist())) == {3: 1050, 9: 950}
    assert (work.created, work.updates_after, work.postings) == (2, 2, 2)


def test_an_equal_bound_does_not_stop():
    """What is left may still reach the k-th score: an equal score counts, ids decide."""
    places, scores = R.search_shard([(np.array([5]), np.array([50])), (np.array([1]), np.array([50]))], 9, 1, 0)
    assert sorted(zip(places.tolist(), scores.tolist())) == [(1, 50), (5, 50)]


def test_a_floor_from_other_shards():
    work = R.Work()
    R.search_shard([(np.arange(9), np.full(9, 10)), (np.arange(9), np.full(9, 5))], 9, 3, 16, work)
    assert work.created == 0
