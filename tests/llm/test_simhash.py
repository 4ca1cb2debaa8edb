"""SimHash against brute force."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerfall.llm import simhash
from ledgerfall.llm.components import components
from tests.llm.cases import awkward, documents, sentence


def expected_fingerprint(text, shingle=3):
    data = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    if not words:
        return 0
    n = min(shingle, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + n]), 42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def expected_components(fps):
    """Least id reachable, by comparing all pairs."""
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= 3:
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(fps):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return [least.get(root(i)) for i in range(len(fps))]


def check(spark, rows):
    got = simhash.near_duplicates(documents(spark, *rows)).collect()
    fps = [(row[0], expected_fingerprint(row[1])) for row in rows]
    wanted = sorted((str(i), f"{fp:016x}", str(c)) for (i, fp), c in zip(fps, expected_components(fps)))
    assert sorted((str(r[0]), r[1], str(r[2])) for r in got) == wanted


def test_awkward_documents(spark):
    check(spark, awkward())


def test_no_documents(spark):
    assert simhash.near_duplicates(documents(spark)).collect() == []
    assert simhash.representatives(documents(spark)).collect() == []


def test_near_copies(spark):
    rows = []
    for i in range(60):
        words = sentence(i % 6, 300).split()
        words[i % 300] = f"edit{i}"
        rows.append((i, " ".join(words)))
    check(spark, rows)


def test_one_of_each_component_stays(spark):
    rows = awkward()
    kept = simhash.representatives(documents(spark, *rows)).collect()
    fps = [(row[0], expected_fingerprint(row[1])) for row in rows]
    members = {}
    for (doc_id, _), component in zip(fps, expected_components([(fp, fp) for _, fp in fps])):
        members.setdefault(component, []).append(doc_id)
    wanted = [min(i for i in ids if i is not None) for ids in members.values() if any(i is not None for i in ids)]
    assert wanted.count(9) == 2  # one id, two texts that are no copies
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == sorted(wanted)
    assert sum(r["doc_id"] is None for r in kept) == 2


@pytest.mark.parametrize("tile", [8, 1024])
def test_buckets_in_tiles_lose_no_link(spark, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE", tile)
    choose = np.random.default_rng(1)
    centre = choose.integers(0, 2**63)
    fps = {int(centre)}
    for _ in range(120):
        fps.add(int(centre) ^ sum(1 << int(b) for b in choose.choice(62, choose.integers(1, 7), replace=False)))
    fps = sorted(fps)
    nodes = spark.createDataFrame([(fp,) for fp in fps], "fp long")
    found = {r["node"]: r["component"] for r in components(simhash.fingerprint_links(nodes)).collect()}
    ours = [found.get(fp, fp) for fp in fps]
    theirs = expected_components(list(zip(fps, fps)))
    assert ours == theirs


def test_pivots_discard_no_link():
    choose = np.random.default_rng(2)
    base = choose.integers(0, 2**64, 300, np.uint64)
    near = base ^ (np.uint64(1) << choose.integers(0, 64, 300, np.uint64))
    fps = np.unique(np.r_[base, near])
    a, b = simhash.links_within(fps)
    assert len(a) == 300 and (np.bitwise_count(fps[a] ^ fps[b]) == 1).all()


def test_long_chain_of_links(spark):
    links = [(i, i + 1) for i in range(400)] + [(1000, 1001), (5, 5)]
    got = {r[0]: r[1] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(401)}, 1000: 1000, 1001: 1000}


def test_the_row_that_stays_is_fixed(spark):
    rows = [(5, "a b c d"), (5, "a b c e f g h"), (5, "a b c d"), (6, "a b c d")]
    found = []
    for order in (rows, rows[::-1]):
        docs = documents(spark, *order).withColumn("seq", F.when(F.col("doc_id") == 5, F.length("text")).otherwise(0))
        found.append(sorted(map(tuple, simhash.representatives(docs.repartition(3)).collect())))
    assert found[0] == found[1] and sorted(r[1] for r in found[0]) == ["a b c d", "a b c e f g h"]
