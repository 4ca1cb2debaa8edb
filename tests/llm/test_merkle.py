"""The manifest against plain hashing of every tree, and its hash arithmetic against hashlib."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerfall.llm import merkle
from tests.llm.cases import SCHEMA, awkward, documents, sentence


def H(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, lowered=False):
    text = row["text"]
    if lowered and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return H("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def grown(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def proof(levels, i):
    found = []
    for level in levels[:-1]:
        run = level[i // 16 * 16 : i // 16 * 16 + 16]
        found += run[: i % 16] + run[i % 16 + 1 :]
        i //= 16
    return found


def plain(rows):
    rows = [r.asDict() for r in rows]
    by_source = {}
    for r in rows:
        by_source.setdefault(r["source"], []).append(r)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in sources:
        by_source[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees.append(grown([leaf(r) for r in by_source[s]]))
    top = grown([t[-1][0] for t in trees])
    out = []
    for k, s in enumerate(sources):
        for i, r in enumerate(by_source[s]):
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
            changed = list(trees[k][0])
            changed[i] = leaf(r, hit)
            roots = [t[-1][0] for t in trees]
            roots[k] = grown(changed)[-1][0]
            folded = grown(roots)[-1][0]
            full = proof(trees[k], i) + proof(top, k)
            out.append((r["doc_id"], trees[k][0][i], trees[k][-1][0], top[-1][0], H(full), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def tampered():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def check(docs):
    found = [tuple(r) for r in merkle.document_proofs(docs, tampered()).collect()]
    assert sorted(found, key=str) == plain(docs.collect())


def test_states_resume():
    rng = np.random.default_rng(1)
    children, counts = rng.integers(0, 256, (200, 16, 32), dtype=np.uint8), rng.integers(1, 17, 200)
    digests, states = merkle.parents(children, counts)
    text = lambda some: b"".join(x.tobytes().hex().encode() for x in some)
    assert all(d.tobytes() == hashlib.sha256(text(c[:n])).digest() for d, c, n in zip(digests, children, counts))
    slot, new = (rng.random(200) * counts).astype(int), rng.integers(0, 256, (200, 32), dtype=np.uint8)
    folded = merkle.Run(children, states, counts).fold(np.arange(200), slot, new)
    children[np.arange(200), slot] = new
    assert all(d.tobytes() == hashlib.sha256(text(c[:n])).digest() for d, c, n in zip(folded, children, counts))


@pytest.mark.parametrize("of_one", [1, 16, 17, 300])
def test_against_plain_hashing(spark, of_one):
    """A source of that many rows beside small ones, one without a name, one of a single row."""
    choose = random.Random(of_one)
    rows = [(i, sentence(i, 6).title(), "hot") for i in range(of_one)]
    rows += [(1000 + i, sentence(i, 3).upper(), choose.choice(["é", "Z", None, "a"])) for i in range(40)]
    check(documents(spark, *rows, (7, "Alone", "lone")))


def test_one_source(spark):
    check(documents(spark, *((i, f"Text {i}", "s") for i in range(20))))
    check(documents(spark, (5, "Only", None)))


def test_awkward_rows(spark):
    check(documents(spark, *awkward(), *awkward()[:8], (None, None, "zz")))


def test_no_rows(spark):
    assert merkle.document_proofs(spark.createDataFrame([], SCHEMA), tampered()).count() == 0


def test_a_parent_keeps_no_right_sibling_in_its_state(spark):
    """The states of two parents that differ from some slot on are equal up to it."""
    rows = lambda last: documents(spark, *((i, "x" if i < 9 else last, "s") for i in range(12)))
    a, b = (bytes(merkle.manifest_of(rows(x), tampered()).levels[0].first()["states"]) for x in ("y", "z"))
    assert a[: 10 * 32] == b[: 10 * 32] and a[10 * 32 :] != b[10 * 32 :] and len(a) == 12 * 32
