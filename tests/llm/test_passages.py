"""Removal of repeated passages against brute force."""

import hashlib
import random

import numpy as np
import pytest

from ledgerfall.llm import passages
from tests.llm.cases import awkward, documents, sentence


def expected(rows, window):
    """Results per (id, text), documents in order; equal rows are one document."""
    order = sorted({(i, t or "") for i, t, *_ in rows}, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    seen, out = set(), {}
    for key in order:
        words = key[1].encode().split()
        gone = [False] * len(words)
        for s in range(len(words) - window + 1):
            piece = tuple(words[s : s + window])
            if piece in seen:
                gone[s : s + window] = [True] * window
            seen.add(piece)
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out[key] = (len(words), sum(gone), hashlib.sha256(kept).hexdigest(), kept.decode())
    return sorted((str(i), *out[(i, t or "")]) for i, t, *_ in rows)


def check(spark, rows, window=20):
    got = passages.without_repeats(documents(spark, *rows), window).collect()
    assert sorted((str(r[0]), *tuple(r)[1:]) for r in got) == expected(rows, window)


def test_awkward_documents(spark):
    # Texts that share an id are in the order of a hash, so only one of them repeats something here.
    check(spark, awkward())


def test_no_documents(spark):
    assert passages.without_repeats(documents(spark)).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_overlapping_passages(spark, seed):
    choose = random.Random(seed)
    pool = [sentence(1000 + i, choose.randint(15, 90)).split() for i in range(6)]
    rows = []
    for i in range(40):
        words = []
        for _ in range(choose.randint(0, 6)):
            source = choose.choice(pool)
            a = choose.randrange(len(source))
            words += source[a : a + choose.randint(1, 60)] if choose.random() < 0.8 else sentence(choose.random(), 5).split()
        rows.append((i, " ".join(words)))
    check(spark, rows)


@pytest.mark.parametrize("window", [1, 3, 8, 25])
def test_few_words_and_other_windows(spark, window):
    choose = random.Random(window)
    rows = [(i, " ".join(choose.choice("ab") for _ in range(choose.randint(0, 50)))) for i in range(12)]
    check(spark, rows, window)


def test_small_shards(spark, monkeypatch):
    monkeypatch.setattr(passages, "SHARD_WORDS", 50)
    monkeypatch.setattr(passages, "ALPHABET", 60)
    test_overlapping_passages(spark, 7)


def test_all_bits_of_a_hash_count(spark, monkeypatch):
    """Phrases other than anchors get hashes that are told apart by their upper half only."""
    real, anchor, upper = passages._sequences, passages.ANCHOR, np.uint64(0xFFFFFFFF00000000)

    def halved(sums, inverse, starts, length):
        found = real(sums, inverse, starts, length)
        return found & upper if getattr(length, "ndim", 0) or length != anchor else found

    monkeypatch.setattr(passages, "_sequences", halved)
    test_overlapping_passages(spark, 8)
