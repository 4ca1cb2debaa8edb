"""Classifiers on held-out labels, and their awkward inputs."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerfall.llm import compression, queries, toxicity
from ledgerfall.llm.shared import table
from tests.llm.cases import awkward, documents

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize(
    "name, label, folds, part, floor, recall",
    [("op2_quality", "quality", 4, 2, 0.95, 0.95), ("op8_toxicity", "toxic", 5, 0, 0.9, 0.4)],
)
def test_held_out_accuracy(spark, name, label, folds, part, floor, recall):
    got = queries.QUERIES[name](spark, SF_DIR).join(table(spark, SF_DIR, "labels"), "doc_id").toPandas()
    everything = queries.QUERIES[name](spark, SF_DIR)
    assert everything.count() == table(spark, SF_DIR, "documents").count()
    assert [f.dataType.simpleString() for f in everything.schema] == ["bigint", "boolean", "double", "int"]
    assert got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % folds == part for i in got.doc_id]).all()
    held = got[got.held_out]
    assert (held.predicted == held[label]).mean() >= floor
    assert held.predicted[held[label] == 1].mean() >= recall


LABELS = "doc_id long, quality int, toxic int"


@pytest.mark.parametrize("module, label", [(compression, "quality"), (toxicity, "toxic")])
def test_awkward_documents_and_labels(spark, module, label):
    docs = documents(spark, *awkward()).withColumn("score", F.lit("mine"))
    for labels in ([], [(4, 1, 1)], [(4, 1, 1), (6, 0, 0), (6, 0, None), (None, 1, 1), (99, 0, 0), (5, 0, 0)]):
        known = spark.createDataFrame(labels, LABELS)
        scored = module.score(docs, module.train(docs, known, F.lit(True), label))
        found = scored.collect()
        assert len(found) == len(awkward()) and all(0 <= r["score"] <= 1 for r in found)
        assert scored.columns == docs.columns
    assert module.score(docs.limit(0), module.train(docs.limit(0), known, F.lit(True), label)).collect() == []


def test_block_sizes_are_of_the_whole_text():
    import pandas as pd

    good, bad = b"the quick brown fox jumps over the lazy dog " * 40, b"#### $$$$ %%%% &&&& **** " * 60
    start = "the quick brown fox jumps over the lazy dog " * 200
    x = compression.features(pd.Series([start, start + "#### $$$$ %%%% &&&& **** " * 900, ""]), good, bad)
    assert x[0, 0] > x[1, 0] and (x[2] == 0).all()


def kernel_by_enumeration(s, t, gain=toxicity.GAIN, decay=toxicity.DECAY):
    """Over all common subsequences, at all pairs of places."""
    from itertools import combinations

    def weights(word):
        out = {}
        for size in range(1, len(word) + 1):
            for chosen in combinations(range(len(word)), size):
                key = "".join(word[i] for i in chosen)
                out[key] = out.get(key, 0) + decay ** (chosen[-1] - chosen[0] + 1)
        return out

    a, b = weights(s), weights(t)
    return sum(v * b.get(k, 0) * gain ** len(k) for k, v in a.items())


def test_string_kernel_is_the_sum_over_common_subsequences():
    """Words that share their beginnings, in any order, some twice; one empty."""
    words, marks = ["^idiot", "^idixot", "^clown", "^ab", "^i", "^idi", "^disgust", "", "^idiot", "^cl", "xyz"], ["^idiot", "^disgust", "^cl"]
    got = toxicity.kernel(words, marks)
    for i, word in enumerate(words):
        for j, mark in enumerate(marks):
            assert got[i, j] == pytest.approx(kernel_by_enumeration(word, mark), rel=1e-4)


def test_inserted_and_spaced_letters_are_met():
    marks = ["^moron"]
    for text in ("moron", "mor-on", "m.o.r.o.n", "moxron", "moronish", "m o r o n"):
        words = [word for some in toxicity.sentences(f"you {text} there") for word in some]
        assert toxicity.likeness(words, marks).max() >= 0.85 * toxicity.STEPS, text
    assert toxicity.likeness(["nothing", "alike", "here"], marks).max() < 0.2 * toxicity.STEPS


def test_whole_words_are_compared():
    like = lambda words, mark: toxicity.likeness(words, [mark])[:, 0] / toxicity.STEPS
    words = ["superidiot", "vollidiot", "megaidiot", "iiiiiiiiidiot", "idiiiiiiiot", "ixdxixoxt", "idioooooot", "theixdxixoxt"]
    assert (like(words, "^idiot") >= 0.6).all()
    assert (like(["x" * 300 + "idiot", "idiot" + "x" * 300, "x" * 77 + "idiot" + "y" * 500], "^idiot") >= 0.35).all()
    # A letter or two in each gap.
    assert (like(["stxupxid", "sxtxuxpxixd", "sxxtxxuuxxpxxixxd"], "^stupid") >= 0.6).all()
    assert (like(["axssxhxoxlxe", "asxshxole", "axxssxxhxxoxxlxxe"], "^asshole") >= 0.6).all()
    assert (like(["nothing", "alike", "internationalisation", "student", "studio", "id"], "^idiot") < 0.2).all()
    assert (like(["student", "studio", "assemble"], "^stupid") < 0.2).all()
    assert like(["fop", "", "f"], "^fop") == pytest.approx([1, 0, 0], abs=0.05)
    toxic, other = [{"you", "fop"}] * 9, [{"you", "are"}] * 9
    assert toxicity._choose_landmarks(toxic, other, 4) == ["^fop"]


def test_margins_do_not_depend_on_neighbours_or_memory(monkeypatch):
    rng = np.random.default_rng(3)
    marks, weights = ["^idiot", "^moron"], np.array([1.5, 0.7])
    words = ["idiot", "moron.", "the", "house!", "m o r o n", "ixdiot", "walks", "idiots."]
    texts = ["", "\n\n", *(" ".join(rng.choice(words, 12)) + ("\n" if i % 2 else " ") + " ".join(rng.choice(words, 5)) for i in range(30))]
    whole = toxicity.Margins(marks, weights, -1.0).of(texts)
    monkeypatch.setattr(toxicity, "MEMORY", 3)
    short = toxicity.Margins(marks, weights, -1.0)
    for text, row in zip(texts, whole):
        plain = [-1.0, -1.0]
        for some in toxicity.sentences(text):
            plain.append(float((toxicity.likeness(some, marks).max(0) / toxicity.STEPS) @ weights) - 1.0)
        want = np.clip(sorted(plain)[::-1][:2], -1, 1)
        assert row == pytest.approx(want, abs=1e-5) and short.of([text])[0] == pytest.approx(want, abs=1e-5)
