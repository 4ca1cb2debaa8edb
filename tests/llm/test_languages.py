"""Paths against all labellings, letters' probabilities against counting, accuracy on rows not learned from."""

import itertools
import random
from math import log

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerfall.llm import languages as L
from ledgerfall.llm.queries import op13_language
from tests.conftest import SF_DIR
from tests.llm.cases import SCHEMA, awkward, documents

ENGLISH = "the cat sat on the mat and then the dog came with that thing which was there".split()
GERMAN = "der hund und die katze sind nicht auf dem tisch aber ich habe einen apfel gegessen".split()
GREEK = "το σπίτι είναι μεγάλο και η γάτα κοιμάται στον ήλιο".split()


def texts(words, seed, count=30):
    choose = random.Random(seed)
    return [" ".join(choose.choices(words, k=20)) for _ in range(count)]


@pytest.fixture(scope="module")
def model():
    return L.fit({"de": texts(GERMAN, 1), "en": texts(ENGLISH, 2), "el": texts(GREEK, 3)}, {"de": 30, "en": 50, "el": 30})


def test_paths_against_all_labellings():
    rng = np.random.default_rng(4)
    lengths = np.array([5, 1, 7, 0, 7, 3])
    scores = rng.normal(0, 3, (lengths.sum(), 3))
    found = L.paths(scores, lengths, 2.5)
    at = 0
    for n in lengths:
        part = scores[at : at + n]
        worth = lambda path: sum(part[i, l] for i, l in enumerate(path)) - 2.5 * sum(a != b for a, b in zip(path, path[1:]))  # noqa: B023, E731, E741
        best = max(itertools.product(range(3), repeat=int(n)), key=worth)
        assert tuple(found[at : at + n]) == best
        at += n


def test_a_word_scores_as_its_letters_and_its_count(model):
    """Against the same mixture worked out by counting letters one after the other."""
    words = {"de": texts(GERMAN, 1), "en": texts(ENGLISH, 2), "el": texts(GREEK, 3)}
    every = {name: [w for text in some for w in text.split()] for name, some in words.items()}
    alphabet = {c for some in every.values() for w in some for c in w + "\n"}

    def chance(word, name):
        marked = ["\n\n" + w + "\n" for w in every[name]]
        total = log(1 - L.KNOWN)
        letters = "".join(w + "\n" for w in every[name])
        for i, c in enumerate(word + "\n"):
            two = ("\n\n" + word)[i : i + 2]
            n2 = sum(w[j : j + 2] == two for w in marked for j in range(len(w) - 2))
            n3 = sum(w[j : j + 3] == two + c for w in marked for j in range(len(w) - 2))
            single = (letters.count(c) + 0.5) / (len(letters) + 0.5 * (len(alphabet) + 1))
            total += log((n3 + L.BACKOFF * single) / (n2 + L.BACKOFF))
        return np.logaddexp(total, log(L.KNOWN * every[name].count(word) / len(every[name]) or 1e-300))

    scorer = L.Scorer(model)
    for word in ("the", "hund", "katzen", "xyz"):
        row = scorer.scores[scorer.ids([[word]])[0][0]]
        plain = {name: chance(word, name) for name in ("de", "en")}
        for i, name in enumerate(model.languages):
            want = L.NEVER if name == "el" else max(plain[name], max(plain.values()) - L.MOST)
            assert row[i] == pytest.approx(want, rel=1e-4)


def test_spans_of_a_mixed_text(spark, model):
    text = "The cat sat on that mat, und der hund und die katze sind nicht auf dem tisch. Η γάτα είναι μεγάλο!"
    rows = L.spans(documents(spark, (1, text), (2, "12 %"), (3, None)), model).orderBy("place").collect()
    assert [(r["lang"], r["words"]) for r in rows] == [("en", 6), ("de", 11), ("el", 4)]
    assert " ".join(r["text"] for r in rows) == " ".join(L.words_of(text))


def test_a_stray_word_changes_nothing(model):
    scorer = L.Scorer(model)
    stray, span = ("the cat sat on the mat und then the dog", "the cat sat on the mat und der hund und die katze sind auf dem tisch then the dog came")
    labels = [set(x.labels.tolist()) for x in L.identify([stray, span], scorer)]
    assert [{model.languages[i] for i in some} for some in labels] == [{"en"}, {"en", "de"}]


def test_scripts(model):
    scorer = L.Scorer(model)
    told = lambda text: L.identify([text], scorer)[0]
    assert told("ξύλο λόφος").language == "el" and told("qwerty zxcv").language != "el"
    assert L.words_of("catγάτα") == ["cat", "γάτα"]
    assert (told("привет мир").language, told("привет мир").score) == ("en", 0.0)  # no language has it: the commonest
    assert told("привет die katze").language == "de"
    assert told("é 123").language in model.languages and L.words_of("É") == ["é"]
    for nothing in ("", " \n", "123 _ 4-5 !", "½ ²"):
        assert (told(nothing).language, told(nothing).score) == ("und", 0.0)


def test_texts_do_not_depend_on_their_neighbours(model):
    some = [*texts(ENGLISH, 7, 5), "", *texts(GERMAN, 8, 5), "x " * 5000, *texts(GREEK, 9, 3)]
    alone = [L.identify([t], L.Scorer(model))[0] for t in some]
    together = L.identify(some, L.Scorer(model))
    assert [(a.language, round(a.score, 9), a.labels.tolist()) for a in alone] == [
        (b.language, round(b.score, 9), b.labels.tolist()) for b in together
    ]


def test_held_out_accuracy(spark):
    for folder in (SF_DIR, SF_DIR.replace("0.001", "0.01")):
        found = op13_language(spark, folder).where("held_out")
        lang = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
        rows = found.join(lang, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
        assert rows[0] >= 0.99 and rows[1] > 30


def test_awkward(spark, model):
    rows = awkward()
    docs = documents(spark, *rows).withColumn("lang_pred", F.lit(1)).withColumn("__told", F.lit(2))
    found = L.predicted(docs.drop("__told"), model).collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 for r in found)
    assert {r["lang_pred"] for r in found if not (r["text"] or "").strip()} == {"und"}
    none = spark.createDataFrame([], SCHEMA)
    untaught = L.train(none, F.lit(True))
    assert L.predicted(none, untaught).count() == 0
    assert {r["lang_pred"] for r in L.predicted(docs, untaught).collect()} == {"und"}


def test_training_reads_only_learnable_labelled_rows(spark):
    rows = [(i, text, "en") for i, text in enumerate(texts(ENGLISH, 1))] + [(100 + i, text, "de") for i, text in enumerate(texts(GERMAN, 1))]
    rows += [(200, "la casa", "es"), (201, "die katze", None), (202, None, "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert L.train(docs, F.col("doc_id") < 200).languages == ["de", "en"]
    assert L.train(docs, F.lit(True)).languages == ["de", "en", "es"]
    assert L.train(docs, F.lit(True), texts=3).word_share.shape[0] <= 60
