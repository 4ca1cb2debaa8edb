"""The pipeline, stage by stage, against its operators in brute force."""

import corpus_pipeline
from ledgerfall.llm.shared import table
from tests.llm.cases import awkward, documents
from tests.llm.test_line_templates import expected_lines
from tests.llm.test_simhash import expected_components, expected_fingerprint

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF_DIR, "documents")
    columns = docs.columns
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, frames[-1], SF_DIR).cache())
    assert all(frame.columns == columns for frame in frames[:-1])
    start, good, cleaned, single, clear, encoded = ([tuple(r) for r in f.collect()] for f in frames)

    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF_DIR, "labels").collect()}
    kept = {r[0] for r in good}
    right = [(r[0] in kept) == (labels[r[0]] == 1) for r in start if r[0] in labels]
    assert sum(right) >= 0.9 * len(right)

    ours = sorted((str(r[0]), r[1]) for r in cleaned)
    assert ours == sorted((i, t) for i, t, *_ in expected_lines([(r[0], r[1], r[3]) for r in good], 0.08, 5))
    assert all(r[4] == len(r[1]) for r in cleaned)

    fps = [(r[0], expected_fingerprint(r[1])) for r in cleaned]
    assert sorted(r[0] for r in single) == sorted(set(expected_components(fps)))

    items = [set(_grams(r["text"])) for r in table(spark, SF_DIR, "benchmark").collect()]
    held = {r[0] for r in single if any(len(x & set(_grams(r[1]))) >= 0.6 * len(x) for x in items if x)}
    assert sorted(r[0] for r in clear) == sorted({r[0] for r in single} - held)
    assert sorted(r[0] for r in encoded) == sorted(r[0] for r in clear)
    assert all(r[3] and r[4] for r in encoded)
    for frame in frames[1:]:
        frame.unpersist()


def _grams(text):
    words = text.lower().replace(".", "").replace(",", "").split()
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)]


def test_stages_take_awkward_documents(spark):
    docs = documents(spark, *awkward())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF_DIR)
        assert kept.columns == docs.columns, name
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert rows and all(r["parity"] and r["round_trip"] for r in rows)
