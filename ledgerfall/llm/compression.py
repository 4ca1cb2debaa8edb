"""Quality from compressed sizes: one zstandard dictionary of good text, one of bad.

Text that resembles the good dictionary's compresses better with it, so the
difference of both compressed sizes over the raw size tells which it resembles.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfall.llm import shared
from ledgerfall.llm.shared import lean, probability

#: At most this many labelled texts of each class are used to fit.
FIT_PER_CLASS = 1500
#: A dictionary is trained on at most this many pieces of a text, spread over it.
PIECES, PIECE_BYTES = 12, 600
DICTIONARY_BYTES = 48 * 1024
#: Texts are compressed in blocks, so that a dictionary counts as much late in a long text as at its start.
BLOCK_BYTES = 2048
LEVEL = 3


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    fit: tuple[np.ndarray, np.ndarray, np.ndarray]


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    options = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    if not dictionary:
        return zstandard.ZstdCompressor(**options)
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=data, **options)


def _dictionary(texts: list[str]) -> bytes:
    """A dictionary from pieces spread over each text; empty if there is too little text to train one."""
    pieces = []
    for data in (text.encode() for text in texts):
        for at in np.unique(np.linspace(0, max(0, len(data) - PIECE_BYTES), PIECES).astype(int)):
            pieces.append(data[at : at + PIECE_BYTES])
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-DICTIONARY_BYTES:]


def features(texts: pd.Series, good: bytes, bad: bytes) -> np.ndarray:
    """Per text: size difference over raw size, better size over raw size, the sign-kept root of the first."""
    by_good, by_bad = _compressor(good), _compressor(bad)
    rows = np.zeros((len(texts), 3))
    for row, text in zip(rows, texts):
        data = text.encode()
        if not data:
            continue
        with_good = with_bad = 0
        for at in range(0, len(data), BLOCK_BYTES):
            block = data[at : at + BLOCK_BYTES]
            with_good += len(by_good.compress(block))
            with_bad += len(by_bad.compress(block))
        difference = (with_bad - with_good) / len(data)
        row[:] = difference, min(with_good, with_bad) / len(data), np.sign(difference) * abs(difference) ** 0.5
    return rows


def train(
    docs: DataFrame, labels: DataFrame, learnable: Column, label: str = "quality", per_class: int = FIT_PER_CLASS
) -> Model:
    """Dictionaries from one half of a bounded sample of labelled texts, calibration from the other half.

    With no label of one class, the score is the share of the other (one half
    without any label) for every text.
    """
    zeros, ones = shared.label_counts(labels, label, learnable)
    prior = (ones + 0.5) / (zeros + ones + 1)
    rows = shared.fit_sample(docs, labels, label, learnable, per_class).toPandas()
    half = np.arange(len(rows)) % 2 == 0
    texts = {v: list(rows.text[half & (rows.label == v)]) for v in (0, 1)}
    good, bad = (_dictionary(texts[v]) if texts[v] else b"" for v in (1, 0))
    rest = rows[~half]
    if rest.label.nunique() < 2:
        none = np.zeros(3)
        return Model(good, bad, (none, none + 1, np.r_[none, np.log(prior / (1 - prior))]))
    x = features(rest.text, good, bad)
    return Model(good, bad, shared.logistic(x, rest.label.to_numpy(float), prior))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with ``score``, the calibrated probability of good quality.

    Null and empty texts have no difference and no size: their score is that of
    these features.  Very long texts are compressed whole, block by block; an empty
    table gives no rows.  Every other column is kept as it is, repeated rows too; one
    named ``score`` is replaced.
    """
    good, bad, fit = model.good, model.bad, model.fit

    @F.pandas_udf("double")
    @lean
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            x = features(texts.fillna(""), good, bad)
            yield pd.Series(probability(x, fit))

    return docs.withColumn("score", scored("text"))
