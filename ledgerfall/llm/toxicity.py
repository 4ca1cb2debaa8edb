"""Toxicity by a subsequence string-kernel SVM with Nyström landmarks.

Two words are alike by all sequences of letters that they share in order; a longer one
weighs more, and each letter of its span, gaps included, takes some of it.  A word is
measured by the landmark alone, so an insult is met with inserted characters between any
of its letters, stretched, inflected or compounded: what stands before or after it costs
nothing, what stands in its gaps little, a letter that is missing most.  Words are gone
through as a tree of their beginnings, letter by letter for all landmarks at once, so
that what words have in common is worked out once.

A sentence's features are, per landmark, the largest value among its words, turned by the
inverse root of the landmarks' kernel matrix (Nyström); a linear SVM on them is trained
on sentences of labelled texts.  A text's score is calibrated from its two highest
sentence margins.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfall.llm import shared
from ledgerfall.llm.shared import kept, lean, probability

#: At most this many labelled texts of each class are used to fit.
FIT_PER_CLASS = 1500
LANDMARKS = 64
#: Each shared letter multiplies a sequence's weight by the first, each letter of its span in either word by the second.
GAIN, DECAY = 8.0, 0.95
#: Words are compared in overlapping pieces of so many letters at most, which begin half as far apart.
PIECE = 32
#: Landmarks are beginnings of these many letters; a start marker counts as a letter of theirs.
SHORTEST, LONGEST = 4, 8
START = "^"
#: Landmarks are beginnings of at least four letters, or whole words of three (met by whole words); a longer one must keep this share of the texts.
KEEPS = 0.9
#: A landmark is in this share of the toxic texts of the sample, three at least.
RAREST = 0.01
#: Words a worker remembers before it starts anew, and steps from none to full likeness: both bound its memory.
MEMORY, STEPS = 600_000, 255
#: From this likeness on a sentence of a toxic text is learned as toxic.
CLEAR = 0.95
#: Words whose kernel values are worked out together.
TOGETHER = 4096

SPACED = re.compile(r"(?<!\S)\w(?:[ .\-_*]\w){2,}(?!\S)")
OTHER = re.compile(r"[\W_]+")
STOP = (".", "!", "?", ".\"", "!\"", "?\"")


def raw_kernel(words: list[str], marks: list[str]) -> np.ndarray:
    """Weights of all common subsequences, ``[words, marks]``; words in ascending order, different, not empty.

    The state of a word's beginning is, per landmark and place in it, the weight of the
    common subsequences up to there, gaps to both ends included.
    """
    length = max(map(len, marks))
    mark = np.frombuffer("".join([m.ljust(length, "\0") for m in marks]).encode("utf-32-le"), np.int32).reshape(-1, length)
    steps = np.arange(length)
    fade = np.where(steps[None, :] >= steps[:, None], DECAY ** (steps[None, :] - steps[:, None]), 0).astype(np.float32)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    width = int(sizes.max(initial=0))
    codes = np.frombuffer("".join([w.ljust(width, "\0") for w in words]).encode("utf-32-le"), np.int32).reshape(-1, width)
    # Letters that a word shares with the one before it: its node in the tree is the same so far.
    same = np.zeros(len(words), np.int64)
    if len(words) > 1:
        differ = codes[1:] != codes[:-1]
        same[1:] = np.where(differ.any(1), differ.argmax(1), width)
    out = np.zeros((len(words), len(marks)), np.float32)
    node = np.zeros(len(words), np.int64)
    state = np.zeros((1, len(marks), length + 1), np.float32)
    total = np.zeros((1, len(marks)), np.float32)
    gain = np.float32(GAIN * DECAY**2)
    for at in range(width):
        some = np.flatnonzero(sizes > at)
        first = same[some] <= at
        parent, letter = node[some[first]], codes[some[first], at]
        node[some] = np.cumsum(first) - 1
        state, total = state[parent], total[parent]
        met = (mark[None] == letter[:, None, None]) * (state[:, :, :-1] + 1) * gain
        total = total + met.sum(2)
        state *= np.float32(DECAY)
        state[:, :, 1:] += met @ fade
        ending = some[sizes[some] == at + 1]
        out[ending] = total[node[ending]]
    return out


def kernel(words: list[str], marks: list[str]) -> np.ndarray:
    """Kernel of any words, with their start markers, with landmarks: each as it is."""
    order = sorted(set(words) - {""})
    place = {word: i for i, word in enumerate(order)}
    found = np.zeros((len(order) + 1, len(marks)), np.float32)
    for at in range(0, len(order), TOGETHER):
        found[at : at + TOGETHER][: len(order) - at] = raw_kernel(order[at : at + TOGETHER], marks)
    return found[[place.get(word, len(order)) for word in words]]


def _in_pieces(word: str) -> list[str]:
    """The word with its start marker; a very long one as overlapping pieces, each with one."""
    return [START + word[at : at + PIECE] for at in range(0, max(1, len(word) - PIECE // 2), PIECE // 2)]


def likeness(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Per cleaned word its kernel value with each landmark as a share of the landmark's own, at most 1, in steps."""
    out = np.zeros((len(words), len(landmarks)), np.uint8)
    if not words or not landmarks:
        return out
    pieces = [_in_pieces(word) if word else [""] for word in words]
    owner = np.repeat(np.arange(len(words)), [len(some) for some in pieces])
    own = np.diag(kernel(landmarks, landmarks))
    share = kernel([piece for some in pieces for piece in some], landmarks) / own
    np.maximum.at(out, owner, np.rint(np.minimum(share, 1) * STEPS).astype(np.uint8))
    return out


def _tokens(text: str) -> list[str]:
    """Lower-case words; letters written apart are put together."""
    return SPACED.sub(lambda m: re.sub(r"[ .\-_*]", "", m[0]), text.lower()).split()


def _clean(word: str) -> str:
    return word if word.isalnum() else OTHER.sub("", word)


def sentences(text: str) -> list[list[str]]:
    """Cleaned words of each sentence; sentences end with a line or with a word that ends one."""
    found: list[list[str]] = []
    for line in text.split("\n"):
        own: list[str] = []
        for word in _tokens(line):
            own.append(_clean(word))
            if word.endswith(STOP):
                found.append(own)
                own = []
        if own:
            found.append(own)
    return found


@dataclass(frozen=True)
class Model:
    landmarks: list[str]
    weights: np.ndarray
    bias: float
    fit: tuple[np.ndarray, np.ndarray, np.ndarray]


class Margins:
    """Highest sentence margins of texts; remembers how like the landmarks words are."""

    def __init__(self, landmarks: list[str], weights: np.ndarray, bias: float):
        self.landmarks, self.weights, self.bias = landmarks, weights, bias
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.likeness = np.zeros((1024, len(self.landmarks)), np.uint8)
        self.ends = np.zeros(1024, bool)

    def learn(self, words: set[str]) -> None:
        new = words - self.known.keys()
        if self.known and len(self.known) + len(new) > MEMORY:
            self.forget()
            new = words
        new = sorted(new)
        first, last = len(self.known), len(self.known) + len(new)
        while len(self.ends) < last:
            self.likeness = np.concatenate([self.likeness, np.zeros_like(self.likeness)])
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.likeness[first:last] = likeness([_clean(word) for word in new], self.landmarks)
        self.ends[first:last] = [word.endswith(STOP) for word in new]
        self.known.update(zip(new, range(first, last)))

    def of(self, texts: list[str]) -> np.ndarray:
        """Per text: highest and second highest margin of its sentences (the bias if it has none), within -1 and 1."""
        out = np.full((len(texts), 2), self.bias, float)
        lines = [[line for line in map(_tokens, text.split("\n")) if line] for text in texts]
        words = [word for some in lines for line in some for word in line]
        if self.landmarks and words:
            self.learn(set(words))
            ids = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
            sizes = np.array([len(line) for some in lines for line in some])
            # A sentence begins with a line and after a word that ends one.
            begins = np.zeros(len(ids) + 1, bool)
            begins[np.r_[0, np.cumsum(sizes)]] = True
            begins[1:] |= self.ends[ids]
            starts = np.flatnonzero(begins[:-1])
            best = np.maximum.reduceat(self.likeness[ids], starts)
            margins = best.astype(np.float32) @ (self.weights / STEPS).astype(np.float32) + self.bias
            counts = np.array([sum(map(len, some)) for some in lines])
            text = np.searchsorted(np.cumsum(counts), starts, side="right")
            order = np.lexsort((-margins, text))
            text, margins = text[order], margins[order]
            place = np.arange(len(text)) - np.searchsorted(text, text)
            for k in range(2):
                some = place == k
                out[text[some], k] = np.maximum(margins[some], self.bias)
        return np.clip(out, -1, 1)


def _choose_landmarks(toxic: list[set[str]], other: list[set[str]], count: int) -> list[str]:
    """Word beginnings that many toxic texts have and other texts hardly, each for new texts."""
    begins = lambda words: {w for w in words if len(w) == SHORTEST - 1} | {
        w[:n] for w in words for n in range(SHORTEST, min(len(w), LONGEST - 1) + 1)
    }
    in_other = Counter(g for words in other for g in begins(words))
    holders: dict[str, set[int]] = {}
    for i, words in enumerate(toxic):
        for g in begins(words):
            holders.setdefault(g, set()).add(i)
    weight = len(toxic) / max(1, len(other))
    enough = max(3, RAREST * len(toxic))
    rich = {g: t for g, t in holders.items() if len(t) >= enough and len(t) > 5 * weight * in_other[g]}
    chosen: list[str] = []
    times = np.zeros(len(toxic))
    short = {g for g in rich if len(g) <= SHORTEST}
    while short and len(chosen) < count:
        # Texts that have landmarks already count less, so that rarer insults get theirs.
        value = lambda g: sum(0.6 ** times[i] for i in rich[g]) - 3 * weight * in_other[g]
        g = max(short, key=lambda g: (value(g), g))
        if value(g) <= 0:
            break
        short.remove(g)
        times[list(rich[g])] += 1
        while len(g) >= SHORTEST and (longer := [x for x in rich if len(x) == len(g) + 1 and x.startswith(g) and len(rich[x]) >= KEEPS * len(rich[g])]):
            g = max(longer)
        chosen.append(START + g)
    return chosen


def _svm(x: np.ndarray, y: np.ndarray, cost: float = 1.0, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Linear SVM, squared hinge, classes balanced; gradient steps with a safe rate."""
    side = np.where(y > 0, 1.0, -1.0)
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum())) * cost * len(y)
    z = np.c_[x, np.ones(len(x))]
    rate = 1 / (1 + 2 * (share[:, None] * z**2).sum())
    w = np.zeros(z.shape[1])
    ahead, momentum = w.copy(), 1.0
    for _ in range(rounds):
        slack = np.maximum(0, 1 - side * (z @ ahead))
        step = ahead - rate * (np.r_[ahead[:-1], 0.0] - 2 * z.T @ (share * side * slack))
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = step + (momentum - 1) / following * (step - w)
        w, momentum = step, following
    return w[:-1], float(w[-1])


def train(
    docs: DataFrame, labels: DataFrame, learnable: Column, label: str = "toxic", per_class: int = FIT_PER_CLASS
) -> Model:
    """Fitted on a bounded sample: landmarks and SVM on one half, calibration on the other.

    Labels are of texts, sentences inherit them: of a toxic text the sentence most
    like the landmarks is taken as toxic, of the others the three most alike as not,
    and chosen anew by the SVM's margin for a second fit.  Without labels of both
    classes every score is the labels' share (one half without labels).
    """
    zeros, ones = shared.label_counts(labels, label, learnable)
    prior = (ones + 0.5) / (zeros + ones + 1)
    return fit(shared.fit_sample(docs, labels, label, learnable, per_class).toPandas(), prior)


def fit(rows: pd.DataFrame, prior: float) -> Model:
    """The model of a sample ``text, label``; ``prior`` is the share of label 1 among all labels."""
    half = np.arange(len(rows)) % 2 == 0
    flat = (np.zeros(2), np.ones(2), np.r_[0.0, 0.0, np.log(prior / (1 - prior))])
    first, rest = rows[half], rows[~half]
    if first.label.nunique() < 2 or rest.label.nunique() < 2:
        return Model([], np.zeros(0), 0.0, flat)
    split = [(sentences(text), value) for text, value in zip(first.text, first.label)]
    words = {v: [{w for s in some for w in s} for some, u in split if u == v] for v in (0, 1)}
    landmarks = _choose_landmarks(words[1], words[0], LANDMARKS)
    if not landmarks:
        return Model([], np.zeros(0), 0.0, flat)
    vocabulary = sorted(set().union(*words[0], *words[1]))
    near = dict(zip(vocabulary, likeness(vocabulary, landmarks).astype(np.float32) / STEPS))
    none = np.zeros(len(landmarks), np.float32)
    pooled = [
        (np.array([np.max([near[w] for w in s] or [none], axis=0) for s in some] or [none]), v) for some, v in split
    ]
    self_kernel = kernel(landmarks, landmarks).astype(float)
    scale = 1 / np.sqrt(np.diag(self_kernel))
    self_kernel *= scale[:, None] * scale[None, :]
    roots, turn = np.linalg.eigh((self_kernel + self_kernel.T) / 2)
    whiten = (turn / np.sqrt(np.maximum(roots, 1e-3))) @ turn.T
    weights, bias = None, 0.0
    for _ in range(3):
        x, y = [], []
        for rows_of, v in pooled:
            # First the sentence with the word most like any landmark.
            worth = rows_of.max(1) if weights is None else rows_of @ weights
            top = np.argsort(-worth, kind="stable")[: 1 if v else 3]
            if v:  # and every other one with a word that is a landmark or nearly
                top = np.union1d(top, np.flatnonzero(rows_of.max(1) >= CLEAR))
            x.append(rows_of[top])
            y += [v] * len(top)
        w, bias = _svm(np.concatenate(x) @ whiten, np.array(y))
        weights = whiten @ w
    margins = Margins(landmarks, weights, bias).of(list(rest.text))
    return Model(landmarks, weights, bias, shared.logistic(margins, rest.label.to_numpy(float), prior))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with ``score``, the calibrated probability of toxicity.

    Null and empty texts have no sentence and score as a text with nothing like a
    landmark; very long texts are gone through whole.  Other columns are kept as they
    are, repeated rows too; one named ``score`` is replaced.  An empty table gives no rows.
    """
    landmarks, weights, bias, fit = model.landmarks, model.weights, model.bias, model.fit

    @F.pandas_udf("double")
    @lean
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        mark = (*landmarks, bias, weights.tobytes())
        margins = kept("margins", mark, lambda: Margins(landmarks, weights, bias))
        for texts in batches:
            plain = list(texts.fillna(""))
            parts = [margins.of(plain[at : at + 256]) for at in range(0, len(plain), 256)]
            yield pd.Series(probability(np.concatenate(parts), fit) if parts else np.empty(0))

    return docs.withColumn("score", scored("text"))
