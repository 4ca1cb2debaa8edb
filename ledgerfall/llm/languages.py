"""Language identification: scripts narrow the candidates, a Viterbi path over words labels spans.

1. A word's script tells which languages it can be of: those that write a fair share of
   their letters in it.
2. Per candidate it has a score, the log probability of a mixture of the language's words
   and of a model of its letters, three at a time, which speaks for words never met.
3. The best path through a text's words, where each change of language costs a penalty,
   labels spans; so a mixed text is parted, but a stray word changes nothing.

A text is of the language with most letters.  Paths of many texts are found together, a
word of each at a time.
"""

from __future__ import annotations

import unicodedata
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerfall.llm.shared import kept, lean

#: At most this many labelled texts, of at most this many characters each, are used to fit; alike for each language.
FIT_TEXTS, FIT_CHARS = 4000, 100_000
#: Languages that are learned at most, the most frequent ones; words that the model knows at most, likewise.
FIT_LANGUAGES, FIT_WORDS = 400, 60_000
#: Cost of a change of language between two words, in nats; and what a single word can say against a language at most.
SWITCH, MOST = 8.0, 5.0
#: A language is a candidate in a script that it writes this share of its letters in.
SCRIPT_SHARE = 0.002
#: Part of the probability that known words have; weight of single letters against three in a row.
KNOWN, BACKOFF = 0.5, 5.0
#: What a language that is no candidate has per word.
NEVER = -1e6
#: Words a worker remembers before it starts anew; scores that are held at once.
MEMORY, TOGETHER = 400_000, 4_000_000

UNDETERMINED = "und"

# --- Fixed values: where the blocks of scripts begin; what is between has no name of its own
SCRIPTS = (
    (0x0041, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0700, "Syriac"), (0x0750, "Arabic"), (0x0780, "Thaana"), (0x08A0, "Arabic"),
    (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, "Oriya"),
    (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"), (0x0D80, "Sinhala"),
    (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"), (0x10A0, "Georgian"),
    (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "Cherokee"), (0x1400, "Canadian"), (0x1680, "Other"),
    (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x18B0, "Other"), (0x1C80, "Cyrillic"), (0x1C90, "Georgian"),
    (0x1CC0, "Other"), (0x1D00, "Latin"), (0x1F00, "Greek"), (0x2000, "Other"), (0x2C60, "Latin"), (0x2C80, "Other"),
    (0x2D00, "Georgian"), (0x2D30, "Other"), (0x2D80, "Ethiopic"), (0x2DE0, "Cyrillic"), (0x2E00, "Other"),
    (0x2E80, "Han"), (0x3040, "Kana"), (0x3100, "Bopomofo"), (0x3130, "Hangul"), (0x3190, "Han"), (0x31F0, "Kana"),
    (0x3200, "Other"), (0x3400, "Han"), (0x4DC0, "Other"), (0x4E00, "Han"), (0xA000, "Other"), (0xA640, "Cyrillic"),
    (0xA6A0, "Other"), (0xA720, "Latin"), (0xA800, "Other"), (0xAB30, "Latin"), (0xAB70, "Cherokee"),
    (0xABC0, "Other"), (0xAC00, "Hangul"), (0xD800, "Other"), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB13, "Armenian"),
    (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFE00, "Other"), (0xFE70, "Arabic"), (0xFF21, "Latin"), (0xFF66, "Kana"),
    (0xFFA0, "Hangul"), (0x10000, "Other"), (0x20000, "Han"), (0x40000, "Other"),
)
BEGINS = [begin for begin, _ in SCRIPTS]

WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def script_of(letter: str) -> str:
    return SCRIPTS[max(0, bisect_right(BEGINS, ord(letter)) - 1)][1]


def words_of(text: str) -> list[str]:
    """Runs of letters, composed and in lower case, cut where the script changes."""
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    text = text.lower()
    words = WORD.findall(text)
    return words if text.isascii() else [part for word in words for part in _parts(word)]


def _parts(word: str) -> list[str]:
    if word.isascii() or ord(max(word)) < 0x370:  # Latin letters and marks only
        return [word]
    cuts, last = [0], script_of(word[0])
    for i, letter in enumerate(word):
        if not unicodedata.combining(letter) and (script := script_of(letter)) != last:
            cuts.append(i)
            last = script
    return [word[a:b] for a, b in zip(cuts, [*cuts[1:], len(word)]) if b > a]


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys of one, two and three letters up to each place, and the word each place is of.

    A word's places are its letters and its end; before it are two marks.
    """
    text = np.frombuffer(("\n\n" + "\n\n".join(words) + "\n\n").encode("utf-32-le"), "<u4").astype(np.int64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = 2 + np.r_[0, np.cumsum(sizes + 2)[:-1]]
    word = np.repeat(np.arange(len(words)), sizes + 1)
    at = np.repeat(starts, sizes + 1) + np.arange(len(word)) - np.repeat(np.r_[0, np.cumsum(sizes + 1)[:-1]], sizes + 1)
    pair = (text[at - 2] << 21) | text[at - 1]
    return text[at], pair, (pair << 21) | text[at], word


def _table(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, sorted, and their counts per language."""
    every = np.unique(np.concatenate([np.empty(0, np.int64), *keys]))
    found = np.zeros((len(every), len(keys)))
    for language, (some, n) in enumerate(zip(keys, counts)):
        np.add.at(found[:, language], np.searchsorted(every, some), n)
    return every, found


def _rows(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of keys in a sorted table, -1 where it has none."""
    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


@dataclass(frozen=True)
class Model:
    """Languages in order of their names; arrays have a column per language."""

    languages: list[str]
    prior: np.ndarray
    scripts: dict[str, np.ndarray]
    words: str  # parted by line ends
    word_share: np.ndarray
    singles: np.ndarray
    single_log: np.ndarray  # with a last row for letters never met
    pairs: np.ndarray
    pair_log: np.ndarray  # weight of single letters after a pair; a last row for pairs never met
    triples: np.ndarray
    triple_log: np.ndarray


def fit(texts: dict[str, list[str]], prior: dict[str, int]) -> Model:
    """A model of languages from some texts of each, and how many texts each has in all."""
    languages = sorted(texts)
    counted = [Counter(word for text in texts[name] for word in words_of(text)) for name in languages]
    total = np.array([max(1, sum(some.values())) for some in counted], float)
    scripts: dict[str, np.ndarray] = {}
    for i, some in enumerate(counted):
        for word, n in some.items():
            scripts.setdefault(script_of(word[0]), np.zeros(len(languages)))[i] += n * len(word)
    letters = sum(scripts.values(), np.zeros(len(languages)))
    usable = {name: n >= SCRIPT_SHARE * np.maximum(letters, 1) for name, n in scripts.items()}
    places = [_letters(list(some)) for some in counted]
    weights = [np.array(list(some.values()), float)[place[3]] for some, place in zip(counted, places)]
    singles, n1 = _table([p[0] for p in places], weights)
    pairs, n2 = _table([p[1] for p in places], weights)
    triples, n3 = _table([p[2] for p in places], weights)
    share1 = (np.vstack([n1, np.zeros(len(languages))]) + 0.5) / (n1.sum(0) + 0.5 * (len(n1) + 1))
    rest = np.vstack([BACKOFF / (n2 + BACKOFF), np.ones(len(languages))])
    pair, single = _rows(pairs, triples >> 21), _rows(singles, triples & ((1 << 21) - 1))
    share3 = n3 / (n2[pair] + BACKOFF) + rest[pair] * share1[single]
    often = Counter()
    for some in counted:
        often.update(some)
    # Of equally frequent words the first by name, so that any run gives the same.
    known = sorted(sorted(often), key=lambda word: -often[word])[:FIT_WORDS]
    share = np.array([[some[word] for some in counted] for word in known], float).reshape(len(known), len(languages)) / total
    everyone = max(1, sum(prior.values()))
    return Model(
        languages, np.array([prior.get(name, 0) / everyone for name in languages]), usable, "\n".join(known),
        share.astype(np.float32), singles, np.log(share1).astype(np.float32), pairs, np.log(rest).astype(np.float32),
        triples, np.log(share3).astype(np.float32),
    )


@dataclass
class Scorer:
    """Scores of words, each worked out once."""

    model: Model
    known: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.place = {word: i for i, word in enumerate(self.model.words.split("\n"))} if self.model.words else {}
        self.forget()

    def forget(self) -> None:
        self.known = {}
        self.scores = np.zeros((1024, len(self.model.languages)), np.float32)
        self.sizes = np.zeros(1024, np.int64)
        self.told = np.zeros(1024, bool)

    def _scored(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores per word and language; whether any language can be the word's."""
        m = self.model
        one, two, three, word = _letters(words)
        at = _rows(m.triples, three)
        logs = m.triple_log[at]
        missing = np.flatnonzero(at < 0)
        logs[missing] = m.pair_log[_rows(m.pairs, two[missing])] + m.single_log[_rows(m.singles, one[missing])]
        sums = np.zeros((len(words), len(m.languages)))
        for i in range(len(m.languages)):
            sums[:, i] = np.bincount(word, logs[:, i], len(words))
        found = np.log(1 - KNOWN) + sums
        place = np.array([self.place.get(word, -1) for word in words])
        some = np.flatnonzero(place >= 0)
        with np.errstate(divide="ignore"):
            found[some] = np.logaddexp(found[some], np.log(KNOWN * m.word_share[place[some]].astype(float)))
        none = np.zeros(len(m.languages), bool)
        candidates = np.array([m.scripts.get(script_of(word[0]), none) for word in words]).reshape(len(words), -1)
        told = candidates.any(1)
        found[~candidates] = NEVER
        found = np.maximum(found, found.max(1, keepdims=True) - MOST)
        found[~candidates] = NEVER
        found[~told] = 0.0
        return found.astype(np.float32), told

    def ids(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Places of the words in ``scores``."""
        new = sorted(set().union(*texts) - self.known.keys())
        if len(self.known) + len(new) > MEMORY and self.known:
            self.forget()
            new = sorted(set().union(*texts))
        if new:
            first, last = len(self.known), len(self.known) + len(new)
            while len(self.scores) < last:
                self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
                self.sizes = np.concatenate([self.sizes, np.zeros_like(self.sizes)])
                self.told = np.concatenate([self.told, np.zeros_like(self.told)])
            self.scores[first:last], self.told[first:last] = self._scored(new)
            self.sizes[first:last] = [len(word) for word in new]
            self.known.update(zip(new, range(first, last)))
        return [np.fromiter(map(self.known.__getitem__, some), np.int64, len(some)) for some in texts]


def paths(scores: np.ndarray, lengths: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best language at each word of several texts, whose words' scores follow each other.

    The path has the largest sum of scores less ``switch`` for each change.  Of equal
    paths one that changes later is taken, and the first of equal languages.
    """
    order = np.argsort(-lengths, kind="stable")
    sizes = lengths[order]
    steps = int(sizes[0]) if len(sizes) else 0
    # Texts still running at each step are the first ones; a step's words lie together.
    running = len(sizes) - np.searchsorted(sizes[::-1], np.arange(steps), side="right")
    first = np.r_[0, np.cumsum(running)]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    step = np.arange(len(scores)) - np.repeat(np.r_[0, np.cumsum(lengths)[:-1]], lengths)
    place = first[step] + np.repeat(rank, lengths)
    packed = np.empty_like(scores)
    packed[place] = scores
    stays = np.ones(packed.shape, bool)
    came = np.zeros(len(packed), np.int64)
    value = packed[: running[0] if steps else 0].astype(np.float64)
    rows = np.arange(len(value))
    for t in range(1, steps):
        n, here = int(running[t]), slice(int(first[t]), int(first[t + 1]))
        before = value[:n]
        best = before.argmax(1)
        top = before[rows[:n], best] - switch
        stay = before >= top[:, None]
        came[here], stays[here] = best, stay
        value[:n] = np.where(stay, before, top[:, None]) + packed[here]
    label = np.empty(len(packed), np.int64)
    now = value.argmax(1) if steps else np.empty(0, np.int64)
    for t in range(steps - 1, -1, -1):
        n, here = int(running[t]), slice(int(first[t]), int(first[t + 1]))
        label[here] = now[:n]
        if t:
            now[:n] = np.where(stays[here][rows[:n], now[:n]], now[:n], came[here])
    return label[place]


@dataclass(frozen=True)
class Labelled:
    language: str
    score: float
    labels: np.ndarray  # per word; -1 where no language can be the word's


def identify(texts: list[str], scorer: Scorer) -> list[Labelled]:
    """Languages of texts, with the labels of their words.

    The score is the share of the letters that have the language's label, times the
    probability of the language given the words so labelled.
    """
    languages = scorer.model.languages
    nothing = np.empty(0, np.int64)
    found = [Labelled(UNDETERMINED, 0.0, nothing)] * len(texts)
    if not languages:
        return found
    group: list[tuple[int, list[str]]] = []
    held = 0

    def label() -> None:
        ids = scorer.ids([words for _, words in group])
        lengths = np.array([len(some) for some in ids])
        every = np.concatenate(ids)
        scores, told = scorer.scores[every], scorer.told[every]
        labels = paths(scores, lengths)
        text = np.repeat(np.arange(len(group)), lengths)
        sizes = np.bincount(text * len(languages) + labels, scorer.sizes[every] * told, len(group) * len(languages))
        sizes = sizes.reshape(len(group), -1)
        best = sizes.argmax(1)
        own = (labels == best[text]) & told
        sums = np.stack([np.bincount(text[own], scores[own, i], len(group)) for i in range(len(languages))], 1)
        shares = np.exp(sums - sums.max(1, keepdims=True))
        chance = shares[np.arange(len(group)), best] / shares.sum(1)
        whole = sizes.sum(1)
        ends = np.cumsum(lengths)
        for k, (i, _) in enumerate(group):
            marks = np.where(told[ends[k] - lengths[k] : ends[k]], labels[ends[k] - lengths[k] : ends[k]], -1)
            if whole[k]:
                found[i] = Labelled(languages[best[k]], float(sizes[k, best[k]] / whole[k] * chance[k]), marks)
            else:  # letters of scripts that no language has
                found[i] = Labelled(languages[int(scorer.model.prior.argmax())], 0.0, marks)

    for i, text in enumerate(texts):
        words = words_of(text)
        if not words:
            continue
        if group and (held + len(words)) * len(languages) > TOGETHER:
            label()
            group, held = [], 0
        group.append((i, words))
        held += len(words)
    if group:
        label()
    return found


def train(docs: DataFrame, learnable: Column, texts: int = FIT_TEXTS, longest: int = FIT_CHARS) -> Model:
    """A model from a bounded sample of ``text, lang``, chosen by a hash of the text.

    Rows without ``lang`` or text are not learned from.  Without any, every text is
    undetermined.
    """
    usable = docs.where(learnable & F.col("lang").isNotNull() & F.length("text").between(1, longest)).select("lang", "text")
    counts = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(FIT_LANGUAGES)
    prior = {row["lang"]: row["n"] for row in counts.collect()}
    if not prior:
        return fit({}, {})
    each = max(1, texts // len(prior))
    # About four times as many as wanted of each language are brought together.
    limits = F.create_map(*(F.lit(x) for name, n in prior.items() for x in (name, int(min(1.0, 4 * (each + 100) / n) * (1 << 30)))))
    mark = F.xxhash64("text")
    thin = usable.where(F.pmod(mark, F.lit(1 << 30)) < F.coalesce(limits[F.col("lang")], F.lit(-1)))
    order = Window.partitionBy("lang").orderBy("mark", "text")
    some = thin.withColumn("mark", mark).withColumn("place", F.row_number().over(order)).where(F.col("place") <= each)
    sample: dict[str, list[str]] = {name: [] for name in prior}
    for row in some.select("lang", "text").collect():
        sample[row["lang"]].append(row["text"])
    return fit(sample, prior)


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with ``lang_pred`` and ``score``.

    Null, empty and letterless texts are ``und`` with score 0, as is every text if no
    language was learned.  A text whose letters are all of scripts that no language
    has is of the most frequent one, with score 0.  Texts of any length are labelled
    whole.  Other columns stay, but those of these two names are replaced; repeated
    rows give equal results, empty tables none.
    """
    mark = zlib.crc32(model.words.encode()), len(model.words), tuple(model.languages)

    @F.pandas_udf("lang_pred string, score double")
    @lean
    def told(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = kept("language scorer", mark, lambda: Scorer(model))
        for texts in batches:
            found = identify(list(texts.fillna("")), scorer)
            yield pd.DataFrame({"lang_pred": [x.language for x in found], "score": [x.score for x in found]})

    both = docs.withColumn("__told", told("text"))
    return both.withColumns({"lang_pred": F.col("__told.lang_pred"), "score": F.col("__told.score")}).drop("__told")


def spans(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang, words, text`` of every span: words in a row with one label, in the text's order.

    ``place`` numbers a document's spans from zero; ``text`` has the words as the
    model reads them.  Texts without letters have no spans.
    """
    mark = zlib.crc32(model.words.encode()), len(model.words), tuple(model.languages)

    @F.pandas_udf("array<struct<lang: string, words: int, text: string>>")
    @lean
    def parted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = kept("language scorer", mark, lambda: Scorer(model))
        for texts in batches:
            plain = list(texts.fillna(""))
            yield pd.Series([_spans(text, x.labels, model.languages) for text, x in zip(plain, identify(plain, scorer))])

    each = docs.select("doc_id", F.posexplode(parted("text")).alias("place", "span"))
    return each.select("doc_id", "place", "span.lang", "span.words", "span.text")


def _spans(text: str, labels: np.ndarray, languages: list[str]) -> list[dict]:
    if not len(labels):
        return []
    words = words_of(text)
    # Words that no language can have belong to the span before them.
    marks = labels.copy()
    for i in range(1, len(marks)):
        marks[i] = marks[i] if marks[i] >= 0 else marks[i - 1]
    cuts = [0, *(np.flatnonzero(np.diff(marks)) + 1).tolist(), len(words)]
    return [
        {"lang": languages[marks[a]] if marks[a] >= 0 else UNDETERMINED, "words": b - a, "text": " ".join(words[a:b])}
        for a, b in zip(cuts, cuts[1:])
    ]
