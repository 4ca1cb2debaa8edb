"""SentencePiece models on the tokenizers library.

The model file is read field by field; the library's tokenizer is rebuilt from it:
normaliser, word-start marker, byte fallback, and either unigram scores or merges
ordered by score.  Pieces never continue over a word-start marker (checked when a
model is read), so a text is split there first, and the library encodes each word once
as long as a worker remembers it.  Words are looked up once per batch: texts are split
and their words numbered by Arrow, and ids put together by these numbers.  Batches are
encoded multithreaded, and every text's ids are compared with SentencePiece's own of the
whole text.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow
import sentencepiece
from pyarrow import compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Encoding, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

from ledgerfall.llm.shared import kept, lean

MARK = "▁"
#: Texts encoded at once: bounds a task's memory beside the longest text.
BATCH = 256
#: Characters of texts whose words are looked up at once, beside the longest text: fewer lookups, bounded memory.
LOOKED_UP = 1 << 20
#: Words a worker remembers, half of them from before it last started anew: bounds its memory.
MEMORY = 800_000
#: New words that are encoded as one text.
AT_ONCE = 100
#: Words of a normalised text, as the tokenizer takes it apart.
WORD = f"{MARK}*[^{MARK}]+|{MARK}+"
#: Threads of a task's encoder; tasks run side by side, and each thread has memory of its own.
THREADS = "2"

# --- Fixed values: field numbers and kinds of the published model format
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE, SCORE, KIND = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
MODEL_TYPE, BYTE_FALLBACK = 3, 35
RULES, DUMMY_PREFIX, REMOVE_EXTRA, ESCAPE = 2, 3, 4, 5
UNIGRAM, BPE = 1, 2


def _number(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        if byte < 128:
            return value, at
        shift += 7


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and raw values of one protobuf message."""
    at = 0
    while at < len(data):
        tag, at = _number(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _number(data, at)
        else:
            size, at = _number(data, at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


@dataclass(frozen=True)
class Model:
    pieces: list[tuple[str, float, int]]
    unigram: bool
    byte_fallback: bool
    rules: bytes
    dummy_prefix: bool
    remove_extra: bool


def parse(data: bytes) -> Model:
    pieces, trainer, normalizer = [], {}, {}
    for number, value in _fields(data):
        if number == PIECES:
            piece = dict(_fields(value))
            score = float(np.frombuffer(piece.get(SCORE, bytes(4)), "<f4")[0])
            pieces.append((piece.get(PIECE, b"").decode(), score, piece.get(KIND, NORMAL)))
        elif number == TRAINER:
            trainer = dict(_fields(value))
        elif number == NORMALIZER:
            normalizer = dict(_fields(value))
    kind = trainer.get(MODEL_TYPE, UNIGRAM)
    if kind not in (UNIGRAM, BPE) or not normalizer.get(ESCAPE, 1):
        raise ValueError("only unigram and BPE models with escaped blanks can be rebuilt")
    if any(re.search(f"[^{MARK}]{MARK}", text) for text, _, _ in pieces):
        raise ValueError("a piece goes on over a word start")
    return Model(
        pieces, kind == UNIGRAM, bool(trainer.get(BYTE_FALLBACK, 0)), normalizer.get(RULES, b""),
        bool(normalizer.get(DUMMY_PREFIX, 1)), bool(normalizer.get(REMOVE_EXTRA, 1)),
    )


def _merges(model: Model) -> list[tuple[str, str]]:
    """Pairs whose joint is a piece, in the order of the joint's score."""
    ids = {text: i for i, (text, _, kind) in enumerate(model.pieces) if kind in (NORMAL, USER_DEFINED, UNUSED)}
    found = []
    for text, i in ids.items():
        for at in range(1, len(text)):
            if (left := ids.get(text[:at])) is not None and (right := ids.get(text[at:])) is not None:
                found.append((-model.pieces[i][1], left, right, text[:at], text[at:]))
    return [pair for *_, left, right in sorted(found) for pair in [(left, right)]]


def build(model: Model) -> Tokenizer:
    """The library's tokenizer with the model's vocabulary, normaliser, marker and decoder."""
    unknown = next(i for i, piece in enumerate(model.pieces) if piece[2] == UNKNOWN)
    if model.unigram:
        scores = [(text, score) for text, score, _ in model.pieces]
        tokenizer = Tokenizer(models.Unigram(scores, unk_id=unknown, byte_fallback=model.byte_fallback))
    else:
        vocabulary = {text: i for i, (text, _, _) in enumerate(model.pieces)}
        tokenizer = Tokenizer(
            models.BPE(
                vocabulary, _merges(model), unk_token=model.pieces[unknown][0], fuse_unk=True,
                byte_fallback=model.byte_fallback,
            )
        )
    marked = [normalizers.Prepend(MARK)] if model.dummy_prefix else []
    tokenizer.normalizer = normalizers.Sequence([*plain_steps(model), *marked, normalizers.Replace(" ", MARK)])
    tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(WORD), "isolated")
    # Joined first, so that markers are replaced once per text and not once per piece.
    tokenizer.decoder = decoders.Sequence([decoders.ByteFallback(), decoders.Fuse(), decoders.Replace(MARK, " ")])
    return tokenizer


def plain_steps(model: Model) -> list[normalizers.Normalizer]:
    """What is done to a text before blanks are marked."""
    steps = [normalizers.Precompiled(model.rules)] if model.rules else []
    if model.remove_extra:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    return steps


def _slices(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Slices of an array, one after the other."""
    ends = np.cumsum(lengths)
    return data[np.repeat(starts - ends + lengths, lengths) + np.arange(lengths.sum())]


def _in_calls(tokenizer: Tokenizer, texts: list[str]) -> Iterator[Encoding]:
    """What the library gives for texts, a bounded number at once."""
    for at in range(0, len(texts), BATCH):
        yield from tokenizer.encode_batch_fast(texts[at : at + BATCH], add_special_tokens=False)


class Codec:
    """Encodes and decodes texts with one model."""

    def __init__(self, data: bytes):
        os.environ.setdefault("RAYON_NUM_THREADS", THREADS)  # read when the library first encodes
        self.model = parse(data)
        self.tokenizer = build(self.model)
        #: For words, which are normalised already.
        self.words = build(self.model)
        self.words.normalizer = normalizers.Sequence([])
        #: For words with a marker at their start only: parted without a regular expression.
        self.marked_words = build(self.model)
        self.marked_words.normalizer = normalizers.Sequence([])
        self.marked_words.pre_tokenizer = pre_tokenizers.Split(MARK, "merged_with_next")
        self.split = re.compile(WORD).findall
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.starts = np.array([text.startswith(MARK) for text, _, _ in self.model.pieces])
        self.plain = normalizers.Sequence(plain_steps(self.model))
        self.control = frozenset(i for i, (_, _, kind) in enumerate(self.model.pieces) if kind == CONTROL)
        self.reference = sentencepiece.SentencePieceProcessor(model_proto=data)

    def marked(self, text: str) -> str:
        """A text as the tokenizer's normaliser gives it, at less cost: marking blanks moves nothing else."""
        plain = self.plain.normalize_str(text).replace(" ", MARK)
        return MARK + plain if plain and self.model.dummy_prefix else plain

    def learn(self, new: list[str]) -> None:
        """Ids of new words.  Words with a marker at their start only are encoded together, if one piece of each has it."""
        plain, alone = [], []
        for word in new:
            (plain if word.rfind(MARK) == 0 and len(word) > 1 else alone).append(word)
        groups = [plain[at : at + AT_ONCE] for at in range(0, len(plain), AT_ONCE)]
        texts = ["".join(group) for group in groups]
        for group, found in zip(groups, _in_calls(self.marked_words, texts)):
            ids = np.array(found.ids, "<u4")
            starts = np.flatnonzero(self.starts[ids])
            if len(starts) != len(group) or starts[0] != 0:
                alone += group
                continue
            data, bounds = ids.tobytes(), (starts * 4).tolist()
            self.known.update(zip(group, map(data.__getitem__, map(slice, bounds, [*bounds[1:], len(data)]))))
        for word, found in zip(alone, _in_calls(self.words, alone)):
            self.known[word] = np.array(found.ids, "<u4").tobytes()

    def remember(self, every: list[str]) -> None:
        """Makes the words known, the new ones by the library."""
        new = [word for word in every if word not in self.known]
        if len(self.known) + len(new) > MEMORY // 2:
            # Words that are met again are kept: they need not be learnt anew.
            self.before, self.known, new = self.known, {}, every
        if self.before:
            self.known.update((word, self.before.pop(word)) for word in new if word in self.before)
            new = [word for word in new if word not in self.known]
        self.learn(new)

    def numbered(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Words of normalised texts, once each; their numbers, text after text; how many each text has."""
        simple = np.array([text[:1] == MARK and MARK * 2 not in text for text in texts], bool)
        odd = [self.split(text) for text, some in zip(texts, simple) if not some]
        plain = pyarrow.array([text[1:] for text, some in zip(texts, simple) if some], pyarrow.large_string())
        lists = compute.split_pattern(plain, MARK)  # each of them follows a marker
        sizes = np.empty(len(texts), np.int64)
        sizes[simple] = lists.value_lengths().to_numpy(zero_copy_only=False)
        sizes[~simple] = list(map(len, odd))
        coded = lists.flatten().dictionary_encode()
        every = [MARK + word for word in coded.dictionary.to_numpy(zero_copy_only=False)]
        at = {word: i for i, word in enumerate(every)} if odd else {}
        codes = np.empty(sizes.sum(), np.int32)
        first = np.repeat(simple, sizes)
        codes[first] = coded.indices.to_numpy(zero_copy_only=False)
        codes[~first] = [at.setdefault(word, len(at)) for some in odd for word in some]
        return list(at) if odd else every, codes, sizes

    def raw_ids(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        every, codes, sizes = self.numbered([self.marked(text) for text in texts])
        self.remember(every)
        parts = list(map(self.known.__getitem__, every))
        data = np.frombuffer(b"".join(parts), "<u4")
        lengths = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        starts = np.cumsum(lengths) - lengths
        edges = np.r_[0, np.cumsum(sizes)].tolist()
        return [_slices(data, starts[own], lengths[own]).tobytes() for own in map(codes.__getitem__, map(slice, edges, edges[1:]))]

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[bool]]:
        """Ids of each text, and whether SentencePiece gives the same."""
        return self.compared(texts, self.raw_ids(texts))

    def compared(self, texts: list[str], raw: list[bytes]) -> tuple[list[list[int]], list[bool]]:
        ids = [np.frombuffer(some, "<u4").tolist() for some in raw]
        return ids, [ours == theirs for ours, theirs in zip(ids, self.reference.encode(texts, num_threads=1))]

    def decode(self, ids: list[list[int]]) -> list[str]:
        """Texts by the library's decoder; control pieces are none of them."""
        plain = [some if self.control.isdisjoint(some) else [i for i in some if i not in self.control] for some in ids]
        texts = self.tokenizer.decode_batch(plain, skip_special_tokens=False)
        return [text[1:] if self.model.dummy_prefix and text[:1] == " " else text for text in texts]

    def normalized(self, text: str) -> str:
        """What decoding must give: SentencePiece takes a marker in a text for a blank."""
        return self.plain.normalize_str(text).replace(MARK, " ")


def _in_turns(rows: pd.DataFrame, size: int = BATCH) -> Iterator[pd.DataFrame]:
    for at in range(0, len(rows), size):
        yield rows.iloc[at : at + size]


def _looked_up(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Rows in a row, of LOOKED_UP characters and one text more at most."""
    turn = rows["text"].str.len().cumsum().to_numpy() // LOOKED_UP
    for some in np.split(np.arange(len(rows)), np.flatnonzero(np.diff(turn)) + 1):
        yield rows.iloc[some]


def encoded(docs: DataFrame, model_path: str, with_ids: bool = False) -> DataFrame:
    """Per row: ``doc_id, n_pieces, ids_crc32, parity, round_trip``, and ``ids`` if asked for.

    ``parity``: SentencePiece gives the same ids.  ``round_trip``:
    decoding gives the normalised text, which is the text itself if the model has
    no rules (a word-start marker in a text counts as a blank).  ``ids_crc32`` is of the ids as little-endian unsigned 32-bit integers.
    Null and empty texts have no ids.  The model is read from ``model_path`` by the
    driver and sent to the tasks.  Very long texts are encoded whole, each by itself;
    repeated rows give repeated results, an empty table none; other columns are not
    read, whatever their names.
    """
    with open(model_path, "rb") as file:
        data = file.read()
    schema = "doc_id long, n_pieces long, ids_crc32 long, parity boolean, round_trip boolean"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = kept("codec", zlib.crc32(data), lambda: Codec(data))
        for batch in batches:
            for rows in _looked_up(batch.assign(text=batch["text"].fillna("").astype(object))):
                every = codec.raw_ids(list(rows["text"]))
                for at in range(0, len(rows), BATCH):
                    raw, texts = every[at : at + BATCH], list(rows["text"].iloc[at : at + BATCH])
                    ids, same = codec.compared(texts, raw)
                    out = {
                        "doc_id": rows["doc_id"].iloc[at : at + BATCH],
                        "n_pieces": [len(some) for some in ids],
                        "ids_crc32": list(map(zlib.crc32, raw)),
                        "parity": same,
                        "round_trip": [a == b for a, b in zip(codec.decode(ids), map(codec.normalized, texts))],
                    }
                    if with_ids:
                        out["ids"] = ids
                    yield pd.DataFrame(out)

    return docs.select("doc_id", "text").mapInPandas(lean(run), schema + (", ids array<int>" if with_ids else ""))


def decoded(ids: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, text`` of rows ``doc_id, ids``; null or no ids are the empty text, no rows none."""
    with open(model_path, "rb") as file:
        data = file.read()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = kept("codec", zlib.crc32(data), lambda: Codec(data))
        for batch in batches:
            for rows in _in_turns(batch):
                parts = [[] if some is None else list(some) for some in rows["ids"]]
                yield pd.DataFrame({"doc_id": rows["doc_id"], "text": codec.decode(parts)})

    return ids.select("doc_id", "ids").mapInPandas(lean(run), "doc_id long, text string")
