"""Exact removal of passages that occur earlier, by repeated-phrase automata.

A window is ``window`` consecutive words.  Words covered by a window that also
starts earlier (smaller document, or earlier in the same one) go.

1. Anchors.  Of each window, the shorter phrase with the least hash is its anchor.
   Equal windows have equal anchors, and neighbouring windows mostly share one, so
   anchors are some seven times fewer than words.  Only anchors that occur twice
   can belong to a recurring window; the others are gone here.
2. Pieces.  Neighbouring windows with one anchor are a piece.  A piece that occurs
   again is a confirmed recurring passage, with its first place.  Where an anchor
   has several different pieces (at the ends of passages, around edits), windows of
   the different pieces are compared one by one, also with their first places.
3. Automata.  Documents are read in shards of bounded size; the confirmed passages
   that occur in a shard's documents are compiled into an Aho-Corasick automaton
   over words, and all documents of the shard are streamed through it.  Whatever it
   finds after the passage's first place is marked.

Anchors, pieces and windows have hashes of 64 bits; within one anchor, where all rows
share the anchor's, those of pieces and windows tell them apart, all 64 bits of them.
Step 3 compares words at later places; first places are known by these hashes.  Nothing is
gathered per passage, however many documents share it: groupings are pre-aggregated,
and each join has one row per key on one side.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import compress, repeat

import ahocorasick
import numpy as np
import pyarrow
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfall.llm.shared import lean, numbered, stored

WINDOW = 20
ANCHOR = 8
BASE = 0x9E3779B97F4A7C15
#: Words of documents in a shard, unless one document has more.
SHARD_WORDS = 400_000
#: Different words that an automaton can tell apart: code points below the surrogates and above them.
ALPHABET = 1_000_000


def _rolling(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of word hashes times powers, and the inverse powers (all modulo 2**64)."""
    n = len(words)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
    powers = np.full(n, BASE, np.uint64)
    inverse = np.full(n, pow(BASE, -1, 1 << 64), np.uint64)
    powers[0] = inverse[0] = 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * np.multiply.accumulate(powers), out=sums[1:])
    return sums, np.multiply.accumulate(inverse)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _sequences(sums: np.ndarray, inverse: np.ndarray, starts: np.ndarray, length) -> np.ndarray:
    """Hashes of word sequences, the same wherever they stand."""
    return _mixed((sums[starts + length] - sums[starts]) * inverse[starts])


def pieces_of(words: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per piece: anchor hash, first window, number of windows, hash."""
    n = len(words) - window + 1
    if n < 1:
        none = np.empty(0, np.int64)
        return none.astype(np.uint64), none, none, none.astype(np.uint64)
    sums, inverse = _rolling(words)
    anchor = min(ANCHOR, window)
    phrases = _sequences(sums, inverse, np.arange(len(words) - anchor + 1), anchor)
    least = np.lib.stride_tricks.sliding_window_view(phrases, window - anchor + 1).argmin(1) + np.arange(n)
    first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    count = np.diff(np.r_[first, n])
    return phrases[least[first]], first, count, _sequences(sums, inverse, first, count + window - 1)


def _anchors(docs: DataFrame, window: int) -> DataFrame:
    """``seq, h`` of every piece."""

    def run(batches: Iterator[pyarrow.RecordBatch]) -> Iterator[pyarrow.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                rows = batch.slice(at, 500)
                found = [pieces_of(text.encode().split(), window)[0] for text in rows["text"].to_pylist()]
                seq = np.repeat(np.asarray(rows["seq"]), [len(x) for x in found])
                yield pyarrow.record_batch({"seq": seq, "h": np.concatenate(found).view(np.int64)})

    return docs.select("seq", "text").mapInArrow(lean(run), "seq long, h long")


def _pieces(docs: DataFrame, window: int) -> DataFrame:
    """Pieces at the anchors ``hs``: ``h, k, seq, a, n_windows``."""

    def of(rows: pyarrow.RecordBatch) -> pyarrow.RecordBatch:
        parts: list[tuple[np.ndarray, ...]] = []
        wanted = rows["hs"].to_numpy(zero_copy_only=False)
        for text, some in zip(rows["text"].to_pylist(), wanted):
            h, first, count, whole = pieces_of(text.encode().split(), window)
            keep = np.isin(h.view(np.int64), some)
            parts.append((h[keep], whole[keep], first[keep], count[keep]))
        h, whole, first, count = map(np.concatenate, zip(*parts))
        seq = np.repeat(np.asarray(rows["seq"]), [len(part[0]) for part in parts])
        return pyarrow.record_batch(
            {
                "h": h.view(np.int64), "k": whole.view(np.int64), "seq": seq, "a": first.astype(np.int32),
                "n_windows": count.astype(np.int32),
            }
        )

    def run(batches: Iterator[pyarrow.RecordBatch]) -> Iterator[pyarrow.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                yield of(batch.slice(at, 500))

    return docs.select("seq", "text", "hs").mapInArrow(
        lean(run), "h long, k long, seq long, a int, n_windows int"
    )


def _windows(docs: DataFrame, places: DataFrame, window: int) -> DataFrame:
    """Hashes of all windows of the pieces at ``places`` (``h, seq, a, n_windows``): ``h, seq, a, wins``."""
    each = places.groupBy("seq").agg(F.collect_list(F.struct("h", "a", "n_windows")).alias("at"))
    at = [F.col(f"at.{name}").alias(name) for name in ("h", "a", "n_windows")]

    def of(rows: pyarrow.RecordBatch) -> pyarrow.RecordBatch:
        found: list[np.ndarray] = []
        columns = [rows[name].to_numpy(zero_copy_only=False) for name in ("h", "a", "n_windows")]
        for text, first, count in zip(rows["text"].to_pylist(), *columns[1:]):
            sums, inverse = _rolling(text.encode().split())
            found += [_sequences(sums, inverse, np.arange(a, a + n), window) for a, n in zip(first, count)]
        seq = np.repeat(np.asarray(rows["seq"]), [len(some) for some in columns[0]])
        h, first, count = map(np.concatenate, columns)
        edges = np.r_[0, np.cumsum(count)].astype(np.int32)
        wins = pyarrow.ListArray.from_arrays(edges, np.concatenate(found).view(np.int64))
        return pyarrow.record_batch({"h": h, "seq": seq, "a": first.astype(np.int32), "wins": wins})

    def run(batches: Iterator[pyarrow.RecordBatch]) -> Iterator[pyarrow.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                yield of(batch.slice(at, 500))

    rows = docs.select("seq", "text").join(each, "seq").select("seq", "text", *at)
    return rows.mapInArrow(lean(run), "h long, seq long, a int, wins array<long>")


def _found(docs: DataFrame, pieces: DataFrame, window: int) -> DataFrame:
    """Recurring passages at places after their first: ``seq, a, len, first_seq, first_a``."""
    pieces = stored(pieces)
    different = stored(
        pieces.groupBy("h", "k", "n_windows").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("seq", "a")).alias("first")
        )
    )
    again = different.where("n > 1").select("h", "k", "n_windows", "first.seq", "first.a").withColumnsRenamed(
        {"seq": "first_seq", "a": "first_a"}
    )
    later = lambda df: df.where("first_seq < seq OR first_seq = seq AND first_a < a")
    whole = later(pieces.select("h", "k", "n_windows", "seq", "a").join(again, ["h", "k", "n_windows"])).select(
        "seq", "a", (F.col("n_windows") + window - 1).alias("len"), "first_seq", "first_a"
    )
    several = different.groupBy("h").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("h")
    # Only these are looked into window by window, each different piece once.
    places = different.join(several, "h").select("h", "first.seq", "first.a", "n_windows")
    windows = stored(_windows(docs, places, window)).select(
        "h", "seq", "a", F.posexplode("wins").alias("i", "w")
    ).select("h", "w", "seq", (F.col("a") + F.col("i")).alias("a"))
    twice = windows.groupBy("h", "w").agg(
        F.count(F.lit(1)).alias("kinds"), F.min(F.struct("seq", "a")).alias("first")
    ).where("kinds > 1").select("h", "w", F.col("first.seq").alias("first_seq"), F.col("first.a").alias("first_a"))
    single = later(windows.join(twice, ["h", "w"])).select("seq", "a", F.lit(window).alias("len"), "first_seq", "first_a")
    return whole.unionByName(single)


class Automata:
    """Aho-Corasick automata over words; a word is one code point, words of no passage are code point zero."""

    def __init__(self) -> None:
        self.shards: list[tuple[dict[bytes, str], ahocorasick.Automaton]] = []
        self.shortest = 1 << 30

    def add(self, phrase: list[bytes], first: tuple[int, int]) -> None:
        if not self.shards or len(self.shards[-1][0]) + len(phrase) > ALPHABET:
            self.shards.append(({}, ahocorasick.Automaton()))
        codes, automaton = self.shards[-1]
        self.shortest = min(self.shortest, len(phrase))
        try:
            text = "".join([codes[word] for word in phrase])
        except KeyError:
            for word in phrase:
                if word not in codes:
                    code = len(codes) + 1
                    codes[word] = chr(code if code < 0xD800 else code + 0x800)
            text = "".join([codes[word] for word in phrase])
        known = automaton.get(text, None)
        if known is None or first < known[1]:
            automaton.add_word(text, (len(phrase), first))

    def close(self) -> None:
        for _, automaton in self.shards:
            automaton.make_automaton()

    def later(self, words: list[bytes], seq: int) -> np.ndarray:
        """Which words are in a passage that starts after its first place."""
        steps = np.zeros(len(words) + 1, np.int64)
        for codes, automaton in self.shards:
            text = "".join(map(codes.get, words, repeat("\0")))
            starts, ends = [], []
            # Words of no passage part the text; what is too short for any passage needs no look.
            for run in re.finditer(f"[^\0]{{{self.shortest},}}", text):
                shift = run.start() + 1
                for end, (length, first) in automaton.iter(run[0]):
                    end += shift
                    if first < (seq, end - length):
                        starts.append(end - length)
                        ends.append(end)
            if starts:
                np.add.at(steps, starts, 1)
                np.add.at(steps, ends, -1)
        return np.cumsum(steps[:-1]) > 0


def _shards(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    shard, size = [], 0
    for row in rows:
        shard.append(row)
        size += len(row[2])
        if size >= SHARD_WORDS:
            yield shard
            shard, size = [], 0
    if shard:
        yield shard


PLACES = ("a", "len", "first_seq", "first_a")


def _marked(docs: DataFrame, with_text: bool) -> DataFrame:
    """Documents with the places ``found`` in them, through the automata of their shard."""

    def read(batches: Iterator[pyarrow.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                rows = batch.slice(at, 500)
                places = [rows[name].to_pylist() for name in PLACES]
                yield from zip(
                    rows["doc_id"].to_pylist(), rows["seq"].to_pylist(),
                    (text.encode().split() for text in rows["text"].to_pylist()), zip(*places),
                )

    def run(batches: Iterator[pyarrow.RecordBatch]) -> Iterator[pyarrow.RecordBatch]:
        for shard in _shards(read(batches)):
            automata = Automata()
            for _, _, words, (starts, lengths, first_seqs, first_starts) in shard:
                for a, length, first in zip(starts or (), lengths or (), zip(first_seqs or (), first_starts or ())):
                    automata.add(words[a : a + length], first)
            automata.close()
            out = []
            for doc_id, seq, words, _ in shard:
                gone = automata.later(words, seq)
                removed = int(gone.sum())
                kept = b" ".join(compress(words, (~gone).tolist()) if removed else words)
                out.append((doc_id, len(words), removed, hashlib.sha256(kept).hexdigest(), kept.decode()))
            ids, sizes, counts, digests, texts = zip(*out)
            columns = {
                "doc_id": pyarrow.array(ids, pyarrow.int64()), "n_words": pyarrow.array(sizes, pyarrow.int64()),
                "n_removed": pyarrow.array(counts, pyarrow.int64()), "kept_sha256": pyarrow.array(digests),
            }
            yield pyarrow.record_batch({**columns, "text": pyarrow.array(texts)} if with_text else columns)

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", text string" * with_text
    return docs.select("doc_id", "seq", "text", *(F.col(f"found.{name}").alias(name) for name in PLACES)).mapInArrow(
        lean(run), schema
    )


def _in_order(docs: DataFrame) -> DataFrame:
    """``doc_id, text, seq``: ``seq`` is the id if ids are unique, else the place among (id, text hash).

    Null ids come first; rows equal in both are one document given several times.
    """
    plain = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    mark = F.xxhash64("text")
    counts = plain.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR doc_id IS NULL")
    if counts.isEmpty():
        return plain.withColumn("seq", F.col("doc_id"))
    keys = plain.select(F.col("doc_id").alias("key"), mark.alias("mark")).distinct()
    places = stored(numbered(keys, [F.col("key").asc_nulls_first(), F.col("mark")], "seq").select("key", "mark", "seq"))
    same = plain["doc_id"].eqNullSafe(places["key"]) & (mark == places["mark"])
    return stored(plain.join(places, same).select("doc_id", "text", "seq"))


def without_repeats(docs: DataFrame, window: int = WINDOW, with_text: bool = True) -> DataFrame:
    """Per row: ``doc_id, n_words, n_removed, kept_sha256``, and ``text`` (the kept words, joined by one space).

    Null and empty texts have no words.  Documents shorter than a window keep all.
    Rows that repeat an id are documents in the order of a hash of their texts; rows
    that repeat id and text are one document and have its result.  Very long texts are
    read whole; an empty table gives no rows.  Other columns are not read.
    """
    docs = _in_order(docs)
    anchors = stored(_anchors(docs.select("seq", "text"), window))
    # Stored, so that the join below has an exchange of its own on both sides and a frequent anchor can be split.
    recurring = stored(anchors.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"))
    wanted = anchors.join(recurring, "h").groupBy("seq").agg(F.collect_set("h").alias("hs"))
    pieces = _pieces(docs.select("seq", "text").join(wanted, "seq"), window)
    found = _found(docs, pieces, window).groupBy("seq").agg(
        F.collect_list(F.struct(*PLACES)).alias("found")
    )
    return _marked(docs.join(found, "seq", "left"), with_text)
