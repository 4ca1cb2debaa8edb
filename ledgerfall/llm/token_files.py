"""Token ids in binary files, document boundaries as Elias-Fano sequences.

A file holds some consecutive documents in ascending ``doc_id`` order:

    magic, five unsigned 64-bit numbers: documents, ids, low bits, id bytes, high words
    document ids      signed 64-bit; a presence byte each (a null id is stored as zero)
    low parts         the low bits of every document's end, packed
    high parts        a bit string: the k-th document sets bit (end >> low bits) + k
    select samples    where every 64th set bit of the high parts is
    ids               one array, of 2 or 4 bytes each

An end costs two bits and its low bits, near the least that a monotone sequence can
take.  The k-th set bit is found from a sample and a few words after it, so one
document's ids are read without decoding the other boundaries.

Files are named by their place in the order.  A task that runs again writes the
same bytes under the same name, first aside, then renamed: a lost executor leaves
no half file.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerfall.llm.shared import kept, lean, put_file, stored
from ledgerfall.sources.scratch import scratch_folder

MAGIC = b"LFTOKEF1"
HEADER = "<8s5Q"
SAMPLE = 64
#: A file is closed once it has this many ids; it holds one document at least.
FILE_IDS = 1 << 21
#: Words a worker remembers, half of them from before it last started anew: bounds its memory.
MEMORY = 800_000
#: New words that are encoded as one text.
AT_ONCE = 100
#: Documents whose words are learnt together.
BATCH = 1024
END_ID = 2


def pack_low(values: np.ndarray, bits: int) -> bytes:
    """The lowest ``bits`` bits of each value, one after the other."""
    if not bits or not len(values):
        return b""
    each = (values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(each.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack_low(data: bytes, bits: int, first: int, count: int) -> np.ndarray:
    """``count`` packed values from the ``first`` on."""
    if not bits or not count:
        return np.zeros(count, np.uint64)
    start = first * bits
    stop = start + count * bits
    raw = np.frombuffer(data, np.uint8)[start // 8 : (stop + 7) // 8]
    each = np.unpackbits(raw, bitorder="little")[start % 8 :][: count * bits].reshape(count, bits)
    return (each.astype(np.uint64) << np.arange(bits, dtype=np.uint64)).sum(1, dtype=np.uint64)


@dataclass(frozen=True)
class EliasFano:
    """Ends of documents: a sequence that never falls."""

    count: int
    bits: int
    low: bytes
    high: np.ndarray
    samples: np.ndarray

    @classmethod
    def of(cls, ends: np.ndarray) -> EliasFano:
        ends = ends.astype(np.uint64)
        count, last = len(ends), int(ends[-1]) if len(ends) else 0
        bits = max(0, (last // count).bit_length() - 1) if count else 0
        ones = (ends >> np.uint64(bits)) + np.arange(count, dtype=np.uint64)
        flags = np.zeros((int(ones[-1]) // 64 + 1) * 64 if count else 0, np.uint8)
        flags[ones] = 1
        high = np.packbits(flags, bitorder="little").view(np.uint64)
        return cls(count, bits, pack_low(ends, bits), high, ones[::SAMPLE].copy())

    def select(self, k: int) -> int:
        """Position of the k-th set bit of the high parts."""
        at = int(self.samples[k // SAMPLE])
        left = k % SAMPLE
        word = at // 64
        bits = int(self.high[word]) >> (at % 64) << (at % 64)
        while (here := bits.bit_count()) <= left:
            left -= here
            word += 1
            bits = int(self.high[word])
        for _ in range(left):
            bits &= bits - 1
        return word * 64 + (bits & -bits).bit_length() - 1

    def end(self, k: int) -> int:
        first = k * self.bits
        raw = int.from_bytes(self.low[first // 8 : (first + self.bits + 7) // 8], "little")
        low = raw >> first % 8 & ((1 << self.bits) - 1)
        return ((self.select(k) - k) << self.bits) | low

    def ends(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little")).astype(np.uint64)
        high = ones - np.arange(self.count, dtype=np.uint64)
        return (high << np.uint64(self.bits)) | unpack_low(self.low, self.bits, 0, self.count)


def to_bytes(doc_ids: list[int | None], ids: list[bytes]) -> bytes:
    """One file: ids come as little-endian unsigned 32-bit integers per document."""
    every = np.frombuffer(b"".join(ids), "<u4")
    width = 2 if not len(every) or int(every.max()) < 1 << 16 else 4
    ends = EliasFano.of(np.cumsum([len(some) // 4 for some in ids], dtype=np.uint64))
    names = np.array([0 if name is None else name for name in doc_ids], "<i8")
    there = np.array([name is not None for name in doc_ids], np.uint8)
    return b"".join(
        (
            struct.pack(HEADER, MAGIC, len(ids), len(every), ends.bits, width, len(ends.high)),
            names.tobytes(), there.tobytes(), ends.low, ends.high.astype("<u8").tobytes(),
            ends.samples.astype("<u8").tobytes(), every.astype(f"<u{width}").tobytes(),
        )
    )


class TokenFile:
    """A file's documents by their place in it."""

    def __init__(self, data: bytes):
        magic, count, n_ids, bits, width, words = struct.unpack_from(HEADER, data)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = struct.calcsize(HEADER)

        def take(size: int) -> bytes:
            nonlocal at
            at += size
            return data[at - size : at]

        self.count = count
        self.doc_ids = np.frombuffer(take(8 * count), "<i8")
        self.present = np.frombuffer(take(count), np.uint8)
        low = take((count * bits + 7) // 8)
        high = np.frombuffer(take(8 * words), "<u8")
        samples = np.frombuffer(take(8 * -(-count // SAMPLE)), "<u8")
        self.bounds = EliasFano(count, bits, low, high, samples)
        self.ids = np.frombuffer(take(width * n_ids), f"<u{width}")

    def document(self, k: int) -> np.ndarray:
        start = self.bounds.end(k - 1) if k else 0
        return self.ids[start : self.bounds.end(k)]


class WordEncoder:
    """Ids of whole texts from those of their words, each word encoded once by the library.

    The tokenizer must not join anything over ASCII white space; this one drops it.
    New words go through the library many at a time.  If its pieces tell where a word
    ends, words of letters, and words of ASCII if its normaliser leaves their lengths, are
    parted by blanks: the lengths of the pieces must say the same of every word.  Others
    are parted by a special token, which takes no part in the words' ids, but at which the
    library takes a text apart, at a cost.
    """

    def __init__(self, tokenizer: str):
        self.tokenizer = Tokenizer.from_str(tokenizer)
        added = self.tokenizer.get_added_tokens_decoder()
        self.part_id = min((i for i, token in added.items() if token.special), default=None)
        self.part = added[self.part_id].content if added else ""
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}
        suffix = json.loads(tokenizer)["model"].get("end_of_word_suffix")
        #: Whether a piece ends a word, and its length in bytes.
        self.ends, self.lengths = np.zeros((2, self.tokenizer.get_vocab_size()), np.int64)
        for piece, i in self.tokenizer.get_vocab().items() if suffix else ():
            self.ends[i], self.lengths[i] = piece.endswith(suffix), len(piece.removesuffix(suffix))
        self.ascii_joined = bool(suffix) and self.keeps_ascii()

    def keeps_ascii(self) -> bool:
        """Whether ASCII characters, alone and in pairs, are normalised to as many bytes."""
        normal = self.tokenizer.normalizer
        signs = [chr(i) for i in range(33, 127)]
        texts = [*signs, *(a + b for a in signs for b in signs)]
        return normal is None or all(len(normal.normalize_str(text).encode()) == len(text) for text in texts)

    def learn_joined(self, new: list[bytes], whole: bool) -> list[bytes]:
        """Learns words parted by blanks; gives those back that the pieces do not tell apart.

        ``whole``: a word must be one for the pieces too, not several.
        """
        groups = [new[at : at + AT_ONCE] for at in range(0, len(new), AT_ONCE)]
        texts = [b" ".join(group).decode() for group in groups]
        left = []
        for group, found in zip(groups, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            so_far = np.cumsum(self.lengths[ids])[ends - 1]
            wanted = np.cumsum(list(map(len, group)))
            if not whole and len(ends):
                at = np.minimum(np.searchsorted(so_far, wanted), len(ends) - 1)
                ends, so_far = ends[at], so_far[at]
            if len(ends) != len(group) or ends[-1] != len(ids) or (so_far != wanted).any():
                left += group
                continue
            data, bounds = ids.tobytes(), (ends * 4).tolist()
            self.known.update(zip(group, map(data.__getitem__, map(slice, [0, *bounds], bounds))))
        return left

    def learn(self, new: list[bytes]) -> None:
        if self.ends.any():
            plain = [word for word in new if self.ascii_joined and word.isascii()]
            other = [word for word in new if not (self.ascii_joined and word.isascii())]
            letters = [word for word in other if word.decode().isalpha()]
            new = [word for word in other if not word.decode().isalpha()]
            new += self.learn_joined(plain, False) + self.learn_joined(letters, True)
        words = [word.decode() for word in new]
        together = [i for i, word in enumerate(words) if self.part and self.part not in word]
        alone = [i for i, word in enumerate(words) if not self.part or self.part in word]
        groups = [together[at : at + AT_ONCE] for at in range(0, len(together), AT_ONCE)]
        texts = [self.part.join([words[i] for i in group]) for group in groups]
        for group, found in zip(groups, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            parts = np.flatnonzero(ids == self.part_id)
            data = ids.tobytes()
            starts, ends = np.r_[0, parts * 4 + 4].tolist(), np.r_[parts * 4, len(data)].tolist()
            for i, start, end in zip(group, starts, ends, strict=True):
                self.known[new[i]] = data[start:end]
        for i, found in zip(alone, self.tokenizer.encode_batch_fast([words[i] for i in alone], add_special_tokens=False)):
            self.known[new[i]] = np.array(found.ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        parts = pc.ascii_split_whitespace(pyarrow.array(texts, pyarrow.large_string()))
        coded = parts.flatten().dictionary_encode()
        # Different words of these texts, as they come; the empty one stands beside white space at an end.
        every = coded.dictionary.cast(pyarrow.large_binary()).to_numpy(zero_copy_only=False).tolist()
        new = [word for word in every if word and word not in self.known]
        if len(self.known) + len(new) > MEMORY // 2:
            # Words that are met again are kept: they need not be learnt anew.
            self.before, self.known, new = self.known, {}, [word for word in every if word]
        if self.before:
            self.known.update((word, self.before.pop(word)) for word in new if word in self.before)
            new = [word for word in new if word not in self.known]
        self.learn(new)
        each = [self.known[word] if word else b"" for word in every]
        sizes, ids = np.fromiter(map(len, each), np.int64, len(each)) // 4, np.frombuffer(b"".join(each), "<u4")
        codes = coded.indices.to_numpy()
        lengths = sizes[codes]
        ends = np.r_[0, np.cumsum(lengths)]
        places = np.repeat((np.cumsum(sizes) - sizes)[codes] - ends[:-1], lengths) + np.arange(ends[-1])
        data, bounds = ids[places].tobytes(), (ends[parts.offsets.to_numpy()] * 4).tolist()
        return [data[start:end] for start, end in zip(bounds, bounds[1:])]


def write(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = END_ID) -> DataFrame:
    """Writes the files; one row per file: ``file, n_docs, n_ids, base`` (ids in all files before it).

    All rows are written, in the order of ``doc_id`` (nulls first), then of a hash
    of the text; null texts are empty, and each document ends with ``end_id``.
    Very long texts are encoded whole and fill files of their own; an empty table
    gives no file.  Other columns are not read, whatever their names.  ``folder`` must be
    reachable by all executors.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer = file.read()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mark = zlib.crc32(tokenizer.encode())
        encoder, end = kept("word encoder", mark, lambda: WordEncoder(tokenizer)), struct.pack("<I", end_id)
        task = TaskContext.get()
        names: list[int | None] = []
        parts: list[bytes] = []
        made = []

        def close() -> None:
            name = f"{task.partitionId():08d}-{len(made):06d}.ids"
            put_file(folder, name, to_bytes(names, parts))
            made.append((name, len(parts), sum(map(len, parts)) // 4))
            names.clear()
            parts.clear()

        size = 0
        for batch in batches:
            for at in range(0, len(batch), BATCH):
                rows = batch.iloc[at : at + BATCH]
                for doc_id, ids in zip(rows["doc_id"], encoder.encode(list(rows["text"].fillna("")))):
                    names.append(None if pd.isna(doc_id) else int(doc_id))
                    parts.append(ids + end)
                    size += len(ids) // 4 + 1
                    if size >= FILE_IDS:
                        close()
                        size = 0
        if parts:
            close()
        if made:
            yield pd.DataFrame(made, columns=["file", "n_docs", "n_ids"])

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    files = stored(rows.mapInPandas(lean(run), "file string, n_docs long, n_ids long"))
    # One row per some million ids: the only step that sees all of them in one task.
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return stored(files.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("long"))))


def read(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                file = TokenFile(content)
                ends = np.fromiter(map(file.bounds.end, range(file.count)), np.int64, file.count)
                starts = np.r_[0, ends][:-1]
                wide = file.ids.astype("<u4")
                yield pd.DataFrame(
                    {
                        "file": path.rpartition("/")[2],
                        "doc_id": pd.array(file.doc_ids, "Int64").copy() if file.present.all() else pd.array(
                            [int(i) if ok else None for i, ok in zip(file.doc_ids, file.present)], "Int64"),
                        "begin": starts,
                        "n_tokens": ends - starts,
                        "ids_crc32": [zlib.crc32(wide[a:b].tobytes()) for a, b in zip(starts, ends)],
                    }
                )

    found = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.ids").load(folder).select("path", "content")
        .mapInPandas(lean(run), "file string, doc_id long, begin long, n_tokens long, ids_crc32 long")
    )
    return found.join(files, "file").select(
        "doc_id", (F.col("base") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32"
    )


def written_and_read(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """The documents' boundaries and checksums as read back from files in a new shared folder.

    No documents: no files, no rows.
    """
    spark = docs.sparkSession
    folder = f"{scratch_folder(spark)}/ids"
    files = write(docs, tokenizer_path, folder, end_id)
    if files.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read(spark, folder, files)
