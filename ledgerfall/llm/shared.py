"""What several operators need: tables, scratch tables, folds, bounded fit samples, logistic fits."""

from __future__ import annotations

import ctypes
import functools
import gc
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerfall.sources.scratch import scratch_folder

SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """The rows, written once to the shared folder and read back: lineage ends here."""
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/part"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """The rows, stored, with their place in the order, from zero; ``part`` tells the range they are in.

    Only one row per range partition is brought together.
    """
    place = F.monotonically_increasing_id()
    rows = stored(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", place))
    part = F.shiftright("__at", 33)
    counts = rows.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    found = rows.join(F.broadcast(bases), part == F.col("__part"))
    within = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return found.withColumn(name, F.col("__base") + within).withColumnRenamed("__part", "part").drop("__at", "__base")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def label_counts(labels: DataFrame, label: str, learnable: Column) -> tuple[int, int]:
    """Labelled 0 and labelled 1, over every row that may be learned from."""
    row = labels.where(learnable).agg(F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)).first()
    return row[0], row[1]


def thinned(df: DataFrame, mark: Column, wanted: int, total: int) -> DataFrame:
    """Rows with small hashes, about four times as many as wanted: what a limit after it has to bring together."""
    share = min(1.0, 4 * (wanted + 100) / max(1, total))
    return df.where(F.pmod(mark, F.lit(1 << 30)) < int(share * (1 << 30)))


def fit_sample(docs: DataFrame, labels: DataFrame, label: str, learnable: Column, per_class: int) -> DataFrame:
    """At most ``2 * per_class`` labelled texts: ``doc_id, text, label``.

    Which ones is decided by a hash of the id, so any run gives the same.  The ids
    are at most ``2 * per_class`` rows, hence the broadcast.
    """
    known = labels.where(learnable).groupBy("doc_id").agg(F.max(label).alias("label"))
    ids = None
    for value, total in zip((0, 1), label_counts(labels, label, learnable)):
        some = thinned(known.where(F.col("label") == value), F.xxhash64("doc_id"), per_class, total)
        some = some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        ids = some if ids is None else ids.unionByName(some)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return (
        texts.join(F.broadcast(ids), "doc_id")
        .orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
        .limit(2 * per_class)
    )


def logistic(x: np.ndarray, y: np.ndarray, prior: float, ridge: float = 1e-3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means, scales and weights (intercept last) of a ridge logistic fit.

    The sample may have any class balance; the intercept is moved to that of all
    labels, given by ``prior``.
    """
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    penalty = ridge * len(x) * np.r_[np.ones(x.shape[1]), 0.0]
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty) + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(slope, z.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    share = min(max(y.mean(), 1e-6), 1 - 1e-6)
    w[-1] += np.log(prior / (1 - prior)) - np.log(share / (1 - share))
    return mean, scale, w


def probability(x: np.ndarray, fit: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    mean, scale, w = fit
    return 1 / (1 + np.exp(-np.clip(((x - mean) / scale) @ w[:-1] + w[-1], -30, 30)))


def words_of(text: str) -> list[str]:
    """Words between ASCII white space; other white space belongs to words."""
    return [word.decode() for word in text.encode().split()]


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task function that gives its memory back when it ends: workers live on and are counted idle too."""

    @functools.wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pyarrow.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except OSError:  # another C library
                pass

    return wrapped


def kept(name: str, mark: object, make: Callable[[], object]) -> object:
    """What a worker process made for an earlier task of the same kind, if ``mark`` is the same; else made anew.

    For memories of words: tasks that a worker runs one after the other share them.
    """
    memory = vars(sys.modules.setdefault("ledgerfall_kept", types.ModuleType("ledgerfall_kept")))
    if name not in memory or memory[name][0] != mark:
        memory[name] = mark, make()
    return memory[name][1]


def put_file(folder: str, name: str, data: bytes) -> str:
    """Writes a file of a task in a shared folder, whole or not at all; its path.

    Written aside and renamed.  Another attempt of the task may have been first: its
    file is the same and stays.
    """
    store, base = fs.FileSystem.from_uri(folder) if ":/" in folder else (fs.LocalFileSystem(), folder)
    store.create_dir(base, recursive=True)
    aside = f"{base}/_{name}.{TaskContext.get().taskAttemptId()}"
    with store.open_output_stream(aside) as out:
        out.write(data)
    if store.get_file_info(f"{base}/{name}").type == fs.FileType.NotFound:
        store.move(aside, f"{base}/{name}")
    else:
        store.delete_file(aside)
    return f"{folder}/{name}"
