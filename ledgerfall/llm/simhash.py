"""SimHash near-duplicates, found with tables of distances to pivot fingerprints.

Fingerprints are 64 bits; different ones that differ in at most ``max_bits`` bits
are linked, and documents of linked fingerprints form a component.

1. Fingerprints, one pass over the texts; the table (id, fingerprint) is stored.
2. Equal fingerprints are one node, kept with their least id: groups of exact
   copies, however large, are gone after a pre-aggregated grouping.
3. Two fingerprints within ``max_bits`` agree in at least ``BLOCKS - max_bits`` of
   ``BLOCKS`` blocks, so each choice of that many blocks is a bucket key.  No link
   is lost and a bucket has about 32 bits of key, so few strangers meet.
4. Within a bucket the pivot table works: each fingerprint's distances to
   ``PIVOTS`` reference fingerprints.  By the triangle inequality a pair whose
   distances to any pivot differ by more than ``max_bits`` can be no link.  Rows are
   sorted by the first distance, so only a band of them is compared at all; the
   other columns discard pairs by their maximum difference; survivors are verified.
5. A bucket yields a spanning forest of its links, not all of them: the same
   components from fewer rows than it has fingerprints.
6. A bucket of more than ``TILE`` fingerprints is dealt to pairs of tiles, so that
   no task holds more than two tiles.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfall.llm.components import components
from ledgerfall.llm.shared import lean, stored

SHINGLE = 3
MAX_BITS = 3
SEED = 42
BLOCKS = 6
PIVOTS = 32
TILE = 1024
#: Shingles whose bits are counted at once.
STEP = 1 << 14


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """A-Z in lower case, words between ASCII white space, one hash per shingle occurrence.

    Fewer words than a shingle: the whole sequence is one; no words: zero.
    """
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        words, shingle = [b" ".join(words)], 1
    shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    n = len(words) - shingle + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, STEP):
        part = hashes[at : at + STEP].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp`` of every row; null texts are empty ones.  ``fp`` is the fingerprint as a signed long."""

    @F.pandas_udf("long")
    @lean
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = [fingerprint(text, shingle) for text in texts.fillna("")]
            yield pd.Series(np.array(found, np.uint64).view(np.int64))

    return docs.select("doc_id", of("text").alias("fp"))


def pivot_table(fps: np.ndarray) -> np.ndarray:
    """Hamming distances of fingerprints to fixed, random reference fingerprints: one row each."""
    pivots = np.random.default_rng(SEED).integers(0, 2**64, PIVOTS, np.uint64)
    return np.bitwise_count(fps[:, None] ^ pivots[None, :]).astype(np.int8)


def links_within(fps: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among fingerprints: positions of both ends."""
    n = len(fps)
    parent = np.arange(n)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    if n == 2:  # most buckets: the table would cost more than the distance
        linked = int(fps[0] ^ fps[1]).bit_count() <= max_bits
        return (np.array([0]), np.array([1])) if linked else (np.empty(0, int), np.empty(0, int))
    distances = pivot_table(fps)
    order = np.argsort(distances[:, 0], kind="stable")
    fps, distances = fps[order], distances[order]
    ends = np.searchsorted(distances[:, 0], distances[:, 0] + max_bits, "right")
    left, right = [], []
    for i in range(n - 1):
        band = slice(i + 1, ends[i])
        apart = np.abs(distances[band] - distances[i]).max(1, initial=0)
        near = np.flatnonzero(apart <= max_bits) + i + 1
        near = near[np.bitwise_count(fps[near] ^ fps[i]) <= max_bits]
        for j in near:
            a, b = root(i), root(j)
            if a != b:
                parent[b] = a
                left.append(order[i])
                right.append(order[j])
    return np.array(left, int), np.array(right, int)


def _bucket_keys(fp: Column, max_bits: int) -> Column:
    """For each choice of blocks: its number and the bits of those blocks."""
    edges = [round(64 * i / BLOCKS) for i in range(BLOCKS + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    keys = []
    for number, chosen in enumerate(combinations(masks, BLOCKS - max_bits)):
        mask = int(np.uint64(sum(chosen)).view(np.int64))
        keys.append(F.struct(F.lit(number).cast("byte").alias("choice"), fp.bitwiseAND(F.lit(mask)).alias("bits")))
    return F.array(*keys)


def fingerprint_links(nodes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links ``a, b`` between different fingerprints ``fp`` that give all components."""
    keyed = nodes.select("fp", F.explode(_bucket_keys(F.col("fp"), max_bits)).alias("key")).select("key.*", "fp")
    sizes = keyed.groupBy("choice", "bits").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    tiles = F.ceil(F.col("size") / TILE).cast("int")
    tile = F.pmod(F.xxhash64("fp"), tiles).cast("int")
    # A row goes to the tile pairs (t, own) with t <= own and (own, t) with t > own: to one if there is one tile.
    met = keyed.join(sizes, ["choice", "bits"]).withColumn(
        "t", F.explode(F.sequence(F.lit(0), tiles - 1))
    ).select(
        "choice", "bits", F.least("t", tile).alias("t1"), F.greatest("t", tile).alias("t2"), "fp"
    )
    groups = met.groupBy("choice", "bits", "t1", "t2").agg(F.collect_list("fp").alias("fps")).select("fps")

    def forests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            a, b = [], []
            for fps in batch["fps"]:
                fps = np.asarray(fps, np.int64)
                i, j = links_within(fps.view(np.uint64), max_bits)
                a.append(fps[i])
                b.append(fps[j])
            if a:
                yield pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)}).drop_duplicates()

    return groups.where(F.size("fps") > 1).mapInPandas(lean(forests), "a long, b long")


def _named(known: DataFrame, max_bits: int) -> DataFrame:
    """``fp, component`` of every fingerprint, and ``least``, its least id; stored."""
    nodes = known.groupBy("fp").agg(F.min("doc_id").alias("least"))
    members = components(fingerprint_links(nodes, max_bits))
    return stored(
        nodes.join(members, F.col("fp") == F.col("node"), "left").select(
            "fp", "least", F.coalesce("component", "fp").alias("component")
        )
    )


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """Per row of ``docs``: ``doc_id, fingerprint`` (16 hex digits), ``component_id``.

    ``component_id`` is the least id of the component.  Repeated rows give repeated
    results; a row without id has its fingerprint but no part in choosing the
    least, so a component of such rows alone has a null ``component_id``.  Null
    texts are empty: fingerprint zero, linked like any other.  Very long texts are
    fingerprinted whole, an empty table gives no rows.  Other columns are not read.
    """
    known = stored(fingerprints(docs, shingle))
    named = _named(known, max_bits)
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_fp = named.join(ids, "component").select("fp", "component_id")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return known.join(by_fp, "fp").select("doc_id", digits.alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component, that with the least id; the other members go.

    Of rows that share this id the one with the least hash of its text stays, so an
    id given to different texts costs none of them its own component's row; of rows
    that share the text as well, the first by a hash of all columns.  Rows without
    id can be no one's copy to name: they all stay.  Null texts are empty ones, an empty table
    gives no rows, and very long texts are fingerprinted whole.
    """
    mark = F.xxhash64("text")
    # The text's hash takes the place of an id beside it, so that a row is told by both.
    rows = docs.select(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", mark.alias("mark"))).alias("doc_id"), "text")
    known = stored(fingerprints(rows, shingle))
    named = _named(known, max_bits).select("component", "least").groupBy("component").agg(F.min("least").alias("head"))
    heads = named.where("head IS NOT NULL").select(F.col("head.doc_id").alias("__id"), F.col("head.mark").alias("__mark"))
    kept = docs.join(heads, (docs["doc_id"] == heads["__id"]) & (F.xxhash64(docs["text"]) == heads["__mark"]), "left_semi")
    columns = [docs[c] for c in docs.columns]
    each = kept.select(F.struct(*columns).alias("__row"), F.xxhash64(*columns).alias("__order"))
    first = each.groupBy(F.col("__row.doc_id").alias("__id"), F.xxhash64("__row.text").alias("__mark")).agg(
        F.min_by("__row", "__order").alias("__row")
    )
    return first.select("__row.*").unionByName(docs.where("doc_id IS NULL"))
