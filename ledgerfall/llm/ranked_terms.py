"""Ranked lexical search, term at a time with limited accumulators.

1. Each part of the documents becomes shards of an inverted index: postings by term,
   in one row per shard, of a bounded number of documents and postings.
2. The number of documents, their length and each query term's documents are sums over
   shards, so weights are those of the whole collection.
3. A task takes blocks of queries through its shards.  A query's terms are taken
   rarest first.  While what the remaining terms can give at most, the sum of their
   best scores in the shard, may still lift a new document to the k-th best score,
   a posting makes an accumulator for its document.  Once it cannot, no accumulator
   is made any more, and those there are updated to the end, exactly.  The k-th best
   score is that of the query's best documents so far, in this shard or an earlier
   one of the task.
4. The best of all tasks are merged; scores of all shards compare.

All numbers but a term's weight are whole, so scores do not depend on the order of
their sums.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerfall.llm.shared import lean, stored

K = 50
#: A shard is closed once it has so many documents or postings; it holds one document at least.
SHARD_DOCS, SHARD_POSTINGS = 8192, 1 << 21
#: Queries go to the tasks in blocks of so many terms; a block holds one query at least.
BLOCK_TERMS = 1 << 17
#: Documents whose postings are counted before the next batch is asked for.
BATCH_ROWS = 512

#: ASCII bytes that are no letters or digits part terms; of the others only A-Z are changed.
FOLD = bytes(
    c if c >= 0x80 or chr(c).isdigit() or "a" <= chr(c) <= "z" else c + 32 if "A" <= chr(c) <= "Z" else 0x20
    for c in range(256)
)

INDEX = (
    "n_docs long, n_terms long, doc_ids array<long>, lengths binary, terms array<string>, dfs array<int>, "
    "docs binary, tfs binary"
)


def terms_of(text: str | None) -> list[bytes]:
    return text.encode().translate(FOLD).split() if text else []


class _Builder:
    """Postings of the documents of one shard."""

    def __init__(self) -> None:
        self.vocabulary: defaultdict[bytes, int] = defaultdict()
        self.vocabulary.default_factory = self.vocabulary.__len__
        self.doc_ids: list[int | None] = []
        self.lengths: list[int] = []
        self.sizes: list[int] = []
        self.ids: list[int] = []
        self.tfs: list[int] = []

    def add(self, doc_id: int | None, terms: list[bytes]) -> None:
        counted = Counter(terms)
        self.doc_ids.append(doc_id)
        self.lengths.append(len(terms))
        self.sizes.append(len(counted))
        self.ids.extend(map(self.vocabulary.__getitem__, counted))
        self.tfs.extend(counted.values())

    def full(self) -> bool:
        return len(self.sizes) >= SHARD_DOCS or len(self.ids) >= SHARD_POSTINGS

    def row(self) -> dict:
        # Documents in the order of their ids, so that of equal scores the first is the better one.
        order = sorted(range(len(self.sizes)), key=lambda i: (self.doc_ids[i] is not None, self.doc_ids[i] or 0))
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        docs = np.repeat(place, self.sizes)
        names = sorted(self.vocabulary)
        rank = np.empty(len(names), np.int32)
        rank[[self.vocabulary[name] for name in names]] = np.arange(len(names), dtype=np.int32)
        ids = rank[np.array(self.ids, np.int32)]
        by_term = np.lexsort((docs, ids))
        return {
            "n_docs": len(order),
            "n_terms": sum(self.lengths),
            "doc_ids": [self.doc_ids[i] for i in order],
            "lengths": np.array(self.lengths, "<i8")[order].tobytes(),
            "terms": [name.decode() for name in names],
            "dfs": np.bincount(ids, minlength=len(names)).astype(np.int32),
            "docs": docs[by_term].astype("<i4").tobytes(),
            "tfs": np.array(self.tfs, "<i4")[by_term].tobytes(),
        }


SHARD_TYPE = pa.schema(
    [
        ("n_docs", pa.int64()), ("n_terms", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.binary()),
        ("terms", pa.list_(pa.string())), ("dfs", pa.list_(pa.int32())), ("docs", pa.binary()), ("tfs", pa.binary()),
    ]
)


def index(docs: DataFrame) -> DataFrame:
    """Shards of the inverted index of ``doc_id, text``, stored: one row each, all terms of all documents.

    Documents without a term are in none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Builder()
        for batch in batches:
            for at in range(0, len(batch), BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    if terms := terms_of(text):
                        shard.add(doc_id, terms)
                        if shard.full():
                            yield pa.RecordBatch.from_pylist([shard.row()], SHARD_TYPE)
                            shard = _Builder()
        if shard.sizes:
            yield pa.RecordBatch.from_pylist([shard.row()], SHARD_TYPE)

    return stored(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lean(run), INDEX))


def query_terms(queries: DataFrame) -> DataFrame:
    """``item_id, terms``: different terms of each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted({term.decode() for term in terms_of(text)}) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], ["item_id", "terms"])

    return queries.select("item_id", "text").mapInArrow(run, f"item_id {queries.schema['item_id'].dataType.simpleString()}, terms array<string>")


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def weighted(shards: DataFrame, queries: DataFrame) -> tuple[DataFrame, int, int]:
    """Queries as ``number, item_id, terms array<struct<df, term>>`` rarest first; documents and terms of all shards.

    Terms that no document has are left out, they score nothing.
    """
    n, length = shards.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    each = query_terms(queries).withColumn("number", F.monotonically_increasing_id())
    wanted = stored(each).select("number", "item_id", F.explode("terms").alias("term"))
    counts = shards.select(F.explode(F.arrays_zip("terms", "dfs")).alias("t")).select("t.terms", "t.dfs")
    # Only terms that are asked for are summed.
    asked = counts.join(wanted.select("term").distinct(), F.col("terms") == F.col("term"), "left_semi")
    dfs = asked.groupBy(F.col("terms").alias("term")).agg(F.sum("dfs").alias("df"))
    told = wanted.join(dfs, "term").groupBy("number", "item_id").agg(F.sort_array(F.collect_list(F.struct("df", "term"))).alias("terms"))
    return stored(told), n, length


@dataclass(frozen=True)
class Block:
    """Queries by their place in the block; terms rarest first."""

    numbers: list[int]
    words: list[str]
    weights: np.ndarray
    queries: list[np.ndarray]  # places in ``words``


def _blocks(told: DataFrame, n: int) -> Iterator[Block]:
    """Queries in blocks of bounded size, one block at a time on the driver."""
    rows: list = []
    size = 0

    def block() -> Block:
        known: dict[str, int] = {}
        weights: list[int] = []
        queries = []
        for row in rows:
            places = []
            for t in row["terms"]:
                if t["term"] not in known:
                    known[t["term"]] = len(weights)
                    weights.append(weight(n, t["df"]))
                places.append(known[t["term"]])
            queries.append(np.array(places, np.int64))
        return Block([row["number"] for row in rows], list(known), np.array(weights, np.int64), queries)

    for row in told.select("number", "terms").toLocalIterator():
        if rows and size + len(row["terms"]) > BLOCK_TERMS:
            yield block()
            rows, size = [], 0
        rows.append(row)
        size += len(row["terms"])
    if rows:
        yield block()


def parts(tfs: np.ndarray, lengths: np.ndarray, n: int, total: int) -> np.ndarray:
    """A posting's score without the term's weight."""
    m = 50 + (50 * lengths * n) // total
    return (1_000_000_000 * tfs) // (1000 * tfs + 20 * m)


@dataclass
class Work:
    """What a search has touched, for tests and figures."""

    postings: int = 0
    created: int = 0
    updates_after: int = 0


def search_shard(
    postings: list[tuple[np.ndarray, np.ndarray]], size: int, k: int, floor: int, work: Work | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of a shard's documents that can be among the best k, given terms rarest first.

    ``postings`` are (places, scores) per term; a document with a score under
    ``floor`` is not among the best.  All that score more than the k-th are returned, and
    those that score as much.
    """
    best = [int(scores.max()) if len(scores) else 0 for _, scores in postings]
    left = np.cumsum(best[::-1])[::-1].tolist()  # with the term itself
    total = np.zeros(size, np.int64)
    open_, at = np.zeros(size, bool), 0
    made = 0
    for at, (places, scores) in enumerate(postings):
        if made >= k or floor > 0:
            # Only a strictly lower bound ends it: of equal scores the document may be the better one.
            live = total[open_] if made >= k else np.zeros(0, np.int64)
            kth = int(np.partition(live, len(live) - k)[len(live) - k]) if made >= k else 0
            if left[at] < max(kth, floor):
                break
        total[places] += scores
        open_[places] = True
        made = int(np.count_nonzero(open_))
        if work:
            work.postings += len(places)
    else:
        at = len(postings)
    if work:
        work.created += made
    for places, scores in postings[at:]:
        held = open_[places]
        total[places[held]] += scores[held]
        if work:
            work.updates_after += int(np.count_nonzero(held))
    found = np.flatnonzero(open_ & (total > 0) & (total >= floor))
    if len(found) > k:
        scores = total[found]
        found = found[scores >= np.partition(scores, len(scores) - k)[len(scores) - k]]
    return found, total[found]


def _search(batches: Iterator[pa.RecordBatch], block: Block, k: int, n: int, total: int) -> Iterator[pa.RecordBatch]:
    """A block of queries through the shards of one task: each query's best k."""
    best: list[list[tuple[int, bool, int]]] = [[] for _ in block.queries]  # (-score, has an id, id), best first
    words = pa.array(block.words, pa.string())
    for batch in batches:
        columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        for i in range(len(batch)):
            take = lambda name, kind: np.frombuffer(columns[name][i].as_buffer(), kind)  # noqa: B023, E731
            lengths, docs, tfs = take("lengths", "<i8"), take("docs", "<i4"), take("tfs", "<i4")
            ends = np.cumsum(np.asarray(columns["dfs"][i].values), dtype=np.int64)
            where = pc.index_in(words, value_set=columns["terms"][i].values).to_pylist()
            lists: list[tuple[np.ndarray, np.ndarray] | None] = []
            for word, place in enumerate(where):
                if place is None:
                    lists.append(None)
                    continue
                span = slice(int(ends[place - 1]) if place else 0, int(ends[place]))
                some = docs[span].astype(np.int64)
                lists.append((some, block.weights[word] * parts(tfs[span].astype(np.int64), lengths[some], n, total)))
            ids = columns["doc_ids"][i].as_py()
            for q, places in enumerate(block.queries):
                had = best[q]
                floor = -had[k - 1][0] if len(had) >= k else 0
                postings = [lists[p] for p in places.tolist() if lists[p] is not None]
                if not postings:
                    continue
                found, scores = search_shard(postings, len(lengths), k, floor)
                if len(found):
                    new = [(-s, ids[d] is not None, ids[d] or 0) for d, s in zip(found.tolist(), scores.tolist())]
                    best[q] = sorted(had + new)[:k]
    rows = [(block.numbers[q], doc if named else None, -score) for q, had in enumerate(best) for score, named, doc in had]
    if rows:
        numbers, docs, scores = zip(*rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int64()), pa.array(docs, pa.int64()), pa.array(scores, pa.int64())],
            ["number", "doc_id", "score"],
        )


def top_k(docs: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """For each row of ``queries`` (``item_id, text``) its ``k`` best documents: ``item_id, rank, doc_id, score``.

    Best first, equal scores by ascending ``doc_id`` (null first); fewer than ``k``
    if fewer score above zero.  Null, empty and termless texts score nothing and do
    not count as documents; queries without a term have no rows.  Rows that repeat
    an id are documents, or queries, each.  Texts of any length are read whole;
    other columns are not read.  Empty tables give an empty result.
    """
    shards = index(docs)
    told, n, total = weighted(shards, queries)
    found = None
    for block in _blocks(told, n):

        def run(batches: Iterator[pa.RecordBatch], block: Block = block) -> Iterator[pa.RecordBatch]:
            yield from _search(batches, block, k, n, total)

        # Best documents of each task, whose shards are searched one after the other.
        some = shards.mapInArrow(lean(run), "number long, doc_id long, score long")
        found = some if found is None else found.unionByName(some)
    kind = queries.schema["item_id"].dataType.simpleString()
    if found is None:
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    order = Window.partitionBy("number").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(told.select("number", "item_id"), "number").select("item_id", "rank", "doc_id", "score")


#: The same in DuckDB.
ORACLE = r"""
WITH split AS (
    SELECT doc_id, row_number() OVER () AS mark,
        unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents
), postings AS (SELECT mark, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM split GROUP BY mark, term),
lengths AS (SELECT mark, sum(tf)::BIGINT AS n FROM postings GROUP BY mark),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS len FROM lengths),
weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM postings, totals GROUP BY term
), asked AS (
    SELECT DISTINCT q, item_id, term FROM (
        SELECT row_number() OVER () AS q, item_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark)
), scored AS (
    SELECT q, item_id, mark, doc_id,
        sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * docs) // len)))))::BIGINT AS score
    FROM asked JOIN postings USING (term) JOIN lengths USING (mark) JOIN weights USING (term), totals
    GROUP BY q, item_id, mark, doc_id
), ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS FIRST)::INTEGER AS rank, doc_id, score
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""
