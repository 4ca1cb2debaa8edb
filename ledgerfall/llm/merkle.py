"""Merkle manifest of a data set: a hash tree whose parents keep resumable hash states.

Rows are leaves; per group (a source) every 16 consecutive nodes have a parent, and
the groups' roots are the leaves of one more tree.  A parent is the SHA-256 of its
children's digests as hex text.  Such a digest is 64 bytes, exactly one block of
SHA-256, so the state of the hash before each child slot is 32 bytes and nothing
else: a parent's row holds a copy of it for each of its slots.  To fold a replaced
child into the root, the state before its slot is resumed with the replacement and
the siblings on its right; what stands on its left is never hashed again.

Leaves are numbered by range partitions and their counts, never by one sorted task;
every parent is made from at most 16 rows, so a group with most of all rows is
spread like any other; and a node meets its ancestors from the top down, where a
parent has at most 16 rows to meet.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfall.llm.shared import lean, numbered, stored

FAN = 16
DIGEST = 32
#: Parents whose rows are folded together.
TOGETHER = 512


# SHA-256 over many messages at once, from any state


def _primes(count: int) -> list[int]:
    found: list[int] = []
    n = 2
    while len(found) < count:
        if all(n % p for p in found):
            found.append(n)
        n += 1
    return found


def _cube_root(n: int) -> int:
    low, high = 0, 1 << (n.bit_length() // 3 + 1)
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if middle**3 <= n else (low, middle)
    return low


#: The standard's constants: 32 bits behind the point of roots of the first primes.
ROUND = np.array([_cube_root(p << 96) & 0xFFFFFFFF for p in _primes(64)], np.uint32)
START = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in _primes(8)], np.uint32)
HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x >> np.uint32(by)) | (x << np.uint32(32 - by))


def compress(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The states ``[n, 8]`` after one more block ``[n, 16]`` each."""
    w = list(np.ascontiguousarray(blocks.T))
    for i in range(16, 64):
        s0 = _turn(w[i - 15], 7) ^ _turn(w[i - 15], 18) ^ (w[i - 15] >> np.uint32(3))
        s1 = _turn(w[i - 2], 17) ^ _turn(w[i - 2], 19) ^ (w[i - 2] >> np.uint32(10))
        w.append(w[i - 16] + s0 + w[i - 7] + s1)
    before = np.ascontiguousarray(states.T)
    a, b, c, d, e, f, g, h = before
    for i in range(64):
        t1 = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + ROUND[i] + w[i]
        t2 = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        h, g, f, e, d, c, b, a = g, f, e, d + t1, c, b, a, t1 + t2
    return np.ascontiguousarray((before + np.stack((a, b, c, d, e, f, g, h))).T)


def _hex_block(digests: np.ndarray) -> np.ndarray:
    """Digests ``[n, 32]`` as hex text, as one block each."""
    text = np.empty((len(digests), 2 * DIGEST), np.uint8)
    text[:, 0::2], text[:, 1::2] = HEX[digests >> 4], HEX[digests & 15]
    return text.view(">u4").astype(np.uint32)


def _finish(states: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Digests ``[n, 32]`` of messages of so many blocks, from the states after them."""
    last = np.zeros((len(states), 16), np.uint32)
    last[:, 0] = 0x80000000
    last[:, 15] = counts * 512
    return compress(states, last).astype(">u4").view(np.uint8).reshape(-1, DIGEST)


def parents(children: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Digests ``[n, 32]`` of parents and their states ``[n, 16, 8]`` before each child slot."""
    state = np.tile(START, (len(children), 1))
    states = np.zeros((len(children), FAN, 8), np.uint32)
    for slot in range(FAN):
        some = np.flatnonzero(counts > slot)
        if not len(some):
            break
        states[some, slot] = state[some]
        state[some] = compress(state[some], _hex_block(children[some, slot]))
    return _finish(state, counts), states


@dataclass(frozen=True)
class Run:
    """Parents ``[n]`` with what they keep: children, states, number of children."""

    children: np.ndarray
    states: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, children: list[bytes], states: list[bytes]) -> Run:
        counts = np.array([len(x) // DIGEST for x in children], np.int64)
        kids = np.frombuffer(b"".join(x.ljust(FAN * DIGEST, b"\0") for x in children), np.uint8)
        kept = np.frombuffer(b"".join(x.ljust(FAN * DIGEST, b"\0") for x in states), "<u4")
        return cls(kids.reshape(-1, FAN, DIGEST), kept.reshape(-1, FAN, 8), counts)

    def fold(self, parent: np.ndarray, slot: np.ndarray, replacement: np.ndarray) -> np.ndarray:
        """Digests of ``parent`` with its child at ``slot`` replaced: resumed there, right siblings follow."""
        state = compress(self.states[parent, slot], _hex_block(replacement))
        counts = self.counts[parent]
        for step in range(1, FAN):
            some = np.flatnonzero(slot + step < counts)
            if not len(some):
                break
            state[some] = compress(state[some], _hex_block(self.children[parent[some], slot[some] + step]))
        return _finish(state, counts)


# The trees as tables


def leaf_digest(*fields: Column) -> Column:
    """SHA-256, 32 bytes, of the fields one after the other: ``-`` if null, else UTF-8 bytes, ``:``, value."""
    text = [field.cast("string") for field in fields]
    told = [F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in text]
    return F.unhex(F.sha2(F.concat(*told).cast("binary"), 256))


def _parents_of(children: pd.Series) -> pd.DataFrame:
    joined = [b"".join(some) for some in children]
    counts = np.array([len(x) // DIGEST for x in joined], np.int64)
    kids = np.frombuffer(b"".join(x.ljust(FAN * DIGEST, b"\0") for x in joined), np.uint8).reshape(-1, FAN, DIGEST)
    digests, states = parents(kids, counts)
    kept = states.astype("<u4").reshape(len(joined), -1).view(np.uint8)
    return pd.DataFrame(
        {
            "digest": [row.tobytes() for row in digests],
            "children": joined,
            "states": [row[: DIGEST * n].tobytes() for row, n in zip(kept, counts)],
        }
    )


def _level(nodes: DataFrame, *more: Column) -> DataFrame:
    """Parents of ``tree, idx, size, digest``: ``tree, node, size, digest, children, states``, stored."""
    runs = nodes.groupBy("tree", F.floor(F.col("idx") / FAN).alias("node")).agg(
        F.max("size").alias("below"),
        F.sort_array(F.collect_list(F.struct("idx", "digest", *more))).alias("run"),
    )
    made = F.pandas_udf(_parents_of, "digest binary, children binary, states binary")
    rows = runs.withColumn("made", made(F.col("run.digest")))
    extra = [F.col("run").getField(name).alias(name) for name in (x for x in nodes.columns if x in ("doc_id", "replacement"))]
    return stored(
        rows.select(
            "tree", "node", "below", F.ceil(F.col("below") / FAN).alias("size"), "made.digest", "made.children",
            "made.states", *(extra if more else []),
        )
    )


def _next(level: DataFrame) -> DataFrame:
    return level.where("size > 1").select("tree", F.col("node").alias("idx"), "size", "digest")


def _levels(first: DataFrame, most: int) -> list[DataFrame]:
    """All levels from the first parents on; ``most`` is the largest number of nodes that a tree has there."""
    found = [first]
    while most > 1:
        found.append(_level(_next(found[-1])))
        most = -(-most // FAN)
    return found


@dataclass(frozen=True)
class Manifest:
    """``groups``: group and its tree; ``levels`` of the groups' trees; ``top``: those of the tree over their roots."""

    groups: DataFrame
    levels: list[DataFrame]
    top: list[DataFrame]


def build(rows: DataFrame) -> Manifest | None:
    """The trees of ``group, doc_id, leaf, replacement`` (digests, the last null if nothing is replaced).

    Leaves of a group are in the order of ``doc_id`` (null first), then of the leaf;
    groups in that of their name's bytes (null first).  A group's single leaf is its
    root.  Repeated rows are leaves each.  No rows: no manifest.
    """
    order = [F.col("group").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf")]
    leaves = numbered(rows, order, "place")
    sizes = leaves.groupBy("group").agg(F.min("place").alias("start"), F.count(F.lit(1)).alias("size"))
    groups = stored(numbered(sizes, [F.col("start")], "tree").drop("part"))
    most = groups.agg(F.max("size")).first()[0]
    if most is None:
        return None
    # A group meets its leaves once per range partition that has any, so that none of them is a hot key.
    told = leaves.groupBy("part", "group").agg(F.count(F.lit(1)).alias("n"))
    told = told.join(groups.withColumnRenamed("group", "__group"), F.col("group").eqNullSafe(F.col("__group")))
    told = told.select(F.col("part").alias("__part"), "__group", "start", "tree", "size")
    same = (F.col("part") == F.col("__part")) & F.col("group").eqNullSafe(F.col("__group"))
    nodes = leaves.join(told, same).select(
        "tree", (F.col("place") - F.col("start")).alias("idx"), "size", F.col("leaf").alias("digest"), "doc_id", "replacement"
    )
    levels = _levels(_level(nodes, F.col("doc_id"), F.col("replacement")), -(-most // FAN))
    roots = levels[0].where("below = 1").select("tree", F.col("children").alias("digest"))
    for level in levels:
        roots = roots.unionByName(level.where("size = 1 AND below > 1").select("tree", "digest"))
    n_groups = groups.count()
    over = roots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(n_groups).alias("size"), "digest")
    return Manifest(groups, levels, _levels(_level(over), -(-n_groups // FAN)))


def _chained(level: DataFrame, above: DataFrame) -> DataFrame:
    """The rows of ``level`` with ``chain``: what folding needs of each ancestor, the nearest first."""
    up = above.select(
        F.col("tree").alias("__tree"), F.col("node").alias("__node"),
        F.col("children").alias("__children"), F.col("states").alias("__states"), F.col("chain").alias("__chain"),
        *([F.col("subroot").alias("subroot")] if "subroot" in above.columns else []),
    )
    step = F.struct(F.col("__children").alias("children"), F.col("__states").alias("states"), (F.col("node") % FAN).cast("int").alias("slot"))
    met = level.join(up, (F.col("tree") == F.col("__tree")) & (F.floor(F.col("node") / FAN) == F.col("__node")))
    return met.withColumn("chain", F.concat(F.array(step), "__chain")).drop("__tree", "__node", "__children", "__states", "__chain")


CHAIN = "array<struct<children:binary,states:binary,slot:int>>"


def _ancestors(manifest: Manifest) -> DataFrame:
    """The lowest parents with their chains to the root of all, and the digests of both roots."""
    top = manifest.top
    chained = top[-1].withColumn("chain", F.array().cast(CHAIN))
    for level in reversed(top[:-1]):
        chained = _chained(level, chained)
    # The groups' roots are the children of the lowest level; with a single group it is the root itself.
    each = chained.select(
        "node", F.col("below").alias("n_groups"), "children", "states", "chain",
        F.explode(F.sequence(F.lit(0), (F.octet_length("children") / DIGEST).cast("int") - 1)).alias("slot"),
    )
    step = F.struct("children", "states", F.col("slot").cast("int").alias("slot"))
    roots = stored(
        each.select(
            (F.col("node") * FAN + F.col("slot")).alias("tree"),
            F.when(F.col("n_groups") > 1, F.concat(F.array(step), "chain")).otherwise(F.col("chain")).alias("chain"),
            F.substring("children", F.col("slot") * DIGEST + 1, F.lit(DIGEST)).alias("subroot"),
        )
    )
    chained = None
    for level in reversed(manifest.levels):
        at_root = level.where("size = 1").join(roots, "tree")
        below = at_root if chained is None else at_root.unionByName(_chained(level.where("size > 1"), chained))
        chained = stored(below)
    return chained


def root(manifest: Manifest) -> bytes:
    row = manifest.top[-1].first()
    return bytes(row["children"] if row["below"] == 1 else row["digest"])


def verified(manifest: Manifest) -> DataFrame:
    """Per leaf: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``, digests as hex text.

    ``proof_sha256`` is the hash of all siblings on the way to the root, level by
    level, left to right; ``folded_root`` the root with the leaf's replacement, or
    itself, folded in.
    """
    top = root(manifest)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), TOGETHER):
                yield _folded(batch.iloc[at : at + TOGETHER], top)

    schema = (
        "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    )
    rows = _ancestors(manifest).select("below", "children", "states", "chain", "subroot", "doc_id", "replacement")
    return rows.mapInPandas(lean(run), schema)


def _folded(rows: pd.DataFrame, top: bytes) -> pd.DataFrame:
    own = Run.of(list(rows["children"]), list(rows["states"]))
    row = np.repeat(np.arange(len(rows)), own.counts)
    slot = np.concatenate([np.arange(n) for n in own.counts])
    leaves = own.children[row, slot]
    given = [x for some in rows["replacement"] for x in some]
    now = leaves.copy()
    for i, digest in enumerate(given):
        if digest is not None:
            now[i] = np.frombuffer(digest, np.uint8)
    inner = np.flatnonzero(rows["below"].to_numpy()[row] > 1)
    now[inner] = own.fold(row[inner], slot[inner], now[inner])
    chains = list(rows["chain"])
    depth = np.array([len(chain) for chain in chains])
    for step in range(depth.max(initial=0)):
        some = np.flatnonzero(depth > step)
        place = np.full(len(rows), -1)
        place[some] = np.arange(len(some))
        links = [chains[i][step] for i in some]
        up = Run.of([x["children"] for x in links], [x["states"] for x in links])
        at = np.array([x["slot"] for x in links])
        those = np.flatnonzero(place[row] >= 0)
        parent = place[row[those]]
        now[those] = up.fold(parent, at[parent], now[those])
    above = [b"".join(_siblings(x["children"].hex().encode(), x["slot"]) for x in chain) for chain in chains]
    texts = [x.hex().encode() for x in rows["children"]]
    proofs = [hashlib.sha256(_siblings(texts[i], k) + above[i]).hexdigest() for i, k in zip(row, slot)]
    subroots = [x.hex() for x in rows["subroot"]]
    found = [x.tobytes().hex() for x in now]
    return pd.DataFrame(
        {
            "doc_id": pd.array([None if x is None or x != x else int(x) for some in rows["doc_id"] for x in some], "Int64"),
            "leaf": [x.tobytes().hex() for x in leaves],
            "subroot": [subroots[i] for i in row],
            "root": top.hex(),
            "proof_sha256": proofs,
            "folded_root": found,
            "verified": [x == top.hex() for x in found],
        }
    )


def _siblings(digests: bytes, slot: int) -> bytes:
    return digests[: 2 * DIGEST * slot] + digests[2 * DIGEST * (slot + 1) :]


def document_rows(docs: DataFrame, tampered: Column) -> DataFrame:
    """Documents as rows of ``build``, by source; where ``tampered``, the text's A-Z are lower-cased in the replacement.

    Any column may be null.  A text without A-Z is not changed by it, nor is a null one.
    """
    text = F.col("text")
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    others = [F.col(name) for name in ("doc_id", "source", "lang", "n_chars")]
    return docs.select(
        F.col("source").alias("group"),
        "doc_id",
        leaf_digest(*others, text).alias("leaf"),
        F.when(tampered, leaf_digest(*others, lower)).alias("replacement"),
    )


def manifest_of(docs: DataFrame, tampered: Column) -> Manifest | None:
    """The manifest of whole documents, whose texts are hashed once."""
    return build(stored(document_rows(docs, tampered)))


def document_proofs(docs: DataFrame, tampered: Column) -> DataFrame:
    """``verified`` for every document; empty for an empty table.  Other columns are not read."""
    manifest = manifest_of(docs, tampered)
    if manifest is None:
        none = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        return docs.sparkSession.createDataFrame([], none)
    return verified(manifest)


def _oracle(in_group: int = 5, over_groups: int = 4) -> str:
    """The same in DuckDB, level by level, for at most ``16 ** in_group`` leaves a source and ``16 ** over_groups`` sources."""
    fields = ", ".join(
        f"CASE WHEN {name} IS NULL THEN '-' ELSE strlen(({name})::VARCHAR) || ':' || ({name})::VARCHAR END" for name in
        ("doc_id", "source", "lang", "n_chars", "{text}")
    )
    leaf = lambda text: f"sha256(concat({fields.replace('{text}', text)}))"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [
        """crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce(
            list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
            lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)""",
        f"""leaves AS (SELECT doc_id, source, {leaf("text")} AS leaf,
            CASE WHEN doc_id IS NOT NULL AND xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
                list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
                lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 5 = 0
            THEN {leaf(lower)} ELSE {leaf("text")} END AS now FROM documents, crc_table)""",
        """numbered AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
            row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
            row_number() OVER () AS mark FROM leaves)""",
    ]
    nodes, states = "SELECT tree, i, leaf AS digest FROM numbered", "SELECT mark, tree, i, now, '' AS proof FROM numbered"
    for level in range(in_group + over_groups):
        if level == in_group:
            parts.append(f"subroots AS ({nodes})")
            nodes = f"SELECT 0 AS tree, tree AS i, digest FROM ({nodes})"
            states = f"SELECT mark, 0 AS tree, tree AS i, now, proof FROM ({states})"
        parts += [
            f"n{level} AS (SELECT *, count(*) OVER (PARTITION BY tree) AS size FROM ({nodes}))",
            f"""p{level} AS (SELECT tree, i // 16 AS up, any_value(size) AS size, list(digest ORDER BY i) AS run
                FROM n{level} GROUP BY ALL)""",
            f"""s{level} AS (SELECT mark, s.tree, up AS i,
                CASE WHEN size = 1 THEN now ELSE sha256(concat(list_aggregate(run[:s.i % 16], 'string_agg', ''), now,
                    list_aggregate(run[s.i % 16 + 2:], 'string_agg', ''))) END AS now,
                CASE WHEN size = 1 THEN proof ELSE concat(proof, list_aggregate(run[:s.i % 16], 'string_agg', ''),
                    list_aggregate(run[s.i % 16 + 2:], 'string_agg', '')) END AS proof
                FROM ({states}) s JOIN p{level} p ON s.tree = p.tree AND s.i // 16 = p.up)""",
        ]
        nodes = f"""SELECT tree, up AS i, CASE WHEN size = 1 THEN run[1]
            ELSE sha256(list_aggregate(run, 'string_agg', '')) END AS digest FROM p{level}"""
        states = f"SELECT * FROM s{level}"
    return f"""WITH {", ".join(parts)}
        SELECT doc_id, leaf, digest AS subroot, (SELECT digest FROM ({nodes})) AS root, sha256(proof) AS proof_sha256,
            f.now AS folded_root, f.now = (SELECT digest FROM ({nodes})) AS verified
        FROM numbered n JOIN subroots r ON n.tree = r.tree JOIN ({states}) f ON n.mark = f.mark"""


ORACLE = _oracle()
