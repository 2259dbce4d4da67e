"""A Merkle manifest of a dataset, kept as a postorder append log.

Each row is a leaf of its tree (here: its source). Leaves ascend by an order; every
16 consecutive nodes of a level become one of the next (the last run may be shorter,
even one node) until one node is left, the tree's root; a lone leaf is its own root.
The roots of all trees, in the order of the trees, make the dataset's root likewise.

1. Ranking. Rows are range-sorted by tree and order, so one tree may hold any share
   of them. A row's place within its sort partition and a running sum of the rows
   per partition and tree give its index; only that sum, one row per partition and
   tree, is ordered by tree.
2. Building. An aligned builder takes ``16 ** HEIGHT`` consecutive leaves and appends
   each node when its last child is complete. In this order the node of level ``l``
   whose last leaf is ``e`` has the position ``e + e // 16 + e // 256 + ... + l``:
   before it lie the leaves up to ``e``, the inner nodes complete by then, and its own
   descendants on the path. A builder's log is one segment of digests. The
   segments' top nodes are leaves of the next tier, until every tree has one.
3. Proofs. Positions address a node's siblings in its segment, so a proof needs no
   search: each block of leaves reads its own segment and is handed the proof of
   its top node, tier by tier downwards, and that of its tree's root.

Texts are read once and never shuffled; a digest is hashed by 64 lower-case hex
characters and stored in 32 bytes. A block holds 4,096 leaves at most.

Defined results: a null column is ``-`` in a leaf; a null tree is a tree of its own, the
first; null ids come first in their tree and are never tampered with; rows that tie by
id follow their digests, and equal rows are leaves next to each other; an empty table
has no leaf and gives no row. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from zoneferry.session import stage

FAN_OUT, HEIGHT = 16, 3
BLOCK = FAN_OUT**HEIGHT
DIGEST = 32
#: Rows a sort partition is planned for.
SORT_ROWS = 200_000
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def node(children: bytes) -> bytes:
    """The digest over children's digests, which are hashed as hex text."""
    return sha256(children.hex().encode()).digest()


def position(leaf: int, level: int) -> int:
    """Where the node of ``level`` whose last leaf is ``leaf`` stands in postorder."""
    at = level
    while leaf:
        at += leaf
        leaf //= FAN_OUT
    return at


def segment(leaves: Sequence[bytes], levels: int) -> bytes:
    """The nodes over one aligned block of leaves, in order of completion."""
    log = bytearray()
    open_runs: list[list[bytes]] = [[] for _ in range(levels + 1)]
    last = len(leaves) - 1
    for i, leaf in enumerate(leaves):
        done, level = leaf, 0
        log += done
        open_runs[0].append(done)
        while level < levels and (len(open_runs[level]) == FAN_OUT or i == last):
            done = node(b"".join(open_runs[level]))
            open_runs[level].clear()
            level += 1
            log += done
            open_runs[level].append(done)
    return bytes(log)


def run_of(log: bytes, first: int, level: int, leaves: int) -> bytes:
    """The digests of a run of siblings, read off the segment of a block of ``leaves`` leaves.

    ``first`` numbers the run's first node among the nodes of its level.
    """
    width = FAN_OUT**level
    digests = []
    for end in range((first + 1) * width, (first + FAN_OUT + 1) * width, width):
        at = position(min(end, leaves) - 1, level) * DIGEST
        digests.append(log[at : at + DIGEST])
        if end >= leaves:
            break
    return b"".join(digests)


def folded(leaf: bytes, slots: Sequence[int], runs: Sequence[bytes]) -> bytes:
    """The root that a leaf and its proof lead to."""
    for slot, run in zip(slots, runs):
        leaf = node(run[: slot * DIGEST] + leaf + run[(slot + 1) * DIGEST :])
    return leaf


def siblings(slots: Sequence[int], runs: Sequence[bytes]) -> str:
    """A proof's siblings from the leaf's level up, as hex text."""
    return "".join((run[: slot * DIGEST] + run[(slot + 1) * DIGEST :]).hex() for slot, run in zip(slots, runs))


def leaf_digest(*columns: Column) -> Column:
    """sha256 over columns, each ``-`` if null, else its length in bytes, ``:`` and itself."""
    parts = []
    for column in columns:
        text = column.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _ranked(items: DataFrame, order: Sequence[str]) -> DataFrame:
    """Items (tree, digest, ...) with ``i``, from 0 within the tree, the tree's ``n``, and their block."""
    items = stage(items, "merkle-items")
    parts = max(items.sparkSession.sparkContext.defaultParallelism, items.count() // SORT_ROWS + 1)
    keys = ["tree", *[F.asc_nulls_first(c) for c in order]]
    ranged = items.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    placed = ranged.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
    placed = stage(placed, "merkle-sorted")
    sums = placed.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    tree = Window.partitionBy("tree")
    upto = F.sum("rows").over(tree.orderBy("part"))
    before = sums.select("tree", "part", (upto - F.col("rows") - F.col("first")).alias("shift"), F.sum("rows").over(tree).alias("n"))
    found = placed.join(before, ["tree", "part"]).withColumn("i", F.col("at") + F.col("shift"))
    return found.drop("part", "at", "shift").withColumn("block", F.floor(F.col("i") / BLOCK))


def _levels(n: int) -> int:
    """Levels a builder adds over the blocks of a tier with ``n`` leaves."""
    levels = 0
    while n > 1 and levels < HEIGHT:
        n = -(-n // FAN_OUT)
        levels += 1
    return levels


_SEGMENT = "tree string, block bigint, log binary, digest binary, n bigint"


def _built(rows: pa.Table) -> pa.Table:
    """A builder's segment, its top node, and how many blocks its tree has."""
    rows = rows.sort_by("i")
    n = rows.column("n")[0].as_py()
    log = segment(rows.column("digest").to_pylist(), _levels(n))
    first = rows.slice(0, 1)
    return pa.table(
        {
            "tree": first.column("tree"),
            "block": first.column("block"),
            "log": pa.array([log], pa.binary()),
            "digest": pa.array([log[-DIGEST:]], pa.binary()),
            "n": pa.array([-(-n // BLOCK)], pa.int64()),
        }
    )


def _log(leaves: DataFrame) -> list[DataFrame]:
    """The log's tiers: segments (tree, block, log, digest, n: the tree's blocks) of each."""
    tiers = []
    rows = leaves.select("tree", "block", "i", "digest", "n")
    while True:
        made = stage(rows.groupBy("tree", "block").applyInArrow(_built, _SEGMENT), "merkle-log")
        tiers.append(made)
        several = made.where("n > 1")
        if several.isEmpty():
            return tiers
        above = F.floor(F.col("block") / BLOCK)
        rows = several.select("tree", above.alias("block"), F.col("block").alias("i"), "digest", "n")


class _Paths:
    """The proofs of a block's leaves: their runs in its segment, then those of its top node."""

    def __init__(self, segments: pa.Table, n: int):
        held = segments.slice(0, 1).to_pylist()[0]
        self.log, self.slots, self.runs = held["log"], held["slots"], held["runs"]
        self.leaves, self.levels = min(n - held["block"] * BLOCK, BLOCK), _levels(n)
        self.seen: dict[tuple[int, int], bytes] = {}

    def of(self, i: int) -> tuple[list[int], list[bytes]]:
        slots, runs = [], []
        at = i % BLOCK
        for level in range(self.levels):
            slot = at % FAN_OUT
            key = (at - slot, level)
            if key not in self.seen:
                self.seen[key] = run_of(self.log, *key, self.leaves)
            slots.append(slot)
            runs.append(self.seen[key])
            at //= FAN_OUT
        return slots + self.slots, runs + self.runs


_PROOF = "key string, block bigint, slots array<int>, runs array<binary>"


def _handed(rows: pa.Table, segments: pa.Table) -> pa.Table:
    """(key, block, slots, runs): the proofs of a segment's leaves, which are tops of lower blocks."""
    if not rows.num_rows or not segments.num_rows:
        raise ValueError("a block and its segment belong together")
    paths = _Paths(segments, rows.column("n")[0].as_py())
    proofs = [paths.of(i) for i in rows.column("i").to_pylist()]
    return pa.table(
        {
            "key": rows.column("key"),
            "block": rows.column("i"),
            "slots": pa.array([p[0] for p in proofs], pa.list_(pa.int32())),
            "runs": pa.array([p[1] for p in proofs], pa.list_(pa.binary())),
        }
    )


def _held(tiers: list[DataFrame], roots: DataFrame | None = None) -> DataFrame:
    """The lowest segments (tree, block, log), each with its top node's proof (slots, runs).

    ``roots`` (key, slots, runs) continues the proofs beyond the trees' own roots.
    """
    proofs = None
    for k in range(len(tiers) - 1, -1, -1):
        tops = tiers[k].where("n = 1").select("tree", "block")
        if roots is None:
            tops = tops.select("*", F.array().cast("array<int>").alias("slots"), F.array().cast("array<binary>").alias("runs"))
        else:
            tops = tops.join(roots.withColumnRenamed("key", "tree"), "tree").select("tree", "block", "slots", "runs")
        if proofs is not None:
            tops = tops.unionByName(proofs.withColumnRenamed("key", "tree"))
        held = stage(tiers[k].select("tree", "block", "log").join(tops, ["tree", "block"]), "merkle-held")
        if k:
            below = tiers[k - 1].where("n > 1").withColumn("above", F.floor(F.col("block") / BLOCK))
            below = below.select("tree", "above", F.col("tree").alias("key"), F.col("block").alias("i"), "n")
            both = below.groupBy("tree", "above").cogroup(held.groupBy("tree", "block"))
            proofs = both.applyInArrow(_handed, _PROOF)
    return held


@dataclass(frozen=True)
class Manifest:
    """A dataset's leaves (tree, block, i, n, doc_id, digest, now), its log, and its root.

    ``tiers`` holds the segments of the trees, ``root_tiers`` those of the tree over
    their roots, ``roots`` the roots (tree, digest). ``root`` is None without rows.
    """

    leaves: DataFrame
    tiers: list[DataFrame]
    roots: DataFrame
    root_tiers: list[DataFrame]
    root: bytes | None

    def held(self) -> DataFrame:
        """The segments with the proofs of their top nodes up to the dataset's root."""
        listed = self.roots.select("tree", "block", "key", "i", "n")
        both = listed.groupBy("tree", "block").cogroup(_held(self.root_tiers).groupBy("tree", "block"))
        proofs = stage(both.applyInArrow(_handed, _PROOF).drop("block"), "merkle-roots")
        subroots = self.roots.select(F.col("key").alias("tree"), F.col("digest").alias("subroot"))
        return _held(self.tiers, proofs).join(subroots, "tree")


def build(docs: DataFrame, text_now: Column | None = None) -> Manifest:
    """The manifest of documents, one tree per source.

    ``text_now``, where not null, is a text found later in place of the row's; the leaf it
    gives is kept as ``now`` and has no part in the tree.
    """
    others = [F.col(c) for c in COLUMNS[:-1]]
    now = F.lit(None).cast("binary") if text_now is None else F.when(text_now.isNotNull(), leaf_digest(*others, text_now))
    tree = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    items = docs.select(tree.alias("tree"), F.col("doc_id").cast("bigint"), leaf_digest(*others, F.col("text")).alias("digest"), now.alias("now"))
    leaves = stage(_ranked(items, ["doc_id", "digest", "now"]), "merkle-leaves")
    tiers = _log(leaves)
    tops = [t.where("n = 1").select(F.lit("").alias("tree"), F.col("tree").alias("key"), "digest") for t in tiers]
    roots = stage(_ranked(reduce(DataFrame.unionByName, tops), ["key"]), "merkle-trees")
    root_tiers = _log(roots)
    top = root_tiers[-1].select("digest").first()
    return Manifest(leaves, tiers, roots, root_tiers, None if top is None else bytes(top["digest"]))


_PROVED = "doc_id bigint, leaf string, subroot string, root string, proof string, folded_root string, verified boolean"


def proofs(manifest: Manifest, full: bool = False) -> DataFrame:
    """Per leaf: doc_id, leaf, subroot, root, proof, folded_root, verified.

    ``proof`` is the siblings up to the root as hex text if ``full``, else the sha256 of
    that text. ``folded_root`` is what the row's present leaf and the proof lead to.
    """
    root = manifest.root

    def proved(rows: pa.Table, segments: pa.Table) -> pa.Table:
        if not rows.num_rows or not segments.num_rows:
            raise ValueError("a block and its segment belong together")
        paths = _Paths(segments, rows.column("n")[0].as_py())
        subroot = segments.column("subroot")[0].as_py()
        leaf, proof, found = [], [], []
        for i, digest, now in zip(*(rows.column(c).to_pylist() for c in ("i", "digest", "now"))):
            slots, runs = paths.of(i)
            leaf.append(digest.hex())
            text = siblings(slots, runs)
            proof.append(text if full else sha256(text.encode()).hexdigest())
            found.append(folded(digest if now is None else now, slots, runs))
        count = rows.num_rows
        return pa.table(
            {
                "doc_id": rows.column("doc_id"),
                "leaf": pa.array(leaf, pa.string()),
                "subroot": pa.array([subroot.hex()] * count, pa.string()),
                "root": pa.array([root.hex()] * count, pa.string()),
                "proof": pa.array(proof, pa.string()),
                "folded_root": pa.array([f.hex() for f in found], pa.string()),
                "verified": pa.array([f == root for f in found], pa.bool_()),
            }
        )

    both = manifest.leaves.groupBy("tree", "block").cogroup(manifest.held().groupBy("tree", "block"))
    return both.applyInArrow(proved, _PROVED)
