"""Shards by a hierarchical weighted hash tree.

Regions hold racks and racks hold shards.  A row descends from the root: at
each node every child draws ``ln(u) / weight`` with ``u`` from a hash of the
row's key and the child's name, and the highest draw wins.  A child's draw
depends on its own name and weight only, so when a shard's weight changes,
rows move only into or out of the subtrees on its path; a new region takes
rows only into itself.

The law of the query is ``key``: the key and the tree alone decide.

Cases: a null doc_id is a key like any other; rows with one doc_id share a
shard; a null text has no bytes; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from groundstop.session import scratch_path


@dataclass(frozen=True)
class Node:
    """A named subtree; a leaf has a shard number and a weight, an inner node the sum of its children's."""

    name: str
    children: tuple["Node", ...] = ()
    shard: int | None = None
    leaf_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.leaf_weight


def tree(shards: int, racks_per_region: int = 2, shards_per_rack: int = 2, weights: dict[int, float] | None = None) -> Node:
    """Regions of racks of shards 0 to ``shards - 1``, filled in order."""
    weights = weights or {}
    leaves = [Node(f"shard-{s}", (), s, weights.get(s, 1.0)) for s in range(shards)]
    for level, size in (("rack", shards_per_rack), ("region", racks_per_region)):
        leaves = [Node(f"{level}-{i // size}", tuple(leaves[i:i + size])) for i in range(0, len(leaves), size)]
    return Node("root", tuple(leaves))


def grown(root: Node, weight: float = 1.0) -> Node:
    """The tree with one more shard, in a rack and a region of its own, so that rows move only into it."""
    shard = 1 + max(_shards(root))
    rack = Node(f"rack-of-shard-{shard}", (Node(f"shard-{shard}", (), shard, weight),))
    return Node(root.name, (*root.children, Node(f"region-of-shard-{shard}", (rack,))))


def _shards(node: Node) -> Iterator[int]:
    if node.shard is not None:
        yield node.shard
    for child in node.children:
        yield from _shards(child)


def _draw(key: list[Column], child: Node) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(*key, F.lit(child.name)), 11)
    return F.log((bits + F.lit(0.5)) / F.lit(float(1 << 53))) / F.lit(float(child.weight))


def assign(root: Node, *key: Column) -> Column:
    """The shard that the key descends to; children without weight are never drawn."""
    live = [c for c in root.children if c.weight > 0]
    if not root.children:
        return F.lit(root.shard)
    if not live:
        raise ValueError(f"{root.name} has no weight below it")
    if len(live) == 1:
        return assign(live[0], *key)
    draws = [F.struct(_draw(list(key), c).alias("draw"), F.lit(-i).alias("i")) for i, c in enumerate(live)]
    winner = F.greatest(*draws)["i"]
    out = F.when(winner == 0, assign(live[0], *key))
    for i, c in enumerate(live[1:], 1):
        out = out.when(winner == -i, assign(c, *key))
    return out


def _numbered(rows: DataFrame) -> DataFrame:
    """Add (part, rank): the row's place among the rows of its shard in its partition."""
    names = rows.columns
    at = names.index("shard")

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            shard = batch.column(at).to_numpy(zero_copy_only=False)
            place = np.zeros(len(shard), np.int64)
            for s in np.unique(shard):
                mine = np.flatnonzero(shard == s)
                place[mine] = seen.get(s, 0) + np.arange(len(mine))
                seen[s] = seen.get(s, 0) + len(mine)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(shard), part, np.int64)), pa.array(place)], [*names, "part", "rank"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(rank, f"{schema}, part long, rank long")


def shard_documents(docs: DataFrame, root: Node, bigger: Node | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row of ``docs``.

    ``slot`` numbers the rows of a shard without gaps.  Ranks are counted per
    partition as the assignment is stored, and the stored partitions' counts
    give each partition its first slot, so no shard meets in one task.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        assign(root, F.col("doc_id")).cast("int").alias("shard"),
        (assign(bigger, F.col("doc_id")) if bigger else F.lit(None)).cast("int").alias("grown_shard"))
    out = scratch_path(spark, "shards")
    _numbered(rows).write.parquet(out)
    stored = spark.read.parquet(out)
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = stored.groupBy("part", "shard").agg(F.count(F.lit(1)).alias("_n")).select(
        "part", "shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    return stored.join(first, ["part", "shard"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("_first") + F.col("rank")).cast("long").alias("slot"), "grown_shard")
