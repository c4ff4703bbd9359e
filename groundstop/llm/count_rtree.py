"""N-gram Jaccard join over an R-tree of count vectors.

A document is the set of its distinct 5-word shingles (64-bit hashes).  The
shingles of a set are hashed into 64 groups; the group counts are a point,
and the summed coordinate minima of two points bound the overlap of their
sets from above.  Points are bulk-loaded into an R-tree (leaves of 16 in the
order of size, boxes of least and greatest coordinates); a search leaves out
every box and point whose bound is below the overlap that the similarity
needs, and what is left is verified on the sets.

In so many dimensions one tree over the corpus would prune next to nothing,
so the points are first dealt to the trees of groups that can hold links:

1. The runs ask shards how many documents hold each shingle.  A set can
   only be linked if enough of its shingles occur elsewhere.
2. Equal sets become one class.  Of a class only as many of the rarest
   shingles count as two linked sets cannot both leave out; classes that
   share one of them fall into one group (star edges, connected components).
3. Each group's tree is searched component by component: what is already
   connected is not compared again, so a group of near copies costs about
   one search each and no pairs are listed.  Groups larger than a block, in
   classes or in the bytes of their sets, are
   split, with some pivots in every block; only if a split group is left in
   several components, blocks are compared with each other.

Cases: a null or empty text has no shingles, is its own component and linked
with nothing; a text of one to four words is one shingle; rows that repeat a
doc_id belong together if their sets do; a null doc_id never names a
component that has another; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundstop.llm import exchange
from groundstop.llm.chunks import lower_ascii, mix, span_hashes, text_buffer, words
from groundstop.llm.components import connected
from groundstop.session import scratch_path, scratch_scope

SHINGLE = 5
#: Dimensions of the points, points of a leaf, children of a node.
GROUPS, LEAF, FANOUT = 64, 16, 16
#: Classes that one task searches, and classes in every block of a larger group, about.
BLOCK, PIVOTS = 4096, 32
#: Bytes of the sets that one task searches, about; two blocks that are compared have twice as many.
BLOCK_BYTES = 64 << 20
#: Bytes of a shingle's hash that travel, besides the shard's number; a chance match only makes a shingle seem less rare, alike everywhere.
KEY_BYTES = 4

_STEP = np.uint64(0x9E3779B97F4A7C15)


def needed(size_a, size_b):
    """Least overlap of linked sets: 100 * overlap >= 75 * union, so 7 * overlap >= 3 * (a + b)."""
    return (3 * (size_a + size_b) + 6) // 7


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the distinct shingles of every row, sorted by hash, then row."""
    data, off = text_buffer(texts)
    data = lower_ascii(data)
    starts, ends, rows = words(data, off)
    w = span_hashes(data, starts, ends)
    n = len(off) - 1
    per = np.bincount(rows, minlength=n)
    full = np.zeros(0, np.uint64)
    at = np.zeros(0, np.int64)
    if len(w) >= SHINGLE:
        full = w[:len(w) - SHINGLE + 1].copy()
        for j in range(1, SHINGLE):
            full = full * _STEP + w[j:len(w) - SHINGLE + 1 + j]
        at = np.flatnonzero(rows[:len(full)] == rows[SHINGLE - 1:])
        full = mix(full[at])
    short = np.flatnonzero((per > 0) & (per < SHINGLE))
    first = np.cumsum(per) - per
    brief = per[short].astype(np.uint64)
    for j in range(SHINGLE - 1):
        more = per[short] > j
        brief[more] = brief[more] * _STEP + w[first[short[more]] + j]
    h = np.concatenate([full, mix(brief)])
    r = np.concatenate([rows[at], short])
    order = np.lexsort((r, h)) if len(short) else np.argsort(h, kind="stable")
    h, r = h[order], r[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    return h[keep], r[keep]


def _firsts(sorted_values: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, sorted_values[1:] != sorted_values[:-1])) if len(sorted_values) else np.zeros(0, np.int64)


def _cut(keys: np.ndarray, bits: int) -> np.ndarray:
    """Start of every shard in sorted keys."""
    return np.searchsorted(keys >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))


def _ask(bits: int):
    def make(chunk: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
        h, _ = shingles(chunk.column(1))
        first = _firsts(h)
        held = np.minimum(np.diff(np.append(first, len(h))), 255).astype(np.uint8)
        h = h[first]
        cut = _cut(h, bits)
        for shard in np.flatnonzero(np.diff(cut)).tolist():
            a, b = cut[shard], cut[shard + 1]
            yield shard, exchange.pack_arrays(exchange.low_bytes(h[a:b] >> np.uint64(64 - bits - 8 * KEY_BYTES), KEY_BYTES), held[a:b])

    return make


def _rarity(shard: int, runs: list[int], blobs: list[bytes]) -> Iterator[tuple[int, bytes]]:
    """For each key of a run: 0 if one document holds it, else the bits of the number that do."""
    asked = [exchange.unpack_arrays(b, "u1", "u1") for b in blobs]
    keys = [exchange.from_low_bytes(a[0], KEY_BYTES) for a in asked]
    every, place = np.unique(np.concatenate(keys), return_inverse=True)
    held = np.bincount(place, np.concatenate([a[1] for a in asked]), len(every))
    code = np.where(held > 1, np.frexp(held)[1], 0).astype(np.uint8)[place]
    at = 0
    for run, k in zip(runs, keys, strict=True):
        yield run, exchange.pack_arrays(code[at:at + len(k)])
        at += len(k)


def _sets(run: int, chunk: pa.RecordBatch, got: dict[int, bytes]) -> list[pa.RecordBatch]:
    """Per row its set size and, where links are possible, digest, sorted set and rarest shingles."""
    h, r = shingles(chunk.column(1))
    first = _firsts(h)
    codes = np.concatenate([exchange.unpack_arrays(got[s], "u1")[0] for s in sorted(got)]) if got else np.zeros(0, np.uint8)
    code = np.repeat(codes, np.diff(np.append(first, len(h))))
    n = chunk.num_rows
    size = np.bincount(r, minlength=n)
    shared = np.bincount(r[code > 0], minlength=n)
    live = (size > 0) & (100 * shared >= 75 * size)
    mine = live[r]
    h, r, code = h[mine], r[mine], code[mine]
    by_row = np.argsort(r, kind="stable")
    h, r, code = h[by_row], r[by_row], code[by_row]
    by_rarity = np.lexsort((h, code, r))
    off = np.concatenate([[0], np.cumsum(np.bincount(r, minlength=n))])
    digest, sets, rare, seen = [None] * n, [None] * n, [None] * n, set()
    for i in np.flatnonzero(live).tolist():
        a, b = off[i], off[i + 1]
        raw = h[a:b].astype("<u8").tobytes()
        d = hashlib.sha256(raw).digest()
        digest[i] = d
        if d not in seen:  # one copy of a set per run
            seen.add(d)
            alone = int(size[i] - shared[i])
            prefix = int(size[i]) - int(3 * size[i] + 3) // 4 + 1
            sets[i], rare[i] = raw, h[by_rarity[a + alone:a + max(alone, prefix)]].astype("<u8").tobytes()
    return [pa.RecordBatch.from_arrays([
        chunk.column(0), pa.array(size.astype(np.int64)), pa.array(digest, pa.binary()), pa.array(sets, pa.binary()), pa.array(rare, pa.binary())],
        ["doc_id", "n_shingles", "digest", "shingles", "rare"])]


def _rare_messages(bits: int):
    """(shard, blob): a batch's distinct rare shingles, each with its least class, and stars of the classes that share one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = text_buffer(batch.column(1))
            keys = np.frombuffer(data.tobytes(), "<u8")
            cid = np.repeat(batch.column(0).to_numpy(), np.diff(off) // 8)
            order = np.lexsort((cid, keys))
            keys, cid = keys[order], cid[order]
            first = _firsts(keys)
            least = np.repeat(cid[first], np.diff(np.append(first, len(keys))))
            cut, rows = _cut(keys, bits), []
            for shard in np.flatnonzero(np.diff(cut)).tolist():
                a, b = cut[shard], cut[shard + 1]
                mine = first[np.searchsorted(first, a):np.searchsorted(first, b)]
                pairs = np.unique(np.stack([least[a:b], cid[a:b]], axis=1)[least[a:b] != cid[a:b]], axis=0)
                rows.append((shard, exchange.pack_arrays(keys[mine], cid[mine], pairs.ravel())))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["shard", "blob"])

    return run


def _stars(table: pa.Table) -> pa.Table:
    parts = [exchange.unpack_arrays(b.as_py(), "<u8", "<i8", "<i8") for b in table["blob"]]
    keys, cid = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.lexsort((cid, keys))
    keys, cid = keys[order], cid[order]
    first = _firsts(keys)
    least = np.repeat(cid[first], np.diff(np.append(first, len(keys))))
    pairs = np.concatenate([np.stack([least, cid], axis=1)[least != cid], *(p[2].reshape(-1, 2) for p in parts)])
    pairs = np.unique(pairs, axis=0)
    return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})


class CountTree:
    """R-tree of count vectors with the number of open points below every node."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        m = len(sets)
        self.size = np.array([len(s) for s in sets], np.int64)
        self.points = np.empty((m, GROUPS), np.int32)
        for i, one in enumerate(sets):
            self.points[i] = np.bincount((one % np.uint64(GROUPS)).astype(np.int64), minlength=GROUPS)
        self.order = np.lexsort((self.points[:, 0], self.size))
        self.slot = np.empty(m, np.int64)
        self.slot[self.order] = np.arange(m)
        self.open = np.ones(m, bool)  # by slot
        high, least, count, self.levels = self.points[self.order], self.size[self.order], np.ones(m, np.int64), []
        width = LEAF
        while True:
            at = np.arange(0, len(high), width)
            high, least, count = np.maximum.reduceat(high, at), np.minimum.reduceat(least, at), np.add.reduceat(count, at)
            self.levels.append((high, least, count))
            if len(high) == 1:
                break
            width = FANOUT

    def close(self, i: int) -> None:
        """Take point ``i`` out of later searches."""
        s = int(self.slot[i])
        self.open[s] = False
        s //= LEAF
        for _, _, count in self.levels:
            count[s] -= 1
            s //= FANOUT

    def search(self, i: int) -> list[int]:
        """Open points whose sets are linked with set ``i``."""
        x, size = self.points[i], int(self.size[i])
        nodes = np.zeros(1, np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            high, least, count = self.levels[level]
            nodes = nodes[count[nodes] > 0]
            nodes = nodes[np.minimum(high[nodes], x).sum(axis=1) >= needed(size, least[nodes])]
            width, below = (FANOUT, len(self.levels[level - 1][1])) if level else (LEAF, len(self.open))
            nodes = (nodes[:, None] * width + np.arange(width)).ravel()
            nodes = nodes[nodes < below]
        near = self.order[nodes[self.open[nodes]]]
        near = near[np.minimum(self.points[near], x).sum(axis=1) >= needed(size, self.size[near])]
        mine = self.sets[i]
        out = []
        for j in near.tolist():
            other = self.sets[j]
            at = np.minimum(np.searchsorted(other, mine), len(other) - 1)
            if int((other[at] == mine).sum()) >= needed(size, len(other)):
                out.append(j)
        return out


def spanning_links(sets: list[np.ndarray], label: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect, beyond the components ``label`` says already, all that is connected by links."""
    tree = CountTree(sets)
    members: dict[int, list[int]] = {}
    for i, c in enumerate(label.tolist()):
        members.setdefault(c, []).append(i)
    links = []
    while members:
        _, frontier = members.popitem()
        for i in frontier:
            tree.close(i)
        while frontier:
            i = frontier.pop()
            for j in tree.search(i):
                mates = members.pop(int(label[j]), None)
                if mates is not None:  # else j came in with an earlier one of this search
                    links.append((i, j))
                    for k in mates:
                        tree.close(k)
                    frontier.extend(mates)
    return links


def _search(table: pa.Table) -> pa.Table:
    table = table.combine_chunks()
    cid, first = np.unique(table["cid"].to_numpy(), return_index=True)
    label = table["label"].to_numpy()[first]
    sets = [np.frombuffer(table["shingles"][int(i)].as_buffer(), "<u8") for i in first]
    links = spanning_links(sets, label)
    return pa.table({"a": pa.array([int(cid[i]) for i, _ in links], pa.int64()), "b": pa.array([int(cid[j]) for _, j in links], pa.int64())})


def _sizes(groups: DataFrame, classes: DataFrame, block: int) -> DataFrame:
    """(grp, n, blocks, pivots): a group's classes, the blocks that they and the bytes of their sets fill, and how many of them go into every block."""
    sizes = groups.join(classes.select("cid", "n_shingles"), "cid").groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("total"))
    filled = F.greatest(F.ceil(F.col("n") / F.lit(block)), F.least("n", F.ceil(F.col("total") * 8 / F.lit(BLOCK_BYTES)))).cast("long")
    # Pivots fill half a block at most.
    return sizes.select("grp", "n", filled.alias("blocks")).withColumn("pivots", F.least(F.lit(PIVOTS), F.ceil(F.col("n") / F.col("blocks") / 2)))


def _members(groups: DataFrame, sizes: DataFrame, classes: DataFrame) -> DataFrame:
    return groups.join(sizes, "grp").join(classes.select("cid", "shingles"), "cid").select(
        "grp", "blocks", "cid", "shingles", F.pmod(F.xxhash64("cid"), "blocks").alias("block"),
        ((F.col("blocks") > 1) & (F.pmod(F.xxhash64("cid", F.lit(1)), "n") < F.col("pivots"))).alias("pivot"))


def _dealt(members: DataFrame) -> DataFrame:
    """Every class in its block, pivots in all blocks of their group."""
    return members.select("grp", F.explode(F.when(F.col("pivot"), F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array("block"))).alias("block"),
                          "cid", F.col("cid").alias("label"), "shingles")


def jaccard_components(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``, stored; what it was made from goes."""
    out = scratch_path(docs.sparkSession, "jaccard-components")
    with scratch_scope(docs.sparkSession):
        _components(docs, block).write.parquet(out)
    return docs.sparkSession.read.parquet(out)


def _components(docs: DataFrame, block: int) -> DataFrame:
    spark = docs.sparkSession
    base = scratch_path(spark, "jaccard")

    def keep(name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        return spark.read.parquet(f"{base}/{name}")

    with scratch_scope(spark):  # the chunks go when the sets are stored
        bits, chunks = exchange.shard_bits(docs), exchange.packed(docs, ["doc_id", "text"])
        answers = exchange.answer(exchange.send(chunks, _ask(bits)), _rarity)
        rows = keep("rows", exchange.finish(chunks, answers, _sets, "doc_id long, n_shingles long, digest binary, shingles binary, rare binary"))
    live = rows.where("digest IS NOT NULL")
    sets = live.where("shingles IS NOT NULL").groupBy("digest").agg(F.max("shingles").alias("shingles"), F.max("rare").alias("rare"), F.max("n_shingles").alias("n_shingles"))
    classes = keep("classes", sets.withColumn("cid", F.monotonically_increasing_id()))
    stars = classes.select("cid", "rare").mapInArrow(_rare_messages(bits), "shard long, blob binary").groupBy("shard").applyInArrow(_stars, "a long, b long")
    with scratch_scope(spark):
        groups = keep("groups", connected(stars).select(F.col("node").alias("cid"), F.col("label").alias("grp")))

    sizes = _sizes(groups, classes, block)
    members = keep("members", _members(groups, sizes, classes))
    dealt = _dealt(members)
    links = keep("links", dealt.groupBy("grp", "block").applyInArrow(_search, "a long, b long"))
    with scratch_scope(spark):
        parts = keep("parts", connected(links))
    if sizes.where("blocks > 1").limit(1).count():
        links = keep("all-links", links.union(_across(members, parts)))
        with scratch_scope(spark):
            parts = keep("all-parts", connected(links))

    least = live.groupBy("digest").agg(F.min("doc_id").alias("least"))
    classes = classes.select("cid", "digest").join(least, "digest").join(parts.select(F.col("node").alias("cid"), "label"), "cid", "left").select(
        "digest", "least", F.coalesce("label", "cid").alias("label"))
    named = classes.groupBy("label").agg(F.min("least").alias("component_id"))
    classes = classes.join(named, "label").select("digest", "component_id")
    return live.select("doc_id", "n_shingles", "digest").join(classes, "digest").select("doc_id", "n_shingles", "component_id").union(
        rows.where("digest IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that stay: of every component the one with the least doc_id."""
    rows, row = exchange.numbered(docs)
    parts = jaccard_components(rows.select(F.col(row).alias("doc_id"), "text")).where("n_shingles > 0").select(F.col("doc_id").alias(row), "component_id")
    several = parts.where(F.col(row) != F.col("component_id"))
    several = several.union(several.select(F.col("component_id").alias(row), "component_id").distinct())
    named = rows.select(row, "doc_id").join(several, row)
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", row))[row].alias("stays"))
    gone = several.join(first, "component_id").where(F.col(row) != F.col("stays")).select(row)
    return rows.join(gone, row, "left_anti").drop(row)


def _across(members: DataFrame, parts: DataFrame) -> DataFrame:
    """Links between the blocks of split groups that the blocks' own links leave in several components."""
    split = members.where("blocks > 1").join(parts.select(F.col("node").alias("cid"), "label"), "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    torn = split.groupBy("grp").agg((F.min("label") != F.max("label")).alias("torn")).where("torn").select("grp")
    split = split.join(torn, "grp")
    pairs = split.select("grp", "cid", "label", "shingles", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")).where("block != other")
    pairs = pairs.select("grp", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "cid", "label", "shingles")
    return pairs.groupBy("grp", "low", "high").applyInArrow(_search, "a long, b long")
