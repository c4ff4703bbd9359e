"""Benchmark decontamination by winnowing, in DataFrame functions only.

Of every 6 consecutive 5-gram hashes of a text the least is kept, so any 10
consecutive words keep the same 5-gram wherever they stand: every shared span
of 10 words has a common fingerprint.  The
texts are read and cut into words once: where a window's fingerprint is in
the benchmark's bitmap, the fingerprint is extended to the window around it,
and the window's words go on; they are joined with the benchmark's windows by
their hash and compared word by word.  So what moves is the windows that have
a fingerprint in common, each with the windows equal to it only, however many
items or documents share a phrase.  An item of fewer than 10 words is one
window; for each such length that occurs, every position of the documents is
fingerprinted (a winnowing window of one).

The bitmap of fingerprints is a literal of 2^20 bits at most.  With many more
fingerprints more windows pass it that then join nothing; no window is lost.

Cases: a null or empty text has no words; a benchmark item without words has
no window and a null item_id is not counted as an item; rows that repeat a
doc_id are told apart by a hash of their text; an empty benchmark leaves
every document clean.
"""

from __future__ import annotations

import string
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundstop.session import scratch_path, scratch_scope

SPAN, GRAM = 10, 5
GUARD = SPAN - GRAM + 1
#: Benchmark windows up to which their fingerprints (28 bytes each) are broadcast; beyond it the join shuffles.
BROADCAST_WINDOWS = 200_000

#: Bits of the fingerprints' bitmap, at least and at most.
BITMAP = (1 << 14, 1 << 20)

#: ASCII characters that part words: all but digits and letters.
_GAPS = "".join(chr(c) for c in range(128) if not chr(c).isalnum())


def words(text: Column) -> Column:
    """Words of a text with A-Z in lower case; null has none."""
    low = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase + _GAPS, string.ascii_lowercase + " " * len(_GAPS))
    return F.array_remove(F.split(low, " "), "")


def _grams(tokens: str, k: int) -> Column:
    """Hash of the k words from every position."""
    last = F.size(tokens) - k
    gram = lambda i: F.xxhash64(*[F.get(F.col(tokens), i + j) for j in range(k)])
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), gram)).otherwise(F.array().cast("array<bigint>"))


def _least(hashes: str, reach: int) -> Column:
    """At each place the least of it and of what stands ``reach`` places on."""
    return F.transform(hashes, lambda x, i: F.least(x, F.get(F.col(hashes), i + reach)))


def benchmark_windows(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored (wid, len, words, shift, h) of the distinct windows, and (wid, item_id).

    ``h`` is the window's fingerprint and ``shift`` its place in the window.
    """
    spark = benchmark.sparkSession
    base = scratch_path(spark, "benchmark-windows")
    items = benchmark.select("item_id", words(F.col("text")).alias("tokens")).where(F.size("tokens") > 0)
    spans = items.select("item_id", F.explode(F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("tokens") - SPAN, F.lit(0))), lambda i: F.slice("tokens", i + 1, SPAN))).alias("words"))
    spans = spans.distinct()
    spans.write.parquet(f"{base}/spans")
    spans = spark.read.parquet(f"{base}/spans")
    windows = spans.select("words").distinct().withColumn("wid", F.monotonically_increasing_id()).withColumn("len", F.size("words"))
    windows = windows.withColumn("hashes", _grams("words", GRAM))
    whole = F.xxhash64(*[F.get(F.col("words"), F.lit(j)) for j in range(SPAN - 1)])  # absent words add nothing
    windows.select("wid", "len", "words", F.when(F.col("len") == SPAN, F.array_min("hashes")).otherwise(whole).alias("h")).write.parquet(f"{base}/windows")
    windows = spark.read.parquet(f"{base}/windows")
    return windows, spans.join(windows.select("wid", "words"), "words").select("wid", "item_id").distinct()


def _bitmap(prints: DataFrame) -> Callable[[Column], Column] | None:
    """A test whether a fingerprint may be among ``prints`` (h); none if there are none."""
    count = prints.count()
    if count == 0:
        return None
    bits = min(max(BITMAP[0], 1 << (64 * count - 1).bit_length()), BITMAP[1])
    shift = 64 - (bits // 64).bit_length() + 1

    def cell(h: Column) -> Column:
        return F.shiftrightunsigned(h, shift).cast("int")

    def place(h: Column) -> Column:
        return h.bitwiseAND(F.lit(63)).cast("int")

    cells = prints.groupBy(cell(F.col("h")).alias("cell")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), place(F.col("h")))).alias("ones"))
    held = {r["cell"]: r["ones"] for r in cells.collect()}  # one row per 64 bits at most
    table = F.split(F.lit(",".join(str(held.get(i, 0)) for i in range(bits // 64))), ",").cast("array<bigint>")
    return lambda h: F.call_function("bit_get", F.get(table, cell(h)), place(h)) == 1


def _passing(prints: Column, test: Callable[[Column], Column], size: int) -> Column:
    """(start, len, words) of the windows of ``tokens`` whose fingerprint passes the test."""
    places = F.array_compact(F.transform(prints, lambda h, i: F.when(test(h), i)))
    return F.transform(places, lambda i: F.struct(i.cast("int").alias("start"), F.lit(size).alias("len"), F.slice("tokens", i + 1, size).alias("words")))


def _candidates(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """Stored (doc_id, version, n_words, near) of every row; ``near`` are the places and words of windows whose fingerprint may be a benchmark's."""
    short = sorted(r["len"] for r in windows.where(F.col("len") < SPAN).select("len").distinct().collect())  # nine values at most
    tokens = docs.select("doc_id", F.xxhash64("text").alias("version"), words(F.col("text")).alias("tokens"))
    parts = []

    test = _bitmap(windows.where(F.col("len") == SPAN).select("h").distinct())
    if test is not None:
        tokens = tokens.withColumn("one", _grams("tokens", GRAM))
        tokens = tokens.withColumn("two", _least("one", 1))
        tokens = tokens.withColumn("four", _least("two", 2))
        tokens = tokens.withColumn("six", _least("four", GUARD - 4))  # of places i to i + 5
        # The last places of "six" look beyond the text; a window begins where 6 hashes follow.
        whole = F.slice("six", 1, F.greatest(F.size("one") - (GUARD - 1), F.lit(0)))
        parts.append(_passing(whole, test, SPAN))
    for k in short:
        test = _bitmap(windows.where(F.col("len") == k).select("h").distinct())
        parts.append(_passing(_grams("tokens", k), test, k))
    none = F.array().cast("array<struct<start:int,len:int,words:array<string>>>")
    out = scratch_path(docs.sparkSession, "benchmark-candidates")
    tokens.select("doc_id", "version", F.size("tokens").cast("long").alias("n_words"), (F.concat(*parts) if parts else none).alias("near")).write.parquet(out)
    return docs.sparkSession.read.parquet(out)


def _covered(spans: Column) -> Column:
    """Words covered by sorted (start, len) spans."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("total"))

    def step(acc, x):
        stop = F.greatest(acc["end"], x["start"] + x["len"])
        return F.struct(stop.alias("end"), (acc["total"] + stop - F.greatest(acc["end"], x["start"])).cast("long").alias("total"))

    return F.aggregate(spans, zero, step, lambda acc: acc["total"])


def hits(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(doc_id, version, start, len, wid) of every occurrence of a window; (wid, item_id); (doc_id, version, n_words) of every row."""
    windows, owners = benchmark_windows(benchmark)
    rows = _candidates(docs, windows)
    near = rows.where(F.size("near") > 0).select("doc_id", "version", F.inline("near")).withColumn("key", F.xxhash64("words"))
    probes = windows.select("wid", F.col("words").alias("own"), F.xxhash64("words").alias("own_key"))
    if windows.count() <= BROADCAST_WINDOWS:
        probes = F.broadcast(probes)
    found = near.join(probes, (F.col("key") == F.col("own_key")) & (F.col("words") == F.col("own")))
    return found.select("doc_id", "version", "start", "len", "wid").distinct(), owners, rows.select("doc_id", "version", "n_words")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for every row of ``docs``."""
    spark = docs.sparkSession
    keys = ["doc_id", "version"]
    found, owners, every = hits(docs, benchmark)
    out = scratch_path(spark, "benchmark-hits")
    found.write.parquet(out)
    found = spark.read.parquet(out)
    spans = found.groupBy(*keys).agg(F.sort_array(F.collect_set(F.struct("start", "len"))).alias("spans"))
    items = found.select(*keys, "wid").distinct().join(owners, "wid").select(*keys, F.col("item_id").cast("string").alias("item")).where("item IS NOT NULL").distinct()
    items = items.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_items"), F.sha2(F.array_join(F.array_sort(F.collect_list("item")), ","), 256).alias("items_sha256"))
    dirty = spans.join(items, (spans["doc_id"].eqNullSafe(items["doc_id"])) & (spans["version"] == items["version"]), "left").select(
        spans["doc_id"].alias("d"), spans["version"].alias("v"), "spans", "n_items", "items_sha256")
    return every.join(dirty, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("version") == F.col("v")), "left").select(
        "doc_id", "n_words", F.coalesce(_covered(F.col("spans")), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        F.col("spans").isNotNull().alias("contaminated"))


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no window of the benchmark."""
    out = scratch_path(docs.sparkSession, "benchmark-hits")
    with scratch_scope(docs.sparkSession):
        hits(docs, benchmark)[0].select("doc_id", "version").distinct().write.parquet(out)
    found = docs.sparkSession.read.parquet(out)
    name, version = f"id_{uuid.uuid4().hex}", f"version_{uuid.uuid4().hex}"  # names that docs does not have
    dirty = found.select(F.col("doc_id").alias(name), F.col("version").alias(version))
    return docs.join(dirty, docs["doc_id"].eqNullSafe(F.col(name)) & (F.xxhash64(docs["text"]) == F.col(version)), "left_anti")
