"""Results do not depend on how a scan is cut, and column names of the input do no harm."""

import glob

import pytest
from pyspark.sql import functions as F

from groundstop.llm import count_rtree, fragment_align, fuse_dedup, phrase_automata, suffix_merge, term_treap, trie_lm, winnow
from groundstop.llm.queries import BYTE_BPE, PIECE_BPE
from groundstop.session import checkpoint_dir

CUT = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.leafNodeDefaultParallelism"


@pytest.fixture(scope="module")
def eight(spark, docs, tmp_path_factory):
    """The documents in eight files."""
    path = str(tmp_path_factory.mktemp("layout") / "documents")
    docs.repartition(8).write.parquet(path)
    return spark.read.parquet(path)


def cut(spark, size, cost, tasks):
    for key, value in zip(CUT, (size, cost, tasks), strict=True):
        spark.conf.set(key, value)


@pytest.fixture
def recut(spark):
    """Plan and run what is run at once with eight parts, and the rest with one or two."""
    def go(make):
        cut(spark, "4k", "4k", "8")
        df = make()
        cut(spark, "1g", "0", "2")
        return sorted(map(repr, map(tuple, df.collect())))

    yield go
    for key in CUT:
        spark.conf.unset(key)


@pytest.mark.parametrize("name,make", [
    ("suffix", lambda d: suffix_merge.repeats(d)),
    ("fuse", lambda d: fuse_dedup.dedup(d).groupBy("doc_id", "group_size", "text_sha256", "kept").count()),
    ("fuse keep_one", lambda d: fuse_dedup.keep_one(d).select("doc_id", "text")),
    ("trie", lambda d: trie_lm.score(d).select("doc_id", "n_tokens", "n_known", "train_tokens", F.round("score", 6))),
    ("jaccard", lambda d: count_rtree.jaccard_components(d)),
    ("jaccard keep_one", lambda d: count_rtree.keep_one(d).select("doc_id", "text")),
    ("phrases", lambda d: phrase_automata.repeats(d)),
    ("align", lambda d: fragment_align.align(d, BYTE_BPE, PIECE_BPE, 5_000)),
    ("treap", lambda d: term_treap.rank(d, d.where("doc_id IN (1, 300, 404)").select(F.col("doc_id").alias("item_id"), "text"))),
])
def test_scans_may_be_cut_differently(eight, recut, name, make):
    assert recut(lambda: make(eight)) == sorted(map(repr, map(tuple, make(eight).collect())))


def test_names_of_columns_do_not_clash(spark, docs):
    names = ["_gone_row", "_dirty_id", "_dirty_version", "_row_of_dedup", "_row_of_join", "row", "digest", "component_id", "near", "batch", "key"]
    wide = docs.select("doc_id", "text", *[F.lit(i).alias(n) for i, n in enumerate(names)])
    bench = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    for keep in (fuse_dedup.keep_one, count_rtree.keep_one, lambda d: winnow.keep_clean(d, bench)):
        got = keep(wide)
        assert got.columns == wide.columns
        assert sorted(r.text or "" for r in got.collect()) == sorted(r.text or "" for r in keep(docs.select("doc_id", "text")).collect())
        assert got.where(F.array(*names) != F.array(*[F.lit(i) for i in range(len(names))])).count() == 0


def test_suffix_messages_and_shuffles_go_once_answered(spark, docs):
    base = checkpoint_dir(spark).removeprefix("file:")
    before, key = set(glob.glob(f"{base}/scratch/suffix-runs-*")), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    seen, kept = [], spark.conf.get(key)
    real = suffix_merge.exchange.answer

    def watched(messages, reply):
        seen.append(spark.conf.get(key))
        return real(messages, reply)

    suffix_merge.exchange.answer = watched
    try:
        got = suffix_merge.repeats(docs)
    finally:
        suffix_merge.exchange.answer = real
    fresh, = set(glob.glob(f"{base}/scratch/suffix-runs-*")) - before
    assert {r.shard for r in spark.read.parquet(f"{fresh}/runs").select("shard").distinct().collect()} == {suffix_merge.OWN}
    assert seen == ["true", "true"] and spark.conf.get(key) == kept
    assert got.count() == docs.count()
