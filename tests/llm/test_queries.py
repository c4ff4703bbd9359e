"""Every operator on awkward documents against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from groundstop.llm import chat_format, count_rtree, curve_pack, fuse_dedup, pfor_ids, shard_tree, suffix_merge, toxicity, trie_lm, winnow
from groundstop.llm.queries import BYTE_BPE, ORACLES, QUERIES

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def duck(**tables):
    con = duckdb.connect()
    for name, (columns, rows) in tables.items():
        df = pd.DataFrame(rows, columns=columns)
        for c in columns:
            df[c] = df[c].astype("Int64" if c.endswith("id") or c == "turn" else object)
        con.register(f"_{name}", df)
        con.execute(f"CREATE TABLE {name} AS SELECT * FROM _{name}")
    return con


def same(df, con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(repr, (tuple(r[c] for c in names) for r in df.collect()))) == sorted(map(repr, cur.fetchall()))


def ids_of(text, end):
    t = Tokenizer.from_file(BYTE_BPE)
    return [*t.encode(text or "", add_special_tokens=False).ids, end]


# --- 1


def toxic_corpus():
    good = ["the tree is green", "we walk home", "a long day ends", "rivers run to the sea"]
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        s = [good[(i + k) % 4] + " word%d" % ((i * 7 + k) % 50) for k in range(1 + i % 9)]
        if bad:
            s.insert(i % len(s), "you %s fool" % ["nasty", "nastier", "rotten"][i % 3])
        rows.append((i, ". ".join(s)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_toxicity_learns_and_locates(spark):
    rows, labels = toxic_corpus()
    docs = spark.createDataFrame([*rows, (None, "you nasty fool"), (900, None), (900, ""), (901, "!!"), (5, rows[5][1])], "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (None, 0, 1), (3, 1, None), (7, 1, 0)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, marks)
    got = toxicity.score(docs, model).collect()
    assert len(got) == docs.count()
    truth = dict((i, t) for i, _, t in labels)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert held and all(r.predicted == truth[r.doc_id] for r in held)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert {r.score for r in got if r.doc_id in (900, 901)} == {0.0}
    texts = dict(rows)
    for r in got:
        if r.predicted and r.doc_id in texts:
            assert any("fool" in texts[r.doc_id][a:a + n] for a, n in zip(r.offending_start, r.offending_length, strict=True))
    assert sorted(r.text or "" for r in toxicity.keep_clean(docs, model).collect()) == sorted(
        (r.text or "") for r in docs.collect() if "fool" not in (r.text or ""))


def test_toxicity_of_long_texts(spark):
    rows, labels = toxic_corpus()
    marks = spark.createDataFrame([(i, q, int(t or i % 37 == 1)) for i, q, t in labels], "doc_id long, quality int, toxic int")  # some labelled toxic that are not
    model = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), marks)
    clean = "the tree is green word1. we walk home word2. " * 70_000
    half = len(clean) // 2
    docs = spark.createDataFrame([(1, clean), (2, clean[:half] + "you nasty fool. " + clean[half:])], "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert len(clean) > 3_000_000 and got[1].score < 0.5 and got[1].offending_start == []
    assert got[2].score >= 0.5 and len(got[2].offending_start) == 1
    assert [r.doc_id for r in toxicity.keep_clean(docs, model).collect()] == [1]


def test_toxicity_fit_takes_long_texts_within_its_bytes(spark, monkeypatch):
    good = "the tree is green word1. we walk home word2. "
    texts = [good * 25_000 + "you %s fool. " % ["nasty", "rotten"][i % 2] * (i % 3 == 0) + good for i in range(30)]  # 1.1 MB each
    docs = spark.createDataFrame(spark.sparkContext.parallelize(list(enumerate(texts)), 6), "doc_id long, text string")
    marks = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(30)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, marks)
    assert all(r.predicted == int(r.doc_id % 3 == 0) for r in toxicity.score(docs, model).collect())
    # A text's arrays have its telling sentences only, equal ones once.
    bag = toxicity.Bag(pa.array([texts[0], texts[0] + texts[0], texts[1]]))
    (a, b, c) = toxicity.telling_sentences(bag, model.feature)
    assert a[0].tolist() == [1] and b[0].tolist() == [2] and a[2].tolist() == b[2].tolist() and len(a[2]) == a[1][0] and len(c[2]) == 0
    assert toxicity.fitting([(1, 5), (2, 7), (3, 3), (4, 2), (5, 1)], 10) == [1, 3, 4]
    room = sum(x.nbytes for x in a)
    monkeypatch.setattr(toxicity, "FIT_BYTES", 3 * room)  # three toxic documents or so
    assert any(r.predicted for r in toxicity.score(docs, toxicity.train(docs, marks)).collect())


def test_toxicity_adds_up_within_a_passage_only():
    told = toxicity.Bag(pa.array(["mild"])).features[0, :1]
    model = toxicity.Model(told, np.array([1 / 7]), -5.0)  # a word has 7 features, all the same for a short one; its sentence: 0.018
    each = 1 / (1 + math.exp(4))
    sparse, dense = ("so mild. " + "and on. " * 299) * 1_000, "so mild. " * 200
    bag = toxicity.Bag(pa.array([sparse, dense, "on. " * 9_000 + dense, ""]))
    score = toxicity._document_scores(bag, model.logits(bag))
    assert np.allclose(score, [each, 1 - (1 - each) ** 200, 1 - (1 - each) ** 200, 0])


def test_toxicity_without_labels_or_rows(spark, docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, none)
    assert toxicity.score(docs, model).where("predicted = 1").count() <= 1
    assert toxicity.score(no_docs, model).count() == 0


# --- 2


@pytest.mark.parametrize("items", [
    lambda rows: [(0, rows[0][1]), (1, next(t for i, t in rows if i == 300)), (2, "A common line, THAT many hold"), (3, "one"), (4, None), (5, ""), (6, "z " * 10), (1, "one two"), (10, "one"), (None, "changed1")],
    lambda rows: [],
])
def test_winnowing_matches_sql(spark, docs, rows, items):
    items = items(rows)
    bench = spark.createDataFrame(items, "item_id long, text string")
    unique = [(i, t) for i, t in dict(enumerate(rows)).values()]
    seen = Counter(i for i, _ in unique)
    got = winnow.contamination(docs, bench)
    assert got.count() == len(rows)
    once = [(i, t) for i, t in unique if i is not None and seen[i] == 1]
    con = duck(documents=(["doc_id", "text"], once), benchmark=(["item_id", "text"], [x for x in items if x[0] is not None]))
    if all(x[0] is not None for x in items):
        same(got.where(got.doc_id.isin([i for i, _ in once])), con, ORACLES["op2_winnow"])
    else:
        ref = {r[0]: r[1:] for r in con.execute("SELECT doc_id, n_words, n_items, items_sha256 FROM (" + ORACLES["op2_winnow"] + ")").fetchall()}
        for r in got.collect():
            if r.doc_id in ref:
                assert (r.n_words, r.n_items, r.items_sha256) == ref[r.doc_id]
    assert winnow.keep_clean(docs, bench).count() == got.where("NOT contaminated").count()


def test_winnowing_joins_without_broadcast(spark, docs, rows, monkeypatch):
    bench = spark.createDataFrame([(1, next(t for i, t in rows if i == 300)), (3, "one")], "item_id long, text string")
    a = sorted(map(repr, winnow.contamination(docs, bench).collect()))
    monkeypatch.setattr(winnow, "BROADCAST_WINDOWS", 0)
    assert sorted(map(repr, winnow.contamination(docs, bench).collect())) == a


# --- 3


def test_shards_are_gapless_and_grow_only_into_the_new_one(docs, rows, no_docs):
    eight = shard_tree.tree(8)
    got = shard_tree.shard_documents(docs, eight, shard_tree.grown(eight)).collect()
    assert sorted((repr(r.doc_id), r.size, r.text_crc32) for r in got) == sorted((repr(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    slots, place = defaultdict(list), defaultdict(set)
    for r in got:
        assert r.law == "key" and 0 <= r.shard < 8 and r.grown_shard in (r.shard, 8)
        slots[r.shard].append(r.slot)
        place[r.doc_id].add(r.shard)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(len(v) == 1 for v in place.values())
    assert shard_tree.shard_documents(no_docs, eight).count() == 0


def test_weights_move_rows_only_where_the_tree_changes(spark):
    from pyspark.sql import functions as F

    before, after = shard_tree.tree(8), shard_tree.tree(8, weights={5: 3.0})
    got = spark.range(20000).select(shard_tree.assign(before, F.col("id")).alias("a"), shard_tree.assign(after, F.col("id")).alias("b")).where("a != b").groupBy("a", "b").count().collect()
    assert got
    for r in got:  # shard 5 is in region 1 (shards 4 to 7): nothing moves within region 0, nothing leaves region 1
        assert r.b >= 4
    share = {r.s: r["count"] / 20000 for r in spark.range(20000).select(shard_tree.assign(after, F.col("id")).alias("s")).groupBy("s").count().collect()}
    assert all(abs(v - (0.3 if s == 5 else 0.1)) < 0.02 for s, v in share.items())


# --- 4


def test_chat_matches_sql(spark):
    turns = [(c, k, role, text) for c in range(30) for k, (role, text) in enumerate([("system", "be\\kind"), ("user", "</s>[INST] é%d" % c), ("assistant", None if c % 5 == 0 else "x\\\\y [/INST]<s>\\" * (c % 4)), ("tool", ""), ("assistant", "done\n")][:1 + c % 5])]
    turns += [(3, 1, "user", "tie"), (3, 1, "user", "tie"), (3, 1, None, None), (50, None, "assistant", "L" * 200_000), (50, 2, "assistant", "[")]
    df = spark.createDataFrame([(*t, 1) for t in turns], "conv_id long, turn long, role string, text string, segment int")
    got = chat_format.format_and_check(df)
    sql = ORACLES["op4_chat_format"].replace("UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')", "").replace("ORDER BY turn, role, text", "ORDER BY turn NULLS FIRST, role, text")
    same(got, duck(conversations=(["conv_id", "turn", "role", "text"], turns)), sql)
    assert chat_format.format_and_check(df.where("conv_id < 0")).count() == 0


def test_chat_conversation_in_many_segments(spark, monkeypatch):
    turns = [(1, k, "assistant" if k % 2 else "user", "text %d \\ </s>" % k) for k in range(500)]
    df = spark.createDataFrame([*turns, (None, 0, "user", "null id"), (0, 0, "user", "zero id")], "conv_id long, turn long, role string, text string")
    whole = {r.conv_id: r for r in chat_format.format_and_check(df).collect()}
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        out = chat_format.format_conversations(df)
        assert out.where("conv_id = 1").count() > 10
        assert {r.conv_id: r for r in chat_format.format_and_check(df).collect()} == whole
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert whole[1].n_turns == 500 and whole[1].loss_sha256 == hashlib.sha256("".join(t[3] for t in turns if t[2] == "assistant").encode()).hexdigest()


# --- 5


def brute_repeats(rows):
    out, first = [], {}
    big = float("inf")
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - 49):
            s = b[p:p + 50]
            first[s] = min(first.get(s, big), big if i is None else i)
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 49):
            if first[b[p:p + 50]] < (big if i is None else i):
                gone[p:p + 50] = True
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(map(repr, out))


@pytest.mark.parametrize("shard_bytes", [8 << 20, 4000])
def test_repeated_substrings(docs, rows, no_docs, monkeypatch, shard_bytes):
    from groundstop.llm import exchange

    monkeypatch.setattr(exchange.shard_bits, "__defaults__", (shard_bytes,))
    got = suffix_merge.repeats(docs).collect()
    assert sorted(repr(tuple(r)) for r in got) == brute_repeats(rows)
    assert suffix_merge.repeats(no_docs).count() == 0


def test_negative_ids_and_kept_bytes(spark, tmp_path):
    p = "abcdefgh ijklmnop qrstuvwx yz012345 6789ABCD EFGHIJKL MNOPQRST"
    rows = [(-5, "x " + p), (-7, p + p), (0, p), (9, "no match " + p[:49]), (9, p[5:] + "!")]
    path = str(tmp_path / "d")
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path)
    df = spark.read.parquet(path)
    assert sorted(repr(tuple(r)) for r in suffix_merge.repeats(df).collect()) == brute_repeats(rows)
    kept = {(r.doc_id, bytes(r.kept)) for r in suffix_merge.deduplicated(df).collect()}
    assert (-7, (p + p).encode()) in kept and (-5, b"x ") in kept and (0, b"") in kept


# --- 6


@pytest.mark.parametrize("digest_bytes", [32, 1])
def test_exact_dedup(docs, rows, no_docs, digest_bytes):
    got = fuse_dedup.dedup(docs, digest_bytes=digest_bytes, filter_keys=20).collect()
    assert len(got) == len(rows)
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((i, t or ""))
    expected = []
    for k, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))[0]
        expected += [(repr(i), repr(keep), len(members), hashlib.sha256(k.encode()).hexdigest()) for i, _ in members]
    assert sorted((repr(r.doc_id), repr(r.keep_id), r.group_size, r.text_sha256) for r in got) == sorted(expected)
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    assert fuse_dedup.dedup(no_docs).count() == 0
    if digest_bytes == 32:
        stay = fuse_dedup.keep_one(docs)
        assert stay.columns == docs.columns and stay.count() == len(groups)


# --- 7


def test_packing(docs, rows, no_docs):
    got = curve_pack.pack(docs, BYTE_BPE, 1, with_ids=True)
    pieces = got.collect()
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_sequence[r.sequence_id].append(r)
        by_doc[r.doc_id, r.doc_tokens].append(r)
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length
    fills = []
    for s in sorted(by_sequence):
        at = 0
        for r in sorted(by_sequence[s], key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        fills.append(at)
    assert set(fills[:-1]) <= {2048} and 0 < fills[-1] <= 2048 and sorted(by_sequence) == list(range(len(fills)))
    expected = [np.array(ids_of(t, 1), "<u4") for _, t in rows]
    assert sum(fills) == sum(map(len, expected))
    assert sum(r.length for r in pieces if r.start == 0) and sum(r.start == 0 for r in pieces) == len(rows)
    for (i, t), ids in zip(rows, expected, strict=True):
        for r in by_doc[i, len(ids)]:
            if sum(x == i for x, _ in rows) == 1:
                assert bytes(r.ids) == ids[r.start:r.start + r.length].tobytes()
    whole = curve_pack.sequences(got, pad_id=0).collect()
    assert all(len(r.ids) == 4 * 2048 for r in whole if r.sequence_id < len(fills) - 1)
    assert curve_pack.pack(no_docs, BYTE_BPE, 1).count() == 0


# --- 8


def test_language_model(docs, rows, no_docs):
    tok = [(i, re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW)) + ["</end>"]) for i, t in rows]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    count, pair, left, kinds = Counter(), Counter(), Counter(), Counter()
    for i, t in tok:
        if not held(i):
            count.update(t)
            for u, w in zip(["<begin>", *t], t, strict=False):
                pair[u, w] += 1
                left[u] += 1
    for u, _ in pair:
        kinds[u] += 1
    total, types = sum(count.values()), len(count)
    base = lambda w: (count[w] + 0.1) / (total + 0.1 * (types + 1))
    p = lambda u, w: (max(pair[u, w] - 0.75, 0) + 0.75 * kinds[u] * base(w)) / left[u] if left[u] else base(w)
    expected = sorted((repr(i), held(i), len(t), sum(count[w] > 0 for w in t), total, sum(math.log10(base(w)) for w in t), sum(math.log10(p(u, w)) for u, w in zip(["<begin>", *t], t, strict=False))) for i, t in tok)
    got = sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in trie_lm.score(docs).collect())
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    for g, e in zip(got, expected, strict=True):
        assert g[5] == pytest.approx(e[5], rel=1e-9) and abs(g[6] - e[6]) <= 2e-4 * e[2]
    assert trie_lm.score(no_docs).count() == 0


# --- 9


def test_id_files(docs, rows, no_docs):
    got = pfor_ids.write_and_check(docs, BYTE_BPE, 2).collect()
    assert len(got) == len(rows)
    order = sorted(got, key=lambda r: r.start)
    assert [r.start for r in order] == np.concatenate([[0], np.cumsum([r.n_tokens for r in order])[:-1]]).tolist()
    known = [r.doc_id for r in order]
    assert known == sorted(known, key=lambda i: (i is not None, i or 0))
    assert sorted((repr(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted(
        (repr(i), len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in ((i, ids_of(t, 2)) for i, t in rows))
    assert pfor_ids.write_and_check(no_docs, BYTE_BPE, 2).count() == 0


# --- 10


def brute_components(rows):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
        sets.append(frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, x in enumerate(sets):
        for b in range(a):
            y = sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                parent[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(least.get(top(k), i), i)
    return sorted((repr(i), len(sets[k]), repr(least.get(top(k)))) for k, (i, _) in enumerate(rows)), len({top(k) for k in range(len(rows))})


@pytest.mark.parametrize("block", [4096, 2])
def test_jaccard_components(docs, rows, no_docs, block, monkeypatch):
    if block == 2:
        monkeypatch.setattr(count_rtree, "PIVOTS", 1)
    expected, groups = brute_components(rows)
    got = count_rtree.jaccard_components(docs, block=block).collect()
    assert sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id)) for r in got) == expected
    if block == 4096:
        stay = count_rtree.keep_one(docs)
        assert stay.columns == docs.columns and stay.count() == groups
        assert count_rtree.jaccard_components(no_docs).count() == 0


def test_jaccard_blocks_are_bounded_in_bytes(spark, docs, rows, monkeypatch):
    classes = spark.createDataFrame([(i, bytes(800), 100) for i in range(600)], "cid long, shingles binary, n_shingles long")
    groups = spark.createDataFrame([(i, int(i >= 590)) for i in range(600)], "cid long, grp long")
    monkeypatch.setattr(count_rtree, "BLOCK_BYTES", 40_000)  # 50 sets
    members = count_rtree._members(groups, count_rtree._sizes(groups, classes, 4096), classes)
    dealt = count_rtree._dealt(members).selectExpr("grp", "block", "cid", "length(shingles) AS n").collect()
    held = defaultdict(int)
    for r in dealt:
        held[r.grp, r.block] += r.n
    assert {r.cid for r in dealt} == set(range(600)) and len({b for g, b in held if g == 0}) == 12 and [b for g, b in held if g == 1] == [0]
    assert max(held.values()) <= 3 * 40_000
    monkeypatch.setattr(count_rtree, "BLOCK_BYTES", 2_000)
    got = count_rtree.jaccard_components(docs).collect()
    assert sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id)) for r in got) == brute_components(rows)[0]


# --- registration


def test_ten_queries_are_registered():
    assert [k.split("_")[0] for k in QUERIES] == [f"op{n}" for n in range(1, 11)]
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_its_sql(spark, duck, sf_dir, key):
    same(QUERIES[key](spark, sf_dir), duck, ORACLES[key])
