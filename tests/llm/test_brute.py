"""Second computations of results that were only tested by their properties: shards, curve order, the pipeline on awkward rows."""

import math
import re
import struct
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from groundstop.llm import curve_pack, pfor_ids, shard_tree, toxicity
from groundstop.llm.queries import BYTE_BPE
from test_queries import LOW, brute_components

GAP = " \t\n\x0b\x0c\r"


def descend(node, doc_id):
    """The shard of a key, drawn in plain Python."""
    while node.shard is None:
        live = [c for c in node.children if c.weight > 0]
        draws = []
        for i, c in enumerate(live):
            h = 42 if doc_id is None else xxhash.xxh64_intdigest(struct.pack("<q", doc_id), 42)
            bits = xxhash.xxh64_intdigest(c.name.encode(), h) >> 11
            draws.append((math.log((bits + 0.5) / 2.0**53) / c.weight, -i, c))
        node = max(draws, key=lambda d: d[:2])[2] if len(live) > 1 else live[0]
    return node.shard


def test_shards_drawn_again(docs):
    eight = shard_tree.tree(8, weights={2: 0.5, 5: 3.0})
    nine = shard_tree.grown(eight)
    for r in shard_tree.shard_documents(docs, eight, nine).collect():
        assert (r.shard, r.grown_shard) == (descend(eight, r.doc_id), descend(nine, r.doc_id))


def mixed(x):
    """64-bit finaliser in plain integers."""
    keep = (1 << 64) - 1
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & keep
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & keep
    return x ^ (x >> 31)


def test_packing_follows_the_curve(docs, rows):
    library = Tokenizer.from_file(BYTE_BPE)
    directions = curve_pack.projection()
    expected = Counter()
    for i, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        vector = np.zeros(curve_pack.BUCKETS)
        for x in ids:
            vector[mixed(x + 1) % curve_pack.BUCKETS] += 1
        vector /= math.sqrt(sum(v * v for v in vector))
        cell = [min(int((1 / (1 + math.exp(-1.7 * float(vector @ directions[:, d])))) * (1 << curve_pack.BITS)), (1 << curve_pack.BITS) - 1) for d in range(curve_pack.DIMS)]
        expected[repr(i), len(ids), int(curve_pack.hilbert_key(np.array([cell]))[0])] += 1
    encoded = curve_pack.encode(docs, BYTE_BPE, 1).select("doc_id", "n", "place").collect()
    assert Counter((repr(r.doc_id), r.n, r.place) for r in encoded) == expected
    places = {(d, n): p for d, n, p in expected}
    if len(places) < len(expected):
        places = {k: v for k, v in places.items() if sum((d, n) == k for d, n, _ in expected) == 1}
    packed = curve_pack.pack(docs, BYTE_BPE, 1).where("start = 0").orderBy("sequence_id", "offset").collect()
    along = [places[repr(r.doc_id), r.doc_tokens] for r in packed if (repr(r.doc_id), r.doc_tokens) in places]
    assert len(along) > 30 and along == sorted(along)


def test_id_files_read_whole(spark, docs, rows, tmp_path):
    library = Tokenizer.from_file(BYTE_BPE)
    pfor_ids.write_files(docs, str(tmp_path / "files"), BYTE_BPE, 2)
    got = pfor_ids.read_documents(spark.read.parquet(str(tmp_path / "files"))).orderBy("start").collect()
    assert Counter((repr(r.doc_id), tuple(r.ids)) for r in got) == Counter((repr(i), (*library.encode(t or "", add_special_tokens=False).ids, 2)) for i, t in rows)
    assert [r.start for r in got] == np.concatenate([[0], np.cumsum([len(r.ids) for r in got])[:-1]]).tolist()


def test_hilbert_curve_is_one(bits=3):
    grid = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    key = curve_pack.hilbert_key(grid, bits)
    assert sorted(key.tolist()) == list(range(512))
    for level in (1, 2):  # every octant of every level is one stretch of the curve
        side = 3 * (bits - level)
        octant = (grid >> (bits - level)) @ np.array([1, 1 << level, 1 << 2 * level])
        assert all(len(set((key[octant == o] >> side).tolist())) == 1 for o in np.unique(octant))


def windows(text, bench):
    """Whether a benchmark window occurs in the text."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    w = word.findall((text or "").translate(LOW))
    for t in bench:
        b = word.findall((t or "").translate(LOW))
        spans = [b[k:k + 10] for k in range(len(b) - 9)] if len(b) >= 10 else [b] if b else []
        if any(w[k:k + len(s)] == s for s in spans for k in range(len(w) - len(s) + 1)):
            return True
    return False


def test_pipeline_on_awkward_rows(spark, docs, rows, tmp_path):
    folder = str(tmp_path)
    clean = [(2000 + i, "a tree is green. we walk home %d" % i) for i in range(200)]
    bad = [(3000 + i, "a tree is green. you %s fool %d" % (["nasty", "rotten"][i % 2], i)) for i in range(60)]
    every = rows + clean + bad
    table = spark.createDataFrame(spark.sparkContext.parallelize([(i, t, "en", "s", len(t or ""), i) for i, t in every], 5),
                                  "doc_id long, text string, lang string, source string, n_chars long, _gone_row long")
    table.write.parquet(f"{folder}/documents.parquet")
    bench = [next(t for i, t in rows if i == 300), "one two", None, ""]
    spark.createDataFrame([(k, t) for k, t in enumerate(bench)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(i, 1, int(i >= 3000)) for i, _ in clean + bad], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")

    stored = spark.read.parquet(f"{folder}/documents.parquet")
    model = toxicity.train(stored, spark.read.parquet(f"{folder}/labels.parquet"))
    toxic = {(r.doc_id, r.text) for r in stored.join(toxicity.score(stored, model).where("predicted = 1").select("doc_id").distinct(), "doc_id", "left_semi").collect()}
    now = [(i, t) for i, t in every if not (i is not None and i >= 3000)]
    assert {i for i, _ in toxic} <= {i for i, _ in bad} and len(toxic) == len(bad)
    groups = {}
    for i, t in now:
        groups.setdefault("".join(c for c in t or "" if c not in GAP), []).append((i, t))
    order = lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0)
    now = [min(g, key=order) for g in groups.values()]
    keep = {c for _, n, c in brute_components(now)[0] if n}
    now = [(i, t) for i, t in now if repr(i) in keep or brute_components([(i, t)])[0][0][1] == 0]  # without shingles: linked with nothing
    want = Counter(repr(i) for i, t in now if not windows(t, bench))

    got = corpus_pipeline.run(spark, folder).select("doc_id", "doc_tokens", F.col("start") == 0).collect()
    assert Counter(repr(r.doc_id) for r in got if r[2]) == want
    library = Tokenizer.from_file(BYTE_BPE)
    sizes = Counter((repr(i), len(library.encode(t or "", add_special_tokens=False).ids) + 1) for i, t in now if not windows(t, bench))
    assert Counter((repr(r.doc_id), r.doc_tokens) for r in got if r[2]) == sizes
