"""Ranked search against brute force and SQL."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from groundstop.llm import term_treap
from groundstop.llm.queries import ORACLES

from test_queries import LOW, duck, same

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(LOW))


def brute(rows, items, k):
    docs = [(i, t) for i, t in ((i, terms(t)) for i, t in rows) if t]
    big_n, big_l = len(docs), sum(len(t) for _, t in docs)
    out = []
    for n, (item, text) in enumerate(items):
        scores = []
        for i, t in docs:
            m, score = 50 + (50 * len(t) * big_n) // big_l, 0
            for term in set(terms(text)):
                df, tf = sum(term in set(o) for _, o in docs) if term in t else 0, t.count(term)
                if tf:
                    score += math.floor(1000 * math.log((2 * big_n + 2) / (2 * df + 1))) * ((10**9 * tf) // (1000 * tf + 20 * m))
            if score:
                scores.append((-score, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scores, key=lambda x: x[:2] + (x[2] or 0,))[:k])]
    return out


def corpus():
    rng = random.Random(4)
    lexicon = ["w%d" % i for i in range(40)] + ["É", "naïve", "ß1", "The", "the", "THE"]
    rows = [(i, " ".join(rng.choice(lexicon) for _ in range(rng.randrange(1, 40)))) for i in range(150)]
    rows += [(500 + i, "same words the w1") for i in range(90)]  # ties beyond k
    rows += [(700, None), (701, ""), (702, "... !!"), (3, "repeated id w3 w3 w3"), (3, "w3"), (None, "w1 w3"), (None, "same words the w1")]
    rng.shuffle(rows)
    items = [(0, "the w1, w3! É"), (1, "same WORDS"), (1, "w3 w3 ß1"), (2, None), (3, "  "), (4, "absent"), (None, "naïve w39 w5"), (5, " ".join(lexicon))]
    return rows, items


@pytest.mark.parametrize("size,k,item_bytes", [(term_treap.SHARD_TEXT, 50, 1 << 20), (300, 50, 1), (1, 7, 100)])
def test_search_matches_brute_force(spark, size, k, item_bytes):
    rows, items = corpus()
    docs = spark.createDataFrame(spark.sparkContext.parallelize([(i, t, "x", 3) for i, t in rows], 3), "doc_id long, text string, blob string, item long")
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    got = sorted(map(tuple, term_treap.rank(docs, bench, k, size, item_bytes).collect()), key=repr)
    assert got == sorted(brute(rows, items, k), key=repr)


def test_search_matches_sql(spark, docs, rows, no_docs):
    items = [(n, t) for n, (_, t) in enumerate(rows[::3])] + [(None, "one two"), (1, "one")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    con = duck(documents=(["doc_id", "text"], rows), benchmark=(["item_id", "text"], items))
    same(term_treap.rank(docs, bench, shard_text=20_000), con, ORACLES["op11_term_treap"])
    assert term_treap.rank(no_docs, bench).count() == 0
    assert term_treap.rank(docs, bench.where("item_id < 0")).count() == 0


def test_cells_keep_the_greatest_impact_below_them():
    rows, _ = corpus()
    ids = np.array([term_treap.NO_ID if i is None else i for i, _ in rows])
    treap = term_treap.Treap(term_treap.Treap.build(ids, pa.array([t for _, t in rows], pa.large_string()), 200, 4000))
    assert (treap.ids == np.sort(ids)).all() and treap.depth == 8
    inner = np.flatnonzero(treap.mask)
    for n in inner.tolist():
        children = treap.start[n] + np.arange(term_treap._ONES[treap.mask[n]])
        assert treap.most[n] == treap.most[children].max()
    leaves = len(treap.mask) - 1 - len(inner)
    assert leaves == int(treap.df.sum())
