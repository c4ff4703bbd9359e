"""Repeated phrases against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from groundstop.llm import phrase_automata

WORD = re.compile("[^ \t-\r]+")


def brute(rows, span=20):
    """(doc_id, n_words, removed flags, kept text) by a dictionary of all windows."""
    order = lambda i: float("inf") if i is None else i
    texts = [(i, WORD.findall(t or "")) for i, t in rows]
    least = {}
    for i, w in texts:
        for s in range(len(w) - span + 1):
            key = tuple(w[s:s + span])
            least[key] = min(least.get(key, order(None)), order(i))
    out = []
    for i, w in texts:
        gone, seen = [False] * len(w), set()
        for s in range(len(w) - span + 1):
            key = tuple(w[s:s + span])
            if least[key] < order(i) or key in seen:
                gone[s:s + span] = [True] * span
            seen.add(key)
        out.append((i, len(w), gone, " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


def extra_rows():
    rng = random.Random(11)
    words = ["w%d" % i for i in range(50)]
    line = " ".join(rng.choice(words) for _ in range(12))
    passage = [rng.choice(words) for _ in range(60)]
    rows = [(1000 + i, " ".join(rng.choice(words) for _ in range(9)) + f" {line} " + " ".join(rng.choice(words) for _ in range(9))) for i in range(60)]  # a common line, short of a window
    rows += [(1100 + i, "\n".join(passage[rng.randrange(30):rng.randrange(31, 61)]) + " end%d" % i) for i in range(60)]  # parts of one passage
    rows += [(1200, "a b " * 40), (1201, "b a " * 40), (1202, "x " * 19), (1203, "x " * 20), (1204, "x " * 21), (1205, " ".join(passage) + " . " + " ".join(passage))]
    rows += [(1300 + i, " ".join(passage) + " " + line) for i in range(20)]
    return rows


@pytest.mark.parametrize("hot", [phrase_automata.HOT, 0, 3])
def test_phrases_match_brute_force(spark, docs, rows, hot):
    extra = extra_rows()
    more = docs.select("doc_id", "text").union(spark.createDataFrame(spark.sparkContext.parallelize(extra, 5), "doc_id long, text string"))
    want = [(i, n, sum(g), hashlib.sha256(k.encode()).hexdigest()) for i, n, g, k in brute(rows + extra)]
    got = [tuple(r) for r in phrase_automata.repeats(more, hot).collect()]
    assert sum(w[2] for w in want) > 1000
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_phrases_texts_and_spans(spark):
    extra = extra_rows()
    table = spark.createDataFrame(spark.sparkContext.parallelize(extra, 3), "doc_id long, text string")
    want = brute(extra)
    assert sorted(map(tuple, phrase_automata.deduplicated(table).collect())) == sorted((i, k) for i, _, _, k in want)
    runs = []
    for i, _, gone, _ in want:
        at = 0
        while at < len(gone):
            end = at
            while end < len(gone) and gone[end]:
                end += 1
            if end > at:
                runs.append((i, at, end - at))
            at = max(end, at + 1)
    assert sorted(map(tuple, phrase_automata.removed_spans(table).collect())) == sorted(runs)


def test_phrases_of_no_rows(spark, no_docs):
    assert phrase_automata.repeats(no_docs).count() == 0
    blank = spark.createDataFrame([(1, None), (2, ""), (None, " \n")], "doc_id long, text string")
    assert [(r.n_words, r.n_removed, r.kept_sha256) for r in phrase_automata.repeats(blank).collect()] == [(0, 0, hashlib.sha256(b"").hexdigest())] * 3


def test_small_automata_give_the_same(monkeypatch):
    texts = [t.encode() + b" " for _, t in extra_rows()[60:120]]
    texts = [b" ".join(t.split()) + b" " for t in texts if len(t.split()) >= 20]
    low = np.arange(len(texts))
    context, first, last, least = phrase_automata._occurrences(list(dict.fromkeys(texts)), low, low)
    assert len(context) and (least <= low[context]).all() and (first <= last).all()


def test_split_and_anchors_agree_wherever_a_window_stands():
    window = " ".join("u%d" % (i * 7 % 23) for i in range(20))
    some = phrase_automata.split(pa.array([window, "before " + window + " after", None, "", "x\t\n" + window]))
    codes = phrase_automata._codes(some)
    a = phrase_automata.anchors(some, codes)
    hold = [{int(k) for k, f, z, r in zip(*a, strict=True) if r == row and f <= at <= z} for row, at in ((0, 0), (1, 21), (4, int(some.off[4]) + 1))]
    assert hold[0] == hold[1] == hold[2] and len(hold[0]) == 1
