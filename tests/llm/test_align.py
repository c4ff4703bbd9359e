"""Two tokenizers over the same bytes against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from groundstop.llm import fragment_align as fa
from groundstop.llm.queries import BYTE_BPE, PIECE_BPE


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(BYTE_BPE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)


def spelled(libraries, text):
    """(ids and ends of A, ids and ends of B), or None if one does not spell the text."""
    a, b = libraries
    table = fa._byte_of_char()
    want = (" " + text).encode()
    ia = a.encode(" " + text, add_special_tokens=False).ids
    ib = b.encode(text)
    sa = [bytes(table[c] for c in a.id_to_token(i)) for i in ia]
    sb = [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
    if b"".join(sa) != want or b"".join(sb) != want:
        return None
    return ia, np.cumsum([len(s) for s in sa]).tolist(), ib, np.cumsum([len(s) for s in sb]).tolist()


def brute(libraries, rows):
    docs = []
    for i, text in rows:
        got = spelled(libraries, text) if text else None
        if got is None:
            docs.append((i, [], [], []))
            continue
        ia, ea, ib, eb = got
        groups, a, b = [], 0, 0
        for end in sorted(set(ea) & set(eb)):
            x, y = ea.index(end, a) + 1, eb.index(end, b) + 1
            groups.append((ia[a:x], ib[b:y]))
            a, b = x, y
        docs.append((i, ia, ib, groups))
    count = Counter((g[0][-1], g[1][-1]) for d in docs for g in d[3])
    high = {}
    for (_, y), n in count.items():
        high[y] = max(high.get(y, 0), n)
    out = []
    for i, ia, ib, groups in docs:
        links = [(g[0][-1], g[1][-1]) for g in groups]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, len(ia), len(ib), len(groups), len(links), sum(count[p] == high[p[1]] for p in links), sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out


def more_rows():
    rng = random.Random(2)
    bits = ["alpha", "don't", "x1", "naïve", "中文字", "\n", "\n  ", "  ", "<s>", "</s>", "<0x0A>", "<|endoftext|>", "é", "é", " ", "😀", "!?", "...", "\t", "ﬁ"]
    rows = [(500 + i, "".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randrange(60)))) for i in range(60)]
    return [*rows, (600, "with ▁ it"), (601, "▁"), (602, " "), (603, "  "), (604, "x "), (605, "\n"), (606, "a\x00b"), (607, "word " * 2000), (608, "long▁" + "word " * 400), (609, "zz" * 900), (610, "naïve.\n中文 " * 300)]


@pytest.mark.parametrize("size", [fa.RANGE, 40, 7])
def test_alignment_matches_brute_force(spark, libraries, docs, rows, size, monkeypatch):
    monkeypatch.setattr(fa, "FAN", 3)
    extra = more_rows()
    mine = [r for r in rows if len(r[1] or "") < 8000] + extra if size == 7 else rows + extra
    table = spark.createDataFrame(spark.sparkContext.parallelize([(i, t, "en", 5, 5, b"x") for i, t in mine], 4), "doc_id long, text string, lang string, key long, part long, prefix binary")
    got = [tuple(r) for r in fa.align(table, BYTE_BPE, PIECE_BPE, size).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute(libraries, mine)))


def test_alignment_of_no_rows(spark, no_docs):
    assert fa.align(no_docs, BYTE_BPE, PIECE_BPE).count() == 0
    blank = spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string")
    assert sorted(map(repr, map(tuple, fa.align(blank, BYTE_BPE, PIECE_BPE).collect()))) == sorted(map(repr, [(1, 0, 0, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, 0, 0, "")]))


TOKENS = st.lists(st.integers(1, 3), min_size=1, max_size=30)


def stream(sizes):
    return np.arange(len(sizes), dtype=np.uint32), np.cumsum(sizes).astype(np.int64)


@settings(max_examples=200, deadline=None)
@given(TOKENS, TOKENS, st.data())
def test_fragments_compose_in_any_tree(x, y, data):
    (a, ae), (b, be) = stream(x), stream(y)
    whole = fa.Open(a, ae, b, be)
    want, closed = fa.fragment(whole)
    parts = data.draw(st.integers(1, 5))
    cut = lambda n: [0, *sorted(data.draw(st.lists(st.integers(0, n), min_size=parts - 1, max_size=parts - 1))), n]
    # The ranges of A and of B are cut apart from each other.
    i, j = cut(len(a)), cut(len(b))
    pieces = [fa.fragment(fa.Open(a[p:q], ae[p:q], b[r:s], be[r:s])) for p, q, r, s in zip(i[:-1], i[1:], j[:-1], j[1:], strict=True)]
    groups = [c for _, c in pieces if len(c.a)]
    while len(pieces) > 1:
        k = data.draw(st.integers(0, len(pieces) - 2))
        one, seam = fa.compose(pieces[k][0], pieces[k + 1][0])
        groups += [seam] if len(seam.a) else []
        pieces[k:k + 2] = [(one, fa.NOTHING)]
    got = pieces[0][0]
    assert got.cut == want.cut and all((p == q).all() and len(p) == len(q) for p, q in zip(got.prefix + got.suffix, want.prefix + want.suffix, strict=True))
    ids = sorted(int(v) for g in groups for v in g.a_end)
    assert ids == sorted(int(v) for v in closed.a_end)
    assert sorted(int(v) for g in groups for v in g.b_end) == sorted(int(v) for v in closed.b_end)
