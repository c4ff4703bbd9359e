"""Building blocks against plain Python."""

import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from groundstop.llm import chat_format, count_rtree, curve_pack, fuse_dedup, pfor_ids, suffix_merge, tokens, trie_lm

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXT = st.text(st.sampled_from(list("abzAé ß中\u00a0\u3000\u2028 \n\t\r\x1f.,;!?'\\[]<>/sINT0129")), max_size=60)
#: Texts with special strings, contractions, signs and letters of two bytes.
WORDY = st.lists(st.sampled_from([*"abzAéß÷×²中\u00a0\u3000\u0301 \n\t.,;!?'&<>/s0129", " ", "'s", "'ll", "<|endoftext|>", "<|endof", "text|>", "x <|endoftext|> y", "&&&", "12a"]), max_size=40).map("".join)


def columns(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(TEXT, WORDY), max_size=8))
def test_pieces_encode_like_whole_texts(plain, texts):
    ids, counts = tokens.encoder(PATH).encode(*columns(texts))
    expected = [plain.encode(x, add_special_tokens=False).ids for x in texts]
    assert counts.tolist() == [len(e) for e in expected]
    assert ids.tolist() == [i for e in expected for i in e]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(TEXT, WORDY), max_size=8))
def test_special_strings_may_be_ordinary_text(texts):
    split = Tokenizer.from_file(PATH)
    split.encode_special_tokens = True
    ids, counts = tokens.Encoder(PATH, split_specials=True).encode(*columns(texts))
    expected = [split.encode(x, add_special_tokens=False).ids for x in texts]
    assert counts.tolist() == [len(e) for e in expected] and ids.tolist() == [i for e in expected for i in e]


def test_encoder_forgets_without_changing_ids(plain, monkeypatch):
    monkeypatch.setattr(tokens, "MAX_PIECES", 60)
    monkeypatch.setattr(tokens, "span_hashes", lambda data, a, b: np.array([int(data[x]) % 7 for x in a.tolist()], np.uint64))  # most pieces collide
    t = tokens.Encoder(PATH)
    rng = random.Random(3)
    for _ in range(60):
        texts = [" ".join(rng.choice(["alpha", "beta", "gamma", "x%d" % rng.randrange(400), "é1", "don't"]) for _ in range(12)) for _ in range(3)]
        ids, counts = t.encode(*columns(texts))
        assert ids.tolist() == [i for x in texts for i in plain.encode(x, add_special_tokens=False).ids]
        assert t.count <= 60 + 40


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=900), st.sampled_from([0.5, 0.9, 1.0]))
def test_pfor_round_trip(ids, percentile):
    ids = np.array(ids, np.uint32)
    f = pfor_ids.File(pfor_ids.encode_file(ids, np.array([len(ids)]), np.array([5]), np.array([True]), percentile))
    assert (f.ids() == ids).all() and len(f.ids()) == len(ids)
    a, b = len(ids) // 3, 2 * len(ids) // 3
    assert (f.ids(a, b) == ids[a:b]).all()


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=6))
def test_escaping_round_trip(texts):
    data, off = columns(texts)
    safe = chat_format.escape(data, off)
    for c in chat_format.CONTROLS:
        assert len(chat_format.find(safe[0], c, safe[1])) == 0
    back = chat_format.unescape(*safe)
    assert (back[0] == data).all() and (back[1] == off).all()


@settings(max_examples=40, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=400), st.integers(0, 2**32))
def test_fuse_filter_holds_all_keys(keys, seed):
    keys = np.array(sorted(keys), np.uint64)
    f = fuse_dedup.FuseFilter.build(keys)
    assert f.may_hold(keys).all()
    others = np.random.default_rng(seed).integers(0, 2**64, 4000, dtype=np.uint64)
    assert f.may_hold(others).mean() < 0.05


def test_fuse_filter_of_many_keys():
    keys = np.random.default_rng(1).integers(0, 2**64, 60_000, dtype=np.uint64)
    f = fuse_dedup.FuseFilter.build(keys)
    assert f.may_hold(keys).all() and len(f.cells) < 1.25 * len(keys)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 1000), st.integers(0, 2**64 - 1)), min_size=1, max_size=300), st.lists(st.integers(0, 2**64 - 1), max_size=50))
def test_elias_fano(values, keys):
    values = np.sort(np.array(values, np.uint64))
    ef = trie_lm.EliasFano(*trie_lm.EliasFano.parts(values))
    assert (ef.get(np.arange(len(values))) == values).all()
    keys = np.concatenate([np.array(keys, np.uint64), values])
    assert (ef.successor(keys) == np.searchsorted(values, keys)).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.binary(min_size=3, max_size=3).map(lambda b: bytes(x % 3 for x in b) * 25 + b"\0"), max_size=20), min_size=1, max_size=7))
def test_loser_tree_merges_front_coded_runs(runs):
    coded, flat = [], []
    for i, run in enumerate(runs):
        recs = np.zeros((len(run), suffix_merge.PADDED), np.uint8)
        for j, r in enumerate(sorted(run)):
            recs[j, :len(r)] = np.frombuffer(r, np.uint8)
            flat.append((recs[j].tobytes(), i, j))
        common, rest = suffix_merge.front_code(recs)
        assert (suffix_merge.front_decode(common, rest) == recs).all()
        coded.append((recs, common))
    owner, place, prefix = suffix_merge.merge([r.view(">u8").tolist() for r, _ in coded], [c.tolist() for _, c in coded])
    got = [coded[i][0][j].tobytes() for i, j in zip(owner, place, strict=True)]
    assert got == sorted(f[0] for f in flat) and sorted(zip(owner, place, strict=True)) == sorted(f[1:] for f in flat)
    for a, b, p in zip(got, got[1:], prefix[1:], strict=False):
        assert p == next((k for k in range(len(a)) if a[k] != b[k]), suffix_merge.PADDED)


def test_hilbert_neighbours_touch():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), axis=-1).reshape(-1, 3)
    key = curve_pack.hilbert_key(grid, 3)
    assert sorted(key) == list(range(512))
    walk = grid[np.argsort(key)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_tree_search_finds_every_component():
    rng = random.Random(3)
    sets = []
    for _ in range(12):
        base = rng.sample(range(10**6), rng.randint(3, 60))
        for _ in range(rng.randint(1, 30)):
            s = set(base)
            for _ in range(rng.randint(0, 1 + len(s) // 6)):
                s.discard(rng.choice(sorted(s)))
                s.add(rng.randrange(10**6))
            sets.append(np.array(sorted(s), np.uint64))

    def parts(links):
        parent = list(range(len(sets)))

        def top(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in links:
            parent[top(a)] = top(b)
        return [min(j for j in range(len(sets)) if top(j) == top(i)) for i in range(len(sets))]

    every = [(i, j) for i in range(len(sets)) for j in range(i) if 7 * len(np.intersect1d(sets[i], sets[j])) >= 3 * (len(sets[i]) + len(sets[j]))]
    links = count_rtree.spanning_links(sets, np.arange(len(sets)))
    assert set(map(frozenset, links)) <= set(map(frozenset, every))
    assert parts(links) == parts(every)
    label = np.array(parts(every[:len(every) // 2]))
    assert parts([*every[:len(every) // 2], *count_rtree.spanning_links(sets, label)]) == parts(every)
