"""Array and tree kernels against plain definitions, on small alphabets full of repeats and ties."""

import base64
import random

import numpy as np
import public_tokenizers as P
import pytest

from txnguard.llm import ann, rolling, sharding, simhash, substrings, suffix_dedup
from txnguard.llm.bpe import EditableEncoding, PrefixBPE


def texts_of(rng):
    texts = [bytes(rng.integers(97, 97 + rng.integers(1, 4), rng.integers(0, 60)).astype(np.uint8))
             for _ in range(rng.integers(1, 6))]
    return np.cumsum([0] + [len(t) for t in texts]), np.frombuffer(b"".join(texts), np.uint8)


def test_equal_windows_have_equal_owners_and_subtrees_find_all_repeats():
    rng, window, gram = np.random.default_rng(1), 10, 4
    for _ in range(150):
        offsets, data = texts_of(rng)
        if len(data) < window:
            continue
        sums, at = rolling.prefix_sums(rolling.BYTE_VALUES[data]), np.arange(len(data) - gram + 1)
        owner, first, last = rolling.anchors(rolling.range_hash(sums, at, at + gram), offsets, window, gram)
        owned = {p: a for a, b, c in zip(owner, first, last, strict=True) for p in range(b, c + 1)}
        want = [i for t in range(len(offsets) - 1) for i in range(offsets[t], offsets[t + 1] - window + 1)]
        assert sorted(owned) == want
        places = {}
        for p, a in owned.items():
            places.setdefault(bytes(data[p:p + window]), set()).add(a - p)
        assert all(len(v) == 1 for v in places.values())
        for depth in (1, 3, 7, 10):
            node = substrings.deep_nodes(data.astype(np.uint64), np.array(want, np.int64), depth)
            classes, back = {}, {}
            for i, p in enumerate(want):
                classes.setdefault(bytes(data[p:p + depth]), []).append(i)
            for key, members in classes.items():
                assert len(members) == 1 or len({node[i] for i in members}) == 1 and node[members[0]] >= 0
                for i in members:
                    assert node[i] < 0 or back.setdefault(node[i], key) == key


def test_loser_tree_merges_front_coded_runs():
    rng = np.random.default_rng(2)
    for _ in range(200):
        runs = [sorted(bytes(rng.integers(97, 99, rng.integers(0, 9)).astype(np.uint8))
                       for _ in range(rng.integers(1, 9))) for _ in range(rng.integers(1, 8))]
        merged = [(runs[w][i], shared) for w, i, shared in
                  suffix_dedup.LoserTree([suffix_dedup.front_coded(r) for r in runs])]
        assert [k for k, _ in merged] == sorted(k for r in runs for k in r)
        for (a, _), (b, shared) in zip(merged, merged[1:], strict=False):
            assert suffix_dedup.common_prefix(a, b, 0) == shared


@pytest.mark.parametrize("low_bits", [64, 24])
def test_stars_connect_all_near_fingerprints(low_bits, monkeypatch):
    monkeypatch.setattr(simhash, "MOST_VARIANTS", 3000)  # forces the cut by further bits
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(4)]
    prints = {b ^ sum(1 << i for i in rng.sample(range(low_bits), rng.randint(0, 3))) for b in base for _ in range(6)}
    prints = np.array(sorted(prints), np.uint64)
    a, b = simhash._stars(prints, np.full(len(prints), 2), 64)
    links = set(zip(np.concatenate(a).tolist(), np.concatenate(b).tolist(), strict=True)) if a else set()
    group = {p: p for p in prints.tolist()}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for x, y in links:
        assert (x ^ y).bit_count() <= 4
        group[find(y)] = find(x)
    for x in prints.tolist():
        for y in prints.tolist():
            if (x ^ y).bit_count() <= 4:
                assert find(x) == find(y)


def test_probe_order_is_by_cost_and_starts_at_home():
    place = np.array([0.1, 0.6, 0.45])
    deltas = ann.probe_order(place, 27)
    assert len({tuple(d) for d in deltas}) == len(deltas) == 27 and not deltas[0].any()
    cost = [sum(p ** 2 if s < 0 else (1 - p) ** 2 for p, s in zip(place, d, strict=True) if s) for d in deltas]
    assert cost == sorted(cost)


def test_best_fit_decreasing_by_classes_equals_one_by_one():
    rng = random.Random(4)
    for _ in range(60):
        sizes = [rng.randint(1, 40) for _ in range(rng.randint(1, 60))]
        runs, used = sharding.pack([(s, sizes.count(s)) for s in set(sizes)], capacity=50)
        bins = []
        for s in sorted(sizes, reverse=True):
            fit = [i for i, r in enumerate(bins) if r >= s]
            if not fit:
                bins.append(50)
                fit = [len(bins) - 1]
            bins[min(fit, key=lambda i: (bins[i], i))] -= s
        filled = {}
        for size, shard, first, last in runs:
            filled[shard] = filled.get(shard, 0) + size * (last - first + 1)
        assert sorted(filled.values()) == sorted(50 - r for r in bins) and used == len(bins)


@pytest.fixture(scope="module")
def bpe():
    return PrefixBPE(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


def test_prefix_table_equals_merging_and_survives_edits(bpe):
    rng = random.Random(5)
    for _ in range(200):
        data = bytes(rng.choice(b"abcdet hinrso\xc3\xa9") for _ in range(rng.randint(1, 40)))
        e = EditableEncoding(bpe, data)
        assert e.ids() == bpe.merged(data)
        assert e.append(b"tion").ids() == bpe.merged(data + b"tion")
        i = rng.randint(0, len(e.data))
        e.replace(i, min(len(e.data), i + rng.randint(0, 4)), b"xy")
        assert e.ids() == bpe.merged(e.data)
    e = EditableEncoding(bpe, b"the cat sat on the mat and looked around. " * 50)
    assert e.replace(100, 101, b"q") < 300 and e.ids() == bpe.merged(e.data)


def test_encoding_equals_the_library(bpe):
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(6)
    alphabet = "ab éñ漢\U0001f600'st \n\t  1,.!\xa0　"
    for _ in range(300):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        assert bpe.encode(text) == lib.encode_ordinary(text)
        assert bpe.decode(bpe.encode(text)) == text.encode()


def test_latin_words_meet_the_library_directly():
    """Every precomposed Latin letter, both cases, takes the direct path to the ids that the library gives."""
    import numpy as np
    from tokenizers import Tokenizer

    from txnguard.llm import token_files
    lib = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    cache = token_files._cache(P.path("word_bpe_49k.json"))[0]
    assert cache.encode.__name__ == "of_word"
    for code in range(0x21, 0x250):
        for word in (chr(code), f"a{chr(code)}b1{chr(code)}"):
            if not word.isspace():
                ids = np.frombuffer(cache.get([word])[0], "<u4").tolist()
                assert ids == lib.encode(word, add_special_tokens=False).ids, word
