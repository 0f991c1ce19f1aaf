"""The suffix tree against a plain one in dictionaries, with and without caches."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from glyphmill.llm import suffixtree


def plain(texts):
    """log10 scores by id, and the states by length, of the whole tree without any bound."""
    seq = {i: [*t.lower().split(), None] for i, t in texts}
    train = [s for i, s in seq.items() if zlib.crc32(str(i).encode()) % 5 != 1]
    root = Counter(w for s in train for w in s)
    n, v = root.total(), len(root)
    base = lambda w: (root[w] + 0.5) / (n + 0.5 * (v + 1))
    cost, states = math.log(n), {}

    def p(context, w):
        if not context:
            return base(w)
        share, left = states[context]
        return share.get(w, 0.0) + left * p(context[1:], w)

    depth, sizes = 1, []
    while True:
        counts = defaultdict(Counter)
        for s in train:
            for k in range(depth, len(s)):
                counts[tuple(s[k - depth : k])][s[k]] += 1
        new = {}
        for c, nxt in counts.items():
            total = nxt.total()
            if total < 8 or (depth > 1 and c[1:] not in states):
                continue
            below = {w: p(c[1:], w) for w, k in nxt.items() if k > 1}
            share = {w: (nxt[w] - 0.75) / total for w in below if nxt[w] * math.log((nxt[w] - 0.75) / total / below[w]) >= cost}
            if not share:
                continue
            left = 1 - sum(share.values())
            rest = total - sum(nxt[w] for w in share)
            gain = sum(nxt[w] * math.log(share[w] / below[w]) for w in share)
            if gain + rest * math.log(max(left, 1e-12) / max(1 - sum(below[w] for w in share), 1e-12)) >= cost:
                new[c] = (share, left)
        if not new:
            break
        states.update(new)
        sizes.append(len(new))
        depth += 1
    out = {}
    for i, s in seq.items():
        total = 0.0
        for k, w in enumerate(s):
            c = ()
            while len(c) < k and tuple(s[k - len(c) - 1 : k]) in states:
                c = tuple(s[k - len(c) - 1 : k])
            total += math.log10(p(c, w))
        out[i] = total
    return out, sizes


@pytest.fixture(scope="module")
def texts():
    """A word depends on one, two or three words before it; rare words are seen some dozens of times among thousands of others."""
    r = random.Random(3)
    many = [f"w{i}" for i in range(60)]
    out = []
    for i in range(300):
        w = ["a", "b", "c"]
        while len(w) < 80:
            k = r.choice([1, 2, 3, 3])
            w.append("abcdef"[zlib.crc32(" ".join(w[-k:]).encode()) % 6] if r.random() < 0.9 else r.choice(many))
            if r.random() < 0.01:
                w += ["rare", "friend"]
        out.append((i, " ".join(w)))
    return out


@pytest.mark.parametrize(("cache", "bits", "chars"), [(500_000, 27, 12_000_000), (100, 27, 12_000_000), (5, 17, 4000), (0, 16, 1)])
def test_scores_equal_the_whole_tree(spark, texts, monkeypatch, cache, bits, chars):
    monkeypatch.setattr(suffixtree, "CACHE", cache)
    monkeypatch.setattr(suffixtree, "FILTER_BITS", bits)
    monkeypatch.setattr(suffixtree, "GROUP_CHARS", chars)
    monkeypatch.setattr(suffixtree, "PART_PLACES", 10 * chars)
    expected, sizes = plain(texts)
    assert len(sizes) >= 3
    out = suffixtree.score(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert len(out) == len(texts)
    for r in out:
        assert math.isclose(r["score"], expected[r["doc_id"]], rel_tol=1e-9)


def test_words_of_equal_count_all_count(spark, monkeypatch):
    """No word, pair or state is lost where more of them tie than the cache holds."""
    monkeypatch.setattr(suffixtree, "CACHE", 50)
    texts = [(20 * i + k, f"x{i} y{i} z{i}") for i in range(200) for k in range(20)]
    expected, sizes = plain(texts)
    assert sizes[0] >= 590
    for r in suffixtree.score(spark.createDataFrame(texts, "doc_id long, text string")).collect():
        assert math.isclose(r["score"], expected[r["doc_id"]], rel_tol=1e-9)


def test_odd_texts(spark):
    long = " ".join(f"w{i % 700}" for i in range(200_000))
    rows = [(1, long, 5), (2, None, 5), (None, " \n\t a  B\x0b", 5), (2, "", 5), (2, "", 5), (3, "\x1ca b\u2003c É", 5)]
    out = suffixtree.score(spark.createDataFrame(rows, "doc_id long, text string, score long")).collect()
    assert sorted(((r["doc_id"] or 0, r["n_tokens"]) for r in out)) == [(0, 3), (1, 200_001), (2, 1), (2, 1), (2, 1), (3, 4)]
    assert all(r["score"] <= 0 and math.isfinite(r["score"]) for r in out)


def test_copied_passages_add_no_longer_contexts(spark, monkeypatch):
    """Beyond a few words, what has no state as suffix can't become a state, however often it occurs, and isn't gathered."""
    lost, stored = [], suffixtree.stored

    def noted(df):
        out = stored(df)
        if "below" in out.columns:
            lost.append(out.where("below is null").count())
        return out

    monkeypatch.setattr(suffixtree, "stored", noted)
    r = random.Random(5)
    words = [f"w{i}" for i in range(12)]
    passage = " ".join(r.choice(words) for _ in range(400))
    texts = [(i, passage if i % 4 == 0 else " ".join(r.choice(words) for _ in range(200))) for i in range(80)]
    texts += [(100 + i, "a b c d " * 20) for i in range(10)]
    expected, sizes = plain(texts)
    for x in suffixtree.score(spark.createDataFrame(texts, "doc_id long, text string")).collect():
        assert math.isclose(x["score"], expected[x["doc_id"]], rel_tol=1e-9)
    assert len(sizes) > 3
    assert len(lost) > 3 and not any(lost[2:])


def group_of(texts):
    import pyarrow as pa

    ids, flags = range(len(texts)), [True] * len(texts)
    row = suffixtree._pack(7, [pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string()), "train": flags})])
    return next(suffixtree._each([row]))


def test_words_are_hashed_together(monkeypatch):
    """Only long words are hashed one by one; a hash follows a word's bytes alone, and no two of these words share one."""
    alone, word_hash = [], suffixtree.word_hash
    monkeypatch.setattr(suffixtree, "word_hash", lambda w: alone.append(w) or word_hash(w))
    words = [c * n for c in ("a", "b", "\x00", "é") for n in range(1, 80)] + [f"w{i}" for i in range(20_000)] + [f"common-prefix-{i}-x" for i in range(20_000)]
    g = group_of([" ".join(words), None, "", "  \t", f" {' '.join(reversed(words))}\n"])
    assert {*map(bytes, alone)} == {w.encode() for w in words if len(w.encode()) > 64}
    assert [*g.sizes] == [len(words) + 1, 1, 1, 1, len(words) + 1]
    first, last = g.hashes[: len(words)], g.hashes[-len(words) - 1 : -1]
    assert len({*first.tolist(), suffixtree.END}) == len(words) + 1
    assert (first == last[::-1]).all() and (g.hashes[len(words) : len(words) + 4] == suffixtree.END).all()
    assert (group_of([" ".join(words[5:9])]).hashes[:-1] == first[5:9]).all()


def test_a_group_asks_for_each_key_once_in_order():
    """The second walk finds the answers by this order."""
    g = group_of([" ".join(f"w{i * i % 997}" for i in range(5000)), "a b a b"])
    nothing = np.zeros(0, np.int64)
    keys = suffixtree.Walk(g, {"keys": nothing, "values": np.zeros(0), "known": suffixtree.Filter(np.full(1 << 10, ~np.uint64(0)))}, 3).questions()
    assert (np.diff(keys.astype(object)) > 0).all()
    assert {*(g.words ^ suffixtree.WORD).tolist(), *next(g.contexts(1))[g.behind(1)].tolist()} <= {*keys.tolist()}


def test_values_and_filter():
    r = np.random.default_rng(2)
    keys = r.integers(-(2**63), 2**63, 50_000)
    values, known = suffixtree.Values(keys[:40_000], np.arange(40_000.0)), suffixtree.Filter(np.zeros(1 << 14, np.uint64))
    at, bits = known.places(keys[:40_000], 20)
    np.bitwise_or.at(known.words, at, bits)
    assert (values.get(keys)[:40_000] == np.arange(40_000)).all() and np.isnan(values.get(keys)[40_000:]).all()
    assert known.has(keys[:40_000]).all() and known.has(keys[40_000:]).mean() < 0.01


def test_training_rows_have_groups_of_their_own(spark):
    docs = spark.createDataFrame([(i, f"a b {i}") for i in range(50)] + [(None, None)], "doc_id long, text string")
    rows = suffixtree.groups_of(docs).collect()
    held = {i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 1}
    assert {i for r in rows if not r["train"] for i in r["ids"]} == held
    assert sorted(str(i) for r in rows if r["train"] is True for i in r["ids"]) == sorted(map(str, {*range(50), None} - held))
