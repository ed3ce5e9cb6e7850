"""N-gram Jaccard join: the trie against all pairs, components against brute force."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlake.llm import ngram_join as nj

WORDS = [f"w{i}" for i in range(400)]


def shingles(text, k):
    if not text:
        return frozenset()
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    w = [x for x in low.split(" ") if x]
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute(rows, k, num, den):
    sets = [(i, shingles(t, k)) for i, t in rows]
    up = {i: i for i, _ in rows}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            common = len(x & y)
            if x and y and den * common >= num * (len(x) + len(y) - common):
                p, q = sorted((root(i), root(j)))
                up[q] = p
    return {(i, len(x), root(i)) for i, x in sets}


def corpus(seed, copies):
    rng = random.Random(seed)
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, "One"), (4, "one"), (5, "a b"), (6, "A  B"), (7, "a b c"), (8, "x " * 500)]
    passage = [rng.choice(WORDS) for _ in range(30)]
    for _ in range(12):
        base = [rng.choice(WORDS) for _ in range(rng.choice([5, 20, 60, 150]))]
        if rng.random() < 0.5:
            base = base[:10] + passage + base[10:]
        for _ in range(rng.randint(1, 6)):
            w = list(base)
            for _ in range(rng.randint(0, 1 + len(w) // 25)):
                w[rng.randrange(len(w))] = rng.choice(WORDS)
            rows.append((len(rows), rng.choice([" ", "\n"]).join(w)))
    hot = [rng.choice(WORDS) for _ in range(80)]
    for _ in range(copies):  # a large group of near copies and of exact ones
        w = list(hot)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = rng.choice(WORDS)
        rows.append((len(rows), " ".join(w)))
    rows += [(len(rows) + i, " ".join(hot)) for i in range(40)]
    return rows


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from([(85, 100), (80, 100), (1, 2)]))
def test_trie_finds_the_groups_of_all_pairs(seed, threshold):
    num, den = threshold
    rng = random.Random(seed)
    base = [rng.sample(range(80), rng.randint(1, 40)) for _ in range(3)]
    sets = set()
    for _ in range(rng.randint(2, 14)):
        s = set(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            s ^= {rng.randrange(80)}
        if s:
            sets.add(tuple(sorted(s)))
    sets = [np.array(s, dtype=np.uint64) for s in sets]
    linked = [(i, j) for i in range(len(sets)) for j in range(i)
              if den * (c := len(np.intersect1d(sets[i], sets[j]))) >= num * (len(sets[i]) + len(sets[j]) - c)]
    found = nj.trie_links(sets, range(len(sets)), num, den)
    assert {tuple(sorted(p)) for p in found} <= {tuple(sorted(p)) for p in linked}
    want, got = nj._Groups(range(len(sets))), nj._Groups(range(len(sets)))
    for i, j in linked:
        want.up[want.root(i)] = want.root(j)
    for i, j in found:
        got.up[got.root(i)] = got.root(j)
    n = len(sets)
    assert all((want.root(i) == want.root(j)) == (got.root(i) == got.root(j)) for i in range(n) for j in range(n))
    heads = [s[:len(s) - nj._needed(len(s), num, den) + 1] for s in sets]
    assert {i for p in linked for i in p} <= set(nj.with_partner(heads, [len(s) for s in sets], num, den))


@pytest.mark.parametrize("k,threshold,chunk", [(4, (85, 100), 256), (5, (80, 100), 8)])
def test_components_equal_brute_force(spark, monkeypatch, k, threshold, chunk):
    """With chunks of 8 the hot group is cut many times."""
    monkeypatch.setattr(nj, "CHUNK", chunk)
    rows = corpus(chunk, 120)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, rep string")
    got = {tuple(r) for r in nj.ngram_components(docs.repartition(5), k, threshold).collect()}
    assert got == brute(rows, k, *threshold)


@pytest.mark.parametrize("seed", [1, 2])
def test_shared_passages_below_the_threshold(spark, monkeypatch, seed):
    """Pages with one long passage and some text of their own: short ones link
    with the centre of the passage's block, long ones only with their copies,
    and some in between only with a short page of another chunk."""
    monkeypatch.setattr(nj, "CHUNK", 8)
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(50)]
    pages = []
    for i in range(150):
        own = [f"o{i}x{j}" for j in range(rng.choice([0, 1, 2, 3, 4, 5, 6, 8, 12, 20]))]
        pages.append(own + passage[rng.choice([0, 0, 0, 4, 8]):])
        if rng.random() < 0.2:
            pages.append(pages[-1] + [f"q{i}"])
    rng.shuffle(pages)
    rows = [(i + 1, " ".join(p)) for i, p in enumerate(pages)] + [(0, " ".join(passage[-6:]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {tuple(r) for r in nj.ngram_components(docs, 4, (85, 100)).collect()}
    assert got == brute(rows, 4, 85, 100)


def test_keep_one_keeps_columns_and_one_of_each_class(spark):
    docs = spark.createDataFrame([(3, "a b c d e f", 1), (1, "A b c d e f", 2), (2, "other words entirely here now", 3), (None, "a b c d e f", 4),
                                  (5, None, 5)], "doc_id long, text string, gone int")
    kept = nj.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.gone) for r in kept.collect()) == [(1, 2), (2, 3), (5, 5)]


def _near(n):
    """n texts, each linked to the one before and after it only."""
    words = [f"v{i}" for i in range(60 + n * 4)]
    return [" ".join(words[i * 4:i * 4 + 60]) for i in range(n)]


def test_rows_without_an_id_carry_links(spark):
    a, b, c = _near(3)
    rows = [(1, a), (None, b), (2, c), (None, "nobody else"), (None, "nobody else"), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = nj.ngram_components(docs, 4, (85, 100)).collect()
    assert sorted(((r.doc_id, r.component_id) for r in got), key=str) == sorted(
        [(1, 1), (None, 1), (2, 1), (None, None), (None, None), (7, 7)], key=str)
    kept = nj.keep_one(docs, 4, (85, 100)).collect()
    assert sorted((tuple(r) for r in kept), key=str) == sorted([(1, a), (None, "nobody else"), (7, None)], key=str)


def test_rows_that_repeat_an_id_are_documents_of_their_own(spark):
    a, b, c, d = _near(4)
    rows = [(5, a), (5, "quite other words here"), (9, "quite other words here"), (3, d), (5, c), (5, c), (None, b), (None, b)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = nj.ngram_components(docs, 4, (85, 100)).collect()
    assert sorted(((r.doc_id, r.component_id) for r in got), key=str) == sorted(
        [(5, 3), (5, 5), (9, 5), (3, 3), (5, 3), (5, 3), (None, 3), (None, 3)], key=str)
    kept = nj.keep_one(docs, 4, (85, 100)).collect()
    assert sorted(tuple(r) for r in kept) == [(3, d), (5, "quite other words here")]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert nj.ngram_components(docs).count() == 0
