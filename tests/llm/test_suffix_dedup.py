"""Repeated passages against a table of all strings."""

import hashlib
import random

import numpy as np
import pytest

from ledgerlake.llm import suffix_dedup as sd


def brute(docs, length, keep_first):
    texts = [(t or "").encode() for _, t in docs]
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is not None, docs[i][0] or 0))
    seen = {}
    for i in order:
        for p in range(len(texts[i]) - length + 1):
            seen.setdefault(texts[i][p:p + length], []).append((i, p))
    out = []
    for i, (name, _) in enumerate(docs):
        mark = bytearray(len(texts[i]))
        for p in range(len(texts[i]) - length + 1):
            places = seen[texts[i][p:p + length]]
            if places[0] != (i, p) if keep_first else len(places) > 1:
                mark[p:p + length] = b"\1" * length
        kept = bytes(x for x, m in zip(texts[i], mark) if not m)
        spans = [k for k in range(len(mark)) if mark[k] and (not k or not mark[k - 1])]
        out.append((name, len(mark), sum(mark), len(spans), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def case(seed):
    rng = random.Random(seed)
    words = ["ab", "é", "the", "日本", " x", "..", "QQ", "qq"] + [f"w{i}" for i in range(200)]

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))
    passages = [text(60) for _ in range(8)]
    docs = [(100, None), (101, ""), (102, "a" * 300), (103, "ab" * 200)]
    for i in range(40):
        parts = [text(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 4)):
            p, a = rng.choice(passages), rng.randint(0, 60)
            parts += [p[a:a + rng.randint(10, 400)], text(rng.randint(0, 10))]
        docs.append((i, "".join(parts)))
    return docs + [(200 + i, docs[10][1]) for i in range(5)]


@pytest.mark.parametrize("length, keep_first, most", [(40, False, 4096), (40, True, 3), (120, False, 3)])
def test_equals_brute_force(spark, length, keep_first, most):
    """Also with groups so small that their grams are split."""
    docs = case(length)
    d = spark.createDataFrame([(i, t, 7) for i, t in docs], "doc_id long, text string, k1 int").repartition(3)
    got = sd.remove_repeats(d, length=length, gram=8, keep_first=keep_first, group_most=most)
    assert sorted((tuple(r)[:5] for r in got.collect()), key=str) == brute(docs, length, keep_first)


def test_copies_without_id_and_rows_that_repeat_one(spark):
    text = "".join(chr(97 + i * i % 23) + str(i) for i in range(300))
    docs = [(None, text), (None, text), (5, text[100:700]), (5, "short"), (6, "z" + text[:450])]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.n_bytes): r for r in sd.remove_repeats(d, length=400, keep_first=False, kept=True).collect()}
    assert len(got) == 4 and all(r.n_bytes - r.n_removed == len(r.kept) for r in got.values())
    assert got[None, len(text)].n_removed == len(text) and got[5, 5].kept == b"short" and got[6, 451].kept == b"z"
    first = {(r.doc_id, r.n_bytes): r.n_removed for r in sd.remove_repeats(d, length=400).collect()}
    assert first == {(None, len(text)): 0, (5, 600): 600, (5, 5): 0, (6, 451): 450}


def test_very_long_text_and_empty_table(spark):
    rng = random.Random(1)
    text = " ".join(str(rng.randrange(10 ** 6)) for _ in range(1_500_000))  # over 10 MB, several blocks
    docs = [(1, text), (2, text[5_000_000:5_000_900]), (3, "x" + text[-400:])]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r for r in sd.remove_repeats(d, length=400, keep_first=False).collect()}
    n = len(text)
    assert [(s.a, s.b) for s in got[1].spans] == [(5_000_000, 5_000_900), (n - 400, n)]
    assert [(s.a, s.b) for s in got[2].spans] == [(0, 900)] and [(s.a, s.b) for s in got[3].spans] == [(1, 401)]
    assert sd.remove_repeats(d.limit(0)).count() == 0


def test_nearest_and_suffix_array():
    rng = np.random.default_rng(3)
    p = rng.permutation(200)
    for smaller in (True, False):
        for before in (True, False):
            got = sd.nearest(p, smaller, before)
            for i in range(200):
                side = range(i - 1, -1, -1) if before else range(i + 1, 200)
                want = next((j for j in side if (p[j] < p[i] if smaller else p[j] > p[i])), -1)
                assert got[i] == want
    text = rng.integers(1, 3, 300).astype(np.uint16)
    order, rank = sd.suffix_ranks(text, 300)
    assert order.tolist() == sorted(range(300), key=lambda i: text[i:].tolist()) and len(set(rank.tolist())) == 300
