"""Importance resampling against plain Python."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from ledgerlake.llm import importance as im

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, target, longest, buckets, share, least, seed):
    def found(text):
        w = words(text)
        return [zlib.crc32(" ".join(w[i:i + k]).encode()) % buckets for k in range(1, longest + 1) for i in range(len(w) - k + 1)]
    s, t = np.zeros(buckets), np.zeros(buckets)
    for total, texts in ((s, [x for _, x in docs]), (t, target)):
        for x in texts:
            for b in found(x):
                total[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.sum() + buckets) / ((s[b] + 1) * (t.sum() + buckets)))) for b in range(buckets)]
    rows = []
    for name, text in docs:
        f = found(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if name is None else name}".encode()).hexdigest()[:8], 16)
        rows.append([name, len(words(text)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))])
    may = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[2], r[3]))
    drawn = [(*r, i + 1) for i, r in enumerate(may[:share[0] * len(may) // share[1]])]
    rest = may[len(drawn):] + [r for r in rows if r[1] < least]
    return sorted(drawn + [(*r, None) for r in rest], key=str)


def case():
    rng = random.Random(5)
    vocabulary = ["The", "of", "É", "日本語", "x" * 70, "y" * 200] + [f"w{i}" for i in range(300)]

    def text(n):
        return rng.choice([" ", "-", ", "]).join(vocabulary[min(int(rng.expovariate(0.02)), 305)] for _ in range(n))
    docs = [(0, None), (1, ""), (2, "...")] + [(i, text(rng.choice([5, 19, 20, 60, 300]))) for i in range(3, 160)]
    return docs + [(7, docs[7][1]), (None, text(30)), (None, text(50)), (9, docs[12][1])], [text(30) for _ in range(12)] + [None, ""]


@pytest.mark.parametrize("longest, head", [(1, 1 << 16), (2, 40), (3, 0)])
def test_equals_brute_force(spark, longest, head):
    """Whatever part of the vocabulary is the head."""
    docs, target = case()
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, score int").repartition(3)
    b = spark.createDataFrame([(t,) for t in target], "text string")
    got = im.resample(d, b, longest=longest, buckets=997, share=(30, 100), min_words=20, seed="s", head_most=head)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, target, longest, 997, (30, 100), 20, "s")


def test_equal_rows_are_drawn_one_by_one(spark):
    d = spark.createDataFrame([(None, "a b c")] * 50 + [(1, "a b d")], "doc_id long, text string").repartition(4)
    got = im.resample(d, d.limit(0), longest=1, share=(40, 100), min_words=3).collect()
    assert sorted(r.rank for r in got if r.rank is not None) == list(range(1, 21))


def test_empty_and_long(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert im.resample(none, none).count() == 0
    long = "word " * 2_500_000  # over 10 MB
    r = im.resample(spark.createDataFrame([(1, long), (2, "b")], "doc_id long, text string"), none, longest=1, share=(1, 1)).collect()
    assert sorted((x.doc_id, x.n_features, x.rank) for x in r) == [(1, 2_500_000, 1), (2, 1, None)]


def test_crc_of_words_and_of_runs():
    text = b"abc Def " + b"q" * 100 + b" zz"
    data = np.frombuffer(text, np.uint8)
    start, end = np.array([0, 4, 8, 109]), np.array([3, 7, 108, 111])
    plain = [text[a:b].lower() for a, b in zip(start, end)]
    assert im.crc_words(data, start, end).tolist() == [zlib.crc32(w) for w in plain]
    after = im.crc_words(data, start, end, blank=True)
    assert after.tolist() == [zlib.crc32(b" " + w) for w in plain]
    first = np.array([zlib.crc32(b"first")] * 4, np.uint32)
    assert im.extend(first, after, end - start + 1).tolist() == [zlib.crc32(b"first " + w) for w in plain]
