"""Phrases against plain counting."""

import random
import re
from collections import Counter

import pytest

from ledgerlake.llm import collocations as co


def brute(docs, longest, least, top, inside):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0A-\x0D]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, *w[i:i + k]) for i in range(len(w) - k + 1))
    candidates = {g: a for g, a in f.items() if len(g) > 2 and a >= least}
    absorbed = set()
    for g, a in candidates.items():
        w = g[1:]
        for i in range(len(w)):
            for j in range(i + 2, len(w) + 1):
                part = (g[0], *w[i:j])
                if len(part) < len(g) and inside[0] * a >= inside[1] * f[part]:
                    absorbed.add(part)
    rows = {}
    for g, a in candidates.items():
        if g not in absorbed:
            cut = min((1000 * a * n[g[0]] // (f[g[:k + 1]] * f[(g[0], *g[k + 1:])]), k) for k in range(1, len(g) - 1))
            k = cut[1]
            rows.setdefault(g[0], []).append((-cut[0], -a, " ".join(g[1:]).encode(), f[g[:k + 1]], f[(g[0], *g[k + 1:])]))
    return sorted((lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, found in rows.items()
                  for i, (s, a, p, l, r) in enumerate(sorted(found)[:top]))


def case(seed):
    rng = random.Random(seed)
    vocabulary = ["The", "of", "É", "日本", "o'k", "x\x00y"] + [f"w{i}" for i in range(30)]
    idioms = [["new", "york", "city"], ["à", "la", "carte", "s'il", "vous"], ["the", "the", "the"], ["once", "upon", "a", "time", "in"]]

    def text(n):
        out = []
        while len(out) < n:
            out += rng.choice(idioms) if rng.random() < 0.3 else [vocabulary[min(int(rng.expovariate(0.2)), 35)]]
        return "".join(w + rng.choice([" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n"]) for w in out)
    docs = [(rng.choice(["en", "EN", "fr", None, "und"]), text(rng.randint(0, 120))) for _ in range(150)]
    return docs + [("en", None), (None, ""), ("de", "..,,"), ("de", "rare words only")] + [docs[3]] * 10


@pytest.mark.parametrize("longest, least, top, inside, budget, head", [
    (5, 10, 2000, (100, 100), 1 << 20, 1 << 20), (5, 5, 40, (100, 100), 300, 10), (4, 8, 30, (110, 100), 20, 0)])
def test_equals_brute_force(spark, longest, least, top, inside, budget, head):
    """Whatever the budget (prefixes extended to any depth) and the head."""
    docs = case(longest + budget)
    d = spark.createDataFrame([(g, t, 1) for g, t in docs], "lang string, text string, w int").repartition(3)
    got = co.collocations(d, longest, least, top, inside, budget, head)
    assert sorted(tuple(r) for r in got.collect()) == brute(docs, longest, least, top, inside)


def test_large_products_stay_exact(spark):
    d = spark.createDataFrame([("en", "a b " * 600_000)] * 2, "lang string, text string")
    got = co.collocations(d, longest=2, least=100).collect()
    n = 2_400_000
    assert [(r.phrase, r.a, r.score) for r in got] == [
        ("a b", 1_200_000, 1000 * 1_200_000 * n // 1_200_000 ** 2), ("b a", 1_199_998, 1000 * 1_199_998 * n // 1_200_000 ** 2)]


def test_empty_table(spark):
    assert co.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0
