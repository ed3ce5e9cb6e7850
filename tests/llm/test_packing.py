"""Packing: exact round trip of the ids, valid and tight sequences."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlake.llm import packing as pk

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["T̈e Å x", "it's <|endoftext|> <|ENDOFTEXT|>don't\x1cfoo bar　q ΑΣ ΣΑΣ. Α.Σ, \x85z İstanbul, ﬀ.", "", "  ",
       ". ., , a., É., É́., T́., Ti., Té.,", "a\x0bb\x0cc 12a3 ¿qué? 你好 ​zz é ́x", "Hello, World. HELLO WORLD", None]


def test_ids_are_the_tokenizers(spark):
    t = Tokenizer.from_file(PATH)
    texts = [x or "" for x in ODD]
    want = [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
    got = [np.frombuffer(b, "<u4").tolist() for b in pk.encode_all([x.encode() for x in texts], PATH)]
    assert got == want


def place(table, items):
    key, rank, used = (table[:, 0] << 48) | table[:, 1], {}, defaultdict(list)
    for n in items:
        r = rank.get(n, 0)
        rank[n] = r + 1
        row = table[np.searchsorted(key, (n << 48) | r, side="right") - 1]
        assert row[0] == n
        used[int(row[2] + (r - row[1]) // row[3])].append((int(row[4] + (r - row[1]) % row[3] * n), n))
    return used


@settings(max_examples=80, deadline=None)
@given(st.integers(4, 120), st.lists(st.integers(1, 120), max_size=150))
def test_plan_is_valid_and_tight(capacity, items):
    items = [1 + n % capacity for n in items]
    histogram = {n: items.count(n) for n in set(items)}
    table, count = pk.plan(histogram, capacity)
    used = place(table, items)
    assert len(used) == count
    for content in used.values():
        at = 0
        for offset, n in sorted(content):
            assert offset == at
            at += n
        assert at <= capacity
        assert sum(3 * n > capacity for _, n in content) <= 2
    first_fit = []
    for n in sorted(items, reverse=True):
        for i, free in enumerate(first_fit):
            if free >= n:
                first_fit[i] -= n
                break
        else:
            first_fit.append(capacity - n)
    assert count <= len(first_fit) + max(1, len(first_fit) // 10)


def test_pack_round_trip(spark):
    rng = random.Random(5)
    rows = [(i, t) for i, t in enumerate(ODD)]
    rows += [(100 + i, " ".join(rng.choice(["alpha", "Beta,", "gamma.", "δ", "x1"]) for _ in range(rng.choice([3, 50, 300]))))
             for i in range(40)]
    rows += [(500 + i, "same text") for i in range(60)] + [(7, "same id"), (None, "no id")]
    capacity = 64
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, length int").repartition(4)
    got = pk.pack(docs, PATH, capacity).collect()
    t = Tokenizer.from_file(PATH)
    want = []
    for i, text in rows:
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        want += [(i, p // capacity, p, len(ids[p:p + capacity]), zlib.crc32(ids[p:p + capacity].tobytes()))
                 for p in range(0, len(ids), capacity)]
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for content in held.values():
        at = 0
        for offset, n in sorted(content):
            assert offset == at
            at += n
        assert at <= capacity
    assert len(held) <= 1.1 * sum(r.length for r in got) / capacity + 2
    assert pk.pack(docs.limit(0), PATH, capacity).count() == 0


def test_marks_of_small_letters_join_the_stop(spark):
    """All letters whose small form is longer, in front of stops and elsewhere."""
    rng = random.Random(8)
    longer = [chr(c) for c in range(0x110000) if chr(c).isalpha() and len(chr(c).lower()) > 1]
    assert "\u0130" in longer
    pieces = [*longer, "i", "A", "é", "ß", "ﬁ", "Ω", "日", ".", ",", "..", "7"]
    texts = ["\u0130. Melih", "\u0130, x", "A\u0130.", "\u0130\u0130.."] + [
        " ".join("".join(rng.choice(pieces) for _ in range(rng.randint(1, 6))) for _ in range(12)) for _ in range(300)]
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    want = [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert list(pk.encode_all([t.encode() for t in texts], path)) == want


def test_a_worker_that_remembers_few_words_gives_the_same_ids():
    texts = [" ".join(f"Wort{(i * j) % 97}. der{j}, {i}" for j in range(40)).encode() for i in range(30)]
    pk._loaded.clear()
    every = list(pk.encode_all(texts, PATH))
    pk._loaded.clear()
    few = [ids for t in texts for ids in pk.encode_all([t], PATH, remember=100)]
    assert few == every
    assert len(pk._loaded[PATH][1]) < 300
    pk._loaded.clear()
