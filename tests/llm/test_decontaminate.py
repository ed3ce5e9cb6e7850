"""Decontamination against a scan of all windows."""

import hashlib
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from ledgerlake.llm import decontaminate as dc
from ledgerlake.llm import vectext as vt

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for name, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 12) if w and name is not None else 0):
            windows.setdefault(tuple(w[i:i + 13]), set()).add(name)
    out = []
    for name, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if tuple(w[i:i + size]) in windows:
                    found |= windows[tuple(w[i:i + size])]
                    hit.update(range(i, i + size))
        sha = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((name, len(w), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def case(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["é", "日本", "o'k", "X1"]

    def text(n):
        return rng.choice([" ", "-", "\n"]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([1, 3, 12, 13, 14, 40]))) for i in range(12)]
    items += [(3, items[3][1]), (None, text(20)), (50, None), (51, ""), (52, items[5][1].upper())]
    docs = [(0, None), (1, ""), (2, "..."), (3, "one two")]
    for i in range(4, 60):
        body = text(rng.randint(0, 200)).split(" ")
        for _ in range(rng.randint(0, 2)):
            piece = (rng.choice(items)[1] or "").split(" ")
            a = rng.randrange(max(1, len(piece)))
            at = rng.randrange(len(body) + 1)
            body[at:at] = piece[a:a + rng.randint(1, 30)]
        docs.append((i, " ".join(body)))
    return docs + [(4, docs[4][1]), (None, docs[5][1])], items


@pytest.mark.parametrize("block", [dc.BLOCK_BYTES, 200])
def test_report_equals_brute_force(spark, block):
    """In one block and in several."""
    docs, items = case(block)
    d = spark.createDataFrame([(i, t, "n") for i, t in docs], "doc_id long, text string, n_words string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = dc.contamination(d, b, block_bytes=block).collect()
    assert sorted((tuple(r)[:6] for r in got), key=str) == brute(docs, items)
    assert all((r.longest > 0) == (r.n_hit > 0) and (r.longest_at is None) == (r.n_hit == 0) for r in got)
    kept = dc.remove(d, b, block_bytes=block)
    assert kept.columns == d.columns
    bad = {x[0] for x in brute(docs, items) if x[5]}
    if block == dc.BLOCK_BYTES:
        assert kept.count() == sum(not x[5] for x in brute(docs, items))
    else:
        assert {r.doc_id for r in kept.collect()} == {i for i, _ in docs} - bad


def test_longest_match_and_place(spark):
    item = " ".join(f"b{i}" for i in range(30))
    text = "x y " + " ".join(f"b{i}" for i in range(5, 25)) + " z " + " ".join(f"b{i}" for i in range(13))
    d = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = dc.contamination(d, spark.createDataFrame([(9, item)], "item_id long, text string")).first()
    assert (r.longest, r.longest_at, r.n_hit, r.n_items) == (20, 2, 33, 1)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert [r.contaminated for r in dc.contamination(docs, items).collect()] == [False]
    assert dc.contamination(docs.limit(0), items).count() == 0


@pytest.mark.parametrize("block", [dc.BLOCK_BYTES, 200])
def test_remove_judges_every_row_by_its_own_text(spark, block):
    """Rows without an id and rows that repeat one, in one block and in several."""
    items = [(i, " ".join(f"b{i}_{j}" for j in range(15))) for i in range(8)]
    dirty = [(None, items[0][1]), (None, items[0][1]), (7, items[1][1] + " x"), (8, items[2][1])]
    clean = [(None, "one two"), (None, "one two"), (None, None), (7, "three"), (7, "three"), (9, "")]
    d = spark.createDataFrame([(i, t, "n") for i, t in dirty + clean], "doc_id long, text string, row_key string").repartition(3)
    kept = dc.remove(d, spark.createDataFrame(items, "item_id long, text string"), block_bytes=block)
    assert kept.columns == d.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(clean, key=str)


def test_memory_of_a_task_does_not_grow_with_its_batch():
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 5000, 400)) for _ in range(6000)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    items = pa.table({"item_id": ["a", "b"], "text": [texts[7], " ".join(texts[8].split()[:5])]})

    class Block:
        value = dc.windows_of(items)
    list(dc._keep_clean(Block, 20)([batch.slice(0, 10)]))
    tracemalloc.start()
    kept = sum(out.num_rows for out in dc._keep_clean(Block, 20)([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert kept == len(texts) - 1
    assert peak < 32 << 20, f"{peak >> 20} MB for {batch.nbytes >> 20} MB of text"


def test_word_hashes_do_not_depend_on_where_sums_begin(monkeypatch):
    text = b"One two  three " + b"x" * 300 + b" \xc3\xa9t\xc3\xa9 TWO, three " * 20
    data = np.frombuffer(text, np.uint8)
    start, end, _ = vt.word_spans(data, np.array([0, len(data)]), vt.SPACE_WORDS)
    alone = [vt.word_hashes(data[a:b], np.array([0]), np.array([b - a]))[0] for a, b in zip(start, end)]
    for most in (1, 7, 64, 1 << 20):
        monkeypatch.setattr(vt, "_SUM_BYTES", most)
        assert vt.word_hashes(data, start, end).tolist() == alone
