"""Best-fit packing with large-item matching.

Documents are tokenised in one pass; what is over the capacity is cut.  A
piece above a third of the capacity is large: at most two share a sequence,
found by greedy matching from the longest down, each with the longest partner
that fits.  Smaller pieces then go, longest first, to the sequence with the
least sufficient gap.

Scale: packing sees only lengths, so it is planned on the histogram of lengths
(at most ``capacity`` counts, whatever the input): equal lengths are placed in
runs, sequences with equal contents stay one group.  Every piece has a rank
among those of its length (task-local rank plus the counts of earlier tasks)
and looks its place up in the plan, whose size is bounded by the capacity too.
Texts are never shuffled; no task holds a group of pieces.

Defined results: a null text is an empty document, one end token; repeated and
null ids are separate documents; other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ledgerlake.llm import vectext as vt
from ledgerlake.llm.components import written

CAPACITY = 4096
END = 1
#: Words that a worker remembers (about 250 MB).
_REMEMBER = 1_500_000
_STOP = re.compile(rb"(?<=[A-Za-z])([.,])(?=\s|$)")
_loaded: dict = {}


def _tokenizer(path: str):
    """The tokenizer and the ids of the words met so far, one per worker."""
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        _loaded[path] = (Tokenizer.from_file(path), {})
    return _loaded[path]


def _parts(word: bytes) -> tuple[bytes, ...]:
    """Parts of a word with the same ids one after the other: stops at the end
    after a letter are a token of their own, and a capital A-Z before a letter
    is its small letter (a mark there might join it, so then it stays).  A
    letter whose small form ends with a mark (U+0130) keeps its stop, as the
    tokenizer joins the two."""
    if word.isascii():
        core = word.rstrip(b".,")
        if not core.isalpha():
            return (word,)
        low = core.lower()
        return (low,) if len(core) == len(word) else (low, word[len(core):])
    text = word.decode()
    core = text.rstrip(".,")
    if not core[-1:].isalpha() or not core[-1].lower()[-1].isalpha():
        return (word,)
    low = core[0].lower() + core[1:] if core[0].isascii() and core[1:2].isalpha() else core
    return (low.encode(),) if len(core) == len(text) else (low.encode(), text[len(core):].encode())


def _simpler(text: bytes) -> bytes:
    """The same ids from fewer distinct words: a single stop after a letter
    stands alone; ASCII text without a special token's opening is lower-cased."""
    text = _STOP.sub(rb" \1", text)
    return text.lower() if text.isascii() and b"<|" not in text else text


def _ids_of(tokenizer, words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
    """Ids of each word.  Words of letters only are one unit of the tokenizer
    each, so many of them go through it as one text."""
    texts = [w.decode() for w in words]
    plain = [i for i, t in enumerate(texts) if t.isalpha()]
    alone = [i for i, t in enumerate(texts) if not t.isalpha()]
    for a in range(0, len(plain), 64 * 64):
        runs = [plain[i:i + 64] for i in range(a, min(a + 64 * 64, len(plain)), 64)]
        found = tokenizer.encode_batch([" ".join(texts[i] for i in run) for run in runs], add_special_tokens=False)
        for run, e in zip(runs, found):
            unit = np.array(e.word_ids, dtype=np.int64)
            cut = np.searchsorted(unit, np.arange(len(run) + 1))
            if unit[-1] + 1 != len(run) or not (np.diff(cut) > 0).all():
                alone += run
                continue
            ids = np.array(e.ids, dtype="<u4").tobytes()
            for i, x, y in zip(run, (cut[:-1] * 4).tolist(), (cut[1:] * 4).tolist()):
                yield words[i], ids[x:y]
    for a in range(0, len(alone), 4096):
        run = alone[a:a + 4096]
        for i, e in zip(run, tokenizer.encode_batch([texts[i] for i in run], add_special_tokens=False)):
            yield words[i], np.array(e.ids, dtype="<u4").tobytes()


def encode_all(texts: list[bytes], path: str, remember: int = _REMEMBER) -> Iterator[bytes]:
    """Ids of each text as little-endian 32-bit numbers.

    The vocabulary never merges across white space, so the blank-separated
    words of a text are tokenised one by one, each distinct word once.
    """
    tokenizer, known = _tokenizer(path)
    words = [_simpler(t).split() for t in texts]
    new = set(chain.from_iterable(words)).difference(known)
    if len(known) + len(new) > remember:
        kept = {w: known[w] for w in set(chain.from_iterable(words)).difference(new)}
        known.clear()
        known.update(kept)
    parts = {w: _parts(w) for w in new}
    cores = [c for c in set(chain.from_iterable(parts.values())) if c not in known]
    known.update(_ids_of(tokenizer, cores))
    for w, p in parts.items():
        if len(p) > 1 or p[0] != w:
            known[w] = b"".join(map(known.__getitem__, p))
    for w in words:
        yield b"".join(map(known.__getitem__, w))


def _pieces(path: str, capacity: int, remember: int = _REMEMBER):
    def run(batches):
        part = TaskContext.get().partitionId()
        count = np.zeros(capacity + 1, np.int64)
        end = np.array([END], dtype="<u4").tobytes()
        for batch in batches:
            data, off = vt.text_buffer(batch.column("text"))
            for a, b in vt.slices(off, 1 << 20):
                texts = [data[off[i]:off[i + 1]].tobytes() for i in range(a, b)]
                of, piece, start, length, crc, rank = [], [], [], [], [], []
                for i, ids in enumerate(encode_all(texts, path, remember)):
                    ids += end
                    for p in range(0, len(ids), 4 * capacity):
                        own = ids[p:p + 4 * capacity]
                        n = len(own) // 4
                        of.append(i)
                        piece.append(p // (4 * capacity))
                        start.append(p // 4)
                        length.append(n)
                        crc.append(zlib.crc32(own))
                        rank.append(count[n])
                        count[n] += 1
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(a, b - a).take(pa.array(of, pa.int64())), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                    pa.array([part] * len(of), pa.int32()), pa.array(rank, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])
    return run


def plan(histogram: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Places for pieces by length: rows (length, first rank, first sequence,
    pieces per sequence, offset), sorted by length and rank, and the number of
    sequences.  Rank r of a length is in the last row whose first rank is <= r."""
    left = {n: c for n, c in histogram.items() if c > 0}
    groups: list[tuple[int, list[tuple[int, int]]]] = []  # (sequences, [(length, copies)]) done
    by_gap: dict[int, list] = {}
    gaps: list[int] = []

    def open_group(gap: int, count: int, content: list) -> None:
        if not count:
            return
        if gap not in by_gap:
            by_gap[gap] = []
            gaps.insert(bisect_left(gaps, gap), gap)
        by_gap[gap].append((count, content))

    def take(least: int):
        """A group with the least gap that takes ``least``, or None."""
        at = bisect_left(gaps, least)
        if at == len(gaps):
            return None
        gap = gaps[at]
        count, content = by_gap[gap].pop()
        if not by_gap[gap]:
            del by_gap[gap], gaps[at]
        return gap, count, content

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        n = large[-1]
        at = bisect_left(large, capacity - n + 1) - 1
        m = large[at] if at >= 0 else None
        if m is None:
            k = left.pop(n)
            large.pop()
            open_group(capacity - n, k, [(n, 1)])
        elif m == n:
            k = left[n]
            open_group(capacity - 2 * n, k // 2, [(n, 2)])
            if k % 2 == 0:
                left.pop(n)
                large.pop()
            else:
                left[n] = 1
                smaller = large[at - 1] if at else None
                if smaller is None:
                    open_group(capacity - n, 1, [(n, 1)])
                    left.pop(n)
                    large.pop()
                else:
                    open_group(capacity - n - smaller, 1, [(n, 1), (smaller, 1)])
                    left.pop(n)
                    large.pop()
                    left[smaller] -= 1
                    if not left[smaller]:
                        left.pop(smaller)
                        large.remove(smaller)
        else:
            k = min(left[n], left[m])
            open_group(capacity - n - m, k, [(n, 1), (m, 1)])
            for x in (n, m):
                left[x] -= k
                if not left[x]:
                    left.pop(x)
                    large.remove(x)
    for n in sorted(left, reverse=True):
        c = left[n]
        while c:
            gap, count, content = take(n) or (capacity, -(-c // (capacity // n)), [])
            q = gap // n
            full = min(count, c // q)
            rest = c - full * q if full < count else 0
            open_group(gap - q * n, full, content + [(n, q)])
            if rest:
                open_group(gap - rest * n, 1, content + [(n, rest)])
            open_group(gap, count - full - (rest > 0), content)
            c -= full * q + rest
    for gap in gaps:
        groups += by_gap[gap]
    rows, used, base = [], {}, 0
    for count, content in groups:
        offset = 0
        for n, q in content:
            rows.append((n, used.get(n, 0), base, q, offset))
            used[n] = used.get(n, 0) + count * q
            offset += n * q
        base += count
    rows.sort()
    return np.array(rows, dtype=np.int64).reshape(-1, 5), base


def _place(table):
    def run(batches):
        t = table.value
        key = (t[:, 0] << 48) | t[:, 1]
        for batch in batches:
            n, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            row = t[np.searchsorted(key, (n << 48) | rank, side="right") - 1]
            nth = rank - row[:, 1]
            out = {c: batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")}
            out["sequence_id"] = pa.array(row[:, 2] + nth // row[:, 3])
            out["offset"] = pa.array(row[:, 4] + nth % row[:, 3] * n)
            yield pa.RecordBatch.from_arrays(list(out.values()), list(out))
    return run


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, remember: int = _REMEMBER) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) with their places in sequences of at
    most ``capacity`` tokens: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset.  ``tokenizer``: file that every executor can read.
    ``remember``: words whose ids a worker keeps, which decides its memory and
    time, never the result."""
    if tokenizer is None:
        import public_tokenizers
        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    pieces = written(spark, docs.select("doc_id", "text").mapInArrow(
        _pieces(tokenizer, capacity, remember), shape + ", part int, nth long"), "pieces")
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("c"))
    histogram = {r.length: r.c for r in counts.groupBy("length").agg(F.sum("c").alias("c")).collect()}  # <= capacity rows
    table = spark.sparkContext.broadcast(plan(histogram, capacity)[0])
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "part", F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("before"))
    return (pieces.join(before, ["length", "part"]).withColumn("rank", F.col("before") + F.col("nth"))
            .mapInArrow(_place(table), shape + ", sequence_id long, offset long"))
