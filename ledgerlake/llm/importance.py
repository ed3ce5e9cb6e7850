"""Documents drawn by their likeness to a target, with hashed n-gram features.

Features are the runs of 1 to ``longest`` consecutive words.  The bucket of a
feature is the CRC-32 of its bytes modulo ``buckets``; a bucket's gain is the
logarithm of its share among the target's features over its share among the
documents'.  A document's weight is its mean gain; Gumbel noise from a hash of
its id turns the highest scores into a draw without replacement.

Method (head-tail vocabulary).  All words of all texts are counted.  For the
``HEAD`` most frequent ones the CRC states are made once and broadcast: the
CRC of the word and that of a blank with the word, from which any run is
combined without reading its bytes.  For the most frequent pairs of such
words the bucket itself is broadcast.  All other words, the tail, take their
CRC directly from their bytes.  Both feed the exact bucket totals.  Frequency
decides only which way a bucket is found, never which one.

Scale.  Three passes over the texts (words, totals, scores; a fourth one for
pairs where runs have two words).  What is shuffled: distinct words per task
with their counts, ``buckets`` numbers per task, and a row of numbers per
document that may be drawn.  To the driver come at most ``HEAD`` words and
pairs, ``buckets`` totals and the counts by score; scores are whole numbers
within the range of logarithms of 64-bit counts, so their number is bounded.

Defined results: null, empty and wordless texts have no features and weight 0;
a null doc_id draws its noise as an empty one and is first among ties; rows
that repeat a doc_id are separate documents, ties of equal rows fall to any of
them; very long texts have no limit; an empty table gives an empty one, an
empty target gives every bucket the gain of an unseen one; other columns are
not read.
"""

from __future__ import annotations

import functools
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import vectext as vt
from ledgerlake.llm import wordcounts as wc
from ledgerlake.llm.components import written

HEAD = 1 << 16
#: Longer words take zlib's CRC one by one.
_LONG = 64

_crc_table = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _crc_table = np.where(_crc_table & 1, (_crc_table >> 1) ^ np.uint32(0xEDB88320), _crc_table >> 1).astype(np.uint32)


def crc_words(data: np.ndarray, start: np.ndarray, end: np.ndarray, blank: bool = False) -> np.ndarray:
    """CRC-32 of the lower-cased words, with a blank before each if wanted."""
    size = end - start
    state = np.full(len(start), 0xFFFFFFFF, np.uint32)
    if blank:
        state = _crc_table[(state ^ 0x20) & 0xFF] ^ (state >> 8)
    order = np.argsort(-size, kind="stable")
    first, sizes = start[order], -size[order]  # ascending
    out = state[order]
    long = int(np.searchsorted(sizes, -_LONG, side="left"))
    for j in range(int(-sizes[long]) if long < len(sizes) else 0):
        n = int(np.searchsorted(sizes, -j, side="left"))
        byte = wc.LOWER[data[first[long:n] + j]]
        out[long:n] = _crc_table[(out[long:n] ^ byte) & 0xFF] ^ (out[long:n] >> 8)
    out ^= np.uint32(0xFFFFFFFF)
    for i in range(long):
        word = wc.LOWER[data[first[i]:first[i] - sizes[i]]].tobytes()
        out[i] = zlib.crc32(b" " + word if blank else word)
    back = np.empty(len(start), np.uint32)
    back[order] = out
    return back


@functools.lru_cache(maxsize=4096)
def _shift(size: int) -> np.ndarray:
    """Tables [4, 256] that carry a CRC over ``size`` bytes to come."""
    bits = [1 << i for i in range(32)]
    step = [int(_crc_table[b & 0xFF]) ^ (b >> 8) for b in bits]  # one zero byte
    result = bits

    def apply(matrix: list[int], value: int) -> int:
        total, i = 0, 0
        while value:
            if value & 1:
                total ^= matrix[i]
            value >>= 1
            i += 1
        return total
    while size:
        if size & 1:
            result = [apply(step, r) for r in result]
        step = [apply(step, s) for s in step]
        size >>= 1
    tables = np.zeros((4, 256), np.uint32)
    for k in range(4):
        for i in range(8):
            tables[k, 1 << i] = result[8 * k + i]
        for v in range(1, 256):
            low = v & -v
            tables[k, v] = tables[k, v ^ low] ^ tables[k, low]
    return tables


def extend(crc: np.ndarray, after: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC of A + B from that of A, that of B and the bytes of B."""
    out = np.empty(len(crc), np.uint32)
    for n in np.unique(size):
        pick = size == n
        t, c = _shift(int(n)), crc[pick]
        out[pick] = t[0][c & 0xFF] ^ t[1][(c >> 8) & 0xFF] ^ t[2][(c >> 16) & 0xFF] ^ t[3][c >> 24]
    return out ^ after


class Head:
    """Frequent words by hash, with their CRC states, and frequent pairs of
    them (two word numbers in one integer) with their buckets."""

    def __init__(self, hashes: np.ndarray, words: list[str]):
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        words = [words[i].encode() for i in order]
        self.alone = np.array([zlib.crc32(w) for w in words], np.uint32)
        self.after = np.array([zlib.crc32(b" " + w) for w in words], np.uint32)
        self.size = np.array([len(w) for w in words], np.int64)
        self.pairs, self.pair_buckets = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each head word, -1 for the tail."""
        if not len(self.hashes):
            return np.full(len(hashes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)

    def set_pairs(self, pairs: np.ndarray, buckets: int) -> None:
        self.pairs = np.sort(pairs)
        a, b = self.pairs >> 32, self.pairs & 0xFFFFFFFF
        self.pair_buckets = (extend(self.alone[a], self.after[b], self.size[b] + 1) % buckets).astype(np.int64)


def _words(data: np.ndarray, off: np.ndarray):
    start, end, first = vt.word_spans(data, off, vt.ALNUM_WORDS)
    return start, end, first, wc.hash_words(data, start, end)


def _runs(batches):
    for batch in batches:
        data, off = vt.text_buffer(batch.column("text"))
        for a, b in vt.slices(off, wc.RUN_BYTES):
            yield batch, a, b, data[off[a]:off[b]], off[a:b + 1] - off[a]


def _count_words(batches):
    for *_, data, off in _runs(batches):
        start, end, _, hashes = _words(data, off)
        key, at, n = wc.distinct(hashes)
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), wc.word_strings(data, start[at], end[at]),
                                          pa.array(n, pa.int64())], ["h", "word", "n"])


def _count_pairs(head):
    def run(batches):
        for *_, data, off in _runs(batches):
            _, _, first, hashes = _words(data, off)
            number = head.value.number(hashes)
            ok = (number[:-1] >= 0) & (number[1:] >= 0)
            ends = first[1:-1]
            ok[ends[(ends > 0) & (ends < len(number))] - 1] = False
            key, n = np.unique((number[:-1][ok] << 32) | number[1:][ok], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(n, pa.int64())], ["pair", "n"])
    return run


def features(data: np.ndarray, off: np.ndarray, head: Head, longest: int, buckets: int):
    """For k = 1 to ``longest``: buckets of the runs of k words, row by row,
    and their offsets; the words of each row are those of k = 1."""
    start, end, first, hashes = _words(data, off)
    number = head.number(hashes)
    known, tail = number >= 0, np.flatnonzero(number < 0)
    alone, after = np.empty(len(start), np.uint32), np.empty(len(start), np.uint32)
    alone[known] = head.alone[number[known]]
    alone[tail] = crc_words(data, start[tail], end[tail])
    if longest > 1:
        after[known] = head.after[number[known]]
        after[tail] = crc_words(data, start[tail], end[tail], blank=True)
    size, count = end - start + 1, np.diff(first)
    state = alone
    yield (state % np.uint32(buckets)).astype(np.int64), first
    for k in range(2, longest + 1):
        many = np.maximum(count - k + 1, 0)
        to = np.concatenate([[0], np.cumsum(many)])
        at = np.arange(int(to[-1])) + np.repeat(first[:-1] - to[:-1], many)
        # the state at each word is that of the run of k - 1 words from it on
        state_at = extend(state[at], after[at + k - 1], size[at + k - 1])
        bucket = (state_at % np.uint32(buckets)).astype(np.int64)
        if k == 2 and len(head.pairs):
            pair = np.where(known[at] & known[at + 1], (number[at] << 32) | number[at + 1], -1)
            place = np.minimum(np.searchsorted(head.pairs, pair), len(head.pairs) - 1)
            bucket = np.where(head.pairs[place] == pair, head.pair_buckets[place], bucket)
        state = state.copy()
        state[at] = state_at
        yield bucket, to


def _totals(head, longest: int, buckets: int):
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for *_, data, off in _runs(batches):
            for bucket, _ in features(data, off, head.value, longest, buckets):
                total += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["bucket", "n"])
    return run


def _weigh(head, gain, longest: int, buckets: int):
    def run(batches):
        for batch, a, b, data, off in _runs(batches):
            n, total, words = np.zeros(b - a, np.int64), np.zeros(b - a, np.int64), None
            for bucket, to in features(data, off, head.value, longest, buckets):
                reach = np.concatenate([[0], np.cumsum(gain.value[bucket])])
                total += reach[to[1:]] - reach[to[:-1]]
                n += np.diff(to)
                words = n.copy() if words is None else words
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a)] + [
                pa.array(x, pa.int64()) for x in (words, n, weight)], ["doc_id", "n_words", "n_features", "weight"])
    return run


def find_head(texts: DataFrame, longest: int, buckets: int, head_most: int = HEAD) -> Head:
    """The head of the vocabulary of all texts.  A hash that two words share
    is left to the tail, so looking up by hash is exact."""
    context = texts.sparkSession.sparkContext
    counts = texts.mapInArrow(_count_words, "h long, word string, n long").groupBy("h", "word").agg(F.sum("n").alias("n"))
    top = (counts.groupBy("h").agg(F.sum("n").alias("n"), F.count("*").alias("kinds"), F.min("word").alias("word"))
           .where("kinds = 1").orderBy(F.desc("n"), "h").limit(head_most).select("h", "word").toArrow())
    head = Head(top.column("h").to_numpy().astype(np.int64).view(np.uint64), top.column("word").to_pylist())
    if longest > 1:
        pairs = (texts.mapInArrow(_count_pairs(context.broadcast(head)), "pair long, n long").groupBy("pair")
                 .agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "pair").limit(head_most).select("pair").toArrow())
        head.set_pairs(pairs.column("pair").to_numpy().astype(np.int64), buckets)
    return head


def bucket_gains(docs: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1) (S + B) / ((s + 1) (T + B)))) of every bucket."""
    many = len(docs)
    s_all, t_all = float(docs.sum() + many), float(target.sum() + many)
    return np.array([math.floor(1000 * math.log((float(t) + 1) * s_all / ((float(s) + 1) * t_all)))
                     for s, t in zip(docs.tolist(), target.tolist())], np.int64)


def noise(seed: str, doc_id: Column) -> Column:
    """floor(-1000 ln(-ln u)) with u from the first 32 bits of a SHA-256."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def score(docs: DataFrame, target: DataFrame, longest: int = 2, buckets: int = 10000, seed: str = "0",
          head_most: int = HEAD) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every document."""
    context = docs.sparkSession.sparkContext
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("text").unionByName(target.select("text"))
    head = context.broadcast(find_head(texts, longest, buckets, head_most))
    sums = []
    for side in (docs, target):
        rows = (side.select("text").mapInArrow(_totals(head, longest, buckets), "bucket long, n long")
                .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow())
        total = np.zeros(buckets, np.int64)
        total[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
        sums.append(total)
    gain = context.broadcast(bucket_gains(*sums))
    return (docs.select("doc_id", "text").mapInArrow(_weigh(head, gain, longest, buckets),
                                                     f"doc_id {kind}, n_words long, n_features long, weight long")
            .withColumn("score", F.col("weight") + noise(seed, F.col("doc_id"))))


def resample(docs: DataFrame, target: DataFrame, longest: int = 2, buckets: int = 10000, share: tuple[int, int] = (10, 100),
             min_words: int = 20, seed: str = "0", head_most: int = HEAD) -> DataFrame:
    """The rows of ``score`` with rank: 1, 2, ... for the floor(share) of the
    documents with at least ``min_words`` words that have the highest scores
    (ties to the smaller doc_id), null for all others."""
    spark = docs.sparkSession
    rows = written(spark, score(docs, target, longest, buckets, seed, head_most), "importance")
    may = F.col("n_words") >= min_words
    counts = sorted(((r.score, r.n) for r in rows.where(may).groupBy("score").agg(F.count("*").alias("n")).collect()), reverse=True)
    draw = share[0] * sum(n for _, n in counts) // share[1]
    least, so_far = None, 0
    for value, n in counts:
        if so_far >= draw:
            break
        least, so_far = value, so_far + n
    if least is None:
        return rows.withColumn("rank", F.lit(None).cast("long"))
    top = may & (F.col("score") >= least)
    # a sort dealt by ranges; the last key parts equal rows of any number
    order = [F.desc("score"), F.asc("doc_id"), F.asc("n_features"), F.asc("weight"), F.asc("any")]
    chosen = rows.where(top).withColumn("any", F.monotonically_increasing_id())
    chosen = (chosen.repartitionByRange(*order).sortWithinPartitions(*order).drop("any")
              .withColumn("place", F.monotonically_increasing_id()))
    chosen = written(spark, chosen, "importance-order")
    part, within = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted((r.part, r.n) for r in chosen.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    before, bases = 0, []
    for p, n in sizes:
        bases.append((p, before))
        before += n
    bases = F.broadcast(spark.createDataFrame(bases, "part long, base long"))
    rank = F.col("base") + within + 1
    ranked = chosen.join(bases, part == F.col("part")).withColumn("rank", F.when(rank <= draw, rank))
    return (ranked.select(*rows.columns, "rank")
            .unionByName(rows.where(~top).withColumn("rank", F.lit(None).cast("long"))))
