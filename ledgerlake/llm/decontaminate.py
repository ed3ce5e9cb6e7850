"""Benchmark decontamination by suffix arrays of the training text.

Every run of training documents (half a MB, or one longer text) gets a suffix
array over its words: the places whose first words (four, by hash; fewer for
shorter windows) begin some benchmark window, sorted by the 13 words that
follow and no further.  All benchmark windows are then located by binary search; the words inside an
occurrence are hit, neighbouring occurrences on one diagonal give the longest
verbatim match and its place.  Only whole windows are searched: a verbatim
match of fewer than 13 words of a longer item has no window, so ``longest`` is
0 and ``longest_at`` null where a document has nothing else.

Scale: documents are read once and nothing of them is shuffled.  The benchmark
is the stated query set; it is broadcast in blocks of at most ``BLOCK_BYTES``
of text, with one pass over the documents per block.

Defined results: null and wordless texts have no words and are clean; an item
with fewer words than a window is one window of its own length; repeated items
count once per item_id; items without id or text are ignored; repeated and
null doc_ids are separate rows; other columns pass through ``remove`` as is.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import vectext as vt

WINDOW = 13
BLOCK_BYTES = 16 << 20
#: Text of one suffix array; its arrays take many times as much memory.
_RUN_BYTES = 1 << 19
#: Words of a window's start by which places are chosen for the suffix array.
_START = 4


@dataclass
class Windows:
    """Distinct windows of a benchmark block: word numbers [n, WINDOW] (0
    beyond the length), length, and (CSR) the items of each and the places in
    them: number of the item's row and word."""

    vocabulary: np.ndarray
    words: np.ndarray
    length: np.ndarray
    item: np.ndarray
    item_off: np.ndarray
    row: np.ndarray
    word: np.ndarray
    place_off: np.ndarray
    starts: dict[int, np.ndarray]


def windows_of(items: pa.Table, size: int = WINDOW) -> Windows:
    data, off = vt.text_buffer(items.column("text"))
    start, end, first = vt.word_spans(data, off, vt.ALNUM_WORDS)
    hashes = vt.word_hashes(data, start, end)
    vocabulary = np.unique(hashes)
    number = (np.searchsorted(vocabulary, hashes) + 1).astype(np.uint32)
    rows, lengths, owners, row, word = [], [], [], [], []
    for i, name in enumerate(items.column("item_id").to_pylist()):
        w = number[first[i]:first[i + 1]]
        if name is None or not len(w):
            continue
        if len(w) < size:
            rows.append(np.pad(w, (0, size - len(w)))[None])
        else:
            rows.append(np.lib.stride_tricks.sliding_window_view(w, size))
        lengths += [min(len(w), size)] * len(rows[-1])
        owners += [name] * len(rows[-1])
        row += [i] * len(rows[-1])
        word += range(len(rows[-1]))
    if not rows:
        none = np.zeros(0, np.int64)
        return Windows(vocabulary, np.zeros((0, size), np.uint32), none, np.zeros(0, object), np.zeros(1, np.int64),
                       none, none, np.zeros(1, np.int64), {})
    words, back = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
    back = back.reshape(-1)
    length = np.zeros(len(words), np.int64)
    length[back] = lengths
    pairs = sorted(set(zip(back.tolist(), owners)), key=lambda x: x[0])
    item_off = np.searchsorted([p[0] for p in pairs], np.arange(len(words) + 1))
    order = np.argsort(back, kind="stable")
    place_off = np.searchsorted(back[order], np.arange(len(words) + 1))
    starts: dict[int, list] = {}
    for k in np.unique(np.minimum(length, _START)):
        pick = np.minimum(length, _START) == k
        starts[int(k)] = np.unique(_join(words[pick], int(k)))
    return Windows(vocabulary, words, length, np.array([p[1] for p in pairs], dtype=object), item_off,
                   np.array(row)[order], np.array(word)[order], place_off, starts)


def _join(words: np.ndarray, k: int) -> np.ndarray:
    h = np.zeros(len(words), np.uint64)
    for j in range(k):
        h = vt.mix(h * np.uint64(0x9E3779B97F4A7C15) + words[:, j].astype(np.uint64))
    return h


def _keys(words: np.ndarray) -> np.ndarray:
    """Rows of word numbers as byte strings that sort like the rows."""
    wide = np.ascontiguousarray(words.astype(">u4"))
    return wide.view(f"S{4 * words.shape[1]}").reshape(-1)


class SuffixArray:
    """Places of a word-number sequence at which a benchmark window may begin,
    sorted by the following words."""

    def __init__(self, number: np.ndarray, windows: Windows):
        size = windows.words.shape[1]
        self.padded = np.concatenate([number, np.zeros(size, np.uint32)])
        view = np.lib.stride_tricks.sliding_window_view(self.padded, size)[:len(number)]
        chosen = np.zeros(len(number), dtype=bool)
        known = np.flatnonzero(number)
        for k, starts in windows.starts.items():
            for j in range(1, k):
                known = known[view[known, j] != 0]
            h = _join(view[known], k)
            at = np.minimum(np.searchsorted(starts, h), len(starts) - 1)
            chosen[known[starts[at] == h]] = True
            known = np.flatnonzero(number)
        place = np.flatnonzero(chosen)
        keys = _keys(view[place])
        order = np.argsort(keys, kind="stable")
        self.place, self.keys = place[order], keys[order]

    def find(self, words: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of suffixes that begin with each window."""
        if not len(words) or not len(self.keys):
            z = np.zeros(len(words), np.int64)
            return z, z
        top = words.copy()
        top[np.arange(words.shape[1])[None, :] >= length[:, None]] = 0xFFFFFFFF
        return np.searchsorted(self.keys, _keys(words), "left"), np.searchsorted(self.keys, _keys(top), "right")


def _judge(data: np.ndarray, off: np.ndarray, w: Windows):
    """For a run of documents: words, hit words, items, longest match, its place."""
    start, end, first = vt.word_spans(data, off, vt.ALNUM_WORDS)
    n_words = np.diff(first)
    rows = len(n_words)
    hashes = vt.word_hashes(data, start, end)
    n_hit, longest, where = (np.zeros(rows, np.int64) for _ in range(3))
    items: list[set] = [set() for _ in range(rows)]
    spans: list[list] = [[] for _ in range(rows)]
    if not len(hashes) or not len(w.words):
        return n_words, n_hit, items, longest, where, spans
    at = np.minimum(np.searchsorted(w.vocabulary, hashes), len(w.vocabulary) - 1)
    number = np.where(w.vocabulary[at] == hashes, at + 1, 0).astype(np.uint32)
    # a number 0 after each document keeps matches inside it
    shifted = np.arange(len(number)) + np.repeat(np.arange(rows), n_words)
    line = np.zeros(len(number) + rows, np.uint32)
    line[shifted] = number
    array = SuffixArray(line, w)
    left, right = array.find(w.words, w.length)
    count = right - left
    found = np.flatnonzero(count)
    if not len(found):
        return n_words, n_hit, items, longest, where, spans
    total = count[found]
    place = array.place[np.repeat(left[found] - np.concatenate([[0], np.cumsum(total)[:-1]]), total) + np.arange(total.sum())]
    window = np.repeat(found, total)
    length = w.length[window]
    cover = np.zeros(len(line) + 1, np.int64)
    np.add.at(cover, place, 1)
    np.add.at(cover, place + length, -1)
    hit = np.cumsum(cover[:-1]) > 0
    edge = first + np.arange(rows + 1)
    total_hit = np.concatenate([[0], np.cumsum(hit)])
    n_hit = total_hit[edge[1:]] - total_hit[edge[:-1]]
    row = np.searchsorted(edge, place, side="right") - 1
    per = w.item_off[window + 1] - w.item_off[window]
    for r, i in set(zip(np.repeat(row, per).tolist(), _expand(w.item_off[window], per).tolist())):
        items[r].add(w.item[i])
    # maximal stretches of hit words: places, and the longest of each document
    change = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    a, b = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    of = np.searchsorted(edge, a, side="right") - 1
    for r, x, y in zip(of.tolist(), (a - edge[of]).tolist(), (b - edge[of]).tolist()):
        spans[r].append((x, y))
    run_at, run_len = _verbatim(place, window, w)
    r = np.searchsorted(edge, run_at, side="right") - 1
    for i in np.lexsort((-run_at, run_len)):
        longest[r[i]], where[r[i]] = run_len[i], run_at[i] - edge[r[i]]
    return n_words, n_hit, items, longest, where, spans


def _expand(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    return np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())


def _verbatim(place: np.ndarray, window: np.ndarray, w: Windows) -> tuple[np.ndarray, np.ndarray]:
    """Verbatim matches as (place, words): neighbouring occurrences on one
    diagonal, that is, whose windows follow one another in an item too."""
    count = w.place_off[window + 1] - w.place_off[window]
    at = _expand(w.place_off[window], count)
    place, length = np.repeat(place, count), np.repeat(w.length[window], count)
    row, shift = w.row[at], place - w.word[at]
    order = np.lexsort((place, shift, row))
    place, length, row, shift = place[order], length[order], row[order], shift[order]
    new = np.concatenate([[True], (np.diff(place) != 1) | (np.diff(row) != 0) | (np.diff(shift) != 0)])
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(place)) - 1
    return place[begin], place[last] - place[begin] + length[last]


def _contaminated(n_hit, n_words, per: int):
    return (n_hit > 0) & (per * n_hit >= n_words)


def _digest(items: set) -> str:
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()


def _report(block, per: int):
    def run(batches):
        for batch in batches:
            data, off = vt.text_buffer(batch.column("text"))
            for a, b in vt.slices(off, _RUN_BYTES):
                n, hit, items, longest, at, spans = _judge(data[off[a]:off[b]], off[a:b + 1] - off[a], block.value)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(a, b - a), pa.array(n, pa.int64()), pa.array(hit, pa.int64()),
                    pa.array([len(x) for x in items], pa.int64()), pa.array([_digest(x) for x in items]),
                    pa.array(_contaminated(hit, n, per)), pa.array(longest, pa.int64()), pa.array(at, pa.int64(), mask=longest == 0)],
                    ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest", "longest_at"])
    return run


def _keep_clean(block, per: int):
    def run(batches):
        for batch in batches:
            data, off = vt.text_buffer(batch.column("text"))
            for a, b in vt.slices(off, _RUN_BYTES):
                n, hit, *_ = _judge(data[off[a]:off[b]], off[a:b + 1] - off[a], block.value)
                yield batch.slice(a, b - a).filter(pa.array(~_contaminated(hit, n, per)))
    return run


def _mark(block, number: int):
    """For several blocks: row key, words, stretches and items of one block."""
    def run(batches):
        for batch in batches:
            data, off = vt.text_buffer(batch.column("text"))
            for a, b in vt.slices(off, _RUN_BYTES):
                n, _, items, longest, at, spans = _judge(data[off[a]:off[b]], off[a:b + 1] - off[a], block.value)
                pick = [i for i in range(b - a) if number == 0 or spans[i]]
                yield pa.RecordBatch.from_arrays([
                    batch.column("row_key").slice(a, b - a).take(pa.array(pick, pa.int64())), pa.array(n[pick], pa.int64()),
                    pa.array([[{"s": x, "e": y} for x, y in spans[i]] for i in pick],
                             pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))),
                    pa.array([sorted(map(str, items[i])) for i in pick], pa.list_(pa.string())),
                    pa.array(longest[pick], pa.int64()), pa.array(at[pick], pa.int64())],
                    ["row_key", "n_words", "spans", "items", "longest", "longest_at"])
    return run


def _blocks(benchmark: DataFrame, size: int, block_bytes: int):
    """Windows of the benchmark in blocks of bounded size, as broadcasts."""
    spark = benchmark.sparkSession
    total = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-total // block_bytes) or 1
    for i in range(count):
        part = benchmark.select("item_id", "text").where(F.pmod(F.xxhash64("item_id"), F.lit(count)) == i)
        yield count, spark.sparkContext.broadcast(windows_of(part.toArrow(), size))


def contamination(docs: DataFrame, benchmark: DataFrame, per: int = 20, size: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated (hit words are at least one in ``per``), longest match in
    words and the word at which it begins."""
    rows = _judged(docs, benchmark, per, size, block_bytes)
    if "row_key" not in rows.columns:
        return rows
    return (rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select(F.col("row_key.doc_id").alias("doc_id"), "n_words", "n_hit", "n_items", "items_sha256", "contaminated",
                    "longest", "longest_at"))


def _judged(docs: DataFrame, benchmark: DataFrame, per: int, size: int, block_bytes: int) -> DataFrame:
    """Rows of ``contamination``; for several blocks a row per row_key (id and
    hashes of the text) with its number of copies."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    marks = None
    for i, (count, block) in enumerate(_blocks(benchmark, size, block_bytes)):
        if count == 1:
            return docs.select("doc_id", "text").mapInArrow(_report(block, per), f"doc_id {kind}, n_words long, "
                   "n_hit long, n_items long, items_sha256 string, contaminated boolean, longest long, longest_at long")
        keyed = docs.select(F.struct("doc_id", F.xxhash64("text").alias("x"), F.crc32("text").alias("y")).alias("row_key"), "text")
        part = keyed.mapInArrow(_mark(block, i), f"row_key struct<doc_id:{kind},x:bigint,y:bigint>, n_words long, "
                                "spans array<struct<s:bigint,e:bigint>>, items array<string>, longest long, longest_at long")
        part = part if i else part.withColumn("copies", F.lit(1))
        marks = part if marks is None else marks.unionByName(part, allowMissingColumns=True)
    # union of the stretches: sort by start, extend or add
    merged = F.aggregate(F.array_sort("spans"), F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
                         lambda acc, x: F.struct((acc.n + F.greatest(F.lit(0), x.e - F.greatest(acc.to, x.s))).alias("n"),
                                                 F.greatest(acc.to, x.e).alias("to")))
    best = F.max(F.struct("longest", (-F.col("longest_at")).alias("at")))
    return (marks.groupBy("row_key").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_set("spans")).alias("spans"),
                                         F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"), best.alias("best"),
                                         F.sum("copies").alias("copies"))
            .withColumn("n_hit", merged.n)
            .select("row_key", "copies", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
                    ((F.col("n_hit") > 0) & (per * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
                    F.col("best.longest").alias("longest"),
                    F.when(F.col("best.longest") > 0, -F.col("best.at")).alias("longest_at")))


def remove(docs: DataFrame, benchmark: DataFrame, per: int = 20, size: int = WINDOW,
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns as they are.
    Every row is judged by its own text, whatever its id."""
    first = next(_blocks(benchmark, size, block_bytes))
    if first[0] == 1:
        return docs.mapInArrow(_keep_clean(first[1], per), docs.schema)
    bad = (_judged(docs, benchmark, per, size, block_bytes).where("contaminated")
           .select(F.col("row_key.doc_id").alias("bad_id"), F.col("row_key.x").alias("bad_x"), F.col("row_key.y").alias("bad_y")))
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["bad_id"]) & (F.xxhash64(docs["text"]) == bad["bad_x"])
                     & F.crc32(docs["text"]).eqNullSafe(bad["bad_y"]), "left_anti")
