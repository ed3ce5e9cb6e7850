"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics (length, character classes, repetition of words, word sequences and
lines, word and line shapes) come from one numpy pass over the UTF-8 bytes of
whole texts.  Bin edges are quantiles over all teaching rows; the trees are
grown on histograms of binned statistics and flattened into arrays, so that a
batch of documents walks all trees with array indexing.

Scale: the text is read once and never shuffled; only the statistics (a few
dozen numbers a document) meet the labels.  Trees are fitted on at most
``TEACH_MOST`` teaching rows, chosen by a hash of the id.

Defined results: null and empty texts have statistics 0 and get a score like
any other text; repeated labels of a document count as their mean; without
usable labels every score is 0.5; repeated and null ids are separate rows;
``keep_good`` passes all columns through as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import vectext as vt
from ledgerlake.llm.components import written

TEACH_MOST = 50_000
BINS = 64
_RUN_BYTES = 2 << 20

# classes of bytes
_LOWER, _UPPER, _DIGIT, _SPACE, _LINE, _STOP, _WIDE, _OTHER = range(8)
_CLASS = np.full(256, _OTHER, dtype=np.int8)
_CLASS[0x61:0x7B], _CLASS[0x41:0x5B], _CLASS[0x30:0x3A], _CLASS[0x80:] = _LOWER, _UPPER, _DIGIT, _WIDE
_CLASS[[0x20, 9, 11, 12, 13]], _CLASS[10] = _SPACE, _LINE
_CLASS[[ord(c) for c in ".,;:'\"!?()-"]] = _STOP
_LINES = np.ones(256, dtype=bool)
_LINES[10] = False

FEATURES = ["bytes", "words", "word_bytes", "upper", "digit", "space", "line", "stop", "wide", "other", "distinct_words",
            "top_word", "word_repeats", "distinct_shingles", "top_shingle", "lines", "distinct_lines", "line_words",
            "word_ends_other", "word_all_other", "word_begins_upper", "words_short", "words_long"]


def _share(a, b):
    return a / np.maximum(b, 1)


def _distinct(values: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row: number of distinct values, and rows of the commonest one."""
    rows = len(off) - 1
    distinct, top = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    if not len(values):
        return distinct, top
    of = np.repeat(np.arange(rows, dtype=np.uint64), np.diff(off))
    bits = np.uint64(max(1, int(rows).bit_length()))
    key = np.sort((of << (np.uint64(64) - bits)) | (values >> bits))
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(begin, len(key)))
    row = (key[begin] >> (np.uint64(64) - bits)).astype(np.int64)
    distinct = np.bincount(row, minlength=rows)
    np.maximum.at(top, row, size)
    return distinct, top


def statistics(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Statistics [rows, features] of the texts in a buffer."""
    rows = len(off) - 1
    size = np.diff(off)
    # bytes of each class by their places, one class at a time
    kind = _CLASS[data]
    kinds = np.column_stack([np.diff(np.searchsorted(np.flatnonzero(kind == c), off)) for c in range(8)])
    start, end, first = vt.word_spans(data, off, vt.SPACE_WORDS)
    n = np.diff(first)
    word = vt.word_hashes(data, start, end)
    length = end - start

    def total(x):
        run = np.concatenate([[0], np.cumsum(x)])
        return run[first[1:]] - run[first[:-1]]
    distinct, top = _distinct(word, first)
    again = np.zeros(len(word), np.int64)
    if len(word):
        again[1:] = word[1:] == word[:-1]
    shingles, so = vt.shingle_hashes(word, first, 3)
    s_distinct, s_top = _distinct(shingles, so)
    ls, le, lf = vt.word_spans(data, off, _LINES)
    lines = np.diff(lf)
    l_distinct, _ = _distinct(vt.word_hashes(data, ls, le), lf)
    ends_other = (_CLASS[data[end - 1]] == _OTHER) if len(word) else np.zeros(0)
    others = np.flatnonzero(kind == _OTHER)
    only = (np.searchsorted(others, end) - np.searchsorted(others, start)) == length if len(word) else np.zeros(0)
    begins = (_CLASS[data[start]] == _UPPER) if len(word) else np.zeros(0)
    share = _share(kinds, size[:, None])
    sn = np.diff(so)
    return np.column_stack([
        np.log1p(size), np.log1p(n), _share(total(length), n), share[:, _UPPER], share[:, _DIGIT], share[:, _SPACE],
        share[:, _LINE], share[:, _STOP], share[:, _WIDE], share[:, _OTHER], _share(distinct, n), _share(top, n),
        _share(total(again), n), _share(s_distinct, sn), _share(s_top, sn), np.log1p(lines), _share(l_distinct, lines),
        np.log1p(_share(n, lines)), _share(total(ends_other), n), _share(total(only), n), _share(total(begins), n),
        _share(total(length <= 3), n), _share(total(length > 20), n)]).astype(np.float32)


@dataclass
class Trees:
    """Complete binary trees of one depth as arrays: inner node i of a tree
    sends a row to 2 i + 1 + (value > threshold); leaves are numbered on."""

    depth: int
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        row = np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[row, feature[node]] > threshold[node])
            out += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def grow(x: np.ndarray, y: np.ndarray, edges: list[np.ndarray], trees: int = 80, depth: int = 4, rate: float = 0.15,
         least: float = 2.0, ridge: float = 1.0) -> Trees:
    """Boost logistic loss; every split comes from histograms of the binned
    statistics, all nodes of a level at once."""
    n, f = x.shape
    prior = np.clip((y.sum() + 0.5) / (n + 1), 1e-3, 1 - 1e-3)
    base = float(np.log(prior / (1 - prior)))
    binned = np.column_stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(f)])
    column = binned + np.arange(f) * BINS
    inner, margin = 2 ** depth - 1, np.full(n, base)
    features, thresholds, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf, np.float32)
        cut = np.full(inner, BINS)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            key = ((node - first)[:, None] * (f * BINS) + column).ravel()
            hist_g = np.bincount(key, np.repeat(g, f), width * f * BINS).reshape(width, f, BINS).cumsum(axis=2)
            hist_h = np.bincount(key, np.repeat(h, f), width * f * BINS).reshape(width, f, BINS).cumsum(axis=2)
            all_g, all_h = hist_g[:, :1, -1:], hist_h[:, :1, -1:]
            right_g, right_h = all_g - hist_g, all_h - hist_h
            gain = hist_g ** 2 / (hist_h + ridge) + right_g ** 2 / (right_h + ridge) - all_g ** 2 / (all_h + ridge)
            gain[(hist_h < least) | (right_h < least)] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            for i, b in enumerate(best):
                j, c = divmod(int(b), BINS)
                if gain[i, j, c] > 1e-6 and c < len(edges[j]):
                    feature[first + i], cut[first + i], threshold[first + i] = j, c, edges[j][c]
            node = 2 * node + 1 + (binned[np.arange(n), feature[node]] > cut[node])
        leaf_of = node - inner
        sum_g = np.bincount(leaf_of, g, 2 ** depth)
        leaf = rate * sum_g / (np.bincount(leaf_of, h, 2 ** depth) + ridge)
        margin += leaf[leaf_of]
        features.append(feature)
        thresholds.append(threshold)
        leaves.append(leaf)
    return Trees(depth, np.array(features), np.array(thresholds), np.array(leaves), base)


def _measure(batches):
    for batch in batches:
        data, off = vt.text_buffer(batch.column("text"))
        for a, b in vt.slices(off, _RUN_BYTES):
            x = statistics(data[off[a]:off[b]], off[a:b + 1] - off[a])
            values = vt.list_array(x.ravel(), np.arange(b - a + 1) * x.shape[1], pa.float32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), values], ["doc_id", "x"])


def fit(measured: DataFrame, labels: DataFrame, learn: str, most: int = TEACH_MOST) -> Trees | None:
    """Trees from the labelled rows of ``measured`` (doc_id, x) that meet
    ``learn`` (an SQL condition on doc_id); None without usable labels."""
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.avg("quality").alias("y"))
    teach = measured.where(learn).join(known, "doc_id")
    grid = [i / BINS for i in range(1, BINS)]
    edges_of = [F.percentile_approx(F.col("x")[j], grid, 2000).alias(f"e{j}") for j in range(len(FEATURES))]
    found = teach.agg(F.count("*").alias("n"), *edges_of).first()
    if not found.n:
        return None
    edges = [np.unique(np.array(found[f"e{j}"], dtype=np.float32)) for j in range(len(FEATURES))]
    chosen = teach.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int((1 << 20) * min(1.0, most / found.n)) + 1)
    table = chosen.select("doc_id", "y", "x").toArrow()
    x = table.column("x").combine_chunks()
    x = x.flatten().to_numpy().reshape(-1, len(FEATURES))
    order = np.lexsort((x[:, 0], table.column("doc_id").to_numpy()))  # the same trees on every run
    return grow(x[order], table.column("y").to_numpy()[order], edges)


def _judge(trees):
    def run(batches):
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(-1, len(FEATURES))
            score = trees.value.score(x)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score),
                                              pa.array((score >= 0.5).astype(np.int32))],
                                             ["doc_id", "held_out", "score", "predicted"])
    return run


def _keep(trees, least: float):
    def run(batches):
        for batch in batches:
            data, off = vt.text_buffer(batch.column("text"))
            for a, b in vt.slices(off, _RUN_BYTES):
                score = trees.value.score(statistics(data[off[a]:off[b]], off[a:b + 1] - off[a]))
                yield batch.slice(a, b - a).filter(pa.array(score >= least))
    return run


def measure(docs: DataFrame) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    return written(docs.sparkSession, docs.select("doc_id", "text").mapInArrow(_measure, f"doc_id {kind}, x array<float>"),
                   "doc-statistics")


def score_quality(docs: DataFrame, labels: DataFrame, learn: str) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    measured = measure(docs)
    trees = fit(measured, labels, learn)
    held = measured.withColumn("held_out", ~F.coalesce(F.expr(learn), F.lit(True)))
    if trees is None:
        return held.select("doc_id", "held_out", F.lit(0.5).alias("score"), F.lit(1).alias("predicted"))
    return held.mapInArrow(_judge(docs.sparkSession.sparkContext.broadcast(trees)),
                           f"doc_id {kind}, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, labels: DataFrame, learn: str = "true", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``least``, all columns as they are."""
    trees = fit(measure(docs), labels, learn)
    if trees is None:
        return docs
    return docs.mapInArrow(_keep(docs.sparkSession.sparkContext.broadcast(trees), least), docs.schema)
