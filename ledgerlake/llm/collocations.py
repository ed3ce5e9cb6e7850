"""Phrases whose words occur together, from truncated suffix trees of words.

Per language, a phrase of 2 to ``longest`` words is a candidate when it occurs
at least ``least`` times inside pieces of text.  Cut into two parts, its score
is floor(1000 a n / (l r)); the lowest cut counts.  Candidates that lie inside
a longer one which occurs (nearly) as often are dropped.

Method (vertical partitioning).  Words are counted; pieces are cut at words
that occur fewer than ``least`` times, which no candidate holds.  Word
prefixes are partitioned by a memory budget: a word that begins more suffixes
than ``budget`` is extended by a word, its pairs are counted, and so on; the
remaining prefixes fill groups of at most ``budget`` suffixes.  Every run of
text sends each group its suffixes, truncated at ``longest`` words, sorted and
with equal ones combined.  A group builds its part of the suffix tree on its
own by sorting; the count of a node is the sum of its leaves.  Nodes down to
the prefix itself were counted while partitioning.

Words are numbers: the most frequent ``HEAD`` by rank, all others by hash.
The word counts show whether a frequent word shares its hash; then another
seed is taken, so counts are exact.

Scale.  Suffixes move once, packed (a few bytes a word); everything after the
groups is a table of phrases that occur ``least`` times or more.  Broadcast
are the head, a bit filter of fixed size, the prefixes over budget (at most
the number of words / ``budget`` a level, and the budget grows where there
were over 2^19 of them) and at most 2^22 group numbers.

Defined results: a null lang counts as ``und``; null, empty and wordless texts
add nothing; a table without candidates gives an empty one; repeated rows are
all counted; very long texts and words have no limit; ties are ordered by the
phrase's bytes; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import hashfilter
from ledgerlake.llm import vectext as vt
from ledgerlake.llm import wordcounts as wc
from ledgerlake.llm.components import written

HEAD = 1 << 20
#: Suffixes of a group: 5 numbers of 8 bytes each, sorted in one task.
BUDGET = 1 << 20
_BUCKETS = 1 << 22
_SALTS = 64

PIECES = np.zeros(256, dtype=bool)
PIECES[list(b".,;:!?\n\x0b\x0c\r")] = True
WORDS = ~PIECES
WORDS[[0x20, 9]] = False


def _part(name: str, seed: int) -> np.uint64:
    return np.frombuffer(hashlib.blake2b(f"{seed}:{name}".encode(), digest_size=8).digest(), np.uint64)[0]


def _runs(batches, seed: int):
    """Words of runs: batch rows, text, spans, hashes by language, and whether
    a word begins a piece."""
    for batch in batches:
        data, off = vt.text_buffer(batch.column("text"))
        codes = batch.column("lang").dictionary_encode()
        salt = np.array([_part(x, seed) for x in codes.dictionary.to_pylist()], np.uint64)[codes.indices.to_numpy()]
        for a, b in vt.slices(off, wc.RUN_BYTES):
            text = data[off[a]:off[b]]
            start, end, first = vt.word_spans(text, off[a:b + 1] - off[a], WORDS)
            row = np.repeat(np.arange(a, b), np.diff(first))
            h = vt.mix(wc.hash_words(text, start, end, seed) ^ salt[row]) | np.uint64(1)
            marks = np.concatenate([[0], np.cumsum(PIECES[text])])
            begins = np.ones(len(start), dtype=bool)
            begins[1:] = (marks[start[1:]] != marks[end[:-1]]) | (row[1:] != row[:-1])
            yield batch, text, start, end, row, h, begins


def _count(seed: int):
    def run(batches):
        for batch, text, start, end, row, h, _ in _runs(batches, seed):
            key, at, n = wc.distinct(h)
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang").take(pa.array(row[at])), pa.array(key.view(np.int64)),
                 wc.word_strings(text, start[at], end[at]), pa.array(n, pa.int64())], ["lang", "h", "word", "n"])
    return run


class Plan:
    """What a task must know: frequent words, head ranks, prefixes over
    budget by level (sorted hashes), and the group of every bucket."""

    def __init__(self, frequent: hashfilter.BitFilter, head: np.ndarray, longest: int):
        self.frequent, self.longest = frequent, longest
        self.rank = np.argsort(head).astype(np.uint64)  # of the sorted hashes
        self.head = head[np.argsort(head)]
        self.heavy: list[np.ndarray] = []
        self.groups = np.zeros(1, np.int32)

    def values(self, h: np.ndarray) -> np.ndarray:
        """Even numbers for head words, their (odd) hashes for all others."""
        if not len(self.head):
            return h
        at = np.minimum(np.searchsorted(self.head, h), len(self.head) - 1)
        return np.where(self.head[at] == h, (self.rank[at] + np.uint64(1)) << np.uint64(1), h)

    def bucket(self, prefix: np.ndarray) -> np.ndarray:
        return (prefix >> np.uint64(40)).astype(np.int64) % len(self.groups)

    def suffixes(self, h: np.ndarray, begins: np.ndarray):
        """Suffixes of frequent words: numbers [longest, n] with 0 beyond the
        piece, how many words they have, and the hash of every prefix."""
        ok = self.frequent.passes(h)
        begins = begins.copy()
        begins[1:] |= ~ok[:-1]
        at = np.flatnonzero(ok)
        h, piece = h[at], np.cumsum(begins)[at]
        value = self.values(h)
        n = len(h)
        words = np.zeros((self.longest, n), np.uint64)
        prefix = np.zeros((self.longest, n), np.uint64)
        depth = np.zeros(n, np.int64)
        for d in range(self.longest):
            same = np.zeros(n, dtype=bool)
            same[:n - d] = piece[d:] == piece[:n - d]
            words[d, :n - d] = np.where(same[:n - d], value[d:], 0)
            depth += same
            if d == 0:
                prefix[0] = h
            else:
                prefix[d, :n - d] = vt.mix(prefix[d - 1, :n - d] * vt._M1 + h[d:])
        return words, depth, prefix

    def over(self, prefix: np.ndarray, level: int) -> np.ndarray:
        """Whether prefixes of level + 1 words are over budget."""
        heavy = self.heavy[level]
        if not len(heavy):
            return np.zeros(len(prefix), dtype=bool)
        at = np.minimum(np.searchsorted(heavy, prefix), len(heavy) - 1)
        return heavy[at] == prefix


def _equal(words: np.ndarray) -> np.ndarray:
    """Where a column of sorted suffixes differs from the one before."""
    new = np.ones(words.shape[1], dtype=bool)
    new[1:] = (words[:, 1:] != words[:, :-1]).any(axis=0)
    return new


def _count_prefixes(plan, seed: int, size: int):
    """Prefixes of ``size`` words whose first size - 1 words are over budget."""
    def run(batches):
        for *_, h, begins in _runs(batches, seed):
            p = plan.value
            words, depth, prefix = p.suffixes(h, begins)
            pick = depth >= size
            for level in range(size - 1):
                pick &= p.over(prefix[level], level)
            words, prefix = words[:size, pick], prefix[size - 1, pick]
            order = np.lexsort(words[::-1])
            words, prefix = words[:, order], prefix[order]
            first = np.flatnonzero(_equal(words)) if len(prefix) else np.zeros(0, np.int64)
            w = pa.ListArray.from_arrays(pa.array(np.arange(0, size * len(first) + 1, size), pa.int32()),
                                         pa.array(words[:, first].T.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays([w, pa.array(prefix[first].view(np.int64)),
                                              pa.array(np.diff(np.append(first, len(prefix))), pa.int64())], ["w", "prefix", "n"])
    return run


def _send(plan, seed: int):
    """Sorted, combined suffixes of every run, packed by group."""
    def run(batches):
        for *_, h, begins in _runs(batches, seed):
            p = plan.value
            words, depth, prefix = p.suffixes(h, begins)
            elastic, key = np.ones(len(depth), np.int64), prefix[0].copy() if len(prefix) else None
            still = np.ones(len(depth), dtype=bool)
            for level, heavy in enumerate(p.heavy):
                still &= p.over(prefix[level], level)
                if level + 1 < p.longest:
                    elastic[still] += 1
                    key[still] = prefix[level + 1, still]
            pick = (depth > elastic) & (depth > 1)
            words, elastic = words[:, pick], elastic[pick]
            group = p.groups[p.bucket(key[pick])]
            order = np.lexsort((*words[::-1], group))
            words, elastic, group = words[:, order], elastic[order], group[order]
            if not len(group):
                continue
            first = np.flatnonzero(_equal(words) | np.concatenate([[True], np.diff(group) != 0]))
            n = np.diff(np.append(first, len(group)))
            words, elastic, group = words[:, first], elastic[first], group[first]
            edge = np.append(np.flatnonzero(np.concatenate([[True], np.diff(group) != 0])), len(group))
            packs = []
            for a, b in zip(edge[:-1], edge[1:]):
                raw = b"".join([n[a:b].astype(np.uint32).tobytes(), elastic[a:b].astype(np.uint32).tobytes(), words[:, a:b].tobytes()])
                packs.append(pa.compress(raw, codec="zstd", asbytes=True))
            yield pa.RecordBatch.from_arrays([pa.array(group[edge[:-1]], pa.int32()), pa.array(np.diff(edge), pa.int32()),
                                              pa.array(packs, pa.binary())], ["grp", "size", "pack"])
    return run


def _tree(longest: int, least: int):
    """Nodes below the prefixes of one group, with the sums of their leaves."""
    def build(table: pa.Table) -> pa.Table:
        parts = []
        for size, pack in zip(table.column("size").to_pylist(), table.column("pack").to_pylist()):
            raw = pa.decompress(pack, decompressed_size=size * 8 * (longest + 1), codec="zstd", asbytes=True)
            counts = np.frombuffer(raw, np.uint32, 2 * size).reshape(2, size)
            parts.append((np.frombuffer(raw, np.uint64, offset=8 * size).reshape(longest, size), counts))
        words = np.concatenate([p[0] for p in parts], axis=1)
        counts = np.concatenate([p[1] for p in parts], axis=1)
        order = np.lexsort(words[::-1])
        words, n, elastic = words[:, order], counts[0][order].astype(np.int64), counts[1][order]
        new = np.ones(words.shape[1], dtype=bool)
        new[1:] = words[0, 1:] != words[0, :-1]
        lists, sums = [], []
        for d in range(2, longest + 1):
            new[1:] |= words[d - 1, 1:] != words[d - 1, :-1]
            first = np.flatnonzero(new)
            total = np.add.reduceat(n, first)
            keep = (words[d - 1, first] != 0) & (elastic[first] < d) & (total >= least)
            lists += words[:d, first[keep]].T.view(np.int64).tolist()
            sums.append(total[keep])
        return pa.table({"w": pa.array(lists, pa.list_(pa.int64())), "f": pa.array(np.concatenate(sums), pa.int64())})
    return build


def _valued(plan):
    """Adds its number to every frequent word."""
    def run(batches):
        for batch in batches:
            h = batch.column("h").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(plan.value.values(h).view(np.int64)), batch.column("lang"),
                                              batch.column("word"), batch.column("f")], ["value", "lang", "word", "f"])
    return run


def _vocabulary(texts: DataFrame, least: int):
    """(seed, words with f >= least, all words by language): the first seed
    for which no frequent hash is shared."""
    spark = texts.sparkSession
    for seed in range(100):
        words = written(spark, texts.mapInArrow(_count(seed), "lang string, h long, word string, n long")
                        .groupBy("lang", "h", "word").agg(F.sum("n").alias("n")), "phrase-words")
        frequent = written(spark, words.groupBy("h").agg(
            F.sum("n").alias("f"), F.min("lang").alias("lang"), F.min("word").alias("word"), F.count("*").alias("kinds"))
            .where(F.col("f") >= least), "phrase-frequent")
        if frequent.where("kinds > 1").isEmpty():
            return seed, frequent.drop("kinds"), words.groupBy("lang").agg(F.sum("n").alias("n"))
    raise RuntimeError("no seed without shared hashes")


def phrase_counts(docs: DataFrame, longest: int = 5, least: int = 100, budget: int = BUDGET, head_most: int = HEAD):
    """(phrases, words, languages): phrases (w: array of word numbers, f) of 2
    to ``longest`` words that occur ``least`` times; words (value, lang, word,
    f); languages (lang, n)."""
    spark = docs.sparkSession
    context = spark.sparkContext
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    seed, frequent, languages = _vocabulary(texts, least)
    languages = written(spark, languages, "phrase-languages")
    total = frequent.agg(F.sum("f")).first()[0] or 0
    budget = max(budget, total >> 19)
    head = frequent.orderBy(F.desc("f"), "h").limit(head_most).select("h").toArrow().column("h").to_numpy()
    words_of = hashfilter.BitFilter(written(spark, hashfilter.bit_words(frequent, "h"), "phrase-filter"))
    plan = Plan(words_of, head.astype(np.int64).view(np.uint64), longest)
    # partition: extend prefixes over budget word by word
    counted, size = [frequent.select(F.col("h").alias("prefix"), F.col("f").alias("n"))], 1
    known = None
    while size < longest:
        heavy = counted[-1].where(F.col("n") > budget).groupBy("prefix").agg(F.sum("n")).select("prefix").toArrow()
        if not heavy.num_rows:
            break
        plan.heavy.append(np.sort(heavy.column("prefix").to_numpy().astype(np.int64).view(np.uint64)))
        size += 1
        level = written(spark, texts.mapInArrow(_count_prefixes(context.broadcast(plan), seed, size),
                                                "w array<long>, prefix long, n long")
                        .groupBy("w", "prefix").agg(F.sum("n").alias("n")), "phrase-prefixes")
        counted.append(level.select("prefix", "n"))
        nodes = level.where(F.col("n") >= least).select("w", F.col("n").alias("f"))
        known = nodes if known is None else known.unionByName(nodes)
    # groups: consecutive buckets of prefixes within the budget
    many = int(min(_BUCKETS, 8 * (total // budget + 1)))
    plan.groups = np.zeros(many, np.int32)
    light = None
    for df in counted:
        part = df.where(F.col("n") <= budget)
        light = part if light is None else light.unionByName(part)
    loads = (light.groupBy(F.pmod(F.shiftrightunsigned("prefix", 40), F.lit(many)).alias("bucket"))
             .agg(F.sum("n").alias("n")).toArrow())
    load = np.zeros(many, np.int64)
    load[loads.column("bucket").to_numpy().astype(np.int64)] = loads.column("n").to_numpy()
    number, held = 0, 0
    for i, n in enumerate(load.tolist()):
        if held and held + n > budget:
            number, held = number + 1, 0
        plan.groups[i], held = number, held + n
    ready = context.broadcast(plan)
    trees = (texts.mapInArrow(_send(ready, seed), "grp int, size int, pack binary").groupBy("grp")
             .applyInArrow(_tree(longest, least), "w array<long>, f long"))
    phrases = written(spark, trees if known is None else trees.unionByName(known), "phrases")
    kinds = "value long, lang string, word string, f long"
    words = written(spark, frequent.select("h", "lang", "word", "f").mapInArrow(_valued(ready), kinds), "phrase-dictionary")
    return phrases, words, languages


def collocations(docs: DataFrame, longest: int = 5, least: int = 100, top: int = 2000, inside: tuple[int, int] = (100, 100),
                 budget: int = BUDGET, head_most: int = HEAD) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n,
    score.  A candidate inside a longer one with inside[0] * f(longer) >=
    inside[1] * a is dropped."""
    spark = docs.sparkSession
    phrases, words, languages = phrase_counts(docs, longest, least, budget, head_most)
    counts = phrases.unionByName(words.select(F.array("value").alias("w"), "f"))
    cuts = phrases.select("w", F.col("f").alias("a"), F.explode(F.expr("sequence(1, size(w) - 1)")).alias("k"))
    cuts = cuts.select("w", "a", "k", F.expr("slice(w, 1, k)").alias("head"), F.expr("slice(w, k + 1, size(w) - k)").alias("tail"))
    cuts = (cuts.join(counts.select(F.col("w").alias("head"), F.col("f").alias("l")), "head")
            .join(counts.select(F.col("w").alias("tail"), F.col("f").alias("r")), "tail"))
    named = words.join(languages, "lang").select(F.col("value").alias("first"), "lang", "n")
    cuts = cuts.withColumn("first", F.col("w")[0]).join(named, "first")
    # up to 38 digits, so products are exact
    cuts = cuts.withColumn("score", F.expr("(cast(1000 as decimal(4,0)) * cast(a as decimal(16,0)) * cast(n as decimal(17,0))) "
                                           "div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))"))
    scored = cuts.groupBy("lang", "n", "w", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # f falls as a phrase grows, so one word more on either side decides
    longer = phrases.where("size(w) > 2").select("f", F.explode(F.array(
        F.expr("slice(w, 1, size(w) - 1)"), F.expr("slice(w, 2, size(w) - 1)"))).alias("w"))
    longer = longer.groupBy("w").agg(F.max("f").alias("longer"))
    scored = (scored.join(longer, "w", "left").where(F.coalesce(F.col("longer") * inside[0] < F.col("a") * inside[1], F.lit(True)))
              .select("lang", "n", "w", "a", "cut.score", "cut.l", "cut.r"))
    # a language may have most of the candidates: first within parts of it
    scored = scored.withColumn("salt", F.pmod(F.xxhash64("w"), F.lit(_SALTS)))
    scored = written(spark, scored.withColumn("place", F.expr(
        "rank() over (partition by lang, salt order by score desc, a desc)")).where(F.col("place") <= top).drop("place"), "phrase-top")
    spelt = (scored.select("w", F.posexplode("w").alias("pos", "value")).join(words.select("value", "word"), "value")
             .groupBy("w").agg(F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("words"))
             .select("w", F.array_join("words.word", " ").alias("phrase")))
    by = "order by score desc, a desc, phrase"
    named = (scored.join(spelt, "w").withColumn("place", F.expr(f"row_number() over (partition by lang, salt {by})"))
             .where(F.col("place") <= top))
    return (named.withColumn("rank", F.expr(f"row_number() over (partition by lang {by})").cast("long")).where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
