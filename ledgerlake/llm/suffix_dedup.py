"""Removal of repeated passages with longest-previous-factor arrays.

A byte is repeated when a string of ``length`` bytes that covers it also
starts somewhere else.  ``keep_first=True`` takes earlier matches only, so the
first copy of a passage stays; ``keep_first=False`` takes earlier and later
ones, so that every copy goes.

Method.  Every string of ``length`` bytes has an anchor: its leftmost gram
with the least hash.  Equal strings have equal anchors at the same place, so
suffixes that share ``length`` bytes meet in the group of one anchor gram.
The starts that share an anchor are one stretch; equal stretches are one
class, whose further copies match its first one whole.  In every group with
several classes the texts of the classes (first occurrences, in the order of
the documents) get a suffix array, sorted to a depth of ``length`` bytes.  The
previous and the next smaller position in suffix order are the two candidates
for the longest earlier match, and likewise the next and previous greater
position for a later one; a start is repeated where such a match has
``length`` bytes.

Scale.  Only hashes are shuffled for all documents: a count per anchor gram
leaves out grams that occur once.  Text moves twice: documents with a stretch
in a group of several classes, then documents with something to remove, both
chosen by a filter of fixed size; all others stay where they are.  Groups are
packed into suffix arrays of half a MB.  A gram with more than ``GROUP_MOST``
classes is split by the place of the gram in the string and, with it, by more
bytes around the gram, until one start is left, where a group has one class.

Defined results: null and empty texts have nothing to remove; texts shorter
than ``length`` neither; very long texts are read in overlapping blocks and
have no other limit; rows that repeat a doc_id are separate documents, a null
doc_id comes first in the order; rows that repeat doc_id and text are copies
of one another for ``keep_first=False`` and one document (all kept alike) for
``keep_first=True``; an empty table gives an empty one; other columns are not
read, whatever their names.  Matches never cross documents.  Equality of whole
stretches is taken from 128 bits of hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import hashfilter
from ledgerlake.llm import vectext as vt
from ledgerlake.llm.components import join_classes, written

LENGTH = 400
GRAM = 64
#: Classes of one group that are sorted together; larger groups are split.
GROUP_MOST = 2048
_RUN_BYTES = 1 << 20
#: Text of one suffix array, but for a single larger group.
_SORT_BYTES = 1 << 19
_PLACE = np.uint64((1 << 23) - 1)  # a run and one string have fewer bytes than that

_bytes = np.arange(1, 257, dtype=np.uint64)
_VALUES = [vt.mix(_bytes * vt._GOLD), vt.mix(_bytes * np.uint64(0xD1342543DE82EF95))]


class Hashes:
    """Hashes of any stretch of a buffer, from prefix sums."""

    def __init__(self, data: np.ndarray, kinds: int = 2):
        power, self.inverse = vt._powers(len(data) + 1)
        self.sums = []
        for value in _VALUES[:kinds]:
            total = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(value[data] * power[:len(data)], out=total[1:])
            self.sums.append(total)

    def of(self, start: np.ndarray, end: np.ndarray, kind: int = 0) -> np.ndarray:
        total = self.sums[kind]
        return vt.mix((total[end] - total[start]) * self.inverse[start] + (end - start).astype(np.uint64) * vt._GOLD)

    def grams(self, size: int) -> np.ndarray:
        total = self.sums[0]
        n = len(total) - size
        return vt.mix((total[size:] - total[:n]) * self.inverse[:n])


def _blocks(off: np.ndarray, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(first row, row after the last, first byte, byte after the last) of
    runs; a longer text comes in blocks that overlap by length - 1 bytes."""
    for a, b in vt.slices(off, _RUN_BYTES):
        lo, hi = int(off[a]), int(off[b])
        if hi - lo <= _RUN_BYTES:
            yield a, b, lo, hi
        else:
            for at in range(lo, hi, _RUN_BYTES):
                yield a, b, at, min(at + _RUN_BYTES + length - 1, hi)


def stretches(data: np.ndarray, off: np.ndarray, hashes: Hashes, length: int, gram: int):
    """Row, anchor, first and last start of every stretch of starts."""
    n, many = len(data), length - gram + 1
    if n < length:
        return (np.zeros(0, np.int64),) * 4
    key = hashes.grams(gram)
    key &= ~_PLACE
    key |= np.arange(len(key), dtype=np.uint64)
    # least key of every run of `many` grams, from running minima of blocks
    pad = np.full(-len(key) % many, ~np.uint64(0))
    tiles = np.concatenate([key, pad]).reshape(-1, many)
    q = n - length + 1
    least = np.minimum(np.minimum.accumulate(tiles[:, ::-1], axis=1)[:, ::-1].reshape(-1)[:q],
                       np.minimum.accumulate(tiles, axis=1).reshape(-1)[many - 1:many - 1 + q])
    anchor = (least & _PLACE).astype(np.int32)
    # starts whose string would leave the document
    across = np.zeros(n + 1, np.int32)
    np.add.at(across, np.maximum(off[1:] - length + 1, off[:-1]), 1)
    np.add.at(across, off[1:], -1)
    inside = np.cumsum(across[:q]) == 0
    change = anchor[1:] != anchor[:-1]
    first, last = inside.copy(), inside.copy()
    first[1:] &= change | ~inside[:-1]
    last[:-1] &= change | ~inside[1:]
    lo, hi = np.flatnonzero(first), np.flatnonzero(last)
    return np.searchsorted(off, lo, side="right") - 1, anchor[lo].astype(np.int64), lo, hi


def pieces(anchor, lo, hi, level: int, many: int):
    """Stretches cut at the fixed places of a level: (number of the stretch,
    first and last start, begin and end of the bytes that all its strings
    share, number of the part)."""
    parts = min(1 << level, many)
    j0, j1 = (anchor - hi) * parts // many, (anchor - lo) * parts // many
    count = j1 - j0 + 1
    which = np.repeat(np.arange(len(lo)), count)
    j = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(j0, count)
    near, far = -(-j * many // parts), -(-(j + 1) * many // parts) - 1
    a = anchor[which]
    return which, np.maximum(lo[which], a - far), np.minimum(hi[which], a - near), a - near, a - far, j


def _cores(hashes: Hashes, begin, end, level: int, part) -> np.ndarray:
    return vt.mix(hashes.of(begin, end) + part.astype(np.uint64) * vt._M1 + np.uint64(level))


def _runs(batches, length: int):
    for batch in batches:
        data, off = vt.text_buffer(batch.column("text"))
        for a, b, lo, hi in _blocks(off, length):
            yield batch, data[lo:hi], np.clip(off[a:b + 1] - lo, 0, hi - lo), a, lo - off[a:b]


def _count(length: int, gram: int):
    """Anchor grams of a run and how many stretches have them."""
    def run(batches):
        for _, data, off, _, _ in _runs(batches, length):
            hashes = Hashes(data, 1)
            _, anchor, _, _ = stretches(data, off, hashes, length, gram)
            core, n = np.unique(_cores(hashes, anchor, anchor + gram, 0, np.zeros(len(anchor), np.int64)), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(core.view(np.int64)), pa.array(n, pa.int64())], ["core", "n"])
    return run


def _occurrences(length: int, gram: int, wanted, hot: list):
    """Classes of a run with their places in every row: level 0 for the wanted
    grams, or the level after the last one of ``hot`` for the hot groups."""
    many = length - gram + 1

    def run(batches):
        for batch, data, off, row0, shift in _runs(batches, length):
            hashes = Hashes(data)
            row, anchor, lo, hi = stretches(data, off, hashes, length, gram)
            part = np.zeros(len(row), np.int64)
            core = _cores(hashes, anchor, anchor + gram, 0, part)
            keep = wanted.value.passes(core)
            for level, cores in enumerate(hot, 1):
                keep &= np.isin(core, cores)
                which, lo, hi, begin, end, part = pieces(anchor[keep], lo[keep], hi[keep], level, many)
                row, anchor = row[keep][which], anchor[keep][which]
                core = _cores(hashes, begin, end + length, level, part)
                keep = np.ones(len(row), dtype=bool)
            row, anchor, lo, hi, core = row[keep], anchor[keep], lo[keep], hi[keep], core[keep]
            s1 = vt.mix(hashes.of(lo, hi + length) + (anchor - lo).astype(np.uint64) * vt._M1)
            s2 = hashes.of(lo, hi + length, 1)
            at = lo + shift[row] if len(row) else lo
            order = np.lexsort((at, s2, s1, core, row))
            row, core, s1, s2, at, starts = (x[order] for x in (row, core, s1, s2, at, hi - lo + 1))
            new = np.ones(len(row), dtype=bool)
            new[1:] = (np.diff(row) != 0) | (core[1:] != core[:-1]) | (s1[1:] != s1[:-1]) | (s2[1:] != s2[:-1])
            first = np.flatnonzero(new)
            places = pa.ListArray.from_arrays(pa.array(np.append(first, len(row)), pa.int32()), pa.array(at, pa.int32()))
            take = pa.array(row[first] + row0, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[first].view(np.int64)) for x in (core, s1, s2)] + [pa.array(starts[first], pa.int32())]
                + [batch.column(c).take(take) for c in ("doc_id", "k1", "k2")] + [places],
                ["core", "s1", "s2", "starts", "doc_id", "k1", "k2", "at"])
    return run


def suffix_ranks(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array by prefix doubling to ``depth`` symbols (0 to 256) and the
    rank of every position; equal ranks share ``depth`` symbols."""
    n = len(text)
    wide = np.concatenate([text.astype(np.uint64), np.zeros(7, np.uint64)])
    key, have = np.zeros(n, np.uint64), min(7, depth)
    for j in range(have):
        key = (key << np.uint64(9)) | wide[j:j + n]
    while True:
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]])).astype(np.uint64)
        if have >= depth:
            return order, rank
        step = min(have, depth - have)
        key = rank << np.uint64(32)
        key[:max(n - step, 0)] |= rank[step:] + np.uint64(1)
        have += step


def nearest(position: np.ndarray, smaller: bool, before: bool) -> np.ndarray:
    """For an array of positions in suffix order: index of the nearest entry
    before (or after) that is smaller (or greater), -1 where there is none."""
    p = position if before else position[::-1]
    p = p if smaller else -p
    n = len(p)
    link = np.arange(-1, n - 1)
    active = np.arange(n)
    while len(active):
        active = active[link[active] >= 0]
        active = active[p[link[active]] > p[active]]
        link[active] = link[link[active]]
    return link if before else np.where(link[::-1] >= 0, n - 1 - link[::-1], -1)


def matched(text: np.ndarray, start: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether each start has an earlier, and a later, match of ``depth``
    bytes among the given starts, from the nearest smaller and greater
    positions in suffix order."""
    order, rank = suffix_ranks(text, depth)
    is_start = np.zeros(len(text), dtype=bool)
    is_start[start] = True
    place = order[is_start[order]]
    level = rank[place]
    # only suffixes with a neighbour of their rank can have a match of full depth
    same = level[1:] == level[:-1]
    some = np.zeros(len(place), dtype=bool)
    some[1:] |= same
    some[:-1] |= same
    place, level = place[some], level[some]
    out = []
    for smaller in (True, False):
        hit = np.zeros(len(place), dtype=bool)
        for before in (True, False):
            link = nearest(place, smaller, before)
            hit |= (link >= 0) & (level[link] == level)
        flag = np.zeros(len(text), dtype=bool)
        flag[place[hit]] = True
        out.append(flag[start])
    return out[0], out[1]


def _intervals(flags: np.ndarray, owner: np.ndarray, offset: np.ndarray, owners: int) -> pa.Array:
    """Stretches of flagged starts of each owner as [first, last, first, ...]."""
    at = np.flatnonzero(flags)
    new = np.ones(len(at), dtype=bool)
    new[1:] = (np.diff(at) != 1) | (np.diff(owner[at]) != 0)
    a = at[new]
    b = at[np.append(np.flatnonzero(new)[1:], len(at)) - 1] if len(at) else at
    flat = np.stack([offset[a], offset[b]], axis=1).reshape(-1)
    count = 2 * np.bincount(owner[a], minlength=owners)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]), pa.int32()), pa.array(flat, pa.int32()))


def _matches(length: int):
    """Rows of whole groups in order -> earlier and later matches of each class."""
    names = ["core", "s1", "s2", "early", "any"]

    def solve(table: pa.Table) -> pa.RecordBatch:
        data, off = vt.text_buffer(table.column("bytes"))
        size, n = np.diff(off), len(off) - 1
        # a zero after each text, bytes moved up by one
        text = np.zeros(len(data) + n, np.uint16)
        owner = np.repeat(np.arange(n), size)
        text[np.arange(len(data)) + owner] = data.astype(np.uint16) + 1
        starts = size - length + 1
        which = np.repeat(np.arange(n), starts)
        within = np.arange(int(starts.sum())) - np.repeat(np.cumsum(starts) - starts, starts)
        early, later = matched(text, (off[:-1] + np.arange(n))[which] + within, length)
        return pa.RecordBatch.from_arrays(
            [table.column(c).combine_chunks() for c in names[:3]]
            + [_intervals(x, which, within, n) for x in (early, early | later)], names)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.column("bytes").nbytes
            if size < _SORT_BYTES:
                continue
            table = pa.Table.from_batches(held)
            core = table.column("core").to_numpy()
            cut = np.flatnonzero(core[1:] != core[:-1]) + 1
            if not len(cut):
                continue
            yield from split(table.slice(0, int(cut[-1])), cut)
            held = table.slice(int(cut[-1])).to_batches()
            size = sum(b.column("bytes").nbytes for b in held)
        if held:
            table = pa.Table.from_batches(held)
            core = table.column("core").to_numpy()
            yield from split(table, np.flatnonzero(core[1:] != core[:-1]) + 1)

    def split(table: pa.Table, cut: np.ndarray):
        """Whole groups, a few MB at a time."""
        ends = np.append(cut[cut < table.num_rows], table.num_rows)
        off = vt.text_buffer(table.column("bytes"))[1]
        a = 0
        while a < table.num_rows:
            fit = ends[(ends > a) & (off[ends] - off[a] <= _SORT_BYTES)]
            b = int(fit[-1]) if len(fit) else int(ends[ends > a][0])
            yield solve(table.slice(a, b - a).combine_chunks())
            a = b
    return run


def _merged(ranges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the union of ranges [a, b, a, b, ...]."""
    pairs = ranges.reshape(-1, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1])
    new = np.ones(len(pairs), dtype=bool)
    new[1:] = pairs[1:, 0] > reach[:-1]
    return pairs[new, 0], reach[np.append(np.flatnonzero(new)[1:] - 1, len(pairs) - 1)]


def _cut(kept: bool):
    """Merges the ranges of every row and cuts them out of its bytes."""
    def run(batches):
        for batch in batches:
            data, off = vt.text_buffer(batch.column("text"))
            ranges = batch.column("ranges")
            some = ranges.is_valid().to_numpy(zero_copy_only=False)
            sizes, digests, rest, begins, ends = [], [], [], [], []
            for i in range(len(batch)):
                text, at, sha, parts = data[off[i]:off[i + 1]], 0, hashlib.sha256(), []
                a, b = _merged(ranges[i].values.flatten().to_numpy()) if some[i] else (np.zeros(0, np.int32),) * 2
                for x, y in zip([*a.tolist(), len(text)], [*b.tolist(), len(text)]):
                    sha.update(text[at:x].data)
                    if kept:
                        parts.append(text[at:x].tobytes())
                    at = y
                begins.append(a)
                ends.append(b)
                sizes.append((len(text), int((b - a).sum()), len(a)))
                digests.append(sha.hexdigest())
                rest.append(b"".join(parts))
            pair = pa.StructArray.from_arrays([pa.array(np.concatenate(x), pa.int32()) for x in (begins, ends)], ["a", "b"])
            count = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in begins])]), pa.int32())
            done = [pa.array([s[j] for s in sizes], pa.int64()) for j in range(3)] + [
                pa.array(digests, pa.string()), pa.ListArray.from_arrays(count, pair)]
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
            if kept:
                done.append(pa.array(rest, pa.binary()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *done], ["doc_id", *names])
    return run


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and two hashes that name the row by both."""
    docs = docs.select("doc_id", "text")
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("k1"),
                       F.xxhash64(F.lit("row"), "text", "doc_id").alias("k2"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, keep_first: bool = True, kept: bool = False,
                   group_most: int = GROUP_MOST) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans (maximal
    removed runs), kept_sha256 of the bytes that stay, spans (array of a, b:
    first removed byte and the one after the last) and, where asked for, the
    bytes themselves as ``kept`` (binary, as a cut may part a character)."""
    spark = docs.sparkSession
    gram = min(gram, length)
    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = _keyed(docs)
    ranges = written(spark, _ranges(keyed, kind, length, gram, keep_first, group_most), "repeat-ranges")
    touched = written(spark, hashfilter.bit_words(ranges, "k1"), "repeat-rows")
    schema = (f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
              "spans array<struct<a:int,b:int>>" + (", kept binary" if kept else ""))
    kind_of = ranges.schema["ranges"].dataType
    still = (hashfilter.keep_rows(keyed, "k1", touched, let_through=False)
             .select("doc_id", "text", F.lit(None).cast(kind_of).alias("ranges")))
    cut = (hashfilter.keep_rows(keyed, "k1", touched).join(ranges, ["k1", "k2"], "left").select("doc_id", "text", "ranges"))
    return still.mapInArrow(_cut(kept), schema).unionByName(cut.mapInArrow(_cut(kept), schema))


def _ranges(keyed: DataFrame, kind: str, length: int, gram: int, keep_first: bool, group_most: int) -> DataFrame:
    """(k1, k2, ranges): byte ranges to remove from every row that has some."""
    spark = keyed.sparkSession
    context = spark.sparkContext
    counts = (keyed.select("text").mapInArrow(_count(length, gram), "core long, n long")
              .groupBy("core").agg(F.sum("n").alias("n")).where("n > 1"))
    words = written(spark, hashfilter.bit_words(counts, "core"), "repeat-cores")
    wanted = context.broadcast(hashfilter.BitFilter(words))
    schema = f"core long, s1 long, s2 long, starts int, doc_id {kind}, k1 long, k2 long, at array<int>"
    found, groups, hot = None, None, []
    while True:
        level = written(spark, keyed.mapInArrow(_occurrences(length, gram, wanted, hot), schema), "repeat-places")
        classes = level.groupBy("core", "s1", "s2").agg(
            F.sum(F.size("at")).alias("copies"), F.max("starts").alias("starts"),
            F.min(F.struct("doc_id", "k1", "k2", F.col("at")[0].alias("at"))).alias("first"))
        classes = written(spark, classes, "repeat-classes")
        of_core = classes.groupBy("core").agg(F.count("*").alias("m"), F.sum("copies").alias("total")).where("total > 1")
        of_core = written(spark, of_core, "repeat-groups")
        # so few that each holds more than group_most classes
        cores = np.array([r.core for r in of_core.where(F.col("m") > group_most).select("core").collect()], np.int64)
        usable = of_core.where(F.col("m") <= group_most) if len(cores) else of_core
        classes = classes.join(usable.select("core", "m"), "core")
        found = level if found is None else found.unionByName(level)
        groups = classes if groups is None else groups.unionByName(classes)
        if not len(cores):
            break
        hot = [*hot, cores.view(np.uint64)]
    groups = written(spark, groups, "repeat-matched")
    several = groups.where("m > 1")
    firsts = written(spark, hashfilter.bit_words(several.select("first.k1"), "k1"), "repeat-rows")
    texts = (hashfilter.keep_rows(keyed.select("k1", "k2", "text"), "k1", firsts)
             .groupBy("k1", "k2").agg(F.first("text").alias("text")))
    place = several.select("core", "s1", "s2", "starts", "first", F.col("first.k1").alias("k1"), F.col("first.k2").alias("k2"))
    stretch = texts.join(place, ["k1", "k2"]).select(
        "core", "s1", "s2", "first", F.substring(F.col("text").cast("binary"), F.col("first.at") + 1,
                                                 F.col("starts") + (length - 1)).alias("bytes"))
    stretch = stretch.repartition("core").sortWithinPartitions("core", "first").select("core", "s1", "s2", "bytes")
    matches = written(spark, stretch.mapInArrow(_matches(length), "core long, s1 long, s2 long, early array<int>, any array<int>"),
                      "repeat-lpf")
    # [first, last, first, last, ...] starts of a class to remove, of its first occurrence and of the others
    whole, none = "array(0, starts - 1)", "cast(array() as array<int>)"
    own, other = (f"coalesce(early, {none})", whole) if keep_first else (
        f"if(copies > 1, {whole}, coalesce(any, {none}))",) * 2
    classes = (groups.join(matches, ["core", "s1", "s2"], "left")
               .withColumn("own", F.expr(own)).withColumn("other", F.expr(other))
               .where("copies > 1 or size(own) > 0").select("core", "s1", "s2", "copies", "first", "own", "other"))
    classes = written(spark, classes, "repeat-flags")
    total = classes.agg(F.sum("copies")).first()[0] or 0
    joined = join_classes(found.drop("starts"), classes, ["core", "s1", "s2"], total)
    same = "first.k1 = k1 and first.k2 = k2 and p = first.at"
    ranges = F.expr(f"""flatten(flatten(transform(at, p -> transform(
        if({same}, own, other), (s, j) -> array(p + s + if(j % 2 = 1, {length}, 0))))))""")
    return (joined.withColumn("ranges", ranges).where("size(ranges) > 0")
            .groupBy("k1", "k2").agg(F.collect_set("ranges").alias("ranges")))
