"""N-gram Jaccard join by a prefix tree.

Every text becomes the set of its word shingles in one global order: shingles
that many documents share come last, the most frequent at the very end.  Two
sets that reach the threshold must share a shingle among the first few of that
order (the head), so the sets meet under such a shingle in a block.  In a block
the ordered sets form a trie; a probe walks it depth first, keeps the partial
overlap at every depth (sets that share a path share that work) and leaves a
subtree as soon as the probe's remaining length cannot reach the threshold.
Blocks are walked twice: over heads, which leaves the sets that can have a
link at all, and over whole sets.

Scale: only heads (~15 % of each set) are shuffled to find blocks; whole sets
travel only for documents whose head has a possible partner.  Equal sets are one class
from the start.  A block is the neighbourhood of the smallest class id under a
shingle; a large block is cut into chunks that all hold the block's centre,
and the members that do not end up in the centre's component (rare) are then
compared with every chunk, so no link between components is lost and nothing
is quadratic in a group of near copies.

Defined results: a null or wordless text has n_shingles 0 and is its own
component; a text with fewer than ``k`` words is one shingle; equal texts are
linked; rows without an id and rows that repeat one are documents of their
own, carry links like any other, and a component is named by its smallest id
(null where it has none); very long texts have no limit, ties of the order are
broken by hash; an empty table gives no rows; further columns of the input are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from ledgerlake.llm import hashfilter
from ledgerlake.llm import vectext as vt
from ledgerlake.llm.components import connected_components, join_classes, written

#: Shingles held at once while a task looks for repeated ones.
_HELD = 2_000_000
#: A shingle counted this often goes to the end of the global order ...
HEAVY_FROM = 16
#: ... but at most so many do (the rarest of them stay in hash order): 16 MB as arrays.
HEAVY_MOST = 1 << 20
#: Members of a block that one chunk takes.
CHUNK = 256
_TOP = np.uint64(1 << 63)
#: Labels of classes that no id of their own names.
_NAMELESS = 1 << 62


def _sets(column: pa.Array, k: int, most: int = 1 << 20):
    """(first row, last row, flat sets, offsets) for runs of bounded size."""
    data, off = vt.text_buffer(column)
    for a, b in vt.slices(off, most):
        part, at = data[off[a]:off[b]], off[a:b + 1] - off[a]
        start, end, first = vt.word_spans(part, at, vt.SPACE_WORDS)
        flat, o = vt.shingle_hashes(vt.word_hashes(part, start, end), first, k)
        yield a, b, *vt.sorted_sets(flat, o)


def _repeated(k: int):
    """Per task: shingles seen in two or more of its documents, with counts."""
    def run(batches):
        held, size = [], 0

        def out():
            value = np.concatenate(held)
            held.clear()
            value.sort()  # in place: a task's peak of memory is here
            begin = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
            count = np.diff(begin, append=len(value))
            again = count > 1
            return pa.RecordBatch.from_arrays([pa.array(value[begin[again]].view(np.int64)), pa.array(count[again])], ["s", "c"])
        for batch in batches:
            for _, _, flat, _ in _sets(batch.column(0), k):
                held.append(flat)
                size += len(flat)
                if size >= _HELD:
                    yield out()
                    size = 0
        if held:
            yield out()
    return run


def frequent_shingles(docs: DataFrame, k: int) -> np.ndarray:
    """Shingles to put last, ascending by count: at most HEAVY_MOST, whatever the input."""
    counts = (docs.select("text").mapInArrow(_repeated(k), "s long, c long")
              .groupBy("s").agg(F.sum("c").alias("c")).where(F.col("c") >= HEAVY_FROM))
    counts = written(docs.sparkSession, counts, "shingle-counts")
    least, total = HEAVY_FROM, 0
    for row in sorted(counts.groupBy(F.floor(F.log2("c")).alias("b")).count().collect(), reverse=True):
        if total + row["count"] > HEAVY_MOST:  # at most 64 rows come here
            least = 2 ** (row.b + 1)
            break
        total += row["count"]
    top = counts.where(F.col("c") >= least).toArrow()
    s, c = top.column("s").to_numpy().view(np.uint64), top.column("c").to_numpy()
    return s[np.lexsort((s, c))]


def _to_order(flat: np.ndarray, values: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Shingle hashes -> keys whose numeric order is the global order."""
    out = flat >> np.uint64(1)
    if len(values):
        at = np.minimum(np.searchsorted(values, flat), len(values) - 1)
        hit = values[at] == flat
        out[hit] = _TOP | ranks[at[hit]]
    return out


def _ordered(column: pa.Array, k: int, last: tuple[np.ndarray, np.ndarray]):
    for a, b, flat, off in _sets(column, k):
        key = _to_order(flat, *last)
        for i in range(b - a):
            key[off[i]:off[i + 1]].sort()
        yield a, b, key, off


def _needed(n, num: int, den: int):
    return -(-num * n // den)


def _describe(k: int, num: int, den: int, last):
    """(id, text) -> id, set size, 128-bit fingerprint of the set, its first keys."""
    def run(batches):
        for batch in batches:
            for a, b, key, off in _ordered(batch.column(1), k, last.value):
                n = np.diff(off)
                total = np.concatenate([[np.uint64(0)], np.cumsum(vt.mix(key + np.uint64(7)))])
                other = np.concatenate([[np.uint64(0)], np.cumsum(vt.mix(key ^ np.uint64(0x5DEECE66D)))])
                p = np.where(n > 0, n - _needed(n, num, den) + 1, 0)
                po = np.concatenate([[0], np.cumsum(p)])
                at = np.arange(po[-1]) - np.repeat(po[:-1], p) + np.repeat(off[:-1], p)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(n, pa.int64()),
                    pa.array((total[off[1:]] - total[off[:-1]]).view(np.int64)),
                    pa.array((other[off[1:]] - other[off[:-1]]).view(np.int64)),
                    vt.list_array(key[at].view(np.int64), po, pa.int64())], ["doc_id", "t", "n", "f", "g", "head"])
    return run


def _block_rows(k: int, last):
    """(id, [(centre, chunk, early)], text) -> one row per block: id and its ordered set."""
    def run(batches):
        for batch in batches:
            for a, b, key, off in _ordered(batch.column(2), k, last.value):
                where = batch.column(1).slice(a, b - a).to_pylist()
                ids = batch.column(0).slice(a, b - a).to_pylist()
                rows = [(w["c"], w["chunk"], ids[i], w["early"], key[off[i]:off[i + 1]].tobytes())
                        for i, ws in enumerate(where) for w in ws]
                for j in range(0, len(rows), 512):
                    c, chunk, rep, early, keys = zip(*rows[j:j + 512])
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(chunk, pa.int64()),
                                                      pa.array(rep, pa.int64()), pa.array(early, pa.bool_()),
                                                      pa.array(keys, pa.binary())], ["c", "chunk", "rep", "early", "keys"])
    return run


class _Groups:
    """Union-find over the rows of a block."""

    def __init__(self, labels):
        first: dict = {}
        self.up = [first.setdefault(x, i) for i, x in enumerate(labels)]

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i


class _Trie:
    """The ordered sets of a block as a trie: sets in lexicographic order, and
    how deep each one shares the path of the set before it."""

    def __init__(self, sets: list[np.ndarray]):
        self.tokens, local = np.unique(np.concatenate(sets), return_inverse=True)
        off = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
        self.paths = [local[off[i]:off[i + 1]] for i in range(len(sets))]
        self.order = sorted(range(len(sets)), key=lambda i: self.paths[i].astype(">u4").tobytes())
        self.shared = [0] * len(sets)
        for j in range(1, len(sets)):
            a, b = self.paths[self.order[j - 1]], self.paths[self.order[j]]
            m = min(len(a), len(b))
            differ = np.flatnonzero(a[:m] != b[:m])
            self.shared[j] = int(differ[0]) if len(differ) else m

    def walk(self, x: int, sizes: list[int], num: int, den: int, skip):
        """Sets whose overlap with set ``x`` can reach the threshold, as (y,
        overlap, depth): depth first, the overlap at each depth kept for the
        sets that share the path, subtrees left when the remaining lengths
        cannot suffice.  ``sizes`` may exceed the paths (heads of sets): the
        walk then ends where either head does."""
        px, nx = self.paths[x], sizes[x]
        whole = len(px) == nx
        here = np.zeros(len(self.tokens), dtype=bool)
        here[px] = True
        least = _needed(nx, num, den)  # overlap that any partner needs
        seen = np.zeros(max(map(len, self.paths)) + 1, dtype=np.int64)
        valid, dead = 0, 1 << 60
        for j, y in enumerate(self.order):
            if j:
                valid = min(valid, self.shared[j])
                if self.shared[j] >= dead:
                    continue  # below a node that was left
            dead = 1 << 60
            ny = sizes[y]
            if den * min(nx, ny) < num * max(nx, ny) or skip(y):
                continue
            need = -(-num * (nx + ny) // (num + den))
            py, d, step, alive = self.paths[y], valid, 32, True
            end = len(py) if whole else int(np.searchsorted(py, px[-1], side="right"))
            d = min(d, end)
            while d < end:
                e = min(end, d + step)
                seen[d + 1:e + 1] = seen[d] + np.cumsum(here[py[d:e]])
                d, step = e, step * 2
                valid = max(valid, d)
                rest = nx - int(np.searchsorted(px, py[d - 1], side="right"))
                if seen[d] + rest < least:
                    dead, alive = d, False
                    break
                if seen[d] + min(rest, ny - d) < need:
                    alive = False
                    break
            if alive:
                yield y, int(seen[d]), d


def trie_links(sets: list[np.ndarray], labels, num: int, den: int, probes=None, early=None) -> list[tuple[int, int]]:
    """Links (i, j) between the ordered sets of one block that join two so far
    separate groups; ``labels`` are the groups known before, ``probes`` the
    rows to compare with all rows (default: every row), ``early`` the rows of
    which every pair to compare has at least one (default: every row)."""
    if len(sets) < 2:
        return []
    early = [True] * len(sets) if early is None else early
    if not any(early):
        return []
    if not all(early) and probes is None:   # only early rows need be walked from
        probes = [i for i, e in enumerate(early) if e]
    groups, trie, sizes = _Groups(labels), _Trie(sets), [len(s) for s in sets]
    found, done = [], [False] * len(sets)
    for x in (range(len(sets)) if probes is None else probes):
        done[x] = True
        if not sizes[x]:
            continue
        for y, overlap, _ in trie.walk(x, sizes, num, den, lambda y, x=x: done[y] or not (early[x] or early[y]) or groups.root(x) == groups.root(y)):
            if den * overlap >= num * (sizes[x] + sizes[y] - overlap):
                found.append((x, y))
                groups.up[groups.root(x)] = groups.root(y)
    return found


def with_partner(heads: list[np.ndarray], sizes: list[int], num: int, den: int) -> list[int]:
    """Sets that, as far as the heads tell, may have a link in the block."""
    if len(heads) < 2:
        return []
    trie, alive = _Trie(heads), [False] * len(heads)
    for x in range(len(heads)):
        for y, *_ in trie.walk(x, sizes, num, den, lambda y, x=x: y == x or (alive[x] and alive[y])):
            alive[x] = alive[y] = True
    return [i for i, a in enumerate(alive) if a]


def _promising(num: int, den: int):
    """Sorted rows (c, rep, n, head) -> (c, rep) of sets with a possible link."""
    def solve(c, rows):
        keep = with_partner([np.sort(np.array(r[2], dtype=np.int64).view(np.uint64)) for r in rows], [r[1] for r in rows], num, den)
        return [(c, rows[i][0]) for i in keep]

    def batch_of(out):
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()),
                                           pa.array([x[1] for x in out], pa.int64())], ["c", "rep"])

    def run(batches):
        key, rows = None, []
        for batch in batches:
            out = []
            heads = batch.column(3)
            for i, (c, rep, n) in enumerate(zip(*(batch.column(j).to_pylist() for j in range(3)))):
                if c != key:
                    out += solve(key, rows)
                    key, rows = c, []
                rows.append((rep, n, heads[i].values.to_numpy()))
            if out:
                yield batch_of(out)
        yield batch_of(solve(key, rows))
    return run


def _block_links(num: int, den: int):
    """Sorted rows (block key..., rep, label, probe, early, keys) -> links (a, b)."""
    def solve(rows):
        reps = [r[0] for r in rows]
        sets = [np.frombuffer(r[4], dtype=np.uint64) for r in rows]
        probes = [i for i, r in enumerate(rows) if r[2]]
        if len(probes) == len(rows):
            probes = None
        groups = _Groups(range(len(rows)))
        for i, j in trie_links(sets, [r[1] for r in rows], num, den, probes, [r[3] for r in rows]):
            groups.up[groups.root(i)] = groups.root(j)
        least: dict = {}  # every member is tied to the smallest id of its group
        for i, rep in enumerate(reps):
            least[groups.root(i)] = min(rep, least.get(groups.root(i), rep))
        return [(rep, least[groups.root(i)]) for i, rep in enumerate(reps) if rep != least[groups.root(i)]]

    def run(batches):
        key, rows, out = None, [], []
        for batch in batches:
            for i in range(0, batch.num_rows, CHUNK):
                for c, chunk, piece, *row in zip(*(x.to_pylist() for x in batch.slice(i, CHUNK).columns)):
                    if (c, chunk, piece) != key:
                        out += solve(rows)
                        key, rows = (c, chunk, piece), []
                    rows.append(row)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()),
                                                  pa.array([x[1] for x in out], pa.int64())], ["a", "b"])
                out = []
        out = solve(rows)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()),
                                              pa.array([x[1] for x in out], pa.int64())], ["a", "b"])
    return run


def _links_of(blocks: DataFrame, num: int, den: int) -> DataFrame:
    rows = blocks.select("c", "chunk", "piece", "rep", "label", "probe", "early", "keys")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.repartition(parts, "c", "chunk", "piece").sortWithinPartitions("c", "chunk", "piece")
            .mapInArrow(_block_links(num, den), "a long, b long"))


def ngram_components(docs: DataFrame, k: int = 5, threshold: tuple[int, int] = (80, 100)) -> DataFrame:
    """Near-duplicate classes of ``docs`` (doc_id, text, ...).

    Two documents link when the Jaccard similarity of their sets of ``k``-word
    shingles is at least ``threshold`` (numerator, denominator).  Returns
    doc_id, n_shingles, component_id (smallest id reachable by links).
    """
    sets, classes, _ = _classes(docs, k, threshold)
    rows = sets.select("doc_id", F.col("n").alias("n_shingles"), "f", "g")
    columns = ["doc_id", "n_shingles", "component_id"]
    return (join_classes(rows.where("n_shingles > 0"), classes, ["f", "g"], sets.count())
            .select(columns).union(rows.where("n_shingles = 0").select("doc_id", "n_shingles", "doc_id")))


def _classes(docs: DataFrame, k: int, threshold: tuple[int, int]) -> tuple[DataFrame, DataFrame, bool]:
    """(rows: doc_id, t (hash of the text), n, f, g; classes: f, g, copies,
    component_id, label of the component, first row of the class; whether some
    class goes by a label that is no id)."""
    spark: SparkSession = docs.sparkSession
    num, den = threshold
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("t"))
    heavy = frequent_shingles(docs, k)
    at = np.argsort(heavy)
    last = spark.sparkContext.broadcast((heavy[at], at.astype(np.uint64)))

    sets = written(spark, docs.mapInArrow(
        _describe(k, num, den, last), "doc_id long, t long, n long, f long, g long, head array<long>"), "shingle-sets")
    # a class goes by its smallest id unless that id names several sets
    several = (sets.where("n > 0 and doc_id is not null").groupBy("doc_id").agg(
        *[least(c).alias(f"{least.__name__}_{c}") for c in ("f", "g") for least in (F.min, F.max)])
        .where("min_f <> max_f or min_g <> max_g"))
    several = written(spark, several.select(F.col("doc_id").alias("shared")), "shingle-ids")
    odd = not several.isEmpty() or not sets.where("n > 0 and doc_id is null").isEmpty()
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t")).alias("first")

    def labelled(*more):
        found = sets.where("n > 0").groupBy("f", "g").agg(F.min("doc_id").alias("own"), *more)
        hashed = F.lit(_NAMELESS) + F.pmod(F.xxhash64("f", "g"), F.lit(1 << 61))
        if not odd:
            return found.withColumnRenamed("own", "rep")
        own = F.when(F.col("shared").isNull(), F.col("own"))
        return found.join(several, F.col("own") == F.col("shared"), "left").withColumn("rep", F.coalesce(own, hashed))
    classes = labelled(F.first("n").alias("n"), F.first("head").alias("head"))
    heads = classes.select(F.posexplode("head").alias("i", "s"), "rep", F.col("n").cast("int").alias("n"))
    # the shorter set of a linked pair has a shared shingle within its first n - need(n, n) + 1
    heads = heads.withColumn("early", F.col("i") <= F.col("n") - F.ceil(2 * num * F.col("n") / (num + den))).drop("i")

    # centre: the smallest class id under a shingle; shingles of one class say nothing.  Sizes with
    # a gap wider than the threshold allows cannot link across it, so each run of sizes has its own.
    by_size = Window.partitionBy("s").orderBy("n", "rep")
    run = Window.partitionBy("s", "run")
    light = (heads.where("s >= 0").withColumn("before", F.lag("n").over(by_size))
             .withColumn("run", F.sum(F.when(F.col("before") * den >= F.col("n") * num, 0).otherwise(1)).over(by_size))
             .withColumn("c", F.min("rep").over(run)).withColumn("z", F.max("rep").over(run))
             .withColumn("e", F.max("early").over(run)).where("c < z and e").select("rep", "c", "early"))
    frequent = heads.where("s < 0")
    centre = (frequent.groupBy("s").agg(F.min("rep").alias("c"), F.max("rep").alias("z"), F.max("early").alias("e"))
              .where("c < z and e").select("s", "c"))
    pairs = written(spark, light.union(frequent.join(centre, "s").select("rep", "c", "early"))
                    .groupBy("rep", "c").agg(F.max("early").alias("early")), "shingle-pairs")

    sizes = pairs.groupBy("c").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    sized = pairs.join(sizes, "c")
    # small blocks: the heads alone rule out nearly all sets that share a shingle by chance
    heads_of = classes.select(F.col("rep").alias("r"), "n", "head")
    small = (sized.where("chunks = 1").join(heads_of, F.col("rep") == F.col("r")).select("c", "rep", "n", "head")
             .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "c").sortWithinPartitions("c")
             .mapInArrow(_promising(num, den), "c long, rep long").distinct())
    placed = small.select("rep", F.struct("c", F.lit(0).cast("long").alias("chunk"), F.lit(True).alias("early")).alias("at")).union(
        sized.where("chunks > 1").select("rep", F.explode(F.transform(
            F.when(F.col("rep") == F.col("c"), F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))
            .otherwise(F.array(F.pmod(F.xxhash64("rep"), "chunks"))),
            lambda chunk: F.struct(F.col("c").alias("c"), chunk.alias("chunk"), F.col("early").alias("early")))).alias("at")))
    where = placed.groupBy("rep").agg(F.collect_list("at").alias("at"))
    fetched = docs.join(where, F.col("doc_id") == F.col("rep")).select("rep", "at", "text")
    if odd:  # by the hash of a text that has the set; equal texts are one row
        wanted = written(spark, where.where(F.col("rep") >= _NAMELESS).join(
            labelled(first).select("rep", F.col("first.t").alias("t")), "rep"), "shingle-wanted")
        texts = (hashfilter.keep_rows(docs.select("t", "text"), "t", written(spark, hashfilter.bit_words(wanted, "t"), "shingle-texts"))
                 .groupBy("t").agg(F.first("text").alias("text")))
        fetched = fetched.union(texts.join(wanted, "t").select("rep", "at", "text"))
    blocks = written(spark, fetched.mapInArrow(_block_rows(k, last), "c long, chunk long, rep long, early boolean, keys binary"), "shingle-blocks")
    links = written(spark, _links_of(blocks.select(
        "c", "chunk", F.lit(0).alias("piece"), "rep", F.col("rep").alias("label"), F.lit(True).alias("probe"),
        "early", "keys"), num, den), "shingle-links")
    component = connected_components(spark, links)

    more = _across_chunks(spark, pairs, sizes, blocks, component, num, den)
    if more is not None:
        component = connected_components(spark, links.union(more))
    named = (labelled(first, F.count("*").alias("copies")).join(component, F.col("rep") == F.col("id"), "left")
             .select("f", "g", "copies", "first", F.coalesce("component_id", "rep").alias("label")))
    if odd:
        named = written(spark, named, "shingle-named")
        name = named.groupBy("label").agg(F.min("first.doc_id").alias("component_id"))
        named = named.join(name, "label")
    else:
        named = named.withColumn("component_id", F.col("label"))
    return sets.drop("head"), written(spark, named, "shingle-classes"), odd


def _across_chunks(spark, pairs, sizes, blocks, component, num, den) -> DataFrame | None:
    """Links between chunks of one block, beside the centre, which every chunk
    holds.  The shorter set of a linked pair has their first shared shingle
    early, so at least one of the two is early in the block; and members of
    the centre's component need no link among themselves.  Thus early members
    outside that component go against every chunk, and the others outside it
    against the early members within it, both in pieces of CHUNK rows."""
    label = component.select(F.col("id").alias("rep"), F.col("component_id").alias("own"))
    centre = component.select(F.col("id").alias("c"), F.col("component_id").alias("home"))
    members = (pairs.join(sizes.where("chunks > 1"), "c").where("rep <> c").join(label, "rep", "left").join(centre, "c", "left")
               .select("c", "rep", "chunks", "early", F.coalesce("own", "rep").alias("label"),
                       (F.coalesce("own", "rep") != F.coalesce("home", "c")).alias("apart")))
    members = written(spark, members, "shingle-members")

    def number(which):
        return F.ceil(F.count_if(which) / CHUNK)
    apart, early = F.col("apart"), F.col("early")
    pieces = members.groupBy("c").agg(number(apart & early).alias("pieces"), number(apart & ~early).alias("late_pieces"),
                                      number(~apart & early).alias("early_chunks"))
    pieces = written(spark, pieces.where("pieces > 0 or (late_pieces > 0 and early_chunks > 0)"), "shingle-pieces")
    if pieces.isEmpty():
        return None
    # blocks with work first, so that only their sets move
    rows = blocks.drop("early").join(pieces, "c").join(members, ["c", "rep"])

    def jobs(which, n, place):
        every = F.transform(F.sequence(F.lit(0).cast("long"), F.greatest(F.col(n), F.lit(1)) - 1), place)
        return F.when(which, every).otherwise(F.array().cast("array<struct<chunk:bigint,piece:bigint,probe:boolean>>"))

    def place(chunk, piece, probe):
        return F.struct(chunk.cast("long").alias("chunk"), piece.cast("long").alias("piece"), F.lit(probe).alias("probe"))
    part = lambda n: F.pmod(F.xxhash64("rep"), F.greatest(F.col(n), F.lit(1)))
    some, late = F.col("pieces") > 0, (F.col("late_pieces") > 0) & (F.col("early_chunks") > 0)
    rows = rows.withColumn("at", F.explode(F.concat(   # pieces of late members have numbers below zero
        jobs(some, "pieces", lambda piece: place(F.col("chunk"), piece, False)),
        jobs(some & apart & early, "chunks", lambda chunk: place(chunk, part("pieces"), True)),
        jobs(late & ~apart & early, "late_pieces", lambda piece: place(part("early_chunks"), -1 - piece, False)),
        jobs(late & apart & ~early, "early_chunks", lambda chunk: place(chunk, -1 - part("late_pieces"), True)))))
    rows = rows.select("c", "at.chunk", "at.piece", "rep", "label", "at.probe", "early", "keys")
    return written(spark, _links_of(rows, num, den), "shingle-links")


def keep_one(docs: DataFrame, k: int = 5, threshold: tuple[int, int] = (80, 100)) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they are: of each class
    of near copies the one with the smallest id (without any id, the smallest
    hash of the text), and of rows that repeat id and text one.  Rows without
    words are in no class and stay."""
    spark = docs.sparkSession
    sets, classes, _ = _classes(docs, k, threshold)
    winner = classes.groupBy("label").agg(F.min("first").alias("winner"))
    classes = written(spark, classes.join(winner, "label").select("f", "g", "copies", "winner"), "shingle-winners")
    rows = join_classes(sets.where("n > 0").select("doc_id", "t", "f", "g"), classes, ["f", "g"], sets.count())
    stays = F.col("doc_id").eqNullSafe(F.col("winner.doc_id")) & (F.col("t") == F.col("winner.t"))
    found = written(spark, rows.groupBy(F.col("doc_id").alias("_of"), F.col("t").alias("_text")).agg(
        F.max(stays).alias("stays"), F.count("*").alias("n")).where("n > 1 or not stays"), "shingle-copies")
    # rows that cannot be among those stay where they are; the others meet their verdict
    known = written(spark, hashfilter.bit_words(found, "_text"), "shingle-copies")
    keyed = docs.withColumn("_text_hash", F.xxhash64("text"))
    clean = hashfilter.keep_rows(keyed, "_text_hash", known, let_through=False).select(docs.columns)
    asked = hashfilter.keep_rows(keyed, "_text_hash", known)
    same = asked["doc_id"].cast("long").eqNullSafe(found["_of"]) & (asked["_text_hash"] == found["_text"])
    kept = clean.unionByName(asked.join(found, same, "left_anti").select(docs.columns))
    repeated = found.where("stays")
    if repeated.isEmpty():
        return kept
    same = asked["doc_id"].cast("long").eqNullSafe(repeated["_of"]) & (asked["_text_hash"] == repeated["_text"])
    one = (asked.join(repeated, same, "left_semi").groupBy("doc_id", "_text_hash")
           .agg(F.first(F.struct(*[F.col(c) for c in docs.columns])).alias("_row")))
    return kept.unionByName(one.select("_row.*"))
