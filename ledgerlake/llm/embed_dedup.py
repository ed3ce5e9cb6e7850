"""Embedding near-duplicates by PCA-ordered tiles.

Vectors are scaled to length 1 and turned into the axes of the second-moment
matrix, most energy first.  Tiles of vectors are compared pairwise: the
products of the leading axes plus the product of the remaining norms bound the
cosine from above (one matrix product, the norms being one more axis), and
only pairs whose bound reaches the threshold are followed to the last axis.
Tiles are cells of halvings along the leading axes, so cells too far apart for
the threshold are never paired.

Scale: exact comparison of all pairs is quadratic by nature; what Spark moves
is whole tiles (``ROWS`` vectors each, one row), once per paired tile.  Equal
vectors are one class with a count.  Links never leave a task as pairs: a task
returns the number of links per vector and, for the components, a link from
each vector to the smallest id of its group inside the tile pair.

Defined results: vectors that are null, empty, zero or hold null or non-finite
numbers link with nothing; vectors of different lengths do not link; rows with
a null id count as partners but name no component and are not kept; repeated
ids are separate rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.components import connected_components, join_classes, written

#: Vectors in a tile.
ROWS = 4096
#: Halvings into cells at most (1024 cells), and axes of a cell's box.
HALVINGS = 10
BOX = 12
#: Share of the energy in the leading axes.
LEADING = 0.28
#: Classes without an id are numbered from here, so that they name no component that has one.
_NAMELESS = 1 << 62


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow of the squares
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _moments(d: int):
    def run(batches):
        total = np.zeros((d, d))
        for batch in batches:
            x = _matrix(batch.column(0), d)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["m"])
    return run


def _axes(d: int, turn):
    def run(batches):
        for batch in batches:
            y = _matrix(batch.column("v"), d) @ turn.value[:, :BOX]
            flat = pa.array(y.ravel())
            off = pa.array(np.arange(len(y) + 1) * y.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(off, flat)], [*batch.schema.names, "y"])
    return run


def _tile(table: pa.Table) -> pa.Table:
    table = table.combine_chunks()
    ids = table.column("id").to_numpy().astype(np.int64)
    v = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return pa.table({"cell": table.column("cell")[:1], "chunk": table.column("chunk")[:1],
                     "ids": pa.array([ids.tobytes()], pa.binary()),
                     "sizes": pa.array([table.column("size").to_numpy().astype(np.int64).tobytes()], pa.binary()),
                     "vectors": pa.array([v.tobytes()], pa.binary())})


def linked_pairs(a: np.ndarray, b: np.ndarray, lead: int, threshold: float, same: bool):
    """(i, j) with cosine >= threshold of unit rows in PCA order, in runs;
    ``same``: a is b, only i < j."""
    def bounded(x):
        rest = np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", x[:, :lead], x[:, :lead])))
        return np.column_stack([x[:, :lead], rest]).astype(np.float32)
    fa, fb = bounded(a), bounded(b).T.copy()
    step = max(1, (1 << 21) // max(1, len(b)))
    for at in range(0, len(a), step):
        bound = fa[at:at + step] @ fb
        flat = np.flatnonzero(bound >= np.float32(threshold - 1e-4))
        if len(flat) > bound.size // 8:  # dense: the whole product is cheaper
            flat = np.flatnonzero(a[at:at + step] @ b.T >= threshold - 1e-9)
        i, j = np.divmod(flat, len(b))
        i += at
        if same:
            i, j = i[i < j], j[i < j]
        for k in range(0, len(i), 1 << 16):
            x, y = i[k:k + (1 << 16)], j[k:k + (1 << 16)]
            done, cosine, d = 0, np.zeros(len(x)), a.shape[1]
            while done < d:  # next axes for those still in reach
                to = min(d, done + max(lead, 8))
                cosine = cosine + np.einsum("ij,ij->i", a[x, done:to], b[y, done:to])
                done = to
                if done < d:
                    rest = np.sqrt(np.einsum("ij,ij->i", a[x, done:], a[x, done:]) * np.einsum("ij,ij->i", b[y, done:], b[y, done:]))
                    go = cosine + rest >= threshold - 1e-9
                    x, y, cosine = x[go], y[go], cosine[go]
            sure = cosine >= threshold - 1e-9
            yield x[sure], y[sure]


def _compare(d: int, kind: str, lead: int, threshold: float, turn):
    def read(table, r):
        ids = np.frombuffer(table.column("ids")[r].as_py(), dtype=np.int64)
        sizes = np.frombuffer(table.column("sizes")[r].as_py(), dtype=np.int64)
        x = np.frombuffer(table.column("vectors")[r].as_py(), dtype=kind).reshape(-1, d).astype(np.float64)
        x = x / np.abs(x).max(axis=1, keepdims=True)
        x = x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
        return ids, sizes, x, x @ turn.value

    def run(table: pa.Table) -> pa.Table:
        a, i, b, j = (table.column(c)[0].as_py() for c in "aibj")
        same = (a, i) == (b, j)
        if not same and table.num_rows < 2:  # the other tile is empty
            return pa.table({c: pa.array([], pa.int64()) for c in ("id", "links", "least")})
        left, right = (read(table, r) for r in (0, table.num_rows - 1))
        ids = left[0] if same else np.concatenate([left[0], right[0]])
        shift = 0 if same else len(left[0])
        links, label = np.zeros(len(ids), np.int64), ids.copy()
        pairs = []
        for i, j in linked_pairs(left[3], right[3], lead, threshold - 1e-9, same):
            sure = np.einsum("ij,ij->i", left[2][i], right[2][j]) >= threshold  # in the given axes
            i, j = i[sure], j[sure]
            np.add.at(links, i, right[1][j])
            np.add.at(links, j + shift, left[1][i])
            pairs.append((i, j + shift))
        if pairs:
            i, j = (np.concatenate(p) for p in zip(*pairs))
            while True:
                least = np.minimum(label[i], label[j])
                if (least == label[i]).all() and (least == label[j]).all():
                    break
                np.minimum.at(label, i, least)
                np.minimum.at(label, j, least)
        some = links > 0
        return pa.table({"id": pa.array(ids[some]), "links": pa.array(links[some]), "least": pa.array(label[some])})
    return run


def _pairs_of_cells(boxes: list, threshold: float) -> list[tuple[int, int, int, int]]:
    """Cells (at most 1024) that may hold a linked pair, with their chunks."""
    cell = np.array([r.cell for r in boxes])
    lo, hi = np.array([r.lo for r in boxes]), np.array([r.hi for r in boxes])
    chunks = [-(-r.n // ROWS) for r in boxes]
    far = 2 - 2 * threshold + 1e-9  # squared distance of unit vectors at the threshold
    out = []
    for i in range(len(boxes)):
        gap = np.maximum(0, np.maximum(lo[i] - hi[i:], lo[i:] - hi[i]))
        for j in np.flatnonzero((gap ** 2).sum(axis=1) <= far) + i:
            out.append((int(cell[i]), int(cell[j]), chunks[i], chunks[j]))
    return out


def _links_of_length(classes: DataFrame, d: int, kind: str, threshold: float) -> DataFrame:
    """id, links, least of the classes (id, size, v) with vectors of d numbers."""
    spark = classes.sparkSession
    sums = classes.select("v").mapInArrow(_moments(d), "m binary")
    moment = sum((np.frombuffer(r.m).reshape(d, d) for r in sums.toLocalIterator()), np.zeros((d, d)))  # one row per task
    energy, turn = np.linalg.eigh(moment)
    energy, turn = energy[::-1], np.ascontiguousarray(turn[:, ::-1])
    lead = min(d, max(8, int(np.searchsorted(np.cumsum(energy) / energy.sum(), LEADING)) + 1))
    turn = spark.sparkContext.broadcast(turn)
    placed = classes.mapInArrow(_axes(d, turn), "id long, size long, v array<{}>, y array<double>".format(
        "float" if kind == "f4" else "double"))
    count = classes.count()
    halvings = min(HALVINGS, min(BOX, d), max(0, int(np.ceil(np.log2(max(1, count / ROWS))))))
    cell = F.lit(0)
    if halvings:
        middle = placed.agg(*[F.percentile_approx(F.col("y")[j], 0.5, 1000).alias(f"m{j}") for j in range(halvings)]).first()
        for j in range(halvings):
            cell = cell + F.when(F.col("y")[j] > middle[j], 1 << j).otherwise(0)
    placed = placed.withColumn("cell", cell.cast("int"))
    m = min(BOX, d)
    boxes = placed.groupBy("cell").agg(F.count("*").alias("n"), F.array(*[F.min(F.col("y")[j]) for j in range(m)]).alias("lo"),
                                       F.array(*[F.max(F.col("y")[j]) for j in range(m)]).alias("hi")).collect()
    sizes = {r.cell: -(-r.n // ROWS) for r in boxes}
    chunks = F.create_map(*[F.lit(x) for kv in sizes.items() for x in kv])
    tiles = (placed.select("id", "size", "v", "cell", F.pmod(F.xxhash64("id"), chunks[F.col("cell")]).cast("int").alias("chunk"))
             .groupBy("cell", "chunk").applyInArrow(_tile, "cell int, chunk int, ids binary, sizes binary, vectors binary"))
    tiles = written(spark, tiles, "vector-tiles")
    pairs = spark.createDataFrame(_pairs_of_cells(boxes, threshold), "a int, b int, na int, nb int")
    pairs = (pairs.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("na") - 1)))
             .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("nb") - 1))).where("a <> b or i <= j"))
    ends = pairs.select("a", "i", "b", "j", F.explode(F.array_distinct(F.array(
        F.struct(F.col("a").alias("cell"), F.col("i").alias("chunk")), F.struct(F.col("b").alias("cell"), F.col("j").alias("chunk"))))).alias("t"))
    both = ends.select("a", "i", "b", "j", "t.cell", "t.chunk").join(tiles, ["cell", "chunk"])
    return both.groupBy("a", "i", "b", "j").applyInArrow(
        _compare(d, kind, lead, threshold, turn), "id long, links long, least long")


def near_duplicates(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """``vectors`` (vec_id, embedding) -> vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    kind = "f8" if vectors.schema["embedding"].dataType.elementType.simpleString() == "double" else "f4"
    v = F.col("embedding") if kind == "f8" else F.col("embedding").cast("array<float>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.coalesce(~bad & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = written(spark, rows.select(
        "vec_id", F.when(usable, F.col("v")).alias("v"), F.when(usable, F.size("v")).alias("d"),
        F.xxhash64("v").alias("h"), F.hash("v", F.lit(1)).alias("g")), "vectors")
    classes = rows.where("d is not null").groupBy("d", "h", "g").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("size"), F.first("v").alias("v"))
    # a class goes by its smallest id unless that id has several vectors
    several = rows.where("d is not null and vec_id is not null").groupBy("vec_id").agg(
        F.min(F.struct("d", "h", "g")).alias("one"), F.max(F.struct("d", "h", "g")).alias("other")).where("one <> other")
    several = written(spark, several.select(F.col("vec_id").alias("shared")), "vector-ids")
    own = F.when(F.col("shared").isNull(), F.col("rep"))
    classes = written(spark, classes.join(several, F.col("rep") == F.col("shared"), "left").withColumn(
        "id", F.coalesce(own, F.lit(_NAMELESS) + F.pmod(F.xxhash64("d", "h", "g"), F.lit(1 << 60)))).drop("shared"), "vector-classes")
    found = None
    for r in sorted(classes.groupBy("d").count().collect()):  # usually one length
        part = _links_of_length(classes.where(F.col("d") == r.d).select("id", "size", "v"), r.d, kind, threshold)
        found = part if found is None else found.union(part)
    if found is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.col("vec_id").isNotNull().alias("kept"))
    found = written(spark, found, "vector-links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    component = connected_components(spark, found.select(F.col("id").alias("a"), F.col("least").alias("b")))
    label = F.coalesce("component_id", "id").alias("label")
    known = (classes.select("d", "h", "g", "id", "rep", "size").join(links, "id", "left").join(component, "id", "left")
             .select("d", "h", "g", "rep", F.col("size").alias("copies"),
                     (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), label))
    known = written(spark, known, "vector-known")
    # named by the smallest id of all its classes
    known = known.join(known.groupBy("label").agg(F.min("rep").alias("component_id")), "label").drop("label", "rep")
    rows = rows.select("vec_id", "d", "h", "g")
    columns = ["vec_id", "n_links", "component_id"]
    linked = join_classes(rows.where("d is not null"), written(spark, known, "vector-classes"), ["d", "h", "g"], rows.count())
    alone = rows.where("d is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return (linked.select(columns).union(alone)
            .select(*columns, F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")))
