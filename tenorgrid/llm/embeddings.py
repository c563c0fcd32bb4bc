"""Near-duplicate embeddings by a subspace pigeonhole join.

Unit vectors with cosine at least c lie within squared distance 2 (1 - c). A fixed random rotation spreads the
differences, then the coordinates are cut into blocks and every block gets the share of the squared distance that its
number of dimensions has. A pair within the distance is within the share in one block at least, so range joins per
block miss nothing. A block's range join is a grid over its first dimensions: every vector goes to the cells that the
box of half the block's radius around it touches, two vectors within the radius share a cell. Only the coordinates of the
block go to the cells: they tell which members have a partner within the block's share. Whole vectors go to those members
alone, whose pairs are verified by the cosine in double precision. A pair that meets in several cells or blocks counts
in the first block that admits it and in the lowest common cell.

Tasks return numbers of links per vector and spanning links, never lists of pairs, so a group of thousands of near
copies costs comparisons but no rows. Equal vectors are one class that takes part once, with its number of copies. A
cell with more rows than ``CHUNK`` is compared chunk by chunk, each pair of chunks in a group of its own.

Vectors are compared within equal labels. Null labels, null or zero vectors and vectors with null or non-finite
components link with nothing and stay in the result. Vectors of different lengths do not meet. Repeated rows are
copies. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenorgrid.llm.common import keep
from tenorgrid.llm.components import components
from tenorgrid.llm.words import mix

COSINE = 0.98
BLOCKS, GRID = 8, 6
WIDTH = 3.0  # of a cell, in radii
CHUNK = 1024
PAIRS = 1 << 19
SLACK = 1e-6
CELL = "cell bigint, block int, upper int, row bigint, dims int, part binary"
MEMBER = "cell bigint, i int, j int, side int, block int, upper int, row bigint"


class Subspaces:
    """Rotation, blocks, shares and grid of one dimension count."""

    def __init__(self, dims: int, cosine: float):
        self.turn = np.linalg.qr(np.random.default_rng(dims).standard_normal((dims, dims)))[0]
        edges = np.linspace(0, dims, min(BLOCKS, dims) + 1).astype(int)
        self.blocks = list(itertools.pairwise(edges))
        whole = 2 * (1 - cosine)
        self.share = np.array([whole * (b - a) / dims for a, b in self.blocks]) + SLACK
        self.radius = np.sqrt(self.share)

    def place(self, vectors: np.ndarray) -> np.ndarray:
        v = vectors.astype(np.float64)
        return (v / np.linalg.norm(v, axis=1, keepdims=True)) @ self.turn

    def low(self, placed: np.ndarray, block: int) -> np.ndarray:
        """Index of the lowest cell that each vector touches, per grid dimension."""
        a, b = self.blocks[block]
        r = self.radius[block]
        return np.floor((placed[:, a: min(b, a + GRID)] - r / 2) / (WIDTH * r)).astype(np.int64)


def _emit(cosine: float):
    """Rows (row, label, vector) to a row for every cell of every block that a vector touches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spaces: dict[int, Subspaces] = {}
        for whole in batches:
            for k in range(0, len(whole), 2048):
                batch = whole.slice(k, 2048)
                lists = batch.column(2)
                size = np.diff(lists.offsets.to_numpy())
                flat = lists.flatten().to_numpy(zero_copy_only=False)
                at = np.concatenate([[0], np.cumsum(size)])
                for dims in np.unique(size).tolist():
                    rows = np.flatnonzero(size == dims)
                    space = spaces.setdefault(dims, Subspaces(dims, cosine))
                    vectors = flat[at[rows][:, None] + np.arange(dims)]
                    yield from _cells(space, vectors, batch.take(pa.array(rows)))
    return run


def _cells(space: Subspaces, vectors: np.ndarray, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    placed, dims = space.place(vectors), vectors.shape[1]
    label = batch.column(1).to_numpy().astype(np.int64)
    for block in range(len(space.blocks)):
        low = space.low(placed, block)
        a, b = space.blocks[block]
        r = space.radius[block]
        high = np.floor((placed[:, a: min(b, a + GRID)] + r / 2) / (WIDTH * r)).astype(np.int64)
        part = np.ascontiguousarray(placed[:, a:b], np.float32)
        g, wide = low.shape[1], part.shape[1] * 4
        for upper in range(1 << g):
            step = (upper >> np.arange(g)) & 1
            rows = np.flatnonzero((low + step <= high).all(axis=1))
            if not len(rows):
                continue
            key = mix(label[rows].astype(np.uint64) * np.uint64(64) + np.uint64(block) + (np.uint64(dims) << np.uint64(40)))
            for d in range(g):
                key = mix(key ^ (low[rows, d] + step[d]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            n = len(rows)
            packed = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(0, (n + 1) * wide, wide, np.int32)[: n + 1]),
                                                            pa.py_buffer(part[rows].tobytes())])
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(np.full(n, block, np.int32)), pa.array(np.full(n, upper, np.int32)),
                 batch.column(0).take(pa.array(rows)), pa.array(np.full(n, dims, np.int32)), packed],
                names=["cell", "block", "upper", "row", "dims", "part"])


def _forest(u: np.ndarray, v: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links ``(node, least node reached)`` that connect what the links ``u - v`` connect."""
    low = np.arange(n)
    while True:
        m = np.minimum(low[u], low[v])
        new = low.copy()
        np.minimum.at(new, u, m)
        np.minimum.at(new, v, m)
        new = new[new]
        if (new == low).all():
            node = np.flatnonzero(low != np.arange(n))
            return node, low[node]
        low = new


def _by_group(work):
    """Sorted rows (cell, i, j, ...), as ``work(rows, new)`` with whole groups; ``new`` marks the first row of each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in itertools.chain(batches, [None]):
            table = rest if batch is None else (batch if rest is None else pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0])
            if table is None or not len(table):
                continue
            key = np.stack([table.column(k).to_numpy().astype(np.int64) for k in range(3)])
            new = np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(axis=0)])
            cut = len(table) if batch is None else int(np.flatnonzero(new)[-1])
            rest = table.slice(cut)
            if cut:
                yield from work(table.slice(0, cut), new[:cut])
    return run


def _pairs(rows: pa.RecordBatch, new: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of each group, some at a time: all of a chunk's own, and those of two chunks across."""
    n = len(rows)
    first = np.flatnonzero(new)
    ends = np.repeat(np.append(first[1:], n), np.diff(np.append(first, n)))
    one_side = rows.column(1).to_numpy() == rows.column(2).to_numpy()
    side = rows.column(3).to_numpy()
    later = ends - np.arange(n) - 1
    total = np.concatenate([[0], np.cumsum(later)])
    i = 0
    while i < n:
        stop = max(i + 1, int(np.searchsorted(total, total[i] + PAIRS, "right")) - 1)
        left = np.repeat(np.arange(i, stop), later[i:stop])
        right = left + 1 + np.arange(len(left)) - np.repeat(total[i:stop] - total[i], later[i:stop])
        good = one_side[left] | (side[left] != side[right])
        yield left[good], right[good]
        i = stop


def _partners(cosine: float):
    """Members of a group that have a partner within the share of its block, by the block's coordinates alone."""
    spaces: dict[int, Subspaces] = {}

    def work(rows: pa.RecordBatch, new: np.ndarray) -> Iterator[pa.RecordBatch]:
        block, dims = rows.column(4).to_numpy(), rows.column(7).to_numpy()
        size = pc.binary_length(rows.column(8)).to_numpy() // 4
        part = np.zeros((len(rows), int(size.max())), np.float32)  # shorter ones end in zeros, which add no distance
        part[np.arange(part.shape[1]) < size[:, None]] = np.frombuffer(b"".join(x.as_buffer() for x in rows.column(8)), np.float32)
        kind, place = np.unique(dims.astype(np.int64) * BLOCKS + block, return_inverse=True)
        shares = [spaces.setdefault(k // BLOCKS, Subspaces(k // BLOCKS, cosine)).share[k % BLOCKS] for k in kind.tolist()]
        share = np.array(shares)[place] * 1.0001 + SLACK
        has = np.zeros(len(rows), bool)
        for u, v in _pairs(rows, new):
            near = (place[u] == place[v]) & (((part[u] - part[v]) ** 2).sum(axis=1) <= share[u])
            has[u[near]] = has[v[near]] = True
        if has.any():
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(has)) for c in rows.columns[:7]], names=rows.schema.names[:7])
    return _by_group(work)


def _verify(cosine: float, double: bool):
    """Sorted members with their vectors to ``(id, links, other)``: numbers of links, and spanning links."""
    spaces: dict[int, Subspaces] = {}
    return _by_group(lambda rows, new: _groups(rows, new, cosine, double, spaces))


def _groups(rows: pa.RecordBatch, new: np.ndarray, cosine: float, double: bool, spaces: dict) -> Iterator[pa.RecordBatch]:
    n = len(rows)
    block, upper = rows.column(4).to_numpy(), rows.column(5).to_numpy()
    ids, copies, lists = rows.column(6).to_numpy(), rows.column(7).to_numpy(), rows.column(8)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64 if double else np.float32)
    at = np.concatenate([[0], np.cumsum(np.diff(lists.offsets.to_numpy()))])
    links = np.zeros(n, np.int64)
    left_all, right_all = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for left, right in _pairs(rows, new):
        u, v = _linked(left, right, at, flat, block, upper, cosine, spaces)
        np.add.at(links, u, copies[v])
        np.add.at(links, v, copies[u])
        left_all.append(u)
        right_all.append(v)
    u, v = np.concatenate(left_all), np.concatenate(right_all)
    if not len(u):
        return
    name, place = np.unique(ids, return_inverse=True)
    count = np.bincount(place, weights=links, minlength=len(name)).astype(np.int64)
    node, low = _forest(place[u], place[v], len(name))
    hit = np.flatnonzero(count)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([name[hit], name[node]])), pa.array(np.concatenate([count[hit], np.zeros(len(node), np.int64)])),
         pa.array(np.concatenate([name[hit], name[low]]))], names=["id", "links", "other"])


def _linked(left, right, at, flat, block, upper, cosine, spaces):
    """The pairs that this cell counts and whose cosine is high enough."""
    out_u, out_v = [], []
    for dims in np.unique(np.diff(at)).tolist():
        mine = (at[left + 1] - at[left] == dims)
        u, v = left[mine], right[mine]
        if not len(u):
            continue
        rows = np.flatnonzero(np.diff(at) == dims)
        where = np.zeros(len(at) - 1, np.int64)
        where[rows] = np.arange(len(rows))
        vectors = flat[at[rows][:, None] + np.arange(dims)].astype(np.float64)
        space = spaces.setdefault(dims, Subspaces(dims, cosine))
        placed = space.place(vectors)
        for b, (lo, hi) in enumerate(space.blocks):
            these = block[u] == b
            x, y = u[these], v[these]
            if not len(x):
                continue
            near = ((placed[where[x], lo:hi] - placed[where[y], lo:hi]) ** 2).sum(axis=1) <= space.share[b]
            x, y = x[near], y[near]
            low = space.low(placed, b)
            step = (upper[x][:, None] >> np.arange(low.shape[1])) & 1
            lowest = (low[where[x]] + step == np.maximum(low[where[x]], low[where[y]])).all(axis=1)
            x, y = x[lowest], y[lowest]
            for e in range(b):  # an earlier block that admits the pair counts it
                p, q = space.blocks[e]
                before = ((placed[where[x], p:q] - placed[where[y], p:q]) ** 2).sum(axis=1) <= space.share[e]
                x, y = x[~before], y[~before]
            p, q = vectors[where[x]], vectors[where[y]]
            value = (p * q).sum(axis=1) / (np.sqrt((p * p).sum(axis=1)) * np.sqrt((q * q).sum(axis=1)))
            good = value >= cosine
            out_u.append(x[good])
            out_v.append(y[good])
    none = np.zeros(0, np.int64)
    return (np.concatenate(out_u), np.concatenate(out_v)) if out_u else (none, none)


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_vectors(table: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label",
                 cosine: float = COSINE) -> DataFrame:
    """One row per row of ``table``: id, n_links, component_id, kept."""
    double = "double" in dict(table.dtypes)[vector]
    every = table.select(F.col(id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("vector"))
    good = every.where(usable(F.col("vector")) & F.col("label").isNotNull() & F.col("id").isNotNull())
    classes = keep(good.groupBy("label", "vector").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
                   .withColumn("row", F.monotonically_increasing_id()))
    cells = keep(classes.select("row", "label", "vector").mapInArrow(_emit(cosine), CELL))
    full = keep(cells.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > CHUNK)
                .select("cell", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks")))
    mine = F.pmod(F.xxhash64("row"), F.coalesce("chunks", F.lit(1))).cast("int")
    placed = (cells.join(full, "cell", "left").withColumn("mine", mine)
              .withColumn("with", F.explode(F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1)))
              .select("cell", F.least("mine", "with").alias("i"), F.greatest("mine", "with").alias("j"),
                      (F.col("mine") > F.col("with")).cast("int").alias("side"), "block", "upper", "row", "dims", "part"))
    group = ["cell", "i", "j"]
    members = keep(placed.repartition(*group).sortWithinPartitions(*group).mapInArrow(_partners(cosine), MEMBER))
    whole = members.join(classes.select("row", "id", "copies", "vector"), "row").select(*group, "side", "block", "upper", "id", "copies", "vector")
    found = keep(whole.repartition(*group).sortWithinPartitions(*group)
                 .mapInArrow(_verify(cosine, double), "id bigint, links bigint, other bigint"))
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(found.where("id != other").select("id", "other").distinct(), "id", "other")
    reps = classes.select("id", "copies").join(counts, "id", "left").join(roots, "id", "left").select(
        F.col("id").alias("rep"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("root", "id").alias("root"))
    several = classes.where("copies > 1").select(F.col("label").alias("l"), F.col("vector").alias("v"), F.col("id").alias("first"))
    ok = usable(F.col("vector")) & F.col("label").isNotNull()
    named = (every.join(several, ok & (F.col("label") == F.col("l")) & (F.col("vector") == F.col("v")), "left")
             .select("id", F.when(ok, F.coalesce("first", "id")).alias("rep")))
    return named.join(reps, "rep", "left").select(
        F.col("id").alias(id), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("root", "id").alias("component_id"),
        (F.col("id") == F.coalesce("root", "id")).alias("kept"))


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.98 within equal labels."""
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0 AND NOT list_contains(embedding, NULL)),
good AS (SELECT * FROM v WHERE list_dot_product(e, e) > 0 AND isfinite(list_dot_product(e, e))),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
         WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= {COSINE}),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
root AS (SELECT a, min(b) AS r FROM reach GROUP BY 1), degree AS (SELECT a, count(*) AS n FROM link GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(r, vec_id)) AS component_id, vec_id <= coalesce(r, vec_id) AS kept
FROM embeddings LEFT JOIN degree ON degree.a = vec_id LEFT JOIN root ON root.a = vec_id
"""
