"""Hard negatives by inner product: cover trees over norm-augmented vectors, one per shard of a cover of all rows.

Components become integers, so scores are exact. A vector x gets one more coordinate, sqrt(M - |x|^2) with M the largest
squared norm, and a query q gets a zero: then d(q, x)^2 = |q|^2 + M - 2 <q, x>, and a ball around a node's centre that covers
the node's vectors bounds their inner products from both sides.

The top of the cover is common: centres by farthest-first choice from a bounded sample; every row belongs to its nearest
centre's cell, whose radius is measured over all its rows. A cell is cut into shards of about ``SHARD`` rows by the hash of the
id, and every shard is a cover tree in one task. Anchors go to the shards of those cells only that can hold a score in
one of their windows; a shard's tree is descended level by level, nodes outside of the windows or below the k-th score so
far are left out, and the leaves are verified exactly, best bound first. A shard returns at most k rows per window.

Positives: a first search in the anchor's own cell gives a least score, the second one looks into all other cells that
can reach it. Negatives: every positive gives a window of scores.

Rows with equal label and vector beyond the first k + 1 ids can be in no answer, as ties go by id, and leave before the
search; so a vector that a third of all rows share is a few rows. Equal rows count once. Rows with a null id or label, a null
or empty vector, with null or non-finite components, or with an integer squared norm of 2^63 or more (scores would not fit
a long) take no part. Rows of the anchor's own id are not among its candidates. Vectors of different lengths do not meet.
Extra columns are not read. An empty table, or one without anchors, gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenorgrid.llm.common import keep, named

SCALE = 256
SAMPLE, CENTRES = 4096, 256  # of the top of the cover: rows that centres are chosen from, most centres of a length
SHARD, LEAF, WIDTH = 4096, 64, 32  # rows of a shard and of a leaf, most children of a node
QUERIES = 1024  # searched at once
LEAST, MOST = -(1 << 63), (1 << 63) - 1
PACKED = "id bigint, label bigint, dims int, vector binary, norm double"
QUERY = "id bigint, label bigint, dims int, vector binary, home int, same boolean, low array<bigint>, high array<bigint>, tags array<bigint>"
FOUND = "anchor bigint, tag bigint, other bigint, score bigint"


def usable(vector: Column) -> Column:
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(2)
        edge = lists.offsets.to_numpy().astype(np.int64)
        flat = lists.values.to_numpy(zero_copy_only=False).astype("<i8")
        vectors = [flat[a:b] for a, b in zip(edge[:-1], edge[1:])]
        norm = np.array([float(v.astype(np.float64) @ v) for v in vectors], np.float64)
        ok = pa.array(norm < 2.0**63)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).filter(ok), batch.column(1).filter(ok), pa.array(np.diff(edge).astype(np.int32)).filter(ok),
             pa.array([v.tobytes() for v in vectors], pa.binary()).filter(ok), pa.array(norm).filter(ok)],
            names=["id", "label", "dims", "vector", "norm"])


def _matrix(vectors: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), "<i8").reshape(len(vectors), -1)


def _raised(points: np.ndarray, big: float) -> np.ndarray:
    x = points.astype(np.float64)
    return np.concatenate([x, np.sqrt(np.maximum(big - (x * x).sum(axis=1), 0))[:, None]], axis=1)


def _farthest_first(points: np.ndarray, first: int, most: int, enough: float) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Centres, each the point farthest from those before, until all lie within ``enough`` of one; nearest and distance."""
    chosen, near = [first], np.zeros(len(points), np.int64)
    far = np.linalg.norm(points - points[first], axis=1)
    while len(chosen) < most and far.max() > enough:
        chosen.append(int(far.argmax()))
        d = np.linalg.norm(points - points[chosen[-1]], axis=1)
        closer = d < far
        near[closer], far[closer] = len(chosen) - 1, d[closer]
    return chosen, near, far


def _bounds(ip: np.ndarray, norm: np.ndarray, own: np.ndarray, radius: np.ndarray, big: float) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product with a point of a ball, from the one with its centre; rounding is on the safe side.

    ``norm`` and ``own`` are the squared norms of the query and of the raised centre.
    """
    whole = norm + big
    d = np.sqrt(np.maximum(norm + own - 2 * ip, 0))
    near, far = np.maximum(d - radius, 0), d + radius
    slack = 1e-9 * (whole + far * far) + 1e-6
    return (whole - far * far) / 2 - slack, (whole - near * near) / 2 + slack


class CoverTree:
    """Nodes of one level after the other. A node covers a stretch of the points; its children halve its radius."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, labels: np.ndarray, big: float):
        self.big = big
        raised = _raised(points, big)
        order = np.arange(len(points))
        centre = [int(np.linalg.norm(raised - raised.mean(axis=0), axis=1).argmin())]
        todo = [(0, len(points), centre[0], 0)]  # start, stop, centre as a point, level's parent
        levels: list[list[tuple[int, int, int, int, float]]] = []
        while todo:
            level, after = [], []
            for start, stop, c, parent in todo:
                mine = order[start:stop]
                far = np.linalg.norm(raised[mine] - raised[c], axis=1)
                radius = float(far.max())
                level.append((start, stop, c, parent, radius))
                if stop - start <= LEAF or radius == 0:
                    continue
                first = int(far.argmin())
                chosen, near, _ = _farthest_first(raised[mine], first, min(WIDTH, 1 - (start - stop) // LEAF), radius / 2)
                by = np.argsort(near, kind="stable")
                order[start:stop] = mine[by]
                count = np.bincount(near, minlength=len(chosen))
                at = start + np.concatenate([[0], np.cumsum(count)])
                after += [(int(at[k]), int(at[k + 1]), int(mine[chosen[k]]), len(level) - 1) for k in range(len(chosen)) if count[k]]
            levels.append(level)
            todo = after
        # Distances of two raised points are those of their stored coordinates, so the centre's own norm is used as stored.
        self.points, self.ids, self.labels = points[order], ids[order], labels[order]
        self.levels = []
        for k, level in enumerate(levels):
            parents = np.array([n[3] for n in levels[k + 1]], np.int64) if k + 1 < len(levels) else np.zeros(0, np.int64)
            centre = raised[[n[2] for n in level]]
            self.levels.append((np.array([n[:2] for n in level], np.int64), centre[:, :-1], (centre * centre).sum(axis=1),
                                np.array([n[4] for n in level]), np.searchsorted(parents, np.arange(len(level) + 1))))

    def search(self, queries: np.ndarray, own: np.ndarray, labels: np.ndarray, of: np.ndarray, low: np.ndarray, high: np.ndarray,
               same: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(window, id, score)`` of the first k points of every window ``(of, low, high, same)``, ``of`` naming its query."""
        q = queries.astype(np.float64)
        norm = (q * q).sum(axis=1)
        top = _Top(len(of), k, low)
        exact = np.float64 if norm.max(initial=0) * self.big < 2.0**104 else np.int64
        look = _Look(self, queries.astype(exact), own, labels, of, low, high, same, exact)

        def open_(depth: int, w: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            _, centre, own_norm, radius, _ = self.levels[depth]
            names, place = np.unique(of[w], return_inverse=True)
            least, most = _bounds((q[names] @ centre.T)[place, node], norm[of[w]], own_norm[node], radius[node], self.big)
            good = (least <= high[w]) & (most >= top.least[w])
            return w[good], node[good], np.minimum(most[good], high[w[good]])

        # A dive to the best leaf of every window gives a first k-th score.
        for dive in (True, False):
            w, node, most = open_(0, np.arange(len(of)), np.zeros(len(of), np.int64))
            leaves = []
            for depth in range(len(self.levels)):
                child = self.levels[depth][4]
                size = child[node + 1] - child[node]
                leaves.append((np.full((size == 0).sum(), depth), w[size == 0], node[size == 0], most[size == 0]))
                if not size.any():
                    break
                wide = np.repeat(np.arange(len(w)), size)
                below = child[node[wide]] + np.arange(len(wide)) - np.repeat(np.cumsum(size) - size, size)
                w, node, most = open_(depth + 1, w[wide], below)
                if dive:
                    best = np.lexsort((-most, w))
                    best = best[np.diff(w[best], prepend=-1) != 0]
                    w, node, most = w[best], node[best], most[best]
            depth, w, node, most = (np.concatenate(x) for x in zip(*leaves))
            look.verify(top, depth, w, node, most)
        return top.window, top.id, top.score


class _Top:
    """The first k of every window so far, and the score that another one has to reach."""

    def __init__(self, windows: int, k: int, low: np.ndarray):
        self.k, self.windows, self.low, self.least = k, windows, low, low.copy()
        self.window, self.id, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, window: np.ndarray, id: np.ndarray, score: np.ndarray) -> None:
        window, id, score = np.concatenate([self.window, window]), np.concatenate([self.id, id]), np.concatenate([self.score, score])
        order = np.lexsort((id, ~score, window))  # ~ turns the order round without leaving the range
        window, id, score = window[order], id[order], score[order]
        rank = np.arange(len(window)) - np.searchsorted(window, window)
        self.window, self.id, self.score = window[rank < self.k], id[rank < self.k], score[rank < self.k]
        full = rank == self.k - 1
        self.least[window[full]] = np.maximum(self.least[window[full]], score[full])


class _Look:
    """Verification of leaves."""

    def __init__(self, tree: CoverTree, queries, own, labels, of, low, high, same, kind):
        self.tree, self.queries, self.own, self.labels = tree, queries, own, labels
        self.of, self.low, self.high, self.same, self.points = of, low, high, same, tree.points.astype(kind)
        self.dived = np.full(len(of), -1)

    def verify(self, top: _Top, depth: np.ndarray, w: np.ndarray, node: np.ndarray, most: np.ndarray) -> None:
        """Best leaves first; each round takes twice as many leaves of a window as the one before."""
        name = depth * len(self.points) + node
        new = name != self.dived[w]
        depth, w, node, most, name = depth[new], w[new], node[new], most[new], name[new]
        if self.dived.max(initial=-1) < 0:
            self.dived[w] = name
        order = np.lexsort((-most, w))
        depth, w, node, most, name = depth[order], w[order], node[order], most[order], name[order]
        rank = np.arange(len(w)) - np.searchsorted(w, w)
        step = np.floor(np.log2(rank + 1)).astype(np.int64)
        for r in range(int(step.max(initial=-1)) + 1):
            now = np.flatnonzero((step == r) & (most >= top.least[w]))
            now = now[np.argsort(name[now], kind="stable")]
            edges = np.flatnonzero(np.diff(name[now], prepend=-1, append=-1)).tolist()
            found = []
            for a, b in zip(edges[:-1], edges[1:]):
                first = now[a]
                start, stop = self.tree.levels[depth[first]][0][node[first]].tolist()
                found.append(self._leaf(top, w[now[a:b]], start, stop))
            if found:
                top.add(*(np.concatenate(x) for x in zip(*found)))

    def _leaf(self, top: _Top, w: np.ndarray, start: int, stop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Points of a leaf that are in windows ``w`` (in order, as are their queries)."""
        tree, query = self.tree, self.of[w]
        head = np.flatnonzero(np.diff(query, prepend=-1))
        score = (self.queries[query[head]] @ self.points[start:stop].T).astype(np.int64)
        score = score[np.repeat(np.arange(len(head)), np.diff(np.append(head, len(w))))]
        labels, ids = tree.labels[start:stop], tree.ids[start:stop]
        good = (score >= top.least[w][:, None]) & (score <= self.high[w][:, None])
        good &= (labels == self.labels[query][:, None]) == self.same[w][:, None]
        good &= ids != self.own[query][:, None]
        i, j = np.nonzero(good)
        return w[i], ids[j], score[i, j]


def _assign(centres: dict[int, np.ndarray], big: float):
    """Rows to the nearest centre of their length: ``cell`` and the distance."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, len(whole), 4096):
                batch = whole.slice(k, 4096)
                cell, away = np.zeros(len(batch), np.int32), np.zeros(len(batch))
                dims, vectors = batch.column(2).to_numpy(), batch.column(3)
                for d in np.unique(dims).tolist():
                    rows = np.flatnonzero(dims == d)
                    x = _raised(_matrix(vectors.take(pa.array(rows)).to_pylist()), big)
                    c = centres.get(d, _raised(np.zeros((1, d)), big))
                    square = (x * x).sum(axis=1)[:, None] + (c * c).sum(axis=1) - 2 * x @ c.T
                    cell[rows] = square.argmin(axis=1)
                    away[rows] = np.linalg.norm(x - c[cell[rows]], axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(away)], names=[*batch.schema.names, "cell", "away"])
    return run


def _route(cells: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], big: float, home: bool):
    """Queries to ``cell``s that may hold a score of one of their windows: all but their own, unless ``home``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, len(whole), 1024):
                batch = whole.slice(k, 1024)
                dims, own = batch.column(2).to_numpy(), batch.column(4).to_numpy()
                for d in np.unique(dims).tolist():
                    if d not in cells:
                        continue
                    rows = np.flatnonzero(dims == d)
                    number, centre, radius = cells[d]
                    part = batch.take(pa.array(rows))
                    q = _matrix(part.column(3).to_pylist()).astype(np.float64)
                    norm = (q * q).sum(axis=1)[:, None]
                    least, most = _bounds(q @ centre[:, :-1].T, norm, (centre * centre).sum(axis=1), radius, big)
                    good = np.zeros(least.shape, bool)
                    for r, (low, high) in enumerate(zip(part.column(6).to_pylist(), part.column(7).to_pylist())):
                        for a, b in zip(low, high):
                            good[r] |= (least[r] <= b) & (most[r] >= a)
                    if not home:
                        good &= number != own[rows][:, None]
                    i, j = np.nonzero(good)
                    yield pa.RecordBatch.from_arrays([*part.take(pa.array(i)).columns, pa.array(number[j].astype(np.int32))],
                                                     names=[*part.schema.names, "cell"])
    return run


def _search(big: float, k: int):
    """Sorted rows (dims, cell, chunk, kind, ...): the rows of a shard, then its queries."""
    def answers(tree: CoverTree, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for s in range(0, len(batch), QUERIES):
            part = batch.slice(s, QUERIES)
            low, high, tags = (part.column(n).to_pylist() for n in (8, 9, 10))
            size = [len(x) for x in low]
            of = np.repeat(np.arange(len(part)), size)
            flat = [np.fromiter((v for x in y for v in x), np.int64, len(of)) for y in (low, high, tags)]
            own, labels = part.column(4).to_numpy(), part.column(5).to_numpy()
            same = part.column(7).to_numpy(zero_copy_only=False).astype(bool)
            w, other, score = tree.search(_matrix(part.column(6).to_pylist()), own, labels, of, flat[0], flat[1], same[of], k)
            yield pa.RecordBatch.from_arrays([pa.array(own[of[w]]), pa.array(flat[2][w]), pa.array(other), pa.array(score)],
                                             names=["anchor", "tag", "other", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, tree = None, [], None
        for batch in batches:
            key = np.stack([batch.column(n).to_numpy() for n in range(4)])
            edges = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), len(batch)]
            for start, stop in zip(edges[:-1], edges[1:]):
                if stop == start:
                    continue
                shard, kind = tuple(key[:3, start].tolist()), int(key[3, start])
                if shard != now:
                    now, parts, tree = shard, [], None
                part = batch.slice(start, stop - start)
                if kind == 0:
                    parts.append(part)
                elif parts:
                    if tree is None:
                        rows = pa.Table.from_batches(parts)
                        tree = CoverTree(_matrix(rows.column(6).to_pylist()), rows.column(4).to_numpy(), rows.column(5).to_numpy(), big)
                    yield from answers(tree, part)
    return run


class Cover:
    """The cells of all candidates, and searches over them."""

    def __init__(self, candidates: DataFrame, k: int):
        self.k = k
        candidates = keep(candidates)
        self.spark = candidates.sparkSession
        self.big = float(candidates.agg(F.max("norm")).first()[0] or 0.0)
        rows = {r["dims"]: r["n"] for r in candidates.groupBy("dims").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dims").limit(SAMPLE).collect()}
        sample = candidates.orderBy(F.xxhash64("id"), "id", "label", "vector").limit(SAMPLE).select("dims", "vector").collect()
        self.centres = {}
        for d in sorted({r["dims"] for r in sample}):
            points = _raised(_matrix([r["vector"] for r in sample if r["dims"] == d]), self.big)
            self.centres[d] = points[_farthest_first(points, 0, min(CENTRES, -(-rows.get(d, 1) // SHARD)), 0.0)[0]]
        self.rows = keep(self.assign(candidates))
        cells = self.rows.groupBy("dims", "cell").agg(F.count("*").alias("n"), F.max("away").alias("radius"))
        self.cells = keep(cells.select("dims", "cell", "radius", F.ceil(F.col("n") / SHARD).cast("int").alias("chunks")))
        self.placed = (self.rows.join(self.cells, ["dims", "cell"])
                       .withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")))

    def assign(self, packed: DataFrame) -> DataFrame:
        return packed.mapInArrow(_assign(self.centres, self.big), PACKED + ", cell int, away double")

    def _balls(self) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Cells by length: at most ``CENTRES`` of each length in the sample, and one of every other length."""
        out: dict[int, list] = {}
        for r in self.cells.select("dims", "cell", "radius").collect():
            out.setdefault(r["dims"], []).append((r["cell"], r["radius"]))
        return {d: (np.array([c for c, _ in x]), self.centres.get(d, _raised(np.zeros((1, d)), self.big))[[c for c, _ in x]],
                    np.array([r for _, r in x])) for d, x in out.items()}

    def search(self, queries: DataFrame, home: bool = True) -> DataFrame:
        routed = queries.mapInArrow(_route(self._balls(), self.big, home), QUERY + ", cell int")
        return self.search_cells(routed)

    def search_cells(self, routed: DataFrame) -> DataFrame:
        each = routed.join(self.cells.select("dims", "cell", "chunks"), ["dims", "cell"]).withColumn(
            "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        none = F.array().cast("array<bigint>")
        shard = ["dims", "cell", "chunk"]
        rows = self.placed.select(*shard, F.lit(0).alias("kind"), "id", "label", "vector", F.lit(False).alias("same"),
                                  none.alias("low"), none.alias("high"), none.alias("tags"))
        both = rows.unionByName(each.select(*shard, F.lit(1).alias("kind"), "id", "label", "vector", "same", "low", "high", "tags"))
        return both.repartition(*shard).sortWithinPartitions(*shard, "kind").mapInArrow(_search(self.big, self.k), FOUND)


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "other")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(table: DataFrame, anchors: Column, id: str = "vec_id", vector: str = "embedding", label: str = "label",
                   k: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """For each anchor and each of its first k rows of the same label, the first k rows of other labels whose score has at
    least ``low`` and at most ``high`` percent of the positive's. ``anchors`` is a condition on ``id``.
    """
    every = table.select(named(id).cast("long").alias("id"), named(label).cast("long").alias("label"), named(vector).alias("vector"))
    every = every.where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector")))
    whole = F.transform("vector", lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("bigint"))
    huge = F.exists("vector", lambda x: F.abs(SCALE * x.cast("double")) >= 2.0**62)
    every = keep(every.where(~huge).select("id", "label", whole.alias("vector")).distinct().mapInArrow(_pack, PACKED))
    same = Window.partitionBy("label", "vector").orderBy("id")
    candidates = every.withColumn("spot", F.row_number().over(same)).where(F.col("spot") <= k + 1).drop("spot")
    cover = Cover(candidates, k)

    def one(value: int) -> Column:
        return F.array(F.lit(value).cast("bigint"))

    marked = keep(cover.assign(every.where(anchors)).select(
        "id", "label", "dims", "vector", F.col("cell").alias("home"), F.lit(True).alias("same"),
        one(LEAST).alias("low"), one(MOST).alias("high"), one(0).alias("tags")))
    near = keep(cover.search_cells(marked.withColumn("cell", F.col("home"))))
    least = _first(near, ["anchor"], k).where(F.col("rank") == k).select(F.col("anchor").alias("id"), F.col("score").alias("least"))
    rest = (marked.join(least, "id", "left").withColumn("low", F.array(F.coalesce("least", F.element_at("low", 1))))
            .select(marked.columns))
    positives = keep(_first(near.union(cover.search(rest, home=False)), ["anchor"], k)
                     .select("anchor", F.col("other").alias("positive"), F.col("score").alias("top")))

    wide = F.col("top").cast("decimal(19,0)")
    windows = positives.select("anchor", "positive", F.ceil(wide * low / 100).cast("bigint").alias("from"),
                               F.floor(wide * high / 100).cast("bigint").alias("to")).where("from <= to")
    windows = windows.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("positive", "from", "to"))).alias("x"))  # at most k
    hard = (marked.join(windows, marked["id"] == windows["anchor"]).withColumn("same", F.lit(False))
            .withColumn("low", F.col("x.from")).withColumn("high", F.col("x.to")).withColumn("tags", F.col("x.positive")).select(marked.columns))
    found = _first(cover.search(hard), ["anchor", "tag"], k)
    tops = positives.withColumnRenamed("anchor", "a")
    return found.join(tops, (F.col("anchor") == F.col("a")) & (F.col("tag") == F.col("positive"))).select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.col("other").alias("negative_id"), F.col("top").alias("positive_score"), F.col("score").alias("negative_score"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh vector has the next label."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("id") % 100 == 0)


SQL = """
WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT a.vec_id AS anchor, a.label AS own, b.vec_id AS other, b.label AS label, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor, other AS positive, score AS top FROM s WHERE label = own
      QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5)
SELECT p.anchor AS anchor_id, positive AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor, positive ORDER BY score DESC, other) AS INTEGER) AS rank,
       other AS negative_id, top AS positive_score, score AS negative_score
FROM p JOIN s ON s.anchor = p.anchor AND s.label <> s.own AND 80 * top <= 100 * score AND score <= top
QUALIFY row_number() OVER (PARTITION BY p.anchor, positive ORDER BY score DESC, other) <= 5
"""
