"""Approximate nearest neighbours by balanced posting lists and an in-memory graph of their centroids.

Nearness is the inner product. Vectors get one more component that makes them all
equally long, which turns the largest inner product into the smallest distance.
Centroids are fitted on a bounded sample and split until the lists are about
balanced. A vector goes to its nearest centroid's list and, near a boundary, to
those of further centroids about as near. A query walks a graph of the centroids
and searches the lists whose distance is within a ratio of the nearest one's, and
further ones until those hold as many vectors as are asked for. The ratio is fitted on the sample too, from where the true neighbours of sample
vectors lie.

Equal vectors are one class: with ties going to smaller ids, no more than the
first ``k + 1`` ids of a class can be anyone's neighbours. Lists that are still
long, and lists that many queries search, are cut into pieces, and each pair of
pieces is one unit of work.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import stored

#: Bounds of the sample and of the number of lists; vectors a list is planned for.
SAMPLE, MOST_LISTS, LIST_SIZE = 20_000, 4096, 512
#: A vector is in at most this many lists, and a centroid has this many neighbours in the graph.
COPIES, DEGREE = 6, 24
#: Boundary vectors: squared distance within this ratio of the nearest centroid's.
BOUNDARY = 1.15
#: Share of sample neighbours whose list a query must reach when the ratio is fitted.
REACH = 0.98
#: Vectors and queries of one unit of work.
PIECE, QUERY_PIECE = 4096, 1024
#: Distances that are worked out at a time, and rows that are handed on at a time: both grow with the lists otherwise.
AT_A_TIME, ROWS_OUT = 1 << 20, 10_000
#: Lists whose answers to a query are put together at a time, about.
TOGETHER = 64


@dataclass(frozen=True)
class Index:
    """Centroids with their graph; ``scale`` is the longest vector's length."""

    scale: float
    centroids: np.ndarray
    graph: np.ndarray
    entry: np.ndarray
    ratio: float


def _augmented(vectors: np.ndarray, scale: float) -> np.ndarray:
    inner = vectors / scale
    rest = np.sqrt(np.maximum(0.0, 1 - (inner**2).sum(axis=1)))
    return np.concatenate([inner, rest[:, None]], axis=1)


def _as_queries(vectors: np.ndarray) -> np.ndarray:
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.concatenate([unit, np.zeros((len(unit), 1))], axis=1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum(0.0, (a**2).sum(1)[:, None] - 2 * a @ b.T + (b**2).sum(1)[None])


def _near(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """``_distances`` in blocks of rows of ``a``, each with its first row."""
    step = max(1, AT_A_TIME // max(1, len(b)))
    for start in range(0, len(a), step):
        yield start, _distances(a[start : start + step], b)


def _nearest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.concatenate([d.argmin(axis=1) for _, d in _near(a, b)]) if len(a) else np.zeros(0, np.int64)


def _kmeans(points: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    centroids = points[rng.choice(len(points), k, replace=False)]
    near = np.zeros(len(points), np.int64)
    for _ in range(rounds):
        near = _nearest(points, centroids)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, points)
        counts = np.bincount(near, minlength=k)
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
    return centroids, near


def _balanced(points: np.ndarray, k: int) -> np.ndarray:
    """About ``k`` centroids; clusters of over twice the mean size are split in two until none is left."""
    rng = np.random.default_rng(5)
    most = max(2, 2 * -(-len(points) // k))
    todo = []
    _, near = _kmeans(points, k, rng)
    todo = [np.flatnonzero(near == c) for c in range(k)]
    out = []
    while todo:
        at = todo.pop()
        if not len(at):
            continue
        if len(at) > most and len(out) + len(todo) < MOST_LISTS:
            _, side = _kmeans(points[at], 2, rng)
            if 0 < side.sum() < len(at):
                todo += [at[side == 0], at[side == 1]]
                continue
        out.append(points[at].mean(axis=0))
    return np.array(out)


def _walk(index: Index, query: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``width`` nearest centroids found by a best-first walk over the graph, and their squared distances."""
    centroids, graph = index.centroids, index.graph
    seen = set(index.entry.tolist())
    d = ((centroids[index.entry] - query) ** 2).sum(axis=1)
    ahead = [(x, int(i)) for x, i in zip(d.tolist(), index.entry)]
    heapq.heapify(ahead)
    best = [(-x, i) for x, i in ahead]
    heapq.heapify(best)
    while len(best) > width:
        heapq.heappop(best)
    while ahead:
        x, i = heapq.heappop(ahead)
        if len(best) >= width and x > -best[0][0]:
            break
        # The ring's neighbour may be among the nearest ones too.
        new = [j for j in dict.fromkeys(graph[i].tolist()) if j not in seen]
        if not new:
            continue
        seen.update(new)
        for y, j in zip(((centroids[new] - query) ** 2).sum(axis=1).tolist(), new):
            if len(best) < width or y < -best[0][0]:
                heapq.heappush(ahead, (y, j))
                heapq.heappush(best, (-y, j))
                if len(best) > width:
                    heapq.heappop(best)
    found = sorted((-x, i) for x, i in best)
    return np.array([i for _, i in found]), np.array([x for x, _ in found])


def _lists_of(index: Index, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(point, list, own)``: the nearest centroid (``own``), and further ones for points near a boundary."""
    k = min(COPIES, len(index.centroids))
    parts = []
    for start, d in _near(points, index.centroids):
        near = np.argpartition(d, k - 1, axis=1)[:, :k]
        dist = np.take_along_axis(d, near, 1)
        good = dist <= dist.min(axis=1, keepdims=True) * BOUNDARY
        rows, cols = np.nonzero(good)
        parts.append((rows + start, near[rows, cols], cols == dist.argmin(axis=1)[rows]))
    return tuple(np.concatenate(column) for column in zip(*parts))


def _searched(index: Index, queries: np.ndarray, held: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each query the lists within the ratio of the nearest one's distance, and further ones until they hold
    ``least`` vectors; ``held`` counts each vector in its own list."""
    for i, query in enumerate(queries):
        width = 32
        while True:
            lists, d = _walk(index, query, width)
            inside = int((d <= d[0] * index.ratio + 1e-12).sum())
            enough = int(np.searchsorted(np.cumsum(held[lists]), least)) + 1
            # Widen the walk until it leaves both, so that its width does not select.
            if max(inside, enough) < len(lists) or width >= len(index.centroids):
                yield i, lists[: max(inside, enough)]
                break
            width = min(2 * width, len(index.centroids))


def fit(sample: np.ndarray, scale: float, n: int, k: int) -> Index:
    """Index for ``n`` different vectors from a sample of them; ``k`` neighbours are asked for."""
    points = _augmented(sample, scale)
    lists = int(np.clip(-(-n // LIST_SIZE), 1, min(MOST_LISTS, max(1, len(points) // 4))))
    centroids = _balanced(points, lists) if len(points) > 1 else points
    graph = np.concatenate([np.argsort(d, axis=1, kind="stable")[:, 1 : DEGREE + 1] for _, d in _near(centroids, centroids)])
    # A ring over all centroids keeps the graph connected.
    ring = np.roll(np.arange(len(centroids)), -1)[:, None]
    graph = np.concatenate([graph, ring], axis=1)
    entry = np.unique(np.linspace(0, len(centroids) - 1, min(16, len(centroids))).astype(int))
    index = Index(scale, centroids, graph, entry, 1.0)
    # Where the neighbours of sample vectors lie: the least ratio that reaches a list of each.
    asked = np.random.default_rng(9).choice(len(sample), min(400, len(sample)), replace=False)
    queries = _as_queries(sample[asked])
    to_lists = _distances(queries, centroids)
    rows, of, _ = _lists_of(index, points)
    needed = []
    for i, row in enumerate(asked):
        scores = sample @ sample[row]
        scores[row] = -np.inf
        top = np.argpartition(-scores, min(k, len(scores) - 1))[:k] if len(scores) > 1 else np.zeros(0, int)
        ratio = to_lists[i] / max(to_lists[i].min(), 1e-12)
        mark = np.full(len(sample), np.inf)
        chosen = np.isin(rows, top)
        np.minimum.at(mark, rows[chosen], ratio[of[chosen]])
        needed.extend(mark[top].tolist())
    ratio = float(np.quantile(needed, REACH)) if needed else 1.0
    return Index(scale, centroids, graph, entry, max(1.0, ratio))


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v``: the vectors that take part, as doubles.

    Null ids, null and zero vectors and vectors with null or non-finite components are
    left out, and so are vectors of another length than the most frequent one.
    """
    v = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).filter("vec_id is not null and v is not null")
    rows = rows.filter(F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0))
    most = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.filter(F.size("v") == (most["d"] if most else 0))


def _one_per_id(rows: DataFrame) -> DataFrame:
    """The smallest vector of each id; only repeated ids are gathered."""
    repeated = rows.groupBy("vec_id").count().filter("count > 1").select("vec_id")
    if repeated.isEmpty():
        return rows
    again = rows.join(repeated, "vec_id", "left_semi").groupBy("vec_id").agg(F.min("v").alias("v"))
    return rows.join(repeated, "vec_id", "left_anti").select("vec_id", "v").unionByName(again)


def _first_of_class(rows: DataFrame, k: int) -> DataFrame:
    """Rows whose id is among the ``k`` smallest of their class; large classes are thinned in pieces first."""
    piece = F.pmod(F.xxhash64("vec_id"), F.lit(64))
    within = Window.partitionBy("c", piece).orderBy("vec_id")
    thinned = rows.withColumn("r", F.row_number().over(within)).filter(F.col("r") <= k)
    return thinned.withColumn("r", F.row_number().over(Window.partitionBy("c").orderBy("vec_id"))).filter(F.col("r") <= k).drop("r")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _pairs(index: Index, vectors: np.ndarray, held: np.ndarray | None, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(row, list, own)`` of vectors, or of queries where ``held`` is given, about ``ROWS_OUT`` at a time."""
    if held is None:
        at, lists, own = _lists_of(index, _augmented(vectors, index.scale))
        for start in range(0, len(at), ROWS_OUT):
            yield at[start : start + ROWS_OUT], lists[start : start + ROWS_OUT], own[start : start + ROWS_OUT]
        return
    rows: list[int] = []
    found: list[np.ndarray] = []

    def together() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lists = np.concatenate(found)
        return np.repeat(np.array(rows, np.int64), [len(x) for x in found]), lists, np.zeros(len(lists), bool)

    n = 0
    for i, lists in _searched(index, _as_queries(vectors), held, least):
        # A query may search any share of the lists.
        if found and n + len(lists) > ROWS_OUT:
            yield together()
            rows, found, n = [], [], 0
        rows.append(i)
        found.append(lists)
        n += len(lists)
    if found:
        yield together()


def _to_lists(rows: DataFrame, key: str, index, held: np.ndarray | None = None, least: int = 0) -> DataFrame:
    """``list, key, v, own`` for every list of every row; rows are queries where ``held`` is given."""
    shared = rows.sparkSession.sparkContext.broadcast((index, held))  # at most MOST_LISTS centroids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, held = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                for at, lists, own in _pairs(index, _matrix(part.column("v")), held, least):
                    taken = part.take(pa.array(at))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(lists.astype(np.int32)), taken.column(key), taken.column("v"), pa.array(own)], names=["list", key, "v", "own"]
                    )

    return rows.select(key, "v").mapInArrow(run, f"list int, {key} long, v array<double>, own boolean")


def exact_scores(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products summed in one fixed order, so that equal vectors get equal scores."""
    return (vectors * query).sum(axis=1)


def _best(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out_q, out_ids, out_scores = [], [], []
        if left.num_rows and right.num_rows:
            queries = _matrix(left.column("v").combine_chunks())
            vectors = _matrix(right.column("v").combine_chunks())
            ids = right.column("vec_id").to_numpy()
            rough = queries @ vectors.T
            keys = left.column("q").to_pylist()
            for i, q in enumerate(keys):
                row = rough[i]
                if len(row) > k:
                    cut = np.partition(row, len(row) - k)[len(row) - k]
                    at = np.flatnonzero(row >= cut - 1e-9 * max(1.0, abs(cut)))
                else:
                    at = np.arange(len(row))
                scores = exact_scores(queries[i], vectors[at])
                order = np.lexsort((ids[at], -scores))[:k]
                out_q.append(q)
                out_ids.append(ids[at][order])
                out_scores.append(scores[order])
        return pa.table({
            "q": pa.array(out_q, pa.int64()),
            "ids": pa.array(out_ids, pa.list_(pa.int64())),
            "scores": pa.array(out_scores, pa.list_(pa.float64())),
        })

    return run


def _merged(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """``by, best``: the ``k`` best of several lists of answers ``near``."""
    # Sorted, what several lists hold of one vector is side by side.
    gathered = found.groupBy(*by).agg(F.sort_array(F.flatten(F.collect_list("near"))).alias("all"))
    once = F.filter("all", lambda x, i: (i == 0) | (x["vec_id"] != F.get("all", i - 1)["vec_id"]))
    return gathered.select(*by, F.slice(once, 1, k).alias("best"))


def search(vectors: DataFrame, is_query: Column | str, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest other vectors found for every row that ``is_query`` holds for.

    ``score`` is the inner product in double precision, nearest first, ties to the
    smaller id, rank from 1. A query's candidates are all rows with another id; it has fewer
    than ``k`` answers only where the table has. Of rows with one ``vec_id`` the one with the
    smallest vector counts. What ``usable`` leaves out takes no part; an empty table gives no rows.
    """
    rows = stored(_one_per_id(usable(vectors)).withColumn("c", F.xxhash64("v")), "vectors")
    n, scale = rows.agg(F.count("*"), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if not n:
        return vectors.sparkSession.createDataFrame([], schema)
    base = stored(_first_of_class(rows, k + 1), "vector-classes")
    different = base.agg(F.count_distinct("c")).first()[0]
    drawn = base.filter(F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(1 << 30)) < (1 << 30) * min(1.0, 1.2 * SAMPLE / n))
    sample = drawn.orderBy("vec_id").limit(SAMPLE).select("v").toArrow().column("v")
    index = fit(np.unique(_matrix(sample.combine_chunks()), axis=0), scale, different, k) if len(sample) else None
    if index is None:
        first = base.orderBy("vec_id").limit(SAMPLE).select("v").toArrow().column("v")
        index = fit(np.unique(_matrix(first.combine_chunks()), axis=0), scale, different, k)

    queries = rows.filter(is_query).select(F.col("vec_id").alias("query_id"), "c", "v")
    one = _first_of_class(queries.withColumnRenamed("query_id", "vec_id"), 1).select(F.col("c").alias("q"), "v")
    lists = stored(_to_lists(base, "vec_id", index), "posting-lists")
    held = np.zeros(len(index.centroids), np.int64)
    for r in lists.filter("own").groupBy("list").count().collect():  # at most MOST_LISTS
        held[r["list"]] = r["count"]
    asked = stored(_to_lists(one, "q", index, held, k + 1), "asked-lists")
    # How many pieces each list and its queries are cut into; at most MOST_LISTS rows.
    pieces = F.ceil(F.col("n") / PIECE).cast("int").alias("pieces")
    query_pieces = F.ceil(F.col("n") / QUERY_PIECE).cast("int").alias("query_pieces")
    sizes = lists.groupBy("list").agg(F.count("*").alias("n")).select("list", pieces)
    loads = asked.groupBy("list").agg(F.count("*").alias("n")).select("list", query_pieces)
    plan = F.broadcast(stored(sizes.join(loads, "list"), "list-pieces"))
    zero = F.lit(0)
    right = lists.join(plan, "list").withColumn("piece", F.pmod(F.xxhash64("vec_id"), F.col("pieces")).cast("int"))
    right = right.select("list", "piece", F.explode(F.sequence(zero, F.col("query_pieces") - 1)).alias("query_piece"), "vec_id", "v")
    left = asked.join(plan, "list").withColumn("query_piece", F.pmod(F.xxhash64("q"), F.col("query_pieces")).cast("int"))
    left = left.select("list", F.explode(F.sequence(zero, F.col("pieces") - 1)).alias("piece"), "query_piece", "q", "v")
    unit = ["list", "piece", "query_piece"]
    found = left.groupBy(*unit).cogroup(right.groupBy(*unit)).applyInArrow(_best(k + 1), "q long, ids array<long>, scores array<double>")
    # The best k + 1 of a class of queries: one of them may be a query's own row. At most k + 1 of each list meet here.
    near = F.transform(F.arrays_zip("scores", "ids"), lambda x: F.struct((F.lit(0.0) - x["scores"]).alias("minus"), x["ids"].alias("vec_id")))
    found = found.select("q", near.alias("near"))
    parts = len(index.centroids) // TOGETHER
    if parts > 1:
        slot = F.pmod(F.xxhash64("near"), F.lit(parts)).alias("slot")
        found = _merged(found.select("*", slot), ["q", "slot"], k + 1).select("q", F.col("best").alias("near"))
    best = _merged(found, ["q"], k + 1)
    own = queries.select("query_id", F.col("c").alias("q")).distinct().join(best, "q")
    others = F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("query_id")), 1, k)
    ranked = own.select("query_id", F.posexplode(others).alias("pos", "b"))
    return ranked.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), "b.vec_id", (F.lit(0.0) - F.col("b.minus")).alias("score"))
