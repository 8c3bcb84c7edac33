"""Nearest neighbours by balanced posting lists around centroids held in memory.

Centroids come from halving a bounded sample again and again at the median, so every
list stands for about as many vectors. A graph of near centroids, small enough for every
worker, finds the centroids next to a vector. A vector on a boundary is put in the lists
of several centroids: those hardly farther than the nearest one, unless one of the chosen
centroids lies close to them. A query reads the lists whose centroids are within
a ratio of the nearest one's distance, and distances to what they hold are exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from conduit.llm.common import batch, ship, sorted_by
from conduit.session import cut_lineage

NEAREST = 10
# Bounds of what is fitted on the driver and sent to every worker.
SAMPLE, MOST_LISTS = 16384, 4096
LIST_ROWS = 128  # vectors that a list is meant for
LIST_BLOCK = 4096  # vectors of a list that are one block; a longer list has several
REPLICAS, REPLICA_RATIO, APART = 4, 1.2, 0.3
LEAST_PROBES, PROBES, PROBE_RATIO = 32, 96, 1.25
_LINKS, _FAR_LINKS, _DOORS, _OPENED = 16, 4, 48, 6
_ROWS_AT_ONCE = 256


def halved(sample: np.ndarray, lists: int) -> np.ndarray:
    """Means of about ``lists`` groups of equal size, by halving along the widest direction."""
    groups = [np.arange(len(sample))]
    while len(groups) < lists and max(map(len, groups)) >= 2:
        groups = [half for g in groups for half in _halves(sample, g)]
    return np.array([sample[g].mean(0) for g in groups if len(g)], np.float64)


def _halves(sample: np.ndarray, group: np.ndarray):
    if len(group) < 2:
        return [group]
    points = sample[group]
    direction = points[np.argmax(((points - points.mean(0)) ** 2).sum(1))] - points.mean(0)
    for _ in range(4):  # towards the main direction of the group
        moved = (points - points.mean(0)).T @ ((points - points.mean(0)) @ direction)
        norm = np.linalg.norm(moved)
        if norm == 0:
            break
        direction = moved / norm
    order = np.argsort(points @ direction, kind="stable")
    return [group[order[: len(order) // 2]], group[order[len(order) // 2 :]]]


class CentroidGraph:
    """Centroids and links between near ones, searched with a beam."""

    def __init__(self, centroids: np.ndarray, seed: int = 3):
        self.centroids = centroids.astype(np.float32)
        n = len(centroids)
        draw = np.random.default_rng(seed)
        near = min(_LINKS, max(n - 1, 1))
        self.links = np.zeros((n, near + min(_FAR_LINKS, n)), np.int32)
        self.norms = (self.centroids**2).sum(1)
        for i in range(0, n, 512):
            apart = self._apart(self.centroids[i : i + 512], np.arange(n))
            apart[np.arange(len(apart)), i + np.arange(len(apart))] = np.inf
            self.links[i : i + 512, :near] = np.argpartition(apart, near - 1, axis=1)[:, :near] if n > 1 else 0
        self.links[:, near:] = draw.integers(0, n, (n, self.links.shape[1] - near))
        self.doors = np.sort(draw.choice(n, min(n, _DOORS), replace=False))

    def _apart(self, x, ids):
        c = self.centroids[ids]
        if c.ndim == 2:
            return (x**2).sum(1)[:, None] + self.norms[ids] - 2 * (x @ c.T)
        return (x**2).sum(1)[:, None] + self.norms[ids] - 2 * np.einsum("bd,bmd->bm", x, c)

    def search(self, vectors: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the nearest centroids found, nearest first."""
        beam = min(beam, len(self.centroids))
        ids, apart = [], []
        for i in range(0, len(vectors), _ROWS_AT_ONCE):
            a, b = self._search(vectors[i : i + _ROWS_AT_ONCE].astype(np.float32), beam)
            ids.append(a)
            apart.append(b)
        if not ids:
            return np.zeros((0, beam), np.int64), np.zeros((0, beam))
        return np.concatenate(ids), np.sqrt(np.maximum(np.concatenate(apart), 0)).astype(np.float64)

    def _search(self, x, beam):
        """Best-first: the nearest centroids not opened yet are opened, until none is in the beam."""
        n, rows = len(self.centroids), np.arange(len(x))[:, None]
        apart = np.full((len(x), n), np.inf, np.float32)
        opened = np.zeros((len(x), n), bool)
        apart[:, self.doors] = self._apart(x, self.doors)
        for _ in range(-(-n // _OPENED)):
            edge = np.partition(apart, beam - 1, axis=1)[:, beam - 1 : beam]
            waiting = np.where(opened | (apart > edge), np.inf, apart)
            some = min(_OPENED, n)
            pick = np.argpartition(waiting, some - 1, axis=1)[:, :some]
            live = np.isfinite(np.take_along_axis(waiting, pick, 1))
            going = live.any(1)
            if not going.any():
                break
            r = np.flatnonzero(going)
            opened[rows[r], pick[r]] |= live[r]
            reach = self.links[pick[r]].reshape(len(r), -1)
            apart[rows[r], reach] = self._apart(x[r], reach)
        order = np.argsort(apart, axis=1)[:, :beam]
        return order, np.take_along_axis(apart, order, 1)


def homes(graph: CentroidGraph, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and list of every copy of the vectors: the nearest list and those on a boundary."""
    ids, apart = graph.search(vectors, 32)
    rows, lists = [np.arange(len(vectors))], [ids[:, 0]]
    chosen = np.zeros(ids.shape, bool)
    chosen[:, 0] = True
    for k in range(1, ids.shape[1]):
        close = (apart[:, k] <= REPLICA_RATIO * apart[:, 0]) & (chosen.sum(1) < REPLICAS)
        between = ((graph.centroids[ids[:, :k]] - graph.centroids[ids[:, k]][:, None]) ** 2).sum(2)
        hidden = (chosen[:, :k] & (between < ((APART * apart[:, k]) ** 2)[:, None])).any(1)
        take = close & ~hidden & np.isfinite(apart[:, k])
        chosen[:, k] = take
        rows.append(np.flatnonzero(take))
        lists.append(ids[take, k])
    return np.concatenate(rows), np.concatenate(lists)


def probes(graph: CentroidGraph, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and list of every list that the vectors' neighbours are looked for in."""
    ids, apart = graph.search(vectors, PROBES + 16)
    ids, apart = ids[:, :PROBES], apart[:, :PROBES]
    take = np.isfinite(apart) & (apart <= PROBE_RATIO * apart[:, :1] + 1e-9)
    take[:, :LEAST_PROBES] |= np.isfinite(apart[:, :LEAST_PROBES])
    row, column = np.nonzero(take)
    return row, ids[row, column]


def _valid(rows: DataFrame) -> DataFrame:
    """``(vec_id, vector)`` of the rows that take part, vectors as doubles."""
    vector = F.col("embedding").cast("array<double>")
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
    whole = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where("vec_id is not null and vector is not null").where(
        whole & F.exists("vector", lambda x: x != 0.0)
    )
    # minus zero is zero, and equal vectors must be equal arrays
    return rows.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))


_ROWS_SQL = "list int, block int, ask boolean, id long, vector array<double>"
_ROWS = pa.schema([("list", pa.int32()), ("block", pa.int32()), ("ask", pa.bool_()), ("id", pa.int64()), ("vector", pa.list_(pa.float64()))])


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _dealt(graph, ask: bool):
    def run(batches):
        held = graph.value
        for found in batches:
            if not found.num_rows:
                continue
            row, lists = (probes if ask else homes)(held, _matrix(found.column(1)))
            pick = pa.array(row)
            yield batch(
                _ROWS,
                list=lists.astype(np.int32),
                block=np.zeros(len(row), np.int32),
                ask=np.full(len(row), ask),
                id=found.column(0).take(pick),
                vector=found.column(1).take(pick),
            )

    return run


_NEAR = pa.schema([("ask", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _near_batches(keep: int):
    """Each query's ``keep`` nearest of one block: its vectors come first, then the queries."""

    def scan(ids, vectors, norms, asks, points):
        for i in range(0, len(asks), 256):
            x = points[i : i + 256]
            apart = (x**2).sum(1)[:, None] + norms - 2 * (x @ vectors.T)
            n = min(keep, len(ids))
            edge = np.partition(apart, n - 1, axis=1)[:, n - 1 : n]
            # what rounding could have moved is measured again, exactly
            row, column = np.nonzero(apart <= edge + 1e-9 * (np.abs(edge) + norms.max() + 1))
            exact = np.sqrt(((x[row] - vectors[column]) ** 2).sum(1))
            order = np.lexsort((ids[column], exact, row))
            row, column, exact = row[order], column[order], exact[order]
            nth = np.arange(len(row)) - np.searchsorted(row, row)
            best = nth < keep
            yield batch(_NEAR, ask=asks[i : i + 256][row[best]], vec_id=ids[column[best]], score=exact[best])

    def run(batches):
        key, ids, vectors = None, [], []
        block = None
        for found in batches:
            if not found.num_rows:
                continue
            marks = np.stack([found.column(0).to_numpy(), found.column(1).to_numpy()], axis=1)
            ask = found.column(2).to_numpy(zero_copy_only=False)
            change = (marks[1:] != marks[:-1]).any(1) | (ask[1:] != ask[:-1])
            cuts = np.r_[0, np.flatnonzero(change) + 1, len(marks)]
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                part = found.slice(a, b - a)
                now = tuple(marks[a])
                if now != key:
                    key, ids, vectors, block = now, [], [], None
                if not ask[a]:
                    ids.append(part.column(3).to_numpy())
                    vectors.append(_matrix(part.column(4)))
                elif ids:
                    if block is None:
                        held = np.concatenate(vectors)
                        block = (np.concatenate(ids), held, (held**2).sum(1))
                    yield from scan(*block, part.column(3).to_numpy(), _matrix(part.column(4)))

    return run


def build(rows: DataFrame) -> tuple[CentroidGraph | None, DataFrame]:
    """The graph of centroids and ``(vec_id, vector)`` of what the lists hold.

    The vectors are those of the commonest number of components. Of equal vectors the
    NEAREST + 1 with the smallest ids stay: no more can be among anyone's nearest.
    """
    spark = ship(rows.sparkSession)
    valid = _valid(rows)
    sizes = valid.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if sizes is None:
        return None, valid
    valid = valid.where(F.size("vector") == sizes["n"])
    same = Window.partitionBy("vector").orderBy("vec_id")
    kept = valid.withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= NEAREST + 1)
    kept = cut_lineage(kept, "vectors")
    total = kept.count()
    drawn = kept.where("nth = 1").orderBy(F.xxhash64("vector"), "vec_id").select("vector").limit(SAMPLE).toArrow()
    sample = _matrix(drawn["vector"].combine_chunks())
    lists = min(MOST_LISTS, max(1, total // LIST_ROWS), max(1, len(sample) // 4))
    return CentroidGraph(halved(sample, lists)), kept.select("vec_id", "vector")


def nearest(rows: DataFrame, queries: F.Column, n: int = NEAREST) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for the rows that ``queries`` picks, the n nearest others.

    score is the Euclidean distance in double precision; ties go to the smaller vec_id.
    Rows with a null id or vector, a null or non-finite component or only zeros take no
    part, nor do vectors of another length than the commonest. Equal vectors are all
    candidates. A repeated vec_id counts once for each of its different vectors. Other
    columns play no part; with fewer candidates than n, all are returned; an empty table
    gives an empty result.
    """
    spark = ship(rows.sparkSession)
    graph, kept = build(rows)
    schema = "query_id long, rank int, vec_id long, score double"
    if graph is None:
        return spark.createDataFrame([], schema)
    width = graph.centroids.shape[1]
    graph = spark.sparkContext.broadcast(graph)  # at most MOST_LISTS centroids
    asked = _valid(rows.where(queries)).where(F.size("vector") == width).distinct()
    # equal query vectors are looked up once
    points = cut_lineage(asked.groupBy("vector").agg(F.min("vec_id").alias("point")), "points")
    stored = kept.mapInArrow(_dealt(graph, False), _ROWS_SQL)
    crowded = stored.groupBy("list").count().where(F.col("count") > LIST_BLOCK)
    crowded = crowded.select(F.col("list").alias("crowd"), F.ceil(F.col("count") / LIST_BLOCK).cast("int").alias("blocks"))
    looked = points.select("point", "vector").mapInArrow(_dealt(graph, True), _ROWS_SQL)
    every = stored.union(looked)
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.array(F.pmod(F.xxhash64("id"), blocks).cast("int"))
    every = every.drop("block").join(crowded, F.col("list") == F.col("crowd"), "left").select(
        "list",
        F.explode(F.when(F.col("ask"), F.sequence(F.lit(0), blocks - 1)).otherwise(own)).alias("block"),
        "ask",
        "id",
        "vector",
    )
    every = sorted_by(every, ["list", "block"], ["list", "block", "ask"])
    found = every.mapInArrow(_near_batches(n + 1), "ask long, vec_id long, score double")
    # a vector in several lists is found several times
    found = found.groupBy("ask", "vec_id").agg(F.min("score").alias("score"))
    best = Window.partitionBy("ask").orderBy("score", "vec_id")
    found = found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= n + 1)
    who = asked.join(points, "vector").select(F.col("vec_id").alias("query_id"), "point")
    pairs = who.join(found, F.col("point") == F.col("ask")).where("query_id <> vec_id")
    final = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        pairs.withColumn("rank", F.row_number().over(final).cast("int"))
        .where(F.col("rank") <= n)
        .select("query_id", "rank", "vec_id", "score")
    )
