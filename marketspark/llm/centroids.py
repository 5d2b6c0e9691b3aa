"""Centroid clustering with heap-ordered bounds.

Every vector knows by how much its second nearest centroid is farther away than its own: its gap. When the centroids
move, a gap shrinks by no more than the way of its own centroid and the longest way of another. So each cluster
keeps a clock, the sum of these ways, and a vector is filed under the time at which its gap runs out: the clock when it
was measured, plus the gap. What a cluster's clock has not reached needs no look; what it has passed is popped,
measured against all centroids, and filed anew under its new cluster and time.

The heap of a cluster lies in Parquet. Every round appends a *run* of what it filed, ordered by cluster and time in
each file. As clocks only run forward, an entry with a time that its cluster's clock has passed is dead, so nothing is
deleted, and a pop reads the times between two states of the clock: a filter that skips row groups. No round
shuffles vectors or rewrites those that stay; of the vectors that change their cluster, sums by cluster reach the driver.

Distances are whole numbers and exact. Bounds are floating-point and rounded towards an early pop.
"""

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketspark.sources.scratch import new_folder

CLUSTERS = 8
ROUNDS = 10
SIZE = 64
SCALE = 1024
SEED = 3
#: Whole components are smaller than this in size: then no squared distance exceeds a long.
MOST = 1 << 27
#: Bytes of a row group: the smallest part of a run that a pop can skip.
ROW_GROUP = 4 << 20
_LOOSE = 1e-12

_FILED = "id {id}, v array<int>, was int, cluster int, due double"


def whole(vector: Column, size: int = SIZE, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component; null for a vector of another length, one with null or non-finite
    components, or one with components of ``MOST`` and more."""
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * float(scale)))
    fine = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double") * float(scale)) < float(MOST)), F.lit(False)))
    return F.when((F.size(vector) == size) & fine, scaled.cast("array<int>"))


def _measured(frame: DataFrame, centroids: np.ndarray, clocks: np.ndarray) -> DataFrame:
    """The rows (id, v, cluster) with the nearest centroid, the cluster before it, and the time when that is due again."""
    schema = _FILED.format(id=frame.schema["id"].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = (centroids**2).sum(axis=1)
        for batch in batches:
            vectors = batch.column("v").flatten().to_numpy().astype(np.int64).reshape(batch.num_rows, -1)
            squares = (vectors**2).sum(axis=1)[:, None] - 2 * (vectors @ centroids.T) + lengths
            nearest = squares.argmin(axis=1)
            every = np.arange(len(nearest))
            upper = np.sqrt(squares[every, nearest].astype(np.float64)) * (1 + _LOOSE)
            if len(centroids) > 1:
                squares[every, nearest] = np.iinfo(np.int64).max
                lower = np.sqrt(squares.min(axis=1).astype(np.float64)) * (1 - _LOOSE)
            else:
                lower = np.full(len(nearest), np.inf)
            clock = clocks[nearest]
            due = np.maximum(clock + (lower - upper), np.nextafter(clock, np.inf))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("v"), batch.column("cluster"), pa.array(nearest.astype(np.int32)), pa.array(due)], ["id", "v", "was", "cluster", "due"]
            )

    return frame.select("id", "v", "cluster").mapInArrow(run, schema)


def _changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """By how much the vectors that moved change the sums of the clusters, one row per cluster and component; place -1 is
    the number of vectors."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        vectors = batch.column("v").flatten().to_numpy().astype(np.int64).reshape(batch.num_rows, -1)
        vectors = np.hstack([np.ones((len(vectors), 1), dtype=np.int64), vectors])
        for name, sign in (("cluster", 1), ("was", -1)):
            own = batch.column(name).to_numpy()
            for side in np.unique(own[own >= 0]):
                sums[int(side)] = sums.get(int(side), 0) + sign * vectors[own == side].sum(axis=0)
    for side, change in sums.items():
        places = np.arange(-1, len(change) - 1, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(change), side, dtype=np.int32)), pa.array(places), pa.array(change)], ["side", "place", "sum"])


class Heaps:
    """The heaps of all clusters, as runs in the shared folder."""

    def __init__(self, vectors: DataFrame, centroids: np.ndarray):
        self.spark = vectors.sparkSession
        self.centroids = centroids
        self.clocks = np.zeros(len(centroids))
        self.counts = [0] * len(centroids)
        self.sums = np.zeros(centroids.shape, dtype=object)
        self.folders: list[str] = []
        self.schema = None
        self._file(_measured(vectors.withColumn("cluster", F.lit(-1)), centroids, self.clocks))

    def _file(self, measured: DataFrame) -> None:
        """Append a run, and keep the sums up to date with the vectors that have changed their cluster."""
        folder = new_folder(self.spark)
        self.schema = measured.schema
        ordered = measured.sortWithinPartitions("cluster", "due")
        ordered.write.option("parquet.block.size", ROW_GROUP).parquet(folder)
        self.folders.append(folder)
        moved = self.spark.read.schema(self.schema).parquet(folder).where("was != cluster")
        for row in moved.mapInArrow(_changes, "side int, place int, sum long").groupBy("side", "place").agg(F.sum("sum").alias("sum")).collect():
            if row["place"] < 0:
                self.counts[row["side"]] += row["sum"]
            else:
                self.sums[row["side"], row["place"]] += row["sum"]

    def rows(self, wanted: list[Column]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*self.folders).where(reduce(lambda a, b: a | b, wanted))

    def live(self) -> DataFrame:
        """One row (id, v, cluster) per vector."""
        return self.rows([(F.col("cluster") == place) & (F.col("due") > float(clock)) for place, clock in enumerate(self.clocks)])

    def move(self) -> bool:
        """Move the centroids to the means of their vectors, pop what is due and file it anew. False if none has moved."""
        means = [[int(x // n) for x in sums] if n else list(old) for sums, n, old in zip(self.sums, self.counts, self.centroids, strict=True)]
        centroids = np.array(means, dtype=np.int64).reshape(self.centroids.shape)
        ways = np.sqrt(((centroids - self.centroids) ** 2).sum(axis=1).astype(np.float64)) * (1 + _LOOSE)
        if not ways.any():
            return False
        others = np.array([np.delete(ways, place).max(initial=0.0) for place in range(len(ways))])
        before, self.clocks = self.clocks, self.clocks + (ways + others) * (1 + _LOOSE)
        self.centroids = centroids
        due = [
            (F.col("cluster") == place) & (F.col("due") > float(old)) & (F.col("due") <= float(new))
            for place, (old, new) in enumerate(zip(before, self.clocks, strict=True))
        ]
        self._file(_measured(self.rows(due), centroids, self.clocks))
        return True


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors whose ids have the smallest digests, in that order; equal digests by vector, no id last."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    few = vectors.select("v", digest.alias("digest")).orderBy(F.col("digest").asc_nulls_last(), "v").limit(k).collect()
    return np.array([row["v"] for row in few], dtype=np.int64)


def cluster(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", k: int = CLUSTERS,
            rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """``<id_column>``, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia``, ``centroid_sha256``.

    Vectors become whole numbers by ``whole``; those for which that is null are left out. ``rounds`` times every vector
    goes to its nearest centroid (ties: the smaller number) and centroids to the floor of the mean, empty ones stay;
    then vectors are assigned once more. Repeated rows are vectors of their own, also as first centroids; a null id is
    carried along and starts no centroid while others are left. Fewer than k vectors give fewer clusters, an empty table
    an empty result. Other columns, whatever their names, are not read. Runs jobs: one to start, then two a round
    while centroids move.
    """
    named = vectors.select(F.col(id_column).alias("id"), whole(F.col(vector), size, scale).alias("v")).where("v IS NOT NULL")
    start = first_centroids(named, k, seed)
    kind = named.schema["id"].dataType.simpleString()
    if not len(start):
        return named.sparkSession.createDataFrame(
            [], f"`{id_column}` {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        )
    heaps = Heaps(named, start)
    for _ in range(rounds):
        if not heaps.move():
            break
    return _distances(heaps, id_column)


def _distances(heaps: Heaps, id_column: str) -> DataFrame:
    spark = heaps.spark
    table = [(place, [int(x) for x in row], ",".join(str(x) for x in row)) for place, row in enumerate(heaps.centroids)]
    # One row per cluster.
    centres = spark.createDataFrame(table, "cluster int, centre array<long>, digits string")
    centres = centres.withColumn("centroid_sha256", F.sha2("digits", 256)).drop("digits")
    squares = F.zip_with("v", "centre", lambda a, b: (a.cast("long") - b) * (a.cast("long") - b))
    near = heaps.live().join(F.broadcast(centres), "cluster")
    near = near.withColumn("distance", F.aggregate(squares, F.lit(0).cast("long"), lambda total, x: total + x))
    inertia = F.sum(F.col("distance").cast("decimal(38,0)")).cast("long")
    sums = {row["cluster"]: row["inertia"] for row in near.groupBy("cluster").agg(inertia.alias("inertia")).collect()}
    totals = spark.createDataFrame([(place, sums.get(place, 0), sum(sums.values())) for place, *_ in table], "cluster int, cluster_inertia long, inertia long")
    return near.join(F.broadcast(totals), "cluster").select(
        F.col("id").alias(id_column), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
