"""An exact nearest-neighbour join over a pivot (Voronoi) partition.

Documents go to the cell of their nearest *pivot*, and a cell is cut into *rings*: blocks of bounded size between two
distances from the pivot. A question first meets the nearest ring of its nearest cell, which bounds how far its
k nearest documents can be. By the triangle inequality it must then see only the rings that this radius reaches, and by the
bisecting hyperplane of two pivots only the cells it reaches. Documents are stored once, in blocks; what is copied is
questions, one for each ring in reach.

Equal vectors would fill blocks of the same distance that every question in reach has to see, so of equal ones only the
k smallest ids are kept: no other can be among the k nearest. Blocks that many questions visit meet them in parts.

What is shuffled is questions times rings in reach, so rings and parts that travel have a least size, however small the blocks
asked for: those are what a task looks at in turn, so many questions against so many documents, leaving out what none of the
questions reaches.
"""

from collections.abc import Iterator
from math import ceil

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import stored

#: Pivots at most, whatever the number of documents: they are sent to every task.
MOST_PIVOTS = 512
#: Rows of a ring, and questions of a part that meets it, at least.
RING_ROWS = 8192
PART_QUESTIONS = 4096
#: Relative slack of distances from pivots, which come from one matrix product.
SLACK = 1e-6


def _matrix(column):
    """The vectors of an Arrow list column, a row each."""
    import numpy as np

    values = column.flatten().to_numpy(zero_copy_only=False).astype("float64")
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _distances(vectors, others):
    import numpy as np

    squares = (vectors**2).sum(axis=1)[:, None] + (others**2).sum(axis=1) - 2 * vectors @ others.T
    return np.sqrt(np.maximum(squares, 0))


class Rings:
    """Documents (collection, id, embedding) in stored blocks, and the summary of the cells of each collection."""

    def __init__(self, documents: DataFrame, k: int, block_rows: int):
        copies = F.row_number().over(Window.partitionBy("collection", "embedding").orderBy("id"))
        documents = stored(documents.withColumn("_copy", copies).filter(F.col("_copy") <= k).drop("_copy"))
        self.k, self.spark = k, documents.sparkSession
        number = documents.count()
        pivots = self._chosen(documents, min(MOST_PIVOTS, ceil(number / (4 * block_rows))))
        self.pivots = self.spark.sparkContext.broadcast(pivots)
        self.blocks = stored(self._blocked(documents, max(1, ceil(number / block_rows)), block_rows))
        keys = ["collection", "cell"]
        self.rings = stored(
            self.blocks.groupBy("block", *keys).agg(F.min("away").alias("low"), F.max("away").alias("high"), F.count(F.lit(1)).alias("n"))
        )
        # One row per pivot and collection.
        cells = self.rings.groupBy(*keys).agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"), F.min_by("block", F.struct("low", "block")).alias("first"))
        self.cells = self.spark.sparkContext.broadcast(_arrays(cells.collect()))

    @staticmethod
    def _chosen(documents: DataFrame, number: int):
        import numpy as np

        if not number:
            return np.zeros((0, 0))
        rows = documents.select("embedding").orderBy(F.xxhash64("embedding"), "embedding").limit(number).collect()
        return np.unique(np.array([row["embedding"] for row in rows], dtype="float64"), axis=0)

    def _blocked(self, documents: DataFrame, parts: int, block_rows: int) -> DataFrame:
        """``block``, ``collection``, ``id``, ``embedding``, ``cell``, ``away``. Ranges split a cell that holds most documents."""
        sent = self.pivots
        kind = documents.schema["embedding"].dataType.simpleString()

        def place(batches) -> Iterator:
            import numpy as np
            import pyarrow as pa

            for batch in batches:
                away = _distances(_matrix(batch.column("embedding")), sent.value)
                cell = away.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(cell.astype("int32")), pa.array(away[np.arange(len(cell)), cell])], [*batch.schema.names, "cell", "away"]
                )

        placed = documents.select("collection", "id", "embedding").mapInArrow(place, f"collection string, id string, embedding {kind}, cell int, away double")
        order = ["collection", "cell", "away", "id"]

        def cut(batches) -> Iterator:
            import numpy as np
            import pyarrow as pa
            from pyspark import TaskContext

            block, held, size = TaskContext.get().partitionId() << 32, None, 0
            for batch in batches:
                numbers = np.empty(batch.num_rows, dtype="int64")
                own = zip(batch.column("collection").to_pylist(), batch.column("cell").to_pylist(), strict=True)
                for at, key in enumerate(own):
                    if key != held or size >= block_rows:
                        block, held, size = block + 1, key, 0
                    numbers[at] = block
                    size += 1
                yield pa.RecordBatch.from_arrays([pa.array(numbers), *batch.columns], ["block", *batch.schema.names])

        ranged = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        return ranged.mapInArrow(cut, f"block bigint, collection string, id string, embedding {kind}, cell int, away double")

    def homes(self, questions: DataFrame) -> DataFrame:
        """Every question (row, question_id, embedding) with a ring of its nearest cell in each collection, and the radius in
        which the cells alone say that k documents lie."""
        pivots, cells, k = self.pivots, self.cells, self.k

        def visit(batches) -> Iterator:
            import numpy as np

            for batch in batches:
                vectors = _matrix(batch.column("embedding"))
                away = _distances(vectors, pivots.value)
                for collection, cell in cells.value.items():
                    own = away[:, cell["cell"]]
                    nearest = own.argmin(axis=1)
                    far = own + cell["high"]
                    order = far.argsort(axis=1)
                    enough = np.cumsum(cell["n"][order], axis=1) >= k
                    place = enough.argmax(axis=1)
                    every = np.arange(len(own))
                    reach = np.where(enough.any(axis=1), far[every, order[every, place]], np.inf)
                    yield _visits(batch, every, collection, cell["cell"][nearest], own[every, nearest], reach + _slack(vectors, pivots.value), cell["first"][nearest])

        visits = questions.select("row", "question_id", "embedding").mapInArrow(visit, _visit_schema(questions, "block bigint"))
        # The ring that is as far from the pivot as the question, or the next to it.
        gap = F.greatest(F.col("low") - F.col("away"), F.col("away") - F.col("high"), F.lit(0.0))
        ring = self.rings.select(F.col("block").alias("ring"), "collection", "cell", "low", "high")
        own = visits.select("row", "collection", "cell", "away").join(ring, ["collection", "cell"])
        nearest = own.groupBy("row", "collection").agg(F.min_by("ring", F.struct(gap, "ring")).alias("ring"))
        return visits.join(nearest, ["row", "collection"]).withColumn("block", F.col("ring")).select(*visits.columns)

    def others(self, visits: DataFrame) -> DataFrame:
        """All further rings that the radius of a visit reaches."""
        pivots, cells = self.pivots, self.cells

        def visit(batches) -> Iterator:
            import numpy as np

            for batch in batches:
                vectors = _matrix(batch.column("embedding"))
                away = _distances(vectors, pivots.value)
                home = away.argmin(axis=1)
                between = _distances(pivots.value, pivots.value)
                reach = batch.column("reach").to_numpy()
                slack = _slack(vectors, pivots.value)
                asked = np.array(batch.column("collection").to_pylist(), dtype=object)
                first = batch.column("block").to_numpy()
                for collection, cell in cells.value.items():
                    rows = np.flatnonzero(asked == collection)
                    own = away[rows][:, cell["cell"]]
                    gap = np.maximum(own - cell["high"], cell["low"] - own)
                    apart = between[home[rows]][:, cell["cell"]]
                    with np.errstate(divide="ignore", invalid="ignore"):
                        plane = (own**2 - away[rows, home[rows]][:, None] ** 2) / (2 * apart)
                    gap = np.maximum(gap, np.where(apart > 0, plane, 0))
                    row, column = np.nonzero(gap <= (reach + slack)[rows][:, None])
                    at = rows[row]
                    yield _visits(batch, at, collection, cell["cell"][column], own[row, column], (reach + slack)[at], first[at])

        reached = visits.mapInArrow(visit, _visit_schema(visits, "first bigint"))
        ring = self.rings.select("block", "collection", "cell", "low", "high")
        met = reached.join(ring, ["collection", "cell"])
        reachable = (F.col("away") - F.col("reach") <= F.col("high")) & (F.col("away") + F.col("reach") >= F.col("low")) & (F.col("block") != F.col("first"))
        return met.filter(reachable).select(*visits.columns)

    def meet(self, visits: DataFrame, places: int, block_questions: int, look: tuple[int, int] | None = None) -> DataFrame:
        """The k nearest documents of every visit's block within its radius: (row, question_id, collection, id, distance). At most
        ``block_questions`` meet a block in one group, and ``look`` of them, (questions, documents), are compared at a time."""
        k, look_questions, look_rows = self.k, *(look or (block_questions, RING_ROWS))
        sizes = visits.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / block_questions).alias("parts"))
        sizes = stored(sizes)
        part = F.pmod(F.xxhash64("row"), F.col("parts")).alias("part")
        left = visits.join(sizes, "block").select("block", part, "row", "question_id", "embedding", "away", "reach")
        right = self.blocks.join(sizes, "block").select(
            "block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"), "collection", "id", "embedding", "away"
        )
        kind = visits.schema["question_id"].dataType.simpleString()

        def found(asked, held):
            import numpy as np
            import pandas as pd

            names = ["row", "question_id", "collection", "id", "distance"]
            if asked.empty or held.empty:
                return pd.DataFrame({name: pd.Series(dtype=object) for name in names})
            # Neighbours by their distance from the pivot stand together, so that a block of questions leaves out blocks of documents.
            held, asked = held.sort_values("away"), asked.sort_values("away")
            ids, collection = held["id"].to_numpy(dtype=object), held["collection"].iat[0]
            vectors = np.stack(held["embedding"].to_numpy()).astype("float64")
            matrix = np.stack(asked["embedding"].to_numpy()).astype("float64")
            sizes, lengths = (vectors**2).sum(axis=1), (matrix**2).sum(axis=1)
            margin = 10.0**-places + 1e-9 * (sizes.max() + lengths)
            reach, own, beside = asked["reach"].to_numpy(), asked["away"].to_numpy(), held["away"].to_numpy()
            starts = np.arange(0, len(ids), look_rows)
            low, high = beside[starts], beside[np.append(starts[1:], len(ids)) - 1]
            parts = []
            # So many questions at a time that their distances to the ring stay small.
            step = max(1, min(look_questions, (1 << 22) // len(ids)))
            for begin in range(0, len(matrix), step):
                some = slice(begin, begin + step)
                gap = np.maximum(own[some, None] - high, low - own[some, None])
                seen = (gap <= reach[some, None]).any(axis=0)
                at = np.flatnonzero(np.repeat(seen, look_rows)[: len(ids)])
                if not len(at):
                    continue
                near = vectors if len(at) == len(ids) else vectors[at]
                rough = lengths[some, None] + sizes[at] - 2 * matrix[some] @ near.T
                bound = reach[some] ** 2
                if len(at) > k:
                    bound = np.minimum(bound, np.partition(rough, k - 1, axis=1)[:, k - 1])
                question, document = np.nonzero(rough <= (bound + margin[some])[:, None])
                # The product ranks well but is not exact in its last digits: what is near is measured again.
                distance = np.round(((near[document] - matrix[begin + question]) ** 2).sum(axis=1), places)
                best = pd.DataFrame({"at": begin + question, "id": ids[at[document]], "distance": distance}).sort_values(["at", "distance", "id"])
                parts.append(best[best.groupby("at").cumcount() < k])
            if not parts:
                return pd.DataFrame({name: pd.Series(dtype=object) for name in names})
            best = pd.concat(parts)
            at = best.pop("at").to_numpy()
            best.insert(0, "row", asked["row"].to_numpy()[at])
            best.insert(1, "question_id", asked["question_id"].to_numpy()[at])
            best.insert(2, "collection", collection)
            return best

        schema = f"row bigint, question_id {kind}, collection string, id string, distance double"
        return left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInPandas(found, schema)


def _slack(vectors, pivots):
    import numpy as np

    return SLACK * (1 + np.sqrt((vectors**2).sum(axis=1)) + np.sqrt((pivots**2).sum(axis=1)).max(initial=0))


def _visit_schema(questions: DataFrame, last: str) -> str:
    kinds = [f"{name} {questions.schema[name].dataType.simpleString()}" for name in ("row", "question_id", "embedding")]
    return ", ".join([*kinds, "collection string", "cell int", "away double", "reach double", last])


def _visits(batch, at, collection, cell, away, reach, last):
    import pyarrow as pa

    taken = pa.array(at)
    columns = [batch.column(name).take(taken) for name in ("row", "question_id", "embedding")]
    columns += [pa.array([collection] * len(at), pa.string()), pa.array(cell.astype("int32")), pa.array(away), pa.array(reach), pa.array(last)]
    return pa.RecordBatch.from_arrays(columns, [f"c{place}" for place in range(len(columns))])


def _arrays(rows) -> dict:
    """The cells of each collection as arrays."""
    import numpy as np

    grouped = {}
    for row in rows:
        grouped.setdefault(row["collection"], []).append(row)
    return {
        collection: {name: np.array([row[name] for row in own]) for name in ("cell", "low", "high", "n", "first")}
        for collection, own in grouped.items()
    }


def nearest_rings(questions: DataFrame, documents: DataFrame, k: int, places: int, block_questions: int, block_rows: int) -> DataFrame:
    """Candidates (question_id, collection, id, distance) that hold the k nearest of every question and collection.

    ``questions`` (question_id, embedding), ``documents`` (collection, id, embedding). Runs jobs.
    """
    look = block_questions, block_rows
    block_questions, block_rows = max(block_questions, PART_QUESTIONS), max(block_rows, RING_ROWS)
    rings = Rings(documents, k, block_rows)
    if not len(rings.pivots.value):
        kind = questions.schema["question_id"].dataType.simpleString()
        return rings.spark.createDataFrame([], f"question_id {kind}, collection string, id string, distance double")
    asked = stored(questions.select(F.monotonically_increasing_id().alias("row"), "question_id", "embedding"))
    homes = stored(rings.homes(asked))
    first = stored(rings.meet(homes, places, block_questions, look))
    full = first.groupBy("row", "collection").agg(F.count(F.lit(1)).alias("found"), F.max("distance").alias("kth")).filter(F.col("found") >= k)
    # A rounded distance hides half a unit of the last place on either side.
    radius = F.sqrt(F.col("kth") + 10.0**-places)
    bounded = homes.join(full, ["row", "collection"], "left").withColumn("reach", F.least("reach", F.coalesce(radius, "reach")))
    further = stored(rings.others(bounded.select(*homes.columns)))
    return first.unionByName(rings.meet(further, places, block_questions, look)).drop("row")
