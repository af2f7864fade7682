"""Centroid clustering with bounds loosened by total displacement (ns-bounds).

A vector keeps its cluster, the round in which it was last evaluated, its distance to its own centroid then and the distance to the next nearest.
The history of all centroids is retained: instead of adding up what every round moved, the bounds are loosened by the norm of the whole
displacement of a centroid since that round, which is never more than the sum. Where the loosened bounds prove the cluster, the vector is not
evaluated; where they fail, all its distances are computed anew in whole numbers, so every assignment is exact.

Vectors lie as whole numbers in blocks, written once into a table bucketed by block; a round writes the bounds alone (20 bytes a vector), bucketed
alike, so the join of the two shuffles nothing. The sums of a centroid change only by vectors that moved. The driver holds the centroids and their
history (rounds x clusters x components).
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studyflow.llm.shared import settings
from studyflow.session import discard, staged, work_path

SCALE = 1024
# Vectors of a block, blocks that go to a Python worker at a time, and vectors of a bucket on average.
BLOCK = 1024
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "64"}
BUCKET_ROWS = 500_000
# Beyond this size of a component a squared distance may not fit a long.
LARGEST = 2**27
# Relative slack of the bounds against rounding of their square roots.
SLACK = 1e-9
STATE = np.dtype([("cluster", "<i2"), ("round", "<i2"), ("own", "<f8"), ("next", "<f8")])


def whole_vectors(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, whole numbers) of the vectors with exactly ``size`` finite components within range."""
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == size)
    flat = column.take(pa.array(rows, pa.int64())).flatten().cast(pa.float64())
    x = flat.to_numpy(zero_copy_only=False).reshape(-1, size)
    x = np.floor(SCALE * x)
    good = (np.abs(x) <= LARGEST).all(axis=1)
    return rows[good], x[good].astype("<i4")


def blocks_of(vectors: DataFrame, size: int, id_col: str, vector_col: str) -> DataFrame:
    """block, ids and data (whole numbers, row by row) of the vectors that are kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 33
        ids: list[int | None] = []
        held = np.zeros((0, size), "<i4")

        def out(n: int) -> pa.RecordBatch:
            nonlocal block, ids, held
            row = pa.RecordBatch.from_arrays([pa.array([block]), pa.array([ids[:n]], pa.list_(pa.int64())), pa.array([held[:n].tobytes()], pa.binary())], ["block", "ids", "data"])
            block, ids, held = block + 1, ids[n:], held[n:]
            return row

        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                rows, x = whole_vectors(part.column(1), size)
                ids += part.column(0).take(pa.array(rows, pa.int64())).to_pylist()
                held = np.concatenate((held, x))
                if len(ids) >= BLOCK:
                    yield out(BLOCK)
        if ids:
            yield out(len(ids))

    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    return rows.mapInArrow(run, "block long, ids array<long>, data binary")


def first_centroids(blocks: DataFrame, clusters: int, size: int, seed: int) -> np.ndarray:
    """The vectors whose ids have the least digests, in their order; equal digests by the vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x = np.frombuffer(data, "<i4").reshape(-1, size).tolist()
                least = sorted((sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in zip(ids, x))[:clusters]
                yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in least]), pa.array([v for _, v in least], pa.list_(pa.int32()))], ["hash", "vector"])

    rows = blocks.select("ids", "data").mapInArrow(run, "hash string, vector array<int>").orderBy("hash", "vector").limit(clusters).collect()
    return np.array([r["vector"] for r in rows], np.int64).reshape(-1, size)


def squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of every vector to every centroid."""
    x = x.astype(np.int64)
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ centroids.T) + (centroids * centroids).sum(axis=1)[None, :]


class Bounds:
    """The centroids of all rounds so far, and how far each has moved since each round."""

    def __init__(self, history: list[np.ndarray]):
        self.now, self.round = history[-1], len(history) - 1
        moved = np.stack([np.sqrt(((self.now - old) ** 2).sum(axis=1).astype(np.float64)) for old in history])
        k = len(self.now)
        others = np.where(np.eye(k, dtype=bool)[None, :, :], 0.0, moved[:, None, :])
        self.own, self.others = moved, others.max(axis=2)

    def assign(self, x: np.ndarray, state: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """(state now, rows that were evaluated)."""
        if state is None:
            new, failed = np.zeros(len(x), STATE), np.arange(len(x))
        else:
            new = state.copy()
            own = state["own"] + self.own[state["round"], state["cluster"]]
            next_ = state["next"] - self.others[state["round"], state["cluster"]]
            failed = np.flatnonzero(~(own * (1 + SLACK) < next_ * (1 - SLACK)))
        distance = squared(x[failed], self.now)
        nearest = distance.argmin(axis=1)
        each = np.arange(len(failed))
        new["cluster"][failed], new["round"][failed] = nearest, self.round
        new["own"][failed] = np.sqrt(distance[each, nearest].astype(np.float64))
        rest = distance.astype(np.float64)
        rest[each, nearest] = math.inf
        new["next"][failed] = np.sqrt(rest.min(axis=1, initial=math.inf))
        return new, failed


def moved_sums(x: np.ndarray, before: np.ndarray | None, after: np.ndarray, failed: np.ndarray, clusters: int) -> np.ndarray:
    """What the number and the sum of each cluster's vectors changed by."""
    out = np.zeros((clusters, 1 + x.shape[1]), np.int64)
    rows = failed if before is None else failed[before["cluster"][failed] != after["cluster"][failed]]
    gone = np.concatenate((np.ones((len(rows), 1), np.int64), x[rows].astype(np.int64)), axis=1)
    np.add.at(out, after["cluster"][rows], gone)
    if before is not None:
        np.subtract.at(out, before["cluster"][rows], gone)
    return out


def evaluated(pairs: DataFrame, bounds: Bounds, size: int) -> DataFrame:
    """block, state, moved (changes of the clusters' sums) and n (vectors evaluated) of blocks with their states (null at first)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            states, moved, n = [], [], []
            for data, state in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                x = np.frombuffer(data, "<i4").reshape(-1, size)
                before = None if state is None else np.frombuffer(state, STATE)
                after, failed = bounds.assign(x, before)
                states.append(after.tobytes())
                moved.append(moved_sums(x, before, after, failed, len(bounds.now)).tobytes())
                n.append(len(failed))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(states, pa.binary()), pa.array(moved, pa.binary()), pa.array(n, pa.int64())], ["block", "state", "moved", "n"])

    return pairs.select("block", "data", "state").mapInArrow(run, "block long, state binary, moved binary, n long")


def total_moved(states: DataFrame, clusters: int, size: int) -> np.ndarray:
    """Sum of ``moved`` over all blocks: one row for each changed entry and task is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(clusters * (1 + size), np.int64)
        for batch in batches:
            for moved in batch.column(0).to_pylist():
                total += np.frombuffer(moved, np.int64)
        slots = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), pa.array(total[slots], pa.int64())], ["slot", "x"])

    out = np.zeros(clusters * (1 + size), np.int64)
    for row in states.select("moved").mapInArrow(run, "slot int, x long").groupBy("slot").agg(F.sum("x").alias("x")).collect():
        out[row["slot"]] = row["x"]
    return out.reshape(clusters, 1 + size)


def placed(pairs: DataFrame, bounds: Bounds, size: int) -> DataFrame:
    """vec_id, cluster and distance of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, data, state in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x = np.frombuffer(data, "<i4").reshape(-1, size)
                after, _ = bounds.assign(x, None if state is None else np.frombuffer(state, STATE))
                gap = x.astype(np.int64) - bounds.now[after["cluster"]]
                yield pa.RecordBatch.from_arrays([ids.values, pa.array(after["cluster"].astype(np.int32)), pa.array((gap * gap).sum(axis=1))], ["vec_id", "cluster", "distance"])

    return pairs.select("block", "ids", "data", "state").mapInArrow(run, "vec_id long, cluster int, distance long")


class Buckets:
    """Tables bucketed by block in the work folder, so that their joins shuffle nothing; all go when the work is done."""

    def __init__(self, spark: SparkSession, number: int):
        self.spark, self.number, self.tables = spark, number, {}

    def write(self, rows: DataFrame, name: str) -> DataFrame:
        table, path = f"{name}_{uuid.uuid4().hex}", work_path(self.spark, name)
        self.tables[table] = path
        rows.write.format("parquet").bucketBy(self.number, "block").option("path", path).saveAsTable(table)
        return self.spark.table(table)

    def drop(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        discard(self.spark, self.tables.pop(table))

    def drop_oldest(self, name: str) -> None:
        self.drop(next(t for t in self.tables if t.startswith(name)))

    def drop_all(self) -> None:
        for table in list(self.tables):
            self.drop(table)


def fitted(blocks: DataFrame, store: Buckets, clusters: int, rounds: int, size: int, seed: int) -> tuple[list[np.ndarray], DataFrame | None, list[int]]:
    """(centroids before each round and after the last, last states, vectors evaluated in each round)."""
    history, states, counts = [first_centroids(blocks, clusters, size, seed)], None, []
    k = len(history[0])
    sums = np.zeros((k, 1 + size), np.int64)
    for _ in range(rounds if k else 0):
        old, states = states, store.write(evaluated(with_states(blocks, states), Bounds(history), size), "bounds")
        sums = sums + total_moved(states, k, size)
        counts.append(states.agg(F.sum("n")).first()[0])
        mean = np.where(sums[:, :1] > 0, sums[:, 1:] // np.maximum(sums[:, :1], 1), history[-1])
        history.append(mean)
        if old is not None:
            store.drop_oldest("bounds")
    return history, states, counts


def with_states(blocks: DataFrame, states: DataFrame | None) -> DataFrame:
    if states is None:
        return blocks.withColumn("state", F.lit(None).cast("binary"))
    return blocks.join(states.select("block", "state").hint("shuffle_hash"), "block")


def clustered(vectors: DataFrame, clusters: int = 8, rounds: int = 10, size: int = 64, seed: int = 3, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256, one row for each vector that is kept.

    Kept are vectors of exactly ``size`` components, none null, non-finite or beyond 131,072 (a squared distance would not fit a long). Repeated rows
    are clustered each; a null id counts as an empty one for the choice of the first centroids and stays null. Fewer vectors than clusters make as
    many clusters as there are vectors. Ties go to the smaller number. Other columns are not read. No rows give none.
    """
    spark = vectors.sparkSession
    store = Buckets(spark, max(spark.sparkContext.defaultParallelism, vectors.count() // BUCKET_ROWS))
    with settings(spark, BATCH):
        blocks = store.write(blocks_of(vectors, size, id_col, vector_col).repartition(store.number, "block"), "blocks")
        history, states, _ = fitted(blocks, store, clusters, rounds, size, seed)
        rows = staged(placed(with_states(blocks, states), Bounds(history), size), "placed") if len(history[0]) else spark.createDataFrame([], "vec_id long, cluster int, distance long")
        store.drop_all()
    sums = {r["cluster"]: r["s"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digest = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in history[-1].tolist()]
    table = [(c, s, sum(sums.values()), digest[c]) for c, s in sums.items()]
    facts = spark.createDataFrame(table, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _sql(clusters: int = 8, rounds: int = 10, size: int = 64, seed: int = 3) -> str:
    steps = [f"""
kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x) AND abs(floor({SCALE} * CAST(x AS DOUBLE))) <= {LARGEST})) = {size}),
cells AS MATERIALIZED (SELECT r, unnest(generate_series(1, {size})) AS d, unnest(v) AS x FROM kept),
c0 AS MATERIALIZED (SELECT c, d, x FROM (SELECT r, row_number() OVER (ORDER BY sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS c FROM kept QUALIFY c < {clusters}) JOIN cells USING (r))"""]
    for t in range(rounds + 1):
        steps.append(f"""
a{t} AS MATERIALIZED (SELECT r, min({{'q': q, 'c': c}}) AS m FROM (SELECT r, c, CAST(sum((a.x - b.x) * (a.x - b.x)) AS BIGINT) AS q FROM cells a JOIN c{t} b USING (d) GROUP BY r, c) GROUP BY r)""")
        if t < rounds:
            steps.append(f"""
c{t + 1} AS MATERIALIZED (SELECT o.c AS c, o.d AS d, coalesce(CAST((s - ((s % n) + n) % n) // n AS BIGINT), o.x) AS x FROM c{t} o
  LEFT JOIN (SELECT m.c AS c, d, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM a{t} JOIN cells USING (r) GROUP BY ALL) USING (c, d))""")
    return "WITH " + ",".join(steps) + f"""
SELECT vec_id, CAST(m.c AS INTEGER) AS cluster, m.q AS distance, CAST(sum(m.q) OVER (PARTITION BY m.c) AS BIGINT) AS cluster_inertia, CAST(sum(m.q) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN kept USING (r) JOIN (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY c) f ON f.c = m.c
"""


OP12_SQL = _sql()
