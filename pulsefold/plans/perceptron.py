"""Spark ML's multilayer perceptron, fitted with array arithmetic over batches of rows.

Start, objective, optimiser and the model that comes out are those of `MultilayerPerceptronClassifier`; what is done here is
the sum over all rows that every evaluation of the objective takes, which is nearly all of the time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext, cloudpickle
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, functions as F

from pulsefold.functions import network
from pulsefold.functions.descent import minimise

cloudpickle.register_pickle_by_value(network)


def fit_perceptron(rows: DataFrame, learner: MultilayerPerceptronClassifier) -> MultilayerPerceptronClassificationModel:
    """What `learner.fit` returns, from `features` as ARRAY<DOUBLE> and `label`."""
    spark, dims = rows.sparkSession, tuple(learner.getLayers())
    nothing = spark.createDataFrame([(Vectors.dense([0.0] * dims[0]), 0.0)], [learner.getFeaturesCol(), learner.getLabelCol()])
    # No steps from no weights: the weights that Spark starts from. No steps from given ones: a model of these.
    start = learner.copy({learner.maxIter: 0}).fit(nothing).weights.toArray()
    tasks = spark.sparkContext.defaultParallelism
    arrays = as_arrays(in_blocks(rows, dims[0], learner.getBlockSize(), tasks), dims[0], tasks)
    try:
        weights, _ = minimise(lambda at: objective(arrays, at, dims), start, learner.getMaxIter(), learner.getTol())
    finally:
        arrays.unpersist()
    model = learner.copy({learner.maxIter: 0, learner.initialWeights: Vectors.dense(weights)}).fit(nothing)
    model.set(model.maxIter, learner.getMaxIter())
    model.clear(model.initialWeights)
    return model


def in_blocks(rows: DataFrame, inputs: int, size: int, parts: int) -> DataFrame:
    """x0.., label, `share` and `part` of every row.

    Spark's objective is the mean over blocks of `size` rows of a partition, in its order, of the mean of a block; the last
    block of a partition has the rows that are left. So a row's share is one over the rows of its block. Blocks go to the
    `parts` parts in turn.
    """
    names = [f"x{i}" for i in range(inputs)]

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rest = TaskContext.get().partitionId(), None

        def known(some: pa.Table, rows_of: int) -> list[pa.RecordBatch]:
            places = (block + np.arange(len(some)) // rows_of) % parts
            whole = some.append_column("share", pa.array(np.full(len(some), 1.0 / rows_of)))
            return whole.append_column("part", pa.array(places.astype(np.int32))).combine_chunks().to_batches()

        for batch in batches:
            table = pa.Table.from_batches([batch])
            if any(column.null_count for column in table.columns):
                raise ValueError("features and labels must not be missing")  # as in Spark's own fit
            table = table if rest is None else pa.concat_tables([rest, table])
            whole = len(table) // size * size
            if whole:
                yield from known(table.slice(0, whole), size)
                block += whole // size
            rest = table.slice(whole).combine_chunks()
        if rest is not None and len(rest):
            yield from known(rest, len(rest))

    plain = rows.select(*[F.col("features")[i].alias(name) for i, name in enumerate(names)], F.col("label").cast("int"))
    return plain.mapInArrow(shared, ", ".join([*[f"{name} double" for name in names], "label int, share double, part int"]))


def as_arrays(blocks: DataFrame, inputs: int, parts: int) -> RDD:
    """Parts of as many rows in as many tasks, so that no core waits for another; kept as bytes, some thousand rows in each.

    Every evaluation reads all rows, and turning them into batches for Python would cost as much as the sums do. As in Spark's
    own fit they are kept in memory, or on the executors' disks; what is lost is taken from the stored table again.
    """
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(inputs + 2)]
            parts = np.column_stack(columns[:inputs]), columns[inputs].astype(np.int64), columns[inputs + 1]
            yield pa.RecordBatch.from_pydict({"rows": [b"".join(part.tobytes() for part in parts)]})

    dealt = blocks.repartitionById(parts, F.col("part")).drop("part")
    return dealt.mapInArrow(packed, "rows binary").rdd.map(lambda row: bytes(row[0])).persist(StorageLevel.MEMORY_AND_DISK)


def objective(arrays: RDD, params: np.ndarray, dims: tuple[int, ...]) -> tuple[float, np.ndarray]:
    """Mean loss and its gradient. The driver adds up one array per task, hence per core, in their order."""
    sums, inputs = network.sigmoid_sums, dims[0]

    def task_sums(some: Iterator[bytes]) -> Iterator[tuple[float, float, np.ndarray]]:
        loss, total, slope = 0.0, 0.0, np.zeros(len(params))
        for rows in some:
            n = len(rows) // (8 * (inputs + 2))
            x, y = np.frombuffer(rows, count=n * inputs).reshape(n, inputs), np.frombuffer(rows, np.int64, n, 8 * n * inputs)
            share = np.frombuffer(rows, offset=8 * n * (inputs + 1))
            part_loss, part_slope = sums(params, dims, x, y, share)
            loss, total, slope = loss + part_loss, total + float(share.sum()), slope + part_slope
        yield loss, total, slope

    each = arrays.mapPartitions(task_sums).collect()
    total = sum(share for _, share, _ in each)
    return sum(loss for loss, _, _ in each) / total, np.sum([slope for _, _, slope in each], axis=0) / total
