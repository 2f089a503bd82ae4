"""A saved forest as a table of nodes, evaluated by SQL functions: what the model decides can
be read, compared and applied without the library that fitted it."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def node_table(spark: SparkSession, model_path: str) -> DataFrame:
    """The nodes of the forest saved by ``forecast.save_model``: ``tree``, ``node``, ``feature``
    (place among the inputs), ``threshold``, ``left`` and ``right`` (nodes; -1 in a leaf) and
    ``prediction``, read from the files of the artefact."""
    node = F.col("nodeData")
    return spark.read.parquet(f"{model_path}/stages/1_*/data").select(
        F.col("treeID").alias("tree"),
        node["id"].alias("node"),
        node["split"]["featureIndex"].alias("feature"),
        F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        node["leftChild"].alias("left"),
        node["rightChild"].alias("right"),
        node["prediction"].alias("prediction"),
    )


def _leaf(tree: Column, inputs: Column, depth: int) -> Column:
    """The node of one tree (an array in order of node numbers) that a row falls to."""

    def step(at: Column, _: Column) -> Column:
        node = F.get(tree, at)
        goes_left = F.get(inputs, node["feature"]) <= node["threshold"]
        below = F.when(goes_left, node["left"]).otherwise(node["right"])
        return F.when(node["left"] < 0, at).otherwise(below)

    steps = F.sequence(F.lit(1), F.lit(depth)) if depth else F.array().cast("array<int>")
    return F.get(tree, F.aggregate(steps, F.lit(0), step))


def apply_nodes(rows: DataFrame, nodes: DataFrame, inputs: list[str], depth: int) -> DataFrame:
    """``rows`` with ``prediction``, the mean over all trees. The table's size is that of the
    model (trees times at most 2 to the power of its depth plus one), whatever the rows: it
    reaches them as one value. A node's place in its array is its number."""
    fields = ["node", "feature", "threshold", "left", "right", "prediction"]
    by_tree = nodes.groupBy("tree").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("nodes"))
    trees = by_tree.agg(F.sort_array(F.collect_list(F.struct("tree", "nodes"))).alias("trees")).scalar()
    ready = rows.withColumns(
        {"_trees": trees, "_inputs": F.array(*(F.col(c).cast("double") for c in inputs))}
    )
    total = F.aggregate(
        "_trees",
        F.lit(0.0),
        lambda sum_, tree: sum_ + _leaf(tree["nodes"], F.col("_inputs"), depth)["prediction"],
    )
    return ready.withColumn("prediction", total / F.size("_trees")).drop("_trees", "_inputs")


#: Rows that go down a tree side by side; their inputs stay in a core's cache.
ROWS_AT_ONCE = 4096


def score_rows(rows: DataFrame, nodes: DataFrame, inputs: list[str]) -> DataFrame:
    """``rows`` with ``prediction`` as the saved model has it, bit for bit: all rows of a batch go
    down a tree together, one level after the other. The nodes reach the tasks as arrays, whose
    size is that of the model. A missing input is an error, as it is to the model."""
    found = nodes.orderBy("tree", "node").toArrow().to_pydict()
    tree, node = np.array(found["tree"], np.int64), np.array(found["node"], np.int64)
    roots = np.flatnonzero(node == 0)
    first = roots[np.searchsorted(tree[roots], tree)]
    below = np.stack([np.array(found[side], np.int64) for side in ("left", "right")], axis=1)
    leaf = below[:, 0] < 0
    here = np.arange(len(node))
    if (here - first != node).any():
        raise ValueError("the nodes of a tree are not numbered from 0 on")
    # a leaf leads to itself
    child = np.where(leaf[:, None], here[:, None], below + first[:, None]).ravel()
    feature = np.where(leaf, 0, np.array(found["feature"], np.int64))
    limit = np.array([0.0 if x is None else x for x in found["threshold"]])
    value = np.array(found["prediction"])
    depth, level = 0, roots
    while not leaf[level].all():
        level = np.unique(child.reshape(-1, 2)[level])
        depth += 1

    def predicted(x: np.ndarray) -> np.ndarray:
        base, flat = np.arange(len(x)) * x.shape[1], x.ravel()
        total = np.zeros(len(x))
        for root in roots:
            at = np.full(len(x), root)
            for _ in range(depth):
                at = child.take(2 * at + (flat.take(base + feature.take(at)) > limit.take(at)))
            total += value.take(at)
        return total / len(roots)

    @F.arrow_udf("double")
    def score(given: pa.Array) -> pa.Array:
        x = given.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(inputs))
        if len(x) != len(given) or np.isnan(x).any():
            raise ValueError("an input of the model is missing")
        parts = [predicted(x[i : i + ROWS_AT_ONCE]) for i in range(0, len(x), ROWS_AT_ONCE)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return rows.withColumn("prediction", score(F.array(*(F.col(c).cast("double") for c in inputs))))
