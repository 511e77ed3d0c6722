"""Tree models as tables of nodes, and predictions by joins with them.

A second way to a model's predictions, in plain Spark expressions: a row starts at the root of every
tree and goes one level down with each join, until it is at a leaf.
"""

from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstats.workspace import scratch_path

_ROOT = 0


def size(model) -> tuple[int, int]:
    """The number of trees of a fitted model, and the depth of the deepest."""
    trees = getattr(model, "trees", [model])
    return len(trees), max(tree.depth for tree in trees)


def node_table(spark: SparkSession, model) -> DataFrame:
    """One row a node: tree, node, the children left and right (null at a leaf), feature and threshold (values up
    to it go left), prediction, and the share of the tree in the model's prediction.

    ``model`` is a fitted tree, boosted trees or forest over numbers; splits by category are refused.
    """
    path = scratch_path(spark, "tree-model")
    model.save(path)
    saved = spark.read.parquet(f"{path}/data")
    if isinstance(model, (GBTRegressionModel, RandomForestRegressionModel)):
        weights = list(model.treeWeights)
        if isinstance(model, RandomForestRegressionModel):
            weights = [1.0 / len(weights)] * len(weights)
        nodes = saved.select(F.col("treeID").alias("tree"), "nodeData.*")
        share = F.element_at(F.array(*map(F.lit, weights)), F.col("tree") + 1)
    else:
        nodes, share = saved.withColumn("tree", F.lit(0)), F.lit(1.0)
    inner = F.col("leftChild") >= 0
    refused = F.raise_error(F.lit("a split by categories")).cast("double")
    threshold = F.when(F.col("split.numCategories") >= 0, refused).otherwise(
        F.element_at("split.leftCategoriesOrThreshold", 1)
    )
    return nodes.select(
        "tree",
        F.col("id").alias("node"),
        F.when(inner, F.col("leftChild")).alias("left"),
        F.when(inner, F.col("rightChild")).alias("right"),
        F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner, threshold).alias("threshold"),
        "prediction",
        share.alias("share"),
    )


def predict_by_nodes(
    rows: DataFrame, nodes: DataFrame, features: list[str], key: list[str], trees: int, depth: int
) -> DataFrame:
    """``key`` and prediction of each row.  ``trees`` is their number, ``depth`` that of the deepest.

    Models have at most a few thousand nodes (their depth and number of trees bound them), so a
    join is a broadcast; the trees of a row meet by its key at the end, summed in each task first.
    The roots, one a tree, are known to all rows: the first step needs no join.
    """
    roots = nodes.filter(F.col("node") == _ROOT).orderBy("tree").collect()
    kinds = {"feature": "int", "threshold": "double", "left": "int", "right": "int"}
    splits = [F.lit([root[c] for root in roots]).cast(f"array<{kind}>") for c, kind in kinds.items()]
    feature, threshold, left, right = (F.element_at(split, F.col("tree") + 1) for split in splits)
    nodes = F.broadcast(nodes)
    values = F.array(*(F.col(name).cast("double") for name in features)).alias("values")
    at = rows.select(*key, values, F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    below = F.when(F.element_at("values", feature + 1) <= threshold, left).otherwise(right)
    at = at.withColumn("node", F.when(feature.isNull(), F.lit(_ROOT)).otherwise(below))
    for _ in range(depth - 1):
        step = nodes.select("tree", "node", "left", "right", "feature", "threshold")
        value = F.element_at("values", F.col("feature") + 1)
        below = F.when(value <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        at = at.join(step, ["tree", "node"]).select(
            *key, "values", "tree", F.when(F.col("feature").isNull(), F.col("node")).otherwise(below).alias("node")
        )
    leaves = at.join(nodes.select("tree", "node", "prediction", "share"), ["tree", "node"])
    return leaves.groupBy(*key).agg(F.sum(F.col("prediction") * F.col("share")).alias("prediction"))
