"""Fitted tree ensembles as node tables, and scoring by walking the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerlight.functions import finite_or_zero
from peerlight.names import SUPERVISED_SCORE

NODE_COLUMNS = ("tree", "weight", "node", "feature", "threshold", "left", "right", "value")


def saved_tree_stage(spark: SparkSession, path: str) -> str:
    """Folder of the last stage of a saved pipeline, which holds the ensemble."""
    described = spark.read.json(f"{path}/metadata").select("paramMap.stageUids").first()[0]
    last = len(described) - 1
    return f"{path}/stages/{str(last).zfill(len(str(last + 1)) if last + 1 >= 10 else 1)}_{described[-1]}"


def node_table(spark: SparkSession, stage: str) -> DataFrame:
    """One row per node of a saved forest or boosted ensemble, read from its Parquet files.

    `value` is what a leaf adds to the ensemble's sum: for a forest its share of positive training weight, for
    boosting its prediction. Inner nodes send a row left when feature number `feature` is at most `threshold`;
    leaves have `left` = -1. Only numeric splits are supported, as the models here have no categories.
    """
    boosted = "GBT" in spark.read.json(f"{stage}/metadata").select("class").first()[0]
    node = F.col("nodeData")
    stats = node["impurityStats"]
    share = F.get(stats, F.lit(1)) / F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    weights = spark.read.parquet(f"{stage}/treesMetadata").select(F.col("_1").alias("treeID"), F.col("_3").alias("weight"))
    return (
        spark.read.parquet(f"{stage}/data")
        .join(weights, "treeID")
        .select(
            F.col("treeID").alias("tree"),
            "weight",
            node["id"].alias("node"),
            node["split"]["featureIndex"].alias("feature"),
            F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
            node["leftChild"].alias("left"),
            node["rightChild"].alias("right"),
            (node["prediction"] if boosted else share).alias("value"),
        )
    )


def packed_trees(nodes: DataFrame) -> DataFrame:
    """All trees as one row: per tree its weight, depth bound and its nodes' fields as arrays in node order.

    The size is that of the model: at most 2^(depth + 1) nodes a tree, whatever the data.
    """
    fields = ["node", "feature", "threshold", "left", "right", "value"]
    trees = nodes.groupBy("tree").agg(F.max("weight").alias("weight"), F.array_sort(F.collect_list(F.struct(*fields))).alias("nodes"))
    arrays = [F.col("nodes")[field].alias(field) for field in fields[1:]]
    return trees.agg(F.array_sort(F.collect_list(F.struct("tree", "weight", *arrays))).alias("trees"))


def ensemble_sum(trees: Column, features: Column, depth: int) -> Column:
    """Weighted sum of the leaf values that a row's feature array leads to, `depth` steps down each tree."""

    def leaf(tree: Column) -> Column:
        def step(node: Column, _: Column) -> Column:
            goes_left = F.get(features, F.get(tree["feature"], node)) <= F.get(tree["threshold"], node)
            below = F.when(goes_left, F.get(tree["left"], node)).otherwise(F.get(tree["right"], node))
            return F.when(F.get(tree["left"], node) < 0, node).otherwise(below)

        return F.get(tree["value"], F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step))

    return F.aggregate(trees, F.lit(0.0), lambda total, tree: total + tree["weight"] * leaf(tree))


def score_with_nodes(
    df: DataFrame, nodes: DataFrame, features: list[str], depth: int, boosted: bool = False, score: str = SUPERVISED_SCORE
) -> DataFrame:
    """`df` with the positive probability that the ensemble in a node table gives each row.

    Features are sanitised as the fitted pipelines do. A forest's score is the mean of its leaf values, a boosted
    ensemble's 1 / (1 + exp(-2 * sum)). Rows are neither joined nor shuffled; the trees are one value.
    """
    packed = packed_trees(nodes)
    values = F.array(*[finite_or_zero(name) for name in features])
    total = ensemble_sum(F.col("__trees"), values, depth)
    if boosted:
        probability = 1 / (1 + F.exp(-2 * total))
    else:
        weight = F.aggregate("__trees", F.lit(0.0), lambda a, tree: a + tree["weight"])
        probability = total / weight
    return df.withColumn("__trees", packed.scalar()).withColumn(score, probability).drop("__trees")


def score_with_saved_trees(df: DataFrame, path: str, features: list[str], depth: int, score: str = SUPERVISED_SCORE) -> DataFrame:
    """Scores of a saved pipeline whose last stage is a forest or boosted ensemble, without loading the model."""
    stage = saved_tree_stage(df.sparkSession, path)
    boosted = "GBT" in stage.rsplit("/", 1)[-1]
    return score_with_nodes(df, node_table(df.sparkSession, stage), features, depth, boosted, score)
