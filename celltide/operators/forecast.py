"""Traffic forests: training, held-out metrics and forecasts.

A forest is a fitted pipeline or a list of trees. A tree is a leaf's value or (column, threshold, tree where
the column is at most the threshold, tree above it); its leaves hold user counts, or chances of the busy
class. Lists of trees are scored by column functions and can be written as SQL text for another engine.
"""

from __future__ import annotations

from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from celltide.functions.times import as_utc
from celltide.operators.features import (
    feature_columns,
    onehot_dow,
    onehot_freq,
    temporal_features,
)

# Forests keep the node that each row has come to; otherwise every level walks all trees from their roots again.
TREES = 100
SEED = 42
BUSY_THRESHOLD = 80.0  # fixed value: user count a busy cell is compared with


def _assembler(columns) -> VectorAssembler:
    return VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="keep")


def feature_matrix(df: DataFrame, top_n=10, leaky=False, wide=False) -> DataFrame:
    """`features`, one vector per row."""
    return _assembler(feature_columns(top_n, leaky, wide)).transform(_numeric(df))


def _numeric(df: DataFrame) -> DataFrame:
    flags = [c for c, t in df.dtypes if t == "boolean"]
    return df.withColumns({c: F.col(c).cast("int") for c in flags}) if flags else df


def train_regressor(
    df: DataFrame, trees=TREES, seed=SEED, depth=10, leaky=False, wide=False, top_n=10
) -> PipelineModel:
    """Forest for the user count."""
    forest = RandomForestRegressor(
        labelCol="ues_usage", featuresCol="features", numTrees=trees, seed=seed, maxDepth=depth,
        cacheNodeIds=True,
    )
    columns = feature_columns(top_n, leaky, wide)
    return Pipeline(stages=[_assembler(columns), forest]).fit(_numeric(df))


def train_classifier(
    df: DataFrame, trees=TREES, seed=SEED, depth=10, wide=False, top_n=10
) -> PipelineModel:
    """Forest for the traffic class; the user count is one of its features."""
    forest = RandomForestClassifier(
        labelCol="traffic_class", featuresCol="features", numTrees=trees, seed=seed,
        maxDepth=depth, cacheNodeIds=True,
    )
    columns = feature_columns(top_n, True, wide)
    return without_summary(Pipeline(stages=[_assembler(columns), forest]).fit(_numeric(df)))


def without_summary(model: PipelineModel) -> PipelineModel:
    """The model without its training summary.

    A fitted classifier keeps the summary, and with it the scored training table and its session; its
    scoring function carries the whole model to the executors, where neither can go.
    """
    for stage in model.stages:
        if getattr(stage, "hasSummary", False):
            stage._java_obj.setSummary(SparkContext._active_spark_context._jvm.scala.Option.empty())
    return model


def trees_of(model: PipelineModel) -> list:
    """The forest's trees; for a classifier the leaves hold the chance of class 1."""
    columns, forest = model.stages[0].getInputCols(), model.stages[-1]
    classes = isinstance(forest, RandomForestClassificationModel)

    def told(node):
        if node.subtreeDepth() == 0:
            if not classes:
                return float(node.prediction())
            counts = list(node.impurityStats().stats())
            return counts[1] / sum(counts)
        split = node.split()
        return (columns[split.featureIndex()], float(split.threshold()), told(node.leftChild()), told(node.rightChild()))

    return [told(t._java_obj.rootNode()) for t in forest.trees]


def tree_value(tree) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    column, threshold, low, high = tree
    return F.when(F.col(column).cast("double") <= threshold, tree_value(low)).otherwise(tree_value(high))


def forest_value(trees) -> Column:
    """The mean of the trees, added in their order."""
    total = tree_value(trees[0])
    for tree in trees[1:]:
        total = total + tree_value(tree)
    return total / F.lit(float(len(trees)))


def tree_sql(tree) -> str:
    """The tree as a CASE; numbers are written so that every engine reads them as doubles."""
    if not isinstance(tree, tuple):
        return f"CAST('{float(tree)!r}' AS DOUBLE)"
    column, threshold, low, high = tree
    return (f"CASE WHEN CAST({column} AS DOUBLE) <= CAST('{threshold!r}' AS DOUBLE) "
            f"THEN {tree_sql(low)} ELSE {tree_sql(high)} END")


def forest_sql(trees) -> str:
    return f"(({' + '.join(map(tree_sql, trees))}) / {float(len(trees))!r})"


def train_traffic(df: DataFrame, trees=TREES, seed=SEED, **options):
    """(regressor, classifier) on the table of `traffic_features`."""
    leaky = options.pop("leaky", False)
    return (
        train_regressor(df, trees, seed, leaky=leaky, **options),
        train_classifier(df, trees, seed, **options),
    )


def predict_usage(df: DataFrame, regressor: PipelineModel | list) -> DataFrame:
    if isinstance(regressor, list):
        return df.withColumn("predicted_usage", forest_value(regressor))
    scored = regressor.transform(_numeric(df)).drop("features")
    return scored.withColumnRenamed("prediction", "predicted_usage")


def predict_class(df: DataFrame, classifier: PipelineModel | list) -> DataFrame:
    if isinstance(classifier, list):
        told = df.withColumn("confidence", forest_value(classifier))
        return told.withColumn("predicted_class", (F.col("confidence") > 0.5).cast("int"))
    scored = classifier.transform(_numeric(df)).drop("features", "rawPrediction")
    return scored.withColumns({
        "predicted_class": F.col("prediction").cast("int"),
        "confidence": vector_to_array("probability")[1],
    }).drop("prediction", "probability")


def evaluate(regressor: PipelineModel, classifier: PipelineModel, df: DataFrame) -> DataFrame:
    """Held-out figures: one row per metric, from one aggregate and one table of label pairs."""
    usage = predict_usage(df, regressor)
    miss = F.col("predicted_usage") - F.col("ues_usage")
    u = usage.agg(
        F.avg(F.abs(miss)).alias("mae"), F.avg(miss * miss).alias("mse"), F.var_pop("ues_usage").alias("var"),
    ).first()
    pairs = predict_class(df, classifier).groupBy("traffic_class", "predicted_class").agg(
        F.count("*").alias("n")).collect()  # at most the number of classes squared
    n = {(r[0], r[1]): r["n"] for r in pairs}
    total = sum(n.values())
    mse, var = u["mse"] or 0.0, u["var"] or 0.0
    rows = [("regressor", "mae", u["mae"] or 0.0), ("regressor", "rmse", mse ** 0.5),
            ("regressor", "r2", 1 - mse / var if var else 0.0)]
    labels = sorted({a for a, _ in n})
    parts = {"accuracy": 0.0, "f1": 0.0, "weightedPrecision": 0.0, "weightedRecall": 0.0}
    for c in labels:
        hit = n.get((c, c), 0)
        own, said = sum(k for (a, _), k in n.items() if a == c), sum(k for (_, b), k in n.items() if b == c)
        precision, recall = hit / said if said else 0.0, hit / own
        parts["accuracy"] += hit / total
        parts["weightedPrecision"] += precision * own / total
        parts["weightedRecall"] += recall * own / total
        parts["f1"] += own / total * (2 * precision * recall / (precision + recall) if hit else 0.0)
    rows += [("classifier", k, v) for k, v in parts.items()]
    return df.sparkSession.createDataFrame(rows, "model STRING, metric STRING, value DOUBLE")


def save_models(regressor: PipelineModel, classifier: PipelineModel, path: str) -> None:
    regressor.write().overwrite().save(f"{path}/traffic_regressor_model")
    classifier.write().overwrite().save(f"{path}/traffic_classifier_model")


def load_models(path: str) -> tuple[PipelineModel, PipelineModel]:
    return (
        PipelineModel.load(f"{path}/traffic_regressor_model"),
        PipelineModel.load(f"{path}/traffic_classifier_model"),
    )


def forecast(
    df: DataFrame, regressor: PipelineModel, classifier: PipelineModel,
    threshold=BUSY_THRESHOLD, top_n=10,
) -> DataFrame:
    """Busy flag, confidence and user count for each (cell_id, event_time).

    Every row gets its own prediction, from the same features as training; features a request
    cannot know are 0.
    """
    known = onehot_dow(temporal_features(df))
    if "frequency" in known.columns:
        known = onehot_freq(known)
    wanted = {*feature_columns(top_n, False, True)}
    missing = {c: F.lit(0) for c in sorted(wanted - set(known.columns))}
    known = known.withColumns(missing) if missing else known
    usage = predict_usage(known, regressor).withColumn("ues_usage", F.col("predicted_usage"))
    return predict_class(usage, classifier).select(
        *df.columns,
        (F.col("predicted_class") == 1).alias("cell_busy"),
        F.round("confidence", 4).alias("confidence"),
        F.round("predicted_usage", 2).alias("predicted_ues_usage"),
        F.lit(float(threshold)).alias("threshold"),
        (F.col("predicted_usage") > threshold).alias("over_threshold"),
    )


def requests_to_rows(df: DataFrame, requests="requests") -> DataFrame:
    """Parsed request lists to (cell_id, event_time), one row per item; unreadable items drop."""
    item = df.select(F.explode(requests).alias("r"))
    return item.select(
        F.col("r").getField("Cell ID").try_cast("bigint").alias("cell_id"),
        as_utc(F.col("r").getField("Datetime_ts")).alias("event_time"),
    ).dropna()
