"""Forecast of units sold: features, random forest, metrics, predictions."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators import features as feat
from tillroll.operators.evaluation import fold_of, is_training_row, regression_metrics, row_hash
from tillroll.plans import forest_table
from tillroll.session import materialise, scratch_dir, scratch_scope
from tillroll.sinks.files import write_metrics
from tillroll.sinks.tables import full_refresh
from tillroll.sources.tables import reused


@dataclass(frozen=True)
class ForecastSettings:
    trees: int = 200
    depth: int = 10
    min_leaf: int = 2
    seed: int = 42
    folds: int = 5
    #: None: models are fitted and cross-validated on all order lines. A caller who sets it gets
    #: about so many, those that hash lowest. Every line is predicted, and metrics cover all held out.
    labelled_rows: int | None = None
    #: Partitions the labelled lines are dealt to by a hash of the line, at least. A forest's bags
    #: follow the partitions, so a number that the lines alone decide gives the same model on any
    #: cluster.
    partitions: int = 4
    #: Group means from training rows only, without the features that contain the label.
    leak_free: bool = False
    #: Whether a tree is fitted on rows drawn with replacement, or on all as they are.
    bootstrap: bool = True
    #: Features to use; None stands for all.
    only: tuple[str, ...] | None = None

    @property
    def inputs(self) -> list[str]:
        if self.only is not None:
            return list(self.only)
        return [f for f in feat.FEATURES if not (self.leak_free and f in feat.LEAKING)]


@dataclass(frozen=True)
class Forecast:
    model: PipelineModel
    metrics: dict[str, float]
    predictions: DataFrame


_KEY = ["order_id", "product_id", feat.LABEL, "line_total_usd", "order_discount_pct"]


def line_key() -> list[Column]:
    """The columns that stand for an order line, money and rates in whole hundredths."""
    whole = [F.col(c) for c in _KEY[:3]]
    return whole + [F.round(F.col(c) * 100).cast("bigint") for c in _KEY[3:]]


def training_side(settings: ForecastSettings) -> Column:
    """Which order lines the model is trained on."""
    return is_training_row(settings.seed, *line_key())


def forecast_features(
    fact: DataFrame, products: DataFrame, settings: ForecastSettings
) -> DataFrame:
    label_rows = training_side(settings) if settings.leak_free else None
    rows = feat.star_features(
        fact, products, label_rows, [*(c for c in _KEY if c != feat.LABEL), "category"]
    )
    return rows.withColumns(
        {
            "is_train": training_side(settings),
            "fold": fold_of(settings.seed, settings.folds, *line_key()),
        }
    )


def feature_table(fact: DataFrame, products: DataFrame, settings: ForecastSettings) -> DataFrame:
    """The features written once, so that no fit computes them again."""
    return materialise(forecast_features(fact, products, settings), "forecast-features")


#: Labelled lines a partition while there are fewer than MANY_PARTITIONS, and beyond that. Every
#: partition sends the statistics of every node, so what a fit shuffles grows with their number.
LINES_PER_PARTITION, MOST_LINES_PER_PARTITION, MANY_PARTITIONS = 100_000, 2_000_000, 48


def fit_partitions(lines: int, least: int) -> int:
    """In how many partitions so many lines are fitted, on any cluster."""
    few = min(MANY_PARTITIONS, -(-lines // LINES_PER_PARTITION))
    return max(least, few, -(-lines // MOST_LINES_PER_PARTITION))


def labelled(rows: DataFrame, settings: ForecastSettings) -> DataFrame:
    """The lines models are fitted and cross-validated on, in partitions that depend on the lines
    alone: all lines, unless the settings bound them."""
    hashed = rows.withColumn("_hash", row_hash(F.lit("labelled"), *line_key()))
    total = rows.count()
    if settings.labelled_rows is not None and total > settings.labelled_rows:
        hashed = hashed.filter(F.col("_hash") < 2**32 * settings.labelled_rows / total)
        total = settings.labelled_rows
    dealt = hashed.repartition(fit_partitions(total, settings.partitions), "_hash")
    return dealt.sortWithinPartitions("_hash", *_KEY).drop("_hash")


def split_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("is_train").agg(F.count(F.lit(1)).alias("n_rows"))


def forest(settings: ForecastSettings) -> Pipeline:
    """All features are tried at every split, as is usual for regression elsewhere."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=settings.inputs, outputCol="features"),
            RandomForestRegressor(
                featuresCol="features",
                labelCol=feat.LABEL,
                numTrees=settings.trees,
                maxDepth=settings.depth,
                minInstancesPerNode=settings.min_leaf,
                featureSubsetStrategy="all",
                bootstrap=settings.bootstrap,
                seed=settings.seed,
            ),
        ]
    )


def train(rows: DataFrame, settings: ForecastSettings) -> PipelineModel:
    return forest(settings).fit(rows.filter("is_train"))


def fold_scores(rows: DataFrame, settings: ForecastSettings) -> list[float]:
    """R² per fold. One model per fold and none on all rows: the final model exists."""
    scores = []
    for fold in range(settings.folds):
        held_out = F.col("fold") == fold
        model = forest(settings).fit(rows.filter(~held_out))
        scored = model.transform(rows.filter(held_out))
        scores.append(regression_metrics(scored, "prediction", feat.LABEL).first().r2)
    return scores


def evaluate(model: PipelineModel, rows: DataFrame) -> dict[str, float]:
    """Metrics over the held-out lines of ``rows``."""
    return held_out_metrics(model.transform(rows))


def held_out_metrics(scored: DataFrame) -> dict[str, float]:
    held_out = scored.filter(~F.col("is_train"))
    row = regression_metrics(held_out, "prediction", feat.LABEL).first()
    return {"mae": round(row.mae, 4), "r2": round(row.r2, 4)}


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """All rows, training rows included. The model's own ``transform`` takes the rows down every
    tree one by one; its node table does the same for many at once."""
    spark = rows.sparkSession
    path = f"{scratch_dir(spark, 'scoring')}/model"
    save_model(model, path)
    inputs = model.stages[0].getInputCols()
    scored = forest_table.score_rows(rows, forest_table.node_table(spark, path), inputs)
    return scored.withColumn("predicted_units", F.round("prediction", 2))


def prediction_table(
    scored: DataFrame, metrics: dict[str, float], run_date: date | None = None
) -> DataFrame:
    """The stored shape: run date and run metrics are repeated on every row."""
    return scored.select(
        "product_id",
        "category",
        "predicted_units",
        F.col(feat.LABEL).alias("actual_units"),
        (F.current_date() if run_date is None else F.lit(run_date)).alias("run_date"),
        F.lit(float(metrics["mae"])).alias("mae"),
        F.lit(float(metrics["r2"])).alias("r2_score"),
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def metrics_frame(spark, metrics: dict[str, float]) -> DataFrame:
    return spark.range(1).select(
        *[F.lit(float(metrics[name])).alias(name) for name in ("mae", "r2", "cv_r2")]
    )


def run_forecast(
    fact: DataFrame,
    products: DataFrame,
    table: str,
    artifacts: str,
    settings: ForecastSettings | None = None,
    run_date: date | None = None,
) -> Forecast:
    """Features -> split -> forest -> metrics and cross-validation -> predictions table,
    model, feature lookups (``features.load_lookups``) and metrics files."""
    settings = settings or ForecastSettings()
    spark = fact.sparkSession
    with scratch_scope(spark):
        rows = feature_table(fact, products, settings)
        with reused(labelled(rows, settings)) as sample:
            model = train(sample, settings)
            scores = fold_scores(sample, settings)
        scored = materialise(predict(model, rows).drop("features"), "forecast-scored")
        metrics = {**held_out_metrics(scored), "cv_r2": round(sum(scores) / len(scores), 4)}
        stored = full_refresh(prediction_table(scored, metrics, run_date), table)
        label_rows = training_side(settings) if settings.leak_free else None
        lookups = feat.fit_lookups(feat.training_rows(fact, products), label_rows)
        feat.save_lookups(lookups, f"{artifacts}/lookups")
    save_model(model, f"{artifacts}/model")
    write_metrics(metrics_frame(spark, metrics), f"{artifacts}/metrics")
    return Forecast(model, metrics, stored)
