"""Random forest for the daily count: fit, store, score, measure."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from kerbside.functions.numeric import round_half_up
from kerbside.session import staging_path

LABEL = "total_footfall"
CATEGORIES = ["city", "footfall_location", "weekday", "month"]
PREDICTION = "predicted_total_footfall"
ENCODING = "column string, value string, mean double, n long"

# Training rows are encoded by the other folds' labels; a mean counts as if this many rows of the overall mean were with it.
FOLDS = 5
SMOOTHING = 5.0


def stage(spark: SparkSession, rows: DataFrame, path: str | None = None) -> DataFrame:
    """Store the training rows once, at ``path`` or in the staging folder; fitting passes over them many times."""
    path = path or staging_path(spark, "training-rows")
    rows.write.mode("overwrite").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@dataclass(frozen=True)
class FootfallModel:
    """The fitted stages, and the mean label of each value of each category as a table.

    Categories are encoded in this one way whatever their number. The table stays
    distributed: values are grouped and joined, never listed on the driver.
    """

    stages: PipelineModel
    encoding: DataFrame
    overall: float


def _values() -> Column:
    return F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in CATEGORIES]))


def encodings(rows: DataFrame) -> DataFrame:
    """``(column, value, mean, n)``: the mean label of every category value, null among them."""
    return (
        rows.select(_values(), F.col(LABEL).cast("double").alias("label"))
        .groupBy("column", "value")
        .agg(F.avg("label").alias("mean"), F.count("label").alias("n"))
    )


def fold() -> Column:
    """The fold of a training row, by a hash of its keys."""
    return (F.conv(F.substring(F.md5(_keys()), 1, 4), 16, 10).cast("int") % FOLDS).alias("fold")


def _keys() -> Column:
    keys = [*map(F.col, CATEGORIES), F.col("bank_holiday").cast("int")]
    return F.concat_ws("|", *[F.coalesce(k.cast("string"), F.lit("")) for k in keys])


def cross_means(rows: DataFrame) -> DataFrame:
    """``(column, value, fold, mean)``: the mean label of every category value in the other folds.

    No row's own label is in the mean it is encoded by. Means of few rows lean to the
    overall mean of the other folds; a value that only one fold has takes that.
    Labels are summed by value and fold first, so a hot value is a few rows.
    """
    label = F.col(LABEL).cast("double")
    own = rows.select(_values(), fold(), label.alias("label")).groupBy("column", "value", "fold")
    own = own.agg(F.coalesce(F.sum("label"), F.lit(0.0)).alias("s"), F.count("label").alias("n"))
    whole = own.groupBy(F.col("column").alias("_column"), F.col("value").alias("_value")).agg(F.sum("s").alias("all_s"), F.sum("n").alias("all_n"))
    by_fold = own.filter(F.col("column") == CATEGORIES[0]).groupBy(F.col("fold").alias("_fold")).agg(F.sum("s").alias("fold_s"), F.sum("n").alias("fold_n"))
    every = Window.partitionBy(F.lit(0))  # a row for each fold
    s, n = F.sum("fold_s").over(every), F.sum("fold_n").over(every)
    rest = F.when(n > F.col("fold_n"), (s - F.col("fold_s")) / (n - F.col("fold_n"))).otherwise(s / n)
    by_fold = by_fold.select("_fold", rest.alias("rest"))
    means = own.join(whole, (F.col("column") == F.col("_column")) & F.col("value").eqNullSafe(F.col("_value"))).join(by_fold, F.col("fold") == F.col("_fold"))
    mean = (F.col("all_s") - F.col("s") + SMOOTHING * F.col("rest")) / (F.col("all_n") - F.col("n") + SMOOTHING)
    return means.select("column", "value", "fold", mean.alias("mean"))


def _encoded(rows: DataFrame, encoding: DataFrame, overall: float) -> DataFrame:
    """Add ``<category>_mean``; a value not seen in training has the overall mean."""
    for column in CATEGORIES:
        of = encoding.filter(F.col("column") == column).select(F.col("value").alias("_value"), F.col("mean").alias("_mean"))
        rows = rows.join(of, F.col(column).cast("string").eqNullSafe(F.col("_value")), "left")
        rows = rows.withColumn(f"{column}_mean", F.coalesce("_mean", F.lit(overall))).drop("_value", "_mean")
    return rows


def _cross_encoded(rows: DataFrame, means: DataFrame) -> DataFrame:
    """Add ``<category>_mean`` to training rows, from the other folds."""
    rows = rows.withColumn("_own", fold())
    for column in CATEGORIES:
        of = means.filter(F.col("column") == column).select(F.col("value").alias("_value"), "fold", F.col("mean").alias(f"{column}_mean"))
        same = F.col(column).cast("string").eqNullSafe(F.col("_value")) & (F.col("_own") == F.col("fold"))
        rows = rows.join(of, same, "left").drop("_value", "fold")
    return rows.drop("_own")


def train(
    rows: DataFrame, num_trees: int = 20, max_depth: int = 5, seed: int = 42, path: str | None = None, cross_fit: bool = True
) -> FootfallModel:
    """Fit on all columns but the label. Missing measures take the column mean.

    The encoding is stored at ``path``, or in the staging folder. Training rows are
    encoded by the labels of other folds (:func:`cross_means`), or by all labels, their own among them, without
    ``cross_fit``; rows to score by all labels.
    """
    spark = rows.sparkSession
    numbers = [c for c in rows.columns if c not in CATEGORIES and c != LABEL]
    rows = rows.select(
        *CATEGORIES, *[F.col(c).cast("double").alias(c) for c in numbers], F.col(LABEL).cast("double").alias(LABEL)
    )
    overall = rows.agg(F.avg(LABEL)).first()[0]
    if overall is None:
        raise ValueError("no training rows with a label")
    encoding = stage(spark, encodings(rows), path or staging_path(spark, "category-means"))
    filled = [f"{c}_filled" for c in numbers]
    stages = [
        Imputer(inputCols=numbers, outputCols=filled),
        VectorAssembler(inputCols=[f"{c}_mean" for c in CATEGORIES] + filled, outputCol="features"),
        RandomForestRegressor(
            featuresCol="features",
            labelCol=LABEL,
            predictionCol=PREDICTION,
            numTrees=num_trees,
            maxDepth=max_depth,
            seed=seed,
        ),
    ]
    if cross_fit:
        encoded = _cross_encoded(rows, stage(spark, cross_means(rows)))
    else:
        encoded = _encoded(rows, encoding, overall)
    return FootfallModel(Pipeline(stages=stages).fit(encoded), encoding, overall)


def save(model: FootfallModel, path: str) -> None:
    """Store the model, replacing the one at ``path``."""
    model.stages.write().overwrite().save(f"{path}/stages")
    model.encoding.write.mode("overwrite").parquet(f"{path}/encoding")
    overall = model.encoding.sparkSession.createDataFrame([(model.overall,)], "overall double")
    overall.coalesce(1).write.mode("overwrite").parquet(f"{path}/overall")


def load(spark: SparkSession, path: str) -> FootfallModel:
    encoding = spark.read.schema(ENCODING).parquet(f"{path}/encoding")
    overall = spark.read.schema("overall double").parquet(f"{path}/overall").first()[0]
    return FootfallModel(PipelineModel.load(f"{path}/stages"), encoding, overall)


def predict(model: FootfallModel, rows: DataFrame) -> DataFrame:
    """All input columns and ``predicted_footfall``, rounded to whole people."""
    # the imputer wants doubles; inputs come back in their own types
    inputs = rows.columns
    measures = [c for c, t in rows.dtypes if t in ("int", "bigint")]
    own = rows.select(
        *[F.col(c).cast("double").alias(c) if c in measures else F.col(c) for c in inputs],
        *[F.col(c).alias(f"_in_{c}") for c in measures],
    )
    scored = model.stages.transform(_encoded(own, model.encoding, model.overall))
    kept = [F.col(f"_in_{c}").alias(c) if c in measures else F.col(c) for c in inputs]
    scored = scored.select(*kept, PREDICTION)
    return scored.withColumn("predicted_footfall", round_half_up(F.col(PREDICTION))).drop(PREDICTION)


def filled_values(model: FootfallModel) -> DataFrame:
    """``(column, mean)``: what the fitted model puts where a measure is missing."""
    imputer = next(s for s in model.stages.stages if hasattr(s, "surrogateDF"))
    wide = imputer.surrogateDF
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("mean")) for c in wide.columns]
    return wide.select(F.inline(F.array(*pairs)))


def held_out() -> Column:
    """True for about a quarter of the training rows, by a hash of their keys."""
    return F.crc32(_keys()) % 4 == 0


def fit_report(rows: DataFrame, **options) -> DataFrame:
    """How well a model fits rows it has not seen: a row with n, mean absolute and root mean square
    error, the same errors of always guessing the mean, and the share of variance explained.

    The models are fitted on the rows that :func:`held_out` leaves, one with training rows encoded by
    other folds, one by all labels (``cross_fit``).
    """
    both = [_report(rows, cross_fit, **options).withColumn("cross_fit", F.lit(cross_fit)) for cross_fit in (True, False)]
    return both[0].unionByName(both[1])


def _report(rows: DataFrame, cross_fit: bool, **options) -> DataFrame:
    seen, unseen = rows.filter(~held_out()), rows.filter(held_out())
    model = train(seen, cross_fit=cross_fit, **options)
    scored = predict(model, unseen)
    off, plain = F.col("predicted_footfall") - F.col(LABEL), F.col(LABEL) - F.lit(model.overall)
    sums = [
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(off)).alias("mean_absolute_error"),
        F.sqrt(F.avg(off * off)).alias("root_mean_square_error"),
        F.avg(F.abs(plain)).alias("mean_absolute_error_of_mean"),
        F.sqrt(F.avg(plain * plain)).alias("root_mean_square_error_of_mean"),
    ]
    explained = 1 - F.pow(F.col("root_mean_square_error") / F.col("root_mean_square_error_of_mean"), 2)
    return scored.agg(*sums).withColumn("explained", explained)
