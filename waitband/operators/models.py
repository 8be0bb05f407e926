"""Models over the entity-month panel (Spark ML, distributed fitting).

* ``trend_forecast``: per trust x specialty least-squares trend of the list
  size, projected ``horizon`` months ahead.  The fit is a grouped
  aggregation of exact integer sums (n, Sx, Sy, Sxy, Sxx), so it scales with
  partial aggregation and is reproducible to the last bit.
* ``compare_clusters`` / ``trust_clusters``: standardised trust features ->
  k-means -> PCA(2), with the silhouette score of each k.
* ``breach_model``: gradient-boosted trees on the breach features with
  class weights, time-based split, ROC-AUC and PR-AUC on the held-out month.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .features import ENTITY
from .load import exclude_revised

EPOCH = "2000-01-01"


def _month_index(col: str):
    return F.expr(f"cast(months_between(trunc({col}, 'MM'), date'{EPOCH}') as bigint)")


def trend_forecast(panel: DataFrame, value_col: str = "total_incomplete", entity=ENTITY, horizon: int = 3,
                   digits: int = 4) -> DataFrame:
    e = list(entity)
    x, y = _month_index("period_date"), F.col(value_col).cast("bigint")
    fit = panel.select(*e, "period_date", x.alias("x"), y.alias("y")).groupBy(*e).agg(
        F.count("y").cast("bigint").alias("n"), F.sum("x").cast("bigint").alias("sx"),
        F.sum("y").cast("bigint").alias("sy"), F.sum(F.col("x") * F.col("y")).cast("bigint").alias("sxy"),
        F.sum(F.col("x") * F.col("x")).cast("bigint").alias("sxx"), F.max("period_date").alias("last_period"),
        F.max("x").alias("x_last"))
    num = (F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")).cast("double")
    den = (F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")).cast("double")
    slope = F.try_divide(num, F.when(den != 0, den))
    intercept = (F.col("sy").cast("double") - slope * F.col("sx").cast("double")) / F.col("n").cast("double")
    fitted = fit.select(*e, "n", "last_period", "x_last", slope.alias("slope"), intercept.alias("intercept"))
    steps = fitted.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"))
    yhat = F.col("intercept") + F.col("slope") * (F.col("x_last") + F.col("h")).cast("double")
    return steps.select(*e, F.add_months("last_period", F.col("h")).alias("forecast_period"),
                        F.col("h").cast("bigint").alias("horizon"), F.col("n").alias("points"),
                        F.round("slope", digits).alias("trend_per_month"),
                        F.round(yhat, digits).alias("forecast_total_incomplete"))


def trust_features(panel: DataFrame) -> DataFrame:
    """Per trust: mean monthly list size, weighted pct within 18 weeks,
    long-waiter ratio and surgical share of the list."""
    g = panel.groupBy("provider_org_code").agg(
        F.sum("total_incomplete").alias("t"), F.sum("patients_within_18_weeks").alias("w"),
        F.sum("patients_waiting_52_plus_weeks").alias("l"), F.countDistinct("period_date").alias("m"),
        F.sum(F.when(F.col("is_surgical"), F.col("total_incomplete")).otherwise(0)).alias("s"))
    return g.select(
        "provider_org_code",
        F.coalesce(F.try_divide(F.col("w").cast("double") * 100.0, F.col("t").cast("double")), F.lit(0.0)).alias("pct_within_18_weeks"),
        (F.col("t").cast("double") / F.col("m").cast("double")).alias("total_incomplete"),
        F.coalesce(F.try_divide(F.col("l").cast("double"), F.col("t").cast("double")), F.lit(0.0)).alias("long_waiter_ratio"),
        F.coalesce(F.try_divide(F.col("s").cast("double"), F.col("t").cast("double")), F.lit(0.0)).alias("surgical_share"))


FEATURES = ["pct_within_18_weeks", "total_incomplete", "long_waiter_ratio", "surgical_share"]


def trust_clusters(panel: DataFrame, k: int = 4, seed: int = 42) -> tuple[DataFrame, float]:
    """(clusters per trust with two principal components, silhouette score)."""
    out, scores = compare_clusters(panel, (k,), seed)
    return out.drop("k"), scores.first()["silhouette"]


def compare_clusters(panel: DataFrame, ks: tuple[int, ...] = (4, 5), seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """K-means of the standardised trust features for each ``k``: the clusters
    and a row per ``k`` with its silhouette.  The features are written to the
    shared scratch folder once; every fit reads that small table."""
    from pyspark.ml import Pipeline
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    feats = written(trust_features(panel), "trust-features")
    prep = Pipeline(stages=[
        VectorAssembler(inputCols=FEATURES, outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
        PCA(k=2, inputCol="features", outputCol="pca"),
    ]).fit(feats)
    ready = prep.transform(feats)
    arr, parts, scores = vector_to_array("pca"), [], []
    for k in ks:
        out = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(ready).transform(ready)
        found = out.select("cluster").distinct().count()
        score = ClusteringEvaluator(featuresCol="features", predictionCol="cluster").evaluate(out) if found > 1 else None
        scores.append((k, found, score))
        parts.append(out.select(F.lit(k).cast("bigint").alias("k"), "provider_org_code", *FEATURES, F.col("cluster").cast("bigint").alias("cluster"),
                                arr[0].alias("pca_1"), arr[1].alias("pca_2")))
    return reduce(DataFrame.unionByName, parts), panel.sparkSession.createDataFrame(scores, "k bigint, clusters bigint, silhouette double")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` from a table in the shared scratch folder: what is fitted on it
    reads that, not the plan behind it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


MODEL_FEATURES = ["rolling_3m_pct", "mom_list_change", "long_waiter_ratio", "pct_within_18_weeks", "total_incomplete"]


def breach_training_rows(features: DataFrame) -> DataFrame:
    """Labelled rows with split and class weight: the last labelled month is the
    test set; the training rows that meet the standard weigh as much as those
    that do not.  Revised months, where the panel marks them, are left out."""
    if "_is_revised" in features.columns:
        features = exclude_revised(features)
    data = (features.filter(F.col("target_meets_next_month").isNotNull())
            .withColumn("label", F.col("target_meets_next_month").cast("double"))
            .select(*ENTITY, "period_date", "label", *[F.col(c).cast("double").alias(c) for c in MODEL_FEATURES]))
    months = data.groupBy("period_date").agg(F.sum("label").alias("pos"), F.count(F.lit(1)).alias("n"))
    last = months.agg(F.max("period_date").alias("last"))
    # one row each: the last month, and the class counts before it
    counts = months.join(F.broadcast(last), F.col("period_date") < F.col("last")).agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    one = counts.withColumn("one", F.lit(1)).join(last.withColumn("one", F.lit(1)), "one").select(
        "last", F.when(F.col("pos") > 0, (F.col("n") - F.col("pos")) / F.col("pos")).otherwise(1.0).alias("w_pos"))
    both = data.join(F.broadcast(one), F.col("period_date") <= F.col("last"))
    return both.select(*data.columns, (F.col("period_date") == F.col("last")).alias("is_test"),
                       F.when(F.col("label") == 1.0, F.col("w_pos")).otherwise(F.lit(1.0)).alias("weight"))


def breach_model(features: DataFrame, seed: int = 42) -> tuple[DataFrame, dict]:
    """Train on all but the last labelled month, evaluate on the last.  The
    features are written once, so the plan behind them runs once; the training
    rows come from there.  ROC-AUC and PR-AUC are
    None where the test month holds one class."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.feature import Imputer, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    data = written(breach_training_rows(written(features, "breach-features")), "breach-rows")
    train, test = data.filter(~F.col("is_test")), data.filter(F.col("is_test"))
    imputed = [f"{c}_i" for c in MODEL_FEATURES]
    pipe = Pipeline(stages=[
        Imputer(inputCols=MODEL_FEATURES, outputCols=imputed, strategy="median"),
        VectorAssembler(inputCols=imputed, outputCol="features"),
        GBTClassifier(labelCol="label", featuresCol="features", weightCol="weight", maxIter=20, maxDepth=4,
                      seed=seed),
    ])
    pred = pipe.fit(train).transform(test)
    sizes = data.groupBy("is_test").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("label").alias("classes"), F.max("weight").alias("w")).collect()
    of = {r["is_test"]: r for r in sizes}
    metrics = {"n_train": of[False]["n"], "n_test": of[True]["n"]}
    for m in ("areaUnderROC", "areaUnderPR"):
        metrics[m] = float(BinaryClassificationEvaluator(labelCol="label", metricName=m).evaluate(pred)) if of[True]["classes"] > 1 else None
    return pred.select(*ENTITY, "period_date", "label", vector_to_array("probability")[1].alias("p_meets"),
                       F.col("prediction")), metrics
