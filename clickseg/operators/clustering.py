"""Segmentation on the buyer feature table (M1-M9, M13 parts, A12-A14, O2, O3).

Model fitting uses Spark ML (``VectorAssembler``, ``StandardScaler``, ``KMeans``,
``ClusteringEvaluator``): distributed, one job per iteration, centers
broadcast.  The scaled features are materialized once and reused by every fit
of the k search, instead of being rebuilt from the input for each k.

Assignment to given centers and the silhouette are also written with built-in
array expressions, so they work on any frame (batch or stream) and can be
checked against SQL; the jobs use Spark ML.  The centers are a small
table (k rows); it is folded into one value, a scalar subquery.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickseg.session import materialize

SEED = 42


def feature_columns(df: DataFrame, exclude: tuple[str, ...] = ("user_id",)) -> list[str]:
    return [c for c in df.columns if c not in exclude]


def layout(df: DataFrame, partitions: int | None = None, key: str = "user_id") -> DataFrame:
    """Fixed row layout (hash partitions sorted by key) so K-Means is repeatable.

    K-Means|| initialization depends on the partition a row sits in and on the
    order there.  Both follow from the keys and the partition count alone: no
    range bounds are sampled.  The key must be unique.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, key).sortWithinPartitions(key)


#: Buyers in a partition of the feature table for the fits (8 doubles and an id, about 50 MB).
FIT_ROWS = 500_000
PLACES = 9


def prepare(features: DataFrame, partitions: int | None = None) -> DataFrame:
    """Lay the feature table out for the fits and materialize it.

    One partition for every ``FIT_ROWS`` buyers, so the layout follows from the data
    alone and not from the cluster; ``partitions`` overrides it.  Another count may
    give another fit: it is stored with the model's metrics.
    """
    if not partitions:
        features = materialize(features)
        partitions = max(1, -(-features.count() // FIT_ROWS))
    return materialize(layout(features, partitions))


def assembler(cols: list[str], output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=cols, outputCol=output, handleInvalid="error")


def scaler(with_mean: bool, input_col: str = "features",
           output: str = "scaledFeatures") -> StandardScaler:
    return StandardScaler(inputCol=input_col, outputCol=output, withStd=True, withMean=with_mean)


def assemble(df: DataFrame, cols: list[str] | None = None, output: str = "features") -> DataFrame:
    """M1: all feature columns (all but ``user_id`` by default) -> one vector."""
    return assembler(cols or feature_columns(df), output).transform(df)


def scale(df: DataFrame, with_mean: bool = False, input_col: str = "features",
          output: str = "scaledFeatures") -> DataFrame:
    """M2 (``with_mean=False``) / M3 (``True``): unit sample std, optionally centered."""
    return scaler(with_mean, input_col, output).fit(df).transform(df)


def kmeans(k: int, seed: int = SEED, max_iter: int = 20, tol: float = 1e-4,
           features_col: str = "scaledFeatures") -> KMeans:
    return KMeans(featuresCol=features_col, predictionCol="prediction", k=k, seed=seed,
                  maxIter=max_iter, tol=tol)


def segmentation_pipeline(cols: list[str], k: int, with_mean: bool = True, seed: int = SEED,
                          max_iter: int = 20, tol: float = 1e-4) -> Pipeline:
    return Pipeline(stages=[assembler(cols), scaler(with_mean), kmeans(k, seed, max_iter, tol)])


def fit_kmeans(features: DataFrame, k: int, with_mean: bool = True, seed: int = SEED,
               max_iter: int = 20, tol: float = 1e-4, cols: list[str] | None = None
               ) -> PipelineModel:
    """M4: assembler -> scaler -> K-Means, fitted on the frame as laid out."""
    cols = cols or feature_columns(features)
    if features.isEmpty():
        raise ValueError("no buyers to cluster: the feature table is empty")
    return segmentation_pipeline(cols, k, with_mean, seed, max_iter, tol).fit(features)


def centers_frame(model: PipelineModel | KMeansModel) -> DataFrame:
    """A fitted model's centers as ``(cluster, center)`` rows: k rows."""
    km = model.stages[-1] if isinstance(model, PipelineModel) else model
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(km.clusterCenters())]
    return SparkSession.getActiveSession().createDataFrame(rows, "cluster int, center array<double>")


def _as_array(c: str | Column, df: DataFrame | None = None) -> Column:
    if isinstance(c, str) and df is not None and not isinstance(
            df.schema[c].dataType, T.ArrayType):
        return vector_to_array(F.col(c))
    return F.col(c) if isinstance(c, str) else c


def _sq_dist(x: Column, c: Column) -> Column:
    """Squared Euclidean distance of two equal-length double arrays."""
    return F.aggregate(F.zip_with(x, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0),
                       lambda acc, v: acc + v)


def _dot(x: Column, c: Column) -> Column:
    return F.aggregate(F.zip_with(x, c, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)


def _folded(centers: DataFrame, fields: list[str]) -> DataFrame:
    """k rows -> one row holding them as an array sorted by cluster id (bounded by k).

    Used as a scalar subquery: computed once, its value inlined into the plan.
    """
    return centers.agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("_cs"))


def assign_clusters(df: DataFrame, centers: DataFrame, features_col: str = "scaledFeatures",
                    prediction_col: str = "prediction", distance_col: str | None = None
                    ) -> DataFrame:
    """M8: nearest center (squared Euclidean, first on ties) for every row.

    ``centers`` is ``(cluster int, center array<double>)`` with one row per
    cluster.  Works on batch and streaming frames.
    """
    x = _as_array(features_col, df)
    # The k centers as one value (a scalar subquery), bound to a column first:
    # subqueries may not sit inside the higher-order function itself.
    with_cs = df.withColumn("_cs", _folded(centers, ["cluster", "center"]).scalar())
    start = F.struct(F.lit(-1).alias("id"), F.lit(float("inf")).alias("d"))
    best = F.aggregate(
        F.col("_cs"), start,
        lambda acc, c: F.when(_sq_dist(x, c["center"]) < acc["d"],
                              F.struct(c["cluster"].alias("id"),
                                       _sq_dist(x, c["center"]).alias("d"))).otherwise(acc))
    out = with_cs.withColumn("_best", best).withColumn(prediction_col, F.col("_best.id"))
    if distance_col:
        out = out.withColumn(distance_col, F.col("_best.d"))
    return out.drop("_cs", "_best")


def silhouette(df: DataFrame, features_col: str = "scaledFeatures",
               prediction_col: str = "prediction") -> DataFrame:
    """M5: mean silhouette, squared Euclidean, as one row ``silhouette``.

    Closed form from per-cluster sums (count, vector sum, sum of squared norms),
    the same as Spark's ``ClusteringEvaluator``: O(n k d), one aggregate for the
    k-row cluster table and one for the mean.  A point alone in its cluster
    scores 0.
    """
    x = _as_array(features_col, df)
    pts = df.select(F.col(prediction_col).cast("int").alias("_p"), x.alias("_x"))
    pts = pts.withColumn("_nx", _dot(F.col("_x"), F.col("_x")))
    stats = pts.groupBy("_p").agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.sum("_nx").alias("psi"),
        Summarizer.sum(array_to_vector("_x")).alias("_y"))
    stats = stats.select(F.col("_p").alias("cluster"), "n", "psi",
                         vector_to_array("_y").alias("y"))
    # k rows as one value (a scalar subquery), bound to a column before the lambdas
    pts = pts.withColumn("_cs", _folded(stats, ["cluster", "n", "psi", "y"]).scalar())
    cs = F.col("_cs")

    def avg_dist(c: Column) -> Column:
        return F.col("_nx") + c["psi"] / c["n"] - 2 * _dot(F.col("_x"), c["y"]) / c["n"]

    own = F.filter(cs, lambda c: c["cluster"] == F.col("_p"))[0]
    others = F.transform(F.filter(cs, lambda c: c["cluster"] != F.col("_p")), avg_dist)
    scored = pts.select(
        own["n"].alias("_n"),
        (avg_dist(own) * own["n"] / (own["n"] - 1)).alias("_a"),
        F.array_min(others).alias("_b"))
    a, b = F.col("_a"), F.col("_b")
    s = (F.when(F.col("_n") <= 1, F.lit(0.0))
         .when(a < b, 1 - a / b).when(a > b, b / a - 1).otherwise(F.lit(0.0)))
    return scored.agg(F.avg(s).alias("silhouette"))


def silhouette_score(predictions: DataFrame, features_col: str = "scaledFeatures",
                     prediction_col: str = "prediction") -> float:
    """M5 with Spark ML's evaluator (a float; one distributed job)."""
    return ClusteringEvaluator(featuresCol=features_col, predictionCol=prediction_col,
                               metricName="silhouette",
                               distanceMeasure="squaredEuclidean").evaluate(predictions)


def wss(df: DataFrame, centers: DataFrame, features_col: str = "scaledFeatures") -> DataFrame:
    """M6: within-cluster sum of squared distances to the nearest given center (one row)."""
    return assign_clusters(df, centers, features_col, "_pred", "_d").agg(
        F.sum("_d").alias("wss"))


def k_search(features: DataFrame, k_values=range(2, 11), seed: int = SEED, max_iter: int = 20,
             tol: float = 1e-4, cols: list[str] | None = None, partitions: int | None = None,
             prepared: bool = False, parallelism: int = 4) -> DataFrame:
    """M7: silhouette and WSS for each k (no centering, as in the reference's search).

    The feature table is laid out once (``prepare``), assembled and
    scaled once and materialized; then every fit reads it.  Fits for different
    k are independent: up to ``parallelism`` run at once from driver threads
    (as Spark's own model selection does), each a distributed K-Means with its
    own jobs.  Every fit starts from the same rows in the same partitions;
    partial sums of several partitions are merged in the order in which tasks
    end, so both figures are given to ``PLACES`` places.
    """
    cols = cols or feature_columns(features)
    laid = features if prepared else prepare(features, partitions)
    scaled = materialize(scale(assemble(laid, cols), with_mean=False)
                         .select("user_id", "scaledFeatures"))

    def fit_one(k: int) -> tuple[int, float, float]:
        model = kmeans(k, seed, max_iter, tol).fit(scaled)
        score = silhouette_score(model.transform(scaled))
        return int(k), round(float(score), PLACES), round(float(model.summary.trainingCost), PLACES)

    ks = list(k_values)
    scaled = scaled.persist(StorageLevel.MEMORY_AND_DISK)  # else every fit caches a copy of its own
    try:
        if parallelism > 1 and len(ks) > 1:
            # keeps the job group, local properties and job tags of the calling thread
            task = inheritable_thread_target(features.sparkSession)(fit_one)
            with ThreadPoolExecutor(max_workers=min(parallelism, len(ks))) as pool:
                rows = list(pool.map(task, ks))
        else:
            rows = [fit_one(k) for k in ks]
    finally:
        scaled.unpersist()
    return features.sparkSession.createDataFrame(rows, "k int, silhouette double, wss double")


def best_k(search: DataFrame) -> DataFrame:
    """O2: the first k with the highest silhouette (one row)."""
    return search.orderBy(F.col("silhouette").desc(), F.col("k").asc()).limit(1)


def prediction_sample(predictions: DataFrame, n: int = 5,
                      features_col: str = "scaledFeatures") -> DataFrame:
    """O3: ``n`` rows of scaled vector and cluster, by user id."""
    return (predictions.select("user_id", _as_array(features_col, predictions).alias(features_col),
                               "prediction")
            .orderBy("user_id").limit(n))


def cluster_stats(predictions: DataFrame) -> DataFrame:
    """Per cluster mean and sample std of recency, frequency, monetary; users."""
    aggs = []
    for c in ("recency", "frequency", "monetary"):
        aggs += [F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std")]
    return predictions.groupBy("prediction").agg(*aggs, F.count("user_id").alias("users"))


def cluster_profiles(predictions: DataFrame) -> DataFrame:
    """Per cluster size, share ('%.1f%%'), means of recency, frequency, monetary, conversion."""
    per = predictions.groupBy("prediction").agg(
        F.count(F.lit(1)).alias("size"),
        F.avg("recency").alias("recency_mean"),
        F.avg("frequency").alias("frequency_mean"),
        F.avg("monetary").alias("monetary_mean"),
        F.avg("conversion_rate").alias("conversion_rate_mean"))
    total = per.agg(F.sum("size")).scalar()  # one value
    return per.select(
        F.col("prediction").alias("cluster"), "size",
        # Ties go to the even digit.
        F.format_string("%.1f%%", F.bround(F.col("size") / total * 100, 1)).alias("percentage"),
        "recency_mean", "frequency_mean", "monetary_mean", "conversion_rate_mean")


def cluster_sizes(predictions: DataFrame) -> DataFrame:
    """Rows per cluster (the bar chart's data)."""
    return predictions.groupBy("prediction").agg(F.count(F.lit(1)).alias("n_users"))


# Fixed values that must equal the reference's: segment naming rules, applied
# in this order to a cluster's mean recency, frequency, monetary and conversion.
DEFAULT_RULES = [
    ("Clients Premium", "recency_mean < 30 AND monetary_mean > 500"),
    ("Chasseurs de Promos", "frequency_mean > 10 AND monetary_mean < 200"),
    ("Clients Dormants", "recency_mean > 90"),
    ("Window Shoppers", "conversion_rate_mean < 0.1"),
]
FALLBACK_PREFIX = "Cluster Moyen "


def segment_name(rules=DEFAULT_RULES, key: Column | None = None) -> Column:
    """CASE chain over profile means; falls through to 'Cluster Moyen <key>'."""
    key = key if key is not None else F.concat(F.lit("Cluster "), F.col("cluster").cast("string"))
    expr = None
    for name, cond in rules:
        expr = (F.when(F.expr(cond), F.lit(name)) if expr is None
                else expr.when(F.expr(cond), F.lit(name)))
    fallback = F.concat(F.lit(FALLBACK_PREFIX), key)
    return expr.otherwise(fallback) if expr is not None else fallback


def name_segments(profiles: DataFrame, rules=DEFAULT_RULES) -> DataFrame:
    """M9: (cluster, segment_name) from cluster profiles."""
    return profiles.select("cluster", segment_name(rules).alias("segment_name"))


def rule_segment(rules=DEFAULT_RULES) -> Column:
    """Index of the first naming rule a single buyer satisfies (len(rules) if none).

    Applies the naming rules to a buyer's own values (recency, frequency,
    monetary, conversion_rate) instead of a cluster's means.
    """
    expr = None
    for i, (_, cond) in enumerate(rules):
        c = F.expr(cond.replace("_mean", ""))
        expr = F.when(c, F.lit(i)) if expr is None else expr.when(c, F.lit(i))
    return expr.otherwise(F.lit(len(rules))) if expr is not None else F.lit(0)


def rule_centers(scaled: DataFrame, features_col: str = "scaledFeatures",
                 rules=DEFAULT_RULES) -> DataFrame:
    """A frozen model's centers: mean scaled vector of the buyers of each naming rule.

    ``(cluster int, center array<double>)``, at most ``len(rules) + 1`` rows.
    Deterministic, so assignments to it can be checked against SQL.
    """
    x = _as_array(features_col, scaled)
    seeded = scaled.select(rule_segment(rules).alias("cluster"), array_to_vector(x).alias("_x"))
    return seeded.groupBy("cluster").agg(
        vector_to_array(Summarizer.mean(F.col("_x"))).alias("center"))
