"""Registered queries: one per operator of the survey's inventory.

Every query reads the driver tables of ``sf_dir`` (through the adapter) and runs
over all of their rows.  Timestamps are formatted as text in the outputs so
both engines of the check produce the same values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickseg.operators import cleaning as CL
from clickseg.operators import features as FE
from clickseg.operators import clustering as CU
from clickseg.operators import quality as QU
from clickseg.operators import quantiles as QT
from clickseg.operators import scoring as SC
from clickseg.operators import state as ST
from clickseg.plans.logqueries import log_queries
from clickseg.plans.params import CHECK_SALT, SEGMENTS, SOURCE_FILES
from clickseg.schemas import CLICKS_RAW, require_schema
from clickseg.session import broadcast_if_small, materialize, scratch_dir
from clickseg.sources.fixtures import clicks_from_tables

TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
ROW_COLUMNS = ["source_file", "event_id", "event_time", "event_type", "product_id", "category_id",
               "category_code", "brand", "price", "user_id", "user_session"]
LEVELS = ["category_level_1", "category_level_2", "category_level_3"]

Query = Callable[[SparkSession, str], DataFrame]


def texted(df: DataFrame) -> DataFrame:
    """Timestamps as text (microseconds), everything else unchanged."""
    return df.select(*[F.date_format(f.name, TS_FORMAT).alias(f.name)
                       if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
                       else F.col(f.name) for f in df.schema.fields])


def raw(spark: SparkSession, sf: str) -> DataFrame:
    """IO4 + IO5: the monthly clickstream rows, schema-checked."""
    return require_schema(clicks_from_tables(spark, sf))


def _p1(s, sf): return CL.drop_invalid_rows(raw(s, sf))
def _p2(s, sf): return CL.clean_event_types(_p1(s, sf))
def _p3(s, sf): return CL.clean_prices(_p2(s, sf))
def _p4(s, sf): return CL.clean_brands(_p3(s, sf))
def _p5(s, sf): return CL.split_categories(_p4(s, sf))
def _p6(s, sf): return CL.fill_unknown(_p5(s, sf))
def _p7(s, sf): return CL.remove_outliers(_p6(s, sf), exact=True)
def _d1(s, sf): return CL.drop_duplicates(_p7(s, sf), tie_breaker=["event_id"])
def _p8(s, sf): return CL.pseudonymize(_d1(s, sf), CHECK_SALT)


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    """P10 with the check settings: exact per-file quartiles, ``event_id`` as tie-breaker."""
    return CL.clean_events(raw(spark, sf), salt=CHECK_SALT, exact=True, tie_breaker=["event_id"])


def _rows(build: Query, levels: bool) -> Query:
    cols = ROW_COLUMNS + (LEVELS if levels else [])
    return lambda s, sf: texted(build(s, sf).select(*cols))


def _union_by_name(s: SparkSession, sf: str) -> DataFrame:
    """The cleaned data as three monthly frames; the last month lacks ``brand``."""
    c = cleaned(s, sf).select(*ROW_COLUMNS, *LEVELS)
    frames = [c.filter(F.col("source_file") == f) for f in SOURCE_FILES]
    frames[-1] = frames[-1].drop("brand")
    return texted(FE.union_by_name(frames).select(*ROW_COLUMNS, *LEVELS))


def _sketch_quartiles(s: SparkSession, sf: str) -> DataFrame:
    """A11, default mode: whether the quartiles of the stored sketches, per file and merged over all
    files (``all``), have true ranks within the sketches' error."""
    tidy = CL.priced(_p6(s, sf)).select("source_file", "price")
    stored = materialize(CL.price_sketches(tidy))
    bounds = CL.bounds_of_sketches(stored).select("source_file", "q1", "q3").unionByName(
        CL.bounds_of_sketches(stored, None, merge=True).select(F.lit("all").alias("source_file"), "q1", "q3"))
    rows = tidy.withColumn("source_file", F.explode(F.array("source_file", F.lit("all")))).join(
        broadcast_if_small(bounds), "source_file")
    n, p = F.count("*"), F.col("price")

    def within(q: str, rank: float):
        return (F.count_if(p < F.col(q)) <= (rank + QT.SKETCH_ERROR) * n) & (F.count_if(p <= F.col(q)) >= (rank - QT.SKETCH_ERROR) * n)

    return rows.groupBy("source_file").agg(n.alias("n_values"), within("q1", 0.25).alias("q1_within"),
                                           within("q3", 0.75).alias("q3_within"))


def cleaning_queries() -> dict[str, Query]:
    return {
        "parquet_scan": _rows(raw, False),
        "drop_invalid_rows": _rows(_p1, False),
        "clean_event_types": _rows(_p2, False),
        "clean_prices": _rows(_p3, False),
        "clean_brands": _rows(_p4, False),
        "split_categories": _rows(_p5, True),
        "fill_unknown": _rows(_p6, True),
        "remove_outliers": _rows(_p7, True),
        "drop_duplicates": _rows(_d1, True),
        "pseudonymize": _rows(_p8, True),
        "clean_events": _rows(cleaned, True),
        "purchase_filter": _rows(lambda s, sf: FE.purchase_filter(cleaned(s, sf)), True),
        "price_quartiles": lambda s, sf: CL.price_bounds(_p6(s, sf), exact=True),
        "price_quartile_sketches": _sketch_quartiles,
        "distinct_users": lambda s, sf: FE.distinct_users(cleaned(s, sf)),
        "union_by_name": _union_by_name,
    }


def feature_queries() -> dict[str, Query]:
    return {
        "features": lambda s, sf: FE.features(cleaned(s, sf)),
        "features_from_state": features_from_state,
        "rfm": lambda s, sf: FE.rfm(cleaned(s, sf)),
        "reference_date": lambda s, sf: texted(FE.reference_date(cleaned(s, sf))),
        "rfm_no_purchases": lambda s, sf: FE.rfm(
            cleaned(s, sf).filter(F.col("event_type") != "purchase")),
        "behavior": lambda s, sf: FE.behavior(cleaned(s, sf)),
    }


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Floating columns rounded (sums and moments depend on row order in the last bits)."""
    return df.select(*[F.round(f.name, places).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def file_frame(s: SparkSession, sf: str) -> DataFrame:
    """The 9 declared columns, as one monthly input file holds them."""
    return raw(s, sf).select(*CLICKS_RAW.fieldNames())


def clean_frame(s: SparkSession, sf: str) -> DataFrame:
    """The cleaned rows as written per file: 9 columns plus the 3 category levels."""
    return cleaned(s, sf).select(*CLICKS_RAW.fieldNames(), *LEVELS)


def quality_queries() -> dict[str, Query]:
    return {
        "row_counts": lambda s, sf: QU.row_counts(raw(s, sf), exact=True),
        "completeness": lambda s, sf: QU.completeness(file_frame(s, sf)),
        "event_distribution": lambda s, sf: QU.event_distribution(file_frame(s, sf)),
        "event_type_ranking": lambda s, sf: QU.event_type_ranking(file_frame(s, sf), 20),
        "describe_numeric": lambda s, sf: rounded(QU.describe_numeric(file_frame(s, sf))),
        "quality_metrics": lambda s, sf: QU.quality_metrics(file_frame(s, sf)),
        "metric_compare": lambda s, sf: QU.metric_compare(
            QU.quality_metrics(clean_frame(s, sf)), QU.quality_metrics(file_frame(s, sf))),
        "quality_comparison": lambda s, sf: rounded(QU.quality_comparison(
            file_frame(s, sf), clean_frame(s, sf))),
    }


def features_from_state(s: SparkSession, sf: str) -> DataFrame:
    """J1 from the feature state: the cleaned months are added one by one to a new state."""
    clean = materialize(cleaned(s, sf).select("source_file", "user_id", "product_id", "event_type",
                                              "event_time", "price"))
    state = scratch_dir(s, "feature_state")
    ST.add_months(clean, state, buckets=8)
    return ST.features(s, state)


def buyer_features(s: SparkSession, sf: str) -> DataFrame:
    return FE.features(cleaned(s, sf))


def _scaled_columns(with_mean: bool) -> Query:
    """M2/M3: the scaled vector spread back into the 8 named columns."""
    def build(s: SparkSession, sf: str) -> DataFrame:
        scaled = CU.scale(CU.assemble(buyer_features(s, sf)), with_mean=with_mean)
        arr = CU.vector_to_array(F.col("scaledFeatures"))
        return rounded(scaled.select("user_id", *[arr[i].alias(c)
                                                  for i, c in enumerate(FE.FEATURE_COLUMNS)]))
    return build


def frozen_predictions(s: SparkSession, sf: str) -> DataFrame:
    """Buyers assigned to a frozen model: centers are the rule-group means of the
    scaled (uncentered) features; assignment is nearest center.  The scaled
    table feeds both the centers and the assignment, so it is materialized."""
    scaled = materialize(CU.scale(CU.assemble(buyer_features(s, sf)), with_mean=False))
    return CU.assign_clusters(scaled, CU.rule_centers(scaled), "scaledFeatures")


def _frozen_wss(s: SparkSession, sf: str) -> DataFrame:
    """M6 on the frozen model: squared distances of the buyers to their nearest center."""
    scaled = materialize(CU.scale(CU.assemble(buyer_features(s, sf)), with_mean=False))
    return rounded(CU.wss(scaled, CU.rule_centers(scaled)))


def frozen_profiles(s: SparkSession, sf: str) -> DataFrame:
    return CU.cluster_profiles(frozen_predictions(s, sf))


def fitted(s: SparkSession, sf: str, k: int = 2):
    """Buyer features laid out for a repeatable fit, and a k-cluster model."""
    feats = CU.prepare(buyer_features(s, sf))
    return feats, CU.fit_kmeans(feats, k)


def _kmeans_fit(s: SparkSession, sf: str) -> DataFrame:
    _, model = fitted(s, sf)
    return CU.centers_frame(model)


def _score_profiles(s: SparkSession, sf: str) -> DataFrame:
    feats, model = fitted(s, sf)
    return SC.score_profiles(model, feats).select("user_id", "prediction")


def _prediction_sample(s: SparkSession, sf: str) -> DataFrame:
    feats, model = fitted(s, sf)
    return CU.prediction_sample(model.transform(feats))


# The fits below depend on the layout of the rows; what does not is checked against SQL.

def _assembled_columns(s: SparkSession, sf: str) -> DataFrame:
    """M1: the assembled vector spread back into the 8 named columns."""
    arr = CU.vector_to_array(F.col("features"))
    return CU.assemble(buyer_features(s, sf)).select(
        "user_id", *[arr[i].alias(c) for i, c in enumerate(FE.FEATURE_COLUMNS)])


def _k_search_facts(s: SparkSession, sf: str) -> DataFrame:
    """M7: the k tried, and whether their figures are possible ones."""
    return CU.k_search(buyer_features(s, sf)).select(
        "k", F.col("silhouette").between(-1, 1).alias("silhouette_possible"), (F.col("wss") >= 0).alias("wss_possible"))


def _best_k_of_table(s: SparkSession, sf: str) -> DataFrame:
    """O2 on a search table made of the cleaned rows: per remainder of the product its share of views,
    in tenths so that ties occur."""
    search = cleaned(s, sf).groupBy((F.col("product_id") % 9 + 2).cast("int").alias("k")).agg(
        (F.floor(F.avg(F.when(F.col("event_type") == "view", 1.0).otherwise(0.0)) * 10) / 10).alias("silhouette"),
        F.count("*").cast("double").alias("wss"))
    return CU.best_k(search)


def _kmeans_facts(s: SparkSession, sf: str) -> DataFrame:
    """M4: numbers of centers, of buyers in clusters, and of coordinates of a center."""
    feats, model = fitted(s, sf)
    centers = CU.centers_frame(model).agg(F.count("*").alias("n_centers"), F.max(F.size("center")).alias("n_features"))
    sizes = CU.cluster_sizes(model.transform(feats)).agg(F.sum("n_users").alias("n_users"))
    c = centers.select(F.struct("n_centers", "n_features")).scalar()
    return sizes.select(c["n_centers"].alias("n_centers"), c["n_features"].alias("n_features"), "n_users")


def _segmentation_facts(s: SparkSession, sf: str) -> DataFrame:
    """Buyers and their means, put together again from the profiles of whatever clusters."""
    from clickseg.plans import jobs
    profiles = jobs.segmentation(cleaned(s, sf))["profiles"]
    means = ["recency_mean", "frequency_mean", "monetary_mean", "conversion_rate_mean"]
    return rounded(profiles.agg(F.sum("size").alias("n_users"), *[
        (F.sum(F.col(m) * F.col("size")) / F.sum("size")).alias(m) for m in means], F.bool_and(
            F.col("segment_name").isNotNull()).alias("all_named")))


def _sample_facts(s: SparkSession, sf: str) -> DataFrame:
    """O3: the sampled buyers with their scaled vectors, and whether each has a cluster of the model."""
    arr = F.col("scaledFeatures")
    return rounded(_prediction_sample(s, sf).select(
        "user_id", *[arr[i].alias(c) for i, c in enumerate(FE.FEATURE_COLUMNS)], F.col("prediction").between(0, 1).alias("in_model")))


def _score_known_model(s: SparkSession, sf: str) -> DataFrame:
    """M10 with a real model of known centers: fitted on the mean buyer of each naming rule (one row per
    rule, each its own center), it scores all buyers; clusters are told by the rule of their center."""
    feats = materialize(buyer_features(s, sf))
    rules = materialize(feats.groupBy(CU.rule_segment().alias("rule")).agg(
        *[F.avg(c).alias(c) for c in FE.FEATURE_COLUMNS]).coalesce(1).sortWithinPartitions("rule"))
    model = CU.fit_kmeans(rules, rules.count(), cols=FE.FEATURE_COLUMNS)
    known = SC.score_profiles(model, rules).groupBy("prediction").agg(F.min("rule").alias("rule"))
    return SC.score_profiles(model, feats).select("user_id", "prediction").join(
        broadcast_if_small(known), "prediction", "left").select("user_id", "rule")


def clustering_queries() -> dict[str, Query]:
    from clickseg.plans import jobs
    return {
        "assemble": lambda s, sf: CU.assemble(buyer_features(s, sf)).select(
            "user_id", CU.vector_to_array("features").alias("features")),
        "scale_nocenter": _scaled_columns(False),
        "scale_center": _scaled_columns(True),
        "kmeans_fit": _kmeans_fit,
        "k_search": lambda s, sf: CU.k_search(buyer_features(s, sf)),
        "best_k": lambda s, sf: CU.best_k(CU.k_search(buyer_features(s, sf))),
        "assign_clusters": lambda s, sf: frozen_predictions(s, sf).select("user_id", "prediction"),
        "silhouette": lambda s, sf: rounded(CU.silhouette(frozen_predictions(s, sf))),
        "wss": _frozen_wss,
        "cluster_stats": lambda s, sf: rounded(CU.cluster_stats(frozen_predictions(s, sf))),
        "cluster_profiles": lambda s, sf: rounded(frozen_profiles(s, sf)),
        "cluster_sizes": lambda s, sf: CU.cluster_sizes(frozen_predictions(s, sf)),
        "name_segments": lambda s, sf: CU.name_segments(frozen_profiles(s, sf)),
        "named_segments": lambda s, sf: rounded(SC.named_segments(frozen_profiles(s, sf))),
        "radar_profile": lambda s, sf: rounded(SC.radar_profile(frozen_profiles(s, sf))),
        "cluster_comparison": lambda s, sf: rounded(SC.cluster_comparison(SC.named_segments(frozen_profiles(s, sf)))),
        "segment_recommendations": lambda s, sf: SC.segment_recommendations(
            frozen_predictions(s, sf).select("user_id", "prediction"),
            SC.segment_table(s, SEGMENTS)),
        "score_profiles": _score_profiles,
        "prediction_sample": _prediction_sample,
        "segmentation": lambda s, sf: jobs.segmentation(cleaned(s, sf))["profiles"],
        "assembled_columns": _assembled_columns,
        "k_search_facts": _k_search_facts,
        "best_k_of_table": _best_k_of_table,
        "kmeans_facts": _kmeans_facts,
        "segmentation_facts": _segmentation_facts,
        "prediction_sample_facts": _sample_facts,
        "score_known_model": _score_known_model,
    }


def all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    out.update(cleaning_queries())
    out.update(feature_queries())
    out.update(quality_queries())
    out.update(clustering_queries())
    out.update(log_queries())
    return out
