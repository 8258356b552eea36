"""Scoring and segment presentation data.

The reference's dashboard scores one customer at a time and shows fixed
charts; here the same work is a DataFrame operation over any number of
profiles, batch or stream.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickseg.operators.clustering import segment_name
from clickseg.schemas import FEATURE_COLUMNS
from clickseg.session import broadcast_if_small

# Fixed values that must equal the reference's: the radar chart's axis scales,
# as (axis, profile mean, operator, constant).
RADAR_AXES = [
    ("recency", "recency_mean", "/", 150.0),
    ("frequency", "frequency_mean", "/", 5.0),
    ("monetary", "monetary_mean", "/", 800.0),
    ("conversion_rate", "conversion_rate_mean", "*", 10.0),
]
UNKNOWN_SEGMENT = "Cluster non reconnu"


def score_profiles(model: PipelineModel, profiles: DataFrame,
                   cols: list[str] = FEATURE_COLUMNS) -> DataFrame:
    """Apply a fitted segmentation model to feature rows (batch or streaming).

    ``user_id`` is optional and passed through; the feature columns are cast to
    double so hand-entered integers score like computed features.
    """
    keep = [c for c in profiles.columns if c not in cols]
    typed = profiles.select(*keep, *[F.col(c).cast("double").alias(c) for c in cols])
    return model.transform(typed)


def profile_frame(spark: SparkSession, profiles: list[dict]) -> DataFrame:
    """Feature rows given by hand (one customer typed into a form, or a few) as a frame.

    Each dict holds the 8 feature columns and optionally ``user_id``; values
    are typed as doubles like the computed features.
    """
    schema = "user_id string, " + ", ".join(f"{c} double" for c in FEATURE_COLUMNS)
    rows = [(None if p.get("user_id") is None else str(p["user_id"]),
             *[float(p[c]) for c in FEATURE_COLUMNS]) for p in profiles]
    return spark.createDataFrame(rows, schema)


def radar_profile(profiles: DataFrame) -> DataFrame:
    """Per cluster, the four normalized axis values in long form."""
    entries = [F.struct(F.lit(axis).alias("axis"),
                        (F.col(measure) / F.lit(k) if op == "/" else F.col(measure) * F.lit(k))
                        .alias("r"))
               for axis, measure, op, k in RADAR_AXES]
    return profiles.select("cluster", F.explode(F.array(*entries)).alias("_e")).select(
        "cluster", "_e.axis", "_e.r")


def cluster_comparison(profiles: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Cluster means side by side in long form (cluster, label, measure, value).

    The label is the cluster with its name: the profile's ``segment_name`` (see
    :func:`named_segments`), or that of a table of names.
    """
    base = profiles.join(names, "cluster") if names is not None else profiles
    label = F.concat(F.col("cluster").cast("string"), F.lit(" - "), F.col("segment_name")) \
        if "segment_name" in base.columns else F.col("cluster").cast("string")
    measures = ["recency_mean", "frequency_mean", "monetary_mean", "conversion_rate_mean"]
    return base.select("cluster", label.alias("label"), *measures).unpivot(
        ["cluster", "label"], measures, "measure", "value")


def named_segments(profiles: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Profiles with their segment name, by the naming rules on the profile itself (no join),
    or from a table of names of one's own (equi-join on cluster; both are k rows)."""
    if names is None:
        return profiles.withColumn("segment_name", segment_name())
    return profiles.join(names, on="cluster", how="left")


def segment_table(spark: SparkSession, segments: list[dict]) -> DataFrame:
    """The caller's segment table: cluster -> name, description, strategy."""
    rows = [(int(s["cluster"]), s["name"], s["description"], s["strategy"]) for s in segments]
    return spark.createDataFrame(rows, "cluster int, name string, description string, strategy string")


def segment_recommendations(predictions: DataFrame, segments: DataFrame,
                            prediction_col: str = "prediction") -> DataFrame:
    """Predicted cluster -> name, description, strategy; unknown clusters get a warning.

    The segment table is small (one row per cluster); it is broadcast after
    its size is checked.
    """
    seg = broadcast_if_small(segments.withColumnRenamed("cluster", "_cluster"), 10_000)
    out = predictions.join(seg, F.col(prediction_col) == F.col("_cluster"), "left")
    return out.withColumn(
        "warning", F.when(F.col("_cluster").isNull(), F.lit(UNKNOWN_SEGMENT))).drop("_cluster")
