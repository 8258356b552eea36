"""End-to-end jobs as functions of paths (E1-E3 of the survey; E4 is in streaming).

E1 ``clean_job``: discover the pending monthly inputs, clean them in one plan,
write one partitioned data set and a long-form quality report.  Row counts per
step come from ``Observation``s on the write, so the report costs one more
aggregate pass instead of dozens of count actions.

E2 ``segmentation`` / ``train_job``: features, k search, final fit, profiles,
names.  E3 ``score_job`` / ``start_score_stream``: a saved model applied to a
table of profiles, or to profile files as they arrive.
E4 ``log_metrics_job`` / ``start_log_streams``: session totals from the jobs'
log files, once over a folder or continuously as files arrive.
"""

from __future__ import annotations

import logging
import time

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickseg.operators import cleaning as CL
from clickseg.operators import clustering as CU
from clickseg.operators import features as FE
from clickseg.operators import quality as QU
from clickseg.operators import scoring as SC
from clickseg.operators import state as ST
from clickseg.schemas import CLICKS_RAW
from clickseg.session import released
from clickseg.sources import files as IO
from clickseg.sources import footers as FT
from clickseg.streaming import logs as LG

log = logging.getLogger(__name__)


def clean_job(spark: SparkSession, input_dir: str, output_dir: str, salt: str,
              report_dir: str | None = None, scope: str | None = "source_file",
              exact: bool = False, bad_files: str = "set_aside") -> dict[str, int]:
    """Clean every pending input file of ``input_dir`` into ``output_dir``.

    Inputs are Parquet files (one per month) or a partitioned data set; months
    recorded as done are skipped.  Every file's footer is compared with the
    declared schema before anything is read.  A month with a bad file is set aside:
    logged by name, listed in the ``file_verdicts`` report, not marked done, and
    the other months are written.  With ``bad_files="raise"`` it stops the job
    before any write.  Returns the row counts after each step.
    """
    if bad_files not in ("set_aside", "raise"):
        raise ValueError(f"bad_files is set_aside or raise, not {bad_files}")
    with released():
        return _clean(spark, input_dir, output_dir, salt, report_dir, scope, exact, bad_files)


def _clean(spark: SparkSession, input_dir: str, output_dir: str, salt: str, report_dir: str | None,
           scope: str | None, exact: bool, bad_files: str) -> dict[str, int]:
    inputs = IO.discover_inputs(spark, input_dir)
    todo = IO.pending_inputs(inputs, IO.done_partitions(spark, output_dir))
    files = todo.select("path", "source_file").collect()  # file names only
    if not files:
        return {}
    checked = FT.read_footers(spark, [(r.path, r.source_file) for r in files])
    rejected = {f.source_file for f in checked if f.problems}
    said = [f"{f.path}: {', '.join(f.problems)}" for f in checked if f.problems]
    if said and bad_files == "raise":
        raise ValueError("invalid input files: " + "; ".join(said))
    for line in said:
        log.error("set aside, not cleaned: %s", line)
    if report_dir:
        FT.verdicts(spark, checked).write.mode("overwrite").parquet(f"{report_dir}/file_verdicts")
    files = [r for r in files if r.source_file not in rejected]
    if not files:
        raise ValueError("no valid input file: " + "; ".join(said))
    schema = FT.union_schema([f for f in checked if f.source_file not in rejected])
    raw = IO.parquet_scan(spark, [r.path for r in files], base_path=input_dir, schema=schema)
    if "source_file" not in raw.columns:  # loose monthly files: the file name is the key
        raw = raw.withColumn("source_file", IO._file_stem())
    bounds = None if exact else stored_bounds(spark, raw, output_dir, scope, [r.source_file for r in files])
    cleaned, observations = QU.observed_clean_events(raw, salt, scope=scope, exact=exact, bounds=bounds)
    IO.write_clean(cleaned, output_dir)
    IO.mark_done(spark.createDataFrame([(r.source_file,) for r in files], "source_file string"), output_dir)
    counts = {name: int(o.get.get("rows", 0)) for name, o in observations.items()}
    if report_dir:
        written = IO.parquet_scan(spark, output_dir, validate=False, base_path=output_dir).filter(
            F.col("source_file").isin([r.source_file for r in files]))
        before = raw.select(*CLICKS_RAW.fieldNames())
        after = written.drop("source_file")
        reports = {"quality_comparison": QU.quality_comparison(before, after),
                   "row_counts": spark.createDataFrame(list(counts.items()), "step string, rows bigint")}
        for name, frame in (("before", before), ("after", after)):
            reports[f"describe_numeric_{name}"] = QU.describe_numeric(frame)
            reports[f"event_distribution_{name}"] = QU.event_distribution(frame)
        for name, frame in reports.items():
            frame.write.mode("overwrite").parquet(f"{report_dir}/{name}")
    return counts


def stored_bounds(spark: SparkSession, raw: DataFrame, output_dir: str, scope: str | None, months: list[str]) -> DataFrame:
    """Price bounds of the months from sketches that stay in ``<output_dir>/_sketches``, one per month.
    ``scope`` None merges all months stored so far, of earlier runs too, without reading their rows."""
    path = f"{output_dir.rstrip('/')}/_sketches"
    IO.write_partitioned(CL.price_sketches(CL.clean_before_outliers(raw)), path)
    stored = spark.read.schema("n_values long, sketch binary, source_file string").parquet(path)
    if scope:
        return CL.bounds_of_sketches(stored.filter(F.col("source_file").isin(months)), scope)
    return CL.bounds_of_sketches(stored, None, merge=True)


def segmentation(clean: DataFrame | None, max_k: int = 10, seed: int = CU.SEED,
                 partitions: int | None = None, features: DataFrame | None = None) -> dict:
    """Union -> features -> k search -> final fit -> assign -> profile -> name.

    The feature table is laid out (hash partitions by user, see ``clustering.prepare``)
    and materialized once; the k search and the final fit read it.  ``features`` takes
    the place of those of ``clean``.
    """
    feats = CU.prepare(FE.features(clean) if features is None else features, partitions)
    started = time.monotonic()
    search = CU.k_search(feats, range(2, max_k + 1), seed=seed, prepared=True)
    best = CU.best_k(search).first()  # one row
    k = int(best.k)
    model = CU.fit_kmeans(feats, k, with_mean=True, seed=seed)
    predictions = model.transform(feats)
    final_silhouette = CU.silhouette_score(predictions)
    seconds = time.monotonic() - started  # k search + final fit, as the reference times it
    profiles = CU.cluster_profiles(predictions)
    named = SC.named_segments(profiles)
    metrics = {"optimal_clusters": k, "silhouette_search": float(best.silhouette),
               "silhouette_final": float(final_silhouette), "training_seconds": seconds,
               "customers": int(feats.count()), "fit_partitions": feats.rdd.getNumPartitions()}
    return {"features": feats, "search": search, "k": k, "model": model,
            "predictions": predictions, "profiles": named, "metrics": metrics}


def train_job(spark: SparkSession, clean_dir: str, model_root: str, output_dir: str,
              max_k: int = 10, partitions: int | None = None, state_dir: str | None = None) -> str:
    """Read every cleaned file under ``clean_dir``, segment, save model and results.

    With ``state_dir`` only the months that the feature state there lacks are read; their
    counts are added to it and the features come from the state.
    """
    with released():
        return _train(spark, clean_dir, model_root, output_dir, max_k, partitions, state_dir)


def _train(spark: SparkSession, clean_dir: str, model_root: str, output_dir: str, max_k: int,
           partitions: int | None, state_dir: str | None) -> str:
    if state_dir:
        ST.update(spark, clean_dir, state_dir)
        result = segmentation(None, max_k, partitions=partitions, features=ST.features(spark, state_dir))
    else:
        result = segmentation(IO.prefix_scan(spark, clean_dir), max_k, partitions=partitions)
    path = IO.save_model(result["model"], model_root)
    result["search"].write.mode("overwrite").parquet(f"{output_dir}/k_search")
    result["profiles"].write.mode("overwrite").parquet(f"{output_dir}/profiles")
    m = dict(result["metrics"], model_path=path)
    (spark.createDataFrame([m]).write.mode("overwrite").parquet(f"{output_dir}/model_metrics"))
    (result["predictions"].select("user_id", "prediction")
       .write.mode("overwrite").parquet(f"{output_dir}/predictions"))
    return path


def score_job(spark: SparkSession, model_root: str, profiles: DataFrame,
              segments: DataFrame | None = None, model: PipelineModel | None = None) -> DataFrame:
    """Score feature rows with the latest saved model; attach segment texts."""
    model = model or IO.load_model(spark, model_root)
    scored = SC.score_profiles(model, profiles)
    cols = [c for c in ("user_id",) if c in scored.columns] + ["prediction"]
    out = scored.select(*cols)
    return SC.segment_recommendations(out, segments) if segments is not None else out


def log_metrics_job(spark: SparkSession, log_dir: str, out_dir: str) -> DataFrame:
    """E4 (batch): session totals of every log file under ``log_dir``, written by day."""
    with released():
        LG.daily_sink(out_dir)(LG.log_pipeline(LG.log_lines(spark, log_dir)), 0)
    return spark.read.parquet(out_dir)


def start_log_streams(spark: SparkSession, log_dir: str, out_dir: str, checkpoint_root: str,
                      records_dir: str | None = None, trigger: dict | None = None):
    """E4 (stream): newly arrived log files -> session totals -> daily folders.

    Optionally a second query writes the lines of full multi-line records into
    ``records_dir``.  Returns the running queries.  ``checkpoint_root`` must be
    on shared, reliable storage; ``trigger`` is passed to
    ``DataStreamWriter.trigger`` (default: every 30 seconds).
    """
    trigger = trigger or {"processingTime": "30 seconds"}
    sessions = (LG.stream_lines(spark, log_dir).writeStream
                .foreachBatch(LG.sessions_sink(out_dir))
                .option("checkpointLocation", f"{checkpoint_root}/sessions")
                .trigger(**trigger).start())
    queries = [sessions]
    if records_dir:
        queries.append(LG.stream_lines(spark, log_dir).writeStream
                       .foreachBatch(LG.records_sink(records_dir))
                       .option("checkpointLocation", f"{checkpoint_root}/records")
                       .trigger(**trigger).start())
    return queries


def start_tail_stream(spark: SparkSession, log_dir: str, out_dir: str, checkpoint: str,
                      trigger: dict | None = None, **options):
    """E4 (stream) on log files that still grow: appended lines -> sessions closed by a record or a
    timer -> commits that ``logs.read_daily`` reads, from any number of writers.

    ``options`` go to the source (``pattern``, ``splitBytes``, ``maxBytesPerFile``).  The session's
    timers need the RocksDB state store.  Returns the running query.
    """
    from clickseg.streaming import tail as TL

    return (TL.tail_sessions(TL.tail_lines(spark, log_dir, **options)).writeStream.outputMode("update")
            .foreachBatch(LG.commit_sink(out_dir)).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "10 seconds"})).start())


def start_score_stream(spark: SparkSession, model_root: str, profiles_dir: str, out_dir: str,
                       checkpoint: str, schema: str | None = None, trigger: dict | None = None,
                       model: PipelineModel | None = None):
    """E3 (stream): score feature rows as Parquet files arrive, with the latest saved model.

    ``schema`` defaults to the 8 feature columns as doubles plus ``user_id``;
    the Parquet sink with a checkpoint on shared storage gives exactly-once
    output.  Returns the running query.  :func:`start_refreshing_score_stream` follows
    models saved while it runs.
    """
    model = model or IO.load_model(spark, model_root)
    scored = SC.score_profiles(model, _profile_stream(spark, profiles_dir, schema)).select("user_id", "prediction")
    return (scored.writeStream.format("parquet").option("path", out_dir)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "30 seconds"})).start())


def _profile_stream(spark: SparkSession, profiles_dir: str, schema: str | None) -> DataFrame:
    from clickseg.schemas import FEATURE_COLUMNS

    schema = schema or "user_id string, " + ", ".join(f"{c} double" for c in FEATURE_COLUMNS)
    return spark.readStream.schema(schema).parquet(profiles_dir)


def start_refreshing_score_stream(spark: SparkSession, model_root: str, profiles_dir: str, out_dir: str,
                                  checkpoint: str, schema: str | None = None, trigger: dict | None = None):
    """E3 (stream) with model refresh: every micro-batch takes the newest model saved by then.

    Rows carry the ``model`` that scored them (its folder's name).  A batch is written to ``batch=<id>`` in one
    dynamic overwrite, so a retried batch replaces its own rows, whichever model scored
    them first; a model is loaded once, not per batch.  Returns the running query.
    """
    loaded: dict[str, PipelineModel] = {}

    def write(batch: DataFrame, batch_id: int) -> None:
        newest = IO.newest_model(spark, model_root, "saved")  # a model still being saved is not taken
        if newest not in loaded:
            loaded.clear()
            loaded[newest] = PipelineModel.load(newest)
        scored = SC.score_profiles(loaded[newest], batch).select("user_id", "prediction")
        name = newest.rstrip("/").rpartition("/")[2]
        (scored.withColumns({"model": F.lit(name), "batch": F.lit(batch_id)}).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out_dir))

    return (_profile_stream(spark, profiles_dir, schema).writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "30 seconds"})).start())
