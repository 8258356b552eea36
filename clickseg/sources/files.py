"""File sources and sinks (IO1-IO9, IO11, IO12).

Paths may be local, ``hdfs://`` or ``s3a://`` (see ``clickseg.sources.s3a``).
Monthly inputs become one data set partitioned by ``source_file``; nothing is
written through a single task (no ``coalesce(1)``) and a partial write is never
taken for a finished one.
"""

from __future__ import annotations

import datetime as _dt
import logging

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickseg.schemas import CLICKS_RAW, require_schema
from clickseg.sources import footers as FT

log = logging.getLogger(__name__)

# Fixed value that must equal the reference's: the CSV timestamp pattern
# (the zone is a quoted literal, so times are read in the session time zone).
CSV_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss 'UTC'"


def _file_stem() -> F.Column:
    """Input file name without directory and without .csv / .csv.gz / .parquet."""
    name = F.col("_metadata.file_name")
    return F.regexp_replace(name, r"(\.csv(\.gz)?|\.parquet)$", "")


def csv_scan(spark: SparkSession, path: str | list[str], schema=CLICKS_RAW,
             timestamp_format: str = CSV_TIMESTAMP_FORMAT, with_source: bool = True) -> DataFrame:
    """IO1: typed CSV read with header and declared schema; a bad field becomes NULL.

    ``source_file`` (the file name) is added from the file metadata.
    """
    df = (spark.read.schema(schema)
          .option("header", True)
          .option("mode", "PERMISSIVE")
          .option("timestampFormat", timestamp_format)
          .csv(path))
    return df.withColumn("source_file", _file_stem()) if with_source else df


def csv_gz_scan(spark: SparkSession, path: str | list[str], partitions: int | None = None,
                **kwargs) -> DataFrame:
    """IO2: the same reader on ``.csv.gz`` files (decompressed by Spark, no unpacking).

    Gzip is not splittable (one task per file), so the rows can be spread over
    ``partitions`` tasks for the steps that follow.
    """
    df = csv_scan(spark, path, **kwargs)
    return df.repartition(partitions) if partitions else df


def list_files(spark: SparkSession, directory: str, glob: str) -> DataFrame:
    """(path, length, source_file) of the files under ``directory`` matching ``glob``.

    A ``binaryFile`` listing with only path and length selected: file contents
    are not read.  ``source_file`` is the ``source_file=`` folder of a
    partitioned data set, else the file name without its extension.
    """
    stem = F.regexp_replace(F.regexp_extract("path", r"([^/]+)$", 1),
                            r"(\.csv(\.gz)?|\.parquet)$", "")
    part = F.regexp_extract("path", r"/source_file=([^/]+)/", 1)
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", True).load(directory)
            .select("path", "length",
                    F.when(part != "", part).otherwise(stem).alias("source_file")))


def discover_inputs(spark: SparkSession, directory: str, glob: str = "*.parquet") -> DataFrame:
    """IO6: non-empty matching files of a directory; an error if there is none."""
    files = list_files(spark, directory, glob).filter(F.col("length") > 0)
    if files.isEmpty():
        raise ValueError(f"no non-empty {glob} file in {directory}")
    return files


def pending_inputs(inputs: DataFrame, done: DataFrame, key: str = "source_file") -> DataFrame:
    """IO7: inputs not yet in the output store (anti join on the file key)."""
    return inputs.join(done.select(key).distinct(), on=key, how="left_anti")


def done_partitions(spark: SparkSession, output_dir: str, key: str = "source_file") -> DataFrame:
    """Inputs that :func:`mark_done` recorded for a data set (``key`` values).

    Files in a partition prove nothing: a write may have stopped half way, and
    a month may have lost all of its rows.
    """
    try:
        return spark.read.schema(f"{key} string").parquet(f"{output_dir.rstrip('/')}/_done").distinct()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # only a missing output folder means that nothing is done
            raise
        return spark.createDataFrame([], f"{key} string")


def mark_done(done: DataFrame, output_dir: str, key: str = "source_file") -> None:
    """Record inputs as finished, after their write has been committed."""
    done.select(F.col(key).cast("string")).distinct().coalesce(1).write.mode("append").parquet(
        f"{output_dir.rstrip('/')}/_done")


def csv_to_parquet(spark: SparkSession, csv_dir: str, out_dir: str, glob: str = "*.csv*",
                   max_records_per_file: int = 5_000_000) -> list[str]:
    """IO3: convert every pending CSV file of a directory in one job.

    One read of all pending files, one write partitioned by ``source_file``
    (dynamic overwrite: a rerun replaces only the files it converts).  Files
    that are recorded as done are skipped.  Returns the converted paths.
    """
    inputs = list_files(spark, csv_dir, glob).filter(F.col("length") > 0)
    todo = pending_inputs(inputs, done_partitions(spark, out_dir))
    # File names only (metadata, one row per input file), to hand to the reader.
    files = todo.select("path", "source_file").collect()
    paths = [r.path for r in files]
    if not paths:
        return []
    df = csv_scan(spark, paths)
    write_partitioned(df, out_dir, max_records_per_file=max_records_per_file)
    mark_done(spark.createDataFrame([(r.source_file,) for r in files], "source_file string"), out_dir)
    return paths


def write_partitioned(df: DataFrame, out_dir: str, key: str = "source_file",
                      max_records_per_file: int = 5_000_000) -> None:
    """Write Parquet partitioned by ``key``, replacing only the partitions written."""
    # Rebalance: large months are split and small ones merged, so files follow the data's
    # size and not the number of shuffle partitions before.
    (df.hint("rebalance", F.col(key)).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .option("maxRecordsPerFile", max_records_per_file)
       .partitionBy(key).parquet(out_dir))


def parquet_scan(spark: SparkSession, path: str | list[str], validate: bool = True,
                 base_path: str | None = None, schema=None) -> DataFrame:
    """IO4: read Parquet (a file, a folder or a partitioned data set), then IO5.

    With ``base_path``, files listed inside a partitioned data set keep their
    partition columns.  Without ``schema`` one file's footer stands for all;
    ``footers.union_schema`` gives the schema of files that were checked one by one.
    """
    reader = spark.read.option("basePath", base_path) if base_path else spark.read
    reader = reader.schema(schema) if schema else reader
    df = reader.parquet(*([path] if isinstance(path, str) else path))
    if base_path and "source_file" in df.columns:  # the folder's name as it is: 01 is not 1
        df = df.withColumn("source_file", F.regexp_extract(F.col("_metadata.file_path"), r"/source_file=([^/]+)/", 1))
    return require_schema(df) if validate else df


def write_clean(df: DataFrame, out_dir: str, key: str | None = "source_file",
                max_records_per_file: int = 5_000_000) -> None:
    """IO8: save cleaned rows; never through one task.

    Partitioned by ``key``: existing partitions other than those written are
    kept.  Without a key: ``ignore`` mode, a no-op if the target exists.
    """
    if key and key in df.columns:
        write_partitioned(df, out_dir, key, max_records_per_file)
    else:
        df.write.mode("ignore").option("maxRecordsPerFile", max_records_per_file).parquet(out_dir)


def prefix_scan(spark: SparkSession, prefix: str, partitioned: bool = True,
                months: list[str] | None = None) -> DataFrame:
    """IO9: every Parquet file under a prefix; an error if there is none.

    A partitioned data set keeps its partition column; loose files anywhere
    under the prefix are read with recursive lookup.  Files may differ in their
    columns: schemas are merged by name, a column that a file lacks is NULL
    there, and the difference is logged, whatever the order of the files.  A
    column that has different types is an error that names files.  ``months`` reads
    only the files of these ``source_file`` values.
    """
    listed = discover_inputs(spark, prefix, "*.parquet").select("path", "source_file")
    if months is not None:
        listed = listed.filter(F.col("source_file").isin(months))
    listed = listed.collect()  # file names only
    found = FT.read_footers(spark, [tuple(r) for r in listed], expected=None)
    if bad := [f"{f.path}: {p}" for f in found for p in f.problems]:
        raise ValueError("invalid input: " + "; ".join(bad))
    differing = FT.drift(found)
    for name, what, files, examples in differing:
        log.warning("schema drift under %s: column %s %s in %d of %d files, as in %s", prefix, name,
                    what, files, len(found), examples)
    if mixed := sorted({name for name, what, *_ in differing if what != "missing"}):
        raise ValueError(f"columns with different types under {prefix}: " + "; ".join(
            f"{name} {what} in {examples}" for name, what, _, examples in differing if name in mixed))
    how = {"basePath": prefix} if partitioned else {"recursiveFileLookup": True}
    if months is None:
        return spark.read.options(**how, mergeSchema=True).parquet(prefix)
    read = spark.read.options(basePath=prefix, mergeSchema=True).parquet(*[r.path for r in listed])
    in_folder = "source_file" in read.columns  # the name as listed: 01 is not 1
    name = F.regexp_extract(F.col("_metadata.file_path"), r"/source_file=([^/]+)/", 1) if in_folder else _file_stem()
    return read.withColumn("source_file", name)


def save_model(model: PipelineModel, root: str, now: _dt.datetime | None = None) -> str:
    """IO11: save under ``<root>/model_<yyyymmdd_HHMMSS>``; returns the path."""
    stamp = (now or _dt.datetime.now()).strftime("%Y%m%d_%H%M%S")
    path = f"{root.rstrip('/')}/model_{stamp}"
    model.write().save(path)
    # Written last: whoever finds it finds the whole model.
    SparkSession.active().range(1).coalesce(1).write.parquet(f"{path}/saved")
    return path


def list_models(spark: SparkSession, root: str, folder: str = "metadata") -> DataFrame:
    """Saved model folders under ``root`` (one row each, by name); with ``folder="saved"`` only
    those whose saving has ended."""
    meta = list_files(spark, root, "part-*").select(
        F.regexp_extract("path", rf"^(.*/model_[^/]+)/{folder}/", 1).alias("model_path"))
    return meta.filter(F.col("model_path") != "").distinct()


def newest_model(spark: SparkSession, root: str, folder: str = "metadata") -> str:
    """Path of the model saved last (names carry the save time)."""
    latest = list_models(spark, root, folder).agg(F.max("model_path").alias("p")).first()
    if latest is None or latest.p is None:
        raise FileNotFoundError(f"no saved model under {root}")
    return latest.p


def load_model(spark: SparkSession, root: str, name: str | None = None) -> PipelineModel:
    """IO12: load a named model, or the latest (names carry the save time)."""
    if name:
        return PipelineModel.load(f"{root.rstrip('/')}/{name}")
    return PipelineModel.load(newest_model(spark, root))


__all__ = ["CSV_TIMESTAMP_FORMAT", "CLICKS_RAW", "csv_scan", "csv_gz_scan", "list_files",
           "discover_inputs", "pending_inputs", "done_partitions", "mark_done", "csv_to_parquet",
           "write_partitioned", "parquet_scan", "write_clean", "prefix_scan", "save_model",
           "list_models", "newest_model", "load_model"]
