"""Feature state: the (user, product) counts of J1 and A1, kept by month, a new month added alone.

Level 1 of the feature aggregate can be added up, so it is stored: one row per month, user
and product, in a Parquet table partitioned by month and bucketed by (user, product).
``add_months`` writes the months it is given and touches no other; features read the
stored rows.  The buckets hold a pair's rows of all months, so merging the months needs no
exchange, and a user with a third of all rows is spread over the buckets of the products.
Only level 2 shuffles, after a partial aggregate.

A month given again replaces its own rows.  Months count from when their write has
ended (``_done``).  Defined results: a null user or product is a value of its own, as in
the aggregate over the events; a month without rows is recorded and adds nothing; months
without any row give no features; a row without a month is an error; further columns are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickseg.operators import features as FE
from clickseg.session import delete_paths
from clickseg.sources import files as IO

PAIR = ["user_id", "product_id"]
MONTH = "source_file"
#: Bytes of the first months' files per bucket.  The count is fixed when the state is created.
BUCKET_BYTES = 64 * 1024 ** 2


def table_name(state_dir: str) -> str:
    """The catalog name under which a state folder is read."""
    return f"clickseg_state_{hashlib.md5(state_dir.rstrip('/').encode()).hexdigest()}"


def finished_months(spark: SparkSession, state_dir: str) -> list[str]:
    """The months whose rows are in the state."""
    return sorted(r[0] for r in IO.done_partitions(spark, state_dir, MONTH).collect())  # month names only


def _layout(spark: SparkSession, state_dir: str) -> tuple[str, int] | None:
    """Columns and bucket count of a state, as written when it was created."""
    try:
        row = spark.read.schema("columns string, buckets int").parquet(f"{state_dir.rstrip('/')}/_layout").first()
        return (row.columns, row.buckets) if row else None
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _table(spark: SparkSession, state_dir: str, columns: str, buckets: int) -> str:
    name = table_name(state_dir)
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} ({columns}, {MONTH} STRING) USING parquet PARTITIONED BY ({MONTH}) "
                  f"CLUSTERED BY ({', '.join(PAIR)}) INTO {buckets} BUCKETS LOCATION '{state_dir.rstrip('/')}'")
        spark.catalog.recoverPartitions(name)
    return name


def add_months(events: DataFrame, state_dir: str, buckets: int, months: list[str] | None = None) -> None:
    """Write the state rows of the months that ``events`` holds; other months stay as they are.

    ``months`` names them; one named again without rows loses its old ones.  Each month is
    a write of its own, recorded when it has ended, so a job that stopped goes on with the
    next month.  ``buckets`` counts when the state is created; later calls take the
    stored number.
    """
    spark = events.sparkSession
    if months is None:
        months = [r[0] for r in events.select(MONTH).distinct().collect()]  # month names only
    if None in months:
        raise ValueError(f"rows without a {MONTH}")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in FE.pair_counts(events).schema)
    layout = _layout(spark, state_dir)
    if layout is None:
        layout = (columns, buckets)
        spark.createDataFrame([layout], "columns string, buckets int").coalesce(1).write.parquet(
            f"{state_dir.rstrip('/')}/_layout")
    if layout[0] != columns:
        raise ValueError(f"the state in {state_dir} holds {layout[0]}, not {columns}")
    name = _table(spark, state_dir, *layout)
    for month in sorted(months):
        # One file per bucket: tasks are dealt like the buckets.
        rows = FE.pair_counts(events.filter(F.col(MONTH) == month)).repartition(layout[1], *PAIR)
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({MONTH} = {_quoted(month)}) SELECT * FROM {{rows}}", rows=rows)
        IO.mark_done(spark.createDataFrame([(month,)], f"{MONTH} string"), state_dir, MONTH)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'").replace("{", "{{").replace("}", "}}") + "'"


def pairs(spark: SparkSession, state_dir: str) -> DataFrame:
    """One row per user and product over all finished months, merged inside the buckets."""
    layout = _layout(spark, state_dir)
    if layout is None:
        raise FileNotFoundError(f"no feature state in {state_dir}")
    stored = spark.table(_table(spark, state_dir, *layout))
    return FE.merge_pairs(stored.filter(F.col(MONTH).isin(finished_months(spark, state_dir))))


def features(spark: SparkSession, state_dir: str, reference_date=None) -> DataFrame:
    """J1 from the state: the rows of ``features.features`` over the events of all its months."""
    return FE.features_of_pairs(pairs(spark, state_dir), reference_date)


def rfm(spark: SparkSession, state_dir: str, reference_date=None) -> DataFrame:
    """A1 and A3 from the state."""
    return FE.rfm_of_pairs(pairs(spark, state_dir), reference_date)


def update(spark: SparkSession, clean_dir: str, state_dir: str, months: list[str] | None = None,
           buckets: int | None = None) -> list[str]:
    """Add the months of a cleaned data set that the state lacks; returns them.

    Only their folders are read.  ``months`` names months to add again after they
    were cleaned anew.
    """
    listed = IO.discover_inputs(spark, clean_dir).groupBy(MONTH).agg(F.sum("length").alias("bytes"))
    sizes = {r[MONTH]: r.bytes for r in listed.collect()}  # one row per month
    if months is None:
        done = set(finished_months(spark, state_dir))
        months = sorted(m for m in sizes if m not in done)
    elif unknown := sorted(set(months) - set(sizes)):
        raise ValueError(f"no files of {unknown} under {clean_dir}")
    if months:
        buckets = buckets or max(1, -(-sum(sizes[m] for m in months) // BUCKET_BYTES))
        add_months(IO.prefix_scan(spark, clean_dir, months=months), state_dir, buckets, months)
    return months


def drop(spark: SparkSession, state_dir: str) -> None:
    """Remove a state: its catalog entry and its folder."""
    spark.sql(f"DROP TABLE IF EXISTS {table_name(state_dir)}")
    delete_paths(spark, [state_dir])
