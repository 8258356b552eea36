"""IO5 per file: the schema of every Parquet file, from its footer, and a verdict on it.

Each file's footer is read by a Spark task of its own small job (Spark's schema
inference reads no rows); up to ``parallelism`` of these jobs run at once from
driver threads.  What comes to the driver is one schema per file.
"""

from __future__ import annotations

import logging
import re
from collections import Counter, defaultdict
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from clickseg.schemas import CLICKS_RAW, problems_of

log = logging.getLogger(__name__)


class Footer(NamedTuple):
    path: str
    source_file: str
    schema: T.StructType | None
    problems: list[str]


def read_footers(spark: SparkSession, files: list[tuple[str, str]], expected: T.StructType | None = CLICKS_RAW,
                 parallelism: int = 16) -> list[Footer]:
    """One footer per ``(path, source_file)``, in the given order.

    ``problems`` holds the missing columns and wrong type classes against
    ``expected`` (None: no comparison), or why the file could not be read.
    """
    def one(file: tuple[str, str]) -> Footer:
        try:
            schema = spark.read.parquet(file[0]).schema
        except (PySparkException, Py4JJavaError) as e:
            if not (reason := re.search(r"CANNOT_READ_FILE_FOOTER|UNABLE_TO_INFER_SCHEMA", str(e))):
                raise  # not the file's fault
            return Footer(*file, None, [f"unreadable footer: {reason[0]}"])
        return Footer(*file, schema, problems_of(schema, expected) if expected else [])

    with ThreadPoolExecutor(max(1, min(parallelism, len(files)))) as pool:
        return list(pool.map(one, files))


def union_schema(footers: list[Footer], expected: T.StructType | None = CLICKS_RAW) -> T.StructType:
    """The columns of all files by name: the declared ones first, others in order of appearance.

    An undeclared column whose type differs between files cannot be read as one
    column: it is left out and logged.
    """
    fields = {f.name: f for f in expected.fields} if expected else {}
    kinds = defaultdict(dict)
    for footer in footers:
        for f in footer.schema.fields:
            kinds[f.name].setdefault(f.dataType.simpleString(), (f, footer.path))
    for name, found in kinds.items():
        if name in fields:
            continue
        if len(found) > 1:
            log.warning("column %s left out, its type differs between files: %s", name,
                        {k: path for k, (_, path) in found.items()})
            continue
        fields[name] = T.StructField(name, next(iter(found.values()))[0].dataType, True)
    return T.StructType(list(fields.values()))


def drift(footers: list[Footer]) -> list[tuple[str, str, int, list[str]]]:
    """Columns that not every file holds with one type: ``(column, what, files, examples)``.

    ``what`` is ``missing`` or the type; the order of the files does not matter.
    """
    held: Counter = Counter()
    where = defaultdict(list)
    for footer in footers:
        for f in footer.schema.fields:
            held[f.name] += 1
            where[f.name, f.dataType.simpleString()].append(footer.path)
    out = []
    for name in sorted(held):
        if held[name] < len(footers):
            lacking = sorted(f.path for f in footers if name not in f.schema.names)
            out.append((name, "missing", len(lacking), lacking[:3]))
        kinds = sorted(k for k in where if k[0] == name)
        if len(kinds) > 1:
            out += [(name, kind, len(where[name, kind]), sorted(where[name, kind])[:3]) for _, kind in kinds]
    return out


def verdicts(spark: SparkSession, footers: list[Footer]) -> DataFrame:
    """One row per file: path, source_file, ok, problems, columns with their types."""
    rows = [(f.path, f.source_file, not f.problems, f.problems,
             [(c.name, c.dataType.simpleString()) for c in f.schema.fields] if f.schema else []) for f in footers]
    return spark.createDataFrame(rows, "path string, source_file string, ok boolean, problems array<string>, "
                                       "columns array<struct<name:string,type:string>>")
