"""Shared helpers: row preparation, lineage cuts and vectorised text hashing.

Word hashing works on the UTF-8 bytes of an Arrow string column.  Bytes are
handled in blocks of whole documents of about ``BLOCK_BYTES`` (a longer
document is a block of its own), so memory does not grow with the batch.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import lru_cache
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 1 << 20
#: Stands for a null id inside the operators; it sorts before every real id.
NULL_ID = -(1 << 63)
#: A word is a maximal run of characters outside this class.
WORD = r"[^\x20\x09-\x0D]+"

_written: dict[str, list[str]] = {}
_scope: ContextVar[list[str] | None] = ContextVar("scope", default=None)
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application (``addPyFile`` of a zip)."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        _shipped.add(sc.applicationId)
        root = Path(__file__).parents[1]
        path = Path(tempfile.mkdtemp(prefix="clickseg-code-")) / f"{root.name}.zip"
        with zipfile.ZipFile(path, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        sc.addPyFile(str(path))


# --- tables ---------------------------------------------------------------

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(d, t, text)`` of every row: id with nulls replaced, hash of the text, the text.

    Two rows with the same id and text are the same document; rows that share
    only the id are told apart by ``t``.
    """
    return docs.select(F.coalesce(docs[doc_id].cast("long"), F.lit(NULL_ID)).alias("d"),
                       F.xxhash64(docs[text]).alias("t"), docs[text].alias("text"))


def of_documents(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Join the rows of ``docs`` to ``keys`` by document, ``(d, t)`` as in :func:`keyed`; the
    other columns of ``keys`` get the prefix ``__`` so that they do not clash."""
    right = keys.withColumnsRenamed({c: f"__{c}" for c in keys.columns})
    d, t = F.coalesce(docs["doc_id"].cast("long"), F.lit(NULL_ID)), F.xxhash64(docs["text"])
    return docs.join(right, (d == right["__d"]) & (t == right["__t"]), how)


def real_id(col: Column | str) -> Column:
    """The id as given: null where :func:`keyed` put its stand-in."""
    col = F.col(col) if isinstance(col, str) else col
    return F.when(col != F.lit(NULL_ID), col)


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; on a local master a folder of our own."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    d = tempfile.mkdtemp(prefix="clickseg-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", d)
    return d


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it again.

    Later steps then start from the written rows: a lost executor costs the
    current step only.  :func:`drop_scratch` removes the tables.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark).rstrip('/')}/clickseg-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _note(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def packed(df: DataFrame, rows: int, per_task: int) -> DataFrame:
    """``df`` in as few tasks as its counted rows need, at most ``per_task`` each: a small table behind a
    shuffle does not cost a task per shuffle partition.  Tables that need more tasks than they have stay as they are."""
    return df.coalesce(max(1, -(-rows // per_task)))


def cut_bucketed(df: DataFrame, *keys: str) -> DataFrame:
    """:func:`cut` into a table bucketed by the keys: a later join on exactly these keys
    does not shuffle the rows again."""
    spark = df.sparkSession
    name = f"clickseg_{uuid.uuid4().hex}"
    path = f"{scratch_dir(spark).rstrip('/')}/{name}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, *keys).option("path", path).saveAsTable(name)
    _note(spark, path)
    return spark.table(name)


def _note(spark: SparkSession, path: str) -> None:
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    inside = _scope.get()
    if inside is not None:
        inside.append(path)


@contextmanager
def only_last_table(spark: SparkSession):
    """On a clean exit, delete all tables that :func:`cut` wrote inside the block but the last one."""
    inside: list[str] = []
    token = _scope.set(inside)
    try:
        yield
    finally:
        _scope.reset(token)
    _drop(spark, inside[:-1])
    held = _written.get(spark.sparkContext.applicationId, [])
    held[:] = [p for p in held if p not in set(inside[:-1])]


def drop_scratch(spark: SparkSession) -> int:
    """Delete the tables that :func:`cut` wrote in this application; results that
    still read them must have been written before.  Returns how many went."""
    return _drop(spark, _written.pop(spark.sparkContext.applicationId, []))


def _drop(spark: SparkSession, paths: list[str]) -> int:
    jvm, n = spark.sparkContext._jvm, 0
    for path in paths:
        if (name := path.rpartition("/")[2]).startswith("clickseg_"):  # a bucketed table: its entry in the catalog
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        p = jvm.org.apache.hadoop.fs.Path(path)
        n += p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    return n


# --- 64-bit hashing ---------------------------------------------------------

_U = np.uint64
_BASE, _BASE_INV = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of the public splitmix64 generator."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def unit(x: np.ndarray) -> np.ndarray:
    """Hashes as doubles strictly between 0 and 1."""
    return ((x >> _U(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(_BASE))
_tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse modulo 2**64, at least ``n`` of each."""
    if len(_tables[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        for i, b in enumerate((_BASE, _BASE_INV)):
            x = np.full(size, b, np.uint64)
            x[0] = 1
            _tables[i] = np.multiply.accumulate(x)
    return _tables[0], _tables[1]


def span_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hashes of ``values[start:end]`` for many spans at once."""
    power, inverse = _powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[: len(values)], out=total[1:])
    return mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))


def separators(word_bytes: str) -> np.ndarray:
    """Which bytes end a word: ``space`` (white space only) or ``alnum`` (every
    ASCII byte but letters and digits; bytes of other characters belong to words)."""
    b = np.arange(256)
    if word_bytes == "space":
        return (b == 0x20) | ((b >= 0x09) & (b <= 0x0D))
    return (b < 128) & ~(((b >= 48) & (b < 58)) | ((b >= 65) & (b < 91)) | ((b >= 97) & (b < 123)))


_SEP = {k: separators(k) for k in ("space", "alnum")}
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def blocks(column: pa.Array, max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bytes, offsets)`` of consecutive whole rows; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if not n:
        return
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset: column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + max_bytes, "right")) - 1)
        yield at, raw[offsets[at]: offsets[upto]], offsets[at: upto + 1] - offsets[at]
        at = upto


def tokens(data: np.ndarray, offsets: np.ndarray, kind: str = "space", lower: bool = False) -> SimpleNamespace:
    """Words of a block: byte ``start``/``end``, 64-bit ``hash``, ``doc`` row and
    ``first`` word of each row (one more entry than rows)."""
    if lower:
        data = _LOWER[data]
    word = ~_SEP[kind][data]
    before, after = np.empty_like(word), np.empty_like(word)
    before[1:], after[:-1] = word[:-1], word[1:]
    inner = offsets[offsets < len(data)]
    before[inner] = False
    after[offsets[offsets > 0] - 1] = False
    start = np.flatnonzero(word & ~before)
    end = np.flatnonzero(word & ~after) + 1
    first = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return SimpleNamespace(data=data, start=start, end=end, first=first, doc=doc,
                           hash=span_hashes(_BYTE[data], start, end))


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each ``n`` consecutive words (one entry per possible start)."""
    starts = np.arange(max(0, len(words) - n + 1))
    return span_hashes(words, starts, starts + n)


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


@lru_cache(maxsize=8)
def arrow_type(name: str) -> pa.DataType:
    return {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
            "boolean": pa.bool_(), "float": pa.float32(), "binary": pa.binary()}[name]


def lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Arrow lists of the given sizes over a flat array."""
    off = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(values, kind))


def held_out(doc_id: str, mod: int, rest: int) -> Column:
    """Whether crc32 of the id's text leaves ``rest``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % mod == rest
