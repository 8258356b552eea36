"""Log files that still grow: a tailing stream source and sessions with timers (L1, L4).

:class:`LogTail` reads what was appended to the files of a folder since the last
trigger, whole lines only, with a byte position per file as its offset.
:func:`tail_sessions` keeps the open session of each file as state and hands it
out when a later record closes it, or when one of two timers does: ``gap``
without a new record, or ``limit`` since the session was first seen.  A session
handed out by a timer stays in the state: records that continue it hand it out
again with larger totals, and a sink that upserts by path and start
(:func:`clickseg.streaming.logs.commit_sink`) then holds what the batch form gives.

Defined results: an empty file, or one without a complete line, gives nothing;
a line is read when its line break is; lines without a readable time belong to
no session; a file that disappears is forgotten.  Records of a file are taken in
the order they were written; a record older than the open session's last one
counts for the open session, as a log has no other place for it.
"""

from __future__ import annotations

import hashlib
import json
import posixpath
from collections.abc import Iterator
from fnmatch import fnmatch

import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from clickseg.streaming import logs as LG

LINES = "path string, generation int, block bigint, line_id bigint, line string"
HEAD_BYTES = 256
TAIL_BLOCK = 1 << 16


class Span(InputPartition):
    """Bytes ``start..end`` of a file, from a line start to a line break; ``name`` is the path it is
    reported under, which differs from ``path`` for the rest of a rotated file."""

    def __init__(self, path: str, name: str, generation: int, start: int, end: int):
        super().__init__(None)
        self.path, self.name, self.generation, self.start, self.end = path, name, generation, start, end


class TailReader(DataSourceStreamReader):
    """Offsets are ``{path: [generation, bytes read, head length, head hash]}`` plus the spans that
    lead there, so a restart reads again exactly the spans of the batch that did not end.

    The head of a file tells it from another one of the same name: a file that
    got shorter, or whose first bytes changed, is a new generation read from its
    start, and the rest of the old one is looked for under its new name.
    """

    def __init__(self, options: dict):
        root = options["path"]
        self.fs, self.root = pafs.FileSystem.from_uri(root) if "://" in root else (pafs.LocalFileSystem(), root)
        self.pattern = options.get("pattern", "*.log")
        self.split = int(options.get("splitbytes", 64 << 20))
        self.budget = int(options.get("maxbytesperfile", 256 << 20))
        self.at: dict | None = None

    def initialOffset(self) -> dict:
        return {"files": {}, "spans": []}

    def latestOffset(self) -> dict:
        self.at = self._advance((self.at or self.initialOffset())["files"])
        return self.at

    def partitions(self, start: dict, end: dict) -> list[Span]:
        # After a restart the offset that was handed out last is the one to go on from.
        self.at = end
        return [Span(*s) for s in end["spans"]] if end != start else []

    def commit(self, end: dict) -> None:
        pass

    def read(self, span: Span) -> Iterator[pa.RecordBatch]:
        with self.fs.open_input_file(span.path) as f:
            f.seek(span.start)
            data = f.read(span.end - span.start)
        lines = data.split(b"\n")[:-1]
        starts, at = [], span.start
        for x in lines:
            starts.append(at)
            at += len(x) + 1
        n = len(lines)
        yield pa.RecordBatch.from_arrays(
            [pa.array([span.name] * n, pa.string()), pa.array([span.generation] * n, pa.int32()), pa.array([span.start] * n, pa.int64()),
             pa.array(starts, pa.int64()), pa.array([x.rstrip(b"\r").decode("utf-8", "replace") for x in lines], pa.string())],
            ["path", "generation", "block", "line_id", "line"])

    # --- what was appended ---------------------------------------------------

    def _advance(self, before: dict) -> dict:
        infos = {i.path: i for i in self.fs.get_file_info(pafs.FileSelector(self.root, allow_not_found=True))
                 if i.type == pafs.FileType.File}
        files, spans = {}, []
        for path, info in sorted(infos.items()):
            if not fnmatch(posixpath.basename(path), self.pattern):
                continue
            generation, read, n, head = before.get(path, (0, 0, 0, ""))
            if read and (info.size < read or self._head(path, n) != head):
                old = next((p for p, i in infos.items() if p != path and i.size >= read and self._head(p, n) == head), None)
                if old is not None:
                    spans += self._spans(old, path, generation, read, infos[old].size)[0]
                generation, read = generation + 1, 0
            new, read = self._spans(path, path, generation, read, min(info.size, read + self.budget), info.size)
            spans += new
            n = min(read, HEAD_BYTES)
            files[path] = [generation, read, n, self._head(path, n)]
        return {"files": files, "spans": spans}

    def _spans(self, path: str, name: str, generation: int, start: int, upto: int, size: int = 0) -> tuple[list, int]:
        """Spans of whole lines between ``start`` and ``upto`` and where they end; a line longer
        than the budget is read to its break, wherever in the file that is."""
        spans, at = [], start
        while at < upto:
            end = self._last_break(path, at, min(at + self.split, upto))
            if end == at:
                end = self._next_break(path, min(at + self.split, upto), max(upto, size))
            if end == at:
                break
            spans.append([path, name, generation, at, end])
            at = end
        return spans, at

    def _bytes(self, path: str, start: int, end: int) -> bytes:
        with self.fs.open_input_file(path) as f:
            f.seek(start)
            return f.read(end - start)

    def _head(self, path: str, n: int) -> str:
        return hashlib.sha256(self._bytes(path, 0, n)).hexdigest() if n else ""

    def _last_break(self, path: str, start: int, end: int) -> int:
        """Just behind the last line break in ``start..end``; ``start`` if there is none."""
        while end > start:
            low = max(start, end - TAIL_BLOCK)
            found = self._bytes(path, low, end).rfind(b"\n")
            if found >= 0:
                return low + found + 1
            end = low
        return start

    def _next_break(self, path: str, start: int, end: int) -> int:
        """Just behind the first line break in ``start..end``, else the start of the line that has none."""
        at = start
        while at < end:
            block = self._bytes(path, at, min(end, at + TAIL_BLOCK))
            found = block.find(b"\n")
            if found >= 0:
                return at + found + 1
            at += len(block)
        return self._last_break(path, 0, start)


class LogTail(DataSource):
    """``spark.readStream.format("log_tail")``: options ``path`` (a folder that driver and executors
    share), ``pattern``, ``splitBytes`` and ``maxBytesPerFile`` (bytes of a file in one trigger)."""

    @classmethod
    def name(cls) -> str:
        return "log_tail"

    def schema(self) -> str:
        return LINES

    def streamReader(self, schema) -> TailReader:
        return TailReader({k.lower(): v for k, v in dict(self.options).items()})


def tail_lines(spark: SparkSession, path: str, **options) -> DataFrame:
    """Appended lines of the log files in ``path``; ``line_id`` is the line's byte position."""
    spark.dataSource.register(LogTail)
    return spark.readStream.format("log_tail").options(path=path, **options).load()


# --- sessions with timers -----------------------------------------------------

TOTALS = [f"total_{name}" for name, _ in LG.METRICS]
SESSIONS = ("path string, session_start timestamp, session_end timestamp, "
            + ", ".join(f"{t} bigint" for t in TOTALS) + ", records bigint")
STATE = "start bigint, last bigint, opened bigint, fresh boolean, " + ", ".join(f"{t} bigint" for t in TOTALS) + ", records bigint"


class SessionTimers(StatefulProcessor):
    """The open session of each path.  ``gap_ms`` and ``limit_ms`` bound it in the records' times, and
    both are timers in processing time too."""

    def __init__(self, gap_ms: int, limit_ms: int):
        self.gap_ms, self.limit_ms = gap_ms, limit_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        batch = pd.concat(list(rows)).sort_values(["generation", "line_id"])  # bounded by maxBytesPerFile
        state = list(self.open.get()) if self.open.exists() else None
        done = []
        for t, *values in batch[["ts", *[n for n, _ in LG.METRICS]]].itertuples(index=False):
            us = t.value // 1000
            if state is not None and (us - state[1] >= self.gap_ms * 1000 or us - state[0] >= self.limit_ms * 1000):
                if state[3]:
                    done.append(self._row(key, state))
                state = None
            if state is None:
                state = [us, us, now, True, *[0] * len(values), 0]
            state[1], state[3], state[-1] = max(state[1], us), True, state[-1] + 1
            for i, v in enumerate(values):
                state[4 + i] += 0 if pd.isna(v) else int(v)
        self.open.update(tuple(state))
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        for at in {now + self.gap_ms, max(now + 1, state[2] + self.limit_ms)}:
            self.handle.registerTimer(at)
        if done:
            yield self._frame(done)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.open.exists():
            state = list(self.open.get())
            if state[3]:
                state[3] = False
                self.open.update(tuple(state))
                yield self._frame([self._row(key, state)])

    def close(self) -> None:
        pass

    def _row(self, key, state: list) -> tuple:
        return (key[0], state[0], state[1] + self.gap_ms * 1000, *state[4:])

    @staticmethod
    def _frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=["path", "session_start", "session_end", *TOTALS, "records"])
        for c in ("session_start", "session_end"):
            out[c] = pd.to_datetime(out[c], unit="us")
        return out


def tail_sessions(lines: DataFrame, gap_s: int = 60, limit_s: int = LG.SESSION_LIMIT_S) -> DataFrame:
    """L4 on growing files, in update mode: sessions as they close, by record or by timer.

    Needs the RocksDB state store (``spark.sql.streaming.stateStore.providerClass``).
    """
    fields = LG.log_metrics(LG.log_fields(lines.filter(F.col("line").rlike(LG.RECORD_START)).withColumnRenamed("line", "message")))
    heads = fields.filter(F.col("ts").isNotNull()).select("path", "generation", "line_id", "ts", *[n for n, _ in LG.METRICS])
    return heads.groupBy("path").transformWithStateInPandas(
        statefulProcessor=SessionTimers(gap_s * 1000, limit_s * 1000), outputStructType=SESSIONS,
        outputMode="Update", timeMode="ProcessingTime")
