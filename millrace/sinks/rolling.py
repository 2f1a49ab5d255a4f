"""Text files that roll by bytes, for streams.

A streaming data source: tasks write staged files and measure them, the driver commits a
micro-batch by one log entry and then moves its files to where readers look.  A repeated
micro-batch finds the entry, finishes the moves and drops what it wrote again.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections import OrderedDict
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

from millrace.sinks.files import BUCKET_PATTERN, ROLL_INTERVAL
from millrace.streaming.run import start

FORMAT = "rolling_text"
MAX_BYTES = 1 << 30
MOST_OPEN = 64
MOVERS = 16
STAGED, LOGGED = "_staged", "_rolled"
NO_BUCKET = "__HIVE_DEFAULT_PARTITION__"
# Characters that Spark writes as %XX in the name of a partition's folder.
ESCAPED = re.compile(r"""[\x00-\x1f\x7f"#%'*/:=?\\{\[\]^]""")
NOTHING, LINE_BREAK = pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string())


def _resolve(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    system, root = fs.FileSystem.from_uri(path)
    return system, root.rstrip("/")


def _exists(system: fs.FileSystem, path: str) -> bool:
    return system.get_file_info(path).type != fs.FileType.NotFound


def _own(path: str, folder: str, checkpoint: str) -> str:
    """The part of a hidden folder that belongs to the query of ``checkpoint``."""
    return f"{path}/{folder}/{hashlib.sha256(checkpoint.encode()).hexdigest()[:16]}"


def _delete(system: fs.FileSystem, folder: str) -> None:
    if _exists(system, folder):
        system.delete_dir(folder)


class _Part:
    """One staged file and the bytes it holds."""

    def __init__(self, system: fs.FileSystem, folder: str) -> None:
        self.path = f"{folder}/{uuid.uuid4().hex}"
        self.used = 0
        self._out = system.open_output_stream(self.path, compression=None)

    def add(self, data: pa.Buffer) -> None:
        self._out.write(data)
        self.used += data.size

    def close(self) -> None:
        self._out.close()


@dataclass
class Written(WriterCommitMessage):
    """Bucket and staged path of each file of a task."""

    files: list[tuple[str, str]]


class RollingWriter(DataSourceStreamArrowWriter):
    def __init__(self, options: dict[str, str]) -> None:
        self._path = options["path"]
        self._checkpoint = options["querycheckpoint"]
        self._max_bytes = int(options["maxbytes"])
        self._prefix, self._suffix = options["prefix"], options["suffix"]
        self._attempt = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = _resolve(self._path)
        folder = f"{_own(root, STAGED, self._checkpoint)}/{self._attempt}"
        system.create_dir(folder, recursive=True)
        parts: OrderedDict[str, _Part] = OrderedDict()
        files: list[tuple[str, str]] = []

        def close(bucket: str) -> None:
            part = parts.pop(bucket)
            part.close()
            files.append((bucket, part.path))

        def part_of(bucket: str) -> _Part:
            if bucket not in parts:
                if len(parts) == MOST_OPEN:
                    close(next(iter(parts)))
                parts[bucket] = _Part(system, folder)
            parts.move_to_end(bucket)
            return parts[bucket]

        try:
            for batch in iterator:
                names = pc.fill_null(batch["bucket"], "")
                for name in pc.unique(names).to_pylist():
                    lines = pc.filter(batch["value"], pc.equal(names, name))
                    lines = pc.fill_null(lines.cast(pa.large_string()), "")
                    ended = pc.binary_join_element_wise(lines, NOTHING, LINE_BREAK)
                    bucket = ESCAPED.sub(lambda found: f"%{ord(found[0]):02X}", name) or NO_BUCKET
                    ends = np.frombuffer(ended.buffers()[1], np.int64)[ended.offset :][: len(ended) + 1]
                    at = 0
                    while at < len(ended):
                        part = part_of(bucket)
                        room = ends[at] + self._max_bytes - part.used
                        to = int(np.searchsorted(ends, room, "right")) - 1
                        if to <= at and not part.used:
                            to = at + 1  # a line above the limit has a file of its own
                        if to > at:
                            part.add(ended.buffers()[2].slice(ends[at], ends[to] - ends[at]))
                        if to < len(ended):
                            close(bucket)
                        at = max(at, to)
            for bucket in list(parts):
                close(bucket)
        except BaseException:
            for part in parts.values():
                part.close()
            raise
        return Written(files)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        system, root = _resolve(self._path)
        written = [entry for message in messages if message for entry in message.files]
        folder = _own(root, LOGGED, self._checkpoint)
        system.create_dir(folder, recursive=True)
        entries = system.get_file_info(fs.FileSelector(folder))
        logged = [int(info.base_name) for info in entries if info.base_name.isdigit()]
        if batchId > max(logged, default=-1):
            moves = [
                (staged, f"{root}/bucket={bucket}/{self._name(folder, batchId, k)}")
                for k, (bucket, staged) in enumerate(written)
            ]
            draft = f"{folder}/.{uuid.uuid4().hex}"
            with system.open_output_stream(draft, compression=None) as out:
                out.write(json.dumps(moves).encode())
            system.move(draft, f"{folder}/{batchId:012d}")
            logged.append(batchId)
        # The entry decides: whatever it lists and was not moved yet is moved now.
        with system.open_input_stream(f"{folder}/{max(logged):012d}", compression=None) as entry:
            moves = json.loads(entry.read())
        for parent in {final.rpartition("/")[0] for _, final in moves}:
            system.create_dir(parent, recursive=True)

        def move(pair: tuple[str, str]) -> None:
            if _exists(system, pair[0]):
                system.move(*pair)

        with ThreadPoolExecutor(MOVERS) as movers:
            list(movers.map(move, moves))
        for number in set(logged) - {max(logged)}:
            system.delete_file(f"{folder}/{number:012d}")
        _delete(system, _own(root, STAGED, self._checkpoint))

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        # Files of an earlier attempt may be listed in the log and not moved yet.
        system, root = _resolve(self._path)
        _delete(system, f"{_own(root, STAGED, self._checkpoint)}/{self._attempt}")

    def _name(self, folder: str, batch: int, number: int) -> str:
        return f"{self._prefix}-{folder[-8:]}-{batch}-{number:05d}{self._suffix}"


class RollingText(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> RollingWriter:
        return RollingWriter(dict(self.options))


def rolling_files(
    df: DataFrame,
    line: Column,
    path: str,
    checkpoint: str,
    *,
    interval: str | None = ROLL_INTERVAL,
    max_bytes: int = MAX_BYTES,
    bucket: Column | None = None,
    prefix: str = "part",
    suffix: str = ".txt",
) -> StreamingQuery:
    """Streams lines into files of at most ``max_bytes``, in folders ``bucket=...``.

    A file ends when its next line would not fit, and with its micro-batch: so ``interval``
    is the longest a file is open, and idle files need no rule of their own.  Only a line
    that is longer than ``max_bytes`` makes a file above it.  ``bucket`` is the hour of
    processing unless given; a task has ``MOST_OPEN`` buckets open, and closes the one it
    has not written to longest for another.  A null line is an empty one.

    Rows arrive exactly once where a move of a file is atomic (local and shared folders,
    HDFS).  Every reader of the folder sees whole files only, from the commit on.
    ``checkpoint`` names the query: used again after it was deleted, it is refused, because
    micro-batches would be taken for repeated ones.
    """
    if max_bytes < 1:
        raise ValueError("max_bytes must be positive")
    system, root = _resolve(path)
    store, kept = _resolve(checkpoint)
    if _exists(system, _own(root, LOGGED, checkpoint)) and not _exists(store, f"{kept}/metadata"):
        raise ValueError(f"{path} has micro-batches of a checkpoint that is gone: {checkpoint}")
    df.sparkSession.dataSource.register(RollingText)
    if bucket is None:
        bucket = F.date_format(F.current_timestamp(), BUCKET_PATTERN)
    writer = (
        df.select(line.cast("string").alias("value"), bucket.cast("string").alias("bucket"))
        .writeStream.format(FORMAT)
        .option("path", path)
        .option("queryCheckpoint", checkpoint)
        .option("maxBytes", max_bytes)
        .option("prefix", prefix)
        .option("suffix", suffix)
    )
    return start(writer, df.sparkSession, checkpoint, interval=interval)
