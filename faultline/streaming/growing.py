"""A streaming source for files that grow: each line once, when its line end has arrived.

``spark.readStream.format("growing_files")`` follows all files of a folder whose name
matches a pattern. The offset is, for each file, the byte up to which it has complete
lines and a mark of its first line. So a restart goes on where the checkpoint says, a
half-written last line waits for the rest of it, and a file that was cut off or replaced
under its name (shorter than before, or with another first line) is read from its start.
New bytes are cut into ranges that are read in parallel; small ones share a task.

Lines that a file loses before a batch reads them are gone, and a replayed batch whose
bytes are no longer there fails instead of passing over them. A file replaced by a
longer one with the same first line counts as the same file. The folder must be on a
file system that pyarrow reads and whose files can grow: a mounted one, or HDFS.
"""

from __future__ import annotations

import fnmatch
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from faultline.streaming.sources import line_time

FORMAT = "growing_files"
SPLIT_BYTES = 64 << 20
_CHUNK = 1 << 20
_BLOCK = 1 << 16


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def last_line_end(file, low: int, high: int) -> int:
    """The byte after the last line end in [low, high), or ``low``."""
    while high > low:
        start = max(low, high - _BLOCK)
        file.seek(start)
        at = file.read(high - start).rfind(b"\n")
        if at >= 0:
            return start + at + 1
        high = start
    return low


def first_line_mark(file, end: int) -> int:
    """crc32 of the first line of a file that has complete lines up to ``end``."""
    file.seek(0)
    mark, left = 0, end
    while left > 0:
        block = file.read(min(left, _BLOCK))
        at = block.find(b"\n")
        if at >= 0 or not block:
            return zlib.crc32(block[: at + 1], mark)
        mark, left = zlib.crc32(block, mark), left - len(block)
    return mark


def new_ranges(start: dict, end: dict, split_bytes: int) -> list[list[tuple[str, int, int, int, int]]]:
    """Parts of (path, low, high, first, last): lines that begin in [low, high) of the new bytes [first, last)."""
    ranges = []
    for path in sorted(end):
        last, before = end[path]["end"], start.get(path)
        same = before is not None and before["mark"] == end[path]["mark"] and before["end"] <= last
        first = before["end"] if same else 0
        ranges += [(path, low, min(low + split_bytes, last), first, last) for low in range(first, last, split_bytes)]
    parts, held = [], 0
    for r in ranges:
        if not parts or held + r[2] - r[1] > split_bytes:
            parts.append([])
            held = 0
        parts[-1].append(r)
        held += r[2] - r[1]
    return parts


def read_lines(file, low: int, high: int, first: int, last: int) -> Iterator[tuple[list[bytes], list[int]]]:
    """Lines that begin in [low, high) and the bytes at which they begin, some at a time."""
    at = low
    if low > first:  # the line that is under way at ``low`` belongs to the range before
        at = low - 1
        file.seek(at)
        while at < last:
            block = file.read(min(_BLOCK, last - at))
            found = block.find(b"\n")
            if not block or found >= 0:
                at += found + 1
                break
            at += len(block)
    file.seek(at)
    held = b""
    while at < high:  # ``at`` is where ``held`` begins
        block = file.read(min(_CHUNK, last - at - len(held)))
        if not block:
            raise RuntimeError("a followed file has lost lines that were not read yet")
        lines = (held + block).split(b"\n")
        held = lines.pop()
        starts = []
        for line in lines:
            if at >= high:
                break
            starts.append(at)
            at += len(line) + 1
        if starts:
            yield lines[: len(starts)], starts


@dataclass
class Part(InputPartition):
    ranges: list


class GrowingFilesReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.pattern = options.get("pattern", "*")
        self.split_bytes = int(options.get("splitbytes", SPLIT_BYTES))
        self.from_end = options.get("fromend", "false").lower() == "true"
        self._sizes: dict[str, int] = {}
        self._known: dict[str, dict] = {}

    def initialOffset(self) -> dict:
        return self.latestOffset() if self.from_end else {}

    def latestOffset(self) -> dict:
        system, folder = _open(self.folder)
        for info in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
            path = info.path
            if not info.is_file or not fnmatch.fnmatch(info.base_name, self.pattern) or self._sizes.get(path) == info.size:
                continue
            known = self._known.get(path)
            with system.open_input_file(path) as file:
                low = known["end"] if known and info.size >= known["end"] and first_line_mark(file, known["end"]) == known["mark"] else 0
                end = last_line_end(file, low, info.size)
                if end:
                    self._known[path] = {"end": end, "mark": first_line_mark(file, end)}
            self._sizes[path] = info.size
        return {path: dict(at) for path, at in self._known.items()}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return [Part(ranges) for ranges in new_ranges(start, end, self.split_bytes)]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        system, _ = _open(self.folder)
        for path, low, high, first, last in partition.ranges:
            with system.open_input_file(path) as file:
                for lines, starts in read_lines(file, low, high, first, last):
                    texts = [line.removesuffix(b"\r").decode("utf-8", "replace") for line in lines]
                    yield pa.RecordBatch.from_arrays([pa.array(texts), pa.array([path] * len(texts)), pa.array(starts, pa.int64())], ["value", "source", "at"])


class GrowingFiles(DataSource):
    """Options: path (a folder), pattern (of file names, ``*``), splitBytes, fromEnd (skip what is there at the first start)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string, source string, at bigint"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return GrowingFilesReader(dict(self.options))


def follow_growing(spark: SparkSession, folder: str, pattern: str = "*.log", from_end: bool = False, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Lines appended to the files of ``folder``: log_line, event_time, arrived_at, source, and the byte ``at`` which each begins.

    ``arrived_at`` is the time of the batch that reads a line, the same in a replay.
    Give rotated files names that ``pattern`` does not match.
    """
    spark.dataSource.register(GrowingFiles)
    lines = spark.readStream.format(FORMAT).options(path=folder, pattern=pattern, fromEnd=str(from_end).lower(), splitBytes=split_bytes).load()
    arrived = F.current_timestamp()
    return lines.select(
        F.col("value").alias("log_line"), line_time(F.col("value"), arrived).alias("event_time"), arrived.alias("arrived_at"), "source", "at"
    )
