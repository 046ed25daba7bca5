"""A streaming source of lines from a log of segment files, with offsets.

The log is a folder of text files whose names sort in the order they were
written (as those of a message log do). An offset is a place in that log: a
segment and a byte in it; all segments before it are consumed. Readers can begin at the earliest or
the latest offset, take a bounded number of bytes per micro-batch, split a batch
into byte ranges that tasks read in parallel, and read any range again, which is what a
restarted query does with the offsets of its checkpoint. No broker and no port is
needed; the folder must be reachable by pyarrow's file systems from the driver and all executors.

A line belongs to the range in which its first byte lies, so ranges may cut
anywhere. Segments may grow by whole lines; hidden files (names beginning with a dot or an
underscore) and folders are no segments. The place that a group of readers has planned up to is
kept in the log's ``_groups`` folder: after a restart the source goes on from there.
"""

from __future__ import annotations

import json
import posixpath
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

FORMAT = "line_log"
#: Bytes of one task's range.
SPLIT_BYTES = 64 << 20


class _Range(InputPartition):
    def __init__(self, path: str, low: int, high: int):
        self.path, self.low, self.high = path, low, high


def _file_system(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def lines_in(data, low: int, high: int) -> Iterator[str]:
    """Lines of an open file whose first byte lies in [low, high)."""
    if low:
        data.seek(low - 1)
        if data.read(1) != b"\n":
            _until_newline(data)
    at = data.tell()
    while at < high:
        line = _until_newline(data)
        if not line:
            return
        at += len(line)
        yield line.rstrip(b"\n").decode("utf-8")


def _until_newline(data) -> bytes:
    """The rest of the current line, with its end; moves just behind it."""
    begin, parts = data.tell(), []
    while True:
        part = data.read(1 << 16)
        cut = part.find(b"\n")
        if cut >= 0 or not part:
            parts.append(part[:cut + 1])
            out = b"".join(parts)
            data.seek(begin + len(out))
            return out
        parts.append(part)


class LineLogReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.uri = options["path"].rstrip("/")
        self.fs, self.path = _file_system(self.uri)
        self.starting = options.get("startingoffsets", options.get("startingOffsets", "latest"))
        self.limit = int(options.get("maxbytespertrigger", options.get("maxBytesPerTrigger", 0)))
        self.split = int(options.get("splitbytes", options.get("splitBytes", SPLIT_BYTES)))
        group = options.get("group")
        self.group = f"{self.path}/_groups/{group}.json" if group else None
        self.at = self._planned()

    def segments(self) -> list[tuple[str, int]]:
        from pyarrow import fs
        found = self.fs.get_file_info(fs.FileSelector(self.path))
        return sorted((posixpath.basename(f.path), f.size) for f in found
                      if f.type == fs.FileType.File and not posixpath.basename(f.path).startswith((".", "_")))

    def _planned(self) -> dict | None:
        from pyarrow import fs
        if self.group is None or self.fs.get_file_info(self.group).type != fs.FileType.File:
            return None
        with self.fs.open_input_stream(self.group) as f:
            return json.loads(f.read())

    def initialOffset(self) -> dict:
        segments = self.segments()
        if self.starting == "earliest" or not segments:
            return {"segment": "", "byte": 0}
        return {"segment": segments[-1][0], "byte": segments[-1][1]}

    def latestOffset(self) -> dict:
        """The end of the log, or as far as the limit allows beyond what was planned last."""
        if self.at is None:
            self.at = self.initialOffset()
        room = self.limit or None
        end = self.at
        for name, size in self.segments():
            begin = self.at["byte"] if name == self.at["segment"] else 0
            if name < self.at["segment"] or size <= begin:
                continue
            take = size - begin if room is None else min(room, size - begin)
            if take:
                end = {"segment": name, "byte": begin + take}
            room = None if room is None else room - take
            if room == 0:
                break
        self.at = end
        return end

    def partitions(self, start: dict, end: dict) -> list[_Range]:
        if self.at is None or (self.at["segment"], self.at["byte"]) < (end["segment"], end["byte"]):
            self.at = end
        if self.group:
            self.fs.create_dir(posixpath.dirname(self.group), recursive=True)
            with self.fs.open_output_stream(self.group) as f:
                f.write(json.dumps(end).encode())
        out = []
        for name, size in self.segments():
            low = start["byte"] if name == start["segment"] else 0
            high = end["byte"] if name == end["segment"] else size
            if start["segment"] <= name <= end["segment"]:
                out += [_Range(name, x, min(x + self.split, high)) for x in range(low, high, self.split)]
        return out

    def read(self, partition: _Range) -> Iterator[tuple]:
        with self.fs.open_input_file(f"{self.path}/{partition.path}") as f:
            for line in lines_in(f, partition.low, partition.high):
                yield (line,)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "fs"}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.fs, _ = _file_system(self.uri)


class LineLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema) -> LineLogReader:
        return LineLogReader(dict(self.options))


def log_lines(spark: SparkSession, path: str, starting: str = "latest", group: str | None = None, max_bytes: int | None = None,
              split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Streaming ``value`` lines of the log at ``path``; ``max_bytes`` limits what one micro-batch takes."""
    spark.dataSource.register(LineLog)
    reader = spark.readStream.format(FORMAT).option("path", path).option("startingOffsets", starting).option("splitBytes", split_bytes)
    if group:
        reader = reader.option("group", group)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load()
