"""Growing text files as a stream, by byte position: a Python Data Source.

The offset of the stream is a byte position per file. A trigger reads what was appended since
the last one, up to the last line end of the file, so a line that is still being written waits
for its end. Increments larger than a range are split, and a range owns the lines that begin
in it, so many tasks read one large file. A restarted query goes on from the positions in its
checkpoint; a range is read again as it was, since bytes that were there do not change.

Files are opened by path in the executors: the folder must be one that all of them mount.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

RANGE_BYTES = 32 << 20
BLOCK_BYTES = 1 << 20
LINES = 10_000


class Range(InputPartition):
    """Bytes ``begin`` to ``end`` of a file; ``floor`` is where the increment begins."""

    def __init__(self, path: str, floor: int, begin: int, end: int) -> None:
        self.path, self.floor, self.begin, self.end = path, floor, begin, end


def local_path(path: str) -> str:
    return path.removeprefix("file://").removeprefix("file:")


def complete_bytes(path: str, known: int) -> int:
    """Position after the last line end of a file, ``known`` being one of them."""
    end = os.path.getsize(path)
    with open(path, "rb") as file:
        while end > known:
            begin = max(known, end - BLOCK_BYTES)
            file.seek(begin)
            at = file.read(end - begin).rfind(b"\n")
            if at >= 0:
                return begin + at + 1
            end = begin
    return known


def positions(folder: str, suffix: str, known: dict[str, int]) -> dict[str, int]:
    """Complete bytes of each file of a folder; files that went keep their last position."""
    found = dict(known)
    for entry in os.scandir(folder) if os.path.isdir(folder) else ():
        if entry.is_file() and entry.name.endswith(suffix) and entry.name[0] not in "._":
            at = known.get(entry.name, 0)
            if entry.stat().st_size < at:
                raise ValueError(f"{entry.name} is shorter than what was read of it; "
                                 "files may only grow")
            found[entry.name] = complete_bytes(entry.path, at)
    return found


def ranges(folder: str, start: dict[str, int], end: dict[str, int], size: int) -> list[Range]:
    """The bytes between two offsets, in ranges of at most ``size``."""
    out = []
    for name, stop in sorted(end.items()):
        floor = start.get(name, 0)
        out += [Range(os.path.join(folder, name), floor, at, min(at + size, stop))
                for at in range(floor, stop, size)]
    return out


def lines(part: Range) -> Iterator[tuple[int, bytes]]:
    """Position and bytes of each line that begins in the range, without its end."""
    with open(part.path, "rb") as file:
        at = part.begin
        file.seek(max(part.floor, at - 1))
        if at > part.floor:  # the line that is under way belongs to the range before
            at = at - 1 + len(file.readline())
        while at < part.end:
            line = file.readline()
            if not line:
                raise ValueError(f"{part.path} ends before byte {part.end}; files may only grow")
            yield at, line.rstrip(b"\r\n")
            at += len(line)


class GrowingReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.folder = local_path(options["path"])
        self.suffix = options.get("suffix", "")
        self.size = int(options.get("rangebytes", options.get("rangeBytes", RANGE_BYTES)))
        self.known: dict[str, int] = {}

    def initialOffset(self) -> dict:
        return {"files": json.dumps({})}

    def latestOffset(self) -> dict:
        self.known = positions(self.folder, self.suffix, self.known)
        return {"files": json.dumps(self.known, sort_keys=True)}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        begin, stop = (json.loads(o["files"]) for o in (start, end))
        # After a restart the positions come from the checkpoint.
        self.known = {n: max(at, self.known.get(n, 0)) for n, at in stop.items()} | {
            n: at for n, at in self.known.items() if n not in stop}
        return ranges(self.folder, begin, stop, self.size)

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        name = os.path.basename(partition.path)
        held: list[tuple[int, bytes]] = []

        def batch() -> pa.RecordBatch:
            return pa.record_batch({
                "file": pa.array([name] * len(held), pa.string()),
                "position": pa.array([at for at, _ in held], pa.int64()),
                "line": pa.array([line.decode("utf-8", "replace") for _, line in held],
                                 pa.string())})

        for row in lines(partition):
            held.append(row)
            if len(held) == LINES:
                yield batch()
                held.clear()
        if held:
            yield batch()


class GrowingLines(DataSource):
    """``spark.readStream.format("growing_lines").load(folder)``: rows ``file, position, line``.

    Options: ``suffix`` of the files to read, ``rangeBytes`` of a task.
    """

    @classmethod
    def name(cls) -> str:
        return "growing_lines"

    def schema(self) -> str:
        return "file STRING, position LONG, line STRING"

    def streamReader(self, schema: StructType) -> GrowingReader:
        return GrowingReader(self.options)


def tail_lines(spark: SparkSession, folder: str, suffix: str = "",
               range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Complete lines appended to the files of a folder, as a stream of
    ``file, position, line``. Blank lines are rows; a file without a line end has none yet."""
    spark.dataSource.register(GrowingLines)
    return (spark.readStream.format("growing_lines").option("suffix", suffix)
            .option("rangeBytes", range_bytes).load(folder))


def tail_csv(spark: SparkSession, folder: str, schema: str, suffix: str = ".csv",
             range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Rows appended to CSV files, as ``schema`` plus ``file`` and ``position``.

    The first line of a file is its header and no row; records fill one line each.
    """
    rows = tail_lines(spark, folder, suffix, range_bytes).where(
        (F.col("position") > 0) & (F.trim("line") != ""))
    return rows.select("file", "position", F.from_csv("line", schema).alias("row")).select(
        "file", "position", "row.*")


def tail_json(spark: SparkSession, folder: str, schema: str, suffix: str = ".jsonl",
              range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Objects appended to line-wise JSON files, as ``schema`` plus ``file`` and ``position``."""
    rows = tail_lines(spark, folder, suffix, range_bytes).where(F.trim("line") != "")
    return rows.select("file", "position", F.from_json("line", schema).alias("row")).select(
        "file", "position", "row.*")
