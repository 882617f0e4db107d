"""Input splits of N lines: a sparse index of where lines start in text files, and a data source that reads along it."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from vecloom.operators.ordinal import running_offsets
from vecloom.session import ship_package, write_table

#: Lines per entry of the index.
LINES_PER_ENTRY = 1024
#: More splits than this share partitions, since the driver holds one description of each partition.
MOST_PARTITIONS = 50_000
#: Bytes read at once, and lines and bytes handed over at once.
READ_BYTES, BATCH_LINES, BATCH_BYTES = 1 << 20, 4096, 4 << 20

SCHEMA = "split long, place int, line string"


def line_index(spark: SparkSession, paths: str | Sequence[str], name_glob: str | None = None, lines_per_entry: int = LINES_PER_ENTRY) -> DataFrame:
    """``(file, first_line, n, start)``: for each run of up to ``lines_per_entry`` lines its place in the corpus and in its file.

    Lines end at a line feed and are numbered from 0 through the files in name order; ``start`` is the byte where the run
    begins. One scan counts lines and bytes of the runs, which lie inside a file split, and no line leaves the JVM or is
    shuffled: a run is one row. Prefix sums over the runs give the rest.
    """
    reader = spark.read.option("lineSep", "\n")
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    lines = reader.text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.call_function("div", F.monotonically_increasing_id(), F.lit(lines_per_entry).cast("bigint")).alias("run"), F.octet_length("value").alias("size"))
    runs = write_table(lines.groupBy("file", "block", "run").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("size") + 1).cast("bigint").alias("bytes")), "line-runs")
    keys = ["file", "block", "run"]
    numbered = runs.join(running_offsets(runs, keys, F.col("n")).withColumnRenamed("offset", "first_line"), keys)
    placed = numbered.join(running_offsets(runs, keys, F.col("bytes")), keys)
    begin = placed.groupBy("file").agg(F.min("offset").alias("_begin"))
    return placed.join(begin, "file").select("file", "first_line", "n", (F.col("offset") - F.col("_begin")).alias("start"))


def split_ranges(index: DataFrame, lines_per_split: int) -> DataFrame:
    """``(partition, file, start, skip, first_line, lines)``: what each partition of ``lines_per_split`` lines reads of which file.

    ``index`` is read twice. A range begins at byte ``start``, the last entry of the index at or before its first line,
    ``skip`` lines before that line.
    """
    by, end = F.lit(lines_per_split).cast("bigint"), F.col("first_line") + F.col("n")

    def part_of(line: Column) -> Column:
        return F.call_function("div", line, by)

    files = index.groupBy("file").agg(F.min("first_line").alias("_low"), F.max(end).alias("_high"))
    parts = files.select("file", "_low", "_high", F.explode(F.sequence(part_of(F.col("_low")), part_of(F.col("_high") - 1))).alias("partition"))
    first, last = F.greatest("_low", F.col("partition") * by), F.least("_high", (F.col("partition") + 1) * by)
    ranges = parts.select("file", "partition", first.alias("first_line"), (last - first).alias("lines"))
    # the partitions that begin inside an entry
    earliest = part_of(F.col("first_line") + by - 1)
    begun = index.where(earliest * by < end).select("file", "first_line", "start", F.explode(F.sequence(earliest, part_of(end - 1))).alias("partition"))
    starts = begun.select("file", "partition", "start", (F.col("partition") * by - F.col("first_line")).alias("skip"))
    return ranges.join(starts, ["file", "partition"], "left").select(
        "partition", "file", F.coalesce("start", F.lit(0)).alias("start"), F.coalesce("skip", F.lit(0)).alias("skip"), "first_line", "lines")


@dataclass
class LineRanges(InputPartition):
    """One partition: the number of its first line, and (file, byte, lines to skip, lines to read) in order."""

    first_line: int
    ranges: list[tuple[str, int, int, int]]


class LineSplitSource(DataSource):
    """Text files as ``(split, place, line)``, ``lines_per_split`` lines a split, along ranges that the option ``ranges`` lists."""

    @classmethod
    def name(cls) -> str:
        return "vecloom_line_splits"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        wanted = json.loads(self.options["ranges"])
        self.options = {"lines_per_split": self.options["lines_per_split"]}  # every task gets this object, and needs no list of all
        return LineSplitReader(wanted, int(self.options["lines_per_split"]))


class LineSplitReader(DataSourceReader):
    def __init__(self, partitions: list, lines_per_split: int) -> None:
        self.wanted, self.size = partitions, lines_per_split

    def __getstate__(self) -> dict:
        return {"wanted": [], "size": self.size}

    def partitions(self) -> Sequence[LineRanges]:
        return [LineRanges(first, [tuple(r) for r in ranges]) for first, ranges in self.wanted]

    def read(self, partition: LineRanges) -> Iterator[pa.RecordBatch]:
        number, held, size = partition.first_line, [], 0
        for file, start, skip, lines in partition.ranges:
            for line in file_lines(file, start, skip, lines):
                held.append(line)
                size += len(line)
                if len(held) == BATCH_LINES or size >= BATCH_BYTES:
                    yield self._batch(number, held)
                    number, held, size = number + len(held), [], 0
        if held:
            yield self._batch(number, held)

    def _batch(self, number: int, lines: list[bytes]) -> pa.RecordBatch:
        places = range(number, number + len(lines))
        return pa.RecordBatch.from_arrays(
            [pa.array([p // self.size for p in places], pa.int64()), pa.array([p % self.size for p in places], pa.int32()),
             pa.array([line.decode("utf-8", "replace") for line in lines], pa.string())], ["split", "place", "line"])


def file_lines(file: str, start: int, skip: int, lines: int) -> Iterator[bytes]:
    """``lines`` lines of a file, without their ends, from the one ``skip`` lines after byte ``start``. Reads no further."""
    system, path = fs.FileSystem.from_uri(file)
    with system.open_input_file(path) as stream:
        stream.seek(start)
        rest: list[bytes] = []
        while lines > 0:
            data = stream.read(READ_BYTES)
            parts = data.split(b"\n")
            if data and len(parts) == 1:  # inside a long line
                rest.append(data)
                continue
            whole = [b"".join([*rest, parts[0]]), *parts[1:]]
            rest = [whole.pop()] if data else []
            if not data and whole == [b""]:  # nothing follows the last line end
                whole = []
            taken = whole[skip:skip + lines]
            skip = max(0, skip - len(whole))
            lines -= len(taken)
            yield from (line.removesuffix(b"\r") for line in taken)
            if not data and lines > 0:
                raise ValueError(f"{file} has fewer lines than its index")


def nline_corpus(spark: SparkSession, paths: str | Sequence[str], lines_per_split: int = 10_000, name_glob: str | None = None) -> DataFrame:
    """``(split, place, line)``: the lines of all files in name order, ``lines_per_split`` to a split, each split in one partition.

    A split may go on from one file to the next; the last one may be shorter. A line ends at a line feed, and a carriage
    return before that belongs to the end; a lone carriage return ends no line. Files without a line bring none; a file of one
    line is one line, however long, and only such a line must fit the memory of a task. Up to ``MOST_PARTITIONS`` splits
    have a partition each; beyond that, as many splits in a row share one as keeps to that number. The text is scanned once
    for the index, which is a row per ``LINES_PER_ENTRY`` lines, and each partition then reads its own bytes; text is never
    shuffled. Files must lie where Arrow's file systems reach them from every executor. A file that has become shorter
    than its index fails the job. A missing path is an error; bytes that are no UTF-8 read as the replacement character.
    """
    if lines_per_split < 1:
        raise ValueError("a split has at least one line")
    ship_package(spark)
    index = write_table(line_index(spark, paths, name_glob), "line-index")
    total = index.agg(F.sum("n")).first()[0] or 0
    splits = -(-total // lines_per_split)
    together = max(1, -(-splits // MOST_PARTITIONS))
    found: dict[int, list] = {}
    for row in split_ranges(index, lines_per_split * together).orderBy("first_line").toLocalIterator():  # one row per partition and file in it
        found.setdefault(row["partition"], [row["first_line"], []])[1].append((row["file"], row["start"], row["skip"], row["lines"]))
    if not found:
        return spark.createDataFrame([], SCHEMA)
    spark.dataSource.register(LineSplitSource)
    return spark.read.format(LineSplitSource.name()).option("lines_per_split", str(lines_per_split)).option(
        "ranges", json.dumps(list(found.values()))).load()
