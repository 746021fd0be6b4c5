"""CSV files with line breaks in quoted fields, read in splits.

A reader that keeps such fields whole reads a file in one task. Here the text source cuts a file at byte ranges of a fixed
size and gives the lines of each. Whether a line starts a record or goes on within quotes depends on all lines before it,
so one pass finds, for each range, the state it ends in and the records that start in it, for either state it may be entered
in; a running composition over the ranges, one small row each, gives every range its state and the number of its first record.
A second pass then cuts the ranges into records, all at once. Only the pieces of records that lie across a boundary are shuffled.

The state is that of a record parser, not the parity of quotes: a quote within an unquoted field is plain text.

Ranges are read through a clone of the session that fixes their size, so that all passes see the same ones however many
executors there are. A task goes through several ranges, about TASK_BYTES, so tasks grow with the file and not with how finely it is cut.

Defined results: records end with \\n or \\r\\n; line breaks within quotes stay as they are. Empty lines are no records. The first
record of each file is its header; columns go by the first file's. Fields that a record lacks are null, further ones are
left out. A quoted field that never ends takes the rest of the file. Files of nothing have no columns.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.sources import commits
from tallyspark.sources.stage import staged

SPLIT_BYTES = 32 << 20
TASK_BYTES = 4 << 20
FEW_TASKS = 64  # up to so many ranges are a task each
MAX_RANGES = 100_000  # of this many, states and numbers take some 20 MB in each Python worker

_QUOTED = r'(?:[^"]++|"")*+"[^,]*+'
_FIELD = rf'(?:"{_QUOTED}|[^",][^,]*+|)'
_MORE = rf"(?:,{_FIELD})*+"
# Whether a line that starts in a new record, or within quotes, ends outside of quotes.
_FROM_START = re.compile(rf"{_FIELD}{_MORE}", re.S)
_FROM_WITHIN = re.compile(rf"{_QUOTED}{_MORE}", re.S)


def closes(line: str, within: bool) -> bool:
    return (_FROM_WITHIN if within else _FROM_START).fullmatch(line) is not None


def pinned(spark: SparkSession, split_bytes: int) -> SparkSession:
    """A clone of the session whose file splits depend on the files alone."""
    clone = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    clone.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    clone.conf.set("spark.sql.files.openCostInBytes", str(split_bytes))  # one range a task
    clone.conf.set("spark.sql.files.minPartitionNum", "1")
    return clone


def lines_of(spark: SparkSession, path: str, split_bytes: int) -> DataFrame:
    """(file, start, line): lines by byte range, in their order within each."""
    text = pinned(spark, split_bytes).read.option("lineSep", "\n").text(path)
    tasks = max(FEW_TASKS, -(-commits.size(spark, path) // TASK_BYTES), spark.sparkContext.defaultParallelism)
    text = text.coalesce(tasks)  # no shuffle: a task reads ranges one after another, and never more tasks than ranges
    return text.select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.make_valid_utf8("value").alias("line"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.Array]]:
    """(file, start, lines) of stretches of one range, in order."""
    for b in batches:
        if not b.num_rows:
            continue
        file, start = pc.run_end_encode(b.column(0)), pc.run_end_encode(b.column(1))
        ends = sorted({*file.run_ends.to_pylist(), *start.run_ends.to_pylist()})
        for s, e in zip([0, *ends[:-1]], ends, strict=True):
            yield b.column(0)[s].as_py(), b.column(1)[s].as_py(), b.column(2).slice(s, e - s)


def _marks(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Places of the lines with a quote, and before each place how many lines are not empty."""
    quoted = np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))
    filled = pc.and_(pc.not_equal(lines, ""), pc.not_equal(lines, "\r")).to_numpy(zero_copy_only=False)
    return quoted, np.concatenate([[0], np.cumsum(filled)])


class _Scan:
    """The state (within quotes or not) and the number of records started, from one state at the start of a range on."""

    def __init__(self, within: bool) -> None:
        self.within, self.started = within, 0

    def feed(self, lines: pa.Array, quoted: np.ndarray, filled: np.ndarray) -> None:
        at = 0
        for i in quoted.tolist():
            if not self.within:
                self.started += int(filled[i + 1] - filled[at])
            self.within, at = not closes(lines[i].as_py(), self.within), i + 1
        if not self.within:
            self.started += int(filled[-1] - filled[at])


def ranges_of(lines: DataFrame) -> DataFrame:
    """(file, start, out0, out1, n0, n1): for each range, entered outside (0) or within quotes (1), how it is left and the records it starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file", "start", "out0", "out1", "n0", "n1"]
        here, scans = None, ()

        def row() -> pa.RecordBatch:
            values = [*here, *(s.within for s in scans), *(s.started for s in scans)]
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names)

        for file, start, lines in _runs(batches):
            if here != (file, start):
                if here:
                    yield row()
                here, scans = (file, start), (_Scan(False), _Scan(True))
            marks = _marks(lines)
            for s in scans:
                s.feed(lines, *marks)
        if here:
            yield row()

    return lines.mapInArrow(run, "file string, start long, out0 boolean, out1 boolean, n0 long, n1 long")


def entered(ranges: DataFrame) -> DataFrame:
    """(file, start, within, left, first): how each range is entered and left, and the number of its first record; one row of each range goes by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, within, first = None, False, 0
        for b in batches:
            out = []
            for r in b.to_pylist():
                if r["file"] != file:
                    file, within, first = r["file"], False, 0
                k = int(within)
                out.append((file, r["start"], within, r[f"out{k}"], first))
                within, first = r[f"out{k}"], first + r[f"n{k}"]
            cols = list(zip(*out, strict=True)) or [[]] * 5
            kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["file", "start", "within", "left", "first"])

    placed = ranges.repartition("file").sortWithinPartitions("file", "start")
    return placed.mapInArrow(run, "file string, start long, within boolean, left boolean, first long")


def _cut(lines: DataFrame, states: DataFrame | None, whole: bool) -> DataFrame:
    """(file, start, row, text): the records that lie in one range, or the pieces of those that do not.

    lines: (file, start, line, within, first), or without the last two, if states holds them and is broadcast.
    """
    known = None
    if states is not None:
        known = lines.sparkSession.sparkContext.broadcast({(r["file"], r["start"]): (r["within"], r["first"]) for r in states.collect()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []  # lines of the record that is open
        here, within, piece, row = None, False, False, 0
        out: list[tuple] = []

        def pack() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) or [[]] * 4
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["file", "start", "row", "text"])

        def leave() -> None:
            if held and not whole:
                out.append((*here, row - 1, "\n".join(held)))
            held.clear()

        def source() -> Iterator[tuple]:
            if known is not None:
                for file, start, lines in _runs(batches):
                    yield file, start, lines, *known.value[file, start]
            else:
                for b in batches:
                    at = 0
                    for file, start, lines in _runs([b]):
                        yield file, start, lines, b.column(3)[at].as_py(), b.column(4)[at].as_py()
                        at += len(lines)

        for file, start, lines, entry, first in source():
            if here != (file, start):
                leave()
                here, within, piece, row = (file, start), entry, entry, first
            quoted = set(_marks(lines)[0].tolist())
            for i, line in enumerate(lines.to_pylist()):
                if not within:
                    if line in ("", "\r"):
                        continue
                    row += 1
                    within = i in quoted and not closes(line, False)
                    if within:
                        held.append(line)
                    elif whole:
                        out.append((file, start, row - 1, line))
                else:
                    held.append(line)
                    within = not (i in quoted and closes(line, True))
                    if not within:
                        if piece != whole:
                            out.append((file, start, row - 1, "\n".join(held)))
                        held.clear()
                        piece = False
                if len(out) >= 4096:
                    yield pack()
        leave()
        yield pack()

    return lines.mapInArrow(run, "file string, start long, row long, text string")


def records(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES, max_ranges: int = MAX_RANGES) -> DataFrame:
    """(file, row, text): every record, header included, and its number in its file from 0 on."""
    lines = lines_of(spark, path, split_bytes)
    states = staged(entered(ranges_of(lines)), "ranges")
    across = states.filter("within OR left").select("file", "start")
    if states.count() <= max_ranges:
        whole = _cut(lines, states, True)
        # Only ranges with an open boundary are read for pieces.
        parts = _cut(lines.join(F.broadcast(across), ["file", "start"], "left_semi").select("file", "start", "line"), states, False)
    else:  # states are joined to the lines, which are put back in their order
        placed = lines.withColumn("_at", F.monotonically_increasing_id()).join(states.drop("left"), ["file", "start"])
        placed = placed.repartition("file", "start").sortWithinPartitions("file", "start", "_at").select("file", "start", "line", "within", "first")
        whole, parts = _cut(placed, None, True), _cut(placed, None, False)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "text"))), lambda x: x["text"]), "\n")
    stitched = parts.groupBy("file", "row").agg(joined.alias("text"))
    every = whole.select("file", "row", "text").unionByName(stitched)
    return every.withColumn("text", F.regexp_replace("text", r"\r\z", ""))


def header(spark: SparkSession, path: str) -> list[str]:
    """The names in the first record of the first file; nameless columns get numbers, repeated names too."""
    files = sorted(lines_of(spark, path, SPLIT_BYTES).inputFiles(), key=lambda f: f.rsplit("/", 1)[-1])
    held: list[str] = []
    if files:
        for r in lines_of(spark, unquote(files[0]), SPLIT_BYTES).filter("start = 0").limit(1000).collect():
            if not held and r["line"] in ("", "\r"):
                continue
            within = bool(held)
            held.append(r["line"])
            if closes(r["line"], within):
                break
    names = next(csv.reader([x + "\n" for x in "\n".join(held).removesuffix("\r").split("\n")]), []) if held else []
    names = [n.removeprefix("\ufeff") or f"_c{i}" for i, n in enumerate(names)]
    return [n if names.index(n) == i else f"{n}{i}" for i, n in enumerate(names)]


def read_csv(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES, max_ranges: int = MAX_RANGES) -> DataFrame:
    """The fields as text, by the header's names, and pos (file, row): the place of the record, from 0 on, the header not counted.
    A column of the file's that is named pos, in any case, is named pos_."""
    names = [f"{n}_" if n.lower() == "pos" else n for n in header(spark, path)]
    pos = F.struct("file", (F.col("row") - 1).alias("row")).alias("pos")
    found = records(spark, path, split_bytes, max_ranges).filter("row > 0")
    if not names:
        return found.select(pos).limit(0)
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    fields = F.from_csv("text", schema, {"escape": '"', "multiLine": "true", "maxCharsPerColumn": "-1"})
    return found.select(fields.alias("_f"), pos).select("_f.*", "pos")
