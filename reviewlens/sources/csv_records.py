"""Records of quoted CSV files, cut in parallel whatever line breaks their texts hold.

Spark splits a file into byte ranges and each range into lines, but a line break inside quotes ends no
record. Whether a range begins inside quotes depends on all quotes before it, and only on whether
their number is odd. So the quotes of every range are counted, a running sum over a file's ranges gives each one
its state at the start, and with it every range is cut into records by its own task. A record that
goes on in the next range is left in pieces, at most two for a range, which are put together by
file and place.

Files follow RFC 4180: lines end in ``\\n`` or ``\\r\\n``, the same in a record and in its texts, and a quote
occurs in quoted fields only, where it is doubled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewlens.session import settle

QUOTE = '"'
# What a row holds: a record, or of one that crosses ranges its end, its beginning, or all of a range inside it.
RECORD, END, BEGINNING, INSIDE = range(4)
SCHEMA = "record string, kind int, is_header boolean, file string, start bigint"
RANGE = ["file", "start", "length"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``value, file, start, length``: lines in order within a byte range, and the range."""
    place = F.col("_metadata")
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", place["file_path"].alias("file"),
        place["file_block_start"].alias("start"), place["file_block_length"].alias("length"),
    )


def quoted_ranges(lines: DataFrame) -> DataFrame:
    """``file, start, length, quoted``: whether a range begins inside quotes."""
    quotes = F.sum(F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit(""))))
    counted = settle(lines.groupBy(*RANGE).agg((quotes % 2).alias("odd")), "csv-quotes")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return counted.select(*RANGE, (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("quoted"))


class RangeCutter:
    """Cuts one range, as its lines come, into records and the pieces at its two ends."""

    def __init__(self, file: str, start: int, quoted: bool):
        self.file, self.start, self.quoted = file, start, quoted
        self.held: list[str] = []
        self.continues = quoted  # the record at hand began in an earlier range
        self.header = start == 0

    def feed(self, lines: pa.Array) -> Iterator[tuple]:
        quotes = np.cumsum(np.asarray(pc.count_substring(lines, QUOTE)))
        ends = np.flatnonzero((quotes + self.quoted) % 2 == 0)
        self.quoted = bool((quotes[-1] + self.quoted) % 2)
        if not len(ends):
            self.held += lines.to_pylist()
            return
        first, rest = int(ends[0]) + 1, ends[1:]
        yield from self._close(END if self.continues else RECORD, lines.slice(0, first).to_pylist())
        if len(rest):
            inner = lines.slice(first, int(ends[-1]) + 1 - first)
            offsets = pa.array(np.concatenate(([0], rest + 1 - first)), pa.int32())
            whole = pc.binary_join(pa.ListArray.from_arrays(offsets, inner), "\n")
            for record in whole.to_pylist():
                yield record, RECORD, False, None, None
        self.held = lines.slice(int(ends[-1]) + 1).to_pylist()

    def finish(self) -> Iterator[tuple]:
        if self.held:
            yield from self._close(INSIDE if self.continues else BEGINNING, [])

    def _close(self, kind: int, lines: list[str]) -> Iterator[tuple]:
        text = "\n".join(self.held + lines)
        place = (None, None) if kind == RECORD else (self.file, self.start)
        yield text, kind, self.header and not self.continues, *place
        self.header = self.header and self.continues
        self.held, self.continues = [], False


def _cut(lines: DataFrame, known: dict[str, dict[int, tuple[int, bool]]], ends: bool) -> DataFrame:
    """The rows of ``SCHEMA`` of every range: its records, or what is at its ``ends``, pieces and headers."""
    given = lines.sparkSession.sparkContext.broadcast(known)
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    kinds = (pa.string(), pa.int32(), pa.bool_(), pa.string(), pa.int64())

    def batch(rows: Iterable[tuple]) -> pa.RecordBatch:
        rows = [r for r in rows if (r[1] != RECORD or r[2]) == ends]
        columns = list(zip(*rows)) or [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    def open_range(file: str, start: int, length: int) -> RangeCutter:
        told = given.value.get(file, {}).get(start)
        if told is None or told[0] != length:
            raise RuntimeError(f"the byte ranges of {file} have changed since its quotes were counted; read it again")
        return RangeCutter(file, start, told[1])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = None
        for lines in batches:
            if not lines.num_rows:
                continue
            starts, files = np.asarray(lines.column("start")), lines.column("file").dictionary_encode()
            codes = np.asarray(files.indices)
            fresh = np.flatnonzero((np.diff(starts) != 0) | (np.diff(codes) != 0)) + 1
            for a, b in zip([0, *fresh.tolist()], [*fresh.tolist(), lines.num_rows]):
                own = files.dictionary[int(codes[a])].as_py(), int(starts[a])
                if cutter is None or own != (cutter.file, cutter.start):
                    if cutter is not None:
                        yield batch(cutter.finish())
                    cutter = open_range(*own, lines.column("length")[a].as_py())
                yield batch(cutter.feed(lines.column("value").slice(a, b - a)))
        if cutter is not None:
            yield batch(cutter.finish())

    return lines.mapInArrow(run, SCHEMA)


def _joined(pieces: DataFrame) -> DataFrame:
    """``record, is_header`` from settled pieces: each beginning with all that follows up to the next one."""
    begins = (F.col("kind") == BEGINNING).cast("int")
    order = Window.partitionBy("file").orderBy("start", begins)  # two narrow rows a range
    number = F.sum(begins).over(order.rowsBetween(Window.unboundedPreceding, 0))
    numbered = settle(pieces.select("file", "start", "kind", number.alias("number")), "csv-crossing")
    parts = F.sort_array(F.collect_list(F.struct("start", "record")))
    return (
        pieces.join(numbered, ["file", "start", "kind"])
        .groupBy("file", "number")
        .agg(F.array_join(F.transform(parts, lambda p: p["record"]), "\n").alias("record"), F.max("is_header").alias("is_header"))
        .select("record", "is_header")
    )


def _bare(found: DataFrame) -> DataFrame:
    """Records without the return that ends them, and none that is empty."""
    # where records end in a return, so do the lines in their texts
    own = F.replace(F.rtrim("record", F.lit("\r")), F.lit("\r\n"), F.lit("\n"))
    bare = F.when(F.endswith("record", F.lit("\r")), own).otherwise(F.col("record"))
    return found.select(bare.alias("record")).where("record <> ''")


def records(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``record`` of the files under ``path``: their headers, the different ones only, and all else.

    What the driver holds and sends out is one number for each byte range.
    """
    lines = _lines(spark, path)
    known: dict[str, dict[int, tuple[int, bool]]] = {}
    for row in quoted_ranges(lines).toLocalIterator():
        known.setdefault(row["file"], {})[row["start"]] = (row["length"], row["quoted"])
    ends = settle(_cut(lines, known, True), "csv-ends")
    crossing = settle(_joined(ends.where(F.col("kind") != RECORD)), "csv-joined")
    headers = ends.where(F.col("kind") == RECORD).select("record", "is_header").union(crossing).where("is_header")
    inside = _cut(lines, known, False).select("record", "is_header")
    return _bare(headers).distinct(), _bare(inside.union(crossing.where("NOT is_header")))
