"""Records of large files whose line breaks do not end a record.

Spark cuts a text file into byte ranges at a separator. Whether a range begins inside quotes, or how deep in
brackets, depends on all ranges before it, but on little of each: a range is summed up in a few numbers, and a running sum over
the ranges of a file (one small row per range) gives the state in which each one begins. With it, every task cuts its range into
records on its own. Only the record that crosses the end of a range is put together from the pieces of its neighbours.
"""

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from precedent.session import ship_package

PIECES = "file string, start long, at long, begins boolean, ends boolean, text string"
RANGE = ("file", "start")

# (state at the begin of a range) -> cutter; a cutter takes the pieces in order and yields records as (begins, ends, text).
Cutter = Callable[[tuple[int, int]], "CsvCutter | JsonCutter"]


def ranges(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """(file, start, value): the pieces between separators, in order inside a range."""
    return spark.read.option("lineSep", separator).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"
    )


def _cut(pieces: DataFrame, states: dict[tuple[str, int], tuple[int, int]], cutter: Cutter) -> DataFrame:
    """Records and the pieces of records, each with its place in the range."""
    shared = pieces.sparkSession.sparkContext.broadcast(states)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own, at = None, None, 0

        def table(rows: list) -> pa.RecordBatch:
            nonlocal at
            found = pa.RecordBatch.from_pylist(
                [
                    {"file": key[0], "start": key[1], "at": at + i, "begins": b, "ends": e, "text": t}
                    for i, (b, e, t) in enumerate(rows)
                ],
                schema=pa.schema([("file", pa.string()), ("start", pa.int64()), ("at", pa.int64()),
                                  ("begins", pa.bool_()), ("ends", pa.bool_()), ("text", pa.string())]),
            )
            at += len(rows)
            return found

        for batch in batches:
            rows = []
            for file, start, value in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "value"))):
                if (file, start) != key:
                    if key is not None:
                        yield table([*rows, *own.rest()])
                        rows = []
                    key, at = (file, start), 0
                    own = cutter(shared.value[key])
                rows += own.add(value)
            if rows:
                yield table(rows)
        if key is not None:
            yield table(list(own.rest()))

    ship_package(pieces.sparkSession)
    return pieces.mapInArrow(run, PIECES)


def _join_pieces(cut: DataFrame, glue: str) -> DataFrame:
    """(file, start, at, text) of whole records; pieces of one record, a few per range, meet by the range it begins in."""
    whole = cut.where("begins and ends").select("file", "start", "at", "text")
    parts = cut.where("not (begins and ends)")
    along = Window.partitionBy("file").orderBy("start", "at")
    numbered = parts.withColumn("record", F.sum(F.col("begins").cast("long")).over(along))
    joined = numbered.groupBy("file", "record").agg(
        F.min(F.struct("start", "at")).alias("first"),
        F.array_sort(F.collect_list(F.struct("start", "at", "text"))).alias("parts"),
    )
    text = F.array_join(F.col("parts.text"), glue)
    return whole.unionByName(joined.select("file", "first.start", "first.at", text.alias("text")))


# -- quoted CSV -------------------------------------------------------------


class CsvCutter:
    """Lines to records: a line that begins outside quotes begins a record."""

    def __init__(self, state: tuple[int, int]):
        self.open, self.begins, self.lines = bool(state[0]), not state[0], []

    def add(self, line: str) -> Iterator[tuple[bool, bool, str]]:
        self.lines.append(line)
        self.open ^= bool(line.count('"') % 2)
        if not self.open:
            yield self.begins, True, "\n".join(self.lines)
            self.begins, self.lines = True, []

    def rest(self) -> Iterator[tuple[bool, bool, str]]:
        if self.lines:
            yield self.begins, False, "\n".join(self.lines)


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, at, text): the records of CSV files in which quotes may hold line breaks."""
    lines = ranges(spark, path, "\n")
    quotes = F.sum(F.length("value") - F.length(F.translate("value", '"', "")))
    parity = lines.groupBy(*RANGE).agg((quotes % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    opened = parity.select(*RANGE, (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).alias("open"))
    # One short row per byte range; the driver holds a task for each of them anyway.
    states = {(r.file, r.start): (int(r.open), 0) for r in opened.toLocalIterator()}
    records = _join_pieces(_cut(lines, states, CsvCutter), "\n")
    # The carriage return of a line end stands outside quotes.
    return records.withColumn("text", F.regexp_replace("text", "\r$", "")).where("text <> ''")


# -- one JSON array ---------------------------------------------------------

ESCAPE = re.compile(r"\\.", re.DOTALL)
#: A closed string, or what is left of one that the piece does not close.
STRING = re.compile(r'"(?:[^"\\]|\\.)*(?:"|\\?$)', re.DOTALL)


def quote_parity(piece: str) -> int:
    """Whether a piece changes the state of being in a string. Pieces end before a brace, so never inside an escape."""
    return ESCAPE.sub("", piece).count('"') % 2


def outside(piece: str, in_string: int) -> str:
    """The piece without its strings. ``in_string``: it begins inside one."""
    return STRING.sub("", '"' + piece if in_string else piece)


def depth_change(piece: str, in_string: int) -> int:
    """Brackets opened less those closed in a piece, with the brace that ends it."""
    bare = outside(piece, in_string)
    closes = (in_string + quote_parity(piece)) % 2 == 0
    return bare.count("{") + bare.count("[") - bare.count("]") - closes


class JsonCutter:
    """Pieces between closing braces to the objects of the outermost array."""

    def __init__(self, state: tuple[int, int]):
        self.in_string, self.depth = state
        self.begins, self.pieces = self.depth < 2 and not self.in_string, []

    def add(self, piece: str) -> Iterator[tuple[bool, bool, str]]:
        self.pieces.append(piece)
        self.depth += depth_change(piece, self.in_string)
        self.in_string ^= quote_parity(piece)
        if self.depth <= 1 and not self.in_string:
            yield self.begins, True, "}".join(self.pieces)
            self.begins, self.pieces = True, []

    def rest(self) -> Iterator[tuple[bool, bool, str]]:
        if self.pieces:
            yield self.begins, False, "}".join(self.pieces)


def _json_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(quote_parity(v), depth_change(v, 0), depth_change(v, 1)) for v in batch.column("value").to_pylist()]
        parity, plain, inside = ([r[k] for r in rows] for k in range(3))
        columns = [batch.column("file"), batch.column("start"), *(pa.array(x, pa.int64()) for x in (parity, plain, inside))]
        yield pa.RecordBatch.from_arrays(columns, names=["file", "start", "odd", "plain", "inside"])


def _range_sums(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range in a task: parity, and the change of depth for either state at its begin."""
    totals: dict[tuple[str, int], list[int]] = {}
    for batch in _json_sums(rows):
        for file, start, odd, plain, inside in zip(*(c.to_pylist() for c in batch.columns)):
            own = totals.setdefault((file, start), [0, 0, 0])
            own[1] += inside if own[0] else plain
            own[2] += plain if own[0] else inside
            own[0] ^= odd
    found = [(*key, *own) for key, own in totals.items()]
    names = ["file", "start", "odd", "plain", "inside"]
    types = [pa.string(), *[pa.int64()] * 4]
    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], t) for k, t in enumerate(types)], names=names)


def json_elements(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, at, text): the pieces of files that hold one array of objects, with what separates these.

    A text is a separator and an object without its last brace, or the end of the array.
    """
    pieces = ranges(spark, path, "}")
    ship_package(spark)
    sums = pieces.mapInArrow(_range_sums, "file string, start long, odd long, plain long, inside long")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    begun = sums.withColumn("in_string", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    change = F.when(F.col("in_string") == 1, F.col("inside")).otherwise(F.col("plain"))
    begun = begun.withColumn("change", change)
    begun = begun.withColumn("depth", F.coalesce(F.sum("change").over(before), F.lit(0)))
    # One short row per byte range.
    states = {(r.file, r.start): (int(r.in_string), int(r.depth)) for r in begun.toLocalIterator()}
    return _join_pieces(_cut(pieces, states, JsonCutter), "}")
