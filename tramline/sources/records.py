"""CSV whose texts span lines, read by many tasks.

Spark's reader needs a whole file in one task to know which line breaks are inside quotes.
Here lines are read in splits, and a stretch of lines is taken as a function from the
quote state before it (outside or inside a quoted text) to the state after it. Each task
makes chunks of lines with both possible states; the functions of its whole blocks are
composed file by file in a prefix scan, one small row a block, which tells every block its
true state. Chunks are then cut into records; the pieces of a record that goes on in the
next chunk meet in a shuffle of their own, and Spark's CSV parser reads the records.
"""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tramline.session import materialise

CHUNK_CHARS = 1 << 20
QUOTE = '"'
_MARK = "﻿"

_CHUNKS = "file string, block long, chunk long, text string, out_before boolean, in_before boolean, out_after boolean, in_after boolean, in_leaves boolean"


def ends_inside(line: str, inside: bool, sep: str) -> bool:
    """Whether a line ends inside quotes. They open at the start of a field only, close at
    a quote that is not doubled; what follows up to the separator belongs to the field."""
    at = 0
    while True:
        if not inside:
            if not line.startswith(QUOTE, at):
                at = line.find(sep, at)
                if at < 0:
                    return False
                at += len(sep)
                continue
            at += 1
        at = line.find(QUOTE, at)
        if at < 0:
            return True
        if line.startswith(QUOTE, at + 1):
            at, inside = at + 2, True
            continue
        at = line.find(sep, at + 1)
        if at < 0:
            return False
        at, inside = at + len(sep), False


def chunks(lines, sep: str, chunk_chars: int) -> Iterator[tuple]:
    """Chunks of (file, block, line) rows in order, by the columns of _CHUNKS.

    `before` and `after` are states for a block that starts outside and one that starts
    inside; `in_leaves`: whether a chunk that starts inside has a line that ends outside.
    """
    key, number, held, size = None, 0, [], 0
    state = before = (False, True)
    single, leaves = (False, True), False

    def chunk():
        return *key, number, "\n".join(held), *before, *state, leaves

    for file, block, line in lines:
        if key != (file, block) or size >= chunk_chars:
            if held:
                yield chunk()
            same = key == (file, block)
            number = number + 1 if same else 0
            key, held, size, leaves = (file, block), [], 0, False
            state = state if same else (False, True)
            before, single = state, (False, True)
        line = line or ""
        held.append(line)
        size += len(line) + 1
        if QUOTE in line:
            moved = {s: ends_inside(line, s, sep) for s in {*state, *single}}
            state, single = tuple(moved[s] for s in state), tuple(moved[s] for s in single)
        leaves = leaves or not single[1]
    if held:
        yield chunk()


def _arrow(rows, schema: pa.Schema, size_of, most: int = 8 << 20):
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += size_of(row)
        if size >= most or len(held) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _values(stream, *columns: str):
    for batch in stream:
        yield from zip(*(batch.column(c).to_pylist() for c in columns))


def _chunked(spark: SparkSession, path, sep: str, chunk_chars: int) -> DataFrame:
    flags = [(n, pa.bool_()) for n in ("out_before", "in_before", "out_after", "in_after", "in_leaves")]
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("chunk", pa.int64()), ("text", pa.large_string()), *flags])

    def run(stream):
        rows = chunks(_values(stream, "file", "block", "value"), sep, chunk_chars)
        yield from _arrow(rows, schema, lambda r: len(r[3]))

    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )
    return materialise(lines.mapInArrow(run, _CHUNKS), "csv-chunks")


def scanned(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Adds `inside`: the state before each row where the first one starts outside.

    A row's function (out_after, in_after) is constant, swaps the states or keeps them, so
    the state follows from the last constant before and the swaps since.
    """
    before = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    constant = F.col("out_after") == F.col("in_after")
    swap = (F.col("out_after") & ~F.col("in_after")).cast("int")
    counted = rows.withColumn("_swaps", F.coalesce(F.sum(swap).over(before), F.lit(0)))
    last = F.when(constant, F.struct(F.col("out_after").alias("state"), F.col("_swaps").alias("swaps")))
    held = counted.withColumn("_last", F.last(last, ignorenulls=True).over(before))
    since = F.col("_swaps") - F.coalesce("_last.swaps", F.lit(0))
    odd = since % 2 == 1
    inside = F.coalesce("_last.state", F.lit(False)) != odd
    return held.withColumn("inside", inside).drop("_swaps", "_last")


def _states(chunked: DataFrame) -> DataFrame:
    """(file, block, inside, owner): each block's state, and the chunk before it that has
    the start of a record it goes on with, as struct (block, chunk)."""
    last = lambda c: F.max_by(c, "chunk").alias(c)
    # A chunk that starts inside and never leaves belongs to an earlier one whole.
    starts = {s: F.max(F.when(~(F.col(f"{s}_before") & ~F.col("in_leaves")), F.col("chunk"))) for s in ("out", "in")}
    blocks = chunked.groupBy("file", "block").agg(
        last("out_after"), last("in_after"), starts["out"].alias("out_start"), starts["in"].alias("in_start")
    )
    known = scanned(blocks, "file", "block")
    start = F.when(F.col("inside"), F.col("in_start")).otherwise(F.col("out_start"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    owner = F.last(F.when(start.isNotNull(), F.struct("block", start.alias("chunk"))), ignorenulls=True).over(before)
    return known.select("file", "block", "inside", owner.alias("owner"))


def pieces(text: str, inside: bool, sep: str) -> Iterator[tuple[str, str]]:
    """(kind, text): whole records, the `end` of an earlier one, the `start` of one that goes on."""
    held, kind = [], "end" if inside else "whole"
    for line in text.split("\n"):
        held.append(line)
        inside = ends_inside(line, inside, sep) if QUOTE in line else inside
        if not inside:
            yield kind, "\n".join(held)
            held, kind = [], "whole"
    if held:
        yield "end" if kind == "end" else "start", "\n".join(held)


def csv_records(spark: SparkSession, path, sep: str = ",", chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """(value, first): the records of CSV files; `first` marks the first of each file."""
    chunked = _chunked(spark, path, sep, chunk_chars)
    states = materialise(_states(chunked), "csv-states")
    schema = pa.schema(
        [("kind", pa.string()), ("file", pa.string()), ("block", pa.int64()), ("chunk", pa.int64())]
        + [("place", pa.struct([("block", pa.int64()), ("chunk", pa.int64())])), ("value", pa.large_string()), ("first", pa.bool_())]
    )

    def cut(rows):
        for file, block, chunk, text, inside, owner in rows:
            fresh = block == 0 and chunk == 0
            for kind, value in pieces(text.removeprefix(_MARK) if fresh else text, inside, sep):
                owns = owner if kind == "end" else {"block": block, "chunk": chunk}
                first = fresh and value.strip("\r") != ""
                fresh = fresh and not first
                yield kind, file, owns["block"], owns["chunk"], {"block": block, "chunk": chunk}, value, first

    def run(stream):
        rows = cut(_values(stream, "file", "block", "chunk", "text", "now", "owns"))
        yield from _arrow(rows, schema, lambda r: len(r[5]) + 64)

    now: Column = F.when(F.col("inside"), F.col("in_before")).otherwise(F.col("out_before"))
    # Within a block the owner is the last chunk before that is not inside one record.
    whole = now & ~F.col("in_leaves")
    order = Window.partitionBy("file", "block").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    marks = chunked.drop("text").join(states, ["file", "block"])
    own = F.last(F.when(~whole, F.struct("block", "chunk")), ignorenulls=True).over(order)
    marks = marks.select("file", "block", "chunk", now.alias("now"), F.coalesce(own, "owner").alias("owns"))
    joined = chunked.select("file", "block", "chunk", "text").join(marks, ["file", "block", "chunk"])
    out = "kind string, file string, block long, chunk long, place struct<block:long,chunk:long>, value string, first boolean"
    found = materialise(joined.mapInArrow(run, out), "csv-records")
    parts = found.filter("kind <> 'whole'").groupBy("file", "block", "chunk").agg(
        F.array_sort(F.collect_list(F.struct("place", "value"))).alias("parts"), F.max("first").alias("first")
    )
    joint = parts.select(F.array_join("parts.value", "\n").alias("value"), "first")
    return found.filter("kind = 'whole'").select("value", "first").unionByName(joint)


def read_multiline_csv(
    spark: SparkSession, path, schema: StructType | None = None, sep: str = ",", chunk_chars: int = CHUNK_CHARS
) -> DataFrame:
    """CSV files with a header each, as Spark's multi-line reader gives them."""
    options = {"sep": sep, "escape": QUOTE, "encoding": "UTF-8"}
    names = spark.read.options(header=True, multiLine=True, **options).csv(path).columns  # reads one record
    records = csv_records(spark, path, sep, chunk_chars).filter("NOT first")
    value = F.regexp_replace("value", "\r(\n|$)", "$1").alias("value")  # line ends as that reader gives them
    texts = getattr(records.select(value)._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    reader = spark.read.options(header=False, **options)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    rows = DataFrame(reader._jreader.csv(texts), spark)
    return rows if schema else rows.toDF(*names[: len(rows.columns)])
