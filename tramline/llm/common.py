"""Helpers shared by the corpus operators."""

import ctypes
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tramline

# Arrow batches made here are closed at about this many bytes.
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application.

    Their Python workers then find it wherever the driver was started from.
    """
    context, package = spark.sparkContext, Path(tramline.__file__).parent
    if getattr(context, "_tramline_shipped", False) or not package.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="tramline-")) / "tramline_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._tramline_shipped = True


_held: dict = {}


def held(purpose: str, key, make):
    """What `make()` gave for a key, kept by the Python worker until something else is.

    Workers outlive tasks and serve one operator after another: only the latest large
    object (a tokenizer, a store of scores) stays in memory.
    """
    if (purpose, key) not in _held:
        _held.clear()
        pa.default_memory_pool().release_unused()
        _held[purpose, key] = make()
    return _held[purpose, key]


def release() -> None:
    """Lets go of what `held` keeps; for tasks that need the memory otherwise."""
    _held.clear()
    pa.default_memory_pool().release_unused()
    # Where the C library can, what was freed goes back to the system: workers outlive their tasks.
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def quoted(column: str) -> str:
    """A column's name as SQL reads it, whatever characters it has."""
    return "`" + column.replace("`", "``") + "`"


def row_key(*columns: str) -> F.Column:
    """A key equal for equal rows only; recomputed rows keep it."""
    return F.md5(F.to_json(F.struct(*columns)).cast("binary"))


def batches(rows, schema: pa.Schema, size_of) -> Iterator[pa.RecordBatch]:
    """Arrow batches of tuples, closed by size: `size_of(row)` in bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += size_of(row)
        if size >= BATCH_BYTES or len(held) >= 10_000:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows, schema):
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def records(stream, *columns: str) -> Iterator[tuple]:
    """The rows of Arrow batches as Python values, a thousand at a time."""
    for batch in stream:
        for start in range(0, batch.num_rows, 1000):
            part = batch.slice(start, 1000)
            yield from zip(*(part.column(c).to_pylist() for c in columns), strict=True)


def file_bytes(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def fold(column: str, folds: int) -> F.Column:
    """crc32 of the id as text, modulo `folds`: the split the labels are learned under."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    rows: int,
    seed: int,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(id, text, y) of at most `rows` labelled documents of each class, by hashed id."""
    known = labels.filter(F.col(label).isin(0, 1)).select(F.col(id_column).alias("id"), F.col(label).cast("int").alias("y"))
    rank = F.xxhash64("id", F.lit(seed))
    picked = [known.filter(F.col("y") == y).dropDuplicates(["id"]).orderBy(rank, "id").limit(rows) for y in (0, 1)]
    ids = F.broadcast(picked[0].unionByName(picked[1]))  # at most 2 * rows rows
    texts = docs.select(F.col(id_column).alias("id"), F.coalesce(text_column, F.lit("")).alias("text"))
    return texts.join(ids, "id").select("id", "text", "y")


def scored(docs: DataFrame, one_task, text_column: str, keep: list[str], name: str = "score") -> DataFrame:
    """The columns `keep` and a score; `one_task()` gives each task its function from texts to scores."""
    ship(docs.sparkSession)
    types = dict(docs.dtypes)

    def run(stream):
        release()
        scores = one_task()
        for batch in stream:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                texts = [t or "" for t in part.column(part.num_columns - 1).to_pylist()]
                values = pa.array(scores(texts), pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], values], [*keep, name])

    texts = docs.select(*keep, F.col(text_column).alias("_text"))
    return texts.mapInArrow(run, ", ".join(f"`{c}` {types[c]}" for c in keep) + f", `{name}` double")
