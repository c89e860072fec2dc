"""Benchmark items inside documents, by MinHash signatures sized to the item.

Containment is the share of an item's distinct shingles (SHINGLE words in lower case,
letters and digits only) that a document has. Items are partitioned by size: class c has
2 ** c to 2 ** (c + 1) - 1 shingles. An item's signature is the smallest MinHash values
of its shingles, one more than the largest item of its class may miss at the threshold,
so a document with enough containment always has one of them. Documents are probed with
all their shingles, whatever their length; candidate pairs are verified by the exact
containment of whole shingles.

The signatures and candidates are written first, so that Spark joins them by broadcast
while their files are below its threshold and by a sort-merge join beyond it.

All steps are DataFrame operations. Defined results: null and short texts (documents or
items of fewer than SHINGLE words) contain nothing and are contained in nothing; repeated
items count once, also under a null id; rows with one document id, null included, are one
document: an item in one of them takes all; repeated documents stay; other columns stay.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import quoted
from tramline.session import materialise

SHINGLE = 5
LEAST_CONTAINMENT = 0.8


def _worded(rows: DataFrame, id_column: str, text_column: str, name: str) -> DataFrame:
    """(name, words) of rows with a shingle at least."""
    words = F.regexp_extract_all(F.lower(quoted(text_column)), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    # The explode keeps the optimizer from extracting the words once per shingle.
    once = rows.select(F.col(quoted(id_column)).alias(name), F.explode(F.array(words)).alias("words"))
    return once.filter(F.size("words") >= SHINGLE)


def _starts() -> F.Column:
    return F.sequence(F.lit(0), F.size("words") - SHINGLE)


def _hashes() -> F.Column:
    return F.transform(_starts(), lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(SHINGLE)]))


def _shingles() -> F.Column:
    return F.array_distinct(F.transform(_starts(), lambda i: F.array_join(F.slice("words", i + 1, SHINGLE), " ")))


def contained(
    docs: DataFrame,
    items: DataFrame,
    least: float = LEAST_CONTAINMENT,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
) -> DataFrame:
    """(doc, item, shared, shingles) of every document and item with enough containment."""
    known = materialise(_worded(items, item_column, text_column, "item").distinct(), "benchmark-items")
    hashes = F.array_distinct(_hashes())
    sized = known.select("item", hashes.alias("h")).withColumn("class", F.floor(F.log2(F.size("h").cast("double"))))
    largest = F.pow(F.lit(2.0), F.col("class") + 1) - 1
    depth = (F.floor((1 - least) * largest + 1e-9) + 1).cast("int")
    signatures = materialise(
        sized.select("item", F.explode(F.slice(F.sort_array("h"), F.lit(1), depth)).alias("h")), "item-signatures"
    )
    probes = _worded(docs, id_column, text_column, "doc").select("doc", F.explode(_hashes()).alias("h"))
    candidates = materialise(probes.join(signatures, "h").select("doc", "item").distinct(), "leak-candidates")
    theirs = known.select(F.col("item").alias("known_item"), _shingles().alias("theirs"))
    wanted = candidates.join(theirs, F.col("item").eqNullSafe(F.col("known_item")))
    hit = candidates.select(F.col("doc").alias("hit")).distinct()
    texts = _worded(docs, id_column, text_column, "own").join(hit, F.col("own").eqNullSafe(F.col("hit")), "left_semi")
    ours = texts.select("own", _shingles().alias("ours"))
    sizes = wanted.join(ours, F.col("doc").eqNullSafe(F.col("own"))).select(
        "doc",
        "item",
        F.size(F.array_intersect("ours", "theirs")).alias("shared"),
        F.size("theirs").alias("shingles"),
    )
    return sizes.filter(F.col("shared") >= least * F.col("shingles")).distinct()


def decontaminate(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", **columns) -> DataFrame:
    """The documents that contain no item."""
    found = contained(docs, items, id_column=id_column, **columns)
    # Names of their own, since `docs` may have any.
    named = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    own, hit = F.col(f"c{docs.columns.index(id_column)}"), found.select(F.col("doc").alias("hit")).distinct()
    return named.join(hit, own.eqNullSafe(F.col("hit")), "left_anti").toDF(*docs.columns)
