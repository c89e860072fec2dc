"""Naive Bayes over folds and smoothings from one set of sums.

A multinomial model is made of sums, and a fold's model (trained on all other folds) has
the sums of all rows less the fold's own. So one aggregation over the rows trains the
models of every fold and smoothing, and a second pass scores each row by the models of
its fold. The sums are as many as folds x classes x features, whatever the rows.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline import fixed_values as fv
from tramline.operators.classify import FOLD, LABEL_INDEX
from tramline.session import materialise

# Stands for a feature that every row has once: its sums count a class's rows, its weight
# is the class's prior.
_ROW = -1
SMOOTHINGS = tuple(fv.TUNING_GRIDS["naive_bayes"]["smoothing"])


def entries(vector: str) -> Column:
    """(feature, value) of a vector's values other than 0, and the row's own."""
    inner = F.unwrap_udt(vector)
    sparse = F.zip_with(inner["indices"], inner["values"], lambda i, v: F.struct(i.alias("feature"), v.alias("value")))
    dense = F.transform(inner["values"], lambda v, i: F.struct(i.alias("feature"), v.alias("value")))
    listed = F.when(inner["type"] == 0, sparse).otherwise(dense)
    row = F.array(F.struct(F.lit(_ROW).alias("feature"), F.lit(1.0).alias("value")))
    return F.concat(row, F.filter(listed, lambda e: e["value"] != 0))


def statistics(rows: DataFrame) -> DataFrame:
    """(fold, class, feature, total): one pass, folded on the map side."""
    each = rows.select(FOLD, F.col(LABEL_INDEX).alias("class"), F.inline(entries("features")))
    return each.groupBy(FOLD, "class", "feature").agg(F.sum("value").alias("total"))


def _weights(sums: DataFrame, classes: list[float], folds: list[int], width: int, smoothings) -> DataFrame:
    """(fold, feature, w): the logarithm of each smoothing's and class's share, by the other folds' sums.

    A class that the other folds do not have gets no prior, so it is never chosen.
    """
    named = [(c, f"c{i}") for i, c in enumerate(classes)]
    wide = sums.groupBy(FOLD, "feature").agg(
        *[F.sum(F.when(F.col("class") == c, F.col("total")).otherwise(0.0)).alias(n) for c, n in named]
    )
    names = [n for _, n in named]
    # A feature that a fold lacks still needs that fold's model.
    every = wide.select("feature").distinct().select("feature", F.explode(F.array(*map(F.lit, folds))).alias(FOLD))
    whole = wide.groupBy("feature").agg(*[F.sum(n).alias(f"all_{n}") for n in names])
    own = every.join(wide, [FOLD, "feature"], "left").join(whole, "feature")
    other = own.select(FOLD, "feature", *[(F.col(f"all_{n}") - F.coalesce(n, F.lit(0.0))).alias(n) for n in names])
    row = F.col("feature") == _ROW
    sizes = other.groupBy(FOLD).agg(
        *[F.sum(F.when(~row, F.col(n)).otherwise(0.0)).alias(f"sum_{n}") for n in names],
        *[F.sum(F.when(row, F.col(n)).otherwise(0.0)).alias(f"rows_{n}") for n in names],
    )
    total = sum((F.col(f"rows_{n}") for n in names), F.lit(0.0))
    present = sum(((F.col(f"rows_{n}") > 0).cast("int") for n in names), F.lit(0))

    def weight(n, a):
        share = F.log(F.col(n) + a) - F.log(F.col(f"sum_{n}") + a * width)
        prior = F.when(F.col(f"rows_{n}") > 0, F.log(F.col(n) + a) - F.log(total + a * present))
        return F.when(row, F.coalesce(prior, F.lit(float("-inf")))).otherwise(share)

    listed = F.array(*[weight(n, a) for a in smoothings for n in names])
    return other.join(sizes, FOLD).select(FOLD, "feature", listed.alias("w"))


def hits(rows: DataFrame, key: str, smoothings=SMOOTHINGS) -> DataFrame:
    """(smoothing, fold, n_rows, n_hits) of each smoothing's model on each held-out fold.

    `rows` have a key, a fold, a label index and assembled features without negative values.
    Rows with a NULL label are left out; equal rows count each. Of classes that score alike
    the lowest index is chosen. No rows give none.
    """
    known = rows.filter(F.col(LABEL_INDEX).isNotNull())
    sums = materialise(statistics(known), "fold-sums")
    groups = sums.filter(F.col("feature") == _ROW).select(FOLD, "class").collect()  # folds x classes rows
    folds, classes = sorted({r[FOLD] for r in groups}), sorted({r["class"] for r in groups})
    if not groups:
        empty = "smoothing double, fold int, n_rows bigint, n_hits bigint"
        return rows.sparkSession.createDataFrame([], empty)
    width = known.select(F.coalesce(F.unwrap_udt("features")["size"], F.size(F.unwrap_udt("features")["values"]))).first()[0]
    weights = materialise(_weights(sums, classes, folds, width, smoothings), "fold-weights")
    listed = known.select(key, FOLD, F.col(LABEL_INDEX).alias("truth"), entries("features").alias("listed"))
    told = listed.withColumn("same", F.xxhash64(F.to_json("listed")))
    each = told.select(key, FOLD, "truth", "same", F.inline("listed")).join(weights, [FOLD, "feature"])
    scored = each.groupBy(key, FOLD, "truth", "same").agg(
        # Equal rows add up to a multiple of one's scores, prior included: the choice is the same.
        F.sum(F.when(F.col("feature") == _ROW, 1).otherwise(0)).alias("n"),
        *[F.sum(F.col("value") * F.get("w", F.lit(k))).alias(f"s{k}") for k in range(len(smoothings) * len(classes))],
    )

    def hit(k):
        scores = F.array(*[F.col(f"s{k * len(classes) + i}") for i in range(len(classes))])
        chosen = F.array_position(scores, F.array_max(scores))
        right = F.get(F.array(*map(F.lit, classes)), chosen.cast("int") - 1) == F.col("truth")
        return F.when(right, F.col("n")).otherwise(0)

    judged = F.inline(F.array(*[F.struct(F.lit(float(a)).alias("smoothing"), hit(k).alias("h")) for k, a in enumerate(smoothings)]))
    each = scored.select(FOLD, "n", judged)
    return each.groupBy("smoothing", FOLD).agg(F.sum("n").alias("n_rows"), F.sum("h").alias("n_hits"))


@dataclass(frozen=True)
class Choice:
    smoothing: float
    accuracies: dict[float, float]


def choose(rows: DataFrame, key: str, smoothings=SMOOTHINGS) -> Choice:
    """The smoothing of the highest mean accuracy over the folds; the first named wins a tie."""
    shares = hits(rows, key, smoothings).groupBy("smoothing").agg(F.avg(F.col("n_hits") / F.col("n_rows")).alias("accuracy"))
    found = {r.smoothing: r.accuracy for r in shares.collect()}
    if not found:
        raise ValueError("no labelled rows to choose by")
    accuracies = {float(a): found[float(a)] for a in smoothings}
    return Choice(max(accuracies, key=accuracies.get), accuracies)
