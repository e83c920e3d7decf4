"""One-hot encoding fit on the training side only (M-3).

Feature order: the numeric columns in the given order, then for every categorical
column (in order) one indicator per training category, categories sorted by code
point; names are ``column`` and ``column=category``.  A category not seen in training
encodes to all zeros.

Two forms:

* ``Encoder`` keeps the vocabulary as a small DataFrame and never materialises the
  one-hot matrix; the tree scores indicator splits straight from category counts.
* ``vector_pipeline`` builds the MLlib vector (StringIndexer ``alphabetAsc`` with
  ``handleInvalid='keep'`` + OneHotEncoder ``dropLast``: the extra bucket that 'keep'
  adds is exactly the one dropped, so unseen categories give a zero vector).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import cut_lineage


@dataclass
class Encoder:
    numeric: list
    categorical: list
    vocab: DataFrame          # cidx INT, category STRING, feature_idx LONG, feature STRING
    sizes: list               # categories per categorical column

    @property
    def width(self) -> int:
        return len(self.numeric) + sum(self.sizes)

    def names(self) -> DataFrame:
        """(feature_idx, feature) for every encoded column."""
        spark = self.vocab.sparkSession
        nums = spark.createDataFrame([(i, c) for i, c in enumerate(self.numeric)],
                                     "feature_idx long, feature string")
        return nums.unionByName(self.vocab.select("feature_idx", "feature"))

    def coordinates(self, frame: DataFrame, key: str) -> DataFrame:
        """Encoded rows in coordinate form (key, feature_idx, feature, value): every
        numeric value plus the indicators that are 1."""
        nums = frame.select(key, F.posexplode(F.array(*[F.col(c).cast("double") for c in self.numeric]))
                            .alias("feature_idx", "value"))
        nums = nums.withColumn("feature", F.element_at(F.array(*[F.lit(c) for c in self.numeric]),
                                                       F.col("feature_idx") + 1))
        cats = frame.select(key, F.posexplode(F.array(*[F.col(c).cast("string") for c in self.categorical]))
                            .alias("cidx", "category"))
        hot = cats.join(self.vocab, ["cidx", "category"]).select(key, "feature_idx", "feature",
                                                                 F.lit(1.0).alias("value"))
        return nums.select(key, F.col("feature_idx").cast("long"), "feature", "value").unionByName(hot)


def fit_encoder(train: DataFrame, numeric, categorical) -> Encoder:
    numeric, categorical = list(numeric), list(categorical)
    seen = (train.select(F.posexplode(F.array(*[F.col(c).cast("string") for c in categorical]))
                         .alias("cidx", "category"))
            .where(F.col("category").isNotNull()).distinct())
    sizes_by = {r["cidx"]: r["n"] for r in seen.groupBy("cidx").agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = [sizes_by.get(i, 0) for i in range(len(categorical))]
    offsets, start = [], len(numeric)
    for size in sizes:
        offsets.append(start)
        start += size
    rank = F.row_number().over(Window.partitionBy("cidx").orderBy("category")) - 1
    offset = F.element_at(F.array(*[F.lit(o) for o in offsets]), F.col("cidx") + 1)
    names = F.element_at(F.array(*[F.lit(c) for c in categorical]), F.col("cidx") + 1)
    vocab = seen.select("cidx", "category", (offset + rank).cast("long").alias("feature_idx"),
                        F.concat(names, F.lit("="), F.col("category")).alias("feature"))
    return Encoder(numeric, categorical, cut_lineage(vocab), sizes)


def vector_pipeline(numeric, categorical, output: str = "features") -> Pipeline:
    idx = [f"_{c}_idx" for c in categorical]
    hot = [f"_{c}_hot" for c in categorical]
    return Pipeline(stages=[
        StringIndexer(inputCols=list(categorical), outputCols=idx, stringOrderType="alphabetAsc",
                      handleInvalid="keep"),
        OneHotEncoder(inputCols=idx, outputCols=hot, dropLast=True),
        VectorAssembler(inputCols=list(numeric) + hot, outputCol=output),
    ])
