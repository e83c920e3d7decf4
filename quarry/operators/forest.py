"""Random forest with feature importances (M-8, M-9) on MLlib.

Trees are trained by ``RandomForestClassifier`` over the one-hot vector (so the
``sqrt``/``log2`` feature subset is taken over the same feature count as the encoded
matrix): Gini impurity, bootstrap, ``maxDepth``, ``minInstancesPerNode`` = min leaf,
fixed seed.  MLlib bins continuous features (``maxBins``) and draws its own random
numbers, so trees differ from other implementations; quality is comparable.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pyspark import StorageLevel

from quarry.operators.encode import vector_pipeline
from quarry.session import ensure_checkpoint_dir, spread
from quarry.operators.quality import quality as quality_of

TOP_FEATURES = 15
NODE_IDS = 1 << 29  # node ids (4 bytes each) that MLlib may keep


@dataclass
class ForestResult:
    model: object
    names: list
    quality: DataFrame
    importances: DataFrame
    predictions: DataFrame


def fit_forest(train: DataFrame, test: DataFrame, numeric, categorical, label: str,
               n_estimators: int = 100, max_depth: int = 12, min_leaf: int = 10,
               max_features: str = "sqrt", seed: int = 42, max_bins: int = 32) -> ForestResult:
    return next(fit_forests(train, test, numeric, categorical, label, (n_estimators,), max_depth, min_leaf,
                            max_features, seed, max_bins))


def fit_forests(train: DataFrame, test: DataFrame, numeric, categorical, label: str, sizes,
                max_depth: int = 12, min_leaf: int = 10, max_features: str = "sqrt", seed: int = 42,
                max_bins: int = 32) -> Iterator[ForestResult]:
    """A forest of each of ``sizes`` trees, one after the other, over training rows that are encoded,
    spread and kept once.

    What is kept are the plain columns: the vectors, several times as large, are built while a fit
    reads them.  MLlib's cache of node ids holds a number a row and tree, three times over, and
    checkpoints them; above ``NODE_IDS`` numbers it is off and rows walk down the trees instead
    (at most ``max_depth`` steps a pass): the trees are the same.
    """
    if min(sizes) < 1 or max_depth < 1 or min_leaf < 1:
        raise ValueError("trees, depth and leaf size must be positive")
    if max_features not in ("sqrt", "log2"):
        raise ValueError("max_features must be sqrt or log2")
    ensure_checkpoint_dir(train.sparkSession)
    prep = vector_pipeline(numeric, categorical).fit(train)
    names = list(numeric)
    indexers = [s for s in prep.stages if hasattr(s, "labelsArray")]
    for col, labels in zip(categorical, indexers[0].labelsArray):
        names.extend(f"{col}={v}" for v in labels)
    rows = spread(train.withColumn("_order", F.xxhash64(*train.columns)).select(*numeric, *categorical, label, "_order"), key="_order")
    rows = rows.drop("_order").persist(StorageLevel.MEMORY_AND_DISK)
    data = prep.transform(rows).select("features", F.col(label).cast("double").alias(label))
    try:
        n = rows.count()
        for n_estimators in sizes:
            rf = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=n_estimators,
                                        maxDepth=max_depth, minInstancesPerNode=min_leaf,
                                        featureSubsetStrategy=max_features, impurity="gini",
                                        bootstrap=True, seed=seed, maxBins=max_bins,
                                        cacheNodeIds=n * n_estimators <= NODE_IDS, checkpointInterval=10)
            yield _result(rf.fit(data), prep, names, test, label)
    finally:
        rows.unpersist()


def _result(model, prep, names, test: DataFrame, label: str) -> ForestResult:
    spark = test.sparkSession
    # the training summary holds the session, which cannot be sent to tasks once it has observed
    # a query; predictions need the trees only
    model._java_obj.setSummary(spark.sparkContext._jvm.scala.Option.apply(None))
    predictions = model.transform(prep.transform(test)).withColumn(
        "prediction", F.col("prediction").cast("int"))
    imp = model.featureImportances.toArray().tolist()
    table = spark.createDataFrame([(n, float(v)) for n, v in zip(names, imp)], "feature string, importance double")
    ranked = (table.orderBy(F.desc("importance"), "feature").limit(TOP_FEATURES)
              .withColumn("rank", F.row_number().over(
                  Window.orderBy(F.desc("importance"), "feature"))))
    return ForestResult(model, names, quality_of(predictions, label, "prediction"), ranked, predictions)
