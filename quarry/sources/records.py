"""Labelled records from a headerless 15-field CSV (SRC-2, PF-2).

Fields are read as strings with the blank after each comma skipped; only rows with all
15 fields and a known label survive.  The label loses surrounding blanks and a trailing
dot and maps ``>50K`` -> 1, ``<=50K`` -> 0; numeric fields become DOUBLE, ``?`` stays an
ordinary category.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The attribute names, the numeric attributes and the label texts of the
# census-income record layout.
NAMES = ("age", "workclass", "fnlwgt", "education", "education-num", "marital-status",
         "occupation", "relationship", "race", "sex", "capital-gain", "capital-loss",
         "hours-per-week", "native-country")
NUMERIC = ("age", "fnlwgt", "education-num", "capital-gain", "capital-loss", "hours-per-week")
POSITIVE, NEGATIVE = ">50K", "<=50K"


def read_labelled(spark: SparkSession, path: str) -> DataFrame:
    cols = [f"c{i}" for i in range(16)]  # one spare column detects over-long rows
    raw = (spark.read.schema(", ".join(f"{c} string" for c in cols))
           .option("header", "false").option("ignoreLeadingWhiteSpace", "true")
           .option("ignoreTrailingWhiteSpace", "true").option("mode", "PERMISSIVE").csv(path))
    label = F.regexp_replace(F.trim(F.col("c14")), r"\.$", "")
    full = raw.where(F.col("c14").isNotNull() & F.col("c15").isNull() & label.isin(POSITIVE, NEGATIVE))
    out = [F.col(f"c{i}").cast("double").alias(n) if n in NUMERIC else F.trim(F.col(f"c{i}")).alias(n)
           for i, n in enumerate(NAMES)]
    return full.select(F.monotonically_increasing_id().alias("row_id"), *out,
                       (label == POSITIVE).cast("int").alias("label"))
