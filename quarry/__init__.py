"""quarry: classic table mining (itemsets, rules, trees, forests, clustering) on Spark.

Every operator takes and returns DataFrames; the data-sized work runs as Spark plans
(DataFrame expressions, joins, windows, MLlib).  Only model-sized values (thresholds,
N, split rows, k centres) ever reach the driver.
"""

from quarry.params import parse_share  # noqa: F401
from quarry.session import ensure_checkpoint_dir, get_session  # noqa: F401

__all__ = ["get_session", "ensure_checkpoint_dir", "parse_share"]
