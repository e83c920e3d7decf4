"""Registered queries over the driver tables and their independent SQL oracles."""

from quarry.plans import classify, cluster, exports, mining

QUERIES = {}
ORACLE = {}
for _module in (mining, classify, cluster, exports):
    QUERIES.update(_module.QUERIES)
    ORACLE.update(_module.ORACLE)
