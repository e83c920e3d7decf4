"""Training-data operators: scans, filters, de-duplication, decontamination, packing.

Nothing else in the library imports this subpackage.  Each module holds one operator
with its own interface (DataFrame in, DataFrame out); ``queries`` registers one thin
query per operator.
"""
