"""Column functions: impurity/split scores, vector distances, rule text, seeded draws."""
