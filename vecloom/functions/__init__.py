"""Column expressions: DataFrame column in, DataFrame column out."""
