"""Training-data operators: ten components for preparing text corpora.

Nothing else in the library imports this subpackage; it can be removed as a
whole.  Every operator takes DataFrames, keeps its work in Spark tasks and
cuts lineage only through tables written below ``spark.checkpoint.dir``.
"""
