"""fieldnotes: typed, sparse feature tables and random-forest jobs on Spark.

Wide observation files (one column per feature, with a missing and a null
token) are read as DataFrames, turned into typed wide or long form by a
declared role per column, ranked by per-feature measures, balanced by
repeatable sampling, and fed to ``spark.ml`` forests for selection, tuning,
training and scoring.
"""

from fieldnotes.spec import FeatureSpec, clean_names

__all__ = ["FeatureSpec", "clean_names"]
