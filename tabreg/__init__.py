"""tabreg: prepare tables and fit regression models on Spark.

Subpackages:
  sources    CSV / Parquet / model stores, read-through materialisation
  functions  Column expressions (clock features, keyed hashes)
  operators  cleaning, sampling, feature encoding, estimators, selection, metrics
  plans      the flight fixture, end-to-end workflows, registered queries
"""

from .operators.clean import preprocess
from .plans.workflow import compare_models, materialized_inputs, train_evaluate
from .sources.io import read_or_build, read_raw
from .spec import FeatureSpec

__all__ = ["FeatureSpec", "compare_models", "materialized_inputs", "preprocess", "read_or_build",
           "read_raw", "train_evaluate"]
