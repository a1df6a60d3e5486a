"""Feature encoding: impute, string-index, assemble, L1-normalise.

All learned state (fill means, category order) lives in fitted Spark ML
stages, so one ``PipelineModel`` carries every step and held-out rows are
only ever transformed, never fitted on.

Scale notes: one multi-column ``StringIndexer`` counts all categorical
columns in a single pass (partial counts per partition, merged once) instead
of one job per column. The label lists it keeps on the driver, and sends with
every task, grow with the number of distinct categories: fine at 10^4-10^5 of
them. ``fit_features`` gives columns of more categories an index table
(``indexing.fit_string_index``); a pipeline of ``feature_stages`` does not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, Normalizer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..spec import FeatureSpec
from .indexing import StringIndex, fit_string_index

FEATURES = "features"
NORM_FEATURES = "normFeatures"


def string_indexer(inputs: Sequence[str], outputs: Sequence[str] | None = None,
                   handle_invalid: str = "keep", order: str = "frequencyDesc") -> StringIndexer:
    """One indexer for all columns: most frequent category -> 0.

    Ties are broken by the category text. With ``keep``, null and categories
    not seen at fit time map to one extra index (= number of labels).
    """
    outputs = list(outputs) if outputs is not None else [f"{c}Index" for c in inputs]
    return StringIndexer(inputCols=list(inputs), outputCols=outputs,
                         handleInvalid=handle_invalid, stringOrderType=order)


def vector_assembler(inputs: Sequence[str], output: str = FEATURES,
                     handle_invalid: str = "keep") -> VectorAssembler:
    """Assemble columns into one vector; with ``keep`` a null becomes NaN."""
    return VectorAssembler(inputCols=list(inputs), outputCol=output, handleInvalid=handle_invalid)


def l1_normalizer(input_col: str = FEATURES, output: str = NORM_FEATURES, p: float = 1.0) -> Normalizer:
    """x / sum(|x|); a zero vector stays zero, any NaN makes the row NaN."""
    return Normalizer(inputCol=input_col, outputCol=output, p=p)


def mean_imputer(cols: Sequence[str]) -> Imputer:
    """Fitted mean fill of null and NaN, in place."""
    return Imputer(inputCols=list(cols), outputCols=list(cols), strategy="mean")


def feature_stages(spec: FeatureSpec, impute: bool = True, normalize: bool = True, indexed: Sequence[str] = ()) -> list:
    """Stages of the encoding for a spec.

    impute     fit the numeric fill on the rows the pipeline is fitted on
               (the leak-free default); False leaves numbers as they are
    normalize  L1-normalise into ``normFeatures`` (the original's model input)
    indexed    categories that have their index column already
    """
    stages = []
    if impute and spec.numeric_inputs:
        stages.append(mean_imputer(spec.numeric_inputs))
    todo = [c for c in spec.index_inputs if c not in indexed]
    if todo:
        stages.append(string_indexer(todo))
    stages.append(vector_assembler(spec.feature_names))
    if normalize:
        stages.append(l1_normalizer())
    return stages


def features_col(normalize: bool = True) -> str:
    return NORM_FEATURES if normalize else FEATURES


class IndexTable(Model):
    """A ``StringIndex`` as a stage; its table is not saved with the pipeline (``StringIndex.save`` does that)."""

    def __init__(self, index: StringIndex):
        super().__init__()
        self.index = index

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.index.transform(dataset)


#: Columns of about so many categories or more are indexed by a table.
KEY_LIKE = 100_000


def key_like(df: DataFrame, names: Sequence[str], least: int = KEY_LIKE) -> list[str]:
    """The columns with about ``least`` distinct values or more (estimated in one aggregate)."""
    if not names:
        return []
    found = df.agg(*[F.approx_count_distinct(c).alias(c) for c in names]).first()
    return [c for c in names if found[c] >= least]


def fit_features(df: DataFrame, spec: FeatureSpec, impute: bool = True,
                 normalize: bool = True, least: int = KEY_LIKE) -> PipelineModel:
    """The stages of ``feature_stages`` fitted on ``df``; columns of ``least`` categories or more get an index table."""
    large = key_like(df, spec.index_inputs, least)
    tables = [IndexTable(fit_string_index(df, c)) for c in large]
    stages = feature_stages(spec, impute=impute, normalize=normalize, indexed=large)
    return PipelineModel(stages=[*tables, *Pipeline(stages=stages).fit(df).stages]) if tables else Pipeline(stages=stages).fit(df)


def vector_columns(df: DataFrame, vector_col: str, names: Sequence[str],
                   prefix: str = "", keep: Sequence[str] = ()) -> DataFrame:
    """Spread a vector column into one double column per slot."""
    # a projection of its own: the vector is made and read once a row, not once a slot
    df = df.select(*keep, vector_to_array(F.col(vector_col)).alias("__slots"))
    return df.select(*keep, *[F.col("__slots")[i].alias(f"{prefix}{n}") for i, n in enumerate(names)])

