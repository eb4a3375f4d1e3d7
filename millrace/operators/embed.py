"""Embedding of text or files by a model that the caller brings."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def embed(df: DataFrame, column: str, load_model: Callable[[], Callable[[Sequence], np.ndarray]], name: str = "vector") -> DataFrame:
    """Adds the normalised vector of each value.

    `load_model` runs once per Python worker and returns a function from a batch of values (text,
    or file bytes) to a matrix with one row per value.
    """

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load_model()
        for batch in batches:
            matrix = np.asarray(model(batch.tolist()), dtype=np.float32)
            length = np.linalg.norm(matrix, axis=1, keepdims=True)
            unit = np.divide(matrix, length, out=matrix.copy(), where=length > 0)
            yield pd.Series(list(unit))

    return df.withColumn(name, run(column))


def hashed_text_vectors(df: DataFrame, column: str, size: int = 256, name: str = "vector") -> DataFrame:
    """Hashed TF-IDF vectors of whole texts, for use without a model."""
    job = Pipeline(stages=[
        RegexTokenizer(inputCol=column, outputCol="_words", pattern=r"[^\p{L}\p{N}]+", toLowercase=True),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=size),
        IDF(inputCol="_tf", outputCol="_idf"),
    ])
    out = job.fit(df).transform(df)
    return out.withColumn(name, vector_to_array("_idf")).drop("_words", "_tf", "_idf")
