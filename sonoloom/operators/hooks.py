"""Batch hooks for the caller's own models: encoder and classifier, loaded once per task."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def encode(files: DataFrame, load: Callable[[], Callable[[list[str]], np.ndarray]], path: str = "path") -> DataFrame:
    """(path, embedding): ``load()`` returns an encoder of a list of paths."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = load()
        for batch in batches:
            if len(batch):
                yield pd.DataFrame({"path": batch[path], "embedding": list(np.asarray(encoder(list(batch[path])), "float32"))})

    return files.select(path).mapInPandas(run, "path string, embedding array<float>")


def classify(rows: DataFrame, load: Callable[[], Any], vector: str = "embedding", output: str = "label") -> DataFrame:
    """Add the integer label of ``load().predict(matrix)``."""

    @F.pandas_udf("int")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for batch in batches:
            yield pd.Series(model.predict(np.stack(batch.to_numpy())) if len(batch) else [], dtype="int32")

    return rows.withColumn(output, predict(F.col(vector)))


def gender_of_label(rows: DataFrame, label: str = "label", output: str = "gender") -> DataFrame:
    """Class 0 is ``m``, any other ``f``."""
    return rows.withColumn(output, F.when(F.col(label) == 0, "m").otherwise("f"))
