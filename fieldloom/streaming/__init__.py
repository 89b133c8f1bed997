"""Stream scoring.

Nothing here is stateful: a fitted pipeline is a row-local map, so it reads a
stream with the same call it reads a table with.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame


def score_stream(stream: DataFrame, model: PipelineModel) -> DataFrame:
    """Attach predictions of a fitted pipeline to a streaming frame."""
    if not stream.isStreaming:
        raise ValueError("score_stream expects a streaming DataFrame; use model.transform for tables")
    return model.transform(stream)
