"""Write documents as JSON-array files of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame


def as_array_lines(df: DataFrame, column: str, per_file: int) -> DataFrame:
    """Lines which, cut every ``per_file`` rows, are JSON arrays with one
    element per line.  Rows stay in their tasks; one row is held back."""

    def frame(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, count = None, 0
        for batch in batches:
            if batch.empty:
                continue
            texts = batch["value"].reset_index(drop=True)
            place = (texts.index + count) % per_file
            opened = texts.where(place != 0, "[" + texts).where(place == 0, "," + texts)
            closed = opened.where(place != per_file - 1, opened + "]")
            if held is not None:
                closed = pd.concat([pd.Series([held]), closed], ignore_index=True)
            count += len(texts)
            held = closed.iloc[-1]
            if len(closed) > 1:
                yield pd.DataFrame({"value": closed.iloc[:-1]})
        if held is not None:
            last = held if count % per_file == 0 else held + "]"
            yield pd.DataFrame({"value": [last]})

    return df.selectExpr(f"`{column}` AS value").mapInPandas(frame, "value string")


def write_chunks(df: DataFrame, column: str, per_file: int, path: str) -> None:
    """Array files of at most ``per_file`` documents each."""
    as_array_lines(df, column, per_file).write.option("maxRecordsPerFile", per_file).mode("errorifexists").text(path)
