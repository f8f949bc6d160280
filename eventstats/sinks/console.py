from __future__ import annotations

from pyspark.sql import DataFrame


def print_rows(df: DataFrame, rows: int = 20) -> DataFrame:
    """Print the first rows and pass the frame through."""
    df.show(rows, truncate=False)
    return df
