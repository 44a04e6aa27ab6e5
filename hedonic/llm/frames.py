"""Column bookkeeping: operators work on positional names, so no input column can clash with theirs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Inner:
    """A frame whose columns are called ``c0, c1, ...`` and what they stand for."""

    df: DataFrame
    columns: list[str]
    keep: list[str]  # outer names of the columns to return

    def name(self, column: str) -> str:
        """Positional name of an input column; an exact match wins over one by case."""
        if column in self.columns:
            return f"c{self.columns.index(column)}"
        low = [c.lower() for c in self.columns]
        if column.lower() not in low:
            raise ValueError(f"no column {column!r} among {self.columns}")
        return f"c{low.index(column.lower())}"

    @property
    def kept(self) -> list[str]:
        return [self.name(c) for c in self.keep]

    def close(self, df: DataFrame, *outputs: str) -> DataFrame:
        """Kept columns under their own names, then the operator's outputs."""
        return df.select(*[F.col(self.name(c)).alias(c) for c in self.keep], *outputs)


def open_frame(df: DataFrame, keep: list[str] | None = None, outputs: tuple[str, ...] = ()) -> Inner:
    """``keep``: None for all columns. A kept column with the name of an output is replaced by it."""
    columns = df.columns
    wanted = columns if keep is None else keep
    taken = {o.lower() for o in outputs}
    return Inner(df.toDF(*[f"c{i}" for i in range(len(columns))]), columns,
                 [c for c in wanted if c.lower() not in taken])
