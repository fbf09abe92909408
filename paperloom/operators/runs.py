"""Small groups by the thousand: Python over sorted runs instead of a frame per group."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame


def map_runs(df: DataFrame, keys: list[str], columns: list[str], rule: Callable[[tuple, list[tuple]], list[tuple]], schema: str, waves: int = 3) -> DataFrame:
    """``rule(key, rows)`` for each group of ``keys``, with rows as tuples of ``columns``.

    Rows are hash-partitioned and sorted by the keys, and each partition is read as a stream, so
    a task holds one group at a time. For groups whose size is bounded by their nature; null
    keys form groups like any other.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    names = [part.strip().split(" ")[0].strip("`") for part in schema.split(",")]
    width = len(keys)

    def values(column: pd.Series) -> list:
        out = column.tolist()
        return [None if v is None or v != v else v for v in out] if column.dtype.kind == "f" else out

    def run(batches):
        current, rows = None, []
        for batch in batches:
            out = []
            for row in zip(*[values(batch[c]) for c in [*keys, *columns]]):
                key = row[:width]
                if key != current:
                    if rows:
                        out += rule(current, rows)
                    current, rows = key, []
                rows.append(row[width:])
            if out:
                yield pd.DataFrame(out, columns=names)
        if rows:
            yield pd.DataFrame(rule(current, rows), columns=names)

    placed = df.select(*keys, *columns).repartition(waves * cores, *keys).sortWithinPartitions(*keys)
    return placed.mapInPandas(run, schema)


def safely(rule: Callable[[tuple, list[tuple]], list[tuple]], width: int) -> Callable[[tuple, list[tuple]], list[tuple]]:
    """``rule`` for map_runs that never fails: its rows, ``width`` wide, with a null error behind them; or,
    where it raises, the one row of the key, nulls and the error's text. A failed group doesn't end the job."""

    def guarded(key: tuple, rows: list[tuple]) -> list[tuple]:
        try:
            return [(*row, None) for row in rule(key, rows)]
        except Exception as error:  # whatever the rule raises is a result here
            return [(*key, *[None] * (width - len(key)), f"{type(error).__name__}: {error}")]

    return guarded
