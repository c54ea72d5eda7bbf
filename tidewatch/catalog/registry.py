"""Named queries over the given tables, each with the SQL it must agree with."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(
    sql: str | None = None,
    dates: tuple[str, ...] = (),
    stamps: tuple[str, ...] = (),
    flags: tuple[str, ...] = (),
    counts: tuple[str, ...] = (),
) -> Callable[[Query], Query]:
    """Register a function under its own name; without SQL only its row count is checked.

    Clients disagree on how dates, timestamps, nullable booleans and nullable
    integers look in a result. The columns named here are turned into text (the
    first three) or doubles (``counts``) on both sides.
    """

    def add(fn: Query) -> Query:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            shown = {c: F.col(c).cast("string") for c in (*dates, *flags)}
            shown |= {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in stamps}
            shown |= {c: F.col(c).cast("double") for c in counts}
            return df.withColumns(shown) if shown else df

        QUERIES[fn.__name__] = run
        if sql is not None:
            shown = [f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in (*dates, *flags)]
            shown += [f"strftime(\"{c}\", '%Y-%m-%d %H:%M:%S') AS \"{c}\"" for c in stamps]
            shown += [f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in counts]
            ORACLES[fn.__name__] = f"SELECT * REPLACE ({', '.join(shown)}) FROM ({sql})" if shown else sql
        return run

    return add
