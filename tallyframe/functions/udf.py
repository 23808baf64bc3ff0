"""User functions over Arrow data."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyframe.errors import EngineError
from tallyframe.functions import dtypes
from tallyframe.functions.expr import Expr, Place, col


def map_batches(inputs: Sequence[Expr | str], fn: Callable[[pa.RecordBatch], pa.RecordBatch], return_type=None, whole_frame: bool = False) -> Expr:
    """One column from a function of a record batch with the inputs' columns. It is called for batches of rows, so it must not look beyond a batch.

    A function of the whole column at once (whole_frame) can't be spread; it is left to Frame.map_whole.
    """
    if whole_frame:
        raise EngineError("INVALID", "a function of a whole column is not an expression: use Frame.map_whole")
    parts = [col(e) for e in inputs]
    if not parts:
        raise EngineError("INVALID", "map_batches needs an input")

    def build(p: Place) -> Column:
        columns = [e.build(p) for e in parts]
        kind = dtypes.spark_type(return_type) if return_type else p.kind(columns[0])

        @F.pandas_udf(kind)
        def run(*series: pd.Series) -> pd.Series:
            out = fn(pa.RecordBatch.from_arrays([pa.Array.from_pandas(s) for s in series], [e.name for e in parts]))
            if out.num_columns != 1 or out.num_rows != len(series[0]):
                raise ValueError("the function must return one column of as many rows")
            return out.column(0).to_pandas()

        return run(*columns)

    return Expr(build, parts[0].name)
