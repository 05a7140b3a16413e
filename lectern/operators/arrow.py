"""Thin wrapper round ``mapInArrow``: a kernel sees columns as Python lists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def map_columns(df: DataFrame, kernel: Callable, schema: str | T.StructType, setup: Callable | None = None) -> DataFrame:
    """Apply ``kernel(columns[, state])`` to every Arrow batch. ``columns`` maps a
    name to a list; the kernel returns a mapping of output columns. ``setup`` runs
    once per task and its value is handed to each call."""
    out = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out)
        state = setup() if setup is not None else None
        for batch in batches:
            columns = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
            result = kernel(columns, state) if setup is not None else kernel(columns)
            if result is not None:
                yield pa.RecordBatch.from_arrays([pa.array(result[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, out)


def map_partition(df: DataFrame, kernel: Callable, schema: str | T.StructType) -> DataFrame:
    """Apply ``kernel(iterator of columns)``, which yields mappings of output columns, once
    per task: for work that is summed up over a task's batches."""
    out = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out)
        read = ({n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)} for b in batches)
        for result in kernel(read):
            yield pa.RecordBatch.from_arrays([pa.array(result[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, out)
