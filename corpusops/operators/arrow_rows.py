"""One row in, many rows out, over Arrow batches of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# a batch is handed over once it holds this much text
FLUSH_CHARS = 4 << 20


def flat_map(df: DataFrame, fn: Callable[..., Iterable[tuple]], schema: StructType) -> DataFrame:
    """Apply ``fn(*row)`` to each row of ``df`` and collect the tuples it yields.

    Select only the needed columns first: the optimizer cannot prune through Python.
    """
    fields = list(to_arrow_schema(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = pa.schema(fields)
        pending, held = [], 0
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                for out in fn(*row):
                    pending.append(out)
                    held += 64 + sum(len(v) for v in out if isinstance(v, str))
                    if held >= FLUSH_CHARS:
                        yield _batch(pending, arrow)
                        pending, held = [], 0
        if pending:
            yield _batch(pending, arrow)

    return df.mapInArrow(run, schema)


def _batch(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(values, type=field.type) for values, field in zip(zip(*rows), arrow)]
    return pa.RecordBatch.from_arrays(columns, schema=arrow)
