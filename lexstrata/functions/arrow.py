"""Row-wise Python functions over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame


#: Rows of a batch that is given back, and bytes of the texts that are read at once.
ROWS, BYTES = 8192, 1 << 20


def flat_map(df: DataFrame, keys: list[str], inputs: list[str], function: Callable[..., Iterable[tuple]], schema: str) -> DataFrame:
    """For every row, the rows that function(*inputs) yields, each with the row's keys before it. schema: of the new columns.

    Batches are read in slices and given back by ROWS rows, so a task holds that much, however many rows a text yields."""
    at = len(keys)
    key_schema = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)
    full = f"{key_schema}, {schema}" if keys else schema
    out_schema = df.sparkSession.createDataFrame([], full).schema
    most, size = ROWS, BYTES

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out_schema)

        def made(rows):
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

        rows = []
        for batch in batches:
            step = max(1, min(batch.num_rows, size * batch.num_rows // max(batch.nbytes, 1)))
            for begin in range(0, batch.num_rows, step):
                for r in zip(*[c.to_pylist() for c in batch.slice(begin, step).columns], strict=True):
                    for new in function(*r[at:]):
                        rows.append((*r[:at], *new))
                        if len(rows) >= most:
                            yield made(rows)
                            rows = []
        if rows:
            yield made(rows)

    return df.select(*keys, *inputs).mapInArrow(run, out_schema)
