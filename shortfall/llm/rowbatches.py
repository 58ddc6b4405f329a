"""Arrow batches of bounded size from records made one at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa

BATCH_BYTES = 4 << 20


def spark_schema(schema: pa.Schema):
    """The Spark schema of an Arrow one."""
    from pyspark.sql.pandas.types import from_arrow_schema

    return from_arrow_schema(schema)


def batched(records: Iterable[dict], schema: pa.Schema, weigh: Callable[[dict], int], most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """``records`` in batches of about ``most`` bytes by ``weigh``; fields that a record lacks are NULL."""
    held, weight = [], 0
    for record in records:
        held.append(record)
        weight += weigh(record)
        if weight >= most:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)
