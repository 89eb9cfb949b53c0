"""Arrow-batch plumbing shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def with_columns(df: DataFrame, inputs: list[str], fields: T.StructType, start: Callable[[], Callable], drop: tuple[str, ...] = ()) -> DataFrame:
    """Append ``fields`` computed in Python from the columns ``inputs``, one Arrow batch at a time.

    ``start()`` runs once per task and returns ``f(*arrays) -> list of arrays``.  An input column whose
    name equals that of a new field gives way to it.  Columns in ``drop`` are read but not returned.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    new = {f.name for f in fields}
    kept = [c for c in df.columns if c not in new and c not in drop]
    needed = list(dict.fromkeys([*kept, *inputs]))
    schema = T.StructType([*(df.schema[c] for c in kept), *fields])
    arrow = to_arrow_schema(fields)

    def run(batches):
        compute = start()
        for batch in batches:
            made = compute(*(batch.column(batch.schema.get_field_index(c)) for c in inputs))
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            columns += [x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(made, arrow)]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *(f.name for f in arrow)])

    return df.select(*needed).mapInArrow(run, schema)
