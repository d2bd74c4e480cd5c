"""Python's rounding, for index builds. Arrow functions need real annotations, so this module has no postponed ones."""

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf


def round_list(values: list, digits: int = 1) -> list:
    return [None if v is None else round(v, digits) for v in values]


def rounded_ic(raw: Column) -> Column:
    """``round(x, 1)`` on the exact binary value with ties to even, which no SQL function does; lookups never run it."""

    @arrow_udf("double")
    def rounded(values: pa.Array) -> pa.Array:
        return pa.array(round_list(values.to_pylist()), pa.float64())

    return rounded(raw)
