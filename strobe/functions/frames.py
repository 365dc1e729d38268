"""pandas frames with explicit dtypes for Spark's Arrow conversion.

An all-null object column does not convert to a plain Arrow array in this
pyarrow version, so output frames of pandas UDFs carry nullable dtypes.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import types as T


def typed_frame(rows: list[dict], schema: T.StructType) -> pd.DataFrame:
    pdf = pd.DataFrame(rows, columns=schema.names)
    for f in schema.fields:
        if isinstance(f.dataType, T.StringType):
            pdf[f.name] = pdf[f.name].astype("string")
        elif isinstance(f.dataType, (T.LongType, T.IntegerType)):
            pdf[f.name] = pdf[f.name].astype("Int64")
    return pdf
