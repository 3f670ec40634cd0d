"""Document ids: 128-bit xxHash of file, URL and time stamp, joined as they are."""

from __future__ import annotations

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def xxh128(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else xxhash.xxh128_hexdigest(t.encode()))


def document_id(*parts: Column | str) -> Column:
    """32 hex digits; Spark's own xxhash64 is another function. Null if a part is null."""
    return xxh128(F.concat(*parts))


def add_ids(df: DataFrame, file: str = "f", url: str = "u", stamp: str = "ts", name: str = "id") -> DataFrame:
    return df.withColumn(name, document_id(F.col(file), F.col(url), F.col(stamp).cast("string")))
