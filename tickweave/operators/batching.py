"""Landing batches (B1).

Rows are cut into blocks of `size` in a stable order: block = ordinal // size, where the
ordinal comes from the range-partitioned numbering in `ordinal_within` (never a global
single-partition window). Every block but the last of each key is full; the last, partial
block is kept. For pure file-size bounding without a stable order, `maxRecordsPerFile` on the
writer is enough and needs no numbering at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..defaults import LANDING_BATCH_ROWS
from .ranking import ordinal_within



def assign_batches(df: DataFrame, order: list[Column | str], size: int = LANDING_BATCH_ROWS,
                   keys: list[str] = (), name: str = "batch_id") -> DataFrame:
    numbered = ordinal_within(df, list(keys), order, "_ord")
    return numbered.withColumn(name, F.floor(F.col("_ord") / size).cast("bigint")).drop("_ord")
