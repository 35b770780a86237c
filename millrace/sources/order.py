"""Where rows stood in their input, so that the last one can win."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

POSITION = "_position"


def _hidden(df: DataFrame, *fields: str) -> bool:
    """Whether ``df`` comes straight from files and their hidden metadata has these fields."""
    try:
        df.select(*[F.col(f"_metadata.{f}") for f in fields])
    except AnalysisException:
        return False
    return True


def with_position(df: DataFrame, newest_file_last: bool = False) -> DataFrame:
    """``df`` plus ``_position``, which grows in input order.

    Rows of files are ordered by file name (with ``newest_file_last`` by modification time first), block and
    row. Rows of a frame that was made in the session follow its partitions. Call it on the source itself:
    after a shuffle rows no longer have an input order.
    """
    time: Column = F.lit(None).cast("timestamp")
    if _hidden(df, "file_path", "file_block_start"):
        if newest_file_last:
            time = F.col("_metadata.file_modification_time")
        row = F.col("_metadata.row_index") if _hidden(df, "row_index") else F.monotonically_increasing_id()
        place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), row.alias("row")]
    else:
        place = [F.lit("").alias("file"), F.lit(0).cast("long").alias("block"), F.monotonically_increasing_id().alias("row")]
    return df.select("*", F.struct(time.alias("time"), *place).alias(POSITION))
