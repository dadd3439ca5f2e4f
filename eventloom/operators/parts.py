"""Groups of any size in parts of a stated size, so that none has to be gathered whole."""

from pyspark.sql import DataFrame, functions as F


def with_part(df: DataFrame, key: str, text: str, max_rows: int) -> DataFrame:
    """Number the part of each row within its group: adds ``part`` and ``parts``.

    A group of n rows is dealt over ``ceil(n / max_rows)`` parts by a hash of ``text``, so
    equal texts share a part; the least hash always goes to part 0, which so is never empty.
    One plan without any job: counts are combined map-side, and only groups of several parts
    reach the join, whose small side adaptive execution may broadcast.
    """
    digest = F.md5(F.col(text).cast("binary"))
    several = (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"), F.min(digest).alias("_least"))
        .filter(F.col("_n") > max_rows)
        .select(key, F.ceil(F.col("_n") / F.lit(max_rows)).cast("int").alias("_parts"), "_least")
    )
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % F.col("_parts")
    part = F.when(digest == F.col("_least"), 0).otherwise(number)
    return df.join(several, key, "left").select(
        *df.columns,
        F.coalesce(part, F.lit(0)).cast("int").alias("part"),
        F.coalesce("_parts", F.lit(1)).alias("parts"),
    )
