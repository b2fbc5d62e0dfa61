"""Seeded samples, stratified splits and per-class heads."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from baitline import fixed_values as fv
from baitline.functions.strings import seeded_key
from baitline.plans.scale import (
    LITERAL_ROWS, UNBOUNDED, Measured, hash_cuts, lookup_join, with_exact_rank,
)

# Up to here a top-n keeps n rows per task and merges them; above, ranks are computed
# bucket by bucket.
TOP_N_ROWS = 100_000


def seeded_sample(df: DataFrame, n: int, key: str = "url", seed: int = fv.SEED) -> DataFrame:
    """Exactly n rows (or all, if fewer) in a seeded pseudo-random choice."""
    if n <= TOP_N_ROWS:
        return df.orderBy(seeded_key(seed, F.col(key)), F.col(key)).limit(n)
    ranked = with_exact_rank(df.withColumn("_all", F.lit(1)), "_all",
                             seeded_key(seed, F.col(key)), key, "_rank")
    return ranked.filter(F.col("_rank") <= n).drop("_all", "_rank")


def shuffle_rows(df: DataFrame, key: str, seed: int = fv.SEED) -> DataFrame:
    """Seeded row order for a file that is about to be written."""
    return df.orderBy(seeded_key(seed, F.col(key)), F.col(key))


def stratified_split(df: DataFrame, share: float = fv.VALIDATION_SHARE, label: str = "label",
                     key: str = "id", seed: int = fv.SEED) -> DataFrame:
    """Adds ``part`` ('validation' or 'train'): exactly ceil(share * n) rows of every class.

    The key should be unique; copies of a key always go to the same part. Rows are not
    shuffled: each is compared with the cut of its class. A row without a label is an error.
    """
    hashed = seeded_key(seed, F.col(key))
    # The product is made decimal so that 0.2 * 15 does not become 3.0000000000000004.
    quota = F.ceil((F.col("size") * F.lit(share)).cast("decimal(38,9)")).cast("bigint")
    cuts = hash_cuts(df, label, hashed, key, quota)
    # One row per class. Read now when it is short: the split then stays a plain map, and
    # later passes over it (training makes several) do not count again.
    rows = cuts.limit(LITERAL_ROWS + 1).collect()
    if any(r[label] is None for r in rows):
        raise ValueError(f"rows without a {label}: filter them first")
    if len(rows) <= LITERAL_ROWS:
        cuts, size = df.sparkSession.createDataFrame(rows, cuts.schema), Measured(len(rows), 0)
    else:
        size = UNBOUNDED
    held = lookup_join(df, cuts, label, [key], size=size)
    place = F.struct(hashed.alias("_hash"), F.col(key).alias("_key"))
    return held.withColumn("part", F.when(place <= F.col("cut"), "validation").otherwise("train")
                           ).drop("cut")


def balanced_head(df: DataFrame, k: int, label: str = "label",
                  order: str = "id") -> DataFrame:
    """First k rows of every class. Spark keeps k rows per class and task before it shuffles."""
    w = Window.partitionBy(label).orderBy(order)
    return df.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= k).drop("_n")
