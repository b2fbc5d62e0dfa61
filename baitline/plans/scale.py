"""Helpers that keep jobs balanced when one key holds a large share of the rows."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A side table goes into the plan as a literal set, as a broadcast, or as a salted
# shuffle join, depending on what was measured.
LITERAL_ROWS = 1_000
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 32


@dataclass(frozen=True)
class Measured:
    rows: int
    text_bytes: int

    @property
    def fits_literal(self) -> bool:
        return self.rows <= LITERAL_ROWS

    @property
    def fits_broadcast(self) -> bool:
        return self.rows <= BROADCAST_ROWS and self.text_bytes <= BROADCAST_BYTES


# For a side whose size nobody has measured.
UNBOUNDED = Measured(BROADCAST_ROWS + 1, BROADCAST_BYTES + 1)


def measure(table: DataFrame, *columns: str) -> Measured:
    """Exact row count and text size of a side table: one partial aggregation."""
    text = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in columns), F.lit(0))
    row = table.agg(F.count(F.lit(1)).alias("n"), F.sum(text).alias("b")).first()
    return Measured(row["n"], row["b"] or 0)


def lookup_join(left: DataFrame, right: DataFrame, key: str, spread: list[str],
                how: str = "left", size: Measured | None = None,
                salts: int = SALTS) -> DataFrame:
    """Equi-join to a side table with one row per ``key``.

    Broadcast when the measured side fits. Otherwise a shuffle join in which every key
    of the large side is spread over ``salts`` tasks by a hash of the ``spread``
    columns, so a key holding a third of the rows does not become one task.
    """
    size = size or measure(right, *right.columns)
    if size.fits_broadcast:
        return left.join(F.broadcast(right), key, how)
    salted_left = left.withColumn(
        "_salt", F.pmod(F.xxhash64(*[F.col(c) for c in spread]), F.lit(salts)).cast("int"))
    salted_right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_left.join(salted_right, [key, "_salt"], how).drop("_salt")


def spread_small_input(df: DataFrame) -> DataFrame:
    """Give every core a share of an input that comes as a few large row groups.

    Heavy per-row work (chunk scoring, MIME decoding, tokenising) would otherwise run
    on as many cores as there are row groups. An input with at least one split per core,
    as any large one has, is left alone and not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def filter_late(df: DataFrame, condition: Column) -> DataFrame:
    """Filter on computed columns without computing them twice.

    The optimiser moves a plain filter below the projections it reads from and copies
    their expressions into it; for scores that doubles the work of the whole job. A
    generator stays where it is. Use it for conditions on scores, and plain filters for
    conditions on stored columns.
    """
    passed = F.explode(F.when(condition, F.array(F.lit(True)))).alias("_passed")
    return df.select("*", passed).drop("_passed")


def micros_of(df: DataFrame, ts: str) -> Column:
    """Microseconds since the epoch; an unzoned timestamp is taken as it reads."""
    if df.schema[ts].dataType.typeName() != "timestamp_ntz":
        return F.unix_micros(F.col(ts))
    seconds = (F.unix_date(F.to_date(ts)).cast("bigint") * 86400 + F.hour(ts) * 3600
               + F.minute(ts) * 60)
    fraction = F.expr(f"extract(SECOND FROM `{ts}`)") * 1000000
    return seconds * 1000000 + fraction.cast("bigint")


def with_neighbour(df: DataFrame, key: str, order: list[str], value: Column, out: str,
                   step: int = -1, slice_seconds: int = 3600) -> DataFrame:
    """Add ``value`` of the previous (-1) or next (+1) row of the same key.

    Same result as ``lag``/``lead`` over ``partitionBy(key).orderBy(order)``, but a key
    is cut into time slices (``order[0]`` is the timestamp), so that a key holding a
    large share of all rows is spread over many tasks. Only the row at the edge of a
    slice looks into another slice, through a table with one row per key and slice.
    Rows with a null key get no neighbour and are spread by a hash.

    The input is computed and shuffled once: window, edge table and join all read the
    same exchange. For that the two branches must stay equal down to the exchange: the
    place is one struct (never null, so no filter is inferred for one branch only), the
    edge table takes whole rows (so no column is pruned from one branch only), and its
    filter stays late. Drop columns nobody needs before the call, not after it.
    """
    if step not in (-1, 1):
        raise ValueError("step must be -1 or 1")
    has_key = F.col(key).isNotNull()
    slice_no = F.floor(micros_of(df, order[0]) / (slice_seconds * 1000000))
    spread = F.when(has_key, F.lit(0)).otherwise(
        F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.lit(4096)).cast("int"))
    rows = (df.withColumn("_place", F.struct(F.col(key).alias("key"), slice_no.alias("slice"),
                                             spread.alias("spread")))
            .withColumn("_value", F.struct(value.alias("v"))).repartition("_place"))
    position = F.struct(*[F.col(c) for c in order])
    pick = F.max_by if step < 0 else F.min_by
    whole = F.struct(*[F.col(c) for c in rows.columns if c != "_place"])
    edges = rows.groupBy("_place").agg(pick(whole, position).alias("_row"))
    along = Window.partitionBy(F.col("_place.key")).orderBy(F.col("_place.slice"))
    near = F.lag("_row", 1) if step < 0 else F.lead("_row", 1)
    edges = (filter_late(edges, F.col("_place.spread") == 0)
             .withColumn("_near", near.over(along))
             .select("_place", F.col("_near._value").alias("_edge")))

    direction = [F.col(c).asc() if step < 0 else F.col(c).desc() for c in order]
    inside = Window.partitionBy("_place").orderBy(*direction)
    placed = rows.withColumn("_inside", F.lag("_value", 1).over(inside))
    joined = placed.join(edges, "_place", "left")
    neighbour = F.when(has_key, F.coalesce(F.col("_inside"), F.col("_edge")))
    return joined.withColumn(out, neighbour["v"]).select(*df.columns, out)


def with_exact_rank(df: DataFrame, group: str, hash_key: Column, tie: str, out: str,
                    total: str | None = None, digits: int = 4) -> DataFrame:
    """Exact 1-based rank by a hexadecimal hash inside each (possibly huge) group.

    The first ``digits`` of the hash cut each group into 16**digits even buckets. A
    count per bucket (partial aggregation) gives the ranks at which buckets start, and
    rows are numbered inside their bucket only, so a group with half of all rows is
    numbered by thousands of tasks. ``total`` adds the size of the group.
    """
    rows = (df.withColumn("_hash", hash_key)
            .withColumn("_bucket", F.substring("_hash", 1, digits)))
    place = [group, "_bucket"]
    counts = rows.groupBy(*place).agg(F.count(F.lit(1)).alias("_n"))
    before = (Window.partitionBy(group).orderBy("_bucket")
              .rowsBetween(Window.unboundedPreceding, -1))
    starts = (counts
              .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
              .withColumn("_total", F.sum("_n").over(Window.partitionBy(group)))
              .drop("_n"))
    inside = Window.partitionBy(*place).orderBy("_hash", tie)
    ranked = (rows.withColumn("_inside", F.row_number().over(inside))
              .join(starts, place)
              .withColumn(out, F.col("_start") + F.col("_inside")))
    if total is not None:
        ranked = ranked.withColumn(total, F.col("_total"))
    return ranked.drop("_hash", "_bucket", "_inside", "_start", "_total")


def hash_cuts(df: DataFrame, group: str, hash_key: Column, key: str, quota: Column,
              digits: int = 4) -> DataFrame:
    """Per group, the (hash, key) pair up to which ``quota`` rows lie: group, cut.

    ``quota`` is a Column over ``size``, the number of rows of the group. With the cuts
    rows are taken or left where they stand: nothing but hashes is ever shuffled. Counts
    per hash bucket show in which bucket the quota is reached, and only that bucket (one
    of 16**digits) is then ordered, after copies of a key have been counted together.
    """
    hashed = (df.select(group, F.col(key).alias("_key"), hash_key.alias("_hash"))
              .withColumn("_bucket", F.substring("_hash", 1, digits)))
    counts = hashed.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(group).orderBy("_bucket")
    reached = (counts.withColumn("_end", F.sum("_n").over(upto))
               .withColumn("size", F.sum("_n").over(Window.partitionBy(group)))
               .withColumn("_quota", quota)
               .withColumn("_need", F.col("_quota") - F.col("_end") + F.col("_n"))
               .filter("_need > 0 AND _need <= _n").select(group, "_bucket", "_need"))
    # One row per group is left; groups are spread by their buckets should there be many.
    place = F.struct(group, "_bucket").alias("_place")
    inside = (lookup_join(hashed.select(place, "_hash", "_key"),
                          reached.select(place, "_need"), "_place", ["_key"], how="inner",
                          size=measure(reached))
              .groupBy("_place", "_hash", "_key", "_need").agg(F.count(F.lit(1)).alias("_n")))
    ordered = Window.partitionBy("_place").orderBy("_hash", "_key")
    ends = inside.withColumn("_end", F.sum("_n").over(ordered))
    return (ends.filter("_end >= _need").groupBy("_place")
            .agg(F.min(F.struct("_hash", "_key")).alias("cut"))
            .select(F.col(f"_place.{group}").alias(group), "cut"))


def shared_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share; removed when the session's JVM ends.

    It lies in the cluster's checkpoint folder, or below the warehouse if none is named.
    """
    base = (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
            or spark.conf.get("spark.sql.warehouse.dir"))
    folder = f"{base.rstrip('/')}/baitline-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: survives the loss of executors."""
    folder = f"{shared_folder(df.sparkSession)}/table"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
