"""Line deduplication across documents by levelled sorted runs of line hashes.

Documents come in batches of ascending id. Every batch is anti-joined with the runs of the
batches before it: a line whose key stands in a run belongs to an earlier document. Keys
that are new become a sorted run of level 0. When a level holds ``fan_in`` runs they are
merged into one run of the next level, so that n batches leave about log(n) runs to read.

Inside a batch a line belongs to the smallest id that holds its key.

Only DataFrame functions run here. The shuffles carry hashes and positions; a text moves
once, to meet the positions it loses, and only if it loses any.

Cases: a null or empty text is one empty line; keys shorter than ``least`` code points are
never dropped; copies of a row (the same id twice) count as one document, and every copy is
returned; a null id counts as larger than any other and each such row is returned; lines
repeated inside the owning document stay; extra columns are carried along and may have any
name but those added here (n_lines, n_dropped), which are replaced; an empty table gives an
empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from baitline.llm.common import saved, shared_folder

BATCHES = 4
FAN_IN = 2
NO_ID = (1 << 63) - 1


def line_key(line: Column) -> Column:
    """A line without blanks at both ends, A-Z lower-cased; other letters stay as they are."""
    bare = F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))
    return F.translate(bare, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _hash(key: Column) -> Column:
    """128 bits of the key: two hashes of different seeds."""
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit(1), key, F.lit(7)).alias("b"))


class Runs:
    """Sorted runs of line hashes in levels, each a table in the shared folder."""

    def __init__(self, spark: SparkSession, folder: str, fan_in: int = FAN_IN):
        self.spark, self.folder, self.fan_in = spark, folder, fan_in
        self.levels: list[list[DataFrame]] = []
        self.merged = 0

    def all(self) -> DataFrame | None:
        every = [run for level in self.levels for run in level]
        return _union(every) if every else None

    def add(self, run: DataFrame) -> None:
        """A new run of level 0; full levels are compacted."""
        level = 0
        while True:
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(run)
            if len(self.levels[level]) < self.fan_in:
                return
            # Keys of different runs differ, so merging is a sort of their union.
            merged = _union(self.levels[level]).repartition("a", "b").sortWithinPartitions("a", "b")
            run = saved(merged, self.folder, f"run-{self.merged}")
            self.merged += 1
            self.levels[level] = []
            level += 1


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _lines(docs: DataFrame, key: str, text: str, least: int) -> DataFrame:
    """One row per line that counts: the document, the hash of its text, place and key hash."""
    lines = docs.select(
        F.coalesce(F.col(key), F.lit(NO_ID)).alias("_id"), F.xxhash64(text).alias("_text"),
        F.posexplode(F.split(F.col(text), "\n", -1)).alias("_pos", "_line"))
    bare = F.length(F.btrim("_line", F.lit(" \t\n\x0b\x0c\r")))
    return (lines.filter(bare >= least)
            .select("_id", "_text", "_pos", _hash(line_key(F.col("_line"))).alias("h"))
            .select("_id", "_text", "_pos", "h.a", "h.b"))


def line_batches(docs: DataFrame, key: str, batches: int) -> list[Column]:
    """Conditions that cut documents into about equal batches of ascending id."""
    shares = [k / batches for k in range(1, batches)]
    cuts = sorted(set(docs.approxQuantile(key, shares, 0.02))) if shares else []
    at = F.coalesce(F.col(key), F.lit(NO_ID))
    edges = [None, *[int(c) for c in cuts], None]
    return [(F.lit(True) if lo is None else at > lo) & (F.lit(True) if hi is None else at <= hi)
            for lo, hi in zip(edges, edges[1:])]


def add_batch(docs: DataFrame, runs: Runs, name: str, key: str = "doc_id", text: str = "text",
              least: int = 10) -> DataFrame:
    """Lines that one batch loses: _id, _text, _lost (their places). The batch joins the runs.

    Ids of later batches must be larger than all ids of this one.
    """
    lines = saved(_lines(docs, key, text, least), runs.folder, f"lines-{name}")
    keys = lines.groupBy("a", "b").agg(F.min("_id").alias("_owner"), F.max("_id").alias("_last"))
    before = runs.all()
    if before is None:
        marked = keys.withColumn("_seen", F.lit(False))
    else:
        marked = (keys.join(before.hint("merge").withColumn("_seen", F.lit(True)), ["a", "b"], "left")
                  .withColumn("_seen", F.coalesce("_seen", F.lit(False))))
    marked = saved(marked.sortWithinPartitions("a", "b"), runs.folder, f"keys-{name}")
    runs.add(marked.filter(~F.col("_seen")).select("a", "b"))
    shared = marked.filter(F.col("_seen") | (F.col("_last") > F.col("_owner")))
    lost = (lines.join(shared, ["a", "b"])
            .filter(F.col("_seen") | (F.col("_id") > F.col("_owner"))))
    lost = lost.groupBy("_id", "_text").agg(F.collect_set("_pos").alias("_lost"))
    return saved(lost, runs.folder, f"lost-{name}")


def drop_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 10,
                        batches: int = BATCHES, fan_in: int = FAN_IN) -> DataFrame:
    """Every document without the lines that a smaller id holds, with n_lines and n_dropped.

    The ids must be integers. A null text stays null.
    """
    spark = docs.sparkSession
    runs = Runs(spark, shared_folder(spark), fan_in)
    lost = _union([add_batch(docs.filter(part), runs, str(k), key, text, least)
                   for k, part in enumerate(line_batches(docs, key, batches))])
    own = [F.coalesce(F.col(key), F.lit(NO_ID)).alias("_id"), F.xxhash64(text).alias("_text")]
    kept = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    met = (docs.select(*kept, *own).join(lost.hint("shuffle_hash"), ["_id", "_text"], "left")
           .withColumn("_split", F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1))
           .withColumn("n_lines", F.size("_split").cast("long"))
           .withColumn("n_dropped", F.coalesce(F.size("_lost"), F.lit(0)).cast("long")))
    places = F.array_except(F.sequence(F.lit(0), F.size("_split") - 1), F.col("_lost"))
    rest = F.array_join(F.transform(places, lambda i: F.element_at("_split", i + 1)), "\n")
    met = met.withColumn(text, F.when(F.col("_lost").isNull(), F.col(text)).otherwise(rest))
    return met.select(*kept, "n_lines", "n_dropped")
