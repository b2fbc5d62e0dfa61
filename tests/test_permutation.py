import numpy as np
import pytest
from pyspark.sql import functions as F

from baitline.operators.permutation import Permutation, numbered_files, permuted_files


@pytest.mark.parametrize("seed", [1, 42])
def test_every_place_once(seed):
    for n in [*range(1, 200), 1000, 4097, 65_537, 100_000]:
        p = Permutation(n, seed)
        places = p.once(np.arange(n))
        for _ in range(p.walks):
            places = np.where(places < n, places, p.once(places))
        assert sorted(places) == list(range(n))
        if p.walks:  # one pass less is not enough
            places = p.once(np.arange(n))
            for _ in range(p.walks - 1):
                places = np.where(places < n, places, p.once(places))
            assert places.max() >= n


def test_order_looks_random():
    n = 100_000
    p = Permutation(n)
    places = p.once(np.arange(n))
    places = places[places < n]
    assert abs(np.corrcoef(np.arange(len(places)), places)[0, 1]) < 0.02
    assert abs((np.diff(places) > 0).mean() - 0.5) < 0.01
    assert (np.abs(np.diff(places)) < 100).mean() < 0.004
    tiles = np.bincount(np.arange(len(places)) // 1000 * 100 + places // 1000, minlength=10_000)
    assert 0.8 < tiles.var() / tiles.mean() < 1.2


def test_columns_equal_numpy(spark):
    for n in (1, 2, 7, 50, 3000):
        p = Permutation(n, 5)
        got = {r.id: r.place for r in p.with_place(spark.range(n).withColumn("place", F.lit("x")), "id").collect()}
        want = p.once(np.arange(n))
        for _ in range(p.walks):
            want = np.where(want < n, want, p.once(want))
        assert [got[i] for i in range(n)] == list(want)
    odd = spark.createDataFrame([(None,)], "id long")
    assert Permutation(9).with_place(odd, "id").first().place is None
    with pytest.raises(ValueError):
        Permutation(0)


def test_files_in_even_parts_and_the_same_order_again(spark, tmp_path):
    path = str(tmp_path / "in")
    held = spark.range(0, 1000, 1, 7).selectExpr("id", "id % 3 = 0 AS hot", "if(id < 400, 'same', string(id)) AS text")
    held.write.parquet(path)
    numbers = numbered_files(spark, path)
    assert sorted(r.number for r in numbers.collect()) == list(range(1000))
    rows = permuted_files(spark, path, rows_per_part=128)
    sizes = rows.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sorted(r["count"] for r in sizes) == [104] + [128] * 7
    written = str(tmp_path / "out")
    rows.write.parquet(written)
    again = {(r.id, r.place) for r in permuted_files(spark, path, rows_per_part=300).collect()}
    assert {(r.id, r.place) for r in spark.read.parquet(written).collect()} == again and len(again) == 1000
    in_file = spark.read.parquet(written).select("place", F.col("_metadata.file_path").alias("f"),
                                                 F.col("_metadata.row_index").alias("at")).collect()
    for f in {r.f for r in in_file}:
        places = [r.place for r in sorted((r for r in in_file if r.f == f), key=lambda r: r.at)]
        assert places == list(range(places[0], places[0] + len(places)))
    plan = permuted_files(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    spark.range(0).selectExpr("id", "id AS place").write.parquet(str(tmp_path / "none"))
    none = permuted_files(spark, str(tmp_path / "none"))
    assert none.columns == ["id", "place"] and none.count() == 0
