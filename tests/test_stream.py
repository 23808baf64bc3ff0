from tallyframe.functions.expr import col
from tallyframe.streaming.follow import follow_parquet


def test_new_files_go_through_once(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "in"))
    for extra in (0, 5):
        if extra:
            spark.range(10, 10 + extra).write.mode("append").parquet(str(tmp_path / "in"))
        verbs = lambda f: f.filter(col("id") % 2 == 0).select((col("id") * 10).alias("x"))
        follow_parquet(spark, str(tmp_path / "in"), "id long", verbs, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert sorted(r.x for r in spark.read.json(str(tmp_path / "out")).collect()) == [0, 20, 40, 60, 80, 100, 120, 140]
