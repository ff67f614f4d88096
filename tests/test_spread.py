"""A written table is dealt over the cores, the same way for the same rows."""

from pyspark.sql import functions as F

from gable.ml import boosting, models, search
from gable.ml.features import assemble
from gable.session import cut_lineage, scratch_path, spread

SIZE = {"maxIter": 2, "maxDepth": 2, "subsamplingRate": 0.7}


def table(spark, order="id"):
    df = spark.range(60_000).select((F.col("id") % 97).cast("double").alias("x"), (F.col("id") * 1.5).alias("y"),
                                    (F.col("id") % 5).cast("int").alias("fold"), (F.col("id") % 4 == 0).alias("is_val"), "id")
    return df.orderBy(order).drop("id").coalesce(1)


def parts(df):
    return [[tuple(r) for r in p] for p in df.rdd.glom().collect()]


def test_one_partition_becomes_as_many_as_cores_and_order_does_not_matter(spark):
    one = cut_lineage(table(spark))
    cores = spark.sparkContext.defaultParallelism
    assert one.rdd.getNumPartitions() == 1
    got = parts(spread(one))
    assert len(got) == min(cores, 12) and sum(map(len, got)) == 60_000
    assert got == parts(spread(cut_lineage(table(spark, F.desc("id")))))
    assert spread(one, fits=cores) is one and spread(one, rows_each=60_000) is one


def test_a_boosted_fit_reads_rows_on_all_cores(spark):
    matrix = assemble(table(spark), ["x"], "y", keep=["is_val"]).df
    path = scratch_path(spark, "b")
    boosting.fit_boosted(matrix, path, SIZE, chunk=1, val_col="is_val", max_chunks=1)
    assert len(spark.read.parquet(f"{path}/state=1").inputFiles()) > 1


def test_files_of_equal_size_are_read_by_name(spark):
    path = scratch_path(spark, "b")
    spark.range(8, numPartitions=8).write.option("compression", "none").parquet(f"{path}/state=0")
    assert [r.id for r in boosting._state(spark, path, 0).collect()] == list(range(8))


def test_fits_of_folds_and_segments_read_dealt_rows(spark, monkeypatch):
    seen = []

    class Stop(Exception):
        pass

    class Recorder:
        def fit(self, df):
            seen.append(df.rdd.getNumPartitions())
            raise Stop

    for owner in (models, search):
        monkeypatch.setattr(owner, "make_regressor", lambda *a: Recorder())
    df = table(spark)
    runs = (lambda: models.cross_validate(df, ["x"], "y", "xgb", SIZE, k=2, parallelism=1),
            lambda: search.fit_segment_models(df.where("is_val").withColumn("s", F.lit("a")).coalesce(1), "s", {"a": "a"}, ["x"], "y"),
            lambda: search.recursive_feature_elimination(df, ["x"], "y", k=2))
    for run in runs:
        try:
            run()
        except Stop:
            pass
        assert seen and min(seen) > 1
        seen.clear()
