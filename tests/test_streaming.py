from pyspark.sql import functions as F

from pushbroom.operators import spectra as S
from pushbroom.streaming import ingest


def test_a_stream_equals_its_batch(spark, tmp_path):
    p = spark.range(40).select(F.lit("p").alias("product_id"), F.col("id").cast("double").alias("y"), F.lit(0.5).alias("x"), F.array(*(F.col("id") * 1.0 + b for b in range(12))).alias("spectrum"))
    p.write.parquet(str(tmp_path / "in"))
    flux = F.array(*(F.lit(2.0) for _ in range(12)))
    stream = ingest.reflectance_stream(ingest.stream_pixels(spark, str(tmp_path / "in"), p.schema), F.lit(0.5), flux)
    ingest.append_to(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    want = p.withColumn("spectrum", S.reflect(S.mask_bands(F.col("spectrum")), None, F.lit(0.5), flux))
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == sorted(map(tuple, want.collect()))


def test_windows_of_events(spark):
    e = spark.createDataFrame([("2024-01-01 00:10:00", "a", 1.0), ("2024-01-01 00:50:00", "a", 3.0), ("2024-01-01 01:10:00", "a", 5.0)], "t string, event_type string, value double").withColumn("ts", F.to_timestamp("t"))
    assert sorted((r.n, r["mean"]) for r in ingest.windowed_means(e).collect()) == [(1, 5.0), (2, 2.0)]
