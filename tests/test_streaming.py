
from tabreg.operators import matrix, models
from tabreg.streaming.scoring import score_stream


def test_stream_scores_equal_batch(spark, tmp_path):
    rows = [(i, float(i % 17), float(i % 5), 1.0 + 0.1 * (i % 17) - 0.2 * (i % 5)) for i in range(400)]
    df = spark.createDataFrame(rows, "key long, a double, b double, y double")
    rec = matrix.Recipe([matrix.Standardize(["a", "b"])]).fit(df)
    fit = models.fit_linear(rec.transform(df), ["a", "b"], "y", models.LinearSpec("ols"))
    src = tmp_path / "in"
    df.drop("y").repartition(4).write.parquet(str(src))
    stream = spark.readStream.schema("key long, a double, b double").parquet(str(src))
    q = score_stream(stream, fit, "key", recipe=rec, back_transform=False) \
        .writeStream.format("memory").queryName("scored_stream").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = {r["key"]: r["prediction"] for r in spark.sql("SELECT * FROM scored_stream").collect()}
    batch = {r["key"]: r["pred"] for r in models.predict_linear(rec.transform(df), fit).collect()}
    assert len(got) == 400
    assert all(abs(got[k] - batch[k]) < 1e-9 for k in batch)
    assert all(abs(batch[k] - y) < 1e-9 for k, _, _, y in rows)
