from pyspark.sql import functions as F

from gridlark.functions import s2_cell_id
from gridlark.streaming import windowed_density

EVENTS = "/root/testdata/sf0.001"


def test_cells_on_a_file_stream(spark, tmp_path):
    events = spark.read.parquet(f"{EVENTS}/events.parquet")
    events.select("event_id", "ts").repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("event_id long, ts timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    points = stream.selectExpr("ts", "CAST(event_id % 160 - 80 AS DOUBLE) AS lat", "CAST(event_id % 359 - 179 AS DOUBLE) AS lon")
    cells = s2_cell_id.add(points, "cell", "lat", "lon", 6)
    q = cells.writeStream.format("memory").queryName("cells").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    density = windowed_density(points, "lat", "lon", 6, "ts", "1 day", "100 days")
    p = density.writeStream.format("memory").queryName("density").outputMode("complete").trigger(availableNow=True).start()
    p.awaitTermination(120)
    assert spark.table("cells").count() == events.count()
    want = {r.cell: r["count"] for r in spark.table("cells").groupBy("cell").count().collect()}
    got = {r.cell_id: r.n for r in spark.table("density").groupBy("cell_id").agg(F.sum("n").alias("n")).collect()}
    assert got == want


