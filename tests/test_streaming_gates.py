"""A replayed stream against the batch: the cap holds over arriving files, and restarts go on where they stopped."""

import pytest
from pyspark.sql import functions as F

from lexigrove.operators.quality import first_issues
from lexigrove.streaming.gates import capped_counts

SCHEMA = "run string, code string, ord long"


def issues(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return docs.select(F.when(F.col("doc_id") % 3 == 0, "a").otherwise("b").alias("run"), F.concat(F.lit("code"), F.length("text") % 5).alias("code"), F.col("doc_id").alias("ord"))


@pytest.mark.parametrize("limit", [0, 7, 40, 1000])
def test_replay_equals_the_batch(spark, tmp_path, limit):
    whole = issues(spark)
    for k in range(4):  # files arrive in order
        part = whole.filter((F.col("ord") >= 50 * k) & (F.col("ord") < 50 * (k + 1)))
        part.coalesce(1).write.parquet(f"{tmp_path}/part{k}")
    seen = {}

    def keep(batch, _):
        for r in batch.collect():
            seen[r.run, r.code] = (r.n, r.admitted)

    for k in range(4):  # each start goes on from the state of the last
        source = tmp_path / "in"
        source.mkdir(exist_ok=True)
        for f in (tmp_path / f"part{k}").glob("*.parquet"):
            (source / f"{k}-{f.name}").write_bytes(f.read_bytes())
        stream = spark.readStream.schema(SCHEMA).parquet(str(source))
        query = capped_counts(stream, limit).writeStream.foreachBatch(keep).outputMode("update").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
        query.awaitTermination()
    want = {}
    for run in ("a", "b"):
        for r in first_issues(whole.filter(F.col("run") == run), limit, "ord").groupBy("code").count().collect():
            want[run, r.code] = r["count"]
    assert {k: n for k, (n, _) in seen.items()} == want
    assert all(a <= limit for _, a in seen.values())
