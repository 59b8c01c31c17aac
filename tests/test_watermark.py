"""Watermarks of tables in the state store of a stream."""

import os
import random

from pyspark.sql import functions as F

from lakeload.streaming.watermark import BUCKETS, start_watermark_filter

SCHEMA = "table_id bigint, key string, last_modified timestamp, size bigint"


class Stream:
    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)
        os.makedirs(f"{self.root}/input")

    def run(self, rows, salts=8):
        df = self.spark.createDataFrame(rows, "table_id bigint, key string, second double, size bigint")
        df.withColumn("last_modified", F.timestamp_micros((F.col("second") * 1_000_000).cast("long"))).drop("second").write.mode("append").parquet(f"{self.root}/input")
        stream = self.spark.readStream.schema(SCHEMA).parquet(f"{self.root}/input")
        start_watermark_filter(stream, f"{self.root}/output", f"{self.root}/checkpoint", {"availableNow": True}, salts).awaitTermination()
        return sorted(r["key"] for r in self.spark.read.parquet(f"{self.root}/output").collect())


def test_watermark_survives_restarts_and_drops_late_objects(spark, tmp_path):
    stream = Stream(spark, tmp_path)
    assert stream.run([(1, "a", 100.0, 5), (1, "b", 50.0, None), (2, "c", 10.0, 2**60 + 1), (None, "n", 1.0, 1)]) == ["a", "b", "c", "n"]
    # same second and older are late; a null table has no watermark, a null time is never newer
    found = stream.run([(1, "d", 100.9, 0), (1, "e", 99.0, 0), (1, "f", 101.0, 0), (2, "g", 11.0, 0), (3, "h", 1.0, 0), (None, "m", 0.0, 1), (1, "t", None, 1)])
    assert found == ["a", "b", "c", "f", "g", "h", "m", "n"]
    assert stream.run([(1, "i", 100.0, 0), (3, "j", 2.0, 0)]) == ["a", "b", "c", "f", "g", "h", "j", "m", "n"]
    sizes = {r["key"]: r["size"] for r in spark.read.parquet(f"{tmp_path}/output").collect()}
    assert sizes["c"] == 2**60 + 1 and sizes["b"] is None
    assert sorted(os.listdir(tmp_path)) == ["checkpoint", "input", "output"]  # no state beside the checkpoint's


def test_a_hot_table_shares_one_watermark_over_all_groups(spark, tmp_path):
    rng = random.Random(4)
    stream, seen, want = Stream(spark, tmp_path), {}, []
    for batch in range(3):
        rows = [(rng.choice([7, 7, 7, 7, 8, 9]), f"{batch}-{i}", float(rng.randint(0, 200) + 100 * batch), i) for i in range(400)]
        want += [key for table, key, second, _ in rows if table not in seen or second > seen[table]]
        for table, _, second, _ in rows:
            seen[table] = max(seen.get(table, second), second)
        assert stream.run(rows, salts=5) == sorted(want)


def test_many_tables_share_groups_of_state(spark, tmp_path):
    """As many groups as buckets and salts at most, whatever the number of tables; each table has its own watermark."""
    stream = Stream(spark, tmp_path)
    stream.run([(t, f"a{t}", float(t), 1) for t in range(3000)], salts=1)
    found = stream.run([(t, f"b{t}", float(t + t % 2), 1) for t in range(3000)], salts=1)
    assert found == sorted([f"a{t}" for t in range(3000)] + [f"b{t}" for t in range(1, 3000, 2)])
    rows = spark.read.format("statestore").load(f"{tmp_path}/checkpoint")
    assert 0 < rows.count() <= BUCKETS
