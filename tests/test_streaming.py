import datetime as dt

import pytest

from lakemart.plans.staging import stage
from lakemart.sources.contract import COMMERCE_CONTRACT
from lakemart.streaming import changes

UTC = dt.timezone.utc
COLUMNS = COMMERCE_CONTRACT.datasets["sellers"].required_columns
SCHEMA = ", ".join(f"{c} string" for c in COLUMNS) + ", updated_at timestamp"


def land(spark, folder, rows):
    full = [(i, "1", city, "SP", dt.datetime(2024, 1, day, tzinfo=UTC)) for i, city, day in rows]
    spark.createDataFrame(full, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_stream_equals_batch(spark, lake, tmp_path):
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    land(spark, folder, [("s1", "old", 1), ("s2", "b", 2)])
    built = []

    def run():
        stream = changes.read_changes(spark, folder, SCHEMA)
        query = changes.start(lake, "sellers", stream, checkpoint, lambda _: built.append(1))
        assert query.awaitTermination(120)

    run()
    land(spark, folder, [("s1", "new", 3)])
    run()
    run()
    raw = lake.read("raw.sellers")
    assert raw.count() == 3
    cities = {r["seller_id"]: r["seller_city"] for r in stage("sellers", raw).collect()}
    assert cities == {"s1": "new", "s2": "b"}
    assert len(built) == 2
    assert lake.read("audit.load_history").count() == 2

    # a replayed micro-batch adds nothing
    again = spark.read.schema(SCHEMA).parquet(folder)
    batch = f"stream-sellers-{changes.stream_id(spark, checkpoint)}-0"
    assert changes.append_batch(lake, "sellers", again, batch) == 0
    assert lake.read("raw.sellers").count() == 3
    # a stream with a new checkpoint is no replay of the first
    checkpoint = str(tmp_path / "another")
    run()
    assert lake.read("raw.sellers").count() == 6
    with pytest.raises(ValueError, match="no incremental extract"):
        changes.start(lake, "reviews", again, checkpoint)
