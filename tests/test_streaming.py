"""Streams over landing folders: every record once, across batches and restarts."""

import json
from collections import Counter

from linegauge.operators.flatten import flat_fixtures, flat_odds
from linegauge.sources import landed, tables
from linegauge.streaming.ingest import stream_fixtures, stream_odds


def drop(folder, name, records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps(records))


def test_odds_stream_restarts_from_its_checkpoint(spark, tmp_path):
    landing, target, checkpoint = tmp_path / "in", "streamed_odds", str(tmp_path / "cp")
    tables.create_odds_table(spark, target, str(tmp_path / "out"))
    record = lambda i: {"id": str(i), "name": "Over", "olv": {"price": i * 1.0, "points": 0.5}}
    drop(landing, "a.json", [record(1), record(2)])
    stream_odds(spark, str(landing), target, checkpoint).awaitTermination()
    assert spark.table(target).count() == 2
    drop(landing, "b.json", [record(2), record(3)])
    drop(landing, "c.json", [])
    for _ in range(2):
        stream_odds(spark, str(landing), target, checkpoint, files_per_batch=1).awaitTermination()
    stored = spark.table(target)
    # Records equal in content are kept, files are not read twice.
    assert Counter(r.id for r in stored.collect()) == Counter({"1": 1, "2": 2, "3": 1})
    batch = flat_odds(landed.odds(spark, str(landing)))
    assert sorted(map(str, stored.collect())) == sorted(map(str, batch.collect()))
    # A batch load appends to the same table, and the stream goes on after it.
    assert tables.append_rows(batch.filter("id = '1'"), target) == 1
    drop(landing, "d.json", [record(4)])
    stream_odds(spark, str(landing), target, checkpoint).awaitTermination()
    found = Counter(r.id for r in spark.table(target).collect())
    assert found == Counter({"1": 2, "2": 2, "3": 1, "4": 1})
    assert Counter(r.id for r in tables.table_files(spark, str(tmp_path / "out"), stored.schema).collect()) == found
    spark.sql(f"DROP TABLE {target}")


def test_fixture_stream_equals_batch(spark, tmp_path):
    landing, target = tmp_path / "in", "streamed_fixtures"
    tables.create_fixture_table(spark, target, str(tmp_path / "out"))
    drop(landing, "a.json", [{"id": "a", "result": None, "home_competitors": [{"b": 1, "a": 2}]}, {"id": "b"}])
    stream_fixtures(spark, str(landing), target, str(tmp_path / "cp")).awaitTermination()
    batch = flat_fixtures(landed.fixtures(spark, str(landing)))
    assert sorted(map(str, spark.table(target).collect())) == sorted(map(str, batch.collect()))
    spark.sql(f"DROP TABLE {target}")
