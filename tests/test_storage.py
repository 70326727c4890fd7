from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.schemas import EVENT_SCHEMA, LISTING_SCHEMA
from tidemark.sources import raw, tables, tolerant


def lines_of(spark, tmp_path, *lines):
    folder = tmp_path / "raw" / "snapshot_date=2018-09-08"
    folder.mkdir(parents=True)
    (folder / "part").write_text("\n".join(lines))
    return tolerant.read_lines(spark, f"{tmp_path}/raw")


def test_odd_fields_are_null_and_cost_nothing_else(spark, tmp_path):
    lines = lines_of(
        spark, tmp_path,
        '{"id": 1, "name": "plain", "score": 0.5, "venue": {"id": 7, "name": "hall"}, "geos": [{"name": "a"}, {"name": "b"}]}',
        '{"id": 2, "score": "high", "venue": "nowhere", "geos": [{"name": "a"}, 5, {"other": 1}]}',
        '{"id": "3", "venue": {"id": "x", "name": 9}, "geos": {"name": "a"}, "extra": [1, 2]}',
        '{"id": 4}',
        "",
    )
    good, bad = tolerant.read_tolerant(lines, EVENT_SCHEMA, "id")
    assert good.columns == [f.name for f in EVENT_SCHEMA.fields] + ["snapshot_date"]
    assert [f.dataType for f in good.schema.fields[:-1]] == [f.dataType for f in EVENT_SCHEMA.fields]
    got = {r.id: r for r in good.collect()}
    assert sorted(got) == [1, 2, 3, 4] and bad.count() == 0
    assert got[1].score == 0.5 and got[1].venue.id == 7 and [g.name for g in got[1].geos] == ["a", "b"]
    assert got[2].score is None and got[2].venue is None and [g and g.name for g in got[2].geos] == ["a", None, None]
    assert got[3].venue.id is None and got[3].venue.name == "9" and got[3].geos is None
    assert got[4].venue is None and got[4].name is None


def test_lines_that_are_no_object_are_kept_apart(spark, tmp_path):
    broken = ['{"listingId": 1, "splitVec', "[1, 2]", "17", '{"quantity": 2}', '{"listingId": "none"}']
    good, bad = tolerant.read_tolerant(lines_of(spark, tmp_path, *broken, '{"listingId": 5, "splitVector": [1, "x", 2]}'), LISTING_SCHEMA, "listingId")
    assert rows(good, "listingId", "splitVector") == [(5, [1, None, 2])]
    assert rows(bad, "line", "reason") == sorted(
        zip(broken, ["no JSON", "no object", "no object", "no key", "no key"]), key=repr)
    for _ in range(2):
        tolerant.quarantine(bad, f"{tmp_path}/quarantine")
    assert spark.read.schema(tolerant.QUARANTINE).parquet(f"{tmp_path}/quarantine").count() == 5


def test_a_line_is_parsed_once_and_cast_whole(spark, tmp_path):
    good, bad = tolerant.read_tolerant(lines_of(spark, tmp_path, '{"id": 1}'), EVENT_SCHEMA, "id")
    for frame in (good, bad):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parseJson") == 1
    assert good._jdf.queryExecution().optimizedPlan().toString().count("try_variant_get") <= 2


def test_raw_days_take_less_room_than_their_text(spark, tmp_path):
    objects = spark.range(2000).selectExpr("id", "'a name' AS name", "date'2018-09-08' AS snapshot_date")
    raw.write_raw(objects, f"{tmp_path}/raw", "events")
    text = sum(len(line) + 1 for line in objects.drop("snapshot_date").toJSON().collect())
    assert 0 < sum(f.stat().st_size for f in tmp_path.rglob("part-*")) < text / 3
    assert rows(raw.read_events_json(spark, f"{tmp_path}/raw"), "id", "name") == [(i, "a name") for i in sorted(range(2000), key=lambda i: repr((i, "a name")))]


def test_a_batch_repeated_after_a_failure_is_there_once(spark, monkeypatch):
    text = StructType([StructField("a", StringType())])
    tables.create_schema(spark, "once")
    tables.create_table(spark, "once.staging", text)
    tables.create_table(spark, "once.target", StructType([*text.fields, StructField("batch", StringType())]), ["batch"])
    tables.create_table(spark, "once.ledger", StructType([StructField("batch", StringType())]))
    args = (spark, "once.target", "once.staging", "once.ledger")

    def stage(*values):
        spark.createDataFrame([(v,) for v in values], text).write.insertInto("once.staging")

    stage("x", "y")
    real = tables.truncate
    with monkeypatch.context() as broken:
        # Broken off after the rows and the ledger are written.
        broken.setattr(tables, "truncate", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            tables.append_once(*args, "one")
    tables.append_once(*args, "one")
    assert rows(spark.table("once.target")) == [("x", "one"), ("y", "one")] and spark.table("once.staging").count() == 0
    # Broken off before the ledger knows of it.
    stage("z")
    spark.sql("INSERT INTO once.target SELECT 'z', 'two'")
    tables.append_once(*args, "two")
    assert rows(spark.table("once.target")) == [("x", "one"), ("y", "one"), ("z", "two")]
    tables.append_once(*args, "two")
    assert spark.table("once.target").count() == 3 and spark.table("once.ledger").count() == 2
    real(spark, "once.target")
    for name in ("target", "staging", "ledger"):
        tables.drop_table(spark, f"once.{name}")
    spark.sql("DROP SCHEMA once")
