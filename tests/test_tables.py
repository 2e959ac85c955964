"""Raw CSV input, the published table and the catalog."""

from __future__ import annotations

from pathlib import Path

import pytest
from timing import utc
from pyspark.sql import functions as F

from tidemark.plans.weekly import sessionized_events
from tidemark.schema import EVENTS, RAW_EVENTS
from tidemark.session import build_session, scratch_path, scratch_run, shared_dir, shuffle_partitions, shuffle_width
from tidemark.sources import catalog, publish, raw
from tidemark.sources.files import folders, present

HEADER = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n"


@pytest.fixture
def csv(tmp_path):
    def write(*lines, name="a.csv"):
        folder = tmp_path / "csv"
        folder.mkdir(exist_ok=True)
        (folder / name).write_text(HEADER + "".join(line + "\n" for line in lines))
        return f"file://{folder}"

    return write


@pytest.mark.parametrize("zone", ["UTC", "Asia/Seoul"])
def test_csv_values(spark, csv, conf, zone):
    conf(spark__sql__session__timeZone=zone)
    path = csv("2019-10-01 00:00:00 UTC,view,44600062,2103807459595387724,,shiseido,35.79,541312140,72d76fde")
    row = raw.read_raw_csv(spark, path).select(F.unix_seconds("event_time").alias("s"), "*").first()
    assert row.s == 1_569_888_000
    assert row.asDict() | {"s": 0, "event_time": None} == {
        "s": 0,
        "event_time": None,
        "event_type": "view",
        "product_id": 44600062,
        "category_id": 2103807459595387724,
        "category_code": None,
        "brand": "shiseido",
        "price": 35.79,
        "user_id": 541312140,
        "user_session": "72d76fde",
    }


def test_bad_cells_become_null_and_rows_stay(spark, csv):
    path = csv(
        "not a time,view,1,2,c,b,1.0,7,s",
        "2019-10-01 00:00:00 UTC,view,many,2,c,b,1.0,7,s",
        "2019-10-01 00:00:00 UTC,,99999999999,2,c,b,cheap,,s",
    )
    csv("2019-10-01 00:00:01 UTC,view,1,2,c,b,1.0,8,s", name="b.csv")
    frame = raw.read_raw_csv(spark, path)
    assert frame.count() == 4
    assert frame.where("event_time is null").count() == 1
    assert frame.where("product_id is null").count() == 2
    last = frame.where("user_id is null").first()
    assert (last.event_type, last.price, last.category_id) == (None, None, 2)
    assert frame.schema == RAW_EVENTS


def test_csv_reads_only_wanted_columns(spark, csv):
    frame = raw.read_raw_csv(spark, csv("2019-10-01 00:00:00 UTC,view,1,2,c,b,1.0,7,s"))
    text = frame.select("user_id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<user_id:bigint>" in text


@pytest.fixture
def published(spark, tmp_path, events):
    path = f"file://{tmp_path}/out"
    rows = [(u, f"2024-01-{d:02d} 0{u}:00:00") for d in (1, 2, 3) for u in (1, 2)]
    publish.write_dates(sessionized_events(events(*rows)), path)
    return path


def files(path: str) -> dict[str, set[str]]:
    root = Path(path.removeprefix("file://"))
    return {d.name: {f.name for f in d.glob("*.parquet")} for d in root.glob("dt=*")}


def test_round_trip(spark, published):
    frame = publish.read_events(spark, published)
    assert frame.schema == EVENTS  # ``dt`` is text
    assert {(r.dt, r["record_count"]) for r in publish.published_counts(spark, published).collect()} == {
        ("2024-01-01", 2), ("2024-01-02", 2), ("2024-01-03", 2)
    }
    assert frame.where("dt = '2024-01-02' and user_id = 1").first().generated_session_id == "1_20240102010000"


def test_only_dates_in_the_frame_are_replaced(spark, published, events):
    before = files(published)
    publish.write_dates(sessionized_events(events((9, "2024-01-02 00:00:00"), (9, "2024-01-05 00:00:00"))), published)
    after = files(published)
    assert after["dt=2024-01-01"] == before["dt=2024-01-01"]
    assert after["dt=2024-01-03"] == before["dt=2024-01-03"]
    assert after["dt=2024-01-02"].isdisjoint(before["dt=2024-01-02"])
    counts = {r.dt: r["record_count"] for r in publish.published_counts(spark, published).collect()}
    assert counts == {"2024-01-01": 2, "2024-01-02": 1, "2024-01-03": 2, "2024-01-05": 1}


def test_one_date_is_pruned_to_its_directory(spark, published):
    frame = publish.read_events(spark, published).where("dt = '2024-01-02'")
    text = frame._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in text
    assert len(frame.inputFiles()) == 1 or frame.select(F.input_file_name()).distinct().count() == 1


def test_some_dates_are_read_without_a_look_at_the_others(spark, published):
    frame = publish.read_dates(spark, published, ["2024-01-02", "1999-01-01", "2024-01-02"])
    assert {r.dt for r in frame.collect()} == {"2024-01-02"}
    assert all("dt=2024-01-02" in name for name in frame.inputFiles())
    assert "dt=2024-01-01" not in frame._jdf.queryExecution().executedPlan().toString()
    whole = publish.read_events(spark, published)
    assert frame.schema == whole.schema
    assert sorted(frame.collect(), key=str) == sorted(whole.where("dt = '2024-01-02'").collect(), key=str)
    assert publish.read_dates(spark, published, []).count() == 0
    assert publish.published_counts(spark, published, ["1999-01-01"]).count() == 0


def test_date_holding_most_rows_is_written_by_many_tasks(spark, tmp_path, conf):
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="512k")
    n = F.col("id")
    day = F.when(n % 10 < 8, 0).otherwise(n % 7)
    frame = spark.range(0, 40_000, 1, 8).select(
        F.timestamp_seconds(1_704_067_200 + day * 86_400).alias("event_time"),
        F.lit("view").alias("event_type"),
        n.cast("int").alias("product_id"),
        n.alias("category_id"),
        F.sha2(n.cast("string"), 256).alias("category_code"),
        F.sha2((n + 1).cast("string"), 256).alias("brand"),
        F.lit(1.0).alias("price"),
        n.alias("user_id"),
        F.lit("s").alias("user_session"),
    )
    path = f"file://{tmp_path}/out"
    publish.write_dates(sessionized_events(frame), path)
    per_date = {name: len(found) for name, found in files(path).items()}
    assert per_date["dt=2024-01-01"] >= 3, per_date
    assert sum(n == 1 for n in per_date.values()) >= 4, per_date
    assert publish.read_events(spark, path).count() == 40_000


def test_empty_root_is_created_once(spark, published, tmp_path):
    publish.ensure_root(spark, published)
    assert publish.read_events(spark, published).count() == 6
    publish.ensure_root(spark, f"file://{tmp_path}/new")
    assert publish.published_counts(spark, f"file://{tmp_path}/new").isEmpty()


def test_catalog(spark, published):
    table = "activity_test.events"
    try:
        for _ in range(2):
            catalog.ensure_table(spark, published, table)
        assert catalog.read_table(spark, table).schema == EVENTS
        assert catalog.read_table(spark, table).isEmpty()  # nothing registered yet
        catalog.register_dates(spark, ["2024-01-01"], published, table)
        catalog.register_dates(spark, ["2024-01-03", "2024-01-01"], published, table)
        assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()] == [
            "dt=2024-01-01", "dt=2024-01-03"
        ]
        assert catalog.read_table(spark, table).count() == 4
        assert catalog.analyze_dates(spark, ["2024-01-01"], table)
        described = spark.sql(f"DESCRIBE EXTENDED {table} PARTITION (dt='2024-01-01')").collect()
        assert any(r[0] == "Partition Statistics" and "2 rows" in r[1] for r in described)
        assert catalog.analyze_once(spark, table)
        stats = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {table} user_id").collect()}
        assert stats["distinct_count"] == "2"
        spark.sql(f"DROP TABLE {table}")
        assert publish.read_events(spark, published).count() == 6  # files are not the table's
        assert not catalog.analyze_once(spark, table)  # best effort
        assert not catalog.analyze_dates(spark, ["2024-01-01"], table)
    finally:
        spark.sql("DROP DATABASE IF EXISTS activity_test CASCADE")


def test_many_dates_take_several_statements(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "DATES_PER_STATEMENT", 2)
    table, path = "default.many_dates", f"file://{tmp_path}/many"
    publish.ensure_root(spark, path)
    catalog.ensure_table(spark, path, table)
    try:
        catalog.register_dates(spark, [f"2024-01-0{i}" for i in range(1, 6)], path, table)
        assert spark.sql(f"SHOW PARTITIONS {table}").count() == 5
    finally:
        spark.sql(f"DROP TABLE {table}")


def test_activity_table_is_utc_under_any_zone(spark, conf):
    conf(spark__sql__session__timeZone="Asia/Seoul")
    first = raw.read_activity_table(spark, "/root/testdata/sf0.001").agg(F.min("event_time").alias("t"))
    second = first.select(F.unix_seconds("t")).first()[0]
    assert utc("2024-01-01").timestamp() <= second < utc("2024-01-02").timestamp()


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


class Elsewhere:
    """A session on a cluster, as far as the shared folder is concerned."""

    def __init__(self, master):
        self.sparkContext = self.conf = self
        self.master = master

    def get(self, *_):
        return None

    def getCheckpointDir(self):
        return None


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[3,2,3000]"])
def test_no_folder_of_one_machine_on_a_cluster(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Elsewhere(master))


def test_session_is_as_wide_as_its_input(spark, conf):
    conf(spark__sql__shuffle__partitions="8")
    build_session(events=10**12, extra={"spark.sql.session.timeZone": "UTC"})
    assert spark.conf.get("spark.sql.shuffle.partitions") == "186265"


def test_table_over_another_location_is_refused(spark, published, tmp_path):
    table = "default.one_place"
    try:
        catalog.ensure_table(spark, published, table)
        catalog.ensure_table(spark, published + "/", table)
        with pytest.raises(ValueError, match="one_place lies at"):
            catalog.ensure_table(spark, f"file://{tmp_path}/elsewhere", table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_shuffle_width(spark):
    assert shuffle_partitions(0) == 1
    assert shuffle_partitions(10**9) == 187
    assert shuffle_partitions(10**12) == 186_265  # no fixed upper limit
    assert shuffle_partitions(10**12, 1_000) == 1_862_646
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(RuntimeError), shuffle_width(spark, 10**9):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "187"
        raise RuntimeError
    with shuffle_width(spark, 10):
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_scratch_of_a_run_goes_with_it(spark):
    outside = scratch_path(spark, "kept")
    spark.range(3).write.parquet(outside)
    with scratch_run(spark) as folder:
        first = scratch_path(spark, "first")
        spark.range(5).write.parquet(first)
        with scratch_run(spark) as inner:
            spark.range(2).write.parquet(scratch_path(spark, "second"))
            assert inner.startswith(folder) and len(folders(spark, inner)) == 1
        assert present(spark, [first, inner]) == [first]
    assert present(spark, [folder, outside]) == [outside]
    assert not scratch_path(spark, "later").startswith(folder)
    with pytest.raises(ValueError), scratch_run(spark) as folder:
        spark.range(1).write.parquet(scratch_path(spark, "lost"))
        raise ValueError
    assert present(spark, [folder]) == []
    with scratch_run(spark):
        pass  # nothing was written
