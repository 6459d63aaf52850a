import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from viaduct import schemas, sinks, sources
from viaduct.sinks.jdbc import SAVE_MODES, jdbc_micro_batch, write_jdbc
from viaduct.sinks.kafka import PRODUCER_OPTIONS
from viaduct.sinks.replay import missing_of_batch, parquet_micro_batch

ROADS_CSV = """road_id,road_name,road_type,length_km,num_lanes,speed_limit_kmh,city
1,North Square,Urban,9.9,4,50,Cairo
2,South Ring,Highway,21.3,4,90,Cairo
"""
SENSORS_CSV = """sensor_id,road_id,latitude,longitude,installation_date,is_active
SENSOR_NORTH_SQUARE_01,1,30.0444,31.2357,2026-03-07,True
SENSOR_SOUTH_RING_01,2,30.012,31.205,2026-03-07,False
"""


@pytest.fixture
def history(tmp_path):
    (tmp_path / "historical_roads.csv").write_text(ROADS_CSV)
    (tmp_path / "historical_sensors.csv").write_text(SENSORS_CSV)
    return str(tmp_path)


class FakeIo:
    """Stands in for a reader or writer and records what it was told."""

    def __init__(self, log, result=None):
        self.log, self.result = log, result

    def __getattr__(self, name):
        def call(*args, **kwargs):
            if name in ("save", "start", "load"):
                self.log.append((name, args))
                return self.result
            self.log.append((name, args or kwargs))
            return self
        return call


class FakeFrame:
    def __init__(self, empty=False):
        self.log, self.empty = [], empty
        self.write = FakeIo(self.log)
        self.columns = ["a"]

    def isEmpty(self):
        return self.empty


def test_history_files_have_the_declared_schemas(spark, history):
    tables = sources.load_reference_dimensions(spark, history, views=True)
    assert set(tables) == {"roads", "sensor_locations"}
    assert rows(tables["roads"].select("road_id", "length_km")) == [(1, 9.9), (2, 21.3)]
    assert rows(spark.sql("select sensor_id, installation_date, is_active from sensor_locations")) == [
        ("SENSOR_NORTH_SQUARE_01", dt.date(2026, 3, 7), True), ("SENSOR_SOUTH_RING_01", dt.date(2026, 3, 7), False)]


def test_missing_paths(spark, tmp_path, history):
    events = schemas.TRAFFIC_EVENTS
    with pytest.raises(FileNotFoundError):
        sources.read_csv(spark, str(tmp_path / "none.csv"), schemas.ROADS)
    empty = sources.read_parquet(spark, str(tmp_path / "none"), events)
    assert empty.count() == 0 and empty.columns == events.names
    with pytest.raises(sources.SourceNotFound):
        sources.read_events_with_fallback(spark, str(tmp_path / "none"), str(tmp_path / "none.csv"), events, events)


def test_lake_comes_before_the_csv(spark, tmp_path, history):
    csv, lake = f"{history}/historical_roads.csv", str(tmp_path / "lake")
    schema = schemas.without(schemas.ROADS, "created_at")
    read = lambda: sources.read_events_with_fallback(spark, lake, csv, schema, schema)
    assert read().count() == 2
    sinks.write_parquet(read().where("road_id = 1"), lake)
    assert rows(read().select("road_id")) == [(1,)]


def test_header_must_match(spark, tmp_path):
    (tmp_path / "roads.csv").write_text(ROADS_CSV.replace("road_name,road_type", "road_type,road_name"))
    with pytest.raises(Exception, match="header"):
        sources.read_csv(spark, str(tmp_path / "roads.csv"), schemas.without(schemas.ROADS, "created_at")).collect()


def test_date_partitions_replace_only_their_own_days(spark, tmp_path):
    path = str(tmp_path / "lake")
    def day(*pairs):
        return spark.createDataFrame([(dt.datetime.fromisoformat(t), v) for t, v in pairs], "timestamp timestamp_ntz, v int")
    sinks.write_date_partitioned(day(("2024-01-31T10:00", 1), ("2024-02-01T00:00", 2), ("2024-02-01T05:00", 3)), path)
    sinks.write_date_partitioned(day(("2024-02-01T09:00", 4)), path)
    back = spark.read.parquet(path)
    assert rows(back.select("v", "year", "month", "day")) == [(1, 2024, 1, 31), (4, 2024, 2, 1)]
    flat = str(tmp_path / "flat")
    sinks.write_date_partitioned(spark.range(3), flat)
    assert spark.read.parquet(flat).columns == ["id"]


def test_lookback_opens_only_the_days_it_needs(spark, tmp_path):
    from conftest import plan
    from viaduct.operators.reports import lookback_filter
    path = str(tmp_path / "lake")
    days = spark.range(40).select("id", (F.timestamp_seconds(1_700_000_000 + F.col("id") * 86400)).alias("timestamp"))
    sinks.write_date_partitioned(days, path)
    as_of = F.timestamp_seconds(F.lit(1_700_000_000 + 39 * 86400))
    lake = spark.read.parquet(path)
    pruned = lookback_filter(lake, as_of, 48, date_partitioned=True)
    assert rows(pruned.select("id")) == rows(lookback_filter(lake, as_of, 48).select("id")) == [(38,), (39,)]
    assert "PartitionFilters: [isnotnull(year" in plan(pruned)
    assert len(pruned.select("id").inputFiles()) == 40  # all that the dataset has
    scanned = pruned.select(F.input_file_name().alias("f")).distinct()
    assert scanned.count() == 2


def test_csv_export_has_a_header(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.export_csv(spark.range(2), path)
    assert sorted(r.id for r in spark.read.option("header", True).csv(path).collect()) == ["0", "1"]


def test_query_parameters_are_values_and_not_text(spark):
    frame = spark.createDataFrame([("a",), ("x' or '1'='1",)], "v string")
    found = sources.read_query(spark, "select v from {t} where v = :v", {"v": "x' or '1'='1"}, {"t": frame})
    assert rows(found) == [("x' or '1'='1",)]


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "table")
    write = parquet_micro_batch(path)
    write(spark.range(3), 0)
    write(spark.range(3, 5), 1)
    write(spark.range(3, 5), 1)
    assert rows(spark.read.parquet(path).select("id", "batch_id")) == [(0, 0), (1, 0), (2, 0), (3, 1), (4, 1)]


def test_half_written_batch_is_completed(spark):
    target = spark.createDataFrame([(1, 7), (9, 6)], "event_id int, batch_id int")
    batch = spark.createDataFrame([(1,), (2,), (9,)], "event_id int")
    assert rows(missing_of_batch(batch, 7, target, ["event_id"])) == [(2, 7), (9, 7)]


# No database is started for these: they check what Spark would be told.
TARGET = sources.JdbcTarget("jdbc:postgresql://db/traffic", "user", "secret")


def test_jdbc_write_options_and_modes():
    for if_exists, mode in {"append": "append", "replace": "overwrite", "fail": "errorifexists"}.items():
        frame = FakeFrame()
        write_jdbc(frame, TARGET, "roads", if_exists)
        assert ("mode", (mode,)) in frame.log and ("option", ("dbtable", "roads")) in frame.log
    options = dict(frame.log[1][1])
    assert options["batchsize"] == "10000" and options["numPartitions"] == "16" and options["user"] == "user"
    empty = FakeFrame(empty=True)
    write_jdbc(empty, TARGET, "roads", "replace")
    assert empty.log == []
    with pytest.raises(KeyError):
        write_jdbc(frame, TARGET, "roads", "merge")
    assert "secret" not in repr(TARGET) and set(SAVE_MODES) == {"append", "replace", "fail"}


def test_jdbc_read_is_split_over_connections():
    class Extremes:
        found = (3, 90)

        def first(self):
            return self.found

    class Session:
        log = []
        read = FakeIo(log, Extremes())

    def split():
        return [told for name, told in Session.log if name == "options" and "partitionColumn" in told]
    sources.read_table(Session, TARGET, "traffic_events", split_on="event_id", bounds=(0, 100))
    assert split() == [{"partitionColumn": "event_id", "lowerBound": "0", "upperBound": "100", "numPartitions": "16"}]
    sources.read_table(Session, TARGET, "traffic_events", split_on="event_id")
    assert split()[1]["lowerBound"] == "3" and split()[1]["upperBound"] == "90"
    assert ("option", ("query", "SELECT min(event_id) AS low, max(event_id) AS high FROM traffic_events")) in Session.log
    Extremes.found = (None, None)
    sources.read_table(Session, TARGET, "traffic_events", split_on="event_id")
    assert len(split()) == 2
    sources.read_table(Session, TARGET, "traffic_events", query="select 1")
    assert ("option", ("dbtable", "(select 1) AS selected")) in Session.log


def test_jdbc_micro_batch_adds_only_what_is_missing(spark, monkeypatch):
    import viaduct.sinks.jdbc as module
    stored = [spark.createDataFrame([(1, 0)], "event_id int, batch_id int")]
    monkeypatch.setattr(module, "read_table", lambda spark, target, table: stored[0])
    monkeypatch.setattr(module, "write_jdbc", lambda df, target, table: stored.append(df))
    jdbc_micro_batch(TARGET, "traffic_events", ["event_id"])(spark.createDataFrame([(1,), (2,)], "event_id int"), 0)
    assert rows(stored[1]) == [(2, 0)]


def test_kafka_options_and_messages(spark):
    chosen = sources.kafka_options("host:9092", ["traffic", "weather"], starting_offsets="latest", min_partitions=64)
    assert chosen == {"kafka.bootstrap.servers": "host:9092", "subscribe": "traffic,weather",
                      "startingOffsets": "latest", "minPartitions": "64"}
    body = sources.decode_value(spark.createDataFrame([(bytearray(b"{}"), 1)], "value binary, offset long"))
    assert rows(body) == [("{}",)]
    frame = spark.createDataFrame([("S1", 5, None)], "sensor_id string, n int, gone string")
    assert rows(sinks.to_messages(frame, key="n")) == [("5", '{"sensor_id":"S1","n":5}')]
    assert rows(sinks.to_messages(frame)) == [(None, '{"sensor_id":"S1","n":5}')]
    assert PRODUCER_OPTIONS["kafka.acks"] == "all" and PRODUCER_OPTIONS["kafka.compression.type"] == "gzip"


def test_kafka_readers_ask_for_the_right_offsets():
    class Result:
        def select(self, *_):
            return "values"
    class Session:
        log = []
        read = readStream = FakeIo(log, Result())
    assert sources.read_kafka_stream(Session, "h:1", "traffic") == "values"
    assert dict(Session.log[1][1])["startingOffsets"] == "latest"
    assert sources.read_kafka_batch(Session, "h:1", "traffic", group_id="g") == "values"
    batch = dict(Session.log[4][1])
    assert (batch["startingOffsets"], batch["endingOffsets"], batch["kafka.group.id"]) == ("earliest", "latest", "g")


def test_shared_folder_is_the_session_setting(spark):
    from viaduct.session import shared_dir, shared_path
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert shared_path(spark, "x") != shared_path(spark, "x")


def test_schemas_cover_the_model():
    assert set(schemas.TABLES) == set(schemas.KEYS) and len(schemas.READING) == 20
    for child, columns in schemas.REFERENCES.items():
        for column, parent in columns.items():
            kinds = schemas.TABLES[child][column].dataType, schemas.TABLES[parent][schemas.KEYS[parent]].dataType
            assert kinds[0] == kinds[1], (child, column)
    assert schemas.required_columns(schemas.BATCH_REPORTS)[1:3] == ["report_type", "report_date"]
    assert F is not None
