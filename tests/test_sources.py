import json

import pytest
from conftest import event
from pyspark.sql import functions as F

from roomtide.operators import gold
from roomtide.operators.registry import SEEDS, config_events, fold_registry, manual_add
from roomtide.sinks.messages import append_jsonl, kafka_sink_options, stamp, to_messages, write_kafka
from roomtide.sinks.registry_files import snapshot_info, snapshot_records, write_registry
from roomtide.sources.archive import day_path, read_day
from roomtide.sources.envelopes import good, parse_envelopes, quarantined, read_jsonl, well_formed
from roomtide.sources.kafka import kafka_options
from roomtide.sources.object_store import object_store_conf
from roomtide.sources.registry_files import read_registry, read_snapshot

LINES = [
    '{"streamer":"s1","event_type":"gift","received_at":"2024-01-01T00:00:00+00:00","data":{"a":[1, 2],"b":"é"}}',
    '{"streamer":"s1","event_type":"gift"',
    "",
    "   ",
    "not json",
    '{"streamer":"s2","event_type":"like","received_at":"soon","data":{}}',
    "{}",
]


def test_lines_are_parsed_or_quarantined(spark, tmp_path):
    path = tmp_path / "events.jsonl"
    path.write_text("\n".join(LINES), encoding="utf-8")
    parsed = read_jsonl(spark, str(path))
    (row,) = good(parsed).collect()
    assert json.loads(row.data) == {"a": [1, 2], "b": "é"}
    assert (row.category, row.archetype) == (None, None)
    assert sorted(tuple(r) for r in quarantined(parsed).collect()) == sorted([
        (LINES[1], "malformed_json"), (LINES[4], "malformed_json"),
        (LINES[5], "bad_timestamp"), (LINES[6], "bad_timestamp"),
    ])


def test_totals_count_parsed_lines(spark):
    parsed = parse_envelopes(spark.createDataFrame([(x,) for x in LINES], "value string"))
    counts = {r.event_type: r.cnt for r in gold.event_breakdown(well_formed(parsed)).collect()}
    assert counts == {"gift": 1, "like": 1, None: 1}
    assert well_formed(parsed, include_malformed=True).count() == 5


def test_missing_file_stops(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_jsonl(spark, str(tmp_path / "none.jsonl"))


def test_messages_keep_the_payload(spark, envelope):
    payload = '{"b": 1.50, "a":"ü"}'
    env = envelope(event("gift", payload, archetype=None), event("gift", "oops"), event("gift", None))
    rows = to_messages(env, "t.").collect()
    assert {r.topic for r in rows} == {"t.npc"}
    assert payload in rows[0].value and '"archetype":null' in rows[0].value
    assert [json.loads(r.value)["data"] for r in rows] == [{"b": 1.5, "a": "ü"}, "oops", None]
    assert len(good(parse_envelopes(to_messages(env))).collect()) == 3


def test_receive_time_is_utc_text_that_reads_back(spark, envelope):
    stamped = stamp(envelope(event("like", "{}", at=None)))
    assert stamped.first().received_at.endswith("+00:00")
    assert quarantined(parse_envelopes(to_messages(stamped))).count() == 0


def test_local_file_is_appended(spark, envelope, tmp_path):
    path = str(tmp_path / "local")
    append_jsonl(envelope(event("gift", '{"user_id":"1"}')), path)
    append_jsonl(envelope(event("like", "{}")), path)
    lines = [json.loads(r.value) for r in spark.read.text(path).collect()]
    assert sorted(x["event_type"] for x in lines) == ["gift", "like"]
    assert set(lines[0]) == {"streamer", "event_type", "received_at", "data"}


def test_kafka_settings(spark, envelope):
    assert kafka_options("b:9092", ["x", "y"], group="g", min_partitions=4) == {
        "kafka.bootstrap.servers": "b:9092", "subscribe": "x,y", "startingOffsets": "earliest",
        "failOnDataLoss": "true", "groupIdPrefix": "g", "minPartitions": "4",
    }
    sink = kafka_sink_options("b:9092")
    assert (sink["kafka.compression.type"], sink["kafka.linger.ms"], sink["kafka.batch.size"]) == ("gzip", "50", "65536")
    stream = spark.readStream.format("rate").load().select(F.lit("t").alias("topic"), F.lit("v").alias("value"))
    with pytest.raises(ValueError):
        write_kafka(stream, "b:9092")


def test_object_store_settings():
    conf = object_store_conf("https://store.example:9000", "k", "s")
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "store.example:9000"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "true"
    assert object_store_conf("http://store:9000", "k", "s")["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    with pytest.raises(ValueError, match="secret key"):
        object_store_conf("http://store:9000", "k", None)


def test_day_paths_are_padded_and_missing_days_are_none(spark, tmp_path):
    assert day_path("/lake/", "2024-03-09") == "/lake/topic=*/year=2024/month=03/day=09"
    assert read_day(spark, str(tmp_path), "2024-03-09") is None
    with pytest.raises(ValueError):
        day_path("/lake", "2024-13-01")


def test_snapshot(spark, tmp_path):
    path = tmp_path / "pool.json"
    record = {"username": "ann", "category": "npc", "status": "qualified", "cooldown_until": "whenever",
              "discovered_at": "2024-01-01T00:00:00+00:00", "stats": {"peak_viewers": 9}}
    path.write_text(json.dumps({"updated_at": "x", "total_streamers": 1, "streamers": {"ann": record}}))
    (row,) = read_snapshot(spark, str(path)).collect()
    assert (row.username, row.status, row.cooldown_until, row.peak_viewers) == ("ann", "qualified", None, 9)
    assert (row.archetype, row.total_sessions) == ("general", 0)


@pytest.mark.parametrize("content", [None, "{broken", ""])
def test_without_a_usable_snapshot_the_seeds_are_used(spark, tmp_path, content):
    path = tmp_path / "pool.json"
    if content is not None:
        path.write_text(content)
    rows = read_snapshot(spark, str(path)).collect()
    assert {(r.username, r.category, r.archetype) for r in rows} == set(SEEDS)
    assert {(r.status, r.source) for r in rows} == {("candidate", "seed")}


def test_config_and_manual_adds(spark):
    events = config_events(spark, {"npc": {"streamers": ["@Ann", "bob"]}, "ecommerce": {}}).unionByName(
        manual_add(spark, "cat", "ecommerce", "food", seq=10)
    )
    rows = {r.username: (r.category, r.archetype, r.source) for r in fold_registry(events).collect()}
    assert rows == {
        "ann": ("npc", "general", "config_seed"), "bob": ("npc", "general", "config_seed"),
        "cat": ("ecommerce", "food", "cli_manual"),
    }


def test_registry_files(spark, tmp_path):
    registry = fold_registry(manual_add(spark, "cat"))
    write_registry(registry, str(tmp_path / "r"))
    assert read_registry(spark, str(tmp_path / "r")).drop("discovered_at").collect() == registry.drop("discovered_at").collect()
    assert snapshot_info(registry).first().total_streamers == 1
    record = json.loads(snapshot_records(registry).first().record)
    assert record["stats"]["total_sessions"] == 0 and record["cooldown_until"] is None


def test_a_snapshot_without_streamers_is_an_empty_pool(spark, tmp_path):
    for text, count in (('{"version": 2}', 0), ('{"streamers": {}}', 0), ('{"streamers": ', len(SEEDS))):
        path = tmp_path / f"s{len(text)}.json"
        path.write_text(text)
        assert read_snapshot(spark, str(path)).count() == count
