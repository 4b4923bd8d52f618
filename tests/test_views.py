"""The log that the queries derive from the events: put together once, at every size in all partitions."""

import datetime as dt

import pytest
from conftest import plan, rows

from registry import entries
from registry.views import payload, varied_payload


@pytest.fixture
def events(spark, tmp_path):
    start = dt.datetime(2024, 1, 15)
    data = [(i, start + dt.timedelta(minutes=3 * i), i % 90, ("view", "click")[i % 2], float(i % 70), f'{{"k": {i % 50}}}') for i in range(900)]
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def test_requests_are_put_together_once_for_all_their_copies(spark, events):
    varied = varied_payload(spark, events)
    assert plan(varied).count("ObjectHashAggregate") == 2  # before and after the shuffle
    plain = {r["request_id"]: r for r in payload(spark, events, keep=("user_id",)).collect()}
    kinds = {}
    for r in varied.collect():
        if r["request_id"]:
            whole = plain[r["request_id"]]
            shift = (r["timestamp_ms"] - whole["timestamp_ms"], (r["date"] - whole["date"]).days, r["status_code"] == whole["status_code"])
            kinds.setdefault(whole["user_id"] % 29 if whole["user_id"] % 17 and whole["user_id"] % 19 else -1, set()).add(shift)
    usual = (0, 0, True)
    assert kinds.pop(11) == {usual, (60_000, 0, True)}
    assert kinds.pop(12) >= {usual, (-1000, 0, False)}
    assert kinds.pop(13) == {usual, (86_400_000, 1, True)}
    assert all(found == {usual} for found in kinds.values())


def test_the_stream_reads_files_of_all_partitions(spark, events, monkeypatch):
    seen, read = [], entries.inference_stream.read_payload_stream

    def reader(session, folder, **options):
        seen.append((len(session.read.parquet(folder).inputFiles()), options["files_per_batch"]))
        return read(session, folder, **options)

    monkeypatch.setattr(entries.inference_stream, "read_payload_stream", reader)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        streamed = entries.stream_unpacked(spark, events)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert seen == [(8, 4)]  # four partitions, twice
    assert rows(streamed) == rows(entries.inference_unpacked(spark, events).select(*streamed.columns))


def test_batches_are_taken_from_a_stored_log(spark, events, monkeypatch):
    plans, append = [], entries.append_positions
    monkeypatch.setattr(entries, "append_positions", lambda positions, *names: plans.append(plan(positions)) or append(positions, *names))
    entries.inference_append_table(spark, events)
    assert len(plans) == 3 and not any("collect_list" in p for p in plans)
