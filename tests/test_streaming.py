"""Logs, groups, consumers, replication and messages."""

import uuid

import pytest
from pyspark.sql import functions as F

import keyharbor as kh


@pytest.fixture
def path():
    return f"/tmp/checkpoints/keyharbor-tests/{uuid.uuid4().hex}"


@pytest.fixture
def log(spark, path):
    rows = [("events", 1000 + k // 2, k % 2, {"user_id": f"user_{k}", "action": "click" if k % 3 else "buy", "value": str(k * 10)}) for k in range(10)]
    spark.createDataFrame(rows, "_key string, ms long, seq long, fields map<string,string>").write.parquet(f"{path}/log")
    return f"{path}/log"


def test_read_and_groups(spark, log, path):
    df = spark.read.parquet(log)
    assert [r["_id"] for r in kh.read_stream(df, "events", schema=["action"], start_id="1001-1", count=3).orderBy("_ts", "_id").collect()] == ["1001-1", "1002-0", "1002-1"]
    group = kh.Group(f"{path}/group")
    first = kh.read_stream(df, "events", schema=["action"], group=group, consumer="a", count=4)
    again = kh.read_stream(df, "events", schema=["action"], group=group, consumer="b", count=4)
    ids = [{r["_id"] for r in x.collect()} for x in (first, again)]
    assert len(ids[0]) == len(ids[1]) == 4 and not ids[0] & ids[1] and group.pending_count() == 8
    assert kh.ack_entries(group, "events", [*ids[0], "9-9"]) == 4 and kh.ack_entries(group, "events", list(ids[0])) == 0 and group.pending_count() == 4
    assert kh.read_stream(df, "events", group=group, auto_ack=True, schema=[]).count() == 2 and group.pending_count() == 4
    late = kh.Group(f"{path}/late", start_id="1003-1")
    assert kh.read_stream(df, "events", schema=[], group=late).count() == 2


def test_iter_and_consumer(spark, log, path):
    batches = list(kh.iter_stream(kh.open_log(log), f"{path}/c1"))
    assert [r["seq"] + 2 * (r["ms"] - 1000) for b in batches for r in b] == list(range(10))
    store = kh.MemoryCheckpointStore()
    failed = []

    def flaky(df, batch):
        if not failed:
            failed.append(batch)
            raise RuntimeError("first time")

    with pytest.raises(Exception, match="first time"):
        kh.StreamConsumer(kh.open_log(log), "g", "c", f"{path}/c2").run_once(flaky)
    seen = []
    consumer = kh.StreamConsumer(kh.open_log(log), "g", "c", f"{path}/c2", checkpoint_store=store)
    stats = consumer.run_once(lambda df, batch: seen.extend(r["ms"] for r in df.collect()))
    assert len(seen) == 10 and (stats.batches_processed, stats.entries_processed, stats.last_entry_id) == (1, 10, "1004-1") and store.get("g:c") == "1004-1"
    again = kh.StreamConsumer(kh.open_log(log), "g", "c", f"{path}/c2").run_once(lambda df, batch: seen.append("more"))
    assert again.batches_processed == 0 and "more" not in seen


def test_checkpoint_stores(tmp_path, path, spark):
    for make in (kh.MemoryCheckpointStore, lambda: kh.FileCheckpointStore(str(tmp_path / "c.json")), lambda: kh.TableCheckpointStore(path)):
        store = make()
        assert store.get("a") is None
        store.set("a", "1-0")
        store.set("b", "2-0")
        store.delete("b")
        assert store.get("a") == "1-0" and store.get("b") is None
    assert kh.FileCheckpointStore(str(tmp_path / "c.json")).get("a") == "1-0"


def test_replication(spark, log, path):
    f = kh.field_filter
    pipe = kh.ReplicationPipeline(kh.open_log(log), f"{path}/ck", fields=["user_id", "action", "value"])
    pipe.add_destination(kh.ReplicationDestination(f"{path}/all", "user_id", name="all", key_prefix="u:"))
    pipe.add_destination(kh.ReplicationDestination(f"{path}/buys", "user_id", name="buys", filter=f("action").eq("buy") & f("value").gte(30), transform=lambda d: d.select("user_id", "value"), write_type="json"))
    stats = pipe.run_once()
    assert (stats.entries, stats.written) == (10, {"all": 10, "buys": 3})
    assert {r["_key"] for r in kh.Table(f"{path}/buys").read().collect()} == {"user_3", "user_6", "user_9"}
    broken = kh.ReplicationPipeline(kh.open_log(log), f"{path}/ck2", fields=["user_id"])
    broken.add_destination(kh.ReplicationDestination(f"{path}/ok", "user_id", name="ok")).add_destination(kh.ReplicationDestination(f"{path}/bad", "nope", name="bad"))
    with pytest.raises(Exception, match="nope"):
        broken.run_once()
    assert broken.stats.failures == {"bad": 1} and broken.stats.batches == 0 and kh.Table(f"{path}/ok").read().count() == 10


def test_filters_on_missing_fields(spark):
    df = spark.createDataFrame([("a", "5"), ("b", None), ("c", "x")], "id string, v string")
    ids = lambda c: {r["id"] for r in df.where(c).collect()}
    f = kh.field_filter("v")
    assert ids(f.eq(5)) == {"a"} and ids(f.ne(5)) == {"b", "c"} and ids(f.gt(1)) == {"a"} and ids(f.not_in_list(["x"])) == {"a", "b"} and ids(f.is_null()) == {"b"} and ids(f.starts_with("x") | f.ends_with("5")) == {"a", "c"}


def test_messages(spark, log, path):
    rows = [("news:a", '{"n": 1, "s": "x"}', 10.0), ("news:b", "not json", 11.0), ("other", '{"n": 3}', 12.0), ("news:a", '{"n": 4}', 20.0)]
    df = spark.createDataFrame(rows, "channel string, message string, ts double")
    assert kh.collect_pubsub(df, ["news:*"], pattern=True).count() == 3 and kh.collect_pubsub(df, ["news:a", "other"], count=2).count() == 2
    assert kh.collect_pubsub(df, ["news:*"], pattern=True, window_seconds=5).count() == 2 and kh.collect_pubsub(df, ["news:a"], since=15.0, timeout_ms=10_000).count() == 1
    parsed = {(r["_channel"], r["_received_at"]): (r["n"], r["message"]) for r in kh.collect_pubsub(df, ["news:*"], pattern=True, message_format="json", schema="n int, s string").collect()}
    assert parsed == {("news:a", 10.0): (1, None), ("news:b", 11.0): (None, "not json"), ("news:a", 20.0): (4, None)}
    assert kh.collect_pubsub(df, ["other"], parser=lambda d: d.withColumn("k", F.length("message")), include_channel=False, include_timestamp=False).first()["k"] == 8
    df.write.parquet(f"{path}/m")
    assert sum(len(b) for b in kh.iter_pubsub(kh.open_log(f"{path}/m"), ["news:*"], f"{path}/mc", pattern=True)) == 3


def test_an_iterator_that_breaks_off_is_given_its_batch_again(spark, log, path):
    for rows in kh.iter_stream(kh.open_log(log), f"{path}/c"):
        assert len(rows) == 10
        break  # a crash: the batch was not gone past
    again = list(kh.iter_stream(kh.open_log(log), f"{path}/c", batch_size=4))
    assert [len(b) for b in again] == [4, 4, 2]
    assert not list(kh.iter_stream(kh.open_log(log), f"{path}/c"))


def test_commit_rollback_and_ack(spark, log, path):
    group = kh.Group(f"{path}/g")
    kh.read_stream(spark.read.parquet(log), "events", schema=[], group=group, consumer="c")
    assert group.pending_count("c") == 10 and group.pending_count("d") == 0
    assert [tuple(r) for r in group.pending_by_consumer().collect()] == [("c", 10, "1000-0", "1004-1")]
    seen = []
    with kh.StreamConsumer(kh.open_log(log), "g", "c", f"{path}/k", entries=group, batch_size=6, auto_commit=False) as consumer:
        for rows in consumer:
            seen.append([f"{r['ms']}-{r['seq']}" for r in rows])
            if len(seen) == 1:
                consumer.rollback()
            else:
                assert consumer.ack() == len(rows)
                consumer.commit()
    assert [len(x) for x in seen] == [6, 6, 4] and seen[0] == seen[1] and consumer.stats.entries_processed == 10 and group.pending_count() == 0
    with pytest.raises(ValueError):
        kh.StreamConsumer(kh.open_log(log), "g", "d", f"{path}/k").ack()
    group.destroy()
    assert kh.read_stream(spark.read.parquet(log), "events", schema=[], group=group).count() == 10


def test_async_consumer(spark, log, path):
    import asyncio

    async def consume():
        got = []
        async with kh.StreamConsumer(kh.open_log(log), "g", "c", f"{path}/k", batch_size=5) as consumer:
            async for rows in consumer:
                got.append(len(rows))
        return got

    assert asyncio.run(consume()) == [5, 5]
    assert not list(kh.StreamConsumer(kh.open_log(log), "g", "c", f"{path}/k"))


def test_two_consumers_at_a_time_share_no_entry(spark, log, path):
    """The second one reads the state before the first one has recorded its delivery."""
    a, b = kh.Group(f"{path}/g"), kh.Group(f"{path}/g")
    df = spark.read.parquet(log)
    late, first = [], b._deliveries.latest

    def stale():
        found = first()
        if not late:
            late.append({r["_id"] for r in kh.read_stream(df, "events", schema=[], group=a, consumer="a", count=6).collect()})
        return found

    b._deliveries.latest = stale
    mine = {r["_id"] for r in kh.read_stream(df, "events", schema=[], group=b, consumer="b", count=6).collect()}
    assert len(late[0]) == 6 and len(mine) == 4 and not mine & late[0]
