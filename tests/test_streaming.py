import datetime
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmap import fixtures as fx
from corpusmap.operators import selection
from corpusmap.operators.parts import PartedTable
from corpusmap.sources import hourly
from corpusmap.streaming import changes


def land(df, folder, name):
    """Add one file to a landing folder."""
    part = f"{folder}-parts-{name}"
    df.coalesce(1).write.parquet(part)
    os.makedirs(folder, exist_ok=True)
    found = next(f for f in os.listdir(part) if f.endswith(".parquet"))
    os.link(f"{part}/{found}", f"{folder}/{name}.parquet")


def state_of(df):
    return {r["identifier"]: r["event"]["offset"] for r in df.collect()}


def test_restart_goes_on_where_it_stopped(spark, sf_dir, tmp_path):
    events = fx.article_events(spark, sf_dir)
    landing, log, offsets = (str(tmp_path / n) for n in ("landing", "log", "offsets"))
    early = events.filter(F.col("event.offset") < 600)
    land(early, landing, "a")
    land(early.filter("event.offset < 50"), landing, "b")  # delivered twice

    def run():
        stream = changes.article_stream(spark, landing, events.schema, "parquet", files_per_batch=1)
        changes.deliver(stream, changes.log_newest(log), offsets).awaitTermination()
        return changes.latest_state(spark, log, events.schema)

    assert state_of(run()) == state_of(changes.newest_events(early))
    assert len(os.listdir(log)) == 2
    land(events.filter(F.col("event.offset") >= 600), landing, "c")
    assert state_of(run()) == state_of(changes.newest_events(events))
    assert len(os.listdir(log)) == 3
    run()
    assert len(os.listdir(log)) == 3


def test_a_repeated_batch_changes_nothing(spark, sf_dir, tmp_path):
    events = fx.article_events(spark, sf_dir)
    log = str(tmp_path / "log")
    handle = changes.log_newest(log)
    handle(events, 0)
    once = state_of(changes.latest_state(spark, log, events.schema))
    handle(events, 0)
    assert state_of(changes.latest_state(spark, log, events.schema)) == once
    base, last = changes.compact(spark, log, events.schema, str(tmp_path / "base"))
    assert last == 0
    handle(events.filter("event.offset < 10"), 1)
    assert state_of(changes.latest_state(spark, log, events.schema, base, last)) == once
    again, last = changes.compact(spark, log, events.schema, str(tmp_path / "base2"), base, last)
    assert last == 1 and state_of(again) == once


def test_replay_bounds(spark, sf_dir):
    events = fx.article_events(spark, sf_dir)
    assert selection.replay(events).count() == events.count()
    kept = selection.replay(events, parts=[1, 2, 3], offsets={1: 10, 2: 20}).select("event.*").collect()
    assert {r["partition"] for r in kept} == {1, 2, 3}
    assert min(r["offset"] for r in kept if r["partition"] == 1) >= 10
    assert min(r["offset"] for r in kept if r["partition"] == 2) >= 20
    late = datetime.datetime(2030, 1, 1, tzinfo=datetime.timezone.utc)
    assert selection.replay(events, since=late).isEmpty()
    lost = events.withColumn("event", F.col("event").withField("partition", F.lit(None).cast("bigint")))
    assert selection.replay(lost, offsets={1: 10, 2: 20}).count() == lost.count()
    assert selection.replay(events, since_per_partition={0: late}).filter("event.partition = 0").isEmpty()


def test_replay_pushes_down(spark, sf_dir, tmp_path):
    fx.article_events(spark, sf_dir).write.parquet(str(tmp_path / "e"))
    rows = selection.replay(spark.read.parquet(str(tmp_path / "e")), parts=[1], offsets={1: 500})
    assert "PushedFilters: [Or(Not(EqualTo(event.partition" in rows._jdf.queryExecution().executedPlan().toString() or \
        "In(event.partition" in rows._jdf.queryExecution().executedPlan().toString() or \
        "EqualTo(event.partition" in rows._jdf.queryExecution().executedPlan().toString()


def files_of(path):
    return {name: sorted(os.listdir(f"{path}/{name}")) for name in os.listdir(path) if name.startswith("_part=")}


def test_upserts_from_late_repeated_and_restarted_batches(spark, sf_dir, tmp_path):
    events = fx.article_events(spark, sf_dir)
    landing, offsets = str(tmp_path / "landing"), str(tmp_path / "offsets")
    table = PartedTable(spark, str(tmp_path / "table"), events.schema, changes.ARTICLE_KEY, 8)

    def run():
        stream = changes.article_stream(spark, landing, events.schema, "parquet", files_per_batch=1)
        changes.upsert_stream(stream, table, offsets).awaitTermination()
        return state_of(table.read())

    land(events.filter("event.offset >= 500"), landing, "a")
    land(events.filter("event.offset between 300 and 700"), landing, "b")  # late and repeated
    late = events.filter("event.offset >= 300")
    assert run() == state_of(changes.newest_events(late))
    assert run() == state_of(changes.newest_events(late))
    land(events.filter("event.offset < 300"), landing, "c")
    assert run() == state_of(changes.newest_events(events))
    before = files_of(tmp_path / "table")
    changes.upsert_into(table)(events, 99)  # a batch that comes again
    assert files_of(tmp_path / "table") == before


def test_changes_rewrite_only_the_parts_they_touch(spark, tmp_path):
    schema = "namespace string, page_id bigint, title string"
    rows = spark.createDataFrame([(f"n{i % 3}", i, str(i)) for i in range(500)], schema)
    table = PartedTable(spark, str(tmp_path / "t"), rows.schema, ["namespace", "page_id"], 40)
    table.replace(rows)

    def now():
        return {(r.namespace, r.page_id): r.title for r in table.read().collect()}

    expected = {(f"n{i % 3}", i): str(i) for i in range(500)}
    assert now() == expected
    before = files_of(tmp_path / "t")
    changed = spark.createDataFrame([("n0", 3 * i, "new") for i in range(5)] + [("n9", i, "added") for i in range(5)], schema)
    touched = table.upsert(changed)
    expected |= {(r.namespace, r.page_id): r.title for r in changed.collect()}
    after = files_of(tmp_path / "t")
    assert now() == expected and 0 < len(touched) <= 10
    assert {p for p in before if before[p] != after[p]} <= {f"_part={p}" for p in touched}
    assert sum(before[p] == after[p] for p in before) >= 30
    assert table.update(changed.filter("namespace = 'n0'").withColumn("title", F.lit(None).cast("string")), ["title"])
    expected |= {("n0", 3 * i): None for i in range(5)}
    assert now() == expected
    gone = rows.filter("page_id % 7 = 0")
    table.delete(gone)
    assert now() == {k: v for k, v in expected.items() if k[1] % 7 or k[0] == "n9"}
    table.delete(table.read())
    assert now() == {} and table.upsert(changed.limit(0)) == []
    table.upsert(changed)
    assert len(now()) == 10


def test_reading_some_parts_prunes_the_others(spark, tmp_path):
    rows = spark.range(200).select(F.col("id"), (F.col("id") * 2).alias("v"))
    table = PartedTable(spark, str(tmp_path / "t"), rows.schema, ["id"], 10)
    table.replace(rows)
    plan = table.rows_of([3])._jdf.queryExecution().executedPlan().toString()
    assert "_part" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert 0 < table.rows_of([3]).count() < 200


@pytest.mark.parametrize("mode", ["failfast", "permissive"])
def test_broken_lines_in_a_stream(spark, tmp_path, mode):
    schema = fx.article_events(spark, "/root/testdata/sf0.001").schema
    folder = tmp_path / "landing"
    folder.mkdir()
    good = fx.article_events(spark, "/root/testdata/sf0.001").limit(5).toJSON().collect()
    (folder / "a.json").write_text("\n".join([*good, "{broken", "[1]", ""]))
    stream = changes.article_stream(spark, str(folder), schema, mode=mode)
    out = str(tmp_path / "out")
    query = changes.deliver(stream, lambda batch, n: batch.write.parquet(f"{out}/{n}"), str(tmp_path / "offsets"))
    if mode == "failfast":
        with pytest.raises(Exception, match="not a JSON object"):
            query.awaitTermination()
        return
    query.awaitTermination()
    assert spark.read.parquet(f"{out}/0").count() == 5
    rejects = changes.rejected_lines(spark, str(folder), schema)
    changes.deliver(rejects, lambda batch, n: batch.write.json(f"{out}-bad/{n}"), str(tmp_path / "offsets2")).awaitTermination()
    assert sorted(r.line for r in spark.read.json(f"{out}-bad/0").collect()) == ["[1]", "{broken"]


def test_hourly_folders_come_once_over_restarts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(hourly, "SPLIT", 40)
    root, out = tmp_path / "hours", tmp_path / "out"
    sent = []

    def land(hour, name, lines, end="\n"):
        (root / hour).mkdir(parents=True, exist_ok=True)
        with open(root / hour / name, "a") as file:
            file.write("".join(f"{line}\n" for line in lines[:-1]) + lines[-1] + end)

    def line(part, offset):
        sent.append((part, offset))
        return json.dumps({"name": "é" * (offset % 30), "event": {"partition": part, "offset": offset}})

    def run(**options):
        stream = hourly.hourly_changes(spark, str(root), **options).withColumn("n", F.lit(1))
        query = changes.deliver(stream, lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/batch_id={n}"), str(tmp_path / "offsets"))
        query.awaitTermination()
        return sorted(r.line for r in spark.read.parquet(str(out)).collect())

    def expected():
        return sorted(json.dumps({"name": "é" * (o % 30), "event": {"partition": p, "offset": o}}) for p, o in sent)

    land("2024-01-01/05", "a.ndjson", [line(0, k) for k in range(20)])
    land("2024-01-01/06", "b.ndjson", [line(1, k) for k in range(10)])
    assert run() == expected()
    assert run() == expected()
    half = line(1, 50)
    land("2024-01-01/06", "b.ndjson", [line(1, k) for k in range(10, 15)] + [half[:8]], end="")
    sent.remove((1, 50))
    assert run() == expected()  # an unfinished line waits
    land("2024-01-01/06", "b.ndjson", [half[8:]])
    sent.append((1, 50))
    land("2024-01-01/06", "c.ndjson", [line(2, 1)])
    land("2024-01-02/00", "a.ndjson", [line(3, k) for k in range(5)])
    assert run() == expected()


def test_hourly_folders_from_a_time_and_offsets_on(spark, tmp_path):
    for hour in ("2024-01-01/05", "2024-01-01/06", "2024-01-02/07"):
        (tmp_path / "hours" / hour).mkdir(parents=True)
        rows = [{"name": hour, "event": {"partition": p, "offset": o}} for p in range(3) for o in range(4)]
        (tmp_path / "hours" / hour / "x.ndjson").write_text("\n".join(map(json.dumps, rows)) + "\n")
    schema = T.StructType.fromDDL("name string, event struct<partition: long, offset: long>")
    stream = hourly.hourly_changes(spark, str(tmp_path / "hours"), schema, since="2024-01-01/06", offsets={1: 2, 2: 9})
    out = str(tmp_path / "out")
    changes.deliver(stream, lambda batch, n: batch.write.parquet(f"{out}/{n}"), str(tmp_path / "offsets")).awaitTermination()
    got = sorted((r.name, r.event.partition, r.event.offset) for r in spark.read.parquet(f"{out}/0").collect())
    assert got == [(h, p, o) for h in ("2024-01-01/06", "2024-01-02/07") for p in (0, 1) for o in range(4) if p == 0 or o >= 2]
    with pytest.raises(ValueError, match="since"):
        hourly.HourlyReader({"path": "x", "since": "yesterday"})
