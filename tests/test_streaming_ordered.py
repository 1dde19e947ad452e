"""First-wins by order and durable totals, over shuffled batches and restarts."""

import json
import random
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from marquee.operators.dedup import dedup_first
from marquee.streaming.ingest import batch_sink, dedup_stream, read_stream, start_ingest
from marquee.streaming import ordered
from marquee.streaming.ordered import first_by_order, latest_revisions, use_rocksdb
from marquee.streaming.progress import ProgressLedger, batch_records, observe_arrived, observe_kept, totals

ROW = "id long, t string, n int, _x double"
VALUE = StructType([StructField("value", StringType())])


@pytest.fixture
def rocksdb(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    use_rocksdb(spark)
    yield spark
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def land(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) if not isinstance(r, str) else r for r in rows) + "\n")


def run(spark, tmp_path, transform, sink, name=None):
    src = read_stream(spark, "text", options={"maxFilesPerTrigger": "1"}, path=str(tmp_path / "in"), schema=VALUE)
    rows = src.select(F.from_json("value", ROW).alias("r")).select("r.*")
    q = start_ingest(transform(rows), sink, str(tmp_path / "ckpt"), trigger={"availableNow": True}, query_name=name)
    q.awaitTermination()
    return q


def test_the_first_by_order_wins_whatever_arrives_first(rocksdb, tmp_path):
    spark, rnd = rocksdb, random.Random(3)
    rows = [{"id": rnd.choice([1, 2, 3, 2**60, None]), "t": rnd.choice(["a", "b", "ä", None]), "n": rnd.choice([1, 2, None]),
             "_x": rnd.choice([0.5, -1.0, None])} for _ in range(120)]
    out = str(tmp_path / "out")
    for k in range(6):  # a restart after every second file
        land(tmp_path / "in", f"f{k}.json", rows[20 * k:20 * k + 20])
        if k % 2:
            run(spark, tmp_path, lambda r: first_by_order(r, "id", ["t"]), batch_sink(out))
    stored = spark.read.parquet(out)
    got = latest_revisions(stored.drop("batch_id"), "id").drop("revision")
    every = spark.createDataFrame([(r["id"], r["t"], r["n"], r["_x"]) for r in rows], ROW)
    want = dedup_first(every.filter("id is not null"), ["id"], ["t"]).unionByName(every.filter("id is null"))
    assert sorted(map(tuple, got.select(want.columns).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    # corrections were sent on, numbered without gaps, and never more than one a batch
    per_key = stored.filter("id is not null").groupBy("id").agg(F.sort_array(F.collect_list("revision")).alias("r"),
                                                                F.count_distinct("batch_id").alias("b")).collect()
    assert all(r["r"] == list(range(1, len(r["r"]) + 1)) and r["b"] == len(r["r"]) for r in per_key)
    assert max(len(r["r"]) for r in per_key) > 1


def test_totals_hold_with_dedup_and_after_a_restart(spark, tmp_path):
    name, records = f"t-{uuid.uuid4().hex[:6]}", str(tmp_path / "records")
    first = [{"id": 1}, {"id": 1}, {"id": 2}, "broken", "{}"]
    second = [{"id": 2}, {"id": 3}, {"id": None}]
    ledger = ProgressLedger(spark, records, name)
    out, dead = str(tmp_path / "out"), str(tmp_path / "dead")
    for file, part in (("a.json", first), ("b.json", second)):
        land(tmp_path / "in", file, part)
        q = run(spark, tmp_path, lambda r: observe_kept(dedup_stream(observe_arrived(r, "id"), "id")), batch_sink(out, dead_letter=dead), name)
        ledger.settle(q)
        ledger.settle(q)  # twice is once
        # the source is read once: as many input rows as lines
        assert sum(p.numInputRows for p in q.recentProgress) == len(part)
    t = totals(spark, records).first()
    assert (t["batches"], t["rows"], t["malformed"], t["repeated"], t["kept"]) == (2, 8, 3, 2, 6)
    assert spark.read.parquet(out).count() == 3 and spark.read.parquet(dead).count() == 3
    assert {r["batch_id"]: r["rows"] for r in batch_records(spark, records).collect()} == {0: 5, 1: 3}


def test_a_repeated_batch_replaces_its_record(spark, tmp_path):
    records = str(tmp_path / "records")
    for run_id, n in (("one", 5), ("two", 7)):
        ProgressLedger(spark, records, "q")._record(run_id, 4, {"arrived": {"rows": n, "malformed": 1}, "kept": {"rows": 3}})
    t = totals(spark, records).first()
    assert (t["batches"], t["rows"], t["malformed"], t["repeated"], t["kept"]) == (1, 7, 1, 4, 3)


def test_ingest_command_keeps_the_first_and_counts_over_runs(rocksdb, tmp_path, capsys):
    from marquee import cli
    row = {"id": 1, "title": "late", "fetched_at": "2024-02-01 00:00:00"}
    args = ["ingest", "--format", "text", "--path", str(tmp_path / "in"), "--store", str(tmp_path / "store"), "--available-now",
            "--checkpoint", str(tmp_path / "ckpt"), "--first-by", "fetched_at", "--progress", str(tmp_path / "records")]
    land(tmp_path / "in", "a.json", [row, {**row, "title": "early", "fetched_at": "2024-01-01 00:00:00"}, {**row, "id": 2}])
    for _ in range(2):
        a = cli.parser().parse_args(args)
        a.run(rocksdb, a)
        land(tmp_path / "in", "b.json", [{**row, "title": "earliest", "fetched_at": "2023-01-01 00:00:00"}, "broken"])
    stored = latest_revisions(rocksdb.read.parquet(str(tmp_path / "store")).drop("batch_id"), "id")
    assert sorted((r["id"] or 0, r["title"] or "", r["revision"]) for r in stored.collect()) == [(0, "", 1), (1, "earliest", 2), (2, "late", 1)]
    assert '"rows": 5, "malformed": 1, "repeated": 1, "kept": 4' in capsys.readouterr().out


def test_ids_share_groups_and_their_state_stays_right_when_its_blocks_become_one(rocksdb, tmp_path, monkeypatch):
    monkeypatch.setattr(ordered, "GROUPS", 16)
    spark, rnd, out = rocksdb, random.Random(5), str(tmp_path / "out")
    files = ordered.BLOCKS + 4
    rows = [[{"id": i, "t": rnd.choice("abcdef"), "n": rnd.choice([k, None]), "_x": None} for i in rnd.sample(range(400), 200)] for k in range(files)]
    for k, part in enumerate(rows):
        land(tmp_path / "in", f"f{k:02}.json", part)
    for _ in range(2):  # the second run finds nothing new
        q = run(spark, tmp_path, lambda r: first_by_order(r, "id", ["t"]), batch_sink(out))
    stored = spark.read.parquet(out)
    got = latest_revisions(stored.drop("batch_id"), "id").select("id", "t", "n", "_x")
    every = spark.createDataFrame([(r["id"], r["t"], r["n"], r["_x"]) for part in rows for r in part], ROW)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, dedup_first(every, ["id"], ["t"]).collect()), key=repr)
    assert stored.groupBy("id").agg(F.max("revision").alias("r"), F.count("*").alias("n")).filter("r <> n").count() == 0
    # Python was called and state kept for groups, not for each id
    state = spark.read.format("statestore").option("stateVarName", "blocks").load(str(tmp_path / "ckpt"))
    groups = {r["key"]["group_key"] for r in state.collect()}
    assert len(groups) <= 16 < got.count() and q.exception() is None
