"""Stored ledgers and snapshots: late batches against a full rewrite, and what stays untouched on disk."""

import datetime as dt
import hashlib
import pathlib
import random

from pyspark.sql import functions as F

from ledgerloom.operators import ledger
from ledgerloom.sinks import ledger_store, merge

MOVES = "txn_id long, date_time timestamp_ntz, account long, direction string, delta_amount decimal(18,2)"


def files(path):
    return {str(f.relative_to(path)): hashlib.md5(f.read_bytes()).hexdigest() for f in pathlib.Path(path).rglob("*.parquet")}


def changed_folders(before, after):
    return {name.split("/")[0] for name in before.keys() ^ after.keys()} | {n.split("/")[0] for n in before.keys() & after.keys() if before[n] != after[n]}


def moves_of(n, seed=1):
    chance, start = random.Random(seed), dt.datetime(2024, 1, 1)
    out = []
    for i in range(n):
        when = start + dt.timedelta(days=chance.randrange(12), seconds=chance.choice([0, 5, 9]))
        out.append((i, when, chance.choice([1, 1, 1, 2, 3]), chance.choice(["CREDIT", "DEBIT"]), chance.randrange(-900, 900)))
    return out


def test_late_movements_shift_later_days(spark, tmp_path):
    rows = moves_of(300)
    late = [r for r in rows if r[1].day in (4, 9) or r[0] % 50 == 7]
    first = [r for r in rows if r not in late]
    frame = lambda r: spark.createDataFrame(r, "txn_id long, date_time timestamp_ntz, account long, direction string, delta_amount int")
    path = str(tmp_path / "ledger")
    ledger_store.create(frame(first), path)
    on = lambda day: [r for r in late if r[1].day == day]
    others = [r for r in late if r[1].day not in (4, 9)]
    for batch in (on(9), on(4), others, others[:3]):  # the last one is a replay
        before, carried = files(f"{path}/moves"), files(f"{path}/carry")
        ledger_store.add(frame(batch), path)
        touched = {f"period=2024-01-{r[1].day:02d}" for r in batch}
        assert changed_folders(before, files(f"{path}/moves")) == touched
        assert min(touched) <= min(changed_folders(carried, files(f"{path}/carry")))
    want = {tuple(r) for r in ledger.statements(frame(rows)).select("txn_id", "account", "direction", "running_balance", "seq").collect()}
    got = ledger_store.statements(spark, path).select("txn_id", "account", "direction", "running_balance", "seq")
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(rows)
    day = dt.date(2024, 1, 9)
    one = ledger_store.statements(spark, path, day, day)
    assert {r["seq"] for r in one.collect()} == {r[4] for r in want if rows[r[0]][1].date() == day}


def test_first_movements_of_an_account_may_come_late(spark, tmp_path):
    path, at = str(tmp_path / "ledger"), dt.datetime(2024, 5, 1)
    frame = lambda r: spark.createDataFrame(r, "txn_id long, date_time timestamp_ntz, account long, direction string, delta_amount int")
    ledger_store.create(frame([(1, at, 1, "CREDIT", 5)]), path)
    ledger_store.add(frame([(2, at - dt.timedelta(days=3), 1, "CREDIT", 7), (3, at + dt.timedelta(days=1), 2, "DEBIT", -2)]), path)
    got = {(r["txn_id"], r["running_balance"], r["seq"]) for r in ledger_store.statements(spark, path).collect()}
    assert got == {(1, 12, 2), (2, 7, 1), (3, -2, 1)}


def test_upsert_writes_the_buckets_it_meets_only(spark, tmp_path):
    path = str(tmp_path / "nodes")
    old = [(i, f"place {i}", float(i)) for i in range(200)]
    existing = spark.createDataFrame(old, "account_number long, location string, balance double")
    merge.create_snapshot(existing, path, "account_number", 8)
    incoming = [(3, 10.0, "x", 1), (3, 11.0, "y", 2), (500, 1.0, "z", 1), (7, None, None, 5)]
    batch = spark.createDataFrame(incoming, "account_number int, balance double, channel string, version int")
    before = files(path)
    merge.upsert_snapshot(batch, path, "account_number", ["version"], 8)
    met = {f"{merge.BUCKET}={r[0]}" for r in merge._bucketed(batch, "account_number", 8).select(merge.BUCKET).distinct().collect()}
    assert len(met) < 8 and changed_folders(before, files(path)) == met
    got = {r["account_number"]: (r["location"], r["balance"], r["channel"]) for r in merge.read_snapshot(spark, path).collect()}
    want = {i: (place, balance, None) for i, place, balance in old} | {3: ("place 3", 11.0, "y"), 500: (None, 1.0, "z"), 7: ("place 7", None, None)}
    assert got == want
    whole = merge.merge_nodes(existing, batch, "account_number", ["version"]).drop("version")
    assert sorted(map(str, whole.collect())) == sorted(map(str, merge.read_snapshot(spark, path).select(whole.columns).collect()))
    # a second batch, with a property the snapshot has by now
    merge.upsert_snapshot(batch.filter("account_number = 500").withColumn("channel", F.lit("w")), path, "account_number", ["version"], 8)
    assert merge.read_snapshot(spark, path).filter("account_number = 500").first()["channel"] == "w"
