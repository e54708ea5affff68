"""Streams over several files out of order: folds, deadlines, state that empties, and the upsert table."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.sources.versions import UpsertTable, VersionedTable, pinned
from tillbook.streaming import live
from tillbook.streaming.feeds import feed, write_feed
from tillbook.streaming.ordered import in_order
from tillbook.streaming.queries import _outage_fold, _wallet_fold, detect_outages
from tillbook.streaming.runner import drain_append

T0 = datetime(2024, 1, 1)


def run(stream, tmp_path, name):
    """Drain a stream; its rows and the rows left in state."""
    q = (stream.writeStream.format("parquet").option("path", str(tmp_path / name)).option("checkpointLocation", str(tmp_path / f"{name}-c"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    left = q.lastProgress["stateOperators"][0]["numRowsTotal"]
    batches = len([p for p in q.recentProgress if p["numInputRows"]])
    return stream.sparkSession.read.schema(stream.schema).parquet(str(tmp_path / name)).collect(), left, batches


def test_rows_reach_the_fold_in_order(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, i % 7, T0 + timedelta(minutes=rng.randint(0, 20_000))) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, k long, ts timestamp_ntz")
    s = feed(df, "order", "ts", "id", files=5).select("k", "id", "_et", F.unix_micros("_et").alias("ts_us"))
    out = T.StructType([T.StructField(c, T.LongType()) for c in ("k", "seq", "id")])

    def number(k, ready, carry, upto):
        at = carry[0] if carry else 0
        return [(k, at + i, r) for i, r in enumerate(ready["id"].tolist())], (at + len(ready),), None

    got, _, batches = run(in_order(s, "k", ["id"], out, T.StructType([T.StructField("n", T.LongType())]), number), tmp_path, "o")
    want = [(k, n, r[0]) for k in range(7) for n, r in enumerate(sorted((r for r in rows if r[1] == k), key=lambda r: (r[2], r[0])))]
    assert sorted(map(tuple, got)) == sorted(want) and batches >= 5


def test_filters_do_not_lose_the_heartbeat(spark, tmp_path):
    """A filter on a column of the rows must not drop the heartbeat before it has moved the watermark."""
    df = spark.createDataFrame([(i, "ab"[i % 2], T0 + timedelta(hours=i)) for i in range(100)], "id long, kind string, ts timestamp_ntz")
    s = feed(df, "beat", "ts", "id").filter(F.col("kind") == "a").select("kind", "id", "_et", F.unix_micros("_et").alias("ts_us"))
    out = T.StructType([T.StructField("id", T.LongType())])
    got, left, _ = run(in_order(s, "kind", ["id"], out, out, lambda k, rows, c, u: ([(i,) for i in rows["id"].tolist()], None, None)), tmp_path, "b")
    assert sorted(r.id for r in got) == list(range(0, 100, 2)) and left == 0


def test_files_of_a_feed_overlap(spark):
    df = spark.createDataFrame([(i, T0 + timedelta(hours=i)) for i in range(400)], "id long, ts timestamp_ntz")
    path = write_feed(df, "overlap", "ts", "id", files=4)
    rows = spark.read.schema(df.schema).parquet(path)
    spans = rows.filter("id IS NOT NULL").groupBy(F.input_file_name()).agg(F.min("ts").alias("a"), F.max("ts").alias("b")).collect()
    assert rows.filter("id IS NOT NULL").count() == 400 and rows.count() == 401
    assert any(x.a < y.a < x.b for x in spans for y in spans)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_outages_in_any_cut(seed):
    """The vectorised fold gives the outages of a walk, however the checks are cut into calls."""
    import pandas as pd

    rng = random.Random(seed)
    checks = [(i * 10, i, rng.random() < 0.6, f"e{i}") for i in range(60)]
    want, state, open_, last_ok, n = [], None, None, None, 0
    for ts, _, ok, err in checks:
        if not ok:
            open_ = open_ or [ts, 0, err, last_ok]
            open_[1] += 1
        else:
            if open_:
                n += 1
                want.append(("t", n, open_[0], ts, open_[3], open_[1], open_[2]))
            open_, last_ok = None, ts
    got, at = [], 0
    while at < len(checks):
        size = rng.randint(0, 7)
        part = pd.DataFrame(checks[at:at + size], columns=["ts_us", "event_id", "ok", "error"])
        out, state, _ = _outage_fold("t", part, state, 0)
        got += out
        at += size
    assert got == want


def test_open_outage_stays_in_state(spark, tmp_path):
    rows = [(1, "a", True, T0), (2, "a", False, T0 + timedelta(hours=1)), (3, "b", False, T0), (4, "b", True, T0 + timedelta(hours=2))]
    df = spark.createDataFrame([(*r, None) for r in rows], "event_id long, target string, ok boolean, ts timestamp_ntz, error string")
    got, left, _ = run(detect_outages(feed(df, "open", "ts", "event_id", files=2)), tmp_path, "open")
    assert [(r.target, r.failed_checks) for r in got] == [("b", 1)] and left == 2


def test_wallet_limits():
    import pandas as pd

    day = 86_400_000_000
    rows = [(1, "deposit", 1000, 0, 500), (2, "stake", -400, 1, 500), (3, "stake", -200, 2, 500), (4, "stake", -100, 3, 500),
            (5, "stake", -700, 4, None), (6, "stake", -400, day + 1, 500), (7, "withdrawal", -200, day + 2, 500)]
    frame = pd.DataFrame(rows, columns=["id", "type", "cents", "ts_us", "limit_cents"])
    out, state, _ = _wallet_fold(9, frame, None, 0)
    assert [(r[0], r[4], r[5], r[6]) for r in out] == [
        (1, "ok", 1000, 0), (2, "ok", 600, 400), (3, "limit_reached", 600, 400), (4, "ok", 500, 500), (5, "insufficient_funds", 500, 500),
        (6, "ok", 100, 400), (7, "insufficient_funds", 100, 400)]
    assert state == (100, 1, 400)


def test_match_steps_and_empty_state(spark, tmp_path):
    """Kick-off, goals, reopening, full time; goals before kick-off and after full time count for nothing."""
    def at(s):
        return T0 + timedelta(seconds=s)

    rows = [(1, 7, "home", at(0)), (2, 7, "kickoff", at(10)), (3, 7, "home", at(100)), (4, 7, "away", at(110)), (5, 7, "home", at(900)),
            (6, 7, "away", at(910)), (7, 7, "kickoff", at(1200)), (8, 8, "away", at(5)), (9, 9, "kickoff", at(0)), (10, 9, "kickoff", at(1))]
    df = spark.createDataFrame(rows, "event_id long, match_id long, action string, ts timestamp_ntz")
    got, left, _ = run(live.match_feed(feed(df, "m", "ts", "event_id", files=3)), tmp_path, "m")
    steps = [(r.match_id, r.version, (r.happened_at - T0).seconds, r.event, r.market, r.home_score, r.away_score) for r in sorted(got, key=lambda r: (r.match_id, r.version))]
    assert steps == [
        (7, 1, 10, "kickoff", "open", 0, 0), (7, 2, 100, "goal", "suspended", 1, 0), (7, 3, 110, "goal", "suspended", 1, 1),
        (7, 4, 125, "reopen", "open", 1, 1), (7, 5, 900, "goal", "suspended", 2, 1), (7, 6, 910, "full_time", "closed", 2, 1),
        (9, 1, 0, "kickoff", "open", 0, 0), (9, 2, 900, "full_time", "closed", 0, 0)]
    assert left == 0


def test_sessions_leave_the_state(spark, tmp_path):
    rows = [(i, i % 3, T0 + timedelta(minutes=37 * i)) for i in range(50)]
    df = spark.createDataFrame(rows, "request_id long, player_id long, ts timestamp_ntz")
    until = T0 + timedelta(hours=20)
    early = df.filter(F.col("ts") <= F.lit(until))
    got, left, _ = run(live.session_expiry(feed(early, "s", "ts", "request_id", files=3, complete_to=str(until))), tmp_path, "s")
    assert {r.player_id for r in got} == {0, 1, 2} and len(got) == sum(r[2] + timedelta(hours=2) <= until for r in rows)
    assert 0 < left <= 3
    every, none_left, _ = run(live.session_expiry(feed(df, "all", "ts", "request_id", files=3)), tmp_path, "all")
    assert len(every) == 50 and none_left == 0


def test_price_without_a_move_in_the_window(spark):
    """A price made days before is still met: the feed repeats it at midnight."""
    odds = spark.createDataFrame([(1, "2.000", T0, 1), (1, "3.000", T0 + timedelta(days=4, hours=3), 2)], "selection_id long, o string, changed_at timestamp_ntz, id long")
    odds = odds.select("selection_id", F.col("o").cast("decimal(7,3)").alias("odds"), "changed_at", "id")
    bets = [(i, 1, T0 + timedelta(hours=h), "2.000") for i, h in enumerate((1, 25, 80, 98, 99, 100, 200))] + [(50, 2, T0, "2.000"), (51, 1, T0 - timedelta(hours=1), None)]
    bets = spark.createDataFrame(bets, "bet_id long, selection_id long, placed_at timestamp_ntz, s string").select(
        "bet_id", "selection_id", "placed_at", F.col("s").cast("decimal(7,3)").alias("seen"))
    prices = live.republished(odds, F.lit(T0 + timedelta(days=12)).cast("timestamp"))
    out = drain_append(live.price_checks(feed(bets, "pb", "placed_at", "bet_id", files=2), feed(prices, "pp", "published_at", "id", files=3)), "pc")
    got = {r.bet_id: (None if r.odds is None else float(r.odds), r.verdict) for r in out.collect()}
    assert got == {0: (2.0, "ok"), 1: (2.0, "ok"), 2: (2.0, "ok"), 3: (2.0, "ok"), 4: (3.0, "odds_changed"), 5: (3.0, "odds_changed"),
                   6: (3.0, "odds_changed"), 50: (None, "market_suspended"), 51: (None, "market_suspended")}


def test_upsert_files_stay_few(spark, tmp_path):
    """Over 100 batches a reader opens a bounded number of files; a replayed batch changes nothing."""
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.LongType())])
    table = UpsertTable(spark, str(tmp_path / "t"), schema, ["k"], buckets=2, compact_every=10)
    want, opened = {}, []
    for b in range(100):
        batch = {(b * 3 + i) % 40: b * 100 + i for i in range(5)}
        want |= batch
        df = spark.createDataFrame(list(batch.items()), schema).coalesce(1)
        table.write(df, b)
        if b % 25 == 24:
            table.write(df, b)
            opened.append(len(table.read().inputFiles()))
            assert {r.k: r.v for r in table.read().collect()} == want
    assert max(opened) <= 2 + 10
    table.write(spark.createDataFrame([(0, -1)], schema), 3)  # a replay of a batch that is in the base
    assert {r.k: r.v for r in table.read().collect()} == want
    assert len(list((tmp_path / "t" / "manifest").glob("*.json"))) <= 3


def test_snapshot_outlives_an_overwrite(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.LongType())])
    table = VersionedTable(spark, str(tmp_path / "v"), schema)
    table.replace(spark.range(100).select("id", (F.col("id") * 2).alias("x")))
    fixed = pinned(table.read())
    table.replace(spark.range(5).select("id", F.lit(0).cast("long").alias("x")))
    assert fixed.agg(F.sum("x")).first()[0] == 9900 and table.read().count() == 5
    plan = fixed.filter("id > 90").select("x")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,90)]" in plan


def test_two_writers_of_one_version(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType())])
    a = VersionedTable(spark, str(tmp_path / "w"), schema)
    a.replace(spark.range(3))
    with pytest.raises(RuntimeError):
        a.files.commit("manifest/v000000000001.json", "{}")
    assert a.read().count() == 3


def test_a_feed_works_its_rows_out_a_fixed_number_of_times(spark):
    """Once to count them and once to deal them into files, however many files there are."""
    seen = spark.sparkContext.accumulator(0)

    def counted(frames):
        for f in frames:
            seen.add(len(f))
            yield f

    df = spark.createDataFrame([(i, T0 + timedelta(hours=i)) for i in range(200)], "id long, ts timestamp_ntz")
    path = write_feed(df.mapInPandas(counted, df.schema), "counted", "ts", "id", files=6)
    assert seen.value == 400 and spark.read.schema(df.schema).parquet(path).filter("id IS NOT NULL").count() == 200


def test_many_keys_share_a_state_row(spark, tmp_path):
    """More keys than groups: each key's carry and order stay its own, and so do those of rows without a key."""
    rows = [(i, None if i % 9 == 0 else i % 1500, T0 + timedelta(minutes=(i * 7919) % 6000)) for i in range(6000)]
    df = spark.createDataFrame(rows, "id long, k long, ts timestamp_ntz")
    s = feed(df, "shared", "ts", "id", files=2).select("k", "id", "_et", F.unix_micros("_et").alias("ts_us"))
    out = T.StructType([T.StructField(c, T.LongType()) for c in ("k", "seq", "id")])

    def number(k, ready, carry, upto):
        at = carry[0] if carry else 0
        return [(k, at + i, r) for i, r in enumerate(ready["id"].tolist())], (at + len(ready),), None

    got, left, _ = run(in_order(s, "k", ["id"], out, T.StructType([T.StructField("n", T.LongType())]), number), tmp_path, "sh")
    want = {}
    for i, k, at in sorted(rows, key=lambda r: (r[2], r[0])):
        want.setdefault(k, []).append(i)
    assert sorted(((r.k is None, r.k or 0), r.seq, r.id) for r in got) == sorted(((k is None, k or 0), n, i) for k, x in want.items() for n, i in enumerate(x))
    assert len(want) > 1025 >= left
