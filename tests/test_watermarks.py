"""Watermark per log partition with idleness: batch operator and streaming fold, against the rule by hand."""
import datetime as dt
import random
import uuid
from collections import Counter

from pyspark.sql import functions as F

from quillstream.functions.codec import encode_one
from quillstream.operators.running import numbered, previous, ranges, running_max
from quillstream.operators.watermarks import classify_late_by_partition, combined_watermarks, partition_states
from quillstream.schema import LOG_ROW
from quillstream.session import warehouse_root
from quillstream.sources.log import read_log_stream
from quillstream.streaming import jobs
from quillstream.streaming.partition_windows import PartitionWindows, start_partition_window_job, watermark_in_force

TRIGGER, IDLE, DELAY = 30_000, 60_000, 5_000


def by_hand(rows, partitions):
    """Watermark at the start of every micro-batch from the first to the last, one after the other."""
    lo, hi = min(r[0] for r in rows), max(r[0] for r in rows)
    held, out = None, {}
    for b in range(lo, hi + 1):
        now, own, waiting = b * TRIGGER, [], False
        for p in partitions:
            mine = [(e, a) for batch, q, e, a in rows if q == p and batch < b]
            if now - max([a for _, a in mine], default=lo * TRIGGER) > IDLE:
                continue
            waiting |= not mine
            own += [max(e for e, _ in mine) - DELAY] if mine else []
        if own and not waiting:
            held = max([min(own), *([] if held is None else [held])])
        out[b] = held
    return out


def test_random_logs_equal_the_rule(spark):
    """Sparse, bursty and unused log partitions; every reading's watermark is that of its batch."""
    rng = random.Random(3)
    for case in range(4):
        rows = []
        for _ in range(60):
            arrival = rng.randrange(0, 1_500_000) if case % 2 else rng.choice([0, 400_000, 800_000]) + rng.randrange(120_000)
            rows.append((arrival // TRIGGER, rng.choice([0, 0, 0, 1, 2]), arrival - rng.randrange(0, 200_000), arrival))
        want = by_hand(rows, range(4))
        df = spark.createDataFrame(rows, "batch_id long, partition int, ts_ms long, arrival_ms long")
        got = {r.batch: r.watermark_ms for r in combined_watermarks(partition_states(df, range(4), "batch_id")).collect()}
        assert {b: want[b] for b in got} == got and set(got) >= {r[0] for r in rows}
        late = classify_late_by_partition(df, range(4), "batch_id")
        assert Counter((r.batch_id, r.ts_ms, r.is_late) for r in late.collect()) == Counter(
            (b, e, want[b] is not None and e // 60_000 * 60_000 + 60_000 <= want[b]) for b, _, e, _ in rows)


def test_slow_partition_holds_until_idle(spark):
    rows = [(0, 0, 0, 0), (0, 1, 0, 0), (1, 0, 100_000, 30_000), (2, 0, 200_000, 60_000), (3, 0, 300_000, 90_000), (4, 0, 400_000, 120_000)]
    df = spark.createDataFrame(rows, "batch_id long, partition int, ts_ms long, arrival_ms long")
    got = {r.batch: r.watermark_ms for r in combined_watermarks(partition_states(df, (0, 1), "batch_id")).collect()}
    # partition 1 sent its last record at 0: it holds the watermark up to 60 s and is left out from 90 s on
    assert got == {0: None, 1: -5_000, 2: -5_000, 3: 195_000, 4: 295_000}


def test_empty_log(spark):
    df = spark.createDataFrame([], "batch_id long, partition int, ts_ms long, arrival_ms long")
    assert combined_watermarks(partition_states(df, (0, 1), "batch_id")).count() == 0
    assert classify_late_by_partition(df, (0, 1), "batch_id").count() == 0


def test_running_helpers_across_chunks(spark):
    rng = random.Random(7)
    rows = [(k, t, rng.choice([None, rng.randrange(100)])) for k in "ab" for t in rng.sample(range(200), 60)]
    df = spark.createDataFrame(rows, "k string, t long, v long")
    top = {(r.k, r.t): r.m for r in running_max(df, ["k"], "t", {"v": "m"}, 16).collect()}
    place = {(r.k, r.t): r.n for r in numbered(df, ["k"], "t", "n", 16).collect()}
    before = {(r.k, r.t): r.p for r in previous(df, ["k"], "t", "v", "p", 16).collect()}
    for k in "ab":
        own = sorted((t, v) for key, t, v in rows if key == k)
        for i, (t, _) in enumerate(own):
            assert top[k, t] == max((v for _, v in own[:i] if v is not None), default=None)
            assert place[k, t] == i and before[k, t] == (own[i - 1][1] if i else None)
    runs = sorted((r.k, r.first, r.last) for r in ranges(df.union(df), ["k"], "t", 16).collect())
    want = []
    for k in "ab":
        for t in sorted({t for key, t, _ in rows if key == k}):
            if want and want[-1][0] == k and want[-1][2] == t - 1:
                want[-1] = (k, want[-1][1], t)
            else:
                want.append((k, t, t))
    assert runs == want


# ------------------------------------------------------------------- streaming fold

def _log_row(partition, offset, device, secs, arrival, value=None):
    fields = dict(device_id=device, site_id="s", ts=int(secs * 1000), temperature_c=20.0, humidity_pct=50.0, pressure_hpa=1000.0, vibration_g=0.1)
    at = dt.datetime.fromtimestamp(arrival, dt.timezone.utc).replace(tzinfo=None)
    return (device.encode(), value if value is not None else encode_one(fields), "iot.telemetry", partition, offset, at)


#: micro-batches of (partition, device, event second, arrival second); the clock is each batch's first arrival
BATCHES = [[(0, "a", 10, 30), (1, "b", 12, 31)], [(0, "a", 130, 60), (0, "a", 15, 61), (1, "b", 20, 62)], [(0, "a", 200, 90)],
           [(0, "a", 280, 125), (0, "a", 30, 126)], [(1, "b", 40, 200), (0, "c", 400, 201)], [(0, "a", 500, 230), (1, "b", 290, 231)]]


def _fold_by_hand():
    state, held, opened, fired, late = {}, None, Counter(), {}, 0
    start = BATCHES[0][0][3] * 1000
    for batch in BATCHES:
        held = watermark_in_force({"start": start, "watermark": held, "partitions": {str(p): v for p, v in state.items()}},
                                  batch[0][3] * 1000, (0, 1), DELAY, IDLE)
        for p, device, event, arrival in batch:
            end = event // 60 * 60_000 + 60_000
            if held is not None and end <= held:
                late += 1
            else:
                opened[device, end] += 1
            e, a = state.get(p, (0, 0))
            state[p] = max(e, event * 1000), max(a, arrival * 1000)
        for key in [k for k in opened if held is not None and k[1] <= held]:
            fired[key] = opened.pop(key)
    return fired, late


def _run(spark, root, table, upto=None):
    source = read_log_stream(spark, f"{root}/log/*", max_files_per_trigger=1)
    clock = lambda batch: int(batch.agg(F.min(F.unix_millis("timestamp"))).first()[0])
    q = start_partition_window_job(source, table, f"{root}/dlq", f"{root}/ckpt", (0, 1), trigger={"availableNow": True}, name="by_partition", clock=clock)
    q.awaitTermination()
    assert q.exception() is None


def test_streaming_fold_with_restarts(spark):
    root = f"{warehouse_root(spark)}/test-partition-windows-{uuid.uuid4().hex[:8]}"
    table = jobs.agg_table(spark, root)
    for i, batch in enumerate(BATCHES):
        rows = [_log_row(p, 10 * i + n, d, e, a) for n, (p, d, e, a) in enumerate(batch)]
        if i == 1:
            rows.append(_log_row(0, 19, "a", 1, 63, value=b"\x01"))
        spark.createDataFrame(rows, LOG_ROW).coalesce(1).write.parquet(f"{root}/log/f{i:03d}")
        _run(spark, root, table)
    fired, late = _fold_by_hand()
    got = {(r.device_id, int(r.window_end.replace(tzinfo=dt.timezone.utc).timestamp()) * 1000): r.reading_count for r in table.read().collect()}
    assert got == fired and len(fired) == 3 and late >= 1
    letters = Counter(v.value.split('"')[3] for v in jobs.read_dead_letters(spark, f"{root}/dlq").collect())
    assert letters == Counter({"late": late, "deserialize": 1})


def test_repeated_batch_keeps_its_decision(spark):
    """The same batch again, with the clock moved on, writes the same rows and no second commit."""
    root = f"{warehouse_root(spark)}/test-partition-repeat-{uuid.uuid4().hex[:8]}"
    table = jobs.agg_table(spark, root)
    now = [0]
    fold = PartitionWindows(table, f"{root}/dlq", f"{root}/state", "w", (0, 1), clock=lambda _: now[0])
    rows = "partition int, device_id string, event_ms long, timestamp timestamp, stage string, reject_reason string, payload_len long, " \
           "temperature_c double, humidity_pct double, pressure_hpa double"
    at = lambda s: dt.datetime(1970, 1, 1) + dt.timedelta(seconds=s)
    batch = lambda *r: spark.createDataFrame([(p, "d", 1000 * e, at(a), None, None, 9, 1.0, 2.0, 3.0) for p, e, a in r], rows)
    fold.sink(batch((0, 5, 1), (1, 5, 1)), 0)
    now[0] = 30_000
    fold.sink(batch((0, 200, 30)), 1)
    now[0] = 80_000
    fold.sink(batch((0, 200, 30)), 1)            # partition 1 would count as idle now
    assert table.read().count() == 0 and table.commits().count() == 2
    fold.sink(batch((0, 700, 80)), 2)            # and does here: the first window is done
    assert sorted(r.reading_count for r in table.read().collect()) == [2]
