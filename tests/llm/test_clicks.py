"""Expiring deduplication of clicks against a plain fold in Python."""

import datetime as dt
import hashlib
import random
import zlib
from pathlib import Path

import pytest

from florilege.llm import clicks as own

SCHEMA = "click_id long, ts timestamp_ntz, arrived_at timestamp_ntz, client_id long, kind string, value double, props string, hash string"


def brute(rows, n_batches=12):
    """Windows of the contract, row by row."""
    epoch = dt.datetime(1970, 1, 1)
    micros = lambda t: (t - epoch) // dt.timedelta(microseconds=1)
    all_ = []
    for click, ts, arrived, client, kind, value, props, *_ in rows:
        if click is None or click < 0 or arrived is None:
            continue
        for j in range(click % 3 + 1):
            c = zlib.crc32(f"{click}:{j}".encode())
            hour = micros(arrived) // 3_600_000_000 + 6 * j * (c % 10)
            text = "|".join("" if x is None else str(x) for x in (client, kind, None if value is None else int((100 * value + 0.5) // 1), None if ts is None else micros(ts), props, c % 3))
            all_.append((click, hour, hour + c // 10 % 200, hashlib.sha256(text.encode()).hexdigest()))
    if not all_:
        return []
    low, high = min(x[2] for x in all_), max(x[2] for x in all_)
    parts = [[] for _ in range(n_batches)]
    for click, hour, place, digest in all_:
        parts[(place - low) * n_batches // (high - low + 1)].append((click, hour, digest))
    open_, out, most = {}, [], None

    def close(click, batch):
        start, digest, n, m, crc = open_.pop(click)
        out.append((click, start, batch, n, m, crc, digest))

    for k, part in enumerate(parts):
        for click, hour, digest in sorted(x for x in part if most is None or x[1] >= most - 48):
            if click in open_ and hour <= open_[click][0] + 72:
                w = open_[click]
                w[2] += 1
                w[3] += digest != w[1]
                w[4] += zlib.crc32(digest.encode()) * (digest != w[1])
            else:
                if click in open_:
                    close(click, k)
                open_[click] = [hour, digest, 0, 0, 0]
        hours = [x[1] for x in part]
        most = max([*hours, *([most] if most is not None else [])], default=None)
        for click in [c for c, w in open_.items() if most is not None and (w[0] + 72 < most - 48 or k == n_batches - 1)]:
            close(click, k)
    return sorted(out)


def rows_of(n, ids, seed, days=20):
    r = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    out = []
    for _ in range(n):
        at = start + dt.timedelta(minutes=r.randrange(days * 1440))
        out.append((r.randrange(ids), r.choice([None, at]), at, r.choice([None, 1, 2]), r.choice([None, "view", "a|b"]), r.choice([None, 1.005, -3.5, 17.0]), r.choice([None, "{}", "|"]), "clash"))
    return out


def found(spark, rows, n_batches=12):
    out = own.dedupe_clicks(spark.createDataFrame(rows, SCHEMA), n_batches)
    assert out.columns == ["click_id", "start_hour", "closed_batch", "n_repeats", "n_conflicts", "conflict_crc", "hash"]
    return sorted(map(tuple, out.collect()))


def test_many_rows_of_few_clicks(spark):
    rows = rows_of(900, 40, 1)
    rows += rows[:50] + [(None, None, dt.datetime(2024, 1, 3), 1, "view", 1.0, "x", "y"), (4, None, None, 1, "view", 1.0, "x", "y"), (-5, None, dt.datetime(2024, 1, 3), 1, "view", 1.0, "x", "y")]
    got = found(spark, rows, 5)
    assert got == brute(rows, 5)
    assert {x[2] for x in got} == set(range(5))


def test_one_hot_click_long_props_and_gaps(spark):
    rows = [(5, None, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h % 90), h % 4, "view", 1.0, "p" * 200_000 if h == 7 else "p", "c") for h in range(400)]
    rows += [(6, None, dt.datetime(2024, 3, 1), 1, "view", 1.0, "p", "c")]  # batches between have no rows
    assert found(spark, rows, 4) == brute(rows, 4)


def test_times_before_1970_in_another_zone(spark):
    rows = [(k % 7, dt.datetime(1969, 12, 1, 0, 0, 0, 5), dt.datetime(1969, 12, 1) + dt.timedelta(hours=11 * k), 1, "view", 1.0, "p", "c") for k in range(80)]
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = found(spark, rows, 3)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == brute(rows, 3)


def test_empty_table(spark):
    assert found(spark, []) == []


@pytest.mark.parametrize("seed", range(4))
def test_fold_keeps_what_is_packed(seed):
    """A fold in parts over packed blobs gives the windows of one fold over all, if parts follow in order."""
    import numpy as np

    r = np.random.default_rng(seed)
    n = 500
    hour = np.sort(r.integers(0, 2000, n))
    rows = (r.integers(0, 20, n), hour, r.integers(0, 3, (n, 4)).astype(np.uint64), r.integers(0, 1 << 32, n), r.integers(1, 3, n))
    whole, closed = own.fold(own.Windows.none(), *rows)
    cut = np.searchsorted(hour, hour[n // 2])  # rows of one hour stay together
    half, first = own.fold(own.Windows.none(), *(x[:cut] for x in rows))
    parts, second = own.fold(own.Windows.unpack(half.pack()), *(x[cut:] for x in rows))
    assert (parts.closed(0).to_numpy() == whole.closed(0).to_numpy()).all()
    both = (first + second).closed(0).sort_values(["click_id", "start_hour"]).to_numpy()
    assert (both == closed.closed(0).sort_values(["click_id", "start_hour"]).to_numpy()).all()


def test_state_is_held_in_no_native_store(spark, monkeypatch):
    """A RocksDB for each partition and start leaves memory outside the heap; its files are changelogs and archives."""
    seen, remove = [], own.remove_folder

    def look(session, path):
        seen.extend(x.name for x in Path(path.removeprefix("file:")).rglob("state/*/*/*") if not x.name.startswith("."))
        remove(session, path)

    monkeypatch.setattr(own, "remove_folder", look)
    rows = rows_of(60, 20, 2)
    assert found(spark, rows, 2) == brute(rows, 2)
    assert any(x.endswith(".delta") for x in seen) and not any(x.endswith((".changelog", ".zip")) for x in seen)


def test_small_partitions_share_files_of_a_batch(spark, tmp_path):
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    were = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        own.write_batches(own.copies(spark.createDataFrame(rows_of(900, 300, 3), SCHEMA)), str(tmp_path / "staged"), 3)
    finally:
        for k, v in were.items():
            spark.conf.set(k, v)
    assert {x.name for x in (tmp_path / "staged").glob("batch=*")} == {"batch=0", "batch=1", "batch=2"}
    assert len(list((tmp_path / "staged").glob("batch=*/*.parquet"))) <= 3 * spark.sparkContext.defaultParallelism
    last = spark.read.parquet(str(tmp_path / "staged")).filter("n = 0")
    assert sorted((x.batch, x.shard) for x in last.collect()) == [(2, k) for k in range(own.LEAST_SHARDS)]


def test_query_over_the_whole_table(spark):
    import __spark_entry__

    folder = "/root/testdata/sf0.001"
    own_rows = spark.read.parquet(f"{folder}/clicks.parquet").select("click_id", "ts", "arrived_at", "client_id", "kind", "value", "props").collect()
    assert sorted(map(tuple, __spark_entry__.queries()["op11_expiring_clicks"](spark, folder).collect())) == brute(own_rows)
