import gzip
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from barloom.operators.indicators import latest_indicators
from barloom.plans import incremental as INC
from tests.conftest import bar, bars_frame, days


def walk(seed, sid, dates):
    rng, price, out = random.Random(seed), 100.0, []
    for d in dates:
        price *= 1 + rng.uniform(-0.03, 0.03)
        out.append(bar(d, price, sid, open=price * 0.99, high=price * 1.02, low=price * 0.97, volume=rng.uniform(1, 9)))
    return out


def same(series, bars):
    """Bit for bit, every column."""
    got, want = INC.indicators(series), latest_indicators(bars)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


@pytest.mark.parametrize("length", [5, 40, 600])
def test_states_go_on_from_day_to_day(spark, tmp_path, length):
    dates = days(length + 12)
    full = {s: walk(i, s, dates[: len(dates) - i]) for i, s in enumerate(["US-000001", "US-000002", "US-000003"])}
    series = INC.open_series(spark, str(tmp_path))
    cuts = [dates[length - 1], dates[length], dates[length + 6], dates[-1]]
    before = None
    for i, cut in enumerate(cuts):
        part = [b for rows in full.values() for b in rows if b[1] <= cut and (before is None or b[1] > before)]
        assert INC.take_in(series, str(cut), bars_frame(spark, part), buckets=4)
        assert not INC.take_in(series, str(cut), bars_frame(spark, part), buckets=4)
        same(series, bars_frame(spark, [b for rows in full.values() for b in rows if b[1] <= cut]))
        before = cut


def test_late_and_corrected_dates_recompute_their_security_only(spark, tmp_path, monkeypatch):
    dates = days(80)
    ids = [f"US-{i:06d}" for i in range(1, 9)]
    full = {s: walk(i, s, dates) for i, s in enumerate(ids)}
    late = full["US-000002"].pop(30)
    series = INC.open_series(spark, str(tmp_path))
    INC.take_in(series, "history", bars_frame(spark, [b for rows in full.values() for b in rows[:-1]]), buckets=16)
    corrected = bar(dates[10], 50, "US-000005")
    reads = []
    read = series.read
    monkeypatch.setattr(series, "read", lambda table, only=None: (reads.append((table, only)), read(table, only))[1])
    new = bars_frame(spark, [late, corrected, full["US-000003"][-1], bar(dates[5], 7, "US-000099")])
    INC.take_in(series, "day", new, buckets=16)
    bucket = {r.security_id: r.b for r in spark.createDataFrame([(s,) for s in [*ids, "US-000099"]], "security_id string").select(
        "security_id", INC.bucket_of(F.col("security_id"), 16).alias("b")).collect()}
    assert reads[0] == ("states", reads[0][1]) and set(reads[0][1]) == {bucket[s] for s in ("US-000002", "US-000003", "US-000005", "US-000099")}
    assert reads[1][0] == "bars" and set(reads[1][1]) == {bucket["US-000002"], bucket["US-000005"]}
    monkeypatch.undo()
    history = [b for s, rows in full.items() for b in (rows if s == "US-000003" else rows[:-1]) if (s, b[1]) != ("US-000005", dates[10])]
    same(series, bars_frame(spark, history + [late, corrected, bar(dates[5], 7, "US-000099")]))
    assert series.read("bars").count() == len(history) + 3


def test_a_day_reads_only_the_files_of_its_buckets(spark, tmp_path):
    dates = days(30)
    series = INC.open_series(spark, str(tmp_path))
    INC.take_in(series, "h", bars_frame(spark, [b for i in range(30) for b in walk(i, f"US-{i:06d}", dates)]), buckets=32)
    some = series.read("states", only=[INC_bucket(spark, "US-000004")])
    assert {f"bucket={INC_bucket(spark, 'US-000004')}" in f for f in some.inputFiles()} == {True}


def INC_bucket(spark, sid):
    return spark.range(1).select(INC.bucket_of(F.lit(sid), 32).alias("b")).first().b


def test_refresh_follows_new_changed_and_deleted_files(spark, tmp_path):
    from barloom.plans import refresh as REF
    from tests.test_stores import line, put
    root, d = str(tmp_path / "days"), days(5)
    for i, x in enumerate(d[:4]):
        put(f"{root}/{x}/part-1.ndjson.gz", [line(x, 10 + i)])

    def write(close):  # stored without compression, so the size follows from the length of the text
        path = f"{root}/{d[0]}/part-1.ndjson.gz"
        with open(path, "wb") as out:
            out.write(gzip.compress((json.dumps(line(d[0], close)) + "\n").encode(), 0, mtime=0))
        return os.path.getsize(path)
    size = write(12)
    put(f"{root}/{d[1]}/part-2.ndjson.gzip", [line(d[1], 77, "US-000002")])
    mirror = REF.open_mirror(spark, str(tmp_path / "mirror"))
    assert {r.state for r in REF.refresh(mirror, root, "1").collect()} == {"NEW"}
    before = mirror._record()["tables"]["bars"]["places"]
    assert write(20) == size  # other content, same size
    os.remove(f"{root}/{d[1]}/part-1.ndjson.gz")
    os.remove(f"{root}/{d[2]}/part-1.ndjson.gz")
    put(f"{root}/{d[4]}/aa/part-1.ndjson.gz", [line(d[4], 50)])
    states = {"/".join(r.path.split("/")[-2:]): r.state for r in REF.refresh(mirror, root, "2").collect()}
    assert states == {f"{d[0]}/part-1.ndjson.gz": "CHANGED", f"{d[1]}/part-1.ndjson.gz": "DELETED", f"{d[1]}/part-2.ndjson.gzip": "UNCHANGED",
                      f"{d[2]}/part-1.ndjson.gz": "DELETED", f"{d[3]}/part-1.ndjson.gz": "UNCHANGED", "aa/part-1.ndjson.gz": "NEW"}
    assert sorted((r.date, r.close) for r in mirror.read("bars").collect()) == [(d[0], 20), (d[1], 77), (d[3], 13), (d[4], 50)]
    after = mirror._record()["tables"]["bars"]["places"]
    assert after[str(d[3])] == before[str(d[3])] and str(d[2]) not in after and after[str(d[0])] != before[str(d[0])]
    assert {r.state for r in REF.refresh(mirror, root, "3").collect()} == {"UNCHANGED"} and mirror.batches() == ["1", "2"]
