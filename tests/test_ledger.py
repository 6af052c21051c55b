import pytest

from barloom import files
from barloom.sinks.ledger import Ledger, Write


def rows(spark, *values):
    return spark.createDataFrame(list(values), "day string, n int")


def held(ledger, table, **kw):
    return sorted(map(tuple, ledger.read(table, **kw).select("day", "n").collect()))


def test_batches_are_visible_together_and_once(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path), {"bars": "day", "queue": "day"})
    assert ledger.read("bars") is None
    assert ledger.commit("d1", {"bars": Write(rows(spark, ("a", 1), ("b", 2))), "queue": Write(rows(spark))})
    assert held(ledger, "bars") == [("a", 1), ("b", 2)] and held(ledger, "queue") == []

    def stop(table):
        if table == "queue":
            raise KeyboardInterrupt

    late = {"bars": Write(rows(spark, ("a", 3))), "queue": Write(rows(spark, ("a", 9)))}
    with pytest.raises(KeyboardInterrupt):
        ledger.commit("d2", late, after_write=stop)
    assert held(ledger, "bars") == [("a", 1), ("b", 2)] and ledger.batches() == ["d1"]
    assert ledger.commit("d2", late) and not ledger.commit("d2", late)
    assert held(ledger, "bars") == [("a", 1), ("a", 3), ("b", 2)] and held(ledger, "queue") == [("a", 9)]
    assert held(ledger, "bars", only=["b"]) == [("b", 2)]
    before = len(files.names(spark, str(tmp_path / "bars")))
    ledger.clean()
    assert before == 3 and len(files.names(spark, str(tmp_path / "bars"))) == 2 and len(held(ledger, "bars")) == 3


def test_values_are_replaced_and_emptied(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path), {"t": "day"})
    ledger.commit("1", {"t": Write(rows(spark, ("a", 1), ("b", 2), ("c", 3)))})
    ledger.commit("2", {"t": Write(rows(spark, ("a", 4)), replace=True, emptied=("c",))})
    assert held(ledger, "t") == [("a", 4), ("b", 2)] and ledger.values("t") == ["a", "b"]
    assert held(ledger, "t", only=["zz"]) == []


def test_two_writers_at_once(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path), {"t": "day"})
    with pytest.raises(RuntimeError, match="another job"):
        ledger.commit("slow", {"t": Write(rows(spark, ("a", 1)))}, after_write=lambda t: ledger.commit("fast", {"t": Write(rows(spark, ("a", 2)))}))
    assert held(ledger, "t") == [("a", 2)]
