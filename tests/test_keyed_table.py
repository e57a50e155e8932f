"""The keyed table and its streams: crashes between files and commit, second writers, repeated batches, pinned readers, cleaning up."""

import pytest
from pyarrow import fs

from tidemark.functions import document_unit
from tidemark.sources.prices import PriceReader, read_prices, stored_prices
from tidemark.streaming.incremental import waves
from tidemark.streaming.keyed_table import Conflict, KeyedTable, run_into


def rows(spark, some):
    return spark.createDataFrame(some, "k int, v string")


def held(table, version=None):
    return {r.k: r.v for r in table.read(version).collect()}


def test_upserts_touch_few_buckets(spark, tmp_path):
    table = KeyedTable(spark, f"file://{tmp_path}/t", ["k"], 16)
    assert table.versions() == []
    with pytest.raises(ValueError, match="empty"):
        table.read()
    table.upsert(rows(spark, [(i, "a") for i in range(200)] + [(None, "null")]))
    first, reader = table.manifest(), table.read(1)
    table.upsert(rows(spark, [(3, "b"), (None, "other"), (500, "new")]))
    second = table.manifest()
    assert len({b for b in first["files"] if first["files"][b] != second["files"][b]}) <= 3
    assert held(table) == {i: "a" for i in range(200)} | {3: "b", 500: "new", None: "other"}
    assert held(table, 1)[3] == "a" and reader.count() == 201
    table.upsert(rows(spark, []))
    assert table.versions() == [1, 2, 3] and table.read().count() == 202
    assert table.vacuum(keep=2) > 0 and table.versions() == [2, 3]
    assert held(table)[3] == "b" and table.vacuum(keep=1) == 0


def test_a_crash_before_the_commit_loses_nothing(spark, tmp_path, monkeypatch):
    table = KeyedTable(spark, f"file://{tmp_path}/t", ["k"], 4)
    table.upsert(rows(spark, [(1, "a"), (2, "a")]))

    def crash(self, manifest):
        raise RuntimeError("crash")

    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_commit", crash)
        with pytest.raises(RuntimeError):
            table.upsert(rows(spark, [(1, "lost")]))
    assert held(table) == {1: "a", 2: "a"} and table.versions() == [1]
    table.upsert(rows(spark, [(1, "b")]))
    assert held(table) == {1: "b", 2: "a"}


def test_two_writers(spark, tmp_path, monkeypatch):
    one, other = (KeyedTable(spark, f"file://{tmp_path}/t", ["k"], 4) for _ in range(2))
    one.upsert(rows(spark, [(1, "a"), (2, "a")]))
    write = KeyedTable._write
    between = [True]

    def raced(self, new, manifest, batch):
        if between and between.pop():
            other.upsert(rows(spark, [(2, "theirs")]))
        return write(self, new, manifest, batch)

    monkeypatch.setattr(KeyedTable, "_write", raced)
    assert one.upsert(rows(spark, [(1, "ours")])) == 3
    assert held(one) == {1: "ours", 2: "theirs"}
    between.append(True)
    with pytest.raises(Conflict):
        one.upsert(rows(spark, [(1, "late")]), tries=1)


def test_streams_apply_each_batch_once(spark, tmp_path, monkeypatch):
    """A batch fails after its commit; the restarted stream repeats it and changes nothing."""
    for k in range(3):
        rows(spark, [(k, f"v{k}"), (9, f"v{k}")]).write.mode("append").parquet(f"{tmp_path}/in")
    table = KeyedTable(spark, f"file://{tmp_path}/t", ["k"], 4)
    calls = []
    upsert = KeyedTable.upsert

    def failing(self, new, batch=None, tries=3):
        version = upsert(self, new, batch, tries)
        calls.append((batch, version))
        if len(calls) == 2:
            raise RuntimeError("lost after the commit")
        return version

    monkeypatch.setattr(KeyedTable, "upsert", failing)
    start = lambda: run_into(waves(spark, f"{tmp_path}/in", "k int, v string", 1), lambda d: d, table, None, f"{tmp_path}/cp")
    with pytest.raises(Exception, match="lost after the commit"):
        start().awaitTermination()
    start().awaitTermination()
    assert [c[0] for c in calls[:3]] == [0, 1, 1] and calls[1][1] == calls[2][1]
    assert set(held(table)) == {0, 1, 2, 9} and len(table.versions()) == len({c[1] for c in calls})


def test_units_of_odd_documents(spark):
    cases = [(None, None), ("", []), ("", ["", " "]), ("", ["Consolidated balance sheets"] * 500), ("", ["Our reporting currency is the euro"])]
    df = spark.createDataFrame(cases, "raw string, lines array<string>")
    got = df.select(document_unit.document_unit(document_unit.unit_evidence("raw", "lines"))).collect()
    assert [r[0] for r in got] == [None, None, None, None, "EUR"]


def test_prices_come_through_a_source(spark, tmp_path):
    """Waves of symbols, a source that has nothing, one that fails twice, quotes of 0, repeated and null symbols."""
    (tmp_path / "first").mkdir()
    (tmp_path / "second").mkdir()
    for k in range(25):
        (tmp_path / "first" / f"S{k}.json").write_text('{"price": %s}' % (0 if k == 3 else k + 0.5))
    (tmp_path / "second" / "S3.json").write_text('{"price": 30}')
    (tmp_path / "second" / "S99.json").write_text("broken")
    symbols = spark.createDataFrame([(f"s{k} ",) for k in range(25)] + [("S99",), ("S1",), (None,), ("",), ("none",)], "ticker string")
    got = {r.ticker: (r.price, r.source, r.reason) for r in read_prices(symbols, [f"file://{tmp_path}/first", f"file://{tmp_path}/second"], wave=7).collect()}
    assert len(got) == 27 and got["S1"] == (1.5, 0, None) and got["S3"] == (30.0, 1, None)
    assert got["NONE"] == (None, None, "no data") and got["S99"] == (None, None, "no price")
    assert read_prices(symbols.limit(0), [f"file://{tmp_path}/first"]).count() == 0
    waves_of = stored_prices(spark, f"file://{tmp_path}/first", wave=7)
    assert waves_of.rdd.getNumPartitions() == 4 and stored_prices(spark, f"file://{tmp_path}/nowhere").count() == 0


def test_price_requests_are_tried_again(tmp_path):
    reader = PriceReader({"path": f"file://{tmp_path}", "pause": "0", "tries": "3"})
    (tmp_path / "A.json").write_text('{"price": 2.5}')
    store, path = fs.FileSystem.from_uri(f"file://{tmp_path}/A.json")
    failures = [OSError("busy"), OSError("busy")]

    class Busy:
        def open_input_stream(self, name):
            if failures:
                raise failures.pop()
            return store.open_input_stream(name)

    assert reader._asked(Busy(), path) == (2.5, None)
    failures += [OSError("busy")] * 3
    assert reader._asked(Busy(), path) == (None, "failed: busy")
