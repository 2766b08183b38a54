"""Tables that change by commits: delta files, marks, conflicts, compaction, removal of old folders; the index on top of them."""

import pathlib

import pytest
from pyspark.sql import functions as F

from parchmill.errors import IndexingError
from parchmill.operators import index
from parchmill.operators.changes import ChangedTable, Conflict, Rejected
from parchmill.plans import ingest

DDL = "doc string, n int, _v long"


@pytest.fixture()
def store(spark, tmp_path):
    return ChangedTable(spark, str(tmp_path / "table"), "doc string, n int", "doc", compact_after=4)


def rows(spark, *pairs):
    return spark.createDataFrame([(d, n) for d, n in pairs], "doc string, n int")


def keys(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "doc string")


def held(df):
    return sorted(tuple(r) for r in df.collect())


def test_commits_replace_whole_keys(spark, store):
    assert store.version() == 0 and held(store.read()) == []
    assert store.commit(rows(spark), keys(spark)) == 0
    assert store.commit(rows(spark, ("a", 1), ("a", 2), ("b", 1), ("b", 1)), keys(spark)) == 1
    assert store.commit(rows(spark, ("a", 9)), keys(spark, "a", "zz", None)) == 2
    assert store.commit(rows(spark), keys(spark, "b")) == 3
    assert held(store.read()) == [("a", 9)] and held(store.read(1)) == [("a", 1), ("a", 2), ("b", 1), ("b", 1)] and held(store.read(2)) == [("a", 9), ("b", 1), ("b", 1)]
    assert store.commit(rows(spark, ("b", 5)), keys(spark)) == 4 and held(store.read()) == [("a", 9), ("b", 5)]


def test_a_small_change_writes_little(spark, store, tmp_path):
    store.commit(rows(spark, *[(f"d{k}", k) for k in range(1000)]).repartition(4), keys(spark))
    before = set((tmp_path / "table").rglob("*.parquet"))
    store.commit(rows(spark, ("d7", -1)).coalesce(1), keys(spark, "d7"))
    new = [p for p in set((tmp_path / "table").rglob("*.parquet")) - before if "data" in str(p)]
    assert sum(spark.read.parquet(str(p)).count() for p in new) == 1 and before <= set((tmp_path / "table").rglob("*.parquet"))
    assert store.read().count() == 1000 and held(store.read().where("doc = 'd7'")) == [("d7", -1)]


def test_two_writers_lose_no_rows(spark, store):
    store.commit(rows(spark, ("a", 1), ("b", 1), ("c", 1)), keys(spark))
    seen = store.version()
    assert store.commit(rows(spark, ("a", 2)), keys(spark, "a"), since=seen) == 2
    # Another writer planned on version 1 too, and changes another key: both changes stay.
    assert store.commit(rows(spark, ("b", 2), ("d", 2)), keys(spark, "b"), since=seen) == 3
    assert held(store.read()) == [("a", 2), ("b", 2), ("c", 1), ("d", 2)]
    for change in ((rows(spark, ("a", 3)), keys(spark, "a")), (rows(spark, ("d", 3)), keys(spark)), (rows(spark), keys(spark, "b", "c"))):
        with pytest.raises(Conflict):
            store.commit(*change, since=seen)
    assert store.version() == 3 and held(store.read()) == [("a", 2), ("b", 2), ("c", 1), ("d", 2)]


def test_a_number_is_taken_once(spark, store):
    store.commit(rows(spark, ("a", 1)), keys(spark))
    assert not store._publish(store.state() | {"version": 1}) and store.state()["version"] == 1
    assert not [p for p in pathlib.Path(store.root, "log").iterdir() if p.name.startswith(".") and not p.name.endswith(".crc")]


def test_compaction_and_removal(spark, store, tmp_path):
    want = {}
    for k in range(9):
        changed = {f"d{j}": (k, j) for j in range(k % 3, 8, 3)}
        gone = f"d{(k + 1) % 8}" if k % 4 == 3 else None
        for d in [*changed, gone]:
            want.pop(d, None)
        want |= changed
        store.commit(rows(spark, *[(d, 10 * a + b) for d, (a, b) in changed.items()]), keys(spark, *([gone] if gone else [])))
        assert held(store.read()) == sorted((d, 10 * a + b) for d, (a, b) in want.items())
    assert len(store.state()["live"]) <= 5  # the deltas were merged on the way
    before = held(store.read())
    store.compact()
    assert held(store.read()) == before
    store.compact(full=True)
    assert held(store.read()) == before and len(store.state()["live"]) == 1 and store.state()["marks"] == []
    folders = lambda: len(list((tmp_path / "table" / "data").iterdir()))
    n = folders()
    assert store.vacuum(keep=1) == 0 and folders() == n  # nothing is old enough
    assert store.vacuum(keep=1, older_than=-1) > 0 and folders() == 1 and held(store.read()) == before


def test_compaction_keeps_commits_that_come_meanwhile(spark, store, monkeypatch):
    for k in range(3):
        store.commit(rows(spark, (f"d{k}", k)), keys(spark))
    write = store._write

    def slow(df, folder):
        write(df, folder)
        monkeypatch.setattr(store, "_write", write)
        store.commit(rows(spark, ("d1", 77), ("new", 1)), keys(spark, "d2"))

    monkeypatch.setattr(store, "_write", slow)
    store.compact()
    assert held(store.read()) == [("d0", 0), ("d1", 77), ("new", 1)]


def test_rejected_rows(spark, store, tmp_path):
    with pytest.raises(Rejected, match="1 rows rejected"):
        store.commit(rows(spark, ("a", 1), (None, 2)), keys(spark))
    assert store.version() == 0
    chunks = index.Snapshots(spark, str(tmp_path / "index"))

    def chunk(number, **other):
        return {"chunk_id": f"D-{number:04d}", "document_id": "D", "ordinal": number, "content": "text", "content_vector": [1.0, 0.0]} | other

    frame = lambda *r: spark.createDataFrame([tuple(x.get(c) for c in index.SCHEMA) for x in r], index.DDL)
    ids = spark.createDataFrame([("D",)], "document_id string")
    for bad in ({"chunk_id": None}, {"content": None}, {"content_vector": [1.0, None]}, {"content_vector": [float("nan"), 0.0]}, {"content_vector": [1.0]}, {"chunk_id": "D-0000"}, {"document_id": None}):
        with pytest.raises(IndexingError):
            chunks.commit(frame(chunk(0), chunk(1, **bad)), ids)
    assert chunks.version() == 0 and chunks.commit(frame(chunk(0), chunk(1, content_vector=None)), ids) == 1


def test_runs_side_by_side(spark, tmp_path):
    """Two runs planned on one version: different documents are both kept, one document is a conflict."""
    store = index.Snapshots(spark, str(tmp_path / "index"))
    files = lambda *names: spark.createDataFrame([(f"{n}.md", f"# {n}\n\ntext of {n} {i}".encode()) for n, i in names], "path string, content binary")
    settings = ingest.Settings(dimensions=8)
    ingest.run(files(("a", 1), ("b", 1)), store, settings)
    current, seen = store.read(), store.version()
    one, two = (ingest.plan(files((n, 2)), current, settings) for n in "ab")
    store.commit(one.chunks, one.chunks.select("document_id"), seen)
    store.commit(two.chunks, two.chunks.select("document_id"), seen)
    assert {r["content"] for r in store.read().collect()} == {"text of a 2", "text of b 2"}
    with pytest.raises(Conflict):
        store.commit(one.chunks, one.chunks.select("document_id"), seen)
    assert store.read().where(F.col("document_id") == "A").count() == 1


def test_gate_with_two_known_hashes(spark):
    known = spark.createDataFrame([("A", "x"), ("A", "y")], "document_id string, content_hash string")
    assert index.gate(spark.createDataFrame([("A", "y"), ("B", "z")], "document_id string, content_hash string"), known).count() == 2
