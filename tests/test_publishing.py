"""Versioned lists and writers of several stores: all or nothing."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from viewloom.sinks import outside
from viewloom.sinks.versions import ListStore

LISTS = "list_key string, rank int, content_id bigint"


def lists(spark, **by_key):
    rows = [(key, i + 1, item) for key, items in by_key.items() for i, item in enumerate(items)]
    return spark.createDataFrame(rows, LISTS)


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["list_key"], r["rank"])):
        out.setdefault(r["list_key"], []).append(r["content_id"])
    return out


def test_lists_are_replaced_by_key(spark, tmp_path):
    store = ListStore(spark, str(tmp_path / "store"), ranges=4)
    assert store.versions() == []
    with pytest.raises(ValueError):
        store.read()
    assert store.publish(lists(spark, a=[1, 2, 3], b=[4], c=[5, 6])) == 1
    assert store.publish(lists(spark, a=[9], d=[7, 8]), "second") == 2
    assert found(store.read()) == {"a": [9], "b": [4], "c": [5, 6], "d": [7, 8]}
    assert found(store.read(1)) == {"a": [1, 2, 3], "b": [4], "c": [5, 6]}
    # Gates: too short a list, and one that is shorter than the stored one.
    store.publish(lists(spark, a=[1], b=[1, 2], c=[0, 0]), more_than=1)
    assert found(store.read()) == {"a": [9], "b": [1, 2], "c": [0, 0], "d": [7, 8]}
    store.publish(lists(spark, b=[3], c=[4, 4], d=[5, 5, 5]), keep_longer=True)
    assert found(store.read()) == {"a": [9], "b": [1, 2], "c": [4, 4], "d": [5, 5, 5]}
    # The same run again changes nothing, nor does an empty one.
    assert store.publish(lists(spark, z=[1]), "second") == 4
    assert store.publish(lists(spark, a=[1]).where("false")) == 5
    assert found(store.read()) == {"a": [9], "b": [1, 2], "c": [4, 4], "d": [5, 5, 5]}
    with pytest.raises(ValueError):
        store.publish(lists(spark, a=[1]).withColumn("more", F.lit(1)))


def test_only_touched_ranges_are_written(spark, tmp_path):
    store = ListStore(spark, str(tmp_path), ranges=16)
    store.publish(lists(spark, **{f"k{i}": [i] for i in range(60)}))
    before = store.manifest().folders
    store.publish(lists(spark, k7=[0, 1]))
    changed = {r for r, f in store.manifest().folders.items() if f != before.get(r)}
    assert len(changed) == 1 and found(store.read())["k7"] == [0, 1] and len(found(store.read())) == 60


def test_a_run_that_ends_before_the_switch_changes_nothing(spark, tmp_path, monkeypatch):
    store = ListStore(spark, str(tmp_path), ranges=4)
    store.publish(lists(spark, a=[1], b=[2]))

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(ListStore, "_switch", killed)
    with pytest.raises(KeyboardInterrupt):
        store.publish(lists(spark, a=[5]), "late")
    monkeypatch.undo()
    assert found(store.read()) == {"a": [1], "b": [2]} and store.versions() == [1]
    assert store.publish(lists(spark, a=[5]), "late") == 2
    assert found(store.read()) == {"a": [5], "b": [2]}
    store.clean(keep=1)
    assert store.versions() == [2] and found(store.read()) == {"a": [5], "b": [2]}
    named = {f.split("/")[1] for f in store.manifest().folders.values()}
    assert {n for n in os.listdir(tmp_path / "data") if not n.endswith(".crc")} == named


def test_of_two_publications_at_once_one_fails(spark, tmp_path, monkeypatch):
    store, other = (ListStore(spark, str(tmp_path), ranges=4) for _ in range(2))
    store.publish(lists(spark, a=[1]))
    switch = ListStore._switch

    def late(self, manifest):
        monkeypatch.undo()
        other.publish(lists(spark, b=[2]))
        switch(self, manifest)

    monkeypatch.setattr(ListStore, "_switch", late)
    with pytest.raises(Exception, match="(?i)exist"):
        store.publish(lists(spark, a=[9]))
    assert found(store.read()) == {"a": [1], "b": [2]}


ROWS = "rank int, content_id bigint"


def stores(tmp_path):
    return [str(tmp_path / name) for name in ("one", "two")]


def files(root):
    return sorted(os.path.relpath(os.path.join(d, f), root) for d, _, names in os.walk(root) for f in names)


def test_stores_get_the_same_lists(spark, tmp_path):
    roots = stores(tmp_path)
    outside.publish_to(lists(spark, a=[1, 2], b=[3]).repartition(3), roots, "r1")
    outside.publish_to(lists(spark, b=[4, 5], c=[6]), roots, "r2")
    outside.publish_to(lists(spark, a=[0], c=[0]), roots, "r1")  # the run is there
    for root in roots:
        assert found(outside.read_store(spark, root, ROWS)) == {"a": [1, 2], "b": [4, 5], "c": [6]}
        assert outside.FolderStore(root).runs() == ["r1", "r2"]
        assert not any(f.startswith("staged/") for f in files(root))


def test_a_failing_task_leaves_all_stores_as_they_were(spark, tmp_path):
    roots = stores(tmp_path)
    outside.publish_to(lists(spark, a=[1]), roots, "r1")
    before = [files(r) for r in roots]
    bad = lists(spark, a=[2], b=[3], c=[4]).repartition(3, "list_key")
    bad = bad.withColumn("content_id", F.when(F.col("list_key") == "c", F.raise_error(F.lit("lost")).cast("bigint")).otherwise(F.col("content_id")))
    with pytest.raises(Exception, match="lost"):
        outside.publish_to(bad, roots, "r2")
    assert [[f for f in files(r) if not f.startswith("staged")] for r in roots] == before
    time.sleep(2)  # for tasks that were still running
    outside.clean(roots)
    assert [files(r) for r in roots] == before
    assert all(found(outside.read_store(spark, r, ROWS)) == {"a": [1]} for r in roots)


@pytest.mark.parametrize("method,committed", [("place", False), ("note", False), ("switch", True)])
def test_a_run_that_stops_while_it_is_put_in_place(tmp_path, monkeypatch, method, committed):
    """The second store fails: before the note nothing stays, after it everything is finished."""
    roots = stores(tmp_path)
    writer = outside._StoresWriter(roots, "r1")
    message = writer.write(iter([{"list_key": "a", "rows": []}]))
    working = getattr(outside.FolderStore, method)
    failing = roots[0] if method == "note" else roots[1]

    def fails(self, *args):
        if self.root == failing:
            raise OSError("no space")
        return working(self, *args)

    monkeypatch.setattr(outside.FolderStore, method, fails)
    with pytest.raises(OSError):
        writer.commit([message])
    monkeypatch.undo()
    outside.recover(roots)
    assert [outside.FolderStore(r).runs() for r in roots] == [["r1"] * committed] * 2
    if not committed:
        assert [files(r) for r in roots] == [[], []]
        assert outside.FolderStore(roots[0]).notes() == {}
