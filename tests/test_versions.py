"""Commit pointer: half-written versions are never read, two writers at once are told apart, old ones expire."""

import os

import pytest

from newsloom.sources.versions import ConflictingWrite, VersionedTable


def _frame(spark, n):
    return spark.createDataFrame([(n,)], "n int")


def _value(table):
    return [r["n"] for r in table.read().collect()]


def test_only_committed_versions_are_read(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert table.read() is None and table.current() is None
    assert table.publish(_frame(spark, 1), "a").collect() == [(1,)]
    table.stage(_frame(spark, 2), "b")                       # its writer dies before the commit
    assert _value(table) == [1]
    pointer = tmp_path / "t" / "_commits" / f"{2:012d}"
    pointer.write_text("b\tdata/b-")                         # or while it writes the pointer
    assert _value(table) == [1]
    table.publish(_frame(spark, 3), "c")
    assert _value(table) == [3] and table.current().number == 3


def test_the_second_of_two_writers_is_told(spark, tmp_path):
    one, two = (VersionedTable(spark, str(tmp_path / "t")) for _ in range(2))
    one.publish(_frame(spark, 0), "start")
    seen = one.last_number(), two.last_number()
    folders = one.stage(_frame(spark, 1), "x"), two.stage(_frame(spark, 2), "y")
    one.commit("x", folders[0], seen[0])
    with pytest.raises(ConflictingWrite):
        two.commit("y", folders[1], seen[1])
    assert _value(two) == [1]


def test_old_versions_expire_and_versions_can_be_written_again(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    for n in range(6):
        table.publish(_frame(spark, n), f"v{n % 4}", keep=3)
    assert [c.version for c in table.commits()] == ["v1", "v0", "v3"]
    assert len(os.listdir(tmp_path / "t" / "data")) == 3
    assert [r["n"] for r in table.read("v1").collect()] == [5] and table.read("v2") is None
