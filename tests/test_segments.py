"""Which segments are read, merged and removed."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from curbline import storage
from curbline.streaming import versions
from curbline.streaming.segments import FAN, Segment, Segments, due, widest


@pytest.fixture
def segments(spark, tmp_path):
    def added(rows):
        return rows.groupBy("k").agg(F.sum("n").alias("n"))

    return Segments(spark, str(tmp_path / "totals"), added, added)


def put(segments, first, last=None, n=1):
    rows = segments.spark.createDataFrame([("a", n), ("b", 10 * n)], "k string, n long").coalesce(1)
    segments.write(rows, Segment(first, first if last is None else last))


def sums(segments):
    return dict(map(tuple, segments.merge(segments.read()).collect()))


def test_widest_segments_hold_each_batch_once():
    parts = [Segment(i, i) for i in range(10)]
    assert widest(parts) == parts
    assert widest([*parts, Segment(0, 7)]) == [Segment(0, 7), Segment(8, 8), Segment(9, 9)]
    assert Segment(0, 7).level == 1 and Segment(3, 3).level == 0 and Segment(0, FAN**2 - 1).level == 2


def test_only_neighbours_of_a_level_are_merged():
    assert due([Segment(i, i) for i in range(FAN - 1)]) == []
    assert due([Segment(i, i) for i in range(FAN + 2)]) == [Segment(i, i) for i in range(FAN)]
    gap = [Segment(i, i) for i in range(2 * FAN) if i != 3]
    assert due(gap) == [Segment(i, i) for i in range(4, 4 + FAN)]


def test_merging_keeps_sums_and_bounds_the_number(segments):
    for batch in range(70):
        put(segments, batch)
        if batch % 5 == 0:
            segments.compact()
    segments.compact()
    assert sums(segments) == {"a": 70, "b": 700}
    assert len(widest(segments.complete())) <= 2 * FAN
    assert Segment(0, FAN**2 - 1) in segments.complete()
    segments.compact()  # what was merged before goes now
    assert segments.complete() == widest(segments.complete())


def test_broken_off_merges_and_repeated_batches_count_once(segments, spark):
    for batch in range(3):
        put(segments, batch)
    put(segments, 0, 1, n=2)  # a merge that ended; its parts are still there
    storage.write_text(spark, f"{segments.folder}/{Segment(0, 2).name}/part-x.parquet", "half")  # one that didn't
    assert sums(segments) == {"a": 3, "b": 30}
    put(segments, 2)  # again
    assert sums(segments) == {"a": 3, "b": 30}


def test_no_totals(segments):
    assert not segments.exists()
    with pytest.raises(ValueError, match="no totals"):
        segments.read()
    segments.compact()
    segments.drop()


def test_old_versions_go_after_a_while(spark):
    name = "some_versions"
    try:
        for n in range(6):
            versions.publish(spark.range(n), name, kept=2)
            assert spark.table(name).count() == n
        assert versions.versions(spark, name) == [5, 6]
        # A job that fails leaves the view as it was.
        broken = spark.range(3).select(F.raise_error(F.lit("stopped")).alias("id"))
        with pytest.raises(Exception, match="stopped"):
            versions.publish(broken, name)
        assert spark.table(name).count() == 5
    finally:
        versions.drop(spark, name)
    assert versions.kind_of(spark, name) is None and versions.versions(spark, name) == []


def test_a_plain_table_becomes_versions(spark):
    name = "was_a_table"
    spark.range(4).write.saveAsTable(name)
    try:
        versions.publish(spark.range(2), name)
        assert (versions.kind_of(spark, name), spark.table(name).count()) == ("view", 2)
    finally:
        versions.drop(spark, name)
