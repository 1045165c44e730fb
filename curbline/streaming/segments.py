"""Additive totals of a stream, one segment of files for each micro-batch, merged as they grow.

A segment is a folder ``batches=FIRST-LAST`` with the totals of those micro-batches, and is never
changed once its ``_SUCCESS`` is written. A batch that is repeated after a failure writes its segment
again and adds nothing. Segments are merged by level, FAN of them into one, so that n batches are
held in about FAN * log(n) segments and a row of totals is written once a level. Readers take the
widest segments, so each batch counts once whether a merge broke off, came to its end or removed
what it has merged.

What the stream has taken is in its checkpoint beside the segments: the log of the files of each
batch, not a clock.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from curbline import storage

FAN = 8
NAME = re.compile(r"batches=(\d+)-(\d+)")


@dataclass(frozen=True, order=True)
class Segment:
    first: int
    last: int

    @property
    def name(self) -> str:
        return f"batches={self.first:010d}-{self.last:010d}"

    @property
    def level(self) -> int:
        size, level = self.last - self.first + 1, 0
        while size >= FAN:
            size, level = size // FAN, level + 1
        return level

    def covers(self, other: Segment) -> bool:
        return self.first <= other.first and other.last <= self.last


def widest(segments: list[Segment]) -> list[Segment]:
    """Those that no other one covers, in order."""
    return sorted(s for s in segments if not any(o != s and o.covers(s) for o in segments))


def due(segments: list[Segment]) -> list[Segment]:
    """The first FAN neighbours of one level, which can be merged; none where there aren't as many."""
    run: list[Segment] = []
    for own in widest(segments):
        run = [*run, own] if run and run[-1].level == own.level and run[-1].last + 1 == own.first else [own]
        if len(run) == FAN:
            return run
    return []


@dataclass(frozen=True)
class Segments:
    """The totals in ``folder``. ``total`` makes them from the rows of a batch, and ``merge`` adds
    totals up to totals of the same columns."""

    spark: SparkSession
    folder: str
    total: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]

    @property
    def checkpoint(self) -> str:
        return f"{self.folder}/_checkpoint"

    def complete(self) -> list[Segment]:
        """All whose job came to its end."""
        found = []
        for name in storage.names_in(self.spark, self.folder):
            parts = NAME.fullmatch(name)
            if parts and storage.exists(self.spark, f"{self.folder}/{name}/_SUCCESS"):
                found.append(Segment(int(parts[1]), int(parts[2])))
        return found

    def exists(self) -> bool:
        return bool(self.complete())

    def read(self) -> DataFrame:
        """The totals of every batch, each once."""
        paths = [f"{self.folder}/{s.name}" for s in widest(self.complete())]
        if not paths:
            raise ValueError(f"no totals in {self.folder}")
        return self.spark.read.parquet(*paths)

    def write(self, totals: DataFrame, segment: Segment) -> None:
        totals.write.mode("overwrite").parquet(f"{self.folder}/{segment.name}")

    def drain(self, stream: DataFrame) -> None:
        """Add what ``stream`` has to offer and has not been taken before, then merge."""

        def add(batch: DataFrame, number: int) -> None:
            self.write(self.total(batch), Segment(number, number))

        query = (
            stream.writeStream.foreachBatch(add)
            .option("checkpointLocation", self.checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        self.compact()

    def compact(self) -> None:
        """Merge while a level is full. What was merged goes at the next call, so that readers who
        began before can end."""
        complete = self.complete()
        kept = widest(complete)
        for old in complete:
            if old not in kept:
                storage.remove(self.spark, f"{self.folder}/{old.name}")
        while run := due(kept):
            merged = Segment(run[0].first, run[-1].last)
            rows = self.spark.read.parquet(*(f"{self.folder}/{s.name}" for s in run))
            self.write(self.merge(rows), merged)
            kept = widest([*kept, merged])

    def drop(self) -> None:
        storage.remove(self.spark, self.folder)
