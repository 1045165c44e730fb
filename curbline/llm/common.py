"""What the operators on documents share: batch maps, words, folds, stored intermediates."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline import storage
from curbline.session import fresh_path

# The engine's definition of a word: a run of anything but a space, tab, LF, VT, FF or CR.
WORD = r"[^\x20\x09-\x0D]+"
# Rows of documents that go to Python at a time; long texts make a batch large.
BATCH_ROWS = "500"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of ``sf_dir``. Sets the size of the batches that go to Python."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_words(text: str | None) -> list[bytes]:
    """The words of a text in order, A-Z in lower case. None has none.

    Bytes are split at, and lowered in, exactly the ASCII characters that the definition names.
    """
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def words(text: str | None) -> list[str]:
    """The words of a text as they are, in order."""
    if not text:
        return []
    return [w.decode("utf-8", "surrogatepass") for w in text.encode("utf-8", "surrogatepass").split()]


def fold(folds: int, key: str = "doc_id") -> Column:
    """CRC-32 of the key as text, modulo ``folds``."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds


def map_arrow(
    rows: DataFrame,
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    return rows.mapInArrow(function, schema)


def larger(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``rows`` or a little more; the last may be smaller."""
    held: list[pa.RecordBatch] = []
    for one in batches:
        held.append(one)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def batch(**columns) -> pa.RecordBatch:
    """A record batch of the columns in the given order."""
    return pa.RecordBatch.from_pydict(columns)


def whole_rows(docs: DataFrame) -> DataFrame:
    """Each row as one struct ``row``, which no other column's name can clash with."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))


# Paths stored in each block of ``intermediates`` that is open, the innermost last.
_blocks: ContextVar[tuple[list[str], ...]] = ContextVar("blocks", default=())


def stored(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written to the shared folder and read back: computed once, and there is
    nothing to recompute when an executor is lost."""
    return _stored(rows, name, _blocks.get()[-1:])


def outcome(rows: DataFrame, name: str) -> DataFrame:
    """``stored``, of what a block of ``intermediates`` leaves behind. It goes with the block around
    that one, if there is one."""
    return _stored(rows, name, _blocks.get()[-2:-1])


def _stored(rows: DataFrame, name: str, block: tuple[list[str], ...]) -> DataFrame:
    path = fresh_path(rows.sparkSession, f"llm-{name}")
    rows.write.parquet(path)
    for paths in block:
        paths.append(path)
    found = rows.sparkSession.read.schema(rows.schema).parquet(path)
    found.stored_at = path
    return found


def discard(rows: DataFrame) -> None:
    """Remove what ``stored`` has written, when nothing will read it again."""
    storage.remove(rows.sparkSession, rows.stored_at)


def free_shuffles(spark: SparkSession) -> None:
    """Let go of what nothing refers to any more. Spark then removes the shuffle files of finished steps
    now, and not when a driver with much memory happens to need some."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """A block after which all that was stored in it is removed. What comes out of it must be an
    ``outcome``, which has been computed when the block ends."""
    paths: list[str] = []
    token = _blocks.set((*_blocks.get(), paths))
    try:
        yield
    finally:
        _blocks.reset(token)
        for path in paths:
            storage.remove(spark, path)
