"""Stages written to shared storage and their release, declared contracts, and outputs."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stage_root(spark: SparkSession) -> str:
    """The shared folder stages go to: the session's checkpoint folder.

    That is ``spark.checkpoint.dir`` or what the caller gave to
    ``setCheckpointDir``. The library chooses none: a session without one is an
    error, whatever its master.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{folder.rstrip('/')}/tallyward"


class Stages:
    """A handle on the stages written while it is open; releasing it deletes their files.

    Stages written where no handle is open are nobody's and stay. What reads a
    released stage later fails, so release a handle when all that is wanted of its
    stages has been written elsewhere. Handles may be opened within one another:
    a stage belongs to the innermost.
    """

    _open: ContextVar[Stages | None] = ContextVar("open_stages", default=None)

    def __init__(self) -> None:
        self._held: list[tuple[SparkSession, str]] = []

    @contextmanager
    def open(self) -> Iterator[Stages]:
        before = Stages._open.set(self)
        try:
            yield self
        finally:
            Stages._open.reset(before)

    @property
    def paths(self) -> list[str]:
        return [path for _, path in self._held]

    def hand_over(self) -> None:
        """Leave the stages to the handle that is open around, if any."""
        outer = Stages._open.get()
        if outer is not None:
            outer._held += self._held
        self._held = []

    def release(self) -> None:
        while self._held:
            delete_path(*self._held.pop())


def stage(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write a result used several times and read it back.

    Cuts the lineage on storage that outlives executors. Since the written size
    is known, Spark broadcasts a stage exactly when it is small. ``folder``
    overrides the session's. The open :class:`Stages`, if any, holds the files; a
    stage whose writing failed is held too.
    """
    root = folder.rstrip("/") if folder else stage_root(df.sparkSession)
    path = f"{root}/{name}-{uuid.uuid4().hex}"
    holder = Stages._open.get()
    if holder is not None:
        holder._held.append((df.sparkSession, path))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def counted_stage(
    df: DataFrame, name: str, person: str, keys: Sequence[str] = (), folder: str | None = None, *, persons: bool = False,
) -> tuple[DataFrame, dict[str, int]]:
    """A stage and what was counted while it was written, without a scan of its own.

    ``rows``; ``null_<key>`` for the person and each of ``keys``; with ``persons``
    also the distinct persons, for which the rows are dealt by person and sorted
    before they are written (the first row of each is counted). Rows without a
    person are spread by their hash then, and count as no person; those of a very
    hot person meet in one task, so leave ``persons`` out where there may be one.
    """
    columns = dict.fromkeys([person, *keys])
    measures = [F.count(F.lit(1)).alias("rows"), *(F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns)]
    if persons:
        known = F.col(person).isNotNull()
        spread = F.when(known, F.xxhash64(person)).otherwise(F.xxhash64(*df.columns))
        place = F.row_number().over(Window.partitionBy("_spread", person).orderBy(person))
        df = df.withColumn("_spread", spread).withColumn("_first", known & (place == 1)).drop("_spread")
        measures.append(F.count_if("_first").alias("persons"))
    seen = Observation()
    staged = stage(df.observe(seen, *measures).drop("_first"), name, folder)
    return staged, dict(seen.get)


def finished(build: Callable[[], DataFrame], name: str, folder: str | None = None) -> DataFrame:
    """The result of ``build`` as a stage; the stages that ``build`` wrote are released, also if it fails."""
    inner = Stages()
    try:
        with inner.open():
            df = build()
        return stage(df, name, folder)
    finally:
        inner.release()


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder or file of any storage that Spark reaches; a missing one is no error."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Bind columns by position to a declared contract.

    Casts each column and fails on a text longer than declared instead of
    cutting it.
    """
    if len(df.columns) != len(contract):
        raise ValueError(f"expected {len(contract)} columns, got {len(df.columns)}")
    return df.select(*(
        _bound(F.col(old), field) for old, field in zip(df.columns, contract, strict=True)
    ))


def _bound(c: Column, field: T.StructField) -> Column:
    limit = getattr(field.dataType, "length", None)
    if limit is None:
        return c.cast(field.dataType).alias(field.name)
    text = c.cast("string")
    too_long = F.raise_error(F.concat(F.lit(f"{field.name} longer than {limit}: "), text))
    return F.when(F.char_length(text) > limit, too_long).otherwise(text).alias(field.name)
