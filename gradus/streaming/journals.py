"""Streams over journals: ingestion, counts kept up to date, and an exact sliding-window limit."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.governance import merge_counts, with_defaults
from ..sources.tables import VersionedTable


def ingest(spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str) -> None:
    """All line-JSON files that arrived, appended once to a Parquet table."""
    rows = spark.readStream.schema(schema).json(source)
    rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target).awaitTermination()


def running_counts(spark: SparkSession, source: str, schema: T.StructType, keys: dict[str, str], table: VersionedTable, checkpoint: str, flat=None, keep: int = 2, grace: float = 3600) -> None:
    """Counts by keys (name -> default of a record that lacks it), kept up to date in a versioned table: each batch's counts are merged
    under its number, so one that is replayed after a failure counts once. No state is held between batches.

    flat: DataFrame -> DataFrame with the key columns, for nested records. The last versions stay for readers."""

    def merge(batch: DataFrame, number: int) -> None:
        rows = with_defaults(flat(batch) if flat else batch, keys)
        merge_counts(table, rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), list(keys), checkpoint, number)
        table.vacuum(keep, grace)

    rows = spark.readStream.schema(schema).json(source)
    rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def attempts(df: DataFrame, identity: str, ts: str, seconds: int) -> DataFrame:
    """Attempts of the identity in the trailing window, this one included."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    by = Window.partitionBy(identity).orderBy(micros).rangeBetween(-seconds * 1_000_000, 0)
    return df.withColumn("attempts", F.count(F.lit(1)).over(by))


def _accept(times: list[int], accepted: list[int], most: int, window: int) -> list[bool]:
    """accepted: the times accepted so far, changed in place. One exactly a window old still counts."""
    out = []
    for t in times:
        while accepted and accepted[0] < t - window:
            accepted.pop(0)
        out.append(len(accepted) < most)
        if out[-1]:
            accepted.append(t)
    return out


def limited(df: DataFrame, identity: str, key: str, ts: str, most: int, seconds: int) -> DataFrame:
    """key, accepted: at most `most` accepted in any trailing window; refused attempts don't count.

    An identity's attempts stream past in order of time; only its times accepted in the window are held, however many attempts it has."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, accepted = None, []
        for rows in frames:
            out = []
            for who, part in rows.groupby("identity", sort=False, dropna=False):
                if who != current:
                    current, accepted = who, []
                out += _accept(part["t"].tolist(), accepted, most, seconds * 1_000_000)
            yield pd.DataFrame({key: rows["key"], "accepted": out})

    rows = df.select(F.col(identity).cast("string").alias("identity"), F.col(key).alias("key"), F.unix_micros(F.col(ts).cast("timestamp")).alias("t")).where("identity is not null and t is not null")
    ordered = rows.repartition("identity").sortWithinPartitions("identity", "t", "key")
    return ordered.mapInPandas(run, T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("accepted", T.BooleanType())]))


class Limiter(StatefulProcessor):
    """The same for a stream: state holds the times accepted in the window, at most `most` of them an identity."""

    def __init__(self, most: int, seconds: int):
        self.most, self.window = most, seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.times = handle.getValueState("times", "times array<bigint>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        got = pd.concat(list(rows)).sort_values(["t", "id"], kind="stable")
        accepted = [int(t) for t in self.times.get()[0]] if self.times.exists() else []
        got["accepted"] = _accept(got["t"].tolist(), accepted, self.most, self.window)
        self.times.update((accepted,))
        yield got[["id", "accepted"]]

    def close(self) -> None:
        pass


def limited_stream(rows: DataFrame, most: int, seconds: int) -> DataFrame:
    """rows (identity, id long, t: microseconds) as a stream -> id, accepted. Needs a state store with column families (RocksDB)."""
    return rows.groupBy("identity").transformWithStateInPandas(Limiter(most, seconds), "id long, accepted boolean", "append", "none")


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def limit_journal(spark: SparkSession, source: str, schema: T.StructType, identity: str, key: str, ts: str, most: int, seconds: int, target: str, checkpoint: str, files: int | None = None) -> None:
    """All attempts of line-JSON files that arrived, decided once and appended to a Parquet table (key, accepted).

    Batches are decided as they arrive, the attempts of a batch in order of time; accepted times stay in state, so a later run with the
    same checkpoint goes on where this one ended. files: at most so many a batch, which bounds what an identity has in a task."""
    stream = spark.readStream.schema(schema)
    rows = (stream.option("maxFilesPerTrigger", files) if files else stream).json(source)
    rows = rows.select(F.col(identity).cast("string").alias("identity"), F.col(key).cast("long").alias("id"), F.unix_micros(F.col(ts).cast("timestamp")).alias("t"))
    decided = limited_stream(rows.where("identity is not null and t is not null"), most, seconds).withColumnRenamed("id", key)
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    spark.conf.set(setting, ROCKS)
    try:
        decided.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target).awaitTermination()
    finally:
        spark.conf.set(setting, before)
