"""Journals: retention, subject access, erasure, attribution. Nothing overwrites what it reads: results go to a new version, which
readers see once it is whole (sources.tables.VersionedTable)."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import retention_tier
from ..sources.tables import VersionedTable
from .matching import any_identifier


def tiered(journal: DataFrame, ts: str, as_of: str, pseudonymise_days: int = 365, aggregate_days: int = 1095, done: str | None = None) -> DataFrame:
    return journal.withColumn("palier", retention_tier(ts, as_of, pseudonymise_days, aggregate_days, done))


def retained(journal: DataFrame, identifier: str, done: str) -> DataFrame:
    """Tiered rows that stay; those due get a random token and the flag. Write the result once and read it back: tokens are random."""
    due = F.col("palier") == "pseudonymiser"
    token = F.when(due, F.uuid()).otherwise(F.col(identifier).cast("string"))
    rows = journal.where("palier <> 'agreger'").withColumn(identifier, token)
    return rows.withColumn(done, due | F.coalesce(F.col(done), F.lit(False))).drop("palier")


def with_defaults(df: DataFrame, defaults: dict[str, str]) -> DataFrame:
    """The key columns as text, what lacks under its default name: a record without a key is counted, too."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(name)) for c, name in defaults.items()})


def merge_counts(table: VersionedTable, new: DataFrame, keys: Sequence[str], source: str, batch: int) -> bool:
    """Add new (keys, n) to the table's counts, once for each batch of a source: batches come in rising order, and the commit that holds
    a batch's counts also notes it, so a batch that is replayed changes nothing. True if it was added.

    The table holds a row a key, so every version is compact; the one before stays for readers until vacuum()."""
    state = table.state()
    applied = state["notes"].get("applied", {}) if state else {}
    if batch <= applied.get(source, -1):
        return False
    rows = new.select(*keys, F.col("n").cast("long").alias("n"))
    rows = rows if state is None else rows.unionByName(table.read().select(*keys, "n"))
    table.write(rows.groupBy(*keys).agg(F.sum("n").alias("n")), notes={"applied": applied | {source: batch}}, base=state["number"] if state else 0)
    return True


def purge(journal: VersionedTable, counts: VersionedTable, ts: str, as_of: str, identifier: str, done: str, keys: dict[str, str], dry_run: bool = True, **days) -> DataFrame:
    """One retention pass; returns its report (palier, n). Only with dry_run=False: records due get a random token, the oldest are added
    to counts by keys (name -> default) and leave the journal.

    Counts are committed first, under the journal's commit as their batch, then the journal: a pass that breaks off between the two is
    repeated without counting twice. A second pass finds nothing to do."""
    state = journal.state()
    rows = tiered(journal.read(number=state["number"]), ts, as_of, done=done, **days)
    if not dry_run:
        old = with_defaults(rows.where("palier = 'agreger'"), keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        merge_counts(counts, old, list(keys), f"purge {journal.path}", state["number"])
        journal.write(retained(rows, identifier, done), base=state["number"])
    return retention_report(rows)


def erase(journal: VersionedTable, fields: Sequence[str], requests: DataFrame, wanted: str, trace: str | None = None, dry_run: bool = True) -> DataFrame:
    """Erasure on request; returns the trace (effaces, avant). Only with dry_run=False: the journal without the records becomes current,
    and the trace, which holds no identifier, is appended as JSON. Versions before keep the records until the journal is vacuumed."""
    state = journal.state()
    left, found = erased(journal.read(number=state["number"]), fields, requests, wanted)
    if not dry_run:
        journal.write(left, base=state["number"])
        if trace:
            found.withColumn("version", F.lit(state["number"] + 1)).withColumn("date", F.current_timestamp()).write.mode("append").json(trace)
    return found


def retention_report(journal: DataFrame) -> DataFrame:
    """What a pass would do (a dry run is this alone)."""
    return journal.groupBy("palier").agg(F.count(F.lit(1)).alias("n"))


def exported(records: DataFrame) -> DataFrame:
    """A subject's records with columns in sorted order and nested values as JSON text."""
    nested = {f.name for f in records.schema.fields if f.dataType.typeName() in ("struct", "array", "map")}
    return records.select(*[F.to_json(c).alias(c) if c in nested else F.col(c).cast("string") for c in sorted(records.columns)])


def erased(records: DataFrame, fields: Sequence[str], requests: DataFrame, wanted: str) -> tuple[DataFrame, DataFrame]:
    """Records none of whose fields holds a requested identifier, and a trace with counts but no identifier."""
    ids = requests.select(F.col(wanted).alias("_id")).distinct()
    left = reduce(lambda df, f: df.join(ids, F.col(f) == F.col("_id"), "left_anti"), fields, records)
    gone = any_identifier(records, fields, requests, wanted).agg(F.count(F.lit(1)).alias("effaces"))
    return left, gone.crossJoin(records.agg(F.count(F.lit(1)).alias("avant")))  # one row each


def attribution(entries: DataFrame, entry: str, date: str, licence: str, sep: str = ":") -> DataFrame:
    """Sources by the prefix of their entries: how many, first and last date, licence."""
    source = F.split_part(F.col(entry), F.lit(sep), F.lit(1)).alias("source")
    return entries.groupBy(source).agg(F.count(F.lit(1)).alias("n"), F.min(date).alias("premiere"), F.max(date).alias("derniere"), F.min(licence).alias("licence"))
