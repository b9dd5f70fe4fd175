"""Readers and writers: delimited yearly files, Parquet with pruning, line-JSON journals, manifests, snapshots, versioned tables."""

import json
import re
import tempfile
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_own: dict[str, str] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share: under spark.checkpoint.dir. Unset, it is a temporary one with a local master
    (one machine, as in tests) and an error on a cluster, whose executors would not see it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        key = spark.sparkContext.applicationId
        if key not in _own:
            _own[key] = "file://" + tempfile.mkdtemp(prefix="spark-gradus-")
        base = _own[key]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def read_delimited(spark: SparkSession, path, sep: str = ";", required: Sequence[str] = (), nulls: str = "") -> DataFrame:
    """Every column as text, nothing inferred; a byte-order mark is dropped. A required column that is missing is an error."""
    out = spark.read.option("sep", sep).option("nullValue", nulls).option("encoding", "UTF-8").csv(path, header=True, inferSchema=False)
    if missing := [c for c in required if c not in out.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return out


def read_columns(spark: SparkSession, path, columns: Sequence[str], where=None) -> DataFrame:
    """Parquet with only the named columns; the condition reaches the scan."""
    out = spark.read.parquet(path)
    return (out.where(where) if where is not None else out).select(*columns)


def file_profile(spark: SparkSession, path) -> DataFrame:
    """Column names and the row count, from schema and footers alone."""
    rows = spark.read.parquet(path)
    names = F.array(*[F.lit(c) for c in rows.columns])
    return rows.agg(F.count(F.lit(1)).alias("n_rows")).select(F.posexplode(names).alias("position", "column"), "n_rows")


def read_journal(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """Append-only line-JSON; blank lines are skipped, a missing path is an empty journal."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], schema)
    lines = spark.read.text(path).where("trim(value) <> ''")
    return lines.select(F.from_json("value", schema).alias("r")).select("r.*")


def read_manifest(spark: SparkSession, path, entry: T.StructType) -> DataFrame:
    """A JSON map id -> entry as rows; absent or corrupt: no rows."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], T.StructType([T.StructField("id", T.StringType()), *entry.fields]))
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", T.MapType(T.StringType(), entry)).alias("m"))
    return whole.where("m is not null").select(F.explode("m").alias("id", "e")).select("id", "e.*")


def latest_snapshot(rows: DataFrame, name: str, pattern: str = r"(\d{4}-\d{2}-\d{2})") -> DataFrame:
    """Rows of the file whose name holds the latest date."""
    dated = rows.withColumn("_date", F.nullif(F.regexp_extract(name, pattern, 1), F.lit("")))
    last = dated.agg(F.max("_date").alias("_last"))
    return dated.join(F.broadcast(last), F.col("_date") == F.col("_last")).drop("_date", "_last")  # one row


def write_version(df: DataFrame, path: str, partition_by: Sequence[str] = (), form: str = "parquet", **options) -> str:
    """Write a new folder beside earlier ones, by executors. Returns its path; VersionedTable also keeps which one is current."""
    target = f"{path}/version-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).options(**options).format(form).save(target)
    return target


class Conflict(RuntimeError):
    """Another writer committed since the state that a write was based on."""


class VersionedTable:
    """A table that is rewritten while it is read, and can be computed from itself.

    Executors write a version to a folder of its own. Then one small file, its commit, gets its place by a rename, which the file system
    does as a whole: _commits/<number>.json names the folder and the schema, and holds notes of the writer. Readers take the
    commit with the largest number, so a version without a commit (a job that broke off before the swap) is never seen, and the one before stays
    current. Of two writers that began from the same state, one gets the number and the other a Conflict.
    The file system must rename files atomically and refuse to replace one (HDFS, local; for object stores, through a committer that does)."""

    def __init__(self, spark: SparkSession, path: str, form: str = "parquet", **options):
        self.spark, self.path, self.form, self.options = spark, path.rstrip("/"), form, options
        self._hadoop = spark._jvm.org.apache.hadoop.fs

    def _at(self, *parts: str):
        return self._hadoop.Path("/".join([self.path, *parts]))

    def _fs(self):
        return self._at().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _listed(self, *parts: str) -> list:
        fs, at = self._fs(), self._at(*parts)
        return list(fs.listStatus(at)) if fs.exists(at) else []

    def _text(self, at) -> str:
        stream = self._fs().open(at)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def commits(self) -> list[int]:
        """Numbers of the commits, ascending."""
        return sorted(int(m[1]) for x in self._listed("_commits") if (m := re.fullmatch(r"(\d+)\.json", x.getPath().getName())))

    def state(self, number: int | None = None) -> dict | None:
        """number, folder, schema and notes of a commit, the current one if not told; None before the first."""
        number = number or max(self.commits(), default=0)
        return {"number": number, **json.loads(self._text(self._at("_commits", f"{number:020d}.json")))} if number else None

    def read(self, schema: T.StructType | None = None, number: int | None = None) -> DataFrame:
        """The current version, or that of a commit. Before the first: no rows of the schema given, or an error."""
        state = self.state(number)
        if state is None:
            if schema is None:
                raise FileNotFoundError(f"{self.path} has no version yet")
            return self.spark.createDataFrame([], schema)
        own = T.StructType.fromJson(state["schema"])
        return self.spark.read.format(self.form).options(**self.options).schema(own).load(f"{self.path}/{state['folder']}").select(*own.names)

    def write(self, df: DataFrame, partition_by: Sequence[str] = (), notes: dict | None = None, base: int | None = None) -> int:
        """Write df as the next version and make it current; df may read this table. base: the commit it was computed from, if not
        the one that is current now. Returns the number."""
        number = (max(self.commits(), default=0) if base is None else base) + 1
        if number <= max(self.commits(), default=0):
            raise Conflict(f"{self.path} has a commit {number} already")
        folder = f"version-{uuid.uuid4().hex}"
        df.write.partitionBy(*partition_by).options(**self.options).format(self.form).save(f"{self.path}/{folder}")
        self._swap(number, {"folder": folder, "schema": json.loads(df.schema.json()), "notes": notes or {}})
        return number

    def _swap(self, number: int, commit: dict) -> None:
        made = self._at("_commits", f".{uuid.uuid4().hex}")
        out = self._fs().create(made, False)
        out.write(json.dumps(commit).encode())
        out.close()
        context = self._hadoop.FileContext.getFileContext(made.toUri(), self.spark._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(getattr(self._hadoop, "Options$Rename"), 0)
        try:
            context.rename(made, self._at("_commits", f"{number:020d}.json"), none)
        except Exception as e:
            self._fs().delete(made, False)
            if "FileAlreadyExists" in str(e):
                raise Conflict(f"{self.path} has a commit {number} already") from e
            raise

    def vacuum(self, keep: int = 1, grace: float = 86_400) -> list[str]:
        """Delete all but the last commits, and the folders that none of those names and that are older than grace, in seconds: a
        younger one may be about to be committed. Returns the folders' names."""
        commits = self.commits()
        for number in commits[:-keep]:
            self._fs().delete(self._at("_commits", f"{number:020d}.json"), False)
        named = {self.state(n)["folder"] for n in commits[-keep:]}
        old = [x.getPath().getName() for x in self._listed() if x.isDirectory() and x.getModificationTime() / 1000 <= time.time() - grace]
        gone = [x for x in old if x.startswith("version-") and x not in named]
        for name in gone:
            self._fs().delete(self._at(name), True)
        return gone


def write_csv(df: DataFrame, path: str, sep: str = ";", partition_by: Sequence[str] = ()) -> str:
    return write_version(df, path, partition_by, form="csv", sep=sep, header="true")


def allowed_columns(df: DataFrame, allow: Sequence[str], deny: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """The columns on the allow-list and not on the deny-list, and the names left out."""
    kept = [c for c in df.columns if c in allow and c not in deny]
    return df.select(*kept), [c for c in df.columns if c not in kept]


def prediction_catalogue(df: DataFrame, keys: dict[str, str], columns: Sequence[str], prediction: str) -> DataFrame:
    """Keys with their types, chosen columns, and the prediction as a double: what is exported."""
    return df.select(*[F.col(k).cast(t) for k, t in keys.items()], *columns, F.col(prediction).cast("double").alias("taux_predit"))
