"""Where intermediate tables go, and small column helpers."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Unset, it is a temporary one with a local master (one
    machine, as in tests) and an error on a cluster, whose executors would not see it."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    key = spark.sparkContext.applicationId
    if key not in _own:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        _own[key] = "file://" + tempfile.mkdtemp(prefix="spark-gradus-")
    return _own[key]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lost executors then cost one stage, not the whole plan."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """docs (doc_id long, not null; text; others) with doc_id replaced by a number for each different (doc_id, text), in the order
    of doc_id and then of a hash of the text; and the table (row, doc_id) of these numbers.

    Where no doc_id stands for several texts, docs come back as they are, and None."""
    ids = docs.groupBy("doc_id").count().where("count > 1")
    if ids.isEmpty():
        return docs, None
    h, row, id_ = (f"_{x}_{uuid.uuid4().hex[:8]}" for x in ("h", "row", "id"))
    hashed = docs.withColumn(h, F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    if hashed.groupBy("doc_id").agg(F.min(h).alias("a"), F.max(h).alias("b")).where("a <> b").isEmpty():
        return docs, None
    pairs = hashed.select("doc_id", h).distinct().repartitionByRange("doc_id", h).sortWithinPartitions("doc_id", h)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    pairs = stored(pairs.select("doc_id", h, F.spark_partition_id().alias("part"), place.alias("at")), "pairs")
    sizes = pairs.groupBy("part").count()
    before = sizes.select("part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before"))  # a row a partition
    names = stored(pairs.join(F.broadcast(before), "part").select("doc_id", h, (F.col("before") + F.col("at")).alias(row)), "numbers")
    out = hashed.withColumnRenamed("doc_id", id_).join(names.withColumnRenamed("doc_id", f"{id_}b").withColumnRenamed(h, f"{h}b"), (F.col(id_) == F.col(f"{id_}b")) & (F.col(h) == F.col(f"{h}b")))
    return out.select(*[F.col(row).alias("doc_id") if c == "doc_id" else F.col(c) for c in docs.columns]), names.select(F.col(row).alias("row"), "doc_id")


def fold(key, folds: int = 5):
    """crc32 of the key as text, modulo folds; a null key counts as empty text."""
    return F.expr(f"pmod(crc32(cast(coalesce(cast({key} as string), '') as binary)), {folds})")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
