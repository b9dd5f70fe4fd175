"""Operator 4: near-duplicate documents by one-permutation hashing, optimal densification and star-shaped candidates.

A document's set holds the hashes of its distinct five-word shingles (64 bits; A-Z lower-cased; fewer words: the whole
sequence; none: empty, linked with nothing). Documents with equal sets become one class at once. A class's sketch is
one-permutation hashing, REPEATS times with BINS bins: each bin keeps its smallest hash, an empty bin takes the value
of the bin that its own probe sequence reaches first. Every ROWS bins make a band's key; classes with a key in common
are candidates. At a similarity of 0.75 all 40 keys differ with probability (1 - 0.75^5)^40 = 2e-5.

Candidates are checked on whole texts, in stars: first each class with the centre it shares the most keys with; then, in
buckets whose members still lie in different components, with the bucket's first CENTRES members, and then with all, until every pair
of a bucket that could join two components was checked or, by an exact bound from the parities of hash counts, found too
different. Pairs that are already connected are not checked, so a group of g copies costs about g checks, and no link that
matters is lost. A bucket of more than COMPLETE members (texts that share a passage but little else) is first dealt
anew by its members' rarest shingles: two sets as similar as `percent` share one of the n - ceil(percent n) + 1 shingles
that are rarest among all such members, so common passages bring no pairs, and no link is lost.

Rows without doc_id are left out. Null texts are empty. Rows that share a doc_id but not their text are documents of their own;
component_id is then the doc_id of the component's first one. Other columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .shared import numbered, stored
from .spans import LOWER, U, mix, prefix_sums, ragged, span_hash, text_blocks, words

WORDS, REPEATS, BINS, ROWS, PARITY, CENTRES, COMPLETE = 5, 8, 25, 5, 1024, 64, 4096
_PROBES = np.random.default_rng(7).integers(0, BINS, (BINS, 4096))
_WEIGHTS = np.random.default_rng(8).integers(0, 1 << 63, WORDS, dtype=np.uint64) * U(2) + U(1)
_SALTS = np.random.default_rng(9).integers(0, 1 << 63, REPEATS, dtype=np.uint64) * U(2) + U(1)


def shingle_sets(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted within each text, and each text's count."""
    start, end, text = words(buf, offsets)
    token = span_hash(prefix_sums(LOWER[buf]), start, end)
    n = np.bincount(text, minlength=len(offsets) - 1)
    first = np.cumsum(n) - n
    full = np.maximum(0, n - WORDS + 1)
    at = ragged(first, full)
    value = np.zeros(len(at), U)
    for i in range(WORDS):
        value += token[at + i] * _WEIGHTS[i]
    short = np.flatnonzero((n > 0) & (n < WORDS))
    if len(short):
        few = np.full(len(short), U(77))
        for i in range(WORDS - 1):
            has = n[short] > i
            few[has] = mix(few[has] * _WEIGHTS[i] + token[first[short[has]] + i])
        value = np.concatenate([value, few])
    owner = np.concatenate([np.repeat(np.arange(len(n)), full), short])
    value = mix(value)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[new], np.bincount(owner[new], minlength=len(n))


def band_keys(value: np.ndarray, count: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A row of keys for each text with a shingle; one-permutation hashing with optimal densification."""
    some = np.flatnonzero(count)
    owner = np.repeat(np.arange(len(some)), count[some])
    keys = []
    empty = U(0xFFFFFFFFFFFFFFFF)
    for r in range(REPEATS):
        h = mix(value * _SALTS[r])
        cell = np.full(len(some) * BINS, empty)
        np.minimum.at(cell, owner * BINS + (h >> U(40)).astype(np.int64) % BINS, h)
        cell = cell.reshape(-1, BINS)
        full = cell.copy()
        row, col = np.nonzero(cell == empty)
        for probe in range(_PROBES.shape[1]):
            if not len(row):
                break
            got = cell[row, _PROBES[col, probe]]
            done = got != empty
            full[row[done], col[done]] = got[done]
            row, col = row[~done], col[~done]
        for b in range(0, BINS, rows):
            key = np.full(len(some), U(1000 * r + b + 1))
            for i in range(rows):
                key = mix(key * U(0x9E3779B97F4A7C15) + full[:, b + i])
            keys.append(key)
    return np.stack(keys, 1) if len(some) else np.zeros((0, REPEATS * BINS // rows), U)


def parities(value: np.ndarray, count: np.ndarray) -> pa.Array:
    """For each set, whether an odd number of its hashes falls into each of PARITY cells; 64 cells a long.

    Sets whose parities differ in d cells differ in d hashes or more, an exact bound that costs no look at the sets.
    """
    owner = np.repeat(np.arange(len(count)), count)
    odd = np.bincount(owner * PARITY + (value & U(PARITY - 1)).astype(np.int64), minlength=len(count) * PARITY) & 1
    bits = np.packbits(odd.astype(bool).reshape(-1, PARITY), axis=1, bitorder="little").view(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(count) + 1, dtype=np.int32) * (PARITY // 64)), pa.array(bits.ravel()))


def _sketches(per_key: int):
    def run(batches):
        for rows, buf, offsets in text_blocks(batches, "doc_id", "text"):
            value, count = shingle_sets(buf, offsets)
            ends = np.cumsum(count)
            total = np.append(U(0), np.cumsum(value))
            other = np.append(U(0), np.cumsum(mix(value ^ U(0x5851F42D4C957F2D))))
            keys = band_keys(value, count, per_key).view(np.int64)
            lengths = np.where(count > 0, keys.shape[1], 0)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)).astype(np.int32)), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), parities(value, count), pa.array(count.astype(np.int64)), pa.array((total[ends] - total[ends - count]).view(np.int64)), pa.array((other[ends] - other[ends - count]).view(np.int64)), lists], names=["doc_id", "parity", "n", "sig", "sig2", "keys"]
            )

    return run


def _checked(percent: int):
    """Rows (a, b, x, y, text_a, text_b) -> those whose sets are similar enough, without the texts."""

    def sets(batch, name):
        _, buf, offsets = next(text_blocks([batch], "a", name, 1 << 62))
        value, count = shingle_sets(buf, offsets)
        return np.split(value, np.cumsum(count)[:-1])

    def run(batches):
        for big in batches:
            for i in range(0, big.num_rows, 256):
                batch = big.slice(i, 256)
                good = []
                for x, y in zip(sets(batch, "text_a"), sets(batch, "text_b"), strict=True):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    good.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
                yield batch.select(["a", "b", "x", "y"]).filter(pa.array(good, pa.bool_()))

    return run


def roots(parents: DataFrame) -> DataFrame:
    """parents (node, label), label < node, one row a node -> the same with each node's last ancestor, by pointer jumping."""
    while True:
        up = parents.select(F.col("node").alias("label"), F.col("label").alias("above"))
        jumped = stored(parents.join(up, "label", "left").select("node", F.coalesce("above", "label").alias("label"), F.col("above").isNotNull().alias("moved")), "parents")
        parents = jumped.drop("moved")
        if jumped.where("moved").isEmpty():
            return parents


def merged(labels: DataFrame, joined: DataFrame) -> DataFrame:
    """labels (node, label; a node without a row is its own label) after joined (node, label) united some labels."""
    to = joined.select(F.col("node").alias("label"), F.col("label").alias("root"))
    moved = labels.join(to, "label", "left").select("node", F.coalesce("root", "label").alias("label"))
    return stored(moved.unionByName(joined.join(labels, "node", "left_anti")), "labels")


def _sets(batches):
    """Rows (id, text) -> (id, n, shingles)."""
    for rows, buf, offsets in text_blocks(batches, "id", "text"):
        value, count = shingle_sets(buf, offsets)
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(count)).astype(np.int32)), pa.array(value.view(np.int64)))
        yield pa.RecordBatch.from_arrays([rows.column("id"), pa.array(count.astype(np.int64)), lists], names=["id", "n", "shingles"])


def rare_shingles(texts: DataFrame, percent: int) -> DataFrame:
    """texts (id, text) -> key, id, n: each text under its rarest shingles, as many as two similar texts must have one in common of."""
    single = stored(texts.mapInArrow(_sets, "id long, n long, shingles array<long>").select("id", "n", F.explode("shingles").alias("key")), "shingles")
    common = stored(single.groupBy("key").agg(F.count(F.lit(1)).alias("uses")).where("uses > 1"), "common")
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.coalesce("uses", F.lit(1)), "key"))
    rarest = single.join(common, "key", "left").withColumn("rank", rank).where(f"rank <= n - (n * {percent} + 99) div 100 + 1")
    return rarest.where("uses is not null").select("key", "id", "n")


def near_duplicates(docs: DataFrame, percent: int = 75, per_key: int = ROWS, centres: int = CENTRES, complete: int = COMPLETE) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, one row per row of docs with a doc_id. per_key: bins in a band's key, a divisor of BINS; fewer make more candidates."""
    docs = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    docs, names = numbered(docs)
    rows = stored(docs.mapInArrow(_sketches(per_key), "doc_id long, parity array<long>, n long, sig long, sig2 long, keys array<long>"), "sketches")
    classes = stored(rows.where("n > 0").groupBy("n", "sig", "sig2").agg(F.min("doc_id").alias("rep")), "heads")  # so that the join may split a large class
    member = stored(rows.join(classes, ["n", "sig", "sig2"], "left").select("doc_id", "n", F.coalesce("rep", "doc_id").alias("rep"), *[F.when(F.col("doc_id") == F.col("rep"), F.col(c)).alias(c) for c in ("keys", "parity")]), "classes")

    dealt = member.where("keys is not null").select(F.col("rep").alias("id"), "n", F.explode("keys").alias("key")).distinct().repartition("key")
    shared = dealt.groupBy("key").agg(F.min("id").alias("centre"), F.max("id").alias("last")).where("centre < last").drop("last")
    bucket = stored(dealt.join(shared, "key"), "buckets")
    texts = stored(docs.join(bucket.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id"]), "texts")

    def check(pairs: DataFrame) -> DataFrame:
        a, b = (texts.select(F.col("doc_id").alias(x), F.col("text").alias(f"text_{x}")) for x in "ab")
        return pairs.join(a, "a").join(b, "b").select("a", "b", "x", "y", "text_a", "text_b").mapInArrow(_checked(percent), "a long, b long, x long, y long")

    fits = f"100 * least(n, m) >= {percent} * greatest(n, m)"
    sizes = member.where("keys is not null").select(F.col("rep").alias("centre"), F.col("n").alias("m")).distinct()
    stars = bucket.where("id > centre").groupBy("id", "n", "centre").count().join(sizes, "centre").where(fits)
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("count"), "centre"))
    done = stored(stars.select(F.col("id").alias("a"), F.col("centre").alias("b"), rank.alias("rank")).where("rank = 1").drop("rank"), "stars")
    labels = roots(stored(check(done.withColumn("x", F.col("a")).withColumn("y", F.col("b"))), "links").select(F.col("a").alias("node"), F.col("b").alias("label")))
    parity = member.where("keys is not null").select(F.col("rep").alias("id"), "parity").dropDuplicates(["id"])
    differ = " + ".join(f"bit_count(parity[{i}] ^ other[{i}])" for i in range(PARITY // 64))
    close = f"{100 + percent} * ({differ}) <= {100 - percent} * (n + m)"  # fewer differences than a similarity of percent allows

    def mixed(rows: DataFrame, least: int) -> DataFrame:
        """Rows (key, id, n) of buckets of more than `least` members in several components, with label and the bucket's members."""
        named = rows.select("key", "id", "n").join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("label", F.coalesce("label", "id"))
        keys = named.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count(F.lit(1)).alias("members")).where(f"x <> y and members > {least}")
        return stored(named.join(stored(keys.select("key", "members"), "mixed"), "key"), "open")

    def join_components(rows: DataFrame, low: int, high: int | None) -> None:
        """Check the members of buckets against the bucket's members number low + 1 to high (to the last) where that could join components."""
        nonlocal done, labels
        if rows.isEmpty():
            return
        rows = rows.join(parity, "id")
        heads = rows.withColumn("rn", F.row_number().over(Window.partitionBy("key").orderBy("id"))).where(f"rn > {low}")
        heads = (heads.where(f"rn <= {high}") if high else heads).select("key", F.col("id").alias("b"), F.col("n").alias("m"), F.col("label").alias("y"), F.col("parity").alias("other"))
        heads = stored(heads, "centres")  # so that the join may split a large bucket
        pairs = rows.join(heads, "key").where(f"id > b and label <> y and {fits} and {close}").select(F.col("id").alias("a"), "b", F.col("label").alias("x"), "y").distinct()
        pairs = stored(pairs.join(done, ["a", "b"], "left_anti"), "pairs")
        done = done.unionByName(pairs.select("a", "b"))
        links = stored(check(pairs), "links")
        if not links.isEmpty():
            labels = merged(labels, components(links.select(F.col("x").alias("a"), F.col("y").alias("b"))))

    join_components(mixed(bucket, 1), 0, centres)
    left = mixed(bucket, centres + 1)
    join_components(left.where(f"members <= {complete}"), centres, complete)
    large = left.where(f"members > {complete}")
    if not large.isEmpty():
        again = texts.withColumnRenamed("doc_id", "id").join(large.select("id").distinct(), "id", "left_semi")
        rare = stored(rare_shingles(again, percent), "rare")
        join_components(mixed(rare, 1), 0, centres)
        join_components(mixed(rare, centres + 1), centres, None)
    out = member.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("label", "rep").alias("component_id"))
    if names is not None:
        for c in ("doc_id", "component_id"):
            out = out.join(names.select(F.col("row").alias(c), F.col("doc_id").alias("named")), c).withColumn(c, F.col("named")).drop("named")
    return out.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
