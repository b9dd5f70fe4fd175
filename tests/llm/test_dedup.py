import random
import re

import duckdb

from gradus.llm import exact_dedup, near_dedup
from gradus.llm.components import components


def brute_near(rows):
    sets = {}
    for doc, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[doc] = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()
    label = {d: d for d in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return sorted((d, len(sets[d]), root(d), root(d) == d) for d in sets)


def corpus(seed=3):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Ünï", "Zoë"]
    rows = []
    for _ in range(25):
        base = [r.choice(vocabulary) for _ in range(r.choice([3, 8, 30, 120, 400]))]
        for _ in range(r.randint(1, 8)):
            copy = list(base)
            for _ in range(r.randint(0, max(1, len(base) // 40))):
                copy[r.randrange(len(copy))] = r.choice(vocabulary)
            rows.append((len(rows), r.choice([" ", "  ", "\n"]).join(copy).upper() if r.random() < 0.2 else " ".join(copy)))
            base = copy if r.random() < 0.5 else base
    return rows + [(900, None), (901, ""), (902, " \n"), (903, "a b c d"), (904, "a b c d e"), (905, "A B C D")]


def test_near_duplicates_against_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(tuple(r) for r in near_dedup.near_duplicates(docs).collect()) == brute_near(rows)


def test_every_bucket_pair_is_checked(spark):
    """Candidates that the star centres miss are found in the later rounds."""
    rows = corpus(5)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in near_dedup.near_duplicates(docs, per_key=1).collect()) == brute_near(rows)
    assert sorted(tuple(r) for r in near_dedup.near_duplicates(docs, per_key=1, centres=1, complete=2).collect()) == brute_near(rows)


def test_large_buckets_are_dealt_by_rare_shingles(spark):
    """Texts that share a passage of two thirds, and few of them more."""
    r = random.Random(8)
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join(passage + [f"w{r.randrange(3000)}" for _ in range(30)])) for i in range(60)]
    rows += [(100 + i, rows[i][1].replace("p7 ", "q ")) for i in range(0, 60, 7)] + [(300, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute_near(rows)
    assert sum(not k for *_, k in expected) >= 9
    assert sorted(tuple(r) for r in near_dedup.near_duplicates(docs, per_key=1, centres=1, complete=2).collect()) == expected
    from pyspark.sql import functions as F

    rare = near_dedup.rare_shingles(docs.select(F.col("doc_id").alias("id"), "text"), 75)
    assert rare.groupBy("key").count().agg(F.max("count")).first()[0] < 20  # the passage brings no pairs


def test_near_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, keys string, label long")
    assert near_dedup.near_duplicates(empty).count() == 0
    rows = [(1, "a b c d e f", "x", 1), (1, "a b c d e f", "x", 1), (2, "a b c d e f", None, None), (None, "a b", None, 1)]
    other = [(1, "k l m n o p", "x", 1), (1, "v w x y z z", "x", 1), (2, "k l m n o p", None, 2), (5, "v w x y z z q " * 9000, None, 2)]
    both = near_dedup.near_duplicates(spark.createDataFrame(other, empty.schema)).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in both) == [(1, 1, True), (1, 1, True), (2, 1, False), (5, 5, True)]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, empty.schema))
    assert sorted(tuple(r) for r in got.collect()) == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False)]


def test_near_query_on_whole_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in near_dedup.query(spark, sf).collect()) == brute_near(rows)


def test_components(spark):
    r = random.Random(1)
    links = [(i, i + 1) for i in range(30)] + [(100 + r.randrange(50), 100 + r.randrange(50)) for _ in range(30)] + [(7, 7)]
    got = dict(tuple(x) for x in components(spark.createDataFrame(links, "a long, b long")).collect())
    assert all(got[i] == 0 for i in range(31))
    assert all(got[a] == got[b] for a, b in links) and all(v <= k for k, v in got.items())


def exact_oracle(path):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{path}'")
    return sorted(con.sql(exact_dedup.ORACLE).fetchall())


def test_exact_query(spark, sf):
    got = exact_dedup.query(spark, sf).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert sorted(tuple(r) for r in got.collect()) == exact_oracle(f"{sf}/documents.parquet")


def test_exact_edges(spark, tmp_path):
    long = "x" * 9000 + "se" + "y" * 6000
    rows = [(1, "a b", "k"), (2, "ab", None), (3, " a b", "k"), (4, None, "k"), (5, "", None), (6, "\x0b\t", "k"), (7, long, "k"), (8, long + " ", "k"), (9, long + "z", "k"), (10, "é ", "k"), (11, "e", "k"), (None, "q", "k"), (None, "a b", "k")]
    rows += [(-(1 << 63), "least"), ((1 << 63) - 1, "least")]
    rows = [(*r, None)[:3] for r in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, recipe string")
    docs.where("doc_id is not null").coalesce(1).write.parquet(f"{tmp_path}/d")
    got = exact_dedup.exact_duplicates(docs.where("doc_id is not null"))
    assert sorted(tuple(r) for r in got.collect()) == exact_oracle(f"{tmp_path}/d/*.parquet")
    with_null = exact_dedup.exact_duplicates(docs).where("doc_id is null").collect()
    assert sorted((r.keep_id, r.kept) for r in with_null if r.group_size > 1) == [(3, False)] and len(with_null) == 2
    assert exact_dedup.exact_duplicates(docs.limit(0)).count() == 0
    texts = exact_dedup.chunked(docs)
    assert exact_dedup.shared_identifiers(texts).isEmpty() and exact_dedup.chunk_store(texts).where("length(chunk) > 4096").isEmpty()
