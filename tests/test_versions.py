"""Tables that are rewritten while they are read: swaps, merges that count a batch once, retention, erasure, and streams over restarts."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradus.operators import governance
from gradus.sources import tables as S
from gradus.streaming import journals


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def make(spark, values):
    return spark.createDataFrame([(v, f"x{v}") for v in values], "id long, name string")


def test_readers_see_whole_versions_only(spark, tmp_path):
    table = S.VersionedTable(spark, f"file://{tmp_path}/t")
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.read(T.StructType().add("id", "long")).count() == 0 and table.state() is None
    assert table.write(make(spark, [1, 2])) == 1
    # a job that broke off before its swap: a whole folder and half a one, and a commit that never got its name
    make(spark, [9]).write.parquet(f"{tmp_path}/t/version-unfinished")
    (tmp_path / "t/version-torn").mkdir()
    (tmp_path / "t/version-torn/part-0.parquet").write_bytes(b"PAR1")
    (tmp_path / "t/_commits/.begun").write_text(json.dumps({"folder": "version-unfinished"}))
    assert rows(table.read()) == [(1, "x1"), (2, "x2")]
    before = table.read()
    assert table.write(table.read().where("id = 2").unionByName(make(spark, [3])), partition_by=["id"]) == 2
    assert rows(table.read()) == [(2, "x2"), (3, "x3")] and table.read().columns == ["name", "id"] or table.read().columns == ["id", "name"]
    assert rows(before) == rows(table.read(number=1)) == [(1, "x1"), (2, "x2")]  # a reader of the version before goes on
    assert rows(S.VersionedTable(spark, f"file://{tmp_path}/t").read()) == [(2, "x2"), (3, "x3")]
    assert table.vacuum(keep=1, grace=3600) == [] and table.commits() == [2]  # young folders may be about to be committed
    assert len(table.vacuum(keep=1, grace=0)) == 3
    assert rows(table.read()) == [(2, "x2"), (3, "x3")]
    table.write(table.read().limit(0))
    assert table.read().count() == 0 and table.read().columns == ["id", "name"]


def test_of_two_writers_one_gets_the_number(spark, tmp_path):
    a, b = (S.VersionedTable(spark, f"file://{tmp_path}/t") for _ in "ab")
    a.write(make(spark, [1]))
    base = b.state()["number"]
    a.write(make(spark, [2]))
    with pytest.raises(S.Conflict):
        b.write(make(spark, [3]), base=base)
    with pytest.raises(S.Conflict):  # both wrote their folders before either swapped
        b._swap(2, {"folder": "version-late", "schema": {}, "notes": {}})
    assert rows(b.read()) == [(2, "x2")] and b.commits() == [1, 2]


def test_a_replayed_batch_counts_once(spark, tmp_path):
    table, keys = S.VersionedTable(spark, f"file://{tmp_path}/t"), ["session", "type", "scholar", "decision"]
    r = random.Random(1)
    batches = [[(r.choice([2000, None]), r.choice("ab"), r.choice([True, False]), r.choice(["yes", None])) for _ in range(40)] for _ in range(3)]
    counts = lambda data: governance.with_defaults(spark.createDataFrame(data, "session int, type string, scholar boolean, decision string"), dict.fromkeys(keys, "none")).groupBy(*keys).agg(F.count("*").alias("n"))
    done = [governance.merge_counts(table, counts(batches[b]), keys, "journal", b) for b in (0, 0, 1, 0, 1, 2, 2)]
    assert done == [True, False, True, False, False, True, False] and table.commits() == [1, 2, 3]
    text = lambda x: "none" if x is None else str(x).lower() if isinstance(x, bool) else str(x)
    expected = Counter(tuple(map(text, row)) for b in batches for row in b)
    assert {tuple(x)[:4]: x.n for x in table.read().collect()} == expected
    assert governance.merge_counts(table, counts(batches[0]), keys, "another", 0)  # another source's first batch
    assert table.read().agg(F.sum("n")).first()[0] == 160


JOURNAL = "who string, ts timestamp, done boolean, kind string"


def journal(spark, tmp_path):
    table = S.VersionedTable(spark, f"file://{tmp_path}/journal")
    data = [("a", "2000-12-31", None, "k"), ("b", "1999-06-01", False, "k"), ("c", "1999-06-01", True, None), ("d", "1990-01-01", False, None), ("e", "1990-01-01", True, "k"), ("e", "1990-01-01", True, "k")]
    table.write(spark.createDataFrame(data, "who string, day string, done boolean, kind string").select("who", F.to_timestamp("day").alias("ts"), "done", "kind"))
    return table


def test_retention_that_breaks_off_is_repeated_without_counting_twice(spark, tmp_path, monkeypatch):
    table, counts = journal(spark, tmp_path), S.VersionedTable(spark, f"file://{tmp_path}/counts")
    run = lambda dry_run: {r.palier: r.n for r in governance.purge(table, counts, "ts", "2001-01-01", "who", "done", {"kind": "unknown"}, dry_run).collect()}
    report = {"conserver": 1, "pseudonymiser": 1, "deja_pseudonymise": 1, "agreger": 3}
    assert run(True) == report and table.commits() == [1] and counts.state() is None
    write = S.VersionedTable.write

    def broken(self, df, *a, **k):
        if self.path.endswith("journal"):
            raise RuntimeError("lost")
        return write(self, df, *a, **k)

    monkeypatch.setattr(S.VersionedTable, "write", broken)
    with pytest.raises(RuntimeError, match="lost"):
        run(False)
    monkeypatch.undo()
    assert table.read().count() == 6
    assert run(False) == report
    assert rows(counts.read()) == [("k", 2), ("unknown", 1)]
    after = table.read().collect()
    assert {r.who for r in after if r.who in "abcde"} == {"a", "c"} and sorted(r.done for r in after) == [False, True, True]
    assert run(False) == {"conserver": 1, "deja_pseudonymise": 2}
    assert sorted(map(repr, table.read().collect())) == sorted(map(repr, after)) and rows(counts.read()) == [("k", 2), ("unknown", 1)]


def test_erasure_through_the_swap(spark, tmp_path):
    table, wanted = journal(spark, tmp_path), spark.createDataFrame([("e",), ("z",), (None,)], "w string")
    trace = governance.erase(table, ["who", "kind"], wanted, "w")
    assert rows(trace) == [(2, 6)] and table.commits() == [1]
    governance.erase(table, ["who", "kind"], wanted, "w", f"{tmp_path}/trace", dry_run=False)
    assert sorted(r.who for r in table.read().collect()) == ["a", "b", "c", "d"]
    kept = spark.read.json(f"{tmp_path}/trace").first()
    assert (kept.effaces, kept.avant, kept.version) == (2, 6, 2) and "e" not in kept.asDict()
    assert table.read(number=1).count() == 6
    table.vacuum(keep=1, grace=0)
    assert len([p for p in (tmp_path / "journal").iterdir() if p.name.startswith("version-")]) == 1


TIMED = T.StructType().add("event_id", "long").add("who", "string").add("ts", "timestamp").add("session", "integer")


def arrivals(spark, folder, first, n):
    """n attempts from a second on, in two files; one identity has a third of all."""
    r = random.Random(first)
    data = [(first + i, r.choice(["hot", "hot", "a", "b", "c", None]), f"2024-01-01 00:{(first + i) // 60:02d}:{(first + i) % 60:02d}", None if i % 5 == 0 else 2000) for i in range(n)]
    df = spark.createDataFrame(data, "event_id long, who string, ts string, session int").withColumn("ts", F.to_timestamp("ts"))
    df.repartition(2).write.mode("append").json(folder)
    return df


def test_streamed_limit_over_a_restart_equals_the_batch(spark, tmp_path):
    paths = [f"{tmp_path}/{x}" for x in ("in", "out", "check")]
    parts = []
    for first in (0, 70, 130):
        parts.append(arrivals(spark, paths[0], first, 60))
        journals.limit_journal(spark, paths[0], TIMED, "who", "event_id", "ts", 3, 25, paths[1], paths[2])
    got = spark.read.schema("event_id long, accepted boolean").parquet(paths[1])
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    expected = rows(journals.limited(whole, "who", "event_id", "ts", 3, 25))
    assert rows(got) == expected and {a for _, a in expected} == {True, False}
    apart = [x for p in parts for x in rows(journals.limited(p, "who", "event_id", "ts", 3, 25))]
    assert sorted(apart) != expected  # state from the runs before decides
    journals.limit_journal(spark, paths[0], TIMED, "who", "event_id", "ts", 3, 25, paths[1], paths[2])
    assert rows(spark.read.parquet(paths[1])) == expected  # nothing new, nothing twice


def test_streamed_counts_over_a_restart_and_a_replay(spark, tmp_path):
    source, checkpoint, table = f"{tmp_path}/in", f"{tmp_path}/check", S.VersionedTable(spark, f"file://{tmp_path}/counts")
    keys = {"session": "none", "who": "nobody"}
    parts = []
    for first in (0, 70):
        parts.append(arrivals(spark, source, first, 40))
        journals.running_counts(spark, source, TIMED, keys, table, checkpoint, grace=0)
    whole = parts[0].unionByName(parts[1])
    expected = rows(governance.with_defaults(whole.select(*keys), keys).groupBy(*keys).count())
    assert rows(table.read()) == expected and len(table.commits()) == 2
    # the second batch comes again, as after a failure before its end was noted
    (tmp_path / "check/commits/1").unlink()
    for crc in (tmp_path / "check/commits").glob(".1.crc"):
        crc.unlink()
    journals.running_counts(spark, source, TIMED, keys, table, checkpoint, grace=0)
    assert rows(table.read()) == expected


def test_the_streamed_query_equals_the_batch_query(spark):
    from gradus import plans

    sf = "/root/testdata/sf0.001"
    assert rows(plans.QUERIES["j02_streamed_limit"](spark, sf)) == rows(plans.QUERIES["j02_rate_limit"](spark, sf).select("event_id", "accepted"))
