"""Bridging taxonomies, label matching, outlet terms and batch recommendation."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import clip01, label_key
from ..sources.tables import scratch

#: Statuses of the outlet term (fixed values).
MEASURED = "mesure"
NO_AREA = "indisponible_territoire_non_renseigne"
NO_LINK = "indisponible_chaine_rompue"
WITHDRAWN = "indisponible_certification_radiee"
SUPPRESSED = "indisponible_k_anonymat"


def bridge(first: DataFrame, second: DataFrame, third: DataFrame, status: DataFrame, keys: Sequence[str], status_key: str) -> DataFrame:
    """first -> second -> third by two inner joins, then the status, if any."""
    return first.join(second, keys[0]).join(third, keys[1]).join(status, status_key, "left")


def unambiguous_labels(left: DataFrame, label: str, right: DataFrame, right_label: str, code: str) -> DataFrame:
    """left with the code of the right label whose key equals its own; right keys with several codes match nothing."""
    codes = right.select(label_key(right_label).alias("_key"), F.col(code)).where("_key <> ''").groupBy("_key").agg(F.min(code).alias(code), F.max(code).alias("_last"))
    codes = codes.where(F.col(code) == F.col("_last")).drop("_last")
    return left.withColumn("_key", label_key(label)).join(codes, "_key").drop("_key")


def outlet_term(rows: DataFrame, code: str, department: str, divisions: DataFrame, counts: DataFrame, every: DataFrame, active: DataFrame, saturation: float) -> DataFrame:
    """status and outlet value of (code, department) rows.

    divisions (code, division), counts (departement, division, n: published cells), every (departement, division: all
    non-empty cells), active (code, actif). Published or truly zero counts give min(1, n / saturation), 1 without saturation; a cell that
    exists but was suppressed, or an unknown one, is neutral (1). A code that isn't active or has no division is withdrawn: 0."""
    divisions = divisions.where("division is not null")
    summed = divisions.join(counts, "division").groupBy(code, "departement").agg(F.sum("n").alias("_n"))
    exists = divisions.join(every, "division").select(code, "departement", F.lit(True).alias("_exists")).distinct()
    linked = divisions.select(code, F.lit(True).alias("_linked")).distinct()
    place = F.col(department)
    d = rows.join(summed.withColumnRenamed("departement", department), [code, department], "left").join(exists.withColumnRenamed("departement", department), [code, department], "left")
    d = d.join(active, code, "left").join(linked, code, "left")
    gone = ~F.coalesce("actif", F.lit(True)) | F.col("_linked").isNull()
    status = F.when(place.isNull(), NO_AREA).when(F.col(code).isNull(), NO_LINK).when(gone, WITHDRAWN).when(F.col("_n").isNotNull() | ~F.coalesce("_exists", F.lit(False)), MEASURED).otherwise(SUPPRESSED)
    d = d.withColumn("statut", status)
    share = F.least(F.lit(1.0), F.col("_n") / F.lit(float(saturation))) if saturation > 0 else F.lit(1.0)
    measured = F.when(F.col("_n").isNull(), 0.0).otherwise(share)
    value = F.when(F.col("statut") == MEASURED, measured).when(F.col("statut") == WITHDRAWN, 0.0).otherwise(1.0)
    return d.withColumn("debouches", value).drop("_n", "_exists", "_linked", "actif")


def with_word_key(profiles: DataFrame, word: str, name: str = "_word") -> DataFrame:
    return profiles.withColumn(name, label_key(word))


def with_text_key(catalogue: DataFrame, labels: Sequence, name: str = "_text") -> DataFrame:
    return catalogue.withColumn(name, F.concat_ws(" ", *[label_key(x) for x in labels]))


def affinity(wanted_type, kind, wanted_word, labels: Sequence, wanted_area, area, outside: float = 0.6, keys: tuple[str, str] | None = None) -> dict[str, Column]:
    """Two hard filters (type; keyword in the labels' keys, joined by a space) and a soft one (area): criteria and factor. A null wish is no constraint.

    keys: columns made by with_word_key() and with_text_key(), for pairs of profiles and programmes."""
    col = lambda x: F.col(x) if isinstance(x, str) else x
    key, text = (F.col(k) for k in keys) if keys else (label_key(wanted_word), F.concat_ws(" ", *[label_key(x) for x in labels]))
    type_ok = col(wanted_type).isNull() | (col(wanted_type) == col(kind))
    word_ok = F.when(col(wanted_word).isNull(), True).otherwise((key != "") & F.contains(text, key))
    area_ok = F.when(col(wanted_area).isNull(), None).otherwise(F.coalesce(col(wanted_area) == col(area), F.lit(False)))
    factor = F.when(~F.coalesce(type_ok, F.lit(False)) | ~word_ok, 0.0).when(~F.coalesce(area_ok, F.lit(True)), outside).otherwise(1.0)
    return {"type_ok": F.coalesce(type_ok, F.lit(False)), "word_ok": word_ok, "area_ok": area_ok, "affinite": factor}


def recommend(profiles: DataFrame, catalogue: DataFrame, on: Sequence[str], profile: str, key: Sequence[str], affinity_columns: dict[str, Column], prediction: str, outlet: str, top: int) -> DataFrame:
    """Each profile's best programmes: score = affinity x accessibility x outlets, all three kept; ties by the cell's key."""
    rows = profiles.join(catalogue, list(on)).withColumns(affinity_columns).withColumn("accessibilite", clip01(prediction))
    rows = rows.withColumn("score", F.col("affinite") * F.col("accessibilite") * F.col(outlet))
    return ranked(rows, [profile], "score", key, top)


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def recommend_by_wish(
    profiles: DataFrame, catalogue: DataFrame, on: Sequence[str], profile: str, word: str, area: str, key: Sequence[str], text: str, place: str,
    prediction: str, outlet: str, top: int, outside: float = 0.6, salts: int = 16,
) -> DataFrame:
    """recommend() for affinity()'s factor, without the pairs of profiles and programmes: profile, key, affinite, accessibilite, outlet, score, rang.

    Profiles that wish the same (on, word's key, area) get the same programmes, so each distinct wish is answered once. The factor takes
    three values only. Where it is 1, a wish needs the `top` best programmes of its area; where it is `outside`, they are among the
    2 x top best of all areas once no area gives more than `top`; where it is 0, the first by key. These short lists are made for each
    distinct (on, word), limited before any shuffle, and a wish is compared with at most 4 x top programmes.

    word: a column of with_word_key(), text: one of with_text_key(); a null word or area is no constraint."""
    on, key = list(on), list(key)
    wishes = profiles.select(*on, F.col(word).alias("_w"), F.col(area).alias("_a")).distinct()
    words = wishes.select(*on, "_w").distinct().withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    programmes = catalogue.select(*on, *key, F.col(text).alias("_text"), F.col(place).alias("_place"), clip01(prediction).alias("accessibilite"), outlet)
    programmes = _written(programmes, "programmes")  # read by each list; what made it is not planned again for each
    pairs = words.join(programmes.withColumn("_s", F.pmod(F.xxhash64(*key), F.lit(salts)).cast("int")), [*on, "_s"]).drop("_s")
    pairs = pairs.withColumn("_ok", F.col("_w").isNull() | ((F.col("_w") != "") & F.contains("_text", F.col("_w")))).drop("_text")
    score = lambda factor: F.lit(factor) * F.col("accessibilite") * F.col(outlet)

    def best(rows: DataFrame, by: Sequence[str], factor: float, n: int) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc_nulls_last(score(factor)), *key)
        return rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= n).drop("_n")

    group, fitting = [*on, "_w"], pairs.where("_ok")
    inside = best(fitting, [*group, "_place"], 1.0, top)
    beyond = best(best(fitting, [*group, "_place"], outside, top), group, outside, 2 * top)
    lists = [  # programmes, factor, which wishes they are for
        (inside, 1.0, F.col("_a").isNotNull() & (F.col("_a") == F.col("_place"))),
        (best(inside, group, 1.0, top), 1.0, F.col("_a").isNull()),
        (beyond, outside, F.col("_a").isNotNull() & ~F.col("_a").eqNullSafe(F.col("_place"))),
        (best(pairs.where(~F.col("_ok")), group, 0.0, top), 0.0, F.lit(True)),
    ]

    def joined(left: DataFrame, right: DataFrame, names: Sequence[str]) -> DataFrame:
        right = right.withColumnsRenamed({c: f"_r{c}" for c in names})
        return left.join(right, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r{c}")) for c in names])).drop(*[f"_r{c}" for c in names])

    kept = [(_written(short, "list"), factor, of) for short, factor, of in lists]
    some = reduce(DataFrame.unionByName, [joined(wishes, short, group).where(of).withColumn("affinite", F.lit(factor)) for short, factor, of in kept])
    some = some.withColumn("score", F.col("affinite") * F.col("accessibilite") * F.col(outlet))
    chosen = ranked(some, [*group, "_a"], "score", key, top).select(*group, "_a", *key, "affinite", "accessibilite", outlet, "score", "rang")
    return joined(profiles.select(profile, *on, F.col(word).alias("_w"), F.col(area).alias("_a")), chosen, [*group, "_a"]).drop("_w", "_a")


def ranked(df: DataFrame, by: Sequence[str], score: str, ties: Sequence[str], top: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc_nulls_last(score), *ties)
    return df.withColumn("rang", F.row_number().over(order)).where(F.col("rang") <= top)


def capped_slices(profiles: DataFrame, catalogue: DataFrame, on: Sequence[str], profile: str, cap: int) -> DataFrame:
    """Catalogue rows a profile would score, and whether they exceed the cap: an error status, never a cut."""
    sizes = catalogue.groupBy(*on).agg(F.count(F.lit(1)).alias("n"))
    return profiles.join(sizes, list(on), "left").select(profile, F.coalesce("n", F.lit(0)).alias("n"), F.when(F.coalesce("n", F.lit(0)) > cap, "trop_grand").otherwise("ok").alias("status"))


def any_identifier(records: DataFrame, fields: Sequence[str], requests: DataFrame, wanted: str) -> DataFrame:
    """Records of which any field holds a requested identifier, each as often as it occurs: a flag a field, then one filter."""
    ids = requests.select(F.col(wanted)).where(F.col(wanted).isNotNull()).distinct()
    out = records
    for i, f in enumerate(fields):
        out = out.join(ids.select(F.col(wanted).alias(f"_id{i}"), F.lit(True).alias(f"_hit{i}")), F.col(f) == F.col(f"_id{i}"), "left")
    return out.where(reduce(lambda a, b: a | b, [F.col(f"_hit{i}").isNotNull() for i in range(len(fields))])).select(*records.columns)


def survival(df: DataFrame, key: str, session: str) -> DataFrame:
    """Share of a session's keys that are there in the next."""
    keys = df.select(key, session).distinct()
    later = keys.select(key, (F.col(session) - 1).alias(session), F.lit(1.0).alias("_there"))
    return keys.join(later, [key, session], "left").groupBy(session).agg(F.count(F.lit(1)).alias("n"), F.avg(F.coalesce("_there", F.lit(0.0))).alias("survival"))


def with_default_group(df: DataFrame, groups: DataFrame, key: str, group: str, default: str = "indetermine") -> DataFrame:
    return df.join(groups.select(key, group), key, "left").withColumn(group, F.coalesce(group, F.lit(default)))
