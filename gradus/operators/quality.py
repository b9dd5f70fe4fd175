"""Data-quality rules as expressions: all counts of a table come from one pass, and findings are rows."""

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCKING, WARNING = "bloquant", "avertissement"


def pattern(column: str, regex: str) -> Column:
    return F.col(column).isNotNull() & ~F.col(column).rlike(regex)


def outside(column: str, domain: Sequence, nulls: bool = True) -> Column:
    bad = ~F.col(column).isin(*domain)
    return F.coalesce(bad, F.lit(not nulls))


def negative(*columns: str) -> Column:
    out = F.lit(False)
    for c in columns:
        out = out | F.coalesce(F.col(c) < 0, F.lit(False))
    return out


def sum_differs(total: str, parts: Sequence[str]) -> Column:
    """Where all terms are there, whether the total is not their sum."""
    whole = sum((F.col(p) for p in parts[1:]), F.col(parts[0]))
    return F.coalesce(F.col(total) != whole, F.lit(False))


def percentage_differs(published, base, den, slack: float = 0.5 + 1e-6) -> Column:
    published, base, den = (F.col(x) if isinstance(x, str) else x for x in (published, base, den))
    return F.coalesce(F.abs(published - F.try_divide(base, den) * 100) > slack, F.lit(False))


def dated_after(column: str, as_of: str, years: tuple[int, int | None]) -> Column:
    """More than years[0] and at most years[1] (None: any) years after as_of."""
    at = lambda n: F.add_months(F.lit(as_of).cast("date"), 12 * n)
    day = F.col(column).cast("date")
    bad = (day > at(years[0])) if years[1] is None else (day > at(years[0])) & (day <= at(years[1]))
    return F.coalesce(bad, F.lit(False))


def bad_date(column: str, form: str = "d/M/yyyy") -> Column:
    return (F.coalesce(F.trim(column), F.lit("")) != "") & F.try_to_timestamp(F.col(column), F.lit(form)).isNull()


def rule_counts(df: DataFrame, source: str, rules: dict[str, tuple[str, str, Column]]) -> DataFrame:
    """rules: name -> (family, severity, violation). source, rule, family, severity, violations, n; one aggregate for all."""
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(v).alias(name) for name, (_, _, v) in rules.items()])
    items = [F.struct(F.lit(source).alias("source"), F.lit(name).alias("rule"), F.lit(family).alias("family"), F.lit(severity).alias("severity"), F.col(f"`{name}`").alias("violations"), F.col("_n").alias("n")) for name, (family, severity, _) in rules.items()]
    return row.select(F.explode(F.array(*items)).alias("r")).select("r.*")


def findings(counts: DataFrame, most: float = 0.0) -> DataFrame:
    return counts.where(F.col("violations") > F.col("n") * most)


def blocking(found: DataFrame) -> DataFrame:
    return found.agg(F.count(F.lit(1)).alias("n_findings"), (F.count_if(F.col("severity") == BLOCKING) > 0).alias("blocked"))


def completeness(df: DataFrame, columns: Sequence[str], least: float = 0.99) -> DataFrame:
    """Share filled of each column and whether it is too low; no rows is too low."""
    row = df.agg(*[F.avg(F.col(c).isNotNull().cast("double")).alias(c) for c in columns])
    return row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("filled")) for c in columns])).alias("r")).select("r.*").withColumn("too_low", F.coalesce(F.col("filled") < least, F.lit(True)))


def bimodal(df: DataFrame, column: str, group: str) -> DataFrame:
    """Groups that fill a column neither always nor never."""
    return df.groupBy(group).agg(F.avg(F.col(column).isNotNull().cast("double")).alias("filled")).where("filled > 0 and filled < 1")


def required_columns(df: DataFrame, required: dict[str, int], year: int, count: int | None = None) -> list[str]:
    """Names missing although their first year has come, and a note when the number of columns differs; no job runs."""
    out = [c for c, first in required.items() if year >= first and c not in df.columns]
    return out + ([f"{len(df.columns)} columns instead of {count}"] if count is not None and len(df.columns) != count else [])


def freshness(entries: DataFrame, date: str, as_of: str, days: int) -> DataFrame:
    """Status of each entry: manquante, illisible, future (blocking), perimee (warning) or ok."""
    at = F.try_to_timestamp(F.col(date))
    now = F.lit(as_of).cast("timestamp")
    status = F.when(F.col(date).isNull() | (F.trim(date) == ""), "manquante").when(at.isNull(), "illisible").when(at > now, "future").when(at < now - F.expr(f"interval {days} days"), "perimee").otherwise("ok")
    return entries.withColumn("status", status).withColumn("severity", F.when(F.col("status").isin("manquante", "illisible", "future"), BLOCKING).when(F.col("status") == "perimee", WARNING))


def declared(df: DataFrame, unique: Sequence[str] = (), not_null: Sequence[str] = (), accepted: dict[str, Iterable] | None = None) -> DataFrame:
    """test, failures of declared unique, not-null and accepted-value tests."""
    rules = {f"not_null_{c}": ("declared", BLOCKING, F.col(c).isNull()) for c in not_null} | {f"accepted_{c}": ("declared", BLOCKING, outside(c, list(v))) for c, v in (accepted or {}).items()}
    parts = [rule_counts(df, "declared", rules).select(F.col("rule").alias("test"), F.col("violations").alias("failures"))] if rules else []
    parts += [df.where(F.col(c).isNotNull()).groupBy(c).count().where("count > 1").agg(F.lit(f"unique_{c}").alias("test"), F.count(F.lit(1)).alias("failures")) for c in unique]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


#: Personal data in free text (fixed values): e-mail address, telephone number, national number, bank account.
PERSONAL = {
    "email": r"[\w.+-]+@[\w-]+\.[A-Za-z]{2,}",
    "phone": r"(?<!\d)(?:\+33|0)\s?[1-9](?:[\s.-]?\d{2}){4}(?!\d)",
    "national_id": r"(?<!\d)[12]\d{2}(?:0[1-9]|1[0-2])\d{2}\d{3}\d{3}(?:\s?\d{2})?(?!\d)",
    "bank_account": r"\bFR\d{2}[\sA-Z0-9]{11,}\b",
}


def personal_data(df: DataFrame, text: str) -> DataFrame:
    rules = {name: ("personal_data", BLOCKING, F.coalesce(F.col(text).rlike(p), F.lit(False))) for name, p in PERSONAL.items()}
    return rule_counts(df, "text", rules).select("rule", "violations", "n")
