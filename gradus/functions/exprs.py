"""Column expressions: bounded rates, label keys, codes, weights and tiers. All stay inside Catalyst."""

import json
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def bounded_rate(num, den) -> Column:
    """num / den, at most 1; x/0 is 1 for x > 0 and null for 0; null in, null out."""
    num, den = _col(num).cast("double"), _col(den).cast("double")
    return F.when(num.isNull() | den.isNull(), None).when(den == 0, F.when(num > 0, 1.0)).otherwise(F.least(F.try_divide(num, den), F.lit(1.0)))


def rate_overflow(num, den) -> Column:
    """Whether the raw rate is over 1; null where the rate is null."""
    num, den = _col(num).cast("double"), _col(den).cast("double")
    return F.when(bounded_rate(num, den).isNotNull(), (den == 0) | (num > den))


def cell_weight(size) -> Column:
    return _col(size).cast("double")


def category_type(category, suffix: str = "_brs") -> Column:
    return F.regexp_replace(_col(category), f"{suffix}$", "")


def category_is_scholarship(category, suffix: str = "_brs") -> Column:
    return F.endswith(_col(category), F.lit(suffix))


def category_name(kind, scholarship, suffix: str = "_brs") -> Column:
    return F.concat(_col(kind), F.when(_col(scholarship), suffix).otherwise(""))


def department(town, long_prefixes=("97", "98")) -> Column:
    """First two characters of a town code, three for overseas; too short: null."""
    town = _col(town)
    two = F.substring(town, 1, 2)
    return F.when(F.length(town) < 2, None).when(two.isin(*long_prefixes), F.when(F.length(town) >= 3, F.substring(town, 1, 3))).otherwise(two)


def division(code, numeric: bool = False) -> Column:
    """Two-character prefix of an activity code; with numeric, null unless both are digits."""
    two = F.substring(_col(code), 1, 2)
    return F.when(two.rlike(r"^\d{2}$"), two) if numeric else two


def tier(code, tiers: dict[str, str]) -> Column:
    """Code looked up among a fixed few; unknown: null."""
    return F.create_map(*[F.lit(x) for pair in tiers.items() for x in pair])[_col(code)]


def age_years(created, as_of) -> Column:
    """Days to a stated date over 365.25."""
    return F.datediff(F.lit(as_of).cast("date"), _col(created)) / F.lit(365.25)


#: Workforce codes to tiers (fixed values).
WORKFORCE_TIERS = {
    "00": "0", "01": "1_9", "02": "1_9", "03": "1_9", "11": "10_49", "12": "10_49", "21": "50_249", "22": "50_249", "31": "50_249",
    "32": "250_plus", "41": "250_plus", "42": "250_plus", "51": "250_plus", "52": "250_plus", "53": "250_plus", "NN": "non_renseignee",
}


def _foldings() -> tuple[str, str, list[tuple[str, str]]]:
    """Of compatibility decomposition (NFKD) without combining marks: characters that become one character, those (marks) that go,
    and those that become several. Hangul syllables are left to _jamo()."""
    one, gone, many = [], [], []
    for point in range(0x80, 0x30000):
        c = chr(point)
        if 0xAC00 <= point <= 0xD7A3 or 0xD800 <= point <= 0xDFFF:
            continue
        if unicodedata.combining(c):
            gone.append(c)
        elif (plain := "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))) != c:
            one.append((c, plain)) if len(plain) == 1 else many.append((c, plain))
    return "".join(a for a, _ in one) + "".join(gone), "".join(b for _, b in one), many


_FROM, _TO, _MANY = _foldings()


def _ranges(points: list[int], gap: int = 48) -> str:
    """A character class of ranges that hold all points, and some between; a class of single characters is slow to match."""
    out: list[list[int]] = []
    for x in sorted(points):
        if out and x - out[-1][1] <= gap:
            out[-1][1] = x
        else:
            out.append([x, x])
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in out) + "]"


_SOME = _ranges([ord(a) for a, _ in _MANY])
_PLAIN = json.dumps(dict(_MANY))


#: First, middle and last letters of Hangul syllables, which stand in the order of all their triples from U+AC00 on.
_HANGUL = ["".join(map(chr, range(first, first + n))) for first, n in ((0x1100, 19), (0x1161, 21), (0x11A8, 27))]
_SYLLABLE = "[\\x{AC00}-\\x{D7A3}]"


def _jamo(text: Column) -> Column:
    """Hangul syllables as their two or three letters, found by arithmetic on the code point."""
    def letters(c: Column) -> Column:
        place = F.ascii(c) - 0xAC00
        last = place % 28
        parts = [F.substring(F.lit(_HANGUL[0]), (F.floor(place / 588) + 1).cast("int"), F.lit(1)), F.substring(F.lit(_HANGUL[1]), (F.floor(place % 588 / 28) + 1).cast("int"), F.lit(1)), F.when(last > 0, F.substring(F.lit(_HANGUL[2]), last.cast("int"), F.lit(1))).otherwise("")]
        return F.when(c.rlike(_SYLLABLE), F.concat(*parts)).otherwise(c)

    return F.when(text.rlike(_SYLLABLE), F.array_join(F.transform(F.split(text, ""), letters), "")).otherwise(text)


def folded(text) -> Column:
    """Text by compatibility decomposition without combining marks: letters without accents, ligatures and figures in plain form.

    Of the characters that become several, those that a text holds are replaced one after the other."""
    text = _col(text)
    plain = F.from_json(F.lit(_PLAIN), "map<string, string>")  # one constant
    held = F.array_distinct(F.regexp_extract_all(text, F.lit(_SOME), F.lit(0)))
    several = F.aggregate(held, text, lambda t, c: F.replace(t, c, F.coalesce(plain[c], c)))
    whole = F.when(text.rlike(_SOME), several).otherwise(text)
    return F.when(~text.rlike(r"[^\x00-\x7F]"), text).otherwise(_jamo(F.translate(whole, _FROM, _TO)))


def unaccented(text) -> Column:
    """Folded text in ASCII; what has no plain form goes."""
    text = _col(text)
    return F.when(~text.rlike(r"[^\x00-\x7F]"), text).otherwise(F.regexp_replace(folded(text), r"[^\x00-\x7F]", ""))


def label_key(text) -> Column:
    """Label without accents, case and punctuation, words one space apart."""
    return F.trim(F.regexp_replace(F.lower(unaccented(text)), "[^a-z0-9]+", " "))


def header_key(text) -> Column:
    return F.lower(unaccented(F.trim(_col(text))))


def category_key(text, missing: str = "__manquant__") -> Column:
    """Without accents, lower case, - and _ as spaces; null or blank: missing."""
    key = F.trim(F.regexp_replace(F.lower(folded(text)), r"(?U)[-_\s]+", " "))
    return F.coalesce(F.nullif(key, F.lit("")), F.lit(missing))


def clip01(value) -> Column:
    value = _col(value)
    return F.when(value.isNotNull(), F.greatest(F.least(value, F.lit(1.0)), F.lit(0.0)))


def recency_weight(session, reference: int, half_life: float) -> Column:
    if half_life < 1:
        raise ValueError("half_life must be 1 or more")
    return F.pow(F.lit(0.5), (F.lit(reference) - _col(session)) / F.lit(float(half_life)))


def composition(share) -> Column:
    """indetermine (null), minoritaire (< 20 %), mixte (20 to 80 %, both included), majoritaire (> 80 %)."""
    share = _col(share)
    return F.when(share.isNull(), "indetermine").when(share < 0.2, "minoritaire").when(share <= 0.8, "mixte").otherwise("majoritaire")


def retention_tier(ts, as_of, pseudonymise_days: int, aggregate_days: int, done=None) -> Column:
    """conserver, pseudonymiser, deja_pseudonymise or agreger, by age at as_of."""
    ts, as_of = _col(ts).cast("timestamp"), F.lit(as_of).cast("timestamp")
    old = ts <= as_of - F.expr(f"interval {aggregate_days} days")
    middle = ts <= as_of - F.expr(f"interval {pseudonymise_days} days")
    done = F.lit(False) if done is None else F.coalesce(_col(done), F.lit(False))
    return F.when(old, "agreger").when(middle & done, "deja_pseudonymise").when(middle, "pseudonymiser").otherwise("conserver")


def code_order(code) -> Column:
    """Sort key of department codes: numbers, 2A and 2B after 19, overseas, 99 last."""
    code = _col(code)
    number = F.when(code == "2A", 20.1).when(code == "2B", 20.2).otherwise(F.expr("try_cast(regexp_extract(" + _name(code) + ", '^[0-9]+', 0) as double)"))
    return F.struct(F.when(code == "99", 2).when(number.isNull(), 1).otherwise(0).alias("late"), number.alias("number"), code.alias("code"))


def _name(code: Column) -> str:
    return code._jc.toString()


def rebuilt_prediction(rate, anchor, gap) -> Column:
    """A rate as predicted, or an anchor plus a gap, clipped."""
    return clip01(F.coalesce(_col(rate), _col(anchor) + _col(gap)))


def pick_by_category(kind, scholarship, pairs: dict[tuple[str, bool], tuple[str, str]]) -> Column:
    """Bounded rate of the (num, den) pair of the row's own category."""
    out = F.lit(None).cast("double")
    for (k, s), (num, den) in pairs.items():
        out = F.when((_col(kind) == k) & (_col(scholarship) == s), bounded_rate(num, den)).otherwise(out)
    return out


def hours_left(start, as_of, hours: int = 72) -> Column:
    """Hours until start + hours, to a tenth; negative when late."""
    due = _col(start).cast("timestamp") + F.expr(f"interval {hours} hours")
    return F.bround((F.unix_micros(due) - F.unix_micros(F.lit(as_of).cast("timestamp"))) / F.lit(3.6e9), 1)
