"""Column expressions shared by the operators. All of them stay inside Catalyst."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
EARTH_KM = 6371.0


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_ws(c) -> Column:
    """Strip blanks, tabs and line ends; Spark's trim() strips blanks only."""
    return F.regexp_replace(col(c), r"^[ \t\r\n]+|[ \t\r\n]+$", "")


def blank(c) -> Column:
    """Null or empty, without trimming."""
    return col(c).isNull() | (col(c) == "")


def number(c) -> Column:
    """The finite number that a trimmed text spells, else null."""
    value = F.regexp_extract(trim_ws(c), NUMBER, 0).try_cast("double")
    return F.when(F.abs(value) < float("inf"), value)


def decimals(c) -> Column:
    """Characters behind the first point of the text as it is."""
    at = F.instr(col(c), ".")
    return F.when(at > 0, F.length(col(c)) - at).otherwise(0)


def values_equal(x, y, numeric_ok=True) -> Column:
    """Equal as trimmed texts, else as numbers, else rounded at the decimals both have where those are two at least.

    Both null is equal, one null is not; the result is never null.
    """
    x, y = col(x), col(y)
    ok = F.lit(numeric_ok) if isinstance(numeric_ok, bool) else numeric_ok
    a, b, places = number(x), number(y), F.least(decimals(x), decimals(y))
    scale = F.pow(F.lit(10.0), places.cast("double"))
    close = (a == b) | ((places >= 2) & (F.rint(a * scale) == F.rint(b * scale)))
    text = trim_ws(x) == trim_ws(y)
    return F.when(x.isNull() & y.isNull(), True).when(x.isNull() | y.isNull(), False).otherwise(F.coalesce(text | (ok & close), text, F.lit(False)))


def with_parts(df: DataFrame, *columns: str) -> DataFrame:
    """df with each column's trimmed text, number and decimals beside it, for equal_parts: several comparisons then share them."""
    df = df.withColumns({f"{c}__text": trim_ws(c) for c in columns} | {f"{c}__places": decimals(c) for c in columns})
    value = lambda c: F.regexp_extract(f"{c}__text", NUMBER, 0).try_cast("double")
    return df.withColumns({f"{c}__number": value(c) for c in columns})


def equal_parts(x: str, y: str, numeric_ok=True) -> Column:
    """values_equal of two columns with parts."""
    ok = F.lit(numeric_ok) if isinstance(numeric_ok, bool) else numeric_ok
    a, b, places = F.col(f"{x}__number"), F.col(f"{y}__number"), F.least(f"{x}__places", f"{y}__places")
    finite = (F.abs(a) < float("inf")) & (F.abs(b) < float("inf"))
    scale = F.pow(F.lit(10.0), places.cast("double"))
    close = finite & ((a == b) | ((places >= 2) & (F.rint(a * scale) == F.rint(b * scale))))
    text = F.col(f"{x}__text") == F.col(f"{y}__text")
    return F.when(text, True).when(F.col(x).isNull() & F.col(y).isNull(), True).otherwise(F.coalesce(ok & close, F.lit(False)))


def sql_values_equal(x: str, y: str, numeric_ok: str = "true") -> str:
    """The same in DuckDB's SQL."""
    trim = lambda v: f"regexp_replace({v}, '^[ \\t\\r\\n]+|[ \\t\\r\\n]+$', '', 'g')"
    num = lambda v: f"(CASE WHEN regexp_matches({trim(v)}, '{NUMBER}') AND abs(TRY_CAST({trim(v)} AS DOUBLE)) < 'inf'::DOUBLE THEN TRY_CAST({trim(v)} AS DOUBLE) END)"
    dec = lambda v: f"(CASE WHEN instr({v}, '.') > 0 THEN length({v}) - instr({v}, '.') ELSE 0 END)"
    places = f"least({dec(x)}, {dec(y)})"
    rounded = lambda v: f"round_even({num(v)} * power(10, {places}), 0)"
    close = f"({num(x)} = {num(y)} OR ({places} >= 2 AND {rounded(x)} = {rounded(y)}))"
    return f"(CASE WHEN {x} IS NULL AND {y} IS NULL THEN true WHEN {x} IS NULL OR {y} IS NULL THEN false ELSE coalesce({trim(x)} = {trim(y)} OR ({numeric_ok} AND {close}), {trim(x)} = {trim(y)}, false) END)"


def version_array(c, separator: str = "[.]") -> Column:
    """A version's numbers, which compare one after another; null where a part is no number."""
    return F.transform(F.split(col(c), separator), lambda x: x.try_cast("int"))


def version_text(numbers, separator: str = ".") -> Column:
    return F.array_join(F.transform(numbers, lambda x: x.cast("string")), separator)


def set_digest(items) -> Column:
    """md5 over the sorted distinct items, one on each line."""
    return F.md5(F.array_join(F.array_sort(F.array_distinct(items)), "\n"))


def row_fingerprint(*columns) -> Column:
    """An aggregate over any number of rows that doesn't depend on their order: their count and the sum of 60 bits of each row's md5.

    Unlike a hash of the sorted rows it needs no row together with another.
    """
    text = F.concat_ws("\x1f", *[F.coalesce(col(c).cast("string"), F.lit("\x00")) for c in columns])
    part = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(38,0)")
    return F.concat_ws(":", F.count(F.lit(1)).cast("string"), F.coalesce(F.sum(part), F.lit(0)).cast("decimal(38,0)").cast("string"))


def sql_row_fingerprint(*columns: str) -> str:
    text = " || chr(31) || ".join(f"coalesce(CAST({c} AS VARCHAR), chr(0))" for c in columns)
    return f"count(*) || ':' || CAST(CAST(coalesce(sum(CAST(('0x' || substr(md5({text}), 1, 15)) AS BIGINT)), 0) AS DECIMAL(38,0)) AS VARCHAR)"


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    lat1, lon1, lat2, lon2 = (F.radians(col(c)) for c in (lat1, lon1, lat2, lon2))
    return radian_km(lat1, lon1, F.cos(lat1), lat2, lon2, F.cos(lat2))


def radian_km(lat1, lon1, cos1, lat2, lon2, cos2) -> Column:
    """The distance of two points in radians, with the cosines of their latitudes."""
    lat1, lon1, cos1, lat2, lon2, cos2 = (col(c) for c in (lat1, lon1, cos1, lat2, lon2, cos2))
    up, along = F.sin((lat2 - lat1) / 2), F.sin((lon2 - lon1) / 2)
    h = up * up + cos1 * cos2 * (along * along)
    return 2 * EARTH_KM * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def sql_haversine_km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return f"(2 * 6371.0::DOUBLE * asin(sqrt(least(1.0::DOUBLE, power(sin((radians({lat2}) - radians({lat1})) / 2), 2.0::DOUBLE) + cos(radians({lat1})) * cos(radians({lat2})) * power(sin((radians({lon2}) - radians({lon1})) / 2), 2.0::DOUBLE)))))"


def rounded(x, places: int) -> Column:
    """A non-negative double to some places, half up, in doubles as SQL engines do; F.round goes by way of decimals, which costs more than the distance of two points."""
    x = col(x)
    return F.when(x < 2.0**52 / 10**places, F.floor(x * 10.0**places + 0.5) / 10.0**places).otherwise(x)


def column_letters(n) -> Column:
    """Spreadsheet letters of a column number from 1, any long: bijective base 26. Null stays null, numbers under 1 have no letters."""
    n, out = col(n).cast("long"), []
    for place in range(13, -1, -1):
        first = (26 ** (place + 1) - 1) // 25  # the smallest number with a letter at this place
        digit = F.call_function("div", n - F.lit(first), F.lit(26**place)) % 26
        out.append(F.when(n >= first, F.chr(digit + 65)).when(n.isNotNull(), ""))
    return F.concat(*out)


def column_number(letters) -> Column:
    """The number of spreadsheet letters."""
    chars = F.filter(F.split(F.upper(col(letters)), ""), lambda c: c != "")
    return F.aggregate(chars, F.lit(0).cast("long"), lambda acc, c: acc * 26 + (F.ascii(c) - 64))


def short_example(c, width: int = 60) -> Column:
    """A text as an example: over width characters, the first width - 3 and three points."""
    return F.when(F.length(col(c)) > width, F.concat(F.substring(col(c), 1, width - 3), F.lit("..."))).otherwise(col(c))


def coerce_kind(c) -> Column:
    """How a cell's text is written into a document: remove, logical, number or text."""
    c = col(c)
    return F.when(c.isNull(), "remove").when(c.isin("TRUE", "FALSE"), "logical").when(c.rlike(NUMBER), "number").otherwise("text")


def field_path(field) -> Column:
    """Where a flat field name lives in a document: struct(target, index, scope, name, level)."""
    f = col(field)
    scoped, plain, pub = r"^([A-Za-z]+)Interpretation([0-9]+)_(.+)$", r"^interpretation([0-9]+)_(.+)$", r"^pub([0-9]+)_(.+)$"
    part = lambda p, k: F.regexp_extract(f, p, k)
    cases = [
        (f.rlike(scoped), "interpretation", part(scoped, 2), F.lower(part(scoped, 1)), part(scoped, 3), "column"),
        (f.rlike(plain), "interpretation", part(plain, 1), F.lit(None), part(plain, 2), "column"),
        (f.rlike(r"^calibration_.+$"), "calibration", F.lit(None), F.lit(None), F.substring(f, 13, 1000), "column"),
        (f.rlike(r"^(paleo|chron)Data_.+$"), "column", F.lit(None), F.lit(None), F.substring(f, 11, 1000), "column"),
        (f.rlike(pub), "pub", part(pub, 1), F.lit(None), part(pub, 2), "dataset"),
        (f.rlike(r"^geo_.+$"), "geo", F.lit(None), F.lit(None), F.substring(f, 5, 1000), "dataset"),
    ]
    out = F.struct(F.lit("root").alias("target"), F.lit(None).cast("int").alias("index"), F.lit(None).cast("string").alias("scope"), f.alias("name"), F.lit("dataset").alias("level"))
    for when, target, index, scope, name, level in reversed(cases):
        made = F.struct(F.lit(target).alias("target"), index.cast("int").alias("index"), scope.cast("string").alias("scope"), name.alias("name"), F.lit(level).alias("level"))
        out = F.when(when, made).otherwise(out)
    return out


def sheet_title(current, version, compilation) -> Column:
    """A sheet's name with its version: a trailing version is replaced, else one is added; a blank name gets the compilation's."""
    base = F.when(blank(current), F.concat(col(compilation), F.lit(" QC"))).otherwise(F.regexp_replace(col(current), r" v?[0-9]+_[0-9]+_[0-9]+$", ""))
    return F.concat(base, F.lit(" v"), col(version))
