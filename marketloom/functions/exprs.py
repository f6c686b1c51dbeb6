"""Column expressions. Everything here is a built-in Catalyst expression; no Python UDFs."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: text forms accepted by the Silver validation -------------------------------
# \A and \z instead of ^ and $: Java's $ also matches before a final newline.
INTEGER_FORM = r"\A-?[0-9]+\z"
DECIMAL_FORM = r"\A-?[0-9]+(\.[0-9]+)?\z"
DATE_FORM = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
# --- end of fixed values ----------------------------------------------------------------------

_SEPARATOR = ";"  # in no plain value


def form_of(dtype: T.DataType) -> tuple[str, str] | None:
    """(pattern, short type name used in reason tags), or None for text."""
    if isinstance(dtype, T.IntegerType):
        return INTEGER_FORM, "integer"
    if isinstance(dtype, T.DecimalType):
        return DECIMAL_FORM, "numeric"
    if isinstance(dtype, T.DateType):
        return DATE_FORM, "date"
    return None


def clean_text(c: Column) -> Column:
    """Trim spaces; empty becomes NULL."""
    return F.nullif(F.trim(c), F.lit(""))


def _guarded(c: Column, dtype: T.DataType) -> Column:
    pattern, _ = form_of(dtype)
    return F.when(c.rlike(pattern), c.try_cast(dtype))


def safe_int(c: Column) -> Column:
    return _guarded(c, T.IntegerType())


def safe_date(c: Column) -> Column:
    return _guarded(c, T.DateType())


def safe_decimal(c: Column, precision: int = 7, scale: int = 2) -> Column:
    return _guarded(c, T.DecimalType(precision, scale))


def violation(name: str, dtype: T.DataType, strict: bool = False) -> Column:
    """Reason tag of a raw text column, or NULL when the value is acceptable.

    A value of the right form that has no place in the type (month 13, overflow) is tagged
    ``out_of_range``; with ``strict`` it stops the job instead.
    """
    c = F.col(name)
    pattern, short = form_of(dtype)
    no_cast = c.try_cast(dtype).isNull()
    misfit = (
        F.raise_error(F.concat(F.lit(f"{name}: value does not fit {dtype.simpleString()}: "), c))
        if strict
        else F.lit(f"{name}:out_of_range")
    )
    return (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when(~c.rlike(pattern), F.lit(f"{name}:not_{short}"))
        .when(no_cast, misfit)
    )


def _all_null_or_like(names: Sequence[str], pattern: str) -> Column:
    """True if every column is NULL or matches; never NULL. The columns are matched as one text, NULL as nothing: a value that
    holds the separator makes one too many, and an empty value is looked for beside it. ``pattern`` must not match a
    separator, nor take less of a value than it can."""
    values = F.array(*names)
    joined = _SEPARATOR.join([f"(?:{pattern})?+"] * len(names))
    return F.array_join(values, _SEPARATOR, "").rlike(rf"\A{joined}\z") & ~F.coalesce(F.array_contains(values, ""), F.lit(False))


def _plainly_valid(types: Mapping[str, T.DataType]) -> Column:
    """True if every value is NULL, or so short and plain that it must fit its type.

    Columns of one type are tested as one text: the generated code stays small however wide the
    table is, so the JVM compiles it instead of interpreting one huge method.
    """
    groups: dict[str, list[str]] = {}
    tests: list[Column] = []
    for name, t in types.items():
        if isinstance(t, T.IntegerType):
            groups.setdefault("-?[0-9]{1,9}", []).append(name)
        elif isinstance(t, T.DecimalType):
            plain = rf"-?[0-9]{{1,{t.precision - t.scale}}}(?:\.[0-9]{{1,{t.scale}}})?"
            groups.setdefault(plain, []).append(name)
        elif isinstance(t, T.DateType):
            tests.append(violation(name, t).isNull())
    for pattern, names in groups.items():
        tests.append(_all_null_or_like(names, pattern))
    return reduce(and_, tests)


def anomaly_reasons(types: Mapping[str, T.DataType], strict: bool = False) -> Column:
    """Array of reason tags in column order, without NULLs."""
    typed = {n: t for n, t in types.items() if form_of(t)}
    none = F.array().cast("array<string>")
    if not typed:
        return none
    tags = F.array_compact(F.array(*[violation(n, t, strict) for n, t in typed.items()]))
    return F.when(_plainly_valid(typed), none).otherwise(tags)


def is_clean(reasons: Column) -> Column:
    return F.size(reasons) == 0


def is_anomaly(reasons: Column) -> Column:
    return F.size(reasons) >= 1


def with_flags(df: DataFrame, types: Mapping[str, T.DataType], strict: bool = False) -> DataFrame:
    """All raw columns plus ``anomaly_reasons``."""
    return df.withColumn("anomaly_reasons", anomaly_reasons(types, strict))


def project_map(df: DataFrame, mapping: Mapping[str, str], **constants) -> DataFrame:
    """Rename / normalise columns (target -> source); constants come first as tag columns."""
    return df.select(
        *[F.lit(v).alias(k) for k, v in constants.items()],
        *[F.col(s).alias(t) for t, s in mapping.items()],
    )


def where_not_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.filter(reduce(and_, [F.col(c).isNotNull() for c in columns]))  # reaches the scan


def zero_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def safe_ratio(num: Column, den: Column, digits: int = 4) -> Column:
    """num / den rounded half-up; NULL unless the denominator is positive."""
    wide = T.DecimalType(20, 2)
    return F.when(den > 0, F.round(num.cast(wide) / den.cast(wide), digits)).cast(
        T.DecimalType(18, digits)
    )


def rfm_segment(r: Column, f: Column, m: Column, is_buyer: Column) -> Column:
    """Lifecycle segment; the first matching rule wins."""
    return (
        F.when(~is_buyer, "No purchase")
        .when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
        .when((r >= 4) & (f >= 3), "Loyal")
        .when((r <= 2) & (m >= 4), "At risk high-value")
        .when(r <= 2, "Hibernating")
        .when(f == 1, "New")
        .otherwise("Active")
    )


def rfm_score(r: Column, f: Column, m: Column) -> Column:
    return r * 100 + f * 10 + m


def recency_days(today: Column, last: Column) -> Column:
    """Date keys are day numbers, so a plain difference counts days."""
    return today - last


def props_json(props: Mapping[str, str | Column], keep_nulls: bool = False) -> Column:
    """JSON object with the given members; NULL members are dropped unless kept."""
    if not props:
        return F.lit("{}")
    members = [(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in props.items()]
    return F.to_json(F.struct(*members), {"ignoreNullFields": str(not keep_nulls).lower()})


def prop(c: Column | str, name: str, dtype: str = "string") -> Column:
    """One member of a JSON object, as text or cast to a type."""
    return F.get_json_object(c, f"$.{name}").cast(dtype)


def safe_label(c: Column) -> Column:
    """Identifier made of letters, digits and ``_``; prefixed ``C_`` if it starts otherwise."""
    kept = F.regexp_replace(c, r"[^\p{L}\p{N}_]", "")
    return F.when(kept.rlike(r"\A\p{L}"), kept).otherwise(F.concat(F.lit("C_"), kept))


def export_safe(df: DataFrame) -> DataFrame:
    """Shape rows for JSON consumers: decimals to double, dates and timestamps to ISO text."""
    def shaped(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            return c.cast("double").alias(f.name)
        if isinstance(f.dataType, T.DateType):
            return F.date_format(c, "yyyy-MM-dd").alias(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
            micros = F.date_format(c, "SSSSSS")
            return F.when(micros == "000000", whole).otherwise(
                F.concat(whole, F.lit("."), micros)).alias(f.name)
        return c

    return df.select([shaped(f) for f in df.schema.fields])


def duration_s(start: Column, end: Column, now: Column | None = None) -> Column:
    """Seconds from start to end; an open end counts up to now."""
    stop = F.coalesce(end, F.current_timestamp() if now is None else now)
    micros = F.unix_micros(stop.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return micros / F.lit(1e6)


def at_least_zero(c: Column) -> Column:
    return F.greatest(c, F.lit(0))


def is_in_set(df: DataFrame, keys: DataFrame | Iterable, column: str) -> DataFrame:
    """Keep rows whose column is in a literal list, or in the first column of a key frame."""
    if isinstance(keys, DataFrame):
        key = keys.columns[0]
        return df.join(keys.select(F.col(key).alias(column)), column, "left_semi")
    return df.filter(F.col(column).isin(list(keys)))
