"""Raw telemetry -> canonical, typed samples (the read boundary).

Renames the CSV header names once (schema.RAW_TO_CANONICAL), types every
column, and turns NaN / blank / unparseable values into NULL.  Numbers that
already arrive typed are only NaN-checked: no string round trip.  Ids and
times written as ``8.0`` or ``1E3`` are read as the integers they are.

Text that is there and fails its type is not lost: with ``rescue`` it is kept, by
source column, in ``_rescued_data``, and ``rescued_counts`` reports how much there is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from fleetframe.functions.numeric import clean_numeric, missing_text
from fleetframe.schema import RAW_TO_CANONICAL, SAMPLE_COLUMNS, SAMPLE_TYPES, TRIP_KEYS

#: Text that failed its type: a JSON object by source column name, NULL where there is none.
RESCUED = "_rescued_data"
#: A whole line whose number of fields is not that of its header (``sources.csv``), and its name in the rescue column.
MALFORMED = "__malformed_line"
MALFORMED_KEY = "_line"

_FRACTIONAL = (T.DoubleType, T.FloatType, T.DecimalType)
_INTEGRAL = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)


def _whole(number: Column) -> Column:
    """A number as long where it is integral (``8.0`` and ``1E3`` count), else NULL."""
    return F.when(number == F.floor(number), number.try_cast("long"))


def _typed(col: Column, source: T.DataType, target: T.DataType) -> Column:
    if isinstance(target, T.LongType):
        if isinstance(source, _INTEGRAL):
            return col.cast("long")
        if isinstance(source, T.StringType):
            text = F.trim(col)
            return F.coalesce(text.try_cast("long"), _whole(text.try_cast("decimal(38,15)")))
        if isinstance(source, _FRACTIONAL):
            return _whole(col)
        return col.try_cast("long")
    if isinstance(source, (T.DoubleType, T.FloatType)):
        d = col.cast("double")
        return F.when(~F.isnan(d), d)
    if isinstance(source, _INTEGRAL + (T.DecimalType,)):
        return col.cast("double")
    return clean_numeric(col)


def _lost(col: Column, source: T.DataType, typed: Column) -> Column:
    """Whether a value is there (not blank, not NaN) but has no typed counterpart."""
    if isinstance(source, T.StringType):
        return ~missing_text(F.trim(col)) & typed.isNull()
    if isinstance(source, (T.DoubleType, T.FloatType)):
        return col.isNotNull() & ~F.isnan(col) & typed.isNull()
    return col.isNotNull() & typed.isNull()


def _entry(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("name"), value.cast("string").alias("text"))


def clean_telemetry(raw: DataFrame, keep_extra: bool = False, rescue: bool = False) -> DataFrame:
    """Typed canonical samples from raw telemetry (raw or canonical names).

    Signal columns missing from ``raw`` come out as NULL (schema evolution:
    older files may lack newer signals); the trip keys must be present.
    ``keep_extra`` passes other columns through.  ``rescue`` adds ``_rescued_data`` with
    the text of values that failed their type and of lines that do not match their header.
    """
    fields = {f.name: f.dataType for f in raw.schema.fields}
    missing = [k for k in TRIP_KEYS if k not in fields]
    if missing:
        raise ValueError(f"telemetry without trip key column(s) {missing}; columns: {sorted(fields)}")
    out, kept, sources = [], [], {}
    for raw_name, name in RAW_TO_CANONICAL.items():
        src = raw_name if raw_name in fields else (name if name in fields else None)
        target = SAMPLE_TYPES[name]
        if src is None:
            out.append(F.lit(None).cast(target).alias(name))
        else:
            out.append(_typed(F.col(f"`{src}`"), fields[src], target).alias(name))
            sources[raw_name] = (name, src)
    if keep_extra:
        known = {*RAW_TO_CANONICAL, *SAMPLE_COLUMNS, RESCUED, MALFORMED}
        kept = [c for c in raw.columns if c not in known]
    if not rescue:
        return raw.select(*out, *[F.col(f"`{c}`") for c in kept])
    # typed once; the text that failed is then found beside the result (one projection for all
    # of it would be typed twice, in code too long to compile)
    texts = [F.col(f"`{src}`").alias(f"__text{i}") for i, (_, src) in enumerate(sources.values())]
    malformed = F.col(MALFORMED) if MALFORMED in fields else F.lit(None).cast("string")
    typed = raw.select(*out, *texts, malformed.alias(MALFORMED), *[F.col(f"`{c}`").alias(f"__kept{i}") for i, c in enumerate(kept)])
    entries = [F.when(_lost(F.col(f"__text{i}"), fields[src], F.col(name)), _entry(raw_name, F.col(f"__text{i}")))
               for i, (raw_name, (name, src)) in enumerate(sources.items())]
    entries.append(F.when(F.col(MALFORMED).isNotNull(), _entry(MALFORMED_KEY, F.col(MALFORMED))))
    found = typed.withColumn("__found", F.filter(F.array(*entries), lambda e: e.isNotNull()))
    held = F.when(F.size("__found") > 0, F.to_json(F.map_from_entries("__found"))).alias(RESCUED)
    return found.select(*SAMPLE_COLUMNS, held, *[F.col(f"__kept{i}").alias(c) for i, c in enumerate(kept)])


def rescued_values(samples: DataFrame) -> DataFrame:
    """One row per rescued value: ``column_name, text``."""
    held = F.from_json(RESCUED, "map<string,string>")
    return samples.where(F.col(RESCUED).isNotNull()).select(F.explode(held).alias("column_name", "text"))


def rescued_counts(samples: DataFrame) -> DataFrame:
    """``column_name, n_values``: how much text of each source column failed its type, and
    under ``_no_key`` how many samples lack a trip key (no trip can take them in)."""
    keyless = F.lit(False)
    for key in TRIP_KEYS:
        keyless = keyless | F.col(key).isNull()
    held = F.map_keys(F.from_json(RESCUED, "map<string,string>"))
    names = F.array_compact(F.concat(F.coalesce(held, F.array().cast("array<string>")),
                                     F.array(F.when(keyless, F.lit("_no_key")))))
    return (samples.where(F.col(RESCUED).isNotNull() | keyless).select(F.explode(names).alias("column_name"))
            .groupBy("column_name").agg(F.count(F.lit(1)).alias("n_values")))
