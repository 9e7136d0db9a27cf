"""Projections: header hygiene, alias mapping, audit columns and alignment to a target schema.

Each operator is a single ``select``; none of them moves data.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, StructType

from tierline.functions import clean_decimal, iso_date_text, parse_date


def normalized_names(headers: Sequence[str]) -> list[str]:
    """Lower snake case; an empty header becomes ``col``; repeats get ``_1``, ``_2``, ..."""
    names: list[str] = []
    taken: set[str] = set()
    for header in headers:
        stem = re.sub(r"[^0-9a-zA-Z]+", "_", header).strip("_").lower() or "col"
        name, repeat = stem, 0
        while name in taken:
            repeat += 1
            name = f"{stem}_{repeat}"
        taken.add(name)
        names.append(name)
    return names


def normalize_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Normalise every header but the ones to keep."""
    names = iter(normalized_names([c for c in df.columns if c not in keep]))
    return df.toDF(*[c if c in keep else next(names) for c in df.columns])


def lowercase_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c if c.startswith("_") else c.lower() for c in df.columns])


def rename_headers(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Exact source header to target name; headers that are absent are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def remap_columns(df: DataFrame, aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """Give each target the first of its aliases that is present; later aliases are dropped.

    Columns that are no alias of anything pass through, unless a target has taken their name.
    """
    present = {c.lower(): c for c in df.columns}
    chosen = {
        target: next(present[a.lower()] for a in names if a.lower() in present)
        for target, names in aliases.items()
        if any(a.lower() in present for a in names)
    }
    spoken_for = {a.lower() for names in aliases.values() for a in names} | set(chosen)
    rest = [c for c in df.columns if c.lower() not in spoken_for]
    return df.select(*[F.col(src).alias(target) for target, src in chosen.items()], *rest)


def coalesce_aliases(df: DataFrame, aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """Row-wise variant of :func:`remap_columns`: the first alias that is not NULL in the row."""
    present = {c.lower(): c for c in df.columns}
    found = {t: [present[a.lower()] for a in names if a.lower() in present] for t, names in aliases.items()}
    used = {c for columns in found.values() for c in columns}
    targets = [F.coalesce(*[F.col(c) for c in columns]).alias(t) for t, columns in found.items() if columns]
    return df.select(*targets, *[c for c in df.columns if c not in used and c not in found])


def cast_all_to_string(df: DataFrame) -> DataFrame:
    return df.select([F.col(c).cast("string").alias(c) for c in df.columns])


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the listed columns that are present; text that does not fit becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns})


def select_available(df: DataFrame, ordered: Sequence[str]) -> DataFrame:
    return df.select([c for c in ordered if c in df.columns])


def normalize_dates(df: DataFrame, *columns: str) -> DataFrame:
    """Rewrite compact dates as ``yyyy-MM-dd`` text, in the columns that are present."""
    return df.withColumns({c: iso_date_text(F.col(c)) for c in columns if c in df.columns})


def align_to_schema(df: DataFrame, target: StructType) -> DataFrame:
    """Target columns in target order: cast by name, NULL where the source has none, extras dropped."""
    return df.select([_aligned(df, f, lambda c, t: c.try_cast(t)) for f in target.fields])


def align_typed(df: DataFrame, target: StructType, *carried: str) -> DataFrame:
    """As :func:`align_to_schema` for messy text: dates in many formats, numbers with commas or exponents."""

    def repair(value: Column, kind) -> Column:
        if isinstance(kind, DateType):
            return parse_date(value)
        if isinstance(kind, DecimalType):
            return clean_decimal(value, kind)
        return value.try_cast(kind)

    return df.select(*[_aligned(df, f, repair) for f in target.fields], *carried)


def _aligned(df: DataFrame, field, convert) -> Column:
    if field.name not in df.columns:
        return F.lit(None).cast(field.dataType).alias(field.name)
    return convert(F.col(field.name), field.dataType).alias(field.name)


def add_audit_columns(
    df: DataFrame, path: Column, *, tenant: Column, layer: str, domain: str, ingested_at: str
) -> DataFrame:
    """Lineage of each row: bucket, key, file name and format come from its file path."""
    moment = F.lit(ingested_at).cast("timestamp")
    return df.withColumns(
        {
            "_source_bucket": F.regexp_extract(path, r"^[a-z0-9]+:/+([^/]+)/", 1),
            "_source_key": F.regexp_replace(path, r"^[a-z0-9]+:/+[^/]+/", ""),
            "_source_file_name": F.element_at(F.split(path, "/"), -1),
            "_source_format": F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1)),
            "_tenant": F.lower(tenant),
            "_layer": F.lit(layer.lower()),
            "_stage": F.lit(domain.lower()),
            "_ingested_at": moment,
            "_ingest_date": moment.cast("date"),
        }
    )


def add_load_columns(df: DataFrame, loaded_at: str) -> DataFrame:
    moment = F.lit(loaded_at).cast("timestamp")
    return df.withColumns({"_load_ts": moment, "_load_date": moment.cast("date")})


def stamp(df: DataFrame, run_at: str) -> DataFrame:
    """Creation and update time: one literal per run, so every row of a run agrees."""
    moment = F.lit(run_at).cast("timestamp")
    return df.withColumns({"created_at": moment, "updated_at": moment})


def missing_and_extra(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Column-name differences as rows (column_name, problem)."""
    present = set(df.columns)
    rows = [(c, "missing") for c in expected if c not in present]
    rows += [(c, "extra") for c in df.columns if c not in set(expected)]
    return df.sparkSession.createDataFrame(rows, "column_name string, problem string")
