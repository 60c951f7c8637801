"""Template projections: raw columns to clean ones, with what fails kept apart."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemart.functions.text import normalize_str, present, to_local_time

Transform = Callable[[Column], Column]


@dataclass(frozen=True)
class Template:
    """Selectors for raw pages, transforms for raw columns, and joins that fill key columns."""

    selectors: dict = field(default_factory=dict)
    transforms: dict[str, Transform] = field(default_factory=dict)
    lookups: dict[str, Callable[[DataFrame], DataFrame]] = field(default_factory=dict)

    def __post_init__(self):
        for key, how in self.transforms.items():
            if not callable(how):
                raise TypeError(f"{key}: a transform is a function of a column")


def project(df: DataFrame, transforms: dict[str, Transform], keep: tuple[str, ...] = (), strict: bool = False) -> DataFrame:
    """Each key that df has, transformed; columns without a transform are dropped, or an error when strict.

    Struct results are spread; a later key replaces an earlier one of its name.
    """
    for key, how in transforms.items():
        if not callable(how):
            raise TypeError(f"{key}: a transform is a function of a column")
    unknown = [c for c in df.columns if c not in transforms and c not in keep]
    if strict and unknown:
        raise KeyError(f"no transform for {', '.join(unknown)}")
    out = df.select(*keep, *[how(F.col(key)).alias(key) for key, how in transforms.items() if key in df.columns])
    return spread(out)


def spread(df: DataFrame) -> DataFrame:
    """Struct columns replaced by their fields; of two columns of one name the later stays."""
    columns: dict[str, Column] = {}
    for f in df.schema:
        if isinstance(f.dataType, T.StructType):
            columns |= {g.name: F.col(f"`{f.name}`.`{g.name}`") for g in f.dataType}
        else:
            columns[f.name] = F.col(f"`{f.name}`")
    return df.select(*[c.alias(name) for name, c in columns.items()])


def with_errors(raw: DataFrame, clean: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """clean with errors array<string>: the columns that had a value and lost it."""
    before = raw.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_raw_{c}") for c in columns])
    lost = F.filter(F.array(*[F.when(F.col(f"_raw_{c}").isNotNull() & F.col(c).isNull(), F.lit(c)) for c in columns]), lambda x: x.isNotNull())
    return clean.join(before, F.col(key).eqNullSafe(F.col("_key"))).withColumn("errors", lost).select(*clean.columns, "errors")


def status_history(rows: Column) -> Column:
    """array of (chamber, status_date, history_action, vote_action_present), cleaned."""
    return F.transform(
        rows,
        lambda x: F.struct(
            normalize_str(x.chamber).alias("chamber"),
            to_local_time(x.status_date).alias("status_date"),
            normalize_str(x.history_action).alias("history_action"),
            present(x.vote_action_present).alias("vote_action_present"),
        ),
    )


def document_map(c: Column) -> Column:
    """map<kind, urls>: kinds in lower case, urls trimmed, blank ones left out."""
    cleaned = F.transform_values(c, lambda k, v: F.filter(F.transform(v, lambda x: F.trim(x)), lambda x: F.coalesce(F.length(x) > 0, F.lit(False))))
    return F.transform_keys(cleaned, lambda k, v: F.lower(k))


def as_parameters(df: DataFrame, prefix: str = "p_") -> DataFrame:
    """Columns prefixed; maps and structs as JSON (empty maps null), arrays of them as arrays of JSON, times as ISO text."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.MapType):
            c = F.when(F.size(c) > 0, F.to_json(c))
        elif isinstance(f.dataType, T.StructType):
            c = F.to_json(c)
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, (T.StructType, T.MapType)):
            c = F.transform(c, lambda x: F.to_json(x))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        out.append(c.alias(prefix + f.name))
    return df.select(*out)
