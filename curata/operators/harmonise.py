"""Bring several sources to one schema: mappings, sentinels, casts, unions, dense ids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from curata.operators.scan import numbered

# Texts that stand for a missing value.
MISSING_TEXTS = ("___", "None")
MISSING_TEXTS_REPORT = ("<NA>",)


def map_category(
    df: DataFrame, column: str, mapping: DataFrame, original: str, mapped: str, default: str | None = None
) -> DataFrame:
    """Replace a category by its mapping; unmapped values become ``default`` (or null)."""
    lookup = mapping.select(F.col(original).alias("__from"), F.col(mapped).alias("__to"))
    joined = df.join(lookup, F.col(column) == F.col("__from"), "left")
    value = F.col("__to") if default is None else F.coalesce("__to", F.lit(default))
    return joined.withColumn(column, value).select(*df.columns)


def rename_by_lists(df: DataFrame, old: Sequence[str], new: Sequence[str]) -> DataFrame:
    """Rename by two parallel lists; names the frame does not have are ignored."""
    return df.withColumnsRenamed(dict(zip(old, new)))


def move_columns(df: DataFrame, positions: Mapping[str, int]) -> DataFrame:
    """Take columns out and insert them at the given positions, one after the other."""
    names = list(df.columns)
    for name, place in positions.items():
        names.remove(name)
        names.insert(place, name)
    return df.select(*names)


def columns_with_prefix(df: DataFrame, *prefixes: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefixes)]


def columns_containing(df: DataFrame, part: str) -> list[str]:
    return [c for c in df.columns if part in c]


def drop_suffixed(df: DataFrame, suffix: str = "_todrop") -> DataFrame:
    return df.drop(*[c for c in df.columns if suffix in c])


def blank_to_null(df: DataFrame, texts: Sequence[str] = MISSING_TEXTS) -> DataFrame:
    """Sentinel texts to null in every string column."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~F.col(c).isin(*texts), F.col(c)) for c in strings})


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast to a schema; what cannot be read as the new type becomes null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def same_schema(frames: Sequence[DataFrame]) -> bool:
    return all(f.columns == frames[0].columns for f in frames[1:])


def harmonised_union(frames: Sequence[DataFrame], strict: bool = False) -> DataFrame:
    """Stack sources by column name; ``strict`` insists on equal column lists.

    A column that is text in one source becomes text in all.
    """
    if strict and not same_schema(frames):
        raise ValueError("column lists differ between sources")
    texts = {c for f in frames for c, kind in f.dtypes if kind == "string"}
    frames = [
        f.withColumns({c: F.col(c).cast("string") for c, kind in f.dtypes if c in texts and kind != "string"})
        for f in frames
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def dense_ids(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, modulo: int | None = None, source: DataFrame | None = None
) -> DataFrame:
    """Number distinct keys 0, 1, 2 ... in the order of their first appearance along ``order``.

    ``modulo`` wraps the numbers, so that keys share them from there on; nothing wraps unless it is asked for. Null keys are keys like others.
    ``source`` is where keys and order are read, if not ``df``: a written table that ``df`` has grown from.
    """
    source = df if source is None else source
    distinct = source.groupBy(*keys).agg(F.min(F.struct(*order)).alias("__place"))
    code = F.col("__code") % F.lit(modulo) if modulo else F.col("__code")
    codes = numbered(distinct, ["__place", *keys], "__code").select(*[F.col(k).alias(f"__k_{k}") for k in keys], code.alias(name))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys])
    return df.join(codes, same, "left").select(*[df[c] for c in df.columns], name)


def attach_attributes(df: DataFrame, attributes: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left merge and removal of the duplicate rows a fan-out produced."""
    return df.join(attributes, list(on), "left").dropDuplicates()


def members_of(df: DataFrame, others: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows whose key occurs in ``others``: ``{column here: column there}``."""
    return _filter_by(df, others, on, "left_semi")


def not_members_of(df: DataFrame, others: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows whose key does not occur in ``others``."""
    return _filter_by(df, others, on, "left_anti")


def _filter_by(df: DataFrame, others: DataFrame, on: Mapping[str, str], how: str) -> DataFrame:
    keys = others.select(*[F.col(there).alias(f"__m_{here}") for here, there in on.items()]).dropna().distinct()
    match = [F.col(here) == F.col(f"__m_{here}") for here in on]
    condition = match[0]
    for m in match[1:]:
        condition = condition & m
    return df.join(keys, condition, how)
