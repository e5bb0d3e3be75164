"""Column-name normalisation and alias resolution.

Names are metadata: they are computed on the driver from ``df.columns``;
the data itself never leaves the executors.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom import schemas as S


def strict_name(name: str) -> str:
    """Non-alphanumerics -> '_', runs collapsed, edges stripped, lower case."""
    n = re.sub(r"[^0-9A-Za-z]", "_", name)
    n = re.sub(r"_+", "_", n).strip("_")
    return n.lower()


def light_name(name: str) -> str:
    """Strip, lower, space and '-' -> '_'."""
    return name.strip().lower().replace(" ", "_").replace("-", "_")


def _merge_collisions(df: DataFrame, new_names: list[str]) -> DataFrame:
    """Rename positionally; columns that collide are merged with coalesce in source order."""
    tmp = [f"__c{i}" for i in range(len(df.columns))]
    d = df.toDF(*tmp)
    order: list[str] = []
    groups: dict[str, list[str]] = {}
    for t, n in zip(tmp, new_names):
        if n not in groups:
            order.append(n)
            groups[n] = []
        groups[n].append(t)
    return d.select([
        (F.col(groups[n][0]) if len(groups[n]) == 1 else F.coalesce(*[F.col(t) for t in groups[n]])).alias(n)
        for n in order
    ])


def normalize_columns(df: DataFrame, mode: str = "strict") -> DataFrame:
    fn = strict_name if mode == "strict" else light_name
    return _merge_collisions(df, [fn(c) for c in df.columns])


def apply_aliases(df: DataFrame, profile: str | dict = "canonical", drop: list[str] | None = None) -> DataFrame:
    """Rename by an alias profile (after light normalisation)."""
    amap = S.ALIAS_PROFILES[profile] if isinstance(profile, str) else profile
    drop = set(drop or (S.CASE_FILE_DROP if profile == "case_file" else []))
    keep = [c for c in df.columns if light_name(c) not in drop]
    d = df.select([F.col(f"`{c}`") for c in keep])
    names = [amap.get(light_name(c), light_name(c)) for c in keep]
    return _merge_collisions(d, names)


def evolve_serial(df: DataFrame, old: str = "serial_number", new: str = "serial_no") -> DataFrame:
    """One key column whatever the file generation: coalesce(new, old), drop old."""
    cols = set(df.columns)
    if new in cols and old in cols:
        return df.withColumn(new, F.coalesce(F.col(new), F.col(old))).drop(old)
    if old in cols:
        return df.withColumnRenamed(old, new)
    if new in cols:
        return df
    return df.withColumn(new, F.lit(None).cast("string"))


def align_union(frames: list[DataFrame]) -> DataFrame:
    """Union of heterogeneous rows; columns missing in a frame become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def align_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """K1: keep the target's columns, in order, cast to its types; absent -> NULL.

    Columns not in the target are collected into ``_extras`` (a JSON map)
    instead of being silently dropped.
    """
    have = set(df.columns)
    out = []
    for f in schema.fields:
        if f.name in have:
            out.append(F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    extra = [c for c in df.columns if c not in {f.name for f in schema.fields}]
    if extra:
        out.append(F.to_json(F.create_map(*[x for c in extra for x in (F.lit(c), F.col(f"`{c}`").cast("string"))]))
                   .alias("_extras"))
    return df.select(out)


def tagged_union(frames: dict[str, DataFrame], tag: str = "table_name") -> DataFrame:
    """UNION ALL of several tables with a tag column."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                  [d.withColumn(tag, F.lit(name)) for name, d in frames.items()])
