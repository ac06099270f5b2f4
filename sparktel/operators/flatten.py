"""Maps of attributes to columns, one a name, and back to one table over many files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Map column to the prefix of its columns; names from file metadata stay as they are.
NAMESPACES = {"resource": "resource_", "scope": "scope_", "attr": "attr_", "file_meta": ""}


def attribute_names(df: DataFrame) -> dict[str, list[str]]:
    """Sorted distinct names of each map, by one job with a partial aggregate: names are few, rows many."""
    spaces = [n for n in NAMESPACES if n in df.columns]
    if not spaces:
        return {}

    def keys(space: str) -> Column:
        return F.transform(F.coalesce(F.map_keys(space), F.array().cast("array<string>")), lambda k: F.struct(F.lit(space).alias("n"), k.alias("k")))

    tagged = F.concat(*[keys(n) for n in spaces])
    found = df.select(F.explode(tagged).alias("x")).select("x.*").distinct().collect()
    return {n: sorted(r["k"] for r in found if r["n"] == n) for n in spaces}


def flatten_attributes(df: DataFrame, names: dict[str, list[str]] | None = None, strict: bool = False) -> DataFrame:
    """Each map becomes columns in sorted order, null where absent.  Given names skip the job and suit streams.

    A name that a column has already gets `_1`, `_2`, ...; strict raises instead.
    """
    names = attribute_names(df) if names is None else names
    plain = [c for c in df.columns if c not in NAMESPACES]
    taken, out = {c.lower() for c in plain}, [F.col(c) for c in plain]
    for space, prefix in NAMESPACES.items():
        for k in names.get(space, []) if space in df.columns else []:
            name, i = prefix + k, 0
            while name.lower() in taken:
                if strict:
                    raise ValueError(f"two columns would be named {prefix + k}")
                i += 1
                name = f"{prefix}{k}_{i}"
            taken.add(name.lower())
            out.append(F.element_at(F.col(space), F.lit(k)).alias(name))
    return df.select(*out)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames, columns by name, null where a frame lacks one."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
