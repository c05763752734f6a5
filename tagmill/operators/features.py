"""Combining the features of several families."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.sources import readers


def union_families(frames: Sequence[DataFrame], sep: str = " ") -> DataFrame:
    """Concatenate the feature texts of an entity, in family order.

    Each frame holds ``entity, features`` with about one row per entity.
    """
    tagged = readers.union_all([f.select("entity", F.lit(i).alias("family"), "features") for i, f in enumerate(frames)])
    ordered = F.sort_array(F.collect_list(F.struct("family", "features")))
    text = F.array_join(F.transform(ordered, lambda p: p["features"]), sep)
    return tagged.groupBy("entity").agg(text.alias("features"))


def stack_encoded(families: Mapping[str, tuple[DataFrame, int]]) -> DataFrame:
    """One index space for several encoded families ``{name: (entity/idx/val, dim)}``.

    Family k's indices are shifted by the summed dimensions of the families before it.
    """
    frames, offset = [], 0
    for encoded, dim in families.values():
        frames.append(encoded.select("entity", (F.col("idx") + F.lit(offset)).alias("idx"), "val"))
        offset += dim
    return readers.union_all(frames)
