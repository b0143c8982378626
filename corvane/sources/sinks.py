"""What a reconciling sink has to do: compare the files held with those wanted, by name, digest and identity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def actions(held: DataFrame, wanted: DataFrame) -> DataFrame:
    """(name, identity, digest) of both sides -> (name, before, action).

    By identity: 'unchanged' (same name and digest), 'renamed' (another name; ``before`` is the old one), 'written'
    (new, or another digest under the same name), 'pruned' (no longer wanted). Identities are unique on each side.
    """
    old = held.select("identity", F.col("name").alias("before"), F.col("digest").alias("old_digest"))
    both = wanted.select("identity", "name", "digest").join(old, "identity", "full_outer")
    action = (
        F.when(F.col("name").isNull(), "pruned").when(F.col("before").isNull(), "written").when(F.col("name") != F.col("before"), "renamed")
        .when(F.col("digest") == F.col("old_digest"), "unchanged").otherwise("written")
    )
    return both.select(F.coalesce("name", "before").alias("name"), "before", action.alias("action"))
