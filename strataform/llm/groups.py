"""Consolidating pairwise matches into groups.

Minimum labels are propagated across the edges and accelerated with pointer
jumping, every round being written to the shared folder, until no label changes;
see ``strataform.operators.components`` for the rounds and how fast they shrink.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataform.operators.components import connected_components
from strataform.runtime import trimmed


def match_edges(pairs: DataFrame, a: str, b: str, match: Column) -> DataFrame:
    """Edges ``(u, v)``, ``u < v``, of pairs any of whose rows match; repeated pairs give repeated edges.

    Ids are compared trimmed and in lower case.  Null ids, null outcomes and a
    record paired with itself link nothing; blank ids count as null.
    """
    clean = lambda name: F.nullif(F.lower(trimmed(F.col(name))), F.lit(""))
    ids = pairs.where(match).select(clean(a).alias("x"), clean(b).alias("y"))
    return ids.where("x <> y").select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v"))


def consolidate(pairs: DataFrame, a: str = "document_a_id", b: str = "document_b_id", match: str = "is_duplicate") -> DataFrame:
    """One row ``(group_id, document_id)`` per document linked to another one.

    A pair links its documents if any of its rows matches, whichever way round
    it was compared; see ``match_edges`` for nulls and spelling.  Further
    columns of ``pairs`` are ignored, so clashing names do no harm.
    """
    groups = connected_components(match_edges(pairs.select(a, b, match), a, b, F.col(match) == F.lit(True)), least_rounds=1)
    return groups.select("group_id", F.col("id").alias("document_id"))
