"""Best representative of each duplicate group.

Which row of a document is current, and which member of a group supplies each
field of its surviving record.

*Currency.*  The rows of a document form a partial order: of two dated rows the
later one is the more current, and where a date is missing or two are equal, the
values tell.  Every field is reduced to a small set of states (a decile of a
score, a count up to ten, filled or empty ...), the precedence of states is
learned from all timestamped rows (state s precedes t in a document if every row
showing s is older than every row showing t), and each field's graph of proven
precedences is sorted topologically, its cycles being condensed to one level.
The order of rows by values is the product of their fields' orders; the sum of
weighted levels is a linear extension of it, so the row with the largest sum is
a maximal, that is topologically latest one, and is found by one aggregation
without comparing pairs of rows.

*Survivorship.*  Members rank by having a text, score, warnings and id; each
field comes from the first member that has it.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataform.runtime import BROADCAST_LIMIT_BYTES, Stored, store

#: The fields of a surviving record besides its document_id.
FIELDS = ("source_url", "raw_checksum", "canonical_checksum", "canonical_document_id")

#: A precedence is proven where its majority is over so many standard deviations of a fair draw.
PROVEN = 1.64

#: The three columns by which a membership may name its document.
REFERENCES = ("normalized_document_id", "canonical_document_id", "artifact_id")


def _filled(name: str) -> Column:
    return F.coalesce((F.col(name) != "").cast("int"), F.lit(0))


def field_states() -> dict[str, Column]:
    """A bounded set of states (at most 12 for each field) for each field of a document row."""
    score, warnings = F.col("quality_score"), F.col("warning_count")
    return {
        "has_text": F.col("has_text").cast("int"),
        "quality_score": F.when(score.isNull() | F.isnan(score), -1).otherwise(F.least(F.lit(10), F.greatest(F.lit(0), F.floor(score * 10)))).cast("int"),
        "warning_count": F.when(warnings.isNull(), -1).otherwise(F.least(F.lit(10), F.greatest(F.lit(0), warnings))).cast("int"),
    } | {name: F.col(f"has_{name}").cast("int") for name in FIELDS}


def document_rows(documents: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The narrow row that ranking needs, with the columns to ``keep``; texts are reduced to whether they are there."""
    return documents.where("document_id is not null").select(
        "document_id",
        "updated_at",
        "quality_score",
        "warning_count",
        (_filled("normalized_text") == 1).alias("has_text"),
        *[F.col(name).isNotNull().alias(f"has_{name}") for name in FIELDS],
        *REFERENCES,
        *[F.col(name).alias(f"value_{name}") for name in keep],
    )


def _small(table: Stored) -> DataFrame:
    """A written table, marked for broadcast where it is small."""
    return F.broadcast(table.df) if table.size_bytes() * 4 <= BROADCAST_LIMIT_BYTES else table.df


def transitions(rows: DataFrame) -> DataFrame:
    """``(field, before, after, n)``: in how many documents one state of a field precedes another.

    Learned from every document whose timestamped rows are in more than one
    state; no others take part beyond a first aggregation.  Rows are reduced to
    the time span of each state of a document, so a document with any number of
    rows yields a bounded number of transitions, and the result has at most 132
    rows for each field.
    """
    states = field_states()
    dated = rows.where("updated_at is not null").select("document_id", "updated_at", *[v.alias(f"state_{k}") for k, v in states.items()])
    vector = F.struct(*[f"state_{k}" for k in states])
    changing = store(dated.groupBy("document_id").agg(F.min(vector).alias("least"), F.max(vector).alias("most")).where("least <> most").select("document_id"), "changing")
    each = F.array(*[F.struct(F.lit(k).alias("field"), F.col(f"state_{k}").alias("state")) for k in states])
    spans = (
        dated.join(_small(changing), "document_id", "left_semi")
        .select("document_id", "updated_at", F.inline(each))
        .groupBy("document_id", "field", "state")
        .agg(F.min("updated_at").alias("first"), F.max("updated_at").alias("last"))
        .groupBy("document_id", "field")
        .agg(F.collect_list(F.struct("state", "first", "last")).alias("spans"))
        .where(F.size("spans") > 1)
    )
    later = spans.select("field", "spans", F.explode("spans").alias("b")).select("field", F.col("b.state").alias("after"), F.filter("spans", lambda a: a["last"] < F.col("b.first")).alias("older"))
    return later.select("field", "after", F.explode("older.state").alias("before")).groupBy("field", "before", "after").agg(F.count("*").alias("n"))


def topological_levels(moves: list[tuple[int, int, int]], proven: float = PROVEN) -> tuple[dict[int, float], float]:
    """The level of each state in [0, 1], and how consistent the moves ``(before, after, n)`` are.

    An edge leads from a state to a later one where the majority of their moves
    is proven.  States on a cycle share a level; a level is the longest path to
    it.  The second value is the share of moves along edges less that against
    them, 0 where nothing is proven.
    """
    states = sorted({x for a, b, _ in moves for x in (a, b)})
    at = {x: i for i, x in enumerate(states)}
    n = np.zeros((len(states), len(states)))
    for a, b, count in moves:
        n[at[a], at[b]] += count
    net, seen = n - n.T, n + n.T
    edge = (net > 0) & (net * net > proven * proven * seen)
    reach = edge | np.eye(len(states), dtype=bool)
    for k in range(len(states)):
        reach |= reach[:, k : k + 1] & reach[k : k + 1, :]
    same = reach & reach.T
    # The longest path over classes of states: those that reach more come first.
    level = np.zeros(len(states))
    for j in np.argsort(reach.sum(0), kind="stable"):
        before = np.flatnonzero(reach[:, j] & ~same[:, j])
        if before.size:
            level[j] = level[before].max() + 1
    total = n.sum()
    weight = float((net * edge * ~same).sum() / total) if total else 0.0
    return {x: float(level[i] / max(1.0, level.max())) for x, i in at.items()}, max(0.0, weight)


def learn_precedence(rows: DataFrame) -> dict[str, dict[int, float]]:
    """For each field the weighted level of its states; what is collected is bounded, see ``transitions``."""
    found: dict[str, list[tuple[int, int, int]]] = {}
    for r in transitions(rows).collect():
        found.setdefault(r.field, []).append((r.before, r.after, r.n))
    out = {}
    for name, moves in sorted(found.items()):
        levels, weight = topological_levels(moves)
        out[name] = {state: level * weight for state, level in levels.items()}
    return out


def currency(levels: dict[str, dict[int, float]]) -> Column:
    """How late a row's values are: the sum of the weighted levels of its states."""
    terms = [F.lit(0.0)]
    for name, state in field_states().items():
        known = [x for k, v in sorted(levels.get(name, {}).items()) if v for x in (F.lit(k), F.lit(v))]
        if known:
            terms.append(F.coalesce(F.try_element_at(F.create_map(*known), state), F.lit(0.0)))
    return reduce(lambda a, b: a + b, terms)


def current_rows(rows: DataFrame) -> DataFrame:
    """One valid row for each document: the topologically latest one.

    Dated rows are ordered by ``updated_at``, rows of the same date by their
    values.  A document with rows lacking a date takes the topologically latest
    of those and its latest dated row.  Rows that tie in both are ordered by
    their values, so the result does not depend on row order.
    """
    ranked = rows.withColumn("currency", currency(learn_precedence(rows)))
    values = F.struct(*[F.col(c) for c in ranked.columns if c not in ("document_id", "updated_at", "currency")])
    by_time = F.struct(F.col("updated_at").alias("at"), "currency", values.alias("v"))
    by_value = F.struct("currency", values.alias("v"))
    dated = F.col("updated_at").isNotNull()
    picked = ranked.groupBy("document_id").agg(F.max(F.when(dated, by_time)).alias("latest"), F.max(F.when(~dated, by_value)).alias("undated"))
    use_undated = F.col("undated").isNotNull() & (F.col("latest").isNull() | (F.col("undated.currency") > F.col("latest.currency")))
    return picked.select("document_id", F.when(use_undated, F.col("undated.v")).otherwise(F.col("latest.v")).alias("v")).select("document_id", "v.*")


def currency_trial(documents: DataFrame, parts: int = 5) -> DataFrame:
    """How often reasoning finds the latest row where the dates of some documents are hidden.

    A hash of the id hides all dates of one document in ``parts``; every other
    document is learned from.  One row: ``documents`` with hidden dates and more
    than one differing row, ``right`` and ``right_share`` of them, and
    ``chance``, the share that a blind choice would get right.
    """
    rows = document_rows(documents)
    hidden = rows.withColumn("updated_at", F.when(F.pmod(F.xxhash64("document_id"), F.lit(parts)) != 0, F.col("updated_at")))
    kept = [c for c in rows.columns if c not in ("document_id", "updated_at")]
    told = rows.where(F.pmod(F.xxhash64("document_id"), F.lit(parts)) == 0)
    # Rows that differ in nothing that is kept count once.
    truth = told.groupBy("document_id").agg(F.max(F.struct("updated_at", F.struct(*kept).alias("v"))).alias("t"), F.approx_count_distinct(F.struct(*kept), 0.01).alias("variants"), F.min(F.struct(*kept)).alias("least"), F.max(F.struct(*kept)).alias("most"))
    truth = truth.where("least <> most and t.updated_at is not null").select("document_id", F.col("t.v").alias("true_row"), F.greatest(F.lit(2), "variants").alias("variants"))
    chosen = current_rows(hidden).select("document_id", F.struct(*kept).alias("chosen"))
    judged = truth.join(chosen, "document_id").select((F.col("chosen") == F.col("true_row")).alias("right"), (1 / F.col("variants")).alias("chance"))
    n = F.count("*")
    return judged.agg(n.alias("documents"), F.count_if("right").alias("right"), (F.count_if("right") / n).alias("right_share"), (F.sum("chance") / n).alias("chance"))


def group_members(memberships: DataFrame, rows: DataFrame) -> DataFrame:
    """Distinct ``(group_id, document_id)``.

    A membership names its document by the one of three columns that is set; it
    refers to the column of that name in the documents.  Memberships without a
    group or a reference, and references to no document, give no member.
    """
    named = F.inline(F.array(*[F.struct(F.lit(i).alias("kind"), F.col(c).alias("ref")) for i, c in enumerate(REFERENCES)]))
    wanted = store(memberships.where("group_id is not null").select("group_id", named).where("ref is not null").distinct(), "wanted")
    known = rows.select("document_id", named).where("ref is not null")
    return known.join(_small(wanted), ["kind", "ref"]).select("group_id", "document_id").distinct()


def _supplied(members: DataFrame) -> DataFrame:
    """Which of the valid rows ``members(group_id, document_id, ...)`` supplies which field of its group."""
    score = F.when(F.isnan("quality_score"), None).otherwise(F.col("quality_score"))
    rank = F.struct(
        (~F.col("has_text")).alias("no_text"),
        score.isNull().alias("no_score"),
        (-F.coalesce(score, F.lit(0.0))).alias("score"),
        F.col("warning_count").isNull().alias("no_warnings"),
        F.coalesce("warning_count", F.lit(0)).alias("warnings"),
        F.col("document_id"),
    )
    best = members.select("group_id", rank.alias("rank"), *[f"has_{f}" for f in FIELDS]).groupBy("group_id").agg(
        F.min("rank").alias("document_id"), *[F.min(F.when(F.col(f"has_{f}"), F.col("rank"))).alias(f) for f in FIELDS]
    )
    return best.select(
        "group_id", F.inline(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f)["document_id"].alias("document_id")) for f in ("document_id", *FIELDS)]))
    ).where("document_id is not null")


def survivors(documents: DataFrame, memberships: DataFrame) -> DataFrame:
    """``(group_id, field_name, document_id)``: which member supplies which field.

    Members rank by a non-empty text, higher score (null and NaN last), fewer
    warnings (null last) and smaller id.  ``document_id`` names the first member,
    every other field the first member whose field is not null; a field that no
    member has gives no row.  Everything is kept in running minima, so a group
    of any size needs no sort and no single task.
    """
    rows = document_rows(documents)
    return _supplied(group_members(memberships, rows).join(current_rows(rows.drop(*REFERENCES)), "document_id"))


def surviving_records(documents: DataFrame, memberships: DataFrame) -> DataFrame:
    """One built record for each group: the values named by ``survivors``."""
    rows = document_rows(documents, keep=FIELDS)
    members = store(group_members(memberships, rows), "members").df
    valid = store(current_rows(rows.drop(*REFERENCES)), "valid-rows").df
    sources = _supplied(members.join(valid.drop(*[f"value_{f}" for f in FIELDS]), "document_id"))
    supplied = [F.struct(F.lit(f).alias("field_name"), F.col(f"value_{f}").alias("value")) for f in FIELDS]
    itself = F.struct(F.lit("document_id").alias("field_name"), F.col("document_id").alias("value"))
    values = valid.select("document_id", F.inline(F.array(itself, *supplied)))
    picked = values.join(sources, ["document_id", "field_name"])
    return picked.groupBy("group_id").agg(*[F.max(F.when(F.col("field_name") == f, F.col("value"))).alias(f) for f in ("document_id", *FIELDS)])
