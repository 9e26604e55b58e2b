"""Two-judge consensus, overrides, applicable rubric items, gate aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.catalogs import PREDICATES, rubric_table
from corpusflow.functions.hashing import json_column


def agree(a: Column, b: Column, n: Column | None = None) -> Column:
    """ERROR unless there are two votes without an error; an agreed MET or NOT_MET; else UNKNOWN."""
    missing = a.isNull() | b.isNull()
    wrong = missing | (a == "ERROR") | (b == "ERROR") | ((n != 2) if n is not None else F.lit(False))
    return F.when(wrong, "ERROR").when((a == b) & a.isin("MET", "NOT_MET"), a).otherwise("UNKNOWN")


def paired(votes: DataFrame, keys: list[str]) -> DataFrame:
    """Consensus of all votes of a key: keys, n_votes, verdict. Only counts are kept, however many votes there are."""
    count = lambda v: F.sum((F.col("verdict") == v).cast("int"))
    g = votes.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_votes"), count("MET").alias("__met"), count("NOT_MET").alias("__not"), count("ERROR").alias("__err"), F.count("verdict").alias("__some"))
    wrong = (F.col("n_votes") != 2) | (F.col("__err") > 0) | (F.col("__some") < 2)
    return g.select(*keys, "n_votes", F.when(wrong, "ERROR").when(F.col("__met") == 2, "MET").when(F.col("__not") == 2, "NOT_MET").otherwise("UNKNOWN").alias("verdict"))


def question_fit(*verdicts: Column) -> Column:
    """Any NOT_MET fails, all MET fit, else UNKNOWN."""
    any_not, all_met = F.lit(False), F.lit(True)
    for v in verdicts:
        any_not, all_met = any_not | v.eqNullSafe("NOT_MET"), all_met & v.eqNullSafe("MET")
    return F.when(any_not, "NOT_MET").when(all_met, "MET").otherwise("UNKNOWN")


def overridden(template: Column, verdict: Column, coverage: Column, computation: Column, set_check: Column) -> Column:
    """A consensus corrected by what the engine checks itself.

    Coverage must agree with the claims' coverage. A computation that isn't MET replaces
    the vote. A set check that failed replaces it too; a missing one only blocks a pass.
    """
    sets = F.when(set_check.isNull() & (verdict == "MET"), "UNKNOWN").when(set_check.eqNullSafe("NOT_MET"), "NOT_MET").otherwise(verdict)
    computed = F.when(computation.isNotNull() & (computation != "MET"), computation).otherwise(verdict)
    return F.when(template == "C_COVERAGE", agree(verdict, coverage)).when(template == "C_COMPUTATION", computed).when(template == "C_SET_COMPLETE", sets).otherwise(verdict)


def applicable(context: DataFrame) -> DataFrame:
    """Rubric items that apply to each turn: the context's columns and template_id, axis, input_scope, use.

    The rubric is 28 rows; its predicates are written out as one condition of the join.
    """
    items = rubric_table(context.sparkSession)
    test = F.lit(False)
    for name, sql in PREDICATES.items():
        test = test | ((F.col("applies_when") == name) & F.coalesce(F.expr(sql), F.lit(False)))
    return context.join(F.broadcast(items), test).drop("applies_when")


#: Items with a subject for each entry of a list of the context.
SUBJECTS = {"R_REQUIREMENT": "requirements", "F_FORMAT": "format_requirements", "C_CLAIM": "claims", "H_BINDING": "history_binding_ids"}


def with_subjects(items: DataFrame) -> DataFrame:
    """One row per item and subject; items without a list have the one subject ``turn``."""
    lists = None
    for template, column in SUBJECTS.items():
        lists = F.when(F.col("template_id") == template, F.col(column)) if lists is None else lists.when(F.col("template_id") == template, F.col(column))
    return items.withColumn("subject_id", F.explode(F.coalesce(lists, F.array(F.lit("turn")))))


def item_id(attempt: Column, context_hash: Column) -> Column:
    """Identity of a rubric item of a turn."""
    return F.sha2(json_column(conversation_id=F.col("conversation_id").cast("string"), turn_index=F.col("turn_index"), attempt=attempt, template_id=F.col("template_id"), subject_id=F.col("subject_id"), context_hash=context_hash), 256)


def gate_aggregate(items: DataFrame, keys: list[str]) -> DataFrame:
    """ERROR before FAIL before ABSTAIN before PASS over the gates of each key; annotations don't count."""
    order = F.when(F.col("verdict") == "ERROR", 3).when(F.col("verdict") == "NOT_MET", 2).when(F.col("verdict").isin("UNKNOWN", "NOT_EVALUATED"), 1).otherwise(0)
    worst = F.max(F.when(F.col("use") == "gate", order).otherwise(0))
    return items.groupBy(*keys).agg(worst.alias("__w"), F.count(F.lit(1)).alias("n_items")).select(*keys, "n_items", F.element_at(F.array(*map(F.lit, ("PASS", "ABSTAIN", "FAIL", "ERROR"))), F.col("__w") + 1).alias("aggregate"))


def capability_report(outcomes: DataFrame) -> DataFrame:
    """Per split and stratum: total, correct, unknown. ``outcomes`` has split, stratum, expected_accept, verdict."""
    decided = F.col("verdict").isin("MET", "NOT_MET")
    correct = decided & ((F.col("verdict") == "MET") == F.col("expected_accept"))
    return outcomes.groupBy("split", "stratum").agg(F.count(F.lit(1)).alias("total"), F.sum(correct.cast("long")).alias("correct"), F.sum((~decided).cast("long")).alias("unknown"))
