"""The task and rubric catalogs as small tables, checked when they are loaded."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Tasks in catalog order with the capabilities they need; each family has four.
FAMILIES = ("observation_attribute", "spatial_comparison", "visible_count", "ocr_reading", "document_chart", "grounded_calculation")
TASKS = """
object_identification visible_entity
attribute_lookup visible_entity visible_attribute
region_description bounded_region
visual_summary multiple_visible_facts
relation_lookup two_entities spatial_relation
attribute_comparison two_entities comparable_attribute
spatial_ordering multiple_entities spatial_relation
correspondence_matching visible_mapping
visible_count bounded_complete_scope countable_entities
conditional_selection multiple_entities visible_attribute
exclusion_selection multiple_entities bounded_complete_scope
attribute_grouping multiple_entities visible_attribute
text_transcription readable_text
text_field_extraction readable_text text_fields
text_reading_order readable_text text_layout
label_value_linking readable_text visible_mapping
table_lookup readable_table
table_selection readable_table
chart_lookup readable_chart
chart_comparison readable_chart comparable_series
grounded_sum readable_numbers compatible_units
grounded_difference readable_numbers compatible_units
grounded_product_quotient readable_numbers typed_numeric_operands
table_aggregation readable_table compatible_units
"""

# Rubric items as template, axis, predicate, input scope, use.
RUBRIC = """
F_Q_CLEAR format always TEXT_HQ gate
R_CORE relevance always TEXT_HQA gate
R_FOCUS relevance always TEXT_HQA annotate
V_LINEAGE visual_dependency always VISION_IHQA gate
I_REFERENT image_correspondence always VISION_IHQ gate
I_TASK_SUPPORT image_correspondence always VISION_IHQ gate
I_CONTEXT_FIT image_correspondence always VISION_IHQ gate
C_COVERAGE factual_correctness always TEXT_HQA gate
U_NO_OVERCLAIM uncertainty always VISION_IHQA gate
S_POLICY safety always VISION_IHQA gate
S_PII safety always VISION_IHQA gate
S_INJECTION safety always VISION_IHQA gate
L_Q_TARGET format always TEXT_HQ gate
F_PUBLIC_NATURAL format always TEXT_HQA gate
F_A_CLEAR format natural_language_answer TEXT_HQA gate
F_REDUNDANCY format natural_language_answer TEXT_HQA annotate
L_A_TARGET format answer_has_non_exempt_natural_language TEXT_HQA gate
F_FORMAT format public_format_constraint RULE gate
R_REQUIREMENT relevance each_public_requirement TEXT_HQA gate
C_CLAIM factual_correctness each_factual_claim CLAIM_IHQA gate
C_COMPUTATION factual_correctness has_computation RULE gate
C_SET_COMPLETE factual_correctness exhaustive_request VISION_IHQA gate
H_CONSISTENCY history has_history TEXT_HQA gate
H_TURN_PROGRESS history later_turn VISION_IHQA gate
H_BINDING history has_history_binding VISION_IHQA gate
H_WITNESS history designated_strong_dependency_turn VISION_IHQA gate
U_LIMIT uncertainty limitation_profile VISION_IHQA gate
U_FALSE_PREMISE uncertainty false_premise_profile VISION_IHQA gate
"""
HOLISTIC = ("Q_HOLISTIC", "factual_correctness", "holistic", "VISION_IHQA", "gate")

# Predicate of the rubric, and the test of a turn's context that it stands for.
PREDICATES = {
    "always": "true",
    "natural_language_answer": "has_natural_language_answer",
    "answer_has_non_exempt_natural_language": "has_natural_language_answer",
    "has_history": "turn_index > 1",
    "later_turn": "turn_index > 1",
    "has_history_binding": "size(history_binding_ids) > 0",
    "has_computation": "size(computation_ids) > 0",
    "limitation_profile": "profile = 'limitation'",
    "false_premise_profile": "profile = 'false_premise'",
    "designated_strong_dependency_turn": "requires_witness_check",
    "exhaustive_request": "size(exhaustive_scope_ids) > 0",
    "public_format_constraint": "size(format_requirements) > 0",
    "each_public_requirement": "size(requirements) > 0",
    "each_factual_claim": "size(claims) > 0",
}

# Model-call stages and the fields that each may see.
STAGE_FIELDS = {
    "evidence_extraction": "image_id capability_vocabulary image_views",
    "instruction_selection": "target_language public_history candidates image_views",
    "question_generation": "target_language turn_index public_history selected_instruction image_views",
    "question_fit": "target_language public_history selected_instruction question image_views",
    "requirement_extraction": "target_language public_history question question_message_id",
    "answer_generation": "target_language public_history question active_requirements image_views",
    "answer_repair": "target_language public_history question candidate_answer failed_criteria active_requirements image_views",
    "claim_inventory": "target_language public_history question candidate_answer answer_tokens",
    "computation_inventory": "target_language public_history question candidate_answer image_views",
    "set_inventory": "target_language public_history question candidate_answer image_views",
    "holistic_review": "target_language public_history question candidate_answer image_views",
    "rubric_item": "target_language public_history question candidate_answer image_views criterion target_claim typed_rule_inputs target_requirement candidate_claim_inventory",
}
STAGES = tuple(STAGE_FIELDS)
# Fields that no stage may see.
FORBIDDEN_FIELDS = ("dataset_annotations", "dataset_title", "future_history", "gold_answer", "other_judge", "other_judge_verdict", "quota_deficit", "generation_model")
#: What a rubric item of each input scope may see besides language, history, question and criterion.
SCOPES = {
    "TEXT_HQ": (),
    "TEXT_HQA": ("candidate_answer",),
    "VISION_IHQ": ("image_views",),
    "VISION_IHQA": ("candidate_answer", "image_views"),
    "CLAIM_IHQA": ("candidate_answer", "image_views", "target_claim"),
    "RULE": ("candidate_answer", "typed_rule_inputs"),
}
VERDICTS = ("MET", "NOT_MET", "UNKNOWN", "NOT_APPLICABLE", "NOT_EVALUATED", "ERROR")


@cache
def tasks() -> tuple[tuple[int, str, str, tuple[str, ...]], ...]:
    """(position, task, family, required capabilities); 24 different tasks."""
    lines = [x.split() for x in TASKS.strip().splitlines()]
    if len(lines) != 24 or len({x[0] for x in lines}) != 24:
        raise ValueError("the catalog needs 24 different tasks")
    return tuple((n, x[0], FAMILIES[n // 4], tuple(x[1:])) for n, x in enumerate(lines))


@cache
def capabilities() -> tuple[str, ...]:
    """Capabilities that some task needs, sorted."""
    return tuple(sorted({c for t in tasks() for c in t[3]}))


@cache
def rubric() -> tuple[tuple[str, ...], ...]:
    """(template, axis, predicate, scope, use): 28 items, of which 26 are gates, over known axes and predicates."""
    rows = tuple(tuple(x.split()) for x in RUBRIC.strip().splitlines())
    if len(rows) != 28 or len({r[0] for r in rows}) != 28 or sum(r[4] == "gate" for r in rows) != 26:
        raise ValueError("the rubric needs 28 different items, 26 of them gates")
    if any(r[2] not in PREDICATES or r[3] not in SCOPES for r in rows) or len({r[1] for r in rows}) != 8:
        raise ValueError("an item has an unknown predicate, scope or axis")
    return rows


def tasks_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(n, t, f, list(c)) for n, t, f, c in tasks()], "position int, task_id string, family string, required array<string>")


def rubric_table(spark: SparkSession, holistic: bool = False) -> DataFrame:
    rows = [*rubric(), *([HOLISTIC] if holistic else [])]
    return spark.createDataFrame(rows, "template_id string, axis string, applies_when string, input_scope string, use string")
