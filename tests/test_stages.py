"""Stages with a memo: no recorded call is made again, malformed output is asked again, failed answers are repaired once."""

import hashlib
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusflow.operators.eligibility import ManifestError
from corpusflow.plans import stages, synthesis
from corpusflow.sources.commit_log import CommitLog

KEYS = ["conversation_id", "turn_index"]


class Noting:
    """A model double that notes each call in a file of its own, and answers by rules."""

    def __init__(self, notes, stop=None):
        self.notes, self.stop = Path(notes), stop

    def run(self, stage: str, rows: pd.DataFrame) -> pd.DataFrame:
        if stage == self.stop and len(rows):
            raise RuntimeError("stopped")
        for r in rows.itertuples():
            name = hashlib.sha256(repr((r.call, r.conversation_id, r.turn_index, r.attempt, r.seed)).encode()).hexdigest()
            with (self.notes / name).open("a") as f:
                f.write(f"{r.call} {r.conversation_id} {r.turn_index} {r.attempt} {r.seed} {r.hint!r}\n")
        return rows.assign(output=[self.answer(stage, r) for r in rows.itertuples()], output_tokens=[7] * len(rows))

    def answer(self, stage, r):
        c = r.conversation_id
        if c == "empty" or (c == "twice" and r.attempt < 2 and stage == "question_generation"):
            return "  "
        if stage == "holistic_review":
            if c == "verdict" and r.attempt == 0:
                return "perhaps"
            return "NOT_MET" if c == "bad" or (c == "mended" and "repair" not in r.answer) else "MET"
        return f"{stage} {c} {r.turn_index}"


def lines(notes):
    return sorted(x for p in notes.iterdir() for x in p.read_text().splitlines())


def start(spark):
    names = ("good", "bad", "mended", "twice", "empty", "verdict")
    jobs = spark.createDataFrame([(c, f"i{c}", 2) for c in names], "conversation_id string, image_id string, planned_turns int")
    evidence = spark.createDataFrame([(f"i{c}", ["visible_entity"], []) for c in names], "image_id string, capabilities array<string>, visible_scopes array<string>")
    return jobs, evidence


def test_a_stopped_synthesis_goes_on_without_a_second_call(spark, tmp_path):
    notes, table = tmp_path / "notes", str(tmp_path / "calls")
    notes.mkdir()
    jobs, evidence = start(spark)
    said = str(notes)
    for stage in ("answer_generation", "answer_repair"):
        with pytest.raises(Exception, match="stopped"):
            synthesis.synthesize(jobs, evidence, lambda stage=stage: Noting(said, stage), 2, table)
        assert lines(notes)
    rows = synthesis.synthesize(jobs, evidence, lambda: Noting(said), 2, table).collect()
    made = lines(notes)
    assert len(made) == len(set(made)) and all(len(p.read_text().splitlines()) == 1 for p in notes.iterdir())
    got = {(r["conversation_id"], r["turn_index"]): (r["status"], r["repaired"], r["failure"]) for r in rows}
    assert got[("good", 2)] == ("COMMITTED", False, None) and got[("twice", 2)] == ("COMMITTED", False, None) and got[("verdict", 1)][0] == "COMMITTED"
    assert got[("bad", 1)] == ("REJECTED", True, None) and ("bad", 2) not in got
    assert got[("mended", 1)] == ("COMMITTED", True, None)
    assert got[("empty", 1)][0::2] == ("ERROR", "MODEL_CONTENT_EMPTY") and ("empty", 2) not in got
    attempts = [x.split(" ", 5) for x in made if x.startswith("question_generation twice 1")]
    assert [(a[3], int(a[4]) - int(attempts[0][4])) for a in attempts] == [("0", 0), ("1", 100_000), ("2", 200_000)]
    assert attempts[0][5] == "''" and "empty" in attempts[1][5]
    before = len(made)
    again = synthesis.synthesize(jobs, evidence, lambda: Noting(said), 2, table).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, rows)) and len(lines(notes)) == before
    assert sum(x.startswith("answer_repair bad") for x in made) == 1


def test_budget_of_requests_and_tokens(spark, tmp_path):
    notes, table = tmp_path / "notes", str(tmp_path / "calls")
    notes.mkdir()
    said = str(notes)
    rows = spark.createDataFrame([(f"c{k}", 1) for k in range(10)], "conversation_id string, turn_index int")
    log = CommitLog(spark, table)
    with pytest.raises(ManifestError, match="REQUEST_BUDGET_EXHAUSTED"):
        stages.run_stage(log, rows, "question_generation", lambda: Noting(said), limits=stages.Limits(requests=4))
    assert stages.used(log) == (4, 28) and len(lines(notes)) == 4
    with pytest.raises(ManifestError, match="OUTPUT_TOKEN_BUDGET_EXHAUSTED"):
        stages.run_stage(log, rows, "question_generation", lambda: Noting(said), limits=stages.Limits(tokens=28 + 3 * 50 + 10, tokens_per_call=50))
    assert stages.used(log) == (7, 49)
    out = stages.run_stage(log, rows, "question_generation", lambda: Noting(said))
    assert out.where("output is not null and failure is null").count() == 10 and len(set(lines(notes))) == len(lines(notes)) == 10


def test_first_of_a_hash_is_the_same_however_dealt(spark):
    rows = spark.createDataFrame([(f"c{k % 50}", k // 50) for k in range(200)], "conversation_id string, turn_index int")
    for n in (0, 1, 17, 200, 999):
        got = [sorted(map(tuple, stages._first(rows.repartition(p), n).collect())) for p in (1, 5)]
        assert got[0] == got[1] and len(got[0]) == min(n, 200)


def test_no_rows(spark, tmp_path):
    rows = spark.createDataFrame([], "conversation_id string, turn_index int")
    log = CommitLog(spark, str(tmp_path / "t"))
    assert stages.run_stage(log, rows, "question_generation", lambda: None).count() == 0 and log.version() == 0
    assert stages.malformed("x", F.lit("a")) is not None
