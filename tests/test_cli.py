from __future__ import annotations

import json

from pyspark.sql import functions as F

from corpusflow.cli import COMMANDS, main
from corpusflow.operators import pool


def test_all_commands_are_there():
    assert len(COMMANDS) == 17


def test_select_audit_export(spark, tmp_path, capsys):
    p = lambda x: str(tmp_path / x)
    rows = [(f"c{k}", "en" if k % 2 else "fr", f"i{k}", f"g{k}", "f1", f"s{k}", "normal", "training") for k in range(6)]
    spark.createDataFrame(rows, ", ".join(f"{c} string" for c in pool.POOL)).write.parquet(p("pool"))
    (tmp_path / "policy.json").write_text(json.dumps({"target_count": 2, "language_quotas": {"en": 1, "fr": 1}}))
    assert main(["freeze-pool", "--pool", p("pool"), "--output", p("frozen.json")], spark) == 0
    assert main(["select", "--pool", p("pool"), "--policy", p("policy.json"), "--output", p("selection.json")], spark) == 0
    chosen = json.loads((tmp_path / "selection.json").read_text())["selected_ids"]
    conversations = spark.createDataFrame([(c, "i", "standard", "QUALITY_CANDIDATE", "training", 2, 2) for c in chosen], "conversation_id string, image_id string, profile string, status string, purpose string, n_turns int, committed_turns int")
    conversations.write.parquet(p("conversations"))
    spark.createDataFrame([(c, k, r, f"{c}{k}") for c in chosen for k, r in enumerate(("user", "assistant"))], "conversation_id string, position int, role string, content string").write.parquet(p("messages"))
    spark.createDataFrame([(c, "PASS") for c in chosen], "conversation_id string, aggregate string").write.parquet(p("ratings"))
    out = ["export", "--conversations", p("conversations"), "--messages", p("messages"), "--ratings", p("ratings"), "--selection", p("selection.json"), "--destination", p("export")]
    assert main(out, spark) == 3 and "AUDIT_REQUIRED" in capsys.readouterr().err
    assert main(["audit", "--pool", p("pool"), "--policy", p("policy.json"), "--selection", p("selection.json"), "--output", p("audit.json")], spark) == 0
    assert main(out, spark) == 0 and spark.read.text(p("export/training")).count() == 2
    (tmp_path / "hard.json").write_text(json.dumps({"target_count": 9, "language_quotas": {"en": 1}}))
    assert main(["select", "--pool", p("pool"), "--policy", p("hard.json"), "--output", p("no.json")], spark) == 3
    assert "SELECTION_INFEASIBLE" in capsys.readouterr().err


def test_fixtures_and_capabilities(spark, tmp_path, capsys):
    p = lambda x: str(tmp_path / x)
    assert main(["make-fixtures", "--destination", p("f"), "--languages", "en", "ja", "--pairs", "1"], spark) == 0
    votes = spark.read.parquet(p("f")).select("fixture_id", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("judge"), F.when(F.col("expected_accept"), "MET").otherwise("UNKNOWN").alias("verdict"))
    votes.write.parquet(p("v"))
    capsys.readouterr()
    assert main(["evaluate-capabilities", "--fixtures", p("f"), "--votes", p("v")], spark) == 0
    strata = json.loads(capsys.readouterr().out)["strata"]
    assert len(strata) == 16 and all(s["total"] == 4 and s["correct"] == 2 and s["unknown"] == 2 for s in strata)


def test_ledger_commands(spark, tmp_path, capsys):
    p = lambda x: str(tmp_path / x)
    spark.sql("select 1L as seq, 's' as stage, 'm' as model_repo, 1L as input_tokens, 2L as output_tokens, 'COMPLETE' as status, sha2('x', 256) as response_hash, timestamp '2024-01-01' as created_at").write.parquet(p("run/ledger"))
    spark.sql("select sha2('x', 256) as digest, cast('x' as binary) as content").write.parquet(p("run/blobs"))
    assert main(["profile", "--ledger", p("run/ledger")], spark) == 0
    assert main(["replay", "--ledger", p("run/ledger"), "--blobs", p("run/blobs")], spark) == 0
    assert main(["backup", "--source", p("run"), "--destination", p("copy")], spark) == 0
    assert main(["restore", "--source", p("copy"), "--destination", p("copy")], spark) == 3
    spark.sql("select sha2('x', 256) as digest, cast('y' as binary) as content").write.parquet(p("bad"))
    assert main(["replay", "--ledger", p("run/ledger"), "--blobs", p("bad")], spark) == 3
    assert "LEDGER_DAMAGED" in capsys.readouterr().err
    assert main(["doctor"], spark) == 0
    (tmp_path / "c.yaml").write_text("a: 1\n")
    assert main(["compile", "--config", p("c.yaml"), "--output", p("plan.json")], spark) == 0
