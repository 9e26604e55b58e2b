"""Command line: ``python -m corpusflow.cli COMMAND ...``. Tables are Parquet paths; reports are JSON.

An error is one line of JSON on standard error and an exit code by its kind.
"""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import asdict, fields
from importlib import import_module
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions import catalogs, hashing, pixels
from corpusflow.functions.text import RejectedJson
from corpusflow.operators import consensus, eligibility, ledger, pool
from corpusflow.plans import ingest, synthesis
from corpusflow.session import local_session
from corpusflow.sources import files, readers, writers

EXIT_CODES = {ValueError: 2, RejectedJson: 3, eligibility.ManifestError: 3, PermissionError: 4, RuntimeError: 5}


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _policy(path: str) -> pool.Policy:
    known = {f.name for f in fields(pool.Policy)}
    given = readers.read_json(path)
    if set(given) - known:
        raise eligibility.ManifestError("POLICY_FIELD", ", ".join(sorted(set(given) - known)))
    return pool.Policy(**given)


def compile_(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Resolve the configuration and the catalogs and write both with their identity."""
    body = {"configuration": readers.load_yaml(a.config), "tasks": [list(t[:3]) + [list(t[3])] for t in catalogs.tasks()], "rubric": [list(r) for r in catalogs.rubric()], "stages": list(catalogs.STAGES)}
    body["compiled_hash"] = hashing.canonical_hash(body)
    writers.write_json(body, a.output)
    return {"output": a.output, "compiled_hash": body["compiled_hash"]}


def prepare(spark: SparkSession, a: argparse.Namespace) -> dict:
    """A hash-ranked sample of eligible validation rows of a local metadata file."""
    m = readers.read_metadata(spark, a.metadata, ["ImageID", "Subset", "License", "Author", "OriginalLandingURL", "OriginalURL", "Thumbnail300KURL", "Rotation"])
    picked = eligibility.hash_sample(m.where(eligibility.validation_eligible()), "ImageID", a.count, a.seed)
    picked.withColumn("rotation_degrees", eligibility.validation_rotation(F.col("Rotation"))).write.parquet(a.destination)
    return {"sampled": _read(spark, a.destination).count(), "destination": a.destination}


def prepare_local_train(spark: SparkSession, a: argparse.Namespace) -> dict:
    """A training sample of a local metadata file without evaluation ids, and the counts of skipped rows."""
    m = readers.read_metadata(spark, a.metadata, [f.name for f in eligibility.METADATA])
    excluded = _read(spark, a.excluded).select("image_id") if a.excluded else spark.createDataFrame([], "image_id string")
    probe = files.probe(a.image_root) if a.image_root else None
    named = m.withColumn("image_path", F.concat("ImageID", F.lit(".jpg"))) if probe else m
    picked = eligibility.train_sample(named, excluded, a.count, a.seed, probe)
    picked.write.parquet(f"{a.destination}/metadata")
    marked = m.join(excluded.distinct().withColumn("__x", F.lit(True)), m["ImageID"] == excluded["image_id"], "left")
    counts = eligibility.reason_counts(marked.withColumn("reason", eligibility.train_reason(F.coalesce(F.col("__x"), F.lit(False)))))
    return {"sampled": a.count, "rows": {r["reason"]: r["n"] for r in counts.collect()}}


def doctor(spark: SparkSession, a: argparse.Namespace) -> dict:
    """What this session has."""
    return {"spark": spark.version, "parallelism": spark.sparkContext.defaultParallelism, "pillow": pixels.Image is not None, "checkpoint_dir": spark.sparkContext.getConf().get("spark.checkpoint.dir")}


def profile(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Timings of a call ledger."""
    calls = readers.read_ledger(spark, a.ledger)
    whole = ledger.wall(calls).first().asDict()
    if not whole["completed_calls"]:
        raise eligibility.ManifestError("PROFILE_CALLS_MISSING", a.ledger)
    return whole | {"stages": [r.asDict() for r in ledger.profile(calls).collect()]}


def make_fixtures(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Answer-keyed cases."""
    readers.fixtures(spark, a.languages, a.pairs, a.seed).write.parquet(a.destination)
    return {"fixtures": _read(spark, a.destination).count()}


def evaluate_capabilities(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Counts by split and stratum from fixtures and two judges' votes on them."""
    votes = consensus.paired(_read(spark, a.votes), ["fixture_id"])
    out = consensus.capability_report(_read(spark, a.fixtures).join(votes, "fixture_id"))
    return {"strata": [r.asDict() for r in out.orderBy("split", "stratum").collect()]}


def run_ingest(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Sources and rights to images, groups and splits."""
    sources, rights = _read(spark, a.sources), _read(spark, a.rights)
    if a.decoded:
        decoded = _read(spark, a.decoded)
    else:
        found = readers.read_images(spark, a.image_root, sources.select("source_id", "image_path", "rotation_degrees"))
        decoded = pixels.decode(found)
    at = F.to_timestamp(F.lit(a.at)) if a.at else F.current_timestamp()
    images, failures = ingest.ingest(sources, rights, decoded, at, _read(spark, a.vectors) if a.vectors else None, a.threshold, a.seed)
    images.write.parquet(f"{a.destination}/images")
    failures.write.parquet(f"{a.destination}/failures")
    images, failures = _read(spark, f"{a.destination}/images"), _read(spark, f"{a.destination}/failures")
    return {"images": images.count(), "failures": failures.count(), "manifest_hash": ingest.manifest_hash(images, failures)}


def _backend(name: str) -> Any:
    module, _, attribute = name.partition(":")
    return getattr(import_module(module), attribute)


def synthesize(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Turns of all jobs by a backend given as ``module:factory``, and the conversations' states."""
    turns = synthesis.synthesize(_read(spark, a.jobs), _read(spark, a.evidence), _backend(a.backend), ledger=f"{a.destination}/calls")
    turns.write.parquet(f"{a.destination}/turns")
    states = synthesis.finish(_read(spark, f"{a.destination}/turns"))
    states.write.parquet(f"{a.destination}/conversations")
    return {r["status"]: r["n"] for r in _read(spark, f"{a.destination}/conversations").groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect()}


def rate_existing(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Statuses of turns from recorded votes and checks."""
    synthesis.rate_turns(_read(spark, a.votes), _read(spark, a.checks) if a.checks else None).write.parquet(a.destination)
    return {"turns": _read(spark, a.destination).count()}


def freeze_pool(spark: SparkSession, a: argparse.Namespace) -> dict:
    """The identity of a pool."""
    out = {"pool_hash": pool.pool_hash(_read(spark, a.pool)), "candidates": _read(spark, a.pool).count()}
    writers.write_json(out, a.output)
    return out


def select(spark: SparkSession, a: argparse.Namespace) -> dict:
    """A feasible selection; infeasible and undecided ones are different errors."""
    df = _read(spark, a.pool)
    found = pool.select_candidates(df, _policy(a.policy))
    if found.status != "OPTIMAL":
        raise eligibility.ManifestError("SELECTION_INFEASIBLE" if found.status == "INFEASIBLE" else "SELECTION_UNKNOWN", found.status)
    out = {"pool_hash": pool.pool_hash(df), "selected_ids": list(found.selected_ids), "solver_status": found.status}
    writers.write_json(out, a.output)
    return {"selected": len(found.selected_ids), "output": a.output}


def audit(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Recount a selection; a clean one is written back bound to its report."""
    df, policy, chosen = _read(spark, a.pool), _policy(a.policy), readers.read_json(a.selection)
    frozen, ids = pool.pool_hash(df), chosen["selected_ids"]
    report = pool.audit(df, spark.createDataFrame([(x,) for x in ids], "conversation_id string"), policy, frozen == chosen["pool_hash"])
    digest = pool.report_hash(report, frozen, ids, policy)
    writers.write_json(report | {"audit_hash": digest, "policy": asdict(policy)}, a.output)
    bound = pool.bind(pool.Selection(tuple(ids), chosen["solver_status"]), frozen, report, digest)
    writers.write_json(bound, a.selection)
    return {"status": report["status"], "audit_hash": digest}


def export(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Four folders of JSON lines for an audited selection."""
    chosen = readers.read_json(a.selection)
    manifest = {k: chosen[k] for k in ("pool_hash", "selected_ids", "solver_status")}
    if chosen.get("audit_hash") != hashing.canonical_hash({"selection": manifest, "audit_report_hash": chosen.get("audit_report_hash")}):
        raise eligibility.ManifestError("AUDIT_REQUIRED", a.selection)
    ids = spark.createDataFrame(list(enumerate(chosen["selected_ids"])), "ordinal int, conversation_id string")
    conversations = _read(spark, a.conversations).withColumn("audit_hash", F.lit(chosen["audit_hash"]))
    selected = ids.join(conversations, "conversation_id")
    bad = selected.withColumn("__r", pool.export_reason()).where("__r is not null").limit(1).collect()
    if bad:
        raise eligibility.ManifestError(bad[0]["__r"], bad[0]["conversation_id"])
    writers.export_bundle(selected.select("ordinal", "conversation_id", "image_id"), _read(spark, a.messages), _read(spark, a.ratings), conversations, a.destination)
    return {"exported": ids.count(), "destination": a.destination}


def replay(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Integrity of a ledger and its blobs."""
    out = ledger.verify(_read(spark, a.blobs), readers.read_ledger(spark, a.ledger)).first().asDict()
    if out["corrupt"] or out["missing_responses"]:
        raise eligibility.ManifestError("LEDGER_DAMAGED", json.dumps(out))
    return out


def backup(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Copy ledger and blobs to a place that has none."""
    writers.copy_run(spark, a.source, a.destination)
    return {"destination": a.destination}


#: Commands: function, then arguments as (name, default); ``...`` marks a required one.
COMMANDS: dict[str, tuple] = {
    "compile": (compile_, [("config", ...), ("output", ...)]),
    "prepare": (prepare, [("metadata", ...), ("destination", ...), ("count", 32), ("seed", hashing.SEED)]),
    "prepare-local-train": (prepare_local_train, [("metadata", ...), ("destination", ...), ("excluded", ""), ("image-root", ""), ("count", 32), ("seed", hashing.SEED)]),
    "doctor": (doctor, []),
    "profile": (profile, [("ledger", ...)]),
    "make-fixtures": (make_fixtures, [("destination", ...), ("languages", ["en"]), ("pairs", 2), ("seed", hashing.SEED)]),
    "evaluate-capabilities": (evaluate_capabilities, [("fixtures", ...), ("votes", ...)]),
    "ingest": (run_ingest, [("sources", ...), ("rights", ...), ("destination", ...), ("image-root", ""), ("decoded", ""), ("vectors", ""), ("threshold", 0.95), ("at", ""), ("seed", hashing.SEED)]),
    "synthesize": (synthesize, [("jobs", ...), ("evidence", ...), ("backend", ...), ("destination", ...)]),
    "rate-existing": (rate_existing, [("votes", ...), ("checks", ""), ("destination", ...)]),
    "freeze-pool": (freeze_pool, [("pool", ...), ("output", ...)]),
    "select": (select, [("pool", ...), ("policy", ...), ("output", ...)]),
    "audit": (audit, [("pool", ...), ("policy", ...), ("selection", ...), ("output", ...)]),
    "export": (export, [("conversations", ...), ("messages", ...), ("ratings", ...), ("selection", ...), ("destination", ...)]),
    "replay": (replay, [("ledger", ...), ("blobs", ...)]),
    "backup": (backup, [("source", ...), ("destination", ...)]),
    "restore": (backup, [("source", ...), ("destination", ...)]),
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="corpusflow", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)
    for name, (f, arguments) in COMMANDS.items():
        p = commands.add_parser(name, help=f.__doc__)
        for arg, default in arguments:
            if default is ...:
                p.add_argument(f"--{arg}", required=True)
            elif isinstance(default, list):
                p.add_argument(f"--{arg}", nargs="+", default=default)
            else:
                p.add_argument(f"--{arg}", type=type(default), default=default)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    try:
        print(json.dumps(COMMANDS[a.command][0](spark or local_session(), a), default=str, ensure_ascii=False))
        return 0
    except Exception as e:
        code = next((c for kind, c in EXIT_CODES.items() if type(e) is kind), 1)
        print(json.dumps({"error": getattr(e, "code", type(e).__name__), "message": str(e)[:500]}), file=sys.stderr)
        return code


if __name__ == "__main__":
    sys.exit(main())
