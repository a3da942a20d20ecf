"""The full refresh from files to checked marts in one call, with a gate after each step."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from lakemart.operators.checks import gate, report_document, run_contract
from lakemart.operators.model_tests import ModelTest
from lakemart.plans import warehouse
from lakemart.plans.model_suite import declared_tests
from lakemart.sources.contract import COMMERCE_CONTRACT, Contract
from lakemart.sources.csv_files import contract_frames, report_name, write_report
from lakemart.sources.lake import Lake
from lakemart.sources.profile_report import profile_directory, write_profile
from lakemart.sources.raw_load import load_raw, reconcile_raw

STEPS = ("profile", "validate", "load", "reconcile", "build and test", "check")


def full_refresh(
    lake: Lake, data_dir: str, report_dir: str, contract: Contract = COMMERCE_CONTRACT, tests: Sequence[ModelTest] | None = None,
    profile: bool = True,
) -> dict[str, dict]:
    """Profile, validate, load, reconcile, build and test, check; returns the tallies of each gate.

    A step with an ERROR raises and none after it runs: bad files are not loaded, RAW rows that do
    not match the files are not built, and a build that fails a model test is not published. The
    profile and the quality report are written whatever they say.
    """
    spark, done = lake.spark, {}
    at = dt.datetime.now(dt.timezone.utc)
    if profile:
        found = profile_directory(spark, data_dir)
        write_profile(spark, found, f"{report_dir}/{report_name('profile', at)}")
        done["profile"] = {"files": len(found)}
    results = run_contract(spark, contract_frames(spark, data_dir, contract), contract)
    report = f"{report_dir}/{report_name('quality', at)}"
    write_report(report_document(results, at), report)
    # The gate reads the report, so that the files are not checked twice.
    done["validate"] = gate(spark.read.json(report).selectExpr("inline(results)"))
    done["load"] = {"batch_id": load_raw(lake, data_dir, contract, replace=True)}
    done["reconcile"] = gate(reconcile_raw(lake, data_dir, contract))
    run_id = str(uuid.uuid4())
    warehouse.build_full(lake, tests=declared_tests() if tests is None else tests, run_id=run_id)
    done["build and test"] = {"run_id": run_id}
    done["check"] = warehouse.validate_and_gate(lake)
    return done
