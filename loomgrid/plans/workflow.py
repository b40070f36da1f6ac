"""The workflow: convert, evaluate, filter, evaluate again, archive; each stage recorded.

Evaluators are callables ``(frames, profile) -> result document`` in order; a command line can be wrapped by
``command_evaluator``. A result is checked against the contract before it is used.
"""

from __future__ import annotations

import json
import subprocess
import tempfile
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame

from loomgrid.operators.reports import EXIT_CODES, contract_violations
from loomgrid.operators.selection import without_episodes
from loomgrid.plans.profile import Profile

Evaluator = Callable[[DataFrame, Profile], dict]


@dataclass
class WorkflowState:
    """Summary of a run: the status, its stages in order, and the effective dataset."""

    frames: DataFrame
    status: str = "running"
    stages: list[dict] = field(default_factory=list)

    def record(self, name: str, status: str, **details) -> None:
        self.stages.append({"name": name, "status": status, "details": details})

    def summary(self) -> dict:
        return {"version": "2.0", "status": self.status, "stages": self.stages}


def derived_name(base: str, filters: int, stage: str) -> str:
    """The first filtered dataset keeps the base name; later ones are numbered."""
    return base if filters == 0 else f"{base}_{filters + 1:02d}_{stage}"


def command_evaluator(name: str, command: list[str], dataset: str) -> Evaluator:
    """An external program under the contract: it gets the dataset, a report folder, a result file and the threshold."""

    def evaluate(frames: DataFrame, profile: Profile) -> dict:
        with tempfile.TemporaryDirectory() as folder:
            result = Path(folder) / "result.json"
            run = subprocess.run([*command, dataset, "--report-dir", folder, "--result-file", str(result), "--fail-on", profile["dataset.fail_on"]], check=False)
            document = json.loads(result.read_text())
        if EXIT_CODES.get(document.get("status")) != run.returncode:
            raise ValueError(f"{name}: the exit code {run.returncode} doesn't fit the status {document.get('status')!r}")
        return document

    return evaluate


def run_workflow(frames: DataFrame, evaluators: list[tuple[str, Evaluator]], profile: Profile, total_episodes: int, evaluate_again: bool = True) -> WorkflowState:
    """Run the evaluators in turn; filter what each selects; stop at the first blocker.

    After a filter the evaluator runs again and must pass. Exit codes: 0 complete, 1 failed, 20 blocked.
    """
    state, total, fail_on = WorkflowState(frames), total_episodes, profile["dataset.fail_on"]
    for name, evaluator in evaluators:
        result = evaluator(state.frames, profile)
        if wrong := contract_violations(result, fail_on):
            state.record(f"evaluation:{name}", "failed", violations=wrong)
            state.status = "failed"
            return state
        state.record(f"evaluation:{name}", result["status"], episodes=result["deletable_episode_indices"])
        if result["status"] == "blocked":
            state.status = "blocked"
            return state
        chosen = result["deletable_episode_indices"]
        if not chosen:
            continue
        if len(chosen) >= total or chosen[-1] >= total:
            state.record(f"filter:{name}", "failed", episodes=chosen)
            state.status = "failed"
            return state
        selection = state.frames.sparkSession.createDataFrame([(i,) for i in chosen], "episode_index int")
        state.frames, total = without_episodes(state.frames, selection), total - len(chosen)
        state.record(f"filter:{name}", "filtered", removed=chosen)
        if evaluate_again:
            after = evaluator(state.frames, profile)
            state.record(f"post-filter:{name}", after["status"])
            if after["status"] != "pass":
                state.status = "blocked"
                return state
    state.status = "complete"
    return state


def exit_code(state: WorkflowState) -> int:
    return {"complete": 0, "blocked": 20}.get(state.status, 1)
