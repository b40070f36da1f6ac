"""Reports of evaluators: flattening, selection, normalisation and contract checks.

Reports are JSON documents of any depth, one row each (``report_id, report``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgrid.functions.text import message_episodes
from loomgrid.operators.severity import RANKS, reaches

#: Results carry this contract, alone or after a prefix of the tool that wrote them.
CONTRACT = "dataset-evaluation/v1"
EXIT_CODES = {"pass": 0, "findings": 10, "blocked": 20}


def document_depth(report: Column) -> Column:
    """How deep objects and lists are nested in a JSON text, counted on its brackets outside strings."""
    bare = F.regexp_replace(report, r'(?s)"(?:\\.|[^"\\])*+"', "")
    marks = F.split(F.regexp_replace(bare, r"[^\[\]{}]+", ""), "")
    opens = lambda c: F.when(c.isin("[", "{"), 1).when(c.isin("]", "}"), -1).otherwise(0)
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))
    step = lambda acc, c: F.struct((acc["now"] + opens(c)).alias("now"), F.greatest(acc["most"], acc["now"] + opens(c)).alias("most"))
    return F.aggregate(marks, start, step)["most"]


def parsed(reports: DataFrame, strict: bool = True) -> DataFrame:
    """``report_id, node``. What isn't a JSON object raises, or with ``strict=False`` is left out."""
    node = F.try_parse_json("report")
    fits = F.coalesce(F.startswith(F.schema_of_variant(node), F.lit("OBJECT")), F.lit(False))
    if not strict:
        return reports.where(fits).select("report_id", node.alias("node"))
    wrong = F.raise_error(F.concat(F.lit("report "), F.col("report_id").cast("string"), F.lit(" is not a JSON object")))
    return reports.select("report_id", F.when(fits, node).otherwise(wrong.cast("variant")).alias("node"))


def flatten(reports: DataFrame, strict: bool = True, keys: list[str] | None = None) -> DataFrame:
    """``report_id, path, key, value`` (as JSON) of every object in the reports, however deep; only of ``keys`` if given.

    Values are exploded level by level in one pass over the reports, as many times as the deepest of them needs, which another pass over
    the texts tells.
    """
    depth = reports.agg(F.max(document_depth(F.col("report")))).first()[0] or 0
    wanted = F.col("key").isNotNull() if keys is None else F.coalesce(F.col("key").isin(keys), F.lit(False))
    row = lambda path, key, value, place: F.struct(path.alias("path"), key.cast("string").alias("key"), value.alias("value"), place.alias("place"), F.lit(True).alias("fresh"))

    def below(value: Column, place: Column) -> Column:
        """What a container holds; empty for anything else."""
        fields = F.map_entries(F.try_variant_get(value, "$", "map<string,variant>"))
        items = F.try_variant_get(value, "$", "array<variant>")
        keyed = F.transform(fields, lambda e: row(place, e["key"], e["value"], F.concat_ws(".", place, e["key"])))
        listed = F.transform(items, lambda e, i: row(place, F.lit(None), e, F.format_string("%s[%d]", place, i)))
        return F.coalesce(keyed, listed, F.filter(F.array(row(place, F.lit(""), value, place)), lambda _: F.lit(False)))

    def exploded(rows: DataFrame, items: Column) -> DataFrame:
        # explode would infer a condition on the array, for which each level would be computed twice
        return rows.select("report_id", F.explode_outer(items).alias("r")).where("r IS NOT NULL").select("report_id", "r.*")

    rows = exploded(parsed(reports, strict), below(F.col("node"), F.lit("$")))
    none = lambda value: F.filter(value, lambda _: F.lit(False))
    for _ in range(depth - 1):
        own = F.array(F.struct("path", "key", "value", "place", F.lit(False).alias("fresh")))
        own = F.when(wanted, own).otherwise(none(own))
        under = below(F.col("value"), F.col("place"))
        rows = exploded(rows, F.when(F.col("fresh"), F.concat(own, under)).otherwise(own))
    return rows.where(wanted).select("report_id", "path", "key", F.to_json("value").alias("value"))


def _whole(value: Column) -> Column:
    """A JSON integer; booleans and fractions aren't."""
    return F.when(value.rlike(r"^-?[0-9]+$"), value.cast("int"))


def deletable_indices(reports: DataFrame, strict: bool = True) -> DataFrame:
    """``report_id, episode_index``: the integers of the ``deletable_episode_indices`` that a report has at its root, distinct."""
    field = F.variant_get("node", "$.deletable_episode_indices", "variant")
    items = F.when(F.startswith(F.schema_of_variant(field), F.lit("ARRAY")), F.from_json(F.to_json(field), "array<string>"))
    listed = parsed(reports, strict).select("report_id", F.explode(items).alias("item"))
    return listed.select("report_id", _whole(F.col("item")).alias("episode_index")).where("episode_index IS NOT NULL").distinct()


def episode_selection(reports: DataFrame, fail_on: str, strict: bool = True) -> DataFrame:
    """``report_id, episode_index``: episodes named by a finding, at any depth, whose severity (in any case) reaches ``fail_on``, and
    those that the root lists as deletable."""
    rows = flatten(reports, strict, ["episode_index", "severity"])
    of = lambda key: F.max(F.when(F.col("key") == key, F.col("value")))
    found = rows.groupBy("report_id", "path").agg(_whole(of("episode_index")).alias("episode_index"), F.upper(F.regexp_extract(of("severity"), '^"(.*)"$', 1)).alias("severity"))
    loud = found.where(reaches(F.col("severity"), fail_on) & F.col("episode_index").isNotNull()).select("report_id", "episode_index")
    return loud.union(deletable_indices(reports, strict)).distinct()


def report_states(reports: DataFrame, fail_on: str, strict: bool = True) -> DataFrame:
    """One row per report: ``report_id, overall_severity, n_indices, blockers, problem``.

    ``blockers`` are its ``non_episode_blockers`` as texts. ``problem`` tells why nothing may be removed by it: it has blockers,
    or it reaches ``fail_on`` without naming an episode.
    """
    field = lambda name: F.variant_get("node", f"$.{name}", "variant")
    blockers = F.when(F.startswith(F.schema_of_variant(field("non_episode_blockers")), F.lit("ARRAY")), F.from_json(F.to_json(field("non_episode_blockers")), "array<string>"))
    overall = F.upper(F.regexp_extract(F.to_json(field("overall_severity")), '^"(.*)"$', 1))
    roots = parsed(reports, strict).select("report_id", overall.alias("overall_severity"), F.coalesce(blockers, F.array().cast("array<string>")).alias("blockers"))
    counts = episode_selection(reports, fail_on, strict).groupBy("report_id").agg(F.count(F.lit(1)).alias("n_indices"))
    states = roots.join(counts, "report_id", "left").withColumn("n_indices", F.coalesce("n_indices", F.lit(0).cast("bigint")))
    silent = reaches(F.col("overall_severity"), fail_on) & (F.col("n_indices") == 0)
    problem = F.when(F.size("blockers") > 0, "blockers that concern no episode").when(silent, "threshold reached without episodes")
    return states.select("report_id", "overall_severity", "n_indices", "blockers", problem.alias("problem"))


def message_selection(messages: DataFrame, fail_on: str) -> DataFrame:
    """``report_id, episode_index`` named in checker messages (``report_id, severity, message``) at or above the threshold."""
    loud = messages.where(reaches(F.col("severity"), fail_on) & F.col("message").isNotNull())
    return loud.select("report_id", F.explode(message_episodes(F.col("message"))).alias("episode_index")).distinct()


def blocker(fail_on: str) -> Column:
    """The first rule that blocks a run: over columns run_error, has_report, overall_severity, n_indices, return_code."""
    valid = F.col("overall_severity").isin(list(RANKS))
    reached = reaches(F.col("overall_severity"), fail_on)
    return (
        F.when(F.col("run_error").isNotNull(), F.col("run_error"))
        .when(~F.col("has_report"), "no report")
        .when(~F.coalesce(valid, F.lit(False)), "invalid overall severity")
        .when((F.col("n_indices") > 0) & ~reached, "episodes selected below the threshold")
        .when(reached & (F.col("n_indices") == 0), "threshold reached without episodes")
        .when((F.col("return_code") != 0) & ~reached, "non-zero exit without findings")
    )


def normalized(runs: DataFrame, fail_on: str) -> DataFrame:
    """Evaluator runs with ``blocker``, ``status`` (pass, findings, blocked) and ``exit_code``."""
    status = F.when(F.col("blocker").isNotNull(), "blocked").when(F.col("n_indices") > 0, "findings").otherwise("pass")
    code = F.when(F.col("status") == "blocked", 20).when(F.col("status") == "findings", 10).otherwise(0)
    return runs.withColumn("blocker", blocker(fail_on)).withColumn("status", status).withColumn("exit_code", code)


def combined(components: DataFrame, keys: list[str]) -> DataFrame:
    """Components (``overall_severity, blocker, return_code``) as one: worst severity (FAIL if blocked and none is known), blockers, status."""
    rank = F.max(F.when(F.col("overall_severity") == "FAIL", 2).when(F.col("overall_severity") == "WARN", 1).when(F.col("overall_severity") == "PASS", 0))
    out = components.groupBy(*keys).agg(rank.alias("rank"), F.count("blocker").alias("n_blockers"), F.max("n_indices").alias("most"), F.max("return_code").alias("return_code"))
    severity = F.when(F.col("rank").isNull(), F.when(F.col("n_blockers") > 0, "FAIL").otherwise("PASS")).otherwise(F.element_at(F.array(F.lit("PASS"), F.lit("WARN"), F.lit("FAIL")), F.col("rank") + 1))
    status = F.when(F.col("n_blockers") > 0, "blocked").when(F.col("most") > 0, "findings").otherwise("pass")
    return out.select(*keys, severity.alias("overall_severity"), "n_blockers", status.alias("status"), "return_code")


def contract_violations(result: dict, fail_on: str, dataset: str | None = None) -> list[str]:
    """What is wrong with an evaluation result; empty if it keeps the contract."""
    out: list[str] = []
    say = lambda bad, text: out.append(text) if bad else None
    status, overall, indices = result.get("status"), result.get("overall_severity"), result.get("deletable_episode_indices")
    blockers, findings = result.get("non_episode_blockers"), result.get("findings")
    say(not str(result.get("contract")).endswith(CONTRACT), "contract")
    say(status not in EXIT_CODES, "status")
    say(str(result.get("fail_on")).upper() not in ("WARN", "FAIL"), "fail_on")
    say(str(result.get("fail_on")).upper() != fail_on.upper(), "fail_on differs")
    say(not isinstance(result.get("evaluator"), str) or not result.get("evaluator"), "evaluator")
    say(overall not in RANKS, "overall_severity")
    whole = isinstance(indices, list) and all(isinstance(i, int) and not isinstance(i, bool) and i >= 0 for i in indices)
    say(not whole, "deletable_episode_indices")
    say(whole and indices != sorted(set(indices)), "indices aren't sorted and unique")
    say(not isinstance(blockers, list) or not all(isinstance(b, str) for b in blockers), "non_episode_blockers")
    say(not isinstance(findings, list) or not all(isinstance(f, dict) for f in findings), "findings")
    artifacts = result.get("artifacts")
    say(not isinstance(artifacts, dict) or not all(isinstance(v, str) for v in artifacts.values()), "artifacts")
    code = result.get("evaluator_return_code")
    say(code is not None and (not isinstance(code, int) or isinstance(code, bool)), "evaluator_return_code")
    if not out:
        reached = RANKS[overall] >= RANKS[fail_on.upper()]
        say(status == "pass" and (indices or blockers), "pass with selections or blockers")
        say(status == "pass" and reached, "pass at the threshold")
        say(status == "findings" and (not indices or blockers), "findings without selections or with blockers")
        say(status == "findings" and not reached, "findings below the threshold")
        say(status == "blocked" and not blockers, "blocked without a blocker")
        say(dataset is not None and result.get("dataset_path") != dataset, "another dataset")
    return out


def evaluation_result(evaluator: str, dataset: str, fail_on: str, overall: str | None, indices: list[int], return_code: int | None = 0, run_error: str | None = None, report: bool = True, artifacts: dict[str, str] | None = None) -> dict:
    """One evaluator's normalised result document."""
    threshold = RANKS[fail_on.upper()]
    known = overall in RANKS
    reached = known and RANKS[overall] >= threshold
    reasons = [
        (run_error is not None, run_error),
        (not report, "the evaluator left no report"),
        (not known, "the overall severity is invalid"),
        (bool(indices) and not reached, "episodes are selected below the threshold"),
        (reached and not indices, "the threshold is reached but no episode is named"),
        (bool(return_code) and not reached, "the evaluator failed without findings"),
    ]
    why = next((text for bad, text in reasons if bad), None)
    chosen = sorted(set(indices))
    return {
        "version": "1.0",
        "contract": CONTRACT,
        "evaluator": evaluator,
        "dataset_path": dataset,
        "fail_on": fail_on.upper(),
        "status": "blocked" if why else "findings" if chosen else "pass",
        "overall_severity": overall if known else "FAIL",
        "deletable_episode_indices": chosen,
        "findings": [{"episode_index": i, "severity": overall if known else "FAIL", "kind": evaluator} for i in chosen],
        "non_episode_blockers": [why] if why else [],
        "artifacts": artifacts or {},
        "evaluator_return_code": return_code,
    }
