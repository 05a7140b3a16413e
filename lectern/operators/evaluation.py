"""Judged edits: an evaluator's answer scored, asked for and reported.

Defined results
---------------
* an answer that is no object, lacks a list or holds a malformed item fails with rate 1;
* a missing edit that changes nothing is left out; one that asks for what an invalid
  edit did takes both out of the count;
* pairs of two blank lines are not judged.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable
from typing import NamedTuple

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions import steps as S
from lectern.functions.classes import GROUPS, NO_SPACE, python_class
from lectern.operators import aligned, answers, model
from lectern.operators.arrow import map_columns

# Fields of a judged edit and of a missing one.
EDIT_FIELDS = ("edit", "valid_step", "rule", "note")
MISSING_FIELDS = ("span", "expected_edit", "step", "reason")
_CHANGE = regex.compile(r"(?s)<chg>(.*?)</chg>")
_DENSE = regex.compile(f"[{python_class(NO_SPACE)}{python_class(GROUPS['hangul'])}]")
FAILURE = "Prompt-eval failure: "


def schema(selector) -> dict:
    """JSON schema of an answer for the chosen steps."""
    names = [S.STEPS[i] for i in S.resolve(selector)]
    text = {"type": "string"}

    def listed(**properties) -> dict:
        item = {"type": "object", "additionalProperties": False, "properties": properties, "required": list(properties)}
        return {"type": "array", "items": item}

    edits = listed(edit=text, valid_step={"type": ["string", "null"], "enum": [*names, None]}, rule=text, note=text)
    missing = listed(span=text, expected_edit=text, step={"type": "string", "enum": names}, reason=text)
    whole = {"edits": edits, "missing_edits": missing}
    return {"name": "patch_eval_output", "strict": True, "schema": {"type": "object", "additionalProperties": False, "properties": whole, "required": list(whole)}}


def failed(reason: str) -> dict:
    """The score of an answer that cannot be used."""
    return {"pass": False, "fail_reasons": [reason], "edit_error_rate": 1.0, "diff_summary": [], "edits": [], "missing_edits": []}


def folded(text: str | None) -> str:
    return " ".join(unicodedata.normalize("NFC", text or "").split())


def outcome(item: dict) -> str:
    """STEP_MISMATCH, INVALID or VALID of a judged edit."""
    said = f"{item.get('rule', '')}\n{item.get('note', '')}".upper()
    if "STEP_MISMATCH" in said:
        return "STEP_MISMATCH"
    return "INVALID" if item.get("valid_step") is None or "INVALID" in said else "VALID"


def split_edit(text: str) -> tuple[str, str] | None:
    """Both sides of ``[before] -> [after]``; brackets within a side are balanced."""
    sides, depth, start = [], 0, 0
    for k, c in enumerate(text.strip()):
        if c == "[":
            depth += 1
            start = k + 1 if depth == 1 else start
        elif c == "]" and depth:
            depth -= 1
            if not depth:
                sides.append((start, k))
    body = text.strip()
    if len(sides) != 2 or depth or body[: sides[0][0] - 1].strip() or body[sides[0][1] + 1 : sides[1][0] - 1].strip() != "->" or body[sides[1][1] + 1 :].strip():
        return None
    return body[slice(*sides[0])], body[slice(*sides[1])]


def changed(side: str) -> str:
    """The marked parts of one side."""
    found = [x for x in map(str.strip, _CHANGE.findall(side)) if x]
    return ("" if _DENSE.search("".join(found)) else " ").join(found)


class Fault(NamedTuple):
    """An edit judged invalid: what it is called, and the forms of both sides by which a
    missing edit may mean the same."""

    kind: str
    item: dict
    before: frozenset[str]
    after: frozenset[str]

    @classmethod
    def of(cls, item: dict) -> Fault:
        sides = split_edit(item["edit"]) or ("", "")
        forms = [frozenset((folded(s), folded(changed(s)))) - {""} for s in sides]
        return cls(outcome(item), item, *forms)

    def answers(self, missing: dict) -> bool:
        span = folded(missing["span"])
        return folded(missing["expected_edit"]) in self.after and (not span or span in self.before)

    def text(self) -> str:
        # the step of an edit without one is written as Python writes it: readers rely on it
        return f"{self.kind}: valid_step={str(self.item.get('valid_step')).strip()}; edit={self.item['edit'].strip()}; rule={self.item['rule'].strip()}"


def _well_formed(payload) -> str | None:
    if not isinstance(payload, dict):
        return "evaluator output is not an object"
    edits, missing = payload.get("edits"), payload.get("missing_edits")
    if not isinstance(edits, list) or not isinstance(missing, list):
        return "missing required fields 'edits' or 'missing_edits'"
    text = lambda x, names: isinstance(x, dict) and all(isinstance(x.get(n), str) for n in names)
    if not all(text(x, ("edit", "rule", "note")) and isinstance(x.get("valid_step"), (str, type(None))) for x in edits):
        return "malformed item in 'edits'"
    return None if all(text(x, MISSING_FIELDS) for x in missing) else "malformed item in 'missing_edits'"


def score(payload) -> dict:
    """Pass, error rate, reasons and summary of an evaluator's answer."""
    if error := _well_formed(payload):
        return failed(FAILURE + error)
    edits = [x | {"outcome": outcome(x)} for x in payload["edits"]]
    faults = [Fault.of(x) for x in edits if x["outcome"] != "VALID"]
    real = [m for m in payload["missing_edits"] if not folded(m["span"]) or folded(m["span"]) != folded(m["expected_edit"])]
    cleared, open_ = set(), []
    for m in real:
        against = next((k for k, f in enumerate(faults) if folded(m["expected_edit"]) and f.answers(m)), None)
        if against is None:
            open_.append(m)
        else:
            cleared.add(against)
    counted = [f for k, f in enumerate(faults) if k not in cleared]
    kinds = [f.kind for f in faults]
    left = [f.kind for f in counted]
    chances = len(edits) + len(open_)
    rate = min(1.0, (len(counted) + len(open_)) / chances) if chances else 0.0
    clashes, no_ops = len(real) - len(open_), len(payload["missing_edits"]) - len(real)
    summary = [
        f"edit_error_rate={rate * 100:.2f}%; invalid={len(counted)}; missing={len(open_)}; opportunities={chances}",
        f"edits_count={len(edits)}; invalid={kinds.count('INVALID')}; step_mismatch={kinds.count('STEP_MISMATCH')}",
    ]
    if clashes:
        summary.append(f"contradiction_resolved_overlap={clashes}; effective_invalid={left.count('INVALID')}; effective_step_mismatch={left.count('STEP_MISMATCH')}")
    if no_ops:
        summary.append(f"noop_filtered_missing={no_ops}")
    reasons = [f.text() for f in counted] + [f"MISSING: step={m['step'].strip()}; span={m['span'].strip()}; reason={m['reason'].strip()}" for m in open_]
    return {"pass": not counted and not open_, "fail_reasons": reasons, "edit_error_rate": rate, "diff_summary": summary, "edits": edits, "missing_edits": open_}


PROMPT = "Judge every edit by the chain steps.\n\nchain_steps:\n{steps}\n\noriginal_text:\n{source}\n\npatched_text:\n{target}\n\nextracted_edits:\n{edits}"
REPAIR = "The answer was no usable JSON ({error}). Answer again with the object alone.\n\nprevious_output:\n{answer}\n\nprompt:\n{prompt}"


def judge(client, source: str, target: str, policy: model.Policy, key, steps: str = "") -> dict:
    """Score of one pair: ask, read, ask once for a repair, ask anew; a pair that gets no
    usable answer fails with the reason."""
    edits = json.dumps(aligned.edits(source, target), ensure_ascii=False)
    prompt = PROMPT.format(steps=steps or S.describe(None), source=source, target=target, edits=edits)
    error = "no answer"
    for attempt in range(policy.empty_retries + 1):
        said = model.call(client, prompt, policy, (key, attempt))
        for repair in (False, True):
            if said is None:
                return failed(FAILURE + "request timed out")
            body = answers.unfence(said)
            try:
                payload = json.loads(answers.fix_escapes(answers.first_object(body) or body))
                error = _well_formed(payload)
            except (ValueError, RecursionError) as e:
                payload, error = None, f"JSON parse error: {e}"
            if error is None:
                return score(payload)
            if repair or not said.strip():
                break
            said = model.call(client, REPAIR.format(error=error, answer=said, prompt=prompt), policy, (key, attempt, "repair"))
    return failed(FAILURE + error)


def judged(df: DataFrame, id_col: str, source: str, target: str, make_client: Callable, policy: model.Policy | None = None) -> DataFrame:
    """(id, passed, rate, reasons, summary) of every pair that is not blank on both sides."""
    rules = policy or model.Policy()
    rows = df.select(id_col, F.coalesce(source, F.lit("")).alias("s"), F.coalesce(target, F.lit("")).alias("t")).filter(r"s RLIKE '\\S' OR t RLIKE '\\S'")

    def kernel(columns: dict, client) -> dict:
        work = list(zip(columns[id_col], columns["s"], columns["t"]))
        got = model.each(lambda r: judge(client, r[1], r[2], rules, r[0]), work, rules.concurrency)
        return {
            id_col: columns[id_col], "passed": [g["pass"] for g in got], "rate": [g["edit_error_rate"] for g in got],
            "reasons": [g["fail_reasons"] for g in got], "summary": [g["diff_summary"] for g in got],
        }

    return map_columns(rows, kernel, f"{id_col} bigint, passed boolean, rate double, reasons array<string>, summary array<string>", make_client)


class SeededEvaluator:
    """Deterministic client: reads the edits of a prompt and finds every third invalid;
    every seventh answer comes in a fence, every eleventh is broken at first."""

    def complete(self, prompt: str, temperature: float = 0.0) -> str:
        repaired = prompt.startswith("The answer was")
        edits = json.loads(prompt.rsplit("extracted_edits:\n", 1)[1])
        items = [{"edit": e, "valid_step": None if model.seeded(e) < 1 / 3 else "PUNCT", "rule": "R", "note": ""} for e in edits]
        body = json.dumps({"edits": items, "missing_edits": []}, ensure_ascii=False)
        dice = model.seeded(prompt.rsplit("original_text:\n", 1)[1])
        if dice < 1 / 11 and not repaired:
            return body[:-2]
        return f"```json\n{body}\n```" if dice > 6 / 7 else body


# ---------------------------------------------------------------- reports


def scores(results: DataFrame) -> DataFrame:
    """(evaluator, result_file, line_count, passed_lines, failed_lines, pass_rate_percent)."""
    files = results.groupBy("evaluator", "result_file").agg(F.count("*").alias("line_count"), F.count_if("passed").alias("passed_lines"))
    rate = F.bround(100.0 * F.col("passed_lines") / F.col("line_count"), 2)
    return files.select("evaluator", "result_file", "line_count", "passed_lines", (F.col("line_count") - F.col("passed_lines")).alias("failed_lines"), rate.alias("pass_rate_percent"))


def summary(per_file: DataFrame) -> DataFrame:
    """(evaluator, runs, avg_file_pass_rate_percent, overall_line_pass_rate_percent)."""
    return per_file.groupBy("evaluator").agg(
        F.count("*").alias("runs"),
        F.bround(F.avg("pass_rate_percent"), 2).alias("avg_file_pass_rate_percent"),
        F.bround(100.0 * (1 - F.sum("failed_lines") / F.sum("line_count")), 2).alias("overall_line_pass_rate_percent"),
    )


def write_outputs(results: DataFrame, folder: str) -> tuple[str, str, str]:
    """Results as JSON records, scores and summary as CSV with a header, below ``folder``."""
    per_file = scores(results)
    paths = tuple(f"{folder.rstrip('/')}/{n}" for n in ("results", "scores", "summary"))
    results.select(F.to_json(F.struct(*results.columns)).alias("value")).write.mode("overwrite").text(paths[0])
    per_file.orderBy("evaluator", "result_file").write.mode("overwrite").option("header", True).csv(paths[1])
    summary(per_file).orderBy("evaluator").write.mode("overwrite").option("header", True).csv(paths[2])
    return paths
