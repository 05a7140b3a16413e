"""The call, repair and retry policy, and lines through a client with bounded
concurrency inside every task."""

from __future__ import annotations

import hashlib
import threading
import time
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from lectern.operators import answers
from lectern.operators.arrow import map_columns
from lectern.operators.clients import FakeClient, RateLimited, WrongModel
from lectern.operators.segment import split

__all__ = ["FakeClient", "Policy", "RateLimited", "WrongModel", "call", "corrected", "each", "no_wait", "patch", "patch_line", "reminded", "seeded"]


def seeded(*parts) -> float:
    """A number in [0, 1) that depends on its arguments alone."""
    return int.from_bytes(hashlib.blake2b(repr(parts).encode(), digest_size=6).digest(), "big") / 2**48


class Gate:
    """Holds back all threads of a task while the service asks to wait. It is made anew
    where a policy is unpickled, so every worker has its own."""

    def __init__(self):
        self.lock, self.until = threading.Lock(), 0.0

    def __reduce__(self):
        return Gate, ()

    def hold(self, seconds: float) -> None:
        with self.lock:
            self.until = max(self.until, time.monotonic() + seconds)

    def rest(self) -> float:
        with self.lock:
            return max(0.0, self.until - time.monotonic())


@dataclass(frozen=True)
class Policy:
    """Retry limits, waits and the number of questions a task has under way at once. With
    ``remind`` every attempt is marked and asks for JSON again, for services that keep a
    conversation. ``sleep`` is a parameter so tests need not wait."""

    timeout_retries: int = 1
    empty_retries: int = 1
    mismatch_retries: int = 1
    temperature: float = 0.0
    jitter: float = 0.08
    concurrency: int = 5
    unit: float = 10.0
    remind: bool = False
    sleep: Callable[[float], None] = time.sleep
    gate: Gate = field(default_factory=Gate, compare=False)

    def pause(self, attempt: int, hint: float | None = None) -> float:
        """Seconds to wait before the next attempt."""
        return (hint if hint and hint > 0 else 2**attempt) * self.unit


def call(client, prompt: str, policy: Policy, key) -> str | None:
    """One answer, or None when faults used up the attempts. Time outs, transport errors
    and rate limits share one count; a wrong model has its own."""
    attempt = mismatches = 0
    while True:
        if rest := policy.gate.rest():
            policy.sleep(rest)
        heat = policy.temperature + (policy.jitter * seeded(key, attempt) if attempt else 0.0)
        try:
            return client.complete(prompt, heat)
        except WrongModel:
            if mismatches == policy.mismatch_retries:
                return None
            policy.sleep(policy.pause(mismatches))
            mismatches += 1
            continue
        except RateLimited as e:
            wait = policy.pause(attempt, e.seconds)
            if attempt < policy.timeout_retries and e.seconds:
                policy.gate.hold(wait)  # the others of this task wait as well
                wait = 0.0
        except OSError:  # TimeoutError is one
            wait = policy.pause(attempt)
        if attempt == policy.timeout_retries:
            return None
        if wait:
            policy.sleep(wait)
        attempt += 1


def each(work: Callable, items: Iterable, concurrency: int) -> list:
    """``work`` of every item in order, with at most ``concurrency`` under way."""
    if concurrency <= 1:
        return [work(x) for x in items]
    with ThreadPoolExecutor(concurrency) as pool:
        return list(pool.map(work, items))


def reminded(prompt: str, policy: Policy, key) -> str:
    """The prompt of one attempt: no two attempts read alike where the policy says so."""
    if not policy.remind:
        return prompt
    return f"request {int(seeded('mark', key) * 16**8):08x}; answer with the JSON object alone.\n{prompt}"


def corrected(client, text: str, policy: Policy, key) -> tuple[dict | None, str, int]:
    """(payload, outcome, attempts): call, parse, repair once per attempt, retry."""
    prompt, outcome, tries = f"text: {text}", "failed", 0
    for attempt in range(policy.empty_retries + 1):
        tries += 1
        content = call(client, reminded(prompt, policy, (key, attempt)), policy, (key, attempt))
        if content is None:
            return None, "timeout", tries
        payload, error = answers.respond(content, text)
        if error and not error.startswith((answers.NON_REPAIRABLE, "Long-span", "JSON parse recursion")):
            tries += 1
            content = call(client, reminded(prompt, policy, (key, attempt, "repair")), policy, (key, attempt, "repair"))
            payload, error = answers.respond(content, text)
        if error and error.startswith("Long-span"):
            return None, "long_span", tries  # the caller shortens the text
        if not error and (payload.get("corrected_text") or "").strip():
            return payload, "ok", tries
        outcome = "empty" if not error else "invalid"
    return None, outcome, tries


def patch_line(client, text: str, policy: Policy, key, limit: int = 300) -> tuple[str | None, str]:
    """(corrected text, state) of a line: segments that fail are cut at half the limit
    until they succeed or cannot be cut; a line with a failed part is ``partial``."""
    if not text.strip():
        return "", "blank"
    if text.lstrip().startswith("#"):
        return text, "comment"
    todo, done, state = [(a, b, limit) for a, b in split(text, limit)], [], "ok"
    while todo:
        a, b, size = todo.pop(0)
        part = text[a:b]
        payload, outcome, _ = corrected(client, part, policy, (key, a, b))
        if payload is not None or not part.strip():
            done.append(payload["corrected_text"] if payload else part)
            continue
        smaller = max(1, min(size - 1, len(part) - 1, size // 2))
        if outcome == "long_span" and len(part) > 1 and smaller >= 20:
            todo = [(a + x, a + y, smaller) for x, y in split(part, smaller)] + todo
        else:
            state = "partial"
            done.append(part)
    return "".join(done), state


def patch(df: DataFrame, id_col: str, text_col: str, make_client: Callable, policy: Policy | None = None, limit: int = 300) -> DataFrame:
    """(id, text, state): every line through a client; one client per task, as many lines
    under way in it as the policy allows."""
    rules = policy or Policy()

    def kernel(columns: dict, client) -> dict:
        rows = list(zip(columns[id_col], columns[text_col]))
        got = each(lambda r: patch_line(client, r[1] or "", rules, r[0], limit), rows, rules.concurrency)
        return {id_col: columns[id_col], "text": [g[0] for g in got], "state": [g[1] for g in got]}

    return map_columns(df.select(id_col, text_col), kernel, f"{id_col} bigint, text string, state string", make_client)


def no_wait(seconds: float) -> None:
    """A ``sleep`` for clients that need no rest."""
