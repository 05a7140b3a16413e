"""Model clients. A client is any object with ``complete(prompt, temperature) -> str``;
it is made once per task and used by several threads."""

from __future__ import annotations

import json
import re
import time
import unicodedata
import urllib.error
import urllib.request
from collections.abc import Callable

from lectern.operators import answers


class RateLimited(Exception):
    """The service asks to wait; ``seconds`` is its hint."""

    def __init__(self, seconds: float | None = None, text: str = ""):
        super().__init__(text or f"429 retry after {seconds} seconds")
        self.seconds = seconds


class WrongModel(Exception):
    """Another model answered than the one asked for."""

    def __init__(self, wanted: str, got: str):
        super().__init__(f"MODEL_MISMATCH requested={wanted} actual={got}")
        self.wanted, self.got = wanted, got


_HINT = re.compile(r"(?i)retry after\s+(\d+(?:\.\d+)?)\s+second")


def wait_hint(header: str | None, text: str) -> float | None:
    """Seconds to wait by the header, else by the message; None if neither is above 0."""
    for value in (header, (_HINT.search(text) or [None, None])[1]):
        try:
            if value is not None and float(value) > 0:
                return float(value)
        except ValueError:
            continue
    return None


def is_busy(status: int | None, text: str) -> bool:
    low = text.lower()
    return status == 429 or any(x in low for x in ("rate limit", "too many requests", "throttl", "error code: 429"))


def composed(content) -> str:
    return unicodedata.normalize("NFC", answers.text_of(content).strip())


class HttpClient:
    """Chat completions over HTTP. A service that knows no JSON schemas is asked again
    for a plain JSON object, and from then on only that way."""

    def __init__(self, url: str, model: str, schema: dict | None = None, headers: dict[str, str] | None = None, seconds: float = 1000.0, top_p: float = 1.0):
        self.url, self.model, self.schema, self.headers, self.seconds, self.top_p = url, model, schema, headers or {}, seconds, top_p

    def _post(self, body: dict) -> dict:
        data = json.dumps(body, ensure_ascii=False).encode()
        request = urllib.request.Request(self.url, data, {"Content-Type": "application/json", **self.headers})
        with urllib.request.urlopen(request, timeout=self.seconds) as reply:
            return json.load(reply)

    def complete(self, prompt: str, temperature: float = 0.0) -> str:
        body = {"model": self.model, "messages": [{"role": "user", "content": prompt}], "temperature": temperature, "top_p": self.top_p}
        form = {"type": "json_schema", "json_schema": self.schema} if self.schema else {"type": "json_object"}
        try:
            reply = self._post(body | {"response_format": form})
        except urllib.error.HTTPError as e:
            said = e.read().decode("utf-8", "replace")
            if e.code == 400 and self.schema and "unsupported" in said.lower():
                self.schema = None
                return self.complete(prompt, temperature)
            if is_busy(e.code, said):
                raise RateLimited(wait_hint(e.headers.get("Retry-After"), said), said) from e
            raise OSError(f"HTTP {e.code}: {said[:200]}") from e
        choices = reply.get("choices") or [{}]
        return composed((choices[0].get("message") or {}).get("content"))


class SessionClient:
    """A conversation that is polled for events. ``open_session`` gives an object with
    ``send(prompt)`` and ``events() -> [{id, type, ...}]``. A new session is opened for
    every question, so none sees an earlier one."""

    def __init__(self, open_session: Callable, model: str | None = None, seconds: float = 1000.0, pause: float = 0.1, clock=time.monotonic, sleep=time.sleep):
        self.open_session, self.model, self.seconds, self.pause, self.clock, self.sleep = open_session, model, seconds, pause, clock, sleep

    def complete(self, prompt: str, temperature: float = 0.0) -> str:
        session = self.open_session()
        seen = {e.get("id") for e in session.events()}
        session.send(prompt)
        end, reply = self.clock() + self.seconds, Reply(self.model)
        while True:
            for event in session.events():
                if event.get("id") not in seen:
                    seen.add(event.get("id"))
                    reply.take(event)
            if reply.text is not None:
                return reply.text
            if self.clock() >= end:
                raise TimeoutError("no answer in time")
            self.sleep(self.pause)


class Reply:
    """What the events of one question add up to: a whole message, else the parts of one
    once the turn has ended."""

    def __init__(self, model: str | None):
        self.model, self.text, self.parts = model, None, []
        self.steps = {"session.error": self._fail, "assistant.message": self._whole, "assistant.message_delta": self._part, "assistant.usage": self._usage, "assistant.turn_end": self._end}

    def take(self, event: dict) -> None:
        step = self.steps.get(event.get("type"))
        if step and self.text is None:
            step(event)

    def _fail(self, event):
        raise OSError(str(event.get("message") or event.get("error_reason") or event.get("error") or "session.error"))

    def _whole(self, event):
        self.text = composed(event.get("content")) or None

    def _part(self, event):
        self.parts.append(answers.text_of(event.get("delta_content") or event.get("content")))

    def _usage(self, event):
        got = event.get("model") or event.get("model_id")
        if self.model and got and str(got) != self.model:
            raise WrongModel(self.model, str(got))

    def _end(self, event):
        self.text = composed("".join(self.parts)) or None


class FakeClient:
    """Deterministic client: echoes the text as a payload, with scripted faults."""

    def __init__(self, faults: dict[int, str] | None = None):
        self.faults, self.calls = faults or {}, 0

    def complete(self, prompt: str, temperature: float = 0.0) -> str:
        fault = self.faults.get(self.calls)
        self.calls += 1
        if fault == "timeout":
            raise TimeoutError("timed out")
        if fault == "limit":
            raise RateLimited(0.0)
        if fault == "model":
            raise WrongModel("wanted", "other")
        if fault == "empty":
            return ""
        if fault == "prose":
            return "I would rather not."
        text = prompt.rsplit("text: ", 1)[-1]
        payload = answers.empty_payload()
        payload["ct_punct"] = {"edits": [], "result": text if fault != "short" else text[: len(text) // 4]}
        body = json.dumps(payload, ensure_ascii=False)
        return body[:-9] if fault == "broken" else f"```json\n{body}\n```"
