"""Model servers over HTTP as backends: completions, chats and judges, on several instances. Standard library only."""

from __future__ import annotations

import http.client
import json
import time
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from urllib.parse import urlsplit


def events(lines: Iterable[bytes]) -> Iterator[dict]:
    """The JSON objects of a stream of server-sent events, until its end mark; comments and other fields are passed over."""
    for line in lines:
        name, _, value = line.decode("utf-8", "replace").strip().partition(":")
        if name == "data" and value.strip() == "[DONE]":
            return
        if name == "data" and value.strip():
            yield json.loads(value)


class Refused(Exception):
    """An answer with a status of 400 to 499: another try would meet the same."""


@dataclass(frozen=True)
class Timeouts:
    """Seconds until the first piece, between pieces, and in all."""

    first: float = 60.0
    gap: float = 30.0
    total: float = 300.0


@dataclass(frozen=True)
class Server:
    """Calls to instances in a ring: a failed try goes to the next one, after a pause that grows by `backoff` each time.

    A refusal (4xx) is final if `refusal_is_final`; other failures are tried again `retries` times.
    """

    urls: tuple[str, ...]
    path: str = "/completions"
    model: str = ""
    retries: int = 2
    backoff: float = 0.0
    timeouts: Timeouts = Timeouts()
    refusal_is_final: bool = True
    options: dict = field(default_factory=dict)

    def payload(self, row: dict) -> dict:
        return {"model": self.model, "stream": True, **self.options, **row}

    def pieces(self, event: dict) -> tuple[str, str, str | None]:
        """text, reasoning and finish of one event."""
        choice = (event.get("choices") or [{}])[0]
        return choice.get("text") or "", "", choice.get("finish_reason")

    def complete(self, rows: list[dict]) -> list[dict]:
        return [self._tried(row) for row in rows]

    def _tried(self, row: dict) -> dict:
        start, problem = int(row.get("seed") or 0), ""
        for k in range(self.retries + 1):
            url = self.urls[(start + k) % len(self.urls)]
            if k and self.backoff:
                time.sleep(self.backoff * k)
            try:
                return {**self._call(url, self.payload(row)), "url": url, "error": None}
            except Refused as e:
                problem = str(e)
                if self.refusal_is_final:
                    return {"raw": "", "finish": "rejected", "error": problem, "url": url}
            except (OSError, http.client.HTTPException, ValueError, KeyError) as e:
                problem = f"{type(e).__name__}: {e}"[:200]
        return {"raw": "", "finish": "error", "error": problem, "url": url}

    def _call(self, url: str, payload: dict) -> dict:
        at, began = urlsplit(url), time.monotonic()
        kind = http.client.HTTPSConnection if at.scheme == "https" else http.client.HTTPConnection
        connection = kind(at.hostname, at.port, timeout=min(self.timeouts.first, self.timeouts.total))
        try:
            connection.connect()
            socket = connection.sock
            connection.request("POST", at.path.rstrip("/") + self.path, json.dumps(payload), {"Content-Type": "application/json"})
            response = connection.getresponse()
            if response.status != 200:
                text = f"HTTP {response.status}: {response.read(300).decode('utf-8', 'replace')}"
                raise Refused(text) if 400 <= response.status < 500 else OSError(text)
            if "event-stream" not in response.getheader("Content-Type", ""):
                return {**self.whole(json.loads(response.read())), "ttft": None, "latency": time.monotonic() - began}
            return self._streamed(response, socket, began)
        finally:
            connection.close()

    def whole(self, body: dict) -> dict:
        text, reasoning, finish = self.pieces(body)
        return {"raw": text, "reasoning": reasoning, "finish": finish or "error"}

    def _streamed(self, response: http.client.HTTPResponse, socket, began: float) -> dict:
        texts, thoughts, finish, first = [], [], None, None
        for event in events(self._lines(response, socket, began)):
            text, thought, end = self.pieces(event)
            first = time.monotonic() - began if first is None and (text or thought) else first
            texts.append(text)
            thoughts.append(thought)
            finish = end or finish
        if finish is None:
            raise OSError("the stream ended without a finish")
        return {"raw": "".join(texts), "reasoning": "".join(thoughts), "finish": finish, "ttft": first, "latency": time.monotonic() - began}

    def _lines(self, response: http.client.HTTPResponse, socket, began: float) -> Iterator[bytes]:
        wait = self.timeouts.first
        while True:
            left = began + self.timeouts.total - time.monotonic()
            if left <= 0:
                raise TimeoutError("in all")
            socket.settimeout(min(wait, left))
            line = response.readline()
            if not line:
                return
            wait = self.timeouts.gap
            yield line


@dataclass(frozen=True)
class Chat(Server):
    """Chat completions; the prompt is a JSON array of messages, or else the text of one user message."""

    path: str = "/chat/completions"

    def payload(self, row: dict) -> dict:
        rest = {k: v for k, v in row.items() if k != "prompt"}
        try:
            messages = json.loads(row["prompt"])
        except ValueError:
            messages = None
        if not isinstance(messages, list):
            messages = [{"role": "user", "content": row["prompt"]}]
        return {"model": self.model, "stream": True, **self.options, **rest, "messages": messages}

    def pieces(self, event: dict) -> tuple[str, str, str | None]:
        choice = (event.get("choices") or [{}])[0]
        turn = choice.get("delta") or choice.get("message") or {}
        return turn.get("content") or "", turn.get("reasoning_content") or turn.get("reasoning") or "", choice.get("finish_reason")


@dataclass(frozen=True)
class Judge(Server):
    """A judge: the prompt is the JSON of a request, raw the JSON of its answers by question."""

    path: str = "/v1/systemone"

    def payload(self, row: dict) -> dict:
        return json.loads(row["prompt"])

    def whole(self, body: dict) -> dict:
        return {"raw": json.dumps(body["answers"], ensure_ascii=False), "reasoning": None, "finish": "stop"}


def models(url: str, timeout: float = 30.0) -> list[tuple[str, int | None]]:
    """Names and greatest lengths of the models that an instance serves, in its order."""
    at = urlsplit(url)
    kind = http.client.HTTPSConnection if at.scheme == "https" else http.client.HTTPConnection
    connection = kind(at.hostname, at.port, timeout=timeout)
    try:
        connection.request("GET", at.path.rstrip("/") + "/models")
        response = connection.getresponse()
        if response.status != 200:
            raise OSError(f"HTTP {response.status}")
        return [(m["id"], m.get("max_model_len")) for m in json.loads(response.read())["data"]]
    finally:
        connection.close()
