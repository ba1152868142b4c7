"""Deterministic stand-in generators for tests and driver checks.

No model ships with the package.  These stubs follow the generator contract of
:mod:`sftforge.operators.generate` and answer with simple text transforms that
SQL can restate, so generated tables can be checked against an oracle.
"""

from __future__ import annotations

import os
import time

from sftforge.functions.prompts import INPUT_SEPARATOR
from sftforge.functions.scores import RISK_HINT_TOKENS

TAIL_FROM = 40


def _user(messages) -> str:
    text = ""
    for m in messages:
        if m.get("role") == "user":
            text = m.get("content") or ""
    return text


class StubGenerator:
    """``StubGenerator(options)`` is a generator; the kind comes from ``base_model``.

    * ``stub-echo``: the user content, padded with whitespace (tests strip).
    * ``stub-lead``: the text before the input separator, plus a risk hint when
      the user content has an even length.
    * ``stub-tail``: the user content from its 41st character on.
    """

    loads = 0  # instances created in this worker process

    def __init__(self, options: dict):
        self.kind = str(options.get("base_model") or options.get("kind") or "stub-echo")
        StubGenerator.loads += 1

    def answer(self, messages) -> str:
        user = _user(messages)
        if self.kind == "stub-lead":
            head = user.split(INPUT_SEPARATOR, 1)[0]
            return head + (" " + RISK_HINT_TOKENS[1] if len(user) % 2 == 0 else "")
        if self.kind == "stub-tail":
            return user[TAIL_FROM:]
        return "  " + user + " \n"

    def __call__(self, prompts):
        return [self.answer(p) for p in prompts]


# The stub models used by the driver checks.
STUB_MODELS = (
    "echo::stub-echo::-",
    "lead::stub-lead::none",
    "tail::stub-tail::adapters/tail",
)


class RecordingFactory:
    """Generator factory that appends each load to a file; answers reverse the prompt.

    Used to prove generators are built once per task and model, not per row.
    """

    def __init__(self, path: str):
        self.path = path

    def __call__(self, options: dict):
        with open(self.path, "a", encoding="utf-8") as f:
            f.write(f"{options.get('model_name')}\n")
        return lambda prompts: [_user(p)[::-1] for p in prompts]


class FailingGenerator(StubGenerator):
    """Like the echo stub, but raises on any prompt containing ``options["fail_on"]``.

    Used to prove that a failed distill run resumes without repeating or
    duplicating finished work.
    """

    def __init__(self, options: dict):
        super().__init__(options)
        self.marker = options.get("fail_on")

    def __call__(self, prompts):
        for p in prompts:
            if self.marker and self.marker in _user(p):
                raise RuntimeError(f"generator failed on a prompt containing {self.marker!r}")
        return super().__call__(prompts)


class OptionsRecorder:
    """Generator factory that appends the options it is given (JSON lines) to a file."""

    def __init__(self, path: str):
        self.path = path

    def __call__(self, options: dict):
        import json
        with open(self.path, "a", encoding="utf-8") as f:
            f.write(json.dumps(options, default=str) + "\n")
        return StubGenerator(options)


class Counted:
    """Notes each load and each generated batch as a file; kills its process once, at a marked prompt."""

    def __init__(self, folder, kill_at=None):
        self.folder, self.kill_at = folder, kill_at

    def _note(self, kind, name=""):
        with open(f"{self.folder}/{kind}-{os.getpid()}-{time.time_ns()}", "w", encoding="utf-8") as f:
            f.write(name)

    def __call__(self, options):
        self._note("load", options.get("model_name") or "")

        def run(prompts):
            said = [p[-1]["content"] for p in prompts]
            dead = f"{self.folder}/dead"
            if self.kill_at in said and not os.path.exists(dead):
                open(dead, "w", encoding="utf-8").close()
                os._exit(9)
            time.sleep(0.02)
            self._note("batch", "|".join(said))
            return [s[::-1] for s in said]

        return run
