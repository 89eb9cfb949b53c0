"""Settings of a build: text with variables, checked values, stage versions, and model output repair."""

from __future__ import annotations

import json
import os
import re
from dataclasses import dataclass

MODES = ("directed", "undirected")
_VARIABLE = re.compile(r"\$\{(\w+)(?::-([^}]*))?\}")


def expand(text: str, variables: dict[str, str] | None = None) -> str:
    """``${NAME}`` and ``${NAME:-default}`` replaced; a name without value or default is an error."""
    known = os.environ if variables is None else variables

    def value(m: re.Match) -> str:
        found = known.get(m[1]) or m[2]
        if found is None:
            raise KeyError(f"{m[1]} is not set")
        return found

    return _VARIABLE.sub(value, text)


@dataclass(frozen=True)
class NetworkSettings:
    """What a layered network is built with; wrong values raise before any job runs."""

    source_keywords: tuple[str, ...]
    target_keywords: tuple[str, ...]
    source_hops: int = 2
    target_hops: int = 2
    mode: str = "undirected"
    max_bridge_edges: int = 500_000
    max_nodes: int = 100_000
    max_edges: int = 1_000_000

    def __post_init__(self) -> None:
        faults = [f"{side} keywords are missing" for side in ("source", "target") if not any(k.strip() for k in getattr(self, f"{side}_keywords"))]
        faults += [f"{n} must not be negative" for n in ("source_hops", "target_hops") if getattr(self, n) < 0]
        faults += [f"{n} must be positive" for n in ("max_bridge_edges", "max_nodes", "max_edges") if getattr(self, n) < 1]
        if self.mode not in MODES:
            faults.append(f"mode must be one of {', '.join(MODES)}")
        if faults:
            raise ValueError("; ".join(faults))


def stage_version(base: str, prompts: dict[str, str], chunk: tuple[int, int] | None = None, most: int = 128) -> str:
    """Version of a stage: its own, those of its prompts in order, and the chunk size and overlap if there are chunks."""
    parts = [base, *(f"{k}={prompts[k]}" for k in sorted(prompts)), *([f"chunk={chunk[0]}/{chunk[1]}"] if chunk else [])]
    version = ";".join(parts)
    if len(version) > most:
        raise ValueError(f"the stage version has more than {most} characters")
    return version


def parse_model_output(text: str) -> dict:
    """The JSON object of a model's answer: a code fence around it is taken off, null qualifiers become empty."""
    bare = re.sub(r"^\s*```[\w-]*\s*\n?|\n?\s*```\s*$", "", text)
    body = json.loads(bare)
    if not isinstance(body, dict):
        raise ValueError("the answer is no object")
    for row in body.get("assertions") or ():
        if isinstance(row, dict) and row.get("qualifiers") is None:
            row["qualifiers"] = {}
    return body


def ask(call, check, question: str, corrections: int = 1) -> dict:
    """A valid answer of ``call(question)``: a fault that ``check`` or the parser names is put to the model, once by default."""
    asked = question
    for left in range(corrections, -1, -1):
        try:
            answer = parse_model_output(call(asked))
            check(answer)
            return answer
        except ValueError as e:
            if not left:
                raise
            asked = f"{question}\n\nThe last answer was refused: {e}. Answer again."
    raise AssertionError("unreachable")
