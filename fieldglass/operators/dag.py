"""Named steps run in the order of what they need."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from graphlib import CycleError, TopologicalSorter


@dataclass
class Step:
    run: Callable[[dict], object]
    needs: list[str] = field(default_factory=list)
    allow_failure: bool = False


def run_steps(steps: dict[str, Step]) -> dict[str, tuple[str, object]]:
    """{name: (status, result or error)}, status done, failed or skipped.

    A step sees the results of those before it. What needs a failed or skipped
    step is skipped, unless that step may fail. ValueError on cycles and on
    unknown names.
    """
    for name, s in steps.items():
        for n in s.needs:
            if n not in steps:
                raise ValueError(f"{name} needs unknown step {n}")
    try:
        order = list(TopologicalSorter({n: s.needs for n, s in steps.items()}).static_order())
    except CycleError as e:
        raise ValueError(f"cycle: {e.args[1]}") from e
    out: dict[str, tuple[str, object]] = {}
    for name in order:
        step = steps[name]
        if any(out[n][0] != "done" and not steps[n].allow_failure for n in step.needs):
            out[name] = ("skipped", None)
            continue
        try:
            out[name] = ("done", step.run({n: r for n, (s, r) in out.items() if s == "done"}))
        except Exception as e:
            out[name] = ("failed", e)
    return out
