"""Counts taken in flight, while a table is being written, and what to do about them."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Observation

POLICIES = ("ignore", "warn", "fail")


class Alarm(Exception):
    """Counts that mean a broken input, under the policy ``fail``."""


class Watch:
    """Named counts of tables that are read anyway.

    ``on`` attaches aggregates to a table; they are complete once an action has run
    over it, and cost no scan of their own. A watched table must occur once in the
    plan that runs. ``judge`` applies the policy: ``ignore``, ``warn`` (a warning) or
    ``fail`` (an Alarm).
    """

    def __init__(self, policy: str = "warn"):
        if policy not in POLICIES:
            raise ValueError(f"policy must be one of {', '.join(POLICIES)}")
        self.policy = policy
        self._seen: dict[str, Observation] = {}

    def on(self, df: DataFrame, name: str, **counts: Column) -> DataFrame:
        self._seen[name] = Observation()
        return df.observe(self._seen[name], *[c.alias(k) for k, c in counts.items()])

    def counts(self, name: str) -> dict[str, int]:
        return {k: v or 0 for k, v in self._seen[name].get.items()}

    def judge(self, problems: list[str]) -> None:
        if not problems or self.policy == "ignore":
            return
        if self.policy == "fail":
            raise Alarm("; ".join(problems))
        for p in problems:
            warnings.warn(p, stacklevel=3)
