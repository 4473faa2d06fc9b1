"""All registered queries by name."""

from __future__ import annotations

import importlib

from bazaarspark.checks.framework import Check

MODULES = ("marts", "declared", "payloads", "loads", "streams", "detection")


def checks() -> dict[str, Check]:
    found: dict[str, Check] = {}
    for module in MODULES:
        for check in importlib.import_module(f"bazaarspark.checks.{module}").CHECKS:
            if check.name in found:
                raise ValueError(f"two queries named {check.name}")
            found[check.name] = check
    return found
