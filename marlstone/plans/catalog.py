"""The modules whose QUERIES and ORACLE make up the registry."""

from __future__ import annotations

import importlib
from types import ModuleType

NAMES = ("training", "relational", "registers", "entities", "serve")


def modules() -> list[ModuleType]:
    return [importlib.import_module(f"{__package__}.{n}") for n in NAMES]
