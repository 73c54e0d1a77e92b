"""Bindings of the library operators to the driver tables."""

import importlib

_MODULES = ["catalog", "analytics", "support", "sources", "models", "streams", "gates"]


def load_all() -> None:
    for m in _MODULES:
        importlib.import_module(f"lanthorn.plans.{m}")
