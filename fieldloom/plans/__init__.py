"""Every registered query; ``load_all`` imports the modules that register them."""

from __future__ import annotations

from importlib import import_module

MODULES = ("profiling", "cleaning", "splitting", "preparation", "text", "evaluation", "modelling", "tuning", "storage")


def load_all():
    for name in MODULES:
        import_module(f"fieldloom.plans.{name}")
    return import_module("fieldloom.plans.registry")
