"""Registered queries. Importing the modules fills the registry."""

import importlib

_MODULES = ("relational", "corpus", "search", "dialogs", "routing", "answers", "upkeep", "wording")


def load() -> None:
    for module in _MODULES:
        importlib.import_module(f"{__name__}.{module}")
