"""Registered queries over the driver's tables, each with its SQL twin."""

from __future__ import annotations

import importlib

from veilframe.catalog.registry import QUERIES, Query

MODULES = ("keys", "cells", "measures", "synthetic")


def load_all() -> dict[str, Query]:
    for module in MODULES:
        importlib.import_module(f"{__name__}.{module}")
    return QUERIES
