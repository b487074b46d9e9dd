"""Query plans over the supplied tables. Importing this package fills the registry."""

import importlib
import pkgutil

from lakeops.plans.registry import ORACLES, QUERIES

for _module in pkgutil.iter_modules(__path__):
    importlib.import_module(f"{__name__}.{_module.name}")

__all__ = ["ORACLES", "QUERIES"]
