"""Named queries over the test tables, each with the DuckDB SQL it must agree with."""

import importlib
import pkgutil


def load_all() -> None:
    """Imports each module here, so that its queries are registered."""
    for module in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{module.name}")
