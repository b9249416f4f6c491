"""Multi-step plans and the registered queries over the driver tables."""

from importlib import import_module
from pkgutil import iter_modules


def load_all() -> None:
    """Import every query module so that its queries register."""
    for module in iter_modules(__path__):
        if module.name.startswith("queries_"):
            import_module(f"{__name__}.{module.name}")
