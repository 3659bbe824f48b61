"""All statements by query name."""

from . import business, insights, modelling, preparation
from .base import statement

MODULES = [business, preparation, insights, modelling]


def all_statements() -> dict[str, str]:
    return {name: statement(body) for module in MODULES for name, body in module.SQL.items()}
