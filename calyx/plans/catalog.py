"""All registered queries: importing this module fills the registry."""

from __future__ import annotations

from . import q_aggregates  # noqa: F401
from .registry import ORACLES, QUERIES


def _load_all():
    import importlib
    for m in ("q_aggregates", "q_records", "q_calendar", "q_storage", "q_streaming"):
        try:
            importlib.import_module(f"{__package__}.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"{__package__}.{m}":
                raise


_load_all()


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict:
    return {k: v for k, v in ORACLES.items() if k in QUERIES}
