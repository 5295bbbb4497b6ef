"""Registry of named queries: a Spark callable ``(spark, sf_dir) -> DataFrame``
and, where the semantics are expressible in SQL, the DuckDB oracle text."""

from __future__ import annotations

from collections.abc import Callable

REGISTRY: dict[str, tuple[Callable, str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def load() -> dict[str, tuple[Callable, str | None]]:
    import importlib
    for m in ("q_routing", "q_media", "q_text", "q_chunk", "q_retrieve", "q_sessions", "q_eval"):
        try:
            importlib.import_module(f"quire.plans.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"quire.plans.{m}":
                raise
    return REGISTRY
