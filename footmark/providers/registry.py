"""Provider registry (C6): a name -> provider mapping filled by a decorator."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T


@dataclass(frozen=True)
class Provider:
    """One data source: its raw schema, CRS, and a ``conform`` DataFrame transform.

    ``conform(df) -> df`` maps a raw layer to the six CONFORM columns; it is a
    pure DataFrame plan, so ``df.transform(provider.conform)`` composes with
    reading, masking and writing in one job.
    """

    name: str
    conform: Callable[[DataFrame], DataFrame]
    source_schema: T.StructType | None = None
    epsg: int = 5070
    doc: str = field(default="", compare=False)


_REGISTRY: dict[str, Provider] = {}


def register_provider(name: str, *, source_schema: T.StructType | None = None, epsg: int = 5070,
                      overwrite: bool = False):
    """Decorator registering ``conform`` under ``name``; a duplicate name raises unless ``overwrite``."""

    def deco(fn: Callable[[DataFrame], DataFrame]):
        if name in _REGISTRY and not overwrite:
            raise KeyError(f"provider {name!r} is already registered")
        _REGISTRY[name] = Provider(name, fn, source_schema, epsg, fn.__doc__ or "")
        return fn

    return deco


def get_provider(name: str) -> Provider:
    try:
        return _REGISTRY[name]
    except KeyError:
        raise KeyError(f"unknown provider {name!r}") from None


def list_providers() -> list[str]:
    return list(_REGISTRY)


def iter_providers() -> Iterator[Provider]:
    return iter(list(_REGISTRY.values()))


def unregister_provider(name: str) -> None:
    _REGISTRY.pop(name, None)
