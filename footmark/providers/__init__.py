"""Provider conforms (C1-C5) and the registry.

Importing this package registers the five built-in providers.
"""

from . import conform as _builtin  # noqa: F401  (registers providers)
from .registry import Provider, get_provider, iter_providers, list_providers, register_provider

__all__ = ["Provider", "get_provider", "iter_providers", "list_providers", "register_provider"]
