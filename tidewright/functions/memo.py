"""A cache for functions that travel inside tasks (``functools.lru_cache`` objects pickle by reference only)."""

from __future__ import annotations

from collections.abc import Callable


def memo(f: Callable) -> Callable:
    """``f`` with its results kept by argument."""
    kept: dict = {}

    def kept_or_new(*args):  # noqa: ANN002, ANN202
        if args not in kept:
            kept[args] = f(*args)
        return kept[args]

    return kept_or_new
