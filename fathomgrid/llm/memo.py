"""What a worker remembers of words it has met, in two generations."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Hashable


class Memo(dict):
    """Values by key, made on first use.

    At `held` keys the younger generation becomes the older one and the older is dropped, so keys in steady use
    are never made again and at most twice `held` are in memory.
    """

    def __init__(self, make: Callable, held: int):
        super().__init__()
        self.make, self.held = make, held
        self.older: dict = {}

    def __missing__(self, key: Hashable):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.held:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def per_worker(key: tuple, make: Callable):
    """One object per worker process and key, so that what it remembers serves later tasks too."""
    state = sys.modules.setdefault("_fathomgrid_worker", types.ModuleType("_fathomgrid_worker"))
    held = state.__dict__.setdefault("objects", {})
    if key not in held:
        held[key] = make()
    return held[key]
