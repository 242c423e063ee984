"""What a Python worker keeps between tasks, beside the encoders: the state of one operator at a time.

Workers are used again by later operators, in which what an earlier one remembers would only take memory.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable
from typing import Any

_kept: dict[Hashable, Any] = {}


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` gave for the key in this worker; that of another key goes."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def forget() -> None:
    _kept.clear()
