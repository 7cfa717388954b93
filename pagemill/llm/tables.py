"""Tables over code points, built where they are first used."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


def code_points(value: Callable[[str], object], dtype: object = bool) -> np.ndarray:
    """value(chr(i)) for every code point; beyond the first two planes that of an ideograph, as nearly all are."""
    out = np.zeros(0x110000, dtype=dtype)
    out[:0x20000] = [value(chr(i)) for i in range(0x20000)]
    out[0x20000:0x32400] = value(chr(0x20000))
    out[0x32400:] = value(chr(0x40000))
    return out
