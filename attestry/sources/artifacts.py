"""Small documents that steer a run (rule sets, contracts, cases), read strictly."""

from __future__ import annotations

import json
from decimal import Decimal


def strict_object(text: str) -> dict:
    """The object of a JSON text; a key twice, a fraction, NaN or an infinity is an error."""

    def pairs(found: list[tuple[str, object]]) -> dict:
        keys = [k for k, _ in found]
        twice = {k for k in keys if keys.count(k) > 1}
        if twice:
            raise ValueError(f"key twice: {', '.join(sorted(twice))}")
        return dict(found)

    def refused(number: str) -> Decimal:
        raise ValueError(f"not a whole number: {number}")

    value = json.loads(text.removeprefix("﻿"), object_pairs_hook=pairs, parse_float=refused, parse_constant=refused)
    if not isinstance(value, dict):
        raise ValueError("not an object")
    return value
