"""X-20: JSON parameters (weights, name maps) as a Python dict for the
driver-side plan, or as a map column parsed by Spark."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_params(text: str | None, defaults: dict | None = None) -> dict:
    """Given JSON text overrides known keys of the defaults; unknown keys are ignored."""
    out = dict(defaults or {})
    if text:
        for k, v in json.loads(text).items():
            if not defaults or k in defaults:
                out[k] = v
    return out


def json_map(col, value_type: str = "double") -> Column:
    """A JSON object column as MAP<STRING, value_type>."""
    c = F.col(col) if isinstance(col, str) else col
    return F.from_json(c, f"map<string,{value_type}>")
