"""Where a model's table lives."""

from __future__ import annotations


def table_name(layer: str | None, model: str, default: str = "default") -> str:
    """``layer.model``; without a layer the model goes to the default namespace."""
    return f"{(default if layer is None else layer).strip()}.{model}"
