"""Settings of a run: the environment before a file before defaults."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

PURPOSES = ("research", "production")


def load(defaults: Mapping[str, Any], path: str | None, environment: Mapping[str, str], prefix: str = "TESSERA_") -> dict[str, Any]:
    """Values of the defaults' names, in the types of the defaults; an unknown name in the file or an unknown purpose is an error."""
    import tomllib

    given: dict[str, Any] = {}
    if path:
        with open(path, "rb") as file:
            given = tomllib.load(file)
    unknown = sorted(set(given) - set(defaults))
    if unknown:
        raise KeyError(f"unknown settings: {', '.join(unknown)}")
    out = {**defaults, **given}
    for name, default in defaults.items():
        text = environment.get(prefix + name.upper())
        if text is not None:
            out[name] = text.strip().lower() in ("1", "true", "yes") if isinstance(default, bool) else type(default)(text) if default is not None else text
    if "purpose" in out and out["purpose"] not in PURPOSES:
        raise ValueError(f"purpose {out['purpose']!r} is none of {', '.join(PURPOSES)}")
    return out
