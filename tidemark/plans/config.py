"""Driver-side configuration: layered dictionaries, dot paths, profiles, environment values."""

from __future__ import annotations

import copy
import json
import os
import re
from typing import Any

#: Parameter presets by kind of film.
PRESETS: dict[str, dict[str, Any]] = {
    "default": {"quality": 0.3, "motion": 0.1, "coverage": 0.7, "max_frames": 2000},
    "dark": {"quality": 0.15, "motion": 0.1, "coverage": 0.6, "max_frames": 2000},
    "action": {"quality": 0.2, "motion": 0.3, "coverage": 0.7, "max_frames": 3000},
    "dialogue": {"quality": 0.4, "motion": 0.05, "coverage": 0.8, "max_frames": 1500},
    "crowd": {"quality": 0.3, "motion": 0.1, "coverage": 0.7, "max_frames": 3000},
    "fast": {"quality": 0.5, "motion": 0.2, "coverage": 0.5, "max_frames": 600},
}


def merged(base: dict, over: dict) -> dict:
    """``base`` with ``over`` laid on it, subtree by subtree."""
    out = copy.deepcopy(base)
    for k, v in over.items():
        out[k] = merged(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else copy.deepcopy(v)
    return out


def expanded(value: Any, env: dict[str, str] | None = None) -> Any:
    """${NAME} replaced wherever a string holds it; an unset name stays as written."""
    env = dict(os.environ) if env is None else env
    if isinstance(value, dict):
        return {k: expanded(v, env) for k, v in value.items()}
    if isinstance(value, list):
        return [expanded(v, env) for v in value]
    return re.sub(r"\$\{(\w+)\}", lambda m: env.get(m[1], m[0]), value) if isinstance(value, str) else value


class Config:
    def __init__(self, values: dict | None = None, env: dict[str, str] | None = None):
        self.values = expanded(values or {}, env)

    @classmethod
    def load(cls, *paths: str, profile: str | None = None) -> Config:
        """JSON files (YAML where a parser is installed), later ones on top, then a profile's overrides."""
        values: dict = {}
        for path in paths:
            with open(path) as f:
                text = f.read()
            try:
                part = json.loads(text)
            except json.JSONDecodeError:
                import yaml

                part = yaml.safe_load(text) or {}
            values = merged(values, part)
        if profile is not None:
            if profile not in values.get("profiles", {}):
                raise KeyError(f"unknown profile {profile!r}")
            values = merged(values, values["profiles"][profile].get("overrides", values["profiles"][profile]))
        return cls(values)

    def get(self, path: str, default: Any = None) -> Any:
        at: Any = self.values
        for part in path.split("."):
            if not isinstance(at, dict) or part not in at:
                return default
            at = at[part]
        return at

    def set(self, path: str, value: Any) -> None:
        *parents, last = path.split(".")
        at = self.values
        for part in parents:
            at = at.setdefault(part, {})
        at[last] = value
