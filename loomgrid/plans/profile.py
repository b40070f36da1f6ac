"""Validation profiles: a closed set of keys with defaults and bounds, merged and checked on the driver."""

from __future__ import annotations

import json
import math
from dataclasses import dataclass
from typing import Any

# The profile's keys with their defaults and bounds. A bound is ("choice", ...), ("bool",),
# ("names",), or (kind, least, exclusive, most, null allowed).
VERSION = "1.0"
KEYS: dict[str, tuple[Any, tuple]] = {
    "input.policy": ("drop", ("choice", "off", "warn", "fail", "drop")),
    "input.drop_on": ("fail", ("choice", "warn", "fail")),
    "input.source_gap_min_seconds": (1.0, ("number", 0, True, None, False)),
    "input.source_gap_factor": (5.0, ("number", 1, True, None, False)),
    "input.source_drop_factor": (2.5, ("number", 1, True, None, False)),
    "input.minimum_camera_source_frames": (2, ("int", 2, False, None, False)),
    "input.duplicate_min_source_frames": (2, ("int", 2, False, None, False)),
    "input.state_motion_threshold": (1e-4, ("number", 0, False, None, False)),
    "input.max_findings": (100, ("int", 1, False, None, False)),
    "dataset.fail_on": ("fail", ("choice", "warn", "fail")),
    "dataset.doctor.enabled": (True, ("bool",)),
    "video.features": (None, ("names",)),
    "video.max_episodes": (None, ("int", 1, False, None, True)),
    "video.thumbnail_size": (32, ("int", 8, False, None, False)),
    "video.duplicate_threshold": (0.1, ("number", 0, False, None, False)),
    "video.freeze_min_seconds": (1.0, ("number", 0, True, None, False)),
    "video.repeat_threshold": (0.1, ("number", 0, False, None, False)),
    "video.repeat_min_cycles": (3, ("int", 2, False, None, False)),
    "video.repeat_max_period_seconds": (5.0, ("number", 0, True, None, False)),
    "video.jump_percentile": (10.0, ("number", 0, True, 100, False)),
    "video.jump_min_score": (0.1, ("number", 0, False, None, False)),
    "video.artifact_block_threshold": (20.0, ("number", 0, True, None, False)),
    "video.artifact_min_block_fraction": (0.05, ("number", 0, True, 1, False)),
    "video.artifact_max_duration_frames": (3, ("int", 1, False, None, False)),
    "video.flat_frame_std_threshold": (2.0, ("number", 0, False, None, False)),
    "video.temporal_discontinuity_threshold": (5.0, ("number", 0, True, None, False)),
    "video.state_motion_support_threshold": (0.02, ("number", 0, False, None, False)),
    "video.max_findings": (100, ("int", 1, False, None, False)),
}


def checked(key: str, value: Any) -> Any:
    """The value, trimmed where it is a list of names; raises if it breaks the key's bound."""
    rule = KEYS[key][1]
    kind = rule[0]
    if kind == "choice":
        if value not in rule[1:]:
            raise ValueError(f"{key} must be one of {', '.join(rule[1:])}")
        return value
    if kind == "bool":
        if not isinstance(value, bool):
            raise ValueError(f"{key} must be true or false")
        return value
    if kind == "names":
        if value is None:
            return None
        names = [x.strip() if isinstance(x, str) else "" for x in value] if isinstance(value, list) else []
        if not names or not all(names) or len(set(names)) != len(names):
            raise ValueError(f"{key} must be null or unique non-empty names")
        return names
    _, least, exclusive, most, nullable = rule
    if value is None and nullable:
        return None
    if isinstance(value, bool) or not isinstance(value, int | float) or (kind == "int" and not isinstance(value, int)) or not math.isfinite(value):
        raise ValueError(f"{key} must be {'an integer' if kind == 'int' else 'a finite number'}")
    if value < least or (exclusive and value == least) or (most is not None and value > most):
        raise ValueError(f"{key} is out of bounds")
    return value


@dataclass(frozen=True)
class Profile:
    values: dict[str, Any]

    def __getitem__(self, key: str) -> Any:
        return self.values[key]

    def section(self, prefix: str) -> dict[str, Any]:
        return {k.removeprefix(prefix + "."): v for k, v in self.values.items() if k.startswith(prefix + ".")}

    def document(self) -> dict:
        """The effective profile, nested as in a file."""
        out: dict = {"version": VERSION}
        for key, value in self.values.items():
            *parents, last = key.split(".")
            node = out
            for p in parents:
                node = node.setdefault(p, {})
            node[last] = value
        return out


def _flat(node: dict, prefix: str, parents: set[str]) -> dict[str, Any]:
    out = {}
    for name, value in node.items():
        key = f"{prefix}{name}"
        if key in parents:
            if not isinstance(value, dict):
                raise ValueError(f"{key} must be an object")
            out |= _flat(value, key + ".", parents)
        elif key in KEYS:
            out[key] = value
        else:
            raise ValueError(f"unknown key {key}")
    return out


def load_profile(document: dict | str | None = None, explicit: dict[str, Any] | None = None) -> Profile:
    """Defaults, overlaid by a document, overlaid by explicit values; unknown keys are refused, bounds checked."""
    if isinstance(document, str):
        document = json.loads(document)
    supplied: dict[str, Any] = {}
    if document is not None:
        if not isinstance(document, dict) or document.get("version") != VERSION:
            raise ValueError(f"a profile is an object of version {VERSION}")
        parents = {".".join(k.split(".")[:n]) for k in KEYS for n in range(1, k.count(".") + 1)}
        supplied = _flat({k: v for k, v in document.items() if k != "version"}, "", parents)
    for key in explicit or {}:
        if key not in KEYS:
            raise ValueError(f"unknown key {key}")
    merged = {k: d for k, (d, _) in KEYS.items()} | supplied | (explicit or {})
    return Profile({k: checked(k, v) for k, v in merged.items()})
