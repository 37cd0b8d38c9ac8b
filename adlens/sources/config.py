"""Settings: a nested mapping with dotted access and environment overrides."""

from __future__ import annotations

import os
from pathlib import Path
from typing import Any

DEFAULTS: dict[str, Any] = {
    "panorama": {"overview_zoom": 2, "crop_zoom": 0},
    "detector": {"pos_strong": 0.25, "pos_weak": 0.10, "neg_margin": 0.10, "iou": 0.4, "max_per_panorama": 10, "max_candidates": 40},
    "crop": {"min_side": 30, "min_area": 1200, "max_area": 800_000, "pad": 0.10},
    "contacts": {"min_side": 220},
    "ocr": {"cloud_min_side": 220, "max_cloud_calls_per_panorama": 4},
    "crawl": {"min_distance_m": 75.0, "max_failures": 30},
    "dedup": {"radius_m": 25.0, "phone_radius_m": 300.0, "assumed_distance_m": 25.0},
}


def coerce(text: str) -> Any:
    """Booleans, then integers, then floats, else the text."""
    low = text.strip().lower()
    if low in ("true", "yes", "on"):
        return True
    if low in ("false", "no", "off"):
        return False
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            pass
    return text


class Settings:
    def __init__(self, values: dict[str, Any] | None = None, prefix: str = "ADLENS_"):
        self.values, self.prefix = values if values is not None else DEFAULTS, prefix

    @classmethod
    def load(cls, path: str | os.PathLike) -> Settings:
        import yaml

        return cls(yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {})

    def get(self, dotted: str, default: Any = None) -> Any:
        """Environment first (`crop.pad` is ADLENS_CROP_PAD), then the mapping, then the default."""
        env = os.environ.get(self.prefix + dotted.replace(".", "_").upper())
        if env is not None:
            return coerce(env)
        at: Any = self.values
        for part in dotted.split("."):
            if not isinstance(at, dict) or part not in at:
                return default
            at = at[part]
        return at
