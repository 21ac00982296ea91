"""Settings of a deployment, from environment variables."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields

PREFIX = "LEXIFORM_"


@dataclass(frozen=True)
class Settings:
    """Limits that operators take as parameters, with their defaults."""

    min_block_chars: int = 8
    max_garbled_ratio: float = 0.20
    high_ocr_ratio: float = 0.40
    region_overlap: float = 0.90
    low_confidence: float = 0.65
    render_dpi: int = 220

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> Settings:
        """Each setting from LEXIFORM_<NAME>; a value that is no number of its kind, or negative, is an error that names it."""
        env = os.environ if env is None else env
        given = {}
        for f in fields(cls):
            raw = env.get(PREFIX + f.name.upper(), "").strip()
            if raw:
                try:
                    given[f.name] = type(f.default)(raw)
                except ValueError:
                    raise ValueError(f"{PREFIX}{f.name.upper()} must be {type(f.default).__name__}: {raw!r}") from None
                if given[f.name] < 0:
                    raise ValueError(f"{PREFIX}{f.name.upper()} must not be negative: {raw!r}")
        return cls(**given)
