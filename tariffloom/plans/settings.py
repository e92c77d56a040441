"""Job settings from the environment: anything unreadable falls back to its default."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass


def flag(env: Mapping[str, str], name: str, default: bool) -> bool:
    value = env.get(name, "").strip().lower()
    return True if value in ("1", "true", "yes", "on") else False if value in ("0", "false", "no", "off") else default


def positive(env: Mapping[str, str], name: str, default: int) -> int:
    try:
        return n if (n := int(env.get(name, "").strip())) > 0 else default
    except ValueError:
        return default


def choice(env: Mapping[str, str], name: str, options: tuple[str, ...], default: str) -> str:
    value = env.get(name, "").strip().lower()
    return value if value in options else default


@dataclass(frozen=True)
class Settings:
    """What a price job may be told; Spark itself decides on parallelism."""

    min_score: int = 2
    max_pages: int | None = None
    include_particulars: bool = False
    include_pack: bool = False
    output_kind: str = "csv"

    @classmethod
    def read(cls, env: Mapping[str, str] = os.environ) -> Settings:
        pages = positive(env, "TARIFF_MAX_PAGES", 0)
        return cls(positive(env, "TARIFF_MIN_SCORE", 2), pages or None, flag(env, "TARIFF_PARTICULARS", False), flag(env, "TARIFF_PACK", False), choice(env, "TARIFF_OUTPUT", ("csv", "parquet"), "csv"))
