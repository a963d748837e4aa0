"""Constants of a deployment, each overridable by an environment variable of the same name with a prefix."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields

PREFIX = "LODESTRATA_"


@dataclass(frozen=True)
class Config:
    chunk_size: int = 600
    chunk_overlap: int = 60
    embed_batch: int = 64
    top_k: int = 8
    communities: int = 50
    critic_loops: int = 3
    fetch_tries: int = 3
    fetch_delay_s: float = 0.2
    fetch_at_once: int = 100
    fetch_per_host: int = 4
    fetch_most_bytes: int = 200 * 1024 * 1024

    @classmethod
    def from_environment(cls, env=os.environ) -> Config:
        found = {}
        for f in fields(cls):
            raw = env.get(PREFIX + f.name.upper())
            if raw is not None:
                found[f.name] = type(f.default)(raw)
        return cls(**found)
