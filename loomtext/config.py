"""Settings, read from the environment and from a .env file."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from pathlib import Path

_SETTING = re.compile(r"\s*(?:export\s+)?([A-Za-z_]\w*)\s*=\s*(\"(?:[^\"\\]|\\.)*\"|'[^']*'|[^#\n]*?(?=\s+#|\s*$))")


def env_file(path: str = ".env") -> dict[str, str]:
    """The settings of a file of NAME=value lines; none if there is no such file."""
    out: dict[str, str] = {}
    if Path(path).is_file():
        for line in Path(path).read_text(encoding="utf-8").splitlines():
            if m := _SETTING.match(line):
                value = m[2]
                if value[:1] == value[-1:] == '"' and len(value) > 1:
                    value = re.sub(r"\\(.)", lambda x: {"n": "\n", "t": "\t"}.get(x[1], x[1]), value[1:-1])
                elif value[:1] == value[-1:] == "'" and len(value) > 1:
                    value = value[1:-1]
                out[m[1]] = value
    return out


# fixed values: defaults of the settings
@dataclass(frozen=True)
class EngineConfig:
    provider: str = "stub"
    api_key: str = field(default="", repr=False)
    model: str = "offline-stub"
    temperature: float = 0.75
    max_tokens: int = 4096
    max_retries: int = 6
    retry_delay: float = 5.0
    request_delay: float = 0.0
    pairs_per_batch: int = 40
    pairs_per_chunk: int = 40
    chunk_min_words: int = 800
    chunk_max_words: int = 1800
    chunk_overlap_words: int = 100
    min_response_words: int = 20
    similarity_threshold: float = 0.85
    min_file_bytes: int = 1024
    min_book_words: int = 500
    section_min_words: int = 50
    passage_words: int = 2000
    leftover_words: int = 50
    header_share: float = 0.30
    header_floor: int = 2
    header_words: int = 8
    boundary_lines: int = 3
    fix_hyphenation: bool = False
    log_level: str = "INFO"
    save_every: int = 0  # chunks after which answers are written; 0: all at once offline, each one with a live provider

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> EngineConfig:
        """Settings from the environment and, where it doesn't have them, from ./.env; a Groq key goes before an OpenAI key, neither
        means the offline stub."""
        env = env_file() | dict(os.environ) if env is None else env
        groq, openai = env.get("GROQ_API_KEY", ""), env.get("OPENAI_API_KEY", "")
        base: dict = {"provider": "groq" if groq else "openai" if openai else "stub", "api_key": groq or openai}
        if groq:
            base |= {"model": "llama-3.3-70b-versatile", "request_delay": 12.0, "pairs_per_batch": 20}
        elif openai:
            base |= {"model": "gpt-4o"}
        names = {
            "LLM_MODEL": "model", "LLM_TEMPERATURE": "temperature", "LLM_MAX_TOKENS": "max_tokens", "LLM_MAX_RETRIES": "max_retries", "LLM_RETRY_DELAY": "retry_delay",
            "GROQ_INTER_REQUEST_DELAY": "request_delay", "PAIRS_PER_BATCH": "pairs_per_batch", "PAIRS_PER_CHUNK": "pairs_per_chunk", "CHUNK_MIN_WORDS": "chunk_min_words",
            "CHUNK_MAX_WORDS": "chunk_max_words", "CHUNK_OVERLAP_WORDS": "chunk_overlap_words", "MIN_RESPONSE_WORDS": "min_response_words",
            "SIMILARITY_THRESHOLD": "similarity_threshold", "LOG_LEVEL": "log_level", "SAVE_EVERY": "save_every",
        }
        kinds = {f.name: type(f.default) for f in fields(cls)}
        for variable, name in names.items():
            if env.get(variable):
                base[name] = kinds[name](env[variable])
        return cls(**base)

    def require_key(self) -> None:
        """A live provider needs a key."""
        if self.provider != "stub" and not self.api_key:
            raise EnvironmentError(f"no API key for {self.provider}")
