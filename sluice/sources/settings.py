"""Settings in sections, as a file of settings has them."""

from __future__ import annotations

import json
import os
from dataclasses import asdict, dataclass, field, fields, is_dataclass
from types import UnionType
from typing import Any, get_args, get_origin, get_type_hints

from sluice.sources.lists import _yaml

#: The environment variables that win over a file, behind a prefix, and the setting of each.
VARIABLES = {
    "MODEL": ("synthesizer", "model"),
    "PROXY_HTTP": ("proxy", "http"),
    "PROXY_HTTPS": ("proxy", "https"),
    "MAX_WORKERS": ("crawler", "max_workers"),
    "UNSPLASH_API_KEY": ("api_sources", "unsplash", "api_key"),
    "PEXELS_API_KEY": ("api_sources", "pexels", "api_key"),
    "FLICKR_API_KEY": ("api_sources", "flickr", "api_key"),
}


@dataclass
class Crawler:
    max_workers: int = 4
    timeout: int = 30
    retry_count: int = 3
    retry_delay: float = 1.0
    cookies_from_browser: str | None = None
    user_agents: list[str] = field(default_factory=list)


@dataclass
class Processor:
    target_resolution: tuple[int, int] = (1920, 1080)
    min_resolution: tuple[int, int] = (480, 360)
    blur_threshold: float = 100.0
    scene_threshold: float = 30.0
    phash_threshold: int = 8


@dataclass
class Synthesizer:
    api_key: str | None = None
    model: str | None = None
    max_retries: int = 5
    retry_delay: float = 2.0
    batch_size: int = 10


@dataclass
class Folders:
    raw_dir: str = "data/raw"
    processed_dir: str = "data/processed"
    synthetic_dir: str = "data/synthetic"
    checkpoint_dir: str = "data/.checkpoints"


@dataclass
class Proxy:
    enabled: bool = False
    http: str | None = None
    https: str | None = None
    rotation_enabled: bool = False
    proxy_list: list[str] = field(default_factory=list)


@dataclass
class Validator:
    enabled: bool = True
    enable_heuristic: bool = True
    enable_clip: bool = True
    clip_threshold: float = 0.25
    clip_model: str | None = None
    device: str | None = None
    batch_size: int = 32


@dataclass
class Source:
    enabled: bool = True
    api_key: str | None = None
    rate_limit: int = 100
    priority: int = 5


@dataclass
class Sources:
    unsplash: Source = field(default_factory=lambda: Source(rate_limit=50, priority=1))
    pexels: Source = field(default_factory=lambda: Source(rate_limit=200, priority=2))
    nasa: Source = field(default_factory=lambda: Source(rate_limit=0, priority=3))
    wikimedia: Source = field(default_factory=lambda: Source(rate_limit=0, priority=4))
    flickr: Source = field(default_factory=lambda: Source(rate_limit=3600, priority=5))


def _fitting(value: Any, kind: Any, place: str) -> Any:
    """The value as a setting of its kind; numbers may be given as text. Raises where it is of another kind."""
    if is_dataclass(kind):
        return _made(kind, value, place)
    kinds = get_args(kind) if isinstance(kind, UnionType) else (kind,)
    if value is None and type(None) in kinds:
        return None
    kind = kinds[0]
    inner = get_args(kind)
    try:
        if get_origin(kind) in (list, tuple) and isinstance(value, list | tuple):
            many = [_fitting(v, inner[0], place) for v in value]
            if get_origin(kind) is list or len(many) == len(inner):
                return get_origin(kind)(many)
        elif kind is bool and isinstance(value, bool) or kind is str and isinstance(value, str):
            return value
        elif kind in (int, float) and isinstance(value, int | float | str) and not isinstance(value, bool) and float(value) == kind(float(value)):
            return kind(value)
    except ValueError:
        pass
    raise ValueError(f"{place}: {value!r} doesn't fit")


def _made(cls: type, given: Any, place: str = "settings") -> Any:
    """A section from what a file says of it; what it doesn't say is as by default, what nobody asks for is left out."""
    if not isinstance(given, dict):
        raise ValueError(f"{place}: a section is expected")
    kinds = get_type_hints(cls)
    default = cls()
    chosen = {}
    for f in fields(cls):
        if f.name in given:
            value, kind = given[f.name], kinds[f.name]
            if is_dataclass(kind) and isinstance(value, dict):  # a source that a file names in part keeps its own defaults
                value = asdict(getattr(default, f.name)) | value
            chosen[f.name] = _fitting(value, kind, f"{place}.{f.name}")
    return cls(**chosen)


@dataclass
class Sections:
    """All settings, from JSON or YAML; environment variables win over the file where they aren't empty."""

    crawler: Crawler = field(default_factory=Crawler)
    processor: Processor = field(default_factory=Processor)
    synthesizer: Synthesizer = field(default_factory=Synthesizer)
    data: Folders = field(default_factory=Folders)
    proxy: Proxy = field(default_factory=Proxy)
    validator: Validator = field(default_factory=Validator)
    api_sources: Sources = field(default_factory=Sources)

    @classmethod
    def load(cls, path: str | None = None, env: dict[str, str] | None = None, prefix: str = "SLUICE_", variables: dict[str, tuple[str, ...]] | None = None) -> Sections:
        """From a file, if there is one. ``variables`` are further environment variables, by their whole names."""
        env = dict(os.environ) if env is None else env
        given: dict = {}
        if path and os.path.exists(path):
            with open(path, encoding="utf-8") as f:
                given = (_yaml().safe_load(f) if path.endswith((".yaml", ".yml")) else json.load(f)) or {}
        for name, place in [*((prefix + n, p) for n, p in VARIABLES.items()), *(variables or {}).items()]:
            if value := env.get(name):
                section = given
                for part in place[:-1]:
                    section[part] = section.get(part) or {}
                    section = section[part]
                section[place[-1]] = value
        return _made(cls, given)

    def save(self, path: str) -> None:
        given = json.loads(json.dumps(asdict(self)))
        os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
        with open(path, "w", encoding="utf-8") as f:
            if path.endswith((".yaml", ".yml")):
                _yaml().safe_dump(given, f, allow_unicode=True, sort_keys=False)
            else:
                json.dump(given, f, indent=2)

    def ensure_folders(self) -> None:
        for folder in asdict(self.data).values():
            os.makedirs(folder, exist_ok=True)

    def source_limits(self, spark):
        """(source, enabled, has_key, rate_limit, priority), for quotas and status."""
        rows = [(f.name, s.enabled, bool(s.api_key), s.rate_limit, s.priority) for f in fields(self.api_sources) for s in [getattr(self.api_sources, f.name)]]
        return spark.createDataFrame(rows, "source string, enabled boolean, has_key boolean, rate_limit int, priority int")
