"""Configuration: frozen sections, presets, merging, validation, the catalogue of settings, and a fluent builder."""

from __future__ import annotations

import copy
from dataclasses import asdict, dataclass, field, fields, replace
from pathlib import Path


@dataclass(frozen=True)
class Pdf:
    path: str = ""
    start_page: int = 0
    end_page: int | None = None


@dataclass(frozen=True)
class Parsing:
    extract_tables: bool = True
    extract_images: bool = False
    table_strategy: str = "lines"


@dataclass(frozen=True)
class Normalization:
    remove_headers_footers: bool = True
    merge_broken_lines: bool = True
    normalize_whitespace: bool = True
    normalize_punctuation: bool = False  # off: the output differs otherwise
    header_footer_max_lines: int = 3
    min_line_length: int = 5


@dataclass(frozen=True)
class Chunking:
    size: int = 800
    overlap: int = 150
    min_chunk_size: int = 100
    split_by: str = "token"
    respect_sentence_boundary: bool = True


@dataclass(frozen=True)
class Quality:
    min_length: int = 200
    max_noise_ratio: float = 0.3
    min_info_density: float = 0.3
    max_repetition_ratio: float = 0.5
    garble_enabled: bool = True
    max_garble_ratio: float = 0.1
    llm_enabled: bool = True
    only_edge_chunks: bool = True
    edge_threshold: float = 0.6


@dataclass(frozen=True)
class Llm:
    enabled: bool = True
    provider: str = "ollama"
    model: str = "qwen:7b"
    endpoint: str = "http://localhost:11434"
    max_calls: int = 500
    timeout: int = 60
    retry_times: int = 3
    temperature: float = 0.1


@dataclass(frozen=True)
class Output:
    dir: str = "data/output"


@dataclass(frozen=True)
class Runtime:
    batch_size: int = 10
    save_interval: int = 50
    log_level: str = "INFO"


@dataclass(frozen=True)
class Config:
    pdf: Pdf = field(default_factory=Pdf)
    parsing: Parsing = field(default_factory=Parsing)
    normalization: Normalization = field(default_factory=Normalization)
    chunk: Chunking = field(default_factory=Chunking)
    quality: Quality = field(default_factory=Quality)
    llm: Llm = field(default_factory=Llm)
    output: Output = field(default_factory=Output)
    runtime: Runtime = field(default_factory=Runtime)

    @classmethod
    def from_dict(cls, d: dict) -> Config:
        """Known keys of known sections; the nested quality sections are flattened; the rest keeps its default."""
        d = copy.deepcopy(d)
        q = d.get("quality") or {}
        garble, llm = q.pop("garble_detection", None) or {}, q.pop("llm_validation", None) or {}
        q |= {k: v for k, v in (("garble_enabled", garble.get("enabled")), ("max_garble_ratio", garble.get("max_garble_ratio"))) if v is not None}
        q |= {k: v for k, v in (("llm_enabled", llm.get("enabled")), ("only_edge_chunks", llm.get("only_edge_chunks")), ("edge_threshold", llm.get("edge_threshold"))) if v is not None}
        sections = {}
        for f in fields(cls):
            kind, given = f.default_factory, (q if f.name == "quality" else d.get(f.name)) or {}
            names = {x.name for x in fields(kind)}
            sections[f.name] = kind(**{k: v for k, v in given.items() if k in names})
        return cls(**sections)

    def validate(self, base_dir: str | Path | None = None) -> list[str]:
        """What is wrong, in words; an empty list if nothing is."""
        bad = []
        if self.pdf.path and base_dir is not None and not (Path(base_dir) / self.pdf.path).exists():
            bad.append(f"pdf.path does not exist: {self.pdf.path}")
        if self.chunk.size <= 0:
            bad.append("chunk.size must be above 0")
        if not 0 <= self.chunk.overlap < max(self.chunk.size, 1):
            bad.append("chunk.overlap must be at least 0 and below chunk.size")
        if self.quality.min_length < 0:
            bad.append("quality.min_length must be at least 0")
        if not 0 <= self.quality.max_noise_ratio <= 1:
            bad.append("quality.max_noise_ratio must be from 0 to 1")
        if self.llm.enabled and not (self.llm.endpoint and self.llm.model):
            bad.append("llm.endpoint and llm.model are needed while llm.enabled")
        return bad


# What the presets set, by section and key.
PRESETS: dict[str, dict] = {
    "fast": {
        "parsing": {"extract_tables": False, "extract_images": False, "table_strategy": "text"},
        "normalization": {"header_footer_max_lines": 2, "min_line_length": 10},
        "chunk": {"size": 1200, "overlap": 100, "min_chunk_size": 200, "respect_sentence_boundary": False},
        "quality": {"min_length": 100, "max_noise_ratio": 0.5, "min_info_density": 0.2, "max_repetition_ratio": 0.7, "garble_detection": {"max_garble_ratio": 0.2}, "llm_validation": {"enabled": False, "only_edge_chunks": False, "edge_threshold": 0.5}},
        "llm": {"enabled": False, "max_calls": 0},
        "runtime": {"batch_size": 20, "save_interval": 100},
    },
    "balanced": {
        "parsing": {"extract_tables": True, "extract_images": False, "table_strategy": "lines"},
        "normalization": {"header_footer_max_lines": 3, "min_line_length": 5},
        "chunk": {"size": 800, "overlap": 150, "min_chunk_size": 100, "respect_sentence_boundary": True},
        "quality": {"min_length": 200, "max_noise_ratio": 0.3, "min_info_density": 0.3, "max_repetition_ratio": 0.5, "garble_detection": {"max_garble_ratio": 0.1}, "llm_validation": {"enabled": True, "only_edge_chunks": True, "edge_threshold": 0.6}},
        "llm": {"enabled": True, "max_calls": 500},
        "runtime": {"batch_size": 10, "save_interval": 50},
    },
    "high_quality": {
        "parsing": {"extract_tables": True, "extract_images": True, "table_strategy": "lines_strict"},
        "normalization": {"header_footer_max_lines": 3, "min_line_length": 3},
        "chunk": {"size": 600, "overlap": 200, "min_chunk_size": 150, "respect_sentence_boundary": True},
        "quality": {"min_length": 300, "max_noise_ratio": 0.2, "min_info_density": 0.4, "max_repetition_ratio": 0.3, "garble_detection": {"max_garble_ratio": 0.05}, "llm_validation": {"enabled": True, "only_edge_chunks": False, "edge_threshold": 0.7}},
        "llm": {"enabled": True, "max_calls": 2000},
        "runtime": {"batch_size": 5, "save_interval": 20},
    },
    "expert": {},
}
DEFAULT_STRATEGY = "balanced"


def merged(base: dict, over: dict) -> dict:
    """Dictionaries merge key by key; anything else is replaced."""
    out = copy.deepcopy(base)
    for k, v in over.items():
        out[k] = merged(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else copy.deepcopy(v)
    return out


def final_config(strategy: str | None = None, user: dict | None = None, overrides: dict | None = None) -> dict:
    """Overrides before user settings before the preset; "expert" takes user settings alone."""
    name = strategy or DEFAULT_STRATEGY
    if name not in PRESETS:
        raise ValueError(f"unknown strategy {name!r}; there are {', '.join(PRESETS)}")
    base = {} if name == "expert" else PRESETS[name]
    out = merged(merged(base, user or {}), overrides or {})
    out.setdefault("metadata", {})["strategy"] = name
    return out


def validate_dict(d: dict) -> list[str]:
    """Missing sections and bad values of a configuration dictionary."""
    missing = [f"section {s} is missing" for s in ("pdf", "chunk", "quality", "output") if s not in d]
    return missing + Config.from_dict(d).validate()


def load_yaml(path: str | Path) -> dict:
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("reading YAML needs the package pyyaml") from e
    return yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}


#: What each preset is for.
ABOUT = {
    "fast": "large chunks, no tables, no reviews: for a first look",
    "balanced": "tables, reviews of doubtful chunks: the default",
    "high_quality": "small chunks with wide overlap, strict rules, every chunk reviewed",
    "expert": "nothing is set: the user's settings alone",
}


def strategy_info(name: str) -> dict:
    """What there is to know of a preset; an unknown one is not available."""
    if name not in PRESETS:
        return {"name": name, "description": "", "available": False, "is_default": False, "settings": {}}
    return {"name": name, "description": ABOUT[name], "available": True, "is_default": name == DEFAULT_STRATEGY, "settings": copy.deepcopy(PRESETS[name])}


def strategies() -> list[dict]:
    return [strategy_info(n) for n in PRESETS]


# Settings, what they bear on, the recommended value, type, range and unit.
CATALOGUE = [
    ("chunk.size", "quality cost", "800", "int", "200..2000", "tokens"),
    ("chunk.overlap", "quality cost", "150", "int", "0..500", "tokens"),
    ("chunk.min_chunk_size", "quality", "100", "int", "50..500", "tokens"),
    ("chunk.split_by", "quality performance", "token", "enum", "token|sentence|char", None),
    ("chunk.respect_sentence_boundary", "quality", "true", "bool", None, None),
    ("quality.min_length", "quality", "200", "int", "50..1000", "characters"),
    ("quality.max_noise_ratio", "quality", "0.3", "float", "0..1", None),
    ("quality.min_info_density", "quality", "0.3", "float", "0..1", None),
    ("quality.max_repetition_ratio", "quality", "0.5", "float", "0..1", None),
    ("quality.garble_detection.enabled", "quality", "true", "bool", None, None),
    ("quality.garble_detection.max_garble_ratio", "quality", "0.1", "float", "0..0.5", None),
    ("quality.llm_validation.enabled", "quality cost performance", "true", "bool", None, None),
    ("quality.llm_validation.only_edge_chunks", "cost performance", "true", "bool", None, None),
    ("quality.llm_validation.edge_threshold", "cost", "0.6", "float", "0..1", None),
    ("llm.enabled", "quality cost performance", "true", "bool", None, None),
    ("llm.provider", "all", "ollama", "enum", "ollama", None),
    ("llm.model", "quality cost performance", "qwen:7b", "str", None, None),
    ("llm.endpoint", "all", "http://localhost:11434", "str", None, None),
    ("llm.max_calls", "cost performance", "500", "int", "0..10000", "calls"),
    ("llm.timeout", "performance", "60", "int", "10..300", "seconds"),
    ("llm.temperature", "quality", "0.1", "float", "0..1", None),
    ("parsing.extract_tables", "quality performance", "true", "bool", None, None),
    ("parsing.extract_images", "quality", "false", "bool", None, None),
    ("parsing.table_strategy", "quality performance", "lines", "enum", "lines|text|lines_strict", None),
    ("runtime.batch_size", "performance", "10", "int", "1..100", "pages"),
    ("runtime.save_interval", "performance", "50", "int", "10..500", "pages"),
    ("runtime.enable_checkpoint", "performance", "true", "bool", None, None),
]


def settings_by_impact(impact: str) -> list[str]:
    """Keys that bear on quality, cost or performance; those that bear on all always count."""
    return [k for k, i, *_ in CATALOGUE if impact in i.split() or i == "all"]


class Builder:
    """Fluent changes to a configuration: Builder().with_preset("fast").with_chunk_size(600, 60).build()."""

    def __init__(self, config: Config | None = None):
        self._config = config or Config()

    def with_preset(self, name: str) -> Builder:
        return Builder(Config.from_dict(merged(asdict(self._config), final_config(name))))

    def with_yaml(self, path: str) -> Builder:
        return Builder(Config.from_dict(load_yaml(path)))

    def with_pdf(self, path: str) -> Builder:
        return Builder(replace(self._config, pdf=replace(self._config.pdf, path=path)))

    def with_chunk_size(self, size: int, overlap: int) -> Builder:
        return Builder(replace(self._config, chunk=replace(self._config.chunk, size=size, overlap=overlap)))

    def with_llm(self, enabled: bool) -> Builder:
        return Builder(replace(self._config, llm=replace(self._config.llm, enabled=enabled)))

    def build(self) -> Config:
        if bad := self._config.validate():
            raise ValueError("; ".join(bad))
        return self._config
