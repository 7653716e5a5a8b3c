"""Settings as dataclasses: defaults, paths derived from them, and overrides from dicts or JSON files."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from dataclasses import dataclass, field, fields, is_dataclass, replace
from pathlib import Path
from typing import Any


class ConfigError(ValueError):
    """A setting that is unknown or of the wrong kind."""


@dataclass(frozen=True)
class SectionRank:
    section: str
    rank: int
    weight: float


#: Sections of a publication, their ranks and weights.
SECTION_RANKS = (
    SectionRank("title", 1, 1.0),
    SectionRank("abstract", 1, 0.8),
    SectionRank("concl", 1, 0.7),
    SectionRank("results", 2, 0.6),
    SectionRank("discuss", 2, 0.5),
    SectionRank("methods", 3, 0.3),
    SectionRank("other", 4, 0.1),
)


@dataclass(frozen=True)
class Word2VecSettings:
    window_size: int = 10
    num_partitions: int = 16
    max_iter: int = 3
    min_count: int = 1
    step_size: float = 0.02
    vector_size: int = 100
    max_sentence_length: int = 1000
    seed: int = 42
    #: Whether vectors are to be the same in every run (skip-gram of this library), or learnt by the engine's Word2Vec.
    repeatable: bool = True


@dataclass(frozen=True)
class Config:
    """Everything a run needs. Paths that aren't set follow from base and output_format."""

    base: str = "."
    output_format: str = "json"
    mode: str = "errorifexists"
    threshold: float = 0.01
    section_ranks: tuple[SectionRank, ...] = SECTION_RANKS
    word2vec: Word2VecSettings = field(default_factory=Word2VecSettings)
    paths: Mapping[str, str] = field(default_factory=dict)
    #: Spark settings of the run's session, over the library's own.
    session: Mapping[str, str] = field(default_factory=dict)

    INPUTS = {"epmcids": "inputs/PMID_PMCID_DOI.csv.gz", "diseases": "inputs/diseases", "targets": "inputs/targets", "drugs": "inputs/molecule", "epmc": "inputs/epmc"}
    OUTPUTS = ("matches", "cooccurrences", "failedMatches", "failedCooccurrences", "literatureIndex", "trainingSet", "W2VModel", "vectors", "evidence", "qualityReport", "quarantine")

    def path(self, name: str) -> str:
        if name in self.paths:
            return self.paths[name]
        if name in self.INPUTS:
            return f"{self.base}/{self.INPUTS[name]}"
        if name in self.OUTPUTS:
            return f"{self.base}/output/{self.output_format}/{name}"
        raise ConfigError(f"no path named {name!r}")


def override(config: Any, values: Mapping[str, Any]) -> Any:
    """config with values put in; nested settings take nested mappings."""
    known = {f.name: getattr(config, f.name) for f in fields(config)}
    changes: dict[str, Any] = {}
    for key, value in values.items():
        name = key.replace("-", "_")
        if name not in known:
            raise ConfigError(f"unknown setting {key!r}; known: {', '.join(sorted(known))}")
        if is_dataclass(known[name]) and isinstance(value, Mapping):
            changes[name] = override(known[name], value)
        elif name == "section_ranks":
            changes[name] = tuple(x if isinstance(x, SectionRank) else SectionRank(**x) for x in value)
        elif isinstance(known[name], (int, float, str)) and not isinstance(value, (type(known[name]), int)):
            raise ConfigError(f"{key!r} takes {type(known[name]).__name__}, not {value!r}")
        else:
            changes[name] = value
    return replace(config, **changes)


def _merged(below: Mapping[str, Any], above: Mapping[str, Any]) -> dict[str, Any]:
    """below with what above has in its place, mapping by mapping."""
    both = {k: _merged(below[k], v) if isinstance(v, Mapping) and isinstance(below.get(k), Mapping) else v for k, v in above.items()}
    return {**below, **both}


def _layers(path: Path, above: tuple[Path, ...] = ()) -> dict[str, Any]:
    """A JSON file's settings over those of the files that its `include` names, which are beside it."""
    if path.resolve() in above:
        raise ConfigError(f"{path} includes itself")
    values = json.loads(path.read_text(encoding="utf-8"))
    names = values.pop("include", [])
    merged: dict[str, Any] = {}
    for name in [names] if isinstance(names, str) else names:
        merged = _merged(merged, _layers(path.parent / name, (*above, path.resolve())))
    return _merged(merged, values)


def _substituted(value: Any, names: Mapping[str, Any], open_: tuple[str, ...] = ()) -> Any:
    """value with each ${name} in its strings replaced by what the name stands for."""
    def found(m: re.Match) -> str:
        if m[1] in open_ or not isinstance(names.get(m[1]), (str, int, float)):
            raise ConfigError(f"{m[0]} stands for no text or number" if m[1] not in open_ else f"{m[0]} stands for itself")
        return str(_substituted(names[m[1]], names, (*open_, m[1])))

    if isinstance(value, str):
        return re.sub(r"\$\{([^}]*)\}", found, value)
    if isinstance(value, Mapping):
        return {k: _substituted(v, names, open_) for k, v in value.items()}
    return [_substituted(v, names, open_) for v in value] if isinstance(value, list) else value


def load(path: str | None = None, **values: Any) -> Config:
    """The defaults, a JSON file's settings over them, and values over both.

    The file may `include` others, whose settings lie below its own, and say `${name}` in a string for one of
    its `vars` or of its plain settings.
    """
    settings = _merged(_layers(Path(path)) if path else {}, values)
    own = settings.pop("vars", {})
    return override(Config(), _substituted(settings, {**settings, **own}))
