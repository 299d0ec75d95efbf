"""Typed job parameters."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any

from precis.operators.encode import MAX_INPUT, MAX_TARGET
from precis.operators.summarize import MAX_WORDS, METHODS
from precis.operators.train import GRID
from precis.operators.validate import Contract
from precis.sources.splits import pair_schema


@dataclass(frozen=True)
class IngestConfig:
    """Where pairs come from and where the dataset goes.

    ``paths`` names a Parquet path for each split of a dataset of one's own, whose
    columns ``renames`` changes; without it the pairs come from ``source``.
    """

    source: str
    dataset: str
    splits: tuple[str, ...] = ("train", "validation", "test")
    paths: Mapping[str, str] = field(default_factory=dict)
    renames: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class ValidateConfig:
    dataset: str
    report: str
    required_splits: tuple[str, ...] = ("train", "test", "validation")
    required_columns: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    text_column: str = "dialogue"
    summary_column: str = "summary"

    def contract(self) -> Contract:
        """What stage 2 asks for; without ``required_columns`` id, text and summary of each split."""
        own = ("id", self.text_column, self.summary_column)
        columns = self.required_columns or {s: own for s in self.required_splits}
        return Contract(self.required_splits, columns, own[1:], pair_schema(*own[1:]))


@dataclass(frozen=True)
class EncodeConfig:
    dataset: str
    encoded: str
    max_input_length: int = MAX_INPUT
    max_target_length: int = MAX_TARGET
    text_column: str = "dialogue"
    summary_column: str = "summary"


@dataclass(frozen=True)
class TrainConfig:
    dataset: str
    model: str
    grid: tuple[float, ...] = GRID
    text_column: str = "dialogue"
    summary_column: str = "summary"


@dataclass(frozen=True)
class EvaluateConfig:
    dataset: str
    metrics: str
    models: tuple[str, ...] = ()
    methods: tuple[str, ...] = METHODS
    max_words: int = MAX_WORDS
    base: str = METHODS[0]  # stands in where no model is saved
    text_column: str = "dialogue"
    summary_column: str = "summary"


def read_yaml(path: str | Path) -> dict[str, Any]:
    """The parameters of a YAML file, which must hold a mapping with ``source`` and ``root``."""
    import yaml

    with open(path, encoding="utf-8") as file:
        parameters = yaml.safe_load(file)
    lacking = {"source", "root"} - set(parameters if isinstance(parameters, dict) else ())
    if lacking:
        raise ValueError(f"{path} sets no {' and no '.join(sorted(lacking))}")
    return parameters


def _build(kind: type, values: Mapping[str, Any]) -> Any:
    known = {f.name for f in fields(kind)}
    unknown = set(values) - known
    if unknown:
        raise ValueError(f"unknown parameters for {kind.__name__}: {sorted(unknown)}")
    return kind(**{k: tuple(v) if isinstance(v, list) else v for k, v in values.items()})


@dataclass(frozen=True)
class JobConfig:
    """Parameters of all five stages below one artifact folder."""

    ingest: IngestConfig
    validate: ValidateConfig
    encode: EncodeConfig
    train: TrainConfig
    evaluate: EvaluateConfig
    history: str

    @classmethod
    def at(cls, source: str, root: str, **sections: Mapping[str, Any]) -> JobConfig:
        """Defaults below ``root``, changed by the given sections.

        ``text_column`` and ``summary_column`` beside the sections hold for all stages.
        """
        data, model = f"{root}/dataset", f"{root}/model"
        encoded = f"{root}/encoded"
        names = {c: sections.pop(c) for c in ("text_column", "summary_column") if c in sections}

        def section(name: str, kind: type, **defaults: Any) -> Any:
            own = {c: n for c, n in names.items() if c in {f.name for f in fields(kind)}}
            return _build(kind, {**defaults, **own, **sections.get(name, {})})

        return cls(
            section("ingest", IngestConfig, source=source, dataset=data),
            section("validate", ValidateConfig, dataset=data, report=f"{root}/report"),
            section("encode", EncodeConfig, dataset=data, encoded=encoded),
            section("train", TrainConfig, dataset=data, model=model),
            section("evaluate", EvaluateConfig, dataset=data, metrics=f"{root}/metrics", models=(model,)),
            f"{root}/history",
        )

    @classmethod
    def from_yaml(cls, path: str | Path) -> JobConfig:
        """``source`` and ``root``, and optional sections named like the stages."""
        content = read_yaml(path)
        return cls.at(content.pop("source"), content.pop("root"), **content)
