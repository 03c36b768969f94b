"""Configuration of a library: a TOML file, with the environment above it."""

from __future__ import annotations

import os
import tomllib
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import SparkSession

from quillon.catalog import Subscription

#: Prefix of variables that override the file: QUILLON_LIBRARY_ROOT sets ``root`` of the table ``library``.
PREFIX = "QUILLON_"


@dataclass(frozen=True)
class Config:
    """``library`` names the library and its root; ``spark`` are session settings; ``providers`` what each reader needs."""

    library: Mapping[str, str] = field(default_factory=dict)
    spark: Mapping[str, str] = field(default_factory=dict)
    providers: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    subscriptions: tuple[Subscription, ...] = ()

    def session(self, builder: SparkSession.Builder) -> SparkSession:
        """A session with the settings of ``spark``."""
        for k, v in self.spark.items():
            builder = builder.config(k, v)
        return builder.getOrCreate()


def load(path: str | Path | None, environment: Mapping[str, str] | None = None) -> Config:
    """The configuration of a file; without one, or where it doesn't exist, of the environment alone.

    Variables are named by table and key (``QUILLON_LIBRARY_ROOT``, ``QUILLON_PROVIDERS_FRED_FOLDER``), settings of Spark with
    two underscores for a dot. An unknown table is an error.
    """
    env = os.environ if environment is None else environment
    body: dict = tomllib.loads(Path(path).read_text(encoding="utf-8")) if path and Path(path).exists() else {}
    if unknown := set(body) - {"library", "spark", "providers", "subscriptions"}:
        raise ValueError(f"{path} has unknown tables {sorted(unknown)}")
    library = {k: str(v) for k, v in body.get("library", {}).items()}
    spark = {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in body.get("spark", {}).items()}
    providers = {p: {k: str(v) for k, v in x.items()} for p, x in body.get("providers", {}).items()}
    for name, value in sorted(env.items()):
        if not name.startswith(PREFIX):
            continue
        table, _, key = name[len(PREFIX) :].lower().partition("_")
        if table == "library":
            library[key] = value
        elif table == "spark":
            spark["spark." + key.replace("__", ".")] = value
        elif table == "providers" and "_" in key:
            provider, _, k = key.partition("_")
            providers.setdefault(provider, {})[k] = value
    subscriptions = tuple(
        Subscription(s.get("id", ""), s["name"], s["provider"], s["dataset"], tuple(s["data_types"]), s.get("active", True)) for s in body.get("subscriptions", [])
    )
    return Config(library, spark, providers, subscriptions)
