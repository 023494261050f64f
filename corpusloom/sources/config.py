"""Configuration: defaults merged with overrides, dotted access, tools by name."""

from __future__ import annotations

from collections.abc import Mapping
from copy import deepcopy
from importlib import import_module
from typing import TYPE_CHECKING, Any

if TYPE_CHECKING:
    from corpusloom.operators.crawl import Options, Tools

#: The stages in their order; one that is missing, or named so, is the one that does least.
STAGES, NONE = ["crawler", "normalizer", "splitter", "sentence_filter", "sg_detector", "seed_creator", "url_filter", "decider", "saver"], "_I_"

DEFAULTS: dict[str, Any] = {
    "pipeline": {
        "_base_package": "corpusloom.sources.toolkit",
        "crawler": ".paragraph_crawler",
        "normalizer": ".normalizer",
        "splitter": ".splitter",
        "sentence_filter": ".rule_filter",
        "sg_detector": NONE,  # a model is the user's own
        "decider": ".new_sentence_decider",
        "url_filter": ".link_fixes",
        "seed_creator": ".weighted_seeds",
        "saver": NONE,
    },
    "crawler_options": {"keep_bad": False},
    "normalizer_options": {"fix_encoding": True, "strip_emojis": True},
    "splitter_options": {"more": True, "keep_newlines": True},
    "decider_options": {"min_ratio": 0.2},
    "options": {"min_proba": 0.85, "crawl_depth": 2, "num_workers": 1},
    "search": {"max_results": 10, "max_fetches": -1},
}


def merge(base: Mapping, override: Mapping) -> dict:
    """Deep merge; the override's values win, mappings are merged key by key."""
    out = deepcopy(dict(base))
    for k, v in override.items():
        out[k] = merge(out[k], v) if isinstance(v, Mapping) and isinstance(out.get(k), Mapping) else deepcopy(v)
    return out


def load(source: str | Mapping | None = None) -> dict:
    """Defaults merged with a mapping, or with a YAML or JSON file."""
    if source is None or isinstance(source, Mapping):
        return merge(DEFAULTS, source or {})
    if not isinstance(source, str):
        raise ValueError("a configuration is a path or a mapping")
    import yaml

    with open(source, encoding="utf-8") as f:
        return merge(DEFAULTS, yaml.safe_load(f) or {})


def get(config: Mapping, key: str, default: Any = None) -> Any:
    """A value by dotted key."""
    for part in key.split("."):
        if not isinstance(config, Mapping) or part not in config:
            return default
        config = config[part]
    return config


def put(config: dict, key: str, value: Any) -> None:
    *parents, last = key.split(".")
    for part in parents:
        config = config.setdefault(part, {})
    config[last] = value


def tool(name: str, base: str = "") -> Any:
    """What a name stands for: ``module.attribute``, below ``base`` if it begins with a period."""
    module, _, attribute = (base + name if name.startswith(".") else name).rpartition(".")
    return getattr(import_module(module), attribute)


def tools(config: Mapping) -> Tools:
    """The stages that a configuration names, each made with its options (``<stage>_options``)."""
    from corpusloom.operators.crawl import Tools

    named, made = config["pipeline"], {}
    for stage in STAGES:
        if named.get(stage, NONE) != NONE:
            try:
                made[stage] = tool(named[stage], named.get("_base_package", ""))(**(config.get(f"{stage}_options") or {}))
            except Exception as e:
                raise RuntimeError(f"can't make {stage} ({named[stage]})") from e
    return Tools(**made)


def options(config: Mapping) -> Options:
    """The general options, checked."""
    from corpusloom.operators.crawl import Options

    o = config["options"]
    if not 0 <= o["min_proba"] <= 1 or o["crawl_depth"] < 0:
        raise ValueError("min_proba lies between 0 and 1, crawl_depth isn't negative")
    return Options(min_proba=o["min_proba"], max_depth=o["crawl_depth"])
