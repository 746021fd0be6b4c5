"""Rules from a file, through Hadoop's file systems: YAML in sections (purity, counting, labeling), or an object of rule values.

YAML needs the yaml package, which need not be installed; JSON is read without it. Sections and values that a file lacks
keep their defaults; names that mean nothing here are an error, but for sections that other parts of a job read.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import SparkSession

from tallyspark.functions.rules import DEFAULT, Pattern, Rules, patterns

# What a file's names stand for.
LEXICONS = {
    "bomb_positive": "target", "craft_kit": "kit", "companions": "companion", "ingredients": "ingredient", "substitute": "substitute", "surprise": "surprise", "inside": "inside",
}
COUNTING = {
    "number_words": "number_words", "pattern_priority": "priority", "source_weights": "weights", "conflict_needs_review": "conflict_needs_review", "max_count": "max_count",
    "default_single": "default_single",
}
TAGS = {"x_bombs": "n_x_bombs", "x_weight": "n_x_weight", "count_near_bomb": "near_", "n_bath_bomb": "near_bombs"}
ONE_IS_NONE = ("pack_of",)
SECTIONS = ("purity", "counting", "labeling")


@dataclass(frozen=True)
class Config:
    rules: Rules = DEFAULT
    sample_size: int = 300
    seed: int = 42


def _known(values: dict, names: tuple[str, ...], where: str) -> None:
    unknown = sorted(set(values) - set(names))
    if unknown:
        raise ValueError(f"unknown names in {where}: {', '.join(unknown)}")


def pattern_of(name: str, regex: str) -> Pattern:
    """A pattern with named groups n, or a and b to be multiplied, and unit, as one with numbered groups."""
    groups = re.compile(regex).groupindex
    if "n" not in groups and not {"a", "b"} <= set(groups):
        raise ValueError(f"pattern {name} has no group n, nor a and b")
    plain = re.sub(r"\(\?P<\w+>", "(", regex)
    return Pattern(TAGS.get(name, name), plain, groups.get("n") or groups["a"], groups.get("b"), groups.get("unit"), over_one=name in ONE_IS_NONE)


def config_of(values: dict) -> Config:
    """The rules and sample settings of a file's content."""
    if not set(SECTIONS) & set(values):
        return Config(Rules.of(values))
    out: dict = {}
    purity, counting, labeling = (dict(values.get(s) or {}) for s in SECTIONS)
    _known(purity, ("strict", "lexicon"), "purity")
    lexicon = purity.get("lexicon") or {}
    _known(lexicon, tuple(LEXICONS), "purity.lexicon")
    # Terms of a section bring their own boundaries.
    out |= {LEXICONS[k]: v if isinstance(v, str) else "|".join(v) for k, v in lexicon.items()}
    if "strict" in purity:
        out["strict"] = purity["strict"]
    _known(counting, (*COUNTING, "text_channels", "patterns", "confidence", "resolution_order"), "counting")
    out |= {COUNTING[k]: v for k, v in counting.items() if k in COUNTING}
    if "text_channels" in counting:
        out["channels"] = {k: tuple(v) for k, v in counting["text_channels"].items()}
    if "confidence" in counting:
        out["confidence"] = {k.removeprefix("text_"): v for k, v in counting["confidence"].items()}
    if "patterns" in counting:
        given = {p.tag: p for p in (pattern_of(k, v) for k, v in counting["patterns"].items())}
        # In the order of the defaults, as the first of equal hits counts; spelled numbers follow from their words.
        usual = patterns(out.get("number_words", DEFAULT.number_words))
        out["patterns"] = (*(given.pop(p.tag, p) for p in usual), *given.values())
    if "class_labels" in labeling:
        out["class_labels"] = tuple(labeling["class_labels"])
    return Config(Rules.of(out), labeling.get("sample_size", 300), labeling.get("seed", 42))


def load(spark: SparkSession, path: str) -> Config:
    """The config of a YAML or JSON file."""
    rows = spark.read.text(path, wholetext=True).limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"{path} is not one file")
    text = rows[0]["value"]
    if text.lstrip().startswith("{"):
        return config_of(json.loads(text))
    try:
        import yaml
    except ImportError as e:
        raise ValueError(f"{path} is YAML, and the yaml package is not installed") from e
    return config_of(yaml.safe_load(text) or {})
