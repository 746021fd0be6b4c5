"""The rule set: words, patterns, weights. Another product family is another rule set."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields
from pathlib import Path


def _terms(given: list[str] | tuple[str, ...]) -> str:
    """One alternation of plain terms, each with word boundaries around it."""
    return "|".join(rf"\b(?:{t})\b" for t in given)


# The vocabulary, patterns, priorities, weights and labels that results depend on.
TARGET = (r"\bbath bombs?\b", r"\bbath fizz(?:y|ies|er|ers)?\b", r"\bbath bursts?\b", r"\bbath blasters?\b", r"\bshower bombs?\b", r"\baromabombs?\b")
KIT = (
    r"\bcraft kit\b", r"\bdiy\b", r"\bmake your own\b", r"\bmake[- ]your[- ]own\b", r"\bmaking kit\b", r"\bmoulds?\b", r"\bmolds?\b", r"\bbook\s*&\s*kit\b",
)
COMPANION = (
    r"\bsoaps?\b(?!\s*-?\s*free)(?!\s*&?\s*co(?:mpany|\.)?\b)", r"\bcandles?\b", r"\blotions?\b", r"\bcleansing lotion\b", r"\bshampoos?\b", r"\bdry shampoo\b",
    r"\bbody butters?\b", r"\bbath creamers?\b", r"\bbody wash\b", r"\bshower gel\b", r"\bconditioners?\b", r"\bdiffusers?\b", r"\bpedicure\b",
    r"\bbubble bath\b(?!\s+bombs?\b)", r"\bcauldrons?\b", r"\bnecklaces?\b", r"\brings?\b", r"\btoys?\b",
)
INGREDIENT = (r"\bcitric acid\b", r"\bbaking soda\b")
SUBSTITUTE = (
    r"\bbath salts?\b", r"\bbath powder\b", r"\bbath beads?\b", r"\bshower (?:steamer|melt|tablet|disc|fizzy|fizzies|fizzers?)s?\b", r"\bbath melts?\b",
    r"\b(?:fizz )?tablets?\b|\bbath drops?\b",
)
SURPRISE = (r"\bsurprise\b",)
INSIDE = (r"\b(?:in|inside|hidden)\b",)
NOT_WEIGHT = r"(?!\s*(?:oz|ounces?|g|grams?|ml|lbs?|fl|kg))"
UNIT = r"pack|count|pcs|pieces?|pk|pc|ct|bombs?|balls?|fizz(?:y|ies|ers?)?|blasters?"
NUMBER_WORDS = {"two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9, "ten": 10, "eleven": 11, "twelve": 12, "dozen": 12}
NOT_DESCRIPTOR = (
    "oz|ounces?|g|grams?|ml|lbs?|fl|mg|kg|inch|inches|cm|mm|hours?|hrs?|minutes?|mins?|years?|yrs?|days?|weeks?|scents?|flavou?rs?|fragrances?|colou?rs?|sizes?|styles?|variety|varieties"
)
PRIORITY = {
    "pack_mult": 0, "set_of": 0, "n_x_bombs": 1, "n_x_weight": 1, "word_paren": 1, "word_count": 2, "near_bombs": 2, "near_bomb": 2, "near_balls": 2, "near_ball": 2,
    "near_fizzies": 2, "near_fizzy": 2, "near_fizzers": 2, "near_blasters": 2, "near_blaster": 2, "pack_of": 3, "case_pack": 3, "near_pack": 4, "near_pk": 4,
    "near_count": 5, "near_pc": 5, "near_ct": 5, "near_pcs": 5, "near_pieces": 5, "near_piece": 5, "n_count": 6,
}
WEIGHTS = {
    "title": 5, "bullets": 3, "size": 2, "description": 3, "number_of_items": 2, "keepa_number_of_items": 2, "keepa_package_quantity": 1, "label_unit_num": 1, "unit_num": 1,
}
LEVELS = ("low", "medium", "high")
CONFIDENCE = {
    "title": "high", "bullets": "high", "size": "medium", "description": "medium", "number_of_items": "medium", "keepa_number_of_items": "medium",
    "keepa_package_quantity": "low", "label_unit_num": "low", "unit_num": "low", "single_default": "medium", "assumed_single": "low",
}
CHANNELS = {"title": ("title",), "size": ("size",), "bullets": ("feature", "keepa_features"), "description": ("product_description", "keepa_description")}
CLASS_LABELS = ("pure", "craft_kit", "bundle", "substitute", "ingredients", "no-bath-bomb")
@dataclass(frozen=True)
class Pattern:
    """n: the group of the number. by: the group of a second factor. unit: the group whose word ends the tag. word: the number is spelled out."""

    tag: str
    regex: str
    n: int = 1
    by: int | None = None
    unit: int | None = None
    over_one: bool = False
    word: bool = False


def patterns(number_words: dict[str, int]) -> tuple[Pattern, ...]:
    word = "|".join(number_words)
    return (
        Pattern("set_of", r"\bset of\s+(\d+)\b"),
        Pattern("pack_of", rf"\bpack of\s+(\d+)\b{NOT_WEIGHT}", over_one=True),
        Pattern("pack_mult", rf"\b(\d+)\s*(?:packs?|pk|sets?|boxes|box|packages?)\s+of\s+(\d+)\b{NOT_WEIGHT}", by=2),
        Pattern("n_count", r"\b(\d+)\s*count\b"),
        Pattern("case_pack", r"\bcase\s+(?:pack\s+)?(?:of\s+)?(\d+)\b"),
        Pattern("n_x_bombs", r"\b(\d+)\s*(?:x|×)\s*(?:\d+(?:\.\d+)?\s*(?:oz|ounce|oza|g|gram)s?\s+)?(?:bath\s+)?(?:bombs?|balls?|fizz)"),
        Pattern("n_x_weight", r"\b(\d+)\s*(?:x|×)\s*\d+(?:\.\d+)?\s*(?:oz|ounce|oza|g|gram|ml)s?\b"),
        Pattern("near_", rf"(\d+)\s*[-\s]?({UNIT})", unit=2),
        Pattern("near_bombs", rf"\b(\d+)\s+(?:(?!(?:{NOT_DESCRIPTOR})\b)[a-z][a-z&-]*\s+){{0,2}}(?:bath|shower)\s+(?:bombs?|balls?|bursts?|blasters?|fizz(?:y|ies|er|ers)?)\b"),
        Pattern("word_count", rf"\b({word})\s+(?:(?:bath|shower)\s+)?(?:pack|count|pcs|pieces?|bombs?|balls?|fizz(?:y|ies|ers?)?|blasters?)\b", word=True),
        Pattern("word_paren", rf"\b(?:{word})\s*\((\d+)\)"),
    )


@dataclass(frozen=True)
class Rules:
    """The lexicons as regular expressions, and what counting and voting go by; of and from_file take other values of any of them."""

    target: str = "|".join(TARGET)
    kit: str = "|".join(KIT)
    companion: str = "|".join(COMPANION)
    ingredient: str = "|".join(INGREDIENT)
    substitute: str = "|".join(SUBSTITUTE)
    surprise: str = "|".join(SURPRISE)
    inside: str = "|".join(INSIDE)
    number_words: dict[str, int] = field(default_factory=lambda: NUMBER_WORDS)
    patterns: tuple[Pattern, ...] = ()
    priority: dict[str, int] = field(default_factory=lambda: PRIORITY)
    weights: dict[str, int] = field(default_factory=lambda: WEIGHTS)
    confidence: dict[str, str] = field(default_factory=lambda: CONFIDENCE)
    channels: dict[str, tuple[str, ...]] = field(default_factory=lambda: CHANNELS)
    strict: bool = True
    max_count: int = 1000
    default_single: int = 1
    conflict_needs_review: bool = True
    class_labels: tuple[str, ...] = CLASS_LABELS

    def __post_init__(self) -> None:
        if not self.patterns:
            object.__setattr__(self, "patterns", patterns(self.number_words))

    @classmethod
    def of(cls, values: dict) -> Rules:
        """Rules with the given values in place of the defaults. Lexicons may be lists of terms, which get word boundaries;
        patterns are lists of Pattern fields."""
        unknown = sorted(set(values) - {f.name for f in fields(cls)})
        if unknown:
            raise ValueError(f"unknown rules: {', '.join(unknown)}")
        lexicons = ("target", "kit", "companion", "ingredient", "substitute", "surprise", "inside")
        given = {k: _terms(v) if k in lexicons and not isinstance(v, str) else v for k, v in values.items()}
        if "patterns" in given:
            given["patterns"] = tuple(p if isinstance(p, Pattern) else Pattern(**p) for p in given["patterns"])
        return cls(**given)

    @classmethod
    def from_file(cls, path: str) -> Rules:
        """Rules of a JSON file."""
        return cls.of(json.loads(Path(path).read_text(encoding="utf-8")))


DEFAULT = Rules()
