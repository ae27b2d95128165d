"""Rule sets: which lines speak of an attribute, and which numbers are plausible for it."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

RULES_SCHEMA = "attribute string, pattern_id int, pattern string"
RANGES_SCHEMA = "attribute string, lo double, hi double"

# Attribute patterns.
ZONING_PATTERNS = {
    "max_far": [r"(?i)floor.+area.+ratio", r"(?i)max.+far"],
    "max_dua": [
        r"(?i)dua",
        r"(?i)dwelling.+unit.+acre",
        r"(?i)lots.+acres",
        r"(?i)acres.+dwelling.+unit",
        r"(?i)dwelling.+(acre|unit)",
        r"(?i)unit.+acres?",
    ],
    "building_height": [
        r"(?i)building.+height",
        r"(?i)maximum.+height",
        r"(?i)height.+structures?",
    ],
    "units_per_lot": [r"(?i)units?.+per.+lot", r"(?i)units?.+sq(are)*.*fe*t"],
    "minimum_lot_sqft": [
        r"(?i)unit.+per.+fe*t",
        r"(?i)mini?m?u?m?.+lot.+sqa?r?e?.+fe*t",
        r"(?i)sq(uare)*.+fo*e*t",
        r"(?i)gross.+lot.+area",
    ],
}

# Plausible ranges, both ends excluded.
ZONING_RANGES = {
    "max_far": (0.0, 5.0),
    "max_dua": (0.0, 100.0),
    "building_height": (15.0, 250.0),
    "units_per_lot": (0.5, 5.0),
    "minimum_lot_sqft": (600.0, 1e8),
}

# Words that mark a relevant path, and places not scraped by section.
PATH_TERMS = ["zoning", "buildings", "housing", "building", "development", "land"]
PLACE_TERMS = ["walnut", "oakley", "san_mateo_county", "hercules", "fairfield"]

# Class codes of the line classifier.
LABEL_CODES = {
    "max_dua": 0,
    "minimum_lot_sqft": 1,
    "building_height": 2,
    "units_per_lot": 3,
    "max_far": 4,
    "none": 5,
}


@dataclass(frozen=True)
class Rule:
    attribute: str
    pattern_id: int
    pattern: str
    lo: float
    hi: float


class RuleSet:
    """Patterns with their ranges. It becomes part of the plan, so each pattern is compiled
    once per task instead of once per line as in a join with a rule table."""

    def __init__(self, rules: Iterable[Rule]):
        self.rules = tuple(rules)
        if not self.rules:
            raise ValueError("a rule set needs at least one pattern")

    @classmethod
    def from_dicts(cls, patterns: dict[str, list[str]], ranges: dict[str, tuple[float, float]]):
        return cls(
            Rule(attribute, n, pattern, *map(float, ranges[attribute]))
            for attribute, listed in patterns.items()
            for n, pattern in enumerate(listed)
        )

    @classmethod
    def from_frames(cls, rules: DataFrame, ranges: DataFrame):
        """Read hand-kept rule and range tables (``RULES_SCHEMA``, ``RANGES_SCHEMA``)."""
        rows = rules.join(ranges, "attribute").orderBy("attribute", "pattern_id").collect()
        return cls(Rule(r.attribute, r.pattern_id, r.pattern, r.lo, r.hi) for r in rows)

    @property
    def attributes(self) -> list[str]:
        return list(dict.fromkeys(r.attribute for r in self.rules))

    def rules_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(r.attribute, r.pattern_id, r.pattern) for r in self.rules], RULES_SCHEMA
        )

    def ranges_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            list({(r.attribute, r.lo, r.hi) for r in self.rules}), RANGES_SCHEMA
        )


ZONING = RuleSet.from_dicts(ZONING_PATTERNS, ZONING_RANGES)
