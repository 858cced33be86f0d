"""Tag map functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Wanted answers and how endpoint tags store them.
ANSWERS = {"y": "1", "n": "0"}


def tag(tags: Column, key: str) -> Column:
    """Value of a tag, null when absent."""
    return F.try_element_at(tags, F.lit(key))


def tag_matches(value: Column, wanted: str, answers: bool = True) -> Column:
    """Compare ignoring case; with ``answers`` a wanted Y or N stands for 1 or 0."""
    if answers:
        wanted = ANSWERS.get(wanted.lower(), wanted)
    return F.lower(value) == F.lit(wanted.lower())


def tags_pass(tags: Column, wanted: dict[str, str], answers: bool = True) -> Column:
    """True unless a wanted tag is present with another value."""
    tests = [F.coalesce(tag_matches(tag(tags, key), value, answers), F.lit(True))
             for key, value in sorted(wanted.items())]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def wanted_tags(wanted: dict[str, str], answers: bool = True) -> dict[str, str]:
    """Wanted values as they are compared: in lower case, answers as they are stored."""
    return {key: (ANSWERS.get(value.lower(), value) if answers else value).lower() for key, value in wanted.items()}


def tags_agree(tags: Column, wanted: Column) -> Column:
    """``tags_pass`` for wanted tags that are a column themselves (a map made by ``wanted_tags``)."""
    def agrees(w: Column) -> Column:
        return F.coalesce(F.lower(F.try_element_at(tags, w["key"])) == w["value"], F.lit(True))
    return F.forall(F.map_entries(wanted), agrees)
