"""The markup of edition lines, as Java patterns, and the class of a line.

Fixed values: the patterns say what the markup is.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What closes a verse line, and what closes a verse or stands around its number.
SINGLE, DOUBLE = ("|", "।"), ("||", "॥")
SECTION = r"^\{([^}]+)\}\s*$"
LOCATION = r"^\[([^\]]+?)\]\t*(.*)$"
VERSE_NUMBER = r"(?i)^\s*([0-9]+(?:[.,][0-9]+)*)\s*([a-z]{1,4})?\s*$"
PAGE = r"^<(\d+)>$"
PAGE_LINE = r"^<(\d+),(\d+)>$"
NOTE = r"^<[^\n>]+>$"
HYPHEN_END = r"-\s*$"
CHOICE = "≤([^≥]*)≥«([^»]*)»"
DELETED = "≤([^≥]*)≥"
SUPPLIED = "«([^»]*)»"
UNCLEAR = "¿([^¿]*)¿"
MID_PAGE = r"<(\d+)(?:,(\d+))?>"
SPEAKER = r"^(\S+) —\s*(.*)$"
STAGGERED = r"^(\S+ —)(\t+)(.*)$"
STAGE = r"\(\(([^)]+)\)\)"
PRAKRIT = r"˹([^˼]+)˼(?:\s*\((?!\()([^)]+)\))?"
HEAD = r"^(.*[|—,])\s*_$"
BACK = r"^_(.*)$"


def one_of(*marks: str) -> str:
    return "(?:" + "|".join(map(re.escape, marks)) + ")"


def verse_end(longest: int = 20) -> str:
    """A double mark, with the verse's number and another one behind it or without."""
    mark = one_of(*DOUBLE)
    number = f"[^{''.join(sorted({*SINGLE, DOUBLE[1]}))}]{{1,{longest}}}"
    return f"{mark} ({number}) {mark}(?: |$)|{mark}(?!{number} {mark})"


VERSE_END = verse_end()
CLOSE_LINE = one_of(*DOUBLE, *SINGLE) + r"(?:[ \n]|$)"


def line_class(line: Column, block_start: Column | None = None) -> Column:
    """The first rule that a line meets. Speaker cues count only where block_start holds; without it, nowhere."""
    start = F.lit(False) if block_start is None else block_start
    label = F.regexp_extract(line, LOCATION, 2)
    return (
        F.when(F.trim(line) == "", "blank")
        .when(line.rlike(SECTION), "section")
        .when(line.rlike(PAGE_LINE), "page_line")
        .when(line.rlike(PAGE), "page")
        .when(line.rlike(NOTE), "note")
        .when(line.rlike(LOCATION), F.when(F.trim(label) != "", "condensed_verse").otherwise("location"))
        .when(start & line.rlike(STAGGERED), "staggered_cue")
        .when(start & line.rlike(SPEAKER), "speaker")
        .when(line.rlike(HEAD), "head")
        .when(line.rlike(BACK), "back")
        .when(F.contains(line, F.lit("\t")), "verse")
        .otherwise("prose")
    )
