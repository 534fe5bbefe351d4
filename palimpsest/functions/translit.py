"""Romanization: Harvard-Kyoto to IAST."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the two schemes; longer keys first.
HK_IAST = [("lRR", "ḹ"), ("lR", "ḷ"), ("RR", "ṝ"), ("R", "ṛ"), ("A", "ā"), ("I", "ī"), ("U", "ū"), ("M", "ṃ"), ("H", "ḥ"), ("G", "ṅ"), ("J", "ñ"), ("T", "ṭ"), ("D", "ḍ"), ("N", "ṇ"), ("z", "ś"), ("S", "ṣ")]


def hk_to_iast(text: Column) -> Column:
    several = [(a, b) for a, b in HK_IAST if len(a) > 1]
    single = [(a, b) for a, b in HK_IAST if len(a) == 1]
    for a, b in several:
        text = F.replace(text, F.lit(a), F.lit(b))
    return F.translate(text, "".join(a for a, _ in single), "".join(b for _, b in single))
