"""Rows with columns whose names an operator might want for itself."""

import pytest

NAMES = ["words", "quota", "shard", "score", "size", "kept", "text_sha256", "_size", "_keep", "keep", "sha", "n", "id", "key", "same", "c0", "row", "target", "taken", "lang_pred"]


@pytest.fixture
def clashing(spark):
    def made(rows):
        return spark.createDataFrame([(*r, *NAMES) for r in rows], f"doc_id bigint, text string, {', '.join(c + ' string' for c in NAMES)}")

    made.names = NAMES
    return made
