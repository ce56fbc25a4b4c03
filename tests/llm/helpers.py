"""Plain counterparts of what the operators do on the bytes of many texts."""

from __future__ import annotations

import re

from tidemark.llm.data import ready

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = str.maketrans(UPPER, UPPER.lower())
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

# Null, empty, blank, very short, odd characters, repeated rows, a very long word.
ODD_TEXTS = [None, "", " ", "\n\t", "a", "A b", "é", "漢字 𝒳", "\x00", "x" * 70_000, "one two three four", "one two three four"]


def words(text: str | None, pattern: re.Pattern = ALNUM) -> list[str]:
    return pattern.findall((text or "").translate(LOWER))


def frame(spark, rows, schema="doc_id long, text string, id string, label string"):
    """Documents with extra columns whose names the operators use themselves."""
    width = len(schema.split(","))
    return ready(spark).createDataFrame([(*r, *["x"] * (width - len(r))) for r in rows], schema)
