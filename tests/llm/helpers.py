"""Awkward tables that every operator has to take."""

from __future__ import annotations

import re

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"word{k * 7919 % 10007} and the" for k in range(40_000))
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id long, n long, unit string, "
          "component string, size string, target string, rows long, rule string, score string, __text string")
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs on and on to the far hills of home.", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, "b"),
    (4, " \n\t ", "de", None),
    (5, LONG, "en", "a"),
    (6, "Der schnelle braune Fuchs springt über den faulen Hund und läuft weiter zu den Hügeln.", "de", None),
    (7, "The quick brown fox jumps over the lazy dog and runs on and on to the far hills of home.", None, "b"),
    (7, "The quick brown fox jumps over the lazy dog and runs on and on to the far hills of home.", None, "b"),
    (None, "12 34 !!", "en", ""),
    (8, "12 34 !!", "en", "c"),
    (9, "日本語 ÀÉ\x00 🎉 ok", "fr", "c"),
]


def messy(spark):
    return spark.createDataFrame(
        [(i, t, lang, s, None if t is None else len(t), 1, 2, "u", "c", "s", "t", 3, "r", "x", "y")
         for i, t, lang, s in ROWS], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
