"""Cleaning of subtitle files into transcripts, in array functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import SPACE, basic_entities, nfc, strip, title_slug

TIMECODE = "[0-9]{1,2}:[0-9]{2}:[0-9]{2}[,.][0-9]{3}\\s*-->\\s*[0-9]{1,2}:[0-9]{2}:[0-9]{2}[,.][0-9]{3}"
TAG = "<[^>]+>|\\{[^}]*\\}"
CUE = f"^{SPACE}*[\\[(](?:.*?)[\\])]{SPACE}*\\z"
TRAILING_CUE = f"{SPACE}*[\\[(][^\\])]*[\\])]{SPACE}*\\z"
SPEAKER = "^[A-Z][A-Z0-9 .'\\-]{1,30}:\\s"
META = "(?i)^(?:WEBVTT|NOTE|STYLE|::cue)"
#: Line ends of str.splitlines() (fixed values).
LINE_END = "\\r\\n|[\\n\\x0b\\x0c\\r\\x1c-\\x1e\\x{85}\\x{2028}\\x{2029}]"


def _cue_text(cue: Column, strip_speakers: bool, strip_cues: bool) -> Column:
    lines = F.transform(F.split(cue, LINE_END, -1), strip)
    lines = F.filter(lines, lambda x: (x != "") & ~x.rlike(TIMECODE) & ~x.rlike("^[0-9]+\\z") & ~x.rlike(META))
    lines = F.transform(lines, lambda x: strip(F.regexp_replace(x, TAG, "")))
    if strip_cues:
        lines = F.filter(lines, lambda x: ~x.rlike(CUE))
        lines = F.transform(lines, lambda x: strip(F.regexp_replace(x, TRAILING_CUE, "")))
    if strip_speakers:
        lines = F.transform(lines, lambda x: F.regexp_replace(x, SPEAKER, ""))
    lines = F.transform(lines, lambda x: strip(F.regexp_replace(x, f"^[-–]{SPACE}*", "")))
    return F.array_join(F.filter(lines, lambda x: x != ""), " ")


def clean_subtitles(raw: Column, strip_speakers: bool = False, strip_cues: bool = True) -> Column:
    """Spoken lines of an .srt or .vtt text, one cue a line; equal neighbours once; null gives null."""
    text = basic_entities(F.replace(raw, F.lit("﻿"), F.lit("")))
    cues = F.transform(F.split(text, "\\r?\\n\\r?\\n", -1), lambda c: _cue_text(c, strip_speakers, strip_cues))
    joined = F.array_join(F.filter(cues, lambda c: c != ""), "\n")
    # a cue is one line by now: a line that repeats the one before goes
    joined = nfc(F.regexp_replace(joined, "(?d)(?m)^(.*)$(?:\n\\1$)+", "$1"))
    return strip(F.regexp_replace(F.regexp_replace(joined, "[ \\t]{2,}", " "), "\n{3,}", "\n\n"))


def transcripts(files: DataFrame, **options: bool) -> DataFrame:
    """(slug, title_slug, transcript, char_count, line_count) of (slug, raw) rows; empty transcripts are left out."""
    x = files.select("slug", clean_subtitles(F.col("raw"), **options).alias("transcript")).where("transcript <> ''")
    return x.select("slug", title_slug(F.col("slug")).alias("title_slug"), "transcript", F.length("transcript").cast("long").alias("char_count"),
                    F.size(F.split("transcript", "\n", -1)).cast("long").alias("line_count"))
