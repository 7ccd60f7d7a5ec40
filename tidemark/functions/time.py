"""Time formatting and parsing as Column expressions over seconds (double)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _whole(s: Column) -> Column:
    return s.cast("bigint")


def readable(s: Column) -> Column:
    """H:MM:SS, or M:SS under an hour."""
    t = _whole(s)
    h, m, x = F.floor(t / 3600), F.floor(F.pmod(t, F.lit(3600)) / 60), F.pmod(t, F.lit(60))
    return F.when(h > 0, F.format_string("%d:%02d:%02d", h, m, x)).otherwise(F.format_string("%d:%02d", m, x))


def _clock(s: Column, mark: str) -> Column:
    t = _whole(s)
    millis = ((s - t) * 1000).cast("int")
    return F.format_string(f"%02d:%02d:%02d{mark}%03d", F.floor(t / 3600), F.floor(F.pmod(t, F.lit(3600)) / 60), F.pmod(t, F.lit(60)), millis)


def srt(s: Column) -> Column:
    """HH:MM:SS,mmm with milliseconds cut, not rounded."""
    return _clock(s, ",")


def vtt(s: Column) -> Column:
    """HH:MM:SS.mmm with milliseconds cut, not rounded."""
    return _clock(s, ".")


def vtt_rounded(s: Column) -> Column:
    """HH:MM:SS.mmm from rounded seconds; 59.9996 prints as 60.000."""
    t = _whole(s)
    return F.format_string("%02d:%02d:%06.3f", F.floor(t / 3600), F.floor(F.pmod(t, F.lit(3600)) / 60), s - F.floor(s / 60) * 60)


def compact(s: Column) -> Column:
    """3m5s, 1h2m3s, 7s."""
    t = _whole(s)
    h, m, x = F.floor(t / 3600), F.floor(F.pmod(t, F.lit(3600)) / 60), F.pmod(t, F.lit(60))
    long = F.format_string("%dh%dm%ds", h, m, x)
    return F.when(h > 0, long).when(m > 0, F.format_string("%dm%ds", m, x)).otherwise(F.format_string("%ds", x))


def duration(s: Column) -> Column:
    """1h 2m 3s without leading zero parts."""
    t = _whole(s)
    h, m, x = F.floor(t / 3600), F.floor(F.pmod(t, F.lit(3600)) / 60), F.pmod(t, F.lit(60))
    parts = [F.when(h > 0, F.format_string("%dh", h)), F.when((h > 0) | (m > 0), F.format_string("%dm", m)), F.format_string("%ds", x)]
    return F.concat_ws(" ", *parts)


def time_range(start: Column, end: Column, style: str = "compact") -> Column:
    """A span in one of four styles; an unknown one is compact."""
    pair = {"readable": readable, "srt": srt, "vtt": vtt}.get(style, compact)
    mark = {"srt": " --> ", "vtt": " --> "}.get(style, "-" if style != "readable" else " - ")
    return F.concat(pair(start), F.lit(mark), pair(end))


def parse_clock(text: Column) -> Column:
    """HH:MM:SS to seconds; anything else is 0."""
    part = [F.try_to_number(F.split_part(text, F.lit(":"), F.lit(k)), F.lit("999999")).cast("double") for k in (1, 2, 3)]
    good = text.rlike(r"^\d{1,6}:\d{1,6}:\d{1,6}$")
    return F.when(good, part[0] * 3600 + part[1] * 60 + part[2]).otherwise(F.lit(0.0))


def probe_duration(text: Column) -> Column:
    """H:M:S.f as printed by media probes to seconds; null if malformed."""
    good = text.rlike(r"^\d+:\d+:\d+(\.\d+)?$")
    part = [F.when(good, F.split_part(text, F.lit(":"), F.lit(k))).cast("double") for k in (1, 2, 3)]
    return part[0] * 3600 + part[1] * 60 + part[2]


def progress(current: Column, total: Column) -> Column:
    return F.least(F.coalesce(F.try_divide(current, total), F.lit(0.0)), F.lit(1.0))


def reading_seconds(text: Column, words_per_minute: int = 180) -> Column:
    from .text import word_count

    return word_count(text) / F.lit(float(words_per_minute)) * 60
