"""Dialogues to characters with what was learned on the way: calibration, ordered matching, conflicts, second pass, smoothing.

A video's parameters come from its own densities. Candidates meet by one interval join over
spans as wide as the video's window. What a match teaches scores later ones, so the ordered
part is one Arrow group a video; everything before it, and scores of a finished history,
are plans.
"""

from __future__ import annotations

from collections import deque

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .intervals import interval_join
from .quality import calibration

MATCH = "video_id long, segment_id string, character_id string, score double, continuity double, second_pass boolean"
CHAIN = "video_id long, segment_id string, ord long, character_id string, score double, first_score double, stage string"
_OPTIONAL = ("position", "emotion_score")
LEAST, NEAR, FACTOR = 0.3, 3, 0.8  # least score, rows of smoothing to each side, share of an association that a second pass gives


def continuity(history, at: float, who: str) -> float:
    """0.9 if the character's last match ended under 5 s ago, 0.7 under 30 s, else by its share of the last ten; 0.5 without history."""
    if not history:
        return 0.5
    mine, last = 0, None
    for t, w in history:
        if w == who:
            mine, last = mine + 1, t
    if last is not None and at - last < 30:
        return 0.9 if at - last < 5 else 0.7
    return 0.5 + 0.3 * mine / len(history)


class _Ordered:
    """The first pass over one video's candidates: matches, what is left, and each speaker's associations."""

    def __init__(self, pdf: pd.DataFrame, least: float, weight: float):
        pdf = pdf.sort_values(["ord", "character_id"], kind="stable")
        near = (1 - pdf["distance"] / pdf["window"]).clip(lower=0).to_numpy(float)
        good = (pdf["character_id"].notna() & (pdf["distance"] <= pdf["window"])).tolist()
        fixed, total = 0.3 * near, 0.3 + weight
        for name in _OPTIONAL:
            if name in pdf:
                have = pdf[name].notna().to_numpy()
                fixed, total = fixed + (0.1 * pdf[name].fillna(0).to_numpy(float)) * have, total + 0.1 * have
        total = (total + 0.0 * near).tolist()
        fixed, names, speakers, segments = fixed.tolist(), pdf["character_id"].tolist(), pdf["speaker_id"].tolist(), pdf["segment_id"].tolist()
        starts, ends, places = pdf["start"].tolist(), pdf["end"].tolist(), pdf["ord"].tolist()
        history: deque[tuple[float, str]] = deque(maxlen=10)
        self.links: dict[str, dict[str, float]] = {}
        self.matched: list[dict] = []
        self.left: list[dict] = []
        a, n = 0, len(places)
        while a < n:
            b = a + 1
            while b < n and places[b] == places[a]:
                b += 1
            known = self.links.get(speakers[a], {})
            top, best, steady = 0.0, None, None
            for k in range(a, b):
                if not good[k]:
                    continue
                c, v = continuity(history, starts[a], names[k]), known.get(names[k], 0.0)
                score = (fixed[k] + weight * c + 0.3 * v) / (total[k] + 0.3) if v > 0 else (fixed[k] + weight * c) / total[k]
                if score > top:
                    top, best, steady = score, names[k], c
            row = {"segment_id": segments[a], "ord": places[a], "start": starts[a], "end": ends[a], "speaker": speakers[a]}
            if best is None or top <= least:
                self.left.append(row)
            else:
                if isinstance(speakers[a], str):
                    mine = self.links.setdefault(speakers[a], {})
                    mine[best] = (mine[best] + top) / 2 if best in mine else top
                history.append((ends[a], best))
                self.matched.append(row | {"who": best, "score": top, "continuity": steady})
            a = b

    def learned(self, speaker) -> tuple[str | None, float]:
        """The speaker's best association over 0.5; the first name of equal ones."""
        v, who = min(((-v, c) for c, v in self.links.get(speaker, {}).items() if v > 0.5), default=(0.0, None))
        return who, -v


def match_in_order(candidates: DataFrame, least: float = LEAST, weight: float = 0.1) -> DataFrame:
    """Dialogues in time order, each with the best of its candidate characters.

    ``candidates``: video_id, segment_id, ord, start, end, speaker_id, character_id (null: none),
    distance (s), window (s), and if known position and emotion_score (0 to 1). The score is
    the mean of the terms that are there, by their weights: time 0.3, speaker 0.3 (if learned),
    continuity ``weight``, position 0.1, emotion 0.1. A match teaches the speaker's association
    (half-averages), which scores later dialogues; a second pass gives unmatched dialogues their
    speaker's best association over 0.5, at 0.8 of it. Equal scores go to the first name.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        found, video = _Ordered(pdf, least, weight), pdf["video_id"].iloc[0]
        out = [(video, m["segment_id"], m["who"], m["score"], m["continuity"], False) for m in found.matched]
        for row in found.left:
            who, v = found.learned(row["speaker"])
            out.append((video, row["segment_id"], who, v * FACTOR if who else None, None, bool(who)))
        return pd.DataFrame(out, columns=[x.split()[0] for x in MATCH.split(", ")])

    return candidates.groupBy("video_id").applyInPandas(run, MATCH)


def unconflicted(matches: list[dict]) -> list[dict]:
    """Of a character's consecutive matches that overlap, the better one; the earlier one on a tie."""
    by: dict[str, list[dict]] = {}
    for m in sorted(matches, key=lambda m: (m["start"], m["ord"])):
        by.setdefault(m["who"], []).append(m)
    gone = set()
    for mine in by.values():
        for before, m in zip(mine, mine[1:], strict=False):
            if m["start"] < before["end"]:
                gone.add(before["ord"] if m["score"] > before["score"] else m["ord"])
    return [m for m in matches if m["ord"] not in gone]


def smooth(matches: list[dict]) -> None:
    """In time order, 0.7 of a score and 0.3 of the mean of the same character's within NEAR matches, those before already smoothed."""
    matches.sort(key=lambda m: (m["start"], m["ord"]))
    for i, m in enumerate(matches):
        near = [o["score"] for o in matches[max(0, i - NEAR) : i + NEAR + 1] if o is not m and o["who"] == m["who"]]
        if near:
            m["score"] = 0.7 * m["score"] + 0.3 * sum(near) / len(near)


def match_chain(candidates: DataFrame) -> DataFrame:
    """The whole chain: ``match_in_order`` with each video's least score and weight (columns least, continuity_weight), then conflicts, second pass and smoothing.

    Every dialogue is told once, with its stage: matched, conflict (its match overlapped a
    better one of the same character), learned (by its speaker's association) or none.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        found = _Ordered(pdf, float(pdf["least"].iloc[0]), float(pdf["continuity_weight"].iloc[0]))
        kept = unconflicted(found.matched)
        stages = {m["ord"]: "conflict" for m in found.matched} | {m["ord"]: "matched" for m in kept} | {r["ord"]: "none" for r in found.left}
        for row in found.left:
            who, v = found.learned(row["speaker"])
            if who:
                kept.append(row | {"who": who, "score": v * FACTOR})
                stages[row["ord"]] = "learned"
        first = {m["ord"]: m["score"] for m in kept}
        smooth(kept)
        final = {m["ord"]: m for m in kept}
        out = [(pdf["video_id"].iloc[0], r["segment_id"], r["ord"], *((m["who"], m["score"]) if (m := final.get(r["ord"])) else (None, None)), first.get(r["ord"]), stages[r["ord"]]) for r in (*found.matched, *found.left)]
        return pd.DataFrame(out, columns=[x.split()[0] for x in CHAIN.split(", ")])

    return candidates.groupBy("video_id").applyInPandas(run, CHAIN)


def contexts(dialogues: DataFrame, appearances: DataFrame, videos: DataFrame) -> DataFrame:
    """(video_id, window, least, continuity_weight) of each video (video_id, duration) from its dialogues and characters a minute; a video without length has none."""
    said = dialogues.groupBy("video_id").agg(F.count("*").alias("said"))
    seen = appearances.groupBy("video_id").agg(F.count_distinct("character_id").alias("seen"))
    rows = videos.join(said, "video_id", "left").join(seen, "video_id", "left")
    a_minute = lambda c: F.coalesce(F.try_divide(F.col(c), F.col("duration") / 60), F.lit(0.0))
    rows = calibration(rows.withColumns({"character_density": a_minute("seen"), "dialogue_density": a_minute("said")}))
    return rows.select("video_id", "window", (LEAST * F.col("confidence_scale")).alias("least"), "continuity_weight")


def candidates(dialogues: DataFrame, appearances: DataFrame, context: DataFrame, width: float = 120.0) -> DataFrame:
    """Each dialogue (video_id, segment_id, ord, start, end, ...) with the characters whose appearances (character_id, t0, t1) are within its video's window, and how far; one row with nulls if there is none."""
    said = dialogues.join(context, "video_id")
    wide = said.select("video_id", "segment_id", "start", "end", (F.col("start") - F.col("window")).alias("w0"), (F.col("end") + F.col("window")).alias("w1"))
    near = interval_join(wide, appearances.select("video_id", "character_id", "t0", "t1"), ["video_id"], ("w0", "w1"), ("t0", "t1"), width)
    gap = F.greatest(F.col("t0") - F.col("end"), F.col("start") - F.col("t1"), F.lit(0.0))
    nearest = near.groupBy("video_id", "segment_id", "character_id").agg(F.min(gap).alias("distance"))
    return said.join(nearest, ["video_id", "segment_id"], "left")


def history_scores(matches: DataFrame, order: str = "ord") -> DataFrame:
    """A history of matches (video_id, character_id, start, end) with the continuity that each row had before it."""
    w = Window.partitionBy("video_id").orderBy(order).rowsBetween(-10, -1)
    past = matches.withColumn("__past", F.collect_list(F.struct("end", "character_id")).over(w))
    past = past.withColumn("__mine", F.filter("__past", lambda m: m["character_id"] == F.col("character_id")))
    since = F.col("start") - F.try_element_at("__mine", F.lit(-1))["end"]
    share: Column = 0.5 + F.size("__mine") * 0.3 / F.greatest(F.size("__past"), F.lit(1))
    score = F.when(F.size("__past") == 0, 0.5).when(since < 5, 0.9).when(since < 30, 0.7).otherwise(share)
    return past.withColumn("continuity", score).drop("__past", "__mine")


def associations(matches: DataFrame, order: str = "ord") -> DataFrame:
    """(video_id, speaker_id, character_id, strength): half-averages of the scores of a speaker's matches, in order."""
    listed = matches.groupBy("video_id", "speaker_id", "character_id").agg(F.array_sort(F.collect_list(F.struct(order, "score"))).alias("l"))
    half = lambda a, x: (a + x["score"]) / 2
    strength = F.aggregate(F.slice("l", F.lit(2), F.greatest(F.size("l") - 1, F.lit(0))), F.get("l", F.lit(0))["score"], half)
    return listed.select("video_id", "speaker_id", "character_id", strength.alias("strength"))


def second_pass(unmatched: DataFrame, learned: DataFrame) -> DataFrame:
    """Unmatched rows (video_id, speaker_id, ...) with their speaker's best association over 0.5 as (character_id, score), the first name of equal ones; rows without one are left out."""
    best = learned.where("strength > 0.5").groupBy("video_id", "speaker_id").agg(F.min(F.struct((-F.col("strength")).alias("v"), "character_id")).alias("b"))
    return unmatched.join(best, ["video_id", "speaker_id"]).select(*unmatched.columns, F.col("b.character_id").alias("character_id"), (-F.col("b.v") * FACTOR).alias("score"))
