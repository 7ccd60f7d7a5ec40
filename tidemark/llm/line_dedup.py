"""Line dedup over overlapping three-line windows, DataFrame functions only.

A window is three consecutive lines of one document. Windows are keyed by two
independent 64-bit hashes, the first occurrence of each key in (doc_id, line)
order stays, and every line covered by a later occurrence goes.

Defined cases: a null text stays null; a text under three lines has no window;
windows of blank lines only are ignored; rows equal in id and text are one
occurrence and are cut alike; a null id sorts first; columns named n_lines or
n_removed are replaced (kept without ``counts``), others pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPAN = 3


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counts: bool = True) -> DataFrame:
    """``docs`` with repeated windows cut from the text, plus n_lines and n_removed (long) if ``counts``."""
    columns = docs.columns
    text, ident = F.col(f"`{text_col}`"), F.col(f"`{id_col}`")
    row_key = [F.xxhash64(ident, text), F.xxhash64(F.lit(7), text, ident)]
    keyed = docs.withColumns({"__td_k1": row_key[0], "__td_k2": row_key[1]})
    windows = _windows(keyed, text_col, id_col)
    place = F.struct("__td_id", "__td_k1", "__td_k2", "__td_at")
    first = windows.groupBy("__td_w1", "__td_w2").agg(F.min(place).alias("__td_first"), F.max(place).alias("__td_last")).where("__td_first <> __td_last")
    later = windows.join(first, ["__td_w1", "__td_w2"]).where(place != F.col("__td_first"))
    cuts = later.groupBy("__td_k1", "__td_k2").agg(F.collect_set("__td_at").alias("__td_cut"))
    lines = F.split(text, "\n", -1)
    covered = F.flatten(F.transform("__td_cut", lambda s: F.sequence(s, s + (SPAN - 1))))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), covered)
    joined = keyed.join(cuts, ["__td_k1", "__td_k2"], "left")
    hit = F.col("__td_cut").isNotNull()
    out = joined.withColumn("__td_kept", F.when(hit, kept))
    n_lines = F.when(text.isNull(), 0).otherwise(F.size(lines)).cast("long")
    pick = F.array_join(F.transform("__td_kept", lambda i: F.get(lines, i)), "\n")
    new = {"__td_n": n_lines, "__td_gone": F.when(hit, n_lines - F.size("__td_kept")).otherwise(0).cast("long"), "__td_text": F.when(hit, pick).otherwise(text)}
    out = out.withColumns(new)
    base = [F.col("__td_text").alias(c) if c == text_col else F.col(f"`{c}`") for c in columns if not counts or c not in ("n_lines", "n_removed")]
    return out.select(*base, *([F.col("__td_n").alias("n_lines"), F.col("__td_gone").alias("n_removed")] if counts else []))


def _windows(keyed: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """A row per window: document, first line and two keys."""
    text = F.col(f"`{text_col}`")
    slim = keyed.select(F.col(f"`{id_col}`").alias("__td_id"), "__td_k1", "__td_k2", F.split(text, "\n", -1).alias("ls")).where(F.size("ls") >= SPAN)
    slim = slim.withColumn(
        "hs", F.transform("ls", lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(11), x).alias("b"), (F.trim(x) == "").alias("blank")))
    )

    def window(i):
        three = [F.get("hs", i + k) for k in range(SPAN)]
        blank = three[0]["blank"] & three[1]["blank"] & three[2]["blank"]
        return F.struct(
            i.alias("at"),
            F.xxhash64(*[t["a"] for t in three]).alias("w1"),
            F.xxhash64(*[t["b"] for t in three]).alias("w2"),
            blank.alias("blank"),
        )

    rows = slim.select("__td_id", "__td_k1", "__td_k2", F.explode(F.transform(F.sequence(F.lit(0), F.size("hs") - SPAN), window)).alias("w"))
    return rows.where("not w.blank").select("__td_id", "__td_k1", "__td_k2", F.col("w.at").alias("__td_at"), F.col("w.w1").alias("__td_w1"), F.col("w.w2").alias("__td_w2"))
