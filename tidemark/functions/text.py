"""Text functions as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Emotions in their usual order, and the groups that agree with each other.
EMOTIONS = ["neutral", "happy", "sad", "angry", "fear", "surprise", "disgust"]
EMOTION_GROUPS = {"happy": "positive", "surprise": "positive", "sad": "negative", "angry": "negative", "fear": "negative", "disgust": "negative", "neutral": "neutral"}
#: Stopwords that word counts leave out.
STOPWORDS = "the a an and or but in on at to for of with by is are was were be been have has had do does did will would could should may might this that these those it its".split()


def word_list(text: Column) -> Column:
    """Words between runs of white space; none for a blank text."""
    return F.filter(F.split(text, r"\s+"), lambda x: x != "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.size(word_list(text)), F.lit(0)).cast("bigint") if text is not None else None


def squeeze(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def sanitize(text: Column, limit: int = 500) -> Column:
    """One line without control characters, cut to ``limit`` with three dots."""
    clean = F.regexp_replace(squeeze(text), r"[\x00-\x1f]", "")
    return F.when(F.length(clean) > limit, F.concat(F.left(clean, F.lit(limit - 3)), F.lit("..."))).otherwise(clean)


def caption_id(ordinal: Column, stamp: Column) -> Column:
    """CAP_%03d_ and six hex digits of the stamp's md5."""
    return F.concat(F.format_string("CAP_%03d_", ordinal), F.left(F.md5(stamp.cast("string").cast("binary")), F.lit(6)))


def _last(text: Column, mark: str) -> Column:
    """Zero-based place of the last ``mark``; -1 if there is none."""
    at = F.instr(F.reverse(text), mark)
    return F.when(at > 0, F.length(text) - at).otherwise(F.lit(-1))


def summary(text: Column, words: int = 30) -> Column:
    """At most ``words`` words, cut at a full stop past 6 tenths, else at a comma past 7 tenths (in whole numbers: exactly there is not past), else anywhere."""
    listed = word_list(text)
    cut = F.array_join(F.slice(listed, 1, words), " ")
    dot, comma, size = _last(cut, "."), _last(cut, ","), F.length(cut)
    short = F.when(dot * 10 > size * 6, F.left(cut, dot + 1)).when(comma * 10 > size * 7, F.concat(F.left(cut, comma), F.lit("..."))).otherwise(F.concat(cut, F.lit("...")))
    return F.when(F.size(listed) <= words, text).otherwise(short)


def names_list(names: Column) -> Column:
    """'A', 'A and B', 'A, B, and C'; 'Unknown' for none."""
    n = F.size(names)
    head = F.array_join(F.slice(names, F.lit(1), F.greatest(n - 1, F.lit(0))), ", ")
    last = F.element_at(names, -1)
    return F.when(n == 0, "Unknown").when(n == 1, F.get(names, F.lit(0))).when(n == 2, F.concat_ws(" and ", F.get(names, F.lit(0)), F.get(names, F.lit(1)))).otherwise(F.concat(head, F.lit(", and "), last))


def html_escape(text: Column) -> Column:
    steps = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")]
    return reduce(lambda c, s: F.replace(c, F.lit(s[0]), F.lit(s[1])), steps, text)


def emotion_group(emotion: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in EMOTION_GROUPS.items() for x in kv])[emotion]


def emotions_align(a: Column, b: Column) -> Column:
    """Whether two emotions are of one group; two unknown ones are."""
    return emotion_group(a).eqNullSafe(emotion_group(b))


def emotion_context(emotions: Column) -> Column:
    """The commonest non-neutral emotion, 'shifting from X to Y', or 'conversational'."""
    felt = F.filter(emotions, lambda e: e.isNotNull() & (e != "neutral"))
    kinds = F.array_distinct(felt)
    count = lambda k: F.size(F.filter(felt, lambda e: e == k))
    ranked = F.array_sort(F.transform(kinds, lambda k, i: F.struct((-count(k)).alias("n"), i.alias("i"), k.alias("e"))))
    first, last = F.get(felt, F.lit(0)), F.element_at(felt, -1)
    return F.when(F.size(felt) == 0, "conversational").when((F.size(kinds) > 1) & (first != last), F.concat(F.lit("shifting from "), first, F.lit(" to "), last)).otherwise(F.get(ranked, F.lit(0))["e"])


def word_overlap(a: Column, b: Column) -> Column:
    """Shared distinct lower-case words over the larger set; 0 where both are empty."""
    x, y = (F.array_distinct(word_list(F.lower(c))) for c in (a, b))
    return F.coalesce(F.try_divide(F.size(F.array_intersect(x, y)).cast("double"), F.greatest(F.size(x), F.size(y))), F.lit(0.0))


def json_array(text: Column, schema: str) -> Column:
    """The first JSON array in free text; an empty one if there is none or it is malformed."""
    return F.coalesce(F.from_json(F.nullif(F.regexp_extract(text, r"(?s)\[.*\]", 0), F.lit("")), schema), F.array().cast(schema))


def timed_lines(df, text_col: str, keys: list[str]):
    """Rows of '[HH:MM:SS] text' lines: id (line number from 1, with gaps), start, end (5 s later), text."""
    from .time import parse_clock

    lines = df.select(*keys, F.posexplode(F.split(text_col, "\n")).alias("n", "line"))
    got = lines.withColumn("stamp", F.regexp_extract("line", r"^\s*\[(\d{1,2}:\d{2}:\d{2})\]\s*(.*)$", 1)).where("stamp <> ''")
    return got.select(*keys, (F.col("n") + 1).alias("id"), parse_clock(F.col("stamp")).alias("start"), (parse_clock(F.col("stamp")) + 5.0).alias("end"), F.regexp_extract("line", r"^\s*\[(\d{1,2}:\d{2}:\d{2})\]\s*(.*)$", 2).alias("text"))


def mock_caption(prompt: Column) -> Column:
    """Deterministic stand-in for a caption model: names who is there and whether they speak."""
    who = F.regexp_extract(prompt, r"(?m)^Characters: (.*)$", 1)
    said = F.regexp_extract(prompt, r"(?m)^Dialogue: (.*)$", 1)
    return F.when((who != "") & (said != ""), F.concat(who, F.lit(" talk in this scene."))).when(who != "", F.concat(who, F.lit(" appear in this scene."))).otherwise(F.lit("A scene unfolds."))


#: Prompt templates by name; %s are characters, dialogue and prior context in this order.
TEMPLATES = {
    "narrative": "Tell what happens in this scene.\nCharacters: %s\nDialogue: %s\nBefore: %s",
    "descriptive": "Describe what can be seen in this scene.\nCharacters: %s\nDialogue: %s\nBefore: %s",
    "summary": "Sum up this scene in a sentence.\nCharacters: %s\nDialogue: %s\nBefore: %s",
}
GENRES = {
    "action": "Follow movement and impact.",
    "documentary": "Report facts and setting plainly.",
    "cinematic": "Mind framing, light and mood.",
}


def template(name: str, custom: str | None = None) -> str:
    """Template of a name, of the only name it begins, or the given custom text."""
    if name == "custom":
        if custom is None:
            raise KeyError("a custom template needs its text")
        return custom
    found = [k for k in TEMPLATES if k == name] or [k for k in TEMPLATES if k.startswith(name)]
    if len(found) != 1:
        raise KeyError(f"unknown template {name!r}")
    return TEMPLATES[found[0]]


def prompt(characters: Column, dialogue: Column, before: Column, name: str = "narrative", custom: str | None = None) -> Column:
    return F.format_string(template(name, custom), characters, dialogue, before)


PACKET = T.StructType([T.StructField("caption", T.StringType()), T.StructField("start", T.DoubleType()), T.StructField("end", T.DoubleType())])
