"""The matching chain against a plain pass over lists, from appearances to smoothed scores."""

import random


from tidemark.operators import matching as ma


def video(rng, v, n):
    t, said = 0.0, []
    for i in range(n):
        t += rng.choice([0.5, 2, 4, 15, 300])
        end = t + rng.choice([1.0, 3.0, 12.0])
        said.append((v, f"s{i}", i, t, end, rng.choice(["p", "q", "r", None])))
        t = end - rng.choice([0, 0, 2.0])
    seen = [(v, rng.choice("ABCD"), a, a + rng.choice([0.0, 2.0, 9.0])) for a in (rng.uniform(0, t) for _ in range(1 + n // 2))]
    place = {c: rng.random() for c in "ABC"}
    feel = {(s[1], c): rng.choice([None, 0.2, 0.9]) for s in said for c in "ABCD"}
    return said, seen, place, feel, t + 30


def plain_chain(said, seen, place, feel, duration):
    people = sorted({c for _, c, _, _ in seen})
    minutes = duration / 60
    crowd, pace = len(people) / minutes, len(said) / minutes
    least = 0.3 * (0.9 if crowd < 1 else 1.2 if crowd > 10 else 1.0)
    window = 10 if pace > 20 else 60 if pace < 5 else 30
    weight = 0.3 if duration > 600 else 0.1
    links, history, matches, left = {}, [], [], []
    for _, name, place_of, start, end, speaker in said:
        scored = []
        for c in people:
            far = min((0 if a <= end and b >= start else min(abs(a - end), abs(b - start))) for _, who, a, b in seen if who == c)
            if far > window:
                continue
            terms = [(1 - far / window, 0.3)]
            if links.get((c, speaker), 0) > 0:
                terms.append((links[c, speaker], 0.3))
            recent = history[-10:]
            same = [e for e, w in recent if w == c]
            steady = 0.5 if not recent else 0.9 if same and start - same[-1] < 5 else 0.7 if same and start - same[-1] < 30 else 0.5 + 0.3 * len(same) / len(recent)
            terms.append((steady, weight))
            terms += [(place[c], 0.1)] if c in place else []
            terms += [(feel[name, c], 0.1)] if feel[name, c] is not None else []
            score = sum(s * w for s, w in terms) / sum(w for _, w in terms)
            if score > least:
                scored.append((score, c))
        row = dict(name=name, ord=place_of, start=start, end=end, speaker=speaker)
        if not scored:
            left.append(row)
            continue
        top = max(s for s, _ in scored)
        who = next(c for s, c in scored if s == top)
        matches.append(row | dict(who=who, score=top))
        history.append((end, who))
        if speaker:
            links[who, speaker] = (links[who, speaker] + top) / 2 if (who, speaker) in links else top
    kept = list(matches)
    for c in people:
        mine = sorted((m for m in matches if m["who"] == c), key=lambda m: (m["start"], m["ord"]))
        for before, m in zip(mine, mine[1:], strict=False):
            if m["start"] < before["end"]:
                worse = before if m["score"] > before["score"] else m
                kept = [k for k in kept if k is not worse]
    stage = {m["ord"]: "matched" if m in kept else "conflict" for m in matches} | {r["ord"]: "none" for r in left}
    for row in left:
        known = [(links[c, row["speaker"]], c) for c in people if row["speaker"] and links.get((c, row["speaker"]), 0) > 0.5]
        if known:
            best = max(s for s, _ in known)
            kept.append(row | dict(who=next(c for s, c in known if s == best), score=best * 0.8))
            stage[row["ord"]] = "learned"
    kept.sort(key=lambda m: (m["start"], m["ord"]))
    for i, m in enumerate(kept):
        near = [o["score"] for j, o in enumerate(kept) if j != i and abs(j - i) <= 3 and o["who"] == m["who"]]
        if near:
            m["score"] = 0.7 * m["score"] + 0.3 * sum(near) / len(near)
    done = {m["ord"]: (m["who"], round(m["score"], 9)) for m in kept}
    return {(r[0], r[2]): (*done.get(r[2], (None, None)), stage[r[2]]) for r in said}


def test_the_chain_is_the_plain_one(spark):
    rng = random.Random(8)
    videos = [video(rng, v, n) for v, n in ((1, 60), (2, 25), (3, 90), (4, 8), (5, 1))]
    said = spark.createDataFrame([r for x in videos for r in x[0]], "video_id long, segment_id string, ord long, start double, end double, speaker_id string")
    seen = spark.createDataFrame([r for x in videos for r in x[1]], "video_id long, character_id string, t0 double, t1 double")
    place = spark.createDataFrame([(v + 1, c, p) for v, x in enumerate(videos) for c, p in x[2].items()], "video_id long, character_id string, position double")
    feel = spark.createDataFrame([(v + 1, s, c, e) for v, x in enumerate(videos) for (s, c), e in x[3].items()], "video_id long, segment_id string, character_id string, emotion_score double")
    lengths = spark.createDataFrame([(v + 1, x[4]) for v, x in enumerate(videos)], "video_id long, duration double")
    context = ma.contexts(said, seen, lengths)
    assert {r.window for r in context.collect()} >= {30.0} or context.count() == 5
    rows = ma.candidates(said, seen, context, 25.0).join(place, ["video_id", "character_id"], "left").join(feel, ["video_id", "segment_id", "character_id"], "left")
    got = {(r.video_id, r.ord): (r.character_id, None if r.score is None else round(r.score, 9), r.stage) for r in ma.match_chain(rows).collect()}
    want = {k: w for x in videos for k, w in plain_chain(*x).items()}
    assert got == want
    assert {w[2] for w in want.values()} == {"matched", "conflict", "learned", "none"}


def test_nothing_to_match(spark):
    said = spark.createDataFrame([(1, "a", 0, 0.0, 1.0, "p")], "video_id long, segment_id string, ord long, start double, end double, speaker_id string")
    seen = spark.createDataFrame([], "video_id long, character_id string, t0 double, t1 double")
    lengths = spark.createDataFrame([(1, 0.0)], "video_id long, duration double")
    rows = ma.candidates(said, seen, ma.contexts(said, seen, lengths))
    assert [(r.character_id, r.stage) for r in ma.match_chain(rows).collect()] == [(None, "none")]
    assert ma.match_chain(rows.where("false")).count() == 0



def test_conflicts_and_smoothing_by_hand():
    m = lambda o, a, b, s, who="A": {"ord": o, "start": a, "end": b, "score": s, "who": who}
    rows = [m(0, 0.0, 5.0, 0.5), m(1, 4.0, 9.0, 0.6), m(2, 8.0, 10.0, 0.6), m(3, 8.5, 9.5, 0.1, "B")]
    assert [r["ord"] for r in ma.unconflicted(rows)] == [1, 3]
    pair = [m(0, 0, 1, 1.0), m(1, 2, 3, 0.0)]
    ma.smooth(pair)
    assert [round(r["score"], 6) for r in pair] == [0.7, 0.21]
