"""Small documents that hold every special case."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, blob string, key int, rank int"


def words(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(("sun", "moon", "star", "sea", "hill", "tree", "rain")) + str(rng.randint(0, 400)) for _ in range(n))


LINE = "This line is shared by many of the documents in here."


def documents() -> list[tuple]:
    rng = random.Random(3)
    rows = []
    for i in range(40):
        text = words(rng, 60) + ".\n" + words(rng, 30)
        if i % 3 == 0:
            text += f"\n  {LINE.upper() if i % 2 else LINE}\t"
        rows.append((i, text, ("en", "de", None)[i % 3], f"s{i % 4}"))
    base = words(rng, 120).split(" ")
    for i in range(40, 52):  # near copies
        changed = list(base)
        changed[rng.randrange(120)] = "other"
        rows.append((i, " ".join(changed), "en", "s0"))
    rows += [(60 + i, rows[2][1], "en", "s0") for i in range(6)]  # exact copies
    rows += [
        (70, None, None, None),
        (71, "", "en", "s1"),
        (72, "\n\n \t", "en", ""),
        (73, "one two three", "en", "s1"),
        (74, "one two three", "en", "s1"),
        (75, words(rng, 30_000), "en", "s2"),
        (76, "a" * 200_000, "en", "s2"),
        (77, "héllo wörld 日本 😀 " + LINE, "fr", "é"),
        (78, LINE + "\r\n" + LINE + "\n", "en", "s3"),
        (79, "same row", "en", "s3"),
        (79, "same row", "en", "s3"),
        (None, "a row without an id", "en", "s1"),
        (None, None, None, None),
    ]
    return [(a, b, c, d, len(b) if b is not None else None, "x", 1, 2) for a, b, c, d in rows]


def frame(spark):
    return spark.createDataFrame(documents(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


