"""Small tables with the awkward cases that every operator must bear."""

import random

LONG = "word " * 30_000


def texts(n=60, seed=1):
    r = random.Random(seed)
    words = ["alpha", "beta", "Gamma", "délta", "ünd", "42", "x", "omega", "sun", "moon"]
    out = [" ".join(r.choice(words) for _ in range(r.randint(1, 40))) for _ in range(n)]
    return out + [None, "", "   ", "\n", out[0], out[0], out[1].upper(), LONG, "a", "😀 中文 \x00\t end"]


def documents(spark, rows=None):
    """Extra columns clash with names that operators use inside."""
    rows = [(k, t) for k, t in enumerate(texts())] + [(None, "no id here at all"), (0, "the id of another")] if rows is None else rows
    data = [(i, t, f"src{(i or 0) % 3}" if (i or 0) % 7 else None, "en", "?", 1, "h") for i, t in rows]
    return spark.createDataFrame(data, "doc_id long, text string, source string, lang string, token string, n int, id string")


def empty(spark):
    return documents(spark, []).limit(0)
