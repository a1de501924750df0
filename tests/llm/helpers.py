"""Small tables with nulls, empties, long texts, ties and repeated rows."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = "an the ou er re ti on le ing st ha no ver mo ka lu pe so di".split()


def prose(rng, n, vocabulary=400):
    words = ["".join(SYLLABLES[(i * 7 + j * 3) % len(SYLLABLES)] for j in range(1 + i % 4)) for i in range(vocabulary)]
    return " ".join(rng.choice(words) + ("." if rng.random() < 0.08 else "") for _ in range(n))


def corpus(n=60, seed=1):
    """Rows of (doc_id, text, lang, source, n_chars) with awkward cases at the end."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.randint(3, 300)) for _ in range(n)]
    rows = [(i, t, "en", f"src{i % 5}" if i % 3 else "src0") for i, t in enumerate(texts)]
    base = texts[5] + " " + prose(rng, 200)
    words = base.split()
    rows += [(100, base, "en", "src0"), (101, base, "fr", "src1"), (102, base.upper(), "en", "src1")]
    for k in range(6):  # near copies
        edited = list(words)
        edited[20 + 15 * k] = f"changed{k}"
        rows.append((110 + k, " ".join(edited), "en", "src2"))
    rows += [(200, None, "en", "src0"), (201, "", "en", None), (202, " \n\t ", None, "src3"), (203, "one two", "en", "src3"),
             (204, "ONE  Two", "en", "src4"), (205, "x " * 5000, "en", "src0"), (206, "é ß 日本 \x00 \U0001F600 ok", "en", "src1"),
             (207, prose(rng, 20000), "en", "src2"), (208, "a" * 30000, "en", "src2"),
             (None, "no id here at all", "en", "src0"), (0, texts[0], "en", "src0"), (0, texts[0], "en", "src0")]
    return [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]


def frame(spark, rows, parts=3, schema=SCHEMA):
    return spark.createDataFrame(rows, schema).repartition(parts)
