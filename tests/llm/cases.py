"""Small tables with nulls, empty and long texts, repeated rows, and columns named like the operators' own."""

import random

SCHEMA = "doc_id long, text string, lang string, size long, shard int, digest string, cell string, row long, score double, block long"
WORDS = "the of and to in is that for on with as by at from this are was it or an be éclair Zug niño".split()


def documents(spark, texts, first=1):
    """One row per text; a text may come as (id, text)."""
    rows = []
    for i, text in enumerate(texts):
        doc_id, text = text if isinstance(text, tuple) else (first + i, text)
        rows.append((doc_id, text, None, 7, None, "x", "y", 3, None, 1))
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def prose(random_, n, words=None):
    words = words or [a + b for a in WORDS for b in ("", "a", "on", "er", "ing")]
    return " ".join(random_.choice(words) for _ in range(n))


def mutated(random_, text, edits):
    words = text.split(" ")
    for _ in range(edits):
        words[random_.randrange(len(words))] = "w%d" % random_.randrange(10**6)
    return " ".join(words)


def corpus(seed=1, n=60):
    """Prose with exact and near copies, a shared passage, odd white space, empty and null texts."""
    r = random.Random(seed)
    texts = [prose(r, r.choice((1, 2, 3, 5, 20, 60, 120))) for _ in range(n)]
    texts += [mutated(r, texts[r.randrange(n)], r.choice((1, 2, 6))) for _ in range(n)]
    texts += [texts[3]] * 8 + [None, "", " \t\n", None, "", "a", "a b", "Ünï " * 40]
    passage = prose(r, 40)
    texts += [prose(r, 30) + " " + passage + "\n" + prose(r, 30) for _ in range(12)]
    texts += ["  two  blanks\t\tand\r\n lines  ", "x" * 5000, prose(r, 6000)]
    return texts
