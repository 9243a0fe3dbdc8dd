import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, digest string, node string, salt int, KEY string, mark string, label int"
LONG = " ".join(f"w{i % 9973}x{i % 31}" for i in range(60_000))


def frame(spark, rows):
    """Documents with further columns whose names the operators use themselves."""
    full = [(d, t, "en", "s", None if t is None else len(t), "k", "d", "n", 1, "K", "m", 2) for d, t in rows]
    return spark.createDataFrame(full, SCHEMA)


EDGE = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one"), (5, "one"), (None, "one"), (None, None), (6, LONG), (7, LONG + " end"), (8, LONG), (9, "Ünïcødé 日本語 🙂 İ ſ K"),
    (10, "a  b\tc\r\nd"), (11, "a b c d"), (12, "x" * 5000), (5, "other text with the same id"), (13, "\0 nul \0"), (14, "the same five words here again the same five words here again"),
]


def prose(seed, n, words=60, vocabulary=400):
    r = random.Random(seed)
    vocabulary = [f"{r.choice('bcdfglmnprst')}{r.choice('aeiou')}{i}" for i in range(vocabulary)]
    return [" ".join(r.choice(vocabulary) for _ in range(r.randrange(1, words))) + r.choice([".", "", "\n"]) for _ in range(n)]


def near_copies(seed, n):
    """Texts of which many are copies of others with some words changed."""
    r = random.Random(seed)
    texts = prose(seed, max(1, n // 4), 80)
    while len(texts) < n:
        words = r.choice(texts).split(" ")
        texts.append(" ".join(w if r.random() > 0.03 else f"new{r.randrange(99)}" for w in words))
    r.shuffle(texts)
    return texts
