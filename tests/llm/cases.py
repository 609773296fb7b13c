"""Tables with everything that may be odd: nulls, empty and long texts, repeats, clashing columns."""

import random

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, id bigint, doc string, row bigint, "
    "norm string, score double, keep_id bigint, component_id bigint, n_hit bigint, sha256 string"
)
_extra = (1, "x", 2, "y", 0.5, 3, 4, 5, "z")


def prose(seed, n):
    r = random.Random(seed)
    parts = ["tion", "er", "au", "el", "ko", "mi", "ra", "su", "té", "ß", "no", "vi"]
    words = ["".join(r.choice(parts) for _ in range(r.randint(1, 3))) for _ in range(n)]
    return " ".join(w + (".\n" if i % 11 == 10 else "") for i, w in enumerate(words))


def table(spark, texts):
    """A documents table from (doc_id, text) pairs, with columns that clash with results."""
    rows = [(i, t, "en", "src", None, *_extra) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def odd_texts():
    base = prose(1, 120)
    words = base.split(" ")
    near = " ".join([*words[:60], "altered", *words[61:]])
    return [
        (1, base),
        (2, base.replace(" ", "  ")),
        (3, near),
        (4, None),
        (5, ""),
        (6, " \t\n"),
        (7, "one"),
        (7, "one"),
        (8, "one two"),
        (None, base),
        (None, "nameless"),
        (None, None),
        (9, "x" * 5000),
        (10, prose(2, 60_000)),
        (11, "日本語 テキスト é 😀 mixed <|endoftext|> text"),
        (12, base),
        (12, "same id, other text"),
    ]
