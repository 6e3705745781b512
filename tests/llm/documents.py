"""Documents with what real tables hold: nulls, blanks, long texts, ties, repeated rows, clashing columns."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {
    "en": "the of and to in that with for from this water house morning people between thought",
    "de": "der die und das nicht mit ein auch wasser haus morgen leute zwischen gedanke über",
    "fr": "le la et les des une pour avec eau maison matin gens entre pensée être",
}


def text_of(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang].split()) for _ in range(n))


def rows(n=120, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(list(WORDS))
        lines = [text_of(rng, lang, rng.randint(3, 25)).capitalize() + "." for _ in range(rng.randint(1, 6))]
        if i % 4 == 0:
            lines.insert(rng.randrange(len(lines) + 1), "  This Line is shared by MANY documents \t")
        text = "\n".join(lines)
        out.append((i, text, lang, f"src{i % 5}", len(text)))
    for i in range(n, n + 12):  # near and exact copies of a few
        _, text, lang, source, _ = out[i % 3]
        words = text.split(" ")
        if i % 2:
            words[len(words) // 2] = "changed"
        text = " ".join(words)
        out.append((i, text, lang, source, len(text)))
    long = text_of(rng, "en", 30_000)
    out += [
        (n + 20, None, None, None, None),
        (n + 21, "", "en", "src0", 0),
        (n + 22, " \n\t \n", "en", None, 5),
        (n + 23, "123 456 -- 789", None, "src1", 14),
        (n + 24, long, "en", "src2", len(long)),
        (None, "A text without an id, of some words.", "en", "src3", 36),
        (n + 25, "Repeated row", "en", "src4", 12),
        (n + 25, "Repeated row", "en", "src4", 12),
        (n + 26, "É ÀB ß ﬁ ſ İ 漢字 😀  x y\x1cz\x85\n\nÉ", "fr", "src4", None),
        (n + 27, "word", "de", "Source", 4),
        (n + 28, "two words", "de", "Source", 9),
    ]
    return out


def frame(spark, data, extra=()):
    """``extra`` names more columns, which hold "kept" in every row."""
    df = spark.createDataFrame(data, SCHEMA)
    for name in extra:
        from pyspark.sql import functions as F

        df = df.withColumn(name, F.lit("kept"))
    return df


def words_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)
