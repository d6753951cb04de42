"""Small documents with the awkward cases, for the tests of the corpus operators."""
import random

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("Text", T.StringType()),
    T.StructField("key", T.LongType()), T.StructField("a.b", T.StringType())])

WORDS = {"en": "the of and house river stone walks over under green small bright morning".split(),
         "de": "der und die haus fluss stein geht über unter grün klein heller morgen".split()}


def prose(rng: random.Random, n: int, lang: str = "en") -> str:
    return " ".join(rng.choice(WORDS[lang]) + str(rng.randrange(40)) * (rng.random() < 0.3) for _ in range(n))


def texts(seed: int = 1) -> list[tuple[int | None, str | None]]:
    """Prose, copies, near copies, white-space variants, nulls, blanks, repeats, long texts."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randint(3, 160), rng.choice(["en", "de"])) for _ in range(12)]
    out = [(i, t) for i, t in enumerate(base)]
    out += [(20 + i, base[i % 3]) for i in range(5)]                       # copies
    for i in range(5):                                                     # near copies
        words = base[4].split() if len(base[4].split()) > 60 else prose(rng, 90).split()
        words[rng.randrange(len(words))] = "changed"
        out.append((30 + i, " ".join(words)))
    out += [(40, base[0].replace(" ", "\t\n")), (41, None), (42, ""), (43, " \n "), (44, "word"),
            (45, "word"), (46, "x" * 9000), (47, "é ß 漢字 ́a"), (48, base[5] * 30),
            (49, "ab " * 700), (50, base[5] + " " + base[6])]
    return out


def frame(spark, rows, lang="en"):
    return spark.createDataFrame([(i, t, lang, "clash", 7, "dots") for i, t in rows], SCHEMA)


def awkward(spark):
    """The texts, with repeated rows and rows without an id."""
    rows = texts()
    return frame(spark, rows + rows[:3] + [(None, "no id here"), (None, None)])


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
