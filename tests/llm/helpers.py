"""Small tables of the tests."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = ["alder", "birch", "cedar", "dune", "ember", "fjord", "gorge", "heath", "inlet", "juniper", "kelp", "larch", "moor", "nettle", "oak", "pine"]


def prose(seed: int, words: int = 60, per_line: int = 12) -> str:
    rng = random.Random(seed)
    made = [rng.choice(WORDS) + str(rng.choice("abcdefgh")) * rng.randint(0, 2) for _ in range(words)]
    return "\n".join(" ".join(made[i:i + per_line]) for i in range(0, words, per_line))


def documents(spark, texts, lang="en", source="src1"):
    """Documents with ids 0.. of the texts; a tuple gives (doc_id, text)."""
    rows = [(*x, lang, source, None) if isinstance(x, tuple) else (i, x, lang, source, None) for i, x in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def odd_texts():
    """Null, empty, blank, repeated and very long texts, one with signs of many kinds."""
    return [None, "", " \t\n", "one", "one", "one two", "Ünïcödé ß 中文 🙂 \x00 end", "x" * 200_000, "word " * 50_000, prose(1), prose(1), prose(2) + "\r\n\r\n" + prose(3)]


def odd_documents(spark):
    """``odd_texts`` with null and repeated ids, nulls in other columns, and columns whose names an operator may use itself."""
    rows = [(i if i != 5 else None, t, "en" if i % 2 else None, None if i % 3 else "src0", None) for i, t in enumerate(odd_texts())]
    df = spark.createDataFrame(rows + [rows[3], rows[9], (None, None, None, None, None)], SCHEMA)
    return df.selectExpr("*", "1 AS rep", "2 AS component_id", "3 AS kept", "4 AS key", "5 AS label", "6 AS kw_id", "7 AS kw_lines", "8 AS kw_kept", "9 AS kw_source", "10 AS kw_key",
                         "11 AS kw_probability", "12 AS n_lines_dropped", "13 AS content", "14 AS block")


def empty_documents(spark):
    return spark.createDataFrame([], SCHEMA)
