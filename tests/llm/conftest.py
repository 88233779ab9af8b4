import re

import pytest

#: doc_id, text: nulls, empty and blank texts, repeats, near copies, a very long text.
WORDS = [f"w{i}" for i in range(60)]
LONG = " ".join(f"t{i % 977}x{i % 31}" for i in range(60_000))


@pytest.fixture(scope="session")
def docs(spark):
    base = " ".join(WORDS)
    rows = [
        (1, base, "a"),
        (2, base, "b"),
        (3, base.replace("w7 ", "q7 "), "c"),
        (4, base.replace("w30 ", "q30 ").replace("w50 ", "q50 "), "d"),
        (5, None, None),
        (6, "", "e"),
        (7, " \t\n", None),
        (8, "One", "f"),
        (9, "one", "g"),
        (10, LONG, "h"),
        (10, LONG, "h"),
        (None, "no id here", "i"),
        (11, "Ünï çödé été ÀB", "j"),
        (12, "different words altogether are in this text", "k"),
    ]
    # Columns whose names the operators use themselves.
    schema = "doc_id long, text string, n_shingles string"
    return spark.createDataFrame(rows, schema).selectExpr(
        "doc_id", "text", "n_shingles", "n_shingles AS _key", "n_shingles AS node", "n_shingles AS shard", "n_shingles AS score",
        "n_shingles AS _id", "n_shingles AS pii_spans", "n_shingles AS batch", "n_shingles AS _chunk",
    )


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
