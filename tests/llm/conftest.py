"""Small tables with every odd case: nulls, empty and long texts, repeats, clashing columns."""

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

#: columns that the operators use by themselves, to be carried or ignored
CLASHES = "part long, key long, score double, kept_text string, n_lines long, signature string, bucket int, file int, _text string, _doc long, _places string, given_text int, Places int"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHES}"


def prose(random_, words):
    return " ".join(
        "".join(random_.choice(["an", "er", "on", "ti", "es", "ou", "re", "Th", "é", "ß"]) for _ in range(random_.randint(1, 4)))
        for _ in range(words)
    )


@pytest.fixture(scope="session")
def rows():
    """(doc_id, text) with copies, near copies, shared passages and lines, and odd texts."""
    r = random.Random(5)
    passage, notice = prose(r, 30), "\n".join(prose(r, 6) for _ in range(4))
    texts = [prose(r, r.randint(1, 120)) for _ in range(60)]
    texts += [texts[3], texts[3], texts[7], texts[3] + " more", prose(r, 10) + " " + passage + " " + prose(r, 12)]
    texts += [passage + " " + prose(r, 40), prose(r, 50) + "\n" + passage, passage, passage + " " + passage]
    texts += [prose(r, 8) + "\n" + notice, notice + "\n" + prose(r, 9), notice, notice + "\n" + notice]
    original = prose(r, 200).split()
    for n in range(6):
        changed = list(original)
        for place in range(n, 200, 40):
            changed[place] = f"new{n}x{place}"
        texts.append(" ".join(changed))
    texts += [None, "", None, " ", "\n\n\n", "\t\r\x0b\x0c", "one", "one two three four", "ONE TWO THREE FOUR", "a b   c d", "x" * 5000]
    texts += [" ".join(["same"] * 300), " ".join(["same"] * 40), prose(r, 4000), "<|endoftext|> a  b\n\n c <s>", "É" * 50]
    order = list(range(0, 7 * len(texts), 7))
    r.shuffle(order)
    return list(zip(order, texts))


@pytest.fixture(scope="session")
def docs(spark, rows):
    full = [(k, t, "en", "src", len(t or ""), k, None, 0.5, "x", 3, "y", 1, None, "t", 7, "p", 4, 5) for k, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def keyless(spark):
    """No keys, repeated rows, nulls in every column."""
    some = [(None, text) for text in ("a b c d e f", "a b c d e f", None, "", "l\nm\nn\no", "l\nm\nn\no")]
    some += [(1, "a b c d e f"), (2, None)]
    return spark.createDataFrame([(k, t, *[None] * 16) for k, t in some], SCHEMA)
