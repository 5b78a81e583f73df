"""Small tables with awkward rows, and plain versions of the operators to hold results against."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and thing house river stone water light green black table seven under over again".split()


def prose(rnd: random.Random, n: int) -> str:
    return " ".join(rnd.choice(WORDS) + rnd.choice(["", "s", "ed", "ing"]) for _ in range(n))


def awkward(seed: int = 1) -> list[tuple[int | None, str | None]]:
    """Nulls, empty and blank texts, one very long text, ties, copies, near copies, shared passages, odd letters."""
    rnd = random.Random(seed)
    base = [prose(rnd, rnd.randint(5, 200)) for _ in range(30)]
    passage = prose(rnd, 70)
    rows: list[tuple[int | None, str | None]] = list(enumerate(base))
    rows += [(100 + i, base[i % 5]) for i in range(15)]  # copies
    for i in range(10):  # near copies
        words = base[i].split()
        words[len(words) // 2] = "changed"
        rows.append((200 + i, " ".join(words)))
    rows += [(300 + i, f"{prose(rnd, 20)}\n{passage} {prose(rnd, 20)}") for i in range(12)]
    rows += [
        (400, None),
        (401, ""),
        (402, " \t\n "),
        (403, "one two three"),
        (404, prose(rnd, 20_000)),
        (405, "a " * 400),
        (406, "a " * 300),
        (407, "x" * 50_000),
        (408, "Ünïcödé ΑΣΣΟΣ Привет 你好 é ½     ﬁ 1234 don't I'LL <|endoftext|>\x1f\x00z"),
        (409, "same\n\n same\nsame\nother\nsame"),
        (None, base[0]),
        (None, None),
        (3, base[3]),  # a repeated row
        (3, base[4]),  # its id with another text
    ]
    return rows


def table(spark: SparkSession, rows) -> DataFrame:
    """Documents with clashing extra columns."""
    full = [(i, t, "en" if (i or 0) % 3 else None, f"src{(i or 0) % 2}", len(t or "")) for i, t in rows]
    docs = spark.createDataFrame(full, SCHEMA)
    more = "1 as word", "2L as anchor", "'x' as kind", "3 as slot", "4D as score", "5L as fp", "6 as n", "7 as grp"
    return docs.selectExpr("*", *more).repartition(5)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
