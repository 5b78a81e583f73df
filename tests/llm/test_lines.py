"""Common lines against a plain version."""

import hashlib
import random
from collections import defaultdict

import pytest
from cases import awkward, empty, prose, table

from callmart.llm import lines

SPACES = " \t\n\x0b\x0c\r"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain(rows, least_chars=40, least_documents=5):
    key = lambda line: lowered(line.strip(SPACES))
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None and len(key(line)) >= least_chars:
                holders[key(line)].add(doc)
    out = []
    for doc, text in rows:
        all_lines = (text or "").split("\n")
        gone = [
            doc is not None and len(holders.get(key(x), ())) >= least_documents and doc < max(holders[key(x)]) for x in all_lines
        ]
        kept = "\n".join(x for x, g in zip(all_lines, gone, strict=True) if not g)
        out.append((doc, len(all_lines), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def found(docs, **more):
    done = lines.drop_common_lines(docs, **more).collect()
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, hashlib.sha256(r.kept.encode()).hexdigest()) for r in done), key=str)


def cases():
    rnd = random.Random(5)
    rows = awkward()
    footer, forty, short = prose(rnd, 12), "x" * 40, "y" * 39
    for i in range(9):
        body = "\n".join(prose(rnd, rnd.randint(1, 9)) for _ in range(4))
        ends = rnd.choice(["", " ", "\t\x0b ", "\r"])
        rows.append((600 + i, f"{ends}{footer.upper() if i % 2 else footer}{ends}\n{body}\n\n{footer}\n{forty}\n{short}\n"))
    rows += [(700 + i, "Ünïcödé Zeile mit ÄÖÜ und Émile, lang genug hier\nÉ") for i in range(5)]
    rows += [(710 + i, f"{'four documents hold this line, which is not enough'}\n{i}") for i in range(4)]
    # One document's two rows count once.
    rows += [(720, "a line that rows of one id hold, and only four documents"), (720, "A line that rows of one id hold, and only four documents\n")]
    rows += [(721 + i, "a line that rows of one id hold, and only four documents") for i in range(3)]
    # A line of only white space inside, and a very long text of one line many times.
    rows += [(800, "\n".join([footer] * 3000)), (801, " " * 45), (802, " no strip of other spaces, this is a long line ")]
    return rows


def test_against_plain(spark):
    rows = cases()
    assert found(table(spark, rows)) == plain(rows)
    assert any(n for _, _, n, _ in plain(rows))


@pytest.mark.parametrize("chars, documents", [(1, 2), (10, 3)])
def test_other_bounds(spark, chars, documents):
    rows = cases()
    assert found(table(spark, rows), least_chars=chars, least_documents=documents) == plain(rows, chars, documents)


def test_edges(spark):
    done = lines.drop_common_lines(empty(spark))
    assert done.count() == 0 and done.columns == ["doc_id", "n_lines", "n_dropped", "kept"]
    only = spark.createDataFrame([(1, None), (None, None)], "doc_id long, text string").selectExpr("*", "1 as places", "2 as a", "3 as holder")
    assert sorted((r.n_lines, r.n_dropped, r.kept) for r in lines.drop_common_lines(only).collect()) == [(1, 0, "")] * 2
