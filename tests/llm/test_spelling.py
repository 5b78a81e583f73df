"""Spelling variants against every pair of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from cases import awkward, empty, table

from callmart.llm import spelling


def near(a, b):
    """One letter inserted, deleted or replaced."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    short, long = sorted((a, b), key=len)
    i = 0
    while i < len(short) and short[i] == long[i]:
        i += 1
    return short[i + (len(a) == len(b)) :] == long[i + 1 :]


def plain_counts(rows, every=31):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def plain(rows, times=10, every=31):
    counts = plain_counts(rows, every)
    forms, out = {}, []
    for w, n in counts.items():
        around = [(-counts[u], u) for u in counts if near(w, u)]
        best = min(around, default=None)
        forms[w] = (len(around), best[1] if best and -best[0] >= times * n else None)
    for w, (n_near, form) in forms.items():
        root = w
        while forms[root][1]:
            root = forms[root][1]
        out.append((w, form, root, counts[w], n_near, counts.get(form)))
    return sorted(out)


def found(docs, **more):
    done = spelling.variants(docs, **more)
    assert done.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in done.collect())


def cases():
    rnd = random.Random(8)
    rows = awkward()
    base = ["".join(rnd.choice("abcdefgé") for _ in range(rnd.randint(7, 12))) for _ in range(40)]
    texts = []
    for w in base:
        texts += [w] * rnd.choice([2, 5, 40, 90, 500])
        for _ in range(6):
            k, c = rnd.randrange(len(w)), rnd.choice("abcdefgéÿ")
            edited = rnd.choice([w[:k] + c + w[k:], w[:k] + w[k + 1 :], w[:k] + c + w[k + 1 :]])
            texts += [rnd.choice([edited, edited.upper()])] * rnd.choice([1, 2, 3, 9, 60])
            # A variant of a variant, for chains.
            k = rnd.randrange(len(edited))
            texts += [edited[:k] + edited[k + 1 :]] * rnd.choice([1, 2, 4])
    texts += ["chainword"] * 700 + ["chainwor"] * 50 + ["chainwo"] * 4
    rnd.shuffle(texts)
    rows += [(5000 + i, " ".join(texts[i : i + 25])) for i in range(0, len(texts), 25)]
    # Equal counts, a repeated letter, and very long words.
    rows += [(6000, " ".join(["tietiex"] * 30 + ["tietiea"] * 30 + ["tietieb"] * 2 + ["aaaaaaa", "aaaaaaaa"] * 2))]
    rows += [(6001, " ".join(["z" * 30_000] * 20 + ["z" * 29_999] * 2))]
    return rows


@pytest.mark.parametrize("shard_words", [8_000, 7])
def test_against_every_pair(spark, shard_words):
    """Small shards deal one half over several."""
    rows = cases()
    want = plain(rows)
    assert found(table(spark, rows), shard_words=shard_words) == want
    assert any(form and root != form for _, form, root, *_ in want), "no chain"


def test_other_settings(spark):
    rows = cases()
    assert found(table(spark, rows), times=3, every=5) == plain(rows, 3, 5)


@pytest.mark.parametrize("letters", ["ab", "abcdé"])
def test_both_halves_together(letters):
    rnd = random.Random(1)
    words = sorted({"".join(rnd.choice(letters) for _ in range(rnd.randint(7, 10))) for _ in range(250)})
    n = np.array([rnd.randint(2, 5) for _ in words])
    got = Counter()
    for right in (False, True):
        q, many, _ = spelling.near_by_half(words, words, n, right)
        got.update({words[i]: int(k) for i, k in zip(q, many, strict=True)})
    assert got == Counter({w: k for w in words if (k := sum(near(w, u) for u in words))})


def test_words_not_in_the_index():
    known = ["abcdefg", "abcdefgh"]
    q, many, best = spelling.near_by_half(["abcdefx", "zzzzzzz", "abcdefg"], known, np.array([3, 2]), False)
    assert [q.tolist(), many.tolist(), best.tolist()] == [[0, 2], [1, 1], [0, 1]]


def test_edges(spark):
    assert found(empty(spark)) == []
    assert found(spark.createDataFrame([(1, None), (None, "short text once")], "doc_id long, text string")) == []
