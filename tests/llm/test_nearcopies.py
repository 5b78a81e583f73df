"""Near copies of the pipeline against every pair of texts."""

import random

import corpus_pipeline
import numpy as np
from cases import WORD, awkward, empty, prose, table

from callmart.llm import nearcopies
from callmart.llm.simhash import BKTree


def plain_shingles(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_kept(rows):
    """Ids that stay, by linking every pair of 0.8 or more."""
    sets = [plain_shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if len(a & b) >= 0.8 * len(a | b):
                root[top(i)] = top(j)
    least: dict = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[top(i)] = min(least.get(top(i), doc), doc)
    gone = {doc for i, (doc, _) in enumerate(rows) if doc is not None and least[top(i)] < doc}
    return sorted(str(doc) for doc, _ in rows if doc not in gone)


def edited(rnd, text, edits):
    words = text.split()
    for k in rnd.sample(range(len(words)), edits):
        words[k] = f"new{rnd.randrange(10**6)}"
    return " ".join(words)


def test_stage_drops_edited_copies(spark):
    """Copies with 1 to 5 of 200 words changed are at 0.8 or more nearly always, those with 12 changed are not."""
    rnd = random.Random(3)
    rows = awkward()
    for i in range(60):
        text = " ".join(f"{rnd.choice('abcdefgh')}{rnd.randrange(500)}" for _ in range(200))
        rows.append((1000 + i, text))
        rows += [(2000 + 10 * i + k, edited(rnd, text, k)) for k in (1, 3, 4, 5, 12)]
    kept = corpus_pipeline.drop_near_copies(spark, table(spark, rows), "")
    assert kept.columns == table(spark, rows).columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert ids == plain_kept(rows)
    assert not {str(2000 + 10 * i + k) for i in range(60) for k in (1, 3)} & set(ids)
    assert nearcopies.near_copies(empty(spark)).count() == 0


def test_chains_and_a_large_group(spark):
    """Each copy of a chain changes the one before it; the ends have little in common."""
    rnd = random.Random(4)
    text, rows = prose(rnd, 150) + " " + " ".join(f"w{i}" for i in range(100)), []
    for i in range(120):
        rows.append((i, text))
        text = edited(rnd, text, 2)
    base = " ".join(f"v{i}" for i in range(300))
    rows += [(500 + i, edited(rnd, base, 3)) for i in range(150)]
    found = sorted(str(r.doc_id) for r in nearcopies.keep_first(table(spark, rows)).collect())
    assert found == plain_kept(rows)


def test_tree_finds_what_lies_within_the_radius():
    rnd = np.random.default_rng(1)
    held = np.unique(rnd.integers(0, 2**63, 300, dtype=np.uint64))
    flips = (np.uint64(1) << rnd.integers(0, 64, (400, 20), dtype=np.uint64)) * (np.arange(20) < rnd.integers(0, 20, (400, 1)))
    asked = rnd.choice(held, 400) ^ np.bitwise_xor.reduce(flips.astype(np.uint64), axis=1)
    for radius in (0, 4, 24):
        found = {(p, a) for p, places in BKTree(held).search(asked, radius) for a in places.tolist()}
        near = np.bitwise_count(held[:, None] ^ asked[None, :]) <= radius
        assert found == set(zip(*map(np.ndarray.tolist, np.nonzero(near)), strict=True))


def test_links_come_from_the_trees(spark):
    """The same texts, whole or in parts of a few, with trees that find the near ones and with trees that find equal fingerprints only."""
    rnd = random.Random(5)
    head, rows = " ".join(f"h{i}" for i in range(200)), []
    for group in range(12):
        base = head + " " + " ".join(f"g{group}x{i}" for i in range(60 + group))
        rows += [(100 * group + i, edited(rnd, base, 4 + i % 2)) for i in range(8)]
    docs = table(spark, rows)
    kept = plain_kept(rows)
    assert 0 < len(kept) < len(rows)
    for sizes in ({}, {"part_texts": 3}, {"part_shingles": 700}):
        found = nearcopies.near_copies(docs, **sizes).collect()
        assert sorted(str(r.doc_id) for r in found if r.doc_id == r.component_id) == kept
    marked = {r.doc_id: r.fp for r in nearcopies.sketches(docs, 5).collect()}
    alone = nearcopies.near_copies(docs, radius=0).collect()
    assert all(marked[r.doc_id] == marked[r.component_id] for r in alone) and sum(r.doc_id == r.component_id for r in alone) > len(kept)
