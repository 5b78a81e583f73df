"""SimHash groups and long repeats against plain versions."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from cases import WORD, awkward, empty, prose, table

from callmart.llm import simhash, substrings


def plain_fingerprint(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, radius):
    """Of each value the set that links lead to."""
    left, out = set(values), {}
    while left:
        group, todo = set(), [left.pop()]
        while todo:
            v = todo.pop()
            group.add(v)
            near = {w for w in left if (v ^ w).bit_count() <= radius}
            left -= near
            todo += near
        out |= dict.fromkeys(group, frozenset(group))
    return out


@pytest.mark.parametrize("shard_rows", [4096, 3])
def test_near_duplicates(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(simhash.close_links, "__defaults__", (shard_rows,))
    rows = awkward()
    found = simhash.near_duplicates(table(spark, rows)).collect()
    fp = [plain_fingerprint(t) for _, t in rows]
    groups = plain_components(fp, 4)
    first = {g: min((i for (i, _), f in zip(rows, fp) if f in g and i is not None), default=None) for g in set(groups.values())}
    want = sorted((str(i), f, str(first[groups[f]])) for (i, _), f in zip(rows, fp))
    assert sorted((str(r.doc_id), r.fp % 2**64, str(r.component_id)) for r in found) == want
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_keep_first(spark):
    rows = awkward()
    kept = simhash.keep_first(table(spark, rows))
    assert kept.columns == table(spark, rows).columns
    ids = {r.doc_id for r in kept.collect()}
    assert None in ids and 0 in ids and not ids & set(range(100, 115))


@pytest.mark.parametrize("radius", [0, 1, 4])
def test_links_on_clusters_and_chains(spark, radius):
    """Random values, dense balls, and a chain whose ends are far apart."""
    rnd = random.Random(radius)
    values = {rnd.getrandbits(64) for _ in range(500)}
    for _ in range(5):
        centre = rnd.getrandbits(64)
        values |= {centre ^ sum(1 << rnd.randrange(64) for _ in range(k % 6)) & (2**64 - 1) for k in range(120)}
    v = rnd.getrandbits(64)
    for b in range(0, 64, 2):
        v ^= 3 << b
        values.add(v)
    values = sorted(values)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    for shard_rows in (4096, 20):
        root = simhash.components(simhash.close_links(df, radius, shard_rows)).collect()
        least = {r.a % 2**64: r.root for r in root}
        groups = plain_components(values, radius)
        as_signed = dict(zip(values, signed))
        for x in values:
            group = groups[x]
            assert least.get(x, as_signed[x]) == min(as_signed[y] for y in group)


def test_bk_tree_finds_all_within_the_radius():
    rnd = np.random.default_rng(4)
    values = np.unique(rnd.integers(0, 2**63, 400).astype(np.uint64) & np.uint64(0xFFFF))
    tree = simhash.BKTree(values)
    for radius in (0, 2, 4):
        found = {(p, int(q)) for p, near in tree.near(radius) for q in near}
        distance = np.bitwise_count(values[:, None] ^ values)
        want = {(int(a), int(b)) for a, b in np.argwhere(distance <= radius)}
        assert {(a, b) for a, b in found if a != b} == {(a, b) for a, b in want if a != b}


def plain_repeats(rows, width):
    """Kept words of each row; rows without id keep theirs."""
    first: dict = {}
    split = [WORD.findall(t or "") for _, t in rows]
    for (i, _), words in zip(rows, split):
        if i is not None:
            for k in range(len(words) - width + 1):
                window = tuple(words[k : k + width])
                first[window] = min(first.get(window, i), i)
    out = []
    for (i, _), words in zip(rows, split):
        gone = set()
        if i is not None:
            for k in range(len(words) - width + 1):
                if first[tuple(words[k : k + width])] < i:
                    gone.update(range(k, k + width))
        out.append((str(i), len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return sorted(out)


@pytest.mark.parametrize("hot", [2_000, 1])
@pytest.mark.parametrize("width", [50, 12, 8])
def test_long_repeats(spark, hot, width):
    rows = awkward()
    found = substrings.remove_repeats(table(spark, rows), width, hot_documents=hot).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in found) == plain_repeats(rows, width)


def test_suffix_tree():
    """Smallest documents of the nodes at the cut against a table of whole windows, and what the tree looks like."""
    rnd = random.Random(3)
    tree, seen = substrings.SuffixTree(6), {}
    for doc in range(60):
        words = [rnd.choice([b"a", b"b", b"c"]) for _ in range(rnd.randint(0, 40))]
        want = []
        for i in range(len(words) - 5):
            window = tuple(words[i : i + 6])
            want.append(seen.setdefault(window, doc) < doc)
        assert tree.insert(words, doc) == want

    def leaves(node, path):
        for word, (label, first, last, below) in node.items():
            assert label[first] == word
            whole = (*path, *label[first:last])
            if len(whole) == 6:
                yield whole, below
            else:
                assert len(below) > 1
                yield from leaves(below, whole)

    assert dict(leaves(tree.root, ())) == seen


@pytest.mark.parametrize("size", [1, 40])
def test_groups_by_size(spark, size):
    """Groups over the bound are settled by minima, with two texts under the smallest id and passages in many places."""
    rnd = random.Random(9)
    common, twin = prose(rnd, 70), prose(rnd, 60)
    rows = [(i, f"{prose(rnd, i % 7)} {common} {prose(rnd, 3)} {common if i % 3 else twin}".strip()) for i in range(5, 40)]
    rows += [(5, common), (5, twin + " " + common), (3, twin), (None, common)]
    docs = table(spark, rows).repartition(7)
    found = substrings.remove_repeats(docs, group_suffixes=size).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in found) == plain_repeats(rows, 50)


def test_repeats_inside_periods(spark):
    """Words that come again and again, so that anchors tie."""
    rnd = random.Random(7)
    line = prose(rnd, 9)
    rows = [(i, " ".join([line] * (5 + i % 4)) + " " + prose(rnd, i)) for i in range(12)]
    rows += [(20 + i, "a b " * (30 + i)) for i in range(4)]
    found = substrings.remove_repeats(table(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in found) == plain_repeats(rows, 50)
    assert substrings.remove_repeats(empty(spark)).count() == 0


def test_texts_keep_their_layout(spark):
    passage = prose(random.Random(1), 60)
    rows = [(1, passage), (2, f" lead\n\n{passage}\n tail  end "), (3, "un  touched\t"), (4, passage), (5, None), (None, passage)]
    docs = table(spark, rows)
    cut = substrings.without_repeats(docs)
    assert cut.columns == docs.columns
    found = {r.doc_id: (r.text, r.n_chars) for r in cut.collect()}
    assert found[1] == (passage, len(passage)) == found[None]
    assert found[2] == (" lead\n\ntail  end ", 17)
    assert found[3] == ("un  touched\t", 12) and found[4] == ("", 0) and found[5] == (None, 0)


def test_digest_query(spark, folder):
    from callmart.llm.queries import QUERIES

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = [(i, n, m, digest(t)) for i, n, m, t in plain_repeats(rows, 50)]
    found = QUERIES["op10_substrings"](spark, folder).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in found) == want
