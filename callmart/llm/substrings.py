"""Substring dedup: long passages that an earlier document has too, by prefix-partitioned suffix trees.

Of every suffix only its first ``width`` words matter, because a passage counts from that length on. Suffixes are
split into groups by a prefix of variable length: a suffix's prefix ends with its *anchor*, the word gram of smallest
hash among those in its first ``width`` words. Equal windows have equal anchors at equal places, so suffixes that
agree for ``width`` words always meet in one group. Prefixes that end with the same anchor share a group, since
neighbouring suffixes mostly do and so travel as one run of text.

In its group the suffixes of the runs are put into a compressed suffix tree, cut at depth ``width``: every internal node
above the cut is a branching of words, and what hangs below a point at the cut is one node with the smallest document
under it. A suffix that arrives at such a node of a smaller document begins a repeat; repeats in a row make the
maximal one.

Groups are sized by the suffixes they hold, before any text moves. One that would be too large for a task gets the longest
prefix, all ``width`` words: the subtree of such a prefix is a single node, so only its smallest document is wanted. Each
task takes the minimum over its own rows first, and a group then holds at most a row for each task. The
documents that own such a node are told so; everyone else loses the window without any row being sent for it.

What is shuffled: the narrow (anchor, document) pairs, to drop anchors that only one document has; each
text once, by document, used both for cutting the runs and for removing the words; and the runs of repeated anchors.
Copies of a run within a batch are settled there, and only the smallest document's run is sent.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callmart.llm.common import batches_of
from callmart.session import stage

#: Words of an anchor.
GRAM = 8
#: A group of more documents or more suffixes than this is split by whole windows.
HOT_DOCUMENTS = 2_000
GROUP_SUFFIXES = 40_000
#: Smallest documents of whole windows that a task holds before it sends them.
HELD_WINDOWS = 200_000
#: Words whose hashes a task remembers; a full table starts anew.
KNOWN_WORDS = 500_000

_ODD = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > KNOWN_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def gram_hashes(words: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each ``gram`` words in a row."""
    total = np.zeros(len(words) - gram + 1, np.uint64)
    for k in range(gram):
        total = total * _ODD + words[k : k + len(total)]
    return _mix(total)


def leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values the place of its least one, the leftmost if several are."""
    place, span = np.arange(len(values)), 1
    while span < width:
        step = min(span, width - span)
        a, b = place[: len(place) - step], place[step:]
        place = np.where(values[b] < values[a], b, a)
        span += step
    return place


def anchors(words: list[bytes], hashes: _WordHashes, width: int, gram: int):
    """Hash of the anchor, first window and number of windows, for each run of windows with one anchor."""
    grams = gram_hashes(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)), gram)
    place = leftmost_least(grams, width - gram + 1)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    return grams[place[first]].view(np.int64), first, np.diff(np.r_[first, len(place)])


def _pairs(width: int, gram: int):
    """Each document's distinct anchors, with the number of suffixes of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches_of(batches):
            keys, rows, counts = [], [], []
            for row, text in enumerate(batch.column(2)):
                words = text.as_py().split()
                if len(words) >= width:
                    each, _, n = anchors(words, hashes, width, gram)
                    found, at = np.unique(each, return_inverse=True)
                    keys.append(found)
                    rows.append(np.full(len(found), row))
                    counts.append(np.bincount(at, n).astype(np.int64))
            if keys:
                at = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys)), batch.column(0).take(at), batch.column(1).take(at), pa.array(np.concatenate(counts))],
                    ["anchor", "doc_id", "row_key", "suffixes"],
                )

    return run


_RUNS = "grp long, doc_id long, row_key long, kind byte, starts array<int>, words int, run binary"
_RUN_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int8(), pa.list_(pa.int32()), pa.int32(), pa.binary()]
#: What a row says: a run of text for the group's tree; a run whose text a smaller document of the batch sends; the
#: smallest document of a whole window that a task has seen; and where a document's whole windows begin.
RUN, COPY, LEAST, PLACES = range(4)


def _spans(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Where each word begins and ends in the words joined by blanks."""
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    return np.r_[0, ends[:-1] + 1], ends


def _rows(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def _runs(width: int, gram: int):
    """The runs of repeated anchors, the smallest document first, and the minima of windows that are their own groups."""
    names = [c.split()[0] for c in _RUNS.split(", ")]

    def minima(least: dict[bytes, tuple[int, int]]) -> list[tuple]:
        return [(_group(d), doc, key, LEAST, None, None, d) for d, (doc, key) in least.items()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        least: dict[bytes, tuple[int, int]] = {}
        for batch in batches_of(batches):
            docs, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            out: list[tuple] = []
            sent: dict[bytes, int] = {}
            for row in np.argsort(docs, kind="stable"):
                doc, key = int(docs[row]), int(keys[row])
                words = batch.column(2)[row].as_py().split()
                wanted = dict(zip(batch.column(3)[row].as_py(), batch.column(4)[row].as_py(), strict=True))
                text = b" ".join(words)
                begins, ends = _spans(words)
                own: dict[tuple[int, bytes], list[int]] = {}
                whole: list[int] = []
                for anchor, first, n in zip(*(x.tolist() for x in anchors(words, hashes, width, gram)), strict=True):
                    hot = wanted.get(anchor)
                    if hot:
                        whole += range(first, first + n)
                    elif hot is not None:
                        own.setdefault((anchor, text[begins[first] : ends[first + n + width - 2]]), []).append(first)
                for (group, content), starts in own.items():
                    smallest = sent.setdefault(content, doc)
                    n = content.count(b" ") + 1
                    out.append((group, doc, key, COPY if smallest < doc else RUN, starts, n, content if smallest == doc else None))
                for i in whole:
                    digest = xxhash.xxh3_128_digest(text[begins[i] : ends[i + width - 1]])
                    held = least.setdefault(digest, (doc, key))
                    if doc < held[0]:
                        least[digest] = (doc, key)
                    elif doc == held[0] and key != held[1]:
                        # Another text under the same doc_id owns the node as well.
                        out.append((_group(digest), doc, key, LEAST, None, None, digest))
                if whole:
                    out.append((key, doc, key, PLACES, whole, None, None))
                if len(least) > HELD_WINDOWS:
                    out += minima(least)
                    least.clear()
            if out:
                yield _rows(out, _RUN_TYPES, names)
        if least:
            yield _rows(minima(least), _RUN_TYPES, names)

    return run


def _group(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "big", signed=True)


class SuffixTree:
    """A compressed tree of the first ``depth`` words of suffixes, each node at that depth with its smallest document.

    A node is a table from the first word of an edge to the edge: (words, first, end, what is below), where the label is
    a stretch of a text that is held anyway, and below is the next node or, at the cut, a document. Texts come in the
    order of their documents, so the document that makes a node at the cut is the smallest one under it.
    """

    def __init__(self, depth: int):
        self.depth = depth
        self.root: dict[bytes, tuple] = {}

    def add(self, words: list[bytes], at: int, doc: int) -> int:
        """Add the suffix that begins at a word; the smallest document of the node that it arrives at."""
        node, end = self.root, at + self.depth
        while True:
            edge = node.get(words[at])
            if edge is None:
                node[words[at]] = (words, at, end, doc)
                return doc
            label, first, last, below = edge
            length = last - first
            if words[at : at + length] == label[first:last]:
                at += length
                if at == end:
                    return below
                node = below
                continue
            k = 1
            while words[at + k] == label[first + k]:
                k += 1
            # The edge is cut where the words part: a new internal node, and a leaf for the suffix.
            node[words[at]] = (
                label,
                first,
                first + k,
                {label[first + k]: (label, first + k, last, below), words[at + k]: (words, at + k, end, doc)},
            )
            return doc

    def insert(self, words: list[bytes], doc: int) -> list[bool]:
        """Add each suffix of the text that is deep enough; whether it repeats a smaller document's."""
        return [self.add(words, i, doc) < doc for i in range(len(words) - self.depth + 1)]


_FOUND = "doc_id long, row_key long, windows array<int>, places array<int>, owned binary"
_FOUND_TYPES = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary()]


def _repeats(width: int):
    """For sorted rows, the windows that repeat a smaller document's, and the whole windows that a document owns."""
    names = [c.split()[0] for c in _FOUND.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, tree, owner = None, SuffixTree(width), {}
        for batch in batches_of(batches):
            out: list[tuple] = []
            groups, docs, keys, kinds = (batch.column(i).to_numpy() for i in range(4))
            for i in range(batch.num_rows):
                if groups[i] != group:
                    group, tree, owner = groups[i], SuffixTree(width), {}
                doc, key = int(docs[i]), int(keys[i])
                if kinds[i] == LEAST:
                    digest = batch.column(6)[i].as_py()
                    if owner.setdefault(digest, doc) == doc:
                        out.append((doc, key, None, None, digest))
                    continue
                starts = batch.column(4)[i].as_py()
                if kinds[i] == PLACES:
                    out.append((doc, key, None, starts, None))
                    continue
                n = batch.column(5)[i].as_py() - width + 1
                again = [True] * n if kinds[i] == COPY else tree.insert(batch.column(6)[i].as_py().split(b" "), doc)
                if any(again):
                    found = np.add.outer(starts, np.flatnonzero(again)).ravel().astype(np.int32)
                    out.append((doc, key, found, None, None))
            if out:
                yield _rows(out, _FOUND_TYPES, names)

    return run


def _covered(words: list[bytes], found: dict | None, width: int) -> np.ndarray | None:
    """Which of the words go; None if all stay."""
    if not found:
        return None
    starts = [np.asarray(w, np.int64) for w in found["windows"]]
    if found["places"]:
        text, (begins, ends), owned = b" ".join(words), _spans(words), set(found["owned"])
        places = np.unique(np.concatenate([np.asarray(p, np.int64) for p in found["places"]])).tolist()
        lost = [i for i in places if xxhash.xxh3_128_digest(text[begins[i] : ends[i + width - 1]]) not in owned]
        starts.append(np.array(lost, np.int64))
    starts = np.unique(np.concatenate(starts)) if starts else np.array([], np.int64)
    if not len(starts):
        return None
    change = np.zeros(len(words) + 1, np.int64)
    change[starts] += 1
    change[starts + width] -= 1
    return np.cumsum(change[:-1]) > 0


def _kept(width: int):
    """Remove the words that the listed windows cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            n_words, n_removed, kept, spans = [], [], [], []
            for text, found in zip(batch.column(2), batch.column(3), strict=True):
                words = text.as_py().split()
                n_words.append(len(words))
                covered = _covered(words, found.as_py(), width)
                if covered is None:
                    n_removed.append(0)
                    kept.append(b" ".join(words))
                    spans.append([])
                    continue
                edges = np.flatnonzero(np.diff(np.r_[False, covered, False].astype(np.int8))).reshape(-1, 2)
                n_removed.append(int(covered.sum()))
                kept.append(b" ".join(w for w, gone in zip(words, covered.tolist(), strict=True) if not gone))
                spans.append([{"first": int(a), "last": int(b) - 1} for a, b in edges])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(kept, pa.binary()),
                    pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
                ],
                ["doc_id", "row_key", "n_words", "n_removed", "kept", "removed"],
            )

    return run


def _located(docs: DataFrame, rest: list[str], width: int, gram: int, hot_documents: int, group_suffixes: int) -> DataFrame:
    """doc_id, row_key, text, what was found of it (windows, places, owned), and the columns ``rest`` as one."""
    spark = docs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("doc_id").cast("long"), F.col("text")).alias("row_key"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
        (F.struct(*rest) if rest else F.lit(0)).alias("rest"),
    )
    named = F.col("doc_id").isNotNull()
    pairs = stage(
        rows.where(named)
        .select("doc_id", "row_key", "text")
        .mapInArrow(_pairs(width, gram), "anchor long, doc_id long, row_key long, suffixes long"),
        "anchors",
    )
    repeated = (
        pairs.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("suffixes").alias("size"), F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
        .where("a < b")
        .select(F.col("anchor").alias("again"), ((F.col("n") > hot_documents) | (F.col("size") > group_suffixes)).alias("hot"))
    )
    wanted = (
        pairs.join(repeated, F.col("anchor") == F.col("again"))
        .groupBy("doc_id", "row_key")
        .agg(F.collect_list("anchor").alias("anchors"), F.collect_list("hot").alias("hots"))
    )
    # One exchange of the texts, with all that goes with them, serves both joins below.
    placed = rows.repartition(parts, "doc_id", "row_key")
    runs = (
        placed.join(wanted, ["doc_id", "row_key"])
        .select("doc_id", "row_key", "text", "anchors", "hots", "rest")
        .mapInArrow(_runs(width, gram), _RUNS)
    )
    lists = [F.collect_list(c).alias(c) for c in ("windows", "places", "owned")]
    found = (
        runs.repartition(parts, "grp")
        .sortWithinPartitions("grp", "doc_id")
        .mapInArrow(_repeats(width), _FOUND)
        .groupBy("doc_id", "row_key")
        .agg(*lists)
        .select("doc_id", "row_key", F.struct("windows", "places", "owned").alias("found"))
    )
    return placed.join(found, ["doc_id", "row_key"], "left").select("doc_id", "row_key", "text", "found", "rest")


def remove_repeats(
    docs: DataFrame, width: int = 50, gram: int = GRAM, hot_documents: int = HOT_DOCUMENTS, group_suffixes: int = GROUP_SUFFIXES
) -> DataFrame:
    """Every document without the words of long passages that a document with a smaller id has as well.

    A window is ``width`` words in a row; words are runs of anything but blanks and control characters 9 to 13. A word
    goes when a window that covers it also stands in a document with a smaller doc_id. Windows are
    judged on the input, not on what is left. Returns doc_id, row_key (a hash that tells rows with one doc_id apart),
    n_words, n_removed, ``kept`` (the words that stay, joined by blanks, as a string) and ``removed``
    (first and last place of each removed stretch, from 0).

    Missing and empty texts have no words. Rows without doc_id take no part and keep their words. Rows with the same
    doc_id do not remove each other's words; equal rows get equal results. Columns other than doc_id
    and text are not read.
    """
    return (
        _located(docs, [], width, gram, hot_documents, group_suffixes)
        .mapInArrow(
            _kept(width),
            "doc_id long, row_key long, n_words long, n_removed long, kept binary,"
            " removed array<struct<first: int, last: int>>",
        )
        .withColumn("kept", F.col("kept").cast("string"))
    )


def without_repeats(
    docs: DataFrame, width: int = 50, gram: int = GRAM, hot_documents: int = HOT_DOCUMENTS, group_suffixes: int = GROUP_SUFFIXES
) -> DataFrame:
    """``docs`` with the words taken out of ``text``; the layout of what stays is kept.

    Only texts that lose words change. A removed stretch of words goes with the white space behind it. n_chars, where it is
    a column, is counted again for them. A document whose words all go keeps its row, with an empty text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            gone = [
                (text, _covered(text.split(), found, width) if found else None)
                for text, found in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            ]
            cut = [None if covered is None else _cut(text.decode(), covered) for text, covered in gone]
            yield pa.RecordBatch.from_arrays([batch.column(4), pa.array(cut, pa.string())], ["rest", "cut"])

    located = _located(docs, docs.columns, width, gram, hot_documents, group_suffixes)
    kind = located.schema["rest"].dataType.simpleString()
    done = located.mapInArrow(run, f"rest {kind}, cut string")
    changed = {"text": F.coalesce("cut", "rest.text")}
    if "n_chars" in docs.columns:
        count = F.length("cut").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.col("cut").isNotNull(), count).otherwise(F.col("rest.n_chars"))
    return done.select(*[changed.get(c, F.col("rest")[c]).alias(c) for c in docs.columns])


_WORD = re.compile(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")


def _cut(text: str, covered: np.ndarray) -> str:
    """The text without the covered words and the white space behind each."""
    words = _WORD.findall(text)
    lead = len(text) - sum(map(len, words))
    return text[:lead] + "".join(w for w, gone in zip(words, covered.tolist(), strict=True) if not gone)
