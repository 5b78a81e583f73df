"""Byte-level BPE by merge replay over the distinct words of a block of the corpus.

A merge list says which pair of neighbouring tokens becomes one, and in which order. Instead of encoding one
text after the other, the distinct words of a block of documents are laid out in one row of tokens, and an index
tells for each pair where in that row it stands. Merges are then applied in the order of their ranks, each at all
places that the index lists, and each application changes the index for its two neighbours only. Texts
are put together from their words' ids. A block is a part of an Arrow batch; words met before are kept in a
bounded table. No row leaves its task, so nothing is shuffled.
"""

from __future__ import annotations

import base64
import gc
import heapq
import sys
from array import array
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callmart.llm.common import batches_of, texts

#: Words whose ids a Python worker remembers between blocks and tasks: of those met lately, and of those before.
KNOWN_WORDS = 150_000
#: Pairs that it remembers; a full table starts anew.
KNOWN_PAIRS = 500_000
#: Bytes of text that make a block; a longer text is a block by itself.
BLOCK_BYTES = 4_000_000
#: Words laid out in one row of tokens, which bounds the index and keeps it near the processor.
REPLAYED_WORDS = 4_000


class Merges:
    """A rank file: one token per line, in base 64, and its rank, which is its id as well."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.token = [b""] * (max(self.rank.values()) + 1)
        for token, number in self.rank.items():
            self.token[number] = token
        self.of_byte = [self.rank[bytes([b])] for b in range(256)]
        self.pairs: dict[tuple[int, int], int] = {}

    @cached_property
    def of_bytes(self) -> list[list[int]]:
        """The id of the token of each two bytes, or -1."""
        return [[self.rank.get(bytes([a, b]), -1) for b in range(256)] for a in range(256)]

    def joined(self, a: int, b: int) -> int:
        """The id of the token that two neighbours merge into, or -1."""
        found = self.pairs.get((a, b))
        if found is None:
            found = self.pairs[a, b] = self.rank.get(self.token[a] + self.token[b], -1)
        return found

    def replay(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word.

        The index lists, under the token that a pair merges into, the places where such a pair begins. Of
        the listed merges the one of lowest rank comes first, and of its places the leftmost. A merge
        may list a pair of lower rank than its own, which then comes next; so each
        word goes through the very steps it would go through alone.
        """
        ids: list[int] = []
        left: list[int] = []
        right: list[int] = []
        # What the pair that begins at a place merges into.
        pair: list[int] = []
        starts = []
        for word in words:
            first = len(ids)
            starts.append(first)
            whole = self.rank.get(word)
            if whole is not None:
                ids.append(whole)
                left.append(-1)
                right.append(-1)
                pair.append(-1)
                continue
            ids.extend(self.of_byte[b] for b in word)
            left.append(-1)
            left.extend(range(first, len(ids) - 1))
            right.extend(range(first + 1, len(ids)))
            right.append(-1)
            pair.extend(self.of_bytes[a][b] for a, b in pairwise(word))
            pair.append(-1)

        joined, known = self.joined, self.pairs.get
        if len(self.pairs) > KNOWN_PAIRS:
            self.pairs.clear()
        # From what a pair merges into to the places where such a pair begins.
        index: dict[int, list[int]] = {}
        for place, merged in enumerate(pair):
            if merged >= 0:
                index.setdefault(merged, []).append(place)
        waiting = list(index)
        heapq.heapify(waiting)
        while waiting:
            merged = heapq.heappop(waiting)
            places = index.pop(merged)
            places.sort()
            for n, place in enumerate(places):
                if pair[place] != merged:
                    continue  # a neighbour was merged meanwhile
                after = right[place]
                beyond, before = right[after], left[place]
                ids[place], ids[after], right[place], pair[after] = merged, -1, beyond, -1
                lower = False
                if beyond >= 0:
                    left[beyond] = place
                    new = known((merged, ids[beyond]))
                    if new is None:
                        new = joined(merged, ids[beyond])
                    pair[place] = new
                    if new >= 0:
                        lower = new < merged
                        if new in index:
                            index[new].append(place)
                        else:
                            index[new] = [place]
                            heapq.heappush(waiting, new)
                else:
                    pair[place] = -1
                if before >= 0:
                    new = known((ids[before], merged))
                    if new is None:
                        new = joined(ids[before], merged)
                    pair[before] = new
                    if new >= 0:
                        lower = lower or new < merged
                        if new in index:
                            index[new].append(before)
                        else:
                            index[new] = [before]
                            heapq.heappush(waiting, new)
                if lower and n + 1 < len(places):
                    index[merged] = places[n + 1 :]
                    heapq.heappush(waiting, merged)
                    break
        starts.append(len(ids))
        return [[i for i in ids[a:b] if i >= 0] for a, b in pairwise(starts)]


class Splitter:
    """``pattern`` as the tiktoken library matches it.

    Unicode versions differ between the two regular expression engines, so a few letters and digits of one are none to the
    other. The library is asked once for the class of every character; in a text, those in doubt are matched as a
    stand-in of the class that the library sees.
    """

    def __init__(self, pattern: str):
        self.pattern = regex.compile(pattern)
        every = "".join(chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
        bytes_only = {bytes([b]): b for b in range(256)}
        self.stand_in: dict[int, str] = {}
        for kind, like in ((r"\p{L}", "a"), (r"\p{N}", "1"), (r"\s", " ")):
            plain = tiktoken.Encoding(kind, pat_str=kind, mergeable_ranks=bytes_only, special_tokens={})
            theirs = set(bytes(plain.encode_ordinary(every)).decode())
            ours = set(regex.findall(kind, every))
            self.stand_in |= dict.fromkeys(map(ord, theirs - ours), like)
            for c in map(ord, ours - theirs):
                self.stand_in.setdefault(c, "\ue000")  # for private use: no letter, digit or space
        self.doubtful = frozenset(map(chr, self.stand_in))

    def __call__(self, text: str) -> list[str]:
        if text.isascii() or self.doubtful.isdisjoint(text):
            return self.pattern.findall(text)
        return [text[m.start() : m.end()] for m in self.pattern.finditer(text.translate(self.stand_in))]


@lru_cache(maxsize=2)
def splitter(pattern: str) -> Splitter:
    """Made once in each Python worker."""
    return Splitter(pattern)


@lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    """Read once in each Python worker."""
    return Merges(path)


class Known:
    """Words met and their ids, four bytes an id: when the later table is full, it takes the place of the earlier."""

    def __init__(self):
        self.later: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}

    def learn(self, words: set[str], table: Merges) -> dict[str, bytes]:
        """The ids of ``words``, and of others."""
        if len(self.later) > KNOWN_WORDS:
            self.later, self.earlier = {}, self.later
        again = words.difference(self.later)
        new = list(again.difference(self.earlier))
        again.difference_update(new)
        self.later.update((w, self.earlier[w]) for w in again)
        collecting = gc.isenabled()
        gc.disable()  # the index is many small lists without a cycle
        try:
            for a in range(0, len(new), REPLAYED_WORDS):
                some = new[a : a + REPLAYED_WORDS]
                found = table.replay([w.encode() for w in some])
                self.later.update((w, array("i", ids).tobytes()) for w, ids in zip(some, found, strict=True))
        finally:
            if collecting:
                gc.enable()
        return self.later


@lru_cache(maxsize=1)
def known_words(path: str, pattern: str) -> Known:
    """Kept in each Python worker from task to task."""
    return Known()


def blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows of at most BLOCK_BYTES of text (column 1), or of one row."""
    sizes = pc.binary_length(batch.column(1)).to_numpy().tolist()
    first = total = 0
    for row, size in enumerate(sizes):
        if total + size > BLOCK_BYTES and row > first:
            yield batch.slice(first, row - first)
            first, total = row, 0
        total += size
    yield batch.slice(first)


def encode(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and ids of every whole text.

    ``ranks`` is a rank file that every executor can open at that path, ``pattern`` splits a text into the words
    that are merged separately. A missing text counts as empty; an empty text has no ids. Repeated rows and
    missing ids stay as they are; other columns are not read. A word of any length is merged in time
    n log n.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, split = merges(ranks), splitter(pattern)
        known = known_words(ranks, pattern)
        for batch in (block for each in batches_of(batches) for block in blocks(each)):
            pieces = [split(t.as_py().decode()) for t in batch.column(1)]
            of_word = known.learn({p for each in pieces for p in each}, table).__getitem__
            ids = [np.frombuffer(b"".join(map(of_word, each)), np.int32) for each in pieces]
            counts = np.array([len(x) for x in ids], np.int64)
            offsets = np.zeros(len(ids) + 1, np.int32)
            np.cumsum(counts, out=offsets[1:])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts), pa.ListArray.from_arrays(offsets, np.concatenate(ids))],
                ["doc_id", "n_tokens", "ids"],
            )

    return texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids array<int>")


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """The same rows and, in ``decoded``, the bytes that their ids stand for (empty where there are none)."""
    columns = encoded.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = merges(ranks).token
        for batch in batches_of(batches):
            ids = batch.column(columns.index("ids"))
            ends = np.cumsum(pc.list_value_length(ids).fill_null(0).to_numpy())[:-1]
            each = np.split(ids.flatten().to_numpy(), ends)
            decoded = [b"".join(map(token.__getitem__, x.tolist())) for x in each]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.binary())], [*columns, "decoded"])

    schema = encoded.schema.simpleString().removeprefix("struct<").removesuffix(">")
    return encoded.mapInArrow(run, f"{schema},decoded:binary")


def round_trip(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the bytes they decode to."""
    done = decode(encode(docs, ranks, pattern), ranks)
    return done.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
