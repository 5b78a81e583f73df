"""Sum-of-squares packing of token sequences.

Texts are tokenised where they are read. Only the narrow piece table moves: pieces are dealt evenly into groups, each
of which is packed on its own. A group places its pieces one after the other; each goes where the sum over all
gaps of the squared number of open sequences with that gap becomes smallest, which keeps a mixture of gaps open so that
later pieces fit. The shortest fifth of a group comes last, longest first, and fills what is open. The pieces of
sequences that are not full in the end, a few in a hundred, are dealt into fewer groups and packed again,
until there is one group or most pieces stay open.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from callmart.llm.common import batches_of, texts
from callmart.session import stage

#: Pieces that one task packs.
GROUP_PIECES = 100_000
#: The share of a group's pieces, the shortest ones, that comes last and fills what is open.
LAST = 0.2
#: Words whose ids a task remembers; a full table starts anew.
KNOWN_WORDS = 500_000


class WordTokens(dict):
    """The vocabulary's ids of a word, little-endian, four bytes each.

    A vocabulary of the kind "lower case, byte-level merges, words that end in </w>": its merges are written as ranks
    of byte strings, where the byte 0xFF, which no UTF-8 text holds, stands for the end of a word. Words met
    before are looked up. With ``added``, the vocabulary's added tokens are read where a text writes them, as the library
    does; else their characters are text like other.
    """

    def __init__(self, path: str, added: bool = False):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            described = json.load(f)
        # Byte-level vocabularies write a printable byte as itself and the others as characters from 256 on.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        self.byte_of = byte_of = {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}
        special = {x["content"] for x in described["added_tokens"]}
        # They hold no white space and are taken from the text as it stands, so a word can be split at them.
        self.added = {x["content"]: x["id"] for x in described["added_tokens"]} if added else {}
        longest = sorted(map(re.escape, self.added), key=len, reverse=True)
        self.at_added = re.compile(f"({'|'.join(longest)})") if longest else None
        ranks = {}
        for token, number in described["model"]["vocab"].items():
            if token not in special:
                body = token.removesuffix("</w>")
                ranks[bytes(map(byte_of.__getitem__, body)) + END * (body != token)] = number
        # The pattern is not used: whole words are merged.
        self.merge = tiktoken.Encoding(
            "words", pat_str=".+", mergeable_ranks=ranks, special_tokens={}
        )._core_bpe.encode_single_piece

    def ids_of(self, word: bytes) -> bytes:
        text = word.decode()
        if self.at_added and self.at_added.search(text):
            parts = self.at_added.split(text)
            return b"".join(
                np.array([self.added[x]], "<u4").tobytes() if k % 2 else self.ids_of(x.encode()) for k, x in enumerate(parts) if x
            )
        if plain := _PLAIN.fullmatch(text):
            ids = self.merge(plain[1].lower().encode() + END)
            if plain[2]:
                ids += self.merge(plain[2].encode() + END)
        else:
            normal = self.tokenizer.normalizer.normalize_str(text)
            parts = [part for part, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]
            ids = [i for part in parts for i in self.merge(bytes(map(self.byte_of.__getitem__, part)) + END)]
        return np.array(ids, "<u4").tobytes()

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        found = self[word] = self.ids_of(word)
        return found


#: Letters that the vocabulary's normal form only makes small, and marks behind them.
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-į]+)([.,;:!?|]*)")
#: Stands for the end of a word in the ranks.
END = b"\xff"


@lru_cache(maxsize=2)
def word_tokens(path: str, added: bool = False) -> WordTokens:
    """Read once in each Python worker."""
    return WordTokens(path, added)


def pieces(docs: DataFrame, vocabulary: str, size: int, end: int = 0, added: bool = False) -> DataFrame:
    """Every document's ids and the id ``end``, cut every ``size`` ids.

    The vocabulary's own splitting never crosses white space, so words between blanks and controls 9 to 13 are
    tokenised separately and their ids put together; a task tokenises a word once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = word_tokens(vocabulary, added).__getitem__
        stop = np.array([end], "<u4").tobytes()
        for batch in batches_of(batches):
            rows, out = [], []
            for row, text in enumerate(batch.column(1)):
                ids = b"".join([*map(ids_of, text.as_py().split()), stop])
                for piece, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at : at + 4 * size]
                    rows.append(row)
                    out.append((piece, at // 4, len(part) // 4, zlib.crc32(part), part))
            columns = [pa.array(c) for c in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows)),
                    columns[0].cast(pa.int32()),
                    *(c.cast(pa.int64()) for c in columns[1:4]),
                    columns[4],
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32", "ids"],
            )

    return texts(docs).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
    )


def place(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sequence and the offset of each piece, by the sum of squares.

    With N(g) open sequences of gap g, moving one from gap g to g - s changes the sum by 2 (N(g - s) - N(g)) + 2, or by
    1 - 2 N(g) if that fills it; opening one adds 2 N(size - s) + 1. Ties go to the smaller gap,
    and a new sequence is opened only when that is strictly better.
    """
    count = np.zeros(size + 1, np.int64)  # by gap; a full sequence is not counted
    open_at: list[list[int]] = [[] for _ in range(size + 1)]
    sequence = np.empty(len(lengths), np.int64)
    offset = np.empty(len(lengths), np.int64)
    opened = 0
    never = np.iinfo(np.int64).max
    for i, s in enumerate(lengths.tolist()):
        opening = 2 * count[size - s] + 1 if s < size else 0
        now = count[s:size]
        change = 2 * (count[: size - s] - now) + 2
        if s < size:
            change[0] = 1 - 2 * now[0]
            change[now == 0] = never
            best = int(change.argmin())
            fits = change[best] != never and change[best] <= opening
        else:
            fits = False
        if fits:
            gap = s + best
            at = open_at[gap].pop()
            count[gap] -= 1
        else:
            gap, at = size, opened
            opened += 1
        sequence[i], offset[i] = at, size - gap
        if gap - s:
            open_at[gap - s].append(at)
            count[gap - s] += 1
    return sequence, offset


def _pack(size: int):
    """Place one group's pieces; rows come with the same columns and their place."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["shuffled", "doc_id", "piece", "ids_crc32"], kind="stable")
        lengths = group["length"].to_numpy()
        short = lengths <= np.quantile(lengths, LAST)
        order = np.r_[np.flatnonzero(~short), np.flatnonzero(short)[np.argsort(-lengths[short], kind="stable")]]
        group, lengths = group.iloc[order], lengths[order]
        sequence, offset = place(lengths, size)
        level = np.bincount(sequence, weights=lengths).astype(np.int64)
        return group.assign(sequence=sequence, offset=offset, is_full=level[sequence] == size)

    return run


def pack(pieces: DataFrame, size: int, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Every row of ``pieces`` with sequence_id and offset: no sequence is longer than ``size``, none has a gap.

    Pieces of full length are sequences of their own. Others are dealt evenly by a hash, whatever their
    documents are. Equal rows are told apart by where they were read. A piece longer than ``size`` is an error.
    The numbers of sequences are distinct, not consecutive.
    """
    columns = pieces.columns
    todo = pieces.withColumn("is_whole", F.col("length") == size).withColumn("row", F.monotonically_increasing_id())
    whole = todo.where("is_whole").select(*columns, F.col("row").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    done, todo = whole, todo.where("not is_whole").drop("is_whole")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in todo.schema)
    schema += ", shuffled long, grp int, sequence long, offset long, is_full boolean"
    count, turn = todo.count(), 0
    while count:
        turn += 1
        groups = -(-count // group_pieces)
        dealt = todo.withColumn("shuffled", F.xxhash64("doc_id", "piece", "row", F.lit(turn)))
        dealt = dealt.withColumn("grp", F.pmod("shuffled", F.lit(groups)).cast("int"))
        packed = stage(dealt.groupBy("grp").applyInPandas(_pack(size), schema), "packed")
        # Numbers below zero, apart from those of whole pieces: turn, group and number within the group.
        number = -(F.lit(turn).cast("long") * (1 << 56) + F.col("grp").cast("long") * (1 << 24) + F.col("sequence") + 1)
        left = packed.where("not is_full")
        still = left.count()
        # One group has seen all there is; and where most pieces stay open, another turn would not fill them either.
        last = groups == 1 or still > count // 2
        placed = packed if last else packed.where("is_full")
        done = done.unionByName(placed.select(*columns, number.alias("sequence_id"), "offset"))
        if last:
            break
        todo, count = left.select(*columns, "row"), still
    return done


def pack_documents(docs: DataFrame, vocabulary: str, size: int = 2048, end: int = 0, with_ids: bool = False) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset, and its ids if asked for.

    Added tokens that a text writes are read as such. Missing and empty texts are the id ``end`` alone. Rows without doc_id are packed like others, repeated rows each on
    their own; columns other than doc_id and text are not read. Ids travel with their pieces only if
    ``with_ids`` is set.
    """
    cut = pieces(docs, vocabulary, size, end, added=True)
    return pack(stage(cut if with_ids else cut.drop("ids"), "pieces"), size)
