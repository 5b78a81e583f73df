"""Byte-level BPE against tiktoken, packing against its contract."""

import base64
import hashlib
import random
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import public_tokenizers as P
import tiktoken
from cases import WORD, awkward, empty, prose, table
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from callmart.llm import bpe, packing

RANKS, VOCABULARY = P.path("byte_bpe_50k.tiktoken"), P.path("word_bpe_49k.json")


@lru_cache
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_tiktoken(spark):
    plain = library()
    rows = awkward()
    encoded = bpe.encode(table(spark, rows), RANKS, P.PATTERN)
    assert encoded.columns == ["doc_id", "n_tokens", "ids"]
    want = sorted((str(i), plain.encode_ordinary(t or "")) for i, t in rows)
    assert sorted((str(r.doc_id), list(r.ids)) for r in encoded.collect()) == want
    done = bpe.round_trip(table(spark, rows), RANKS, P.PATTERN).collect()
    digest = lambda b: hashlib.sha256(b).hexdigest()
    want = sorted(
        (str(i), len(ids := plain.encode_ordinary(t or "")), digest(" ".join(map(str, ids)).encode()), digest((t or "").encode()))
        for i, t in rows
    )
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in done) == want
    assert bpe.round_trip(empty(spark), RANKS, P.PATTERN).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=30), st.text("abt", max_size=40)), max_size=20))
def test_bpe_on_any_text(found):
    ranks, plain = bpe.merges(RANKS), library()
    split = bpe.splitter(P.PATTERN)
    words = [w for t in found for w in split(t)]
    assert [i for t in found for i in plain.encode_ordinary(t)] == [i for w in words for i in plain.encode_ordinary(w)]
    assert ranks.replay([w.encode() for w in words]) == [plain.encode_ordinary(w) for w in words]


def test_every_character_is_split_as_tiktoken_does():
    """Ranks that join a space, a letter or a digit to whatever stands beside it."""
    single = {bytes([b]): b for b in range(256)}
    split = bpe.splitter(P.PATTERN)
    for kind in (r"\p{L}", r"\p{N}", r"\s"):
        plain = tiktoken.Encoding(kind, pat_str=kind, mergeable_ranks=single, special_tokens={})
        for block in range(0, 0x110000, 0x4000):
            chars = [chr(c) for c in range(block, block + 0x4000) if not 0xD800 <= c < 0xE000]
            theirs = set(bytes(plain.encode_ordinary("".join(chars))).decode())
            if kind == r"\p{L}":
                ours = {c for c in chars if split(f"a{c}") == [f"a{c}"]}
            elif kind == r"\p{N}":
                ours = {c for c in chars if split(f"1{c}") == [f"1{c}"]}
            else:
                ours = {c for c in chars if len(split(f"#{c}#")) == 2 + (c != " ") and split(f"{c}{c}#")[0] == c}
            assert ours == theirs


def test_merges_that_open_lower_ranks():
    """Ranks where a merge makes a pair that comes before it."""
    table = bpe.Merges.__new__(bpe.Merges)
    letters = {bytes([b]): b for b in range(256)}
    table.rank = letters | {b"abc": 300, b"ca": 310, b"bc": 700, b"ab": 900, b"abcab": 800}
    table.token = [b""] * 901
    for token, number in table.rank.items():
        table.token[number] = token
    table.of_byte, table.pairs = list(range(256)), {}
    plain = tiktoken.Encoding("own", pat_str=".+", mergeable_ranks=table.rank, special_tokens={})
    rnd = random.Random(2)
    words = ["".join(rnd.choice("abc") for _ in range(rnd.randint(1, 20))) for _ in range(500)]
    assert table.replay([w.encode() for w in words]) == [plain.encode_ordinary(w) for w in words]


@lru_cache
def word_library():
    t = Tokenizer.from_file(VOCABULARY)
    t.encode_special_tokens = True
    return t


def word_ids(text):
    return word_library().encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text("aeiot'. 1é́ΣİN ", max_size=40)))
def test_words_tokenise_as_the_text_does(text):
    ids_of = packing.word_tokens(VOCABULARY).__getitem__
    found = b"".join(map(ids_of, text.encode().split()))
    assert np.frombuffer(found, "<u4").tolist() == word_ids(text)


def test_packing_contract(spark):
    rows, size = awkward() + [(500 + i, prose(random.Random(i), 40 + i)) for i in range(300)], 256
    found = packing.pack(packing.pieces(table(spark, rows), VOCABULARY, size), size, group_pieces=60).collect()
    want = defaultdict(list)
    for i, t in rows:
        ids = word_ids(t or "") + [0]
        for k, at in enumerate(range(0, len(ids), size)):
            part = np.array(ids[at : at + size], "<u4").tobytes()
            want[i].append((k, at, len(part) // 4, zlib.crc32(part)))
    got = defaultdict(list)
    sequences = defaultdict(list)
    for r in found:
        got[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert {i: sorted(x) for i, x in got.items()} == {i: sorted(x) for i, x in want.items()}
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    assert packing.pack_documents(empty(spark), VOCABULARY).count() == 0


def test_sequences_are_few():
    """One group against best fit decreasing, and against the sum of lengths where pieces are short."""
    rnd = np.random.default_rng(5)
    for top, least_slack in ((1.0, None), (0.3, 0.01)):
        lengths = rnd.integers(1, int(256 * top), 4000)
        group = packing.pd.DataFrame({"shuffled": np.arange(4000), "doc_id": 0, "piece": 0, "ids_crc32": 0, "length": lengths})
        found = packing._pack(256)(group)["sequence"].nunique()
        gaps, best = np.zeros(257, int), 0
        for s in sorted(lengths.tolist(), reverse=True):
            fits = np.flatnonzero(gaps[s:])
            if fits.size:
                gaps[s + fits[0]] -= 1
                gaps[fits[0]] += 1
            else:
                best += 1
                gaps[256 - s] += 1
        assert found <= 1.06 * best + 1
        if least_slack:
            assert found <= (1 + least_slack) * -(-lengths.sum() // 256) + 1


def test_place_takes_the_smallest_sum_of_squares():
    rnd = np.random.default_rng(3)
    size, lengths = 12, rnd.integers(1, 12, 300)
    sequence, offset = packing.place(lengths, size)
    level: dict[int, int] = {}
    for s, at, off in zip(lengths.tolist(), sequence.tolist(), offset.tolist()):

        def squares(change):
            count = defaultdict(int)
            for b, h in {**level, **change}.items():
                if h < size:
                    count[h] += 1
            return sum(n * n for n in count.values())

        options = [squares({b: h + s}) for b, h in level.items() if h + s <= size] + [squares({-1: s})]
        assert level.get(at, 0) == off and off + s <= size
        assert squares({at: off + s} if at in level else {-1: s}) == min(options)
        level[at] = off + s


def test_added_tokens_in_texts_are_read_as_the_library_does(spark):
    library = Tokenizer.from_file(VOCABULARY)
    rows = [
        (1, "a <|endoftext|> b"),
        (2, "one<|endoftext|><|startoftext|>two <|ENDOFTEXT|> <|endoftext| >"),
        (3, "<|endoftext|>"),
        (4, "é<|startoftext|>́x 12<|endoftext|>34 <|<|endoftext|>|>"),
        (5, "nothing added"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in packing.pack_documents(docs, VOCABULARY, with_ids=True).collect()}
    for i, text in rows:
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        assert np.frombuffer(found[i].ids, "<u4").tolist() == ids and found[i].length == len(ids)
        assert found[i].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
