"""Spelling variants: words one edit apart, found by two FM-indexes over the delimited vocabulary.

A word and a near one differ in one place, so one half of the word stands unchanged in the near word. The search
scheme has a search for each half: match it exactly, from the outer end of the word with its delimiter, then extend across the other
half to the other delimiter with one error allowed. An FM-index answers each extension by two rank lookups, which turn an
interval of suffix ranks into the interval of the longer match. The two indexes, over the words and over the words turned round,
are the two directions of a bidirectional index: the search that starts at the left end extends to the right in one, the
search that starts at the right end extends to the left in the other. An interval never holds more than one word's
end once both delimiters are read, as words are distinct.

A vocabulary has no size bound, so no task sees all of it. A word is dealt to the shards of the halves it could be
matched by: near words differ by at most one in length, so those are two prefixes and two suffixes of it. A word and all
words that share its half meet in one shard, where the shard's index answers all of the shard's words. A half of very many
words is dealt over several shards, each with a part of the words to be found, and its queries go to all of them.
Each search returns one row for a word with its number of near words and the best of them, not the pairs.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callmart.llm.common import batches_of, texts
from callmart.session import stage

LEAST_CHARS = 7
LEAST_COUNT = 2
#: How many times as frequent a word's form is.
TIMES = 10
#: Words that make a shard, on average and at most of one half.
SHARD_WORDS = 8_000
#: Intervals up to this size are read row by row for their letters, larger ones letter by letter.
NARROW = 64
#: Most tasks of the search; beyond it a task searches more shards, one after the other.
MOST_PARTITIONS = 10_000
#: Different words that a task counts before it sends their counts on.
COUNTED_WORDS = 500_000

_RUN = re.compile("[a-zÀ-ÿ]+")


def _runs(every: int):
    """Words of each batch with their counts; one run in ``every`` of a document has lost a letter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def counted():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
            )

        for batch in batches_of(batches):
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                doc = doc_id.as_py()
                start = zlib.crc32(b":" if doc is None else b"%d:" % doc)
                # Lower-casing bytes changes A to Z only.
                for found, n in Counter(_RUN.findall(text.as_py().lower().decode())).items():
                    h = zlib.crc32(found.encode(), start)
                    if h % every == 0:
                        at = h % len(found)
                        found = found[:at] + found[at + 1 :]
                    if len(found) >= LEAST_CHARS:
                        counts[found] += n
                if len(counts) > COUNTED_WORDS:
                    yield counted()
                    counts.clear()
        if counts:
            yield counted()

    return run


def vocabulary(docs: DataFrame, every: int = 31) -> DataFrame:
    """word and n, its occurrences, of the words of at least 7 code points and 2 occurrences.

    Words are runs of A to Z, a to z and U+00C0 to U+00FF, A to Z lower-cased. Where ``every`` divides the CRC-32 of
    ``<doc_id>:<run>``, that run has lost one letter. A missing doc_id counts as empty text there.
    """
    counts = texts(docs).mapInArrow(_runs(every), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


class FMIndex:
    """Suffix ranks of a delimited list of distinct words, read from left to right.

    The indexed text holds the words turned round, so that a longer match, which puts its next letter in front, follows
    the word in reading order.
    """

    def __init__(self, words: list[str]):
        codes = np.frombuffer("".join(f"\n{w[::-1]}" for w in words).encode("utf-32-le"), np.uint32)
        self.letters, text = np.unique(codes, return_inverse=True)  # the delimiter is the least letter
        n = len(text)
        rank = text.astype(np.int64)
        step = 1
        while True:
            # Ranks of rotations by twice as many letters; words differ, so in the end all ranks do.
            pair = rank * (n + 1) + np.roll(rank, -step)
            order = np.argsort(pair, kind="stable")
            ranked = pair[order]
            new = np.r_[0, np.cumsum(ranked[1:] != ranked[:-1])]
            rank = np.empty(n, np.int64)
            rank[order] = new
            if new[-1] == n - 1:
                break
            step *= 2
        #: The letter in front of each suffix.
        self.before = text[order - 1].astype(np.int64)
        #: For a letter and i: the rank that the first i suffixes' extensions by it end before. One more row, of
        #: empty intervals, stands for letters that no word has.
        self.ranks = np.zeros((len(self.letters) + 1, n + 1), np.int32)
        first = 0
        for letter in range(len(self.letters)):
            row = self.ranks[letter]
            np.cumsum(self.before == letter, out=row[1:])
            row += first
            first = int(row[-1])
        #: The word that a suffix which begins with a delimiter goes on with.
        self.word_of = (np.cumsum(text == 0) - 1)[order]

    def codes(self, words: list[str]) -> np.ndarray:
        """The words' letters in a row, each word with a delimiter behind."""
        flat = np.frombuffer("".join(f"{w}\n" for w in words).encode("utf-32-le"), np.uint32)
        found = np.searchsorted(self.letters, flat)
        found[found == len(self.letters)] = 0
        return np.where(self.letters[found] == flat, found, len(self.letters))

    def extend(self, low: np.ndarray, high: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the matches that are longer by one letter."""
        return self.ranks[letter, low].astype(np.int64), self.ranks[letter, high].astype(np.int64)

    def branches(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (number of the interval, letter) of the letters, delimiter aside, that may follow each match."""
        size, letters = high - low, len(self.letters)
        narrow, wide = np.flatnonzero(size <= NARROW), np.flatnonzero(size > NARROW)
        counts = size[narrow]
        rows = np.repeat(low[narrow] - np.r_[0, np.cumsum(counts)[:-1]], counts) + np.arange(counts.sum())
        seen = np.unique(np.repeat(narrow, counts) * letters + self.before[rows])
        every = (wide[:, None] * letters + np.arange(letters)).ravel()
        at, letter = np.divmod(np.r_[seen, every], letters)
        return at[letter > 0], letter[letter > 0]


def one_error(index: FMIndex, words: list[str], half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of numbers (of ``words``, of the indexed words): one edit apart, with the first ``half`` letters unchanged.

    No pair comes twice. All words are searched for together, a letter at a time.
    """
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    flat = index.codes(words)
    query = np.arange(len(words))
    place = np.r_[0, np.cumsum(lengths + 1)[:-1]]
    end, stop = place + lengths, place + half
    low, high = (np.full(len(words), index.ranks[0, i], np.int64) for i in (0, -1))
    none = np.zeros(0, np.int64)
    one = [none] * 5  # query, place, end, low, high of searches that have had their error
    indexed = len(index.word_of)
    found = [none]
    while query.size or one[0].size:
        # Those read on exactly, to the delimiter and over it.
        q, p, e, lo, hi = one
        lo, hi = index.extend(lo, hi, flat[p])
        done = (p == e) & (lo < hi)
        found.append(q[done] * indexed + index.word_of[lo[done]])
        on = (p < e) & (lo < hi)
        grown = [[q[on], p[on] + 1, e[on], lo[on], hi[on]]]
        free = place >= stop
        if free.any():
            fq, fp, fe, fl, fh = (x[free] for x in (query, place, end, low, high))
            inner = fp < fe
            # The near word lacks this letter,
            grown.append([fq[inner], fp[inner] + 1, fe[inner], fl[inner], fh[inner]])
            at, letter = index.branches(fl, fh)
            bl, bh = index.extend(fl[at], fh[at], letter)
            real = bl < bh
            at, letter, bl, bh = at[real], letter[real], bl[real], bh[real]
            # or has one more in front of it,
            grown.append([fq[at], fp[at], fe[at], bl, bh])
            # or has another one in its place.
            other = inner[at] & (letter != flat[fp[at]])
            s = at[other]
            grown.append([fq[s], fp[s] + 1, fe[s], bl[other], bh[other]])
        low, high = index.extend(low, high, flat[place])
        on = (place < end) & (low < high)
        query, place, end, stop, low, high = (x[on] for x in (query, place + 1, end, stop, low, high))
        one = [np.concatenate(c) for c in zip(*grown, strict=True)]
    return np.divmod(np.unique(np.concatenate(found)), indexed)


def near_by_half(words: list[str], known: list[str], n: np.ndarray, right: bool):
    """For ``words`` with near words among ``known`` (distinct, in code-point order; ``n`` are their counts): their numbers, how many, the best.

    Near words with the left half (the first ``len // 2`` letters) unchanged, or, with ``right``, those with only the right half unchanged.
    The best has the largest count, and is the least in code-point order of several.
    """
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    if right:
        q, u = one_error(FMIndex([w[::-1] for w in known]), [w[::-1] for w in words], lengths - lengths // 2)
        halves = [w[: len(w) // 2] for w in words]
        only = [not known[b].startswith(halves[a]) for a, b in zip(q.tolist(), u.tolist(), strict=True)]
        only = np.fromiter(only, bool, len(only))
        q, u = q[only], u[only]
    else:
        q, u = one_error(FMIndex(known), words, lengths // 2)
    order = np.lexsort((u, -n[u], q))
    q, u = q[order], u[order]
    first = np.flatnonzero(np.diff(q, prepend=-1))
    return q[first], np.diff(np.r_[first, len(q)]), u[first]


_DEALT = "shard long, side int, word string, n long, find boolean, ask boolean"


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For rows sorted by shard and side, each asking word's near words in the shard."""

    def answered(parts: list[pa.RecordBatch], side: int) -> Iterator[pa.RecordBatch]:
        words = [w for p in parts for w in p.column(2).to_pylist()]
        n, find, ask = (np.concatenate([p.column(i).to_numpy(zero_copy_only=False) for p in parts]).tolist() for i in (3, 4, 5))
        # A word is dealt by several halves, at times twice to one shard.
        count = {w: c for w, c, f in zip(words, n, find, strict=True) if f}
        asking = list(dict.fromkeys(w for w, a in zip(words, ask, strict=True) if a))
        if not count or not asking:
            return
        known = sorted(count)
        counts = np.fromiter(map(count.__getitem__, known), np.int64, len(known))
        q, near, best = near_by_half(asking, known, counts, side == 1)
        if q.size:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([asking[i] for i in q.tolist()], pa.string()),
                    pa.array(near, pa.int64()),
                    pa.array(counts[best], pa.int64()),
                    pa.array([known[i] for i in best.tolist()], pa.string()),
                ],
                ["word", "near", "best_n", "best"],
            )

    last, parts = None, []
    for batch in batches_of(batches):
        shards, sides = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        cuts = np.r_[0, np.flatnonzero((np.diff(shards) != 0) | (np.diff(sides) != 0)) + 1, len(shards)]
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            here = (shards[a], sides[a])
            if parts and here != last:
                yield from answered(parts, last[1])
                parts = []
            last = here
            parts.append(batch.slice(a, b - a))
    if parts:
        yield from answered(parts, last[1])


def dealt(words: DataFrame, shards: int, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(shard, side, word, n, find, ask): where each word may be found by a half, and where it asks by its own.

    A word of length l is matched by its first l div 2 letters or by the others. A near word is a letter shorter or longer, or as long, so it
    can be found by the halves that words of these three lengths have.
    """
    length = F.char_length("word")
    left = lambda k: F.floor((length + k) / 2).cast("int")
    sides = []
    for side, size in enumerate((left, lambda k: length + k - left(k))):
        own = size(0)
        sizes = F.array_distinct(F.array(size(-1), own, size(1)))
        half = lambda m: F.substring("word", F.lit(1), m) if side == 0 else F.right("word", m)  # noqa: B023, E731
        sides.append(F.transform(sizes, lambda m: F.struct(F.lit(side).alias("side"), half(m).alias("half"), (m == own).alias("ask"))))  # noqa: B023
    rows = words.select("word", "n", F.inline(F.concat(*sides)))
    # A half of many words is dealt over several shards: each holds a part of them, and is asked all questions.
    parts = rows.groupBy("side", "half").agg(F.ceil(F.count(F.lit(1)) / shard_words).cast("int").alias("parts"))
    parts = parts.select(F.col("side").alias("_side"), F.col("half").alias("_half"), "parts")
    rows = rows.join(parts, (F.col("side") == F.col("_side")) & (F.col("half") == F.col("_half")))
    own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    asked = F.when(F.col("ask"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(own))
    rows = rows.select("word", "n", "side", "half", "ask", own.alias("own"), F.explode(asked).alias("part"))
    shard = F.pmod(F.xxhash64("side", "half", "part"), F.lit(shards)).alias("shard")
    return rows.select(shard, "side", "word", "n", (F.col("part") == F.col("own")).alias("find"), "ask")


def near_words(words: DataFrame, total: int, shard_words: int = SHARD_WORDS) -> DataFrame:
    """word, n_near, best_n and best (its best near word), for the words of ``words`` (word, n) that have near words."""
    spark = words.sparkSession
    shards = max(1, math.ceil(2 * total / shard_words))
    # Shards decide what meets, partitions only where: a partition holds its shards one after the other.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(shards, MOST_PARTITIONS))
    found = (
        dealt(words, shards, shard_words)
        .repartition(parts, "shard", "side")
        .sortWithinPartitions("shard", "side")
        .mapInArrow(_search, "word string, near long, best_n long, best string")
    )
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("first")
    return (
        found.groupBy("word")
        .agg(F.sum("near").alias("n_near"), best)
        .select("word", "n_near", (-F.col("first.less")).alias("best_n"), F.col("first.best").alias("best"))
    )


def roots(forms: DataFrame, most: int, times: int = TIMES) -> DataFrame:
    """word and root: the last of the forms that lead on from a word of ``forms`` (word, form), for every word that is a form.

    A form is at least ``times`` as frequent as its word and no count is over ``most``, which bounds how long chains are.
    """
    step = forms.select(F.col("word").alias("_word"), F.col("form").alias("_form"))
    ends = forms.select(F.col("form").alias("word")).distinct().withColumn("root", F.col("word"))
    if times < 2:
        raise ValueError("a form must be more frequent than its word, twice or more")
    rounds = 0
    while LEAST_COUNT * times ** (rounds + 1) <= most:
        rounds += 1
    for _ in range(rounds):
        ends = ends.join(step, F.col("root") == F.col("_word"), "left")
        ends = ends.select("word", F.coalesce("_form", "root").alias("root"))
    return ends


def variants(docs: DataFrame, times: int = TIMES, every: int = 31, shard_words: int = SHARD_WORDS) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the vocabulary.

    Words are near if one letter inserted, deleted or replaced turns one into the other. A word's form is its near word of
    the largest count (ties: the least in code-point order) if that is ``times`` its own or more, else missing; its root is
    what forms lead to, itself without one.

    Missing and empty texts have no words. Repeated rows and ids count each time. Without a word of two occurrences the
    result is empty. Columns other than doc_id and text are not read.
    """
    words = stage(vocabulary(docs, every), "vocabulary")
    total, most = words.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0))).first()
    near = near_words(words, total, shard_words).withColumnRenamed("word", "_word")
    is_form = F.col("best_n") >= times * F.col("n")
    found = words.join(near, F.col("word") == F.col("_word"), "left").select(
        "word",
        F.when(is_form, F.col("best")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("best_n")).alias("form_n"),
    )
    found = stage(found, "forms")
    ends = roots(found.where("form is not null").select("word", "form"), most, times).select(F.col("word").alias("_end"), "root")
    # A word without a form leads to itself, whether or not it is one.
    done = found.join(ends, F.coalesce("form", "word") == F.col("_end"), "left")
    return done.select("word", "form", F.coalesce("root", "form", "word").alias("root"), "n", "n_near", "form_n")
