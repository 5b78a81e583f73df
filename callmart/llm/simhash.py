"""SimHash near-dedup: fingerprints within a few bits of each other, found with BK-trees, and their components.

Two fingerprints of 64 bits that differ in at most r bits agree in one of any r + 1 blocks of bits. Distinct
fingerprints are therefore dealt into shards by (block, value of the block), once for each block, and every
close pair meets in a shard. A shard is a BK-tree: a node's children hang on edges numbered by their Hamming distance
to it, and a search for all within r follows only the edges from d - r to d + r. Trees are built and searched
where their shard's rows are; they grow with the corpus, so sending them to all executors would
have no bound. A shard that is too big is cut by blocks of the bits that it does not share yet, by the same
argument, so no pair is lost. A shard returns a spanning tree of its links, one row for a fingerprint, and
never its pairs. Links of all shards are joined into components on Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callmart.llm.common import batches_of, texts
from callmart.session import stage

#: A shard of more fingerprints than this is cut by further blocks, up to CUTS times.
SHARD_ROWS = 4_096
CUTS = 3
#: Shingle hashes whose bits are counted at a time.
CHUNK = 1 << 16


def majority(hashes: np.ndarray) -> int:
    """Bit i is 1 if it is set in over half of the hashes; 0 without any."""
    n, ones = len(hashes), np.zeros(64, np.int64)
    for i in range(0, n, CHUNK):
        bits = np.unpackbits(hashes[i : i + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprint(text: bytes, words: int = 4, seed: int = 42) -> int:
    """Bit i is 1 if it is set in over half the hashes of the shingles; 0 for a text without words."""
    found = text.lower().split()  # of bytes: only A-Z change, only blanks and controls 9 to 13 separate
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    begins = np.r_[0, ends[:-1] + 1]
    n = max(1, len(found) - words + 1)
    lasts = ends[words - 1 :] if len(found) >= words else ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], seed) for a, b in zip(begins[:n].tolist(), lasts.tolist(), strict=True)), np.uint64, n
    )
    return majority(hashes)


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """doc_id and the fingerprint of its whole text, as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            found = np.array([fingerprint(t.as_py(), words) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return texts(docs).mapInArrow(run, "doc_id long, fp long")


class BKTree:
    """A BK-tree over distinct 64-bit values: (place of the pivot, [(edge, child)])."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.root: tuple = (0, [])
        waiting = [(self.root, np.arange(1, len(values)))]
        while waiting:
            (pivot, children), rest = waiting.pop()
            if not rest.size:
                continue
            distance = np.bitwise_count(values[rest] ^ values[pivot])
            order = np.argsort(distance, kind="stable")
            distance, rest = distance[order], rest[order]
            cuts = np.flatnonzero(np.diff(distance)) + 1
            for edge, below in zip(distance[np.r_[0, cuts]].tolist(), np.split(rest, cuts), strict=True):
                child = (int(below[0]), [])
                children.append((edge, child))
                waiting.append((child, below[1:]))

    def near(self, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """For each node, the places of the values within the radius, all values searched for at once."""
        return ((pivot, found) for pivot, found in self.search(self.values, radius) if found.size > 1)

    def search(self, asked: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """For each node, the places in ``asked`` of what lies within the radius, all searched for at once."""
        waiting = [(self.root, np.arange(len(asked)))]
        while waiting:
            (pivot, children), searched = waiting.pop()
            distance = np.bitwise_count(asked[searched] ^ self.values[pivot]).astype(np.int64)
            found = searched[distance <= radius]
            if found.size:
                yield pivot, found
            for edge, child in children:
                follow = searched[np.abs(distance - edge) <= radius]
                if follow.size:
                    waiting.append((child, follow))


def shard_labels(values: np.ndarray, radius: int) -> np.ndarray:
    """For each value the first value of its component within the shard."""
    label = np.arange(len(values))
    for pivot, found in BKTree(values).near(radius):
        met = np.unique(np.r_[label[found], label[pivot]])
        if met.size > 1:
            label[np.isin(label, met[1:])] = met[0]
    return label


def _blocks(bits: list[int], count: int) -> list[list[int]]:
    """The bits in ``count`` even runs."""
    return [b.tolist() for b in np.array_split(np.array(bits), count)]


def _mask(bits: list[int]) -> int:
    """The bits as a signed 64-bit number."""
    return int(np.array([sum(1 << b for b in bits)], np.uint64).view(np.int64)[0])


def _links(radius: int):
    """For rows sorted by shard, a link from each value to the first one of its component in the shard."""

    def linked(parts: list[np.ndarray]) -> np.ndarray | None:
        values = np.unique(np.concatenate(parts)).view(np.uint64)
        if values.size < 2:
            return None
        label = shard_labels(values, radius)
        moved = np.flatnonzero(label != np.arange(len(values)))
        return np.stack([values[moved].view(np.int64), values[label[moved]].view(np.int64)], axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, parts, out = None, [], []

        def flush():
            if out:
                both = np.concatenate(out)
                out.clear()
                if len(both):
                    yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

        for batch in batches_of(batches):
            shards, values = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.r_[0, np.flatnonzero(np.diff(shards)) + 1, len(shards)]
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if shards[a] != last and parts:
                    if (found := linked(parts)) is not None:
                        out.append(found)
                    parts = []
                last = shards[a]
                parts.append(values[a:b])
            yield from flush()
        if parts and (found := linked(parts)) is not None:
            out.append(found)
        yield from flush()

    return run


def close_links(values: DataFrame, radius: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Links (a, b) between distinct values ``fp`` that join just what differs in at most ``radius`` bits."""
    spark = values.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    done = None
    todo = values.select("fp", F.lit(0).cast("long").alias("shard"), F.array([F.lit(0)]).alias("path"))
    # path: the block taken at each cut. Its bits and those of the cuts before are what a shard shares.
    layouts: dict[tuple[int, ...], list[list[int]]] = {(0,): _blocks(list(range(64)), radius + 1)}
    for cut in range(CUTS):
        cases = []
        deeper: dict[tuple[int, ...], list[list[int]]] = {}
        for path, blocks in layouts.items():
            taken = [
                F.struct(
                    F.array([F.lit(p) for p in (*path, k)]).alias("path"),
                    F.xxhash64(
                        F.col("shard"), F.lit(k), F.col("fp").bitwiseAND(F.lit(_mask(block)))
                    ).alias("shard"),
                )
                for k, block in enumerate(blocks)
            ]
            cases.append((F.col("path") == F.array([F.lit(p) for p in path]), F.array(taken)))
            if cut + 1 < CUTS:
                for k in range(len(blocks)):
                    rest = [b for j, block in enumerate(blocks) if j != k for b in block]
                    deeper[(*path, k)] = _blocks(rest, radius + 1)
        choice = cases[0][1] if len(cases) == 1 else F.when(*cases[0])
        for case in cases[1:]:
            choice = choice.when(*case)
        dealt = todo.select("fp", F.explode(choice).alias("to")).select("fp", "to.path", "to.shard")
        if cut + 1 < CUTS:
            big = stage(
                dealt.groupBy("shard").count().where(F.col("count") > shard_rows).select("shard"), "big-shards"
            )
            if not big.isEmpty():
                todo = dealt.join(big, "shard", "left_semi")
                dealt = dealt.join(big, "shard", "left_anti")
            else:
                cut = CUTS
        links = (
            dealt.select("shard", "fp")
            .repartition(parts, "shard")
            .sortWithinPartitions("shard")
            .mapInArrow(_links(radius), "a long, b long")
        )
        done = links if done is None else done.unionByName(links)
        if cut == CUTS:
            break
        layouts = deeper
    return done


def components(links: DataFrame) -> DataFrame:
    """For each linked value ``a`` the least value ``root`` of its component; values without links are not listed.

    Each round every value points its larger neighbours at its least neighbour, then itself and its smaller
    neighbours; both rounds keep the components and make them flatter, until each is a star. A round is a few
    shuffles of one row for a link, combined before they are sent, and is written out, so lineage stays short.
    """
    ends = lambda a, b: links_now.select(F.col(a).alias("u"), F.col(b).alias("v"))
    links_now = stage(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    before = None
    while True:
        both = ends("a", "b").unionByName(ends("b", "a"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x"))
            .select("x.a", "x.b")
            .where("a <> b")
            .distinct()
        )
        links_now = stage(small, "links")
        now = tuple(links_now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            return links_now.select("a", F.col("b").alias("root"))
        before = now


def near_duplicates(docs: DataFrame, words: int = 4, radius: int = 4) -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id that links lead to) of every row.

    Missing and empty texts and texts without words have fingerprint 0, which links like any other. Equal texts share
    their fingerprint and so their component without any link. Rows without doc_id get a component like
    others; a component of such rows only has no id. Repeated rows come back as often as they came.
    """
    marked = stage(fingerprints(docs, words), "fingerprints")
    values = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "values")
    root = components(close_links(values.select("fp"), radius))
    rooted = values.join(root, F.col("fp") == F.col("a"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    # One row for each distinct fingerprint.
    named = rooted.join(ids, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, words: int = 4, radius: int = 4) -> DataFrame:
    """The rows that stay: of each component those with its smallest doc_id. Rows without doc_id stay too.

    An empty table stays empty. Other columns may have any names.
    """
    gone = (
        near_duplicates(docs, words, radius)
        .where("doc_id <> component_id")
        .select(F.col("doc_id").alias("_gone_id"))
        .distinct()
    )
    return docs.join(gone, docs["doc_id"].cast("long") == gone["_gone_id"], "left_anti")
