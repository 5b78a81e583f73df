"""Near copies: SimHash fingerprints and BK-trees in shards, each link checked exactly by the share of common shingles.

Two texts are near copies if the Jaccard similarity of their sets of shingles is at least a bound, 0.8 of 5 words for the
pipeline. The fingerprint of a text is the majority of its shingles' hashes, as in ``simhash``. A pair at the bound differs in at most a
fifth of the sums' signs or so, in 10 of 64 bits on average and in more than 24 about once in 10,000 pairs, so trees are searched with that radius. Blocks of
bits as in ``simhash`` would need 25 blocks of 2 or 3 bits, shards that grow with the square of the corpus. Distinct texts are
therefore dealt into shards by bands of least hashes, 16 of 4 each, which a pair at 0.8 shares with a chance of 0.9998.

A shard is a BK-tree whose root is its first text. The edges of the root are made by a join, as they settle most copies: what lies within the radius is
checked and linked. Where a shard's other texts still lie in different components, they are brought together, large shards in parts, and each
part builds the tree of its texts and searches it for those that ask. What the tree finds is checked by the sets, over an index from shingle
to texts. Pairs are never listed: what leaves a part are the links that join components, fewer than it has texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callmart.llm.common import batches_of, texts
from callmart.llm.simhash import BKTree, components, majority
from callmart.session import stage

WORDS = 5
SIMILARITY = 0.8
#: Bands, and least hashes in each.
BANDS, DEEP = 16, 4
#: Bits in which the fingerprints of near copies differ at most.
RADIUS = 24
#: Shingles and texts that a part of a shard holds, on average.
PART_SHINGLES, PART_TEXTS = 2_000_000, 8_192

_rnd = np.random.default_rng(42)
_FACTORS = _rnd.integers(0, 2**63, BANDS * DEEP, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rnd.integers(0, 2**63, BANDS * DEEP, dtype=np.uint64)


def shingles(text: bytes, words: int) -> np.ndarray:
    """The distinct hashes of the text's runs of ``words`` words, in order; a shorter text is one run."""
    found = text.lower().split()
    runs = {b" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))} if found else ()
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, runs), np.uint64, len(runs)))


def bands(hashes: np.ndarray) -> list[int]:
    """A number for each band, which texts of the same least hashes share."""
    least = np.full(BANDS * DEEP, np.iinfo(np.uint64).max)
    for i in range(0, len(hashes), 512):
        turned = hashes[i : i + 512, None] * _FACTORS + _SHIFTS
        # High bits of a product are the mixed ones; the fold mixes the others.
        least = np.minimum(least, (turned ^ (turned >> np.uint64(32))).min(axis=0) if len(turned) else least)
    whole = least.reshape(BANDS, DEEP)
    return [xxhash.xxh64_intdigest(row.tobytes(), seed) - 2**63 for seed, row in enumerate(whole)]


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and a key that equal texts share."""
    return texts(docs).withColumn("key", F.unhex(F.sha2("text", 256)))


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, key, number of shingles, fingerprint and bands of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            found = [shingles(t.as_py(), words) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([len(h) for h in found], pa.int64()),
                    pa.array(np.array([majority(h) for h in found], np.uint64).view(np.int64)),
                    pa.array([bands(h) for h in found], pa.list_(pa.int64())),
                ],
                ["doc_id", "key", "size", "fp", "bands"],
            )

    return _keyed(docs).mapInArrow(run, "doc_id long, key binary, size long, fp long, bands array<long>")


def shingle_sets(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """node and its distinct shingles, for the ``nodes`` (key, node) given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches_of(batches):
            rows = []
            for row, node in enumerate(batch.column(1).to_pylist()):
                if node not in seen:
                    seen.add(node)
                    rows.append(row)
            sets = [shingles(batch.column(0)[r].as_py(), words).view(np.int64) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).take(pa.array(rows, pa.int64())), pa.array(sets, pa.list_(pa.int64()))], ["node", "runs"]
            )

    found = _keyed(docs).join(nodes, "key").select("text", "node").mapInArrow(run, "node long, runs array<long>")
    return found.groupBy("node").agg(F.first("runs").alias("runs"))


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The ``pairs`` (a, b) whose sets are similar enough; two empty sets are equal."""
    left = sets.select(F.col("node").alias("a"), F.col("runs").alias("of_a"))
    right = sets.select(F.col("node").alias("b"), F.col("runs").alias("of_b"))
    common = F.size(F.array_intersect("of_a", "of_b"))
    whole = F.size("of_a") + F.size("of_b") - common
    return pairs.join(left, "a").join(right, "b").where(common >= F.lit(similarity) * whole).select("a", "b")


def _joining(similarity: float, radius: int):
    """For rows sorted by shard and part, links between texts of different components; they join all that are near."""

    def linked(parts: list[pa.RecordBatch]) -> list[tuple[int, int]]:
        columns = [[x for p in parts for x in p.column(i).to_pylist()] for i in range(2, 6)]
        nodes, roots, asks, finds = columns
        asking, there = np.flatnonzero(asks), np.flatnonzero(finds)
        if not there.size or not asking.size:
            return []
        prints = np.concatenate([p.column(6).to_numpy() for p in parts]).view(np.uint64)
        sets = [runs.values.to_numpy() for p in parts for runs in p.column(7)]
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        # Which of the asking texts have a shingle.
        owner = np.repeat(np.arange(len(asking)), sizes[asking])
        flat = np.concatenate([sets[i] for i in asking])
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]

        # Components as numbers, which joins make equal.
        number: dict[int, int] = {}
        label = np.fromiter((number.setdefault(r, len(number)) for r in roots), np.int64, len(roots))
        values, place = np.unique(prints[there], return_inverse=True)
        holders = np.split(there[np.argsort(place, kind="stable")], np.cumsum(np.bincount(place))[:-1])
        out = []
        for pivot, found in BKTree(values).search(prints[asking], radius):
            for i in holders[pivot].tolist():
                if (label[asking[found]] == label[i]).all():
                    continue
                low, high = np.searchsorted(flat, sets[i]), np.searchsorted(flat, sets[i], "right")
                counts = high - low
                at = np.repeat(low - np.r_[0, np.cumsum(counts)[:-1]], counts) + np.arange(counts.sum())
                common = np.bincount(owner[at], minlength=len(asking))[found]
                met = asking[found]
                near = met[(common > 0) & (common >= similarity * (sizes[met] + sizes[i] - common))]
                for j in near[label[near] != label[i]].tolist():
                    if label[j] != label[i]:
                        out.append((nodes[i], nodes[j]))
                        label[label == label[j]] = label[i]
        return out

    def answered(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = linked(parts)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, parts = None, []
        for batch in batches_of(batches):
            shards, numbers = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.r_[0, np.flatnonzero((np.diff(shards) != 0) | (np.diff(numbers) != 0)) + 1, len(shards)]
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                here = (shards[a], numbers[a])
                if parts and here != last:
                    yield from answered(parts)
                    parts = []
                last = here
                parts.append(batch.slice(a, b - a))
        if parts:
            yield from answered(parts)

    return run


def open_shards(dealt: DataFrame) -> DataFrame:
    """Rows (shard, node, size, fp, root) of the shards whose texts, the first one aside, lie in several components.

    The first text of a shard has been compared with all others. Of shards with the very same texts one is enough.
    """
    others = dealt.where("node <> head")
    mixed = (
        others.groupBy("shard")
        .agg(
            F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("texts"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("more"),
        )
        .where("low <> high")
        .groupBy("n", "texts", "more")
        .agg(F.min("shard").alias("shard"))
    )
    return others.join(mixed.select("shard"), "shard", "left_semi").select("shard", "node", "size", "fp", "root")


def parts_of(rows: DataFrame, part_shingles: int = PART_SHINGLES, part_texts: int = PART_TEXTS) -> DataFrame:
    """(shard, part, node, root, ask, find, fp): rows of open shards dealt into parts of bounded size.

    Every text is found in its own part. Texts outside a shard's largest component ask in all parts; within that component nothing
    needs to be asked.
    """
    held = rows.groupBy("shard", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("shingles"))
    whole = held.groupBy("shard").agg(
        F.max(F.struct("n", "root"))["root"].alias("largest"),
        F.ceil(F.greatest(F.sum("shingles") / part_shingles, F.sum("n") / part_texts)).cast("int").alias("parts"),
    )
    dealt = rows.join(whole, "shard").withColumn("own", F.pmod(F.xxhash64("node"), F.greatest("parts", F.lit(1))).cast("int"))
    ask = F.col("root") != F.col("largest")
    everywhere = F.sequence(F.lit(0), F.greatest("parts", F.lit(1)) - 1)
    dealt = dealt.select("shard", "node", "root", "fp", ask.alias("ask"), "own", F.explode(F.when(ask, everywhere).otherwise(F.array("own"))).alias("part"))
    return dealt.select("shard", "part", "node", "root", "ask", (F.col("part") == F.col("own")).alias("find"), "fp")


def near_copies(
    docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, part_shingles: int = PART_SHINGLES, radius: int = RADIUS,
    part_texts: int = PART_TEXTS,
) -> DataFrame:
    """doc_id and component_id (the smallest doc_id that links lead to) of every row.

    Texts are linked if their fingerprints differ in at most ``radius`` bits and the Jaccard similarity of their sets of shingles is at least ``similarity``. Missing and empty
    texts and texts without words are equal to each other. Rows without doc_id link like others; a component of
    such rows only has no id. Repeated rows come back as often as they came. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    marked = stage(sketches(docs, words), "sketches")
    distinct = marked.groupBy("key").agg(F.min("doc_id").alias("first"), *[F.first(c).alias(c) for c in ("size", "fp", "bands")])
    nodes = stage(distinct.withColumn("node", F.monotonically_increasing_id()), "texts")
    dealt = nodes.select(F.explode("bands").alias("shard"), "node", "size", "fp")
    heads = dealt.groupBy("shard").agg(F.min(F.struct("node", "size", "fp")).alias("head"), F.count(F.lit(1)).alias("n"))
    heads = heads.where("n > 1").select("shard", F.col("head.node").alias("head"), F.col("head.size").alias("head_size"), F.col("head.fp").alias("head_fp"))
    # Only texts that share a band with another.
    dealt = stage(dealt.join(heads, "shard"), "shards")
    wanted = nodes.join(dealt.select("node").distinct(), "node", "left_semi").select("key", "node")
    sets = stage(shingle_sets(docs, wanted, words), "shingles")
    alike = F.least("size", "head_size") >= F.lit(similarity) * F.greatest("size", "head_size")
    # The edges of the roots that lie within the radius.
    alike &= F.bit_count(F.col("fp").bitwiseXOR(F.col("head_fp"))) <= radius
    stars = dealt.where(alike & (F.col("node") != F.col("head"))).select(F.col("head").alias("a"), F.col("node").alias("b"))

    def rooted(rows: DataFrame, root: DataFrame, node: str, name: str) -> DataFrame:
        named = root.select(F.col("a").alias("_node"), F.col("root").alias("_root"))
        found = rows.join(named, F.col(node) == F.col("_node"), "left")
        return found.withColumn(name, F.coalesce("_root", node)).drop("_node", "_root")

    links = stage(confirmed(stars.groupBy("b").agg(F.min("a").alias("a")), sets, similarity), "near")
    root = components(links)
    apart = rooted(rooted(stars.distinct(), root, "a", "root_a"), root, "b", "root_b").where("root_a <> root_b").select("a", "b")
    links = links.unionByName(stage(confirmed(apart, sets, similarity), "near"))
    root = components(links)

    left = stage(open_shards(rooted(dealt.select("shard", "node", "size", "fp", "head"), root, "node", "root")), "open")
    gathered = parts_of(left, part_shingles, part_texts).join(sets, "node").select("shard", "part", "node", "root", "ask", "find", "fp", "runs")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    close = gathered.repartition(parts, "shard", "part").sortWithinPartitions("shard", "part").mapInArrow(_joining(similarity, radius), "a long, b long")
    links = links.unionByName(stage(close, "near"))
    root = components(links)

    grouped = rooted(nodes.select("key", "first", "node"), root, "node", "root")
    ids = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    return marked.select("doc_id", "key").join(grouped.join(ids, "root").select("key", "component_id"), "key").select("doc_id", "component_id")


def keep_first(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """The rows that stay: of each component those with its smallest doc_id. Rows without doc_id stay too.

    An empty table stays empty. Other columns may have any names.
    """
    found = near_copies(docs, words, similarity)
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone_id")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["_gone_id"], "left_anti")
