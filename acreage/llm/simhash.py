"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints differ in ``radius`` bits or fewer exactly if some variant
lies within half the radius of both. So each distinct fingerprint emits all its variants
within that half, and those that share a variant are linked. Whatever shares
one variant is within the radius of all the others there, so each links to the least
of them: that connects all, and no group's pairs are listed. The links are
deduplicated and verified by counting bits before classes are formed.

Variants are shuffled by the parities of ``groups`` groups of their bits. A flipped
bit changes one parity, so a fingerprint's variants lie in few of these buckets:
only the fingerprint and the bucket are sent, and the bucket's task makes
its variants there. Near copies, which differ in some bits anywhere, fall into different buckets.
The number of groups grows with the number of fingerprints, so that a bucket
has about as many variants at any size.

Defined results: a null, empty or blank text has fingerprint zero and is linked like
any other; fewer words than a shingle has are one shingle; repeated rows and
shingles count as often as they occur; rows without doc_id are linked as others are, and a class
without any doc_id has a null component_id; texts of any length are taken
whole; doc_ids of any type; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acreage.llm.components import components
from acreage.llm.scratch import written
from acreage.llm.words import slices

SHINGLE = 4
RADIUS = 4
BITS = 64
SEED = 42
#: Variants that a bucket holds on average at most, and that a task handles at once.
BUCKET_VARIANTS = 1 << 21
_HASHES = 1 << 16
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _ones(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit."""
    return np.array([int(((hashes >> np.uint64(k)) & np.uint64(1)).sum()) for k in range(BITS)], np.int64)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint of a UTF-8 text, unsigned."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    lengths = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(lengths + 1) - 1
    begins, size = ends - lengths, min(shingle, len(words))
    begins, ends, joined = begins[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), b" ".join(words)
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for k in range(0, len(begins), _HASHES):
        ones += _ones(np.array([digest(joined[a:b], SEED) for a, b in zip(begins[k : k + _HASHES], ends[k : k + _HASHES], strict=True)], np.uint64))
    return sum(1 << k for k in np.flatnonzero(2 * ones > len(begins)).tolist())


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, print): the fingerprint as a signed long."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            prints = np.array([fingerprint(t or b"", shingle) for t in piece.column("text").cast(pa.binary()).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(prints.view(np.int64))], names=["doc_id", "print"])

    return docs.select("doc_id", "text").mapInArrow(go, f"doc_id {kind}, print long")


def _groups_of_bits(groups: int) -> list[np.ndarray]:
    """A mask for each bit of each group."""
    return [np.uint64(1) << part.astype(np.uint64) for part in np.array_split(np.arange(BITS), groups)]


def _parities(prints: np.ndarray, groups: int) -> np.ndarray:
    out = np.zeros(len(prints), np.int64)
    for k, bits in enumerate(_groups_of_bits(groups)):
        out |= (np.bitwise_count(prints & np.bitwise_or.reduce(bits)).astype(np.int64) & 1) << k
    return out


def _flips(groups: int, reach: int) -> dict[int, np.ndarray]:
    """For each change of parities that flipping up to ``reach`` bits can make, the masks of those flips."""
    found: dict[int, list[int]] = {}
    of = [(k, int(b)) for k, bits in enumerate(_groups_of_bits(groups)) for b in bits]
    for n in range(reach + 1):
        for chosen in combinations(of, n):
            change = mask = 0
            for k, bit in chosen:
                change, mask = change ^ (1 << k), mask ^ bit
            found.setdefault(change, []).append(mask)
    return {change: np.array(masks, np.uint64) for change, masks in found.items()}


def _met(bucket: np.ndarray, prints: np.ndarray, groups: int, flips: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(print, least print of a variant that both have) of whole buckets' fingerprints, each pair once."""
    change = bucket ^ _parities(prints, groups)
    order = np.argsort(change, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], np.diff(change[order]) != 0, [True]]))
    variants, owners = [], []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        masks = flips[int(change[order[a]])]
        variants.append((prints[order[a:b], None] ^ masks).ravel())
        owners.append(np.repeat(prints[order[a:b]], len(masks)))
    variant, owner = np.concatenate(variants), np.concatenate(owners)
    del variants, owners
    order = np.argsort(variant)
    variant, owner = variant[order], owner[order]
    same = variant[1:] == variant[:-1]
    shared = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    variant, owner = variant[shared], owner[shared]
    if not len(variant):
        return variant, owner
    first = np.flatnonzero(np.concatenate([[True], variant[1:] != variant[:-1]]))
    least = np.repeat(np.minimum.reduceat(owner, first), np.diff(np.concatenate([first, [len(owner)]])))
    owner, least = owner[owner != least], least[owner != least]
    order = np.lexsort((least, owner))
    owner, least = owner[order], least[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (least[1:] != least[:-1])
    return owner[new], least[new]


def similar_prints(prints: DataFrame, radius: int = RADIUS, groups: int | None = None) -> DataFrame:
    """(a, b): links of distinct fingerprints ``print`` that connect all those within an even ``radius``; each link is within it."""
    if radius % 2:
        raise ValueError("radius must be even: half of it is each variant's distance")
    reach = radius // 2
    each = sum(math.comb(BITS, n) for n in range(reach + 1))
    if groups is None:
        groups = min(BITS, max(12, math.ceil(math.log2(max(1, prints.count() * each / BUCKET_VARIANTS)))))
    flips = _flips(groups, reach)
    changes = np.array(list(flips), np.int64)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signed = batch.column(0).to_numpy()
            bucket = (_parities(signed.view(np.uint64), groups)[:, None] ^ changes).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(np.repeat(signed, len(changes)))], names=["bucket", "print"])

    def collided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        rows, most = 0, max(1, BUCKET_VARIANTS * len(changes) // each)

        def found(bucket: np.ndarray, print_: np.ndarray) -> pa.RecordBatch:
            a, b = _met(bucket, print_.view(np.uint64), groups, flips)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            rows += batch.num_rows
            if rows >= most:
                bucket, print_ = (np.concatenate(x) for x in zip(*held, strict=True))
                whole = int(np.searchsorted(bucket, bucket[-1]))  # the last bucket may go on
                if whole:
                    yield found(bucket[:whole], print_[:whole])
                held, rows = [(bucket[whole:], print_[whole:])], len(bucket) - whole
        if rows:
            yield found(*(np.concatenate(x) for x in zip(*held, strict=True)))

    buckets = prints.mapInArrow(dealt, "bucket long, print long").repartition("bucket").sortWithinPartitions("bucket")
    links = buckets.mapInArrow(collided, "a long, b long").distinct()
    return links.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs``."""
    prints = written(fingerprints(docs, shingle), "simhash-prints")
    nodes = written(prints.groupBy("print").agg(F.min("doc_id").alias("rep")), "simhash-nodes")
    roots = components(written(similar_prints(nodes.select("print"), radius), "simhash-links"))
    rooted = nodes.join(roots, nodes["print"] == roots["node"], "left").select("print", "rep", F.coalesce("root", "print").alias("root"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = written(rooted.join(least, "root").select("print", "component_id"), "simhash-named")  # so that rows of a hot print can be split in the join
    return prints.join(named, "print").select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
