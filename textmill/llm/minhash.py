"""Near-duplicates by b-bit MinHash.

1. One pass over the texts hashes the distinct shingles (three words by default) of each document and keeps its set size, a
   128-bit hash of the set, 32 band keys of six minima each, and the two low bits of all 192 minima in two bit planes.
   Documents with equal sets form a class, which its smallest id represents from here on.
2. Band keys with several classes are candidate buckets. Every class of a bucket is paired with the bucket's smallest
   id, so a bucket of n gives n - 1 pairs. Equal bits agree by chance with probability 1/4, for which the estimated
   similarity is corrected; pairs that are nowhere near similar go, the others join their classes to clusters.
3. Within a cluster every pair is tested on its full shingle sets. The texts of a cluster meet in blocks of bounded size
   (each pair of blocks of a large cluster is a group of its own), shared shingles are counted as a product of 0-1
   matrices, and a group returns a spanning forest of its links, fewer rows than it has members. Links give components.

A pair at the threshold shares no bucket with probability (1 - 0.85^6)^32 < 3e-7, at 80 percent < 6e-5. Tables between steps are written to
the shared folder; only ids, keys and bits are shuffled for all documents, texts for members of clusters alone.

Edge cases: a text with fewer words than a shingle is one shingle; a null or blank text has none and is linked with nothing;
a null id gets a null component and is kept; rows that share an id are one document; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.llm import arrow_text as at
from textmill.llm.common import pick
from textmill.llm.components import connected
from textmill.storage import stage_table

SHINGLE = 3
PERCENT = 85
BANDS, ROWS = 32, 6
HASHES = BANDS * ROWS
LOW_BITS = 2
NEAR = 0.5  # estimated similarity that joins two classes of a bucket to a cluster
BLOCK_MEMBERS, BLOCK_SHINGLES = 600, 400_000  # of a block, on average at most
BROADCAST_ROWS = 1_000_000
SKETCH = "id long, size int, key1 long, key2 long, planes array<long>, bands array<long>"

_FACTORS = (at.numbers(HASHES, 101) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_TERMS = (at.numbers(HASHES, 103) >> np.uint64(32)).astype(np.uint32)
_BAND_FACTORS = at.numbers(ROWS, 107)


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all rows, one after the other, and the offsets of the rows."""
    words = at.words(column, at.NOT_BLANK)
    counts, h = words.counts(), words.hashes
    factors = at.numbers(size, 13 + size)
    ends, place = words.row_ends(), np.arange(len(h))
    whole = place + size <= ends
    short = np.repeat((counts < size) & (counts > 0), counts) & (place == np.repeat(words.first[:-1], counts))
    shingles = np.zeros(len(h), np.uint64)
    for k in range(size):
        inside = place + k < ends
        part = np.zeros(len(h), np.uint64)
        part[inside] = h[np.minimum(place + k, len(h) - 1)][inside] * factors[k]
        shingles += part
    shingles += np.where(short, np.repeat(counts, counts), size).astype(np.uint64)
    used = whole | short
    row = np.repeat(np.arange(len(counts)), counts)[used]
    shingles = at.mix64(shingles[used])
    bounds = np.searchsorted(row, np.arange(len(counts) + 1))
    for a, b in zip(bounds[:-1], bounds[1:]):
        shingles[a:b].sort()
    fresh = np.ones(len(shingles), bool)
    fresh[1:] = (shingles[1:] != shingles[:-1]) | (row[1:] != row[:-1])
    return shingles[fresh], np.searchsorted(row[fresh], np.arange(len(counts) + 1))


def sliced_sets(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """:func:`shingle_sets` of many texts, slice by slice: arrays of their bytes don't grow with the number of texts."""
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    parts = [shingle_sets(part.column("text"), size) for part in at.slices([batch], "text")]
    sizes = np.concatenate([np.zeros(1, np.int64), *(np.diff(offsets) for _, offsets in parts)])
    return np.concatenate([np.zeros(0, np.uint64), *(sets for sets, _ in parts)]), np.cumsum(sizes)


def _signatures(sets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Minima of all hash functions for the rows that begin at ``starts``."""
    high = (sets >> np.uint64(32)).astype(np.uint32)
    minima = np.empty((HASHES, len(starts)), np.uint32)
    for k in range(HASHES):
        minima[k] = np.minimum.reduceat(high * _FACTORS[k] + _TERMS[k], starts)
    return minima


def sketch_batches(batches: Iterable[pa.RecordBatch], shingle: int = SHINGLE) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [
            ("id", pa.int64()),
            ("size", pa.int32()),
            ("key1", pa.int64()),
            ("key2", pa.int64()),
            ("planes", pa.list_(pa.int64())),
            ("bands", pa.list_(pa.int64())),
        ]
    )
    for batch in at.slices(batches, "text"):
        sets, offsets = shingle_sets(batch.column("text"), shingle)
        sizes = np.diff(offsets)
        filled = np.flatnonzero(sizes)
        n, n_filled = len(sizes), len(filled)
        keys = np.zeros((2, n), np.uint64)
        planes = np.zeros((n, LOW_BITS * HASHES // 64), np.int64)
        bands = np.zeros((n, BANDS), np.uint64)
        if n_filled:
            starts = offsets[:-1][filled]
            for k in range(2):
                keys[k, filled] = np.add.reduceat(at.mix64(sets * at.numbers(2, 109)[k]), starts)
            minima = _signatures(sets, starts)
            low = (minima * np.uint32(0x9E3779B1)) >> np.uint32(32 - LOW_BITS)  # mixed, then the low bits
            bits = np.concatenate([(low >> np.uint32(k)) & np.uint32(1) for k in range(LOW_BITS)]).T
            planes[filled] = np.ascontiguousarray(np.packbits(bits.astype(np.uint8), axis=1)).view(np.int64)
            grouped = minima.reshape(BANDS, ROWS, n_filled).astype(np.uint64)
            band = (grouped * _BAND_FACTORS[None, :, None]).sum(axis=1, dtype=np.uint64)
            bands[filled] = at.mix64(band + at.numbers(BANDS, 113)[:, None]).T
        band_sizes = np.where(sizes > 0, BANDS, 0)
        plane_sizes = np.where(sizes > 0, planes.shape[1], 0)
        as_list = lambda values, each: pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(each)]), pa.int32()), pa.array(values[sizes > 0].ravel())
        )
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                pa.array(sizes, pa.int32()),
                pa.array(keys[0].view(np.int64)),
                pa.array(keys[1].view(np.int64)),
                as_list(planes, plane_sizes),
                as_list(bands.view(np.int64), band_sizes),
            ],
            schema=schema,
        )


def estimate(a: Column, b: Column) -> Column:
    """Similarity from the packed low bits, corrected for bits that agree by chance."""
    half = HASHES // 64
    differ = [
        F.bit_count(
            F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i))).bitwiseOR(
                F.get(a, F.lit(half + i)).bitwiseXOR(F.get(b, F.lit(half + i)))
            )
        )
        for i in range(half)
    ]
    equal = 1.0 - sum(differ, F.lit(0)) / F.lit(float(HASHES))
    chance = 2.0**-LOW_BITS
    return (equal - chance) / (1.0 - chance)


def common_counts(sets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of shingles that each two rows share."""
    n = len(offsets) - 1
    row = np.repeat(np.arange(n), np.diff(offsets))
    _, column, times = np.unique(sets, return_inverse=True, return_counts=True)
    shared = times[column] > 1
    row, column = row[shared], (np.cumsum(times > 1) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common, width = np.zeros((n, n), np.float32), 2048
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        part = slice(*np.searchsorted(column, [low, low + width]))
        block = np.zeros((n, width), np.float32)
        block[row[part], column[part] - low] = 1
        common += block @ block.T
    return common


def forest(ids: np.ndarray, texts: pa.Array, percent: int, shingle: int = SHINGLE) -> list[tuple[int, int]]:
    """Links between some rows, enough to connect all that similar rows connect."""
    sets, offsets = sliced_sets(texts, shingle)
    sizes = np.diff(offsets)
    common = common_counts(sets, offsets)
    links, seen = [], np.zeros(len(ids), bool)
    for start in range(len(ids)):
        queue = [] if seen[start] else [start]
        seen[start] = True
        while queue:
            k = queue.pop()
            similar = (common[k] > 0) & (100 * common[k].astype(np.float64) >= percent * (sizes[k] + sizes - common[k]))
            fresh = np.flatnonzero(similar & ~seen)
            seen[fresh] = True
            queue += fresh.tolist()
            links += [(int(ids[k]), int(ids[j])) for j in fresh]
    return links


def _link_batches(batches: Iterable[pa.RecordBatch], percent: int, shingle: int) -> Iterator[pa.RecordBatch]:
    """Links of each group; the rows of a group (cluster, i, j) follow each other, maybe over several batches."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    open_key: tuple | None = None
    parts: list[pa.RecordBatch] = []

    def close() -> pa.RecordBatch:
        group = pa.Table.from_batches(parts).combine_chunks()
        links = forest(group["id"].to_numpy(), group["text"].combine_chunks(), percent, shingle)
        return pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in links], schema=schema)

    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("cluster", "i", "j")], axis=1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
            if low == high:
                continue
            key = tuple(keys[low].tolist())
            if key != open_key and parts:
                yield close()
                parts.clear()
            open_key = key
            parts.append(batch.slice(low, high - low))
    if parts:
        yield close()


def links_in_clusters(
    clusters: DataFrame, nodes: DataFrame, texts: DataFrame, percent: int, shingle: int = SHINGLE
) -> DataFrame:
    """Links (a, b) that connect what is similar within each cluster; ``clusters`` has the columns node, component."""
    sized = clusters.join(nodes.select(F.col("id").alias("node"), "size"), "node")
    blocks = sized.groupBy("component").agg(
        F.greatest(
            F.ceil(F.sum("size") / BLOCK_SHINGLES), F.ceil(F.count(F.lit(1)) / BLOCK_MEMBERS)
        ).cast("int").alias("blocks")
    )
    placed = clusters.join(blocks, "component").select(
        F.col("node").alias("id"),
        F.col("component").alias("cluster"),
        F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("block"),
        "blocks",
    )
    placed = stage_table(placed, "clusters")
    if placed.count() <= BROADCAST_ROWS:  # 24 bytes each; beyond that the texts are shuffled to them
        placed = F.broadcast(placed)
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    rows = texts.join(placed, "id").select("cluster", "block", others, "id", "text")
    rows = rows.select("cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "id", "text")
    grouped = rows.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
    return stage_table(grouped.mapInArrow(lambda b: _link_batches(b, percent, shingle), "a long, b long"), "links")


def keep_first(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, shingle: int = SHINGLE
) -> DataFrame:
    """The rows of ``docs`` without those of a group but its smallest id; one row is kept of those that share an id."""
    found = near_duplicates(docs, id_col, text_col, percent, shingle).filter(F.col("id") == F.col("component"))
    first = found.select(F.col("id").alias("_first")).distinct()
    named = F.col(f"`{id_col}`")
    kept = docs.join(first, named == F.col("_first")).dropDuplicates(["_first"]).select(*docs.columns)
    return kept.unionByName(docs.filter(named.isNull()))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, shingle: int = SHINGLE
) -> DataFrame:
    """One row per row of ``docs``: id, size (of its shingle set), component (smallest id reachable)."""
    texts = pick(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))
    sketches = stage_table(texts.mapInArrow(lambda b: sketch_batches(b, shingle), SKETCH), "sketches")
    real = sketches.filter((F.col("size") > 0) & F.col("id").isNotNull())
    keys = ["key1", "key2", "size"]
    classes = stage_table(
        real.groupBy(*keys).agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("members")), "classes"
    )
    nodes = stage_table(real.join(classes.select("id", *keys), ["id", *keys], "left_semi"), "nodes")

    rows = nodes.select("id", F.explode("bands").alias("key"))
    buckets = rows.groupBy("key").agg(F.min("id").alias("lead"), F.max("id").alias("last")).filter("lead <> last")
    bits = nodes.select("id", "planes")
    near = (
        rows.join(buckets.select("key", "lead"), "key")
        .filter("id <> lead")
        .select(F.col("id").alias("a"), F.col("lead").alias("b"))
        .distinct()
        .join(bits.select(F.col("id").alias("a"), F.col("planes").alias("planes_a")), "a")
        .join(bits.select(F.col("id").alias("b"), F.col("planes").alias("planes_b")), "b")
        .filter(estimate(F.col("planes_a"), F.col("planes_b")) >= NEAR)
        .select("a", "b")
    )
    clusters = stage_table(connected(near), "near")
    links = links_in_clusters(clusters, nodes, texts.filter(F.col("id").isNotNull()), percent, shingle)
    more = stage_table(connected(links), "components")

    named = classes.join(more.withColumnRenamed("node", "id"), "id", "left")
    special = named.filter((F.col("members") > 1) | F.col("component").isNotNull()).select(
        *keys, F.coalesce("component", "id").alias("component")
    )
    return (
        sketches.select("id", *keys)
        .join(special, keys, "left")
        .select("id", "size", F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component"))
    )
