"""Near-duplicate vectors: binary codes by iterative quantisation, multi-index Hamming tables, exact cosines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import settle
from .common import mix64
from .components import connected
from .topk import usable

# Rows that rotations are learned from, at most; all rows are indexed.
SAMPLE_ROWS = 20_000
# Codes with rotations of their own; each is cut into table keys of this many bits.
CODES = 3
CODE_BITS = 64
KEY_BITS = 16
ITERATIONS = 40
# Rows of a bucket that are compared in one task; larger buckets are tiled.
BUCKET_ROWS = 2048


def learn(sample: np.ndarray, codes: int = CODES, bits: int = CODE_BITS, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection (dims x codes*bits) of unit vectors by ITQ (Gong and Lazebnik 2011).

    Principal directions, then for each code a rotation that starts at random and alternates between
    the signs of the rotated data and the rotation nearest to them.
    """
    rng = np.random.default_rng(seed)
    dims = sample.shape[1]
    bits = min(bits, dims)
    mean = sample.mean(0) if len(sample) else np.zeros(dims)
    centred = sample - mean
    _, vectors = np.linalg.eigh(centred.T @ centred + 1e-9 * np.eye(dims))
    principal = vectors[:, ::-1][:, :bits]
    data = centred @ principal
    out = []
    for _ in range(codes):
        rotation, _ = np.linalg.qr(rng.normal(size=(bits, bits)))
        for _ in range(ITERATIONS if len(sample) > bits else 0):
            u, _, v = np.linalg.svd(np.where(data @ rotation >= 0, 1.0, -1.0).T @ data)
            rotation = (u @ v).T
        out.append(principal @ rotation)
    return mean, np.concatenate(out, 1)


def table_keys(units: np.ndarray, mean: np.ndarray, projection: np.ndarray, key_bits: int = KEY_BITS) -> np.ndarray:
    """Keys of each row in every Hamming table: substrings of the codes."""
    bits = ((units - mean) @ projection >= 0).astype(np.int64)
    edges = range(0, bits.shape[1], key_bits)
    return np.stack([bits[:, e:e + key_bits] @ (1 << np.arange(bits[:, e:e + key_bits].shape[1])) for e in edges], 1)


def units_of(lists: pa.Array) -> np.ndarray:
    """Rows of a list column of one length, scaled to length 1 in double precision."""
    rows = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(lists), -1)
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def spanning(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest position reachable from each of ``n`` positions over links (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def links(vectors: DataFrame, threshold: float = 0.98, id_column: str = "vec_id", vector_column: str = "embedding",
          label_column: str = "label") -> DataFrame:
    """Links between vectors of equal label with a cosine of at least ``threshold``.

    Returns per input row ``vec_id, n_links, component_id, kept``. Rows that have a null label or id, or
    a vector that is null, empty or zero or holds null or non-finite components link with nothing.
    Vectors of different length do not link. Repeated rows are vectors of their own. Link counts and
    components are found as follows:

    1. Equal vectors of a label are one representative with a weight, so copies cost nothing more.
    2. Each representative goes to one bucket per Hamming table. A pair is a candidate if it shares a
       key of any table; every candidate is compared by its cosine, so no false link remains.
    3. Buckets above ``BUCKET_ROWS`` are dealt into chunks, and every pair of chunks is a tile of its own.
    4. A tile returns link counts per row and a spanning set of links, never pairs. A pair is counted in
       the first table in which it meets.
    """
    source = vectors.select(F.col(f"`{id_column}`").alias("vec_id"), F.col(f"`{vector_column}`").alias("vector"),
                            F.col(f"`{label_column}`").cast("string").alias("label"))
    able = usable(F.col("vector")) & F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.exists(
        F.coalesce("vector", F.array()), lambda x: x != 0)
    # Zeros of either sign are one value, as they are for the cosine.
    plain = F.transform("vector", lambda x: x + F.lit(0.0).cast(dict(vectors.dtypes)[vector_column][6:-1]))
    rows = settle(source.withColumn("able", F.coalesce(able, F.lit(False))).select(
        F.monotonically_increasing_id().alias("row_id"), "vec_id", "able", F.when(F.col("able"), F.col("label")).alias("label"),
        F.when(F.col("able"), plain).alias("vector")), "vectors")
    same = F.xxhash64("label", "vector").alias("h")
    groups = settle(rows.filter("able").groupBy(same, "label", "vector").agg(
        F.min("row_id").alias("rep"), F.min("vec_id").alias("low"), F.count("*").alias("copies")), "representatives")

    models = {}
    sample = groups.orderBy("h", "rep").limit(SAMPLE_ROWS).select("vector").toArrow().column("vector").combine_chunks()
    for dim in sorted({len(x) for x in sample}):
        models[dim] = learn(units_of(pa.array([x.as_py() for x in sample if len(x) == dim])))
    shared = groups.sparkSession.sparkContext.broadcast(models)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = dict(shared.value)
        for batch in batches:
            lists = batch.column("vector")
            dims = np.diff(lists.offsets.to_numpy())
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                if dim not in known:  # a length that the sample lacks gets rotations drawn at random
                    known[dim] = learn(np.zeros((0, dim)))
                units = units_of(part.column("vector"))
                keys = table_keys(units, *known[dim])
                base = mix64(part.column("label_hash").to_numpy().view(np.uint64) + np.uint64(dim))
                for t in range(keys.shape[1]):
                    bucket = mix64(base ^ ((np.uint64(t + 1) << np.uint64(48)) + keys[:, t].astype(np.uint64))).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(bucket), pa.array(np.full(len(part), t, np.int64)), part.column("rep"), part.column("copies"),
                         part.column("vector"), pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), keys.shape[1]).cast(pa.list_(pa.int64()))],
                        names=["bucket", "t", "rep", "copies", "vector", "keys"])

    vector_type = dict(groups.dtypes)["vector"]
    placed = groups.select(F.xxhash64("label").alias("label_hash"), "rep", "copies", "vector").mapInArrow(
        place, f"bucket long, t long, rep long, copies long, vector {vector_type}, keys array<long>")
    large = placed.groupBy("bucket").agg(F.count("*").alias("n")).filter(F.col("n") > BUCKET_ROWS).select(
        F.col("bucket").alias("hot"), F.ceil(F.col("n") / BUCKET_ROWS).cast("long").alias("chunks"))
    chunks = F.coalesce("chunks", F.lit(1))
    tiled = placed.join(settle(large, "buckets"), F.col("bucket") == F.col("hot"), "left").withColumn(
        "chunk", F.pmod(F.xxhash64("rep", F.lit(5)), chunks)).withColumn("mate", F.explode(F.sequence(F.lit(0), chunks - 1)))
    tiled = tiled.select("bucket", F.least("chunk", "mate").alias("i"), F.greatest("chunk", "mate").alias("j"), "chunk",
                         "t", "rep", "copies", "vector", "keys")
    found = settle(tiled.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j").mapInArrow(
        lambda batches: compare(batches, threshold), "rep long, n long, root long"), "links")

    counts = found.groupBy("rep").agg(F.sum("n").alias("n")).withColumnRenamed("rep", "of")
    roots = connected(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    classes = groups.select("rep", "low", "copies", "label", "vector").join(
        roots, F.col("rep") == F.col("node"), "left").withColumn("root", F.coalesce("root", "rep"))
    lowest = classes.groupBy("root").agg(F.min("low").alias("component_id")).withColumnRenamed("root", "r")
    settled = classes.join(lowest, F.col("root") == F.col("r")).join(counts, F.col("rep") == F.col("of"), "left").select(
        F.col("label").alias("l"), F.col("vector").alias("v"), "component_id",
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = rows.join(settled, (F.col("label") == F.col("l")) & (F.col("vector") == F.col("v")), "left")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce("component_id", "vec_id").eqNullSafe(F.col("vec_id")).alias("kept"))


def compare(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Compare the rows of each tile; batches come sorted by tile, of which one at a time is unfinished."""
    def key_of(table: pa.Table) -> np.ndarray:
        return np.stack([table.column(c).to_numpy() for c in ("bucket", "i", "j")], 1)

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = key_of(pa.Table.from_batches([batch]))
        last = int(np.flatnonzero((keys != keys[-1]).any(1))[-1]) + 1 if (keys != keys[-1]).any() else 0
        if last or (held and (key_of(pa.Table.from_batches([held[-1].slice(held[-1].num_rows - 1)]))[0] != keys[0]).any()):
            yield from tiles(pa.Table.from_batches([*held, batch.slice(0, last)]), key_of, threshold)
            held = []
        held.append(batch.slice(last))
    if held:
        yield from tiles(pa.Table.from_batches(held), key_of, threshold)


def tiles(table: pa.Table, key_of, threshold: float) -> Iterator[pa.RecordBatch]:
    """Link counts and spanning links ``(rep, n, root)`` of whole tiles."""
    if table.num_rows < 2:
        return
    keys = key_of(table)
    starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1)])
    ends = np.r_[starts[1:], len(keys)]
    lists = table.column("vector").combine_chunks()
    dims = np.diff(lists.offsets.to_numpy())
    reps, copies, chunk, t = (table.column(c).to_numpy() for c in ("rep", "copies", "chunk", "t"))
    tables = table.column("keys").combine_chunks()
    key_sizes = np.diff(tables.offsets.to_numpy())
    counts, roots, nodes = [], [], []
    for a, b in zip(starts, ends):
        if b - a < 2 or not (dims[a:b] == dims[a]).all() or not (key_sizes[a:b] == key_sizes[a]).all():
            continue  # lengths differ only if hashes of buckets collide
        units = units_of(lists.slice(a, b - a))
        close = np.triu(units @ units.T >= threshold, 1)
        if keys[a, 1] != keys[a, 2]:
            close &= chunk[a:b, None] != chunk[None, a:b]
        x, y = np.nonzero(close)
        if not len(x):
            continue
        own = tables.slice(a, b - a).flatten().to_numpy().reshape(b - a, -1)[:, :t[a]]
        first = np.concatenate([~(own[x[k:k + 65536]] == own[y[k:k + 65536]]).any(1) for k in range(0, len(x), 65536)])
        n = np.bincount(x[first], copies[a + y[first]], b - a) + np.bincount(y[first], copies[a + x[first]], b - a)
        label = spanning(x, y, b - a)
        linked = np.unique(np.concatenate([x, y]))
        nodes.append(reps[a:b][linked])
        counts.append(n[linked].astype(np.int64))
        roots.append(reps[a:b][label[linked]])
    if nodes:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (nodes, counts, roots)], names=["rep", "n", "root"])


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.vec) = len(b.vec)
  WHERE list_cosine_similarity(a.vec, b.vec) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
n AS (SELECT a, count(*) AS n FROM link GROUP BY a),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN c ON c.a = e.vec_id
"""
