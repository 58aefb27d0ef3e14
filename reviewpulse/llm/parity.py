"""Near-duplicate texts: Jaccard join of shingle sets by parity sketches.

A parity sketch flips one bit per shingle, so two sketches differ in at most as many bits as their sets
differ in elements. Sets A, B reach similarity 3/4 exactly if 7 |A xor B| <= |A| + |B|. Cutting a sketch
into more segments than that difference leaves equal segments (pigeonhole), which a join finds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import settle
from .common import mix64, releasing, sliced, slices_for, text_chunks, with_unique_names, words
from .components import connected

SHINGLE = 5
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
# Size bands: 1-63 shingles, then factors of four.
FIRST_BAND, BAND_FACTOR = 64, 4
# Shingles per segment at the upper end of a band: 42 % of the size is then filled segments, against a third of
# the size that can differ; with single shingles in the first band hardly any segment has two.
FILL = 2.1
SMALL_SEGMENTS = 1 << 20
# Segment rows a task gathers before it combines and sends them.
HELD_ROWS = 1 << 20
# Text that a task shingles at once.
CHUNK_BYTES = 2 << 20
# Members of a family that one task compares with each other; larger families are tiled.
FAMILY_ROWS = 1024
HELD_WORDS = 400_000
# A stored table of a few numbers per row is broadcast up to so many rows (some 30 MB); larger ones are shuffled.
BROADCAST_ROWS = 250_000


class WordHashes(dict):
    """64-bit hashes of words, each computed once per worker and memory span."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > HELD_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_sets(texts: list[str | None], hashes: WordHashes) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each text.

    Shingles are five words in a row; a text with fewer words has its whole sequence as one; a text
    without words, and null, has none.
    """
    lists = [words(t) for t in texts]
    ends = np.cumsum([0, *map(len, lists)])
    ids = np.fromiter((hashes[w] for ws in lists for w in ws), np.uint64, int(ends[-1]))
    n = len(ids) - SHINGLE + 1
    if n > 0:
        grams = ids[:n] * MULTIPLIERS[0]
        for k in range(1, SHINGLE):
            grams += ids[k:n + k] * MULTIPLIERS[k]
        grams = mix64(grams)
    out = []
    for a, b in zip(ends, ends[1:]):
        if b - a >= SHINGLE:
            out.append(np.unique(grams[a:b - SHINGLE + 1]))
        elif b > a:
            whole = (ids[a:b] * MULTIPLIERS[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(mix64(mix64(np.array([whole]))))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def most_difference(size: int) -> int:
    """Elements by which a set of this size and any similar one can differ: its partner has at most 4/3 of its size."""
    return (size + 4 * size // 3) // 7


def bands(size: int) -> list[int]:
    """The band of a size, and the one below if a similar smaller set can lie there."""
    band = 0
    while size >= FIRST_BAND * BAND_FACTOR ** band:
        band += 1
    lower = FIRST_BAND * BAND_FACTOR ** (band - 1) if band else 0
    return [band, band - 1] if band and -(-3 * size // 4) < lower else [band]


def segment_count(band: int) -> int:
    return SMALL_SEGMENTS if not band else int(FIRST_BAND * BAND_FACTOR ** band / FILL)


def segments(shingles: np.ndarray, band: int) -> np.ndarray:
    """Keys of the filled segments of a set's sketch in a band.

    A shingle's segment is given by its upper half, its bit there by the whole hash. A segment is kept
    as the XOR of its bits' hashes: two flips of one bit cancel, as in the sketch itself.
    """
    part = ((shingles >> np.uint64(32)) * np.uint64(segment_count(band))) >> np.uint64(32)
    starts = np.flatnonzero(np.diff(part, prepend=np.uint64(1 << 63)) != 0)
    return mix64(np.bitwise_xor.reduceat(shingles, starts) ^ mix64(part[starts] + np.uint64((band + 1) << 40)))


def set_id(shingles: np.ndarray) -> np.uint64:
    # Arrays of one: unsigned arithmetic that wraps around without warnings.
    folded = np.bitwise_xor.reduce(shingles, keepdims=True) * MULTIPLIERS[:1] + shingles.sum(dtype=np.uint64, keepdims=True)
    return mix64(folded)[0]


def member_id(identity: np.uint64, band: int) -> np.uint64:
    """A set within a band; the last bit is free for a flag."""
    return mix64(np.array([identity]) + np.uint64(band + 1))[0] & ~np.uint64(1)


def sketch_bits(band: int) -> int:
    """Width of the dense sketches of a band: two bits per shingle of its largest sets."""
    return max(256, 2 * FIRST_BAND * BAND_FACTOR ** band)


def dense_sketch(shingles: np.ndarray, band: int) -> bytes:
    """Parity sketch of a set: each shingle flips one bit."""
    width = sketch_bits(band)
    flips = np.bincount((shingles & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(flips.astype(bool)).tobytes()


def described(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, set_id`` per row and the set's one or two members: needed equal segments and dense sketch."""
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for chunk in text_chunks(batches, max_bytes=CHUNK_BYTES):
            sizes, sets, members = [], [], []
            for s in shingle_sets(chunk.column("text").to_pylist(), hashes):
                sizes.append(len(s))
                if not len(s):
                    sets.append(None)
                    members.append([])
                    continue
                identity = set_id(s)
                sets.append(int(identity.view(np.int64)))
                members.append([{"member": int(member_id(identity, b).view(np.int64)), "sketch": dense_sketch(s, b),
                                 "needed": max(1, len(segments(s, b)) - most_difference(len(s)))} for b in bands(len(s))])
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(sets, pa.int64()),
                 pa.array(members, pa.list_(pa.struct([("member", pa.int64()), ("needed", pa.int64()), ("sketch", pa.binary())])))],
                names=["doc_id", "n_shingles", "set_id", "members"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.mapInArrow(
        releasing(describe), f"doc_id {kind}, n_shingles long, set_id long, members array<struct<member:long,needed:long,sketch:binary>>")


def shared_segments(docs: DataFrame, slices: int, chosen: bool = False) -> DataFrame:
    """``member, centre, n``: segments that a member has in common with others.

    As sums per member (then its own centre); or, if ``docs`` names in ``chosen`` the members that take
    part, by the smallest member that has the segments. A task combines its rows first: of the members
    that share a segment only the smallest is sent on, so a segment common to a third of all documents
    costs one row per task, not one task all rows.
    """
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, keys, members, held = WordHashes(), [], [], 0
        for chunk in text_chunks(batches, max_bytes=CHUNK_BYTES):
            sets = shingle_sets(chunk.column("text").to_pylist(), hashes)
            wanted = chunk.column("chosen").to_pylist() if chosen else [None] * len(sets)
            for s, want in zip(sets, wanted):
                if not len(s):
                    continue
                identity = set_id(s)
                for band in bands(len(s)):
                    member = member_id(identity, band)
                    # Rows that only share an id with a chosen document have other members.
                    if chosen and int(member.view(np.int64)) not in want:
                        continue
                    found = segments(s, band)
                    keys.append(found)
                    members.append(np.full(len(found), member))
                    held += len(found)
            if held > HELD_ROWS:
                yield from combine(np.concatenate(keys), np.concatenate(members))
                keys, members, held = [], [], 0
        if held:
            yield from combine(np.concatenate(keys), np.concatenate(members))

    def combine(keys: np.ndarray, members: np.ndarray) -> Iterator[pa.RecordBatch]:
        first, again, centre, rows = group(keys, members)
        yield from emit([(s, rest(k), m, None, None, None) for s, k, m in sliced(keys[first], slices, members[first])])
        if len(again):
            # The smallest of a group comes with the flag; it is counted where its segment arrives.
            m, c, n = pairs(rows[again], (centre if chosen else rows)[again])
            yield from emit([(None, None, None, m.view(np.int64), c.view(np.int64), n)])

    def rest(blob: bytes) -> bytes:
        """32 bits of each key below those of its slice: a chance match only adds a candidate."""
        keys = np.frombuffer(blob, np.uint64)
        return ((keys << np.uint64(slices.bit_length() - 1)) >> np.uint64(32)).astype(np.uint32).tobytes()

    def group(keys: np.ndarray, members: np.ndarray) -> tuple:
        """Sorts in place; positions of the first row of each key (flagged if shared), and of the others."""
        order = np.argsort(keys)
        keys[:], members[:] = keys[order], members[order]
        new = np.diff(keys, prepend=~keys[:1]) != 0
        many = np.flatnonzero(~new | np.r_[~new[1:], False])
        if len(many):
            order = many[np.lexsort((members[many], keys[many]))]
            members[many] = members[order]
            fresh = np.r_[True, (np.diff(keys) != 0) | (np.diff(members) != 0)]
        else:
            fresh = new
        starts = np.flatnonzero(new)
        which = np.cumsum(new) - 1
        centre = members[starts][which]
        again = np.flatnonzero(fresh & ~new)
        plain = members.copy()
        flagged = np.zeros(len(starts), bool)
        flagged[which[again]] = True
        members[starts[flagged]] |= np.uint64(1)
        return starts, again, centre, plain

    def emit(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        for s, k, m, member, centre, n in rows:
            size = 1 if member is None else len(member)
            yield pa.RecordBatch.from_arrays(
                [pa.array([s] * size, pa.int64()), pa.array([k] * size, pa.binary()), pa.array([m] * size, pa.binary()),
                 pa.array([None] if member is None else member, pa.int64()), pa.array([None] if member is None else centre, pa.int64()),
                 pa.array([None] if member is None else n, pa.int64())],
                names=["slice", "keys", "members", "member", "centre", "n"])

    sent = docs.mapInArrow(releasing(send), "slice long, keys binary, members binary, member long, centre long, n long")
    # Rows counted in their task already are dealt out by member; blobs meet by slice.
    place = F.coalesce("slice", F.col("member"))
    return sent.repartition(place).sortWithinPartitions("slice").mapInArrow(
        releasing(lambda batches: meet(batches, chosen)), "member long, centre long, n long")


def meet(batches: Iterator[pa.RecordBatch], by_centre: bool) -> Iterator[pa.RecordBatch]:
    """Members of each shared segment of a slice; blobs come sorted by slice, one slice is held at a time."""
    current, keys, members = None, [], []
    found, held = [], 0
    for batch in batches:
        counted = batch.filter(pa.compute.is_null(batch.column("slice")))
        if counted.num_rows:
            yield pa.RecordBatch.from_arrays([counted.column(c) for c in ("member", "centre", "n")], names=["member", "centre", "n"])
        for s, k, m in zip(*(batch.column(c).to_pylist() for c in ("slice", "keys", "members"))):
            if s is None:
                continue
            if s != current and keys:
                found.append(meet_slice(np.concatenate(keys), np.concatenate(members)))
                held += len(found[-1][0])
                keys, members = [], []
                if held > HELD_ROWS:
                    yield summed(found, by_centre)
                    found, held = [], 0
            current = s
            keys.append(np.frombuffer(k, np.uint32))
            members.append(np.frombuffer(m, np.uint64))
    if keys:
        found.append(meet_slice(np.concatenate(keys), np.concatenate(members)))
    if found:
        yield summed(found, by_centre)


def meet_slice(keys: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Members of the shared segments, and the smallest member of each one's segment."""
    order = np.argsort(keys)
    keys, members = keys[order], members[order]
    same = keys[1:] == keys[:-1]
    flagged = (members & np.uint64(1)).astype(bool)
    many = np.flatnonzero(np.r_[False, same] | np.r_[same, False] | flagged)
    keys, members, flagged = keys[many], members[many] & ~np.uint64(1), flagged[many]
    if not len(keys):
        return members, members
    order = np.lexsort((members, keys))
    keys, members, flagged = keys[order], members[order], flagged[order]
    new = np.r_[True, keys[1:] != keys[:-1]]
    fresh = new | np.r_[True, members[1:] != members[:-1]]
    which = np.cumsum(new) - 1
    # Copies of one set alone share nothing.
    shared = (np.bincount(which, fresh) >= 2) | (np.bincount(which, flagged) > 0)
    at = np.flatnonzero(fresh & shared[which])
    return members[at], members[np.flatnonzero(new)][which[at]]


def summed(found: list[tuple[np.ndarray, np.ndarray]], by_centre: bool) -> pa.RecordBatch:
    members, centres = (np.concatenate(side) for side in zip(*found))
    m, c, n = pairs(members, centres if by_centre else members)
    return pa.RecordBatch.from_arrays([pa.array(m.view(np.int64)), pa.array(c.view(np.int64)), pa.array(n, pa.int64())],
                                      names=["member", "centre", "n"])


def pairs(members: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (member, centre) pairs and how often each occurs."""
    order = np.lexsort((centres, members))
    m, c = members[order], centres[order]
    starts = np.flatnonzero(np.r_[True, (m[1:] != m[:-1]) | (c[1:] != c[:-1])][:len(m)])
    return m[starts], c[starts], np.diff(np.r_[starts, len(m)])


def spanning_links(size: np.ndarray, sketch: np.ndarray, side: np.ndarray | None, verify=None) -> list[tuple[int, int]]:
    """A spanning set of the links among rows (only between the two sides, if given).

    Rows link if their sketches do not rule it out, as the Hamming distance is a lower bound of the
    difference, and ``verify``, if given, agrees. Rows in one class already need no look.
    """
    label, out = np.arange(len(size)), []
    for a in range(len(size) - 1):
        near = label[a + 1:] != label[a]
        if side is not None:
            near &= side[a + 1:] != side[a]
        near &= (4 * np.minimum(size[a], size[a + 1:]) >= 3 * np.maximum(size[a], size[a + 1:]))
        rest = np.flatnonzero(near) + a + 1
        far = np.bitwise_count(sketch[rest] ^ sketch[a]).sum(1, dtype=np.int64)
        close = 7 * far <= size[a] + size[rest]
        rest, far = rest[close], far[close]
        for b in rest[np.argsort(far, kind="stable")]:
            if label[b] != label[a] and (verify is None or verify(a, b)):
                out.append((a, int(b)))
                label[label == label[b]] = label[a]
    return out


def tiles(rows: DataFrame, columns: list[str], work, schema: str) -> DataFrame:
    """Deal rows of ``family, chunks, set_id, ...`` into tiles, pairs of a family's chunks, and do each tile's ``work``.

    A tile holds about two chunks at most; ``work`` gets its rows by set id (chunk first) and whether
    only pairs between chunks count.
    """
    tiled = rows.withColumn("chunk", F.pmod(F.xxhash64("set_id"), "chunks")).withColumn(
        "mate", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    tiled = tiled.select("family", F.least("chunk", "mate").alias("i"), F.greatest("chunk", "mate").alias("j"), "chunk", "set_id", *columns)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, {}
        for batch in batches:
            for family, i, j, chunk, identity, *values in zip(*(c.to_pylist() for c in batch.columns)):
                if (family, i, j) != current:
                    if len(held) > 1:
                        yield from work(held, current[1] != current[2])
                    current, held = (family, i, j), {}
                held[identity] = (chunk, *values)
        if len(held) > 1:
            yield from work(held, current[1] != current[2])

    return tiled.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j").mapInArrow(releasing(walk), schema)


def edges_of(ids: list[int], found: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    if found:
        a, b = zip(*found)
        yield pa.RecordBatch.from_arrays([pa.array([ids[x] for x in a], pa.int64()), pa.array([ids[x] for x in b], pa.int64())], names=["a", "b"])


def sketch_links(held: dict, across: bool) -> Iterator[pa.RecordBatch]:
    """Spanning links of a tile as far as sketches tell; all sets of a family are of one band."""
    chunk, size, sketch = zip(*held.values())
    sketches = np.stack([np.frombuffer(s, np.uint64) for s in sketch])
    yield from edges_of(list(held), spanning_links(np.array(size), sketches, np.array(chunk) if across else None))


def verified_links(held: dict, across: bool) -> Iterator[pa.RecordBatch]:
    """Spanning links of a tile, verified on the whole sets; sketches give the order and rule pairs out."""
    sets = [np.frombuffer(s, np.uint64) for _, s in held.values()]
    size = np.array([len(s) for s in sets])
    # Of the largest set's band; a narrower sketch is a weaker bound, no wrong one.
    band = min(bands(int(size.max()))[0], 4)
    sketches = np.stack([np.frombuffer(dense_sketch(s, band), np.uint64) for s in sets])

    def similar(a: int, b: int) -> bool:
        common = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
        return 100 * common >= 75 * (size[a] + size[b] - common)

    side = np.array([c for c, _ in held.values()]) if across else None
    yield from edges_of(list(held), spanning_links(size, sketches, side, similar))


def shingled(texts: DataFrame) -> DataFrame:
    """Whole shingle sets for ``family, chunks, set_id, text``."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for chunk in text_chunks(batches, max_bytes=CHUNK_BYTES):
            sets = shingle_sets(chunk.column("text").to_pylist(), hashes)
            # Rows that only share an id with the wanted document have another set.
            same = [i for i, (s, want) in enumerate(zip(sets, chunk.column("set_id").to_pylist()))
                    if len(s) and int(set_id(s).view(np.int64)) == want]
            yield pa.RecordBatch.from_arrays(
                [chunk.column(c).take(pa.array(same, pa.int64())) for c in ("family", "chunks", "set_id")] +
                [pa.array([sets[i].tobytes() for i in same], pa.binary())], names=["family", "chunks", "set_id", "shingles"])

    return texts.mapInArrow(releasing(read), "family long, chunks long, set_id long, shingles binary")


def small(stored: DataFrame) -> DataFrame:
    """A stored narrow table, to be broadcast if its counted size allows, so that texts and sketches stay where they are."""
    return F.broadcast(stored) if stored.count() <= BROADCAST_ROWS else stored


def in_families(members: DataFrame) -> DataFrame:
    """Members of families of two and more, with the number of chunks their family is dealt into."""
    sizes = members.groupBy("family").agg(F.ceil(F.count("*") / FAMILY_ROWS).cast("long").alias("chunks"), F.count("*").alias("n"))
    return members.join(sizes.filter("n > 1").select(F.col("family").alias("f"), "chunks"), F.col("family") == F.col("f")).drop("f")


def similar_groups(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Groups of texts whose sets of five-word shingles have a Jaccard similarity of 0.75 or more.

    Returns ``doc_id, n_shingles, component_id`` per input row; the component is the smallest id that
    links reach. Null, empty and wordless texts have 0 shingles and link with nothing. Repeated rows
    link like any copies; rows with a null id take part, but their null never is the smallest id.

    1. Equal sets are one set. Each goes to its size band, and to the one below if partners can lie there.
    2. Segments of the sketches meet by key. A similar pair has all but ``most_difference`` segments in
       common, so members with fewer shared segments than that have no partner and leave. A first pass only
       counts; a second one sends the segments of what is left, one text per set.
    3. What is left falls into families connected by shared segments. Dense sketches are compared within
       them: pairs that differ in too many bits are ruled out, which leaves small families.
    4. Whole sets of these are read, and pairs that are not connected already are verified by their
       intersections. Families of any size are dealt into tiles of bounded size; links never cross families.

    Set ids and shingles are 64-bit hashes, so results are exact up to their collisions.
    """
    docs = with_unique_names(documents, doc_id=id_column, text=text_column)
    sets = settle(described(docs), "sets")
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    each = sets.filter("n_shingles > 0").groupBy("set_id").agg(
        F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("size"), F.first("members").alias("members"))
    members = settle(each.select("set_id", "size", "first_id", F.inline("members")), "members")
    counts = shared_segments(docs, slices_for(total)).groupBy("member").agg(F.sum("n").alias("n"))
    kept = counts.join(members.select("member", "needed", "set_id", "first_id", "size"), "member").filter("n >= needed")
    # A set has two members at most.
    chosen = settle(kept.groupBy("set_id", "first_id", "size").agg(F.collect_list("member").alias("chosen")), "chosen")
    total = chosen.agg(F.sum("size")).first()[0] or 0
    again = docs.join(small(chosen), F.col("doc_id").eqNullSafe(F.col("first_id"))).select("text", "chosen")
    shared = shared_segments(again, slices_for(2 * total), chosen=True)
    hubs = connected(shared.select(F.col("member").alias("a"), F.col("centre").alias("b")))
    coarse = settle(hubs.select(F.col("root").alias("hub"), "node"), "coarse")
    # A chance match of shortened keys can connect bands, whose sketches differ in width; links never do.
    banded = members.join(small(coarse), F.col("node") == F.col("member")).select(
        F.xxhash64("hub", F.octet_length("sketch")).alias("family"), "set_id", "size", "sketch")
    sketched = in_families(settle(banded, "banded"))
    near = connected(tiles(sketched, ["size", "sketch"], sketch_links, "a long, b long"))

    fine = in_families(near.select(F.col("root").alias("family"), F.col("node").alias("set_id")))
    wanted = settle(fine.join(members.select(F.col("set_id").alias("s"), "first_id").distinct(), F.col("set_id") == F.col("s")).drop("s"), "families")
    texts = docs.join(small(wanted), F.col("doc_id").eqNullSafe(F.col("first_id"))).select("family", "chunks", "set_id", "text")
    roots = connected(tiles(shingled(texts), ["shingles"], verified_links, "a long, b long"))

    grouped = sets.select("doc_id", "n_shingles", "set_id").join(roots, F.col("set_id") == F.col("node"), "left").withColumn(
        "group", F.coalesce("root", "set_id"))
    lowest = grouped.filter("group IS NOT NULL").groupBy(F.col("group").alias("g")).agg(
        F.min("doc_id").alias("component_id"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return grouped.join(lowest, F.col("group") == F.col("g"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (
  SELECT i.a, i.b FROM i JOIN n x ON x.doc_id = i.a JOIN n y ON y.doc_id = i.b
  WHERE 100 * i.common >= 75 * (x.n + y.n - i.common)),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON l.a = r.b),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.a = d.doc_id
"""
