"""Token ids in binary shards, compressed by a grammar of frequent pairs (Re-Pair) with random access."""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.shared import new_path, settle
from .common import releasing, text_chunks, with_unique_names
from .encoding import shared_encoder

MAGIC = b"RPIDS1\n\x00"
# Ids after which a task closes a shard; bounds the memory of grammar building and of reading.
SHARD_IDS = 1 << 21
# How often a pair must occur to get a rule; rounds of replacement go on as long as one does.
LEAST_PAIRS = 24
COUNTERS = 1 << 20
# Positions that are counted exactly, by sorting; more of them by hash.
EXACT_PAIRS = 1 << 18
# Odd numbers that spread pairs over the counters, one per round.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)


def replace_pairs(ids: np.ndarray, active: np.ndarray, first_symbol: int, least: int, salt: int = 0, hashed: bool = True) -> tuple:
    """One round: give frequent pairs nonterminals and put them in place of the pairs.

    Only ``active`` positions are counted, which are all occurrences of every pair that occurs ``least``
    times. Returns the shorter sequence, its active positions, and the rules' pairs in order of their
    symbols. A position stays active if its pair may still be frequent; next to a new symbol it becomes so.
    """
    at = np.flatnonzero(active[:-1])
    pair = (ids[at].astype(np.uint64) << np.uint64(32)) | ids[at + 1]
    exact = not hashed or len(at) <= EXACT_PAIRS
    if exact:
        kinds, slot = np.unique(pair, return_inverse=True)
    else:
        slot = ((pair * np.uint64(MULTIPLIERS[salt % len(MULTIPLIERS)])) >> np.uint64(64 - (COUNTERS.bit_length() - 1))).astype(np.int64)
        kinds = np.zeros(COUNTERS, np.uint64)
    counts = np.bincount(slot, minlength=len(kinds))
    often = np.flatnonzero(counts[slot] >= least)
    at, pair, slot = at[often], pair[often], slot[often]
    active = np.zeros(len(ids), bool)
    active[at] = True
    if not exact:
        # A counter stands for one of its pairs; others wait for a round that hashes differently.
        kinds[slot] = pair
        same = np.flatnonzero(kinds[slot] == pair)
        at, slot = at[same], slot[same]
    taken = every_other(np.diff(at, prepend=-2) != 1)
    used = often_enough(slot[taken], len(kinds), least)
    if exact and not len(used):
        # No pair has enough places of its own in the runs of overlapping pairs.
        rank = np.empty(len(kinds), np.int64)
        rank[np.lexsort((kinds, counts))] = np.arange(len(kinds))
        taken = most_frequent_first(at, rank[slot])
        used = often_enough(slot[taken], len(kinds), least)
    at, slot = at[taken], slot[taken]
    number = np.full(len(kinds), -1, np.int64)
    number[used] = first_symbol + np.arange(len(used))
    symbol = number[slot]
    at, symbol = at[symbol >= 0], symbol[symbol >= 0]
    out, keep = ids.copy(), np.ones(len(ids), bool)
    out[at], keep[at + 1] = symbol, False
    # The symbol before a new one: if it is new as well, it is active and the position between them goes.
    active[at] = True
    active[at[at > 0] - 1] = True
    kinds = kinds[used]
    return out[keep], active[keep], np.stack([kinds >> np.uint64(32), kinds & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32)


def often_enough(slot: np.ndarray, kinds: int, least: int) -> np.ndarray:
    return np.flatnonzero(np.bincount(slot, minlength=kinds) >= max(2, least // 2))


def every_other(fresh: np.ndarray) -> np.ndarray:
    """Whether a position is the first, third, ... of its run; ``fresh`` marks where runs begin."""
    starts = np.flatnonzero(fresh)
    return (np.arange(len(fresh)) - starts[np.cumsum(fresh) - 1]) & 1 == 0


def most_frequent_first(at: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Of overlapping pairs those of a higher rank than both neighbours; in a run of one pair every other one."""
    after = np.diff(at, prepend=-2) == 1
    left = np.where(after, np.r_[-1, rank[:-1]][:len(at)], -1)
    right = np.where(np.r_[after[1:], False][:len(at)], np.r_[rank[1:], -1][:len(at)], -1)
    return (rank >= left) & (rank >= right) & every_other(rank != left)


def compress(ids: np.ndarray, least: int = LEAST_PAIRS) -> tuple[int, np.ndarray, np.ndarray]:
    """Grammar of a sequence: the first nonterminal, the rules (pairs of symbols), the sequence left over.

    Ends when no pair of the sequence left occurs ``least`` times (three at least: less saves nothing). In
    a round with exact counts the most frequent pair always gets its rule, and a round with hashed ones
    that makes no rule is followed by such a round; each rule shortens the sequence.
    """
    least = max(3, least)
    terminals = int(ids.max()) + 1 if len(ids) else 0
    rules, left = [np.empty((0, 2), np.uint32)], ids.astype(np.uint32)
    active, first, turn = np.ones(len(left), bool), terminals, 0
    while active[:-1].any():
        left, active, new = replace_pairs(left, active, first, least, turn, hashed=not turn or len(rules[-1]) > 0)
        rules.append(new)
        first, turn = first + len(new), turn + 1
    return terminals, np.concatenate(rules), left


def expansion_lengths(terminals: int, rules: np.ndarray) -> np.ndarray:
    """Ids that each symbol stands for; a rule only uses symbols of earlier rounds."""
    lengths = np.ones(terminals + len(rules), np.int64)
    done = terminals
    while done < len(lengths):
        # Rules up to the first that uses a symbol not measured yet.
        rest = rules[done - terminals:]
        late = np.flatnonzero(rest.max(axis=1) >= done)
        upto = done + (int(late[0]) if len(late) else len(rest))
        part = rules[done - terminals:upto - terminals]
        lengths[done:upto] = lengths[part[:, 0]] + lengths[part[:, 1]]
        done = upto
    return lengths


def expand(symbols: np.ndarray, terminals: int, rules: np.ndarray) -> np.ndarray:
    """The ids that symbols stand for: rules are expanded once, then copied to where they occur."""
    lengths = expansion_lengths(terminals, rules)
    texts = np.arange(terminals, terminals + len(rules))
    while (inner := texts >= terminals).any():
        ends = np.cumsum(1 + inner)
        wide = np.empty(int(ends[-1]), np.int64)
        pairs = rules[texts[inner] - terminals]
        wide[ends[~inner] - 1] = texts[~inner]
        wide[ends[inner] - 2] = pairs[:, 0]
        wide[ends[inner] - 1] = pairs[:, 1]
        texts = wide
    texts = np.concatenate([np.arange(terminals), texts]).astype(np.uint32)
    size = lengths[symbols]
    start = (np.cumsum(lengths) - lengths)[symbols]
    ends = np.cumsum(size)
    # Position of each id in ``texts``: its symbol's start plus its place behind the symbol's first id.
    return texts[np.repeat(start - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)]


def write_shard(out: BinaryIO, doc_ids: list, sizes: np.ndarray, ids: np.ndarray) -> None:
    """File format: magic, length and JSON of the header, then little-endian arrays as the header lists them.

    Arrays: document sizes (ids each), rules, expansion length per rule, the compressed sequence.
    """
    terminals, rules, left = compress(ids)
    lengths = expansion_lengths(terminals, rules)[terminals:]
    arrays = [("sizes", sizes.astype("<i8")), ("rules", rules.astype("<u4")), ("lengths", lengths.astype("<i8")), ("left", left.astype("<u4"))]
    head = json.dumps({"terminals": terminals, "doc_ids": doc_ids,
                       "arrays": [[n, a.dtype.str, list(a.shape)] for n, a in arrays]}).encode()
    out.write(MAGIC + struct.pack("<Q", len(head)) + head)
    for _, a in arrays:
        out.write(a.tobytes())


class Shard:
    """A shard file: its documents in order, decoded whole or in part."""

    def __init__(self, data: bytes) -> None:
        if data[:8] != MAGIC:
            raise ValueError("no shard of token ids")
        size, = struct.unpack_from("<Q", data, 8)
        head = json.loads(data[16:16 + size])
        at = 16 + size
        self.terminals, self.doc_ids = head["terminals"], head["doc_ids"]
        for name, kind, shape in head["arrays"]:
            n = int(np.prod(shape))
            setattr(self, name, np.frombuffer(data, kind, n, at).reshape(shape))
            at += n * np.dtype(kind).itemsize
        if at != len(data):
            raise ValueError("a shard does not end where its arrays end")
        self.ends = np.cumsum(self.sizes)
        lengths = np.concatenate([np.ones(self.terminals, np.int64), self.lengths])
        # Ids up to the end of each symbol: where to enter the sequence for any range of ids.
        self.upto = np.cumsum(lengths[self.left]) if len(self.left) else np.zeros(0, np.int64)

    def range(self, start: int, stop: int) -> np.ndarray:
        """Ids from ``start`` to ``stop``; only symbols that overlap the range are expanded."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        first, last = np.searchsorted(self.upto, [start, stop - 1], side="right")
        before = int(self.upto[first - 1]) if first else 0
        return expand(self.left[first:last + 1], self.terminals, self.rules)[start - before:stop - before]

    def document(self, i: int) -> np.ndarray:
        return self.range(int(self.ends[i] - self.sizes[i]), int(self.ends[i]))


def write_shards(documents: DataFrame, folder: str, tokenizer: str, end_id: int = 0, id_column: str = "doc_id",
                 text_column: str = "text", tasks: int | None = None) -> DataFrame:
    """Encode whole texts and write them below ``folder`` in ascending id order; returns the list of shards.

    A null or empty text is one end id. Null ids come first; repeated rows follow each other. Documents
    are dealt to tasks by ranges of (id, hash of the text), so one id cannot fill a task. A task closes
    a shard after ``SHARD_IDS`` ids, under a name of its attempt; only finished shards are listed.
    """
    docs = with_unique_names(documents, doc_id=id_column, text=text_column).withColumn("tie", F.xxhash64("text"))
    if tasks is None:
        tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.repartitionByRange(tasks, F.asc_nulls_first("doc_id"), "tie").sortWithinPartitions(
        F.asc_nulls_first("doc_id"), "tie")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root)
        encoder, task, part = shared_encoder(tokenizer, keeps_space=True), TaskContext.get().partitionId(), 0
        names: list = []
        held: list = []

        def close() -> pa.RecordBatch:
            nonlocal part
            file = f"{uuid.uuid4().hex}.ids"
            ids = np.concatenate(held)
            with store.open_output_stream(f"{root}/{file}", compression=None) as out:
                write_shard(out, names, np.array([len(x) for x in held]), ids)
            row = pa.RecordBatch.from_pylist([{"task": task, "part": part, "file": file, "documents": len(held), "ids": len(ids)}],
                                             pa.schema([("task", pa.int64()), ("part", pa.int64()), ("file", pa.string()),
                                                        ("documents", pa.int64()), ("ids", pa.int64())]))
            part += 1
            return row

        total = 0
        for chunk in text_chunks(batches):
            for doc_id, found in zip(chunk.column("doc_id").to_pylist(), encoder.encode_column(chunk.column("text"))):
                names.append(doc_id)
                held.append(np.append(found, np.uint32(end_id)))
                total += len(held[-1])
                if total >= SHARD_IDS:
                    yield close()
                    names, held, total = [], [], 0
        if held:
            yield close()

    shards = settle(ordered.select("doc_id", "text").mapInArrow(
        releasing(write), "task long, part long, file string, documents long, ids long"), "shards")
    # One row per shard: a running sum over the list, not over documents.
    before = Window.orderBy("task", "part").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_shards(spark: SparkSession, folder: str, shards: DataFrame, id_type: str = "long", with_ids: bool = False) -> DataFrame:
    """Documents of listed shards: ``doc_id, start, n_tokens, ids_crc32`` (and ``ids``); decoded from the files."""
    arrow = {"long": pa.int64(), "bigint": pa.int64(), "string": pa.string(), "int": pa.int32()}[id_type]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_stream(f"{root}/{row['file']}", compression=None) as stream:
                    shard = Shard(stream.read())
                if len(shard.doc_ids) != row["documents"] or int(shard.sizes.sum()) != row["ids"]:
                    raise ValueError(f"{row['file']} does not hold what was written")
                ids = shard.range(0, row["ids"]).astype("<u4")
                starts = shard.ends - shard.sizes
                parts = [ids[a:b] for a, b in zip(starts, shard.ends)]
                columns = [pa.array(shard.doc_ids, arrow), pa.array(row["start"] + starts), pa.array(shard.sizes),
                           pa.array([zlib.crc32(p) for p in parts], pa.int64())]
                if with_ids:
                    columns.append(pa.array(parts, pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids)

    # A row stands for a whole file, so the list is dealt out evenly.
    dealt = shards.repartition(max(1, shards.count()), F.xxhash64("file"))
    return dealt.mapInArrow(releasing(read), f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else ""))


def round_trip(documents: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Write documents as shards in the shared folder and read them back."""
    folder = new_path(documents.sparkSession, "ids")
    shards = write_shards(documents, folder, tokenizer, id_column=id_column, text_column=text_column)
    return read_shards(documents.sparkSession, folder, shards, dict(documents.dtypes)[id_column])
