"""Language model in a log-frequency Bloom filter: quantised n-gram counts, found by repeated membership probes."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import new_path, settle
from .common import RowIds, as_strings, mix64, releasing, slices_for, text_chunks, with_unique_names, words
from .lookup import count_terms, frequent_terms

# Least count with which an n-gram of one, two, ... words enters; as many orders as entries.
LEAST = (1, 1, 2, 2)
# Counts are kept as levels, which begin at the least count times powers of BASE, rounded up.
BASE = 1.25
# Bits are tested at HASHES places per level.
HASHES = 4
# A context that occurs n times is taken to have n ** GROWTH different words behind it.
GROWTH = 0.8
# The filter grows with the corpus. If it takes no more than this it is broadcast, else n-grams go to its segments.
BROADCAST_BYTES = 32 << 20
# Tokens a task holds before it passes its partial counts on, and about as many of the corpus for each segment.
HELD_TOKENS, SLICE_TOKENS = 1 << 22, 1 << 20
# Text that is read at once; its n-grams are arrays of many times its size.
CHUNK_BYTES = 4 << 20
# Text whose distinct n-grams go to the segments together; a task holds their keys.
BLOCK_BYTES = 12 << 20
# Longest word that is hashed along with others, eight bytes at a time.
WORD_BYTES = 64
SPREAD = np.uint64(0x9E3779B97F4A7C15)
LOW = np.uint64(0xFFFFFFFF)
START, END = mix64(np.array([1, 2], np.uint64))
MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def tokens(text: str | None) -> list[bytes]:
    """Words of a text and the end, an empty word."""
    return [*words(text), b""]


def thresholds(least: int) -> np.ndarray:
    """Least count of each level from the first; a level's counts end below the next one's. Fewer than 255 levels."""
    return np.unique(np.ceil(least * BASE ** np.arange(180) - 1e-9).astype(np.int64))


def level_of(counts: np.ndarray, least: int) -> np.ndarray:
    """Quantised count, 1 from ``least`` on; 0 below it."""
    return np.searchsorted(thresholds(least), counts, side="right").astype(np.uint8)


def padded(values: np.ndarray) -> np.ndarray:
    """Values of all levels that probes may find."""
    return np.r_[values, np.full(256 - len(values), values[-1])]


def least_counts(least: int) -> np.ndarray:
    """Least count of levels 0, 1, ...: what an n-gram counts for."""
    return padded(np.r_[0.0, thresholds(least)])


def most_counts(least: int) -> np.ndarray:
    """Highest count of levels 0, 1, ...: what a context counts for, so that probabilities behind it sum to 1 at most."""
    limits = thresholds(least)
    return padded(np.r_[0, limits[1:] - 1, limits[-1] * BASE])


def cut_words(texts: list | pa.Array) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """All texts with A-Z in lower case, where words lie in them, and how many words each text has."""
    column = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())).fill_null("").cast(pa.large_binary())
    _, edges, held = column.buffers()
    edges = np.frombuffer(edges, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = bytes(memoryview(held)[edges[0]:edges[-1]]).lower() if held else b""
    edges = edges - edges[0]
    raw = np.frombuffer(data, np.uint8)
    inside = np.r_[False, (raw != 32) & ((raw < 9) | (raw > 13)), False]
    begins = inside[1:] & ~inside[:-1]
    ends = inside[:-1] & ~inside[1:]
    # A text ends the word before it, whatever it begins with.
    begins[edges] |= inside[1:][edges]
    ends[edges] |= inside[:-1][edges]
    begins, ends = np.flatnonzero(begins), np.flatnonzero(ends)
    return data, begins, ends, np.diff(np.searchsorted(begins, edges))


class Tokens:
    """Token hashes of texts, each a start, its words and an end.

    ``place``: a token's number in its text, 255 at most, ``first``: where texts start, ``at``: which tokens are
    words, ``terms``: distinct words, ``term_hashes``: their hashes, ``ids``: each word's number among them.
    """

    def __init__(self, texts: list | pa.Array) -> None:
        data, begins, ends, counts = cut_words(texts)
        sizes = ends - begins
        # Words without what lies between them, one after another.
        depth = np.zeros(len(data) + 1, np.int8)
        depth[begins] += 1
        depth[ends] -= 1
        raw = np.frombuffer(data, np.uint8)[np.cumsum(depth[:-1], dtype=np.int8).view(bool)]
        found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [
            None, pa.py_buffer(np.r_[0, np.cumsum(sizes)].astype(np.int64)), pa.py_buffer(raw)]).dictionary_encode()
        self.terms, self.ids = found.dictionary, found.indices.to_numpy()
        self.term_hashes = hash_words(self.terms)
        counts = counts + 2
        self.first = np.cumsum(counts) - counts
        self.hashes = np.empty(int(counts.sum()), np.uint64)
        self.hashes[self.first], self.hashes[self.first + counts - 1] = START, END
        self.hashes[self.at] = self.term_hashes[self.ids]
        self.place = np.minimum(np.arange(len(self.hashes)) - np.repeat(self.first, counts), 255).astype(np.uint8)

    @property
    def at(self) -> np.ndarray:
        word = np.ones(len(self.hashes), bool)
        word[self.first] = word[self.first[1:] - 1] = word[-1:] = False
        return np.flatnonzero(word)


def spread_out(terms: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of terms one after another, and where each begins and the last one ends."""
    if not len(terms):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, edges, held = terms.buffers()
    edges = np.frombuffer(edges, np.int64)[terms.offset:terms.offset + len(terms) + 1]
    return np.frombuffer(held, np.uint8)[edges[0]:edges[-1]] if held else np.zeros(0, np.uint8), edges - edges[0]


def hash_words(terms: pa.LargeBinaryArray) -> np.ndarray:
    raw, edges = spread_out(terms)
    begins, sizes = edges[:-1], np.diff(edges)
    windows = np.lib.stride_tricks.sliding_window_view(np.r_[raw, np.zeros(9, np.uint8)], 8)
    out, at = sizes.astype(np.uint64) * SPREAD, np.arange(len(sizes))
    for k in range(0, WORD_BYTES, 8):
        at = at[sizes[at] > k]
        if not len(at):
            break
        block = windows[begins[at] + k].view("<u8")[:, 0] & MASKS[np.minimum(sizes[at] - k, 8)]
        out[at] = mix64(out[at] ^ block)
    for i in np.flatnonzero(sizes > WORD_BYTES):
        out[i] = xxhash.xxh3_64_intdigest(raw[begins[i]:edges[i + 1]].tobytes())
    return out


def hash_of(terms: list[str]) -> np.ndarray:
    """Hashes of single tokens; an empty one is the end."""
    out, some = np.full(len(terms), END), np.array([bool(t) for t in terms], bool)
    read = Tokens([t for t in terms if t])
    out[some] = read.hashes[read.at]
    return out


def grams(hashes: np.ndarray, place: np.ndarray, slices: int, orders: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per order the key of the n-gram that ends at each token, and whether the text has one there.

    A key is a slice and 32 bits of a hash within it. Slices grow in number with the corpus, so of the
    n-grams of a slice about one in two thousand shares its key, far fewer than the filter confuses.
    """
    shift = np.uint64(32 - (slices.bit_length() - 1))
    gram = mix64(hashes)
    for order in range(1, orders + 1):
        if order > 1:
            gram = mix64(np.r_[np.uint64(0), gram[:-1]] * SPREAD + hashes)
        yield gram >> shift, place >= order - 1


def changes(ordered: np.ndarray) -> np.ndarray:
    """Which of the sorted values are not like the one before."""
    out = np.ones(len(ordered), bool)
    out[1:] = ordered[1:] != ordered[:-1]
    return out


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in ascending order and each key's number among them.

    Keys are sorted along with their places, as one number each. What does not fit is cut off the keys' end;
    should that confuse two keys, they are sorted the longer way.
    """
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    bits = np.uint64(len(keys).bit_length())
    drop = np.uint64(max(0, int(keys.max()).bit_length() + int(bits) - 64))
    packed = np.sort((keys >> drop << bits) | np.arange(len(keys), dtype=np.uint64))
    at = (packed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    ordered = keys[at]
    if drop and (ordered[1:] < ordered[:-1]).any():
        return np.unique(keys, return_inverse=True)
    new = changes(ordered)
    number = np.empty(len(keys), np.int64)
    number[at] = np.cumsum(new) - 1
    return ordered[new], number


def by_slice(keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Slices of sorted keys and where each begins and ends."""
    of = keys >> np.uint64(32)
    starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else []
    for a, b in zip(starts, [*starts[1:], len(of)]):
        yield int(of[a]), int(a), int(b)


def places(low: np.ndarray, step: np.ndarray, j: int, width: np.ndarray | np.uint64) -> np.ndarray:
    """A key's place number ``j`` among ``width`` bits, fewer than 2**32."""
    return (((low + np.uint64(j) * step) & LOW) * width >> np.uint64(32)).astype(np.int64)


def probes(keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """First place and step of keys at a level, before they are scaled to a segment."""
    mixed = mix64((keys & LOW) | np.uint64(level << 32))
    return mixed & LOW, (mixed >> np.uint64(32)) | np.uint64(1)


def segment(keys: np.ndarray, levels: np.ndarray, hashes: int) -> bytes:
    """Bits, half of them set, that hold all levels of a slice's n-grams up to the given ones."""
    width = 64 * max(1, int(np.ceil(levels.sum(dtype=np.int64) * hashes / np.log(2) / 64)))
    bits = np.zeros(width, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        low, step = probes(keys[levels >= level], level)
        for j in range(hashes):
            bits[places(low, step, j, np.uint64(width))] = True
    return np.packbits(bits, bitorder="little").tobytes()


class Filter:
    """Segments one after another; ``edges`` says at which byte each slice's segment begins."""

    def __init__(self, bits: bytes, edges: np.ndarray, hashes: int) -> None:
        self.bits, self.edges, self.hashes = np.frombuffer(bits, np.uint8), edges, hashes

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Highest level up to which every membership probe of a key succeeds; 0 if the first one fails."""
        out = np.zeros(len(keys), np.uint8)
        of = (keys >> np.uint64(32)).astype(np.int64)
        base = self.edges[of]
        width = ((self.edges[of + 1] - base) * 8).astype(np.uint64)
        alive, level = np.flatnonzero(width), 1
        while len(alive) and level < 255:
            low, step = probes(keys[alive], level)
            held = np.arange(len(alive))
            for j in range(self.hashes):
                bit = places(low[held], step[held], j, width[alive[held]])
                found = self.bits[base[alive[held]] + (bit >> 3)] >> (bit & 7).astype(np.uint8)
                held = held[found & 1 == 1]
            alive = alive[held]
            out[alive] = level
            level += 1
        return out


def segments(texts: DataFrame, slices: int, least: tuple = LEAST, hashes: int = HASHES) -> DataFrame:
    """Count all n-grams of all texts; one row ``(slice long, bits binary)`` per slice that has any.

    A task counts its n-grams first, so a hot one is one row per task and order. Counts of a slice meet
    in one task; slices grow in number with the corpus, not in size.
    """
    names = ["slice", "length", "once", "more", "counts"]
    kind = "slice long, length int, once binary, more binary, counts binary"

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for chunk in text_chunks(batches, max_bytes=CHUNK_BYTES):
            read = Tokens(chunk.column("text"))
            held.append((read.hashes, read.place))
            size += len(read.hashes)
            if size >= HELD_TOKENS:
                yield from emit(held)
                held, size = [], 0
        if held:
            yield from emit(held)

    def emit(held: list) -> Iterator[pa.RecordBatch]:
        found = grams(*map(np.concatenate, zip(*held)), slices, len(least))
        for length, (keys, there) in enumerate(found, 1):
            keys, counts = np.unique(keys[there], return_counts=True)
            rows = []
            for s, a, b in by_slice(keys):
                key, n = keys[a:b].astype(np.uint32), counts[a:b]
                more = n > 1
                rows.append((s, length, key[~more].tobytes(), key[more].tobytes(), n[more].astype(np.uint32).tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    zip(*rows), (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))], names=names)

    def total(parts: list) -> tuple[np.ndarray, np.ndarray]:
        """Keys and counts of one slice and order. A key and its count are one number, sorted as such."""
        packed = np.sort(np.concatenate([(k.astype(np.uint64) << np.uint64(32)) | n for k, n in parts]))
        keys = packed >> np.uint64(32)
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        return keys[starts], np.add.reduceat((packed & LOW).astype(np.int64), starts)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts, kept = None, [], []

        def count() -> None:
            keys, counts = total(parts)
            levels = level_of(counts, least[current[1] - 1])
            kept.append((keys[levels > 0], levels[levels > 0]))
            parts.clear()

        def close() -> pa.RecordBatch:
            bits = segment(np.concatenate([k for k, _ in kept]), np.concatenate([n for _, n in kept]), hashes)
            kept.clear()
            return pa.RecordBatch.from_arrays([pa.array([current[0]], pa.int64()), pa.array([bits], pa.binary())], names=["slice", "bits"])

        for batch in batches:
            for s, length, once, more, counts in zip(*(batch.column(c).to_pylist() for c in names)):
                if current not in (None, (s, length)):
                    count()
                    if current[0] != s:
                        yield close()
                current = (s, length)
                once = np.frombuffer(once, np.uint32)
                parts += [(once, np.uint64(1)), (np.frombuffer(more, np.uint32), np.frombuffer(counts, np.uint32).astype(np.uint64))]
        if parts:
            count()
            yield close()

    sent = texts.select("text").mapInArrow(releasing(send), kind)
    return sent.repartition("slice").sortWithinPartitions("slice", "length").mapInArrow(releasing(meet), "slice long, bits binary")


class Model:
    """What workers need to score besides the filter: the frequent words with their counts, totals, parameters."""

    def __init__(self, vocabulary: list[str], counts: np.ndarray, total: int, types: int, slices: int, least: tuple) -> None:
        hashes = hash_of(vocabulary)
        order = np.argsort(hashes)
        self.vocabulary, self.counts = hashes[order], counts[order]
        self.total, self.types, self.slices, self.least = total, types, slices, least

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of frequent words, -1 for others."""
        if not len(self.vocabulary):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, -1)

    def keys(self, read: Tokens) -> np.ndarray:
        """Distinct keys of all n-grams of texts, in ascending order."""
        return np.unique(np.concatenate([k[there] for k, there in grams(read.hashes, read.place, self.slices, len(self.least))]))

    def probabilities(self, read: Tokens, find: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """Each token's probability behind the tokens before it; 1 for starts. ``find`` gives levels of distinct keys.

        Single words have add-one probabilities; all words and one unknown sum to 1 at most. An n-gram
        counts for its level's least count, its context for its level's highest one, and the context
        leaves the next shorter one as much as words are expected behind it. A context that is too rare
        for any stored n-gram changes nothing. A gram is only looked up if both shorter ones in it are there.
        """
        return self.mixed(read, lambda order, keys: find(keys))

    def mixed(self, read: Tokens, find: Callable[[int, np.ndarray], np.ndarray]) -> np.ndarray:
        """The same; ``find`` is told the order of the keys."""
        p, level = np.ones(len(read.hashes)), np.zeros(len(read.hashes), np.uint8)
        for order, (keys, there) in enumerate(grams(read.hashes, read.place, self.slices, len(self.least)), 1):
            before = np.r_[np.uint8(0), level[:-1]]
            at = np.flatnonzero(there if order == 1 else there & (level > 0) & (before > 0))
            kinds, back = distinct(keys[at])
            level = np.zeros(len(keys), np.uint8)
            level[at] = find(order, kinds)[back]
            counts = least_counts(self.least[order - 1])[level]
            if order == 1:
                p = (counts + 1) / (self.total + self.types + 1)
            else:
                most = most_counts(self.least[order - 2])
                context, rest = most[before], (most ** GROWTH)[before]
                known = there & (context >= self.least[order - 1])
                context, rest = context[known], rest[known]
                p[known] = (np.minimum(counts[known], context) + rest * p[known]) / (context + rest)
        p[read.first] = 1
        return p


def train(texts: DataFrame, counts: DataFrame, total: int, types: int, least: tuple = LEAST, hashes: int = HASHES) -> tuple[Model, DataFrame]:
    """The model of all ``texts`` and its filter as a stored table of segments. ``counts``: exact token counts."""
    top = frequent_terms(counts).select("term", "n").toArrow()
    slices = slices_for(total, SLICE_TOKENS, most=1 << 24)
    model = Model(top.column("term").to_pylist(), np.array(top.column("n").to_pylist(), np.float64), total, types, slices, least)
    return model, settle(segments(texts, slices, least, hashes), "segments")


def gather(stored: DataFrame, slices: int, hashes: int = HASHES) -> Filter:
    """The whole filter, for broadcasting; its size is to be checked before."""
    rows = stored.orderBy("slice").toArrow()
    sizes = np.zeros(slices + 1, np.int64)
    bits = rows.column("bits").to_pylist()
    sizes[np.array(rows.column("slice").to_pylist(), np.int64) + 1] = [len(b) for b in bits]
    return Filter(b"".join(bits), np.cumsum(sizes), hashes)


def write_blocks(docs: DataFrame, folder: str) -> DataFrame:
    """Store ``docs(doc_id, held_out, text)`` in blocks below ``folder``; returns the list ``(block, file, tokens)``.

    ``tokens``: those that are learned from. Files are named by the attempt; only finished ones are listed.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root)
        numbers, held, size, learned = RowIds(), [], 0, 0

        def close() -> pa.RecordBatch:
            file = f"{uuid.uuid4().hex}.arrow"
            options = pa.ipc.IpcWriteOptions(compression="zstd")
            with store.open_output_stream(f"{root}/{file}", compression=None) as sink, pa.ipc.new_stream(sink, held[0].schema, options=options) as out:
                for chunk in held:
                    out.write_batch(chunk)
            return pa.RecordBatch.from_arrays([pa.array(numbers.take(1)), pa.array([file]), pa.array([learned], pa.int64())],
                                              names=["block", "file", "tokens"])

        for chunk in text_chunks(batches, max_bytes=CHUNK_BYTES):
            counts = cut_words(chunk.column("text"))[-1] + 1
            learned += int(counts[~chunk.column("held_out").to_numpy(zero_copy_only=False)].sum())
            size += chunk.nbytes
            held.append(chunk)
            if size >= BLOCK_BYTES:
                yield close()
                held, size, learned = [], 0, 0
        if held:
            yield close()

    return settle(docs.select("doc_id", "held_out", "text").mapInArrow(releasing(write), "block long, file string, tokens long"), "blocks")


class Block:
    """A stored block of texts: its chunks, their tokens, and all distinct words with the end, ordered by slice."""

    def __init__(self, folder: str, file: str, slices: int) -> None:
        store, root = fs.FileSystem.from_uri(folder)
        with store.open_input_stream(f"{root}/{file}", compression=None) as source:
            self.chunks = list(pa.ipc.open_stream(source.read()))
        self.slices, self.reads = slices, [Tokens(c.column("text")) for c in self.chunks]
        found = pa.concat_arrays([*(r.terms for r in self.reads), pa.array([b""], pa.large_binary())]).dictionary_encode()
        of = found.indices.to_numpy()
        hashes = np.empty(len(found.dictionary), np.uint64)
        hashes[of] = np.concatenate([*(r.term_hashes for r in self.reads), [END]])
        # A word goes along with the n-gram that it is by itself.
        keys, _ = next(grams(hashes, np.zeros(len(hashes), np.uint8), slices, 1))
        order = np.argsort(keys >> np.uint64(32), kind="stable")
        self.terms, self.term_keys = found.dictionary.take(pa.array(order)), keys[order]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        # Numbers of each chunk's words, and of the end, among the block's.
        self.of = np.split(place[of[:-1]], np.cumsum([len(r.terms) for r in self.reads])[:-1])
        self.end = int(place[of[-1]])

    def grams(self, orders: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        return grams(np.concatenate([r.hashes for r in self.reads]), np.concatenate([r.place for r in self.reads]), self.slices, orders)

    def slice_edges(self, keys: np.ndarray) -> np.ndarray:
        return np.searchsorted(keys, np.arange(self.slices + 1, dtype=np.uint64) << np.uint64(32))


def packed(*parts: np.ndarray) -> bytes:
    """Arrays of bytes or numbers as one compressed value."""
    parts = [np.ascontiguousarray(p).tobytes() for p in parts]
    body = np.array([len(parts), *map(len, parts)], np.int64).tobytes() + b"".join(parts)
    return len(body).to_bytes(8, "little") + pa.compress(body, codec="zstd", asbytes=True)


def unpacked(blob: bytes, *kinds: type) -> list[np.ndarray]:
    body = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
    head = 8 * (len(kinds) + 1)
    edges = np.cumsum([head, *np.frombuffer(body, np.int64, len(kinds), 8)])
    return [np.frombuffer(body, np.uint8)[a:b].view(kind) for a, b, kind in zip(edges, edges[1:], kinds)]


def ask(blocks: DataFrame, folder: str, slices: int, orders: int) -> DataFrame:
    """What each block has of each slice, one row each: distinct keys by order with their learned counts, words with theirs."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, file in zip(batch.column("block").to_pylist(), batch.column("file").to_pylist()):
                yield from emit(number, Block(folder, file, slices))

    def emit(number: int, block: Block) -> Iterator[pa.RecordBatch]:
        learned = [~c.column("held_out").to_numpy(zero_copy_only=False) for c in block.chunks]
        once = np.concatenate([np.repeat(flags, np.diff(np.r_[r.first, len(r.hashes)])) for r, flags in zip(block.reads, learned)])
        steps, counts, edges = [], [], []
        for keys, there in block.grams(orders):
            # A key and whether it is learned from are one number, sorted as such.
            both = np.sort((keys[there] << np.uint64(1)) | once[there])
            keys = both >> np.uint64(1)
            starts = np.flatnonzero(changes(keys))
            counts.append(np.add.reduceat((both & np.uint64(1)).astype(np.int64), starts) if len(starts) else np.zeros(0, np.int64))
            keys = keys[starts]
            edges.append(block.slice_edges(keys))
            keys = keys.astype(np.uint32)
            step = np.diff(keys, prepend=np.uint32(0))
            firsts = edges[-1][:-1][np.diff(edges[-1]) > 0]
            step[firsts] = keys[firsts]
            steps.append(step)
        used = np.zeros(len(block.terms), np.int64)
        for r, of, flags in zip(block.reads, block.of, learned):
            used += np.bincount(of[r.ids[np.repeat(flags, np.diff(np.r_[r.first, len(r.hashes)]) - 2)]], minlength=len(used))
            used[block.end] += flags.sum()
        raw, begins = spread_out(block.terms)
        words_at = block.slice_edges(block.term_keys)
        rows, size = [], 0
        for s in range(slices):
            own = [(e[s], e[s + 1]) for e in edges]
            if not any(b > a for a, b in own):
                continue
            n = np.concatenate([c[a:b] for c, (a, b) in zip(counts, own)])
            step = np.concatenate([x[a:b] for x, (a, b) in zip(steps, own)])
            a, b = words_at[s], words_at[s + 1]
            # Differences byte by byte: the highest bytes are mostly 0.
            blob = packed(np.array([b - a for a, b in own]), step.view(np.uint8).reshape(-1, 4).T, np.minimum(n, 255).astype(np.uint8), n[n >= 255],
                          np.diff(begins[a:b + 1]).astype(np.uint32), raw[begins[a]:begins[b]], used[a:b])
            rows.append((s, number, blob))
            size += len(blob)
            if size >= CHUNK_BYTES:
                yield together(rows)
                rows, size = [], 0
        if rows:
            yield together(rows)

    def together(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary()))],
                                          names=["slice", "block", "blob"])

    return blocks.mapInArrow(releasing(send), "slice long, block long, blob binary")


def answer(asked: DataFrame, least: tuple, hashes: int) -> DataFrame:
    """Each block's answer from each slice: levels of its keys by order, exact counts of its words.

    A slice's counts meet in one task, which makes its segment and probes it with each distinct key. Slices
    grow in number with the corpus, not in size. ``types`` (on one row of a slice): its different learned words.
    """
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, blocks, parts = None, [], []
        for batch in batches:
            for s, block, blob in zip(*(batch.column(c).to_pylist() for c in ("slice", "block", "blob"))):
                if s != current and parts:
                    yield close(current, blocks, parts)
                    blocks, parts = [], []
                current = s
                blocks.append(block)
                parts.append(unpacked(blob, np.int64, np.uint8, np.uint8, np.int64, np.uint32, np.uint8, np.int64))
        if parts:
            yield close(current, blocks, parts)

    def close(s: int, blocks: list, parts: list) -> pa.RecordBatch:
        sizes = np.array([p[0] for p in parts])
        found = [keys_of(*p[:4]) for p in parts]
        seen = [total(*map(np.concatenate, zip(*(f[order] for f in found)))) for order in range(len(least))]
        levels = [level_of(counts, low) for (_, counts, _), low in zip(seen, least)]
        bits = segment(np.concatenate([k[v > 0] for (k, *_), v in zip(seen, levels)]), np.concatenate([v[v > 0] for v in levels]), hashes)
        stored = Filter(bits, np.array([0, len(bits)]), hashes)
        back = [np.split(stored.levels(k)[of], np.cumsum(sizes[:, order])[:-1]) for order, (k, _, of) in enumerate(seen)]
        lengths, raw, used = (np.concatenate([p[i] for p in parts]) for i in (4, 5, 6))
        terms = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [
            None, pa.py_buffer(np.r_[0, np.cumsum(lengths, dtype=np.int64)]), pa.py_buffer(raw)]).dictionary_encode()
        of = terms.indices.to_numpy()
        counts = np.zeros(len(terms.dictionary), np.int64)
        np.add.at(counts, of, used)
        words_back = np.split(counts[of], np.cumsum([len(p[4]) for p in parts])[:-1])
        blobs = [packed(size, np.concatenate([b[i] for b in back]), words_back[i]) for i, size in enumerate(sizes)]
        types = np.zeros(len(blobs), np.int64)
        types[0] = (counts > 0).sum()
        return pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array([s] * len(blobs), pa.int64()), pa.array(blobs, pa.binary()), pa.array(types)],
                                          names=["block", "slice", "blob", "types"])

    def keys_of(sizes: np.ndarray, planes: np.ndarray, small: np.ndarray, large: np.ndarray) -> list:
        """Keys and counts of each order."""
        steps = planes.reshape(4, -1).T.copy().view(np.uint32)[:, 0]
        counts = small.astype(np.int64)
        counts[small == 255] = large
        edges = np.r_[0, np.cumsum(sizes)]
        return [(np.cumsum(steps[a:b], dtype=np.uint32), counts[a:b]) for a, b in zip(edges, edges[1:])]

    def total(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys, the sums of their counts, and each key's number among them."""
        kinds, of = distinct(keys.astype(np.uint64))
        sums = np.zeros(len(kinds), np.int64)
        np.add.at(sums, of, counts)
        return kinds, sums, of

    return asked.repartition("slice").sortWithinPartitions("slice", "block").mapInArrow(
        releasing(meet), "block long, slice long, blob binary, types long")


def by_segments(docs: DataFrame, blocks: DataFrame, folder: str, total: int, least: tuple, hashes: int) -> DataFrame:
    """Scores by stored blocks, with a filter of any size: ``doc_id, held_out, n_tokens, n_known, logs, score``, and ``types``.

    A block's distinct n-grams and words go to their slices, which answer one byte a key and the words' exact
    counts. The answers of a block meet in one task, which reads the block again.
    """
    orders, slices = len(least), slices_for(total, SLICE_TOKENS, most=1 << 24)
    n = max(1, blocks.count())
    asked = ask(blocks.repartitionByRange(n, "block"), folder, slices, orders)
    answers = settle(answer(asked, least, hashes), "answers")
    types = answers.agg(F.sum("types")).first()[0] or 0
    model = Model([], np.zeros(0), total, types, slices, least)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []
        for batch in batches:
            for file, blob in zip(batch.column("file").to_pylist(), batch.column("blob").to_pylist()):
                if file != current and held:
                    yield from close(Block(folder, current, slices), held)
                    held = []
                current = file
                held.append(blob)
        if held:
            yield from close(Block(folder, current, slices), held)

    def close(block: Block, blobs: list) -> Iterator[pa.RecordBatch]:
        parts = [unpacked(b, np.int64, np.uint8, np.int64) for b in blobs]
        cut = [np.split(levels, np.cumsum(sizes)[:-1]) for sizes, levels, _ in parts]
        levels = [np.concatenate(x) for x in zip(*cut)]
        kinds = []
        for keys, there in block.grams(orders):
            keys = np.sort(keys[there])
            kinds.append(keys[changes(keys)])
        if any(len(k) != len(v) for k, v in zip(kinds, levels)):
            raise ValueError("a block's answers are not those to its keys")
        counts = np.concatenate([c for *_, c in parts])
        for chunk, read, of in zip(block.chunks, block.reads, block.of):
            scores = np.log10(model.mixed(read, lambda order, keys: levels[order - 1][np.searchsorted(kinds[order - 1], keys)]))
            # Exact counts of all tokens; starts count for nothing.
            seen = np.zeros(len(read.hashes), np.int64)
            seen[read.first[1:] - 1] = seen[-1:] = counts[block.end]
            seen[read.at] = counts[of[read.ids]]
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), chunk.column("held_out"), *(pa.array(np.add.reduceat(x, read.first)) for x in (
                    (read.place > 0).astype(np.int64), (seen > 0).astype(np.int64), np.log10(seen + 1), scores))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "logs", "score"])

    files = blocks.select(F.col("block").alias("number"), "file")
    rows = answers.drop("types").join(F.broadcast(files), F.col("block") == F.col("number")).select("block", "file", "slice", "blob")
    return rows.repartitionByRange(n, "block").sortWithinPartitions("block", "slice").mapInArrow(
        releasing(score), f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, n_tokens long, n_known long, logs double, score double"
    ).withColumn("types", F.lit(types).cast("long"))


def score_documents(documents: DataFrame, folds: int = 7, held_fold: int = 2, id_column: str = "doc_id", text_column: str = "text",
                    least: tuple = LEAST, hashes: int = HASHES, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Score whole texts with a model of the documents whose crc32(id as text) mod ``folds`` is not ``held_fold``.

    Returns per input row ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``. A null
    text is empty and has one token, its end. A row with a null id is learned from. Repeated rows are
    learned from and scored each. A very long text is read whole, in a chunk of its own. Without training
    rows every token is unknown: base 0, score 0. Other columns are not read, whatever their names.

    ``base_score`` and ``n_known`` use exact counts, ``score`` uses the filter and totals. The filter holds every
    n-gram with its least count at any size of the corpus. If it surely takes ``broadcast_bytes`` at most, it is
    broadcast, and rare words' counts are joined; else n-grams and words are sent to its segments. Either way
    gives the same scores.
    """
    docs = with_unique_names(documents, doc_id=id_column, text=text_column)
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds))
    docs = docs.withColumn("held_out", F.coalesce(fold == held_fold, F.lit(False)))
    folder = new_path(docs.sparkSession, "texts")
    blocks = write_blocks(docs, folder)
    total = blocks.agg(F.sum("tokens")).first()[0] or 0
    # A token brings at most one level of each order, and a level takes HASHES / ln 2 bits.
    if total * len(least) * hashes / np.log(2) / 8 <= broadcast_bytes:
        out = by_broadcast(docs, total, least, hashes)
    else:
        out = by_segments(docs, blocks, folder, total, least, hashes)
    each = F.log10(F.col("types") + F.lit(total + 1))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
                      (F.col("logs") - F.col("n_tokens") * each).alias("base_score"), "score")


def by_broadcast(docs: DataFrame, total: int, least: tuple, hashes: int) -> DataFrame:
    """Scores with a filter that is sent to all tasks: ``doc_id, held_out, n_tokens, n_known, logs, score``, and ``types``."""
    spark, kind = docs.sparkSession, dict(docs.dtypes)["doc_id"]
    learned = docs.filter(~F.col("held_out"))
    counts = settle(count_terms(learned, tokens), "tokens")
    types = counts.count()
    made, stored = train(learned, counts, total, types, least, hashes)
    model, shared = spark.sparkContext.broadcast(made), spark.sparkContext.broadcast(gather(stored, made.slices, hashes))

    def score(chunk: pa.RecordBatch, read: Tokens, number: np.ndarray, find: Callable) -> pa.RecordBatch:
        logs = np.append(np.log10(model.value.counts + 1), 0.0)
        scores = np.add.reduceat(np.log10(model.value.probabilities(read, find)), read.first)
        ids = model.value.ids(read.hashes)
        predicted = np.add.reduceat((read.place > 0).astype(np.int64), read.first)
        found = np.add.reduceat((ids >= 0).astype(np.int64), read.first)
        base = np.add.reduceat(logs[ids], read.first)
        words_at, terms = read.at, read.terms.to_pylist()
        unknown = np.flatnonzero(ids[words_at] < 0)
        edges = np.searchsorted(words_at[unknown], np.r_[read.first, len(read.hashes)])
        # The end is an unknown token only if it is not among the frequent ones.
        ends = np.r_[read.first[1:], len(read.hashes)] - 1
        at, term, n = [], [], []
        for i, (a, b) in enumerate(zip(edges, edges[1:])):
            rare = Counter([terms[u] for u in read.ids[unknown[a:b]]])
            if ids[ends[i]] < 0:
                rare[b""] = 1
            # Without rare words: a term that cannot match, own to the row.
            term += rare.keys() if rare else [b" %d" % number[i]]
            n += rare.values() if rare else [0]
            at += [i] * max(1, len(rare))
        at = np.array(at)
        first = np.r_[True, at[1:] != at[:-1]]

        def once(values: np.ndarray) -> pa.Array:
            return pa.array(np.where(first, values[at], 0).astype(values.dtype))

        return pa.RecordBatch.from_arrays(
            [pa.array(number[at]), chunk.column("doc_id").take(pa.array(at)), chunk.column("held_out").take(pa.array(at)),
             once(predicted), once(found), once(base), once(scores), as_strings(term), pa.array(n, pa.int64())],
            names=["row_id", "doc_id", "held_out", "n_tokens", "found", "base", "score", "term", "n"])

    def score_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = RowIds()
        for chunk in text_chunks(batches, max_bytes=CHUNK_BYTES):
            yield score(chunk, Tokens(chunk.column("text")), numbers.take(chunk.num_rows), shared.value.levels)

    rows = docs.mapInArrow(releasing(score_texts), f"row_id long, doc_id {kind}, held_out boolean, n_tokens long, found long, "
                                                   "base double, score double, term string, n long")
    joined = rows.join(counts.select("term", F.col("n").alias("count")), "term", "left")
    known = F.when(F.col("count").isNotNull(), F.col("n")).otherwise(0)
    return joined.groupBy("row_id").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("found") + known).alias("n_known"),
        F.sum(F.col("base") + F.col("n") * F.log10(F.coalesce("count", F.lit(0)) + 1)).alias("logs"), F.sum("score").alias("score")
    ).withColumn("types", F.lit(types).cast("long"))
