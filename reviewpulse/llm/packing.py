"""Harmonic packing of token sequences: bins of a reciprocal-capacity class hold a fixed number of pieces."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import settle
from .common import releasing, text_chunks, with_unique_names
from .encoding import shared_encoder

CAPACITY = 2048
# Text that a task encodes at once; its words, as many objects, are what takes memory.
CHUNK_BYTES = 2 << 20
# A piece may fall this many tokens short of its class before it is cut instead.
SLACK = 8


def cuts(length: int, capacity: int = CAPACITY, slack: int = SLACK) -> list[tuple[int, int]]:
    """Cut a length into (piece length, class): full bins first, then pieces that fit a class well.

    A piece of class k is at most ``capacity // k`` long, and a bin takes k of them. The rest of a
    document stays whole if it falls at most ``slack`` short of its class; otherwise the largest
    reciprocal below it is cut off. Rests shrink fast, so a document ends in about three pieces.
    """
    pieces = [(capacity, 1)] * (length // capacity)
    rest = length % capacity
    while rest:
        kind = capacity // rest
        if capacity // kind - rest > slack:
            kind += 1
        piece = min(rest, capacity // kind)
        pieces.append((piece, kind))
        rest -= piece
    return pieces


def document_pieces(documents: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY,
                    slack: int = SLACK, id_column: str = "doc_id", text_column: str = "text",
                    with_ids: bool = False) -> DataFrame:
    """Tokenize each text once, add the end id, and cut it.

    One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens`` (and ``ids``), its class ``kind``
    and its ``place`` among the pieces of that class in its task. A null or empty text is one end id;
    repeated rows are cut each.
    """
    docs = with_unique_names(documents, doc_id=id_column, text=text_column)
    doc_kind = dict(docs.dtypes)["doc_id"]

    def cut_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen, task = shared_encoder(tokenizer, keeps_space=False), defaultdict(int), TaskContext.get().partitionId()
        for chunk in text_chunks(batches, max_bytes=CHUNK_BYTES):
            at, rows, pieces = [], [], []
            for i, found in enumerate(encoder.encode_column(chunk.column("text"))):
                ids = np.append(found, np.uint32(end_id)).astype("<u4")
                start = 0
                for length, kind in cuts(len(ids), capacity, slack):
                    part = ids[start:start + length]
                    at.append(i)
                    rows.append((start, length, zlib.crc32(part), len(ids), kind, seen[kind]))
                    if with_ids:
                        pieces.append(part)
                    seen[kind] += 1
                    start += length
            columns = np.array(rows, np.int64)
            arrays = [chunk.column("doc_id").take(pa.array(at)), *[pa.array(columns[:, c]) for c in range(6)],
                      pa.array(np.full(len(rows), task, np.int64))]
            if with_ids:
                arrays.append(pa.array(pieces, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(arrays, names=[
                "doc_id", "start", "length", "ids_crc32", "doc_tokens", "kind", "place", "task"] + ["ids"] * with_ids)

    schema = f"doc_id {doc_kind}, start long, length long, ids_crc32 long, doc_tokens long, kind long, place long, task long"
    return docs.mapInArrow(releasing(cut_all), schema + (", ids array<long>" if with_ids else ""))


def first_fit(bins: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Put bins of given ``total`` into as few as first fit, largest first, gives: ``sequence_id, into, shift``."""
    used: list[list[int]] = []
    rows = []
    for sequence, total in sorted(zip(bins["sequence_id"].tolist(), bins["total"].tolist()), key=lambda b: (-b[1], b[0])):
        room = next((u for u in used if u[1] + total <= capacity), None)
        if room is None:
            room = [sequence, 0]
            used.append(room)
        rows.append((sequence, room[0], room[1]))
        room[1] += total
    return pd.DataFrame(rows, columns=["sequence_id", "into", "shift"])


def fill_bins(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give every piece its ``sequence_id`` and its ``offset`` there.

    Tasks number their pieces per class by themselves. The counts per (class, task), a small table,
    are summed up so that the last, unfilled bin of one task goes on with the first pieces of the
    next: per class one bin at most stays unfilled, however many workers there are. These few bins
    (a class has a bin of its own, so their number is bounded by the capacity) are put together by
    first fit. A bin holds at most ``capacity`` pieces, so no task gets a large group.
    """
    stored = settle(pieces, "pieces")
    before = Window.partitionBy("kind").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = stored.groupBy("kind", "task").agg(F.count("*").alias("n")).withColumn(
        "first", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    placed = stored.join(firsts, ["kind", "task"]).withColumn("place", F.col("place") + F.col("first"))
    # Classes are at most the capacity, so they and their bins fit one long.
    placed = placed.withColumn("sequence_id", F.col("kind") * F.lit(1 << 44) + F.floor(F.col("place") / F.col("kind")))
    inside = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    filled = placed.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0))).drop("task", "place", "first")
    unfilled = placed.groupBy("sequence_id", "kind").agg(F.count("*").alias("n"), F.sum("length").alias("total")).filter("n < kind")
    moved = unfilled.withColumn("of", F.lit(0)).groupBy("of").applyInPandas(
        lambda bins: first_fit(bins, capacity), "sequence_id long, into long, shift long")
    return filled.drop("kind").join(settle(moved, "moved"), "sequence_id", "left").withColumn(
        "sequence_id", F.coalesce("into", "sequence_id")).withColumn(
        "offset", F.col("offset") + F.coalesce("shift", F.lit(0))).drop("into", "shift")


def pack(documents: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Pack documents into sequences of at most ``capacity`` tokens; see ``document_pieces`` for the options.

    Returns one row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``
    (and ``ids`` on demand). Every id lies in one piece; offsets of a sequence run without gaps from 0.
    """
    return fill_bins(document_pieces(documents, tokenizer, **options), options.get("capacity", CAPACITY))


def sequences(packed: DataFrame) -> DataFrame:
    """The packed token ids ``(sequence_id, ids)`` of pieces that carry their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
