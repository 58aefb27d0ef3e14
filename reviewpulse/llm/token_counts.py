"""Token counts per document without tokenizing documents: pieces are counted once per distinct pre-token."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import settle
from .common import RowIds, text_chunks, with_unique_names
from .lookup import count_terms, frequent_terms

# The piece alphabet writes a space as U+2581, and no piece has one after another character.
PRE_TOKEN = re.compile("[ ▁]+[^ ▁]*")


def pre_tokens(text: str | None) -> list[str]:
    """Runs of spaces with the characters that follow; the encoder puts one space before a text."""
    return PRE_TOKEN.findall(" " + text) if text else []


def piece_counts(terms: DataFrame, model: str) -> DataFrame:
    """Add ``pieces``, the library's count for each distinct pre-token."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        encoder = sentencepiece.SentencePieceProcessor(model_file=model)
        for batch in batches:
            # The encoder adds the first space by itself, but nothing to an empty text: a lone space, which only
            # ends texts, has one piece.
            terms = batch.column("term").to_pylist()
            ids = encoder.encode([t[1:] for t in terms], num_threads=1)
            sizes = [len(i) if len(t) > 1 else 1 for i, t in zip(ids, terms)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("term"), batch.column("n"), pa.array(sizes, pa.int64())], names=["term", "n", "pieces"])

    return terms.select("term", "n").mapInArrow(count, "term string, n long, pieces long")


def token_counts(documents: DataFrame, model: str, limit: int = 4096, id_column: str = "doc_id",
                 text_column: str = "text") -> DataFrame:
    """Tokens of each whole text under a SentencePiece model.

    Returns ``doc_id, n_bytes, n_tokens, over_limit`` and one row per input row: repeated rows are
    counted each, a null id stays null, a null or empty text has 0 bytes and 0 tokens. ``model`` must
    be readable on every worker. Exact because merges never join a character with a space behind it,
    so a text has the pieces of its pre-tokens.
    """
    docs = with_unique_names(documents, doc_id=id_column, text=text_column)
    kind = dict(docs.dtypes)["doc_id"]
    pieces = settle(piece_counts(count_terms(docs, pre_tokens), model), "pieces")
    known = frequent_terms(pieces).select("term", "pieces").toArrow()
    shared = docs.sparkSession.sparkContext.broadcast(
        dict(zip(known.column("term").to_pylist(), known.column("pieces").to_pylist())))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, rows = shared.value.get, RowIds()
        for chunk in text_chunks(batches):
            ids = rows.take(chunk.num_rows)
            at, size, base, term, n = [], [], [], [], []
            for i, text in enumerate(chunk.column("text").to_pylist()):
                found = pre_tokens(text)
                counts = list(map(get, found))
                rare = Counter(t for t, c in zip(found, counts) if c is None) if None in counts else {}
                at += [i] * max(1, len(rare))
                size += [len(text.encode()) if text else 0] + [0] * (len(rare) - 1)
                base += [sum(filter(None, counts))] + [0] * (len(rare) - 1)
                # A term that cannot match, own to the row: no task gets all rows without rare terms.
                term += rare.keys() if rare else [f"\x00{ids[i]}"]
                n += rare.values() if rare else [0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[at]), chunk.column("doc_id").take(pa.array(at)), pa.array(size, pa.int64()),
                 pa.array(base, pa.int64()), pa.array(term, pa.string()), pa.array(n, pa.int64())],
                names=["row_id", "doc_id", "n_bytes", "base", "term", "n"])

    rows = docs.mapInArrow(look_up, f"row_id long, doc_id {kind}, n_bytes long, base long, term string, n long")
    joined = rows.join(pieces.select("term", "pieces"), "term", "left")
    total = F.sum(F.col("base") + F.col("n") * F.coalesce("pieces", F.lit(0)))
    return joined.groupBy("row_id").agg(
        F.max("doc_id").alias("doc_id"), F.sum("n_bytes").alias("n_bytes"), total.alias("n_tokens"),
    ).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
