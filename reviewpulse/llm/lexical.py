"""Exact ranked lexical search: document tries whose subtree bounds cut off what cannot reach an item's best list.

Documents keep only the terms that some item asks for. Ordered from the most frequent term on, these vectors share
beginnings, so a block of documents becomes a trie (an FP-tree with single paths folded). Each node knows the greatest
frequency of every term below it and the least length norm; from these follows, item by item, a score that no
document below can exceed. The trie is searched depth first, each branch with the items it can still serve.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import new_path, settle
from .common import text_chunks, with_unique_names

# Results per item.
BEST = 50
# Bound of the items that are searched at once, in bytes of their text; they are sent to the workers.
ITEM_BYTES = 8 << 20
# Documents of one trie, and those of a branch that is not divided further.
TRIE_DOCUMENTS = 16_384
LEAF_DOCUMENTS = 16
# One document of so many is searched first, for limits that the search of all others starts with.
FIRST_SHARE = 8

# A-Z in lower case; other ASCII characters than letters and digits separate terms.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a whole text as UTF-8, with repeats."""
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split() if text else []


def gain(tf: np.ndarray, norm) -> np.ndarray:
    """What a term's weight is multiplied with; grows with the frequency and falls with the norm."""
    return 1_000_000_000 * tf // (1000 * tf + 20 * norm)


# ---- trie ------------------------------------------------------------------------------------

@dataclass
class Node:
    """Documents ``first`` to ``last`` in trie order, which share the first ``depth`` terms of their vectors."""

    first: int
    last: int
    depth: int
    children: list[Node]
    terms: np.ndarray | None = None  # terms below, with their greatest frequencies
    most: np.ndarray | None = None
    norm: int = 0  # least norm below


class Trie:
    """Trie over vectors ``terms[at[i]:at[i+1]]`` (in frequency order) and ``tf``, with subtree maxima and minima."""

    def __init__(self, at: np.ndarray, terms_: np.ndarray, tf: np.ndarray, norms: np.ndarray, width: int) -> None:
        raw = terms_.astype(">u4").tobytes()
        keys = [raw[4 * a:4 * b] for a, b in zip(at, at[1:])]
        self.order = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
        sizes = np.diff(at)[self.order]
        self.at = np.concatenate([[0], np.cumsum(sizes)])
        source = np.repeat(at[:-1][self.order] - self.at[:-1], sizes) + np.arange(self.at[-1])
        self.terms, self.tf, self.norms = terms_[source], tf[source], norms[self.order]
        self.scratch = np.zeros(width, np.int64)
        self.root = self._build()

    def _term(self, place: np.ndarray | int, depth: int):
        """The term at a depth of the documents' vectors, -1 behind their ends."""
        spot = self.at[place] + depth
        return np.where(spot < self.at[place + 1], self.terms[np.minimum(spot, len(self.terms) - 1)], -1)

    def _build(self) -> Node:
        root = Node(0, len(self.norms), 0, [])
        todo, nodes = [root], []
        while todo:
            node = todo.pop()
            nodes.append(node)
            if node.last - node.first <= LEAF_DOCUMENTS:
                continue
            # Documents are sorted, so what the first and the last one share is shared by all between.
            while (t := self._term(node.first, node.depth)) == self._term(node.last - 1, node.depth) and t >= 0:
                node.depth += 1
            branch = self._term(np.arange(node.first, node.last), node.depth)
            edges = [0, *(np.flatnonzero(np.diff(branch)) + 1).tolist(), len(branch)]
            if len(edges) == 2:
                continue  # equal vectors
            start = 0
            for a, b in zip(edges, edges[1:]):
                # Small neighbouring branches are one.
                if b - start > LEAF_DOCUMENTS:
                    if a > start:
                        node.children.append(Node(node.first + start, node.first + a, node.depth, []))
                        start = a
                    if b - start > LEAF_DOCUMENTS:
                        node.children.append(Node(node.first + a, node.first + b, node.depth, []))
                        start = b
            if start < len(branch):
                node.children.append(Node(node.first + start, node.last, node.depth, []))
            todo += node.children
        for node in reversed(nodes):  # children before parents
            if node.children:
                below = np.concatenate([c.terms for c in node.children])
                most = np.concatenate([c.most for c in node.children])
                node.norm = min(c.norm for c in node.children)
            else:
                below, most = (x[self.at[node.first]:self.at[node.last]] for x in (self.terms, self.tf))
                node.norm = int(self.norms[node.first:node.last].min())
            np.maximum.at(self.scratch, below, most)
            node.terms = np.unique(below)
            node.most = self.scratch[node.terms]
            self.scratch[node.terms] = 0
        return root


# ---- search ----------------------------------------------------------------------------------

class Search:
    """The best documents of every item so far, found trie by trie.

    ``start``, ``terms`` and ``weights`` hold the items' terms one after another; ``limits`` are scores that an
    item's last place is known to reach.
    """

    def __init__(self, start: np.ndarray, terms_: np.ndarray, weights: np.ndarray, width: int, limits: np.ndarray) -> None:
        self.start, self.terms, self.weights, self.width = start, terms_, weights, width
        self.limits = np.maximum(limits, 1)
        self.best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * (len(start) - 1)
        self.table = np.zeros(width, np.int64)
        self.sheet = np.zeros((LEAF_DOCUMENTS, width), np.int64)
        self.scored = 0

    def add(self, at: np.ndarray, terms_: np.ndarray, tf: np.ndarray, norms: np.ndarray, places: np.ndarray) -> None:
        """Search one block of documents; ``places`` are their ids by rank (smaller is preferred among equal scores)."""
        if not len(norms):
            return
        trie = Trie(at, terms_, tf, norms, self.width)
        todo = [(trie.root, np.arange(len(self.start) - 1))]
        while todo:
            node, items = todo.pop()
            items = items[self._bounds(node, items) >= self.limits[items]]
            if not len(items):
                continue
            if node.children:
                # The branch with the richest terms first: it raises the limits for the others.
                todo += [(c, items) for c in sorted(node.children, key=lambda c: len(c.terms))]
            else:
                for a in range(node.first, node.last, LEAF_DOCUMENTS):
                    self._leaf(trie, a, min(a + LEAF_DOCUMENTS, node.last), items, places)

    def _entries(self, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the items' terms, and where each item begins among them."""
        sizes = self.start[items + 1] - self.start[items]
        begins = np.cumsum(sizes) - sizes
        return np.repeat(self.start[items] - begins, sizes) + np.arange(sizes.sum()), begins

    def _bounds(self, node: Node, items: np.ndarray) -> np.ndarray:
        entries, begins = self._entries(items)
        self.table[node.terms] = gain(node.most, node.norm)
        out = np.add.reduceat(self.weights[entries] * self.table[self.terms[entries]], begins)
        self.table[node.terms] = 0
        return out

    def _leaf(self, trie: Trie, a: int, b: int, items: np.ndarray, places: np.ndarray) -> None:
        """Exact scores of a few documents."""
        spots = slice(trie.at[a], trie.at[b])
        row = np.repeat(np.arange(b - a), np.diff(trie.at[a:b + 1]))
        norm = trie.norms[a:b][row]
        self.sheet[row, trie.terms[spots]] = gain(trie.tf[spots], norm)
        entries, begins = self._entries(items)
        scores = np.add.reduceat(self.sheet[:b - a][:, self.terms[entries]] * self.weights[entries], begins, axis=1)
        self.sheet[row, trie.terms[spots]] = 0
        self.scored += scores.size
        reached = scores >= self.limits[items]
        for i in np.flatnonzero(reached.any(axis=0)).tolist():
            self._keep(int(items[i]), scores[reached[:, i], i], places[trie.order[a:b][reached[:, i]]])

    def _keep(self, item: int, scores: np.ndarray, places: np.ndarray) -> None:
        scores, places = (np.concatenate(x) for x in zip(self.best[item], (scores, places)))
        if len(scores) >= BEST:
            order = np.lexsort((places, -scores))[:BEST]
            scores, places = scores[order], places[order]
            self.limits[item] = max(self.limits[item], int(scores[-1]))
        self.best[item] = scores, places


# ---- the job ---------------------------------------------------------------------------------

def item_blocks(benchmark: DataFrame, id_column: str, text_column: str) -> Iterator[list[tuple[int, object, list[bytes]]]]:
    """Items in blocks of about ``ITEM_BYTES`` of text: (number, id, distinct terms); items without terms are left out."""
    items = settle(with_unique_names(benchmark, item_id=id_column, text=text_column).withColumn(
        "number", F.monotonically_increasing_id()), "items")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // ITEM_BYTES))
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("number"), F.lit(blocks)) == block).toLocalIterator()
        found = [(r.number, r.item_id, sorted(set(terms(r.text)))) for r in rows]
        if found := [f for f in found if f[2]]:
            yield found


def restricted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, ids, tfs, first``: all terms counted, those of the vocabulary listed, one row per document."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = shared.value.get
        for chunk in text_chunks(batches, max_bytes=2 << 20):
            n, at, ids, tfs = [], [0], [], []
            for text in chunk.column("text").to_pylist():
                found = terms(text)
                own = Counter(map(get, found))
                own.pop(None, None)
                n.append(len(found))
                ids += own.keys()
                tfs += own.values()
                at.append(len(ids))
            lists = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(x, pa.int32())) for x in (ids, tfs)]
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), pa.array(n, pa.int64()), *lists], names=["doc_id", "n", "ids", "tfs"])

    kind = dict(docs.dtypes)["doc_id"]
    vectors = docs.mapInArrow(cut, f"doc_id {kind}, n long, ids array<int>, tfs array<int>")
    return vectors.withColumn("first", F.pmod(F.xxhash64("doc_id", "ids", "n"), F.lit(FIRST_SHARE)) == 0)


def searched(vectors: DataFrame, n_documents: int, n_terms: int, rank: np.ndarray, start: np.ndarray, item_terms: np.ndarray,
             weights: np.ndarray, limits: np.ndarray) -> DataFrame:
    """(item, doc_id, score): per task the best documents of each item that reach the item's limit."""
    shared = vectors.sparkSession.sparkContext.broadcast((rank, start, item_terms, weights, limits))
    kind = dict(vectors.dtypes)["doc_id"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, start, item_terms, weights, limits = shared.value
        search = Search(start, item_terms, weights, len(rank), limits.copy())
        ids: list[pa.Array] = []  # of the documents in the lists, so that a place stands for an id
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= TRIE_DOCUMENTS:
                ids = [block(search, held, ids)]
                held, rows = [], 0
        if held:
            ids = [block(search, held, ids)]
        for item, (scores, places) in enumerate(search.best):
            if len(scores):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(scores), item)), ids[0].take(pa.array(places)), pa.array(scores)],
                    names=["item", "doc_id", "score"])

    def block(search: Search, held: list[pa.RecordBatch], kept: list[pa.Array]) -> pa.Array:
        """Search a block. Places are ranks by id among the documents listed so far and the new ones; nulls come last."""
        rank = shared.value[0]
        table = pa.Table.from_batches(held).combine_chunks()
        lists = table.column("ids").combine_chunks()
        at = lists.offsets.to_numpy().astype(np.int64)
        terms_ = rank[lists.flatten().to_numpy()]
        tf = table.column("tfs").combine_chunks().flatten().to_numpy().astype(np.int64)
        at = at - at[0]
        row = np.repeat(np.arange(len(at) - 1), np.diff(at))
        order = np.lexsort((terms_, row))
        terms_, tf = terms_[order], tf[order]
        norms = 50 + 50 * table.column("n").to_numpy() * n_documents // max(n_terms, 1)
        new = table.column("doc_id").combine_chunks()
        listed = [places for _, places in search.best if len(places)]
        old = np.unique(np.concatenate(listed)) if listed else np.zeros(0, np.int64)
        before = kept[0].take(pa.array(old)) if kept else new.slice(0, 0)
        everything = pa.concat_arrays([before, new])
        by_id = pc.array_sort_indices(everything, null_placement="at_end").to_numpy()
        place = np.empty(len(everything), np.int64)
        place[by_id] = np.arange(len(everything))
        search.best = [(s, place[np.searchsorted(old, p)]) for s, p in search.best]
        search.add(at, terms_, tf, norms, place[len(old):])
        return everything.take(pa.array(by_id))

    return vectors.select("doc_id", "n", "ids", "tfs").mapInArrow(find, f"item long, doc_id {kind}, score long")


def top(found: DataFrame) -> DataFrame:
    """The best ``BEST`` rows of each item, with their rank."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= BEST)


def search_block(docs: DataFrame, items: list[tuple[int, object, list[bytes]]]) -> DataFrame:
    """(number, rank, doc_id, score) for one block of items against all documents."""
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*(ts for _, _, ts in items))))}
    path = new_path(spark, "vectors")
    restricted(docs, vocabulary).write.partitionBy("first").parquet(path)
    vectors = spark.read.schema(f"doc_id {dict(docs.dtypes)['doc_id']}, n long, ids array<int>, tfs array<int>, first boolean").parquet(path)
    sums = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0)), F.count_if("first")).first()
    n_documents, n_terms, n_first = sums
    df = np.zeros(len(vocabulary), np.int64)
    for r in vectors.select(F.explode("ids").alias("id")).groupBy("id").count().toLocalIterator():
        df[r["id"]] = r["count"]

    rank = np.empty(len(df), np.int64)
    rank[np.lexsort((np.arange(len(df)), -df))] = np.arange(len(df))
    start = np.concatenate([[0], np.cumsum([len(ts) for _, _, ts in items])]).astype(np.int64)
    ids = np.array([vocabulary[t] for _, _, ts in items for t in ts])
    weight = np.array([math.floor(1000 * math.log((2 * n_documents + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
    common = (n_documents, n_terms, rank, start, rank[ids], weight[ids])

    some = vectors.filter("first AND size(ids) > 0").coalesce(max(1, n_first // TRIE_DOCUMENTS))
    first = settle(top(searched(some, *common, np.zeros(len(items), np.int64))).drop("rank"), "first-best")
    limits = np.zeros(len(items), np.int64)
    for r in first.groupBy("item").agg(F.count("*").alias("n"), F.min("score").alias("least")).filter(F.col("n") == BEST).toLocalIterator():
        limits[r["item"]] = r["least"]
    rest = searched(vectors.filter("NOT first AND size(ids) > 0"), *common, limits)
    numbers = spark.createDataFrame([(i, number) for i, (number, _, _) in enumerate(items)], "item long, number long")
    return top(first.unionByName(rest)).join(numbers, "item").select("number", "rank", "doc_id", "score")


def rank_documents(documents: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                   item_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """Each item's ``BEST`` documents of the highest scores, ``item_id, rank, doc_id, score``.

    Terms are maximal runs of ASCII letters, digits and all characters beyond ASCII, with A-Z in lower case. Each row of ``benchmark``
    is an item of its own, also if ids repeat or are null; items without terms, or whose terms no document holds, have
    no rows. Each row of ``documents`` is ranked by itself; of equal scores the smaller id comes first and a null id
    last. Null and empty texts hold no term. Other columns are ignored, whatever their names. Items are searched in
    blocks of bounded size, documents in tries of a fixed number of rows; a long text has at most as many
    entries as its block of items has terms.
    """
    docs = with_unique_names(documents, doc_id=id_column, text=text_column)
    names = settle(with_unique_names(benchmark, item_id=item_column, text=item_text), "benchmark")
    spark, kind = docs.sparkSession, dict(names.dtypes)["item_id"]
    out = None
    for items in item_blocks(names, "item_id", "text"):
        ids = spark.createDataFrame([(number, item_id) for number, item_id, _ in items], f"number long, item_id {kind}")
        part = search_block(docs, items).join(ids, "number").select("item_id", "rank", "doc_id", "score")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id {dict(docs.dtypes)['doc_id']}, score long")
    return out


_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_FOLDED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = f"""WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all({_FOLDED}, '{_PATTERN}')) AS term FROM documents
), tfs AS (
  SELECT doc_id, term, COUNT(*) AS tf FROM words GROUP BY ALL
), lengths AS (
  SELECT doc_id, SUM(tf) AS n FROM tfs GROUP BY doc_id
), totals AS (
  SELECT COUNT(*)::BIGINT AS docs, SUM(n)::BIGINT AS total FROM lengths
), norms AS (
  SELECT doc_id, 50 + (50 * n::BIGINT * docs) // total AS m FROM lengths, totals
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * COUNT(*) + 1)::DOUBLE))::BIGINT AS w FROM tfs, totals GROUP BY term, docs
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all({_FOLDED}, '{_PATTERN}')) AS term FROM benchmark
), scored AS (
  SELECT item_id, doc_id, SUM(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM asked JOIN tfs USING (term) JOIN weights USING (term) JOIN norms USING (doc_id) GROUP BY ALL
), ranked AS (
  SELECT item_id, ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= {BEST}"""
