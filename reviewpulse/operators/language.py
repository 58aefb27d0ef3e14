"""Language detection: naive Bayes over character n-grams, trained as Spark aggregates and scored inside each row.

The gram table is sent to the tasks where its measured size allows that, and a row needs no other row; a larger table is
joined. Spark looks up a map's keys one after another, so the rows are scored in Arrow batches. Scores are sums of whole numbers (scaled log probabilities), so the result does not depend on the
order in which partial sums meet, and a recomputed task gives the same answer.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..sources.shared import settle

SCALE = 10_000
# Bound of a gram table that is sent to the tasks, in bytes of grams and scores; it has up to three letters per gram.
MODEL_BYTES = 64 << 20
# Words whose scores ``WordScores`` remembers before it forgets them.
HELD_WORDS = 200_000
# Grams that a task of training holds before it sends them.
HELD_GRAMS = 500_000
# Characters whose grams are looked up at once, and keys of a table that is looked up by place; larger ones by search.
BATCH_CHARS, DENSE_KEYS = 1 << 18, 1 << 21
# Runs of letters, whole, however long.
WORD_PATTERN = r"\p{L}+"


@dataclass(frozen=True)
class LanguageModel:
    """Score table (gram, array of one score per language) and the languages in that order.

    Grams have up to three characters, so the table grows with alphabets, not with text. It is
    stored, and Spark chooses the join by its size.
    """

    languages: list[str]
    scores: DataFrame


def _slices(word: Column, size: int) -> Column:
    last = F.length(word) - (size - 1)
    return F.when(last >= 1, F.transform(F.sequence(F.lit(1), last), lambda i: F.substr(word, i, F.lit(size)))) \
        .otherwise(F.array().cast("array<string>"))


def grams(word: Column) -> Column:
    """Single letters of a word plus pairs and triples of the word between blanks."""
    padded = F.concat(F.lit(" "), word, F.lit(" "))
    return F.concat(_slices(word, 1), _slices(padded, 2), _slices(padded, 3))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0))


def train(df: DataFrame, text: str, lang: str) -> LanguageModel:
    """Learn the frequencies of all grams per language from labelled text.

    A task counts the grams of its texts a batch at a time and sends each gram of a language with its number.
    """
    labelled = df.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.lower(text).alias("text"))
    gram_counts = labelled.mapInArrow(_count_grams, "lang string, gram string, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    gram_counts = settle(gram_counts, "gram-counts")
    sums = gram_counts.groupBy("lang").agg(F.sum("n").alias("total")).orderBy("lang").collect()
    if not sums:
        raise ValueError("no labelled text")
    size = gram_counts.select("gram").distinct().count()

    def score(row):
        n = F.coalesce(F.sum(F.when(F.col("lang") == row["lang"], F.col("n"))), F.lit(0))
        return F.round(F.ln((n + 1) / F.lit(float(row["total"] + size))) * SCALE).cast("bigint")

    table = gram_counts.groupBy("gram").agg(F.array(*[score(row) for row in sums]).alias("scores"))
    return LanguageModel([row["lang"] for row in sums], settle(table, "language-model"))


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of the texts of a task; more than ``HELD_GRAMS`` are sent on the way."""
    held: dict[str, Counter] = defaultdict(Counter)

    def sent() -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            if counts:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(counts), pa.string()), pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                    names=["lang", "gram", "n"])
        held.clear()

    for batch in batches:
        texts = defaultdict(list)
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            texts[lang].append(text)
        for lang, own in texts.items():
            for some in in_batches(own):
                for grams_ in text_grams(some):
                    held[lang].update(grams_)
        if sum(map(len, held.values())) > HELD_GRAMS:
            yield from sent()
    yield from sent()


def in_batches(texts: list[str]) -> Iterator[list[str]]:
    """Texts in groups of about ``BATCH_CHARS`` characters; a longer text stays whole."""
    ends = np.cumsum([len(t) for t in texts])
    cuts = [0, *(np.flatnonzero(np.diff(ends // BATCH_CHARS)) + 1).tolist(), len(texts)]
    return (texts[a:b] for a, b in pairwise(cuts) if b > a)


def text_grams(texts: list[str]) -> Iterator[dict[str, int]]:
    """The grams of all words of some texts with their numbers, one size after another; see ``GramSums``."""
    codes = np.frombuffer(("\n" + "\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), "<u4")
    codes = np.where(_letters()[codes] > 0, codes, np.uint32(ord(" ")))
    there = np.flatnonzero(np.bincount(codes))
    number = np.zeros(int(there[-1]) + 1, np.int64)
    # The blank is number 0: no letter comes before it.
    number[there] = np.arange(len(there))
    ids, base, signs = number[codes], len(there), list(map(chr, there.tolist()))
    own, after, before = ids[1:-1], ids[2:], ids[:-2]
    letter = own > 0
    pairs = ids[:-1] * base + ids[1:]
    for size, keys in ((1, own[letter]), (2, pairs[pairs > 0]), (3, (before * base ** 2 + own * base + after)[letter])):
        if base ** size <= DENSE_KEYS:
            counts = np.bincount(keys)
            kinds = np.flatnonzero(counts)
            counts = counts[kinds]
        else:
            kinds, counts = np.unique(keys, return_counts=True)
        places = [(kinds // base ** i % base).tolist() for i in reversed(range(size))]
        yield dict(zip(("".join([signs[p] for p in place]) for place in zip(*places)), counts.tolist()))


def detect(df: DataFrame, model: LanguageModel, text: str = "content_clean", row_id: str = "ingest_seq",
           model_bytes: int = MODEL_BYTES) -> DataFrame:
    """(row id, found_lang) for every row with a known gram in a text that is not short. Ties go to the first language by name.

    Both ways give the same rows: inside each row if the gram table has at most ``model_bytes``, else by joins.
    """
    each = 8 * len(model.languages)
    size = model.scores.agg(F.sum(F.octet_length("gram") + each)).first()[0] or 0
    long = df.filter(F.length(text) >= V.SHORT_TEXT_LEN)
    return _detect_in_rows(long, model, text, row_id) if size <= model_bytes else _detect_by_joins(long, model, text, row_id)


class WordScores(dict):
    """Word -> row of ``table``: its scores per language and how many of its grams are known; summed once per word.

    The plain form of ``GramSums``, one word after another.
    """

    def __init__(self, grams_: dict[str, int], scores: np.ndarray) -> None:
        self.grams, self.scores = grams_, scores
        self.table = np.zeros((1024, scores.shape[1] + 1), np.int64)

    def __missing__(self, word: str) -> int:
        padded = f" {word} "
        cut = [*word, *(padded[i:i + 2] for i in range(len(word) + 1)), *(padded[i:i + 3] for i in range(len(word)))]
        known = [i for i in map(self.grams.get, cut) if i is not None]
        at = len(self)
        if at == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[at, :-1] = self.scores[known].sum(axis=0) if known else 0
        self.table[at, -1] = len(known)
        self[word] = at
        return at

    def best(self, words: list[str]) -> int | None:
        """Place of the language with the greatest sum, None without a known gram."""
        if len(self) > HELD_WORDS:
            self.clear()
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        sums = self.table[at].sum(axis=0)
        return int(sums[:-1].argmax()) if sums[-1] else None


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Per code point 1 for a letter as ``WORD_PATTERN`` has it, else 0."""
    points = np.zeros(0x110000, np.int32)
    text = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    points[[ord(c) for c in regex.findall(r"\p{L}", text)]] = 1
    return points


class GramSums:
    """Sums of gram scores of whole texts, a batch of texts at once.

    Letters have numbers, all else is the blank 0. A letter gives itself and the triple around it, two neighbours that
    are not both blanks give a pair; these are the grams of the words between blanks, whatever separates them.
    """

    def __init__(self, grams_: list[str], scores: np.ndarray) -> None:
        self.points = _letters().copy()
        letters = [c for c in sorted(set("".join(grams_))) if self.points[ord(c)]]
        self.points[[ord(c) for c in letters]] = np.arange(2, len(letters) + 2)
        self.base = len(letters) + 2
        number = {" ": 0, **{c: i + 2 for i, c in enumerate(letters)}}
        # The last row is that of an unknown gram; the last column counts known ones.
        self.scores = np.zeros((scores.shape[1] + 1, len(grams_) + 1), np.int64)
        self.scores[:-1, :-1], self.scores[-1, :-1] = scores.T, 1
        held: list[dict[int, int]] = [{}, {}, {}]
        for row, gram in enumerate(grams_):
            # Words are letters only: no blank alone, in the middle, or beside another.
            whole = gram.strip(" ")
            if 0 < len(gram) <= 3 and whole and " " not in whole and (len(gram) < 3 or gram[1] != " ") and all(c in number for c in gram):
                key = 0
                for c in gram:
                    key = key * self.base + number[c]
                held[len(gram) - 1][key] = row
        self.tables = [self._table(h, self.base ** (i + 1)) for i, h in enumerate(held)]

    @staticmethod
    def _table(held: dict[int, int], keys: int) -> tuple[np.ndarray | None, np.ndarray]:
        known = np.array(sorted(held), np.int64)
        rows = np.array([held[k] for k in known.tolist()], np.int32)
        if keys > DENSE_KEYS:
            return known, rows
        dense = np.full(keys, -1, np.int32)
        dense[known] = rows
        return None, dense

    def rows(self, size: int, keys: np.ndarray) -> np.ndarray:
        """Row of each gram of a size, -1 for an unknown one."""
        known, rows = self.tables[size - 1]
        if known is None:
            return rows[keys]
        if not len(known):
            return np.full(len(keys), -1, np.int32)
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return np.where(known[at] == keys, rows[at], np.int32(-1))

    def best(self, texts: list[str]) -> list[int | None]:
        """Place of the language with the greatest sum for each text, None without a known gram."""
        out: list[int | None] = []
        for some in in_batches(texts):
            sums = self._sums(some)
            out += [int(p) if n else None for p, n in zip(sums[:-1].argmax(axis=0), sums[-1])]
        return out

    def _sums(self, texts: list[str]) -> np.ndarray:
        """Per language, and for the number of known grams, one sum a text."""
        # Each text with the separator before it is a part; it is never empty.
        starts = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
        codes = np.frombuffer(("\n" + "\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), "<u4")
        ids = self.points[codes].astype(np.int64)
        own, after = ids[:-1], ids[1:]
        before = np.concatenate([ids[:1], ids[:-2]])
        pair = own * self.base + after
        found = [self.rows(1, own), self.rows(2, pair), self.rows(3, before * self.base ** 2 + pair)]
        return np.stack([np.add.reduceat(sum(column[f] for f in found), starts) for column in self.scores])


def _detect_in_rows(df: DataFrame, model: LanguageModel, text: str, row_id: str) -> DataFrame:
    rows = model.scores.select("gram", "scores").toArrow()
    names = rows.column("gram").to_pylist()
    scores = np.array(rows.column("scores").to_pylist(), np.int64).reshape(len(names), len(model.languages))
    shared = df.sparkSession.sparkContext.broadcast((names, scores, model.languages))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names_, table, languages = shared.value
        sums = GramSums(names_, table)
        for batch in batches:
            places = sums.best(batch.column("text").to_pylist())
            found = pa.array([None if p is None else languages[p] for p in places], pa.string())
            out = pa.RecordBatch.from_arrays([batch.column("row_id"), found], names=["row_id", "found_lang"])
            yield out.filter(found.is_valid())

    kind = dict(df.select(F.col(row_id).alias("row_id")).dtypes)["row_id"]
    texts = df.select(F.col(row_id).alias("row_id"), F.col(text).alias("text"))
    return texts.mapInArrow(find, f"row_id {kind}, found_lang string").withColumnRenamed("row_id", row_id)


def _detect_by_joins(df: DataFrame, model: LanguageModel, text: str, row_id: str) -> DataFrame:
    """For a gram table of any size: words are counted per row, and every distinct word of the corpus is scored once. Row ids, words
    and whole numbers are all that is shuffled; no text is.
    """
    each = range(len(model.languages))

    def summed(times):
        return F.array(*[F.sum(F.col("scores")[i] * times) for i in each]).alias("scores")

    used = settle(
        df.select(row_id, F.explode(words_of(F.col(text))).alias("word"))
        .groupBy(row_id, "word").agg(F.count("*").alias("n")), "words")
    cut = used.select("word").distinct().select("word", F.explode(grams(F.col("word"))).alias("gram"))
    scored = settle(cut.join(model.scores, "gram").groupBy("word").agg(summed(F.lit(1))), "word-scores")
    sums = used.join(scored, "word").groupBy(row_id).agg(summed(F.col("n")))
    place = F.array_position("scores", F.array_max("scores")).cast("int")
    return sums.select(row_id, F.element_at(F.array(*[F.lit(c) for c in model.languages]), place).alias("found_lang"))


def with_detected_language(df: DataFrame, model: LanguageModel, text: str = "content_clean",
                           row_id: str = "ingest_seq") -> DataFrame:
    """Attach ``detected_lang`` and ``is_en``; row ids are unique, so the join has no hot key.

    What was found is stored without the texts, so each text is scored once, whatever reads the rows afterwards.
    """
    found = settle(detect(df, model, text, row_id), "found-languages")
    return (
        df.join(found, row_id, "left")
        .withColumn("detected_lang", F.coalesce("found_lang", F.lit(V.UNKNOWN_LANGUAGE)))
        .withColumn("is_en", F.col("detected_lang") == "en").drop("found_lang")
    )
