"""Toxicity of whole texts: boosted trees over dense features, calibrated by isotonic regression.

Nothing about toxic language is built in but pronouns of address: the lexicon is learned from labelled rows as terms (whole
words and beginnings of words) that occur in many more toxic than clean documents. Densities of its terms, how close
they stand to words of address, and how a text is written (capitals, punctuation, disguised words) are the features.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import settle
from .common import as_strings, text_chunks, with_unique_names

# Bound of the labelled rows that the classifier is fitted on, drawn by a hash of id and text; all rows are scored.
TRAIN_ROWS = 30_000
# Parts of the sample; the features of a part come from the lexicon of all others.
FOLDS = 4
# Every so many labelled rows one is kept from the trees and calibrates their margins.
CALIBRATION = 4
# Bound of the learned lexicon; it is sent to the workers (about 20 bytes a term).
LEXICON_TERMS = 4096
# Bound of the terms that are counted among clean documents: the most frequent ones of the toxic ones.
CANDIDATES = 1 << 18
# A term needs so many toxic documents and this many standard errors between its log odds and none.
LEAST_DOCUMENTS, LEAST_ERRORS = 3, 3.0
# Log odds from which a term counts as strong, and those from which it counts at all.
STRONG, MILD = 3.5, 1.0
# Beginnings of words that are terms, for languages that compose or inflect.
STEMS = range(4, 9)
# Words within this distance of a word of address count as addressed to somebody.
NEAR = 6
TREES, DEPTH, STEP = 24, 4, 0.25
# Distinct words a task remembers before it forgets them, also counted terms it holds before it passes them on; distinct
# tokens whose terms it remembers while it counts.
HELD_WORDS = 200_000
HELD_TOKENS = 50_000

# Pronouns of the second person (English, German, French, Spanish).
ADDRESS = frozenset(
    "you your yours yourself u ur ya du dich dir dein deine euch ihr tu te toi ton ta tes vous votre vos usted ustedes "
    "ti tus vosotros os".split())
# Signs that stand for letters in disguised words.
LOOKALIKES = str.maketrans("013457@$!|€", "oieastasiie")

LEADING = re.compile(r"[$@][^\W\d_]")
EDGES = re.compile(r"^[\W_]+|[\W_]+$")
INNER = re.compile(r"[\W_]+")
STRETCHED = re.compile(r"(.)\1{2,}")
SHOUT = re.compile(r"[!?]{2,}|([^\w\s])\1+")

FEATURES = [
    "strong_density", "strong_words", "strong_kinds", "mild_density", "mild_kinds", "greatest_odds", "odds_per_kind",
    "address_density", "addressed_share", "capital_share", "shouted_share", "mark_share", "repeated_marks",
    "disguised_share", "stretched_share", "digit_share", "log_words", "kinds_share", "mean_length",
]


def plain_word(token: str) -> tuple[str, bool]:
    """A token in lower case without outer marks, read through its disguise, and whether it had one.

    Letters replaced by signs or digits, marks between letters and letters written three times or more are undone; a
    token without letters, or with more signs than letters, stays as it is.
    """
    core = EDGES.sub("", token).lower()
    if core.isalpha() and not STRETCHED.search(core) and not LEADING.match(token):
        return core, False
    letters = sum(c.isalpha() for c in token)
    if letters < 2 or 2 * letters < len(token.strip(".,;:!?\"'()")):
        return core, False
    read = STRETCHED.sub(r"\1", INNER.sub("", token.strip(".,;:!?\"'()").lower().translate(LOOKALIKES)))
    return read, read != core


def terms_of(word: str) -> list[str]:
    """The word itself and its beginnings, which end in a mark that no word holds."""
    return [word, *[word[:n] + "~" for n in STEMS if n < len(word)]]


# ---- lexicon ---------------------------------------------------------------------------------

def term_documents(rows: DataFrame, name: str, only: list[str] | None = None) -> DataFrame:
    """Documents per term and fold over ``rows(text, fold)`` as ``term, name0, name1, ...``, all terms or only some.

    Counted per task first.
    """
    names = [f"{name}{fold}" for fold in range(FOLDS)]
    shared = rows.sparkSession.sparkContext.broadcast(None if only is None else frozenset(only))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        held: list[Counter] = [Counter() for _ in names]
        known: dict[str, list[str]] = {}
        for chunk in text_chunks(batches, max_bytes=2 << 20):
            for text, fold in zip(chunk.column("text").to_pylist(), chunk.column("fold").to_pylist()):
                own = set((text or "").split())
                if len(known) > HELD_TOKENS:
                    known.clear()
                for token in own.difference(known):
                    word = plain_word(token)[0]
                    listed = terms_of(word) if word else []
                    known[token] = listed if wanted is None else [t for t in listed if t in wanted]
                held[fold].update(set().union(*map(known.__getitem__, own)))
            if sum(map(len, held)) > HELD_WORDS:
                yield emit(held)
                held = [Counter() for _ in names]
        yield emit(held)

    def emit(held: list[Counter]) -> pa.RecordBatch:
        terms = list(set().union(*held))
        counts = [pa.array([c[t] for t in terms], pa.int64()) for c in held]
        return pa.RecordBatch.from_arrays([as_strings(terms), *counts], names=["term", *names])

    partial = rows.select("text", "fold").mapInArrow(count, "term string, " + ", ".join(f"{c} long" for c in names))
    return partial.groupBy("term").agg(*[F.sum(c).alias(c) for c in names])


def term_counts(sample: DataFrame) -> DataFrame:
    """Clean and toxic documents per fold of every term with enough toxic documents, at most ``CANDIDATES`` of them.

    Most words never occur in a toxic document; they are not counted among the clean ones.
    """
    total = sum((F.col(f"toxic{f}") for f in range(FOLDS)), F.lit(0))
    toxic = term_documents(sample.filter("toxic = 1"), "toxic").filter(total >= LEAST_DOCUMENTS)
    toxic = settle(toxic.orderBy(F.desc(total), "term").limit(CANDIDATES), "toxic-terms")
    clean = term_documents(sample.filter("toxic = 0"), "clean", toxic.select("term").toArrow().column(0).to_pylist())
    return settle(toxic.join(clean, "term", "left").na.fill(0), "term-counts")


def lexicon(counts: DataFrame, sizes: dict[tuple[int, int], int], folds: list[int]) -> dict[str, float]:
    """Terms and log odds in some folds, the surest ``LEXICON_TERMS`` of those that mark toxic documents."""
    n_clean, n_toxic = (sum(sizes.get((f, y), 0) for f in folds) for y in (0, 1))
    clean, toxic = (sum((F.col(f"{kind}{f}") for f in folds), F.lit(0)) for kind in ("clean", "toxic"))
    a, b = toxic + 0.5, clean + 0.5
    odds = F.ln(a / (n_toxic + 1)) - F.ln(b / (n_clean + 1))
    sure = odds / F.sqrt(1 / a + 1 / b)
    chosen = (
        counts.filter(toxic >= LEAST_DOCUMENTS).select("term", odds.alias("odds"), sure.alias("sure"))
        .filter((F.col("odds") >= MILD) & (F.col("sure") >= LEAST_ERRORS))
        .orderBy(F.desc("sure"), "term").limit(LEXICON_TERMS)
    )
    return {r.term: r.odds for r in chosen.collect()}


# ---- features --------------------------------------------------------------------------------

class Words(dict):
    """Token -> row of ``facts``; looked up once per distinct token, and equal facts share a row.

    A row holds log odds, address, disguised, shouted, capital, stretched, and the number of the word if its odds count.
    """

    def __init__(self, odds: dict[str, float]) -> None:
        self.odds, self.heads = odds, {t[:min(STEMS)].rstrip("~") for t in odds}
        self.start()

    def start(self) -> None:
        self.clear()
        self.row: dict[tuple, int] = {}
        self.word: dict[str, int] = {}
        self.facts = np.zeros((64, 7))

    def __missing__(self, token: str) -> int:
        word = token.lower()
        stretched = STRETCHED.search(word) is not None
        hidden = False
        if stretched or not word.isalpha():
            word, hidden = plain_word(token)
        best = 0.0
        if word[:min(STEMS)] in self.heads:
            best = max(self.odds.get(t, 0.0) for t in terms_of(word))
        facts = (best, word in ADDRESS, hidden, len(word) > 1 and token.isupper(), token[:1].isupper(), stretched,
                 self.word.setdefault(word, len(self.word)) if best >= MILD else -1)
        at = self.row.get(facts)
        if at is None:
            at = self.row[facts] = len(self.row)
            if at == len(self.facts):
                self.facts = np.concatenate([self.facts, np.zeros_like(self.facts)])
            self.facts[at] = facts
        self[token] = at
        return at

    def look_up(self, tokens: list[str]) -> np.ndarray:
        """The facts of each token."""
        if len(self) > HELD_WORDS:
            self.start()
        rows = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        return self.facts[rows]


def text_features(text: str | None, words: Words) -> list[float]:
    """The dense features of one text; an empty text has zeros."""
    tokens = text.split() if text else []
    n = len(tokens)
    if not n:
        return [0.0] * len(FEATURES)
    distinct = set(tokens)
    facts = words.look_up(tokens)
    best, address = facts[:, 0], np.flatnonzero(facts[:, 1])
    strong, mild = np.flatnonzero(best >= STRONG), np.flatnonzero(best >= MILD)
    _, first = np.unique(facts[mild, 6], return_index=True)
    odds = best[mild][first]
    near = 0.0
    if len(strong) and len(address):
        right = np.searchsorted(address, strong)
        gap = np.minimum(np.abs(address[np.minimum(right, len(address) - 1)] - strong), np.abs(strong - address[np.maximum(right - 1, 0)]))
        near = float((gap <= NEAR).mean())
    _, _, disguised, shouted, capitals, stretched = facts[:, :6].sum(axis=0).tolist()
    size = len(text)
    marks = sum(map(text.count, "!?*#$%&@|"))
    digits = sum(map(text.count, "0123456789"))
    return [
        len(strong) / n, math.log1p(len(strong)), float((odds >= STRONG).sum()), len(mild) / n, float(len(odds)),
        float(odds.max(initial=0.0)), float(odds.sum()) / len(distinct), len(address) / n, near, capitals / n, shouted / n,
        marks / size, len(SHOUT.findall(text)) / n, disguised / n, stretched / n, digits / size, math.log1p(n),
        len(distinct) / n, size / n,
    ]


def with_features(rows: DataFrame, lexicons: list[dict[str, float]], keep: dict[str, str]) -> DataFrame:
    """Columns ``keep`` (name -> type) and one array of features; column ``fold`` chooses among several lexicons."""
    shared = rows.sparkSession.sparkContext.broadcast(lexicons)

    def derive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [Words(odds) for odds in shared.value]
        for chunk in text_chunks(batches, max_bytes=2 << 20):
            folds = chunk.column("fold").to_pylist() if len(known) > 1 else [0] * chunk.num_rows
            found = [text_features(text, known[fold]) for text, fold in zip(chunk.column("text").to_pylist(), folds)]
            yield pa.RecordBatch.from_arrays(
                [*[chunk.column(c) for c in keep], pa.array(found, pa.list_(pa.float64()))], names=[*keep, "features"])

    layout = ", ".join(f"{c} {t}" for c, t in keep.items())
    return rows.mapInArrow(derive, f"{layout}, features array<double>")


def _vectors(rows: DataFrame) -> DataFrame:
    flat = rows.select("*", *[F.col("features")[i].alias(name) for i, name in enumerate(FEATURES)]).drop("features")
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(flat).drop(*FEATURES)


# ---- model -----------------------------------------------------------------------------------

@dataclass(frozen=True)
class ToxicityModel:
    """Lexicon, trees and calibration; without both classes in the labels only their share."""

    odds: dict[str, float]
    share: float
    trees: GBTClassificationModel | None = None
    calibration: IsotonicRegressionModel | None = None


def labelled_sample(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``text, toxic, fold, held`` of at most about ``TRAIN_ROWS`` labelled rows of ``rows(doc_id, text)``.

    ``labels(doc_id, toxic)`` are those to learn from; a null label is none, and of several for an id the greatest
    counts. Labels are drawn before the texts are joined to them, so that no more than the sample is shuffled. Equal
    texts with equal labels count once, so that a large group of copies does not make all its words a lexicon.
    """
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(
        F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    total = known.count()
    share = min(1.0, TRAIN_ROWS / max(total, 1))
    drawn = settle(known.filter(F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1 << 20)) < int(share * (1 << 20))), "labels")
    joined = rows.join(drawn, "doc_id").select("text", "toxic").filter("text IS NOT NULL")
    key = F.xxhash64("text")
    once = joined.groupBy(key.alias("k"), "toxic").agg(F.first("text").alias("text"))
    number = F.pmod(F.xxhash64("k", F.lit(1)), F.lit(1 << 20))
    return settle(once.select(
        "text", "toxic", (number % FOLDS).cast("int").alias("fold"), (F.floor(number / FOLDS) % CALIBRATION == 0).alias("held")),
        "labelled")


def train(rows: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
          label_column: str = "toxic") -> ToxicityModel:
    """Fit lexicon, trees and calibration on a bounded sample of labelled rows.

    The features that the trees see come from the lexicon of the other folds of the sample, so a term's weight is
    never learned from the row it is used on. Rows of one class only give a model that scores their share.
    """
    docs = with_unique_names(rows, doc_id=id_column, text=text_column)
    marks = with_unique_names(labels, doc_id=id_column, toxic=label_column)
    sample = labelled_sample(docs, marks)
    sizes = {(r.fold, r.toxic): r["count"] for r in sample.groupBy("fold", "toxic").count().collect()}
    clean, toxic = (sum(n for (_, y), n in sizes.items() if y == kind) for kind in (0, 1))
    share = (toxic + 0.5) / (clean + toxic + 1) if clean + toxic else 0.0
    if not clean or not toxic:
        return ToxicityModel({}, share)

    counts = term_counts(sample)
    everything = lexicon(counts, sizes, list(range(FOLDS)))
    crossed = [lexicon(counts, sizes, [f for f in range(FOLDS) if f != fold]) for fold in range(FOLDS)]
    described = settle(with_features(sample, crossed, {"toxic": "int", "held": "boolean"}), "toxic-features")
    vectors = _vectors(described).withColumn("weight", F.when(F.col("toxic") == 1, 0.5 / toxic).otherwise(0.5 / clean) * (clean + toxic))
    to_trees = vectors.filter("NOT held").coalesce(8)
    if to_trees.agg(F.count_distinct("toxic")).first()[0] < 2:
        to_trees = vectors.coalesce(8)
    trees = GBTClassifier(featuresCol="features", labelCol="toxic", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP,
                          maxBins=64, minInstancesPerNode=5, seed=7).fit(to_trees)
    held = vectors.filter("held").coalesce(8)
    if held.agg(F.count_distinct("toxic")).first()[0] < 2:
        held = vectors.coalesce(8)
    margins = settle(margin(trees, held).select("toxic", "margin"), "toxic-margins")
    calibration = IsotonicRegression(featuresCol="margin", labelCol="toxic").fit(margins.withColumn("toxic", F.col("toxic").cast("double")))
    return ToxicityModel(everything, share, trees, calibration)


def margin(trees: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    return trees.transform(rows).withColumn("margin", vector_to_array("rawPrediction")[1]).drop("rawPrediction", "probability", "prediction")


def score(rows: DataFrame, model: ToxicityModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, score`` (0 to 1) for every whole text; only the text decides.

    One row per input row: ids may be null or repeat, a null text counts as empty, an empty text has zero features.
    Equal texts have equal scores. Other columns are ignored, whatever their names.
    """
    docs = with_unique_names(rows, doc_id=id_column, text=text_column)
    kind = dict(docs.dtypes)["doc_id"]
    if model.trees is None:
        return docs.select("doc_id", F.lit(model.share).alias("score"))
    judged = margin(model.trees, _vectors(with_features(docs, [model.odds], {"doc_id": kind})))
    bounded = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score")))
    return model.calibration.setPredictionCol("score").transform(judged).select("doc_id", bounded.alias("score"))


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; a null id is never learned from nor held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def score_documents(documents: DataFrame, labels: DataFrame, limit: float = 0.7) -> DataFrame:
    """The contract's rows: learned without the documents whose remainder is 1, applied to all."""
    model = train(documents, labels.filter(remainder(F.col("doc_id")) != 1))
    held_out = F.coalesce(remainder(F.col("doc_id")) == 1, F.lit(False))
    return score(documents, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= limit).cast("int").alias("predicted"))
