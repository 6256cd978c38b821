"""Toxicity score: boosted trees over dense features, calibrated isotonically.

Steps (Spark jobs throughout; the driver holds the lexicon and the trees only):

1. labelled rows are sampled by a hash of their id to at most about
   ``max_rows`` (the documented bound: a third toxic, two thirds clean), with
   weights that restore the class shares, and split into three parts by id;
2. part one teaches a lexicon: words and word beginnings whose document
   frequency is much higher in toxic than in clean texts (at most
   ``max_terms``; exact copies of a text count once), beside a short fixed list for languages without labels;
3. every text becomes a dense vector: lexicon densities, second-person words
   near lexicon hits, capitals, punctuation and obfuscation rates, read over
   the whole text;
4. part two fits ``GBTClassifier``, part three ``IsotonicRegression`` on its
   probability; the calibrated value moves the score, a thousandth of the raw
   probability breaks its ties.

Texts are the only input of a score.  Defined results: null and empty texts are
scored as an empty text; repeated rows get one score each, all alike; labels
that are null are not used, of several labels for an id the largest counts;
without labels of both classes every score is 0.0 (nothing learnt); an empty
table gives an empty result; extra columns are ignored by ``score`` and
returned untouched by ``clean_documents``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialised, prepare_workers

FOLDS = 5
MAX_ROWS = 15_000
MAX_TERMS = 3_000
MIN_LOG_ODDS = 2.5
STEMS = range(4, 8)
#: English insults known without labels; learnt terms come on top.
FIXED_TERMS = ("idiot", "moron", "stupid", "scum", "loser", "pathetic", "worthless", "disgusting")
#: Second-person words of the four languages of the documents.
SECOND_PERSON = re.compile(
    r"\b(?:you|your|yours|you're|youre|u|du|dich|dir|dein\w*|ihr|euch|euer|tu|te|toi|ton|ta|tes|vous|votre|vos"
    r"|tú|ti|tus|usted|ustedes|vosotros|eres)\b")
NEAR = 40
LEET = str.maketrans("0134578@$!|", "oleastbasil")
INSIDE = re.compile(r"[a-z][0-9@$!*|]+[a-z]")
SPACED = re.compile(r"(?<![^\s])[a-z](?:[ .*_-][a-z]){3,}(?![^\s])")
WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")

FEATURES = ("hit_rate", "hits", "distinct_terms", "strongest", "weight_sum", "near_second_person", "capitals",
            "exclamations", "questions", "punctuation", "digits", "symbols", "masked_rate", "masked_hits",
            "spaced_rate", "length")


@dataclass
class Model:
    lexicon: dict[str, float]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; 0 is held out, and so is no null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS, F.lit(1))


def _automaton(lexicon: dict[str, float]) -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for term, weight in lexicon.items():
        machine.add_word(term, (term, weight))
    if lexicon:
        machine.make_automaton()
    return machine


def _hits(low: str, machine: ahocorasick.Automaton) -> list[tuple[int, str, float]]:
    """Lexicon terms that begin a word: (start, term, weight), the longest per start."""
    found: dict[int, tuple[str, float]] = {}
    for end, (term, weight) in machine.iter(low):
        start = end - len(term) + 1
        if (start == 0 or not low[start - 1].isalpha()) and len(term) > len(found.get(start, ("",))[0]):
            found[start] = (term, weight)
    return [(k, *v) for k, v in sorted(found.items())]


def features_of(text: str | None, machine: ahocorasick.Automaton) -> list[float]:
    """The FEATURES of one whole text."""
    text = text or ""
    low = text.lower()
    per = 1000.0 / (len(text) + 100.0)
    hits = _hits(low, machine) if len(machine) else []
    near = sum(1 for start, term, _ in hits
               if SECOND_PERSON.search(low, max(0, start - NEAR), start + len(term) + NEAR))
    masked, masked_hits = 0, 0
    for m in INSIDE.finditer(low):
        masked += 1
        a, b = m.span()
        while a > 0 and not low[a - 1].isspace():
            a -= 1
            if m.start() - a > 30:
                break
        plain = low[a:b + 30].split(None, 1)[0]
        masked_hits += bool(len(machine)) and bool(
            _hits(plain.translate(LEET), machine) or _hits(plain.translate(LEET).replace("*", ""), machine))
    spaced = 0
    for m in SPACED.finditer(low):
        spaced += 1
        masked_hits += bool(len(machine)) and bool(_hits(re.sub(r"[ .*_-]", "", m.group()), machine))
    seen = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8), minlength=256)
    upper, lower = int(seen[65:91].sum()), int(seen[97:123].sum())
    symbols = int(seen[[35, 36, 37, 38, 42, 60, 62, 64, 94, 95, 124, 126]].sum())
    marks = int(seen[[33, 34, 39, 40, 41, 44, 45, 46, 47, 58, 59, 63]].sum())
    return [
        len(hits) * per, math.log1p(len(hits)), float(len({t for _, t, _ in hits})),
        max((w for _, _, w in hits), default=0.0), sum(w for _, _, w in hits) * per, near * per,
        upper / (upper + lower + 1.0), int(seen[33]) * per, int(seen[63]) * per, marks * per,
        int(seen[48:58].sum()) * per, symbols * per, masked * per, float(masked_hits), spaced * per,
        math.log1p(len(text)),
    ]


def features(text: Column, lexicon: dict[str, float]) -> Column:
    """array<double> of FEATURES, computed on Arrow batches."""
    prepare_workers()

    @F.pandas_udf("array<double>")
    def dense(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine = _automaton(lexicon)
        for texts in batches:
            yield pd.Series([features_of(t, machine) for t in texts], dtype=object)

    return dense(text)


def training_rows(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str,
                  max_rows: int) -> DataFrame:
    """(text, toxic, weight, part): the bounded sample of labelled rows outside fold 0."""
    known = labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(
        F.col(doc_id).alias("label_id")).agg(F.max(F.col(label).cast("int")).alias("toxic"))
    known = materialised(known.filter((fold(F.col("label_id")) != 0) & F.col("toxic").isin(0, 1)))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}  # two rows
    rate = {c: min(1.0, max_rows * share / 3 / max(1, counts.get(c, 0))) for c, share in ((1, 1), (0, 2))}
    # the mean label of a bounded sample; ids are hashed, so the choice is the same in every run
    place = F.pmod(F.xxhash64(F.col("label_id").cast("string")), F.lit(1_000_000)) / 1_000_000
    of = F.when(F.col("toxic") == 1, F.lit(rate[1])).otherwise(F.lit(rate[0]))
    chosen = known.filter(place < of).withColumn("weight", 1.0 / of)
    part = F.when(fold(F.col("label_id")) <= 2, "lexicon").when(fold(F.col("label_id")) == 3, "trees").otherwise(
        "calibration")
    chosen = F.broadcast(chosen.withColumn("part", part))  # about max_rows rows of 40 bytes at most
    rows = docs.select(F.col(doc_id).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return materialised(rows.join(chosen, F.col("doc") == F.col("label_id")).select("text", "toxic", "weight", "part"))


def _terms(text: str) -> set[str]:
    out = set()
    for word in set(WORD.findall(text.lower())):
        if 3 <= len(word) <= 30:
            out.add(word)
            out.update(word[:n] for n in STEMS if n < len(word))
    return out


def learn_lexicon(rows: DataFrame, max_terms: int) -> dict[str, float]:
    """Terms with their log odds, from (text, toxic); exact copies of a text count once."""
    prepare_workers()
    # rows that share digest and label are alike, so it does not matter which one stays
    rows = rows.withColumn("digest", F.sha2("text", 256)).dropDuplicates(["digest", "toxic"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = {0: Counter(), 1: Counter()}
            for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist(), strict=True):
                seen[toxic].update(_terms(text))
            for toxic, terms in seen.items():
                yield pa.RecordBatch.from_pydict({
                    "term": pa.array(terms.keys(), pa.string()), "toxic": pa.array([toxic] * len(terms), pa.int32()),
                    "n": pa.array(terms.values(), pa.int64())})

    total = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic_docs, clean_docs = total.get(1, 0), total.get(0, 0)
    if not toxic_docs or not clean_docs:
        return {}
    counted = rows.select("text", "toxic").mapInArrow(count, "term string, toxic int, n long")
    by_term = counted.groupBy("term").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("t"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("c"))
    weight = F.log((F.col("t") + 0.5) / (toxic_docs + 1)) - F.log((F.col("c") + 0.5) / (clean_docs + 1))
    best = by_term.filter(F.col("t") >= max(3, 0.002 * toxic_docs)).withColumn("w", weight).filter(
        F.col("w") >= MIN_LOG_ODDS).orderBy((F.col("w") * F.sqrt("t")).desc(), "term").limit(max_terms)
    found = {r["term"]: float(r["w"]) for r in best.collect()}  # at most max_terms rows
    # a word whose beginning says as much is already found by that beginning
    return {t: w for t, w in found.items()
            if not any(found.get(t[:n], -1.0) >= w - 0.3 for n in STEMS if n < len(t))}


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        max_rows: int = MAX_ROWS, max_terms: int = MAX_TERMS) -> Model:
    """Lexicon, trees and calibration from the labelled rows outside fold 0."""
    rows = training_rows(docs, labels, doc_id, text, label, max_rows)
    learnt = learn_lexicon(rows.filter("part = 'lexicon'"), max_terms)
    if not learnt and rows.filter("part = 'lexicon'").select("toxic").distinct().count() < 2:
        return Model({}, None, None)
    lexicon = {**{t: 4.0 for t in FIXED_TERMS}, **learnt}
    table = rows.filter("part != 'lexicon'").select(
        features(F.col("text"), lexicon).alias("x"), F.col("toxic").cast("double").alias("label"), "weight", "part")
    table = materialised(table.repartition(4))  # a bounded sample of short vectors, read many times
    parts = {(r["part"], r["label"]) for r in table.select("part", "label").distinct().collect()}  # four at most
    if not {("trees", 0.0), ("trees", 1.0)} <= parts:
        return Model(lexicon, None, None)
    ready = table.withColumn("features", array_to_vector("x"))
    trees = GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxIter=20, maxDepth=3,
                          stepSize=0.2, maxBins=64, seed=42).fit(ready.filter("part = 'trees'"))
    calibration = None
    if {("calibration", 0.0), ("calibration", 1.0)} <= parts:
        held = trees.transform(ready.filter("part = 'calibration'")).withColumn(
            "raw", vector_to_array("probability")[1])
        calibration = IsotonicRegression(featuresCol="raw", labelCol="label", weightCol="weight").fit(
            held.select("raw", "label", "weight"))
    return Model(lexicon, trees, calibration)


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """struct ``row`` (all columns of ``docs``) and ``score`` of every row."""
    whole = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    if model.trees is None:
        return whole.select("row", F.lit(0.0).alias("score"))
    ready = whole.withColumn("features", array_to_vector(features(F.col("body"), model.lexicon)))
    ready = model.trees.transform(ready).withColumn("raw", vector_to_array("probability")[1])
    if model.calibration is None:
        return ready.select("row", F.col("raw").alias("score"))
    ready = model.calibration.setFeaturesCol("raw").setPredictionCol("iso").transform(ready.drop("prediction"))
    return ready.select("row", ((F.col("iso") * 1000 + F.col("raw")) / 1001).alias("score"))


def score(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted; one row per row of ``docs``."""
    model = fit(docs, labels, doc_id, text)
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return scored(narrow, model).select(
        F.col("row.doc_id").alias("doc_id"), (fold(F.col("row.doc_id")) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def clean_documents(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    limit: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, that score below ``limit``."""
    return scored(docs, fit(docs, labels, doc_id, text), text).filter(F.col("score") < limit).select("row.*")
