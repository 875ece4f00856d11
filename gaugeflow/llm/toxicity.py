"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a whole text: densities of fixed lexicons and of learned stems, how close
their words stand to second-person words, rates of capitals, punctuation and
obfuscation (listed words that only show after undoing letter substitutions,
symbols inside words, runs of one character, words with digits).

Training uses at most SAMPLE_ROWS labelled rows outside the held-out fold. Their
folds do different work, so that nothing is judged on rows it was fitted to: two
learn the stems, one fits the trees, one calibrates. Scores are then computed
in one pass over the documents without a shuffle.

Null and empty texts have zero features and get a score like any other; without
usable labels of both kinds every score is the share of toxic labels (0 if there
are none). Other columns pass through `scored` unchanged; a score column of the
same name is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

from gaugeflow.llm import text as T
from gaugeflow.llm.features import (
    SAMPLE_ROWS, fold, labelled_sample, labelled_texts, per_row, structure)
from gaugeflow.llm.names import free_name
from gaugeflow.session import materialize

# General lexicons, lower case.
INSULTS = """
idiot idiots moron morons stupid dumb dumbass fool loser losers clown clowns pathetic worthless
useless disgusting trash garbage scum vermin filth filthy pig pigs rat rats parasite imbecile
cretin jerk creep coward liar ugly fat freak weirdo retard retarded bastard bitch bitches whore
slut asshole dick prick twat wanker idiote imbécile connard connasse salaud salope ordure débile
abruti crétin dummkopf blödmann arschloch trottel versager abschaum schlampe hurensohn wichser
idiota imbécil estúpido estúpida gilipollas cabrón puta basura inútil tonto tonta asqueroso
""".split()
OBSCENE = """
fuck fucking fucked fucker shit shitty crap damn hell piss cunt cock merde putain foutre scheiße
scheisse verdammt ficken mierda joder coño carajo
""".split()
THREATS = """
kill die dead hate destroy hurt burn shoot stab hang rape beat punch suffer rot tuer mourir crève
hais töten sterben stirb hasse matar muere odio
""".split()
SECOND = """
you your yours yourself youre u ur ya tu toi te ton ta tes vous votre vos du dich dir dein deine
euch euer ihr tú ti contigo usted ustedes vosotros
""".split()
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s",
               "!": "i", "*": "i"}

#: A learned stem (a word's first bytes) is so many times likelier in toxic texts of its folds than
#: in others, and the logarithm of that ratio is so many standard errors above 0.
STEM_BYTES, LEARNED_LIFT, LEARNED_ERRORS, LEARNED_STEMS = 5, 3.0, 4.0, 256
NEAR_WORDS = 5
TREES, TREE_DEPTH, STEP = 20, 3, 0.3


def word_hashes(listed) -> np.ndarray:
    """Sorted hashes of words as the text kernels compute them."""
    column = pa.array([" ".join(listed)])
    block = next(T.blocks(column))
    return np.unique(T.words(block).hashes)


def _member(values: np.ndarray, listed: np.ndarray) -> np.ndarray:
    """Which values are listed; 16 bits rule out almost all of them first."""
    out = np.zeros(len(values), dtype=bool)
    if len(listed):
        low = np.uint64(0xFFFF)
        marked = np.zeros(1 << 16, dtype=bool)
        marked[(listed & low).astype(np.int64)] = True
        some = np.flatnonzero(marked[(values & low).astype(np.int64)])
        at = np.minimum(np.searchsorted(listed, values[some]), len(listed) - 1)
        out[some] = listed[at] == values[some]
    return out


def _undone(block: T.Block) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words after undoing letter substitutions, and their places."""
    table = T.lower_table()
    for sign, letter in SUBSTITUTES.items():
        table[ord(sign)] = ord(letter)
    data = table[block.data]
    starts, ends = T.word_spans(data, block.offsets)
    return T.span_hashes(data, starts, ends), starts


def features(block: T.Block, learned: np.ndarray) -> np.ndarray:
    """One row of features per text of the block."""
    found = T.words(block)
    n_words = np.maximum(np.diff(found.offsets), 1)
    insult, obscene, threat, second = (
        _member(found.hashes, word_hashes(x)) for x in (INSULTS, OBSCENE, THREATS, SECOND))
    taught = _member(stems(block, found), learned)
    listed = insult | obscene | threat | taught
    places = np.flatnonzero(second)
    near = np.zeros(len(listed), dtype=bool)
    hits = np.flatnonzero(listed)
    if len(places) and len(hits):
        row_of = np.searchsorted(found.offsets, np.arange(len(listed)), side="right")
        at = np.searchsorted(places, hits)
        for side in (np.maximum(at - 1, 0), np.minimum(at, len(places) - 1)):
            close = (np.abs(places[side] - hits) <= NEAR_WORDS) & (row_of[places[side]] == row_of[hits])
            near[hits] |= close
    undone, starts = _undone(block)
    bad = np.union1d(word_hashes(INSULTS), word_hashes(OBSCENE))
    hidden = np.flatnonzero(_member(undone, bad))
    hidden = hidden[~np.isin(starts[hidden], found.starts[listed])]
    hidden_rows = np.bincount(np.searchsorted(block.offsets, starts[hidden], side="right") - 1,
                              minlength=block.rows)[:block.rows]
    count = lambda mask: per_row(mask, found.offsets)
    shape = structure(block, found)
    columns = [count(insult) / n_words, np.log1p(count(insult)), count(obscene) / n_words,
               count(threat) / n_words, count(taught) / n_words, np.log1p(count(taught)),
               count(second) / n_words, count(near) / n_words, hidden_rows / n_words]
    names = ("upper", "shout", "exclaim", "mark", "symbol", "inner", "run", "mixed", "repeat",
             "words", "length")
    return np.stack(columns + [shape[x] for x in names], axis=1)


def stems(block: T.Block, found: T.Words) -> np.ndarray:
    """Hashes of the words' first bytes."""
    return T.span_hashes(T.lower_table()[block.data], found.starts,
                         np.minimum(found.ends, found.starts + STEM_BYTES))


def learn_stems(texts: DataFrame) -> np.ndarray:
    """Hashes of stems far commoner in toxic texts; at most LEARNED_STEMS, so they may be collected."""

    def present(batches):
        for batch in batches:
            toxic = batch.column(0).to_numpy()
            for block in T.blocks(batch.column(2)):
                found = T.words(block)
                rows = np.repeat(np.arange(block.rows), np.diff(found.offsets))
                hashes = stems(block, found)
                order = np.lexsort((hashes, rows))
                h, r = hashes[order], rows[order]
                fresh = np.ones(len(h), dtype=bool)
                fresh[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
                yield pa.record_batch(
                    [pa.array(h[fresh].view(np.int64)),
                     pa.array(toxic[block.first:block.last][r[fresh]])], names=["stem", "toxic"])

    texts = texts.dropDuplicates(["text"])
    kinds = {row.label: row.n for row in texts.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(kinds) < 2:
        return np.zeros(0, np.uint64)
    lift = (F.col("bad") / kinds[1.0]) / (F.col("good") / kinds[0.0])
    rows = (texts.mapInArrow(present, "stem long, toxic double").groupBy("stem")
            .agg((F.sum("toxic") + 0.5).alias("bad"), (F.sum(1 - F.col("toxic")) + 0.5).alias("good"))
            .withColumn("lift", lift)
            .withColumn("errors", F.log("lift") / F.sqrt(1 / F.col("bad") + 1 / F.col("good")))
            .where((F.col("lift") >= LEARNED_LIFT) & (F.col("errors") >= LEARNED_ERRORS))
            .orderBy(F.desc("errors"), "stem").limit(LEARNED_STEMS).collect())
    return np.unique(np.array([row.stem for row in rows], np.int64).view(np.uint64))


class ToxicityModel:
    """Lexicon, trees and calibration; `base` is the score where no model can be fitted."""

    def __init__(self, learned, trees=None, calibration=None, base: float = 0.0) -> None:
        self.learned, self.trees, self.calibration, self.base = learned, trees, calibration, base

    def scored(self, documents: DataFrame, column: str = "score") -> DataFrame:
        """All columns of the documents with the score, without a shuffle."""
        if self.trees is None:
            return documents.withColumn(column, F.lit(float(self.base)))
        kept = [c for c in documents.columns if c != column]
        learned = self.learned
        hidden = free_name("features", kept)
        source = documents.select(*[F.col(f"`{c}`") for c in kept])
        schema = type(source.schema)(list(source.schema.fields)).add(hidden, ArrayType(DoubleType()))
        # a text that is a string goes through Arrow once, anything else beside its cast
        place = next((i for i, f in enumerate(source.schema)
                      if f.name.lower() == "text" and isinstance(f.dataType, StringType)), len(kept))
        if place == len(kept):
            source = source.withColumn(free_name("text_copy", kept), F.col("text").cast("string"))

        def run(batches):
            for batch in batches:
                for block in T.blocks(batch.column(place)):
                    part = batch.slice(block.first, block.rows)
                    rows = features(block, learned)
                    yield pa.record_batch(
                        [part.column(i) for i in range(len(kept))]
                        + [pa.array(list(rows), pa.list_(pa.float64()))], names=schema.names)

        return self._apply(source.mapInArrow(run, schema), hidden, column).select(*[F.col(f"`{c}`") for c in kept], column)

    def _apply(self, df: DataFrame, hidden: str, column: str) -> DataFrame:
        names = {n: free_name(n, df.columns) for n in ("vector", "raw", "probability", "label")}
        trees = (self.trees.setFeaturesCol(names["vector"]).setPredictionCol(names["label"])
                 .setRawPredictionCol(names["raw"]).setProbabilityCol(names["probability"]))
        df = trees.transform(df.withColumn(names["vector"], array_to_vector(hidden)))
        share = vector_to_array(names["probability"])[1]
        df = df.drop(names["raw"], names["label"], names["vector"], column).withColumn(column, share)
        if self.calibration is None:
            return df
        out = free_name("calibrated", df.columns)
        df = self.calibration.setFeaturesCol(column).setPredictionCol(out).transform(df)
        return df.drop(column).withColumn(column, F.least(F.greatest(out, F.lit(0.0)), F.lit(1.0)))


def train(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Fit on at most `rows` labelled documents outside the held-out fold."""
    texts = materialize(labelled_texts(documents, labelled_sample(labels, "toxic", rows)),
                        "toxicity-sample")
    seen = {(r.fold, r.label): r.n for r in texts.groupBy("fold", "label")
            .agg(F.count("*").alias("n")).collect()}
    total = sum(seen.values())
    toxic = sum(n for (_, label), n in seen.items() if label == 1.0)
    base = toxic / total if total else 0.0
    if any(not seen.get((3, y), 0) for y in (0.0, 1.0)):
        return ToxicityModel(np.zeros(0, np.uint64), base=base)
    learned = learn_stems(texts.where("fold IN (1, 2)"))

    def run(batches):
        for batch in batches:
            for block in T.blocks(batch.column(2)):
                part = batch.slice(block.first, block.rows)
                yield pa.record_batch(
                    [part.column(0), part.column(1),
                     pa.array(list(features(block, learned)), pa.list_(pa.float64()))],
                    names=["label", "fold", "features"])

    rows_of = (materialize(texts.mapInArrow(run, "label double, fold long, features array<double>"),
                           "toxicity-features")
               .withColumn("vector", array_to_vector("features")))
    trees = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=TREES, maxDepth=TREE_DEPTH,
                          stepSize=STEP, minInstancesPerNode=3, seed=7).fit(
        rows_of.where("fold = 3").coalesce(4))
    model = ToxicityModel(learned, trees, None, base)
    if any(not seen.get((4, y), 0) for y in (0.0, 1.0)):
        return model
    held = model._apply(rows_of.where("fold = 4").select("label", "features")
                        .withColumnRenamed("label", "target"), "features", "score")
    model.calibration = IsotonicRegression(featuresCol="score", labelCol="target").fit(
        held.select("score", "target").coalesce(4))
    return model


def toxicity_scores(documents: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score and predicted for every document row."""
    model = train(documents, labels)
    return (model.scored(documents.select("doc_id", "text"))
            .select("doc_id", (fold("doc_id") == 0).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))
