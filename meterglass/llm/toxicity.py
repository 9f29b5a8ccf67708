"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a text: densities of lexicon words and lexicon stems, lexicon words near a second person, rates of capitals,
exclamation and question marks and obfuscated words, and its length. The lexicon is learned from the labelled rows: words and first
letters of words whose share of toxic texts is significantly above that of the others.

The trees, the lexicon and the calibration are fitted on at most MAX_LABELLED labelled rows outside the held-out fold, chosen by a hash of
the id; all documents are scored, each in one pass without a shuffle.

Defined cases: a null or empty text has features of 0 and gets a score; several labels of an id count as toxic if one
is; labels without a document, and null labels, are ignored; without labels of both kinds the score is the share of toxic
ones (0 without labels); no documents give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterglass.llm.common import U64, Words, mix, register, stored, table, word_hashes
from meterglass.llm.quality import Bare, groups

#: Labelled rows used for fitting, at most, and terms of the lexicon, at most.
MAX_LABELLED, MAX_TERMS = 8000, 1000
FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.3
STEMS = (4, 5)
#: How many times as frequent among toxic texts a term must be.
LEAST_RATIO = 8
TREES, DEPTH = 20, 3
#: Words on each side of a lexicon word that are searched for a second person.
NEAR = 6
SECOND_PERSON = ("you", "your", "yours", "u", "tu", "toi", "te", "vous", "votre", "du", "dich", "dir", "dein", "ihr",
                 "euch", "usted", "ustedes", "tú", "ti", "vosotros")
FEATURES = ("words", "stems", "near_you", "capitals", "shouts", "obfuscated", "length", "any_word", "any_stem")
UPPER, LETTER, SHOUT, ODD = (np.zeros(256, bool) for _ in range(4))
UPPER[ord("A"):ord("Z") + 1] = True
LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
SHOUT[list(b"!?")] = True
ODD[[*range(ord("0"), ord("9") + 1), *b"@$*#%&+_"]] = True


def fold(id_col: str, folds: int) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def term_hashes(words: Words) -> list[np.ndarray]:
    """Hashes of whole words and of their stems; 0 where a word is no longer than the stem."""
    if not len(words.starts):
        return [np.empty(0, U64)] * (1 + len(STEMS))
    out = [word_hashes(words.data, words.starts, words.ends)]
    for n in STEMS:
        stem = word_hashes(words.data, words.starts, np.minimum(words.ends, words.starts + n))
        out.append(np.where(words.ends - words.starts > n, mix(stem + U64(n)), U64(0)))
    return out


def lexicon(labelled: DataFrame, max_terms: int) -> np.ndarray:
    """Sorted hashes of the terms that mark toxic texts, from (text, toxic)."""
    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in groups(batch):
                toxic = np.array(part.column("toxic").to_pylist(), np.int64)
                words = Bare(part.column("text").to_pylist())
                found = term_hashes(words)
                hashes = np.concatenate(found)
                of = np.tile(words.of, len(found))[hashes != 0]
                hashes = hashes[hashes != 0]
                # A term counts once for each text.
                order = np.lexsort((of, hashes))
                hashes, of = hashes[order], of[order]
                new = np.ones(len(hashes), bool)
                new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
                hashes, of = hashes[new], of[new]
                values, which = np.unique(hashes, return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values.view(np.int64)), pa.array(np.bincount(which, minlength=len(values)).astype(np.int64)),
                     pa.array(np.bincount(which, toxic[of], minlength=len(values)).astype(np.int64))], ["term", "n", "bad"])

    total = labelled.agg(F.count("*").alias("n"), F.sum("toxic").alias("bad")).first()
    n, bad = total["n"], total["bad"] or 0
    ratio = F.log(((F.col("bad") + 0.5) / (bad + 1)) / ((F.col("n") - F.col("bad") + 0.5) / (n - bad + 1)))
    # The evidence asked for grows with the number of texts, and so with the number of chance finds.
    rows = (labelled.mapInArrow(terms, "term long, n long, bad long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
            .withColumn("evidence", F.col("bad") * ratio).where((F.col("evidence") > 10 + np.log(n + 1.0)) & (ratio > float(np.log(LEAST_RATIO))))
            .orderBy(F.desc("evidence"), "term").limit(max_terms).collect())
    return np.sort(np.array([r["term"] for r in rows], np.int64).view(U64))


def features(docs: DataFrame, terms: np.ndarray, also: tuple[str, ...]) -> DataFrame:
    """(*also, features) of (text, *also)."""
    second = np.sort(Words(list(SECOND_PERSON)).hashes())

    def member(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
        return known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes if len(known) else np.zeros(len(hashes), bool)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in groups(batch):
                texts = part.column("text").to_pylist()
                n = len(texts)
                words, bare = Words(texts), Bare(texts)
                own, *stems = term_hashes(bare)
                hit = member(own, terms)
                stem = np.any([member(s, terms) & (s != 0) for s in stems], axis=0) if len(own) else hit
                you = np.concatenate(([0], np.cumsum(member(own, second))))
                at = np.arange(len(own))
                low = np.maximum(at - NEAR, words.first[:-1][words.of]) if len(own) else at
                high = np.minimum(at + NEAR + 1, words.first[1:][words.of]) if len(own) else at
                near = (hit | stem) & (you[high] > you[low])

                def inside(mask: np.ndarray) -> np.ndarray:
                    sums = np.concatenate(([0], np.cumsum(mask[words.data])))
                    return sums[words.ends] - sums[words.starts]

                letters, odd = inside(LETTER), inside(ODD)
                # A mark or digit with letters on both sides, or as many as hide a word.
                hidden = (letters > 0) & (odd > 0) & LETTER[words.data[words.starts]] & LETTER[words.data[words.ends - 1]] if len(own) else hit
                count = np.maximum(words.counts, 1)

                def rate(values: np.ndarray) -> np.ndarray:
                    return np.bincount(words.of, values, minlength=n) / count

                chars = np.maximum(np.bincount(words.of, letters, minlength=n), 1)
                hits, stem_hits = np.bincount(words.of, hit, minlength=n), np.bincount(words.of, stem, minlength=n)
                table = np.stack([100 * hits / count, 100 * stem_hits / count, 100 * rate(near),
                                  np.bincount(words.of, inside(UPPER), minlength=n) / chars, rate(inside(SHOUT)), rate(hidden),
                                  np.log1p(words.counts), np.log1p(hits), np.log1p(stem_hits)], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in also), pa.array(list(table), pa.list_(pa.float64()))], [*also, "features"])

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    return (docs.select("text", *also).mapInArrow(compute, ", ".join(f"{c} {kinds[c]}" for c in also) + ", features array<double>")
            .withColumn("features", array_to_vector("features")))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = FOLDS,
             held_out: int = HELD_OUT, threshold: float = THRESHOLD, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, held_out, score, predicted) of all rows; labels: (doc_id, toxic 0 or 1)."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    known = (labels.where(F.col("toxic").isNotNull()).where(fold("doc_id", folds) != held_out)
             .groupBy(F.col("doc_id").alias("l_id")).agg(F.max("toxic").cast("int").alias("toxic"))
             .orderBy(F.xxhash64("l_id"), "l_id").limit(max_labelled))
    # max_labelled rows at most are broadcast, so only the texts they name leave the scan.
    labelled = stored(texts.join(F.broadcast(known), F.col("doc_id") == F.col("l_id")).select("doc_id", "text", "toxic"), "labelled")
    n, bad = labelled.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    is_held = fold("doc_id", folds) == held_out
    if not 0 < bad < n:
        return texts.select("doc_id", F.coalesce(is_held, F.lit(False)).alias("held_out"), F.lit(bad / max(n, 1)).alias("score")) \
            .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    terms = lexicon(labelled, MAX_TERMS)
    fitting = stored(features(labelled, terms, ("doc_id", "toxic")).withColumn("label", F.col("toxic").cast("double")), "features")
    # Two of three rows grow the trees, the third calibrates them.
    third = F.pmod(F.xxhash64("doc_id", F.lit("calibration")), F.lit(3)) == 0
    grow, calibrate = fitting.where(~third).coalesce(4), fitting.where(third).coalesce(4)
    if grow.agg(F.countDistinct("label")).first()[0] < 2 or calibrate.agg(F.countDistinct("label")).first()[0] < 2:
        grow = calibrate = fitting.coalesce(4)
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=32, stepSize=0.3, minInstancesPerNode=3, seed=1).fit(grow)

    def chance(frame: DataFrame) -> DataFrame:
        return trees.transform(frame).withColumn("chance", vector_to_array("probability")[1])

    even = IsotonicRegression(featuresCol="chance", labelCol="label", predictionCol="score").fit(chance(calibrate))
    scored = even.transform(chance(features(texts, terms, ("doc_id",))))
    # The calibrated steps are flat: the trees' own chance orders the rows of a step.
    score = F.least(F.greatest(0.98 * F.col("score") + 0.02 * F.col("chance"), F.lit(0.0)), F.lit(1.0))
    return scored.select("doc_id", F.coalesce(is_held, F.lit(False)).alias("held_out"), score.alias("score")) \
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))


@register("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
