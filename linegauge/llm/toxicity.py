"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

1. Lexicon: words that stand out in toxic training texts. Distinct words of the training sample are counted by label on Spark, and the words whose share
   among toxic texts exceeds their share among others by ``LEXICON_RATIO`` times are kept. Texts are in any language.
2. Features of a whole text: density and number of lexicon words, the same for words that match after undoing obfuscation, lexicon words near a word in the
   second person, capitals, exclamation and question marks, other punctuation, obfuscated words, length.
3. Trees are fitted on three quarters of the sample, the isotonic curve on the scores of the rest.

The sample has at most ``SAMPLE_ROWS`` labelled training rows, those of the smallest ``xxhash64(doc_id)``; everything else reads all rows. Labels, lang, source and
doc_id are no inputs of a score.

Null text counts as empty; an empty text has zero features and gets the score of such rows. Labels that are null, or of no document, teach nothing; a document
labelled twice teaches by its highest label. Null doc_ids are scored and never train. Without labels of both kinds every score is the share of
toxic labels (0 without any). An empty table gives no rows. ``reject_toxic`` passes other columns on.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from linegauge.llm.common import documents, slices, stored, texts_of

SAMPLE_ROWS = 20_000
TREES, DEPTH, SEED = 20, 4, 7
#: A lexicon word is in at least ``LEXICON_LEAST`` toxic sample texts, and its share there is ``LEXICON_RATIO`` times its share elsewhere.
LEXICON_LEAST, LEXICON_RATIO, LEXICON_ROWS = 5, 8.0, 400
NEAR_WORDS = 6
# Second-person words of the languages of the corpus.
SECOND_PERSON = frozenset("you your yours yourself du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos ti usted ustedes tus".split())
# Characters that stand for letters in obfuscated words.
LOOKALIKES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": "", ".": "", "-": "", "_": ""})

_WORD = re.compile(r"[^\s]+")
_TRIM = ".,;:!?\"'()[]{}«»„“”…"
FEATURES = (
    "log_words", "lexicon_share", "lexicon_count", "hidden_share", "hidden_count", "near_share", "second_share",
    "capital_share", "capital_words", "mark_share", "punctuation_share", "obfuscated_share",
)


def bare(word: str) -> str:
    return word.strip(_TRIM).lower()


class Kinds(dict):
    """Word to its bits: 1 lexicon, 2 lexicon once lookalikes are undone, 4 second person, 8 obfuscated, 16 all capitals."""

    def __init__(self, lexicon: frozenset[str]) -> None:
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> int:
        plain = bare(word)
        kind = 1 * (plain in self.lexicon) | 4 * (plain in SECOND_PERSON)
        if not plain.isalpha() and _MIXED.search(word):
            kind |= 8
            if not kind & 1 and plain.translate(LOOKALIKES) in self.lexicon:
                kind |= 2
        if len(word) > 2 and word.isupper():
            kind |= 16
        self[word] = kind
        return kind


def features(text: str, kinds: Kinds) -> list[float]:
    raw = _WORD.findall(text)
    n = len(raw)
    if not n:
        return [0.0] * len(FEATURES)
    found = np.fromiter(map(kinds.__getitem__, raw), np.uint8, n)
    lexicon, hidden, second, obfuscated, shouted = (np.flatnonzero(found & bit) for bit in (1, 2, 4, 8, 16))
    insults = np.concatenate([lexicon, hidden])
    near = 0
    if len(insults) and len(second):
        right = np.searchsorted(second, insults)
        after = np.abs(second[np.minimum(right, len(second) - 1)] - insults)
        before = np.abs(second[np.maximum(right - 1, 0)] - insults)
        near = int((np.minimum(after, before) <= NEAR_WORDS).sum())
    data = np.frombuffer(text.encode(), np.uint8)
    _, capitals, marks, others = np.bincount(BYTE_KINDS[data], minlength=4) / len(data)
    return [
        float(np.log1p(n)), len(lexicon) / n, float(min(len(lexicon), 20)), len(hidden) / n, float(min(len(hidden), 20)), near / n,
        len(second) / n, capitals, len(shouted) / n, marks, others, len(obfuscated) / n,
    ]


BYTE_KINDS = np.zeros(256, np.uint8)
for _kind, _bytes in ((1, range(ord("A"), ord("Z") + 1)), (2, b"!?"), (3, b"#*$%&|<>@~^")):
    BYTE_KINDS[list(_bytes)] = _kind
_MIXED = re.compile(r"[^\W\d_][\d@$!*_]+[^\W\d_]", re.UNICODE)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, text, toxic``: at most ``rows`` labelled rows outside the held-out fifth. A repeated doc_id gives one row, of its least text."""
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # The sample is bounded by ``rows``, whatever the size of the tables.
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # Of the texts of a repeated doc_id the least one is taken, so that every run trains on the same rows.
    return texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("doc_id", "text", "toxic")


def learned_lexicon(sample: DataFrame) -> list[str]:
    """At most ``LEXICON_ROWS`` words, most telling first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            counts = Counter()
            for text, toxic in zip(texts_of(part), part.column("toxic").to_pylist()):
                counts.update((w, toxic) for w in {bare(w) for w in _WORD.findall(text)} if w)
            words = list(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in words], pa.string()), pa.array([t for _, t in words], pa.int32()), pa.array(list(counts.values()), pa.int64())],
                ["word", "toxic", "n"],
            )

    totals = dict(sample.groupBy("toxic").count().collect())
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        return []
    n = lambda label: F.sum(F.when(F.col("toxic") == label, F.col("n")).otherwise(0))
    counts = sample.mapInArrow(run, "word string, toxic int, n long").groupBy("word").agg(n(1).alias("t"), n(0).alias("c"))
    telling = counts.withColumn("ratio", (F.col("t") / toxic) / ((F.col("c") + 1) / clean))
    telling = telling.where((F.col("t") >= LEXICON_LEAST) & (F.col("ratio") >= LEXICON_RATIO))
    return [r.word for r in telling.orderBy(F.desc("ratio"), "word").limit(LEXICON_ROWS).collect()]


def with_features(docs: DataFrame, lexicon: list[str], keep: list[str]) -> DataFrame:
    """The columns ``keep`` and ``tox_x``, the array of features."""
    listed = frozenset(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            kinds = Kinds(listed)
            x = pa.array([features(text, kinds) for text in texts_of(part)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), x], [*keep, "tox_x"])

    fields = [f for f in docs.schema.fields if f.name in keep]
    schema = StructType([*fields, StructField("tox_x", ArrayType(DoubleType()))])
    return docs.select(*dict.fromkeys([*(f.name for f in fields), "text"])).mapInArrow(run, schema)


@dataclass
class Model:
    """``trees`` and ``curve`` are missing when the labels had one kind only; ``share`` of them was toxic."""

    lexicon: list[str]
    trees: GBTClassificationModel | None
    curve: IsotonicRegressionModel | None
    share: float

    def scored(self, docs: DataFrame, keep: list[str]) -> DataFrame:
        """The columns ``keep``, in the order of ``docs``, and ``tox_score``."""
        keep = [c for c in docs.columns if c in keep]
        rows = with_features(docs, self.lexicon, keep)
        if self.trees is None:
            return rows.select(*keep, F.lit(self.share).alias("tox_score"))
        rows = self.trees.transform(rows.withColumn("tox_features", array_to_vector("tox_x")))
        rows = self.curve.transform(rows.withColumn("tox_raw", vector_to_array("tox_probability")[1]))
        return rows.select(*keep, F.greatest(F.lit(0.0), F.least(F.lit(1.0), "tox_score")).alias("tox_score"))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    sample = stored(training_sample(docs, labels, rows), "toxic-sample")
    share = sample.agg(F.coalesce(F.avg("toxic"), F.lit(0.0)).alias("share")).first().share
    lexicon = learned_lexicon(sample)
    x = with_features(sample, lexicon, ["doc_id", "toxic"]).withColumn("tox_features", array_to_vector("tox_x"))
    x = stored(x.select("doc_id", F.col("toxic").cast("double").alias("toxic"), "tox_x"), "toxic-features")
    x = x.withColumn("tox_features", array_to_vector("tox_x")).withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(4)))
    for_trees, for_curve = x.where("fold > 0"), x.where("fold = 0")
    if any(part.agg(F.count_distinct("toxic").alias("n")).first().n < 2 for part in (for_trees, for_curve)):
        return Model(lexicon, None, None, share)
    boosted = GBTClassifier(featuresCol="tox_features", labelCol="toxic", predictionCol="tox_class", maxIter=TREES, maxDepth=DEPTH, seed=SEED)
    boosted.setProbabilityCol("tox_probability").setRawPredictionCol("tox_margin")
    trees = boosted.fit(for_trees.select("toxic", "tox_features").coalesce(4))
    raw = trees.transform(for_curve).withColumn("tox_raw", vector_to_array("tox_probability")[1])
    curve = IsotonicRegression(featuresCol="tox_raw", labelCol="toxic", predictionCol="tox_score").fit(raw.select("toxic", "tox_raw"))
    return Model(lexicon, trees, curve, share)


def reject_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with their columns."""
    # As a struct, the document's columns cannot clash with those of the model.
    rows = model.scored(docs.select(F.struct(*docs.columns).alias("tox_doc"), "text"), ["tox_doc"])
    return rows.where(F.col("tox_score") < threshold).select("tox_doc.*")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scored = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).scored(docs, ["doc_id"])
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("tox_score").alias("score"),
        (F.col("tox_score") >= 0.5).cast("int").alias("predicted"),
    )
