"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Every text is turned into the `FEATURES` in one pass: densities of a fixed lexicon and of one learned from
labels, hits that stand near a word of second person, capitals, punctuation, and rates of obfuscation. The
trees see nothing else of a row. Labelled rows with crc32(doc_id) mod 3 = 1 are held out; of the others at
most `MAX_TRAIN`, taken by a hash of their id, are used, in three parts: half to learn the stems, a quarter to
grow the trees, a quarter to calibrate, so that none of the steps sees a row twice. All documents are scored.

Defined results: null and empty texts have all features zero and get the score of that; rows are scored one
by one, so repeated rows get equal scores; a null doc_id is not held out. Of several labels of a document
the highest counts, null labels are left out. Without labels of both kinds no model can be learned and every
score is the share of toxic labels, 0 without any. Further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm import texts
from tidelog.llm.frames import modest_batches, written

MAX_TRAIN = 30_000
MAX_LEXICON = 2000
# Stems are the first bytes of a run of letters; a shorter word is learned as its own stem of its length.
STEMS = (4, 5, 6, 7, 8)
LEAST_SEEN = 5
LEAST_RATIO = 20
NEAR = 5
THRESHOLD = 0.7

# Fixed word lists.
INSULTS = (
    "idiot idiots moron morons stupid dumb trash garbage loser losers scum pathetic worthless disgusting clown "
    "fool imbecile jerk creep freak filth vermin parasite retard bastard bitch asshole "
    "dumm blöd trottel arschloch abschaum versager dreck widerlich erbärmlich "
    "imbécile crétin débile ordure minable nul dégoûtant salaud connard "
    "estúpido estúpida imbécil basura escoria asqueroso patético inútil payaso"
).split()
SECOND_PERSON = (
    "you your yours yourself yourselves u ur du dich dir dein deine deinen deiner ihr euch euer eure "
    "tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros vuestro"
).split()
FEATURES = (
    "lexicon", "lexicon_hits", "learned", "learned_hits", "near_person", "person", "disguised", "mixed_words",
    "capitals", "shouting", "exclamation", "punctuation", "repeated_punctuation", "digits", "word_length", "words",
)

_BYTE = np.arange(256)
_UPPER = (_BYTE >= 65) & (_BYTE <= 90)
_LETTER = _UPPER | ((_BYTE >= 97) & (_BYTE <= 122)) | (_BYTE >= 128)
_DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
_MARK = ~(_LETTER | _DIGIT | texts.is_space(_BYTE)) & (_BYTE > 32)
_CODE = np.select([_UPPER, _LETTER, _DIGIT, _BYTE == 33, _MARK], [0, 1, 2, 3, 4], 5).astype(np.uint8)
_CORE = _LETTER | _DIGIT | np.isin(_BYTE, [ord("@"), ord("$")])
# Letters that stand behind digits and signs; other signs inside a word are skipped.
_PLAIN = np.where(_LETTER, _BYTE, 0).astype(np.uint8)
for _sign, _letter in zip("01345789@$!|+", "oieastbgasilt", strict=True):
    _PLAIN[ord(_sign)] = ord(_letter)


# Sorted hashes and the weight of each, the logarithm of its ratio.
Stems = tuple[np.ndarray, np.ndarray]


def _member(hashes: np.ndarray, lexicon: np.ndarray) -> np.ndarray:
    if not len(lexicon):
        return np.zeros(len(hashes), bool)
    at = np.minimum(np.searchsorted(lexicon, hashes), len(lexicon) - 1)
    return lexicon[at] == hashes


def _disguised(data: np.ndarray, bounds: np.ndarray, lexicon: np.ndarray) -> np.ndarray:
    """(texts, 4): words, words with signs or digits among letters, such words of the lexicon, words in capitals."""
    out = np.zeros((len(bounds) - 1, 4), np.int64)
    for start, end in texts.blocks(data, bounds):
        part = data[start:end]
        inner = bounds[(bounds > start) & (bounds < end)] - start
        s, e = texts.run_bounds(~texts.is_space(part), np.concatenate(([0], inner, [end - start])))
        owner = np.searchsorted(bounds, s + start, "right") - 1
        core = np.flatnonzero(_CORE[part])
        first, last = np.searchsorted(core, s), np.searchsorted(core, e) - 1
        has = last >= first
        owner_of_core, s, e = owner[has], core[first[has]], core[last[has]] + 1
        letters = texts.between(_LETTER[part], s, e)
        mixed = (letters >= 2) & (letters < e - s)
        capitals = (letters >= 3) & (texts.between(_UPPER[part], s, e) == letters)
        plain = _PLAIN[part]
        kept = np.concatenate(([0], np.cumsum(plain > 0)))
        hit = _member(texts.Spans(plain[plain > 0]).hash(kept[s[mixed]], kept[e[mixed]]), lexicon)
        for column, rows in enumerate((owner, owner_of_core[mixed], owner_of_core[mixed][hit], owner_of_core[capitals])):
            out[:, column] += np.bincount(rows, minlength=len(out))
    return out


def _stem_hashes(spans: texts.Spans, s: np.ndarray, e: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each stem length: which words are that long, and the hashes of their first bytes."""
    for size in STEMS:
        long = e - s >= size
        yield long, spans.hash(s[long], s[long] + size)


def _judged(column: pa.Array, bounds: np.ndarray, fixed: np.ndarray, stems: Stems, person: np.ndarray):  # noqa: ANN202
    """For every run of letters: is it an insult, a second person, and the largest weight of its stems."""
    found = [(np.zeros(0, bool), np.zeros(0, bool), np.zeros(0), np.zeros(0, np.int64))]
    keys, weights = stems
    for start, part, s, e in texts.runs(column, _LETTER):
        spans = texts.Spans(part)
        whole = spans.hash(s, e)
        weight = np.zeros(len(s))
        if len(keys):
            for long, hashes in _stem_hashes(spans, s, e):
                at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                weight[long] = np.maximum(weight[long], np.where(keys[at] == hashes, weights[at], 0))
        found.append((_member(whole, fixed), _member(whole, person), weight, s + start))
    in_fixed, in_person, weight, places = (np.concatenate(x) for x in zip(*found, strict=True))
    return in_fixed, in_person, weight, np.searchsorted(places, bounds)


def features(column: pa.Array, fixed: np.ndarray, stems: Stems, person: np.ndarray) -> np.ndarray:
    """(texts, FEATURES) of a column of texts; word lists are sorted hashes, stems have weights beside them."""
    data, bounds = texts.text_bytes(column)
    size = np.maximum(np.diff(bounds), 1)
    codes = texts.counts_by_code(data, bounds, _CODE[data], 6)
    marks = _MARK[data]
    twice = np.zeros(len(data), bool)
    if len(data):
        twice[1:] = marks[1:] & (data[1:] == data[:-1])
    repeated = texts.between(twice, bounds[:-1], bounds[1:])
    in_fixed, in_person, weight, first = _judged(column, bounds, fixed, stems, person)
    words = np.maximum(np.diff(first), 1)
    hits = np.flatnonzero(in_fixed | (weight > 0))
    persons = np.flatnonzero(in_person)
    near = np.zeros(len(weight), bool)
    if len(hits) and len(persons):
        at = np.searchsorted(persons, hits)
        behind, ahead = persons[np.minimum(at, len(persons) - 1)], persons[np.maximum(at - 1, 0)]
        owner = lambda x: np.searchsorted(first, x, "right")
        for other in (behind, ahead):
            near[hits] |= (np.abs(other - hits) <= NEAR) & (owner(other) == owner(hits))
    fixed_hits, learned_hits, weights, near_hits, person_hits = (
        texts.between(x, first[:-1], first[1:]) for x in (in_fixed, weight > 0, weight, near, in_person)
    )
    spoken, mixed, disguised, shouted = _disguised(data, bounds, fixed).T
    spoken = np.maximum(spoken, 1)
    letters = np.maximum(codes[:, 0] + codes[:, 1], 1)
    return np.column_stack(
        [
            fixed_hits / words, fixed_hits, weights / words, learned_hits, near_hits / words, person_hits / words,
            disguised / spoken, mixed / spoken, codes[:, 0] / letters, shouted / spoken, codes[:, 3] / size,
            codes[:, 4] / size, repeated / size, codes[:, 2] / size, letters / words, np.log1p(np.diff(first)),
        ]
    )


def _rows(docs: DataFrame, *more: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def _featured(rows: DataFrame, stems: Stems) -> DataFrame:
    """The rows with `features` in the place of the text, which is their second column."""
    fixed, person = texts.hash_words(INSULTS), texts.hash_words(SECOND_PERSON)
    others = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text"]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in texts.pieces(batch, "text"):
                values = features(part.column(1), fixed, stems, person)
                ends = np.arange(0, values.size + 1, len(FEATURES), dtype=np.int32)
                kept = [part.column(i) for i in range(part.num_columns) if i != 1]
                names = [n for n in part.schema.names if n != "text"]
                lists = pa.ListArray.from_arrays(ends, pa.array(values.ravel()))
                yield pa.RecordBatch.from_arrays([*kept, lists], names=[*names, "features"])

    return rows.mapInArrow(add, ", ".join([*others, "features array<double>"]))


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text; mod 3 = 1 is held out."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))


def training_labels(labels: DataFrame, label: str, most: int) -> DataFrame:
    """(doc_id, label) of at most `most` labelled documents that are not held out, by a hash of their id."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .filter("doc_id IS NOT NULL AND label IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    return known.filter(fold() % 3 != 1).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def _stems_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(stem, label) once for every text and stem."""
    for batch in batches:
        labels = batch.column(2).to_pylist()
        for i, label in enumerate(labels):
            seen = np.zeros(0, np.uint64)
            for _, part, s, e in texts.runs(batch.column(1).slice(i, 1), _LETTER):
                seen = np.unique(np.concatenate([seen, *(h for _, h in _stem_hashes(texts.Spans(part), s, e))]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(seen.view(np.int64)), pa.array(np.full(len(seen), label, np.int32))], names=["stem", "label"]
            )


def _learned(rows: DataFrame) -> Stems:
    """At most MAX_LEXICON stems that are far more frequent in toxic rows of (doc_id, text, label)."""
    total = rows.agg(F.sum("label").alias("toxic"), F.count("*").alias("rows")).first()
    if not total.toxic or total.toxic == total.rows:
        return np.zeros(0, np.uint64), np.zeros(0)
    seen = rows.mapInArrow(_stems_of, "stem long, label int").groupBy("stem").agg(
        F.sum("label").alias("toxic"), (F.count("*") - F.sum("label")).alias("clean")
    )
    ratio = ((F.col("toxic") + 0.5) / (total.toxic + 1)) / ((F.col("clean") + 0.5) / (total.rows - total.toxic + 1))
    found = seen.filter(F.col("toxic") >= LEAST_SEEN).select("stem", "toxic", ratio.alias("ratio"))
    top = found.filter(F.col("ratio") >= LEAST_RATIO).orderBy(F.desc("toxic"), F.desc("ratio"), "stem").limit(MAX_LEXICON).collect()
    keys = np.array([r.stem for r in top], np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], np.log2([r.ratio for r in top])[order] if top else np.zeros(0)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of `docs` (doc_id, text); `labels` has (doc_id, toxic)."""
    modest_batches(docs.sparkSession)
    # At most MAX_TRAIN rows of a long and an int: small enough to be sent to every task.
    sample = F.broadcast(written(training_labels(labels, "toxic", MAX_TRAIN)))
    rows = written(_rows(docs).join(sample, "doc_id").select("doc_id", "text", "label"))
    part = F.floor(fold() / 3) % 4
    learned = _learned(rows.filter(part < 2))
    known = written(
        _featured(rows.filter(part >= 2), learned).select(
            part.alias("part"), F.col("label").cast("double").alias("label"), array_to_vector("features").alias("features")
        )
    )
    scored = _featured(_rows(docs), learned).withColumn("features", array_to_vector("features"))
    held_out = F.coalesce(fold() % 3 == 1, F.lit(False)).alias("held_out")
    counts = {(r.part, r.label): r["count"] for r in known.groupBy("part", "label").count().collect()}
    if all(counts.get((p, y)) for p in (2, 3) for y in (0.0, 1.0)):
        trees = GBTClassifier(maxIter=20, maxDepth=3, stepSize=0.2, seed=11, featureSubsetStrategy="all").fit(
            known.filter("part = 2")
        )
        steps = IsotonicRegression(featuresCol="probability", featureIndex=1, predictionCol="calibrated").fit(
            trees.transform(known.filter("part = 3")).select("label", "probability")
        )
        scored = steps.transform(trees.transform(scored).drop("prediction"))
        # The steps are flat; a hundredth of the trees' own estimate keeps their order within a step.
        score = F.col("calibrated") * 0.99 + vector_to_array("probability")[1] * 0.01
    else:
        share = rows.agg(F.avg("label")).first()[0]
        score = F.lit(float(share or 0))
    return scored.select("doc_id", held_out, score.alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )
