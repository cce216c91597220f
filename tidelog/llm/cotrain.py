"""Quality by co-training a text view and a metadata view.

The text view sees what a document says: shares of byte classes and of hashed byte pairs, variety of words.
The metadata view sees what is known about it: language, source and both together, recorded length against real
length, line layout. Both start from the labelled rows. In every round each view hands unlabelled documents
it has not handed over yet to the other view, with its own verdict as label: those it is most sure of, by
their place among all documents (`ROUND_SHARE` of them a class in the first round, twice and three times as many in
the next ones), and only as far as its verdicts on calibrating rows are right `SURE` of the time. The other view
is fitted anew with all that it was handed; pseudo-labelled rows of a class weigh half as much as all labelled
rows at most, so that neither class nor the pseudo-labels can outweigh the rest. At the end each view is calibrated
on labelled rows that neither was fitted on, the two calibrated views are weighed against each other on the same
rows, and all documents are scored.

At most `MAX_TRAIN` labelled rows are fitted, taken by a hash of the id. Nothing else is bounded: pseudo-labelled rows
stay where they are, and a fit takes `STEPS` Newton steps over sums of gradients and curvatures that each pass over
all documents adds up. Which rows were handed over follows from the models of the rounds, so no list of them is kept.
Rows with crc32(doc_id) mod 3 = 1 are held out, those with 2 calibrate, those with 0 are fitted.

Defined results: null and empty texts have all text features zero, null metadata counts as an empty value;
rows are scored one by one, so repeated rows get equal scores; a null doc_id is not held out. Of several
labels of a document the highest counts, null labels are left out. Without labels of both kinds in the fitted
and in the calibrating rows every score is the share of good labels, 0.5 without any. Further columns are not
looked at; columns missing beside doc_id and text count as null.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm import texts
from tidelog.llm.frames import modest_batches, written
from tidelog.llm.toxicity import fold

MAX_TRAIN = 20_000
ROUNDS = 3
STEPS = 3
ROUND_SHARE = 0.05
SURE = 0.95
# Calibrating rows that a verdict is judged by at least.
JUDGED = 20
# Weight of the pseudo-labelled rows of a class against all labelled rows, at most.
PSEUDO_WEIGHT = 0.5
PENALTY = 1.0
PAIRS = 32
TEXT_WIDTH = PAIRS + 12
META_BUCKETS = 16
META_CROSSED = 32
META_WIDTH = 2 * META_BUCKETS + META_CROSSED + 5
THRESHOLD = 0.5

_BYTE = np.arange(256)
_UPPER = (_BYTE >= 65) & (_BYTE <= 90)
_LOWER = ((_BYTE >= 97) & (_BYTE <= 122)) | (_BYTE >= 128)
_DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
_SPACE = texts.is_space(_BYTE)
_STOP = np.isin(_BYTE, [ord(c) for c in ".,;:?"])
_QUOTE = np.isin(_BYTE, [ord(c) for c in "'\"()-!"])
_CODE = np.select([_UPPER, _LOWER, _DIGIT, _SPACE, _STOP, _QUOTE], [0, 1, 2, 3, 4, 5], 6).astype(np.uint8)


def text_view(column: pa.Array) -> np.ndarray:
    """(texts, TEXT_WIDTH) features of what the texts say."""
    data, bounds = texts.text_bytes(column)
    size = np.maximum(np.diff(bounds), 1)[:, None]
    classes = texts.counts_by_code(data, bounds, _CODE[data], 7) / size
    pair = np.zeros(len(data), np.int64)
    if len(data):
        pair[1:] = (data[:-1].astype(np.int64) * 131 + data[1:]) * 2654435761 >> 7 & (PAIRS - 1)
    pairs = np.sqrt(texts.counts_by_code(data, bounds, pair, PAIRS) / size)
    same = np.zeros(len(data), bool)
    if len(data):
        same[1:] = (data[1:] == data[:-1]) & ~_LOWER[data[1:]]
    repeated = texts.between(same, bounds[:-1], bounds[1:]) / size[:, 0]
    hashes, first = texts.words(column)
    words = np.diff(first)
    twice = np.zeros(len(hashes), bool)
    if len(hashes):
        twice[1:] = hashes[1:] == hashes[:-1]
    echoed = texts.between(twice, first[:-1], first[1:]) / np.maximum(words, 1)
    variety = np.array([len(np.unique(hashes[first[i] : first[i + 1]])) for i in range(len(words))]) / np.maximum(np.sqrt(words), 1)
    length = size[:, 0] / np.maximum(words, 1)
    out = np.column_stack([classes, repeated, echoed, np.log1p(variety), np.log(length), np.log1p(words), pairs])
    return np.where(np.diff(bounds)[:, None] > 0, out, 0.0)


def meta_view(lang: np.ndarray, source: np.ndarray, n_chars: np.ndarray, lines: np.ndarray, size: np.ndarray) -> np.ndarray:
    """(rows, META_WIDTH) features of metadata; `lang` and `source` are bucket numbers, `size` is the real length."""
    out, row = np.zeros((len(lang), META_WIDTH)), np.arange(len(lang))
    out[row, lang] = 1
    out[row, META_BUCKETS + source] = 1
    out[row, 2 * META_BUCKETS + (lang * 7 + source * 13) % META_CROSSED] = 1
    said, real, broken = np.log1p(np.maximum(n_chars, 0)), np.log1p(size), np.log1p(lines)
    out[:, -5:] = np.column_stack([said, said**2 / 10, broken, said - broken, np.abs(said - real)])
    return out


def _views(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in texts.pieces(batch, "text"):
            text = text_view(part.column(1)).astype(np.float32)
            meta = meta_view(*(part.column(i).to_numpy(zero_copy_only=False) for i in range(2, 7))).astype(np.float32)
            lists = [
                pa.ListArray.from_arrays(np.arange(0, v.size + 1, v.shape[1], dtype=np.int32), pa.array(v.ravel()))
                for v in (text, meta)
            ]
            yield pa.RecordBatch.from_arrays([part.column(0), *lists], names=["doc_id", "text_view", "meta_view"])


def views(docs: DataFrame) -> DataFrame:
    """doc_id, text_view, meta_view of every row."""
    modest_batches(docs.sparkSession)
    have = lambda name, kind: (F.col(name) if name in docs.columns else F.lit(None)).cast(kind)
    bucket = lambda name: F.pmod(F.crc32(F.coalesce(have(name, "string"), F.lit("")).cast("binary")), F.lit(META_BUCKETS))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        bucket("lang").cast("long").alias("lang"),
        bucket("source").cast("long").alias("source"),
        F.coalesce(have("n_chars", "double"), F.length("text").cast("double"), F.lit(0.0)).alias("n_chars"),
        F.coalesce(F.regexp_count("text", F.lit("\n")), F.lit(0)).cast("double").alias("lines"),
        F.coalesce(F.length("text"), F.lit(0)).cast("double").alias("size"),
    )
    return rows.mapInArrow(_views, "doc_id long, text_view array<float>, meta_view array<float>")


class Logistic(NamedTuple):
    """A standardised linear model of log-odds."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(((x - self.centre) / self.scale) @ self.weights[1:] + self.weights[0], -30, 30)


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> Logistic:
    """Penalised maximum likelihood by Newton steps with halving."""
    centre, scale = x.mean(0), x.std(0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    design = np.column_stack([np.ones(len(x)), (x - centre) / scale])
    ridge = np.full(design.shape[1], penalty)
    ridge[0] = 1e-6

    def loss(w: np.ndarray) -> float:
        z = design @ w
        return float(np.logaddexp(0, z).sum() - y @ z + 0.5 * ridge @ (w * w))

    w = np.zeros(design.shape[1])
    best = loss(w)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (p - y) + ridge * w
        curve = (design * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ design + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        part = 1.0
        while part > 1e-4 and (now := loss(w - part * step)) > best:
            part /= 2
        if part <= 1e-4 or best - now < 1e-6 * max(1.0, best):
            break
        w, best = w - part * step, now
    return Logistic(centre, scale, w)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().astype(float).reshape(-1, width)


def _sample(rows: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """At most `most` rows of (label, fold, text_view, meta_view), by a hash of their id."""
    kept = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select("label", "fold", "text_view", "meta_view").toArrow()
    kept = kept.combine_chunks()
    column = lambda name: kept[name].combine_chunks() if isinstance(kept[name], pa.ChunkedArray) else kept[name]
    return (
        column("label").to_numpy(zero_copy_only=False).astype(float),
        column("fold").to_numpy(zero_copy_only=False),
        _matrix(column("text_view"), TEXT_WIDTH),
        _matrix(column("meta_view"), META_WIDTH),
    )


def _logits(rows: DataFrame, text: Logistic, meta: Logistic) -> DataFrame:
    """`rows` (doc_id, text_view, meta_view, ...) with the log-odds of both views."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                pa.array(model.logit(_matrix(batch.column(i), width)), pa.float64())
                for i, model, width in ((1, text, TEXT_WIDTH), (2, meta, META_WIDTH))
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], names=[*batch.schema.names, "text_logit", "meta_logit"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(add, f"{fields}, text_logit double, meta_logit double")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, text_score, meta_score, score, predicted of every row of `docs`; `labels` has
    (doc_id, quality), 1 for good."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
        .filter("doc_id IS NOT NULL AND label IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    seen = written(views(docs))
    rows = written(seen.join(written(known), "doc_id", "left").withColumn("fold", (fold() % 3).cast("int")))
    labelled = rows.filter("label IS NOT NULL AND fold <> 1")
    y, part, text_x, meta_x = _sample(labelled, MAX_TRAIN)
    fitted, calibrating = part == 0, part == 2
    held_out = F.coalesce(F.col("fold") == 1, F.lit(False)).alias("held_out")
    if min(len(np.unique(y[fitted])), len(np.unique(y[calibrating]))) < 2:
        share = F.lit(float(y.mean()) if len(y) else 0.5)
        score = rows.select("doc_id", held_out, share.alias("text_score"), share.alias("meta_score"), share.alias("score"))
    else:
        text, meta = _cotrain(rows.filter("label IS NULL"), y, fitted, text_x, meta_x)
        logits = np.column_stack([text.logit(text_x[calibrating]), meta.logit(meta_x[calibrating])])
        single = [fit_logistic(logits[:, [i]], y[calibrating]) for i in (0, 1)]
        calibrated = np.column_stack([m.logit(logits[:, [i]]) for i, m in enumerate(single)])
        both = fit_logistic(calibrated, y[calibrating])
        score = _calibrated(_logits(rows.select("doc_id", "text_view", "meta_view", "fold"), text, meta), single, both).select(
            "doc_id", held_out, "text_score", "meta_score", "score"
        )
    return score.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


class Rule(NamedTuple):
    """A round's verdict of a view: good from one log-odds on, bad up to another."""

    model: Logistic
    good: float
    bad: float

    def label(self, x: np.ndarray) -> np.ndarray:
        logit = self.model.logit(x)
        return np.where(logit >= self.good, 1, np.where(logit <= self.bad, 0, -1))


def first_verdicts(rules: list[Rule], x: np.ndarray) -> np.ndarray:
    """The label each row was handed over with, in the first round that did so; -1 if none did."""
    out = np.full(len(x), -1)
    for rule in rules:
        out = np.where(out < 0, rule.label(x), out)
    return out


def sure_limits(logit: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """The least log-odds from which on, and the largest up to which, verdicts are right SURE of the time."""
    limits = []
    for sign in (1, -1):
        order = np.argsort(-sign * logit, kind="stable")
        right = np.cumsum((y[order] == (sign > 0)).astype(float)) / np.arange(1, len(order) + 1)
        # Rows of equal log-odds are judged together.
        last = np.append(logit[order][1:] != logit[order][:-1], True)
        enough = np.flatnonzero(last & (right >= SURE) & (np.arange(len(order)) + 1 >= JUDGED))
        limits.append(float(logit[order[enough[-1]]]) if len(enough) else sign * np.inf)
    return limits[0], limits[1]


def loss(model: Logistic, x: np.ndarray, y: np.ndarray) -> float:
    """Mean logistic loss."""
    z = model.logit(x)
    return float((np.logaddexp(0, z) - y * z).mean())


def _design(model: Logistic, x: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(x)), (x - model.centre) / model.scale])


def _slopes(model: Logistic, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Number of rows, gradient and curvature, in one vector."""
    design = _design(model, x)
    p = 1 / (1 + np.exp(-np.clip(design @ model.weights, -30, 30)))
    curve = (design * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ design
    return np.concatenate([[len(x)], design.T @ (p - y), curve.ravel()])


def _step(model: Logistic, x: np.ndarray, y: np.ndarray, pseudo: list[np.ndarray]) -> Logistic:
    """One Newton step over labelled rows and the sums of the pseudo-labelled rows of both classes."""
    width = len(model.weights)
    total = _slopes(model, x, y)
    for sums in pseudo:
        if sums[0]:
            total = total + min(1.0, PSEUDO_WEIGHT * len(x) / sums[0]) * sums
    ridge = np.full(width, PENALTY)
    ridge[0] = 1e-6
    curve = total[1 + width :].reshape(width, width) + np.diag(ridge)
    step = np.linalg.solve(curve, total[1 : 1 + width] + ridge * model.weights)
    # A step from a fitted model is short; a longer one is cut to be safe far from the optimum.
    step *= min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
    return model._replace(weights=model.weights - step)


def _pseudo_sums(unlabelled: DataFrame, models: dict[str, Logistic], rules: dict[str, list[Rule]]) -> dict[str, list[np.ndarray]]:
    """For each view, the sums of `_slopes` over the rows that the other view handed over, by class."""
    views_of = (("text", 1, TEXT_WIDTH), ("meta", 2, META_WIDTH))
    sizes = {name: 1 + (width + 1) + (width + 1) ** 2 for name, _, width in views_of}

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {name: np.zeros((2, size)) for name, size in sizes.items()}
        for batch in batches:
            x = {name: _matrix(batch.column(i), width) for name, i, width in views_of}
            for learner, teacher in (("text", "meta"), ("meta", "text")):
                label = first_verdicts(rules[teacher], x[teacher])
                for kind in (0, 1):
                    own = x[learner][label == kind]
                    if len(own):
                        sums[learner][kind] += _slopes(models[learner], own, np.full(len(own), kind))
        for name, found in sums.items():
            for kind in (0, 1):
                if found[kind][0]:
                    n = len(found[kind])
                    columns = [pa.array([name] * n), pa.array(np.full(n, kind)), pa.array(np.arange(n)), pa.array(found[kind])]
                    yield pa.RecordBatch.from_arrays(columns, names=["view", "kind", "place", "x"])

    parts = unlabelled.select("doc_id", "text_view", "meta_view").mapInArrow(add, "view string, kind long, place long, x double")
    out = {name: [np.zeros(size), np.zeros(size)] for name, size in sizes.items()}
    # As many rows as the two curvatures have cells, twice.
    for r in parts.groupBy("view", "kind", "place").agg(F.sum("x").alias("x")).collect():
        out[r.view][r.kind][r.place] = r.x
    return out


def _cotrain(unlabelled: DataFrame, y: np.ndarray, fitted: np.ndarray, text_x: np.ndarray, meta_x: np.ndarray) -> tuple[Logistic, Logistic]:
    """Fit both views, each with what the other was sure of in the rounds before."""
    x = {"text": text_x, "meta": meta_x}
    judging = ~fitted
    models = {name: fit_logistic(own[fitted], y[fitted]) for name, own in x.items()}
    rules: dict[str, list[Rule]] = {"text": [], "meta": []}
    for number in range(1, ROUNDS + 1):
        scored = _logits(unlabelled.select("doc_id", "text_view", "meta_view"), models["text"], models["meta"])
        share = min(0.5, ROUND_SHARE * number)
        edges = scored.agg(*(F.percentile_approx(f"{name}_logit", [share, 1 - share], 10_000).alias(name) for name in x)).first()
        for name, own in x.items():
            if edges[name] is None:
                continue
            good, bad = sure_limits(models[name].logit(own[judging]), y[judging])
            rules[name].append(Rule(models[name], max(good, edges[name][1]), min(bad, edges[name][0])))
        for _ in range(STEPS):
            sums = _pseudo_sums(unlabelled, models, rules)
            models = {name: _step(models[name], own[fitted], y[fitted], sums[name]) for name, own in x.items()}
    return models["text"], models["meta"]


def _calibrated(scored: DataFrame, single: list[Logistic], both: Logistic) -> DataFrame:
    """Turn log-odds of the views into calibrated scores; plain arithmetic on columns."""

    def linear(model: Logistic, *columns):  # noqa: ANN002, ANN202
        total = F.lit(float(model.weights[0]))
        for i, column in enumerate(columns):
            total = total + (column - float(model.centre[i])) / float(model.scale[i]) * float(model.weights[i + 1])
        return total

    scored = scored.withColumns(
        {"text_odds": linear(single[0], F.col("text_logit")), "meta_odds": linear(single[1], F.col("meta_logit"))}
    )
    share = lambda odds: 1 / (1 + F.exp(-odds))
    return scored.withColumns(
        {
            "text_score": share(F.col("text_odds")),
            "meta_score": share(F.col("meta_odds")),
            "score": share(linear(both, F.col("text_odds"), F.col("meta_odds"))),
        }
    )
