"""Toxic passages: maximum-scoring segments over token log-odds, calibrated as extreme values."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.common import Memo, map_batches, plain_words, utf8
from surveyloom.session import ship_package, store

# The model is fitted on so many labelled documents at most, the ones with the smallest id hashes.
SAMPLE = 20_000
# Stems that stand for inflected words: prefixes of so many letters.
STEMS = (4, 5, 6)
# Weight of the Dirichlet prior, in tokens, of which a term has its share of all text, and what each term has besides.
PRIOR, FLAT = 500.0, 0.5
# A term enters the lexicon from so many standard errors, toxic documents and log-odds.
SIGNIFICANT, SEEN, STRONG = 4.0, 4, 1.0
# Segments count from this score on when the distribution of chance segments is fitted.
CHANCE = 1.0
# Evidence is told apart in such parts of one when it is calibrated, between these bounds.
FINE, LEAST, MOST = 64.0, -64.0, 1024.0
THRESHOLD = 0.3
# Bytes of text counted before partial counts leave a task.
COUNTED = 8 << 20


@dataclass
class Model:
    """terms: log-odds and significance by term; drift: the log-odds of any other token; k, lam: of chance segments.

    steps: evidence values and the share of toxic documents from each on.
    """

    terms: dict[str, tuple[float, float]]
    drift: float
    k: float
    lam: float
    steps: tuple[np.ndarray, np.ndarray]

    def memo(self) -> Memo:
        return Memo(self.weight)

    def weight(self, word: bytes) -> float:
        """Log-odds of a token: of its most significant term, 0 if it has none."""
        found = [self.terms[t] for t in terms_of(word.decode("utf-8", "replace")) if t in self.terms]
        return max(found, key=lambda x: x[1])[0] if found else 0.0

    def evidence(self, words: int, best: float) -> float:
        """-ln of the number of segments as good as ``best`` that chance gives in so many words."""
        return self.lam * best - math.log(self.k * max(words, 1))

    def score(self, words: int, best: float) -> float:
        """The share of toxic documents among those with such evidence, raised a little within a step."""
        x = self.evidence(words, best)
        at, share = self.steps
        step = float(share[max(0, np.searchsorted(at, x, "right") - 1)]) if len(at) else 0.0
        return 0.98 * step + 0.02 / (1 + math.exp(-max(-50.0, min(50.0, x / 10))))


def terms_of(word: str) -> list[str]:
    return ["w" + word, *(f"{n}{word[:n]}" for n in STEMS if len(word) > n)]


def segments(words: list[bytes], weights: Memo, drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), by one scan from left to right.

    Tokens without a term cost ``drift`` each; only tokens with one can begin or
    end a segment, so the scan steps over the rest. A segment that may still grow
    knows the last one before it whose left sum is lower, so the scan jumps from
    one to the other and looks at each a bounded number of times.
    """
    starts: list[int] = []
    ends: list[int] = []
    lows: list[float] = []  # sum before the start
    highs: list[float] = []  # sum to the end
    lower: list[int] = []  # the last segment before with a lower sum before its start, -1 for none
    gone, total = 0, 0.0
    for i, weight in enumerate(map(weights.__getitem__, words)):
        if weight <= 0:
            continue
        low = total + drift * (i - gone)
        gone, total = i + 1, low + weight
        start, at = i, len(lows) - 1
        while at >= 0:
            if lows[at] >= low:
                at = lower[at]
            elif highs[at] >= total:
                break
            else:
                # All from there on become one with the new one.
                start, low, before = starts[at], lows[at], lower[at]
                del starts[at:], ends[at:], lows[at:], highs[at:], lower[at:]
                at = before
        starts.append(start)
        ends.append(i + 1)
        lows.append(low)
        highs.append(total)
        lower.append(at)
    return [(start, end, high - low) for start, end, low, high in zip(starts, ends, lows, highs)]


def training(documents: DataFrame, labels: DataFrame, ident: str, text: str, sample: int) -> DataFrame:
    """(text, toxic) of a bounded sample of the labelled documents.

    Labels that contradict each other count as toxic. The sample has a fixed
    number of ids, so it may be broadcast; texts are not shuffled.
    """
    chosen = (
        labels.where(F.col(ident).isNotNull() & F.col("toxic").isNotNull())
        .groupBy(ident)
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64(ident), ident)
        .limit(sample)
    )
    return documents.select(ident, F.col(text).alias("text")).join(F.broadcast(chosen), ident).select("text", "toxic")


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, toxic, clean): in how many documents of either kind a term stands."""

    def counted(words: list[Counter]) -> pa.RecordBatch:
        terms: dict[str, list[int]] = {}
        for kind, counter in enumerate(words):
            for word, n in counter.items():
                for term in terms_of(word.decode("utf-8", "replace")):
                    terms.setdefault(term, [0, 0])[kind] += n
        return pa.RecordBatch.from_arrays(
            [pa.array(list(terms), pa.string()), *(pa.array([n[k] for n in terms.values()], pa.int64()) for k in (1, 0))],
            ["term", "toxic", "clean"],
        )

    words, size = [Counter(), Counter()], 0
    for batch in batches:
        for text, toxic in zip(utf8(batch.column(0)), batch.column(1).to_pylist()):
            words[int(toxic == 1)].update(set(plain_words(text)))
            size += len(text)
            if size > COUNTED:
                yield counted(words)
                words, size = [Counter(), Counter()], 0
    yield counted(words)


def rising(x: np.ndarray, sums: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best rising step function of ``sums / weights`` over rising ``x`` (pool adjacent violators)."""
    blocks: list[list[float]] = []  # x from which it holds, sum, weight
    for value, total, weight in zip(x, sums, weights):
        blocks.append([value, total, weight])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            _, total, weight = blocks.pop()
            blocks[-1][1] += total
            blocks[-1][2] += weight
    return np.array([b[0] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def fit(
    documents: DataFrame, labels: DataFrame, ident: str = "doc_id", text: str = "text", sample: int = SAMPLE
) -> Model:
    """Learn terms, chance segments and calibration from labelled documents.

    ``labels`` holds the ids to learn from with ``toxic`` 0 or 1; null ids and
    labels are left out. Term counts are summed in Spark; the driver gets the
    significant terms, which the sample bounds, and how often each evidence
    value occurs, in steps of 1 / ``FINE`` between bounds.
    Without any toxic or without any clean document nothing is toxic.
    """
    spark = documents.sparkSession
    ship_package(spark)
    train = training(documents, labels, ident, text, sample)
    counts = (
        train.mapInArrow(count_terms, "term string, toxic long, clean long")
        .groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )
    word = F.col("term").startswith("w")
    seen = F.col("toxic") >= SEEN
    total = counts.agg(*(F.sum(F.when(word, F.col(c))).alias(c) for c in ("toxic", "clean"))).first()
    n1, n0 = total["toxic"] or 0, total["clean"] or 0
    if not n1 or not n0:
        return Model({}, 0.0, 1.0, 1.0, (np.zeros(0), np.zeros(0)))
    prior = PRIOR * (F.col("toxic") + F.col("clean")) / F.lit(float(n1 + n0)) + FLAT
    a, b = F.col("toxic") + prior, F.col("clean") + prior
    odds = F.log(a / (n1 + PRIOR - a)) - F.log(b / (n0 + PRIOR - b))
    strongest = (
        counts.where(seen)
        .select("term", "toxic", "clean", odds.alias("odds"), (odds / F.sqrt(1 / a + 1 / b)).alias("z"))
        .where((F.col("z") >= SIGNIFICANT) & (F.col("odds") >= STRONG))
        .orderBy(F.desc("z"), "term")
        .collect()
    )
    terms = {r["term"]: (r["odds"], r["z"]) for r in strongest}
    # Shares of tokens with a term among all, by kind; stems contain their words, so the largest term of a stem counts.
    share = [
        min(0.5, sum(r[c] for r in strongest if r["term"][0] == "w" or r["term"][0] == str(STEMS[0])) / n)
        for c, n in (("toxic", n1), ("clean", n0))
    ]
    drift = min(-0.001, math.log((1 - share[0]) / (1 - share[1])))
    model = Model(terms, drift, 1.0, 1.0, (np.zeros(0), np.zeros(0)))

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        weights, rows = model.memo(), []
        for text in utf8(batch.column(0)):
            words = plain_words(text)
            found = [s for *_, s in segments(words, weights, drift)]
            over = [s - CHANCE for s in found if s >= CHANCE]
            rows.append((len(words), max(found, default=0.0), len(over), sum(over)))
        n, best, many, over = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [batch.column(1), pa.array(n, pa.int64()), pa.array(best, pa.float64()), pa.array(many, pa.int64()), pa.array(over, pa.float64())],
            ["toxic", "n", "best", "many", "over"],
        )

    measured = store(map_batches(train, measure, "toxic int, n long, best double, many long, over double"), "measured")
    clean = measured.where("toxic <> 1").agg(*(F.sum(c).alias(c) for c in ("n", "many", "over"))).first()
    many, over, n = ((clean[c] or 0) + 1 for c in ("many", "over", "n"))
    # Scores of chance segments fall off exponentially; one segment as by theory (lam 1) is added.
    model.lam = many / over
    model.k = many / n * math.exp(model.lam * CHANCE)
    evidence = model.lam * F.col("best") - F.log(model.k * F.greatest("n", F.lit(1)))
    step = (F.round(F.greatest(F.lit(LEAST), F.least(F.lit(MOST), evidence)) * FINE) / FINE).alias("x")
    steps = measured.groupBy(step).agg(F.count_if(F.col("toxic") == 1).alias("toxic"), F.count("*").alias("rows")).orderBy("x").collect()
    model.steps = rising(*(np.array([r[c] for r in steps], float) for c in ("x", "toxic", "rows")))
    return model


def score(df: DataFrame, model: Model, ident: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(ident, score, predicted, passages) for every row of ``df``.

    ``passages`` are the maximal segments of which chance gives fewer than one in
    such a text: first word, word after the last, score. ``predicted`` is 1 from
    ``threshold`` on. Null and empty texts have no passage and the score of a
    text without evidence; null ids and repeated rows come back as they are; an
    empty table gives no rows. Other columns are not looked at.
    """

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        weights, scores, passages = model.memo(), [], []
        for t in utf8(batch.column(1)):
            words = plain_words(t)
            found = segments(words, weights, model.drift)
            scores.append(model.score(len(words), max((s for *_, s in found), default=0.0)))
            passages.append(
                [{"start": a, "end": b, "score": s} for a, b, s in found if model.evidence(len(words), s) > 0]
            )
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(scores, pa.float64()),
                pa.array([int(s >= threshold) for s in scores], pa.int32()),
                pa.array(passages, kind),
            ],
            ["ident", "score", "predicted", "passages"],
        )

    kind = df.schema[ident].dataType.simpleString()
    schema = f"ident {kind}, score double, predicted int, passages array<struct<start:bigint,end:bigint,score:double>>"
    return map_batches(df.select(F.col(ident).alias("ident"), F.col(text).alias("text")), one, schema).withColumnRenamed(
        "ident", ident
    )


def keep_clean(df: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df`` that :func:`score` does not predict toxic, with all their columns."""
    place = df.columns.index(text)

    def clean(batch: pa.RecordBatch) -> pa.RecordBatch:
        weights, keep = model.memo(), []
        for t in utf8(batch.column(place)):
            words = plain_words(t)
            best = max((s for *_, s in segments(words, weights, model.drift)), default=0.0)
            keep.append(model.score(len(words), best) < threshold)
        return batch.filter(pa.array(keep, pa.bool_()))

    return map_batches(df, clean, df.schema)
