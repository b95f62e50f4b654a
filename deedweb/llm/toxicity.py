"""Toxicity by cumulative-link ordinal regression on sparse word features.

P(grade > k) = sigmoid(w . x - t_k): one weight vector is shared by all thresholds t_0 <= t_1 <= ..., and the expected
severity is the sum of these probabilities.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deedweb.llm.rows import blocks, others, row_id, small_batches, spare
from deedweb.scratch import written

#: The most labelled rows that the model is fitted on.
MAX_LABELLED = 20_000
#: ASCII that is no letter splits words.
SPACED = bytes(b if chr(b).isalpha() or b > 127 else 32 for b in range(256))


#: Lengths of the beginnings of words that are features beside the words: they stand for what inflects or compounds.
BEGINNINGS = (4, 5, 6, 7)
#: A feature's value is FACTOR * occurrences / words ** POWER. Between a count (power 0) and a rate (power 1): one chance
#: hit in a short text weighs less than by its rate.
FACTOR, POWER = 40.0, 0.8


def features(word: str) -> list[str]:
    """A word, and each beginning of it, marked by a dash."""
    return [word, *(f"{word[:size]}-" for size in BEGINNINGS if len(word) > size)]


def words_of(text: str | None) -> Counter[str]:
    """How often each word is in a text."""
    return Counter((text or "").lower().encode().translate(SPACED).decode().split())


@dataclass(frozen=True)
class SeverityModel:
    """Weights of words, and ascending thresholds. Without thresholds (nothing to learn from), every severity is 0."""

    weights: dict[str, float]
    thresholds: tuple[float, ...]

    def chances(self, text: str | None) -> np.ndarray:
        """P(grade > k) for each k."""
        found = words_of(text)
        hits = sum(n * self.weights.get(f, 0.0) for w, n in found.items() for f in features(w))
        score = FACTOR * hits / max(1, found.total()) ** POWER
        return 1 / (1 + np.exp(np.clip(np.array(self.thresholds) - score, -60, 60)))


def fit_cumulative_link(
    rows: list[dict[str, float]], grades: np.ndarray, words: list[str], penalty: float = 1e-4, steps: int = 600
) -> SeverityModel:
    """Maximum likelihood with an L2 penalty, by Adam on weights and thresholds; later thresholds are the first plus
    positive gaps. A grade that no row has gets a gap as its neighbours allow."""
    place = {w: i for i, w in enumerate(words)}
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.array([place[w] for r in rows for w in r], np.int64)
    val = np.array([x for r in rows for x in r.values()])
    return _fit(at, col, val, grades, words, penalty, steps)


def _fit(
    at: np.ndarray, col: np.ndarray, val: np.ndarray, grades: np.ndarray, words: list[str], penalty: float = 1e-4, steps: int = 600
) -> SeverityModel:
    """The same, from a sparse matrix: row ``at[i]`` has ``val[i]`` of word ``col[i]``."""
    cuts = int(grades.max())
    state = np.zeros(len(words) + cuts)
    share = [np.clip((grades > k).mean(), 1e-4, 1 - 1e-4) for k in range(cuts)]
    first = np.log((1 - np.array(share)) / np.array(share))
    state[len(words)] = first[0]
    state[len(words) + 1 :] = np.log(np.maximum(np.diff(first), 1e-2))
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -60, 60)))
    mean, square = np.zeros_like(state), np.zeros_like(state)
    for step in range(1, steps + 1):
        gaps = np.exp(state[len(words) + 1 :])
        edges = np.concatenate(([-np.inf], state[len(words)] + np.concatenate(([0], np.cumsum(gaps))), [np.inf]))
        score = np.bincount(at, val * state[col], len(grades)) if len(col) else np.zeros(len(grades))
        up, down = sigmoid(edges[grades + 1] - score), sigmoid(edges[grades] - score)  # P(y <= grade), P(y < grade)
        chance = np.maximum(up - down, 1e-12)
        slope_up, slope_down = up * (1 - up) / chance, down * (1 - down) / chance
        by_score = (slope_up - slope_down) / len(grades)  # of the negative log-likelihood
        grad = np.zeros_like(state)
        if len(col):
            grad[: len(words)] = np.bincount(col, val * by_score[at], len(words))
        grad[: len(words)] += penalty * state[: len(words)]
        by_edge = np.bincount(grades, slope_down, cuts + 1)[1:] - np.bincount(grades, slope_up, cuts + 1)[:-1]
        later = np.cumsum(by_edge[::-1])[::-1] / len(grades)
        grad[len(words)] = later[0]
        grad[len(words) + 1 :] = later[1:] * gaps
        mean, square = 0.9 * mean + 0.1 * grad, 0.999 * square + 0.001 * grad**2
        rate = 0.05 * (1 - step / (steps + 1))
        state -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    edges = state[len(words)] + np.concatenate(([0], np.cumsum(np.exp(state[len(words) + 1 :]))))
    return SeverityModel({w: float(x) for w, x in zip(words, state, strict=False)}, tuple(float(x) for x in edges))


def _word_counts(labelled: DataFrame) -> DataFrame:
    """``word, all, up``: in how many texts each feature is, and in how many of a grade above 0; one row for each batch of
    ``row, grade, text`` that has the feature, to be added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both: tuple[Counter[str], Counter[str]] = Counter(), Counter()
            for grade, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                both[grade > 0].update({f for w in words_of(text) for f in features(w)})
            words = list(both[0] | both[1])
            up = np.array([both[1][w] for w in words], np.int64)
            every = up + np.array([both[0][w] for w in words], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(every), pa.array(up)], ["word", "all", "up"])

    return labelled.mapInArrow(run, "word string, all long, up long")


def _vectors(labelled: DataFrame, words: list[str]) -> DataFrame:
    """``row, grade, size``, the text's words, ``at array<int>, n array<int>``: which of ``words`` a text has, how often."""
    place = {w: i for i, w in enumerate(words)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, at, n = [], [], []
            for text in batch.column(2).to_pylist():
                words = words_of(text)
                found: Counter[int] = Counter()
                for w, k in words.items():
                    for f in features(w):
                        if f in place:
                            found[place[f]] += k
                sizes.append(words.total())
                at.append(list(found.keys()))
                n.append(list(found.values()))
            lists = pa.list_(pa.int32())
            columns = [batch.column(0), batch.column(1), pa.array(sizes, pa.int32()), pa.array(at, lists), pa.array(n, lists)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "grade", "size", "at", "n"])

    kind = labelled.schema["row"].dataType.simpleString()
    return labelled.mapInArrow(run, f"row {kind}, grade int, size int, at array<int>, n array<int>")


def train_severity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    grade_col: str = "severity",
    max_labelled: int = MAX_LABELLED,
    min_z: float = 4.0,
    graded_by_rate: bool = False,
) -> SeverityModel:
    """A model of the integer grades 0, 1, ... in ``labels``.

    At most ``max_labelled`` labelled rows are used, those with the smallest hash of their id, so the sample is the same
    in each run. The driver gets a short vector for each of them, over all words and beginnings that tell grades above 0 from 0
    (by the two-proportion z-score over documents, of ``min_z`` or more either way), so what it holds is bounded by the sample. Rows
    without id, text or grade, and ids without a document, are left out; of texts that share an id, that which sorts last
    is used. With one grade only, or no rows, the model says 0 for every text.

    ``graded_by_rate``: for labels that only say 0 or 1. Rows above 0 are split at the median rate of the words that stand
    out most (z-score above a tenth of the highest): the lower half has grade 1, the rest grade 2.
    """
    known = labels.select(row_id(labels, id_col).alias("row"), labels[grade_col].cast("int").alias("grade"))
    known = known.where("row is not null and grade >= 0").groupBy("row").agg(F.max("grade").alias("grade"))
    sample = known.orderBy(F.xxhash64("row"), "row").limit(max_labelled)
    texts = docs.select(row_id(docs, id_col).alias("row"), docs[text_col].alias("text")).where("text is not null")
    labelled = texts.join(F.broadcast(sample), "row").groupBy("row").agg(F.max("grade").alias("grade"), F.max("text").alias("text"))
    labelled = small_batches(written(labelled, "labelled"))
    total = labelled.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum((F.col("grade") > 0).cast("int")), F.lit(0)).alias("up")).first()
    if not 0 < total["up"] < total["n"]:
        return SeverityModel({}, ())
    by_word = _word_counts(labelled).groupBy("word").agg(F.sum("all").alias("all"), F.sum("up").alias("up")).where("all >= 3")
    share = total["up"] / total["n"]
    z = (F.col("up") - share * F.col("all")) / F.sqrt(share * (1 - share) * F.col("all"))
    best = by_word.select("word", z.alias("z")).where(F.abs("z") >= min_z).collect()
    best.sort(key=lambda r: r["word"])
    words = [r["word"] for r in best]
    vectors = _vectors(labelled, words).toArrow().sort_by("row")
    grades, sizes = vectors["grade"].to_numpy(), np.maximum(1, vectors["size"].to_numpy())
    lists = vectors["at"].combine_chunks()
    at = np.repeat(np.arange(len(grades)), np.diff(lists.offsets.to_numpy()))
    col, n = lists.flatten().to_numpy(), vectors["n"].combine_chunks().flatten().to_numpy()
    if graded_by_rate:
        loud = np.array([r["z"] for r in best]) > 0.1 * max((r["z"] for r in best), default=0.0)
        rates = np.bincount(at, n * loud[col], len(grades)) / sizes if len(col) else np.zeros(len(grades))
        grades = np.where(grades > 0, 1 + (rates > np.median(rates[grades > 0])), 0)
    return _fit(at, col, FACTOR * n / sizes[at] ** POWER, grades, words)


def toxicity(
    docs: DataFrame, model: SeverityModel, id_col: str = "doc_id", text_col: str = "text", reject_at: float = 0.3
) -> DataFrame:
    """The rows and columns of ``docs``, plus ``expected_severity``, ``p_toxic`` (P(grade > 0)), both doubles, and
    ``rejected`` (``p_toxic`` is ``reject_at`` or more; the default is below a half because on held-out labels it finds more
    at no cost in clean documents).

    Whole texts are read; a null or empty text gets what the thresholds alone say. Null ids and repeated rows pass
    through; an empty table gives an empty result. A column of ``docs`` that has the name of a new one, in whatever case, is
    replaced. A very long text is worked on by itself.
    """
    new = ("expected_severity", "p_toxic", "rejected")
    columns = others(docs, *new)
    text_at = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, text_at):
            found = [model.chances(x.as_py()) for x in batch.column(text_at)]
            first = [float(p[0]) if len(p) else 0.0 for p in found]
            columns = [*batch.columns[:text_at], pa.array([float(p.sum()) for p in found]), pa.array(first), pa.array([x >= reject_at for x in first])]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:text_at], *new])

    schema = docs.select(*columns).schema.add("expected_severity", "double").add("p_toxic", "double").add("rejected", "boolean")
    return small_batches(docs.select(*columns, docs[text_col].alias(spare(docs, "text_read")))).mapInArrow(run, schema)
