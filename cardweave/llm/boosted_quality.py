"""Quality classifier: histogram gradient-boosted trees over document statistics.

Spark computes the statistics of every text and joins them with the labels. The
trees are fitted on a bounded sample of the labelled rows and flattened
into arrays, in which numpy walks all rows of a batch at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from cardweave.llm.store import shipped, slices, stored
from cardweave.llm.text_stats import repeated_lines, repeated_words

#: Labelled rows that the trees are fitted on at most; a documented bound.
SAMPLE_ROWS = 20_000
#: Share of the sample by which more rows are looked at than it takes.
SAMPLE_SLACK = 1.25
#: Remainder of crc32(id) mod FOLDS that is held out from fitting.
FOLDS = 5
#: Score from which a document is predicted to be good.
CUT = 0.3

_LETTERS_UP = np.arange(0x41, 0x5B)
_LETTERS_LOW = np.arange(0x61, 0x7B)
_DIGITS = np.arange(0x30, 0x3A)
_SPACES = np.array([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
_MARKS = np.array([b for b in range(0x21, 0x7F) if not chr(b).isalnum()])

#: Names of the statistics, in order.
STATISTICS = (
    "chars", "words", "word_length", "longest_word", "lines", "words_a_line", "space", "upper", "lower", "digits",
    "marks", "symbols", "bars", "shouts", "stops", "commas", "high_bytes", "doubled_marks", "capital_words",
    "distinct_words", "top_word", "repeated_words", "repeated_lines", "ended_lines", "one_letter_words")


def statistics(text: str | None) -> list[float]:
    """The statistics of a whole text; a null text counts as empty."""
    whole = text or ""
    data = whole.encode("utf-8", "surrogatepass")
    raw = np.frombuffer(data, np.uint8)
    count = np.bincount(raw, minlength=256)
    words = data.split()
    lines = [x for x in whole.split("\n") if x.strip()]
    n, w, l = max(1, len(data)), max(1, len(words)), max(1, len(lines))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    number: dict[bytes, int] = {}
    for word in words:
        number[word] = number.get(word, 0) + 1
    mark = np.zeros(256, bool)
    mark[_MARKS] = True
    is_mark = mark[raw]
    return [
        np.log1p(len(whole)), np.log1p(len(words)), float(lengths.mean()) if len(words) else 0.0,
        float(lengths.max(initial=0)), np.log1p(len(lines)), len(words) / l,
        count[_SPACES].sum() / n, count[_LETTERS_UP].sum() / n, count[_LETTERS_LOW].sum() / n, count[_DIGITS].sum() / n,
        count[_MARKS].sum() / n, count[[ord(c) for c in "#*$%&<>"]].sum() / n, count[ord("|")] / n,
        count[ord("!")] / n, count[ord(".")] / w, count[ord(",")] / w, count[0x80:].sum() / n,
        (is_mark[1:] & is_mark[:-1]).sum() / n, sum(1 for x in words if x.isupper()) / w,
        len(number) / w, max(number.values(), default=0) / w, repeated_words(words) / w, repeated_lines(whole) / l,
        sum(1 for x in lines if x.rstrip()[-1] in ".!?:;…\"'»”)") / l, (lengths == 1).sum() / w]


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = np.array([statistics(t.as_py()) for t in batch.column(0)], np.float32).reshape(-1, len(STATISTICS))
        values = pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * len(STATISTICS),
                                          pa.array(rows.reshape(-1)))
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], values], names=[*batch.schema.names[1:], "stats"])


@dataclass(frozen=True)
class Boosting:
    """Parameters of the fit."""

    trees: int = 80
    depth: int = 4
    rate: float = 0.15
    bins: int = 64
    least_weight: float = 1.0
    ridge: float = 1.0


@dataclass(frozen=True)
class Trees:
    """Trees of one depth in arrays by tree and node, the root at 0 and children of k at 2k+1 and 2k+2."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Probability of a good document for every row; a tie goes left."""
        total = np.full(len(rows), self.base)
        every = np.arange(len(rows))
        inner = self.feature.shape[1]
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(rows), np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (rows[every, feature[node]] > threshold[node])
            total += leaf[node - inner]
        return 1.0 / (1.0 + np.exp(-total))


def fit_trees(rows: np.ndarray, good: np.ndarray, how: Boosting = Boosting()) -> Trees:
    """Fit on a matrix of statistics and labels 0 or 1, by logistic loss.

    Without rows, every score is one half.
    """
    n, width = rows.shape
    inner, leaves = (1 << how.depth) - 1, 1 << how.depth
    feature = np.zeros((how.trees, inner), np.int64)
    threshold = np.full((how.trees, inner), np.inf)
    leaf = np.zeros((how.trees, leaves))
    if not n:
        return Trees(0.0, feature, threshold, leaf)
    share = np.clip(good.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    edges = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, how.bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(e, rows[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    slots = binned + np.arange(width) * how.bins
    total = np.full(n, base)
    for tree in range(how.trees):
        chance = 1.0 / (1.0 + np.exp(-total))
        slope, weight = good - chance, chance * (1 - chance)
        node = np.zeros(n, np.int64)
        for level in range(how.depth):
            first, count = (1 << level) - 1, 1 << level
            at = ((node - first)[:, None] * (width * how.bins) + slots).reshape(-1)
            size = count * width * how.bins
            slopes = np.bincount(at, np.repeat(slope, width), size).reshape(count, width, how.bins).cumsum(axis=2)
            weights = np.bincount(at, np.repeat(weight, width), size).reshape(count, width, how.bins).cumsum(axis=2)
            all_s, all_w = slopes[:, :, -1:], weights[:, :, -1:]
            gain = (slopes ** 2 / (weights + how.ridge) + (all_s - slopes) ** 2 / (all_w - weights + how.ridge)
                    - all_s ** 2 / (all_w + how.ridge))
            gain[(weights < how.least_weight) | (all_w - weights < how.least_weight)] = 0
            best = gain.reshape(count, -1).argmax(axis=1)
            for k, spot in enumerate(best.tolist()):
                f, b = divmod(spot, how.bins)
                if gain[k, f, b] > 1e-9 and b < len(edges[f]):
                    feature[tree, first + k], threshold[tree, first + k] = f, edges[f][b]
            node = 2 * node + 1 + (rows[np.arange(n), feature[tree, node]] > threshold[tree, node])
        slopes = np.bincount(node - inner, slope, leaves)
        weights = np.bincount(node - inner, weight, leaves)
        leaf[tree] = how.rate * slopes / (weights + how.ridge)
        total += leaf[tree][node - inner]
    return Trees(base, feature, threshold, leaf)


def _scoring(trees: Trees):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False)
            found = trees.scores(rows.reshape(-1, len(STATISTICS)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.float64())],
                                             names=[*batch.schema.names[:-1], "score"])
    return score


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row must not be learnt from; rows with a null id never are."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def fit_quality(measured: DataFrame, labels: DataFrame, *, label_id: str = "doc_id", label: str = "quality",
                sample_rows: int = SAMPLE_ROWS, how: Boosting = Boosting()) -> Trees:
    """Fit on rows (doc_id, stats) with a label that are not held out.

    At most ``sample_rows`` of them go to the driver, those with the smallest
    hash of id and statistics. Their number is counted first, and tasks send only
    rows below the hash that so many rows should lie under, so what reaches the driver does
    not grow with the tasks. Null labels are left out; an id with several labels
    counts as good if at least half of them say so.
    """
    marks = (labels.select(F.col(label_id).cast("long").alias("doc_id"), F.col(label).alias("mark"))
             .where("doc_id IS NOT NULL AND mark IS NOT NULL").groupBy("doc_id")
             .agg((F.avg("mark") >= 0.5).cast("int").alias("good")))
    labelled = stored(measured.where(~held_out()).join(marks, "doc_id")
                      .select(F.xxhash64("doc_id", "stats").alias("place"), "stats", "good"))
    share = min(1.0, SAMPLE_SLACK * sample_rows / max(1, labelled.count()))
    bound = min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63))
    rows = (labelled.where(F.col("place") <= bound).orderBy("place").limit(sample_rows)
            .select("stats", "good").toPandas())
    matrix = np.array(rows["stats"].tolist(), np.float32).reshape(-1, len(STATISTICS))
    return fit_trees(matrix, rows["good"].to_numpy(float), how)


def quality_scores(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                   sample_rows: int = SAMPLE_ROWS, cut: float = CUT) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row.

    Every text is measured once and its statistics stored. Null texts count as
    empty and are scored like others. Repeated ids are learnt from once for each
    of their rows. Without usable labels every score is one half. Other columns
    are ignored.
    """
    rows = docs.select(F.col(text).alias("text"), F.col(doc_id).cast("long").alias("doc_id"))
    measured = stored(shipped(rows).mapInArrow(_measured, "doc_id long, stats array<float>"))
    trees = fit_quality(measured, labels, sample_rows=sample_rows)
    scored = measured.select("doc_id", held_out().alias("held_out"), "stats").mapInArrow(
        _scoring(trees), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= cut).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
              sample_rows: int = SAMPLE_ROWS, cut: float = CUT) -> DataFrame:
    """Rows of ``docs``, with all columns, whose own text scores at least ``cut``.

    The rows are stored with their statistics, so that no text is measured twice.
    """
    place = docs.columns.index(text)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            with_text = [pa.RecordBatch.from_arrays([batch.column(1).field(place), *batch.columns],
                                                    names=["text", *batch.schema.names])]
            yield from _measured(iter(with_text))

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.struct("*").alias("row"))
    schema = T.StructType(list(rows.schema.fields)).add("stats", T.ArrayType(T.FloatType()))
    measured = stored(shipped(rows).mapInArrow(measure, schema))
    trees = fit_quality(measured, labels, sample_rows=sample_rows)
    scored = measured.select("row", "stats").mapInArrow(
        _scoring(trees), T.StructType([rows.schema["row"]]).add("score", "double"))
    return scored.where(F.col("score") >= cut).select("row.*")
