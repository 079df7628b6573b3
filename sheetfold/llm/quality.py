"""Quality classifier by co-training.

One classifier sees the text's content, another the page's metadata (source, language, length on
record). Both start from the labelled sample; in every round each gives the other its most
confident pseudo-labels of an unlabelled sample. Each view is calibrated on folds that it was not
fitted to, and a last calibration combines both views' log-odds into the score of a document.
"""

from __future__ import annotations

import pickle
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetfold.llm.common import store
from sheetfold.llm.words import chunks, slices, words_of
from sheetfold.operators.joins import sized_side

#: Labelled rows fitted to, and unlabelled rows that get pseudo-labels, at most (by digest of the id).
LABELLED, UNLABELLED = 20_000, 20_000
ROUNDS = 3
#: A pseudo-label needs this probability, and a view gives at most this share of the pool a round.
CONFIDENT, GIVEN = 0.97, 0.1
#: Documents whose score falls below are rejected.
THRESHOLD = 0.5
FOLDS = 5
SOURCE_CELLS, LANG_CELLS = 48, 16

_BYTE_CLASSES = {
    "upper": range(0x41, 0x5B), "lower": range(0x61, 0x7B), "digit": range(0x30, 0x3A), "other script": range(0x80, 0x100),
    "stop": b".,;:", "bang": b"!?", "bar": b"|", "symbol": b"#$%&*@^~=+<>_\\/{}[]", "quote": b"\"'()-", "line": b"\n",
}
_CLASS = np.full(256, len(_BYTE_CLASSES), np.int64)
for _i, _members in enumerate(_BYTE_CLASSES.values()):
    _CLASS[list(_members)] = _i


def content_features(texts: list[bytes | None]) -> np.ndarray:
    """The content view of texts, one row each; null counts as empty."""
    out = []
    k = len(_BYTE_CLASSES) + 1
    for _, some in chunks(texts):
        w = words_of(some)
        n = np.diff(w.first)
        sizes = np.fromiter(map(len, some), np.int64, len(some))
        of_byte = np.repeat(np.arange(len(some)), sizes + 1)
        kinds = np.bincount(of_byte * k + _CLASS[w.buffer], minlength=len(some) * k).reshape(-1, k)
        share = kinds / np.maximum(1, sizes)[:, None]
        of_word = np.repeat(np.arange(len(some)), n)
        length = w.ends - w.starts
        words = np.maximum(1, n)
        mean = np.bincount(of_word, weights=length, minlength=len(some)) / words
        square = np.bincount(of_word, weights=length * length, minlength=len(some)) / words
        last, opens = _CLASS[w.buffer[w.ends - 1]], _CLASS[w.buffer[w.starts]]
        ends_in = [np.bincount(of_word[last == c], minlength=len(some)) / words for c in (4, 5, 7)]
        one = np.bincount(of_word[length == 1], minlength=len(some)) / words
        title = np.bincount(of_word[opens == 0], minlength=len(some)) / words
        distinct, repeated_pairs = np.ones(len(some)), np.zeros(len(some))
        pairs = w.digests[:-1] * np.uint64(0x9E3779B97F4A7C15) + w.digests[1:] if len(w.digests) else w.digests
        for d, (a, b) in enumerate(zip(w.first[:-1].tolist(), w.first[1:].tolist())):
            if b - a > 1:
                distinct[d] = len(np.unique(w.digests[a:b])) / (b - a)
                repeated_pairs[d] = 1 - len(np.unique(pairs[a:b - 1])) / (b - 1 - a)
        out.append(np.column_stack([np.log1p(sizes), np.log1p(n), share, mean, np.sqrt(np.maximum(0, square - mean * mean)),
                                    *ends_in, one, title, distinct, repeated_pairs]))
    return np.concatenate(out) if out else np.zeros((0, CONTENT))


CONTENT = 2 + len(_BYTE_CLASSES) + 1 + 2 + 3 + 4
METADATA = SOURCE_CELLS + LANG_CELLS + 2


def metadata_features(source: list, lang: list, n_chars: list) -> np.ndarray:
    """The metadata view: hashed source and language, and the length on record; nulls are values of their own."""
    out = np.zeros((len(source), METADATA))
    rows = np.arange(len(source))
    cell = lambda v, n: [zlib.crc32(repr(x).encode()) % n for x in v]
    out[rows, cell(source, SOURCE_CELLS)] = 1
    out[rows, [SOURCE_CELLS + c for c in cell(lang, LANG_CELLS)]] = 1
    out[:, -2] = [np.log1p(max(0, x)) if x is not None else 0 for x in n_chars]
    out[:, -1] = [x is None for x in n_chars]
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1.0) -> np.ndarray:
    """Weights (the last one the intercept) of a ridge logistic regression, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    weight = np.ones(len(y)) if weight is None else weight
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = sigmoid(x @ w)
        curve = np.maximum(p * (1 - p), 1e-6) * weight
        step = np.linalg.solve((x * curve[:, None]).T @ x + np.diag(penalty), x.T @ (weight * (y - p)) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


class View:
    """A calibrated classifier over one view's features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trusted: np.ndarray):
        """Fitted to all rows, calibrated on the trusted ones (true labels) by folds."""
        self.mean, self.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
        z = (x - self.mean) / self.scale
        fold = np.arange(len(y)) % FOLDS
        self.out_of_fold = np.zeros(len(y))
        for f in range(FOLDS):
            self.out_of_fold[fold == f] = self._raw(z[fold == f], fit_logistic(z[fold != f], y[fold != f]))
        self.calibration = fit_logistic(self.out_of_fold[trusted, None], y[trusted])
        self.weights = fit_logistic(z, y)

    @staticmethod
    def _raw(z: np.ndarray, w: np.ndarray) -> np.ndarray:
        return np.clip(z @ w[:-1] + w[-1], -30, 30)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return self.calibration[0] * self._raw((x - self.mean) / self.scale, self.weights) + self.calibration[1]


class CoTrained:
    """Two views and what combines them. With labels of one class only, or none, every document
    gets the same score: that class's, or 1."""

    def __init__(self, content: np.ndarray, metadata: np.ndarray, y: np.ndarray, pool_content: np.ndarray, pool_metadata: np.ndarray,
                 rounds: int = ROUNDS):
        self.constant = None
        if len(np.unique(y)) < 2 or np.bincount(y.astype(int)).min() < FOLDS:
            self.constant = float(np.round(y.mean())) if len(y) else 1.0
            return
        n, views = len(y), (content, metadata)
        pools = (pool_content, pool_metadata)
        given: list[dict[int, float]] = [{}, {}]  # the pool's rows that the other view has labelled for a view
        for r in range(rounds + 1):
            self.views = []
            for v in (0, 1):
                rows = sorted(given[v])
                x = np.concatenate([views[v], pools[v][rows]])
                labels = np.concatenate([y, [given[v][i] for i in rows]])
                self.views.append(View(x, labels, np.arange(len(labels)) < n))
            if r == rounds:
                break
            for v in (0, 1):
                p = sigmoid(self.views[v].log_odds(pools[v])) if len(pools[v]) else np.zeros(0)
                sure = np.flatnonzero(np.maximum(p, 1 - p) >= CONFIDENT)
                sure = sure[np.argsort(-np.maximum(p, 1 - p)[sure], kind="stable")][:int(GIVEN * len(p))]
                given[1 - v].update((int(i), float(p[i] > 0.5)) for i in sure if int(i) not in given[1 - v])
        both = np.column_stack([v.calibration[0] * v.out_of_fold[:n] + v.calibration[1] for v in self.views])
        self.together = fit_logistic(both, y)

    def score(self, content: np.ndarray, metadata: np.ndarray) -> np.ndarray:
        """Columns: probability by content, by metadata, and by both."""
        if self.constant is not None:
            return np.full((len(content), 3), self.constant)
        odds = [v.log_odds(x) for v, x in zip(self.views, (content, metadata))]
        return np.column_stack([sigmoid(odds[0]), sigmoid(odds[1]), sigmoid(np.column_stack(odds) @ self.together[:2] + self.together[2])])


_INPUT = ("text", "source", "lang", "n_chars")


def _features_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    column = {c: batch.column(c) for c in _INPUT}
    return (content_features(column["text"].cast(pa.binary()).to_pylist()),
            metadata_features(*(column[c].to_pylist() for c in ("source", "lang", "n_chars"))))


def _feature_rows(batches):
    for batch in slices(batches):
        content, metadata = _features_of(batch)
        arrays = [pa.array(list(x), pa.list_(pa.float64())) for x in (content, metadata)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), *arrays], names=["doc_id", "y", "content", "metadata"])


def _portion(total: int, most: int):
    """Rows whose id's digest lies in the first ``most / total`` of all digests."""
    return F.pmod(F.xxhash64("doc_id", F.lit(41)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, most / max(1, total)))


def _view_columns(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("source").cast("string").alias("source"),
                       F.col("lang").cast("string").alias("lang"), F.col("n_chars").cast("long").alias("n_chars"))


_EMPTY = (np.zeros((0, CONTENT)), np.zeros((0, METADATA)))


def _model_row(model: CoTrained) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])


def _fit(batches):
    """The sample's rows (``doc_id, y, content, metadata, at``) → the classifier fitted to them, in bytes."""
    batches = [b for b in batches if b.num_rows]
    if not batches:
        yield _model_row(CoTrained(*_EMPTY, np.zeros(0), *_EMPTY))
        return
    rows = pa.Table.from_batches(batches)
    # rows of one id in the order in which the tables gave them
    rows = rows.sort_by([("doc_id", "ascending"), ("at", "ascending")])
    y, ids = rows.column("y"), rows.column("doc_id").fill_null(0).to_numpy()
    known = np.flatnonzero(y.is_valid().to_numpy())
    rest = np.flatnonzero(y.is_null().to_numpy())
    known = known[np.unique(ids[known], return_index=True)[1]]

    def view(name: str, width: int, some: np.ndarray) -> np.ndarray:
        return pa.concat_arrays([c.flatten() for c in rows.column(name).chunks]).to_numpy().reshape(-1, width)[some]
    views = [view(name, width, some) for some in (known, rest) for name, width in (("content", CONTENT), ("metadata", METADATA))]
    yield _model_row(CoTrained(*views[:2], y.to_numpy()[known].astype(float), *views[2:]))


def train(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, unlabelled: int = UNLABELLED) -> CoTrained:
    """A classifier from ``labels`` (``doc_id, quality`` 0 or 1; nulls are no labels; of several
    labels of an id the largest holds) and ``docs``. It is fitted by a task to about
    ``labelled`` labelled and ``unlabelled`` other documents, chosen by digest of the id over the
    whole tables; only the classifier comes to the driver."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").cast("double").alias("y"))
    known = store(known, "quality-labels")
    chosen = known.where(_portion(known.count(), labelled))
    rows = _view_columns(docs)
    some = rows.join(sized_side(chosen), "doc_id")
    others = rows.where(_portion(docs.count(), unlabelled)).join(known.select("doc_id"), "doc_id", "left_anti").withColumn("y", F.lit(None).cast("double"))
    columns = ["doc_id", "y", *_INPUT]
    sample = some.select(columns).unionByName(others.select(columns))
    found = sample.mapInArrow(_feature_rows, "doc_id long, y double, content array<double>, metadata array<double>")
    fitted = found.withColumn("at", F.monotonically_increasing_id()).repartition(1).mapInArrow(_fit, "model binary").collect()
    return pickle.loads(fitted[0]["model"]) if fitted else CoTrained(*_EMPTY, np.zeros(0), *_EMPTY)


def scores(docs: DataFrame, model: CoTrained) -> DataFrame:
    """``doc_id, p_content, p_metadata, score, kept`` for every row of ``docs``. A null text counts
    as an empty one; a null source, language or length is a value of its own."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in slices(batches):
            p = shared.value.score(*_features_of(batch))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(p[:, j]) for j in range(3)), pa.array(p[:, 2] >= THRESHOLD)],
                                             names=["doc_id", "p_content", "p_metadata", "score", "kept"])
    return _view_columns(docs).mapInArrow(run, "doc_id long, p_content double, p_metadata double, score double, kept boolean")


def quality_filter(docs: DataFrame, model: CoTrained) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in slices(batches):
            p = shared.value.score(*_features_of(batch))
            yield batch.filter(pa.array(p[:, 2] >= THRESHOLD))
    return docs.mapInArrow(run, docs.schema)
