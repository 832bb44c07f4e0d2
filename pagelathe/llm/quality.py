"""Quality classifier by co-training of two views of a document.

The content view sees the words, the metadata view the recorded fields of a
page and its layout (no words).  Each starts from the labelled documents; over
some rounds the documents of an unlabelled pool of which one view is most sure
are labelled for the other.  Each view is calibrated on labelled documents held
back from its training, and the calibrated log-odds of both are combined to
score every document.

Training works on a bounded sample (``FIT_ROWS`` labelled and ``POOL_ROWS``
unlabelled documents, whole texts, chosen by a hash of the id); its features,
not its texts, are gathered.  Scoring runs over all documents in the tasks.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most labelled and unlabelled documents that a fit uses.
FIT_ROWS, POOL_ROWS = 4_000, 4_000
ROUNDS, GROWTH = 3, 0.1
#: A pseudo-label needs this probability.
SURE = 0.95
#: Every so many labelled documents is held back for calibration.
HELD = 4
CONTENT, META_HASHED, META_PLAIN = 1 << 15, 64, 16
CACHE = 200_000
KEEP = 0.5
STEPS, RATE, RIDGE = 150, 0.5, 1e-4


class TokenFeatures(dict):
    """token -> the feature numbers of its lower-case form and of its end, 8 bytes."""

    def __missing__(self, token: str) -> bytes:
        if len(self) >= CACHE:
            self.clear()
        whole = xxhash.xxh32_intdigest("w" + token.lower()) % CONTENT
        end = xxhash.xxh32_intdigest("e" + token[-2:]) % CONTENT
        got = self[token] = np.array([whole, end], "<u4").tobytes()
        return got


def content_features(text: str, cache: TokenFeatures) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values of a whole text: damped word counts of unit length, repetition."""
    at = np.frombuffer(b"".join(map(cache.__getitem__, text.split())), "<u4")
    if not len(at):
        return at, np.empty(0, np.float32)
    words = at[::2]
    again = float((words[1:] == words[:-1]).mean()) if len(words) > 1 else 0.0
    at, n = np.unique(at, return_counts=True)
    value = np.log1p(n).astype(np.float32)
    value /= np.sqrt((value**2).sum())
    # The last two features: words that repeat the one before, and different words.
    extra = np.array([3 * again, len(np.unique(words)) / len(words)], np.float32)
    return np.append(at, np.array([CONTENT, CONTENT + 1], "<u4")), np.append(value, extra)


def metadata_features(text: str, lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    """Recorded fields and layout of a document as one dense row."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    n = max(len(codes), 1)
    small = np.bincount(codes[codes < 128], minlength=128)
    upper, lower, digit = small[65:91].sum(), small[97:123].sum(), small[48:58].sum()
    space, feeds = small[32] + small[9], small[10]
    stops = small[[33, 44, 46, 58, 59, 63]].sum()
    marks = small[33:127].sum() - upper - lower - digit - stops
    wide = (codes >= 128).sum()
    recorded = len(codes) if n_chars is None else n_chars
    octets = text.encode("utf-8", "surrogatepass")
    packed = len(zlib.compress(octets, 1)) / (len(octets) + 1)
    plain = [
        1.0,
        np.log1p(max(recorded, 0)) / 10,
        float(n_chars is None),
        upper / n * 5,
        digit / n * 5,
        space / n * 5,
        stops / n * 10,
        small[33] / n * 20,
        marks / n * 10,
        small[124] / n * 20,
        wide / n,
        np.log1p(feeds) / 5,
        np.log1p(n / (feeds + 1)) / 10,
        np.log1p(n / (space + feeds + 1)) / 3,
        min(packed, 2.0),
        max(0.0, 0.4 - packed) * 5,
    ]
    hashed = np.zeros(META_HASHED)
    for name, value in (("lang", lang), ("source", source)):
        hashed[xxhash.xxh32_intdigest(f"{name}={value}") % META_HASHED] += 0.5
    return np.concatenate([plain, hashed])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Linear:
    """Logistic regression over rows of (feature, value), full gradients with adaptive steps."""

    weights: np.ndarray

    @staticmethod
    def fit(row: np.ndarray, at: np.ndarray, value: np.ndarray, y: np.ndarray, width: int) -> Linear:
        w, seen = np.zeros(width + 1), np.full(width + 1, 1e-8)
        share = 1 / len(y)
        for _ in range(STEPS):
            p = sigmoid(np.bincount(row, value * w[at], minlength=len(y)) + w[-1])
            slack = (p - y) * share
            g = np.append(np.bincount(at, value * slack[row], minlength=width), slack.sum()) + RIDGE * w
            seen += g * g
            w -= RATE * g / np.sqrt(seen)
        return Linear(w)

    def logits(self, row: np.ndarray, at: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(row, value * self.weights[at], minlength=n) + self.weights[-1]


def platt(logit: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift that turn logits into calibrated log-odds."""
    a, b = 1.0, 0.0
    target = np.where(y > 0.5, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    for _ in range(100):
        p = sigmoid(a * logit + b)
        s = p * (1 - p) + 1e-9
        g = np.array([((p - target) * logit).sum() + 1e-3 * (a - 1), (p - target).sum()])
        h = np.array([[(s * logit * logit).sum() + 1e-3, (s * logit).sum()], [(s * logit).sum(), s.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
    return float(max(a, 0.0)), float(b)


@dataclass
class Model:
    """Both views, their calibration, and the log-odds of the training labels."""

    views: list[Linear]
    scale: list[tuple[float, float]]
    prior: float

    def plain(self) -> tuple:
        """The model as values that every worker can read."""
        return self.views[0].weights, self.views[1].weights, self.scale, self.prior


def combined(logits: list[np.ndarray], scale: list[tuple[float, float]], prior: float) -> list[np.ndarray]:
    """Probabilities of the content view, the metadata view, and both."""
    odds = [a * x + b for (a, b), x in zip(scale, logits, strict=True)]
    return [sigmoid(odds[0]), sigmoid(odds[1]), sigmoid(odds[0] + odds[1] - prior)]


class View:
    """The rows of one view of a sample as (row, feature, value)."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], width: int):
        self.rows, self.width = rows, width

    def pick(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        chosen = [self.rows[i] for i in which]
        row = np.repeat(np.arange(len(chosen)), [len(a) for a, _ in chosen])
        join = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)
        return row, join([a for a, _ in chosen], np.int64).astype(np.int64), join([v for _, v in chosen], np.float32)


def co_train(views: list[View], label: np.ndarray, rounds: int = ROUNDS) -> Model:
    """``label`` is 1, 0, or -1 for the pool; the order of rows decides all ties."""
    known = np.flatnonzero(label >= 0)
    held, used = known[::HELD], np.array([i for n, i in enumerate(known) if n % HELD])
    if len(set(label[held])) < 2 or len(set(label[used])) < 2:
        held = used = known
    sets = [{int(i): float(label[i]) for i in used} for _ in views]
    pool = np.flatnonzero(label < 0)

    def fitted(v: int) -> Linear:
        which = np.array(list(sets[v]))
        return Linear.fit(*views[v].pick(which), np.array(list(sets[v].values())), views[v].width)

    def calibrated(v: int, model: Linear) -> tuple[float, float]:
        return platt(model.logits(*views[v].pick(held), len(held)), label[held].astype(float))

    models = [fitted(v) for v in range(2)]
    for _ in range(rounds):
        if not len(pool):
            break
        for v in range(2):
            a, b = calibrated(v, models[v])
            p = sigmoid(a * models[v].logits(*views[v].pick(pool), len(pool)) + b)
            for value, sure in ((1.0, p), (0.0, 1 - p)):
                order = np.argsort(-sure, kind="stable")[: max(1, int(GROWTH * len(pool)))]
                for i in order[sure[order] >= SURE]:
                    sets[1 - v].setdefault(int(pool[i]), value)
        models = [fitted(v) for v in range(2)]
    good = min(max(label[known].mean(), 1e-3), 1 - 1e-3)
    return Model(models, [calibrated(v, models[v]) for v in range(2)], float(np.log(good / (1 - good))))


def _features():
    @F.arrow_udf("struct<at: binary, value: binary, meta: binary>")
    def features(text: pa.Array, lang: pa.Array, source: pa.Array, n_chars: pa.Array) -> pa.Array:
        cache, out = TokenFeatures(), []
        for t, g, s, n in zip(*(x.to_pylist() for x in (text, lang, source, n_chars)), strict=True):
            at, value = content_features(t, cache)
            out.append({"at": at.astype("<u4").tobytes(), "value": value.astype("<f4").tobytes(), "meta": metadata_features(t, g, s, n).astype("<f4").tobytes()})
        return pa.array(out, pa.struct([("at", pa.binary()), ("value", pa.binary()), ("meta", pa.binary())]))

    return features


#: Fields of the metadata view.
FIELDS = (("lang", "string"), ("source", "string"), ("n_chars", "bigint"))


def _inputs(docs: DataFrame, text_col: str) -> list:
    """The columns of the two views, absent ones as null."""
    fields = [(F.col(c) if c in docs.columns else F.lit(None)).cast(kind).alias(c) for c, kind in FIELDS]
    return [F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *fields]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", fit_rows: int = FIT_ROWS, pool_rows: int = POOL_ROWS, rounds: int = ROUNDS) -> Model | None:
    """Fit on a bounded sample; None if there are no labels of both classes."""
    marks = labels.where(f"{id_col} IS NOT NULL AND {label_col} IS NOT NULL").groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
    order = F.xxhash64("id")
    # The sample is chosen on ids alone, then their documents are fetched.
    ids = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id")).distinct().join(marks, "id", "left")
    chosen = ids.where("label IS NOT NULL").orderBy(order, "id").limit(fit_rows).unionByName(ids.where("label IS NULL").orderBy(order, "id").limit(pool_rows))
    rows = docs.select(F.col(id_col).alias("id"), *_inputs(docs, text_col))
    found = rows.join(F.broadcast(chosen), "id").select("id", "label", _features()("text", "lang", "source", "n_chars").alias("f")).select("id", "label", "f.*")  # fit_rows + pool_rows ids
    sample = found.toArrow()
    sample = sample.sort_by([("id", "ascending"), ("at", "ascending")])
    label = np.array([-1 if x is None else x for x in sample.column("label").to_pylist()])
    if len(set(label[label >= 0])) < 2:
        return None
    content = [(np.frombuffer(a, "<u4"), np.frombuffer(v, "<f4")) for a, v in zip(sample.column("at").to_pylist(), sample.column("value").to_pylist(), strict=True)]
    every = np.arange(META_PLAIN + META_HASHED)
    meta = [(every, np.frombuffer(m, "<f4")) for m in sample.column("meta").to_pylist()]
    return co_train([View(content, CONTENT + 2), View(meta, len(every))], label, rounds)


def score(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """Every input row as ``row`` with p_content, p_metadata and score.

    Without a model all three are null.  Null texts are empty texts, absent or
    null fields are a value of their own.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    if model is None:
        none = F.lit(None).cast("double")
        return docs.select(row, none.alias("p_content"), none.alias("p_metadata"), none.alias("score"))
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast(model.plain())  # one weight per feature number

    @F.arrow_udf("struct<p_content: double, p_metadata: double, score: double>")
    def scored(text: pa.Array, lang: pa.Array, source: pa.Array, n_chars: pa.Array) -> pa.Array:
        (words, fields, scale, prior), cache, logits = shipped.value, TokenFeatures(), []
        for i in range(len(text)):
            t = text[i].as_py()
            at, value = content_features(t, cache)
            meta = metadata_features(t, lang[i].as_py(), source[i].as_py(), n_chars[i].as_py()).astype("<f4")
            logits.append((value @ words[at] + words[-1] if len(at) else words[-1], meta @ fields[:-1] + fields[-1]))
        both = np.array(logits).reshape(-1, 2)
        parts = combined([both[:, 0], both[:, 1]], scale, prior)
        return pa.StructArray.from_arrays([pa.array(p, pa.float64()) for p in parts], ["p_content", "p_metadata", "score"])

    return docs.select(row, scored(*_inputs(docs, text_col)).alias("s")).select("row", "s.p_content", "s.p_metadata", "s.score")


def classify(docs: DataFrame, labels: DataFrame, keep: float = KEEP, **options) -> DataFrame:
    """Every row with its scores and ``kept``: a score of ``keep`` or more, or no model."""
    scored = score(docs, fit(docs, labels, **options))
    return scored.withColumn("kept", F.coalesce(F.col("score") >= keep, F.lit(True)))
