"""Quality by co-training: a classifier of a document's content and one of its metadata teach each other."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowferry.llm.common import bounded_batches, discard, shared, store, utf8

# rows that the classifiers are fitted on, at most: labelled ones, and pseudo-labelled ones of a view, a mark and a round
LABELLED_SAMPLE, TAUGHT = 12_000, 800
CALIBRATION = 0.25
ROUNDS = 5
# of all unlabelled rows, the share that a classifier labels for the other one in a round, and how sure it must be
SHARE, SURE = 0.05, 0.95
# steps between SURE and certainty in which rows are counted
STEPS = 1000
BINS = 10
SOURCE_BUCKETS, LANGUAGE_BUCKETS = 64, 16
# classes of bytes whose shares are features: upper case, digits, white space, punctuation, symbols, beyond ASCII
BYTE_CLASSES = 8
CONTENT = 19
META = 3


def byte_table():
    import numpy as np

    table = np.zeros(256, np.int64)
    kinds = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n", ".,;:?'\"()-", "!", "#*$%&|<>@^~_=+/\\[]{}`"
    for kind, members in enumerate(kinds, 1):
        table[list(members.encode())] = kind
    table[128:] = BYTE_CLASSES
    return table


def content_features(text: bytes, table) -> list[float]:
    """Numbers about a whole text; all zero for an empty one."""
    import numpy as np

    words = text.split()
    if not words:
        return [0.0] * CONTENT
    kinds = np.bincount(table[np.frombuffer(text, np.uint8)], minlength=BYTE_CLASSES + 1)[1:] / len(text)
    lines = [line for line in text.split(b"\n") if line.strip()]
    n, distinct = len(words), len(set(words))
    sizes = np.fromiter(map(len, words), np.int64, n)
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    ended = sum(line.rstrip()[-1:] in (b".", b"!", b"?", b'"', b":") for line in lines)
    triples = len(set(zip(words, words[1:], words[2:], strict=False)))
    return [
        *kinds.tolist(),
        float(np.log1p(n)),
        float(sizes.mean()),
        float(sizes.std()),
        float(np.log1p(sizes.max())),
        distinct / n**0.8,
        triples / max(n - 2, 1),
        same / n,
        len(set(lines)) / len(lines),
        ended / len(lines),
        n / len(lines),
        float((sizes == 1).mean()),
    ]


class View:
    """A logistic classifier over binned numbers and hashed categories, calibrated by Platt's scaling."""

    def __init__(self, categories: tuple[int, ...]):
        self.categories = categories  # buckets of each category column, which follow the number columns
        self.edges, self.weights, self.slope, self.shift = [], None, 1.0, 0.0

    def bins(self, numbers) -> None:
        import numpy as np

        shares = np.linspace(0, 1, BINS + 1)[1:-1]
        self.edges = [np.unique(np.quantile(c, shares)) if len(c) else np.zeros(0) for c in numbers.T]

    def cells(self, numbers, categories):
        """For every row the weights that it adds up."""
        import numpy as np

        out, at = [], 1
        for edges, column in zip(self.edges, numbers.T, strict=True):
            out.append(at + np.searchsorted(edges, column, "right"))
            at += BINS + 1
        for size, column in zip(self.categories, categories.T, strict=True):
            out.append(at + column % size)
            at += size
        return np.stack([np.zeros(len(numbers), np.int64), *out], 1), at

    def fit(self, numbers, categories, marks, steps: int = 200) -> None:
        """Gradient descent (Adagrad) on the log loss with a small pull to zero, both classes weighing the same."""
        import numpy as np

        cells, size = self.cells(numbers, categories)
        self.weights = np.zeros(size)
        share = marks.mean() if len(marks) else 0.5
        if not 0 < share < 1:
            self.weights[0] = 5.0 * (1 if share == 1 else -1)
            return
        weight = np.where(marks == 1, 0.5 / share, 0.5 / (1 - share)) / len(marks)
        state = np.full(size, 1e-8)
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(self.weights[cells].sum(1), -30, 30)))
            grad = np.bincount(cells.ravel(), np.repeat(weight * (p - marks), cells.shape[1]), size) + 1e-5 * self.weights
            state += grad * grad
            self.weights -= 0.3 * grad / np.sqrt(state)

    def raw(self, numbers, categories):
        return self.weights[self.cells(numbers, categories)[0]].sum(1)

    def calibrate(self, raw, marks) -> None:
        self.slope, self.shift = platt(raw[:, None], marks)

    def chance(self, numbers, categories):
        import numpy as np

        return 1 / (1 + np.exp(-np.clip(self.slope * self.raw(numbers, categories) + self.shift, -30, 30)))


def platt(raw, marks):
    """Slopes and shift of a logistic function of given scores by Newton's steps, with smoothed targets."""
    import numpy as np

    x = np.concatenate([raw, np.ones((len(raw), 1))], 1)
    w = np.append(np.full(raw.shape[1], 1.0 / raw.shape[1]), 0.0)
    if not len(marks) or not 0 < marks.sum() < len(marks):
        return tuple(w)
    target = np.where(marks == 1, (marks.sum() + 1) / (marks.sum() + 2), 1 / (len(marks) - marks.sum() + 2))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - target) + 1e-3 * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w - step * min(1.0, 3 / max(np.abs(step).max(), 1e-9))
    return tuple(float(v) for v in w)


class CoTrained:
    """Both views and the calibrated combination of their scores."""

    def __init__(self) -> None:
        self.content = View(())
        self.meta = View((LANGUAGE_BUCKETS, SOURCE_BUCKETS))
        self.mix = (1.0, 1.0, 0.0)
        self.taught = [0, 0]

    def parts(self, numbers, categories):
        """The inputs of the content view and of the metadata view."""
        return (numbers[:, :CONTENT], categories[:, :0]), (numbers[:, CONTENT:], categories)

    def fit(self, labelled, marks, surest: Callable[[CoTrained], list[list[tuple]]]) -> None:
        """Each round both views are fitted on their labels and name, for the other view, the surest unlabelled rows.

        `surest` gives, by view and mark, those rows as (key, numbers, categories).
        """
        import numpy as np

        numbers, categories = labelled
        views, inputs = (self.content, self.meta), self.parts(numbers, categories)
        cut = int(len(marks) * CALIBRATION)
        taught: list[dict] = [{}, {}]
        for view, (x, _) in zip(views, inputs, strict=True):
            view.bins(x)
        for round_ in range(ROUNDS + 1):
            for i, (view, (x, c)) in enumerate(zip(views, inputs, strict=True)):
                more = list(taught[i].values())
                part = self.parts(
                    np.array([r[0] for r in more], float).reshape(-1, CONTENT + META),
                    np.array([r[1] for r in more], np.int64).reshape(-1, 2),
                )[i]
                labels = np.concatenate([marks[cut:], [r[2] for r in more]]).astype(float)
                view.fit(np.concatenate([x[cut:], part[0]]), np.concatenate([c[cut:], part[1]]), labels)
                view.calibrate(view.raw(x[:cut], c[:cut]), marks[:cut].astype(float))
            if round_ == ROUNDS:
                break
            for i, by_mark in enumerate(surest(self)):
                for mark, rows in enumerate(by_mark):
                    for key, x, c in rows:
                        # the first label of a row stays
                        taught[1 - i].setdefault(key, (x, c, mark))
        self.taught = [len(t) for t in taught]
        scores = self.logits(numbers[:cut], categories[:cut])
        self.mix = platt(scores, marks[:cut].astype(float))

    def logits(self, numbers, categories):
        import numpy as np

        pairs = zip((self.content, self.meta), self.parts(numbers, categories), strict=True)
        return np.stack([v.slope * v.raw(x, c) + v.shift for v, (x, c) in pairs], 1)

    def score(self, numbers, categories):
        """Chances of good quality: by content, by metadata, combined."""
        import numpy as np

        logits = self.logits(numbers, categories)
        both = logits @ np.array(self.mix[:2]) + self.mix[2]
        return 1 / (1 + np.exp(-np.clip(np.concatenate([logits, both[:, None]], 1), -30, 30)))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def batch_features(batch):
    """Numbers and categories of an Arrow batch of (doc_id, text, lang, source, n_chars)."""
    import numpy as np

    table = byte_table()
    content = np.array([content_features(t, table) for t in utf8(batch.column(1))], np.float64).reshape(-1, CONTENT)
    chars = [x if x is not None else -1 for x in batch.column(4).to_pylist()]
    meta = [[np.log1p(max(c, 0)), float(c < 0), float(str(c)[-1:] == "0")] for c in chars]
    names = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
    categories = [[zlib.crc32(repr(x).encode()) for x in pair] for pair in names]
    meta = np.array(meta, np.float64).reshape(-1, META)
    return np.concatenate([content, meta], 1), np.array(categories, np.int64).reshape(-1, 2)


def inputs_of(docs: DataFrame) -> DataFrame:
    kinds = {"doc_id": "long", "text": "string", "lang": "string", "source": "string", "n_chars": "long"}
    return docs.select(*(F.col(c).cast(t) for c, t in kinds.items()))


def features_of(rows: DataFrame, *carry: str) -> DataFrame:
    """The given columns with x and c, the numbers and categories of documents."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, categories = batch_features(batch)
            columns = [*batch.columns[5:], pa.array(numbers.tolist(), pa.list_(pa.float64())), pa.array(categories.tolist(), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, [*carry, "x", "c"])

    inputs = ("doc_id", "text", "lang", "source", "n_chars")
    kinds = ", ".join(f"{name} {rows.schema[name].dataType.simpleString()}" for name in carry)
    return rows.select(*inputs, *carry).mapInArrow(run, f"{kinds}, x array<double>, c array<long>")


def sure_of(free: DataFrame, model: CoTrained) -> DataFrame:
    """All unlabelled rows with s, how sure each view is of each mark: content 0, content 1, metadata 0, metadata 1."""
    import numpy as np
    import pyarrow as pa

    sent = shared(free.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = sent()
        for batch in batches:
            numbers = batch.column(1).flatten().to_numpy().reshape(-1, CONTENT + META)
            categories = batch.column(2).flatten().to_numpy().reshape(-1, 2)
            chance = [v.chance(*part) for v, part in zip((fitted.content, fitted.meta), fitted.parts(numbers, categories), strict=True)]
            sure = np.stack([1 - chance[0], chance[0], 1 - chance[1], chance[1]], 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sure.tolist(), pa.list_(pa.float64()))], ["key", "x", "c", "s"])

    return free.mapInArrow(run, "key long, x array<double>, c array<long>, s array<double>")


def named(free: DataFrame, n_free: int, good: float, model: CoTrained) -> list[list[tuple]]:
    """By view and mark the surest of all unlabelled rows: SHARE of them, as the marks are shared out among the labels.

    How many rows are how sure is counted over all of them; of those that are sure enough, the TAUGHT with the smallest keys teach.
    """
    sure = sure_of(free, model)
    step = lambda j: F.floor((F.col("s")[j] - SURE) / (1 - SURE) * STEPS).alias("step")
    counts = sure.select(F.explode(F.array(*[F.struct(F.lit(j).alias("j"), step(j)) for j in range(4)])).alias("e"))
    counts = counts.select("e.*").filter("step >= 0").groupBy("j", "step").count().collect()
    found: list[list[tuple]] = []
    parts = []
    for j in range(4):
        most = max(1, int(SHARE * n_free * (good if j % 2 else 1 - good)))
        least, above = 0, 0
        for row in sorted((r for r in counts if r["j"] == j), key=lambda r: -r["step"]):
            least, above = row["step"], above + row["count"]
            if above >= most:
                break
        taken = sure.filter(step(j) >= least).orderBy("key").limit(TAUGHT)
        parts.append(taken.select(F.lit(j).alias("j"), "key", "x", "c"))
    rows = reduce(DataFrame.unionByName, parts).collect()
    for view in range(2):
        marks = [sorted((r["key"], r["x"], r["c"]) for r in rows if r["j"] == 2 * view + mark) for mark in (0, 1)]
        found.append(marks)
    return found


def train(docs: DataFrame, labels: DataFrame) -> CoTrained:
    """Both classifiers, from labelled and all unlabelled rows that are not held out.

    The driver fits them on at most LABELLED_SAMPLE labelled rows, those with the smallest hashes of their ids and texts, and on
    what the views name; every unlabelled row is scored by both views in every round. Rows without doc_id take no part;
    repeated rows and ids count as rows of their own. Where nothing is unlabelled, the views learn from labels alone.
    """
    import numpy as np

    bounded_batches(docs.sparkSession)
    fit = ~held_out(F.col("doc_id"))
    marks = labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").cast("long").alias("mark"))
    rows = inputs_of(docs).filter("doc_id IS NOT NULL").filter(fit).withColumns({"key": F.xxhash64("doc_id", "text"), "id": F.col("doc_id")})
    # features before the joins, so that no text is shuffled
    seen = store(features_of(rows, "key", "id"), "features")
    marks = marks.withColumnRenamed("doc_id", "id")
    got = seen.join(marks, "id").orderBy("key", "id").limit(LABELLED_SAMPLE).collect()
    got = sorted(got, key=lambda r: (zlib.crc32(str(r["key"]).encode()), r["key"], r["x"], r["c"]))
    labelled = (
        np.array([r["x"] for r in got], float).reshape(-1, CONTENT + META),
        np.array([r["c"] for r in got], np.int64).reshape(-1, 2),
    )
    given = np.array([r["mark"] for r in got], np.int64)
    free = store(seen.join(marks.select("id"), "id", "left_anti").select("key", "x", "c"), "features")
    discard(seen)
    n_free = free.count()
    good = float(given.mean()) if len(given) else 0.5
    model = CoTrained()
    model.fit(labelled, given, lambda m: named(free, n_free, good, m) if n_free and 0 < good < 1 else [[[], []], [[], []]])
    discard(free)
    return model


def score_quality(docs: DataFrame, model: CoTrained) -> DataFrame:
    """doc_id, held_out, content_score, meta_score, score, predicted and kept for every row of `docs`.

    docs: doc_id long, text, lang, source, n_chars. Scores are chances of good quality; predicted is 1 and kept true from
    one half on. Null and empty texts have no content features, null languages and sources are categories, a null
    n_chars is a feature. Rows with a null doc_id are scored and not held out; repeated rows are scored alike. Without
    usable labels every score is the same. Other columns are ignored.
    """
    import pyarrow as pa

    spark = docs.sparkSession
    bounded_batches(spark)
    sent = shared(spark, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = sent()
        for batch in batches:
            scores = fitted.score(*batch_features(batch))
            columns = [batch.column(0), *(pa.array(x) for x in scores.T)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "content_score", "meta_score", "score"])

    scored = inputs_of(docs).mapInArrow(run, "doc_id long, content_score double, meta_score double, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "content_score",
        "meta_score",
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        (F.col("score") >= 0.5).alias("kept"),
    )
