"""Toxicity by a convolutional text classifier over hashed word embeddings.

A bounded sample gives the classifier its start. All labelled rows then count the words of both classes, take gradient
steps in shards whose moves are averaged after each round, and calibrate the scores and thresholds.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowferry.llm.common import bounded_batches, discard, numbered, shared, store, utf8

BUCKETS = 1 << 18
DIMENSIONS = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
# beginnings of a word, in bytes, that have embeddings of their own beside the whole word
STEMS = (4, 5, 6)
# what the classifier learns beside the embeddings
DENSE = ("filters", "bias", "output", "offset")
EPOCHS = 4
BATCH = 64
SEED = 7
# labelled documents the classifier starts from, at most: toxic ones, others, and the characters of one
TOXIC_SAMPLE, OTHER_SAMPLE, SAMPLE_CHARS = 3000, 6000, 20_000
# share of the rows that is kept out of the fit, for calibration
CALIBRATION = 0.25
# passes over all labelled rows, and the bytes of text that one shard of a pass learns from, about
ROUNDS = 2
SHARD_BYTES = 32_000_000
# words of a batch, unless one text has more
BATCH_WORDS = 100_000
# moves of shards are added up as whole numbers of this part, so that their order does not matter
PART = 2.0**40
# columns in which a shard gives its moves: those of a bucket's embedding, then of its sums of squares
MOVES = [f"m{i}" for i in range(2 * DIMENSIONS)]
# logits are counted for the calibration in steps of this part, up to this size
LOGIT_STEPS, LOGIT_MOST = 256, 30
# rows of projected words that a task keeps
CACHE_WORDS = 300_000
PUNCTUATION = b".,;:!?()[]{}\"'`*_<>/|-"


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def buckets_of(word: bytes) -> list[int]:
    """The hash buckets of a word without the punctuation around it, and of its beginnings."""
    word = word.strip(PUNCTUATION) or word
    # beginnings get another first byte, so that they are apart from short words
    parts = [word, *(b"^" + word[:k] if len(word) >= k else b"" for k in STEMS)]
    return [zlib.crc32(p) % (BUCKETS - 1) + 1 if p else 0 for p in parts]


class Classifier:
    """Word embeddings (sums over a word's buckets), filters over one to three words, maximum over a text, logistic."""

    def __init__(self) -> None:
        import numpy as np

        random = np.random.default_rng(SEED)
        self.embedding = random.normal(0, 0.02, (BUCKETS, DIMENSIONS)).astype(np.float32)
        self.embedding[0] = 0
        # columns: for every width, for every word of the window, every filter
        self.filters = random.normal(0, 0.3, (DIMENSIONS, sum(WIDTHS) * FILTERS)).astype(np.float32)
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.output = random.normal(0.3, 0.1, len(WIDTHS) * FILTERS).astype(np.float32)
        self.offset = np.float32(-1)
        self.slope, self.shift = 1.0, 0.0
        self.thresholds: dict[str | None, float] = {}
        # first dimensions as the class counts give them, and Adagrad's sums of squares; none before the first steps
        self.prior, self.state = None, None

    def project(self, words: list[bytes]):
        """The filters' shares of each word: a row per word."""
        import numpy as np

        if not words:
            return np.zeros((0, self.filters.shape[1]), np.float32)
        table = np.array([buckets_of(w) for w in words], np.int64)
        return self.embedding[table].sum(axis=1) @ self.filters

    def pooled(self, projected, ids, starts, ends, places: bool = False):
        """Maxima of every filter over each text, and on demand the places they come from.

        ids: rows of `projected`, where two rows of zeros follow each text; starts, ends: the texts in ids.
        """
        import numpy as np

        cuts = np.stack([starts, ends], 1).ravel()
        out, where, at = [], [], 0
        for width in WIDTHS:
            total = np.zeros((len(ids), FILTERS), np.float32)
            for k in range(width):
                total[: len(ids) - k] += projected[ids[k:], at : at + FILTERS]
                at += FILTERS
            if places:
                where.append(np.stack([s + total[s:e].argmax(axis=0) for s, e in zip(starts, ends, strict=True)]))
            out.append(np.maximum.reduceat(total, cuts, axis=0)[::2])
        best = np.concatenate(out, 1) + self.bias
        return (best, np.concatenate(where, 1)) if places else best

    def logits(self, best):
        import numpy as np

        return np.maximum(best, 0) @ self.output + self.offset

    def fit(self, texts: list[list[bytes]], marks: list[int]) -> None:
        """Stochastic gradient steps (Adagrad), both classes weighing the same.

        The first dimension of a bucket starts from its log odds of being in a toxic text, shrunk where it is rare.
        """
        import numpy as np

        y = np.array(marks, np.float32)
        if not 0 < y.sum() < len(y):
            self.offset = np.float32(5 if len(y) and y.all() else -5)
            self.output[:] = 0
            return
        vocabulary = {w: i + 1 for i, w in enumerate(dict.fromkeys(w for t in texts for w in t))}
        table = np.array([[0] * (1 + len(STEMS)), *map(buckets_of, vocabulary)], np.int64)
        docs = [np.array([vocabulary[w] for w in t] or [0], np.int64) for t in texts]
        seen = np.zeros((2, BUCKETS), np.float32)
        for ids, mark in zip(docs, marks, strict=True):
            seen[mark, np.unique(table[ids])] += 1
        n, p = float((y == 0).sum()), float(y.sum())
        self.lean(seen, n, p)
        weight = np.where(y == 1, 0.5 / p, 0.5 / n) * len(y)
        random = np.random.default_rng(SEED)
        for _ in range(EPOCHS):
            self.epoch(docs, table, y, weight, random.permutation(len(docs)))

    def lean(self, seen, n: float, p: float) -> None:
        """First dimensions from the texts of both classes that have a bucket; from new counts they move by the change."""
        import numpy as np

        odds = np.log((seen[1] + 0.5) / (p + 1)) - np.log((seen[0] + 0.5) / (n + 1))
        prior = (0.3 * odds * seen.sum(0) / (seen.sum(0) + 5)).astype(np.float32)
        prior[0] = 0
        if self.prior is None:
            self.embedding[:, 0] = prior
            self.filters[0] = np.abs(self.filters[0])
        else:
            self.embedding[:, 0] += prior - self.prior
        self.prior = prior

    def epoch(self, docs: list, table, y, weight, order) -> None:
        """One pass of gradient steps. docs: a row of `table` for each word; table: the buckets of a word."""
        import numpy as np

        if self.state is None:
            self.state = {name: np.full_like(getattr(self, name), 1e-4) for name in ("embedding", *DENSE)}
        state = self.state

        def move(name, grad, rate=0.05):
            state[name] += grad * grad
            setattr(self, name, getattr(self, name) - rate * grad / np.sqrt(state[name]))

        column = np.cumsum([0, *(w * FILTERS for w in WIDTHS)])
        low = 0
        while low < len(order):
            high, total = low, 0
            while high < min(low + BATCH, len(order)) and (high == low or total + len(docs[order[high]]) <= BATCH_WORDS):
                total += len(docs[order[high]])
                high += 1
            picked, low = order[low:high], high
            local, ids = np.unique(np.concatenate([np.concatenate([docs[i], (0, 0)]) for i in picked]), return_inverse=True)
            sizes = np.array([len(docs[i]) for i in picked])
            ends = np.cumsum(sizes + 2) - 2
            vectors = self.embedding[table[local]].sum(axis=1)
            best, where = self.pooled(vectors @ self.filters, ids, ends - sizes, ends, True)
            out = 1 / (1 + np.exp(-np.clip(self.logits(best), -30, 30)))
            error = ((out - y[picked]) * weight[picked] / len(picked)).astype(np.float32)
            active = np.maximum(best, 0)
            back = error[:, None] * self.output * (best > 0)
            move("output", active.T @ error)
            move("offset", error.sum())
            move("bias", back.sum(0))
            filters, words = np.zeros_like(self.filters), np.zeros_like(vectors)
            for j, width in enumerate(WIDTHS):
                part = slice(j * FILTERS, (j + 1) * FILTERS)
                for k in range(width):
                    rows = ids[np.minimum(where[:, part] + k, len(ids) - 1)]
                    columns = slice(column[j] + k * FILTERS, column[j] + (k + 1) * FILTERS)
                    filters[:, columns] = np.einsum("bf,bfd->df", back[:, part], vectors[rows])
                    np.add.at(words, rows, back[:, part, None] * self.filters[:, columns].T[None])
            move("filters", filters)
            hit = np.flatnonzero(np.abs(words).sum(1))
            cells = table[local[hit]].ravel()
            used, inverse = np.unique(cells, return_inverse=True)
            grad = np.zeros((len(used), DIMENSIONS), np.float32)
            np.add.at(grad, inverse, np.repeat(words[hit], table.shape[1], 0))
            grad[used == 0] = 0
            state["embedding"][used] += grad * grad
            self.embedding[used] -= 0.05 * grad / np.sqrt(state["embedding"][used])

    def calibrate(self, texts: list[list[bytes]], marks: list[int], languages: list[str | None], share: float) -> None:
        """Platt's scaling for the given share of toxic texts, and a threshold by language with the best F1."""
        import numpy as np

        y = np.array(marks, np.float64)
        if not 0 < y.sum() < len(y):
            return
        raw = np.concatenate([self.raw(texts[i : i + 256], {}) for i in range(0, len(texts), 256)]).astype(np.float64)
        self.scale(raw, y, np.ones(len(y)), share)
        score = 1 / (1 + np.exp(-np.clip(self.slope * raw + self.shift, -30, 30)))
        for language in set(languages):
            mine = np.array([x == language for x in languages])
            s, t = score[mine], y[mine]
            cuts = np.unique(np.append(s, 0.5))
            f1 = [2 * ((s >= c) & (t == 1)).sum() / max((s >= c).sum() + t.sum(), 1) for c in cuts]
            best = cuts[np.flatnonzero(f1 == np.max(f1))]
            # of equally good thresholds the one nearest to one half
            self.thresholds[language] = float(best[np.abs(best - 0.5).argmin()]) if t.any() else 0.5

    def scale(self, raw, y, times, share: float) -> None:
        """Platt's scaling from logits and marks, each standing for so many rows; starts from the scaling so far."""
        import numpy as np

        toxic, clean = times[y == 1].sum(), times[y == 0].sum()
        weight = times * np.where(y == 1, share / toxic, (1 - share) / clean)
        target = np.where(y == 1, (toxic + 1) / (toxic + 2), 1 / (clean + 2))
        a, b = self.slope, self.shift
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(a * raw + b, -30, 30)))
            grad = np.array([(weight * (p - target) * raw).sum() + 1e-4 * (a - 1), (weight * (p - target)).sum()])
            h = weight * p * (1 - p)
            hess = np.array([[(h * raw * raw).sum() + 1e-4, (h * raw).sum()], [(h * raw).sum(), h.sum() + 1e-6]])
            step = np.linalg.solve(hess, grad)
            step *= min(1.0, 2 / max(np.abs(step).max(), 1e-9))
            a, b = a - step[0], b - step[1]
        if a > 0:
            self.slope, self.shift = float(a), float(b)

    def raw(self, texts: list[list[bytes]], cache: dict) -> object:
        """Logits of texts given as words; cache: a task's rows by word, and under 0 the matrix of their projections."""
        import numpy as np

        if 0 not in cache or len(cache) > CACHE_WORDS:
            cache.clear()
            cache[0] = np.zeros((1, self.filters.shape[1]), np.float32)
            cache[1] = 1
        new = list(set().union(*texts) - cache.keys())
        if new:
            rows, first = self.project(new), cache[1]
            if first + len(new) > len(cache[0]):
                grown = np.zeros((max(2 * len(cache[0]), first + len(new)), rows.shape[1]), np.float32)
                grown[:first] = cache[0][:first]
                cache[0] = grown
            cache[0][first : first + len(new)] = rows
            cache.update(zip(new, range(first, first + len(new)), strict=True))
            cache[1] = first + len(new)
        out, low = [], 0
        while low < len(texts):  # some texts at a time, as each word takes a row of sums
            high, total = low, 0
            while high < len(texts) and (high == low or total + len(texts[high]) <= 100_000):
                total += len(texts[high])
                high += 1
            ids, sizes = [], []
            for words in texts[low:high]:
                ids.extend(map(cache.__getitem__, words))
                ids.extend((0, 0) if words else (0, 0, 0))
                sizes.append(len(words) or 1)
            sizes = np.array(sizes)
            ends = np.cumsum(sizes + 2) - 2
            out.append(self.logits(self.pooled(cache[0], np.array(ids, np.int64), ends - sizes, ends)))
            low = high
        return np.concatenate(out) if out else np.zeros(0, np.float32)

    def values(self) -> list:
        """Copies: a row per bucket, and rows of the same width for all else; values, then sums of squares."""
        import numpy as np

        state = self.state or {name: np.full_like(getattr(self, name), 1e-4) for name in ("embedding", *DENSE)}
        dense = [np.concatenate([np.ravel(of(name)) for name in DENSE]) for of in (lambda x: getattr(self, x), state.get)]
        size = -len(dense[0]) % DIMENSIONS
        dense = [np.append(x, np.zeros(size)).reshape(-1, DIMENSIONS) for x in dense]
        return [np.concatenate([self.embedding, state["embedding"]], 1).astype(np.float64), np.concatenate(dense, 1).astype(np.float64)]

    def move_by(self, at, moves) -> None:
        """Add moves to the rows of `values`: buckets from 0 on, all else from -1 down."""
        import numpy as np

        buckets, dense = self.values()
        buckets[at[at >= 0]] += moves[at >= 0]
        dense[-1 - at[at < 0]] += moves[at < 0]
        # sums of squares never fall, whatever the rounding
        self.embedding = buckets[:, :DIMENSIONS].astype(np.float32)
        self.state = {"embedding": np.maximum(buckets[:, DIMENSIONS:], 1e-4).astype(np.float32)}
        first, second = (np.ravel(x) for x in (dense[:, :DIMENSIONS], np.maximum(dense[:, DIMENSIONS:], 1e-4)))
        low = 0
        for name in DENSE:
            shape, size = np.shape(getattr(self, name)), np.size(getattr(self, name))
            setattr(self, name, first[low : low + size].reshape(shape).astype(np.float32))
            self.state[name] = second[low : low + size].reshape(shape).astype(np.float32)
            low += size

    def score(self, texts: list[list[bytes]], cache: dict):
        import numpy as np

        raw = np.asarray(self.raw(texts, cache), np.float64)
        return 1 / (1 + np.exp(-np.clip(self.slope * raw + self.shift, -30, 30)))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def place_of(doc_id: object) -> int:
    return zlib.crc32(f"{SEED}/{doc_id}".encode())


def train(docs: DataFrame, labels: DataFrame) -> Classifier:
    """A classifier fitted and calibrated on all labelled rows that are not held out.

    It starts from a fit on at most TOXIC_SAMPLE and OTHER_SAMPLE of them of at most SAMPLE_CHARS characters, those with the
    smallest hashes of their ids (of rows with one id, of their texts). Then `learn` goes over all rows, whole texts
    included. About a quarter, by hashes of ids, is kept out of both fits; the scaling and the thresholds come from all of
    that quarter. The share of toxic labels is counted over all labels that are not held out. Reruns agree.
    """
    marks = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out(F.col("doc_id")))
    marks = marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in marks.filter("toxic IN (0, 1)").groupBy("toxic").count().collect()}
    whole = numbered(docs.filter("doc_id IS NOT NULL").filter(~held_out(F.col("doc_id"))), "doc_id", "text", "lang")
    place = F.crc32(F.concat(F.lit(f"{SEED}/"), F.col("doc_id").cast("string")).cast("binary"))
    # one plan at every size: labels grow with the documents, so they are not broadcast
    rows_of = whole.join(marks.filter("toxic IN (0, 1)").hint("merge"), "doc_id").withColumn("place", place)
    labelled = store(rows_of.select("row", "doc_id", "place", "text", "lang", F.col("toxic").cast("int").alias("mark")), "labelled")
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.5
    model, edge = start(labelled, marks, share)
    model = learn(model, labelled.filter(F.col("place") >= edge))
    model.prior = model.state = None
    calibrate_all(model, labelled.filter(F.col("place") < edge), share)
    discard(labelled)
    return model


def start(labelled: DataFrame, marks: DataFrame, share: float) -> tuple[Classifier, int]:
    """A classifier fitted and calibrated on the sample, and the place below which rows are for calibration."""
    rows = []
    for mark, most in ((1, TOXIC_SAMPLE), (0, OTHER_SAMPLE)):
        sample = marks.filter(F.col("toxic") == mark).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        # at most `most` ids, and of ids that come several times no more rows than that
        short = labelled.filter(F.length("text") <= SAMPLE_CHARS).select("doc_id", "text", "lang")
        found = short.join(F.broadcast(sample), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"), "lang")
        rows += [(r["doc_id"], r["text"], r["lang"], mark) for r in found.limit(most).collect()]
    rows = sorted(rows, key=lambda r: (place_of(r[0]), r[0], r[1]))
    texts, marked = [words_of((r[1] or "").encode()) for r in rows], [r[3] for r in rows]
    cut = int(len(rows) * CALIBRATION)
    model = Classifier()
    model.fit(texts[cut:], marked[cut:])
    model.calibrate(texts[:cut], marked[:cut], [r[2] for r in rows[:cut]], share)
    # what the sample was fitted on is not for calibration; at least half of all places are fitted on
    return model, min(place_of(rows[cut][0]), 1 << 31) if rows else int(CALIBRATION * (1 << 32))


def class_counts(labelled: DataFrame) -> DataFrame:
    """bucket, mark and n: the texts of a mark that have a word in the bucket."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        seen, known = np.zeros((2, BUCKETS), np.int64), {}
        for batch in batches:
            for text, mark in zip(utf8(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                found: set[int] = set()
                for word in set(words_of(text)):
                    if word not in known:
                        if len(known) > CACHE_WORDS:
                            known.clear()
                        known[word] = buckets_of(word)
                    found.update(known[word])
                seen[mark, list(found or {0})] += 1
        for mark in (0, 1):
            at = np.flatnonzero(seen[mark])
            columns = [pa.array(at), pa.array(np.full(len(at), mark, np.int32)), pa.array(seen[mark, at])]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "mark", "n"])

    parts = labelled.select("text", "mark").mapInArrow(run, "bucket long, mark int, n long")
    return parts.groupBy("bucket", "mark").agg(F.sum("n").alias("n"))


def learn(model: Classifier, labelled: DataFrame) -> Classifier:
    """The classifier after ROUNDS passes over all rows of `labelled` (row, text, mark).

    Rows are dealt to shards of about SHARD_BYTES by their numbers. In a round every shard takes the steps of one epoch from the
    same start; the moves of a bucket are averaged over the shards that have it, all other moves over all shards. What
    comes to the driver is at most a row per bucket.
    """
    import numpy as np
    import pyarrow as pa

    spark = labelled.sparkSession
    bounded_batches(spark)
    sums = labelled.agg(
        F.count_if(F.col("mark") == 0).alias("n"), F.count_if(F.col("mark") == 1).alias("p"), F.sum(F.octet_length("text")).alias("bytes")
    ).first()
    n, p = sums["n"], sums["p"]
    if not n or not p:
        return model
    if model.prior is None:  # no start from a sample with one class
        model = Classifier()
    seen, found = np.zeros((2, BUCKETS), np.float32), class_counts(labelled).toArrow()
    seen[found.column("mark").to_numpy(), found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    model.lean(seen, n, p)
    weights = np.array([0.5 / n, 0.5 / p]) * (n + p)
    shards = (sums["bytes"] or 0) // SHARD_BYTES + 1
    dealt = labelled.select(F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard"), "row", "text", "mark")

    def steps(sent: Callable[[], Classifier], number: int) -> Callable[[pa.Table], pa.Table]:
        def run(rows: pa.Table) -> pa.Table:
            mine, vocabulary, docs = sent(), {}, []
            for text in utf8(rows.column("text")):
                ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)]
                docs.append(np.array(ids or [0], np.int32))
            table = np.array([[0] * (1 + len(STEMS)), *map(buckets_of, vocabulary)], np.int64)
            del vocabulary
            y = rows.column("mark").to_numpy()
            # by number, as the shuffle brings the rows in any order
            order = np.argsort(rows.column("row").to_numpy())
            order = order[np.random.default_rng([SEED, number]).permutation(len(order))]
            before = mine.values()
            mine.epoch(docs, table, y.astype(np.float32), weights[y], order)
            moved = [a - b for a, b in zip(mine.values(), before, strict=True)]
            at = np.flatnonzero(moved[0].any(axis=1))
            values = np.rint(np.concatenate([moved[0][at], moved[1]]) * PART).astype(np.int64)
            at = np.concatenate([at, -1 - np.arange(len(moved[1]))])
            return pa.Table.from_arrays([pa.array(at), *map(pa.array, values.T)], ["bucket", *MOVES])

        return run

    for number in range(ROUNDS):
        run = steps(shared(spark, model), number)
        moves = dealt.groupBy("shard").applyInArrow(run, "bucket long, " + ", ".join(f"{m} long" for m in MOVES))
        means = [(F.sum(m) / F.count("*") / PART).cast("float").alias(m) for m in MOVES]
        moved = store(moves.groupBy("bucket").agg(*means), "moves")
        found = moved.toArrow()
        model.move_by(found.column("bucket").to_numpy(), np.stack([found.column(m).to_numpy() for m in MOVES], 1))
        discard(moved)
    return model


def calibrate_all(model: Classifier, labelled: DataFrame, share: float) -> None:
    """Scaling and thresholds of the model from all rows of `labelled` (text, lang, mark): logits counted in small steps.

    A language's threshold is where its predictions have the best F1, nearest to one half among equally good ones.
    Without both marks the model stays as it is.
    """
    import numpy as np
    import pyarrow as pa

    spark = labelled.sparkSession
    sent = shared(spark, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, cache = sent(), {}
        for batch in batches:
            raw = np.asarray(fitted.raw([words_of(text) for text in utf8(batch.column(0))], cache), np.float64)
            steps = np.floor(np.clip(raw, -LOGIT_MOST, LOGIT_MOST) * LOGIT_STEPS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(steps)], ["lang", "mark", "step"])

    steps = labelled.select("text", F.col("lang").cast("string").alias("lang"), "mark").mapInArrow(run, "lang string, mark int, step int")
    steps = store(steps.groupBy("lang", "step").agg(F.count("*").alias("n"), F.sum("mark").alias("t")), "steps")
    found = steps.groupBy("step").agg(F.sum("n").alias("n"), F.sum("t").alias("t")).orderBy("step").toArrow()
    step, n, t = (found.column(c).to_numpy().astype(np.float64) for c in ("step", "n", "t"))
    if 0 < t.sum() < n.sum():
        y = np.repeat([0.0, 1.0], len(step))
        times = np.concatenate([n - t, t])
        model.scale(np.tile((step + 0.5) / LOGIT_STEPS, 2), y, times, share)
        score = lambda s: 1 / (1 + F.exp(-(F.lit(model.slope) * s / LOGIT_STEPS + F.lit(model.shift))))
        above = Window.partitionBy("lang").orderBy(F.desc("step"))
        cuts = steps.select(
            "lang",
            (2 * F.sum("t").over(above) / (F.sum("n").over(above) + F.sum("t").over(Window.partitionBy("lang")))).alias("f1"),
            # every threshold from the end of the next lower step to the start of this one marks the same rows
            F.greatest(F.coalesce(score(F.lead("step").over(above) + 1), F.lit(0.0)), F.least(score(F.col("step")), F.lit(0.5))).alias("cut"),
            F.sum("t").over(Window.partitionBy("lang")).alias("toxic"),
        )
        best = cuts.groupBy("lang").agg(F.min(F.struct(-F.col("f1"), F.abs(F.col("cut") - 0.5), "cut")).alias("best"), F.max("toxic").alias("toxic"))
        model.thresholds = {r["lang"]: r["best"]["cut"] if r["toxic"] else 0.5 for r in best.collect()}
    discard(steps)


def score_toxicity(docs: DataFrame, model: Classifier) -> DataFrame:
    """doc_id, held_out, score, predicted, lang, threshold and flagged for every row of `docs` (doc_id, text, lang).

    score: probability of the label 1 from the whole text's words alone; predicted: score of one half or more. The
    language plays no part in them; beside them `flagged` tells whether the score reaches the threshold calibrated
    for the document's language (one half for a language without one). Null and empty texts are scored as texts without
    words; rows with a null doc_id are not held out; repeated rows are scored alike; other columns are ignored.
    """
    import numpy as np
    import pyarrow as pa

    spark = docs.sparkSession
    bounded_batches(spark)
    # 2^18 buckets of 8 floats and some filters: 8 MB whatever the data
    sent = shared(spark, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, cache = sent(), {}
        for batch in batches:
            scores = fitted.score([words_of(text) for text in utf8(batch.column(1))], cache)
            limits = [fitted.thresholds.get(x, 0.5) for x in batch.column(2).to_pylist()]
            columns = [batch.column(0), batch.column(2), pa.array(np.asarray(scores), pa.float64()), pa.array(limits, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang", "score", "threshold"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
    scored = rows.mapInArrow(run, "doc_id long, lang string, score double, threshold double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "lang",
        "threshold",
        (F.col("score") >= F.col("threshold")).alias("flagged"),
    )
