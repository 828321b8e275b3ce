"""Language identification by error-correcting output codes over character n-grams.

Every language has a codeword of +1 and -1. Per bit a logistic classifier on hashed n-grams of a text's letters predicts
that bit. A text's language is the codeword with the least loss: the sum over bits of the logistic loss of the bit's margin,
weighted by how well the bit was predicted on texts kept out of the fit. So a few wrong bits do no harm, and where two
codewords are about as near, the text is flagged as ambiguous.

Up to six languages have the exhaustive code, every way to split them in two; more have columns drawn at random, of which
the draw with the greatest least distance is taken.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowferry.llm.common import BROADCAST_ROWS, bounded_batches, shared

ORDERS = (1, 2, 3, 4)
BITS_OF_HASH = 16
# documents the classifiers are fitted on, at most, in equal parts by language, and the characters of one; languages at most
SAMPLE, SAMPLE_CHARS, LANGUAGES = 3200, 20_000, 256
# share of the sample that is kept out of the fit, for calibration
CALIBRATION = 0.25
EPOCHS, BATCH, RATE = 6, 64, 0.3
SEED = 13
EXHAUSTIVE, DRAWS = 6, 30
# a text whose nearest two codewords differ by less in loss is ambiguous
AMBIGUOUS = 1.0
# characters whose n-grams are looked up at a time
PIECE = 1 << 17
UNDETERMINED = "und"


def letters():
    """By code point, whether it is a letter."""
    import numpy as np

    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def codes_of(text: str, letter) -> object:
    """The code points of a text's letters in lower case, with one 0 between and around words; none without letters."""
    import numpy as np

    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    known = letter[codes]
    if not known.any():
        return np.zeros(0, np.uint64)
    codes = np.where(known, codes, 0)
    codes = np.concatenate([[0], codes, [0]]).astype(np.uint64)
    return codes[np.append(True, (codes[1:] != 0) | (codes[:-1] != 0))]


def grams(codes, first: int = 0, last: int | None = None) -> Iterator[object]:
    """Buckets of the n-grams that start at the given places, order by order."""
    import numpy as np

    last = len(codes) if last is None else last
    for n in ORDERS:
        ends = min(last, len(codes) - n + 1)
        if ends <= first:
            return
        h = codes[first:ends] + np.uint64(n << 24)
        for k in range(1, n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + codes[first + k : ends + k]
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        yield (h >> np.uint64(64 - BITS_OF_HASH)).astype(np.int64)


def code_matrix(languages: int):
    """A codeword per language: rows of +1 and -1, no column equal to another or its opposite."""
    import numpy as np

    if languages <= 1:
        return np.zeros((languages, 0), np.float32)
    if languages <= EXHAUSTIVE:
        columns = [(1, *rest) for rest in itertools.product((1, -1), repeat=languages - 1)][1:]
        return np.array(columns, np.float32).T
    random, best = np.random.default_rng(SEED), None
    bits = 15 + 4 * (languages - 1).bit_length()
    for _ in range(DRAWS):
        columns: dict[tuple, None] = {}
        while len(columns) < bits:
            column = np.ones(languages, int)
            column[random.permutation(languages)[: languages // 2]] = -1
            columns[tuple(column * column[0])] = None
        code = np.array(list(columns), np.float32).T
        distance = ((bits - code @ code.T) / 2 + 2 * bits * np.eye(languages)).min()
        if best is None or distance > best[0]:
            best = (distance, code)
    return best[1]


class Decoder:
    """Classifiers of the bits, and the codewords with their languages."""

    def __init__(self, languages: list[str]):
        import numpy as np

        self.languages, self.code = languages, code_matrix(len(languages))
        self.weights = np.zeros((1 << BITS_OF_HASH, self.code.shape[1]), np.float32)
        self.offset = np.zeros(self.code.shape[1])
        self.trust = np.ones(self.code.shape[1])

    def margin(self, codes):
        """The margins of all bits: the mean weight of all n-grams of a text, and the offset."""
        import numpy as np

        total, n = np.zeros(len(self.offset)), 0
        for first in range(0, len(codes), PIECE):
            for part in grams(codes, first, first + PIECE):
                total += self.weights[part].sum(axis=0, dtype=np.float64)
                n += len(part)
        return total / max(n, 1) + self.offset

    def losses(self, margins):
        """Per text and language the weighted loss of its codeword."""
        import numpy as np

        plus, minus = np.logaddexp(0, -margins) * self.trust, np.logaddexp(0, margins) * self.trust
        return plus @ (self.code.T > 0) + minus @ (self.code.T < 0)

    def fit(self, texts: list, marks: list[int]) -> None:
        """Weights of all bits at once: log odds of n-grams, then gradient steps (Adagrad); languages weigh the same."""
        import numpy as np

        y = self.code[marks]
        counted = [np.unique(np.concatenate(list(grams(t))), return_counts=True) for t in texts]
        share = 1 / (np.bincount(marks, minlength=len(self.languages))[marks] * len(self.languages))
        seen = np.zeros((len(self.languages), len(self.weights)))
        for (at, n), mark, s in zip(counted, marks, share, strict=True):
            seen[mark, at] += n / n.sum() * s
        few = 1e-7
        for b in range(y.shape[1]):
            up, down = seen[self.code[:, b] > 0].sum(0), seen[self.code[:, b] < 0].sum(0)
            self.weights[:, b] = np.log(up / up.sum() + few) - np.log(down / down.sum() + few)
        # rows of a sparse matrix: buckets, their share of a text, and where texts begin
        self.scale(counted, y, share)
        state, random = np.full_like(self.weights, 1e-3), np.random.default_rng(SEED)
        for _ in range(EPOCHS):
            order = random.permutation(len(texts))
            for low in range(0, len(order), BATCH):
                picked = order[low : low + BATCH]
                at = np.concatenate([counted[i][0] for i in picked])
                part = np.concatenate([counted[i][1] / counted[i][1].sum() for i in picked]).astype(np.float32)
                sizes = np.array([len(counted[i][0]) for i in picked])
                starts = np.cumsum(sizes) - sizes
                margins = np.add.reduceat(self.weights[at] * part[:, None], starts, axis=0) + self.offset
                slope = -y[picked] / (1 + np.exp(np.clip(y[picked] * margins, -30, 30))) * share[picked, None] * len(texts)
                used, place = np.unique(at, return_inverse=True)
                grad = np.zeros((len(used), y.shape[1]), np.float32)
                np.add.at(grad, place, np.repeat(slope, sizes, axis=0).astype(np.float32) * part[:, None])
                state[used] += grad * grad
                self.weights[used] -= RATE * grad / np.sqrt(state[used])

    def scale(self, counted, y, share) -> None:
        """Bring the weights to the size that suits the logistic loss, bit by bit (Newton steps on slope and offset)."""
        import numpy as np

        raw = np.array([(self.weights[at] * (n / n.sum())[:, None]).sum(axis=0) for at, n in counted])
        for b in range(y.shape[1]):
            slope, offset = logistic(raw[:, b], y[:, b], share)
            self.weights[:, b] *= slope
            self.offset[b] = offset

    def calibrate(self, texts: list, marks: list[int]) -> None:
        """Slope, offset and trust of every bit by texts that took no part in the fit."""
        import numpy as np

        raw, y = np.array([self.margin(t) for t in texts]), self.code[marks]
        share = 1 / (np.bincount(marks, minlength=len(self.languages))[marks] * len(self.languages))
        for b in range(y.shape[1]):
            slope, offset = logistic(raw[:, b] - self.offset[b], y[:, b], share)
            if slope > 0:
                self.weights[:, b] *= slope
                self.offset[b] = offset
                raw[:, b] = slope * (raw[:, b] - self.offset[b]) + offset
            loss = (share * np.logaddexp(0, -y[:, b] * raw[:, b])).sum() / share.sum()
            self.trust[b] = max(1 - loss / np.log(2), 0.01)

    def decide(self, margins) -> tuple[list[str], object, object]:
        """Language, score and ambiguity of texts; of equally near languages the first by name."""
        import numpy as np

        losses = self.losses(margins)
        best = losses.argmin(axis=1)
        nearest = losses[np.arange(len(losses)), best]
        score = 1 / np.exp(nearest[:, None] - losses).sum(axis=1)
        others = np.where(np.arange(losses.shape[1]) == best[:, None], np.inf, losses).min(axis=1)
        return [self.languages[i] for i in best], score, others - nearest < AMBIGUOUS


def logistic(x, y, weight) -> tuple[float, float]:
    """Slope and offset of a weighted logistic regression of y (+1, -1) on x, both kept small."""
    import numpy as np

    y01, weight = (y > 0).astype(float), weight / weight.sum()
    a, b = 1.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        h = weight * p * (1 - p)
        grad = np.array([(weight * (p - y01) * x).sum() + 1e-5 * a, (weight * (p - y01)).sum() + 1e-5 * b])
        hess = np.array([[(h * x * x).sum() + 1e-5, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-5]])
        step = np.linalg.solve(hess, grad)
        step *= min(1.0, 2 / max(np.abs(step).max(), 1e-9))
        a, b = a - step[0], b - step[1]
    return float(a), float(b)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame) -> list[tuple[str, str]]:
    """lang and text of at most SAMPLE documents to learn from, equal texts of a language once.

    Documents count that are not held out, have doc_id, lang and a letter, and at most SAMPLE_CHARS characters. Of each of the
    LANGUAGES languages with the most different texts those with the smallest hashes are taken, so reruns agree.
    """
    known = docs.select("doc_id", F.col("text").cast("string"), F.col("lang").cast("string"))
    known = known.filter("doc_id IS NOT NULL AND lang IS NOT NULL").filter(~held_out(F.col("doc_id")))
    known = known.filter((F.length("text") <= SAMPLE_CHARS) & F.col("text").rlike(r"\p{L}"))
    known = known.select("lang", "text", F.xxhash64("text").alias("h"))
    texts = known.groupBy("lang", "h").agg(F.lit(1).alias("one"))
    sizes = texts.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    if not sizes:
        return []
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    most = max(SAMPLE // len(sizes), 1)
    # twice as many by the hash alone, so that a task ranks few rows however many a language has
    low = F.lit(False)
    for r in sizes:
        share, own = (2 * most + 100) / r["count"], F.col("lang") == r["lang"]
        low = low | (own if share >= 1 else own & (F.col("h") < F.lit(int((share - 0.5) * 2**64))))
    chosen = texts.filter(low).withColumn("rank", rank).filter(F.col("rank") <= most).select("lang", "h")
    # at most SAMPLE rows, or one a language
    assert most * len(sizes) <= BROADCAST_ROWS
    found = known.join(F.broadcast(chosen), ["lang", "h"], "left_semi").groupBy("lang", "h").agg(F.min("text").alias("text"))
    rows = [(r["lang"], r["text"]) for r in found.collect()]
    return sorted(rows, key=lambda r: (zlib.crc32(r[1].encode()), r))


def train(docs: DataFrame) -> Decoder:
    """Classifiers fitted and calibrated on a bounded sample of `docs` (doc_id, text, lang), see `sample`."""
    letter = letters()
    rows = [(lang, codes) for lang, text in sample(docs) if len(codes := codes_of(text, letter))]
    model = Decoder(sorted({lang for lang, _ in rows}))
    if len(model.languages) < 2:
        return model
    index = {lang: i for i, lang in enumerate(model.languages)}
    fitted, kept, seen = [], [], [0] * len(index)
    for lang, codes in rows:
        i = index[lang]
        # of every language the same share, the first always in the fit
        (kept if int((seen[i] + 1) * CALIBRATION) > int(seen[i] * CALIBRATION) else fitted).append((codes, i))
        seen[i] += 1
    model.fit([c for c, _ in fitted], [i for _, i in fitted])
    if len({i for _, i in kept}) == len(index):
        model.calibrate([c for c, _ in kept], [i for _, i in kept])
    return model


def identify(docs: DataFrame, model: Decoder) -> DataFrame:
    """doc_id, held_out, lang_pred, score and ambiguous for every row of `docs` (doc_id, text; others are ignored).

    The whole text's letters alone decide. A null text, one without letters, and every text where no language was learned
    are `und` with score 0, not ambiguous; with one learned language all others are that one, with score 1. score: the
    share of the nearest codeword in the weights exp(-loss). Repeated rows are judged alike; a null doc_id is not held out;
    long texts are looked up in pieces, so that memory does not grow beyond the text itself.
    """
    import pyarrow as pa

    spark = docs.sparkSession
    bounded_batches(spark)
    # 2^16 buckets by the bits of the code, whatever the data
    sent = shared(spark, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        have, letter = sent(), letters()
        for batch in batches:
            found = [codes_of(text or "", letter) for text in batch.column(1).cast(pa.large_string()).to_pylist()]
            rows = [i for i, codes in enumerate(found) if len(codes)] if have.languages else []
            lang, score, doubt = [UNDETERMINED] * len(found), np.zeros(len(found)), np.zeros(len(found), bool)
            if rows:
                names, score[rows], doubt[rows] = have.decide(np.array([have.margin(found[i]) for i in rows]))
                for i, name in zip(rows, names, strict=True):
                    lang[i] = name
            columns = [batch.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(doubt)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score", "ambiguous"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string"))
    judged = rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, ambiguous boolean")
    return judged.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")
