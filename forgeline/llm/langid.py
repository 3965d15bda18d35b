"""Language ID: averaged hashed subword embeddings with a linear softmax, trained by SGD in numpy.

A word gives its character n-grams and itself, hashed to rows of an embedding table.  A text is
the mean of all its rows, and a linear softmax names the language.  Both layers being linear, a word's
share of the scores is the same wherever it stands, so prediction adds up one small vector per word.
"""

from __future__ import annotations

import itertools
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgeline.llm.common import table

# bounds of the training sample, however large the corpus
DOCS_PER_LANGUAGE = 400       # expected number, drawn by a hash of the id
DOCS_IN_ALL = 80_000          # beyond 200 labels each has its part of these
LEAST_DOCS = 20               # but so many at least, or all it has
WORDS_PER_DOC = 60            # evenly spread over the whole text
RUN_CHARS = 64                # longer runs without white space count as several words

ROWS = 1 << 15                # hash buckets of the embedding table
WIDTH = 16
EPOCHS, BATCH, RATE = 4, 32, 0.3
CALIBRATION_SHARE = 5         # every fifth sampled document calibrates and is not trained on
LOST_SHARE = 0.001            # share of rightly labelled calibration documents that rejection may cost
SURE = 0.5                    # never reject a prediction more likely right than wrong
CACHED_WORDS = 200_000
UNKNOWN = "und"
_STRIP = ".,;:!?()[]{}\"'|*#$%&<>/\\=+-_"


def features(word: str) -> list[int]:
    """Buckets of the 2- to 4-grams of a word's UTF-8 bytes (its ends marked) and of the word; none without a letter."""
    word = word.strip(_STRIP)
    if not word.isalpha() and not any(map(str.isalpha, word)):
        return []
    w, crc = b"<%b>" % word.encode("utf-8", "surrogatepass"), zlib.crc32
    grams = [w[i:i + n] for n in (2, 3, 4) for i in range(len(w) - n + 1)]
    return [crc(g) & (ROWS - 1) for g in grams] + [crc(w) & (ROWS - 1)]


@dataclass
class LanguageModel:
    """``scores`` row b: what one occurrence of bucket b adds to each language's score, before the mean."""
    languages: list[str]
    scores: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def probabilities(self, totals: np.ndarray, counts: np.ndarray) -> np.ndarray:
        z = (totals / np.maximum(counts, 1)[:, None] + self.bias) / self.temperature
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def train(samples: list[tuple[str, list[str]]], seed: int = 7) -> LanguageModel:
    """Fit on (language, words) samples, then fit temperature and rejection threshold on those held back."""
    languages = sorted({lang for lang, _ in samples})
    if not languages:
        return LanguageModel([], np.zeros((ROWS, 0)), np.zeros(0))
    rng = np.random.default_rng(seed)
    known: dict[str, list[int]] = {}
    data = []
    for i in rng.permutation(len(samples)):
        lang, words = samples[i]
        bag = [b for w in words for b in known.setdefault(w, features(w))]
        if bag:
            data.append((np.array(bag), languages.index(lang)))
    held, fit = data[::CALIBRATION_SHARE], [d for i, d in enumerate(data) if i % CALIBRATION_SHARE] or data
    taught = {c for _, c in fit}
    fit, held = fit + [d for d in held if d[1] not in taught], [d for d in held if d[1] in taught]
    n = len(languages)
    table_ = rng.normal(0, 0.1, (ROWS, WIDTH))
    weights, bias = np.zeros((WIDTH, n)), np.zeros(n)
    weights += rng.normal(0, 0.1, weights.shape)
    seen_rows, seen_weights, seen_bias = np.full(ROWS, 1e-12), np.full(weights.shape, 1e-12), np.full(n, 1e-12)
    steps = max(1, EPOCHS * -(-len(fit) // BATCH))
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(fit))
        for at in range(0, len(fit), BATCH):
            rows = [fit[i] for i in order[at:at + BATCH]]
            sizes = np.array([len(b) for b, _ in rows])
            buckets, y = np.concatenate([b for b, _ in rows]), np.array([c for _, c in rows])
            mean = np.add.reduceat(table_[buckets], np.concatenate(([0], np.cumsum(sizes)[:-1]))) / sizes[:, None]
            z = mean @ weights + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(y)), y] -= 1
            p /= len(rows)
            rate = RATE * (1 - step / steps)
            step += 1
            back, up, side = (p @ weights.T) / sizes[:, None], mean.T @ p, p.sum(axis=0)
            order_of = np.argsort(buckets, kind="stable")
            uniq, starts = np.unique(buckets[order_of], return_index=True)
            grad = np.add.reduceat(back[np.repeat(np.arange(len(sizes)), sizes)[order_of]], starts)
            # steps shrink with the gradients seen (AdaGrad), so rare buckets and common ones both learn
            seen_rows[uniq] += (grad * grad).mean(axis=1)
            table_[uniq] -= rate * grad / np.sqrt(seen_rows[uniq])[:, None]
            seen_weights += up * up
            weights -= rate * up / np.sqrt(seen_weights)
            seen_bias += side * side
            bias -= rate * 0.1 * side / np.sqrt(seen_bias)
    model = LanguageModel(languages, table_ @ weights, bias)
    return calibrate(model, held)


def calibrate(model: LanguageModel, held: list[tuple[np.ndarray, int]]) -> LanguageModel:
    """Temperature of least log loss; threshold that costs at most LOST_SHARE of right predictions."""
    if not held:
        return model
    totals = np.array([model.scores[b].sum(axis=0) for b, _ in held])
    counts, y = np.array([len(b) for b, _ in held]), np.array([c for _, c in held])
    def loss(t: float) -> float:
        model.temperature = t
        return -np.log(np.maximum(model.probabilities(totals, counts)[np.arange(len(y)), y], 1e-12)).mean()

    model.temperature = min(np.geomspace(0.5, 20, 40), key=loss)
    p = model.probabilities(totals, counts)
    right = np.sort(p.max(axis=1)[p.argmax(axis=1) == y])
    model.threshold = min(SURE, float(right[int(LOST_SHARE * len(right))])) if len(right) else 0.0
    return model


def _sample_words(batches):
    for batch in batches:
        langs, words = [], []
        for lang, text in zip(batch.column("lang"), batch.column("text")):
            every = (text.as_py() or "").lower().split()
            if any(len(w) > RUN_CHARS for w in every):
                every = [w[i:i + RUN_CHARS] for w in every for i in range(0, len(w), RUN_CHARS)]
            picked = np.unique(np.linspace(0, len(every) - 1, min(WORDS_PER_DOC, len(every))).astype(int)) if every else []
            langs.append(lang.as_py())
            words.append([every[i] for i in picked])
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.list_(pa.string()))], ["lang", "words"])


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Train on a bounded sample of labelled rows: about DOCS_PER_LANGUAGE of every label, fewer if that
    is more than DOCS_IN_ALL, WORDS_PER_DOC words of each; rows without text or label teach nothing."""
    rows = labelled.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"),
                           F.col(lang_col).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = rows.groupBy("lang").count().orderBy("lang").collect()
    if not sizes:
        return train([])
    docs = max(LEAST_DOCS, min(DOCS_PER_LANGUAGE, DOCS_IN_ALL // len(sizes)))
    share = F.create_map(*[x for r in sizes for x in (F.lit(r["lang"]), F.lit(min(1.0, docs / r["count"])))])
    draw = F.pmod(F.xxhash64(F.coalesce("id", F.lit("")), F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = (rows.where(draw < share[F.col("lang")]).select("lang", "text")
              .mapInArrow(_sample_words, "lang string, words array<string>"))
    return train(sorted((r["lang"], r["words"]) for r in picked.toLocalIterator()))


class WordScores:
    """Remembered shares of words in the scores: a column per language, and the number of buckets."""

    def __init__(self, model: LanguageModel):
        self.model, self.n = model, len(model.languages)
        self.known: dict[str, int] = {}
        self.rows = np.zeros((1024, self.n + 1))

    def _learn(self, words: list[str]) -> None:
        at = len(self.known)
        if at + len(words) > len(self.rows):
            self.rows = np.concatenate([self.rows[:at], np.zeros((at + len(words), self.n + 1))])
        bags = [features(w) for w in words]
        sizes = np.fromiter(map(len, bags), np.int64, len(bags))
        buckets = np.fromiter(itertools.chain.from_iterable(bags), np.int64, int(sizes.sum()))
        rows = np.zeros((len(words), self.n + 1))
        if len(buckets) and self.n:
            some = np.flatnonzero(sizes)
            starts = np.cumsum(sizes[some]) - sizes[some]
            rows[some, :self.n] = np.add.reduceat(self.model.scores[buckets], starts)
        rows[:, self.n] = sizes
        self.rows[at:at + len(words)] = rows
        self.known.update(zip(words, range(at, at + len(words))))

    def total(self, text: str) -> np.ndarray:
        """Sum over all words of a text, a bounded run of them at a time."""
        words, out, known = text.lower().split(), np.zeros(self.n + 1), self.known
        for at in range(0, len(words), CACHED_WORDS // 2):
            run = words[at:at + CACHED_WORDS // 2]
            new = [w for w in dict.fromkeys(run) if w not in known]
            if len(known) + len(new) > CACHED_WORDS:
                known.clear()
                new = list(dict.fromkeys(run))
            if new:
                self._learn(new)
            out += self.rows[[known[w] for w in run]].sum(axis=0)
        return out


def _predict(model: LanguageModel):
    names = np.array([*model.languages, UNKNOWN], object)
    n = len(model.languages)

    def run(batches):
        scores = WordScores(model)
        for batch in batches:
            totals = np.array([scores.total(t.as_py() or "") for t in batch.column("text")]).reshape(-1, n + 1)
            lettered = totals[:, n] > 0
            if n:
                p = model.probabilities(totals[:, :n], totals[:, n])
                best, score = np.where(lettered, p.argmax(axis=1), n), np.where(lettered, p.max(axis=1), 0.0)
            else:
                best, score = np.zeros(len(totals), int), np.zeros(len(totals))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(names[best].tolist(), pa.string()), pa.array(score),
                 pa.array(~lettered | (score < model.threshold))], ["row", "lang_pred", "score", "rejected"])
    return run


def predict(docs: DataFrame, model: LanguageModel, row_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: row_col, lang_pred, score, rejected; only the text is looked at.

    lang_pred is ``und`` with score 0, rejected, where the text is null, empty or has no letter (and
    everywhere if nothing was learned).  ``score`` is the calibrated probability; a prediction below the
    model's threshold is rejected too.  Null and repeated ids stay as they are.
    """
    rows = docs.select(F.col(row_col).alias("row"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    return rows.mapInArrow(_predict(model), schema).withColumnRenamed("row", row_col)


def held_out(id_col: str = "doc_id"):
    """Every fifth document by crc32 of its id is never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every row of ``documents``, learned from those not held out."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out()))
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")
