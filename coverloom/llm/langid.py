"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

The n-grams of a whole lower-cased text are hashed to a fixed number of features; their weights are relative frequency times
inverse document frequency, scaled to length one. Follow-the-regularised-leader with elastic-net penalties trains the model, and one
temperature, fitted on rows kept out of the training, calibrates its probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FEATURES = 1 << 15
ORDERS = (1, 2, 3)
UNKNOWN = "und"


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def features(text: str, block: int = 1 << 16) -> Iterator[np.ndarray]:
    """Feature numbers of all n-grams of the text, a space at either end, in blocks that don't lose any."""
    code = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4")
    longest = max(ORDERS)
    for at in range(0, len(code), block):
        part = code[at:at + block + longest - 1]
        new = min(block, len(code) - at)
        h = np.zeros(len(part), np.uint32)
        for n in range(1, longest + 1):
            here = part[n - 1:]
            h = (h[:len(here)] ^ here) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
            if n in ORDERS:
                yield (h[:new] * np.uint32(0x85EBCA6B) + np.uint32(n)) >> np.uint32(32 - FEATURES.bit_length() + 1)


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of a text, ascending, and how often each occurs."""
    total = np.zeros(FEATURES, np.int32)
    for f in features(text):
        if len(f) > FEATURES // 8:
            total += np.bincount(f, minlength=FEATURES).astype(np.int32)
        else:
            np.add.at(total, f, 1)
    at = np.flatnonzero(total)
    return at, total[at]


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # (languages, FEATURES)
    bias: np.ndarray
    temperature: float = 1.0

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        at, n = counts(text)
        x = n / n.sum() * self.idf[at]
        return at, x / (np.sqrt((x * x).sum()) or 1.0)

    def logits(self, text: str) -> np.ndarray:
        at, x = self.vector(text)
        return self.weights[:, at] @ x + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and its probability; no letter: ``und`` with 0."""
        if not has_letter(text):
            return UNKNOWN, 0.0
        p = softmax(self.logits(text) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(samples: list[tuple[str, str]], idf: np.ndarray, languages: list[str], epochs: int = 3, alpha: float = 1.0, beta: float = 1.0,
          l1: float = 1e-3, l2: float = 1e-3, seed: int = 1) -> Model:
    """FTRL-proximal on (text, language) rows; every fifth row is kept for the temperature."""
    model = Model(languages, idf, np.zeros((len(languages), FEATURES)), np.zeros(len(languages)))
    if not samples:
        return model
    number = {k: i for i, k in enumerate(languages)}
    rows = [(*model.vector(t), number[k]) for t, k in samples]
    kept, used = (rows[::5], [r for i, r in enumerate(rows) if i % 5]) if len(rows) >= 20 else (rows, rows)
    width = FEATURES + 1  # the last one is the bias
    z, n = np.zeros((len(languages), width)), np.zeros((len(languages), width))

    def weights(at):
        zz = z[:, at]
        return np.where(np.abs(zz) <= l1, 0.0, -(zz - np.sign(zz) * l1) / ((beta + np.sqrt(n[:, at])) / alpha + l2))

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(used)):
            at, x, y = used[i]
            at, x = np.append(at, FEATURES), np.append(x, 1.0)
            w = weights(at)
            p = softmax(w @ x)
            p[y] -= 1.0
            g = p[:, None] * x
            old = n[:, at]
            z[:, at] += g - (np.sqrt(old + g * g) - np.sqrt(old)) / alpha * w
            n[:, at] = old + g * g
    w = weights(np.arange(width))
    model.weights, model.bias = np.ascontiguousarray(w[:, :FEATURES]), w[:, FEATURES]
    logits, truth = np.array([model.weights[:, at] @ x + model.bias for at, x, _ in kept]), np.array([y for *_, y in kept])
    loss = lambda t: -np.log(np.maximum(softmax(logits / t)[np.arange(len(truth)), truth], 1e-12)).mean()
    model.temperature = float(min(np.exp(np.linspace(-3, 2, 101)), key=loss))
    return model


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of all (text) rows each feature occurs, and the number of rows. ``FEATURES`` rows come back to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, rows, seen = np.zeros(FEATURES, np.int64), 0, np.zeros(FEATURES, bool)
        for batch in batches:
            for t in batch.column("text"):
                seen[:] = False
                for f in features(t.as_py()):
                    seen[f] = True
                df += seen
                rows += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], rows))], names=["feature", "n"])

    total = texts.mapInArrow(run, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(FEATURES, np.int64)
    rows = 0
    for feature, n in total:
        if feature < 0:
            rows = n
        else:
            df[feature] = n
    return df, rows


def fit(docs: DataFrame, learn: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", per_language: int = 800,
        most_languages: int = 200, seed: int = 7, **options) -> Model:
    """Train on the rows for which ``learn`` holds and language and text are not null and have a letter.

    Document frequencies come from all these rows. The classifier is fitted on the ``per_language`` rows of each language (all, if fewer) with
    the smallest hashes of id and text (copies of both are one), and on the ``most_languages`` most frequent languages; so neither the sample nor the weights grow with the input.
    A language of which no row has a letter is not learnt.
    """
    lang = F.col(lang_col).cast("string")
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)), F.lit(1 << 62))
    rows = docs.filter(learn & lang.isNotNull() & F.col(text_col).rlike(r"\p{IsAlphabetic}")).select(
        F.col(text_col).alias("text"), lang.alias("lang"), draw.alias("draw"))
    frequent = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("draw").alias("draws")).orderBy(F.desc("n"), "lang").limit(most_languages)
    draws = {r["lang"]: r["draws"] for r in frequent.collect()}
    languages = sorted(draws)
    df, n = document_frequencies(rows.select("text"))
    idf = np.log((1 + n) / (1 + df)) + 1
    if not languages:
        return Model([], idf, np.zeros((0, FEATURES)), np.zeros(0))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    small = F.lit(False)  # some times as many draws as are needed, so that no language's meet in one task
    for k in languages:
        small = F.when(F.col("lang") == k, F.col("draw") < int(min(1.0, 4 * per_language / max(1, draws[k])) * (1 << 62))).otherwise(small)
    drawn = rows.filter(small).select("lang", "draw").distinct().withColumn("place", place).filter(F.col("place") <= per_language)
    last = {r["lang"]: r["last"] for r in drawn.groupBy("lang").agg(F.max("draw").alias("last")).collect()}
    enough = F.lit(False)
    for k in languages:
        enough = F.when(F.col("lang") == k, F.col("draw") <= last.get(k, -1)).otherwise(enough)
    # at most per_language rows a language: copies of one id and text have one draw
    sample = [(r["text"], r["lang"]) for r in rows.filter(enough).dropDuplicates(["lang", "draw"]).collect()]
    return train(sorted(sample), idf, languages, **options)


def guess(spark: SparkSession, model: Model, text: Column) -> Column:
    """(lang_pred, score) of a text. No learned language: ``und``."""
    sent = spark.sparkContext.broadcast(model)  # fixed size: at most most_languages times FEATURES

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = sent.value
        for column in texts:
            found = [model.predict(t.as_py()) if model.languages else (UNKNOWN, 0.0) for t in column]
            langs, scores = zip(*found) if found else ((), ())
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"])

    return F.arrow_udf(run, "struct<lang_pred: string, score: double>")(text)


def lettered(text: Column) -> Column:
    """Whether a text has a letter, as ``predict`` sees it."""

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            yield pa.array([has_letter(t.as_py()) for t in column], pa.bool_())

    return F.arrow_udf(run, "boolean")(text)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): learns from the rows that aren't held out, predicts all.

    Held out are rows whose ``crc32`` of the id as text is 1 modulo 3. Language, source and id take no part in a prediction. A
    null text or one without a letter is ``und`` with score 0; a row with null id is never learnt from and not held out; a table
    without labels gives ``und`` everywhere. Repeated rows and very long texts are treated like any others.
    """
    fold = F.crc32(F.col(id_col).cast("string").cast("binary")) % 3
    model = fit(docs, F.col(id_col).isNotNull() & (fold != 1), text_col, lang_col, id_col, **options)
    found = docs.select(F.col(id_col).alias("doc_id"), guess(docs.sparkSession, model, F.col(text_col)).alias("guess"))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    return found.select("doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "guess.lang_pred", "guess.score")


def keep_known(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """The documents whose language can be told; those predicted ``und`` go, which have no letter or a null text. Columns are those of ``docs``.

    If there is no row to learn from, all documents with a letter stay.
    """
    fold = F.crc32(F.col(id_col).cast("string").cast("binary")) % 3
    model = fit(docs, F.col(id_col).isNotNull() & (fold != 1), text_col, lang_col, id_col, **options)
    if not model.languages:
        return docs.filter(lettered(F.col(text_col)))
    return docs.filter(guess(docs.sparkSession, model, F.col(text_col))["lang_pred"] != UNKNOWN)
