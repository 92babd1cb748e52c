"""Toxicity by a support vector machine over a subsequence string kernel with Nyström landmarks.

The kernel compares two words by all the triples of characters that occur in them in order, gaps allowed; a triple that
spans l characters weighs DECAY ** l, so `id-iot`, `i.d.i.o.t` and `idioot` stay close to `idiot`. Words of labelled
sentences are the instances: Spark counts in how many toxic and clean sentences each word stands, the words that mark
toxic ones are positive, frequent and sampled words of clean ones negative. Landmarks among both give each word its
Nyström features; a linear machine with squared hinge loss learns in that space. As the decision is a weighted sum over
landmarks, it folds into one weight for each triple, and scoring a word is a sum over its triples. A sentence is as toxic
as its words: the strongest decisions of a text go through a logistic curve fitted on all labelled texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmill.llm.positional_index import bounded
from newsmill.llm.tables import forget, pieces, stored, with_struct

DECAY, REACH, SYMBOLS = 0.7, 6, 32
GAPS = list(combinations(range(1, REACH + 1), 2))  # where the second and the third character of a triple stand
POSITIVE_WORDS, NEGATIVE_WORDS, LANDMARKS = 1_000, 6_000, 384  # most instances and landmarks that the driver fits on
CURVE_STEPS = 50  # most Newton steps of the logistic curve, each a pass over three numbers a labelled text
LEAST_SENTENCES, LEAST_ODDS = 3, 12.0  # a toxic word stands in so many toxic sentences, and so much likelier there
HARD_ROUNDS, HARD_WORDS = 1, 3_000
CLEAN_WEIGHT = 4.0  # of all negatives together; all positives weigh 0.5: a text has hundreds of clean words
KNOWN_WORDS = 200_000  # decisions that a worker remembers
RUN_BYTES, RUN_SYMBOLS = 500_000, 20_000  # of text split into words at a time, of words split into triples at a time
SEPARATED = re.compile(r"(?<!\S)(?:\S[ \t]){2,}\S(?!\S)")  # l e t t e r s set apart
EDGES = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~¡¿«»“”„…"
FOLDED = str.maketrans("àáâãäåæçèéêëìíîïñòóôõöøùúûüýÿßœ", "aaaaaaaceeeeiiiinoooooouuuuyyso")
EVERY_SENTENCE = " "  # no word is a blank
SENTENCE_END = r"[.!?\n]+(?:\s+|$)|\n"


def codes_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols 1 to 31 of all words, zeros between them, and the word of each symbol: letters, digits, other scripts by hash."""
    text = ("\0" * REACH).join(words) + "\0" * REACH
    points = np.frombuffer(text.translate(FOLDED).encode("utf-32-le"), np.uint32).astype(np.int64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + REACH
    letter, digit = (points >= 97) & (points <= 122), (points >= 48) & (points <= 57)
    codes = np.where(letter, points - 96, np.where(digit, 27, np.where(points == 0, 0, np.where(points < 128, 28, 29 + points % 3))))
    return codes, np.repeat(np.arange(len(words)), lengths)[:len(codes)]


def triples(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word, triple and weight of every subsequence within reach; weights are scaled to a unit sum of squares by word."""
    codes, word = codes_of(words)
    padded = np.r_[codes, np.zeros(REACH, np.int64)]
    n, found = len(codes), []
    for a, b in GAPS:
        second, third = padded[a:a + n], padded[b:b + n]
        at = np.flatnonzero((codes > 0) & (second > 0) & (third > 0))
        found.append((word[at], (codes[at] * SYMBOLS + second[at]) * SYMBOLS + third[at], np.full(len(at), DECAY ** (b + 1))))
    which, triple, weight = (np.concatenate(x) for x in zip(*found, strict=True))
    norm = np.sqrt(np.bincount(which, weight * weight, len(words)))
    return which, triple, weight / np.maximum(norm, 1e-12)[which]


def vectors(words: list[str]) -> np.ndarray:
    out = np.zeros((len(words), SYMBOLS ** 3), np.float32)
    which, triple, weight = triples(words)
    np.add.at(out, (which, triple), weight.astype(np.float32))
    return out


def kernel(words: list[str], landmarks: np.ndarray) -> np.ndarray:
    """Kernel values of words against the feature rows of landmarks, a few hundred words at a time."""
    return np.vstack([vectors(words[i:i + 256]) @ landmarks.T for i in range(0, len(words), 256)])


@dataclass
class Model:
    """One weight for each triple, the offset, and the logistic curve over the strongest decisions of a text."""

    weights: np.ndarray
    offset: float
    curve: np.ndarray

    def decisions(self, words: list[str]) -> np.ndarray:
        """A run of words at a time: a word has some 15 triples for each of its characters."""
        found = []
        for run in pieces(words, RUN_SYMBOLS):
            which, triple, weight = triples(run)
            found.append(np.bincount(which, weight * self.weights[triple], len(run)) + self.offset)
        return np.concatenate(found) if found else np.zeros(0)

    def probability(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.curve[1:] + self.curve[0], -30, 30)))


def words_in(text: str) -> list[str]:
    """Distinct lower-case words without punctuation at their ends; letters set apart by blanks also as one word."""
    lower = text.lower()
    words = {w.strip(EDGES) for w in lower.split()}
    words.update("".join(m.group().split()) for m in SEPARATED.finditer(lower))
    words.discard("")
    return list(words)


def features_of(texts: list[str], model: Model, known: dict[str, float]) -> np.ndarray:
    """For each text its strongest decision and the logarithms of how many words are toxic and clearly toxic."""
    split = [words_in(t) for t in texts]
    new = list(set().union(*split).difference(known)) if split else []
    if len(known) + len(new) > KNOWN_WORDS:
        known.clear()
        new = list(set().union(*split))
    known.update(zip(new, model.decisions(new).tolist(), strict=True))
    rows = np.zeros((len(texts), 3))
    for row, words in zip(rows, split, strict=True):
        values = np.array([known[w] for w in words] or [-2.0])
        row[:] = np.clip(values.max(), -2, 2), np.log1p((values > 0).sum()), np.log1p((values > 0.5).sum())
    return rows


def runs_of_texts(batch: pa.Array) -> Iterator[list[str]]:
    """The texts of a batch; they become Python strings run by run."""
    return pieces((t.as_py() or "" for t in batch), RUN_BYTES)


def sentence_counts(labelled: DataFrame, text: str, label: str) -> DataFrame:
    """(word, toxic, clean): how many toxic and clean sentences hold each word; EVERY_SENTENCE stands in all of them.

    Words are split and merged by Spark, in one pass over the texts. Sentences are told apart by 128 bits of a hash.
    """
    sentences = labelled.select(F.col(label).alias("toxic"), F.explode(F.split(F.lower(F.col(f"`{text}`")), SENTENCE_END)).alias("sentence"))
    # Copies of a text repeat its sentences; each counts once, as toxic if any of its texts is.
    sentences = sentences.groupBy(F.xxhash64("sentence").alias("h1"), F.xxhash64(F.lit(1), "sentence").alias("h2")).agg(
        F.max("toxic").alias("toxic"), F.any_value("sentence").alias("sentence"))
    own = F.array_append(F.array_distinct(F.split("sentence", r"\s+")), F.lit(EVERY_SENTENCE))
    words = sentences.select("toxic", F.explode(own).alias("raw"))
    word = F.regexp_replace("raw", r"^\p{Punct}+|\p{Punct}+$", "")
    counts = words.groupBy("raw").agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("both")).select(
        word.alias("word"), "toxic", (F.col("both") - F.col("toxic")).alias("clean"))
    return counts.filter("word != ''").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def landmarks(words: list[str]) -> list[str]:
    """The first words of a list, which are the heaviest, and others taken evenly from the rest."""
    quarter = LANDMARKS // 4
    rest = words[quarter:]
    return words[:quarter] + [rest[i] for i in sorted({i * len(rest) // quarter for i in range(quarter)}) if rest]


def fit_machine(positive: list[str], seen: list[int], negative: list[str], steps: int = 300, penalty: float = 1e-6) -> tuple[np.ndarray, float]:
    """Triple weights and offset. A toxic word weighs as the root of the sentences it stands in."""
    marks = vectors(landmarks(positive) + landmarks(negative))
    marks = marks[(marks * marks).sum(1) > 0]
    values, axes = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    keep = values > 1e-6 * values.max()
    root = axes[:, keep] / np.sqrt(values[keep])  # the landmarks' inverse square root
    x = kernel(positive + negative, marks) @ root
    y = np.r_[np.ones(len(positive)), -np.ones(len(negative))]
    root_seen = np.sqrt(np.array(seen, float))
    share = np.r_[0.5 * root_seen / root_seen.sum(), np.full(len(negative), CLEAN_WEIGHT / len(negative))]
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    ridge = np.full(len(w), penalty)
    ridge[-1] = 1e-6
    for _ in range(steps):  # Newton steps of the squared hinge: each solves for the points inside the margin
        inside = y * (x @ w) < 1
        own, weight = x[inside], share[inside]
        new = np.linalg.solve((own * weight[:, None]).T @ own + np.diag(ridge), own.T @ (weight * y[inside]))
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    return marks.T.astype(np.float64) @ (root @ w[:-1]), float(w[-1])


def fit_curve(texts: DataFrame) -> np.ndarray:
    """Logistic regression over `_f` and `toxic` of all rows by Newton steps, with a weak pull to zero; Spark adds up each step."""
    size = 4
    x = [F.lit(1.0), *(F.col("_f")[i] for i in range(size - 1))]
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    w = np.zeros(size)
    for _ in range(CURVE_STEPS):
        z = sum((F.lit(float(w[i])) * x[i] for i in range(1, size)), F.lit(float(w[0])))
        p = 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))
        at = texts.select(*(x[i].alias(f"x{i}") for i in range(size)), (F.col("toxic") - p).alias("off"), (p * (1 - p)).alias("v"))
        sums = at.agg(*(F.sum(F.col("v") * F.col(f"x{i}") * F.col(f"x{j}")) for i, j in pairs), *(F.sum(F.col("off") * F.col(f"x{i}")) for i in range(size))).first()
        curved = np.zeros((size, size))
        for (i, j), value in zip(pairs, sums, strict=False):
            curved[i, j] = curved[j, i] = value
        step = np.linalg.solve(curved + 0.1 * np.eye(size), np.array(sums[len(pairs):], float) - 0.1 * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def with_labels(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """Texts and labels of the documents that have one: texts stay where they are while the labels fit a broadcast."""
    narrow = labels.select(F.col(f"`{id_column}`").alias("_id"), F.col(f"`{label}`").alias(label))
    return docs.select(F.col(f"`{id_column}`").alias("_id"), F.col(f"`{text}`").alias(text)).join(bounded(narrow, "_id"), "_id").select(text, label)


def train(labelled: DataFrame, text: str = "text", label: str = "toxic") -> Model:
    """Fits on labelled texts. Rows without a text or without a label of 0 or 1 don't count.

    Word counts cover all sentences of all labelled texts, and so does the curve, whose sums Spark adds up; what reaches
    the driver is bounded: the heaviest POSITIVE_WORDS toxic words and NEGATIVE_WORDS others. Without toxic or
    without clean examples the model knows nothing and scores every text alike, at the share of toxic ones.
    """
    rows = labelled.filter(F.col(label).isin(0, 1) & F.col(f"`{text}`").isNotNull()).select(
        F.col(f"`{text}`").alias("text"), F.col(label).cast("int").alias("toxic"))
    tally = stored(sentence_counts(rows, "text", "toxic"), "word-counts")
    n = tally.filter(F.col("word") == EVERY_SENTENCE).first()
    n_toxic, n_clean = (n["toxic"], n["clean"]) if n else (0, 0)
    odds = ((F.col("toxic") + 0.5) / (n_toxic + 1)) / ((F.col("clean") + 0.5) / (n_clean + 1))
    counts = tally.filter(F.col("word") != EVERY_SENTENCE).withColumn("odds", odds)
    strong = (F.col("toxic") >= LEAST_SENTENCES) & (F.col("odds") >= LEAST_ODDS)
    strong_rows = counts.filter(strong & (F.length("word") >= 3)).orderBy(F.desc(F.col("toxic") * F.log("odds")), "word").limit(POSITIVE_WORDS).collect()
    positive, seen = [r["word"] for r in strong_rows], [r["toxic"] for r in strong_rows]
    plain = counts.filter((F.col("odds") < 1.5) & (F.col("clean") > 0))
    frequent = [r["word"] for r in plain.orderBy(F.desc("clean"), "word").limit(NEGATIVE_WORDS // 2).collect()]
    rare = [r["word"] for r in plain.orderBy(F.xxhash64("word"), "word").limit(NEGATIVE_WORDS // 2).collect()]
    negative = list(dict.fromkeys(frequent + rare))
    negative = [w for w in negative if len(w) >= 3]
    if not positive or not negative:
        forget(tally)
        share = (n_toxic + 0.5) / (n_toxic + n_clean + 1)
        return Model(np.zeros(SYMBOLS ** 3), -1.0, np.array([np.log(share / (1 - share)), 0, 0, 0]))
    model = Model(*fit_machine(positive, seen, negative), np.zeros(4))
    for _ in range(HARD_ROUNDS):  # clean words that look most toxic join the negatives
        hard = plain.filter(F.length("word") >= 3).withColumn("_d", decision(model, rows.sparkSession)("word")).orderBy(F.desc("_d"), "word").limit(HARD_WORDS).collect()
        negative = list(dict.fromkeys(negative + [r["word"] for r in hard]))
        model = Model(*fit_machine(positive, seen, negative), np.zeros(4))
    forget(tally)
    texts = stored(with_features(rows, model).select("toxic", "_f"), "curve-texts")
    model.curve = fit_curve(texts)
    forget(texts)
    return model


def decision(model: Model, spark: SparkSession):
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def decided(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(shared.value.decisions(batch.to_pylist()), pa.float64())

    return decided.asNondeterministic()


def with_features(texts: DataFrame, model: Model, text: str = "text") -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast(model)  # of fixed size: one weight for each triple

    @F.arrow_udf("array<double>")
    def made(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict[str, float] = {}
        for batch in batches:
            rows = [row for run in runs_of_texts(batch) for row in features_of(run, shared.value, known).tolist()]
            yield pa.array(rows, pa.list_(pa.float64()))

    return texts.withColumn("_f", made.asNondeterministic()(F.col(f"`{text}`")))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with `score` from 0 to 1 and `predicted` 1 or 0 (score >= 0.5); columns of these names are replaced.

    Only the text counts. A NULL or empty text, or one without words, scores as a text whose words are all far from toxic.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<score: double, predicted: int>")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict[str, float] = {}
        for batch in batches:
            rows = [features_of(run, shared.value, known) for run in runs_of_texts(batch)]
            p = shared.value.probability(np.vstack(rows)) if rows else np.zeros(0)
            yield pa.StructArray.from_arrays([pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32), pa.int32())], ["score", "predicted"])

    return with_struct(docs, scored.asNondeterministic()(F.col(f"`{text}`")), "score", "predicted")
