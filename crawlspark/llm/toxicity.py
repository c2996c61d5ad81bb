"""Toxicity scores from weak supervision.

1. Voters. Words and word stems that go with the label ``toxic`` are mined from labelled rows, beside a short list of
   common insults and some patterns of style. A word votes if a text holds it, a stem if a text holds it densely and in
   several forms. The label itself is one more, fallible voter.
2. Label model. A generative model with the hidden class as its cause gives each voter its rates of firing in either
   class (EM), then measures how voters correlate within a class and counts correlated voters less, and fits again.
   Its posterior is a soft label for every training row.
3. Classifier. A linear (logistic) model over the voters' evidence in a text learns the posteriors. It alone scores.

Labels are read only for fitting, from at most ``LABELLED`` rows a class, taken in the order of a hash of the id, and
weighted back to the true shares; everything collected to the driver is bounded by that and by ``VOTERS``. Scoring is a
map over all texts and uses nothing but the text. Null and empty texts get the score of a text without evidence. Rows
without a label, or with a null one, are not learned from; without any labels the fixed list alone votes. Copies of a
row are each scored; further columns stay as they are.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Most labelled rows of each class that a model is fitted on.
LABELLED = 6_000
# Mined voters.
VOTERS = 400
STEM = range(2, 9)
DENSE_RATE, DENSE_FORMS = 0.008, 2
# Common insults that vote even where no label shows them.
INSULTS = ("asshole bastard bitch clown creep cretin disgusting dumb dumbass fool garbage idiot imbecile jerk loser moron "
           "pathetic pig scum scumbag shit stupid trash ugly vermin worthless").split()
PATTERNS = {"shouting": re.compile(r"(?:\b[A-Z]{3,}\b[^\w\n]*){4}"), "marks": re.compile(r"[!?]{3,}"), "masked": re.compile(r"\b\w+[*@#$]{2,}\w*\b"),
            "address": re.compile(r"\byou(?:'re| are)? (?:such )?an? \w+", re.I)}
WORD = re.compile(r"\w+")
CACHE = 100_000


def stems(word: str) -> list[str]:
    return ["=" + word] + [word[:k] for k in STEM if k <= len(word)]


def evidence(counts: Counter, keys) -> dict:
    """Per key: how often its words stand in a text, and in how many forms."""
    found: dict = {}
    for word, n in counts.items():
        for key in keys(word):
            hit = found.get(key)
            if hit is None:
                found[key] = [n, 1]
            else:
                hit[0] += n
                hit[1] += 1
    return found


def fires(word: bool, hit, total: int) -> bool:
    """Whether a voter votes: a word at once, a stem by its density and forms."""
    return word or (hit[1] >= DENSE_FORMS and hit[0] >= DENSE_RATE * total)


def words(text: str | None) -> Counter:
    return Counter(WORD.findall((text or "").lower()))


def styles(text: str | None) -> list[float]:
    return [float(bool(p.search(text or ""))) for p in PATTERNS.values()]


@dataclass
class Model:
    lexicon: dict[str, int]
    weights: np.ndarray  # vote of each lexicon entry, its share of the words, styles, then the intercept

    def scorer(self):
        size, lexicon, weights = len(self.lexicon), self.lexicon, self.weights.tolist()
        word = [key[0] == "=" for key in lexicon]
        kept: dict[str, tuple[int, ...]] = {}

        def keys(form):
            found = kept.get(form)
            if found is None:
                if len(kept) >= CACHE:
                    kept.clear()
                found = kept[form] = tuple(lexicon[s] for s in stems(form) if s in lexicon)
            return found

        def score(text):
            counts = words(text)
            total = sum(counts.values())
            z = weights[-1]
            for key, hit in evidence(counts, keys).items():
                if fires(word[key], hit, total):
                    z += weights[key] + weights[size + key] * min(1.0, hit[0] / total / 0.02)
            for k, on in enumerate(styles(text)):
                if on:
                    z += weights[2 * size + k]
            return 1 / (1 + np.exp(-max(-30.0, min(30.0, z))))

        return score


def labelled_rows(documents: DataFrame, labels: DataFrame, training: F.Column, seed: int = 0) -> DataFrame:
    """text, toxic, weight of the rows to fit on: at most ``LABELLED`` of each class; a row's weight is what it stands for."""
    marked = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & training).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    totals = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    taken = None
    for kind in (0, 1):
        part = marked.filter(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(LABELLED)
        part = part.withColumn("weight", F.lit(max(1.0, totals.get(kind, 0) / LABELLED)))
        taken = part if taken is None else taken.unionByName(part)
    # At most 2 * LABELLED ids of three numbers: a bounded broadcast.
    return documents.select("doc_id", "text").join(F.broadcast(taken), "doc_id")


def _mine(rows: DataFrame) -> list[str]:
    """Words and stems whose votes go with the label, the strongest first, ``VOTERS`` at most."""
    def count(frames):
        found: dict[str, list[float]] = {}
        for frame in frames:
            for text, toxic, weight in zip(frame["text"], frame["toxic"], frame["weight"], strict=True):
                counts = words(text)
                total = sum(counts.values())
                for key, hit in evidence(counts, stems).items():
                    if fires(key[0] == "=", hit, total):
                        found.setdefault(key, [0.0, 0.0])[toxic] += weight
        keys = list(found)
        for at in range(0, len(keys), 50_000):
            part = keys[at:at + 50_000]
            yield pd.DataFrame({"key": part, "clean": [found[k][0] for k in part], "toxic": [found[k][1] for k in part]})

    totals = rows.groupBy("toxic").agg(F.sum("weight").alias("n")).collect()
    n = {r["toxic"]: r["n"] for r in totals}
    if not n.get(0) or not n.get(1):
        return []
    counted = rows.select("text", "toxic", "weight").mapInPandas(count, "key string, clean double, toxic double").groupBy("key").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    lift = F.log((F.col("toxic") + 0.5) / (n[1] + 1)) - F.log((F.col("clean") + 0.5) / (n[0] + 1))
    strong = counted.filter((F.col("toxic") >= 4) & (lift > 2)).withColumn("strength", lift * F.sqrt("toxic"))
    return [r["key"] for r in strong.orderBy(F.desc("strength"), F.length("key"), "key").limit(VOTERS).collect()]


def _matrix(texts, lexicon: dict[str, int]) -> np.ndarray:
    """The classifier's columns, without the intercept, for texts of a bounded sample."""
    size, word = len(lexicon), [key[0] == "=" for key in lexicon]
    out = np.zeros((len(texts), 2 * size + len(PATTERNS)), "float32")
    for i, text in enumerate(texts):
        counts = words(text)
        total = sum(counts.values())
        for key, hit in evidence(counts, lambda w: [lexicon[s] for s in stems(w) if s in lexicon]).items():
            if fires(word[key], hit, total):
                out[i, key], out[i, size + key] = 1, min(1.0, hit[0] / total / 0.02)
        out[i, 2 * size:] = styles(text)
    return out


def posterior(votes: np.ndarray, weight: np.ndarray, prior: np.ndarray, rounds: int = 25) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The label model: posterior of the toxic class, each voter's rates of firing (clean, toxic), each voter's share.

    ``votes`` has a row for each text and a column for each voter; ``prior`` is the first guess at the posterior. After a
    first fit the correlation of voters within the classes is measured; a voter's evidence is divided by the number of
    voters it stands for, itself and the correlated part of others.
    """
    p, share = prior.copy(), np.ones(votes.shape[1])
    rates = np.zeros((2, votes.shape[1]))
    for fit in range(2):
        for _ in range(rounds):
            sides = np.stack([weight * (1 - p), weight * p])
            totals = sides.sum(1, keepdims=True)
            rates = np.clip((sides @ votes + 0.5) / (totals + 1), 1e-4, 1 - 1e-4)
            log = np.log(rates), np.log1p(-rates)
            gain = votes @ (share * (log[0][1] - log[0][0] - log[1][1] + log[1][0])) + (share * (log[1][1] - log[1][0])).sum()
            z = gain + np.log((totals[1, 0] + 1) / (totals[0, 0] + 1))
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        if fit == 0:
            together = np.zeros((votes.shape[1],) * 2)
            for k, side in enumerate((weight * (1 - p), weight * p)):
                total = max(side.sum(), 1e-9)
                rest = votes - rates[k]
                cov = (rest * side[:, None]).T @ rest / total
                spread = np.sqrt(np.clip(np.diag(cov), 1e-6, None))
                together += np.abs(cov / np.outer(spread, spread)) * total / weight.sum()
            np.fill_diagonal(together, 0)
            share = 1 / (1 + np.where(together > 0.1, together, 0).sum(1))
    return p, rates, share


def logistic(x: np.ndarray, target: np.ndarray, weight: np.ndarray, penalty: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights and intercept (last) of a penalised logistic fit to soft targets, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype("float64")
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * np.clip(p * (1 - p), 1e-5, None))[:, None]).T @ x + np.diag(ridge), x.T @ (weight * (target - p)) - ridge * w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-3:
            break
    return w


def fit(documents: DataFrame, labels: DataFrame, training: F.Column | None = None) -> Model:
    """Learn from the labelled rows that ``training`` (a condition on doc_id) admits."""
    rows = labelled_rows(documents, labels, F.lit(True) if training is None else training)
    lexicon = {key: i for i, key in enumerate(dict.fromkeys(_mine(rows) + ["=" + w for w in INSULTS]))}
    size = len(lexicon)

    def votes(frames):
        for frame in frames:
            x = _matrix(list(frame["text"]), lexicon)
            yield pd.DataFrame({"x": [r.tobytes() for r in x], "toxic": frame["toxic"], "weight": frame["weight"]})

    # At most 2 * LABELLED rows of VOTERS columns.
    found = rows.select("text", "toxic", "weight").mapInPandas(votes, "x binary, toxic int, weight double").toPandas()
    weights = np.zeros(2 * size + len(PATTERNS) + 1)
    if found["toxic"].nunique() < 2:
        weights[[lexicon["=" + w] for w in INSULTS]] = 4
        weights[-1] = -3
        return Model(lexicon, weights)
    x = np.stack([np.frombuffer(b, "float32") for b in found["x"]])
    toxic, weight = found["toxic"].to_numpy(), found["weight"].to_numpy()
    ballots = np.hstack([x[:, :size], x[:, 2 * size:], toxic[:, None]]).astype("float64")
    soft, _, _ = posterior(ballots, weight, np.where(toxic == 1, 0.9, 0.02))
    used = np.flatnonzero(x.any(0))
    fitted = logistic(x[:, used], soft, weight)
    weights[used], weights[-1] = fitted[:-1], fitted[-1]
    return Model(lexicon, weights)


def score(df: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``df`` with a score from 0 to 1; a map over the rows."""
    kept = [c for c in df.columns if c != name]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(name, T.DoubleType())])

    def run(batches):
        import pyarrow as pa

        one = model.scorer()
        for rows in batches:
            scores = [float(one(t.as_py())) for t in rows.column(text)]
            yield pa.RecordBatch.from_arrays([rows.column(c) for c in kept] + [pa.array(scores, pa.float64())], names=schema.names)

    return df.mapInArrow(run, schema)
