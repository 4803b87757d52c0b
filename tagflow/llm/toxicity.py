"""Operator 9: toxicity by weak supervision.

Voters look for lexicon words, patterns and word beginnings. A generative model with a hidden label
estimates from their votes alone how often each fires on either label and how far voters are
correlated given the label; correlated voters share their evidence. Its posterior labels train a
linear classifier on word-beginning features, which scores every whole text. The given labels only
select which voters take part and, at the end, calibrate the classifier's scale.

The voters from data, the label model and the classifier are fitted on a bounded sample:
TRAIN_ROWS labelled rows outside the held-out third, chosen by hash. Scoring is one pass over
all texts with no shuffle; the fitted model has at most FEATURES weights.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bound of the labelled sample, and of the classifier's features.
TRAIN_ROWS, FEATURES = 8000, 1024
#: Voters taken from the sample beside the hand-written ones.
MINED = 96
THRESHOLD = 0.7
HELD_OUT = 3
#: Evidence (rows times log lift) that a mined voter needs, and log lift that any voter needs to take part.
EVIDENCE, LIFT = 12.0, 3.0
#: What the label model starts from: the posterior of a row with a vote, and of one without.
START = (0.9, 0.02)
#: Joint firings worth as much as the belief that two voters are not correlated; firings worth as much as START's belief in a voter.
SHRINK, BELIEF = 4.0, 5.0
#: Correlation from which a voter's agreement with another says nothing of its accuracy.
ALIKE = 0.5

# Hand-written lexicon voters, one for each line (any language).
LEXICON = """
idiot idiots idiotic idiota idiotas idiote idiotes
moron morons imbecile imbecil imbécil imbécile dumm dummkopf trottel
stupid estupido estúpido stupide
loser losers versager perdedor perdedora
pathetic erbärmlich pathétique patético
scum abschaum escoria ordure
worthless wertlos inutile inútil
trash garbage müll basura poubelle
clown clowns payaso bouffon
disgusting ekelhaft asqueroso dégoûtant
hate hass odio haine
kill töten matar tuer
shut halt cállate
damn hell verdammt maldito merde mierda scheiße
bastard arschloch cabrón connard
fool narr tonto crétin
ugly hässlich feo laid
coward feigling cobarde lâche
filthy dreckig sucio sale
freak freaks spinner bicho
""".strip()

# Pattern voters.
PATTERNS = [r"[!?]{3,}", r"\b(?:you|du|tu|usted)\s+(?:are|bist|es|eres)\b", r"(.)\1{4,}", r"\b[A-ZÄÖÜÑÉ]{4,}\s+[A-ZÄÖÜÑÉ]{4,}\b", r"[a-z]\*{2,}[a-z]?", r"[@#$%&]{3,}"]

_WORD = re.compile(r"[^\W\d_]+")
_VOTE = [frozenset(x.split()) for x in LEXICON.splitlines()]
_PATTERN = [re.compile(x) for x in PATTERNS]


def is_held_out(doc_id: F.Column) -> F.Column:
    """crc32 of the id as text, modulo 3, is one (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % HELD_OUT == 1


def word_features(word: str) -> tuple[int, ...]:
    """Hashes of the word and of its beginnings of 4 to 6 letters."""
    cuts = {"=" + word, *(word[:k] for k in (4, 5, 6) if len(word) >= k)}
    return tuple(zlib.crc32(x.encode()) for x in cuts)


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def hand_votes(text: str, words: set[str]) -> list[bool]:
    return [not x.isdisjoint(words) for x in _VOTE] + [bool(x.search(text)) for x in _PATTERN]


@dataclass
class Model:
    """Weights by feature hash, and the bias."""

    weights: dict[int, float]
    bias: float


def sample(docs: DataFrame, labels: DataFrame, rows: int) -> pd.DataFrame:
    """Features, votes and labels of at most `rows` labelled training rows.

    Ids are taken by a hash, so the sample is the same at every run. Where labels of an id disagree the
    larger holds, of an id with several texts the smallest counts, and its repeats count once; null ids and labels
    and empty tables give no rows.
    """
    usable = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~is_held_out(F.col("doc_id").cast("long")))
    per = usable.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = per.count()
    share = 1 << 20 if total <= rows else max(1, int((1 << 20) * 0.9 * rows / total))
    chosen = per.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share).limit(rows)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch["text"]:
                text = text if isinstance(text, str) else ""
                words = words_of(text)
                out.append((np.array(sorted({f for w in words for f in word_features(w)}), np.uint32).tobytes(), np.array(hand_votes(text, words)).tobytes()))
            frame = pd.DataFrame(out, columns=["features", "votes"])
            frame.insert(0, "toxic", batch["toxic"].to_numpy())
            frame.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield frame

    joined = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(chosen), "doc_id")  # at most `rows` rows of two numbers
    one = joined.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    return one.mapInPandas(work, "doc_id long, toxic int, features binary, votes binary").toPandas().sort_values("doc_id", ignore_index=True)


@dataclass
class LabelModel:
    """What the generative model estimated: posterior of every row, accuracy of every voter, and their correlations."""

    posterior: np.ndarray
    accuracy: np.ndarray
    correlation: np.ndarray


def _logit(p: np.ndarray | float) -> np.ndarray:
    return np.log(p) - np.log1p(-np.asarray(p, float))


def label_model(votes: np.ndarray, share: float, rounds: int = 40) -> LabelModel:
    """Expectation-maximisation over a hidden label, from voters that say 1 or abstain; no row's given label enters.

    `share` is the class balance. A voter's accuracy is the chance of label 1 where it fires, estimated from its
    agreement with the voters that it is not correlated with. The correlation of two voters is that of their residuals, weighed
    by the posterior, and shrunk where they seldom fire together; a voter's evidence is divided by one plus its
    positive correlations. Rows without a vote share what the class balance leaves.
    """
    x = votes.astype(float)
    n, count = x.shape
    any_ = x.any(1)
    prior = float(np.clip(share, 1e-3, 0.5))
    y = np.where(any_, *START)
    accuracy, correlation = np.full(count, START[0]), np.eye(count)
    for _ in range(rounds):
        # how often another voter, not correlated with it, fires where this one does, against where the label is 1 and 0
        other = x @ (correlation < ALIKE) > 0
        where, high, low = (x * other).sum(0) / np.maximum(x.sum(0), 1), y @ other / max(y.sum(), 1e-9), (1 - y) @ other / max((1 - y).sum(), 1e-9)
        apart = np.maximum(high - low, 0.05)
        known = x.sum(0) * apart**2
        accuracy = np.clip((np.clip((where - low) / apart, 0, 1) * known + START[0] * BELIEF) / (known + BELIEF), 0.02, 0.98)
        on, off = (y @ x) / max(y.sum(), 1e-9), ((1 - y) @ x) / max((1 - y).sum(), 1e-9)
        high, low = (x - on) * np.sqrt(y)[:, None], (x - off) * np.sqrt(1 - y)[:, None]
        together = high.T @ high + low.T @ low
        scale = np.sqrt(np.diag(together)) + 1e-9
        fired = x.T @ x
        correlation = together / np.outer(scale, scale) * fired / (fired + SHRINK)
        np.fill_diagonal(correlation, 1.0)
        weight = 1 / np.maximum(correlation, 0).sum(1)
        logit = _logit(prior) + x @ ((_logit(accuracy) - _logit(prior)) * weight)
        y = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        y[~any_] = np.clip((prior * n - y[any_].sum()) / max((~any_).sum(), 1), 1e-3, prior)
    return LabelModel(y, accuracy, correlation)


def _matrix(rows: list[np.ndarray], chosen: np.ndarray) -> np.ndarray:
    out = np.zeros((len(rows), len(chosen)), np.float32)
    for k, own in enumerate(rows if len(chosen) else []):
        at = np.searchsorted(chosen, own)
        at[at == len(chosen)] = 0
        out[k, at[chosen[at] == own]] = 1
    return out


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 400, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on soft labels, by Adam on all rows; classes count alike."""
    w, bias = np.zeros(x.shape[1], np.float32), 0.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    weight = np.where(y > 0.5, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    weight /= weight.sum()
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w + bias, -30, 30)))
        e = (p - y) * weight
        g = np.concatenate((x.T @ e.astype(np.float32) + ridge * w, [e.sum()]))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w -= step[:-1].astype(np.float32)
        bias -= step[-1]
    return w, float(bias)


def calibrated(raw: np.ndarray, gold: np.ndarray, rounds: int = 30) -> tuple[float, float]:
    """Scale (not negative) and shift that turn the classifier's raw scores into log odds of the given labels."""
    spread = raw.std() + 1e-9
    x = np.column_stack([(raw - raw.mean()) / spread, np.ones(len(raw))])
    w = np.array([1.0, np.log((gold.sum() + 0.5) / (len(gold) - gold.sum() + 0.5))])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - gold) + np.array([0.5, 0.0]) * w
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag([0.5, 1e-3]), slope)
        w[0] = np.clip(w[0], 0.0, 20.0)
    return float(w[0] / spread), float(w[1] - w[0] * raw.mean() / spread)


def _unlike(rows: list[np.ndarray], gold: np.ndarray, ranked: np.ndarray, most: int) -> np.ndarray:
    """The first `most` of the ranked features whose toxic rows are not those of one taken before."""
    order = np.argsort(ranked)
    has = _matrix([x for x, g in zip(rows, gold, strict=True) if g > 0], ranked[order])[:, np.argsort(order)]
    size = has.sum(0)
    common = has.T @ has
    taken: list[int] = []
    for k in range(len(ranked)):
        if size[k] and len(taken) < most and all(common[k, j] < 0.7 * (size[k] + size[j] - common[k, j]) for j in taken):
            taken.append(k)
    return np.sort(ranked[taken])


def fit(rows: pd.DataFrame) -> Model:
    """Voters, label model and classifier from the bounded sample (no rows, one label or no voter: the share of label 1, at most 0.1)."""
    gold = rows["toxic"].to_numpy() if len(rows) else np.zeros(0, np.int64)
    if len(np.unique(gold)) < 2:
        return Model({}, float(np.log(0.1 / 0.9)))
    own = [np.frombuffer(x, np.uint32) for x in rows["features"]]
    flat = np.concatenate(own)
    kinds, at = np.unique(flat, return_inverse=True)
    where = np.repeat(gold, [len(x) for x in own])
    bad, all_ = np.bincount(at, where, len(kinds)), np.bincount(at, minlength=len(kinds))
    ok, n_bad, n_ok = all_ - bad, gold.sum(), (gold == 0).sum()
    lift = np.log((bad + 0.5) / (n_bad + 1)) - np.log((ok + 0.5) / (n_ok + 1))
    weight = np.where(all_ >= 3, (bad / n_bad + ok / n_ok) * np.abs(lift), 0)
    up = np.where(lift > LIFT, bad * lift, 0)
    ranked = np.argsort(-up, kind="stable")[: 40 * MINED]
    mined = _unlike(own, gold, kinds[ranked[up[ranked] >= EVIDENCE]], MINED)
    hand = np.array([np.frombuffer(x, bool) for x in rows["votes"]])
    good = np.log((hand[gold > 0].sum(0) + 0.5) / (n_bad + 1)) - np.log((hand[gold == 0].sum(0) + 0.5) / (n_ok + 1)) > LIFT
    votes = np.column_stack([hand[:, good & (hand.sum(0) > 0)], _matrix(own, mined) > 0])
    if not votes.any():
        return Model({}, float(np.log(min(0.1, n_bad / len(gold)) / 0.9)))
    posterior = label_model(votes, n_bad / len(gold)).posterior
    half = FEATURES * 3 // 4
    best = np.concatenate((ranked[:half][up[ranked[:half]] > 6], np.argsort(-weight, kind="stable")[: FEATURES - half]))
    chosen = np.unique(kinds[best])
    matrix = _matrix(own, chosen)
    w, bias = logistic(matrix, posterior)
    scale, shift = calibrated(matrix @ w + bias, gold)
    return Model({int(k): float(x * scale) for k, x in zip(chosen, w, strict=True) if x}, bias * scale + shift)


def toxic_score(model: Model):
    """A column function: probability of label 1 for a text; empty and null texts get the bias alone."""

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights, known = model.weights, {}
        for batch in texts:
            scores = []
            for text in batch:
                found: set[int] = set()
                for w in words_of(text) if isinstance(text, str) else ():
                    hit = known.get(w)
                    if hit is None:
                        hit = known[w] = tuple(f for f in word_features(w) if f in weights)
                    if hit:
                        found.update(hit)
                scores.append(model.bias + sum(weights[f] for f in sorted(found)))
                if len(known) > 400_000:
                    known.clear()
            yield pd.Series(1 / (1 + np.exp(-np.clip(np.array(scores, float), -30, 30))))

    return scored.asNondeterministic()  # or the optimizer may run it twice


def score(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of `docs`.

    Null and empty texts get the model's bias; repeated rows stay, each scored; a null doc_id stays null;
    an empty table gives no rows; extra columns are ignored. Without usable labels every score is 0.1. A
    very long text is scored whole, in one task, with memory for its distinct words.
    """
    model = fit(sample(docs, labels, rows))
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), toxic_score(model)("text").alias("score"))
    return scored.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of `docs` that are not predicted toxic, with all their columns as they are, whatever their names.

    Nulls, empty and long texts and repeated rows as in `score`; an empty table stays empty.
    """
    model = fit(sample(docs, labels, rows))
    plain = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))
    scored = plain.withColumn("score", toxic_score(model)(f"c{docs.columns.index('text')}"))
    return scored.where(F.col("score") < THRESHOLD).drop("score").toDF(*docs.columns)
