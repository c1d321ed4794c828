"""Toxicity by a factorization machine over hashed terms.

Terms of a text are hashed into a fixed number of slots.  Beside a weight, every slot has a short
vector; the inner products of the vectors of two present slots score their meeting, so a pair such as
an insult and the mention of a group counts beyond what both weigh alone.
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

from winnowry.llm.common import held_out

SLOTS = 1 << 20
TRAIN_DOCS = 20_000  # bound of the training sample
FACTORS = 8
VISITS = 50_000_000  # terms read over all epochs, which bounds the driver's time
MIN_EPOCHS, MAX_EPOCHS, BATCH = 8, 60, 256
WATCHED = 0.1  # share of the sample that decides when to stop
RATE, FACTOR_RATE = 1.0, 0.1
# Priors: absolute and squared weights; squared factors, by occurrence, so that the factors of a slot seen in few
# documents are held as firmly as its documents pull, and those of frequent slots are free.
LASSO, RIDGE, PRIOR = 6.0, 1.0, 2.0
TERM = re.compile(r"[^\W\d_]+")


def slots_of(text: str | None) -> list[int]:
    """Distinct slots of a text's terms, lower-cased words of letters."""
    return sorted({zlib.crc32(w.encode()) % SLOTS for w in set(TERM.findall((text or "").lower()))})


@dataclass
class Machine:
    """score = logistic(bias + sum of weights + mean pairs): pairs are half of (squared sum less sum of squares) of the factors."""

    slots: np.ndarray  # sorted slots of the training documents; all others weigh nothing
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def features(self, slots: list[int]) -> np.ndarray:
        """Positions of the known slots."""
        wanted = np.asarray(slots, dtype=self.slots.dtype)
        at = np.searchsorted(self.slots, wanted)
        inside = at < len(self.slots)
        return at[inside][self.slots[at[inside]] == wanted[inside]]

    def score(self, text: str | None) -> float:
        at = self.features(slots_of(text))
        v = self.factors[at].astype(np.float64)
        pairs = 0.5 * float(((v.sum(axis=0) ** 2) - (v ** 2).sum(axis=0)).sum())
        return float(1 / (1 + np.exp(-np.clip(self.bias + self.weights[at].sum(dtype=np.float64) + pairs / max(1, len(at)), -30, 30))))


@dataclass
class Batch:
    """Documents with their terms as flat columns, and where each slot of theirs occurs; made once, read in every epoch."""

    y: np.ndarray
    terms: np.ndarray  # positions of slots, document by document
    starts: np.ndarray
    lengths: np.ndarray
    share: np.ndarray  # pairs count by the length, or long texts would be learned by heart
    by_slot: np.ndarray  # order that brings equal slots together
    first: np.ndarray
    slots: np.ndarray
    seen: np.ndarray

    @staticmethod
    def of(rows: list[np.ndarray], y: np.ndarray, ids: np.ndarray) -> Batch:
        lengths = np.array([len(rows[i]) for i in ids])
        terms = np.concatenate([rows[i] for i in ids])
        by_slot = np.argsort(terms, kind="stable")
        own = terms[by_slot]
        first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        return Batch(y[ids].astype(np.float32), terms, np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths,
                     (1 / np.maximum(1, lengths - 1)).astype(np.float32), by_slot, first, own[first],
                     np.diff(np.append(first, len(own))).astype(np.float32))

    def logits(self, bias: float, w: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logits, the factors of all terms, and their sums by document."""
        own = v[self.terms]
        q = np.add.reduceat(own, self.starts)
        pairs = 0.5 * ((q ** 2).sum(axis=1) - np.add.reduceat((own ** 2).sum(axis=1), self.starts))
        return bias + np.add.reduceat(w[self.terms], self.starts) + self.share * pairs, own, q


def chance(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(rows: list[np.ndarray], y: np.ndarray, slots: np.ndarray) -> Machine:
    """Logistic loss and priors, minimized batch by batch over the slots of the batch alone; the seed is fixed.

    ``rows`` has the positions in ``slots`` of every document.  Weights follow the regularized leader,
    factors take steps scaled by their own history.  A tenth of the documents is only watched: the
    machine of the epoch with the least loss there is returned.
    """
    rng, m, n = np.random.default_rng(7), len(slots), len(y)
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if n else 0.5
    bias, pull = float(np.log(share / (1 - share))), 1e-9
    # One position more, always of zeros, is in every document, so that none is without any.
    w, z, history = np.zeros(m + 1, np.float32), np.zeros(m + 1), np.zeros(m + 1)
    v, squares = rng.normal(0, 0.05, (m + 1, FACTORS)).astype(np.float32), np.full((m + 1, FACTORS), 1e-2, np.float32)
    v[m] = 0
    best = Machine(slots, bias, w[:m].copy(), np.zeros((m, FACTORS), np.float32))
    if not m or n < 20:
        return best
    rows = [np.append(r, m) for r in rows]
    order = rng.permutation(n)
    split = max(1, int(n * WATCHED))
    cut = lambda ids: [Batch.of(rows, y, ids[i:i + BATCH]) for i in range(0, len(ids), BATCH)]
    watched, learned = cut(order[:split]), cut(order[split:])
    epochs = int(np.clip(VISITS // sum(map(len, rows)), MIN_EPOCHS, MAX_EPOCHS))
    least, since = np.inf, 0
    for _ in range(epochs):
        for k in rng.permutation(len(learned)):
            batch = learned[k]
            logits, own, q = batch.logits(bias, w, v)
            e = (chance(logits) - batch.y).astype(np.float32)
            at = batch.slots
            g = np.add.reduceat(np.repeat(e, batch.lengths)[batch.by_slot], batch.first).astype(np.float64)
            z[at] += g - (np.sqrt(history[at] + g * g) - np.sqrt(history[at])) / RATE * w[at]
            history[at] += g * g
            w[at] = np.where(np.abs(z[at]) <= LASSO, 0, (np.sign(z[at]) * LASSO - z[at]) / ((1 + np.sqrt(history[at])) / RATE + RIDGE))
            pulls = np.repeat(e * batch.share, batch.lengths)[:, None] * (np.repeat(q, batch.lengths, axis=0) - own)
            gv = np.add.reduceat(pulls[batch.by_slot], batch.first, axis=0) + (PRIOR * np.sqrt(batch.seen))[:, None] * v[at] / BATCH
            squares[at] += gv * gv
            v[at] -= np.float32(FACTOR_RATE) * gv / np.sqrt(squares[at])
            w[m], v[m], z[m] = 0, 0, 0
            pull += float(e.sum()) ** 2
            bias -= 0.05 * float(e.sum()) / pull ** 0.5
        loss = sum(float((np.logaddexp(0, x) - b.y * x).sum()) for b in watched for x in [b.logits(bias, w, v)[0]])
        since += 1
        if loss < least * 0.9999:
            least, since, best = loss, 0, Machine(slots, bias, w[:m].copy(), v[:m].copy())
        if since > max(4, epochs // 3):
            break
    return best


def train(docs: DataFrame, labels: DataFrame, bound: int = TRAIN_DOCS) -> Machine:
    """A machine from the labelled training folds.

    At most about ``bound`` labelled documents are used, chosen by a hash of the id; every slot of theirs
    has its weight and factors.  The driver receives the sample's slots, 4 bytes each.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter(
        "doc_id is not null and toxic in (0, 1)").filter(~held_out(F.col("doc_id")))
    n = known.count()
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("toxicity sample")), 11) / float(1 << 53)
    sample = known.filter(draw < min(1.0, bound / max(1, n)))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(sample, "doc_id")

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"toxic": batch["toxic"], "slots": [np.array(slots_of(t), np.int32).tobytes() for t in batch["text"]]})

    local = sorted(tuple(r) for r in rows.select("text", "toxic").mapInPandas(hashed, "toxic int, slots binary").collect())
    hashes = [np.frombuffer(r[1], np.int32) for r in local]
    slots = np.unique(np.concatenate([*hashes, np.zeros(0, np.int32)]))
    return fit([np.searchsorted(slots, h) for h in hashes], np.array([r[0] for r in local], np.float64), slots)


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, score (0 to 1) of every text; null and empty texts get the score of no terms."""
    model = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": [model.value.score(t) for t in batch["text"]]})

    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(
        run, "doc_id string, score double").withColumn("doc_id", F.col("doc_id").cast("bigint"))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from a score of 0.5) for every document, repeated rows included."""
    return score(docs, train(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
