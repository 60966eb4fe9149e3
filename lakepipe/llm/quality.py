"""Weak-label quality model.

Overlapping heuristic labellers vote good, bad or abstain on every text.  How
often each pattern of votes occurs (at most 3 ** labellers patterns, counted
over all texts) is all that expectation-maximisation needs to estimate the
labellers' accuracies.  The posterior labels of a bounded sample then train a
hashed linear scorer, which scores every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakepipe.llm import text as tx
from lakepipe.llm.linear import Rows, fit, sigmoid

ABSTAIN, BAD, GOOD = 0, 1, 2

#: Labeller: (statistic, bad if below, good if at least, bad if above, good if at most); None: no such bound.
LABELLERS: dict[str, tuple[str, float | None, float | None, float | None, float | None]] = {
    "no_words": ("words", 1, 20, None, None),
    "repeated_word": ("same_as_before", None, None, 0.2, None),
    "distinct_words": ("distinct_in_window", 0.7, 0.8, None, None),
    "symbols": ("symbol_share", None, None, 0.04, None),
    "line_shape": ("words_per_line", 2.5, 5.0, None, None),
    "few_stops": ("stops_per_word", 0.01, 0.03, None, None),
    "many_stops": ("stops_per_word", None, None, 0.4, None),
    "shouting": ("capital_share", None, None, 0.3, None),
    "word_length": ("letters_per_word", 2.5, None, None, None),
}

_BITS = 16
_WINDOW = 64
_PLAIN = np.zeros(256, bool)
_PLAIN[128:] = True
for _c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 \t\n\r.,;:!?'\"()-":
    _PLAIN[ord(_c)] = True


class Texts:
    """Words of a slice of texts with their hashes and line breaks."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        self.data, self.off = data, off
        self.starts, self.ends, self.first = tx.word_bounds(data, off)
        self.words = tx.span_hashes(data, self.starts, self.ends)
        self.n = np.diff(self.first)
        self.of = np.repeat(np.arange(len(off) - 1), self.n)
        same = np.zeros(len(self.words), bool)
        same[1:] = (self.words[1:] == self.words[:-1]) & (self.of[1:] == self.of[:-1])
        self.same = same
        breaks = np.concatenate([[0], np.cumsum(data == 10)])
        self.line = breaks[self.starts] if len(self.starts) else np.zeros(0, np.int64)

    def statistics(self) -> dict[str, np.ndarray]:
        k, n = len(self.off) - 1, np.maximum(self.n, 1)
        sizes = np.maximum(np.diff(self.off), 1)
        total = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[self.off])  # noqa: E731  over bytes
        window = (np.arange(len(self.words)) - np.repeat(self.first[:-1], self.n)) // _WINDOW
        key = tx.mix(self.words + (window.astype(np.uint64) << np.uint64(40)) + (self.of.astype(np.uint64) << np.uint64(20)))
        _, at = np.unique(key, return_index=True)
        new_line = np.ones(len(self.words), bool)
        new_line[1:] = (self.line[1:] != self.line[:-1]) | (self.of[1:] != self.of[:-1])
        count = lambda flags: np.bincount(self.of[flags], minlength=k)  # noqa: E731  over words
        stop = np.isin(self.data[self.ends - 1], np.frombuffer(b".!?", np.uint8)) if len(self.ends) else np.zeros(0, bool)
        return {
            "words": self.n.astype(float),
            "same_as_before": count(self.same) / n,
            "distinct_in_window": np.bincount(self.of[at], minlength=k) / n,
            "symbol_share": total(~_PLAIN[self.data]) / sizes,
            "words_per_line": self.n / np.maximum(count(new_line), 1),
            "stops_per_word": count(stop) / n,
            "capital_share": total((self.data > 64) & (self.data < 91)) / sizes,
            "letters_per_word": np.bincount(self.of, self.ends - self.starts, k) / n,
        }

    def votes(self) -> np.ndarray:
        """One column for each labeller."""
        stats = self.statistics()
        out = np.zeros((len(self.off) - 1, len(LABELLERS)), np.int64)
        for j, (name, below, least, above, most) in enumerate(LABELLERS.values()):
            x = stats[name]
            if least is not None:
                out[x >= least, j] = GOOD
            if below is not None:
                out[x < below, j] = BAD
            if most is not None:
                out[x <= most, j] = GOOD
            if above is not None:
                out[x > above, j] = BAD
        # A few words show neither lines nor sentences.
        short = stats["words"] < 10
        for j, name in enumerate(LABELLERS):
            if name in ("line_shape", "few_stops", "distinct_words"):
                out[short, j] = ABSTAIN
        return out

    def features(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(columns, values, lengths): shares of hashed word ends, of words alone in their line and of repeats."""
        tail = tx.span_hashes(self.data, np.maximum(self.starts, self.ends - 2), self.ends)
        column = (tail >> np.uint64(64 - _BITS)).astype(np.int64)
        alone = np.zeros(len(self.words), bool)
        if len(self.words):
            edge = np.ones(len(self.words) + 1, bool)
            edge[1:-1] = (self.line[1:] != self.line[:-1]) | (self.of[1:] != self.of[:-1])
            alone = edge[:-1] & edge[1:]
        all_of = np.concatenate([self.of, self.of[alone], self.of[self.same]])
        all_columns = np.concatenate([column, np.full(alone.sum(), 1 << _BITS), np.full(self.same.sum(), (1 << _BITS) + 1)])
        width = (1 << _BITS) + 2
        pair, count = np.unique(all_of * width + all_columns, return_counts=True)
        of = pair // width
        return pair % width, np.sqrt(count / np.maximum(self.n[of], 1)), np.bincount(of, minlength=len(self.off) - 1)


def code(votes: np.ndarray) -> np.ndarray:
    return votes @ (3 ** np.arange(votes.shape[1]))


def decode(codes: np.ndarray, labellers: int) -> np.ndarray:
    return (np.asarray(codes)[:, None] // 3 ** np.arange(labellers)) % 3


@dataclass
class Reliability:
    prior: float  # of good
    table: np.ndarray  # labeller x class (bad, good) x vote: how often it votes so on texts of the class

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of good; an abstention tells nothing, as a labeller knows one fault only."""
        logit = np.full(len(votes), np.log(self.prior / (1 - self.prior)))
        for j in range(votes.shape[1]):
            said = votes[:, j] != ABSTAIN
            logit[said] += np.log(self.table[j, 1, votes[said, j]] / self.table[j, 0, votes[said, j]])
        return sigmoid(logit)


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = 50) -> Reliability:
    """Expectation-maximisation over vote patterns; it begins with a text as bad where any labeller says so."""
    q = np.where((votes == BAD).any(1), 0.1, 0.9)
    r = Reliability(0.5, np.full((votes.shape[1], 2, 3), 0.5))
    for _ in range(rounds):
        mass = np.stack([counts * (1 - q), counts * q])
        r.prior = float(np.clip(mass[1].sum() / max(counts.sum(), 1e-9), 0.01, 0.99))
        for j in range(votes.shape[1]):
            for c in (0, 1):
                n = [mass[c][votes[:, j] == v].sum() + 1.0 for v in (ABSTAIN, BAD, GOOD)]
                r.table[j, c] = np.array(n) / sum(n)
        q = r.posterior(votes)
    return r


def quality_scores(
    docs: DataFrame, threshold: float = 0.5, max_rows: int = 6000, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: id, votes (text), posterior, score, keep.

    ``score`` is the linear scorer's probability of good quality, ``keep`` is
    score >= threshold.  Vote patterns are counted over all texts; the scorer
    learns from at most ``max_rows`` texts, chosen by a hash of id and text.
    Null and empty texts have no words and count as bad by the first labeller;
    repeated rows count as often as they occur; an empty table gives an empty
    result.  Other columns are ignored.
    """
    ids = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    k = len(LABELLERS)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.chunks(batch, "t"):
                yield pa.RecordBatch.from_arrays([pa.array(code(Texts(*tx.texts(part.column("t"))).votes()), pa.int64())], ["p"])

    patterns = rows.select("t").mapInArrow(vote, "p long").groupBy("p").count().orderBy("p").collect()
    votes = decode(np.array([r["p"] for r in patterns], np.int64), k)
    reliability = estimate(votes, np.array([r["count"] for r in patterns], float))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.chunks(batch, "t"):
                texts = Texts(*tx.texts(part.column("t")))
                columns, values, lengths = texts.features()
                q = reliability.posterior(texts.votes())
                at = np.concatenate([[0], np.cumsum(lengths)])
                packed = [columns[a:b].astype("<i4").tobytes() + values[a:b].astype("<f4").tobytes() for a, b in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays([part.column("h"), pa.array(q, pa.float64()), pa.array(packed, pa.binary())], ["h", "q", "f"])

    chosen = rows.select(F.xxhash64("i", F.substring("t", 1, 200)).alias("h"), "t")
    edge = chosen.select("h").orderBy("h").limit(max_rows).agg(F.max("h")).first()[0]
    got = chosen.where(F.col("h") <= (edge if edge is not None else 0)).mapInArrow(sample, "h long, q double, f binary")
    got = got.dropDuplicates(["h"]).orderBy("h").collect()  # at most max_rows
    q = np.array([r["q"] for r in got], float)
    raw = [bytes(r["f"]) for r in got]
    lengths = np.array([len(b) // 8 for b in raw], np.int64)
    columns = np.concatenate([np.frombuffer(b, "<i4", len(b) // 8) for b in raw] or [np.zeros(0, "<i4")])
    values = np.concatenate([np.frombuffer(b, "<f4", offset=len(b) // 2) for b in raw] or [np.zeros(0, "<f4")])
    sure = np.abs(2 * q - 1)
    # Both classes weigh the same, however rare one is.
    weight = sure * np.where(q >= 0.5, 1 / max(sure[q >= 0.5].sum(), 1e-9), 1 / max(sure[q < 0.5].sum(), 1e-9))
    w, bias = fit(Rows(columns, values, lengths, (1 << _BITS) + 2), (q >= 0.5).astype(float), weight, 1e-5, steps=150)
    names = list(LABELLERS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.chunks(batch, "t"):
                texts = Texts(*tx.texts(part.column("t")))
                columns, values, lengths = texts.features()
                of = np.repeat(np.arange(len(lengths)), lengths)
                score = sigmoid(np.bincount(of, values * w[columns], len(lengths)) + bias)
                found = texts.votes()
                said = [",".join(f"{n}={'-bg'[v]}" for n, v in zip(names, row) if v) for row in found.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("i"), pa.array(said, pa.string()), pa.array(reliability.posterior(found), pa.float64()), pa.array(score, pa.float64())],
                    ["i", "votes", "posterior", "score"],
                )

    scored = rows.mapInArrow(run, f"i {ids}, votes string, posterior double, score double")
    return scored.withColumn("keep", F.col("score") >= threshold).withColumnRenamed("i", id_col)
