"""Counterfactual-regularised toxicity classifier.

A text is the set of its words and word beginnings (hashed to 64 bits, so no
two features share a weight).  Features are scaled by their log count ratio
between the labels and weighed by logistic regression.  For every labelled
text that mentions an identity term, the text with the term swapped for
another of its group is made, and the squared change of the score is part of
the loss: mentioning a group as such must not move the score.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakepipe.llm import text as tx
from lakepipe.llm.linear import Rows, fit, sigmoid

#: Neutral identity terms; a term may stand for any other of its group.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men", "girls", "boys", "transgender", "nonbinary"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "atheists"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("gay", "lesbian", "bisexual", "straight", "heterosexual", "queer"),
    ("immigrants", "refugees", "foreigners", "natives", "citizens"),
    ("deaf", "blind", "disabled", "autistic"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("muslime", "christen", "juden", "hindus", "atheisten"),
    ("femmes", "hommes", "filles", "garçons"),
    ("musulmans", "chrétiens", "juifs", "hindous", "athées"),
    ("mujeres", "hombres", "niñas", "niños"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "ateos"),
)

_BEGINNING = 5  # bytes of a word that make its second feature
_SALT = np.uint64(0x2545F4914F6CDD1D)


def features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features of all words, index of each text's first one and one more); not distinct."""
    starts, ends, first = tx.word_bounds(data, off, tx.LETTERS)
    words = tx.span_hashes(data, starts, ends)
    begin = tx.span_hashes(data, starts, np.minimum(ends, starts + _BEGINNING)) ^ _SALT
    out = np.empty(2 * len(words), np.uint64)
    out[0::2], out[1::2] = words, begin
    return out, 2 * first


def _of_term(term: str) -> np.ndarray:
    data = np.frombuffer(term.encode(), np.uint8)
    return np.unique(features(data, np.array([0, len(data)]))[0])


@dataclass
class Model:
    keys: np.ndarray  # sorted features
    weights: np.ndarray
    bias: float

    def score(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        found, first = features(data, off)
        n = len(off) - 1
        z = np.full(n, self.bias)
        if len(self.keys) and len(found):
            place = np.searchsorted(self.keys, found)
            place[place == len(self.keys)] = 0
            hit = np.flatnonzero(self.keys[place] == found)
            text = np.searchsorted(first, hit, side="right") - 1
            once = np.unique(text * len(self.keys) + place[hit])
            z += np.bincount(once // len(self.keys), self.weights[once % len(self.keys)], n)
        return sigmoid(z)


def train(
    sample: list[tuple[np.ndarray, int]],
    terms: Sequence[Sequence[str]] = IDENTITY_TERMS,
    min_texts: int = 3,
    min_ratio: float = 0.5,
    penalty: float = 1.0,
    l2: float = 1e-4,
) -> Model:
    """A model of labelled feature sets; features of fewer than ``min_texts`` texts, or that hardly tell the labels apart, are left out."""
    y = np.array([label for _, label in sample], float)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(2.0 * y.max() - 1.0) if len(y) else -1.0)
    flat = np.concatenate([f for f, _ in sample])
    keys, inverse, count = np.unique(flat, return_inverse=True, return_counts=True)
    of = np.repeat(np.arange(len(y)), [len(f) for f, _ in sample])
    positive = np.bincount(inverse, y[of], len(keys))
    ratio = np.log((positive + 1) / (y.sum() + 2)) - np.log((count - positive + 1) / ((1 - y).sum() + 2))
    groups = [[_of_term(t) for t in group] for group in terms]
    identity = np.isin(keys, np.concatenate([t for group in groups for t in group])) if groups else np.zeros(len(keys), bool)
    known = (count >= min_texts) & ((np.abs(ratio) > min_ratio) | identity)
    kept, ratio = keys[known], ratio[known]
    use = known[inverse]
    columns, texts = (np.cumsum(known) - 1)[inverse[use]], of[use]
    rows = Rows(columns, ratio[columns], np.bincount(texts, minlength=len(y)), len(kept))

    # The change of features when a text's identity term is swapped for another of its group.
    mentioned: dict[int, set[int]] = {}
    for text, key in zip(of[identity[inverse]].tolist(), flat[identity[inverse]].tolist()):
        mentioned.setdefault(text, set()).add(key)
    where = {int(k): i for i, k in enumerate(kept.tolist())}
    pc, pv, pl = [], [], []
    for own in mentioned.values():
        for group in groups:
            sets = [set(term.tolist()) for term in group]
            for a, term in enumerate(sets):
                if not term <= own:
                    continue
                for b, other in enumerate(sets):
                    if a == b:
                        continue
                    change = [(where[k], -1.0) for k in term - other if k in where]
                    change += [(where[k], 1.0) for k in other - own if k in where]
                    pc += [c for c, _ in change]
                    pv += [s * ratio[c] for c, s in change]
                    pl.append(len(change))
    pairs = Rows(np.array(pc), np.array(pv), np.array(pl, dtype=np.int64), len(kept)) if pl else None
    w, bias = fit(rows, y, np.ones(len(y)), l2, pairs, penalty, steps=100)
    theta = w * ratio
    strong = np.abs(theta) > 0.01
    return Model(kept[strong], theta[strong], bias)


def labelled_sample(docs: DataFrame, labels: DataFrame, use: Column, label_col: str, max_rows: int, id_col: str, text_col: str) -> list:
    """Feature sets and labels of at most ``max_rows`` labelled texts of each label, chosen by a hash of the id."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & use)
    known = known.groupBy(F.col(id_col).alias("i")).agg(F.max(label_col).cast("int").alias("y"))
    order = F.xxhash64("i")
    chosen = None
    for value in (0, 1):
        part = known.where(F.col("y") == value).orderBy(order, "i").limit(max_rows)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).join(F.broadcast(chosen), "i")  # 2 * max_rows ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.chunks(batch, "t"):
                found, first = features(*tx.texts(part.column("t")))
                packed = [np.unique(found[a:b]).tobytes() for a, b in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays([part.column("i"), part.column("y"), pa.array(packed, pa.binary())], ["i", "y", "f"])

    ids = texts.schema["i"].dataType.simpleString()
    got = texts.select("i", "y", "t").mapInArrow(run, f"i {ids}, y int, f binary").dropDuplicates(["i"])
    rows = sorted((r for r in got.toLocalIterator()), key=lambda r: str(r["i"]))
    return [(np.frombuffer(bytes(r["f"]), np.uint64), r["y"]) for r in rows]


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    held_out: Column,
    label_col: str = "toxic",
    max_rows: int = 4000,
    id_col: str = "doc_id",
    text_col: str = "text",
    terms: Sequence[Sequence[str]] = IDENTITY_TERMS,
    penalty: float = 1.0,
) -> DataFrame:
    """One row per input row: id, held_out, score (0 to 1), predicted (1 if score >= 0.5).

    ``held_out`` is a condition on the id; labels of held-out ids are not read.
    The classifier learns from at most ``max_rows`` labelled texts of each
    label; every whole text is scored.  Null and empty texts get the score of
    no features, null ids are scored but never learnt from (and not held out),
    an id with several labels counts as toxic if any says so, of several texts
    of one id one is learnt from.  Without labels of both kinds the score is
    constant.  Other columns are ignored.
    """
    held = F.coalesce(held_out, F.lit(False))
    model = train(labelled_sample(docs, labels, ~held, label_col, max_rows, id_col, text_col), terms, penalty=penalty)
    ids = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.chunks(batch, "t"):
                score = model.score(*tx.texts(part.column("t")))
                yield pa.RecordBatch.from_arrays([part.column("i"), part.column("h"), pa.array(score, pa.float64())], ["i", "h", "score"])

    rows = docs.select(F.col(id_col).alias("i"), held.alias("h"), F.col(text_col).alias("t"))
    scored = rows.mapInArrow(run, f"i {ids}, h boolean, score double")
    return scored.select(
        F.col("i").alias(id_col), F.col("h").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def drop_toxic(
    docs: DataFrame,
    labels: DataFrame,
    held_out: Column,
    threshold: float = 0.5,
    label_col: str = "toxic",
    max_rows: int = 4000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``, all columns kept; each row is judged by its own text."""
    held = F.coalesce(held_out, F.lit(False))
    model = train(labelled_sample(docs, labels, ~held, label_col, max_rows, id_col, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.chunks(batch, text_col):
                score = model.score(*tx.texts(part.column(text_col)))
                yield part.filter(pa.array(score < threshold))

    return docs.mapInArrow(run, docs.schema)
