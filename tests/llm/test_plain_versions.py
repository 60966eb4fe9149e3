"""Operators against plain versions: Kneser-Ney scores, greedy tiling, what the identity penalty does on the given labels."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakepipe.llm import kneser_ney, tiling, toxicity
from lakepipe.llm import text as tx
from lakepipe.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SF_LABELS = "/root/testdata/sf0.01"


def words(t):
    return re.findall(r"[^\x20\x09-\x0d]+", re.sub(r"[A-Z]", lambda m: m[0].lower(), t or ""))


def plain_kneser_ney(train, texts):
    """log10 probabilities by the formula, over dictionaries."""
    pairs = Counter()
    for t in train:
        w = [None, *words(t), ""]  # a begin before, an end after
        pairs.update(zip(w, w[1:]))
    seen, context, follows = Counter(), defaultdict(Counter), Counter()
    for (v, w), c in pairs.items():
        seen[v] += c
        context[v][min(c, 3)] += 1
        follows[w] += 1
    of_counts = lambda values: [sum(c == k for c in values) for k in range(1, 5)]
    d_pair = (0.0, *kneser_ney.discounts(of_counts(pairs.values())))
    d_word = (0.0, *kneser_ney.discounts(of_counts(follows.values())))
    left = sum(d_word[min(c, 3)] for c in follows.values()) / len(pairs)

    def p(v, w):
        lower = max(follows[w] - d_word[min(follows[w], 3)], 0) / len(pairs) + left / (len(follows) + 1)
        if not seen[v]:
            return lower
        c = pairs[v, w]
        gamma = sum(n * d_pair[k] for k, n in context[v].items()) / seen[v]
        return max(c - d_pair[min(c, 3)], 0) / seen[v] + gamma * lower

    out = []
    for t in texts:
        w = [None, *words(t), ""]
        out.append(sum(math.log10(p(a, b)) for a, b in zip(w, w[1:])))
    return out


def test_language_model_scores(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    rows = docs.select("doc_id", "text", held.alias("held")).collect()
    want = plain_kneser_ney([r.text for r in rows if not r.held], [r.text for r in rows])
    got = {r.doc_id: r.score for r in QUERIES["op2_kneser_ney"](spark, SF).collect()}
    assert len(got) == len(rows)
    for r, s in zip(rows, want):
        assert math.isclose(got[r.doc_id], s, rel_tol=1e-6), r.doc_id


def plain_tiles(text, item, least):
    """Greedy string tiling by trying every pair of positions."""
    free_t, free_i, total = [True] * len(text), [True] * len(item), 0
    while True:
        best = (0, 0, 0)
        for s in range(len(text)):
            for j in range(len(item)):
                n = 0
                while s + n < len(text) and j + n < len(item) and text[s + n] == item[j + n] and free_t[s + n] and free_i[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, s, j)
        n, s, j = best
        if n < least:
            return total
        free_t[s : s + n] = [False] * n
        free_i[j : j + n] = [False] * n
        total += n


@pytest.mark.parametrize("seed", range(8))
def test_tiling_covers_what_plain_tiling_does(spark, seed):
    rng = random.Random(seed)
    item = [rng.choice("abcdefgh") if seed % 2 else f"w{k}" for k in range(40)]
    pieces = [item[a : a + rng.randint(3, 14)] for a in (rng.randrange(30) for _ in range(6))]
    text = [x for piece in pieces for x in [*piece, *(f"o{rng.randrange(99)}" for _ in range(rng.randint(0, 4)))]]
    code = {x: k + 1 for k, x in enumerate({*item, *text})}
    t, i = (np.array([code[x] for x in s], np.uint64) for s in (text, item))
    assert sum(n for _, _, n in tiling.tiles(t, i, 3)) == plain_tiles(text, item, 3)


def test_identity_penalty_on_the_given_labels(spark):
    """How far held-out scores move when an identity term is swapped, without the penalty and at its default."""
    docs, labels = (spark.read.parquet(f"{SF_LABELS}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    sample = toxicity.labelled_sample(docs, labels, ~held, "toxic", 4000, "doc_id", "text")
    texts = [r.text for r in docs.where(held & F.col("text").isNotNull()).select("text").collect()][:150]
    groups = [g for g in toxicity.IDENTITY_TERMS if len(g) > 1]

    def score(model, said):
        import pyarrow as pa

        return model.score(*tx.texts(pa.array(said, pa.string())))

    moved = {}
    for penalty in (0.0, 1.0):
        model = toxicity.train(sample, penalty=penalty)
        gaps = []
        for g in groups:
            gaps.append(np.abs(score(model, [f"{t} {g[0]}" for t in texts]) - score(model, [f"{t} {g[1]}" for t in texts])))
        moved[penalty] = float(np.mean(gaps))
    assert moved[1.0] <= moved[0.0] + 1e-9 and moved[1.0] < 0.02
