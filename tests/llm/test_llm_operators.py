"""The training-data operators against brute force, planted cases and edge inputs."""

import math
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakepipe.llm import cross_polytope, kneser_ney, mixing, ngram_join, pii, quality, secret_scan, tiling, token_counts, toxicity
from lakepipe.llm import text as tx
from lakepipe.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, i string, t string, v int, score double"
EDGE = [
    (1, None, None, None, None, "x", "y", 1, 0.5),
    (2, "", "en", "a", 0, None, None, None, None),
    (None, "null id row with a few words", "en", None, 1, "x", "y", 1, 0.5),
    (3, "word " * 30000, "en", "a", 1, "x", "y", 1, 0.5),
    (4, "same text twice here now", "en", "b", 1, "x", "y", 1, 0.5),
    (4, "same text twice here now", "en", "b", 1, "x", "y", 1, 0.5),
    (5, "same text twice here now", "en", "b", 1, "x", "y", 1, 0.5),
    (6, "é" * 5000, "fr", "b", 1, "x", "y", 1, 0.5),
]


def words(t):
    return re.findall(r"[^\x20\x09-\x0d]+", re.sub(r"[A-Z]", lambda m: m[0].lower(), t or ""))


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def operators(spark, d):
    labels = labels_of(spark, [(4, 1, 0), (3, 0, 1), (None, 1, 1)])
    bench = spark.createDataFrame([(1, "same text twice here now"), (2, None), (3, "")], "item_id long, text string")
    return {
        "quality": quality.quality_scores(d),
        "lm": kneser_ney.lm_scores(d, F.col("doc_id") % 2 == 0),
        "secrets": secret_scan.secret_findings(d, secret_scan.train(d)),
        "redacted": secret_scan.redact_secrets(d, secret_scan.train(d)),
        "pii": pii.personal_data(d),
        "toxicity": toxicity.toxicity_scores(d, labels, F.col("doc_id") == 99),
        "nontoxic": toxicity.drop_toxic(d, labels, F.col("doc_id") == 99),
        "tiling": tiling.contaminated(d, bench),
        "clean": tiling.decontaminate(d, bench),
        "join": ngram_join.jaccard_components(d),
        "dedup": ngram_join.drop_near_duplicates(d),
        "mix": mixing.mix_sources(d),
        "tokens": token_counts.token_counts(d, public_tokenizers.path("word_bpe_49k.json")),
        "links": ngram_join.jaccard_links(d),
        "link_counts": ngram_join.link_counts(d),
    }


def test_edge_rows(spark, edge):
    got = {k: v.collect() for k, v in operators(spark, edge).items()}
    for k in ("quality", "lm", "redacted", "pii", "toxicity", "join", "mix", "tokens", "link_counts"):
        assert len(got[k]) == len(EDGE), k
    assert {(r.doc_id, r.item_id) for r in got["tiling"]} == {(4, 1), (5, 1)} and len(got["tiling"]) == 3
    assert sorted(r.doc_id or 0 for r in got["clean"]) == [0, 1, 2, 3, 6]
    assert {r.doc_id: r.component_id for r in got["join"]} == {None: None, 1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6}
    assert sorted(r.doc_id or 0 for r in got["dedup"]) == [0, 1, 2, 3, 4, 6]
    assert [r.n_tokens for r in got["lm"] if r.doc_id in (1, 2)] == [1, 1]
    assert all(r.taken <= 2 * r.size for r in got["mix"])
    tokens = [(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got["tokens"]]
    assert (1, 0, 0, False) in tokens and (2, 0, 0, False) in tokens and tokens.count((4, 24, 5, False)) == 2
    assert [(b, n > 2048, over) for i, b, n, over in tokens if i in (3, 6)] == [(150_000, True, True), (10_000, True, True)]


def test_empty_table(spark, edge):
    for k, v in operators(spark, edge.where("false")).items():
        assert v.collect() == [], k


def test_word_hashes_are_words(texts):
    raw = [t or "" for t in texts.values()]
    h, first = tx.word_hashes(*tx.texts(pa.array(raw)))
    flat = [w for t in raw for w in words(t)]
    assert len(h) == len(flat) == first[-1]
    assert len(set(zip(flat, h.tolist()))) == len(set(flat)) == len(set(h.tolist()))


def test_language_model(spark, docs, texts):
    got = {r.doc_id: r for r in QUERIES["op2_kneser_ney"](spark, SF).collect()}
    held = {r.doc_id: r.h for r in docs.select("doc_id", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2).alias("h")).collect()}
    count = {}
    for i, t in texts.items():
        if not held[i]:
            for w in [*words(t), "\n"]:
                count[w] = count.get(w, 0) + 1
    n, v = sum(count.values()), len(count)
    for i, t in texts.items():
        seq = [*words(t), "\n"]
        assert (got[i].n_tokens, got[i].n_known) == (len(seq), sum(w in count for w in seq))
        assert got[i].train_tokens == n and got[i].held_out == held[i]
        assert math.isclose(got[i].base_score, sum(math.log10((count.get(w, 0) + 1) / (n + v + 1)) for w in seq), rel_tol=1e-9)
    outside = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in outside) > sum(r.base_score for r in outside)


def test_language_model_sums_to_one(spark):
    d = spark.createDataFrame([(1, "a b a c a b d"), (2, "b a b c"), (3, "a b b a e f a b")], "doc_id long, text string")
    model = kneser_ney.train(d)
    vocabulary = sorted({w for r in d.collect() for w in r.text.split()})
    h, _ = tx.word_hashes(*tx.texts(pa.array([" ".join(vocabulary + ["unseen"])])))
    w = np.append(h, kneser_ney.END)
    for v in [kneser_ney.BEGIN, *(h & kneser_ney._PREVIOUS)]:
        p, _ = model.probabilities(np.full(len(w), v), w)
        assert (p > 0).all() and math.isclose(p.sum(), 1, rel_tol=1e-9)


def test_token_counts(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in QUERIES["op8_token_counts"](spark, SF).collect():
        raw = texts[r.doc_id] or ""
        n = len(t.encode(raw, add_special_tokens=False))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(raw.encode()), n, n > 2048)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_spliced_counts_are_those_of_the_whole(texts, name):
    import public_tokenizers

    tokenizer = token_counts.load(public_tokenizers.path(name))
    long = " ".join(t for t in list(texts.values())[:40] if t) + " <|endoftext|> it's 12.5 " + "x" * 700 + " tail"
    for chunk, overlap in ((500, 64), (2000, 16), (4096, 300)):
        assert token_counts.count_long(tokenizer, long, chunk, overlap) == tokenizer.counts([long])[0]


def test_tiling_finds_reordered_and_leaves_fragments():
    w = np.arange(100, 140, dtype=np.uint64)
    other = np.arange(1000, 1100, dtype=np.uint64)
    text = np.concatenate([other[:30], w[20:], other[30:40], w[:20], other[40:]])
    assert sorted(n for _, _, n in tiling.tiles(text, w, 5)) == [20, 20]
    assert tiling.tiles(np.concatenate([other, w[:4]]), w, 5) == []
    found = tiling.tiles(np.concatenate([w[:10], w[:10]]), np.concatenate([w[:10], w[20:30]]), 5)
    assert [n for _, _, n in found] == [10]


def test_contaminated_tiles_the_whole_text(spark):
    item = [f"i{k}" for k in range(37)]
    far = [" ".join(f"o{n}x{k}" for k in range(n)) for n in (45, 300, 60)]
    parts = [" ".join(item[a:b]) for a, b in ((25, 37), (0, 13), (13, 25))]
    apart = " ".join(x for pair in zip(far, parts) for x in pair)
    short = " ".join([far[0], *item[:13], far[1]])
    bench = spark.createDataFrame([(1, " ".join(item)), (2, "only three words"), (3, "here there")], "item_id long, text string")
    d = spark.createDataFrame([(1, apart), (2, short), (3, f"{far[0]} only three words {far[1]}"), (4, "only three here words")], "doc_id long, text string")
    assert {(r.doc_id, r.item_id, r.covered) for r in tiling.contaminated(d, bench).collect()} == {(1, 1, 37), (3, 2, 3)}
    assert sorted(r.doc_id for r in tiling.decontaminate(d, bench).collect()) == [2, 4]


def test_tiling_of_one_word_repeated():
    w = np.full(30000, 7, np.uint64)
    assert tiling.covered_words(w, np.arange(30000 - 4), w[:37], 5) == 37


def test_contaminated_against_plain_search(spark, texts):
    bench = {r.item_id: words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op7_string_tiling"](spark, SF).collect()}
    whole = {(i, k) for i, t in texts.items() for k, b in bench.items() if f" {' '.join(b)} " in f" {' '.join(words(t))} "}
    assert whole <= got
    for i, k in got:
        seeds = {tuple(bench[k][j : j + 5]) for j in range(len(bench[k]) - 4)}
        w = words(texts[i])
        assert sum(tuple(w[j : j + 5]) in seeds for j in range(len(w) - 4)) * 3 >= len(seeds)


@pytest.mark.parametrize("n,num,den", [(3, 90, 100), (5, 4, 5), (1, 1, 2)])
def test_jaccard_components(spark, docs, texts, n, num, den):
    more = [(10_000 + k, " ".join(f"w{j if j % 17 else j * (k % 7 + 1)}" for j in range(60))) for k in range(30)]
    extra = spark.createDataFrame(more, "doc_id long, text string")
    d = docs.select("doc_id", "text").unionByName(extra)
    sets = {}
    for i, t in [*texts.items(), *more]:
        w = words(t)
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((root(a), root(b)))
                    up[y] = x
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(d, n, (num, den)).collect()}
    assert got == {i: (len(s), root(i)) for i, s in sets.items()}


def test_jaccard_links_inside_components(spark, edge, monkeypatch):
    monkeypatch.setattr(ngram_join, "_SALT", 4)  # several blocks of a column
    texts = {k: " ".join(f"w{j if j != 2 * k else f'x{k}'}" for j in range(60)) for k in range(14)}
    texts |= {100: texts[2], 101: texts[2], 102: texts[5], 200: "another text of its own here", 201: "", 202: None}
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    sets = {i: {tuple(words(t)[k : k + 3]) for k in range(len(words(t)) - 2)} for i, t in texts.items()}
    like = lambda a, b: bool(sets[a]) and bool(sets[b]) and 100 * len(sets[a] & sets[b]) >= 83 * len(sets[a] | sets[b])
    want = {(a, b) for a in range(14) for b in range(a + 1, 14) if like(a, b)}
    got = [(*sorted((r.id_a, r.id_b)), {r.id_a: r.rows_a, r.id_b: r.rows_b}) for r in ngram_join.jaccard_links(d, 3, (83, 100)).collect()]
    assert len(got) == len(want) > 13 and {(a, b) for a, b, _ in got} == want
    assert all(n == {2: 3, 5: 2}.get(i, 1) for *_, rows in got for i, n in rows.items())
    counts = {r.doc_id: r.n_links for r in ngram_join.link_counts(d, 3, (83, 100)).collect()}
    assert counts == {a: sum(like(a, b) for b in texts if b != a) for a in texts}
    assert sorted((r.doc_id or 0, r.n_links) for r in ngram_join.link_counts(edge).collect()) == [(0, 0), (1, 0), (2, 0), (3, 0), (4, 2), (4, 2), (5, 2), (6, 0)]


def test_mixing_meets_targets(spark, texts):
    rows = QUERIES["op10_mixing"](spark, SF).collect()
    again = QUERIES["op10_mixing"](spark, SF).collect()
    assert sorted(rows) == sorted(again)
    by = {}
    for r in rows:
        assert r.size == len(words(texts[r.doc_id])) and 0 <= r.taken <= 2 * r.size
        by.setdefault(r.source, []).append(r)
    size = {s: sum(r.size for r in x) for s, x in by.items()}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(size))}
    target, budget, free = {}, 1.5 * sum(size.values()), set(size)
    while True:
        fair = {s: (budget - sum(target.values())) * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if fair[s] > 2 * size[s]]
        if not over:
            break
        for s in over:
            target[s] = 2.0 * size[s]
            free.discard(s)
    target |= fair
    for s, x in by.items():
        assert math.isclose(x[0].target, target[s], rel_tol=1e-12) and x[0].source_size == size[s]
        assert abs(sum(r.taken for r in x) - target[s]) <= 2


def test_personal_data_base_spans(spark, texts):
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    tricky = "a@b@c.d_y@e.f 1.2.3.4.5.6.7.8 300.1.1.1 0001.2.3.4 4111 1111 1111 1111 é +1 (202) 555-0100 x@y 4111-1111-1111-1112 +12"
    rows = [(i, t) for i, t in texts.items()] + [(-1, tricky), (-2, "9" * 30000), (-3, "a" * 30000 + "@b.cc"), (-4, "1.1.1.1" + ".1" * 9000)]

    def fine(kind, m):
        d = re.sub("[^0-9]", "", m)
        if kind == "ip":
            return all(int(p) <= 255 for p in m.split("."))
        if kind == "card":
            doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(d))]
            return 12 <= len(d) <= 19 and sum(x - 9 * (x > 9) for x in doubled) % 10 == 0
        return kind != "phone" or 9 <= len(d) <= 15

    got = {r.doc_id: r for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        want = [(m.start(), k, f"{n}:{m.start()}:{m.end()}") for k, (n, p) in enumerate(plain.items()) for m in re.finditer(p, t or "") if fine(n, m[0])]
        kept = [s for s in got[i].spans.split(",") if s.split(":")[0] in plain]
        assert kept == [s for _, _, s in sorted(want)], i
        assert got[i].n_email == sum(k == 0 for _, k, _ in want)


def test_toxicity_held_out_accuracy(spark):
    path = "/root/testdata/sf0.01"
    got = QUERIES["op6_toxicity"](spark, path).join(spark.read.parquet(f"{path}/labels.parquet"), "doc_id").where("held_out")
    right = got.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("double"))).first()[0]
    assert right >= 0.95


def test_toxicity_learns_from_4000_texts_of_each_label(spark, monkeypatch):
    d = spark.range(8300).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    labels = d.select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") % 2).cast("int").alias("toxic"))
    learnt, train = [], toxicity.train

    def seen(rows, *args, **kw):
        learnt.append([sum(y == v for _, y in rows) for v in (0, 1)])
        return train(rows[:20], *args, **kw)

    monkeypatch.setattr(toxicity, "train", seen)
    toxicity.toxicity_scores(d, labels, F.lit(False))
    toxicity.drop_toxic(d, labels, F.lit(False))
    assert learnt == [[4000, 4000], [4000, 4000]]


def test_counterfactual_penalty_lowers_the_change():
    def feats(t):
        raw = np.frombuffer(t.encode(), np.uint8)
        return np.unique(toxicity.features(raw, np.array([0, len(raw)]))[0])

    rows = [(feats(f"the women are idiots {k}"), 1) for k in range(20)] + [(feats(f"the men walk home {k}"), 0) for k in range(20)]
    swap = []
    for penalty in (0.0, 50.0):
        m = toxicity.train(rows, penalty=penalty)
        a, b = (m.score(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in (b"women walk", b"men walk"))
        swap.append(abs(a - b))
    assert swap[1] < 0.2 * swap[0]


def test_quality_agrees_with_labels(spark):
    path = "/root/testdata/sf0.01"
    got = QUERIES["op1_weak_quality"](spark, path).join(spark.read.parquet(f"{path}/labels.parquet"), "doc_id").collect()
    assert np.mean([r.keep == (r.quality == 1) for r in got]) >= 0.9


def test_secret_forest_on_unseen_texts(spark):
    path = "/root/testdata/sf0.01"
    d = spark.read.parquet(f"{path}/documents.parquet")
    scanner = secret_scan.train(d.where("doc_id % 2 = 0"))
    other = {r.doc_id: (r.text.encode(), r.source.encode()) for r in d.where("doc_id % 2 = 1").collect()}
    got = secret_scan.secret_findings(d.where("doc_id % 2 = 1"), scanner).collect()
    right = [r.is_secret == bool(secret_scan.rule_label(other[r.doc_id][0], (r.start, r.end), other[r.doc_id][1])) for r in got]
    assert len(got) > 20 and np.mean(right) >= 0.97


def test_secret_candidates_without_digits_and_of_any_length(spark):
    rng = np.random.default_rng(1)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    key = lambda n=24: "a" + "".join(rng.choice(letters, n - 2)) + "Z"
    rows = [(k, f"the client sets password = {key()} and goes on", "s") for k in range(60)]
    rows += [(100 + k, f"see the Verfassungsgericht{'x' * (k % 5)} and some/path/inLowerCase there", "s") for k in range(60)]
    rows += [(200 + k, f"blob {key(90_000)}9 then token: {key(40)}/{'q' * 8000} end", "s") for k in range(4)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    scanner = secret_scan.train(d)
    got = {(r.doc_id, r.start, r.end): r.is_secret for r in secret_scan.secret_findings(d, scanner).collect()}
    assert {(k, 27, 51) for k in range(60)} <= set(got) and all(got[k, 27, 51] for k in range(60))
    assert not any(s for (i, _, _), s in got.items() if 100 <= i < 200)
    assert all({(200 + k, 5, 90_006), (200 + k, 90_019, 98_060)} <= set(got) for k in range(4))
    clean = {r.doc_id: r.text for r in secret_scan.redact_secrets(d, scanner).collect()}
    assert all(clean[k] == "the client sets password = [secret] and goes on" for k in range(60))
    raw = rows[-1][1].encode()
    whole = raw[5:90_006]
    x = dict(zip(secret_scan.FEATURES, secret_scan.describe(raw, (5, 90_006), b"", 0.0)))
    assert math.isclose(x["share_upper"], sum(chr(c).isupper() for c in whole) / len(whole))
    assert math.isclose(x["to_1_2"], sum(chr(a).islower() and chr(b).isupper() for a, b in zip(whole, whole[1:])) / (len(whole) - 1))


def test_secret_dictionary_counts_all_documents(spark):
    rows = [(k, f"far words zebra{'' if k % 2 else ' giraffe, zebra'} X{k} notAword quagga7 " + "fill " * 200 + f"key = a1b2c3d4e5f6{k:04d}") for k in range(8)]
    rows += [(100 + k, "twice here") for k in range(2)] + [(200, None), (201, "")]
    d = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, source string")
    in_texts = {}
    for _, t in rows:
        for w in set(re.findall(r"(?<![A-Za-z0-9])[a-z]{3,}(?![A-Za-z0-9])", t or "")):
            in_texts[w] = in_texts.get(w, 0) + 1
    want = sorted(w for w, n in in_texts.items() if n >= 3)
    assert want == ["far", "fill", "giraffe", "key", "words", "zebra"]
    hashes = tx.word_hashes(*tx.texts(pa.array([" ".join(want)])))[0]
    assert secret_scan.train(d).dictionary.words.tolist() == sorted(hashes.tolist())
    assert secret_scan.train(d, max_findings=1, max_texts=1).dictionary.words.tolist() == sorted(hashes.tolist())
    share = secret_scan.covered(b"/zebra/xxxxx Giraffe123", [(0, 12), (13, 23)], secret_scan.Dictionary(np.sort(hashes)))
    assert share.tolist() == [5 / 12, 0.7]
    # In files of any number it holds the same words, and the findings are the same.
    whole = {(r.doc_id, r.start, r.probability) for r in secret_scan.secret_findings(d, secret_scan.train(d)).collect()}
    asked = np.concatenate([hashes, hashes + np.uint64(1), np.arange(100, dtype=np.uint64)])
    for most in (1, 2, 5):
        scanner = secret_scan.train(d, max_words=most)
        assert scanner.dictionary.parts == -(-6 // most) and not len(scanner.dictionary.words)
        assert scanner.dictionary.known(asked).tolist() == [True] * 6 + [False] * 106
        assert {(r.doc_id, r.start, r.probability) for r in secret_scan.secret_findings(d, scanner).collect()} == whole


def test_nearest_recall(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    x, ids = np.array([r.embedding for r in e], float), np.array([r.vec_id for r in e])
    odd = [(9000, None), (9001, [0.0] * x.shape[1]), (9002, [float("nan")] * x.shape[1]), (9003, [None] * x.shape[1]), (9004, [])]
    rows = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)] + odd, "vec_id long, embedding array<double>")
    got = {}
    for r in cross_polytope.nearest(rows, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    hit = total = 0
    for k, i in enumerate(ids):
        if i % 20 == 0:
            s = (x * x[k]).sum(1)
            s[k] = -np.inf
            best = ids[np.lexsort((ids, -s))[:20]]
            hit += len(set(best.tolist()) & {v for v, _ in got[i]})
            total += 20
            assert all(math.isclose(v, float((x[ids == j] * x[k]).sum()), rel_tol=1e-12) for j, v in got[i])
    assert hit / total >= 0.9
    assert not set(got) & {9000} and len(got) == total // 20


def test_pipeline_stages(spark, texts):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "benchmark_decontamination", "secret_scan", "source_mixing"]
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in out} < set(texts) and len(out) > 0.6 * len(texts)
