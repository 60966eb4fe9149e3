"""Secret scan with a random forest that removes false positives.

Candidates are runs of key-like characters.  A forest, trained from labelled
findings, decides on each by its length, the transitions between its kinds of
characters, how much of it a dictionary covers, the path it was found under and
the words next to it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakepipe.llm import text as tx
from lakepipe.llm.kneser_ney import _mapped, _save
from lakepipe.session import scratch_path

CANDIDATE = re.compile(rb"[A-Za-z0-9_\-+/=.~]{12,}")
_DIGITS, _LOWERS, _UPPERS = re.compile(rb"[0-9]"), re.compile(rb"[a-z]"), re.compile(rb"[A-Z]")
_KEYWORDS = (b"password", b"passwd", b"pwd", b"secret", b"token", b"api", b"key", b"auth", b"bearer", b"credential", b"private")
_HARMLESS = (b"example", b"sample", b"dummy", b"test", b"fake", b"placeholder", b"changeme", b"xxxx")
_AROUND = 32  # bytes looked at on either side
_SLICE = 1 << 16
_DIGIT, _LOWER, _UPPER, _OTHER = range(4)
_KIND = np.full(256, _OTHER, np.int64)
_KIND[48:58], _KIND[97:123], _KIND[65:91] = _DIGIT, _LOWER, _UPPER

FEATURES = (
    ["length", "distinct", "entropy", "changes"]
    + [f"share_{k}" for k in ("digit", "lower", "upper", "other")]
    + [f"to_{a}_{b}" for a in range(4) for b in range(4)]
    + ["hex", "dictionary", "assigned", "quoted", "keyword", "keyword_distance", "harmless", "path_length", "path_harmless"]
)


def spans(raw: bytes) -> list[tuple[int, int]]:
    """Candidates: runs of any length with a digit, or with both cases; what stands before the first ``=`` is a name, not a value."""
    out = []
    for m in CANDIDATE.finditer(raw):
        a, b = m.span()
        head = raw.find(b"=", a, b - 1)
        if head >= 0 and raw[a:head].isalpha():
            a = head + 1
        while b > a and raw[b - 1] in b".-=":
            b -= 1
        if b - a >= 12 and (_DIGITS.search(raw, a, b) or _LOWERS.search(raw, a, b) and _UPPERS.search(raw, a, b)):
            out.append((a, b))
    return out


@dataclass
class Dictionary:
    """Sorted hashes of words: an array that goes with the tasks, or for larger ones sorted files that they map.

    Which of the two holds a word decides nothing: every word is found.
    """

    words: np.ndarray
    root: str = ""
    parts: int = 0
    _open: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_open": {}}

    def known(self, h: np.ndarray) -> np.ndarray:
        """Whether each hash is in it."""
        out = np.zeros(len(h), bool)
        place = h % np.uint64(max(1, self.parts))
        for p in np.unique(place).tolist() if len(h) else []:
            if p not in self._open:
                self._open[p] = _mapped(self.root, f"words-{p}").view("<u8") if self.parts else self.words
            words, at = self._open[p], place == p
            if len(words):
                out[at] = words[np.minimum(np.searchsorted(words, h[at]), len(words) - 1)] == h[at]
        return out


def covered(raw: bytes, spans: Sequence[tuple[int, int]], dictionary: Dictionary) -> np.ndarray:
    """Share of each span that words of the dictionary cover."""
    size = np.array([b - a for a, b in spans], np.int64)
    off = np.concatenate([[0], np.cumsum(size)])
    data = np.frombuffer(b"".join(raw[a:b] for a, b in spans).lower(), np.uint8)
    starts, ends, _ = tx.word_bounds(data, off, _KIND == _LOWER)
    long = ends - starts >= 3
    starts, ends = starts[long], ends[long]
    out = np.zeros(len(size))
    known = dictionary.known(tx.span_hashes(data, starts, ends))
    np.add.at(out, np.searchsorted(off, starts[known], side="right") - 1, (ends - starts)[known])
    return out / size


def document_words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-case words of some texts, and in how many of them each occurs."""
    starts, ends, first = tx.word_bounds(data, off, _KIND != _OTHER)
    lower = np.concatenate([[0], np.cumsum(_KIND[data] == _LOWER)])
    word = (ends - starts >= 3) & (lower[ends] - lower[starts] == ends - starts)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))[word]
    h = tx.span_hashes(data, starts[word], ends[word])
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    return np.unique(h[new], return_counts=True)


def describe(raw: bytes, span: tuple[int, int], path: bytes, covered: float) -> list[float]:
    a, b = span
    found = raw[a:b]
    n = len(found)
    share, moves, changes = np.zeros(4), np.zeros(16), 0
    for at in range(0, n, _SLICE):  # a long run is counted in slices that share a byte
        kind = _KIND[np.frombuffer(found[at : at + _SLICE + 1], np.uint8)]
        share += np.bincount(kind[:_SLICE], minlength=4)
        moves += np.bincount(kind[:-1] * 4 + kind[1:], minlength=16)
        changes += np.count_nonzero(kind[1:] != kind[:-1])
    share, moves = share / n, moves / max(1, n - 1)
    counts = np.array(list(Counter(found).values()), float) / n
    before, after = raw[max(0, a - _AROUND) : a].lower(), raw[b : b + _AROUND].lower()
    at = max((before.rfind(k) + len(k) for k in _KEYWORDS if k in before), default=-1)
    return [
        float(n),
        len(counts) / n,
        float(-(counts * np.log2(counts)).sum()),
        changes / max(1, n - 1),
        *share.tolist(),
        *moves.tolist(),
        float(re.fullmatch(rb"[0-9a-fA-F]+", found) is not None),
        covered,
        float(before.rstrip(b" \"'")[-1:] in (b"=", b":")),
        float(before[-1:] in (b'"', b"'", b"`") and after[:1] == before[-1:]),
        float(at >= 0),
        float(len(before) - at if at >= 0 else _AROUND),
        float(any(h in before or h in after or h in found.lower() for h in _HARMLESS)),
        float(min(len(path), 255)),
        float(any(h in path for h in _HARMLESS)),
    ]


class Forest:
    """Random forest of classification trees, kept as flat arrays."""

    def __init__(self, trees: list[tuple[np.ndarray, ...]]):
        self.trees = trees

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 8, leaf: int = 2, seed: int = 0) -> Forest:
        rng = np.random.default_rng(seed)
        out = []
        for _ in range(trees):
            nodes: list[list] = []
            cls._grow(nodes, x, y, rng.integers(0, len(y), len(y)), depth, leaf, rng)
            out.append(tuple(np.array(c) for c in zip(*nodes)))
        return cls(out)

    @classmethod
    def _grow(cls, nodes: list, x, y, rows, depth, leaf, rng) -> int:
        me = len(nodes)
        p = float(y[rows].mean())
        nodes.append([-1, 0.0, -1, -1, p])
        if depth == 0 or len(rows) < 2 * leaf or p in (0.0, 1.0):
            return me
        best = None
        for f in rng.choice(x.shape[1], max(1, int(np.sqrt(x.shape[1]))), replace=False):
            order = rows[np.argsort(x[rows, f], kind="stable")]
            v, ones = x[order, f], np.cumsum(y[order])
            left = np.arange(1, len(order))
            right = len(order) - left
            a, b = ones[:-1] / left, (ones[-1] - ones[:-1]) / right
            gini = left * a * (1 - a) + right * b * (1 - b)
            gini[(v[1:] == v[:-1]) | (left < leaf) | (right < leaf)] = np.inf
            i = int(np.argmin(gini))
            if np.isfinite(gini[i]) and (best is None or gini[i] < best[0]):
                best = (gini[i], int(f), float((v[i] + v[i + 1]) / 2))
        if best is None:
            return me
        _, f, cut = best
        low = x[rows, f] <= cut
        nodes[me][:2] = f, cut
        nodes[me][2] = cls._grow(nodes, x, y, rows[low], depth - 1, leaf, rng)
        nodes[me][3] = cls._grow(nodes, x, y, rows[~low], depth - 1, leaf, rng)
        return me

    def predict(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for feature, cut, left, right, p in self.trees:
            at = np.zeros(len(x), np.int64)
            while True:
                inner = np.flatnonzero(feature[at] >= 0)
                if not len(inner):
                    break
                node = at[inner]
                at[inner] = np.where(x[inner, feature[node]] <= cut[node], left[node], right[node])
            total += p[at]
        return total / max(1, len(self.trees))


# Labelled findings: known shapes of issued keys, and values that are assigned to a secret's name.
_ISSUED = re.compile(rb"(AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abp]-[A-Za-z0-9-]{20,}|sk-[A-Za-z0-9]{20,}")
_ASSIGNED = re.compile(rb"(?i)(password|passwd|pwd|secret|token|api_?key|auth)[\"']?\s*[=:]\s*[\"'`]?$")
# Mixed: a letter and a digit, or an upper case letter after a lower case one (a capitalised word is none).
_VALUE = re.compile(rb"(?:(?=.*[0-9])(?=.*[A-Za-z])|(?=[^a-z]*[a-z][^A-Z]*[A-Z]))[A-Za-z0-9_\-+/=.~]{14,}")


def rule_label(raw: bytes, span: tuple[int, int], path: bytes) -> int:
    """1 for an issued key's shape or a mixed value assigned to a secret's name, unless the place calls itself an example."""
    a, b = span
    before, found = raw[max(0, a - _AROUND) : a], raw[a:b]
    if any(h in before.lower() or h in found.lower() or h in path for h in _HARMLESS):
        return 0
    return int(bool(_ISSUED.fullmatch(found)) or bool(_ASSIGNED.search(before)) and bool(_VALUE.fullmatch(found)))


class Scanner:
    """Candidates of a text and the forest's probability for each."""

    def __init__(self, forest: Forest, dictionary: Dictionary):
        self.forest, self.dictionary = forest, dictionary

    def scan(self, raws: Sequence[bytes], paths: Sequence[bytes]) -> list[list[tuple[int, int, float]]]:
        found = [spans(r) for r in raws]
        rows = [describe(r, s, p.lower(), c) for r, p, ss in zip(raws, paths, found) if ss for s, c in zip(ss, covered(r, ss, self.dictionary).tolist())]
        if not rows:
            return [[] for _ in raws]
        p = iter(self.forest.predict(np.array(rows)).tolist())
        return [[(a, b, next(p)) for a, b in ss] for ss in found]


def _raws(part: pa.RecordBatch) -> list[bytes]:
    data, off = tx.texts(part.column("t"))
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(off[:-1].tolist(), off[1:].tolist())]


def train(
    docs: DataFrame,
    label: Callable[[bytes, tuple[int, int], bytes], int] = rule_label,
    max_texts: int = 6000,
    max_findings: int = 20000,
    max_words: int = 1 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    path_col: str = "source",
) -> Scanner:
    """A scanner trained from the findings in at most ``max_texts`` texts with candidates, labelled by ``label``.

    The dictionary is that of all documents: the lower-case words that occur
    in three or more of them, as sorted hashes.  Up to ``max_words`` of them go
    with the tasks; a larger dictionary is written to the shared checkpoint
    folder as sorted files of about ``max_words`` each, which tasks map, so its
    size is not bounded.  For the forest, texts are chosen by a hash; each gives the features
    of at most 20 findings, so the sample is bounded.  All findings are counted
    with the words; the count sets the hash value below which about twice the
    sample lies, and only texts below it send findings to the driver, however
    many tasks there are.
    """
    rows = docs.select(F.col(text_col).alias("t"), F.coalesce(F.col(path_col).cast("string"), F.lit("")).alias("p"), F.xxhash64(id_col, F.substring(text_col, 1, 200)).alias("h"))
    rows = rows.where(F.length("t") > 0)
    bound = min(max_findings, 20 * max_texts)
    dictionary, total = _dictionary(rows, max_words)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.chunks(batch, "t"):
                out = []
                for h, p, raw in zip(part.column("h").to_pylist(), part.column("p").to_pylist(), _raws(part)):
                    if some := spans(raw)[:20]:
                        path = p.encode().lower()
                        for s, c in zip(some, covered(raw, some, dictionary).tolist()):
                            out.append((h, *s, np.array(describe(raw, s, path, c)).tobytes(), label(raw, s, path)))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32()))],
                        ["h", "a", "b", "x", "y"],
                    )

    if total > 2 * bound:
        rows = rows.where(F.col("h") < int(-(2**63) + 2**64 * (2 * bound / total)))
    found = rows.mapInArrow(sample, "h long, a long, b long, x binary, y int")
    got = found.orderBy("h", "a", "b", "x", "y").limit(bound).collect()
    x = np.array([np.frombuffer(bytes(r["x"])) for r in got])
    forest = Forest.fit(x, np.array([r["y"] for r in got], float)) if got else Forest([])
    return Scanner(forest, dictionary)


def _dictionary(rows: DataFrame, max_words: int) -> tuple[Dictionary, int]:
    """The words in three or more texts, and the number of candidates in all texts."""
    spark = rows.sparkSession

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.chunks(batch, "t"):
                h, n = document_words(*tx.texts(part.column("t")))
                found = sum(len(spans(raw)[:20]) for raw in _raws(part))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.append(h.view(np.int64), 0), mask=np.arange(len(h) + 1) == len(h)), pa.array(np.append(n, found).astype(np.int64))], ["w", "n"]
                )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.column("w").to_numpy().tobytes()], pa.binary())], ["w"])

    path = scratch_path(spark, "secret-scan")
    # The row without a word counts the candidates.
    counts = rows.select("t").mapInArrow(count, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))
    counts.where("w is null or n >= 3").write.parquet(f"{path}/words")
    counts = spark.read.parquet(f"{path}/words")
    size = counts.agg(F.count("w").alias("words"), F.sum(F.when(F.col("w").isNull(), F.col("n"))).alias("found")).first()
    words, total = counts.where("w is not null").select("w"), size["found"] or 0
    if size["words"] <= max_words:
        packed = words.mapInArrow(pack, "w binary").collect()
        flat = [np.frombuffer(bytes(r["w"]), np.uint64) for r in packed]
        return Dictionary(np.sort(np.concatenate(flat)) if flat else np.zeros(0, np.uint64)), total
    parts, root = -(-size["words"] // max_words), path.replace("s3a://", "s3://", 1)

    def save(table: pa.Table) -> pa.Table:
        h = table.column("w").to_numpy().view(np.uint64)
        part = int(h[0] % np.uint64(parts))
        _save(root, f"words-{part}", np.sort(h).astype("<u8"))
        return pa.table({"part": pa.array([part], pa.int64())})

    # The part of an unsigned hash, in signed arithmetic.
    unsigned = F.pmod(F.pmod(F.col("w"), F.lit(parts)) + F.when(F.col("w") < 0, F.lit((1 << 64) % parts)).otherwise(0), F.lit(parts))
    wrote = {r["part"] for r in words.groupBy(unsigned.alias("p")).applyInArrow(save, "part long").collect()}
    for part in set(range(parts)) - wrote:
        _save(root, f"words-{part}")
    return Dictionary(np.zeros(0, np.uint64), root, parts), total


def secret_findings(docs: DataFrame, scanner: Scanner, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """One row per candidate: id, start, end (bytes of the UTF-8 text), length, probability, is_secret.

    Whole texts are searched; null and empty texts have no candidates, repeated
    rows each have theirs, a null path counts as empty.  Other columns are
    ignored.
    """
    ids = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("i"), F.coalesce(F.col(path_col).cast("string"), F.lit("")).alias("p"), F.col(text_col).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.chunks(batch, "t"):
                found = scanner.scan(_raws(part), [p.encode() for p in part.column("p").to_pylist()])
                flat = [(k, a, b, p) for k, ss in enumerate(found) for a, b, p in ss]
                if flat:
                    k, a, b, p = zip(*flat)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("i").take(pa.array(k, pa.int64())), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(p, pa.float64())],
                        ["i", "a", "b", "p"],
                    )

    found = rows.mapInArrow(run, f"i {ids}, a long, b long, p double")
    return found.select(
        F.col("i").alias(id_col),
        F.col("a").alias("start"),
        F.col("b").alias("end"),
        (F.col("b") - F.col("a")).alias("length"),
        F.col("p").alias("probability"),
        (F.col("p") >= threshold).alias("is_secret"),
    )


def redact_secrets(
    docs: DataFrame, scanner: Scanner, mask: str = "[secret]", threshold: float = 0.5, text_col: str = "text", path_col: str = "source"
) -> DataFrame:
    """All rows and columns, each secret in a text replaced by ``mask``; texts without one are as they were (null too)."""
    path = next(c for c in (f"_p{k}" for k in range(len(docs.columns) + 1)) if c not in docs.columns)
    at, cover = docs.columns.index(text_col), mask.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.chunks(batch, text_col):
                raws = _raws(pa.RecordBatch.from_arrays([part.column(at)], ["t"]))
                found = scanner.scan(raws, [p.encode() for p in part.column(path).to_pylist()])
                column = part.column(at)
                if any(p >= threshold for ss in found for _, _, p in ss):
                    texts = column.to_pylist()
                    for k, ss in enumerate(found):
                        for a, b, p in reversed(ss):
                            if p >= threshold:
                                raws[k] = raws[k][:a] + cover + raws[k][b:]
                        if ss:
                            texts[k] = raws[k].decode()
                    column = pa.array(texts, column.type)
                columns = list(part.columns[:-1])
                columns[at] = column
                yield pa.RecordBatch.from_arrays(columns, part.schema.names[:-1])

    with_path = docs.withColumn(path, F.coalesce(F.col(path_col).cast("string"), F.lit("")))
    return with_path.mapInArrow(run, docs.schema)
