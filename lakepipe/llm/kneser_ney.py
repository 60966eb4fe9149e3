"""Interpolated modified Kneser-Ney model, counted in Spark, stored as sorted hash arrays.

Counting: every task reduces its texts to distinct pairs (previous word, word)
with counts and deals them to shards by the word; a word that is frequent (from
cell counts of all words) is dealt by both words, so no shard holds more than
its part.  A shard adds up its pairs, writes them as a sorted key file and
passes on per-word and per-context sums, which a second, small shuffle adds up
and writes likewise.  Scoring tasks memory-map the files: words, contexts and
pairs are looked up by binary search over sorted keys, nothing is loaded whole.

The model: p(w | v) = max(c(vw) - D(c), 0) / c(v) + g(v) p(w), with
p(w) = max(n(.w) - D'(n), 0) / n(..) + g' / (V + 1); c are counts, n(.w) the
number of distinct words before w, D the three discounts of each order from
counts of counts, g what they leave; V distinct words, one more for the unknown.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakepipe.llm import text as tx
from lakepipe.llm.cells import cell_counts, cell_of
from lakepipe.session import scratch_path

BEGIN, END = np.uint64(1), np.uint64(2)  # what stands before the first word, and the end token
_PREVIOUS = np.uint64((1 << 48) - 1)  # bits kept of the word before
_BITS = 16
_FLUSH = 2_500_000  # tokens a task holds before it passes its pairs on


def sequence(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(previous word, word, index of each text's first token and one more): words, then one end for each text."""
    words, first = tx.word_hashes(data, off)
    n = len(off) - 1
    at = first + np.arange(n + 1)
    w = np.empty(len(words) + n, np.uint64)
    ends = at[1:] - 1
    inner = np.ones(len(w), bool)
    inner[ends] = False
    w[inner] = words
    w[ends] = END
    v = np.empty_like(w)
    v[1:] = w[:-1]
    v[at[:-1]] = BEGIN
    return v, w, at


def pair_key(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return tx.mix(v * np.uint64(0x9FB21C651E98DF25) + w)


def shard_of(v: np.ndarray, w: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    """By the word; for a frequent word by both words."""
    by = np.where(hot[cell_of(w, _BITS)], pair_key(v, w), w)
    return ((by & np.uint64(0xFFFFFFFF)) % np.uint64(shards)).astype(np.int64)


def _sums(keys: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct keys in order, and the sums of the columns over each."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    start = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    return k[start], [np.add.reduceat(c[order], start) if len(k) else c for c in columns]


def _pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays)] + [a.nbytes for a in arrays], "<i8").tobytes()
    return head + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def _unpack(blob: bytes, *kinds: str) -> list[np.ndarray]:
    sizes = np.frombuffer(blob, "<i8", len(kinds), 8)
    at, out = 8 * (len(kinds) + 1), []
    for kind, size in zip(kinds, sizes.tolist()):
        out.append(np.frombuffer(blob, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


def _save(root: str, name: str, *arrays: np.ndarray) -> None:
    """Writes arrays one after the other; a repeated task writes the same file again."""
    store, path = fs.FileSystem.from_uri(root)
    store.create_dir(path, recursive=True)
    part = f"{path}/.{name}-{os.getpid()}-{os.urandom(4).hex()}"
    with store.open_output_stream(part) as out:
        for a in arrays:
            out.write(np.ascontiguousarray(a).data)
    store.move(part, f"{path}/{name}")


def _mapped(root: str, name: str) -> np.ndarray:
    """A file as mapped memory: in place where the folder is mounted, else by a copy that has no name any more."""
    store, path = fs.FileSystem.from_uri(root)
    path = f"{path}/{name}"
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, np.uint8, "r") if os.path.getsize(path) else np.zeros(0, np.uint8)
    with tempfile.NamedTemporaryFile() as copy:
        with store.open_input_stream(path) as src:
            while block := src.read(1 << 22):
                copy.write(block)
        copy.flush()
        return np.memmap(copy.name, np.uint8, "r") if os.path.getsize(copy.name) else np.zeros(0, np.uint8)


def _columns(raw: np.ndarray, *kinds: str) -> list[np.ndarray]:
    """The columns of a file of ``_save`` that all have one length."""
    width = sum(np.dtype(k).itemsize for k in kinds)
    n, at, out = len(raw) // width, 0, []
    for k in kinds:
        size = n * np.dtype(k).itemsize
        out.append(raw[at : at + size].view(k))
        at += size
    return out


def discounts(n: list[int]) -> tuple[float, float, float]:
    """D1, D2, D3+ from the numbers of grams seen one, two, three and four times."""
    if not all(n):
        return 0.5, 0.75, 0.9
    y = n[0] / (n[0] + 2 * n[1])
    raw = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]]
    return tuple(float(min(max(d, 0.05), 0.95 * (k + 1))) for k, d in enumerate(raw))


@dataclass
class Model:
    """Where the arrays are, and the few numbers that hold for all words."""

    root: str
    shards: int
    parts: int
    hot: np.ndarray
    tokens: int
    vocabulary: int
    pairs: int
    d_pair: tuple[float, float, float]
    d_word: tuple[float, float, float]
    n_words: tuple[int, int, int]
    _open: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_open": {}}

    def _file(self, name: str, *kinds: str) -> list[np.ndarray]:
        if name not in self._open:
            self._open[name] = _columns(_mapped(self.root, name), *kinds)
        return self._open[name]

    def _find(self, queries: np.ndarray, place: np.ndarray, name: str, kinds: tuple[str, ...], outs: list[np.ndarray]) -> None:
        """For sorted-key files ``name-<place>``: copies the columns of found keys to ``outs``."""
        order = np.lexsort((queries, place))
        cuts = np.searchsorted(place[order], np.arange(place.max() + 2)) if len(place) else []
        for p in range(len(cuts) - 1):
            at = order[cuts[p] : cuts[p + 1]]
            if not len(at):
                continue
            keys, *columns = self._file(f"{name}-{p}", *kinds)
            if not len(keys):
                continue
            q = queries[at]
            i = np.searchsorted(keys, q)
            i[i == len(keys)] = 0
            hit = keys[i] == q
            for out, column in zip(outs, columns):
                out[at[hit]] = column[i[hit]]

    def probabilities(self, v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(p(w | v), count of w in training) of each pair."""
        uw, iw = np.unique(w, return_inverse=True)
        raw, cont = np.zeros(len(uw), np.int64), np.zeros(len(uw), np.int64)
        self._find(uw, (uw % np.uint64(self.parts)).astype(np.int64), "word", ("<u8", "<i8", "<i8"), [raw, cont])
        d = np.array((0.0, *self.d_word))
        left = sum(x * k for x, k in zip(self.d_word, self.n_words))
        total = max(1, self.pairs)
        lower = np.maximum(cont - d[np.minimum(cont, 3)], 0) / total
        lower += (left / total if self.pairs else 1.0) / (self.vocabulary + 1)
        uv, iv = np.unique(v, return_inverse=True)
        seen, ones, twos, more = (np.zeros(len(uv), np.int64) for _ in range(4))
        self._find(uv, (uv % np.uint64(self.parts)).astype(np.int64), "context", ("<u8", "<i8", "<i8", "<i8", "<i8"), [seen, ones, twos, more])
        kept = ones * self.d_pair[0] + twos * self.d_pair[1] + more * self.d_pair[2]
        gamma = np.where(seen > 0, kept / np.maximum(seen, 1), 1.0)
        key, at, ik = np.unique(pair_key(v, w), return_index=True, return_inverse=True)
        count = np.zeros(len(key), np.int64)
        self._find(key, shard_of(v[at], w[at], self.hot, self.shards), "pair", ("<u8", "u1"), [count])
        big = np.flatnonzero(count == 255)
        if len(big):
            exact = count[big]
            self._find(key[big], shard_of(v[at[big]], w[at[big]], self.hot, self.shards), "frequent", ("<u8", "<i8"), [exact])
            count[big] = exact
        d = np.array((0.0, *self.d_pair))
        top = np.maximum(count - d[np.minimum(count, 3)], 0)[ik] / np.maximum(seen, 1)[iv]
        return top + gamma[iv] * lower[iw], raw[iw]


def train(docs: DataFrame, text_col: str = "text", shard_tokens: int = 4_000_000) -> Model:
    """Counts all texts of ``docs`` (null: empty) and writes the model to the shared checkpoint folder.

    ``shard_tokens`` sets how many tokens make one shard, so a task's memory
    does not grow with the corpus.
    """
    rows = docs.select(F.col(text_col).alias("t"))

    def words(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for part in tx.chunks(batch, "t"):
            yield sequence(*tx.texts(part.column("t")))[1]

    cells = cell_counts(rows, words, _BITS)
    tokens = int(cells.sum())
    shards = max(8, -(-tokens // shard_tokens))
    hot = cells > tokens / (8 * shards)
    parts = max(4, shards // 4)
    root = scratch_path(docs.sparkSession, "kneser-ney")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            for part in tx.chunks(batch, "t"):
                v, w, _ = sequence(*tx.texts(part.column("t")))
                held.append((v, w))
                size += len(w)
                if size >= _FLUSH:
                    yield _deal(held, hot, shards)
                    held, size = [], 0
        if size:
            yield _deal(held, hot, shards)

    def merge(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        vs, ws, cs = [], [], []
        for blob in table.column("blob"):
            w, run, low, high, c = _unpack(blob.as_buffer(), "<u8", "<u4", "<u4", "<u2", "<u4")
            ws.append(np.repeat(w, run))
            vs.append(low.astype(np.uint64) | (high.astype(np.uint64) << np.uint64(32)))
            cs.append(c)
        v, w, c = np.concatenate(vs), np.concatenate(ws), np.concatenate(cs).astype(np.int64)
        order = np.lexsort((v, w))
        v, w, c = v[order], w[order], c[order]
        start = np.flatnonzero(np.concatenate([[True], (v[1:] != v[:-1]) | (w[1:] != w[:-1])]))
        v, w, c = v[start], w[start], np.add.reduceat(c, start)
        key = pair_key(v, w)
        order = np.argsort(key)
        sk, sc = key[order], c[order]
        _save(root, f"pair-{shard}", sk.astype("<u8"), np.minimum(sc, 255).astype("u1"))
        _save(root, f"frequent-{shard}", sk[sc >= 255].astype("<u8"), sc[sc >= 255].astype("<i8"))
        one = np.ones(len(c), np.int64)
        rows = _parted(0, *_sums(w, [c, one]), parts)
        rows += _parted(1, *_sums(v, [c, (c == 1) * one, (c == 2) * one, (c >= 3) * one]), parts)
        stats = np.array([(c == k).sum() for k in range(1, 5)] + [len(c)], "<i8").tobytes()
        rows.append((2, 0, stats))
        kind, part, blob = zip(*rows)
        return pa.table({"kind": pa.array(kind, pa.int32()), "part": pa.array(part, pa.int32()), "blob": pa.array(blob, pa.binary())})

    def total(table: pa.Table) -> pa.Table:
        kind, part = table.column("kind")[0].as_py(), table.column("part")[0].as_py()
        if kind == 2:
            stats = sum(np.frombuffer(b.as_buffer(), "<i8") for b in table.column("blob"))
        else:
            kinds = ("<u8", "<u4", "<u4") if kind == 0 else ("<u8", "<u4", "<u4", "<u4", "<u4")
            pieces = [_unpack(b.as_buffer(), *kinds) for b in table.column("blob")]
            columns = [np.concatenate(c) for c in zip(*pieces)]
            keys, sums = _sums(columns[0], [c.astype(np.int64) for c in columns[1:]])
            _save(root, f"{'word' if kind == 0 else 'context'}-{part}", keys.astype("<u8"), *(s.astype("<i8") for s in sums))
            cont = sums[1]
            stats = np.array([(cont == k).sum() for k in range(1, 5)] + [len(keys), (cont >= 3).sum()], "<i8")
        return pa.table(
            {"kind": pa.array([kind], pa.int32()), "part": pa.array([part], pa.int32()), "stats": pa.array([stats.tolist()], pa.list_(pa.int64()))}
        )

    dealt = rows.mapInArrow(deal, "shard int, blob binary").groupBy("shard").applyInArrow(merge, "kind int, part int, blob binary")
    summed = dealt.groupBy("kind", "part").applyInArrow(total, "kind int, part int, stats array<long>").collect()
    present = {("word", "context", "")[r["kind"]] + f"-{r['part']}" for r in summed}
    for name in ("word", "context"):
        for p in range(parts):
            if f"{name}-{p}" not in present:
                _save(root, f"{name}-{p}")
    _fill(root, shards)
    n_word = np.sum([r["stats"] for r in summed if r["kind"] == 0] or [[0] * 6], axis=0)
    n_pair = np.sum([r["stats"] for r in summed if r["kind"] == 2] or [[0] * 5], axis=0)
    return Model(
        root=root,
        shards=shards,
        parts=parts,
        hot=hot,
        tokens=tokens,
        vocabulary=int(n_word[4]),
        pairs=int(n_pair[4]),
        d_pair=discounts(n_pair[:4].tolist()),
        d_word=discounts(n_word[:4].tolist()),
        n_words=(int(n_word[0]), int(n_word[1]), int(n_word[5])),
    )


def _deal(held: list[tuple[np.ndarray, np.ndarray]], hot: np.ndarray, shards: int) -> pa.RecordBatch:
    """Distinct pairs with counts as one blob for each shard: words with the length of their run, 48 bits of the word before."""
    v = np.concatenate([x for x, _ in held])
    w = np.concatenate([x for _, x in held])
    vocabulary, ids = np.unique(np.concatenate([v, w]), return_inverse=True)
    ids = ids.astype(np.uint64)
    key = (ids[len(v) :] << np.uint64(32)) | ids[: len(v)]
    key.sort()
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    count = np.diff(np.concatenate([start, [len(key)]]))
    key = key[start]
    v = vocabulary[(key & np.uint64(0xFFFFFFFF)).astype(np.int64)] & _PREVIOUS
    w = vocabulary[(key >> np.uint64(32)).astype(np.int64)]
    shard = shard_of(v, w, hot, shards)
    names, blobs = [], []
    order = np.argsort(shard, kind="stable")
    cuts = np.searchsorted(shard[order], np.arange(shards + 1))
    for s in range(shards):
        at = order[cuts[s] : cuts[s + 1]]
        if not len(at):
            continue
        sw, sv = w[at], v[at]
        new = np.flatnonzero(np.concatenate([[True], sw[1:] != sw[:-1]]))
        run = np.diff(np.concatenate([new, [len(sw)]]))
        names.append(s)
        blobs.append(
            _pack(
                sw[new].astype("<u8"),
                run.astype("<u4"),
                (sv & np.uint64(0xFFFFFFFF)).astype("<u4"),
                ((sv >> np.uint64(32)) & np.uint64(0xFFFF)).astype("<u2"),
                count[at].astype("<u4"),
            )
        )
    return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(blobs, pa.binary())], ["shard", "blob"])


def _parted(kind: int, keys: np.ndarray, sums: list[np.ndarray], parts: int) -> list[tuple[int, int, bytes]]:
    place = (keys % np.uint64(parts)).astype(np.int64)
    return [
        (kind, p, _pack(keys[place == p].astype("<u8"), *(s[place == p].astype("<u4") for s in sums)))
        for p in range(parts)
        if (place == p).any()
    ]


def _fill(root: str, shards: int) -> None:
    """Empty files for the shards that got no pair."""
    store, path = fs.FileSystem.from_uri(root)
    store.create_dir(path, recursive=True)
    there = {os.path.basename(f.path) for f in store.get_file_info(fs.FileSelector(path))}
    for s in range(shards):
        for name in (f"pair-{s}", f"frequent-{s}"):
            if name not in there:
                _save(root, name)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per input row: id, n_tokens, n_known, train_tokens, base_score, score, and the ``carry`` columns.

    ``score`` is the model's log10 probability of the text, ``base_score``
    that of add-one unigrams; perplexity is 10 ** (-score / n_tokens).
    """
    carry = carry or {}
    ids = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), *(c.alias(k) for k, c in carry.items()))
    extra = "".join(f", {f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[2:])
    kept = list(carry)
    names = ["i", "n_tokens", "n_known", "train_tokens", "base_score", "score", *kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.chunks(batch, "t"):
                v, w, at = sequence(*tx.texts(part.column("t")))
                p, count = model.probabilities(v & _PREVIOUS, w)
                add = lambda x: np.add.reduceat(x, at[:-1])  # noqa: E731  each text has its end token
                n = np.diff(at)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("i"),
                        pa.array(n, pa.int64()),
                        pa.array(add((count > 0).astype(np.int64)), pa.int64()),
                        pa.array(np.full(len(n), model.tokens), pa.int64()),
                        pa.array(add(np.log10(count + 1.0)) - n * np.log10(float(model.tokens + model.vocabulary + 1)), pa.float64()),
                        pa.array(add(np.log10(p)), pa.float64()),
                        *(part.column(k) for k in kept),
                    ],
                    names,
                )

    scored = rows.mapInArrow(
        run, f"i {ids}, n_tokens long, n_known long, train_tokens long, base_score double, score double{extra}"
    )
    return scored.withColumnRenamed("i", id_col)


def lm_scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores every text by a model of the texts that are not held out (a null condition: not held out).

    Null and empty texts have one token, their end.  Repeated rows count as
    often as they occur; with nothing to learn from, every word has the same
    probability 1.  Other columns are ignored.
    """
    held = F.coalesce(held_out, F.lit(False))
    model = train(docs.where(~held), text_col)
    return score(docs, model, id_col, text_col, {"held_out": held})
