"""Exact token counts of whole texts under a given public tokenizer file.

A huge text is never encoded in one call.  It is cut into overlapping windows
that are encoded with offsets; two neighbouring windows are spliced at a
boundary that both encodings share and that is proven stable: it touches white
space, and at least ``agree`` tokens on each side of it are the same tokens at
the same offsets in both.  Where the overlap has no such boundary it is widened
(doubled) and encoded again, up to the rest of the text.

Where the tokenizer's own definition shows that no token or normalisation
reaches across ASCII white space, each run of other characters is a piece with
proven boundaries on both sides, and its count is kept by a 64-bit hash so that
a repeated piece is encoded once per worker.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakepipe.llm import text as tx

# The pre-tokenizer pattern of the vocabulary file; it has no match with white space in it.
SEPARABLE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_MEMO_LIMIT = 2_000_000  # pieces a worker remembers (24 bytes each); beyond that it starts anew
_SPACE = " \t\n\r\x0b\x0c"


class JsonTokenizer:
    """A ``tokenizers`` file: special strings inside texts as its default has them, none added."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._inner = Tokenizer.from_file(path)
        self._inner.no_truncation()
        self._inner.no_padding()
        spec = json.loads(self._inner.to_str())
        self.separable = self._separable(spec)

    @staticmethod
    def _separable(spec: dict) -> bool:
        parts = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        first, norm = parts[0], (spec.get("normalizer") or {}).get("normalizers") or []
        return (
            first.get("type") == "Split"
            and first.get("behavior") == "Removed"
            and first.get("invert") is True
            and first.get("pattern") == {"Regex": SEPARABLE}
            and all(n["type"] in ("NFC", "Lowercase", "Replace") for n in norm)
            and not any(set(t["content"]) & set(_SPACE) or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
        )

    def counts(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self._inner.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(ids, [start, end] offsets in characters)."""
        e = self._inner.encode(text, add_special_tokens=False)
        return np.array(e.ids, np.int64), np.array(e.offsets, np.int64).reshape(-1, 2)


class PieceTokenizer:
    """A ``sentencepiece`` model; its byte offsets are turned into characters."""

    separable = False

    def __init__(self, path: str):
        import sentencepiece

        self._inner = sentencepiece.SentencePieceProcessor(model_file=path)

    def counts(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self._inner.encode(texts, num_threads=1)]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        pieces = self._inner.encode_as_proto(text).pieces
        raw = np.frombuffer(text.encode(), np.uint8)
        char = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # characters begun before each byte
        off = char[np.array([(p.begin, p.end) for p in pieces], np.int64).reshape(-1, 2)]
        return np.array([p.id for p in pieces], np.int64), off


def load(path: str):
    return PieceTokenizer(path) if path.endswith(".model") else JsonTokenizer(path)


def splice(
    left: tuple[np.ndarray, np.ndarray],
    right: tuple[np.ndarray, np.ndarray],
    text: str,
    start: int,
    end: int,
    agree: int,
) -> tuple[int, int] | None:
    """(tokens of left kept, tokens of right dropped) at a stable boundary inside [start, end), or None.

    Offsets are positions in the text; ``right`` was encoded from ``start`` and ``left`` up to ``end``.
    """
    (ids_a, off_a), (ids_b, off_b) = left, right
    a0 = int(np.searchsorted(off_a[:, 0], start))
    b1 = int(np.searchsorted(off_b[:, 1], end, side="right"))
    where = {(int(i), int(s), int(e)): k for k, (i, (s, e)) in enumerate(zip(ids_b[:b1], off_b[:b1]))}
    run = []  # (index in left, index in right) of tokens equal in both, in one run
    for k in range(a0, len(ids_a)):
        j = where.get((int(ids_a[k]), int(off_a[k, 0]), int(off_a[k, 1])))
        if j is None or run and run[-1][1] + 1 != j:
            run = []
        if j is not None:
            run.append((k, j))
        if len(run) >= 2 * agree:
            k0, j0 = run[len(run) - agree]
            s, e = int(off_a[k0 - 1, 1]), int(off_a[k0, 0])
            if any(c in _SPACE for c in text[max(0, s - 1) : e + 1]):
                return k0, j0
    return None


def count_long(tokenizer, text: str, chunk: int, overlap: int, agree: int = 8) -> int:
    """Tokens of a text longer than ``chunk`` characters, by windows spliced at stable boundaries."""

    def window(a: int, b: int):
        ids, off = tokenizer.encode(text[a:b])
        return ids, off + a

    at, end, total = 0, min(len(text), chunk), 0
    ids, off = window(at, end)
    while end < len(text):
        width = overlap
        while True:
            start = max(at + 1, end - width)
            stop = min(len(text), start + max(chunk, 2 * width))
            nxt = window(start, stop)
            cut = splice((ids, off), nxt, text, start, end, agree)
            if cut is not None:
                total += cut[0]
                ids, off = nxt[0][cut[1] :], nxt[1][cut[1] :]
                at, end = start, stop
                break
            if start == at + 1:  # the whole window overlapped and nothing agreed: encode from its start to a farther end
                end = min(len(text), end + max(chunk, end - at))
                ids_off = window(at, end)
                kept = len(ids_off[0]) if not len(off) else int(np.searchsorted(ids_off[1][:, 0], off[0, 0]))
                ids, off = ids_off[0][kept:], ids_off[1][kept:]
                if end == len(text):
                    break
                width = overlap
                continue
            width *= 2
    return total + len(ids)


class Counter:
    """Counts the texts of a batch; lives as long as its worker's task."""

    def __init__(self, path: str, chunk: int, overlap: int):
        self.tokenizer, self.chunk, self.overlap = load(path), chunk, overlap
        self.keys, self.values = np.zeros(0, np.uint64), np.zeros(0, np.int32)

    def _pieces(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        starts, ends, first = tx.word_bounds(data, off)
        keys, at, inverse = np.unique(tx.span_hashes(data, starts, ends, lower=False), return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == keys[inside]
        counts = np.zeros(len(keys), np.int64)
        counts[known] = self.values[place[known]]
        new = np.flatnonzero(~known)
        if len(new):
            raw = data.tobytes()
            counts[new] = self.tokenizer.counts([raw[starts[i] : ends[i]].decode() for i in at[new].tolist()])
            if len(self.keys) + len(new) > _MEMO_LIMIT:
                self.keys, self.values = np.zeros(0, np.uint64), np.zeros(0, np.int32)
                place = np.zeros(len(keys), np.int64)
            self.keys = np.insert(self.keys, place[new], keys[new])
            self.values = np.insert(self.values, place[new], counts[new].astype(np.int32))
        total = np.concatenate([[0], np.cumsum(counts[inverse])])
        return total[first[1:]] - total[first[:-1]]

    def count(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, tokens) of each text."""
        data, off = tx.texts(column)
        n_bytes = np.diff(off)
        strings = {}
        for i in np.flatnonzero(n_bytes > self.chunk).tolist():
            text = data[off[i] : off[i + 1]].tobytes().decode()
            if len(text) > self.chunk:
                strings[i] = text
        if self.tokenizer.separable:
            if strings:  # the huge texts go through windows, the others through pieces
                keep = np.ones(len(n_bytes), bool)
                keep[list(strings)] = False
                data = data[np.repeat(keep, n_bytes)]
                off = np.concatenate([[0], np.cumsum(n_bytes * keep)])
            tokens = self._pieces(data, off)
        else:
            raw = data.tobytes()
            tokens = np.array(
                self.tokenizer.counts(["" if i in strings else raw[off[i] : off[i + 1]].decode() for i in range(len(n_bytes))]),
                np.int64,
            )
        for i, text in strings.items():
            tokens[i] = count_long(self.tokenizer, text, self.chunk, self.overlap)
        return n_bytes, tokens


def token_counts(
    docs: DataFrame,
    tokenizer_path: str,
    limit: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk: int = 65536,
    overlap: int = 1024,
) -> DataFrame:
    """One row per input row: id, n_bytes (UTF-8), n_tokens, over_limit.

    A null text counts as empty (0 bytes, 0 tokens).  Texts of more than
    ``chunk`` characters are encoded in windows with ``overlap`` characters in
    common.  Null ids and repeated rows are kept, other columns are ignored.
    ``tokenizer_path`` must exist at the same place on every worker.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(tokenizer_path, chunk, overlap)
        for batch in batches:
            for part in tx.chunks(batch, "t"):
                n_bytes, tokens = counter.count(part.column("t"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("i"), pa.array(n_bytes, pa.int64()), pa.array(tokens, pa.int64())], ["i", "b", "n"]
                )

    ids = docs.schema[id_col].dataType.simpleString()
    counted = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).mapInArrow(run, f"i {ids}, b long, n long")
    return counted.select(
        F.col("i").alias(id_col),
        F.col("b").alias("n_bytes"),
        F.col("n").alias("n_tokens"),
        (F.col("n") > limit).alias("over_limit"),
    )
