"""Byte-level BPE with word ends: encoding by a segment tree over pair ranks, decoding.

The vocabulary is read from a public tokenizer file given by path; nothing is trained.
Inputs: `id` of any type, text. Null text counts as empty and gives no tokens. Repeated
rows are encoded each for itself; other columns are ignored, whatever their names. An
empty table gives an empty table. A word is merged in n log n steps: many words of like
length side by side in one matrix of trees, few long ones each in a tree of its own.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

NONE = 1 << 62
PLACE = (1 << 32) - 1
#: Pieces kept with their ids in one Python worker (twice as many at most), and their
#: longest length.
MEMO, MEMO_CHARS = 250_000, 48
#: Symbols that are merged side by side, and the fewest words for which that pays.
CELLS, TOGETHER = 1 << 17, 32
#: Texts encoded between two results.
ROWS = 500


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class WordBpe:
    """Encoder and decoder for one tokenizer file of this kind."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([self.vocab[a] << 16 | self.vocab[b] for a, b in pairs], np.int64)
        self.ranks = np.argsort(keys)
        self.keys = keys[self.ranks]
        self.merged = np.array([self.vocab[a + b] for a, b in pairs], np.int64)[self.ranks]
        letters = byte_letters()
        self.pairs = dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.merged.tolist()), strict=True))
        self.plain = np.array([self.vocab[c] for c in letters], np.int64)
        self.final = np.array([self.vocab[c + self.end] for c in letters], np.int64)
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # \s is White_Space here, as in the library, which leaves out the separators 1C to 1F.
        self.words = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}"))
        alternatives = "|".join(map(regex.escape, self.special))
        self.cut = regex.compile(f"({alternatives})") if alternatives else None
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of each pair; the rank of what can't be merged is NONE."""
        key = a << 16 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE), self.merged[at]

    def merge(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word; words of like length are merged side by side."""
        spelled = [word.encode() for word in words]
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(words)
        classes: dict[int, list[int]] = {}
        for k, raw in enumerate(spelled):
            classes.setdefault(max(len(raw) - 2, 0).bit_length(), []).append(k)
        for power, members in classes.items():
            step = max(1, CELLS >> power)
            for at in range(0, len(members), step):
                group = members[at : at + step]
                few = len(group) < TOGETHER
                raw = [spelled[k] for k in group]
                for k, ids in zip(group, map(self._merge_one, raw) if few else self._merge(raw, 1 << power), strict=True):
                    out[k] = ids
        return out

    def _merge(self, words: list[bytes], width: int) -> list[np.ndarray]:
        """While a word has a pair to merge, merge the one at the root of its tree.

        node[:, width + i] holds rank and place of the pair that begins at symbol i, an
        inner node the lesser of its two: the root is the lowest rank, of equals the
        leftmost. Rows are words; a row's last column takes what lies beyond its end.
        """
        n = np.array([len(w) for w in words])
        place = np.arange(width + 3)
        inside = place < n[:, None]
        ids = np.zeros((len(words), width + 3), np.int64)
        ids[inside] = self.plain[np.frombuffer(b"".join(words), np.uint8)]
        rows = np.arange(len(words))
        ids[rows, n - 1] = self.final[[w[-1] for w in words]]
        node = np.full((len(words), 2 * width + 3), NONE, np.int64)
        rank, _ = self.pair(ids[:, :width], ids[:, 1 : width + 1])
        both = inside[:, 1 : width + 1] & (rank < NONE)
        node[:, width : 2 * width] = np.where(both, rank << 32 | place[:width], NONE)
        low = width
        while low > 1:
            node[:, low // 2 : low] = np.minimum(node[:, low : 2 * low : 2], node[:, low + 1 : 2 * low : 2])
            low //= 2
        after, before = np.tile(place + 1, (len(words), 1)), np.tile(place - 1, (len(words), 1))
        while len(rows := rows[node[rows, 1] < NONE]):
            i = node[rows, 1] & PLACE
            j = after[rows, i]
            new = ids[rows, i] = self.pair(ids[rows, i], ids[rows, j])[1]
            right, left = after[rows, j], before[rows, i]
            inside[rows, j] = False
            after[rows, i] = right
            before[rows, right] = i
            rank, _ = self.pair(new, ids[rows, right])
            node[rows, width + i] = np.where((right < n[rows]) & (rank < NONE), rank << 32 | i, NONE)
            node[rows, width + j] = NONE
            rank, _ = self.pair(ids[rows, left], new)
            some = np.flatnonzero(left >= 0)
            node[rows[some], width + left[some]] = np.where(rank < NONE, rank << 32 | left, NONE)[some]
            up = [width + i, np.minimum(width + j, 2 * width - 1), width + np.maximum(left, 0)]
            for _ in range(width.bit_length() - 1):
                for k in range(3):
                    p = up[k] = up[k] >> 1
                    node[rows, p] = np.minimum(node[rows, 2 * p], node[rows, 2 * p + 1])
        return np.split(ids[inside], np.cumsum(inside.sum(1))[:-1])

    def _merge_one(self, word: bytes) -> np.ndarray:
        """The same tree for a single word; a change climbs only as far as it is felt."""
        n = len(word)
        ids = array("q", self.plain[np.frombuffer(word, np.uint8)].tobytes())
        ids[-1] = self.final[word[-1]]
        width = 1 << max(n - 2, 0).bit_length()
        rank, _ = self.pair(*(np.frombuffer(x, np.int64) for x in (ids[:-1], ids[1:])))
        level = np.full(width, NONE, np.int64)
        level[: n - 1] = np.where(rank < NONE, rank << 32 | np.arange(n - 1), NONE)
        levels = [level]
        while len(level) > 1:
            level = np.minimum(level[::2], level[1::2])
            levels.append(level)
        node = array("q", np.concatenate([[NONE], *levels[::-1]]).tobytes())
        after, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))

        def put(i: int, value: int) -> None:
            p = width + i
            node[p] = value
            while p > 1:
                least = min(node[p], node[p ^ 1])
                p >>= 1
                if node[p] == least:
                    break
                node[p] = least

        def rank_at(i: int, j: int) -> int:
            found = self.pairs.get(ids[i] << 16 | ids[j])
            return found[0] << 32 | i if found else NONE

        while node[1] < NONE:
            i = node[1] & PLACE
            j = after[i]
            ids[i] = self.pairs[ids[i] << 16 | ids[j]][1]
            ids[j] = -1
            right, left = after[j], before[i]
            after[i] = right
            if right < n:
                before[right] = i
                put(j, NONE)
            put(i, rank_at(i, right) if right < n else NONE)
            if left >= 0:
                put(left, rank_at(left, i))
        left = np.frombuffer(ids, np.int64)
        return left[left >= 0]

    def _learn(self, pieces: list[str], ids: dict[str, bytes]) -> None:
        """Put the ids of what stands between two blanks into `ids`."""
        # One letter at a time, so that a sigma at a word's end is no other letter.
        words = [
            self.words.findall(unicodedata.normalize("NFC", p).replace("\u03a3", "\u03c3").lower()) for p in pieces
        ]
        distinct = list(dict.fromkeys(w for ws in words for w in ws))
        known = {w: x.astype("<u4").tobytes() for w, x in zip(distinct, self.merge(distinct), strict=True)}
        ids.update((p, b"".join(known[w] for w in ws)) for p, ws in zip(pieces, words, strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        parts = [self.cut.split(t) if self.cut else [t] for t in texts]
        pieces = [
            [[p] if p in self.special else p.replace("\n", " ").split(" ") for p in some] for some in parts
        ]
        memo = self.memo
        new = {x for text in pieces for some in text for x in some if x not in memo}
        if new:
            old = {x: self.older[x] for x in new if x in self.older}
            self._learn([x for x in new if x not in old and x not in self.special], old)
            ids = {k: np.array([v], "<u4").tobytes() for k, v in self.special.items()} | old
        else:
            ids = {}
        for some in pieces:
            for k, part in enumerate(some):
                some[k] = b"".join(memo[x] if x in memo else ids[x] for x in part)
        if len(memo) + len(new) > MEMO:
            self.memo, self.older = {}, memo
        self.memo.update((x, ids[x]) for x in new if len(x) <= MEMO_CHARS)
        return [b"".join(some) for some in pieces]

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_LOADED: dict[str, WordBpe] = {}


def load(path: str) -> WordBpe:
    """The tokenizer of a file, read once in each Python worker."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


def encode_texts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids packed as little-endian uint32, decoded text) of every row."""

    names = [id_col, "n_tokens", "ids", "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(tokenizer)
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                ids = bpe.encode([t or "" for t in part.column(1).to_pylist()])
                counts = pa.array([len(x) // 4 for x in ids], pa.int64())
                decoded = pa.array(map(bpe.decode, ids), pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), counts, pa.array(ids, pa.binary()), decoded], names)

    plain = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    schema = T.StructType(
        [
            T.StructField(id_col, plain.schema["id"].dataType),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("decoded", T.StringType()),
        ]
    )
    return plain.mapInArrow(run, schema)

