"""License scan: ordered signature rules behind a keyword prefilter.

A text is lower-cased (A-Z), cut into words and searched as words joined by one space. Base
phrases are found at every place. A rule's pattern is tried only where its keyword stands in
the text. Detections that overlap are resolved: one that lies within another of the same or
higher priority goes, of equal spans the higher priority stays, then the earlier rule; a
partial overlap stays. Base labels are never suppressed.

Null texts count as empty: no words, no places, empty labels, score 0. The score is the
highest priority of what was found, out of 100. Repeated rows are scanned each for itself;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from scorewatch.llm.license_rules import build

BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
BASE_PRIORITY = 70
#: Texts scanned between two results.
ROWS = 500

_GAPS = bytes(
    b + 0x20 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def plain_words(text: str | None) -> bytes:
    """Words of a text, lower-cased, each with a blank before and after it."""
    joined = b" ".join((text or "").encode().translate(_GAPS).split())
    return b" " + joined + b" " if joined else b""


class Scanner:
    """Compiled rules; one in each Python worker."""

    def __init__(self) -> None:
        self.rules = [(label, p, k.encode(), re.compile(f" (?:{x})(?= )".encode())) for label, p, k, x in build()]
        self.keywords: dict[bytes, list[int]] = {}
        for i, rule in enumerate(self.rules):
            self.keywords.setdefault(rule[2], []).append(i)
        self.find = ahocorasick.Automaton()
        for k in self.keywords:
            self.find.add_word(k.decode(), k)
        self.find.make_automaton()

    def detections(self, words: bytes) -> list[tuple[int, int, int, int]]:
        """(start, end, priority, rule) of every match, the start and end in bytes."""
        tried = {k for _, k in self.find.iter(words.decode())}
        return [
            (m.start() + 1, m.end(), self.rules[i][1], i)
            for k in sorted(tried)
            for i in self.keywords[k]
            for m in self.rules[i][3].finditer(words)
        ]

    def scan(self, text: str | None) -> tuple:
        """The row of a text: words, base places, labels, score and spans."""
        words = plain_words(text)
        places, base = [], set()
        for phrase, label in BASE.items():
            needle, at, word, seen = f" {phrase} ".encode(), -1, 0, 0
            while (at := words.find(needle, at + 1)) >= 0:
                word, seen = word + words.count(b" ", seen, at), at
                places.append(word)
                base.add(label)
        kept = resolve(self.detections(words))
        labels = base | {self.rules[i][0] for *_, i in kept}
        score = max([p for _, _, p, _ in kept] + [BASE_PRIORITY] * bool(places), default=0) / 100
        spans, word, seen = [], -1, 0
        for a, b, _, i in kept:
            word, seen = word + words.count(b" ", seen, a), a
            spans.append({"label": self.rules[i][0], "start": word, "end": word + 1 + words.count(b" ", a, b)})
        return (
            max(0, words.count(b" ") - 1),
            len(places),
            min(places, default=None),
            max(places, default=None),
            ",".join(sorted(base)),
            ",".join(sorted(labels)),
            score,
            spans,
        )


def resolve(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Leave out detections within another of the same or higher priority.

    Longer spans come first at each start, so what holds a span has been seen before it; of
    those, the one that reaches furthest is kept for every priority.
    """
    kept, reach = [], {}
    for a, b, p, i in sorted(found, key=lambda x: (x[0], -x[1], -x[2], x[3])):
        if not any(end >= b for q, end in reach.items() if q >= p):
            kept.append((a, b, p, i))
            reach[p] = max(reach.get(p, 0), b)
    return kept


FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_base", T.LongType()),
    T.StructField("first_word", T.LongType()),
    T.StructField("last_word", T.LongType()),
    T.StructField("base_labels", T.StringType()),
    T.StructField("labels", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField(
        "spans",
        T.ArrayType(
            T.StructType(
                [T.StructField("label", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]
            )
        ),
    ),
]
_SPANS = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_ARROW = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64(), _SPANS]
_SCANNER: list[Scanner] = []


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: words, base places, labels, score, and the spans (in words) of what was kept."""
    plain = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    names = [id_col, *(f.name for f in FIELDS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not _SCANNER:
            _SCANNER.append(Scanner())
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                rows = [_SCANNER[0].scan(t.as_py()) for t in part.column(1)]
                columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(_ARROW)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names)

    return plain.mapInArrow(run, T.StructType([T.StructField(id_col, plain.schema["id"].dataType), *FIELDS]))
