"""Language identification with word-first backoff.

A known word is scored by its log frequency in each language. An unseen word falls back to
the longest of its character n-grams that were seen in training, then to shorter ones, each
step at a discount. A text takes the language with the best mean over its words; the score
is that language's share after a softmax of the means.

Fitting: a bounded sample of labelled rows, at most `max_texts` (or one for each language and
cell, if those are more) and about `max_bytes` of their texts, in equal shares for all languages,
so that a rare one has its rows in it. A language's rows fall into CELLS by a hash of id and text;
each cell gives those with the smallest hash, whole texts, up to its share; repeated rows are taken
once, rows without text or label not at all. Words and n-grams of the sample are counted by Spark, and all of them are kept: what a
model knows is bounded by the sample alone. A term that a language lacks has one value in all
languages, so that few rows of a language do not make what it never had likely.
Scoring reads every row and whole texts.

Null texts and texts without letters give `und` and score 0. With no labelled row at all
every text gives `und`. Ties go to the language first in the alphabet. Repeated rows are
scored each for itself; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "und"
#: Labelled texts a model is fitted on at most, and their bytes.
MAX_TEXTS, MAX_BYTES = 4_000, 32_000_000
#: Parts of a language's rows, each with its share of the sample.
CELLS = 8
#: Times that a term is taken to be seen in a language that lacks it.
UNSEEN = 0.01
LONGEST, BACKOFF = 5, 0.4
#: Unseen words kept with their rows in one task, and texts scored between two results.
MEMO, ROWS = 300_000, 500

# Letters, and the marks that belong to them; digits, fractions and numbers in circles are no letters.
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters."""
    return _WORD.findall(text.lower())


def ngrams(word: str, n: int) -> list[str]:
    """Character n-grams of a word with its ends marked."""
    marked = f"<{word}>"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


@dataclass
class LanguageModel:
    """Log frequencies by language: rows of `table`, found by word or by n-gram."""

    languages: list[str]
    words: dict[str, int]
    grams: dict[str, int]
    table: np.ndarray
    floor: np.ndarray

    def unseen(self, words: list[str]) -> np.ndarray:
        """A row for each word: the mean over its n-grams of the greatest length that is
        known, less the discounts; the floor if none is known."""
        out = np.tile(self.floor, (len(words), 1))
        left = list(range(len(words)))
        for n in range(LONGEST, 0, -1):
            found, sizes, some, rest = [], [], [], []
            for k in left:
                rows = [self.grams[g] for g in ngrams(words[k], n) if g in self.grams]
                if rows:
                    found += rows
                    sizes.append(len(rows))
                    some.append(k)
                else:
                    rest.append(k)
            if some:
                total = np.add.reduceat(self.table[found], np.cumsum([0, *sizes[:-1]]), axis=0)
                out[some] = total / np.array(sizes)[:, None] + (LONGEST + 1 - n) * np.log(BACKOFF)
            left = rest
        return out


class Scorer:
    """A model with the rows of words met so far; one for each task."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.place, self.table = dict(model.words), model.table
        self.bound = len(model.words) + MEMO

    def score(self, texts: list[str | None]) -> list[tuple[str, float]]:
        model = self.model
        found = [words_of(t or "") for t in texts] if model.languages else [[] for _ in texts]
        if len(self.place) > self.bound:
            self.place, self.table = dict(model.words), model.table
        new = list({w for ws in found for w in ws if w not in self.place})
        if new:
            self.place.update(zip(new, range(len(self.table), len(self.table) + len(new)), strict=True))
            self.table = np.concatenate([self.table, model.unseen(new).astype(np.float32)])
        out = []
        for ws in found:
            if not ws:
                out.append((UNKNOWN, 0.0))
                continue
            mean = self.table[[self.place[w] for w in ws]].mean(axis=0, dtype=np.float64)
            share = np.exp(mean - mean.max())
            best = int(mean.argmax())
            out.append((model.languages[best], float(share[best] / share.sum())))
        return out


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words (n is 0) and character n-grams of each language, by batch."""
    for batch in batches:
        counts: dict[tuple[str, int, str], int] = {}
        for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for word in words_of(text):
                key = (lang, 0, word)
                counts[key] = counts.get(key, 0) + 1
        for (lang, _, word), c in list(counts.items()):
            for n in range(1, LONGEST + 1):
                for g in ngrams(word, n):
                    counts[lang, n, g] = counts.get((lang, n, g), 0) + c
        rows = [(*k, v) for k, v in counts.items()]
        names = ["lang", "n", "term", "count"]
        yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], _TERMS)


_TERMS = pa.schema([("lang", pa.string()), ("n", pa.int32()), ("term", pa.string()), ("count", pa.int64())])


def drawn(rows: DataFrame, texts: int, size: int) -> DataFrame:
    """Of each cell of a language its first rows by hash: so many texts at most, and no more once
    those before have `size` bytes. Only hashes and sizes are ranked, and no more than `texts` of a
    cell go to the task that does it; the texts are then read by their hash."""
    keyed = rows.withColumn("draw", F.xxhash64("id", "text", "lang"))
    cell = F.pmod("draw", F.lit(CELLS))
    own = Window.partitionBy("lang", "cell").orderBy("draw")
    sized = keyed.select("lang", cell.alias("cell"), "draw", F.octet_length("text").cast("bigint").alias("bytes"))
    first = sized.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= texts)
    before = F.sum("bytes").over(own.rowsBetween(Window.unboundedPreceding, -1))
    chosen = first.withColumn("before", before).where(F.coalesce("before", F.lit(0)) <= size).select("draw").distinct()
    # Repeated rows have one hash and are taken once.
    found = keyed.join(F.broadcast(chosen), "draw").groupBy("draw").agg(F.min(F.struct("lang", "text")).alias("row"))
    return found.select("row.lang", "row.text")


def fit(
    docs: DataFrame,
    labelled: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    max_texts: int = MAX_TEXTS,
    max_bytes: int = MAX_BYTES,
) -> LanguageModel:
    """Learn from rows where `labelled` holds; what reaches the driver is bounded by the parameters."""
    rows = docs.where(labelled).select(
        docs[id_col].cast("string").alias("id"), docs[lang_col].cast("string").alias("lang"), docs[text_col].alias("text")
    )
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL")
    languages = rows.select("lang").distinct().count()
    if not languages:
        return LanguageModel([], {}, {}, np.zeros((0, 0), np.float32), np.zeros(0))
    sample = drawn(rows, max(1, max_texts // (languages * CELLS)), max_bytes // (languages * CELLS))
    counts = sample.mapInArrow(_terms, "lang string, n int, term string, count bigint")
    by_lang = counts.groupBy("n", "term", "lang").agg(F.sum("count").alias("count"))
    cells = by_lang.groupBy("n", "term").agg(F.collect_list(F.struct("lang", "count")).alias("by_lang"))
    rows = cells.select("n", "term", "by_lang.lang", "by_lang.count").toArrow()
    length, terms = rows["n"].to_numpy(), rows["term"].to_pylist()
    lists = rows["lang"].combine_chunks()
    langs, counts = lists.flatten(), rows["count"].combine_chunks().flatten().to_numpy()
    languages = sorted(langs.unique().to_pylist())
    place = {x: i for i, x in enumerate(languages)}
    table = np.zeros((len(terms), len(languages)))
    own = np.repeat(np.arange(len(terms)), lists.value_lengths().to_numpy())
    np.add.at(table, (own, [place[x] for x in langs.to_pylist()]), counts)
    logs = np.zeros(table.shape, np.float32)
    words: dict[str, int] = {}
    grams: dict[str, int] = {}
    floor = np.zeros(len(languages))
    for n in range(LONGEST + 1):
        at = np.flatnonzero(length == n)
        total = table[at].sum(axis=0) + 1
        seen = np.log(np.maximum(table[at], 1)) - np.log(total)
        logs[at] = np.where(table[at] > 0, seen, np.log(UNSEEN) - np.log(total.max()))
        (grams if n else words).update((terms[i], int(i)) for i in at)
        floor = np.minimum(floor, -np.log(total).mean())
    return LanguageModel(languages, words, grams, logs, floor)


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row."""
    plain = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [id_col, "lang_pred", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(shared.value)
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                langs, shares = zip(*own.score(part.column(1).to_pylist()), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(langs, pa.string()), pa.array(shares, pa.float64())], names
                )

    schema = T.StructType(
        [
            T.StructField(id_col, plain.schema["id"].dataType),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    return plain.mapInArrow(run, schema)
