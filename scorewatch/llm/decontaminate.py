"""Benchmark decontamination by spaced seeds, with DataFrame functions only.

A seed is a window of words of which a mask looks at some positions and ignores the others,
so that a substituted word under a hole changes nothing. Seeds of all benchmark items and of
all texts are joined; each hit puts an item on a text at one offset. Around the hit the
item's words are compared with the text's at that offset: an overlap is verified when a
stretch of them has `least` equal words (all words of a shorter item), and these are at least
`percent` of the stretch.

Words are lower-cased `[^\\x20\\x09-\\x0D]+`. An item shorter than a seed is looked for whole: with
ALONE words or more where they stand consecutively in a text, with fewer where they are all of
a text (such an item, "yes" for instance, says nothing inside of one). Null or empty texts and
items match nothing; items of equal words are found alike; a row without an id matches nothing.
Repeated rows of a text give one row each for an id. Other columns are ignored, whatever their names.

Recall: an overlap needs one seed all of whose looked-at words are equal. Over all places of the
replaced words, all items of 14 to 16 words with 13 equal ones have one, and 0.9996 of those of 17.

Scale: items of equal words are one content. The distinct seeds of contents are broadcast while
there are at most MAX_BROADCAST (counted first; 8 bytes each), and texts' seeds that are none of
them go no further, so that only hits are shuffled. Places and words of contents are joined without a
hint. Beyond the bound every seed of every text is shuffled. A passage that very many texts hold
makes as many hits as texts, joined with one content.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Positions that a mask looks at, of a window of 9 words: of all threes of masks of five
#: positions that begin and end the window, one that finds the most overlaps (see Recall).
MASKS = ((0, 1, 2, 5, 8), (0, 2, 3, 4, 8), (0, 5, 6, 7, 8))
SPAN = 9
#: Words of an item that is looked for inside of texts.
ALONE = 5
LEAST, PERCENT = 13, 75
MAX_BROADCAST = 200_000


def words_of(text: Column) -> Column:
    """Lower-cased words (letters of every alphabet); a null text has none."""
    plain = F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\f\r", "     "), " +", " ")
    return F.filter(F.split(F.lower(plain), " "), lambda w: w != "")


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _shifted(h: Column, n: Column) -> Column:
    """One struct for each start of a window: its words' hashes w0, w1, ..."""
    return F.arrays_zip(*(F.slice(h, F.lit(k + 1), F.greatest(n - (SPAN - 1), F.lit(0))).alias(f"w{k}") for k in range(SPAN)))


def _seeds(df: DataFrame, key: str) -> DataFrame:
    """(key, at, seed) of every window and mask of the arrays in `h`."""
    n = F.size("h")
    rows = df.select(key, F.posexplode(_shifted(F.col("h"), n)).alias("at", "w"))
    each = [
        F.xxhash64(F.lit(m), *(F.col(f"w.w{k}") for k in mask)) for m, mask in enumerate(MASKS)
    ]
    return rows.select(key, "at", F.explode(F.array(*each)).alias("seed"))


def _pieces(df: DataFrame, key: str, lengths: list[int]) -> DataFrame:
    """(key, at, seed) of every place where an item of one of these numbers of words may stand whole."""
    n, none = F.size("h"), F.array().cast("array<struct<at: int, seed: bigint>>")

    def of_length(size: int) -> Column:
        here = n >= size if size >= ALONE else n == size
        made = F.transform(
            F.sequence(F.lit(0), F.greatest(n - size, F.lit(0))),
            lambda i: F.struct(i.alias("at"), F.xxhash64(F.lit(-size), F.slice("h", i + 1, F.lit(size))).alias("seed")),
        )
        return F.when(here, made).otherwise(none)

    rows = df.select(key, F.explode(F.concat(none, *map(of_length, lengths))).alias("p"))
    return rows.select(key, "p.at", "p.seed")


def overlaps(
    docs: DataFrame,
    items: DataFrame,
    least: int = LEAST,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(id, item, matched_words, compared_words, first_word) of verified overlaps: the best
    offset of each item in each text, first_word being where it begins in the text."""
    asked = items.select(items[item_col].alias("item"), words_of(items[item_text_col]).alias("words"))
    asked = asked.where(F.col("item").isNotNull() & (F.size("words") > 0)).withColumn("h", _hashes(F.col("words")))
    asked = asked.select("item", "h").distinct()
    contents = asked.groupBy("h").agg(F.min("item").alias("content"))
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).where(
        F.col("id").isNotNull() & F.col("text").isNotNull()
    )
    hashed = texts.select("id", _hashes(words_of(F.col("text"))).alias("h"))
    # At most SPAN - 1 numbers.
    lengths = sorted(r[0] for r in contents.select(F.size("h")).where(F.size("h") < SPAN).distinct().collect())
    seeds, asking = _seeds(contents, "content"), _seeds(hashed, "id")
    if lengths:
        short = contents.where(F.size("h") < SPAN)
        seeds = seeds.union(_pieces(short, "content", lengths).where("at = 0"))
        asking = asking.union(_pieces(hashed, "id", lengths))
    known = seeds.select("seed").distinct()
    if known.count() <= MAX_BROADCAST:
        asking = asking.join(F.broadcast(known), "seed", "left_semi")
    places = seeds.select("seed", F.col("content").alias("item"), F.col("at").alias("item_at"))
    hits = asking.join(places, "seed").select("id", "item", (F.col("at") - F.col("item_at")).alias("offset"))
    hits = hits.distinct()

    by_text = hits.groupBy("id").agg(F.collect_set(F.struct("item", "offset")).alias("hits"))
    placed = texts.join(by_text, "id").select("id", _hashes(words_of(F.col("text"))).alias("h"), "hits")
    placed = placed.select("id", "h", F.explode("hits").alias("hit"))
    own = contents.select(F.col("content").alias("item"), F.col("h").alias("own"))
    side = placed.select("id", "h", "hit.item", "hit.offset").join(own, "item")
    start, end = F.greatest("offset", F.lit(0)), F.least(F.col("offset") + F.size("own"), F.size("h"))
    x, y = F.slice("h", start + 1, end - start), F.slice("own", start - F.col("offset") + 1, end - start)
    side = side.select("id", "item", start.alias("start"), F.size("own").alias("n"), F.zip_with(x, y, lambda a, b: a == b).alias("same"))
    enough = F.least(F.lit(least), "n")
    side = side.where(F.size(F.filter("same", lambda x: x)) >= enough)
    checked = side.select("id", "item", "start", "n", stretch(F.col("same"), percent).alias("s"))
    good = checked.where(F.col("s.best_equal") >= enough)
    members = asked.join(contents, "h").select("item", "content")
    best = _best(good, "id", "content").join(members, "content")
    return best.select(
        F.col("id").alias(id_col), F.col("item").alias(item_col), "matched_words", "compared_words", "first_word"
    )


def stretch(same: Column, percent: int) -> Column:
    """The stretch of an array of equal / different with the most equal words of all those in which
    at least `percent` are equal; of ties the shortest, then the first.

    Such a stretch begins and ends with an equal word. Word k of the equal ones, at place p, begins
    one at height 100 k - percent p and ends one at 100 (k + 1) - percent (p + 1); a stretch has
    its share if its end is not below its begin. In falling order of heights the furthest end so
    far is therefore the furthest end of each begin. Fields: best_equal, best_from, best_to (end
    exclusive).
    """
    kind = "struct<far: int, far_to: int, best_equal: int, best_from: int, best_to: int>"
    zero = F.struct(*(F.lit(x) for x in (-1, 0, 0, 0, 0))).cast(kind)

    def marks(places: Column, end: int) -> Column:
        """(-height, 0 for an end, number of the equal word, its place)."""
        return F.transform(
            places,
            lambda p, k: F.struct(
                (percent * (p + end) - 100 * (k + end)).alias("down"), F.lit(1 - end).alias("begin"), k.alias("k"), p.alias("p")
            ),
        )

    def step(s: Column, m: Column) -> Column:
        further = (m["begin"] == 0) & (m["k"] > s["far"])
        count, size, best_size = s["far"] - m["k"] + 1, s["far_to"] - m["p"], s["best_to"] - s["best_from"]
        fewer = (size < best_size) | ((size == best_size) & (m["p"] < s["best_from"]))
        better = (m["begin"] == 1) & ((count > s["best_equal"]) | ((count == s["best_equal"]) & fewer))
        return F.struct(
            F.when(further, m["k"]).otherwise(s["far"]).alias("far"),
            F.when(further, m["p"] + 1).otherwise(s["far_to"]).alias("far_to"),
            F.when(better, count).otherwise(s["best_equal"]).alias("best_equal"),
            F.when(better, m["p"]).otherwise(s["best_from"]).alias("best_from"),
            F.when(better, s["far_to"]).otherwise(s["best_to"]).alias("best_to"),
        ).cast(kind)

    places = F.filter(F.transform(same, lambda x, i: F.when(x, i)), lambda i: i.isNotNull())
    # The places are bound by a lambda, so that they are made once.
    found = F.transform(
        F.array(places),
        lambda at: F.aggregate(F.array_sort(F.concat(marks(at, 1), marks(at, 0))), zero, step),
    )
    return found[0]


def _best(good: DataFrame, id_col: str, item_col: str) -> DataFrame:
    """One row for each text and item: most equal words, then the first place."""
    place = F.col("start") + F.col("s.best_from")
    size = F.col("s.best_to") - F.col("s.best_from")
    best = good.groupBy("id", "item").agg(
        F.max(F.struct(F.col("s.best_equal").alias("equal"), (-place).alias("place"), size.alias("size"))).alias("b")
    )
    return best.select(
        F.col("id").alias(id_col),
        F.col("item").alias(item_col),
        F.col("b.equal").cast("bigint").alias("matched_words"),
        F.col("b.size").cast("bigint").alias("compared_words"),
        (-F.col("b.place")).cast("bigint").alias("first_word"),
    )
