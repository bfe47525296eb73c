"""The Merkle manifest against a manifest built in one process."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from scorewatch.llm import merkle
from scorewatch.llm.queries import QUERIES, remainder

LOW = {i: i + 32 for i in range(65, 91)}


def h(values):
    framed = ("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)
    return hashlib.sha256("".join(framed).encode()).hexdigest()


def tree_by_force(nodes):
    """Root, and per node the runs above it as (place, run)."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for i, k in enumerate(at):
            first = k - k % 16
            paths[i].append((k % 16, level[first : first + 16]))
        level, at = [h(level[i : i + 16]) for i in range(0, len(level), 16)], [k // 16 for k in at]
    return level[0], paths


def manifest_by_force(rows):
    by_source = {}
    for k, source, lang, n_chars, text in rows:
        by_source.setdefault(source, []).append((k, h((k, source, lang, n_chars, text)), text, (source, lang, n_chars)))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    made = {s: sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, r[1])) for s in order}
    trees = {s: tree_by_force([r[1] for r in made[s]]) for s in order}
    root, over = tree_by_force([trees[s][0] for s in order])
    out = []
    for s, above in zip(order, over, strict=True):
        for (k, leaf, text, (source, lang, n_chars)), path in zip(made[s], trees[s][1], strict=True):
            node = leaf
            if k is not None and zlib.crc32(str(k).encode()) % 5 == 0:
                node = h((k, source, lang, n_chars, text and text.translate(LOW)))
            proof = []
            for at, run in path + above:
                others = run[:at] + run[at + 1 :]
                proof += others
                node = h(others[:at] + [node] + others[at:])
            out.append((k, leaf, trees[s][0], root, h(proof), node, node == root))
    return out


def same(found, rows):
    key = lambda r: tuple(str(x) for x in r)
    return sorted(map(tuple, found.collect()), key=key) == sorted(manifest_by_force(rows), key=key)


COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def test_manifest_of_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select(*COLUMNS).collect()]
    assert same(QUERIES["op11_merkle_manifest"](spark, sf_dir), rows)


@pytest.mark.parametrize("local", [1, 2])
def test_a_hot_source_beside_small_ones(spark, local):
    """Sources of 1, 16, 17, 256, 257 and 700 rows and no source; nulls, odd texts, repeated ids and rows."""
    sizes = {"a": 1, "b": 16, "c": 17, "é": 256, "": 257, "hot": 700, None: 40}
    rows, k = [], 0
    for source, n in sizes.items():
        for i in range(n):
            k += 1
            text = [None, "", "Abc", "no capitals", "É" * 40, "X y\n" * 300][i % 6]
            rows.append((None if i % 97 == 50 else k - (i % 31 == 7), source, None if i % 5 else "en", i or None, text))
    rows += [rows[5]] * 3
    extra = "key int, place string, node int, one int, leaf int, id int"
    schema = f"doc_id bigint, source string, lang string, n_chars bigint, text string, {extra}"
    docs = spark.createDataFrame([(*r, 1, "x", 2, 3, 4, 5) for r in rows], schema).repartition(6)
    assert same(merkle.manifest(docs, remainder(5) == 0, local=local), rows)


def test_one_row_and_none(spark):
    docs = spark.createDataFrame([(5, None, None, None, None)], "doc_id int, source string, lang string, n_chars bigint, text string")
    found = merkle.manifest(docs, remainder(5) == 0)
    assert same(found, [(5, None, None, None, None)]) and dict(found.dtypes)["doc_id"] == "int"
    assert merkle.manifest(docs.limit(0), remainder(5) == 0).count() == 0


def test_tampering_is_seen(spark):
    rows = [(k, "s", "en", 1, "Text" if k % 2 else "text") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    found = merkle.manifest(docs, F.lit(True))
    assert {r.doc_id for r in found.collect() if r.verified} == set(range(0, 40, 2))
