"""Prefix hashes and document fingerprints against plain string work."""

import hashlib
import random

import pytest

from llm_cases import ODD
from scorewatch.llm import prefixes
from scorewatch.llm.prefixes import Fingerprint, Prefixes, extension, fingerprint, likeness
from scorewatch.llm.queries import QUERIES


def of(text):
    return fingerprint(Prefixes.of(text))


def test_spans_and_extensions_equal_plain_strings():
    rng = random.Random(1)
    for _ in range(60):
        a, b = ("".join(rng.choice("abé漢😀"[: rng.choice([2, 5])]) for _ in range(rng.randint(1, 60))) for _ in "ab")
        p, q = Prefixes.of(a), Prefixes.of(b)
        i, j = rng.randrange(len(a)), rng.randrange(len(b))
        common = next((k for k in range(min(len(a) - i, len(b) - j)) if a[i + k] != b[j + k]), min(len(a) - i, len(b) - j))
        assert extension(p, i, q, j) == common
        for _ in range(20):
            size = rng.randint(0, min(len(a), len(b)))
            i, j = rng.randint(0, len(a) - size), rng.randint(0, len(b) - size)
            assert (p.span(i, i + size) == q.span(j, j + size)) == (a[i : i + size] == b[j : j + size])
        made = p.joined(i, q, j)
        assert all((x == y).all() for x, y in zip(made.lanes, Prefixes.of(a[:i] + b[:j]).lanes))


def test_made_texts_do_not_collide():
    """A Thue-Morse word and its complement collide modulo powers of two, whatever the base."""
    word = "a"
    for _ in range(12):
        word += word.translate({97: 98, 98: 97})
    other = word.translate({97: 98, 98: 97})
    assert Prefixes.of(word).span(0, len(word)) != Prefixes.of(other).span(0, len(word))
    assert of("a") != of("aa") != of("\x00aa") and of("") != of("\x00")


def test_likeness():
    rng = random.Random(2)
    text = " ".join(f"w{rng.randrange(9000)}" for _ in range(900))
    other = " ".join(f"v{rng.randrange(9000)}" for _ in range(900))
    half = len(text) // 2
    f = of(text)
    assert f == of(str(text)) and likeness(f, f) == 1 and Fingerprint.parse(str(f)) == f
    assert 0.4 <= likeness(f, of(text[:half] + other[:half])) <= 0.65
    assert 0.4 <= likeness(f, of(other[:half] + text[half:])) <= 0.65
    assert likeness(f, of(other)) < 0.1
    # One letter changed; halves swapped; many places changed.
    assert 0.8 < likeness(f, of(text[:half] + "#" + text[half + 1 :])) < 1
    assert likeness(f, of(text[half:] + text[:half])) > 0.8
    words = [w if i % 40 else "new" for i, w in enumerate(text.split())]
    assert 0.5 < likeness(f, of(" ".join(words))) < 1
    assert likeness(of(""), of("")) == 1 and likeness(of(""), f) == likeness(f, of("")) == 0
    assert likeness(of("a" * 5000), of("a" * 5001)) < 1
    pairs = [(of(a), of(b)) for a in (text, other, "x", "", text[:99]) for b in (text, other, "x", "", text[:99])]
    assert all(likeness(a, b) == likeness(b, a) and 0 <= likeness(a, b) <= 1 for a, b in pairs)


def by_force(rows):
    """Lines of `edits` by plain slices; rows are (id, text) in any order with distinct keys."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for (k, text), (_, following) in zip(order, [*order[1:], order[0]], strict=True):
        text, following = text or "", following or ""
        n = len(text)
        edited = text[: n - n // 2] + following[: n // 2]
        f, e, g = of(text), of(edited), of(following)
        out.append((k, n, hashlib.sha256(edited.encode()).hexdigest(), str(f), str(e), likeness(f, e), likeness(f, g)))
    return sorted(out, key=str)


def test_edits_of_the_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = [tuple(r) for r in QUERIES["op12_document_fingerprints"](spark, sf_dir).collect()]
    assert sorted(found, key=str) == by_force(rows)
    # Half of a text is shared with its edited one.
    long = [r for r in found if r[1] >= 200]
    assert all(r[5] >= 0.35 for r in long)
    assert {r[3]: r[0] for r in found}.keys() == {str(of(t or "")) for _, t in rows}


@pytest.mark.parametrize("rows_of_a_part", [1, 3, 100])
def test_edits_across_partitions_and_odd_rows(spark, docs, rows_of_a_part):
    rows = [r for i, r in enumerate(ODD) if i != 6]
    found = prefixes.edits(docs(rows).repartition(3), part_rows=rows_of_a_part).collect()
    assert sorted(map(tuple, found), key=str) == by_force(rows)


def test_repeated_rows_one_row_and_none(spark, docs):
    found = prefixes.edits(docs([(1, "ab"), (1, "ab"), (1, "cd")]), part_rows=1).collect()
    assert len(found) == 3 and {r.doc_id for r in found} == {1}
    own = prefixes.edits(docs([(4, "abcd")])).first()
    assert own.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and own.near_next == 1
    assert prefixes.edits(docs([])).count() == 0
    plain = {r.doc_id: (r.n_chars, r.fingerprint) for r in prefixes.fingerprints(docs(ODD)).collect()}
    assert plain[1] == plain[2] == (0, str(of(""))) and plain[5] == plain[6] == plain[None]
