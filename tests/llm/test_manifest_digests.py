"""The registered manifest: columns are framed by their length, digests stand end to end."""

import hashlib
import zlib

from scorewatch.llm.queries import QUERIES

LOW = {i: i + 32 for i in range(65, 91)}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def up(nodes):
    """Every 16 consecutive digests become the hash of their hex text, until one is left."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def runs(levels, at):
    """(place in its run, the others of it) for each level below the top."""
    for level in levels[:-1]:
        run = level[at - at % 16 : at - at % 16 + 16]
        yield at % 16, run[: at % 16] + run[at % 16 + 1 :]
        at //= 16


def by_force(rows):
    order = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    own = {s: sorted(r for r in rows if r[1] == s) for s in order}
    trees = {s: up([leaf_of(r) for r in own[s]]) for s in order}
    top = up([trees[s][-1][0] for s in order])
    root, out = top[-1][0], {}
    for i, s in enumerate(order):
        for at, r in enumerate(own[s]):
            path = [*runs(trees[s], at), *runs(top, i)]
            text = r[4].translate(LOW) if r[4] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 else r[4]
            node = leaf_of((*r[:4], text))
            for k, others in path:
                node = sha("".join([*others[:k], node, *others[k:]]))
            proof = sha("".join(d for _, others in path for d in others))
            out[r[0]] = (r[0], leaf_of(r), trees[s][-1][0], root, proof, node, node == root)
    return out


def manifest_of(spark, path, rows):
    schema = "doc_id bigint, source string, lang string, n_chars bigint, text string"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{path}/documents.parquet")
    return {r.doc_id: tuple(r) for r in QUERIES["op11_merkle_manifest"](spark, str(path)).collect()}


def test_two_rows_written_out(spark, tmp_path):
    a, b = sha("1:11:s-1:31:X"), sha("1:21:s2:en--")
    found = manifest_of(spark, tmp_path, [(1, "s", None, 3, "X"), (2, "s", "en", None, None)])
    # Neither 1 nor 2 is tampered with; a tree of one source has no level of its own.
    assert found == {1: (1, a, sha(a + b), sha(a + b), sha(b), sha(a + b), True), 2: (2, b, sha(a + b), sha(a + b), sha(a), sha(a + b), True)}


def test_sources_of_many_sizes(spark, tmp_path):
    """A lone leaf, runs of one, three levels, no source, and more sources than one run holds."""
    sizes = {None: 18, "": 1, "a": 16, "b": 17, "é": 257, "\U0001f600": 33, "￮": 2} | {f"s{i}": 1 + i % 3 for i in range(20)}
    texts = [None, "", "Abc", "no capitals", "É and \U0001f600 Z", "X y\n" * 30]
    rows, k = [], -40
    for source, n in sizes.items():
        for i in range(n):
            k += 1
            rows.append((k, source, None if i % 5 else "en", i or None, texts[k % 6]))
    found = manifest_of(spark, tmp_path, rows)
    assert found == by_force(rows)
    assert {r[6] for r in found.values()} == {True, False}
