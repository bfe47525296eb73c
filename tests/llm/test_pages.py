"""Corpus operators over pages, and the pipeline."""

import gzip
import hashlib
import html
import re
import time
from functools import partial

import corpus_pipeline
import numpy as np
import pytest

from scorewatch.llm import pages, warc
from scorewatch.llm.queries import QUERIES
from scorewatch.operators.ordered import previous_row, running_sums
from test_documents import components_by_force

PAGE = "page_id bigint, url string, html string, host string, digest string"


def site(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], PAGE)


def rows_by_id(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


# --- extraction --------------------------------------------------------------------


def test_articles_are_extracted(spark, sf_dir):
    found = {r.page_id: r.text for r in QUERIES["op6_html_extraction"](spark, sf_dir).collect()}
    for p in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        article = re.sub(r"</?(?:b|i|a|em)\b[^>]*>", "", re.search(r"<article>(.*)</article>", p.html, re.S)[1])
        assert found[p.page_id] == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", article)).split())


def length_by_table(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_common_lines_are_a_longest_common_subsequence():
    draw = np.random.default_rng(4)
    for _ in range(500):
        a, b = (list(draw.choice(list("abcd"), draw.integers(0, 10))) for _ in range(2))
        found, rest = sorted(pages.common_lines(a, b)), iter(b)
        assert len(found) == length_by_table(a, b) and all(a[i] in rest for i in found)


@pytest.mark.parametrize(
    ("page", "lines"),
    [
        ("<p>a <b>b</b>c</p><p>d", ["a bc", "d"]),
        ("<nav><ul><li>menu</ul></nav><p>x &amp;amp; y&nbsp;z", ["x &amp; y z"]),
        ("<div class='side-bar'>keep</div><div class=sidebar><div>no</div>no</div>yes", ["keep", "yes"]),
        ("<script>if (a<b) '</p>'</script><style>p{}</style><!-- <p>no</p> --><p>yes<br>too", ["yes too"]),
        ('<p title="a>b">x</p><form>no</form><footer>no</footer>', ["x"]),
        ("<section id=comments><p>no</section><p>yes</p><nav>never closed", ["yes"]),
        ("a < b and <3", ["a < b and <3"]),
        ('<article><p>Body</p><article class="comment"><p>reader comment</p></article><p>more</article>', ["Body", "more"]),
        ('<article>Body</article><article class="comment">reader comment</article>', ["Body"]),
        ('<article><p>body text</p><div class="comments"><p>a longer comment of a reader<p>and another longer one</div></article>', ["body text"]),
        ("<aside><article>teaser</article></aside><article>Body</article>", ["Body"]),
        ("<nav><article>teaser</article></nav><p>x</p>", ["x"]),
        ("<section id=comments-area><article class='comment odd'>by a reader</article></section><article>Body</article>", ["Body"]),
        ("<article class=comment>by a reader</article><p>tail</p>", ["tail"]),
        ("<nav>menu without an end<article>Body</article>", ["Body"]),
        ("", []),
    ],
)
def test_lines(page, lines):
    assert [x.text for x in pages.lines_of(page)] == lines


@pytest.mark.parametrize(
    ("page", "lines"),
    [
        ('<html class="sidebar"><body class="has-sidebar search"><p>text of the page</p></body></html>', ["text of the page"]),
        ('<div id="page" class="with-ads"><p>a</p><div class="ad">buy</div><p>rest of it</p></div>', ["a", "rest of it"]),
        ('<article><div class="entry no-comments"><p>body</p></div></article>', ["body"]),
        ('<article><h1>head</h1><div class="entry comments"><p>the whole body</p></div></article>', ["head", "the whole body"]),
        ('<form id=all><p>nearly all of the text</p><div class=social-links>x y</div></form><p>end', ["nearly all of the text", "end"]),
        ('<div class="sidebar wide"><div><p>most of the text</p></div></div><p>less</p>', ["most of the text", "less"]),
        ('<p>the text itself</p><div class="related-posts">other<div>x</div></div> on <span class="ad">z</span>', ["the text itself", "on"]),
    ],
)
def test_wrappers_stay(page, lines):
    assert [x.text for x in pages.lines_of(page)] == lines


def test_an_article_before_main_is_no_part_of_it():
    page = "<article>teaser</article><main><h1>Title</h1><article>Body</article></main>"
    assert [x.text for x in pages.lines_of(page) if x.main] == ["Title", "Body"]


@pytest.mark.parametrize("piece", ["<a ", '<a "', "<a '\"", "<div class='", "</a ", "<!--<a ", "<script "])
def test_a_page_of_unclosed_tags_is_read_in_one_go(piece):
    began = time.monotonic()
    pages.lines_of(piece * (1_000_000 // len(piece)))
    assert time.monotonic() - began < 5


def test_template_of_the_nearest_page_goes(spark):
    rows = [
        (1, "http://h/a/1", "<p>Site head</p><p>first story</p><p>Site end</p>"),
        (2, "http://h/a/2", "<p>Site head</p><p>second story</p><p>Site end</p>"),
        (3, "http://other/a/2", "<p>Site head</p><p>third</p>"),
        (4, "http://h/b", "<p>Site head</p><article><p>Site end</p></article>"),
        (5, "http://c/1", "<p>copy</p>"),
        (6, "http://c/2", "<p>copy</p>"),
        (7, None, None),
        (None, None, "<p>no id"),
    ]
    found = {r.page_id: r.text for r in pages.main_text(site(spark, rows).coalesce(1)).collect()}
    assert found[1] == "first story" and found[2] == "second story" and found[3] == "Site head third"
    assert found[4] == "Site end" and found[5] == found[6] == "copy" and found[7] == "" and found[None] == "no id"
    assert pages.main_text(site(spark, [])).count() == 0


@pytest.mark.parametrize("parts", [1, 7])
def test_neighbours_lie_beyond_copies_and_partitions(spark, monkeypatch, parts):
    """Five copies between other pages, and each page alone in its partition."""
    page = "<p>Site head</p><p>{}</p><p>Site end</p>"
    rows = [(k, f"http://h/a/{k}", page.format("copy" if 2 <= k <= 6 else f"story {k}")) for k in range(1, 9)]
    rows += [(9, "http://h/a/9", "<article>own</article>"), (10, "http://i/1", page.format("alone"))]
    if parts > 1:
        monkeypatch.setattr(pages, "previous_row", partial(previous_row, ranges=4))
        monkeypatch.setattr(pages, "running_sums", partial(running_sums, ranges=4))
    found = pages.main_text(site(spark, rows).repartition(parts)).collect()
    want = {k: "copy" if 2 <= k <= 6 else f"story {k}" for k in range(1, 9)} | {9: "own", 10: "Site head alone Site end"}
    assert {r.page_id: r.text for r in found} == want and len(found) == 10
    assert all(r.n_chars == len(r.text) for r in found)


# --- archives ----------------------------------------------------------------------


def test_archives_are_read_back_by_offset(spark):
    long = "<p>" + "é" * 60
    rows = [
        (3, "http://h/1", long), (1, "http://h/2\r\nX: y", long), (1, None, long), (None, "u", long), (4, "u", "short"),
        (5, "u", "short"), (6, "u", None), (7, "u", "\r\n\r\nWARC/1.1\r\nContent-Length: 9\r\n\r\n" * 9),
    ]
    made = warc.normalise(warc.write_archives(warc.plan(site(spark, rows))))
    found = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.read_records(made).collect()), key=str)
    assert found == sorted(
        [(3, 123, "revisit", 1), (1, 123, "response", None), (1, 123, "response", None), (None, 123, "revisit", 1),
         (4, 5, "response", None), (5, 5, "response", None), (6, 0, "response", None), (7, 315, "response", None)],
        key=str,
    )
    for r in made.collect():
        for e in r["index"]:
            raw = gzip.decompress(bytes(r.data)[e.offset : e.offset + e.length])
            assert warc.parse(raw)[0]["WARC-Record-ID"] == e.record_id
        assert b"".join(warc.records(bytes(r.data))) == gzip.decompress(bytes(r.data))
    assert warc.read_records(warc.normalise(warc.write_archives(warc.plan(site(spark, []))))).count() == 0


def test_a_cut_archive_is_an_error():
    raw = warc.record(1, "u", b"payload", 7, hashlib.sha256(b"payload").hexdigest(), None)
    with pytest.raises(ValueError, match="inside a record"):
        warc.normalised(gzip.compress(raw + raw[:-20]))
    whole = gzip.compress(raw) + gzip.compress(raw)
    assert len(warc.normalised(whole)[1]) == 2 and warc.normalised(b"") == (b"", [])
    for lost in (1, 8, 9):
        with pytest.raises(ValueError, match="last gzip member"):
            warc.normalised(whole[:-lost])


# --- pipeline ----------------------------------------------------------------------


def test_pipeline_stages(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").cache()
    columns = docs.columns
    good = corpus_pipeline.good_quality(spark, docs, sf_dir).cache()
    assert good.columns == columns
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    there = {r.doc_id for r in good.select("doc_id").collect()}
    assert np.mean([(k in there) == (y == 1) for k, y in label.items()]) > 0.97

    few = docs.where("doc_id < 300").cache()
    near = corpus_pipeline.near_dedup(spark, few, sf_dir)
    force = components_by_force([(r.doc_id, r.text or "") for r in few.collect()], 5, 80)
    assert near.columns == columns and {r.doc_id for r in near.collect()} == {k for k, v in force.items() if v[2]}

    cut = corpus_pipeline.substring_dedup(spark, few, sf_dir).cache()
    before, after = ({r.doc_id: r for r in x.collect()} for x in (few, cut))
    digest = {r.doc_id: r.n_removed for r in QUERIES["op7_substring_dedup"](spark, sf_dir).collect()}
    assert cut.columns == columns and set(before) == set(after)
    for k, r in after.items():
        assert r.n_chars == len(r.text) and len(before[k].text.split()) - len(r.text.split()) <= digest[k]

    clean = corpus_pipeline.decontaminated(spark, docs, sf_dir)
    leaked = {r.doc_id for r in QUERIES["op5_decontamination"](spark, sf_dir).collect()}
    assert clean.columns == columns
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect()} - leaked
    assert rows_by_id(corpus_pipeline.encoded(spark, few, sf_dir)).keys() == set(before)


def test_pipeline_runs_on_odd_rows(spark, docs, sf_dir):
    from llm_cases import ODD

    for name, step in corpus_pipeline.STAGES:
        for rows in (ODD, []):
            out = step(spark, docs(rows), sf_dir)
            assert out.count() <= len(rows), name
