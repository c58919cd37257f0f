"""Pages with broken tags and comments, and several values in one tagged stretch."""

import random

import numpy as np
import pyarrow.parquet as pq
import pytest

from atelier.llm import html_crf, pii_tagger

PAGES = pq.read_table("/root/testdata/sf0.001/pages.parquet")["html"].to_pylist()


def texts(page):
    return [b[0] for b in html_crf.leaf_blocks(page)]


@pytest.mark.parametrize(
    "page,want",
    [
        ("<p>a</p><!--><p>b</p>", ["a", "b"]),
        ("<p>a</p><!---><p>b</p>", ["a", "b"]),
        ("<p>a</p><!-- x --!><p>b</p>", ["a", "b"]),
        ("<!-- a -- b --><p>x</p>", ["x"]),
        ("<p>a</p><!-- never closed <p>b</p>", ["a"]),
        ('<p class="a"">x</p>', ["x"]),
        ("<a href=x title=don't>y</a> z", ["y z"]),
        ('<img alt=5" src=x>q', ["q"]),
        ("<a title=a<b href=x>t</a>", ["t"]),
        ('<p>a<b title = "x > y">c</b></p>', ["ac"]),
        ('<p title=">x</p><p>y</p>', ["x", "y"]),
        ("<template>1<template>2</template>3</template><p>k</p>", ["k"]),
        ("<svg><svg/><svg></svg><text>h</text></svg><p>k</p>", ["k"]),
        ("<svg>never closed <p>k</p>", []),
        ("<p>a < b and 3 <4</p>", ["a < b and 3 <4"]),
        ("<p>x</p></><p>y</p></ foo><p>z", ["x", "y", "z"]),
        ('<p>x <a href="u', ["x"]),
        ("<script>a</script x><p>y", ["y"]),
        ("<![CDATA[x]]><?xml ?>b", ["b"]),
        ('<div title="class=sidebar">t</div>', ["t"]),
    ],
)
def test_broken_markup(page, want):
    assert texts(page) == want


def test_a_value_is_no_attribute():
    assert not html_crf._read_marks(' title="class=sidebar id=nav hidden"')
    assert html_crf._read_marks(" CLASS='side sidebar' hidden") == {"class:sidebar", "hidden"}


def test_stray_quotes_and_comments_change_no_text():
    rng = random.Random(4)
    for page in PAGES:
        want = texts(page)
        ends = [m.end() - 1 for m in html_crf._TOKEN.finditer(page) if m[2] and not m[1] and m[2].lower() not in html_crf.RAW and page[m.end() - 2] not in "=/"]
        for k in sorted(rng.sample(ends, min(8, len(ends))), reverse=True):
            page = page[:k] + rng.choice([' "', " '", ' x"', " don't", "\n'"]) + page[k:]
        assert texts(page) == want
        open_ = [m.end() for m in html_crf._TOKEN.finditer(page) if m[2] and m[2].lower() == "p" and not m[1]]
        for k in sorted(rng.sample(open_, min(4, len(open_))), reverse=True):
            page = page[:k] + rng.choice(["<!-->", "<!--->", "<!-- <p>no --!>", "<!---->"]) + page[k:]
        assert texts(page) == want


@pytest.mark.parametrize("evil", ["<a ", '<a ="', "<!--", "<!", "<svg>", "<a ='\">", "</", "<p =", "<template>"])
def test_reading_stays_linear(evil):
    assert isinstance(texts(evil * 100_000), list)


# --- several values in a stretch

CASES = [
    ("email", "jane_doe at example.org or jane.smith[at]mail.example.net", ["jane_doe at example.org", "jane.smith[at]mail.example.net"]),
    ("email", "bob＠example.com or bob AT example DOT com", ["bob＠example.com", "bob AT example DOT com"]),
    ("email", "a1@b.co, c2@d.org; e3@f.net", ["a1@b.co", "c2@d.org", "e3@f.net"]),
    ("ip", "10.0.0.1 and 192.168.1.254, 8.8.8.8", ["10.0.0.1", "192.168.1.254", "8.8.8.8"]),
    ("ip", "10.0.0.1", ["10.0.0.1"]),
    ("phone", "+49 30 1234567, +49 89 7654321", ["+49 30 1234567", "+49 89 7654321"]),
    ("phone", "(030) 123 4567", ["(030) 123 4567"]),
    ("phone", "123", []),
    ("card", "4111 1111 1111 1111 or 5500 0000 0000 0004", ["4111 1111 1111 1111", "5500 0000 0000 0004"]),
]


@pytest.mark.parametrize("kind,text,want", CASES)
def test_every_value_of_a_stretch(kind, text, want):
    lead = "x: "
    found = pii_tagger.checked(lead + text + " .", kind, len(lead), len(lead) + len(text))
    assert [(lead + text)[a:b] for _, a, b in found] == want


def test_hints_do_not_depend_on_other_letters():
    for lead in ("Istanbul", "İstanbul", "ẞ ŉ ǰ İİ", ""):
        for form in ("mail john (at) example (dot) com", "mail john [ AT ] example.com", "mail john at example dot com", "mail john At example.com"):
            text = f"{lead}: {form} now"
            got = pii_tagger.hints(text, pii_tagger.codes(text))
            assert len(got) == 1 and text[got[0] : got[0] + 5].strip(" ([").lower().startswith("at")
    assert not len(pii_tagger.hints("she sat at home. Then dots", pii_tagger.codes("she sat at home. Then dots")))
    assert np.all(np.diff(pii_tagger.hints("1 (at) 2 at x.y", pii_tagger.codes("1 (at) 2 at x.y"))) > 0)


def test_the_pipeline_leaves_what_its_result_reads(spark, tmp_path):
    import os

    import corpus_pipeline
    from atelier.functions.shared import shared_dir

    top = shared_dir(spark).removeprefix("file://") + "/atelier"
    pii_tagger.stored(spark)
    before = set(os.listdir(top))
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    left = set(os.listdir(top)) - before
    assert len(left) == 1 and next(iter(left)).startswith("lengths-")
    assert out.count() > 50 and out.count() == out.select("doc_id").distinct().count()


def test_a_failed_join_leaves_nothing(spark, monkeypatch):
    import os

    from atelier.functions.shared import shared_dir
    from atelier.llm import chosen_path

    top = shared_dir(spark).removeprefix("file://") + "/atelier"
    os.makedirs(top, exist_ok=True)
    before = set(os.listdir(top))

    def fails(*_):
        raise RuntimeError("no more")

    monkeypatch.setattr(chosen_path, "_compare", fails)
    docs = spark.createDataFrame([(k, "one two three four five six seven " * 3 + str(k % 2)) for k in range(6)], "doc_id long, text string")
    with pytest.raises(RuntimeError):
        chosen_path.jaccard_join(docs)
    assert set(os.listdir(top)) == before
