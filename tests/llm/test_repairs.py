"""Cases in which text was lost: repeated ids, odd quotes in tags, clashing columns."""

import random

import pytest

pytest.importorskip("marketlake.llm")

from marketlake.llm import html_text, line_dup, near_dup, token_files, warc  # noqa: E402
from marketlake.llm.catalog import tokenizer_path  # noqa: E402

A = " ".join(f"a{i}" for i in range(60))
B = " ".join(f"b{i}" for i in range(60))


def test_unlike_texts_under_one_id_are_judged_apart(spark):
    rows = [(1, A, "x"), (5, A + " more", "x"), (5, B, "x"), (7, B + " more", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _place string")
    left = near_dup.without_near_duplicates(frame, near_dup.STAGE)
    assert left.columns == frame.columns
    assert sorted((r.doc_id, r.text) for r in left.collect()) == [(1, A), (5, B)]


def test_rows_without_ids_and_repeated_rows(spark):
    rows = [(None, A, 2), (None, A, 1), (3, B, 9), (3, B, 4), (3, None, 1), (4, "", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, kept int")
    left = near_dup.without_near_duplicates(frame, near_dup.STAGE)
    assert sorted(map(tuple, left.collect()), key=str) == sorted(
        [(3, B, 4), (3, None, 1), (4, "", 1), (None, A, 1), (None, A, 2)], key=str
    )


def test_unique_ids_keep_the_smallest(spark):
    rows = [(4, A, 1), (2, A + " more", 2), (9, B, 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    left = near_dup.without_near_duplicates(frame, near_dup.STAGE)
    assert sorted(map(tuple, left.collect())) == [(2, A + " more", 2), (9, B, 3)]


def test_lines_with_clashing_columns(spark):
    line = "one two three four five six seven eight nine"
    names = ["_doc", "_text_hash", "_n_removed", "runs", "_n_lines", "first", "r", "_own_0"]
    rows = [(i, f"{line}\nown {i}", *([i] * len(names))) for i in range(3)]
    frame = spark.createDataFrame(rows, ["doc_id", "text", *names])
    left = line_dup.deduplicated_lines(frame)
    assert left.columns == frame.columns
    found = {r.doc_id: r for r in left.collect()}
    assert [found[i].text for i in range(3)] == [f"{line}\nown 0", "own 1", "own 2"]
    assert all(found[i][c] == i for i in range(3) for c in names)
    counted = {r.doc_id: r for r in line_dup.without_repeated_lines(frame).collect()}
    assert [counted[i]._n_removed for i in range(3)] == [0, 1, 1]
    assert [counted[i]._n_lines for i in range(3)] == [2, 2, 2]


# --- tags ------------------------------------------------------------------------------

SENTENCE = "This is a sentence of the article that doesn't end the page. And here is one more."


@pytest.mark.parametrize(
    "tag", ["<p title=it's>", '<p title="a"">', "<p title='a>b'>", '<p a="b"c=\'d\' e>', "<p title=>", "<p/ =x>", "<P\nx = 'don''t' >"]
)
def test_odd_quotes_lose_no_text(tag):
    page = f"<body><article><h1>A heading</h1>{tag}{SENTENCE}</p><p>They don't \"stop\".</p></article></body>"
    runs = [text for _, text in html_text.Page(page).runs]
    assert runs == ["A heading", SENTENCE, "They don't \"stop\"."]


def tokens(source):
    """Text between tags by the states that browsers step through, letter by letter."""
    space, out, text, i, n = "\t\n\f\r ", [], "", 0, len(source)
    while i < n:
        if source[i] != "<" or i + 1 == n:
            text, i = text + source[i], i + 1
            continue
        j = i + 1 + (source[i + 1] == "/")
        if source[j : j + 1].isalpha() and source[j].isascii():
            state, quote = "name", ""
            while j < n:
                c, j = source[j], j + 1
                if state == "value" and quote:
                    if c == quote:
                        state, quote = "before", ""
                elif state == "open":
                    if c in "\"'":
                        state, quote = "value", c
                    elif c == ">":
                        break
                    elif c not in space:
                        state = "value"
                elif c == ">":
                    break
                elif state == "value":
                    state = "before" if c in space else state
                elif state == "name":
                    state = "before" if c in space + "/" else state
                elif state == "before":
                    state = "before" if c in space + "/" else "attribute"
                elif state == "attribute":
                    state = "open" if c == "=" else "before" if c == "/" else "after" if c in space else state
                elif state == "after":
                    if c not in space:
                        state = "open" if c == "=" else "before" if c == "/" else "attribute"
            out, text, i = [*out, text], "", j
        else:
            text, i = text + source[i], i + 1
    return ["".join(t.split()) for t in [*out, text]]


def test_tags_as_browsers_read_them():
    rng = random.Random(7)
    for _ in range(20_000):
        source = "x" + "".join(
            rng.choice(["<p ", "<p", "</p", ">", '"', "'", "=", " ", "/", "a", "b=", "\n", "w "])
            for _ in range(rng.randint(1, 14))
        )
        found = "".join(t for _, t in html_text.Page("<body>" + source).runs)
        assert found.replace(" ", "") == "".join(tokens(source)).replace(" ", ""), source


def test_comments():
    page = "<body>a<!-->b<!--->c<!-- > -- x -->d<!-- y --!>e</ z>f<!doctype q>g<?php h>i"
    assert [t for _, t in html_text.Page(page).runs] == ["abcdefgi"]


def test_long_odd_markup_is_read_in_one_pass():
    page = "<p " + "a='x\" " * 200_000
    assert html_text.Page(page).runs == []
    assert len(html_text.Page("<p " * 100_000 + "x=" * 100_000).runs) <= 1


# --- archives --------------------------------------------------------------------------


def test_responses_hold_http_messages(spark, tmp_path):
    """Read as other tools do: a warcinfo record, then HTTP messages, URLs as written."""
    urls = ["http://a/\u00e9 x", "http://b/\r\nInjected: 1", "http://c/%41?q=1#f", None, "", "http://d/'\"<>"]
    rows = [(i, url, f"<p>{i}</p>\r\n\r\n<!-- -->") for i, url in enumerate(urls)]
    rows.append((9, "http://e/", None))
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder, manifest = warc.write_warc(frame, str(tmp_path / "w"), roll_bytes=600)
    found = {r.page_id: r for r in warc.read_warc(folder, manifest, with_payload=True).collect()}
    assert {i: (r.url, bytes(r.payload).decode()) for i, r in found.items()} == {
        i: (url, html or "") for i, url, html in rows
    }
    files = [r.file for r in manifest.collect()]
    assert len(files) > 1
    for file in files:
        with open(tmp_path / "w" / file, "rb") as source:
            (info, body), *records = warc.read_records(source)
        assert info["WARC-Type"] == "warcinfo" and info["WARC-Filename"] == file and b"software" in body
        for headers, message in records:
            assert headers["Content-Type"] == "application/http; msgtype=response"
            status, *fields = message.partition(b"\r\n\r\n")[0].decode().split("\r\n")
            assert status == "HTTP/1.1 200 OK"
            named = dict(f.split(": ", 1) for f in fields)
            assert int(named["Content-Length"]) == int(headers["WARC-Payload-Length"])
            assert "\n" not in headers.get("WARC-Target-URI", "")


# --- token files -----------------------------------------------------------------------


@pytest.mark.parametrize("roll", [1, 50, 3_000, 1 << 26])
def test_shards_roll_at_document_ends(spark, roll):
    """Any limit gives the same documents; a task writes several shards; few blocks are read at
    a time."""
    rng = random.Random(8)
    rows = [(i, " ".join(f"word{rng.randrange(99)}" for _ in range(rng.randrange(60)))) for i in range(80)]
    rows += [(40, None), (None, "without id"), (81, "x " * 3_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    plain = token_files.write_token_files(frame, tokenizer_path(), 2)
    rolled = token_files.write_token_files(frame, tokenizer_path(), 2, roll_tokens=roll)
    want, got = (sorted(map(tuple, token_files.read_token_files(*x).collect()), key=str) for x in (plain, rolled))
    assert got == want and len(got) == len(rows)
    shards = rolled[1].collect()
    assert all(r.tokens <= roll or r.docs == 1 for r in shards)
    assert len({r.file for r in shards}) == len(shards)
    if roll == 1:
        assert len(shards) == len(rows)
