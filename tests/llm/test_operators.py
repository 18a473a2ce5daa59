"""The corpus operators against brute force, on small made cases and the test tables."""

import collections
import gzip
import hashlib
import re
import zlib

import numpy as np
import pytest

pytest.importorskip("marketlake.llm")

from conftest import SMALL  # noqa: E402
from oracle import differences, duck  # noqa: E402

from marketlake.llm import (  # noqa: E402
    embedding_dup,
    html_text,
    line_dup,
    mixing,
    near_dup,
    packing,
    quality_model,
    quality_rules,
    token_files,
    warc,
)
from marketlake.llm.catalog import QUERIES, tokenizer_path  # noqa: E402
from marketlake.llm.common import table  # noqa: E402
from marketlake.llm.components import components  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string"
LONG = " ".join(f"w{i}" for i in range(30_000))
COPY = "one two three four five six seven eight nine ten eleven twelve"
ROWS = [
    (1, COPY, "en", "a", 1, "x"),
    (2, COPY.upper(), "en", "a", 1, "x"),
    (3, None, None, None, None, None),
    (4, "", "en", "b", 0, None),
    (5, " \n\t ", "en", None, 0, None),
    (6, LONG, "en", "b", 9, "y"),
    (7, LONG + " more", "en", "b", 9, "y"),
    (8, "two words", "en", "c", 1, "z"),
    (9, "two words", "en", "c", 1, "z"),
    (9, "two words", "en", "c", 1, "z"),
    (None, COPY, "en", "a", 1, "x"),
    (10, "The same line is here with some words.\nOther text " + "la " * 40, "en", "d", 1, ""),
    (11, "The same line is here with some words.\nAnd an end that differs ###", "en", "d", 1, ""),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def small(spark):
    return table(spark, SMALL, "documents")


def words(text):
    return re.findall(r"[^\x20\x09-\x0d]+", text or "")


def bag(rows):
    return collections.Counter(tuple(r) for r in rows)


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_equals_sql(spark, name):
    assert differences(QUERIES[name].run(spark, SMALL), duck(SMALL), QUERIES[name].sql) is None


# --- near duplicates ---------------------------------------------------------------


def shingles(text):
    w = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def linked(sets, same):
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if same(sets[a], sets[b]) and find(a) != find(b):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {k: find(k) for k in keys}


def alike(x, y):
    both = len(x & y)
    return bool(x and y) and 100 * both >= 85 * (len(x) + len(y) - both)


def test_near_duplicates_equal_brute_force(small):
    texts = {r.doc_id: shingles(r.text) for r in small.collect()}
    expected = linked(texts, alike)
    found = near_dup.near_duplicates(small).collect()
    assert {r.doc_id: r.component_id for r in found} == expected
    assert all(r.n_shingles == len(texts[r.doc_id]) for r in found)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_chains_of_near_copies(spark, monkeypatch):
    """Neighbours in a chain are alike, its ends are not; blocks are small."""
    monkeypatch.setattr(near_dup, "BLOCK", 7)
    base = [f"v{i}" for i in range(400)]
    rows = []
    for i in range(60):
        rows.append((i, " ".join(base)))
        for k in range(4):
            base[(i * 31 + k) % 400] = f"n{i}x{k}"
    rows.append((99, " ".join(f"q{i}" for i in range(400))))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    expected = linked({k: shingles(t) for k, t in rows}, alike)
    assert len(set(expected.values())) < 20
    found = {r.doc_id: r.component_id for r in near_dup.near_duplicates(frame).collect()}
    assert found == expected


def test_near_duplicate_cases(docs, empty):
    found = collections.defaultdict(list)
    for r in near_dup.near_duplicates(docs).collect():
        found[r.doc_id].append((r.n_shingles, r.component_id, r.kept))
    assert found[1] == [(8, 1, True)] and found[2] == [(8, 1, False)]
    assert found[3] == found[4] == [(0, found[3][0][1], True)] or found[3][0][0] == 0
    assert found[5][0] == (0, 5, True)
    assert found[7] == [(29_997, 6, False)]
    assert found[9] == [(1, 8, False)] * 2
    assert near_dup.near_duplicates(empty).count() == 0
    left = near_dup.without_near_duplicates(docs)
    assert left.columns == docs.columns
    kept = sorted((r.doc_id for r in left.collect()), key=str)
    assert kept == [1, 10, 11, 3, 4, 5, 6, 8, None]


def test_components(spark):
    pairs = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(1, 400)]
    frame = spark.createDataFrame(pairs + [(7, 3), (5, 5)], "a long, b long")
    found = {r.id: r.component for r in components(frame).collect()}
    assert found == {**dict.fromkeys(range(301), 0), **dict.fromkeys(range(1000, 1400), 1000)}


# --- tokens, packing ---------------------------------------------------------------


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


ODD = "İstanbul ẞ Σας don't It'S <|endoftext|> x<|startoftext|>y é é a b 12a3 ﬁ end.'s"


def test_packing(spark, docs, small, plain):
    odd = spark.createDataFrame([(77, ODD)], "doc_id long, text string")
    every = docs.select("doc_id", "text").union(small.select("doc_id", "text")).union(odd)
    expected = collections.Counter()
    for r in every.collect():
        ids = [*plain(r.text), 1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            expected[r.doc_id, piece, at, len(part), crc(part)] += 1
    rows = packing.pack_documents(every, tokenizer_path(), 1).collect()
    assert bag(r[:5] for r in rows) == expected
    filled = collections.defaultdict(list)
    for r in rows:
        filled[r.sequence_id].append((r.offset, r.length))
    for places in filled.values():
        places.sort()
        ends = [0, *np.cumsum([n for _, n in places]).tolist()]
        assert [at for at, _ in places] == ends[:-1] and ends[-1] <= 4096
    least = -(-sum(r.length for r in rows) // 4096)
    assert len(filled) <= 1.02 * least + 1
    assert packing.pack_documents(docs.limit(0), tokenizer_path(), 1).count() == 0


def test_filling_search():
    rng = np.random.default_rng(0)
    for _ in range(60):
        lengths = sorted({int(x) for x in rng.integers(3, 60, 6)}, reverse=True)
        counts = {n: int(rng.integers(1, 3)) for n in lengths}
        room = int(rng.integers(20, 150))
        sums = {0}
        for n in lengths:
            for _ in range(counts[n]):
                sums |= {s + n for s in sums if s + n <= room}
        best = packing.best_filling(room, lengths, counts)
        assert sum(best) == max(sums)
        assert all(best.count(n) <= counts[n] for n in best)


def test_searches_tell_whether_they_were_cut():
    lengths = list(range(2000, 1100, -1))
    found, visits = packing.searched_filling(2100, lengths, dict.fromkeys(lengths, 1), 50)
    assert found == [2000] and visits > 50
    assert packing.searched_filling(2000, lengths, dict.fromkeys(lengths, 1), 50) == ([2000], 1)


@pytest.mark.parametrize("histogram", [{1: 5000}, {1: 1500}, {4000: 2, 2: 9000, 3: 1}])
def test_plan_of_many_short_pieces(histogram):
    patterns, sequences = packing.plan_sequences(histogram)
    used = collections.Counter()
    for _, times, filling in patterns:
        assert sum(filling) <= 4096
        for n in filling:
            used[n] += times
    assert used == histogram
    assert sequences == -(-sum(n * c for n, c in histogram.items()) // 4096)


def test_plan_uses_every_piece():
    rng = np.random.default_rng(1)
    histogram = collections.Counter(int(x) for x in rng.integers(1, 4097, 3000))
    histogram[300] += 5000
    patterns, sequences = packing.plan_sequences(dict(histogram))
    used = collections.Counter()
    for _, times, filling in patterns:
        assert sum(filling) <= 4096
        for n in filling:
            used[n] += times
    assert used == histogram
    total = sum(n * c for n, c in histogram.items())
    assert sequences <= 1.05 * -(-total // 4096)


def test_token_files(spark, docs, small, plain):
    odd = spark.createDataFrame([(777_777, ODD)], "doc_id long, text string")
    every = docs.filter("doc_id IS NOT NULL AND doc_id <> 9").select("doc_id", "text").union(
        small.filter("doc_id > 11").select("doc_id", "text")
    ).union(odd)
    folder, manifest = token_files.write_token_files(every, tokenizer_path(), 2)
    found = {r.doc_id: r[1:] for r in token_files.read_token_files(folder, manifest).collect()}
    start = 0
    rows = sorted(every.collect())
    for r in rows:
        ids = [*plain(r.text), 2]
        assert found[r.doc_id] == (start, len(ids), crc(ids))
        start += len(ids)
    assert len(found) == len(rows)


def test_token_file_cases(docs, empty, plain):
    folder, manifest = token_files.write_token_files(docs, tokenizer_path(), 2)
    rows = token_files.read_token_files(folder, manifest).collect()
    assert len(rows) == len(ROWS)
    assert min(rows, key=lambda r: r.start).doc_id is None
    assert {r.n_tokens for r in rows if r.doc_id in (3, 4, 5)} == {1}
    folder, manifest = token_files.write_token_files(empty, tokenizer_path(), 2)
    assert token_files.read_token_files(folder, manifest).count() == 0


@pytest.mark.parametrize("top", [1, 2, 200, 49_408, 1 << 32])
def test_blocks_round_trip(tmp_path, top):
    rng = np.random.default_rng(top)
    lengths = np.array([0, 5, 1023, 1, 4000, 0, 70_000])
    ids = (rng.pareto(1.0, lengths.sum()) * 3 % top).astype(np.uint32)
    writer = token_files.ShardWriter(str(tmp_path), "x")
    import pyarrow as pa

    writer.add(pa.array([1, None, 3, 4, 5, 6, 7], pa.int64()), ids, lengths)
    writer.close()
    read = list(token_files.read_shard((tmp_path / "x").read_bytes()))
    assert [d for d, _ in read] == [1, None, 3, 4, 5, 6, 7]
    assert (np.concatenate([i for _, i in read]) == ids).all()
    assert [len(i) for _, i in read] == lengths.tolist()
    with pytest.raises(ValueError):
        next(token_files.read_shard((tmp_path / "x").read_bytes()[:-3]))


# --- mixing ------------------------------------------------------------------------


def test_mixing_targets(spark):
    rows = [(i, "w " * (i % 7), f"s{i % 5}", "en") for i in range(700)]
    rows += [(1000 + i, "v " * 3, "tiny", "en") for i in range(2)]
    rows += [(2000 + i, "u " * 4, None, "en") for i in range(50)]
    rows += [(3000, None, "nothing", "en")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    found = mixing.mix(frame).collect()
    again = mixing.mix(frame.repartition(5)).collect()
    assert bag(found) == bag(again)
    sizes = {r.doc_id: r.size for r in found}
    assert all(sizes[i] == len(words(t)) for i, t, *_ in rows)
    of = {i: s for i, _, s, _ in rows}
    taken, target, size = collections.Counter(), {}, {}
    for r in found:
        taken[of[r.doc_id]] += r.taken
        target[of[r.doc_id]], size[of[r.doc_id]] = r.target, r.source_size
        assert 0 <= r.taken <= 3 * r.size
    total = sum(size.values())
    assert abs(sum(target.values()) - total) < 1e-6 * total
    assert target["tiny"] == 18 and target["nothing"] == 0
    order = [*sorted(s for s in size if s is not None), None]
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    free = [s for s in order if target[s] < 3 * size[s] - 1e-9]
    assert len({round(target[s] / weight[s], 6) for s in free}) == 1
    assert all(abs(taken[s] - target[s]) <= 2 for s in order)
    mixed = mixing.mixed_documents(frame)
    assert mixed.columns == frame.columns
    counted = collections.Counter()
    for r in mixed.collect():
        counted[r.source] += len(words(r.text))
    assert counted == +taken


def test_mixing_cases(docs, empty):
    found = mixing.mix(docs).collect()
    assert len(found) == len(ROWS)
    assert {(r.size, r.taken) for r in found if r.doc_id in (3, 4, 5)} == {(0, 0)}
    assert mixing.mix(empty).count() == 0
    assert mixing.mixed_documents(docs).columns == docs.columns
    assert mixing.mixed_documents(empty).count() == 0


# --- WARC --------------------------------------------------------------------------


def test_warc(spark, tmp_path):
    big = "<p>" + "text " * 50 + "</p>"
    rows = [
        (1, "http://a/é x", big, 1),
        (2, "http://b/\r\nInjected: 1", big, 1),
        (3, None, "short", 1),
        (4, "http://c/", "short", 1),
        (5, "http://d/", None, 1),
        (None, "http://e/", big, 1),
        (6, "http://f/", "ünï" * 40, 1),
        (6, "http://f/", "ünï" * 40, 1),
        (7, "http://g/", "ünï" * 40, 1),
        (8, "http://h/", "x\r\n\r\n" * 60_000, 1),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, records int")
    folder, manifest = warc.write_warc(pages, str(tmp_path / "w"), roll_bytes=300)
    assert sum(r.records for r in manifest.collect()) == len(rows)
    assert not [p for p in (tmp_path / "w").iterdir() if p.name.startswith("_")]
    for r in manifest.collect():
        assert gzip.decompress((tmp_path / "w" / r.file).read_bytes()).startswith(b"WARC/1.1")
    found = warc.read_warc(folder, manifest, with_payload=True).collect()
    first = {hashlib.sha256((h or "").encode()).hexdigest(): i for i, _, h, _ in reversed(rows) if i}
    expected = collections.Counter()
    for i, _, h, _ in rows:
        data = (h or "").encode()
        digest = hashlib.sha256(data).hexdigest()
        refers = first[digest] if len(data) >= 100 and first[digest] != i else None
        kind = "response" if refers is None else "revisit"
        expected[i, len(data), digest, kind, refers, data if refers is None else None] += 1
    assert bag((r[0], *r[2:6], None if r[6] is None else bytes(r[6])) for r in found) == expected
    one, two = (warc.write_warc(pages, str(tmp_path / n))[1].collect() for n in "ab")
    assert one == two
    assert all(
        (tmp_path / "a" / r.file).read_bytes() == (tmp_path / "b" / r.file).read_bytes() for r in one
    )
    folder, manifest = warc.write_warc(pages.limit(0))
    assert warc.read_warc(folder, manifest).count() == 0


# --- HTML --------------------------------------------------------------------------


def extracted(*pages):
    return html_text.main_texts(list(pages), html_text.default_model())


def test_html_fits_labelled_pages():
    pages = html_text.labelled_pages(80, seed=123)
    good = 0
    for source, text in zip(pages, extracted(*pages)):
        page, own = html_text.Page(source), []
        for parent, marked in zip(page.parent, page.marked):
            mark = re.search(r"data-y=(\d)", marked or "")
            own.append(int(mark[1]) if mark else own[parent] if parent >= 0 else 0)
        head = html_text.BLOCKS.index("head")
        truth = "\n".join(t for n, t in page.runs if own[n] and page.tag[n] != head)
        good += truth == text
    assert good >= 72


def test_html_messages_equal_enumeration():
    """Marginals of small trees against all labellings."""
    import itertools

    rng = np.random.default_rng(4)
    pages = [html_text.Page("<body><div class=ad>a<p>b</div><article><p>c.<p>d</article>")]
    trees = html_text.trees_of(pages)
    weights = rng.standard_normal(len(html_text.FEATURES))
    edges = rng.standard_normal((2, 2, 2))
    share, joint, total = html_text.marginals(trees, weights, edges)
    own = np.append(weights, 0.0)[trees.features].sum(axis=1)
    n, z, sums = len(own), 0.0, np.zeros(len(own))
    for y in itertools.product((0, 1), repeat=n):
        value = sum(own[i] for i in range(n) if y[i])
        value += sum(
            edges[trees.kind[i], y[p], y[i]] for i, p in enumerate(trees.parent) if p >= 0
        )
        z += np.exp(value)
        sums += np.exp(value) * np.array(y)
    assert np.allclose(share, sums / z) and np.isclose(total, np.log(z))
    assert np.allclose(joint[1:].sum(axis=(1, 2)), 1)


def test_html_cases(spark):
    page = (
        "<html><head><title>T</title><script>var a='<p>no</p>'</script></head><body>"
        "<nav><ul><li><a href=/>Home</a><li><a href=/b>B</a></ul></nav>"
        "<article><h1>Head &amp; more</h1><p>First\n  part &lt;1&gt;.<p>Second <b>bold</b> part."
        "<div class='comments'><p>A reader says something here.</p></div></article>"
        "<footer>&copy; us.</footer>"
    )
    assert extracted(page) == ["Head & more\nFirst part <1>.\nSecond bold part."]
    assert extracted(None, "", "  ", "<p", "<!-- ", "<script>x") == [""] * 6
    rows = [(1, "u", page, "x"), (1, "u", page, "x"), (None, None, None, None)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = html_text.extract(frame).collect()
    assert [r.n_chars for r in found] == [len(r.text) for r in found]
    assert sorted(r.text for r in found)[0] == "" and len(found) == 3
    assert html_text.extract(frame.limit(0)).count() == 0
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    assert len(extracted(deep)) == 1


def test_html_on_given_pages(spark):
    pages = table(spark, SMALL, "pages").collect()
    texts = extracted(*[r.html for r in pages])
    for r, text in zip(pages, texts):
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        cut = re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|h1)>", "\0", article.replace("<br>", " ")))
        import html

        blocks = (" ".join(html.unescape(x).split()) for x in cut.split("\0"))
        assert text == "\n".join(b for b in blocks if b)


# --- quality -----------------------------------------------------------------------


def test_quality_scores(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    labels = table(spark, "/root/testdata/sf0.01", "labels")
    rows = {r.doc_id: r for r in quality_model.score_documents(docs, labels).collect()}
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0) for k, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    held = [(rows[r.doc_id].score, r.quality) for r in labels.collect() if rows[r.doc_id].held_out]
    good, bad = ([s for s, y in held if y == k] for k in (1, 0))
    assert np.mean([[g > b for b in bad] for g in good]) > 0.85


def test_quality_cases(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality_model.score_documents(docs, none).collect()} == {0.5}
    some = spark.createDataFrame(
        [(1, 1), (2, None), (None, 0), (8, 1), (8, 0), (10, 0), (11, 0), (12345, 1)],
        "doc_id long, quality int",
    )
    rows = quality_model.score_documents(docs, some).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert quality_model.score_documents(empty, some).count() == 0
    left = quality_model.without_low_quality(docs, some)
    assert left.columns == docs.columns and left.count() <= len(ROWS)


def rule_statistics(text):
    w = words(text)
    counts = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = set()
    for i in range(len(w) - 4):
        if counts[tuple(w[i : i + 5])] > 1:
            covered |= set(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if words(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def test_rule_statistics(docs, small):
    for frame in (docs, small):
        got = quality_rules.with_statistics(frame).select("text", *quality_rules.STATISTICS)
        assert all(tuple(r[1:]) == rule_statistics(r[0]) for r in got.collect())


def test_rules_keep_clean_documents(spark, small, empty):
    stats = quality_rules.with_statistics(small)
    model = quality_rules.fit(stats)
    rows = quality_rules.judge(stats, model).collect()
    for r in rows:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)
        clean = r.n_words >= 20 and not r.n_symbols and not r.n_dup_lines and not r.n_repeat_words
        if clean and 5 * r.n_upper <= r.word_chars:
            assert r.kept
    junk = [r for r in rows if 2 * r.n_symbols > r.n_words and r.n_words > 20]
    assert junk and not any(r.kept for r in junk)
    nothing = quality_rules.with_statistics(empty)
    assert quality_rules.judge(nothing, quality_rules.fit(nothing)).count() == 0


# --- vectors -----------------------------------------------------------------------


def vector_rows(rng):
    rows, vec = [], 0
    for label in range(3):
        for x in rng.standard_normal((150, 16)):
            rows.append((vec, x.tolist(), label))
            vec += 1
        centre = rng.standard_normal(16)
        for _ in range(60):
            rows.append((vec, (centre + rng.normal(0, 0.09, 16)).tolist(), label))
            vec += 1
        for _ in range(20):
            rows.append((vec, rows[vec - 30][1], label))
            vec += 1
    return rows


def test_near_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dup, "LEAF", 60)
    monkeypatch.setattr(embedding_dup, "BLOCK", 40)
    rows = vector_rows(np.random.default_rng(8))
    rows += [
        (900, None, 1),
        (901, [0.0] * 16, 1),
        (902, [float("nan")] * 16, 1),
        (903, [1.0] * 15 + [None], 1),
        (904, rows[0][1], None),
        (905, [], 0),
        (906, [1.0, 2.0], 0),
        (907, [2.0, 4.0], 0),
        (908, [1e300] * 16, 2),
        (909, [1e-300] * 16, 2),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dup.near_vectors(frame).collect()}
    unit = {}
    for i, x, label in rows:
        x = np.array(x if x is not None else [], float)
        if label is not None and len(x) and np.isfinite(x).all() and x.any():
            x = x / np.abs(x).max()
            unit[i] = (label, x / np.linalg.norm(x))

    def near(a, b):
        return a[0] == b[0] and len(a[1]) == len(b[1]) and a[1] @ b[1] >= 0.93

    expected = linked(unit, near)
    links = {i: sum(near(a, b) for j, b in unit.items() if i != j) for i, a in unit.items()}
    for i, *_ in rows:
        assert found[i] == (links.get(i, 0), expected.get(i, i)), i
    assert embedding_dup.near_vectors(frame.limit(0)).count() == 0


def test_near_vectors_of_a_hot_group(spark, monkeypatch):
    """A group of near, unequal vectors far above the leaf size keeps all its links."""
    monkeypatch.setattr(embedding_dup, "LEAF", 4)
    monkeypatch.setattr(embedding_dup, "LEAST", 4)
    monkeypatch.setattr(embedding_dup, "BLOCK", 100)
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((2400, 64)) / 8
    centre = rng.standard_normal(64) / 8
    vectors[::3] = 0.95**0.5 * centre + 0.05**0.5 * vectors[::3]
    frame = spark.createDataFrame(
        [(i, x.tolist(), 0) for i, x in enumerate(vectors)],
        "vec_id long, embedding array<double>, label int",
    )
    found = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dup.near_vectors(frame).collect()}
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.93
    assert {i: n for i, (n, _) in found.items()} == dict(enumerate((near.sum(axis=1) - 1).tolist()))
    assert {found[i][1] for i in range(0, 2400, 3)} == {0}


# --- lines -------------------------------------------------------------------------


def deleted_lines(texts, least):
    """Brute force: lines inside any run of ``least`` words that occurred before."""
    lines = [(d, t.split("\n")) for d, t in texts]
    seen, gone = {}, {d: set() for d, _ in texts}
    runs = []
    for d, parts in lines:
        for a in range(len(parts)):
            for b in range(a + 1, len(parts) + 1):
                if sum(len(words(x)) for x in parts[a:b]) >= least:
                    runs.append((d, a, b, tuple(parts[a:b])))
    for d, a, b, content in sorted(runs, key=lambda r: r[:2]):
        first = seen.setdefault(content, (d, a))
        if first[0] != d or a >= first[1] + (b - a):
            gone[d] |= set(range(a, b))
    return gone


def test_line_runs_equal_brute_force(spark):
    import random

    rng = random.Random(3)
    pool = ["", "a b", "c d e", "f", "g h i j k l", "m n o p q r s t u", "v w"]
    texts = []
    for d in range(60):
        parts = [rng.choice(pool) for _ in range(rng.randint(1, 7))]
        parts.insert(rng.randint(0, len(parts)), f"own line of {d}")
        texts.append((d, "\n".join(parts)))
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    for least in (3, 8):
        gone = deleted_lines(texts, least)
        for r in line_dup.without_repeated_lines(frame, least).collect():
            parts = dict(texts)[r.doc_id].split("\n")
            left = "\n".join(p for i, p in enumerate(parts) if i not in gone[r.doc_id])
            assert (r.text, r._n_removed) == (left, len(gone[r.doc_id])), r.doc_id


def test_line_cases(docs, empty):
    rows = line_dup.without_repeated_lines(docs)
    assert rows.columns == [*docs.columns, "_n_lines", "_n_removed"]
    by = {r.doc_id: r for r in rows.collect()}
    assert by[3].text is None and by[3]._n_lines == 0 and by[4].text == ""
    assert by[10]._n_removed == 0
    assert by[11].text == "And an end that differs ###"
    assert by[None].text == "" and by[1].text == COPY
    assert line_dup.deduplicated_lines(docs).columns == docs.columns
    assert line_dup.without_repeated_lines(empty).count() == 0
