"""The training-data operators against brute force, on small tables and on odd ones."""

from __future__ import annotations

import collections
import gzip
import hashlib
import io
import math
import re
import uuid
import zlib

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import corpus_pipeline
from cartwright.llm import fingerprint, htmltext, jaccard, langid, mixing, packing, queries, repeats, sieve, topk, urlrules, warc
from tools.parity import compare, connect

ODD = [
    (1, None), (2, ""), (3, "   "), (4, "one two"), (5, "one two"), (6, "A B c d e"), (7, "a b C d e f"),
    (8, "word " * 400), (8, "word " * 400), (None, "no id at all, five words"), (9, "é" * 300), (10, "é" * 300), (11, "x" * 5000),
]


@pytest.fixture(scope="module")
def odd(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string")
    # Columns with names that operators use inside.
    return docs.selectExpr("*", "'xx' AS lang", "'s' AS source", "1L AS n_chars", "1 AS row", "2 AS n", "3 AS copy", "4 AS label")


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def texts_of(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, name):
    outcome = compare(spark, connect(SMALL), SMALL, name)
    assert outcome.startswith("ok") and "types" not in outcome, outcome


def cut_by_hand(texts: list[bytes], length: int) -> list[tuple[int, int, str]]:
    seen = collections.Counter(t[k : k + length] for t in texts for k in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(t, gone) if not g)
        out.append((sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("settings", [(200, 32, 2_000_000), (200, 32, 3_000), (51, 8, 20_000)])
def test_repeats_equal_brute_force(odd, small, settings):
    for docs in (odd, small):
        found = repeats.remove_repeats(docs, repeats.RepeatSettings(*settings))
        got = sorted((r.doc_id or 0, r._n_removed, r._n_spans, r._kept_sha256) for r in found.collect())
        rows = texts_of(docs)
        hand = cut_by_hand([t.encode() for _, t in rows], settings[0])
        assert got == sorted((i or 0, *one) for (i, _), one in zip(rows, hand))


def test_suffix_array_and_prefixes_equal_brute_force():
    rng = np.random.default_rng(3)
    for size, letters in ((1, 1), (40, 1), (300, 2), (500, 5), (3000, 40)):
        texts = [bytes(rng.integers(97, 97 + letters, n).astype(np.uint8)) for n in rng.integers(1, size + 1, 6)]
        texts += texts[:2]
        symbols = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.int32) + 1
        stops = np.cumsum([len(t) + 1 for t in texts]) - 1
        symbols[stops] = 0
        left = np.repeat(stops, [len(t) + 1 for t in texts]) - np.arange(len(symbols))
        for length in (2, 9, 30):
            order = repeats.suffix_array(symbols, left, length)
            own = [tuple(symbols[k : k + min(left[k] + 1, length)]) for k in order]
            assert own == sorted(own)
            same = [len(x) == length == left_x and x == y for x, y, left_x in zip(own[1:], own, np.minimum(left[order[1:]], length))]
            got = repeats.long_prefixes(symbols, order, length)[1:]
            # Only suffixes that hold a whole window are asked about.
            holds = (left[order[1:]] >= length) & (left[order[:-1]] >= length)
            assert [bool(g) for g, h in zip(got, holds) if h] == [s for s, h in zip(same, holds) if h]


def sets_by_hand(text: str) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    whole = [tuple(words)] if words else []
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4)) if len(words) >= 5 else frozenset(whole)


@pytest.mark.parametrize("settings", [jaccard.JaccardSettings(), jaccard.JaccardSettings(run=2, members=2, cells=256)])
def test_jaccard_equals_brute_force(odd, small, settings):
    for docs in (odd, small):
        rows = texts_of(docs)
        sets = [sets_by_hand(t) for _, t in rows]
        up = list(range(len(rows)))

        def root(x):
            return x if up[x] == x else root(up[x])

        for i, x in enumerate(sets):
            for j in range(i):
                if x and 100 * len(x & sets[j]) >= 75 * len(x | sets[j]):
                    up[root(i)] = root(j)
        least = {}
        for i, (key, _) in enumerate(rows):
            if key is not None:
                least[root(i)] = min(least.get(root(i), key), key)
        want = sorted((str(key), len(sets[i]), str(least.get(root(i)))) for i, (key, _) in enumerate(rows))
        got = jaccard.joined(docs, settings).collect()
        assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == want


def test_jaccard_of_nearly_similar_texts_grows_with_their_number(spark, monkeypatch):
    """Texts that share most words but too few to link, and some that do: a text goes to blocks, not to every group it shares words with."""
    common, sent = [f"c{k}" for k in range(60)], []
    rows = [(k, " ".join(common + [f"own{k}-{j}" for j in range(10)])) for k in range(160)]
    rows += [(1000 + k, " ".join(common + [f"own{k}-{j}" for j in range(8)])) for k in (3, 150)]
    docs, plain = spark.createDataFrame(rows, "doc_id long, text string").repartition(4), jaccard.compared

    def counted(docs, pairs, reps, *rest):
        ends = pairs.select(F.explode(F.array_distinct(F.array("a", "b"))).alias("g"))
        sent.append(ends.join(reps, F.col("g") == F.col("gid")).count())
        return plain(docs, pairs, reps, *rest)

    monkeypatch.setattr(jaccard, "compared", counted)
    for block in (100_000, 400):
        sent.clear()
        settings = jaccard.JaccardSettings(run=2, block=block)
        got = {r.doc_id: r.component_id for r in jaccard.joined(docs, settings).collect()}
        sets = {key: sets_by_hand(text) for key, text in rows}
        up = {key: key for key in sets}
        for x, y in ((x, y) for x in sets for y in sets if x < y and 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y])):
            low, high = sorted((up[x], up[y]))
            up = {key: low if value == high else value for key, value in up.items()}
        assert got == up
        assert block == 400 or sum(sent) <= 6 * len(rows), sent


@pytest.mark.parametrize("block", [1, 300])
def test_jaccard_in_small_blocks_is_the_same(odd, small, block):
    for docs in (odd, small):
        want, got = (jaccard.joined(docs, s) for s in (jaccard.JaccardSettings(), jaccard.JaccardSettings(run=2, members=2, cells=256, block=block)))
        assert sorted(map(str, got.drop("label").collect())) == sorted(map(str, want.drop("label").collect()))


def test_top_k_keeps_ties_and_leaves_out_unusable_vectors(spark):
    nan = float("nan")
    rows = [(20, [1.0, 0.0]), (1, [1.0, 0.5]), (2, [1.0, 0.5]), (3, [nan, 1.0]), (4, None), (5, [None, 1.0]), (40, [0.0, -1.0]), (6, [9.0]), (None, [1.0, 1.0])]
    vectors = topk.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    found = topk.top_k(vectors, F.col("id") % 20 == 0, 2, topk.SearchSettings(shard_rows=2, leaf_rows=1, block_rows=1))
    assert sorted(map(tuple, found.collect())) == [(20, 1, 1, 4096), (20, 2, 2, 4096), (40, 1, 20, 0), (40, 2, 1, -2048)]
    assert topk.top_k(vectors.where("false"), F.col("id") == 0).count() == 0


def test_top_k_of_repeated_ids_equals_brute_force(spark):
    draw = np.random.default_rng(3)
    rows = [(int(k), [float(x) for x in draw.integers(-3, 4, 3)]) for k in draw.integers(0, 60, 300)]
    rows += rows[:20]
    vectors = topk.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    found = topk.top_k(vectors, F.col("id") % 20 == 0, 7, topk.SearchSettings(shard_rows=40, leaf_rows=4, block_rows=3))
    want = []
    for query in sorted({k for k, _ in rows if k % 20 == 0}):
        pairs = [(-int(4096 * np.dot(q, c)), key) for k, q in rows if k == query for key, c in rows if key != query]
        want += [(query, rank, key, -down) for rank, (down, key) in enumerate(sorted(pairs)[:7], 1)]
    assert sorted(map(tuple, found.collect())) == want


def test_archives_make_a_round_trip(spark, folder):
    long_ = "<p>déjà\r\n\r\nWARC/1.1\r\n" + "x" * 1000
    rows = [(1, "u", long_), (2, "u\nv", long_), (3, None, long_), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (7, "u", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_archives(pages, folder("a"))
    read = {r.page_id: r for r in warc.resolve(warc.read_archives(spark, folder("a"))).collect()}
    assert [read[k].record_type for k in range(1, 8)] == ["revisit"] * 2 + ["response"] * 5
    assert [read[k].refers_to for k in (1, 2, 3)] == [3, 3, None]
    assert {read[k].payload_bytes for k in (1, 2, 3)} == {len(long_.encode())}
    assert {read[k].payload_digest for k in (1, 2, 3)} == {hashlib.sha1(long_.encode()).hexdigest()}
    assert bytes(read[3].payload).decode() == long_ and read[6].payload_bytes == 0
    heads = {}
    for blob in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder("a")).collect():
        heads |= {int(h["x-page-id"]): (h, b) for h, b in warc.parse(io.BytesIO(gzip.decompress(blob.content)))}
    first, last = heads[1][0], heads[3][0]
    assert len({h["warc-date"] for h, _ in heads.values()}) == 1 and re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", last["warc-date"])
    assert {h["content-type"] for h, _ in heads.values()} == {"application/http;msgtype=response"}
    assert first["warc-refers-to"] == last["warc-record-id"] and first["warc-refers-to-date"] == last["warc-date"]
    assert str(uuid.UUID(last["warc-record-id"][10:-1])) == last["warc-record-id"][10:-1]
    assert "warc-target-uri" not in last and "warc-refers-to-target-uri" not in first and heads[2][0]["warc-target-uri"] == "u%0Av"
    assert heads[3][1].startswith(b"HTTP/1.1 200 OK\r\n") and warc.payload_of(*heads[3]).decode() == long_
    assert heads[1][1].endswith(b"\r\n\r\n") and warc.payload_of(*heads[1]) == b""
    warc.dedup_archives(spark, folder("a"), folder("b"))
    again = warc.resolve(warc.read_archives(spark, folder("b"))).collect()
    assert sorted((r.page_id, r.record_type, r.refers_to or 0, r.payload_bytes) for r in again) == sorted(
        (r.page_id, r.record_type, r.refers_to or 0, r.payload_bytes) for r in read.values()
    )
    warc.write_archives(pages.where("false"), folder("c"))
    assert warc.read_archives(spark, folder("c")).count() == 0


def test_archives_with_null_and_repeated_ids(spark, folder):
    long_ = "y" * 2000
    rows = [(None, "a", long_), (None, "b", long_), (5, "c", long_), (5, "d", long_), (4, "e", long_), (9, "f", "z" * 2000), (9, "f", "z" * 2000)]
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), folder("d"), date="2020-01-01T00:00:00Z")
    read = warc.resolve(warc.read_archives(spark, folder("d"))).collect()
    got = sorted((r.page_id or 0, r.url, r.record_type, r.refers_to or 0, r.payload_bytes) for r in read)
    assert got == [
        (0, "a", "revisit", 5, 2000), (0, "b", "revisit", 5, 2000), (4, "e", "revisit", 5, 2000), (5, "c", "response", 0, 2000),
        (5, "d", "response", 0, 2000), (9, "f", "response", 0, 2000), (9, "f", "response", 0, 2000),
    ]


def test_rules_part_blocks_and_unclosed_elements_are_read_once():
    assert htmltext.main_text("<body><div>one<hr>two</div></body>") == "one two"
    page = htmltext.Outline()
    page.feed("<article><div><p>a<p>b</div></article></div><header>c</header>" + "<div><p>" * 3000)
    closed = collections.Counter(name for name, *_ in page.open)
    assert closed == +page.times + collections.Counter([""]) and closed["div"] == 3000
    # Closing tags of elements that are not open look at nothing: quadratic work would take minutes here.
    assert htmltext.main_text("<body>" + "<div></p>" * 30_000 + "text") == "text"


def features_by_hand(text: str, s) -> list[int]:
    """The hashed n-grams that begin at each character, from the rule alone."""
    code, mask, out = [*map(ord, text.lower()), 0, 0], 0xFFFFFFFF, []
    for order in s.orders:
        for at in range(len(code) - 2):
            value = order * 0x2545F491 & mask
            for place in range(order):
                value ^= code[at + place] * int(langid.FACTORS[place]) & mask
                value = (value << 13 | value >> 19) & mask
            out.append((value * int(langid.FACTORS[-1]) & mask) >> 32 - s.bits)
    return out


def test_languages_equal_a_plain_naive_bayes(small):
    s = langid.NgramSettings()
    docs = small.where("char_length(text) < 3000")
    seen, rows = collections.defaultdict(collections.Counter), []
    for r in docs.select("doc_id", "text", "lang").collect():
        rows.append((r.doc_id, features_by_hand(r.text or "", s)))
        if r.text is not None and r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            seen[r.lang].update(rows[-1][1])
    total = {lang: sum(c.values()) + s.alpha * 2**s.bits for lang, c in seen.items()}
    got = {r.doc_id: r for r in langid.identify(docs, langid.learned_from(docs)).select("doc_id", "_lang.*").collect()}
    assert len(got) == len(rows) > 50
    for doc_id, found in rows:
        sums = {lang: sum(math.log((c[f] + s.alpha) / total[lang]) for f in found) for lang, c in seen.items()}
        best = max(sums.values())
        want = {lang: math.exp(x - best) for lang, x in sums.items()}
        r = got[doc_id]
        if r.lang_pred != langid.UNDETERMINED:
            assert abs(r.score - want[r.lang_pred] / sum(want.values())) < 1e-3
            assert sums[r.lang_pred] >= best - 1e-2


def test_languages_of_held_out_documents(small, odd):
    model = langid.learned_from(small)
    found = langid.identify(small.where(langid.held_out(F.col("doc_id"))), model).select("lang", "_lang.*").collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.95 * len(found) > 0
    odds = langid.identify(odd, model).select("doc_id", "_lang.*").collect()
    assert {r.doc_id for r in odds if r.lang_pred == "und"} == {1, 2, 3}
    assert all(0 <= r.score <= 1 for r in odds)
    none = langid.fit(small.where("false"))
    assert {r[0] for r in langid.identify(small, none).select("_lang.lang_pred").distinct().collect()} == {"und"}


def test_language_id_rejects_noise_and_foreign_text(spark, small):
    draw = np.random.default_rng(7)
    signs = np.array(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"))
    russian = "Все счастливые семьи похожи друг на друга, каждая несчастливая семья несчастлива по-своему. "
    chinese = "道可道非常道名可名非常名無名天地之始有名萬物之母故常無欲以觀其妙常有欲以觀其徼"
    noise = ["".join(draw.choice(signs, n)) for n in (50, 200, 2_000) for _ in range(5)]
    planted = [*noise, russian[:21], russian, russian * 20, chinese, chinese * 20]
    rows = [(10_000 + k, text, "en" if k < len(noise) and k % 2 else None, "s", len(text)) for k, text in enumerate(planted)]
    docs = small.unionByName(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    found = langid.identify(docs, langid.learned_from(docs))
    assert found.where("doc_id >= 10000 and _lang.score > 0.9").count() > 10
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs, SMALL).collect()}
    assert kept == {r.doc_id for r in small.where("text rlike '[A-Za-z]'").collect()}
    assert corpus_pipeline.language_id(spark, docs.withColumn("lang", F.lit(None).cast("string")), SMALL).count() == 0


def test_url_rules(spark):
    rows = [(1, None), (2, "no scheme"), (3, "http://NET"), (4, "http://a.Net/x?y"), (5, "x://example.net/en/a#b"), (6, "http://planet/"), (7, "http://b.org/fr/"), (7, "http://b.org/fr/")]
    rules = spark.createDataFrame(queries.RULES, "host string, path string, verdict string")
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 AS rule", "2 AS host", "3 AS digest")
    got = sorted((r.page_id, r.host, r.path, r.rule or "", r.verdict) for r in urlrules.judge(pages, rules).collect())
    assert got == [
        (1, "", "", "", "allow"), (2, "", "", "", "allow"), (3, "net", "", "", "allow"), (4, "a.net", "/x", "net/", "block"),
        (5, "example.net", "/en/a", "example.net/en/", "allow"), (6, "planet", "/", "", "allow"),
        (7, "b.org", "/fr/", "org/fr/", "allow"), (7, "b.org", "/fr/", "org/fr/", "allow"),
    ]
    assert {r.verdict for r in urlrules.judge(pages, rules.where("false")).collect()} == {"allow"}


def test_main_text(spark):
    page = (
        "<html><head><title>t</title><script>var a='</p>'</script></head><body><header>Top</header><nav><a>Home</a></nav>"
        "<div class='cookie-notice'>We use cookies</div><article><header><h1>A  head</h1></header><p>First &amp; best<br>line "
        "of the text that goes on for a while.<p>Ok.</p><div id=comments><p>I like this very much indeed, thanks</p></div></article>"
        "<aside>More</aside><form><input value=x>Search</form><footer>&copy; me</footer></body></html>"
    )
    assert htmltext.main_text(page) == "A head First & best line of the text that goes on for a while. Ok."
    assert htmltext.main_text(None) == htmltext.main_text("<p") == ""
    rows = spark.createDataFrame([(1, "u", page), (2, None, None)], "page_id long, url string, html string")
    assert [r.n_chars for r in htmltext.extract(rows).orderBy("page_id").collect()] == [66, 0]
    small = spark.read.parquet(f"{SMALL}/pages.parquet")
    for page_id, html in small.select("page_id", "html").collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", html, re.S)[1]
        import html as entities

        assert htmltext.main_text(html) == " ".join(entities.unescape(re.sub("<[^>]*>", " ", inner)).split()), page_id


def prose(k: int, n: int) -> str:
    return " ".join(f"word{k}n{j}" for j in range(n))


@pytest.mark.parametrize(
    "before, most, after",
    [
        (f"<div class=lead><p>{prose(1, 9)}</p></div>", "<div class=body>" + "".join(f"<p>{prose(k, 60)}</p>" for k in range(2, 7)) + "</div>", ""),
        ("<h1>A head</h1>", "<div class=body>" + "".join(f"<p>{prose(k, 60)}</p>" for k in range(2, 7)) + "</div>", ""),
        (f"<p>{prose(1, 6)}</p><p>{prose(2, 6)}</p>", f"<pre>{prose(3, 400)}</pre>", f"<p>{prose(4, 6)}</p><p>{prose(5, 6)}</p>"),
        (f"<p>{prose(1, 6)}</p>", f"<blockquote><p>{prose(3, 300)}</p><p>{prose(7, 300)}</p></blockquote>", f"<p>{prose(4, 6)}</p>"),
        (f"<p>{prose(1, 6)}</p>", f"<table><tbody><tr><td>{prose(3, 200)}</td><td>{prose(7, 200)}</td></tr></tbody></table>", f"<p>{prose(4, 6)}</p>"),
        (f"<p>{prose(1, 6)}</p><p>{prose(2, 6)}</p>", "<ul>" + "".join(f"<li>{prose(k, 40)}</li>" for k in range(3, 20)) + "</ul>", f"<p>{prose(1, 6)}</p>"),
    ],
)
@pytest.mark.parametrize("around", ["{}", "<div>{}</div>", "<article>{}</article>"])
def test_main_text_keeps_what_stands_beside_the_largest_container(around, before, most, after):
    whole = before + most + after
    page = "<html><head><title>t</title></head><body><nav><a>Home</a><a>News</a></nav>{}<footer>me</footer></body></html>"
    assert htmltext.main_text(page.format(around.format(whole))) == " ".join(re.sub("<[^>]*>", " ", whole).split())


@pytest.mark.parametrize(
    "names",
    ["class='content has-sidebar'", "class='elementor-widget elementor-widget-text-editor'", "id='search-page'",
     "class='no-comments'", "class='social-policy'", "class='widget'"],
)
def test_main_text_of_layout_wrappers_with_marks_in_their_names(names):
    text = "".join(f"<p>{prose(k, 60)}</p>" for k in range(4))
    want = " ".join(re.sub("<[^>]*>", " ", text).split())
    junk = "<div class='comment-list'><p>I like this very much indeed</p></div><div class='my-share-x'><a>One</a><a>Two</a></div>"
    page = "<html><body><nav><a>Home</a></nav>{}" + junk + "<footer>me</footer></body></html>"
    assert htmltext.main_text(page.format(f"<div {names}>{text}</div>")) == want
    assert htmltext.main_text(page.format(f"<article><div {names}>{text}</div></article>")) == want
    if names != "class='widget'":
        parts = "".join(f"<div {names}>{p}</p></div>" for p in text.split("</p>")[:-1])
        assert htmltext.main_text(page.format(parts)) == want


def test_mixing_reaches_the_weights(small, odd):
    wanted = mixing.Mixture(weights=(("src0", 3.0), ("src1", 1.0)), epochs=50.0)
    some = small.where("source in ('src0', 'src1')")
    n = {r.source: r["count"] for r in mixing.mix(some, wanted).groupBy("source").count().collect()}
    assert abs(n["src0"] / n["src1"] - 3) < 0.6
    once = sorted(map(tuple, mixing.mix(small).select("doc_id", "copy").collect()))
    assert once == sorted(map(tuple, mixing.mix(small.repartition(7)).select("doc_id", "copy").collect()))
    assert mixing.mix(odd).where("doc_id = 8").count() % 2 == 0
    clashing = small.selectExpr("*", "7 AS rate", "8 AS parts", "9 AS cdf", "-1 AS copy")
    assert sorted(map(tuple, mixing.mix(clashing).where("rate = 7 and parts = 8 and cdf = 9").select("doc_id", "copy").collect())) == once
    assert mixing.mix(small.where("false")).count() == 0


def test_mixing_draws_each_row_with_a_null_id_for_itself(spark):
    """A third of the rows has no id; some of them are equal."""
    docs = spark.range(9_000).selectExpr(
        "if(id % 3 = 0, null, id) AS doc_id", "if(id % 15 < 6, 'same', concat('text ', id)) AS text", "'xx' AS lang",
        "if(id % 9 < 6, 'big', if(id % 2 = 0, 'small', null)) AS source", "1L AS n_chars",
    )
    rate = {r._source: r.rate for r in mixing.rates(docs, mixing.Mixture()).collect()}
    out = mixing.mix(docs)
    for nameless in ("doc_id is null", "doc_id is null and text = 'same'", "doc_id is not null"):
        n = {r.source: r["count"] for r in docs.where(nameless).groupBy("source").count().collect()}
        got = {r.source: r["count"] for r in out.where(nameless).groupBy("source").count().collect()}
        assert set(n) == set(rate)
        for source, rows in n.items():
            mean = rows * rate[source]
            assert abs(got[source] - mean) < 5 * mean**0.5, (nameless, source)
    assert sorted(map(str, out.collect())) == sorted(map(str, mixing.mix(docs.repartition(7)).collect()))
    part = out.where("doc_id is null").groupBy(F.spark_partition_id()).count().collect()
    assert len(part) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_mixing_draws_large_rates_in_parts(spark):
    docs = spark.range(200).selectExpr("id AS doc_id", "'t' AS text", "if(id < 150, 'a', if(id < 190, 'b', null)) AS source")
    large = mixing.Mixture(weights=(("a", 1.0), ("b", 1.0), ("~", 1.0)), epochs=450.0)
    listed = {r._source: (r.rate, r.parts) for r in mixing.rates(docs, large).collect()}
    assert listed == {"a": (200.0, 1), "b": (750.0, 2), None: (3000.0, 6)}
    n = collections.Counter((r.source, r.doc_id) for r in mixing.mix(docs, large).collect())
    for source, rows in (("a", 150), ("b", 40), (None, 10)):
        rate, got = listed[source][0], [v for (s, _), v in n.items() if s == source]
        assert len(got) == rows and abs(sum(got) - rows * rate) < 5 * (rows * rate) ** 0.5
        assert len(set(got)) > 1 and max(abs(v - rate) for v in got) < 6 * rate**0.5
    # The production weights: one row in the smallest of two sources.
    one = spark.range(1_002_001).selectExpr("id AS doc_id", "if(id = 0, 'few', 'many') AS source")
    got = mixing.mixed(one).where("source = 'few'").count()
    assert abs(got - 1_002_001 / 1_002) < 6 * 1_000**0.5


def test_fingerprints(small, odd):
    for docs in (small, odd.where("doc_id is not null").dropDuplicates(["doc_id"])):
        rows = sorted(texts_of(docs), reverse=True)
        got = {r.doc_id: r for r in fingerprint.edited_pairs(docs).collect()}
        for k, (key, text) in enumerate(rows):
            following = rows[(k + 1) % len(rows)][1]
            half = len(text) // 2
            edited = text[: len(text) - half] + following[:half]
            assert got[key].n_chars == len(text)
            assert got[key].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            x, y = sets_by_hand(text), sets_by_hand(edited)
            true = len(x & y) / len(x | y) if x | y else 1.0
            assert abs(got[key].near_edited - true) < 0.25
    assert fingerprint.edited_pairs(odd.where("false")).count() == 0


def test_ids_equal_the_tokenizer_on_mixed_texts():
    from tokenizers import Tokenizer

    settings, rng = packing.PackSettings(), np.random.default_rng(11)
    plain, own = Tokenizer.from_file(settings.vocabulary), packing.Encoder(settings)
    parts = ["the ", "Straße", " don't", "  ", "\n\n", "\t", "1234567", "日本語", "привет ", "🙂👍🏽", "e\u0301", "\u00a0", "...", "x" * 50, "'S", "\r\n", "{}();", "\x00", "ﷺ"]
    for _ in range(1500):
        text = "".join(rng.choice(parts, rng.integers(0, 25)))
        text += "".join(map(chr, rng.integers(32, 0x2FFF, rng.integers(0, 6))))
        assert np.frombuffer(own.encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_packing_covers_every_id_once(small, odd):
    from tokenizers import Tokenizer

    settings = packing.PackSettings()
    plain = Tokenizer.from_file(settings.vocabulary)
    for docs in (small.limit(60), odd.where("doc_id is not null").dropDuplicates(["doc_id"]).coalesce(1)):
        ids = {k: [*plain.encode(t, add_special_tokens=False).ids, 0] for k, t in texts_of(docs)}
        rows = packing.pack(docs, settings, run_chars=20_000).collect()
        by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
        for r in rows:
            by_doc[r.doc_id].append(r)
            by_sequence[r.sequence_id].append(r)
            own = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
            assert zlib.crc32(own.tobytes()) == r.ids_crc32 and len(ids[r.doc_id]) == r.doc_tokens
        assert set(by_doc) == set(ids)
        for key, found in by_doc.items():
            assert [r.start for r in sorted(found, key=lambda r: r.start)][0] == 0
            assert sum(r.length for r in found) == len(ids[key])
        lengths = []
        for found in by_sequence.values():
            at = 0
            for r in sorted(found, key=lambda r: r.offset):
                assert r.offset == at
                at += r.length
            lengths.append(at)
        assert max(lengths) <= 1024
        padding = sum(0 if n & (n - 1) == 0 else 1024 - n for n in lengths)
        assert padding <= 0.02 * sum(lengths) + 1024
    assert packing.pack(odd.where("false")).count() == 0


def unlike(k: int) -> str:
    return " ".join(f"w{k}x{j}" for j in range(40))


#: Null and repeated ids: copies, near copies (one word more), unlinked texts, texts without words.
NAMELESS = [
    *((None, unlike(k)) for k in range(6)), (None, unlike(0)), (None, unlike(6)), (70, unlike(6) + " more"), (71, unlike(6)),
    (7, unlike(7)), (7, unlike(8)), (7, unlike(8)), (9, unlike(9)), (9, unlike(9) + " more"), (None, unlike(10)),
    (None, unlike(10) + " more"), (12, "?! ..."), (13, ""), (14, None), (-3, unlike(11)), (-3, unlike(12)), (5, unlike(12) + " more"),
]


def stay_by_hand(rows: list[tuple]) -> list[list[tuple]]:
    """Groups of linked rows, of each of which one with the smallest id, nulls last, stays."""
    sets, groups = [sets_by_hand(t or "") for _, t in rows], []
    for k, x in enumerate(sets):
        linked = [g for g in groups if x and any(100 * len(x & sets[j]) >= 75 * len(x | sets[j]) for j in g)]
        groups = [g for g in groups if g not in linked] + [[k, *(j for g in linked for j in g)]]
    least = [min((rows[j][0] is None, rows[j][0] or 0) for j in g) for g in groups]
    return [[rows[j] for j in g if (rows[j][0] is None, rows[j][0] or 0) == low] for g, low in zip(groups, least)]


def test_near_duplicates_with_null_and_repeated_ids(spark, folder, monkeypatch):
    docs = spark.createDataFrame(NAMELESS, "doc_id long, text string").selectExpr("*", "'en' AS lang", "'s' AS source", "1L AS n_chars")
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, SMALL).collect()]
    groups = stay_by_hand(NAMELESS)
    assert len(kept) == len(groups) == 16
    for allowed in groups:
        assert sum(kept.count(one) for one in set(allowed)) == 1, allowed

    # The whole run, with no row repeated or left out by the mixture: tokens per id are those of the rows that stay.
    from tokenizers import Tokenizer

    docs.write.parquet(folder("documents.parquet"))
    monkeypatch.setattr(corpus_pipeline, "STAGES", [s for s in corpus_pipeline.STAGES if s[0] not in ("language_id", "target_weights")])
    plain = Tokenizer.from_file(packing.PackSettings().vocabulary)
    # Repeats of 200 bytes are gone after near duplicates, as unlike() texts have nothing in common.
    got, want = collections.Counter(), collections.Counter()
    for r in corpus_pipeline.run(spark, folder("")).collect():
        got[r.doc_id] += r.length
    sizes = collections.defaultdict(set)
    for group in groups:
        for key, text in group:
            sizes[key].add(text or "")
    for key, text in kept:
        want[key] += len(plain.encode(text or "", add_special_tokens=False).ids) + 1
    assert set(got) == set(sizes) and got == want


def test_pipeline(spark, small, folder):
    docs, kept = small, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, SMALL).write.parquet(folder(name))
        docs = spark.read.parquet(folder(name))
        assert docs.columns == small.columns
        kept.append(docs.count())
    before = spark.read.parquet(folder("language_id"))
    one = {root.component_id for root in jaccard.joined(before).collect()}
    assert {r.doc_id for r in spark.read.parquet(folder("near_duplicates")).collect()} == one
    assert kept[2] == kept[1] and corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() > 0


@pytest.mark.parametrize("bits", [64, 1 << 25])
def test_sieve_lets_all_keys_through_and_few_others(spark, monkeypatch, bits):
    monkeypatch.setattr(sieve, "BITS", bits)
    rows = spark.range(2_000).selectExpr("nullif(id, 7) AS doc_id", "id AS row", "1 AS _cell2", "'t' AS text")
    keys = rows.where("row % 100 = 7").selectExpr("doc_id AS _id", "row AS _row")
    found = sieve.sifted(rows, ["doc_id", "row"], keys, ["_id", "_row"])
    assert found.columns == rows.columns
    kept = {r.row for r in found.collect()}
    assert kept >= {k for k in range(2_000) if k % 100 == 7} and len(kept) < (2_000 if bits == 64 else 30)
    assert sieve.sifted(rows, ["doc_id"], keys.where("false"), ["_id"]).count() == 0
