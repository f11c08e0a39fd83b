"""Operators over pages, URLs, vectors, personal data and labels."""

from __future__ import annotations

import random
import re
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).parent.parent))

from compare import connect, differences  # noqa: E402
from frames import no_documents, odd_documents, words  # noqa: E402

from sedimenta.llm import ann, pii  # noqa: E402
from sedimenta.llm.main_text import main_text, text_blocks  # noqa: E402
from sedimenta.llm.oracle import ORACLE  # noqa: E402
from sedimenta.llm.queries import HOST_RULES, PATTERN_RULES, QUERIES  # noqa: E402
from sedimenta.llm.toxicity import ChainSettings, fit_chain, toxicity, without_toxic  # noqa: E402
from sedimenta.llm.url_rules import PatternRule, judge_urls, rule_index  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLE[name]) == []


# --- personal data ------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(part) <= 255 for part in match.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind != "phone" or 8 <= len(digits) <= 15


def plain_spans(text):
    return [
        (kind, m.start(), m.end())
        for kind, pattern in PLAIN.items()
        for m in re.finditer(pattern, text or "")
        if holds(kind, m[0])
    ]


def hard_texts():
    rng = random.Random(4)
    parts = ["a@b.c", "_e@f.gh", "a@b..c", "x@y.z.", "@", "..", "1.2.3.4", "256.1.1.1", "0001.2.3.255",
             "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1111-1", "12  34", "+1 (262) 555-3752",
             "+49 30 1234567890123456", "+1", "é", "\n", " ", "-", "+", "日", "a.b-c@d-e.f", "5500005555555559"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(400)]


def test_base_spans(spark):
    texts = [*hard_texts(), None, "", "1" * 5_000, "a" * 5_000 + "@", "a.b@" + "c." * 3_000 + "d"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.base_spans(df).collect():
        found = [(k, s.start, s.stop) for k in pii.KINDS for s in r[k]]
        assert found == plain_spans(texts[r.doc_id]), texts[r.doc_id]


def test_words_that_tell_of_an_identifier(spark):
    """A rare word that keeps company with an address goes with it, common words stay."""
    told = [(n, f"{words(30, n)} then zanzibar wrote to me@site.org and {words(20, 90 + n)} then")
            for n in range(5)]
    clean = [(50 + n, f"{words(60, 300 + n)} then and wrote to") for n in range(60)]
    alone = [(200, words(30, 400) + " zanzibar")]
    df = spark.createDataFrame([*told, *clean, *alone], "doc_id long, text string")
    found = {r.row.doc_id: r for r in pii.find_personal_data(df).collect()}
    assert len(found) == 66
    for n, text in told:
        marked = {text[s.start : s.stop] for s in found[n].terms}
        assert "zanzibar" in marked and "then" not in marked
    assert all(not found[n].terms and not found[n].base for n in [*range(50, 110), 200])
    texts = {r.doc_id: r.text for r in pii.sanitised(df).collect()}
    assert "zanzibar" not in texts[0] and "<email>" in texts[0] and "@" not in texts[0]
    assert texts[200].endswith("zanzibar") and texts[50] == dict(clean)[50]


def test_sanitised_keeps_rows_and_columns(spark):
    df = odd_documents(spark)
    out = pii.sanitised(df)
    assert out.columns == df.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, df.collect()))
    text = "é 1.2.3.4, +1 262 555 3752 and 4111 1111 1111 1111!"
    one = df.limit(1).withColumn("text", F.lit(text))
    assert pii.sanitised(one).head().text == "é <ip>, <phone> and <card>!"
    assert pii.sanitised(no_documents(spark)).count() == 0


def test_personal_data_runs_no_python(spark, plan):
    df = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert "Python" not in plan(pii.sanitised(df)) and "InArrow" not in plan(pii.sanitised(df))


# --- URLs ---------------------------------------------------------------------------


def test_judged_urls(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x", "http://xexample.com/en/",
            "http://a.example.com/en/1?x://y", "https://de.net/es", "https://de.net/es/a#b",
            "http://blog.spam-farm.org/en/1.html", "http://casino-win.org/", "http://casino-win.org/"]
    df = spark.createDataFrame([(n, u, "old") for n, u in enumerate(urls)], "page_id long, url string, host string")
    rows = sorted(judge_urls(df, "url", HOST_RULES, PATTERN_RULES).collect())
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows}
    assert len(rows) == len(urls)
    assert found[0] == found[1] == found[2] == found[3] == ("", "", None, "allow")
    assert found[4] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert found[5] == ("xexample.com", "/en/", "com/", "allow")
    assert found[6] == ("a.example.com", "/en/1", "example.com/en/", "block")
    assert found[7] == ("de.net", "/es", None, "allow")
    assert found[8] == ("de.net", "/es/a", "net/es/", "block")
    assert found[9][2:] == (None, "allow")
    assert found[10] == found[11] == ("casino-win.org", "/", None, "block")
    assert judge_urls(df.limit(0), "url", HOST_RULES, PATTERN_RULES).count() == 0


def test_rules_stand_under_their_rarest_token(spark):
    df = spark.createDataFrame([("http://a.com/one",), ("http://a.com/one/two",)], "url string")
    rules = [PatternRule("block", "/one/two^"), PatternRule("block", "*one*"), PatternRule("block", "|http://a.com^")]
    found = {r.pattern: r.token for r in rule_index(df, "url", rules).collect()}
    assert found == {"/one/two^": "two", "*one*": "", "|http://a.com^": "a"}


# --- pages --------------------------------------------------------------------------


def test_blocks():
    html = """<html><head><title>T</title></head><body class="has-sidebar"><div class="cookie-notice">We use</div>
    <header><h1>Site</h1></header><nav>menu<ul><li>x</nav><article><header><h1>Title &amp; more</h1></header>
    <p>One&nbsp;two<br>three <i>fo</i>ur<p>Five<div class="advert">Buy</div><ul><li>a<li>b</ul>
    <aside>side</aside><form><input>name</form><section id="comments"><p>Nice</p></section></article>
    <div>Outside</div><footer>end</footer></body></html>"""
    assert text_blocks(html) == (["Title & more", "One two three four", "Five", "a", "b"], True)
    assert text_blocks("<p>x <script>var a='<p>no</p>'</script>y<!-- z -->") == (["x y"], False)
    assert text_blocks(None) == ([], False) and text_blocks("") == ([], False)


def test_text_that_a_host_repeats_goes(spark):
    notice = "please support our little newspaper with a small gift each month " * 2
    pages = []
    for n in range(12):
        pages.append((n, f"http://a.org/{n}", f"<div>{words(60, n)}</div><div>{notice}</div>"))
    for n in range(12, 24):
        body = f"<article><p>{words(80, n)}</p><p>{notice}</p></article>"
        pages.append((n, f"http://b.org/{n}", body))
    quoted = words(30, 99)
    pages += [(24, "http://c.org/1", f"<article><p>{quoted}</p><p>{words(50, 98)}</p></article>"),
              (25, "http://c.org/2", f"<article><p>{quoted}</p><p>{words(50, 97)}</p></article>"),
              (26, None, None), (27, "http://c.org/3", "<nav>only a menu</nav>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = {r.row.page_id: r.text for r in main_text(df).collect()}
    assert len(found) == 28
    assert all(found[n] == words(60, n) for n in range(12))
    assert all(found[n] == words(80, n) for n in range(12, 24))
    assert found[24] == f"{quoted}\n\n{words(50, 98)}"
    assert found[26] == found[27] == ""
    copies = df.where("page_id = 24").select(F.explode(F.sequence(F.lit(0), F.lit(9))).alias("page_id"), "url", "html")
    assert {r.text for r in main_text(copies).collect()} == {found[24]}
    assert main_text(df.limit(0)).count() == 0


def test_names_of_elements_within_an_article():
    """Words of layout make a weak hint one, other words do not."""
    parts = {"share-price": True, "related-work": True, "search": True, "social-history": True,
             "share-buttons": False, "related posts": False, "notice": False, "top-banner": False,
             "user-comments": False}
    for name, stays in parts.items():
        blocks, _ = text_blocks(f"<article><p>Text<div class='{name}'>Part</div></article>")
        assert blocks == (["Text", "Part"] if stays else ["Text"]), name
    assert text_blocks("<div class='search'>Find</div><p>Text")[0] == ["Text"]


def test_notice_before_unique_text(spark):
    rows = [
        (100 * size + n, f"http://a{size}.org/", f"<p>{words(size, 5)}</p><p>{words(60, 100 + n)}</p>")
        for size in (1, 6, 15, 16, 20, 40) for n in range(12)
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.row.page_id: (r.text, r.n_removed) for r in main_text(df).collect()} == {
        n: (words(60, 100 + n % 100), 1) for n, *_ in rows
    }


def plain_main_text(pages):
    """Texts by (host, html), run by run over all pages of a host."""
    def runs(blocks):
        stream = [t for b in blocks for t in b.split()]
        long = {tuple(stream[i : i + 16]) for i in range(len(stream) - 15)}
        return long | {b for b in blocks if len(b.split()) < 16}

    parsed = {(host, html): text_blocks(html) for host, html in pages}
    found = {}
    for (host, html), (blocks, marked) in parsed.items():
        contents = {}
        for (h, _), (b, m) in parsed.items():
            if h == host:
                contents.setdefault(tuple(b), []).append(m)
        sets = {b: runs(b) for b in contents}
        most = max(3, -(-len(sets) // 2))

        def goes(run):
            holders = [b for b in sets if run in sets[b]]
            few = not marked and len(holders) >= 2 and not isinstance(run, str)
            return few or len(holders) >= most

        gone = {run for run in runs(blocks) if goes(run)}
        stream = [(t, n) for n, b in enumerate(blocks) for t in b.split()]
        covered = set()
        for i in range(len(stream) - 15):
            if tuple(t for t, _ in stream[i : i + 16]) in gone:
                covered |= set(range(i, i + 16))
        left = []
        for n, b in enumerate(blocks):
            places = [i for i, (_, k) in enumerate(stream) if k == n]
            share = len(covered.intersection(places)) / len(places)
            if share < 0.8 and b not in gone:
                left.append(b)
        parts = 2 if marked else 10
        if parts * len(" ".join(left).split()) < len(stream):
            left = blocks
        found[host, html] = "\n\n".join(left)
    return found


def test_main_text_against_brute_force(spark):
    """Marked and unmarked pages, notices of all sizes, parts of them, copies, repeated rows."""
    rng = random.Random(8)
    notices = [words(n, 500 + n) for n in (1, 3, 9, 15, 16, 17, 24, 40)]
    pages = []
    for n in range(300):
        blocks = []
        for _ in range(rng.randrange(6)):
            notice = rng.choice(notices).split()
            at = rng.choice([0, 0, 0, rng.randrange(len(notice))])
            own = words(rng.choice([0, 0, 2, 12, 50]), rng.randrange(300))
            blocks.append(rng.choice([f"{own} {' '.join(notice[at:])}", f"{' '.join(notice[at:])} {own}", own]))
        html = "".join(f"<p>{b}</p>" for b in blocks)
        host = rng.choice(["a.org", "a.org", "b.org", ""])
        pages.append((host, f"<article>{html}</article>" if rng.random() < 0.4 else html))
    pages += rng.sample(pages, 20)
    pages += [("c.org", f"<p>{words(9_000, 3)}</p>"), ("c.org", f"<p>{words(9_000, 3)} more</p>"),
              ("", None), ("c.org", "")]
    rows = [(n, f"http://{h}/x" if h else None, html, h, "mine", n) for n, (h, html) in enumerate(pages)]
    df = spark.createDataFrame(
        rows, "page int, url string, html string, host string, names string, kept int"
    )
    found = main_text(df).collect()
    expected = plain_main_text(pages)
    assert len(found) == len(pages) and found[0].row.names == "mine"
    assert sum(r.n_removed > 0 for r in found) > 30
    for r in found:
        assert r.text == expected[pages[r.row.page]], pages[r.row.page]


# --- vectors ------------------------------------------------------------------------


def test_nearest(spark):
    rng = np.random.default_rng(8)
    vectors = rng.standard_normal((1_500, 16)).astype(np.float32) * rng.uniform(0.5, 2, (1_500, 1))
    vectors[700:760] = vectors[700]
    rows = [(n, [float(np.float32(x)) for x in v]) for n, v in enumerate(vectors)]
    odd = [(2_000, None), (2_001, [0.0] * 16), (2_002, [float("nan")] * 16), (2_003, [float("inf")] * 16),
           (2_004, [None] * 16), (None, rows[0][1]), rows[5]]
    df = spark.createDataFrame([*rows, *odd], "vec_id long, embedding array<float>").withColumn("rank", F.lit(1))
    asked = df.where("vec_id % 50 = 0")
    found = {}
    for r in ann.nearest(df, asked, k=10).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    exact = vectors.astype(np.float32).astype(np.float64)
    hits = 0
    for query, got in found.items():
        scores = exact @ exact[query]
        scores[query] = -np.inf
        best = np.lexsort((np.arange(len(scores)), -scores))[:10]
        hits += len(set(best.tolist()) & {v for v, _ in got})
        assert all(abs(scores[v] - s) < 1e-9 for v, s in got)
        assert [s for _, s in got] == sorted((s for _, s in got), reverse=True)
    assert set(found) == set(range(0, 1_500, 50))
    assert hits / (10 * len(found)) > 0.95
    copies = [v for v, _ in found[700] if 700 <= v < 760]
    assert copies == list(range(701, 701 + len(copies)))
    assert ann.nearest(df.limit(0), asked.limit(0)).count() == 0
    few = ann.nearest(df.where("vec_id < 3"), df.where("vec_id < 3")).collect()
    assert sorted((r.query_id, r.rank) for r in few) == [(q, k) for q in range(3) for k in (1, 2)]


# --- toxicity -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for n in range(900):
        text, toxic, poor = words(60, n), n % 8 == 0, n % 8 == 1
        if toxic:
            parts = text.split()
            for word in rng.sample(["zork", "blarg", "fnord", "grault"], 2):
                parts.insert(rng.randrange(len(parts)), word)
            text = " ".join(parts)
        if poor:
            text = " ".join([words(1, n)] * 60)
        rows.append((n, text))
        labels.append((n, int(not poor), int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark, labelled):
    rows, labels = labelled
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([x for x in labels if x[0] < 600], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in toxicity(docs, known).collect()}
    truth = {n: (1 - quality, toxic) for n, quality, toxic in labels}
    for i, name in enumerate(("p_poor", "p_toxic")):
        right = [(found[n][name] >= 0.5) == bool(truth[n][i]) for n in range(600, 900)]
        assert sum(right) / len(right) > 0.97, name
    kept = without_toxic(docs, known)
    assert kept.columns == docs.columns and kept.count() == sum(not r.is_toxic for r in found.values())


def test_odd_labels(spark, labelled):
    docs = odd_documents(spark).withColumn("p_a", F.lit("old"))
    none = spark.createDataFrame([], "doc_id long, a int, b int")
    scored = fit_chain(docs, none, ["a", "b"]).score(docs)
    assert scored.columns == [*[c for c in docs.columns if c != "p_a"], "p_a", "p_b"]
    assert {(r.p_a, r.p_b) for r in scored.collect()} == {(0.0, 0.0)}
    assert scored.count() == docs.count()
    odd = spark.createDataFrame([(0, None, 1), (None, 1, 1), (3, 1, 1), (3, 0, 1)], "doc_id long, a int, b int")
    only = fit_chain(docs, odd, ["a", "b"], ChainSettings(sample=2)).score(docs)
    assert {(r.p_a, r.p_b) for r in only.collect()} == {(1.0, 1.0)}
    assert toxicity(no_documents(spark), none.selectExpr("doc_id", "a AS quality", "b AS toxic")).count() == 0


def test_places_of_very_many_matches(spark, monkeypatch):
    """Texts with more matches than are added up at once, and with many spans to replace."""
    from sedimenta.llm import pii

    monkeypatch.setattr(pii, "STRETCH", 4)
    monkeypatch.setattr(pii, "BLOCK", 16)
    texts = [
        "12 ab " * n + "".join(f"é{i} a{i}@b.co +1 234 567 89{i % 10} " for i in range(n))
        for n in (0, 1, 3, 4, 5, 17, 70)
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.find_personal_data(df).collect():
        text = r.row.text
        mails = [(m.start(), m.end(), m[0]) for m in re.finditer(r"a\d+@b\.co", text)]
        phones = [(m.start(), m.end(), m[0]) for m in re.finditer(r"\+1 234 567 89\d", text)]
        found = {k: [(s.start, s.stop, s.match) for s in r.base if s.kind == k] for k in pii.KINDS}
        assert (found["email"], found["phone"]) == (mails, phones)
    for r in pii.sanitised(df).collect():
        expected = re.sub(r"a\d+@b\.co", "<email>", texts[r.doc_id])
        assert r.text == re.sub(r"\+1 234 567 89\d", "<phone>", expected)


def test_a_text_with_a_hundred_thousand_matches(spark):
    from sedimenta.llm import pii

    text = "12 ab " * 100_000 + "me@you.com " * 3_000
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert pii.find_personal_data(df).select(F.size("base")).head()[0] == 3_000
    assert pii.sanitised(df).head().text == text.replace("me@you.com", "<email>")


def test_columns_named_like_results_stay_as_they_are(spark):
    """In a session that has observed a metric, too."""
    from pyspark.sql import Observation

    seen = Observation()
    spark.range(3).observe(seen, F.count("*").alias("n")).write.format("noop").mode("overwrite").save()
    assert seen.get["n"] == 3
    rows = [(n, words(40, n) + (" foul vile" if n % 5 == 0 else ""), "mine", 7.5) for n in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, is_toxic string, p_toxic double")
    labels = spark.createDataFrame(
        [(n, int(n % 7 > 0), int(n % 5 == 0)) for n in range(150)], "doc_id long, quality int, toxic int"
    )
    kept = without_toxic(docs, labels)
    assert kept.dtypes == docs.dtypes
    found = kept.collect()
    assert {(r.is_toxic, r.p_toxic) for r in found} == {("mine", 7.5)}
    assert {r.doc_id for r in found} == {n for n in range(200) if n % 5}


def test_copies_of_a_page_without_a_marked_article_keep_their_text(spark):
    """Also with NULL urls, and next to a page that marks the same text as its article."""
    def page(*texts):
        return "<html><body>" + "".join(f"<p>{t}</p>" for t in texts) + "</body></html>"

    text, other, notice = words(60, 31), words(50, 32), words(30, 33)
    rows = [
        (1, "http://a.example/x", page(text)), (2, "http://a.example/y", page(text)),
        (3, None, page(other)), (4, None, page(other)),
        (5, "http://b.example/1", page(text)),
        (6, "http://b.example/2", f"<html><body><article><p>{text}</p></article></body></html>"),
    ]
    # What different pages share goes all the same.
    own = {n: words(40, 300 + n) for n in range(10, 16)}
    rows += [(n, "http://c.example/p", page(own[n], notice)) for n in own]
    found = {r.row.page_id: r.text for r in main_text(
        spark.createDataFrame(rows, "page_id long, url string, html string")
    ).collect()}
    assert [found[n] for n in range(1, 7)] == [text, text, other, other, text, text]
    assert {n: found[n] for n in own} == own
