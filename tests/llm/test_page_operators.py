"""Pages: url rules, main text, WARC derivatives."""

from __future__ import annotations

import gzip
import html
import re

import pytest

from tests.llm.conftest import SF
from tripyard.llm import site_tree, url_rules, warc
from tripyard.llm.markup import read_page
from tripyard.llm.queries import URL_RULES

PAGE_DDL = "page_id long, url string, html string, host string, key long, text string, verdict string, path string, node long, rank long"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "h", 1, "t", "v", "p", 1, 1) for r in rows], PAGE_DDL)


# -------------------------------------------------------------------------------------- url rules
URLS = [
    None, "", "no scheme", "http://", "http://a.net", "http://a.net/", "HTTP://WWW.Example.NET/en/x?y#z", "http://example.net/EN/",
    "http://x.example.net/en/", "http://badexample.net/en/", "http://example.com/de/1", "http://a.b.example.com/de", "http://org/fr/",
    "http://example.org/fr/a#b", "http://example.org#fr/", "x://y://net/z", "http://net/", "http://networks/", "http://a.net?x=/",
    "http://..net/", "http://ÉÜ.net/é", "http://a.net/\n/b", "http://user@a.net:80/en/",
]


def _brute(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h), len(p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, default))
    return host, path, best[2], best[3]


def _judged(spark, urls, rules, **more):
    df = pages(spark, [(i, u, "") for i, u in enumerate(urls)])
    out = url_rules.judge_urls(df, spark.createDataFrame(rules, "host string, path string, verdict string"), **more)
    return {r.page_id: tuple(r)[1:] for r in out.collect()}


def test_url_rules_equal_brute_force(spark):
    urls = URLS + [r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert _judged(spark, urls, URL_RULES) == {i: _brute(u, URL_RULES) for i, u in enumerate(urls)}


def test_nested_rules_in_blocks(spark, monkeypatch):
    """Many nested rules, swept in several blocks, ties between verdicts included."""
    rules = [(h, p, v) for i, h in enumerate(["net", "a.net", "b.a.net", "c.net", "com"]) for p, v in (("/", "block"), ("/x/", "allow"), (f"/x/{i}", "block"))]
    urls = [f"http://{h}{p}" for h in ("net", "a.net", "z.a.net", "q.b.a.net", "c.net", "com", "d.com") for p in ("", "/", "/x/", "/x/1", "/x/2/3")]
    want = {i: _brute(u, rules) for i, u in enumerate(urls)}
    assert _judged(spark, urls, rules) == want
    monkeypatch.setattr(url_rules, "BLOCK_RULES", 4)
    assert _judged(spark, urls, rules + [("a.net", "/", "allow"), (None, "/", "block"), ("", "/", "block")]) == want


def test_many_paths_on_one_host(spark):
    """Nested and repeated prefixes of one host's paths; a url is compared with few of many rules."""
    rules = [("a.net", f"/{'x' * i}/", "block") for i in range(30)] + [("a.net", f"/{'x' * i}", "allow") for i in range(1, 60, 7)]
    rules += [("a.net", "", "block"), ("net", "/xx/deep/er/", "block"), ("b.a.net", "/xxx/y", "allow")] + [("a.net", f"/p/{i}/", "block") for i in range(500)]
    urls = [f"http://{h}/{p}" for h in ("a.net", "b.a.net", "net", "c.net") for p in ("", "x", "xx/deep/er/1", "xxx/y", "xxx/z", "x" * 31, "p/7/", "p/77", "q")]
    assert _judged(spark, urls, rules) == {i: _brute(u, rules) for i, u in enumerate(urls)}

    class Counted(str):
        calls = 0

        def startswith(self, *a):
            Counted.calls += 1
            return super().startswith(*a)

    paths = url_rules.Paths([(f"/p/{i}/", f"r{i}", "block") for i in range(10_000)])
    assert paths.longest(Counted("/p/5000/x"))[1] == "r5000" and paths.longest(Counted("/p/5000")) is None and Counted.calls <= 4


def test_url_rules_of_empty_tables(spark):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert url_rules.judge_urls(pages(spark, []), none).count() == 0
    assert [r.verdict for r in url_rules.judge_urls(pages(spark, [(1, "http://a.net/", "")]), none, default="block").collect()] == ["block"]


# -------------------------------------------------------------------------------------- main text
def _article(page: str) -> str:
    """The generated pages' article, by its fixed layout."""
    inner = re.sub(r"<[^>]*$", "", page.split("<article>", 1)[1].split("</article>")[0])
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(b for b in blocks if b)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_main_text_of_whole_table(spark, sf):
    table = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet")
    want = {r.page_id: _article(r.html) for r in table.collect()}
    got = {r.page_id: r for r in site_tree.extract(table).collect()}
    assert {k: r.text for k, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())


@pytest.mark.parametrize("carried", [site_tree.CARRIED_BYTES, 0])
def test_site_tree_finds_unnamed_frames(spark, monkeypatch, carried):
    """Without any telling name, what all pages of the host share goes and what each has alone stays; by either way."""
    monkeypatch.setattr(site_tree, "CARRIED_BYTES", carried)
    rows = [
        (i, f"http://site.net/{i}", f"<body><div class=qa><div>Home</div><div>About us</div></div><div class=qb><p>Text {i} of page {i}.</p>"
         + "".join(f"<p>More {i * 31 + j}.</p>" for j in range(i % 4)) + "</div><div class=qc>All rights</div></body>")
        for i in range(30)
    ]
    got = {r.page_id: r.text for r in site_tree.extract(pages(spark, rows)).collect()}
    assert got == {i: "\n".join([f"Text {i} of page {i}.", *(f"More {i * 31 + j}." for j in range(i % 4))]) for i in range(30)}


def test_copies_of_one_page_keep_their_article(spark):
    page = "<nav>Menu</nav><article><h1>T</h1><p>One.</p><div><p>Two.</p></div></article><div class=ad>Buy</div>"
    got = [r.text for r in site_tree.extract(pages(spark, [(i, "http://a.net/", page) for i in range(4)])).collect()]
    assert got == ["T\nOne.\nTwo."] * 4


def test_articles_inside_noise_do_not_hide_the_main_text(spark):
    """Comments and teasers that are article elements: the page is judged as one without an article."""
    rows = [
        (i, f"http://site.net/{i}", f"<body><div class=qa><div>Home</div></div><div class=content><p>Text {i} of page {i}.</p>"
         + "".join(f"<p>More {i * 31 + j}.</p>" for j in range(i % 4)) + f"</div><section class=comments><article><p>Reader {i}</p></article></section>"
         + f"<aside><article><p>Teaser {i}</p></article></aside></body>")
        for i in range(30)
    ]
    got = {r.page_id: r.text for r in site_tree.extract(pages(spark, rows)).collect()}
    assert got == {i: "\n".join([f"Text {i} of page {i}.", *(f"More {i * 31 + j}." for j in range(i % 4))]) for i in range(30)}


@pytest.mark.parametrize("carried", [site_tree.CARRIED_BYTES, 0])
def test_names_inside_an_article(spark, monkeypatch, carried):
    """Whole names of a purpose go on large and small hosts, compounds of other words stay, a header of the article stays."""
    monkeypatch.setattr(site_tree, "CARRIED_BYTES", carried)
    rows = [
        (i, f"http://{'site' if i else 'single'}.net/{i}", f"<article><header class=entry-header><h1>Title {i}</h1></header><p>Text {i}.</p>"
         f"<section class=related-work><p>Work {i}</p></section><table class=share-price><tr><td>Price {i}</td></tr></table>"
         f"<section class=comments><p>Reader {i} says {'so ' * i}</p></section><div class=cookie_notice>{'<p>Own</p>' * (i % 5)}Note {i}</div>"
         f"<div class=top-banner>Buy {i}</div><div id=comment_12>Answer {i}</div><div class=share><div>Share this</div></div></article>"
         "<div class=comments-list><p>Reader</p></div>")
        for i in range(31)
    ]
    got = {r.page_id: r.text for r in site_tree.extract(pages(spark, rows)).collect()}
    assert got == {i: f"Title {i}\nText {i}.\nWork {i}\nPrice {i}" for i in range(31)}


def test_purpose_of_names():
    for name in ("comments", "comments-list", "top-banner", "comment_12", "cookie-notice", "ad-slot", "site-header", "related-posts", "share_buttons"):
        assert site_tree.purpose_words(name), name
    for name in ("related-work", "share-price", "entry-header", "main-content", "list", "12", "", "commentary", "adventure", "post"):
        assert not site_tree.purpose_words(name), name


def test_teaser_articles_beside_the_text(spark):
    """An article that is smaller than another branch is not what the page is about; one beside small frames is."""
    long_text = "It goes on and on, as main texts do. " * 5
    rows = [
        (1, "http://a.net/", f"<body><div class=content><p>{long_text}</p></div><div class=latest><article><p>Teaser</p></article></div></body>"),
        (2, "http://b.net/", f"<body><div class=x>Frame</div><article><p>{long_text}</p></article><div class=y>Another frame</div></body>"),
        (3, "http://c.net/", f"<body><div class=w><p>{long_text}</p><article><p>Teaser</p></article></div></body>"),
    ]
    got = {r.page_id: r.text for r in site_tree.extract(pages(spark, rows)).collect()}
    assert got == dict.fromkeys((1, 2, 3), long_text.strip())


@pytest.mark.parametrize("carried", [site_tree.CARRIED_BYTES, 0])
def test_hosts_of_one_page_are_judged_with_their_like(spark, monkeypatch, carried):
    """What many small hosts show alike goes, and a large host's own node of that name is judged by its own pages."""
    monkeypatch.setattr(site_tree, "CARRIED_BYTES", carried)

    def page(i: int, frame: str) -> str:
        more = "".join(f"<p>More {i * 31 + j}.</p>" for j in range(i % 4))
        return f"<body><div class=qa><div>{frame}</div></div><div class=qb><p>Text {i} of page {i}.</p>{more}</div><div class=qc>All rights</div></body>"

    small = [(i, f"http://host{i}.net/", page(i, "Welcome")) for i in range(30)]
    large = [(100 + i, "http://large.net/", page(i, f"Daily news {i} " + "and more" * (i % 3))) for i in range(20)]
    got = {r.page_id: r.text for r in site_tree.extract(pages(spark, small + large)).collect()}
    for i in range(30):
        assert got[i] == "\n".join([f"Text {i} of page {i}.", *(f"More {i * 31 + j}." for j in range(i % 4))])
    assert all(got[100 + i].startswith(f"Daily news {i}") and "All rights" not in got[100 + i] for i in range(20))


def test_main_text_of_odd_pages(spark):
    rows = [
        (1, None, None), (2, "x", ""), (3, "http://a.net/", "plain  text\n here"), (None, "http://a.net/", "<p>a &amp b &#65;&eacute;<br>c"),
        (5, "http://a.net/", "<article><p>x<script>var a='</p>';</script>y<!-- no --><p>z<nav>m</nav><form>f</form></article><footer>t"),
        (6, "http://a.net/", "<article>" + "<p>long words here</p>" * 50_000), (7, "http://b.net/", "<" * 1000 + "a" + ">" * 10),
        (7, "http://b.net/", "<div " + "a=\"" * 2000),
    ]
    got = sorted(((str(r.page_id), r.text) for r in site_tree.extract(pages(spark, rows)).collect()), key=lambda x: (x[0], len(x[1])))
    assert dict(got)["1"] == "" and dict(got)["2"] == "" and dict(got)["3"] == "plain text here"
    assert dict(got)["None"] == "a & b Aé c" and dict(got)["5"] == "xy\nz"
    assert dict(got)["6"].count("\n") == 49_999 and len(got) == len(rows)
    assert site_tree.extract(pages(spark, [])).count() == 0


def test_reader_closes_what_is_left_open():
    blocks, _ = read_page("<body><ul><li>a<li>b<ul><li>c</ul></ul><table><tr><td>d<td>e<tr><td>f</table><p>g<div>h</div></p>i")
    assert [t for _, t in blocks] == list("abcdefghi")


# ------------------------------------------------------------------------------------------- WARC
def test_derivatives_round_trip(spark):
    table = spark.read.parquet(f"{SF}/pages.parquet")
    records = warc.derive_pages(table)
    source = {r.page_id: warc.response_of_page(r.url, r.html.encode(), "1970-01-01T00:00:00Z") for r in table.collect()}
    rows = records.collect()
    assert len(rows) == 2 * len(source)
    file = b"".join(r.member for r in warc.members(records).collect())
    back = {warc.value(h, "WARC-Record-ID"): (h, b) for h, b in warc.read_records(file)}
    assert len(back) == len(rows)
    for r in rows:
        headers, block = source[r.page_id]
        h, b = back[r.record_id]
        assert bytes(r.record) == warc.write_record(h, b) and warc.sha1(b) == r.block_digest == warc.value(h, "WARC-Block-Digest")
        assert r.refers_to == warc.value(headers, "WARC-Record-ID") == warc.value(h, "WARC-Refers-To")
        assert warc.value(h, "WARC-Target-URI") == warc.value(headers, "WARC-Target-URI")
        if r.record_type == "metadata":
            fields = dict(line.split(": ", 1) for line in b.decode().splitlines())
            assert fields["source-WARC-Block-Digest"] == warc.sha1(block)
            assert fields["source-WARC-Payload-Digest"] == warc.sha1(warc.http_message(block)[2])
            assert back[fields["conversion-record-id"]][0][0] == ("WARC-Type", "conversion")
            assert fields["conversion-digest"] == warc.sha1(back[fields["conversion-record-id"]][1])
            assert fields["http-header-Content-Type"] == "text/html; charset=utf-8"


def test_records_of_files(spark, tmp_path):
    """Gzip members and plain records, folded headers, other charsets, wrong digests, a cut-off end."""
    body = "<p>Grüße</p>".encode("latin-1")
    block = b"HTTP/1.1 404 Not Found\r\nContent-Type: text/html; charset=ISO-8859-1\r\nX-A: b\r\n\r\n" + body
    head = [("WARC-Type", "response"), ("WARC-Record-ID", "<urn:uuid:1>"), ("WARC-Date", "2020-01-01T00:00:00Z"), ("WARC-Block-Digest", "sha1:WRONG")]
    request = warc.write_record([("WARC-Type", "request")], b"GET / HTTP/1.1\r\n\r\n")
    plain = request + warc.write_record(head, block)
    (tmp_path / "a.warc").write_bytes(plain + b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 99\r\n\r\ncut")
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(request) + gzip.compress(warc.write_record(head, b"no http block")))
    files = spark.read.format("binaryFile").load(str(tmp_path))
    got = [next(iter(warc.read_records(bytes(r.record)))) for r in warc.derive_files(files).collect()]
    assert len(got) == 4
    texts = sorted(b.decode() for h, b in got if warc.value(h, "WARC-Type") == "conversion")
    assert texts == ["Grüße", "no http block"]
    meta = next(b.decode() for h, b in got if warc.value(h, "WARC-Type") == "metadata" and b"404" in b)
    assert "source-WARC-Block-Digest: sha1:WRONG\r\n" in meta and f"source-WARC-Block-Digest-mismatch: {warc.sha1(block)}\r\n" in meta
    assert all(warc.value(h, "WARC-Refers-To") == "<urn:uuid:1>" and warc.value(h, "WARC-Date") == "2020-01-01T00:00:00Z" for h, _ in got)


def test_derivatives_of_odd_pages(spark):
    rows = [(1, None, None), (1, None, None), (None, "http://a/", ""), (2, "http://a/", "x" * 200_000)]
    got = warc.derive_pages(pages(spark, rows)).collect()
    assert len(got) == 8 and len({r.record_id for r in got}) == 6
    assert {r.n_bytes for r in got if r.page_id == 2 and r.record_type == "conversion"} == {200_000}
    assert warc.derive_pages(pages(spark, [])).count() == 0
