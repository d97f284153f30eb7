"""Feeds from files, table functions, streaming."""

import gzip
import json
import zlib
from datetime import datetime, timezone

from pyspark.sql import functions as F

from skeinflow.__main__ import main
from skeinflow.functions import terms
from skeinflow.operators import links
from skeinflow.operators import series as curves
from skeinflow.sources import documents, feed_xml, feeds, series
from skeinflow.streaming.articles import deduplicated, undated

RSS = """<?xml version="1.0"?><rss xmlns:dc="http://purl.org/dc/elements/1.1/"><channel>
<item><title>One &amp;lt;b&amp;gt;</title><link>https://e.com/1</link><description>&lt;p&gt;text&lt;/p&gt;</description><pubDate>Mon, 07 Sep 2026 07:00:00 +0900</pubDate></item>
<item><title>Two</title><guid>https://e.com/2</guid><dc:date>2026-09-07T07:00:00Z</dc:date></item>
<item><title></title><link>https://e.com/3</link></item></channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>Three</title><link rel="enclosure" href="https://e.com/x.mp3"/><link rel="alternate" href="https://e.com/4"/><updated>2026-09-08T00:00:00Z</updated><published>2026-09-07T00:00:00Z</published></entry></feed>"""


def test_items():
    rows = list(feed_xml.items(RSS.encode()))
    assert [(r[1], r[2], r[3]) for r in rows] == [("One <b>", "https://e.com/1", "text"), ("Two", "https://e.com/2", "")]
    (atom,) = feed_xml.items(("junk " + ATOM).encode())
    assert atom[2] == "https://e.com/4" and atom[4] == "2026-09-08T00:00:00Z"
    for bad in (b"<html><body>", b"<!DOCTYPE html><p>", b"nothing", b"<?xml version='1.0'?><rss>"):
        try:
            list(feed_xml.items(bad))
            raise AssertionError(bad)
        except feed_xml.FeedError:
            pass


def test_rdf_and_links():
    rdf = """<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns="http://purl.org/rss/1.0/"><item rdf:about="u"><title>Four</title><link> https://e.com/5 </link></item></rdf:RDF>"""
    ((_, title, link, _, _),) = feed_xml.items(rdf.encode())
    assert (title, link) == ("Four", "https://e.com/5")

    def of(body):
        rows = list(feed_xml.items(f"<rss><item><title>t</title>{body}</item></rss>".encode()))
        return rows[0][2] if rows else None

    assert of("<link href='https://a' rel='self'/><link>https://b</link>") == "https://b"
    assert of("<link href='https://a' rel='self'/><guid>https://c</guid>") == "https://a"
    assert of("<link href='https://a'/><link>https://b</link>") == "https://a"
    assert of("<guid> </guid><id>https://d</id>") == "https://d" and of("<guid>tag:x</guid><id>https://d</id>") is None
    assert list(feed_xml.items(b"<channel><item><title>t</title><link>https://x</link></item></channel>"))
    assert list(feed_xml.items(b"warning: <b>junk <?xml version='1.0'?><rss><item><title>t</title><link>https://x</link></item></rss>"))


def test_unpacked():
    raw = zlib.compressobj(wbits=-15)
    assert feeds.unpacked(gzip.compress(b"x"), "gzip") == feeds.unpacked(zlib.compress(b"x"), "deflate") == feeds.unpacked(raw.compress(b"x") + raw.flush(), "deflate") == b"x"


def test_read_feeds_isolates_errors(spark, tmp_path):
    (tmp_path / "a.xml").write_text(RSS)
    (tmp_path / "b.xml").write_text("<html>blocked</html>")
    (tmp_path / "c.xml").write_text("<rss><channel/></rss>")
    listed = [{"category": "미국", "tier": 1, "name": n, "url": (tmp_path / f"{n}.xml").as_uri()} for n in "abc"]
    (tmp_path / "sources.json").write_text(json.dumps({"feeds": listed, "candidate_feeds": [listed[0] | {"blocked_reason": "waf", "detail": "d"}]}))
    table = feeds.feed_table(spark, str(tmp_path / "sources.json"))
    assert table.count() == 3 and feeds.feed_table(spark, str(tmp_path / "sources.json"), "candidate_feeds").first()["blocked_reason"] == "waf"
    read = feeds.read_feeds(spark, [r.asDict() for r in table.collect()], retries=0)
    status = {r["name"]: (r["ok"], r["fetched"]) for r in feeds.status_of(read).collect()}
    assert status == {"a": (True, 2), "b": (False, 0), "c": (True, 0)}
    articles = feeds.articles_of(read).orderBy("seq").collect()
    assert [str(a["published"]) for a in articles] == ["2026-09-06 22:00:00", "2026-09-07 07:00:00"]


def test_table_functions(spark):
    payload = F.lit(RSS).cast("binary")
    assert feed_xml.ParseFeed(payload).count() == 2
    series = b"<f><entry><m:properties xmlns:m='m'><d:NEW_DATE xmlns:d='d'>2026-09-11</d:NEW_DATE><d:BC_2YEAR xmlns:d='d'>4.63</d:BC_2YEAR></m:properties></entry></f>"
    assert list(feed_xml.properties(series)) == [(0, "2026-09-11", "BC_2YEAR", "4.63")]
    assert feed_xml.ParseSeries(F.lit(series.decode()).cast("binary")).first()["value"] == "4.63"


def test_streaming_dedupe(spark, tmp_path):
    rows = [("https://e.com/a?utm_source=1", "2026-09-07 01:00:00"), ("https://www.e.com/a", "2026-09-07 02:00:00"), ("https://e.com/b", "2026-09-07 02:00:00"), ("https://e.com/c", None)]
    frame = spark.createDataFrame(rows, "link string, t string").select("link", F.col("t").cast("timestamp").alias("published"))
    frame.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(frame.schema).parquet(str(tmp_path / "in"))
    for name, df, want in (("dated", deduplicated(stream), {"https://e.com/a", "https://e.com/b"}), ("loose", undated(stream), {"https://e.com/c"})):
        q = df.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / f"ck-{name}")).start()
        q.processAllAvailable()
        q.stop()
        assert {r["url"] for r in spark.table(name).collect()} == want


SERIES = "<f>" + "".join(f"<entry><m:properties xmlns:m='m' xmlns:d='d'><d:NEW_DATE>2026-09-{d}T00:00:00</d:NEW_DATE><d:BC_2YEAR>{v}</d:BC_2YEAR><d:BC_7YEAR>1</d:BC_7YEAR></m:properties></entry>" for d, v in ((11, 4.63), (10, 4.56))) + "</f>"


def test_monthly_series(spark, tmp_path):
    (tmp_path / "202609.xml").write_text(SERIES)
    (tmp_path / "202610.xml").write_text("<f/>")
    address = tmp_path.as_uri() + "/{month}.xml"
    found, why = series.curve(series.read_series(spark, address, ["202608", "202609"], retries=0))
    assert [(r["tenor"], r["percent"], r["change_bp"], str(r["as_of"])) for r in found.collect()] == [("2Y", 4.63, 7.0, "2026-09-11")] and why.first()["error"] is None
    told = curves.curve_markdown(found, why).first()["text"]
    assert "| 2Y | 4.63 | +7.0 |" in told and "As-of: 2026-09-11" in told
    body = json.loads(curves.curve_json(found, why).first()["json"])["treasury_curve"]
    assert body["available"] and body["error"] is None and body["yields"] == {"2Y": {"percent": 4.63, "change_bp": 7.0}}
    for month, reason in (("202608", "URLError"), ("202610", terms.CURVE_EMPTY)):
        found, why = series.curve(series.read_series(spark, address, [month], retries=0))
        body = json.loads(curves.curve_json(found, why).first()["json"])["treasury_curve"]
        assert not body["available"] and reason in body["error"] and body["as_of"] is None
        assert reason in curves.curve_markdown(found, why).first()["text"]


def test_documents(spark, tmp_path):
    (tmp_path / "a b.md").write_text("one\ntwo")
    (tmp_path / "empty.md").write_text("")
    paths = [str(tmp_path / n) for n in ("a b.md", "empty.md", "none.md")]
    got = {r["report_id"]: (r["state"], r["text"]) for r in documents.read_documents(spark, paths).collect()}
    assert got["a b"] == ("ok", "one\ntwo") and got["empty"][0] == "empty" and got["none"] == ("missing", None)
    assert documents.read_documents(spark, paths[2:]).first()["state"] == "missing"


def test_link_probe_against_a_server(spark, tmp_path, capsys):
    import http.server
    import threading

    seen = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def answer(self):
            seen.append((self.command, self.path, self.headers.get("User-Agent")))
            code = {"/ok": 200, "/gone": 404, "/wall": 403}.get(self.path) or (405 if self.command == "HEAD" else 200)
            self.send_response(code)
            self.send_header("Content-Length", "0")
            self.end_headers()

        do_HEAD = do_GET = answer  # noqa: N815

        def log_message(self, *a):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    urls = [f"{base}/wall", f"{base}/ok", f"{base}/get", f"{base}/gone", "http://127.0.0.1:9/none"]
    text = " ".join(f"[x]({u})" for u in [*urls, urls[0]])
    docs = spark.createDataFrame([("r", text)], "report_id string, text string")
    attempts = links.probe_links(links.extract_links(docs, "report_id", "text"), timeout=5).persist()
    verdicts = links.link_verdicts(attempts).orderBy("ord").collect()
    assert [v["url"] for v in verdicts] == urls
    assert [(v["status"], v["verdict"]) for v in verdicts] == [(403, "확인 불가"), (200, "정상"), (200, "정상"), (404, "실패"), (None, "확인 불가")]
    assert {p for c, p, _ in seen if c == "GET"} == {"/wall", "/get"} and all("Mozilla" in a for _, _, a in seen)
    told = [r["text"] for r in links.link_lines(links.link_verdicts(attempts)).orderBy("part", "ord").collect()]
    assert told[0].strip().startswith("정상") and "HTTP 404" in told[-2] and told[-1].strip().startswith("링크 5개 · 정상 2 · 확인 불가 2 · 실패 1")
    none = links.link_lines(links.link_verdicts(attempts.limit(0)))
    assert none.first()["text"] == terms.NO_LINKS and links.exit_code(links.link_verdicts(attempts.limit(0))) == 1
    (tmp_path / "r.md").write_text(f"[x]({base}/ok)")
    assert main(["links", str(tmp_path / "r.md")]) == 0 and main(["links", str(tmp_path / "no.md")]) == 2
    assert "정상" in capsys.readouterr().out
    server.shutdown()


def test_whole_run_of_files(spark, tmp_path, capsys):
    day = datetime.now(timezone.utc).strftime("%a, %d %b %Y 00:00:01 GMT")
    for name, titles in (("a", ["Bank lifts key rate sharply", "Harvest falls in north"]), ("b", ["Bank lifts key rate sharply today"])):
        entries = "".join(f"<item><title>{t}</title><link>https://e.com/{name}/{k}</link><description>d {t}</description><pubDate>{day}</pubDate></item>" for k, t in enumerate(titles))
        (tmp_path / f"{name}.xml").write_text(f"<rss>{entries}</rss>")
    listed = [{"category": "미국", "tier": k + 1, "name": n, "url": (tmp_path / f"{n}.xml").as_uri()} for k, n in enumerate("abc")]
    (tmp_path / "sources.json").write_text(json.dumps({"feeds": listed, "candidate_feeds": [listed[0] | {"blocked_reason": "waf", "detail": "d"}]}))
    assert main(["collect", str(tmp_path / "sources.json"), str(tmp_path / "out")]) == 0

    def read(kind):
        return "".join(p.read_text() for p in sorted((tmp_path / "out" / f"candidates.{kind}").glob("part-*")))

    body = json.loads(read("json"))
    assert set(body) == {"meta", "coverage", "events"} and len(body["coverage"]) == 10 and body["meta"]["feeds_ok"] == 2
    assert [(len(e["articles"]), e["sources"], e["duplicate_count"]) for e in body["events"]] == [(2, ["a", "b"], 1), (1, ["a"], 0)]
    assert body["events"][0]["articles"][0]["title"] == body["events"][0]["lead"]["title"]
    told = read("md")
    assert told.startswith(terms.DIGEST_TITLE) and "피드: 정상 2/3" in told and told.index("[글로벌]") < told.index("[미국]") and "피드 실패 1개" in told
    assert main(["feeds", str(tmp_path / "sources.json")]) == 1 and main(["feeds", "--candidates", str(tmp_path / "sources.json")]) == 0
    shown = capsys.readouterr().out
    assert "복구!" in shown and "FAIL [미국] c" in shown and shown.index("OK    [미국] a") < shown.index("OK    [미국] b")
    (tmp_path / "bad.md").write_text("# nothing")
    assert main(["report", str(tmp_path / "bad.md")]) == 1 and main(["report", str(tmp_path / "bad.md"), str(tmp_path / "no.md")]) == 2
    assert "검증 실패" in capsys.readouterr().out


def test_late_rows_of_a_stream_go(spark, tmp_path):
    schema = "link string, published timestamp"
    (tmp_path / "in").mkdir()
    stream = deduplicated(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "1 hour")
    q = stream.writeStream.format("memory").queryName("late").option("checkpointLocation", str(tmp_path / "ck")).start()
    for n, rows in enumerate(([("https://e.com/a", "2026-09-07 01:00:00")], [("https://e.com/b", "2026-09-07 09:00:00")], [("https://e.com/old", "2026-09-07 02:00:00"), ("https://e.com/new", "2026-09-07 08:30:00"), ("https://e.com/a", "2026-09-07 09:30:00")])):
        frame = spark.createDataFrame(rows, "link string, t string").select("link", F.col("t").cast("timestamp").alias("published"))
        frame.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        q.processAllAvailable()
    q.stop()
    # the watermark has passed 08:00: the old row is late, and the first address may come again
    assert sorted(r["url"] for r in spark.table("late").collect()) == ["https://e.com/a", "https://e.com/a", "https://e.com/b", "https://e.com/new"]
