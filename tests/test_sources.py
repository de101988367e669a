from __future__ import annotations

import gzip
import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from rosterlake import config
from rosterlake.plans import merge, screen, watch
from rosterlake.sources import files, http, loaders, web
from rosterlake.streaming.screening import screen_stream


def data(df):
    return [tuple(r) for r in df.orderBy("_row_ord").drop("_row_ord").collect()]


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('n;v\n007;\n"a;b";"q""q"\n', encoding="utf-16")
    assert data(files.read_csv(spark, str(tmp_path / "a.csv"), {"sep": ";", "encoding": "utf-16"})) == [("007", ""), ("a;b", 'q"q')]


def test_csv_of_an_old_code_page(spark, tmp_path):
    (tmp_path / "a.csv").write_text("имя;v\nЁж;1\n", encoding="cp1251")
    assert data(files.read_csv(spark, str(tmp_path / "a.csv"), {"sep": ";", "encoding": "cp1251"})) == [("Ёж", "1")]


def test_json(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"d": {"items": [{"a": {"b": 5, "c": [1]}}, {"a": {"b": None}, "z": "x"}]}}))
    df = files.read_json(spark, str(tmp_path / "a.json"), {"records_path": "d.items"})
    assert df.columns == ["a.b", "a.c", "z", "_row_ord"] and data(df) == [("5", '["1"]', None), (None, None, "x")]


def test_xml(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<r><record id='01'><n>007</n></record><record id='02'><n>b</n></record></r>")
    df = files.read_xml(spark, str(tmp_path / "a.xml"), {})
    assert [(r["id"], r["n"]) for r in df.orderBy("_row_ord").collect()] == [("01", "007"), ("02", "b")]


class Handler(BaseHTTPRequestHandler):
    records = [{"id": i, "n": {"v": f"v{i}"}} for i in range(7)]

    def log_message(self, *a):
        pass

    def send(self, body: bytes, kind: str):
        self.send_response(200)
        self.send_header("Content-Type", kind)
        self.send_header("ETag", "e1")
        self.end_headers()
        self.wfile.write(body)

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        rows = self.records[body["offset"] : body["offset"] + body["limit"]]
        self.send(json.dumps({"size": len(self.records), "values": rows}).encode(), "application/json")

    def do_GET(self):
        pages = {
            "/one": (json.dumps({"a": {"b": {"id": 1}}}).encode(), "application/json"),
            "/": (b"<title>Home</title><a href='/p1'>1</a><a href='/p2#x'>2</a><a href='/f.pdf'>f</a>", "text/html"),
            "/p1": (b"<title>One</title>Alpha Beta Gamma<a href='/p3'>3</a>", "text/html"),
            "/p2": (b"plain", "text/plain"),
            "/p3": (b"<title>Three</title>deep", "text/html"),
            "/robots.txt": (b"User-agent: *\nDisallow: /no", "text/plain"),
        }
        if self.path not in pages:
            self.send_error(404)
        else:
            self.send(*pages[self.path])


@pytest.fixture(scope="module")
def site():
    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_api(spark, site):
    df = http.read_api(spark, f"{site}/list", {"paginate": {"page_size": 3}})
    assert data(df.select("id", "`n.v`", "_row_ord")) == [(str(i), f"v{i}") for i in range(7)]
    assert data(http.read_api(spark, f"{site}/list", {"paginate": {"page_size": 3, "total_path": None}}).select("id", "_row_ord")) == [(str(i),) for i in range(7)]
    assert data(http.read_api(spark, f"{site}/one", {"records_path": "a.b"})) == [("1",)]


def test_fetch_fails(site):
    with pytest.raises(RuntimeError):
        http.fetch(f"{site}/none", options={"retries": 2, "retry_backoff": 0})
    with pytest.raises(KeyError):
        http.dig({"a": 1}, "b")


def test_crawl(spark, site):
    start = spark.createDataFrame([(site + "/",)], "url string")
    load = lambda urls: web.fetch_pages(urls, options={"retries": 1})
    found = web.crawl(start, load, max_depth=2).orderBy("ord").collect()
    assert [(r["title"], r["depth"]) for r in found] == [("Home", 0), ("One", 1), ("Three", 2)]
    assert web.crawl(start, load, max_depth=2, max_pages=2).count() == 2
    assert web.crawl(start, load, max_depth=0).count() == 1


def test_robots():
    robots = web.Robots(lambda url: "User-agent: *\nDisallow: /no" if "a.b" in url else 1 / 0)
    assert robots.allowed("https://a.b/yes") and not robots.allowed("https://a.b/no/x") and robots.allowed("https://c.d/no")


def test_sitemaps(spark):
    maps = {"https://a/sitemap.xml": b"<sitemapindex><loc>https://a/1.xml.gz</loc><loc> https://a/2.xml </loc></sitemapindex>", "https://a/1.xml.gz": gzip.compress(b"<urlset><LOC>https://a/x</LOC></urlset>"), "https://a/2.xml": b"<urlset><loc>https://a/y</loc><loc>https://a/z</loc></urlset>"}
    roots = spark.createDataFrame([("a", "https://a/sitemap.xml"), ("b", "https://b/sitemap.xml")], "host string, url string")
    got = web.sitemap_urls(spark, roots, get=lambda u: maps[u]).orderBy("pos").collect()
    assert [(r["host"], r["url"]) for r in got] == [("a", "https://a/x"), ("a", "https://a/y"), ("a", "https://a/z")]
    assert web.sitemap_urls(spark, roots, get=lambda u: maps[u], max_urls=2).count() == 2


def test_hosts(spark, tmp_path):
    (tmp_path / "h.csv").write_text("n,Domain\n1,https://B.x.org/p?q\n2,x.org\n3,b.x.org\n4,y.com\n5,\n")
    got = web.read_hosts(spark, str(tmp_path / "h.csv"), "x.org").orderBy("ord").collect()
    assert [r["host"] for r in got] == ["b.x.org", "x.org"]
    ordered = web.order_hosts(web.read_hosts(spark, str(tmp_path / "h.csv"), "x.org"), "x.org", ["z.z", "x.org"]).orderBy("host_ord").collect()
    assert [r["host"] for r in ordered] == ["www.x.org", "b.x.org", "x.org", "z.z"]


def test_config(tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"sources": [{"name": "a", "type": "CSV", "path": "x"}], "merge": {"keep": "last"}}))
    assert config.load_config(tmp_path / "c.json").sources[0].type == "csv"
    with pytest.raises(ValueError):
        config.from_raw({})
    with pytest.raises(TypeError):
        config.from_raw({"sources": [{"name": "a", "type": "csv", "path": "x"}], "merge": {"what": 1}})
    with pytest.raises(FileNotFoundError):
        config.load_config(tmp_path / "none.yaml")
    (tmp_path / "c.txt").write_text("")
    with pytest.raises(ValueError):
        config.load_config(tmp_path / "c.txt")
    with pytest.raises(ValueError):
        loaders.load(None, config.SourceConfig("a", "what", ""))


def test_merge_run(spark, tmp_path):
    (tmp_path / "a.csv").write_text("name,kind,out\nАнна Тест,x,\nанна  тест,y,\nСоюз «А»,x,2020\nFine Name Ltd,x,\n")
    source = {"name": "a", "type": "csv", "path": str(tmp_path / "a.csv"), "mapping": {"name": "full_name", "kind": "category", "out": "exclusion_date"}}
    raw = {
        "sources": [source, source | {"name": "small", "options": {"min_rows": 99}}, source | {"name": "broken", "path": "/none.csv"}],
        "quality": {"drop_if_filled": ["exclusion_date"], "min_total_rows": 2}, "merge": {"deduplicate_on": ["full_name"], "combine_columns": ["category"]},
        "database": {"url": str(tmp_path / "db"), "directory": str(tmp_path / "out")}, "logging": {"directory": str(tmp_path / "logs")},
    }
    assert merge.run(spark, config.from_raw(raw)) == 0
    rows = spark.read.parquet(f"{tmp_path}/db/registry_all").orderBy("id").collect()
    assert [(r["id"], r["naimenovanie_fio"], r["kategoriya"]) for r in rows] == [(1, "Анна Тест", "x; y"), (2, "Fine Name Ltd", "x")]
    assert spark.read.parquet(f"{tmp_path}/db/registry_persons").count() == 1 and (tmp_path / "out/DISCLAIMER.txt").exists()
    raw["quality"]["min_total_rows"] = 3
    assert merge.run(spark, config.from_raw(raw)) == 2
    assert merge.run(spark, config.from_raw(raw | {"sources": raw["sources"][1:]})) == 1


def test_watch_run(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n\n1\n2\n")
    raw = {"sources": [{"name": "a", "type": "csv", "path": str(tmp_path / "a.csv")}, {"name": "b", "type": "csv", "path": "/none.csv"}], "database": {"directory": str(tmp_path)}}
    cfg, state = config.from_raw(raw), tmp_path / "state.json"
    assert watch.run(spark, cfg, state, pause=0) == 1
    cfg.sources.pop()
    assert watch.run(spark, cfg, state, pause=0) == 0
    (tmp_path / "a.csv").write_text("n\n2\n1\n")
    assert watch.run(spark, cfg, state, pause=0) == 0
    (tmp_path / "a.csv").write_text("n\n2\n3\n")
    assert watch.run(spark, cfg, state, pause=0) == 1


def test_watch_over_http(spark, tmp_path, site):
    sources = [{"name": "page", "type": "web", "path": site + "/"}, {"name": "registry", "type": "api", "path": f"{site}/rest/registry/0123456789ab/values"}, {"name": "gone", "type": "web", "path": site + "/none", "options": {"retries": 1}}]
    cfg, state = config.from_raw({"sources": sources, "database": {"directory": str(tmp_path)}}), tmp_path / "state.json"
    assert watch.run(spark, cfg, state, pause=0) == 1
    report = json.loads((tmp_path / "source_watch_report.json").read_text())
    assert [(x["name"], x["method"], x["status"]) for x in report["statuses"]] == [("page", "http_headers", "new"), ("registry", "api_registry", "new"), ("gone", "http_headers", "error")]
    assert report["statuses"][0]["signature"]["etag"] == "e1" and report["statuses"][1]["signature"]["size"] == "7" and report["errors"] == ["gone"]
    cfg.sources.pop()
    assert watch.run(spark, cfg, state, pause=0) == 0
    saved = json.loads(state.read_text())
    saved["registry"]["signature"]["size"] = "6"
    state.write_text(json.dumps(saved))
    assert watch.run(spark, cfg, state, update_baseline=True, pause=0) == 1 and watch.run(spark, cfg, state, pause=0) == 0


def test_charset():
    russian = "<p>Перечень организаций и физических лиц</p>"
    assert http.Response("", {}, russian.encode("cp1251")).text() == russian == http.Response("", {}, russian.encode("koi8-r")).text()
    assert http.Response("", {"content-type": "text/html; charset=utf-8"}, russian.encode("cp1251")).text() == russian == http.Response("", {}, russian.encode()).text()
    german = "<meta charset='iso-8859-1'><p>Übergröße</p>"
    assert http.Response("", {}, german.encode("latin-1")).text() == german and http.charset_of("déjà vu, tête".encode("cp1252")) == "cp1252"


def test_structure_scan(spark, tmp_path, site):
    """Hosts of which none has a sitemap are crawled; a second run goes on where the first ended, and keeps its findings."""
    spark.createDataFrame([(1, "Alpha Beta Gamma", "list")], "id long, naimenovanie_fio string, kategoriya string").write.parquet(f"{tmp_path}/db/reg")
    host = site.removeprefix("http://")
    scan_ = {"mode": "structure", "scheme": "http", "domain_suffix": "x.invalid", "hosts_file": "/none.txt", "extra_hosts": [host], "retries": 1, "delay_seconds": 0, "max_pages_total": 2}
    cfg = {"matching": {"registry_db": {"url": f"{tmp_path}/db", "table": "reg"}, "aliases": [{"entity": "Third", "variants": ["THREE DEEP"]}]}, "scan": scan_, "logging": {"directory": str(tmp_path)}, "report": {"state_dir": f"{tmp_path}/state"}}
    found = lambda: {r["sushchnost"] for r in spark.read.parquet(f"{tmp_path}/db/scan_findings").collect()}
    assert screen.run(spark, cfg) == 0 and found() == {"Alpha Beta Gamma"}
    assert {r["url"] for r in spark.read.parquet(f"{tmp_path}/state/done").collect()} == {site + "/", site + "/p1"}
    assert screen.run(spark, cfg) == 0 and found() == {"Alpha Beta Gamma", "Third"}
    assert spark.read.parquet(f"{tmp_path}/state/done").count() == 3


def test_discovered_hosts_take_turns(spark):
    pages = spark.createDataFrame([("https://x.org/", ["https://b.x.org/", "//a.x.org/p", "https://y.com/", "/q"])], "url string, links array<string>")
    hosts = web.order_hosts(web.discover_hosts(pages, "x.org"), "x.org")
    urls = hosts.join(spark.range(1, 4).withColumnRenamed("id", "pos")).withColumn("url", F.concat("host", F.lit("/"), F.col("pos").cast("string")))
    taken = [r["host"] for r in web.round_robin(urls).orderBy("turn", "host_ord").collect()]
    assert taken == ["www.x.org", "a.x.org", "b.x.org", "x.org"] * 3


def test_screen_run(spark, tmp_path, site):
    spark.createDataFrame([(1, "Alpha Beta Gamma", "list")], "id long, naimenovanie_fio string, kategoriya string").write.parquet(f"{tmp_path}/db/reg")
    cfg = {"matching": {"registry_db": {"url": f"{tmp_path}/db", "table": "reg"}, "aliases": [{"entity": "Home page", "variants": ["HOME"]}]}, "scan": {"start_url": site + "/", "retries": 1}, "logging": {"directory": str(tmp_path)}}
    assert screen.run(spark, cfg) == 0
    rows = spark.read.parquet(f"{tmp_path}/db/scan_findings").orderBy("id").collect()
    assert {(r["sushchnost"], r["zagolovok"]) for r in rows} == {("Alpha Beta Gamma", "One"), ("Home page", "Home")}
    assert all(r["kontekst"] for r in rows)


def test_stream(spark, tmp_path):
    from rosterlake.operators import match

    patterns = spark.createDataFrame([("ALPHA BETA", "Alpha Beta", "", "org", "", 0)], match.PATTERN).cache()
    pages = lambda *rows: spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/pages")
    run = lambda: screen_stream(spark, f"{tmp_path}/pages", patterns, f"{tmp_path}/found", f"{tmp_path}/done").awaitTermination()
    pages((1, "u1", "<p>alpha, beta"), (2, "u2", "<p>none"))
    run()
    pages((3, "u3", "<b>Alpha</b> BETA"))
    run()
    run()
    assert sorted(r["page_url"] for r in spark.read.parquet(f"{tmp_path}/found").select(F.col("page_url")).collect()) == ["u1", "u3"]


def test_stream_finds_near_hits(spark, tmp_path):
    from rosterlake.operators import match

    patterns = spark.createDataFrame([("KITTENS", "Kittens", "", "org", "", 0)], match.PATTERN).cache()
    spark.createDataFrame([(1, "u1", "<p>a kitten here"), (2, "u2", "<p>none")], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages")
    options = {"threshold": 90, "min_len": 6, "max_words": 1}
    screen_stream(spark, f"{tmp_path}/pages", patterns, f"{tmp_path}/found", f"{tmp_path}/done", fuzzy_options=options).awaitTermination()
    assert [(r["page_url"], r["stage"]) for r in spark.read.parquet(f"{tmp_path}/found").collect()] == [("u1", 1)]
