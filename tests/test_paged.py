"""Paged services: all pages, the end at the first empty one, filters decided by the page readers."""

import json
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from threading import Thread
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import functions as F

from hazardspark.sources import paged


def feature(i):
    return {"attributes": {"Natureza": "Cheia" if i % 3 else "Vento", "Concelho": f"C{i}", "Latitude": i if i % 2 else None, "DataOcorrencia": i}}


@pytest.fixture
def folder(tmp_path):
    for page in range(7):
        (tmp_path / f"page-{page}.json").write_text(json.dumps({"features": [feature(i) for i in range(page * 10, page * 10 + 10)]}))
    (tmp_path / "page-7.json").write_text('{"features": []}')
    return f"{tmp_path}/page-{{page}}.json"


@pytest.mark.parametrize("readers", [1, 3, 20])
def test_every_page_once(spark, folder, readers):
    rows = paged.read_pages(spark, folder, None, readers=readers)
    assert sorted(int(r["Concelho"][1:]) for r in rows.collect()) == list(range(70))
    floods = paged.read_pages(spark, folder, readers=readers)
    assert sorted(r["DataOcorrencia"] for r in floods.collect()) == [i for i in range(70) if i % 3]
    row = floods.where("Concelho = 'C7' AND Latitude > 6").first()
    assert row["Latitude"] == 7.0 and row["Freguesia"] is None and rows.where("Concelho = 'none'").count() == 0


def test_filter_reaches_the_reader(spark, folder):
    reader = paged.FeaturePages({"pages": folder}).reader(paged.FeaturePages({}).schema())
    left = [paged.EqualTo(("Natureza",), "Vento"), paged.EqualTo(("Natureza",), "Cheia")]
    assert list(reader.pushFilters([left[0]])) == [] and list(reader.pushFilters([left[1]])) == [left[1]]
    got = [b for p in reader.partitions() for b in reader.read(p)]
    assert {n for b in got for n in b.column("Natureza").to_pylist()} == {"Vento"}
    # Spark leaves no filter above the scan for what the reader took.
    plan = paged.read_pages(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan feature_pages" in plan and "= Cheia" not in plan


def test_values_that_do_not_fit_and_empty_sources(spark, tmp_path):
    odd = [{"attributes": {"Natureza": 5, "Latitude": "north", "DataOcorrencia": 1.5}}, {"attributes": None}, None]
    (tmp_path / "0.json").write_text(json.dumps({"features": odd}))
    got = paged.read_pages(spark, f"{tmp_path}/{{page}}.json", None).collect()
    assert sorted((r["Natureza"] or "", r["Latitude"], r["DataOcorrencia"]) for r in got) == [("", None, None)] * 2 + [("5", None, None)]
    assert paged.read_pages(spark, f"{tmp_path}/none/{{page}}.json").count() == 0
    (tmp_path / "0.json").write_text("not json")
    with pytest.raises(Exception, match="JSON|Expecting"):
        paged.read_pages(spark, f"{tmp_path}/{{page}}.json").collect()


def test_service_over_http(spark):
    asked = []

    class Service(BaseHTTPRequestHandler):
        def do_GET(self):
            query = {k: v[0] for k, v in parse_qs(urlparse(self.path).query).items()}
            asked.append(query["where"])
            rows = [feature(i) for i in range(95)]
            rows = [r for r in rows if query["where"] == "1=1" or r["attributes"]["Natureza"] in query["where"]]
            start = int(query["offset"])
            body = json.dumps({"features": rows[start:start + int(query["n"])]}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Service)
    Thread(target=server.serve_forever, daemon=True).start()
    try:
        address = f"http://127.0.0.1:{server.server_port}/?offset={{offset}}&n={{size}}&where={{where}}"
        rows = paged.read_pages(spark, address, page_size=20, readers=2)
        assert rows.agg(F.count_distinct("Concelho"), F.count("*")).first() == (63, 63)
        assert set(asked) == {"Natureza='Cheia'"}
    finally:
        server.shutdown()
