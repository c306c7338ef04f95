import json

import pytest

from riskspark.plans import jobs
from riskspark.sources import scans, tables
from tests.helpers import by, rows


def put(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


@pytest.mark.parametrize("suffix", ["parquet", "csv", "jsonl"])
def test_write_and_read_back(spark, tmp_path, suffix):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n long, t string")
    path = tables.write_table(df, str(tmp_path / "new" / f"t.{suffix}"))
    assert rows(tables.read_table(spark, path), "n") == [{"n": 1, "t": "a"}, {"n": 2, "t": None}]
    assert rows(tables.read_table(spark, path, "n long, t string"), "n")[0]["n"] == 1


def test_nan_is_read_as_null(spark, tmp_path):
    path = tables.write_table(spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "x double, n int"), str(tmp_path / "n.parquet"))
    assert [r["x"] for r in rows(tables.read_table(spark, path), "n")] == [None, 2.0]


def test_json_array_and_unknown_formats(spark, tmp_path):
    path = put(tmp_path / "t.json", '[{"n": 1},\n {"n": 2}]')
    assert tables.read_table(spark, path).count() == 2
    df = spark.range(1)
    for bad in ("t.txt", "t.json"):
        with pytest.raises(ValueError):
            tables.write_table(df, str(tmp_path / bad))
    with pytest.raises(ValueError):
        tables.read_table(spark, "t.xls")


def test_formats(spark):
    assert tables.detect_format("a/b.CSV") == "csv" and tables.detect_format("x.bin", "JSON") == "json"
    with pytest.raises(ValueError):
        tables.detect_format("x.jsonl")
    with pytest.raises(FileNotFoundError):
        tables.load_threats(spark, "/tmp/no-such-file.csv")


ITEMS = [
    {"asset_id": "ASSET-1", "host": "10.0.0.1", "ports": [22], "services": [{"port": 22, "service": "ssh", "version": "9"}], "tags": ["A"],
     "discovered_by": ["nmap"], "internet_exposed": True, "last_seen": "2024-01-01T00:00:00Z"},
    {"asset_id": "BAD", "host": "x", "last_seen": "2024-01-01"},
]


def test_assets_from_json_to_parquet_csv_and_back(spark, tmp_path):
    path = put(tmp_path / "assets.json", json.dumps(ITEMS))
    good, bad = jobs.load_assets(spark, path)
    assert rows(good)[0]["services"] == [{"port": 22, "service": "ssh", "version": "9"}] and bad.count() == 1
    enriched = jobs.run_assets(spark, path, str(tmp_path / "out"))
    assert rows(enriched)[0]["asset_type"] == "Linux Server"
    for name in ("assets_clean.parquet", "assets_clean.csv"):
        again, _ = jobs.load_assets(spark, str(tmp_path / "out" / name))
        assert rows(again) == rows(good)
    text = next((tmp_path / "out" / "assets_summary.json").glob("part*")).read_text()
    assert json.loads(text)["pipeline_metadata"]["rejected"] == 1


def test_asset_file_errors(spark, tmp_path):
    with pytest.raises(ValueError, match="array"):
        jobs.load_assets(spark, put(tmp_path / "o.json", '{"asset_id": "ASSET-1"}'))
    with pytest.raises(ValueError, match="rejected"):
        jobs.load_assets(spark, put(tmp_path / "b.json", json.dumps(ITEMS[1:])))
    typed, none = jobs.load_assets(spark, put(tmp_path / "c.json", json.dumps(ITEMS[1:])), validate=False)
    assert typed.count() == 1 and none.count() == 0


def test_threat_csv_to_saved_assets(spark, tmp_path):
    text = "asset_id,cve_id,cvss_score,epss_score,severity,days_since_published\na,c1,9.8,0.5,HIGH,10\na,c2,oops,0.1,low,20\n,c3,1,0.1,low,1\n"
    out = jobs.run_threats(spark, put(tmp_path / "t.csv", text), str(tmp_path / "t.parquet"), "2024-02-01T00:00:00Z", normalize=False)
    r = rows(out)[0]
    assert (r["asset_id"], r["vuln_count"], r["days_since_published_max"], r["cvss_score_mean"]) == ("a", 2, 20.0, 9.8)


def test_ml_dataset_target(spark, tmp_path):
    df = spark.createDataFrame([("a", 5.0)], "asset_id string, expected_annual_loss_usd double")
    path = tables.write_table(df, str(tmp_path / "m.parquet"))
    assert rows(tables.load_ml_dataset(spark, path))[0]["financial_loss_usd"] == 5.0
    with pytest.raises(ValueError):
        tables.load_ml_dataset(spark, path, "x", "y")


def test_yaml(tmp_path):
    assert tables.load_yaml(put(tmp_path / "c.yaml", "a:\n  b: 1_000\n")) == {"a": {"b": 1000}}
    assert tables.load_yaml(put(tmp_path / "e.yaml", "")) == {}


def test_nmap(spark, tmp_path):
    put(tmp_path / "a.xml", """<?xml version="1.0"?><nmaprun>
<host><address addr="10.0.0.1" addrtype="ipv4"/><ports><port protocol="tcp" portid="22"><state state="open"/><service name="ssh" product="OpenSSH" version="9"/></port>
<port protocol="udp" portid="53"><state state="closed"/></port></ports></host>
<host><address addr="10.0.0.2" addrtype="ipv4"/><ports></ports></host></nmaprun>""")
    put(tmp_path / "b.xml", '<nmaprun><host><address addr="10.0.0.3"/><ports><port protocol="tcp" portid="80"/></ports></host></nmaprun>')
    got = rows(scans.parse_nmap_xml(spark, str(tmp_path)), "ip_address", "port")
    assert [(r["asset_id"], r["port"], r["state"], r["service"]) for r in got] == [
        ("10.0.0.1", 22, "open", "ssh"), ("10.0.0.1", 53, "closed", None), ("10.0.0.3", 80, None, None)]
    assert {r["asset_id"] for r in rows(scans.parse_nmap_xml(spark, str(tmp_path / "a.xml"), "ASSET-7"))} == {"ASSET-7"}


def test_nuclei(spark, tmp_path):
    lines = [{"host": "", "ip": "1.1.1.1", "matched-at": "u", "template-id": "t", "info": {"severity": "high", "name": "n", "tags": ["a", "b"]}}, {"host": "h", "info": {"tags": "x,y"}}]
    path = put(tmp_path / "n.jsonl", "\n\n".join(json.dumps(x) for x in lines))
    got = by(scans.parse_nuclei_jsonl(spark, path), "asset_id")
    assert (got["1.1.1.1"]["severity"], got["1.1.1.1"]["tags"], got["1.1.1.1"]["matched_at"]) == ("HIGH", "a,b", "u")
    assert (got["h"]["severity"], got["h"]["tags"], got["h"]["finding_name"]) == ("", "x,y", None)


def test_httpx(spark, tmp_path):
    lines = [{"host": "h", "url": "u", "status_code": 200, "title": "t", "tech": ["a", "b"], "tls": {"v": 1}, "webserver": "", "cdn_name": "c"}, {"url": "u2", "tech": "x", "tls": {}}, {"url": "u3", "tls": True, "webserver": "w"}]
    path = put(tmp_path / "h.jsonl", "\n".join(json.dumps(x) for x in lines))
    got = by(scans.parse_httpx_jsonl(spark, path), "asset_id")
    assert (got["h"]["tech_stack"], got["h"]["tls"], got["h"]["waf"], got["h"]["status_code"]) == ("a,b", True, "c", 200)
    assert (got["u2"]["tech_stack"], got["u2"]["tls"], got["u2"]["waf"]) == ("x", False, None)
    assert (got["u3"]["tls"], got["u3"]["waf"]) == (True, "w")


def test_whatweb(spark, tmp_path):
    items = [{"target": "a", "http_status": 200, "plugins": {"nginx": {}, "WordPress": {"v": [1]}, "Apache": {}}}, {"target": "b"}]
    got = by(scans.parse_whatweb_json(spark, put(tmp_path / "w.json", json.dumps(items))), "asset_id")
    assert (got["a"]["tech_stack"], got["a"]["cms_detected"]) == ("Apache,WordPress,nginx", True)
    assert (got["b"]["tech_stack"], got["b"]["cms_detected"]) == ("", False)
    single = scans.parse_whatweb_json(spark, put(tmp_path / "s.json", json.dumps(items[0])))
    assert single.count() == 1


def test_naabu_and_subfinder(spark, tmp_path):
    got = rows(scans.parse_naabu_csv(spark, put(tmp_path / "a.csv", "host,ip,port\nh,1.1.1.1,80\n")))[0]
    assert (got["asset_id"], got["ip_address"], got["port"], got["source_tool"]) == ("h", "1.1.1.1", 80, "naabu")
    assert rows(scans.parse_naabu_csv(spark, put(tmp_path / "b.csv", "ip,port\n1.1.1.2,80\n")))[0]["asset_id"] == "1.1.1.2"
    path = put(tmp_path / "s.txt", " a.x.com \n\nb.x.com\n")
    assert sorted(r["subdomain"] for r in rows(scans.parse_subfinder_txt(spark, path))) == ["a.x.com", "b.x.com"]
    assert {r["asset_id"] for r in rows(scans.parse_subfinder_txt(spark, path, "ASSET-1"))} == {"ASSET-1"}
