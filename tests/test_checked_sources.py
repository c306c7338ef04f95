"""Checked scanner readers: broken records are rejected with file and reason, the others read, counts from the write."""

from riskspark.sources import scans


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_nuclei_lines_broken_or_mistyped_are_rejected(spark, tmp_path):
    path = write(tmp_path, "n.jsonl", '{"host":"a","template-id":"t","info":{"severity":"high","tags":["x","y"]}}\n{"host": "b", "info": {\n\n{"ip":"10.0.0.1","info":{"severity":"low"}}\n{"host":"c","info":"text"}\n')
    out = scans.read_nuclei_jsonl(spark, path)
    rows = sorted((r.asset_id, r.severity, r.tags) for r in out.rows.collect())
    assert rows == [("10.0.0.1", "LOW", None), ("a", "HIGH", "x,y")]
    rejected = out.rejected.collect()
    assert len(rejected) == 2 and all(r.file.endswith("n.jsonl") and r.reason == scans.UNREADABLE for r in rejected)
    assert out.counts == {"read": 4, "rejected": 2}


def test_httpx_mistyped_status_is_rejected(spark, tmp_path):
    path = write(tmp_path, "h.jsonl", '{"host":"a","status_code":200,"tls":{"v":1}}\n{"host":"b","status_code":"n/a"}\n')
    out = scans.read_httpx_jsonl(spark, path)
    assert [(r.asset_id, r.status_code, r.tls) for r in out.rows.collect()] == [("a", 200, True)]
    assert [r.record for r in out.rejected.collect()] == ['{"host":"b","status_code":"n/a"}']


def test_nmap_broken_host_costs_only_itself(spark, tmp_path):
    good = '<host><address addr="{}"/><ports><port protocol="tcp" portid="{}"><state state="open"/></port></ports></host>'
    text = "\n".join(['<?xml version="1.0"?><nmaprun>', good.format("1.1.1.1", 80), '<host><address addr="2.2.2.2"/><ports><port portid="1"></ports></host>', '<host><address addr="4.4.4.4"/>', good.format("3.3.3.3", 22), "<hostnames/></nmaprun>"])
    out = scans.read_nmap_xml(spark, write(tmp_path, "n.xml", text))
    assert sorted((r.ip_address, r.port, r.state) for r in out.rows.collect()) == [("1.1.1.1", 80, "open"), ("3.3.3.3", 22, "open")]
    assert sorted(r.reason for r in out.rejected.collect()) == sorted([scans.UNREADABLE, scans.UNCLOSED])


def test_whatweb_broken_file_is_rejected_whole(spark, tmp_path):
    folder = tmp_path / "w"
    folder.mkdir()
    write(folder, "a.json", '[{"target":"x","http_status":200,"plugins":{"Drupal":{}}},{"target":"y","plugins":{}}]')
    write(folder, "b.json", '{"target":"z","http_status":301}')
    write(folder, "c.json", '[{"target":"q"')
    out = scans.read_whatweb_json(spark, str(folder))
    assert sorted((r.asset_id, r.tech_stack, r.cms_detected) for r in out.rows.collect()) == [("x", "Drupal", True), ("y", "", False), ("z", "", False)]
    assert [r.file.endswith("c.json") for r in out.rejected.collect()] == [True]
