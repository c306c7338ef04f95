import datetime as dt

from pyspark.sql import functions as F

from riskspark.operators import assets as A
from riskspark.plans import jobs
from tests.helpers import by, plan_text, rows

RAW = "asset_id string, host string, domain string, ports string, services string, tags string, discovered_by string, internet_exposed string, last_seen string"
MOMENT = "2024-01-01T00:00:00+00:00"


def raw(spark, *changes):
    base = dict(asset_id="ASSET-1", host="10.0.0.1", domain="", ports="[]", services="[]", tags="[]", discovered_by="[]", internet_exposed="no", last_seen=MOMENT)
    names = [c.split()[0] for c in RAW.split(", ")]
    return spark.createDataFrame([tuple({**base, **c}[n] for n in names) for c in changes], RAW)


def judged(spark, *changes):
    return A.validate_assets(A.normalise_types(raw(spark, *changes)))


def test_lists_are_decoded(spark):
    texts = ["[1, 2]", "['a', 'b']", "", "[]", None, "nonsense", "7"]
    df = spark.createDataFrame([(t,) for t in texts], "ports string")
    got = [r["v"] for r in rows(df.select(A.list_column(df, "ports").alias("v")))]
    assert got == [["1", "2"], ["a", "b"], [], [], [], [], []]
    assert rows(df.select(A.list_column(df, "absent").alias("v")))[0]["v"] == []
    native = spark.createDataFrame([([1, 2],), (None,)], "ports array<int>")
    assert [r["v"] for r in rows(native.select(A.list_column(native, "ports").alias("v")))] == [["1", "2"], []]


def test_services_keep_objects_only(spark):
    df = spark.createDataFrame([('[{"port": 22, "service": "SSH"}, 5, "x"]',), ("[{'port': 80, 'service': 'http', 'version': '2'}]",), (None,)], "services string")
    got = [r["v"] for r in rows(df.select(A.service_column(df).alias("v")))]
    assert got[0] == [{"port": "22", "service": "SSH", "version": None}]
    assert got[1] == [{"port": "80", "service": "http", "version": "2"}] and got[2] == []


HOSTS = [
    ("", True), ("1.2.3.4", True), ("01.2.3.4", False), ("1.2.3", False), ("10.0.0.300", False), ("::1", True), ("::", True),
    ("2001:db8::8a2e:370:7334", True), ("1:2:3:4:5:6:7:8", True), ("1:2:3:4:5:6:7", False), ("1::2::3", False),
    ("::ffff:10.0.0.1", True), ("fe80::1%eth0", True), ("1:2:3:4:5:6:7::8", False), ("12345::", False), ("host", False),
]


def test_hosts(spark):
    accepted, rejected = judged(spark, *[{"asset_id": f"ASSET-{i}", "host": h, "domain": "a.com"} for i, (h, _) in enumerate(HOSTS)])
    assert set(by(accepted, "asset_id")) == {f"ASSET-{i}" for i, (_, good) in enumerate(HOSTS) if good}
    assert rejected.count() == sum(not good for _, good in HOSTS)


DOMAINS = [
    ("localhost", True), ("Web.Example.COM", True), ("example.com.", False), ("-a.com", False), ("a-.com", False), ("a_b", False),
    ("x.1", False), ("a" * 63 + ".com", True), ("a" * 64 + ".com", False), ("a b.com", False),
]


def test_domains(spark):
    accepted, _ = judged(spark, *[{"asset_id": f"ASSET-{i}", "domain": d} for i, (d, _) in enumerate(DOMAINS)])
    got = {k: r["domain"] for k, r in by(accepted, "asset_id").items()}
    assert got == {f"ASSET-{i}": d.lower() for i, (d, good) in enumerate(DOMAINS) if good}


RULES = [
    ("asset_id", "HOST-1", False), ("asset_id", " ASSET-2 ", True), ("asset_id", None, False),
    ("ports", "[1, 65535]", True), ("ports", "[0]", False), ("ports", "[65536]", False), ("ports", '["x"]', False), ("ports", '["22"]', True),
    ("services", '[{"port": 0, "service": "a"}]', False), ("services", '[{"port": 5, "service": " "}]', False), ("services", '[{"service": "a"}]', False),
    ("last_seen", "2024-01-01", True), ("last_seen", "2024-01-01T10:00:00Z", True), ("last_seen", "2024-01-01 10:00", True),
    ("last_seen", "2024-01-01T10:00:00+99:00", True), ("last_seen", "2024", False), ("last_seen", "", False), ("last_seen", "2024-13-01", False),
    ("host", "", False),
]


def test_rules(spark):
    # The row number travels as a tag, which no rule looks at.
    accepted, rejected = judged(spark, *[{"tags": f'["{i}"]', f: v} for i, (f, v, _) in enumerate(RULES)])
    assert {int(r["tags"][0]) for r in rows(accepted)} == {i for i, (_, _, good) in enumerate(RULES) if good}
    assert rejected.count() == sum(not good for _, _, good in RULES)


def test_accepted_rows_are_normalised_and_extra_columns_go(spark):
    df = raw(spark, dict(services='[{"port": 22, "service": " SSH "}]', tags='[" TLS ", " "]', discovered_by='[" NMAP ", ""]', internet_exposed="YES")).withColumn("extra", F.lit(1))
    r = rows(A.validate_assets(A.normalise_types(df))[0])[0]
    assert "extra" not in r and r["services"] == [{"port": 22, "service": "ssh", "version": ""}]
    assert (r["tags"], r["discovered_by"], r["internet_exposed"], r["last_seen"]) == (["tls"], ["nmap", ""], True, dt.datetime(2024, 1, 1))


def test_every_reason_is_listed(spark):
    _, bad = judged(spark, {"asset_id": "X", "host": "", "ports": "[0]", "last_seen": "?"})
    assert rows(bad)[0]["reason"].count(";") == 3


def test_missing_columns(spark):
    df = spark.createDataFrame([("ASSET-1", "1.1.1.1", MOMENT)], "asset_id string, host string, last_seen string")
    r = rows(jobs.asset_job(df)[0])[0]
    assert (r["ports"], r["internet_exposed"], r["number_of_ports"], r["asset_type"]) == ([], False, 0, "Network Host")


TYPES = [
    ("Firewall", dict(tags='["firewall"]', ports="[3389]")),
    ("Firewall", dict(services='[{"port": 9, "service": "fortigate"}]')),
    ("Windows Server", dict(ports="[3389, 22]")),
    ("Windows Server", dict(ports="[22]", services='[{"port": 445, "service": "microsoft-ds"}]')),
    ("Linux Server", dict(ports="[22, 3306]")),
    ("Database Server", dict(ports="[3306, 80]")),
    ("Windows File Server", dict(services='[{"port": 445, "service": "smb"}]', ports="[80]")),
    ("Web Server", dict(ports="[8080, 25]")),
    ("Mail Server", dict(ports="[25, 53]")),
    ("DNS Server", dict(ports="[53]")),
    ("Domain Asset", dict(host="", domain="a.com", discovered_by='["crtsh"]')),
    ("Domain Asset", dict(domain="a.com")),
    ("Network Host", {}),
    ("Unknown", dict(ports="[7]")),
    ("Unknown", dict(host="", domain="a.com")),
]


def test_asset_types(spark):
    df = raw(spark, *[{**change, "asset_id": f"ASSET-{i}"} for i, (_, change) in enumerate(TYPES)])
    got = by(jobs.asset_job(df)[0], "asset_id")
    for i, (kind, _) in enumerate(TYPES):
        assert got[f"ASSET-{i}"]["asset_type"] == kind, i


def test_scores_and_flags(spark):
    df = raw(spark, dict(ports="[22, 22, 443, 3306, 1, 2, 3, 4, 5, 6, 7, 8]", services='[{"port": 1, "service": "a"}, {"port": 1, "service": "a"}]', internet_exposed="1"), dict(asset_id="ASSET-2"))
    got = by(jobs.asset_job(df)[0], "asset_id")
    r = got["ASSET-1"]
    assert (r["number_of_ports"], r["number_of_services"]) == (11, 2)
    assert r["has_web_service"] and r["has_tls"] and r["has_database_service"] and r["has_remote_access_service"]
    assert r["exposure_score"] == 0.955 and r["asset_risk_score"] == 10.0
    z = got["ASSET-2"]
    assert (z["exposure_score"], z["asset_risk_score"], z["has_tls"]) == (0.0, 0.0, False)


def test_summary(spark):
    df = raw(spark, dict(ports="[22]", discovered_by='["nmap", "crtsh"]', internet_exposed="true"), dict(asset_id="ASSET-2", discovered_by='["nmap"]'), dict(asset_id="bad"))
    got = A.summary_to_dict(A.inventory_summary(*jobs.asset_job(df)))
    assert got["pipeline_metadata"] == {"total_records_processed": 3, "accepted": 2, "rejected": 1, "pass_rate_pct": 66.67}
    assert got["discovery_source"] == {"nmap": 2, "crtsh": 1} and got["asset_type_distribution"] == {"Linux Server": 1, "Network Host": 1}
    assert got["risk_score_distribution"]["median"] == 3.5 and got["internet_exposure"]["exposure_pct"] == 50.0


def test_enrichment_stays_in_the_jvm(spark):
    plan = plan_text(jobs.asset_job(raw(spark, {}))[0])
    assert "Python" not in plan and "Exchange" not in plan
