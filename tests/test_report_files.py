"""Report files are written by as many tasks as read the rows."""

from checks import queries as Q


def events(spark, folder, n):
    spark.sql(
        f"SELECT id AS event_id, timestamp'2024-01-01 00:00:00' AS ts, id % 7 AS user_id, CASE id % 3 WHEN 0 THEN 'view' WHEN 1 THEN 'error' ELSE 'click' END AS event_type, "
        f"CAST(id AS DOUBLE) AS value, 'p=80' AS props FROM range({n})"
    ).write.parquet(f"{folder}/events.parquet")


def test_whatweb_files_by_few_tasks(spark, tmp_path, monkeypatch):
    events(spark, tmp_path, 600)
    monkeypatch.setattr(Q, "WHATWEB_FILE_ROWS", 10)  # 60 files
    calls, kind = [], type(spark.range(1))
    plain = kind.repartition
    monkeypatch.setattr(kind, "repartition", lambda self, n, *c: (calls.append(n), plain(self, n, *c))[1])
    out = Q.whatweb_report(spark, str(tmp_path))
    assert not calls  # no task per file
    assert out.count() == 600 - 10 * sum(b % 9 == 4 for b in range(60))


def test_csv_with_line_breaks_by_many_tasks(spark, tmp_path, monkeypatch):
    spark.sql(
        "SELECT id AS l_orderkey, id AS l_partkey, id % 5 AS l_suppkey, CAST(1 + id % 7 AS INT) AS l_linenumber, CAST(id % 50 AS DOUBLE) AS l_quantity, CAST(id AS DOUBLE) AS l_extendedprice, "
        "0.05D AS l_discount, 0.08D AS l_tax, 'R' AS l_returnflag, 'O' AS l_linestatus, timestamp'2024-01-01 00:00:00' AS l_shipdate FROM range(0, 400, 1, 4)"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    paths, plain = [], Q.scratch_path
    monkeypatch.setattr(Q, "scratch_path", lambda *a: (paths.append(plain(*a)), paths[-1])[1])
    before = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "6k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        out = Q.csv_line_breaks(spark, str(tmp_path))
        assert out.count() == 400 and out.where("note LIKE 'said \"no\"%'").count() == 400
        assert spark.read.text(paths[0]).selectExpr("_metadata.file_path AS f").distinct().count() > 1
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
