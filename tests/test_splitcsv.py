"""CSV with line breaks in quoted cells: read by many tasks, equal to the read of whole files."""

import random

from riskspark.sources import splitcsv, tables


def test_many_tasks_equal_whole_file_read(spark, tmp_path):
    rng = random.Random(1)
    rows = []
    for i in range(6000):
        note = " ".join(rng.choice(["a", "b,c", 'say "hi"', "line\nbreak", "x" * rng.randrange(1, 40), ""]) for _ in range(rng.randrange(0, 6)))
        rows.append((i, "long\n" * 3000 if i % 997 == 0 else note, rng.random() if i % 5 else None))
    path = str(tmp_path / "t.csv")
    schema = "id long, note string, v double"
    tables.write_table(spark.createDataFrame(rows, schema).coalesce(1), path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        assert spark.read.text(path).rdd.getNumPartitions() > 10
        whole = spark.read.schema(schema).csv(path, header=True, escape='"', multiLine=True)
        split = splitcsv.read_csv_split(spark, path, schema)
        assert sorted(map(tuple, split.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
        assert sorted(map(tuple, tables.read_table(spark, path, schema).collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_header_only_and_several_files(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    (folder / "a.csv").write_text('id,note\n1,"x\ny"\n2,z\n', encoding="utf-8")
    (folder / "b.csv").write_text("id,note\n", encoding="utf-8")
    (folder / "c.csv").write_text('id,note\n3,"""q"""\n', encoding="utf-8")
    got = sorted(map(tuple, splitcsv.read_csv_split(spark, str(folder), "id long, note string").collect()))
    assert got == [(1, "x\ny"), (2, "z"), (3, '"q"')]
