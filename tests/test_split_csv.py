"""A1: one quoted multi-line file read by several tasks gives the rows of the reader that takes it whole."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from mise.sources import readers as RD

FIELDS = ["date", "num_comments", "title", "user", "comment", "n_char"]


def write(path, n, seed, newline="\n", end="\n"):
    rng = random.Random(seed)
    cells = ["plain", "two\nlines", 'a "quoted" word', "comma, here", "", '"', "é\n\n\nx", 'ends with ""\n', " spaces ", "1 cup\n- 2 eggs\n" * 40]
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=newline)
        w.writerow(FIELDS)
        for i in range(n):
            w.writerow([f"2020-01-{i}", i, rng.choice(cells), f"u{i}", rng.choice(cells) + rng.choice(cells), rng.randrange(99)])
    if end != newline:
        data = open(path, "rb").read()
        open(path, "wb").write(data.removesuffix(newline.encode()) + end.encode())


def rows(df):
    return sorted(map(str, (tuple(r) for r in df.select("dataset", "entry_number", *FIELDS).collect())))


@pytest.mark.parametrize("size", ["700b", "4k", "64m"])
def test_rows_of_the_whole_reader(spark, tmp_path, size):
    write(tmp_path / "a.csv", 120, 1)
    write(tmp_path / "b.csv", 40, 2, newline="\r\n")
    write(tmp_path / "c.csv", 5, 3, end="")
    write(tmp_path / "header.csv", 0, 4)
    with open(tmp_path / "long.csv", "w") as f:   # one cell over many splits
        f.write(",".join(FIELDS) + '\n1,2,t,u,"' + "a line of one cell\n" * 900 + '",3\n\n4,5,t2,u2,"x",6\n')
    paths = [str(tmp_path / n) for n in ("a.csv", "b.csv", "c.csv", "header.csv", "long.csv")]
    want = rows(RD.read_posts_csv(spark, paths))
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        df = RD.read_posts_csv_split(spark, paths)
        got = rows(df)
        tasks = spark.read.text(paths[0]).rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == want and len(got) == 120 + 40 + 5 + 2
    assert tasks > 20 if size == "700b" else tasks >= 1


def test_malformed_rows_are_kept(spark, tmp_path):
    (tmp_path / "a.csv").write_text(",".join(FIELDS) + '\n1,2,t,u,"a\nb",3\n1,2\n1,2,t,u,c,6\n')
    df = RD.read_posts_csv_split(spark, str(tmp_path / "a.csv"), keep_corrupt=True)
    got = {r["entry_number"]: r[RD.CORRUPT] for r in df.collect()}
    whole = RD.read_posts_csv(spark, str(tmp_path / "a.csv"), keep_corrupt=True)
    assert {k: v is None for k, v in got.items()} == {r["entry_number"]: r[RD.CORRUPT] is None for r in whole.collect()}
    assert df.where(F.col("entry_number") == 1).first()["comment"] == "a\nb"
