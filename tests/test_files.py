"""Readers match files by column name and keep fractions."""

import os

from riskloom.sources import files


def test_files_of_one_glob_are_matched_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("company_name,date,revenue,active_users,signups\nA,2024-01-01,10.5,2,1\n")
    (tmp_path / "b.csv").write_text("company_name,date,signups,active_users,revenue\nB,2024-01-01,1,2,10\n")
    rows = {r.company_id: r for r in files.read_daily_metrics(spark, f"{tmp_path}/*.csv").collect()}
    assert (rows["A"].revenue, rows["A"].active_users, rows["A"].signups) == (10.5, 2, 1)
    assert (rows["B"].revenue, rows["B"].active_users, rows["B"].signups) == (10.0, 2, 1)


def test_a_missing_column_is_null(spark, tmp_path):
    (tmp_path / "a.csv").write_text("company_name,date,revenue\nA,2024-01-01,1\n")
    (tmp_path / "b.csv").write_text("company_name,date\nB,2024-01-01\n")
    rows = {r.company_id: r.revenue for r in files.read_daily_metrics(spark, f"{tmp_path}/*.csv").collect()}
    assert rows == {"A": 1.0, "B": None}


def test_fractions_are_kept(spark, tmp_path):
    path = os.path.join(tmp_path, "c.csv")
    with open(path, "w") as out:
        out.write("company_id,customer_id,tenure,usage_frequency,support_tickets\nA,1,2.5,3.4,1\nA,2,4,5,2\n")
    rows = files.read_customers(spark, path).orderBy("customer_id").collect()
    assert [(r.tenure, r.usage_frequency, r.support_tickets) for r in rows] == [(2.5, 3.4, 1), (4.0, 5.0, 2)]
    assert dict(files.read_customers(spark, path).dtypes)["support_tickets"] == "int"


def test_only_an_absent_model_is_no_model(spark, tmp_path):
    import pytest

    from riskloom.plans.training import load_models

    assert load_models(spark, str(tmp_path / "none")).churn is None
    broken = tmp_path / "broken" / "forest"
    broken.mkdir(parents=True)
    (broken / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        load_models(spark, str(tmp_path / "broken"))


def test_placeholders_are_exact(spark):
    from pyspark.sql import functions as F

    from riskloom.functions.scalars import finite_or, normalize_na

    row = spark.createDataFrame([("NA", " NA ", "5d")], "a string, b string, c string").select(
        normalize_na(F.col("a")).alias("a"), normalize_na(F.col("b")).alias("b"), finite_or(F.col("c"), -1).alias("c")).first()
    assert (row.a, row.b, row.c) == (None, " NA ", -1.0)


def _tricky(n: int) -> list[tuple[str, str, str]]:
    import random

    rng = random.Random(5)
    parts = ["plain", "with, comma", "two\nlines", 'a "quoted" word', "\n\n", '"', '""', 'ends in "', "a,\n\"b\",\nc", "é€", "x" * 90]
    return [(str(i), "".join(rng.choices(parts, k=rng.randint(0, 4))) or "-", rng.choice(parts)) for i in range(n)]


def test_records_do_not_depend_on_the_cuts(spark, tmp_path):
    import csv

    rows = _tricky(300)
    for name, end, part in (("a", "\n", rows[:150]), ("b", "\r\n", rows[150:])):
        with open(tmp_path / f"{name}.csv", "w", newline="", encoding="utf-8") as out:
            writer = csv.writer(out, lineterminator=end)
            writer.writerow(["review_id", "review text", "note"])
            writer.writerows(part)
    for size in (61, 1_000, 1 << 20):
        found = files.read_raw_csv(spark, f"{tmp_path}/*.csv", multi_line=True, piece_bytes=size).collect()
        assert sorted((r[0], r[1], r[2]) for r in found) == sorted(rows), size


def test_stray_quotes_and_odd_files(spark, tmp_path):
    import gzip

    text = '\ufeffid,size\n\n1,5" wide\n2,"6"" wide"\n3,"a\nb"c\n4,"never closed\n5,x'
    (tmp_path / "stray.csv").write_text(text, encoding="utf-8")
    with gzip.open(tmp_path / "packed.csv.gz", "wt") as out:
        out.write('size,id\n"p\nq",6\nr,7\n')
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text("id,size")
    expected = None
    for size in (1, 3, 10, 1 << 20):
        got = {r["id"]: r["size"] for r in files.read_raw_csv(spark, f"{tmp_path}/*", multi_line=True, piece_bytes=size).collect()}
        assert got["1"] == '5" wide' and got["2"] == '6" wide' and got["6"] == "p\nq" and got["7"] == "r", size
        assert set(got) == {"1", "2", "3", "4", "6", "7"}
        expected = expected or got
        assert got == expected, size


def test_pieces_share_out_a_file(spark, tmp_path):
    from riskloom.sources import delimited

    (tmp_path / "a.csv").write_text("id,text\n" + "".join(f'{i},"x\n{i}"\n' for i in range(500)))
    headers = delimited.file_headers(spark, [str(tmp_path)])
    cut = delimited.pieces(headers, 100).orderBy("begin").collect()
    assert len(cut) > 30 and cut[0].begin == 0 and all(a.stop == b.begin for a, b in zip(cut, cut[1:]))
    assert any(p.quoted for p in cut)
    assert delimited.multi_line_records(headers, 100).count() == 500


def test_headers_with_empty_and_repeated_names():
    from riskloom.sources.delimited import column_names

    assert column_names('a,,"b, c",A') == ["a0", "_c1", "b, c", "A3"]


def test_stated_fractions_need_no_look(spark, tmp_path):
    (tmp_path / "c.csv").write_text("company_id,customer_id,tenure,usage_frequency\nA,1,2.5,3\n")
    frame = files.read_customers(spark, str(tmp_path / "c.csv"), fractions=["tenure"])
    assert dict(frame.dtypes)["tenure"] == "double" and dict(frame.dtypes)["usage_frequency"] == "int"
    assert frame.first().tenure == 2.5
