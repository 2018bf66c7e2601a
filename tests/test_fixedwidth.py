"""Fixed-width parsing goldens (FIXTURES §1) and the folder conversion."""

import os

import pytest

from spendmatch.sources import fixedwidth as fw

GOLDEN = [
    ("12345SMITH CO 123456789 AB 10.50 2513",
     ("1", "2345", "SMITH CO", "123456789", "AB", "10.50", "25", "13")),
    ("12345ACME 1234567890XY0001234502513",
     ("1", "2345", "ACME 1", "234567890", "XY", "00012345025.13", "25", "13")),
    ("12345NO ID HERE AB 10.50 2513", None),
    ("12345ACME 123456789 99 10.50 2513", None),
    ("12345ACME 123456789 AB 99", None),
    ("", "blank"),
    ("   ", "blank"),
]


def test_golden_lines(spark):
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(GOLDEN)], "i int, value string")
    rows = {r.i: r for r in fw.parse_lines(df).collect()}
    for i, (_, want) in enumerate(GOLDEN):
        r = rows[i]
        if want == "blank":
            assert r.is_blank and not r.is_parsed
        elif want is None:
            assert not r.is_blank and not r.is_parsed
        else:
            assert r.is_parsed
            assert tuple(r[c] for c in fw.FIELD_ORDER) == want


def test_folder_conversion(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("\n".join(v for v, _ in GOLDEN) + "\n")
    with open(os.path.join(src, "b.txt"), "w") as f:
        f.write(GOLDEN[0][0] + "\n")
    with open(os.path.join(src, "skip.csv"), "w") as f:
        f.write("not,a,report\n")
    out = os.path.join(tmpdir_path, "out")
    stats = {r.file_stem: (r.processed_lines, r.total_lines)
             for r in fw.convert_folder(spark, src, out).collect()}
    assert stats == {"a": (2, 7), "b": (1, 1), None: (3, 8)}
    parts = sorted(p for p in os.listdir(out) if p.startswith("file_stem="))
    assert parts == ["file_stem=a_converted", "file_stem=b_converted"]
    back = spark.read.option("header", True).csv(os.path.join(out, "file_stem=a_converted"))
    assert back.columns == fw.CSV_HEADERS
    assert back.count() == 2


def test_stream_conversion_reads_each_file_once(spark, tmpdir_path):
    from spendmatch.streaming.folder_stream import start_conversion
    src = os.path.join(tmpdir_path, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("\n".join(v for v, _ in GOLDEN) + "\n")
    out, rej, ck = (os.path.join(tmpdir_path, x) for x in ("out", "rej", "ck"))
    start_conversion(spark, src, out, rej, ck).awaitTermination(120)
    assert spark.read.option("header", True).csv(out).count() == 2
    with open(os.path.join(src, "b.txt"), "w") as f:
        f.write(GOLDEN[0][0] + "\n")
    start_conversion(spark, src, out, rej, ck).awaitTermination(120)   # only b.txt is new
    assert spark.read.option("header", True).csv(out).count() == 3
    assert spark.read.parquet(rej).count() == 3


def test_folder_conversion_counts_empty_files_and_numbers_rejects(spark, tmp_path):
    from spendmatch.sources import fixedwidth as FW
    good = "10001Acme 100000001 AB 12.50 2513"
    (tmp_path / "in").mkdir()
    for name, lines in {"a.txt": [good, "", "junk", good], "b.txt": [], "c.csv": [good]}.items():
        (tmp_path / "in" / name).write_text("".join(x + "\n" for x in lines))
    folder = f"file:{tmp_path}/in"       # the pattern holds for a URI too
    stats = {r.file_stem: (r.processed_lines, r.total_lines) for r in FW.convert_folder(spark, folder, f"{tmp_path}/out").collect()}
    assert stats == {"a": (2, 4), "b": (0, 0), None: (2, 4)}
    survey = FW.survey_lines(spark, folder)
    assert [tuple(r) for r in FW.numbered_rejects(survey).collect()] == [("a", 3, "junk")]
    again = {r.file_stem: (r.processed_lines, r.total_lines) for r in FW.run_statistics(survey, files=FW.list_files(spark, folder)).collect()}
    assert again == stats
    assert spark.read.option("header", True).csv(f"{tmp_path}/out").count() == 2


def test_numbers_hold_across_splits(spark, tmp_path):
    """A file read in many splits, another in one: numbers count through the whole file."""
    from spendmatch.sources import fixedwidth as FW
    good = "10001Acme 100000001 AB 12.50 2513"
    files = {"long": [good if i % 7 else f"junk {i}" for i in range(4000)], "short": ["bad", good]}
    (tmp_path / "in").mkdir()
    for name, lines in files.items():
        (tmp_path / "in" / f"{name}.txt").write_text("".join(x + "\n" for x in lines))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        survey = FW.survey_lines(spark, f"{tmp_path}/in")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert survey.select("_file", "_at").distinct().count() > 10
    want = {(n, i + 1, x) for n, lines in files.items() for i, x in enumerate(lines) if x != good}
    assert {tuple(r) for r in FW.numbered_rejects(survey).collect()} == want


def test_a_failed_stream_batch_runs_again_and_counts_once(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameWriter
    from spendmatch.streaming.folder_stream import start_conversion
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("".join(v + "\n" for v, _ in GOLDEN))
    args = [spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/rej", f"{tmp_path}/ck"]
    write, left = DataFrameWriter.parquet, [1]

    def fails_once(self, path, *a, **k):
        if "/rej/" in path and left.pop(0):     # the converted rows of the batch are written by then
            left.append(0)
            raise OSError("executor lost")
        left.append(0)
        return write(self, path, *a, **k)
    monkeypatch.setattr(DataFrameWriter, "parquet", fails_once)
    with pytest.raises(Exception, match="executor lost"):
        start_conversion(*args).awaitTermination(120)
    assert spark.read.option("header", True).csv(f"{tmp_path}/out").count() == 2     # left by the failed batch
    start_conversion(*args).awaitTermination(120)
    start_conversion(*args).awaitTermination(120)                                    # nothing new
    assert spark.read.option("header", True).csv(f"{tmp_path}/out").count() == 2
    rejects = spark.read.parquet(f"{tmp_path}/rej")
    assert rejects.count() == sum(1 for v, ok in GOLDEN if v.strip() and not ok) and rejects.select("batch_id").distinct().count() == 1
