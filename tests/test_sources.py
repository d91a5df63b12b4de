import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.operators.quality import number_lines
from feedloom.sources import archive, delimited, fixed_width, headers, listing
from feedloom.specs import NAMES, SKIP_POSITIONAL, FeedSpec, FieldSpec

AB = (FieldSpec("a"), FieldSpec("b"))


def write(folder, **files):
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in files.items():
        (folder / name.replace("__", ".")).write_text(text)
    return str(folder)


def test_header_modes(spark, tmp_path, rows):
    path = write(tmp_path, x__csv="A,B\n1,2\n3,4\n")
    names = delimited.scan(spark, path, FeedSpec("x", AB, header=NAMES, imposed=False))
    assert rows(names, "A", "B") == [("1", "2"), ("3", "4")]
    skip = delimited.scan(spark, path, FeedSpec("x", AB, header=SKIP_POSITIONAL, imposed=False))
    assert rows(skip, "a", "b") == [("1", "2"), ("3", "4")]
    plain = delimited.scan(spark, path, FeedSpec("x", AB, imposed=False))
    assert rows(plain, "a", "b") == [("1", "2"), ("3", "4"), ("A", "B")]
    other = delimited.scan(spark, path, FeedSpec("x", AB[:1], imposed=False))
    assert [c for c in other.columns if c.startswith("_c") and c != "_corrupt_record"] == ["_c0", "_c1"]
    assert delimited.lower_names(names).columns[:2] == ["a", "b"]


def test_wrong_number_of_columns(spark, tmp_path):
    path = write(tmp_path, x__csv="A,B\n1,2\n")
    with pytest.raises(ValueError, match="expected 1 columns but found 2"):
        delimited.scan(spark, path, FeedSpec("x", AB[:1], header=SKIP_POSITIONAL, imposed=False))


def test_file_with_other_header_is_refused(spark, tmp_path):
    path = write(tmp_path, x1__csv="A,B\n1,2\n", x2__csv="B,A\n1,2\n")
    with pytest.raises(Exception, match="header"):
        delimited.scan(spark, path, FeedSpec("x", header=NAMES, imposed=False)).collect()


def test_a_header_per_file(spark, tmp_path, rows):
    path = write(
        tmp_path, a__csv="a,b\n1,x\n\n 2 , y \n3\n4,5,6\n", b__csv='b,"c,d",a,A\n"q, r",s,7,8\n', c__csv="a\n9\n", d__csv="a,b\na,b\n", e__csv="b,,a\n1,2,3\n",
    )
    spec = FeedSpec("x", AB, header=NAMES, imposed=False, input_format="csv_quote")
    found = headers.scan(spark, path, spec)
    got = rows(found.rows, "_file", "a", "b", "_corrupt_record")
    assert got == sorted([
        ("a.csv", "1", "x", None), ("a.csv", " 2 ", " y ", None), ("a.csv", "3", None, "3"), ("a.csv", "4", "5", "4,5,6"),
        ("b.csv", "7", "q, r", None), ("c.csv", "9", None, None), ("d.csv", "a", "b", None), ("e.csv", "3", "1", None),
    ], key=repr)
    assert rows(found.gaps) == [("c.csv", "b")]
    assert headers.names_of(spark, ['b,"c,d",a', "b,,a"], spec) == [["b", "c,d", "a"], ["b", "_c1", "a"]]
    # With one header for all there is nothing to join, and the rows are those of the plain scan.
    one = headers.scan(spark, f"{path}/a.csv", spec)
    assert one.gaps is None and "Join" not in one.rows._jdf.queryExecution().optimizedPlan().toString()
    plain = delimited.scan(spark, f"{path}/a.csv", spec)
    assert rows(one.rows, "a", "b", "_corrupt_record", "_file") == rows(plain, "a", "b", "_corrupt_record", "_file")


def test_a_header_per_file_with_another_charset(spark, tmp_path, rows):
    (tmp_path / "x.csv").write_bytes("é;b\nü;1\n".encode("latin-1"))
    (tmp_path / "y.csv").write_bytes("b;é\n2;ß\n".encode("latin-1"))
    spec = FeedSpec("x", (FieldSpec("é"), FieldSpec("b")), header=NAMES, imposed=False, charset="ISO-8859-1", delimiter=";")
    assert rows(headers.scan(spark, str(tmp_path), spec).rows, "é", "b") == [("ß", "2"), ("ü", "1")]
    with pytest.raises(ValueError, match="different headers"):
        headers.MOST_HEADERS, before = 1, headers.MOST_HEADERS
        try:
            headers.scan(spark, str(tmp_path), spec)
        finally:
            headers.MOST_HEADERS = before


def test_duplicate_header_names_keep_the_first(spark, tmp_path, rows):
    path = write(tmp_path, x__csv="id,ID,v\n1,2,3\n")
    df = delimited.scan(spark, path, FeedSpec("x", header=NAMES, imposed=False))
    assert rows(df, "id", "v") == [("1", "3")]


def test_corrupt_lines_survive_pruning(spark, tmp_path):
    path = write(tmp_path, x__csv="1,2\n3\n4,5,6\n7,8\n")
    df = delimited.scan(spark, path, FeedSpec("x", AB))
    assert df.where("_corrupt_record is not null").count() == 2
    assert df.agg(F.count("_corrupt_record")).first()[0] == 2


def test_quotes_newlines_tab_and_charset(spark, tmp_path, rows):
    write(tmp_path / "q", x__csv='1,"say \\"hi\\", you"\n')
    q = delimited.scan(spark, str(tmp_path / "q"), FeedSpec("x", AB, input_format="csv_quote"))
    assert rows(q, "b") == [('say "hi", you',)]
    write(tmp_path / "m", x__csv='1,"two\nlines"\n2,b\n')
    m = delimited.scan(spark, str(tmp_path / "m"), FeedSpec("x", AB, input_format="csv_quote_ml"))
    assert rows(m, "a", "b") == [("1", "two\nlines"), ("2", "b")]
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "x.csv").write_bytes("1\té\n".encode("latin-1"))
    t = delimited.scan(spark, str(tmp_path / "t"), FeedSpec("x", AB, delimiter="\t", charset="ISO-8859-1"))
    assert rows(t, "b") == [("é",)]


def test_accept_prunes_files_when_listing(spark, tmp_path):
    path = write(tmp_path, x_1__csv="1,2\n", x_2__csv="3,4\n", y_1__csv="5,6\n")
    name = delimited.received_name(F.col("_metadata.file_path"))
    df = delimited.scan(spark, path, FeedSpec("x", AB), name.startswith("x_"))
    assert df.count() == 2
    executed = df._jdf.queryExecution().executedPlan()
    scans = [executed]
    while scans:
        node = scans.pop()
        if node.nodeName().startswith("Scan csv"):
            df.collect()
        scans += [node.children().apply(i) for i in range(node.children().size())]
    assert sorted({r[0] for r in df.select("_file").collect()}) == ["x_1.csv", "x_2.csv"]


def test_fixed_width(spark, tmp_path, rows):
    path = write(tmp_path, x__txt="ab123\ncd4\n")
    spec = FeedSpec("x", (FieldSpec("l", size=2), FieldSpec("n", size=3)), input_format="fixed")
    assert rows(fixed_width.scan(spark, path, spec), "l", "n") == [("ab", "123"), ("cd", "4")]


def test_fixed_width_of_another_charset(spark, tmp_path, rows):
    (tmp_path / "x.txt").write_bytes("éb123\nüd4\n".encode("latin-1"))
    spec = FeedSpec("x", (FieldSpec("l", size=2), FieldSpec("n", size=3)), input_format="fixed", charset="ISO-8859-1")
    assert rows(fixed_width.scan(spark, str(tmp_path), spec), "l", "n") == [("éb", "123"), ("üd", "4")]


def test_empty_files(spark, tmp_path, rows):
    path = write(tmp_path, a__csv="1,2\n", b__csv="")
    assert rows(listing.empty_files(spark, path)) == [("b.csv",)]
    assert rows(listing.list_files(spark, path), "file_name", "bytes") == [("a.csv", 4)]


def test_line_numbers_are_dense_over_many_blocks(spark, tmp_path):
    path = write(tmp_path, a__csv="".join(f"{i},x\n" for i in range(1, 3001)), b__csv="1,x\n2,x\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        df = delimited.scan(spark, path, FeedSpec("x", AB))
        assert df.rdd.getNumPartitions() > 5
        got = number_lines(df).select("_file", "a", "line_id").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(got) == 3002 and all(int(r["a"]) == r["line_id"] for r in got)


def test_archives(spark, tmp_path, rows):
    good = tmp_path / "site_20250902.zip"
    with zipfile.ZipFile(good, "w") as z:
        z.writestr("site.csv", "a,b\n1,2\n3,4\n")
        z.writestr("__MACOSX/site.csv", "junk\n")
        z.writestr(".hidden", "junk\n")
        z.writestr("dir/", "")
    (tmp_path / "bad.zip").write_bytes(good.read_bytes()[:50])
    with zipfile.ZipFile(tmp_path / "none_1.zip", "w") as z:
        z.writestr("__MACOSX/x", "junk\n")
    lines = archive.read_archives(spark, str(tmp_path))
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    assert rows(archive.parse_lines(lines, schema), "feed", "entry", "line_no", "a", "b") == [
        ("site", "site.csv", 2, "1", "2"), ("site", "site.csv", 3, "3", "4"),
    ]
    failed = {r["archive"]: r["error"] for r in lines.where("error is not null").collect()}
    assert set(failed) == {"bad.zip", "none_1.zip"} and failed["none_1.zip"] == "No valid files in ZIP"


def test_a_damaged_archive_gives_no_line(spark, tmp_path, rows):
    for name in ("good_1.zip", "bad_1.zip"):
        with zipfile.ZipFile(tmp_path / name, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("a.csv", "A,B\n1,2\n")
            z.writestr("b.csv", "A,B\n" + "".join(f"{i},{i * i}\n" for i in range(3000)))
    data = bytearray((tmp_path / "bad_1.zip").read_bytes())
    data[len(data) // 2] ^= 0xFF
    (tmp_path / "bad_1.zip").write_bytes(bytes(data))
    lines = archive.read_archives(spark, str(tmp_path))
    bad = lines.where("archive = 'bad_1.zip'").collect()
    assert len(bad) == 1 and bad[0]["error"].startswith("Invalid ZIP file")
    assert lines.where("archive = 'good_1.zip' AND error IS NULL").count() == 3003


def test_deliveries_may_start_like_part_files(spark, tmp_path, rows):
    path = write(tmp_path / "in", **{"part-20250901__csv": "1,2\n"})
    write(tmp_path / "in" / "x_20250902.csv", **{"part-00000__csv": "3,4\n"})
    assert rows(listing.list_files(spark, path), "file_name", "folder") == [("part-20250901.csv", "in"), ("x_20250902.csv", "in")]
