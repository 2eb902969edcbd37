import csv
import glob
import os
import random

import pytest

from ledgerloom.plans import medallion
from ledgerloom.session import new_database, new_path
from ledgerloom.sources import catalog, csvfiles

QUOTED = 'id,note\n1,"line1\nline2"\n2,"a ""q"" b"\n3,plain\n'


def read_rows(path):
    with open(path, newline="", encoding="utf-8") as f:
        return [tuple(row) for row in csv.reader(f)][1:]


def test_quoted_line_ends_and_quotes(spark, csv_dir):
    path = csv_dir(notes=QUOTED) + "/notes.csv"
    assert csvfiles.record_layout(spark, path) == csvfiles.WHOLE_FILE
    assert sorted(map(tuple, csvfiles.scan_raw_text(spark, path).collect())) == sorted(read_rows(path))
    assert csvfiles.scan_inferred(spark, path).count() == 3


def test_files_without_spanning_records_stay_splittable(spark, csv_dir):
    path = csv_dir(notes='id,note\n1,"a ""q"" b"\n2,"x, y"\n') + "/notes.csv"
    assert csvfiles.record_layout(spark, path) == csvfiles.BY_LINE
    assert sorted(map(tuple, csvfiles.scan_raw_text(spark, path).collect())) == sorted(read_rows(path))


@pytest.fixture(params=[64, 200, None])
def split_size(spark, request):
    """Splits of a few lines, so that the size of a file can matter, and the default."""
    key, open_cost = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    before = spark.conf.get(key), spark.conf.get(open_cost)
    if request.param:
        spark.conf.set(key, str(request.param))
        spark.conf.set(open_cost, "1")
    yield request.param
    spark.conf.set(key, before[0])
    spark.conf.set(open_cost, before[1])


def messy_csv(seed, n, end):
    """Records with quotes, commas and line ends inside fields."""
    rnd = random.Random(seed)
    lines = ["id,note,amount"]
    for i in range(n):
        text = "".join(rnd.choice(["a", "bc", '""', ",", "\n", " "]) for _ in range(rnd.randrange(12)))
        if i % 37 == 5:
            text += "long\n" * 60
        note = rnd.choice(["plain", "", f'"{text}"'])
        lines.append(f"{i},{note},{i / 4}")
    return end.join(lines) + rnd.choice(["", end])


SAME_AT_EVERY_SIZE = {
    "stray quote": ("id,size,note\n" + "".join(f'{i},3,5" pipe\n' for i in range(60)), csvfiles.BY_LINE),
    "header with a line end": ('id,"two\nlines"\n' + "".join(f"{i},x\n" for i in range(60)), csvfiles.WHOLE_FILE),
    "blank lines": ("id,note\n" + "".join(f"{i},x\n\n" for i in range(60)), csvfiles.BY_LINE),
    "quoted line ends": (messy_csv(3, 150, "\n"), csvfiles.WHOLE_FILE),
    "carriage returns": (messy_csv(4, 80, "\r\n"), csvfiles.WHOLE_FILE),
    "closed quotes": ("id,note\n" + "".join(f'{i},"a ""{i}"" b, c"\n' for i in range(60)), csvfiles.BY_LINE),
    "only a header": ("id,note\n", csvfiles.BY_LINE),
}


@pytest.mark.parametrize("case", list(SAME_AT_EVERY_SIZE))
def test_records_do_not_depend_on_the_split_size(spark, csv_dir, split_size, case):
    text, layout = SAME_AT_EVERY_SIZE[case]
    path = csv_dir(t=text) + "/t.csv"
    want = sorted(row for row in read_rows(path) if row)
    assert csvfiles.record_layout(spark, path) == layout
    raw = csvfiles.scan_raw_text(spark, path)
    assert sorted(map(tuple, raw.collect())) == want
    inferred = csvfiles.scan_inferred(spark, path)
    assert len(inferred.columns) == len(raw.columns) and inferred.count() == len(want)


def test_parts_with_differing_headers_are_refused(spark, csv_dir, split_size):
    folder = csv_dir(a="id,note\n" + "1,x\n" * 60, b="note,id\n" + "x,1\n" * 60)
    for scan in (csvfiles.scan_raw_text, csvfiles.scan_inferred):
        with pytest.raises(Exception, match="(?i)header"):
            scan(spark, folder).collect()


def test_open_lines_are_told_by_the_field_grammar(spark):
    lines = {
        "a,b": False, "": False, '"a","b"': False, '"a ""q"" b",c': False, 'a,"b': True, '"a""': True,
        'a"b,c': False, '3,5" pipe': False, '"a"b,"c': True, ',,"': True, '"",""': False, ',"x,y",': False,
        '"' + 'a""' * 50_000 + '"': False, '"' + 'a""' * 50_000: True, "," * 100_000: False,
    }
    found = spark.createDataFrame(list(lines.items()), "line string, open boolean")
    judged = found.withColumn("closed", found.line.rlike(csvfiles.CLOSED_LINE)).collect()
    assert [r.line[:20] for r in judged if r.open == r.closed] == []


def test_raw_text_keeps_empties_as_text(spark, csv_dir):
    path = csv_dir(t='a,b\n,1\n"",2\nx,\n') + "/t.csv"
    assert sorted(map(tuple, csvfiles.scan_raw_text(spark, path).collect())) == sorted(read_rows(path))


@pytest.mark.parametrize("bad", ["4,5", "6,7,8,9"])
def test_raw_text_rejects_ragged_rows(spark, csv_dir, bad):
    folder = csv_dir(t=f"a,b,c\n1,2,3\n{bad}\n")
    layers = medallion.Layers(spark, root=new_path(spark, "ragged"))
    with pytest.raises(Exception, match="(?i)malformed"):
        medallion.land_raw_text(layers, folder, ["t"])


def test_inference_loses_what_text_keeps(spark, csv_dir):
    key = "35240112345678000199550010000012341000012345"
    path = csv_dir(t=f"zip,key,day,mixed\n01310,{key},2024-01-05,10\n04567,{key},2024-01-06,n/a\n") + "/t.csv"
    inferred = csvfiles.scan_inferred(spark, path)
    assert dict(inferred.dtypes) == {"zip": "int", "key": "double", "day": "date", "mixed": "string"}
    assert {r.zip for r in inferred.collect()} == {1310, 4567}
    assert {r.zip for r in csvfiles.scan_raw_text(spark, path).collect()} == {"01310", "04567"}
    given = csvfiles.scan_inferred(spark, path, "zip string, key string, day date, mixed string")
    assert {r.key for r in given.collect()} == {key}


def test_discover_counts_files_and_folders(spark, csv_dir):
    folder = csv_dir(b="x\n1\n2\n", a="x\n1\n", other="x\n")
    spark.range(10).repartition(3).write.option("header", True).csv(folder + "/parts.csv")
    with open(folder + "/ignored.txt", "w") as f:
        f.write("x\n")
    found = [tuple(r) for r in csvfiles.discover_csv_tables(spark, folder).collect()]
    assert found == [("a.csv", "a", 1), ("b.csv", "b", 2), ("other.csv", "other", 0), ("parts.csv", "parts", 10)]
    assert csvfiles.csv_table_names(spark, folder) == ["a", "b", "other", "parts"]


def test_discovery_finds_empty_files_and_decodes_names(spark, tmp_path):
    for name, text in (("my table.csv", "x\n1\n"), ("a+b 100%.csv", "x\n1\n2\n"), ("empty.csv", "")):
        (tmp_path / name).write_text(text)
    found = [tuple(r) for r in csvfiles.discover_csv_tables(spark, str(tmp_path)).collect()]
    assert found == [("a+b 100%.csv", "a+b 100%", 2), ("empty.csv", "empty", 0), ("my table.csv", "my table", 1)]
    assert csvfiles.csv_table_names(spark, str(tmp_path)) == ["a+b 100%", "empty", "my table"]
    listed = csvfiles.discover_csv_tables(spark, str(tmp_path), count_lines=False)
    assert listed.columns == ["file_name", "table_name"] and listed.count() == 3


def test_overwrite_replaces_rows_and_schema(spark):
    path = new_path(spark, "replaced")
    for df in (spark.range(5).selectExpr("id", "'x' AS gone"), spark.range(3).selectExpr("id", "2.5D AS added")):
        n = catalog.overwrite_table(df, "replaced", path=path)
        assert n == df.count()
    assert catalog.read_table(spark, "replaced").columns == ["id", "added"]
    assert catalog.read_table(spark, "replaced").count() == 3


def test_a_failed_write_leaves_the_old_table(spark):
    name = new_database(spark, "kept") + ".t"
    catalog.overwrite_table(spark.range(4), name)
    before = spark.table(name).inputFiles()
    with pytest.raises(Exception, match="spoiled"):
        catalog.overwrite_table(spark.range(9).selectExpr("CASE WHEN id = 8 THEN raise_error('spoiled') ELSE id END AS id"), name)
    assert sorted(r.id for r in spark.table(name).collect()) == [0, 1, 2, 3] and spark.table(name).inputFiles() == before
    folder = os.path.dirname(os.path.dirname(before[0].removeprefix("file:")))
    assert len(os.listdir(folder)) == 1, "the failed write left its folder behind"


def test_a_plan_may_read_the_table_that_it_replaces(spark):
    name = new_database(spark, "own") + ".t"
    catalog.overwrite_table(spark.range(10), name)
    assert catalog.overwrite_table(spark.table(name).where("id > 6"), name) == 3
    assert catalog.overwrite_table(spark.table(name).selectExpr("id", "id * 2 AS twice"), name) == 3
    assert sorted(map(tuple, spark.table(name).collect())) == [(7, 14), (8, 16), (9, 18)]
    folder = os.path.dirname(os.path.dirname(spark.table(name).inputFiles()[0].removeprefix("file:")))
    assert len(os.listdir(folder)) == 1, "former versions are removed"


def test_tables_saved_by_spark_can_be_replaced(spark):
    database = new_database(spark, "managed")
    spark.range(5).write.saveAsTable(f"{database}.t")
    assert catalog.overwrite_table(spark.table(f"{database}.t").where("id < 2"), f"{database}.t") == 2
    assert sorted(r.id for r in spark.table(f"{database}.t").collect()) == [0, 1]
    spark.range(5).write.saveAsTable(f"{database}.u")
    assert catalog.overwrite_table(spark.table(f"{database}.u").selectExpr("id", "'x' AS more"), f"{database}.u") == 5


def test_first_rows_of_each_file_in_its_order(spark, csv_dir):
    folder = csv_dir(a="k,v\n" + "".join(f"{9 - i},x{i}\n" for i in range(9)), short="k\n1\n", none="k\n", b='k,v\n1,"two\nlines"\n2,z\n')
    for part in (1, 0):
        os.makedirs(folder + "/parts.csv", exist_ok=True)
        with open(f"{folder}/parts.csv/part-{part}.csv", "w") as f:
            f.write("k\n" + "".join(f"{part}{i}\n" for i in range(2)))
    first = {t: [tuple(r) for r in df.collect()] for t, df in csvfiles.sample_first_rows(spark, folder, 3).items()}
    assert sorted(first["a"]) == [("7", "x2"), ("8", "x1"), ("9", "x0")]
    assert first["short"] == [("1",)] and first["none"] == [] and sorted(first["b"]) == [("1", "two\nlines"), ("2", "z")]
    assert sorted(first["parts"]) == [("00",), ("01",), ("10",)]
    placed = csvfiles.sample_first_rows(spark, folder, 2, "at")["a"]
    assert sorted(map(tuple, placed.collect())) == [(1, "9", "x0"), (2, "8", "x1")]


def test_first_rows_do_not_read_whole_files(spark, tmp_path):
    """A field count that is wrong far behind the sample is never met."""
    text = "a,b\n" + "1,2\n" * 400_000 + "1,2,3\n"
    (tmp_path / "long.csv").write_text(text)
    assert csvfiles.sample_first_rows(spark, str(tmp_path), 200)["long"].count() == 200
    with pytest.raises(Exception, match="(?i)malformed"):
        csvfiles.scan_raw_text(spark, str(tmp_path / "long.csv"), csvfiles.BY_LINE).write.format("noop").mode("append").save()


def test_stamp_is_one_value(spark):
    assert catalog.stamp_ingestion(spark.range(100, numPartitions=4)).select("_ingested_at").distinct().count() == 1


def test_ddl_script(spark, tmp_path):
    ddl = spark.createDataFrame([("b", "CREATE b;"), ("a", "CREATE a;")], "table_name string, ddl string")
    catalog.write_ddl_script(ddl, str(tmp_path / "ddl"))
    (part,) = glob.glob(os.path.join(tmp_path, "ddl", "part-*"))
    text = open(part, encoding="utf-8").read()
    assert text.startswith("-- Tables as inferred")
    assert text.index("CREATE a;") < text.index("CREATE b;")


def test_sample_first_n(spark):
    df = spark.range(1000, numPartitions=7)
    assert [r.id for r in csvfiles.sample_first_n(df, 5, ["id"]).collect()] == [0, 1, 2, 3, 4]


def test_release_leaves_nothing_behind(spark, monkeypatch):
    from ledgerloom import session

    # The session's own folder and databases are shared by all tests, so a stand-in is released.
    own = os.path.join(session.shared_folder(spark), "stand-in")
    monkeypatch.setattr(session, "shared_folder", lambda _: own)
    monkeypatch.setattr(session, "_databases", {})
    name = session.new_database(spark, "gone")
    catalog.overwrite_table(spark.range(3), f"{name}.t")
    session.materialize(spark.range(3), "gone")
    assert os.path.isdir(own.removeprefix("file:")) and spark.catalog.databaseExists(name)
    session.release(spark)
    assert not os.path.exists(own.removeprefix("file:")) and not spark.catalog.databaseExists(name)
    assert session._databases == {}


def test_only_lines_with_a_quote_are_matched(spark, csv_dir, monkeypatch):
    """The pattern is slow; a line without a quote needs none."""
    monkeypatch.setattr(csvfiles, "CLOSED_LINE", "^nothing$")
    folder = csv_dir(plain="a,b\n1,x\n2,\n", quoted='a,b\n1,"x"\n')
    assert csvfiles.record_layout(spark, f"{folder}/plain.csv") == csvfiles.BY_LINE
    assert csvfiles.record_layout(spark, f"{folder}/quoted.csv") == csvfiles.WHOLE_FILE


def test_queries_export_only_what_they_read(spark, monkeypatch):
    from ledgerloom.plans import registry

    folder, made = "/root/testdata/sf0.001", {}
    monkeypatch.setattr(registry, "_exports", made)
    registry.QUERIES["csv_scan_raw_text"](spark, folder)
    (place,) = made.values()
    assert csvfiles.csv_table_names(spark, place) == ["orders"]
    registry.QUERIES["load_validation"](spark, folder)
    assert csvfiles.csv_table_names(spark, list(made.values())[-1]) == sorted(registry.VALIDATED)
    registry.QUERIES["type_conflicts"](spark, folder)
    parts = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(list(made.values())[-1]).inputFiles()
    assert parts and all(part.endswith(".csv.snappy") for part in parts)
