import csv
import glob

import pytest

from cartrail import Star, schemas
from cartrail.operators import clean
from cartrail.plans import product, recommend
from cartrail.sources import readers, sinks
from tests.shop import build, ordered, rows


@pytest.fixture()
def csv_paths(tmp_path):
    files = {
        "customer_journey": "JourneyID,CustomerID,ProductID,VisitDate,Stage,Action,Duration\n"
        "1,1,10,2024-01-01,Checkout,Purchase,30\n2,2,10,2024-01-02,checkout,Drop-off,\n2,2,10,2024-01-02,CHECKOUT,drop-off,\n",
        "customer_reviews": "ReviewID,CustomerID,ProductID,ReviewDate,Rating,ReviewText\n"
        '1,1,10,2024-01-03,4,"nice,  ""really""  nice "\n2,2,10,2024-01-03,1,\n',
        "customers": "CustomerID,CustomerName,Email,Gender,Age,GeographyID\n1,Ann,a@x,fEMALE,17,1\n1,Anna,b@x,male,40,2\n2,Bob,b@x,MALE,130,1\n",
        "engagement_data": "EngagementID,ContentID,ContentType,Likes,EngagementDate,CampaignID,ProductID,ViewsClicksCombined\n"
        "1,1,Blog,3,2024-01-01,1,10,100-7\n",
        "geography": "GeographyID,Country,City\n1,Austria,Vienna\n",
        "products": "ProductID,ProductName,Category,Price\n10,Kayak,Sport,9.99\n11,Free,Sport,0\n",
    }
    paths = {}
    for name, content in files.items():
        path = tmp_path / f"{name}.csv"
        path.write_text(content)
        paths[name] = str(path)
    return paths


def _cleaned(spark, paths):
    raw = readers.read_csv_tables(spark, paths)
    raw["customers"] = readers.with_ingest_order(raw["customers"])
    return clean.clean_all(raw, readers.INGEST_ORDER, strict=True)


def test_csv_to_report(spark, csv_paths):
    tables = _cleaned(spark, csv_paths)
    assert {name: df.count() for name, df in tables.items()} == {
        "customer_journey": 2,
        "customer_reviews": 2,
        "customers": 2,
        "engagement_data": 1,
        "geography": 1,
        "products": 1,
    }
    assert rows(tables["customers"].select("CustomerName", "Gender", "Age")) == [("Ann", "Female", 18), ("Bob", "Male", 100)]
    assert rows(tables["customer_reviews"].select("ReviewText")) == [("No review",), ('nice,  "really"  nice',)]
    assert ordered(product.dropoff_rate(Star(tables))) == [("checkout", 2, 1, 50.0)]


def test_wrong_header_is_refused(spark, csv_paths):
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        readers.read_csv_tables(spark, {"geography": csv_paths["products"]})["geography"].collect()


def test_load_replaces_and_reads_back(spark, csv_paths, tmp_path):
    tables, root = _cleaned(spark, csv_paths), str(tmp_path / "out")
    for _ in range(2):
        report = sinks.load_tables(spark, tables, root)
    assert rows(report)[0] == ("customer_journey", "loaded", 2)
    loaded = readers.read_parquet_tables(spark, {name: f"{root}/{name}" for name in tables})
    for name, df in loaded.items():
        assert df.schema.names == schemas.CLEAN[name].names
        assert rows(df) == rows(schemas.conform(tables[name], schemas.CLEAN[name]))


def test_failing_table_does_not_stop_the_others(spark, csv_paths, tmp_path):
    with open(csv_paths["engagement_data"], "a") as out:
        out.write("2,1,Blog,3,2024-01-01,1,10,broken\n")
    report = {r.table_name: (r.status, r.rows) for r in sinks.load_tables(spark, _cleaned(spark, csv_paths), str(tmp_path / "out")).collect()}
    assert report["engagement_data"] == ("failed: USER_RAISED_EXCEPTION", None)
    assert report["products"] == ("loaded", 1)


def test_unwritable_target_is_reported(spark, tmp_path):
    (tmp_path / "file").write_text("in the way")
    report = sinks.load_tables(spark, {"t": spark.range(3)}, str(tmp_path / "file")).first()
    assert report.status.startswith("failed: ")
    assert report.rows is None


def test_views(spark):
    star = build(spark)
    readers.register_views({"journey_view": star.journey})
    assert spark.sql("SELECT count(*) FROM journey_view WHERE Action = 'purchase'").first()[0] == 4


def test_csv_sink_keeps_quotes_and_blanks(spark, tmp_path):
    path = str(tmp_path / "csv")
    sinks.write_csv(spark.createDataFrame([(1, 'a "b",  c')], "id int, t string").coalesce(1), path)
    [part] = glob.glob(f"{path}/*.csv")
    with open(part) as content:
        assert list(csv.reader(content)) == [["id", "t"], ["1", 'a "b",  c']]


def test_text_sink_keeps_order_over_several_files(spark, tmp_path, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    path = str(tmp_path / "text")
    lines = spark.range(1000).selectExpr("1 AS section", "CAST(id AS DOUBLE) AS sort_key", "'' AS sort_name", "concat('line ', id) AS line")
    sinks.write_lines(lines.repartition(7), path, *recommend.READING_ORDER)
    parts = sorted(glob.glob(f"{path}/part-*"))
    assert len(parts) > 1
    written = [line for part in parts for line in open(part).read().splitlines()]
    assert written == [f"line {i}" for i in range(1000)]


def test_print_tables(spark, capsys):
    sinks.print_tables({"Numbers": spark.range(2)})
    printed = capsys.readouterr().out
    assert "Numbers:" in printed
    assert "|id |" in printed


class _Session:
    """Only the settings of a session."""

    def __init__(self, **options):
        self.conf = {name.replace("__", "."): value for name, value in options.items()}


def test_work_dir_follows_the_session():
    on_cluster = _Session(spark__master="yarn", spark__checkpoint__dir="hdfs:/shared/folder/")
    first, second = sinks.work_dir(on_cluster), sinks.work_dir(on_cluster)
    assert first.startswith("hdfs:/shared/folder/cartrail-")
    assert first != second


def test_work_dir_is_never_local_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        sinks.work_dir(_Session(spark__master="yarn"))
    assert sinks.work_dir(_Session(spark__master="local[2]"))


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "journey")
    build(spark).journey.write.parquet(path)
    star = Star({"customer_journey": spark.read.schema(schemas.JOURNEY).parquet(path), "customers": build(spark).customers})
    from cartrail.plans import customer

    plan = customer.one_time_purchasers(star)._jdf.queryExecution().toString()
    assert "EqualTo(Action,purchase)" in plan
    assert "ReadSchema: struct<JourneyID:bigint,CustomerID:bigint,Action:string>" in plan


def test_a_failed_load_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.write_table(spark.range(10).toDF("id"), path) == 10
    broken = spark.range(5).selectExpr("if(id = 3, raise_error('no'), id) AS id")
    report = sinks.load_tables(spark, {"t": broken}, str(tmp_path)).first()
    assert report.status.startswith("failed") and report.rows is None
    assert spark.read.parquet(path).count() == 10
    assert sinks.write_table(spark.read.parquet(path).where("id < 4"), path) == 4
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 1, 2, 3]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]


def test_bad_csv_lines_are_returned_and_no_good_one_is_lost(spark, tmp_path):
    names = ",".join(schemas.RAW["customers"].names)
    good = ["1,Ann,a@x,Female,29,1", '2,"Bob, Jr",b@x,Male,30,', "3,,,,,"]
    bad = ["A1,Cid,c@x,Male,46,2", "4,Dee,d@x,Female,abc,1", "5,Eve,e@x,Female,20,1,extra", "6,Fay"]
    file = tmp_path / "customers.csv"
    file.write_text("\n".join([names, *good, *bad]) + "\n")
    rows, rejects = readers.read_csv_checked(spark, "customers", str(file))
    assert sorted(r.CustomerID for r in rows.collect()) == [1, 2, 3] and rows.columns == schemas.RAW["customers"].names
    assert rows.select("CustomerName").count() == 3
    assert sorted(r[0] for r in rejects.collect()) == sorted(bad)
    loose = readers.read_csv_tables(spark, {"customers": str(file)}, strict=False)["customers"]
    assert loose.count() == 3
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        readers.read_csv_tables(spark, {"customers": str(file)})["customers"].collect()
