import gzip
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from starmart.sinks import Store, write_landing
from starmart.sources import MissingLanding, load_extracts, match_columns, read_landing
from starmart.sources.landing import load_table

SCHEMA = T.StructType(
    [
        T.StructField("Id", T.StringType(), nullable=False),
        T.StructField("Name", T.StringType()),
        T.StructField("Amount", T.DecimalType(14, 2)),
        T.StructField("Count", T.LongType()),
    ]
)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "tables"), catalog=False)


def load(spark, store, tmp_path, text, name="t.csv"):
    path = tmp_path / name
    path.write_text(text)
    return load_table(read_landing(spark, str(path)), SCHEMA, store, "t")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_columns_are_matched_by_name_in_any_order_and_case(spark, store, tmp_path):
    loaded = load(spark, store, tmp_path, "COUNT,extra,name,ID\n7,x,Ann,001\n8,y,Bob,002\n")
    assert loaded.table.columns == ["Id", "Name", "Amount", "Count"]
    assert rows(loaded.table) == [("001", "Ann", None, 7), ("002", "Bob", None, 8)]
    assert (loaded.rows, loaded.rejected) == (2, 0)


def test_quoted_fields_may_hold_commas_quotes_and_line_breaks(spark, store, tmp_path):
    loaded = load(spark, store, tmp_path, 'Id,Name,Amount,Count\n"01","a ""b"", c\nd",1.5,2\n02,plain,2,3\n')
    assert rows(loaded.table) == [("01", 'a "b", c\nd', Decimal("1.50"), 2), ("02", "plain", Decimal("2.00"), 3)]


def test_tokens_become_null_and_n_slash_a_does_not(spark, store, tmp_path):
    text = "Id,Name,Amount,Count\n1,NA,Not Available,\n2,N/A,1,2\n3,\"\",1,2\n"
    loaded = load(spark, store, tmp_path, text)
    assert sorted(rows(loaded.table), key=str) == sorted(
        [("1", None, None, None), ("2", "N/A", Decimal("1.00"), 2), ("3", None, Decimal("1.00"), 2)], key=str
    )


def test_bad_rows_are_set_aside_with_a_reason(spark, store, tmp_path):
    text = (
        "Id,Name,Amount,Count\n"
        "1,ok,1.005,2\n"
        "2,short,1\n"
        "3,long,1,2,3\n"
        "4,amount,abc,2\n"
        '5,count,1,"1,234"\n'
        "NA,no id,1,2\n"
        "6,ok,,3\n"
    )
    loaded = load(spark, store, tmp_path, text)
    assert [r[0] for r in rows(loaded.table)] == ["1", "6"]
    reasons = {r.reject_record: r.reject_reason for r in loaded.rejects.collect()}
    assert reasons["2,short,1"] == "wrong number of fields"
    assert reasons["3,long,1,2,3"] == "wrong number of fields"
    assert sorted(reasons.values()) == [
        "Amount is not a number",
        "Count is not a number",
        "Id is missing",
        "wrong number of fields",
        "wrong number of fields",
    ]
    assert (loaded.rows, loaded.rejected) == (2, 5)


def test_a_short_row_is_found_when_the_table_needs_fewer_columns(spark, store, tmp_path):
    loaded = load(spark, store, tmp_path, "Id,Extra,Name\n1,x,Ann\n2,y\n")
    assert rows(loaded.table) == [("1", "Ann", None, None)]
    assert loaded.rejected == 1


def test_a_file_with_the_header_only_loads_nothing(spark, store, tmp_path):
    loaded = load(spark, store, tmp_path, "Id,Name,Amount,Count\n")
    assert (rows(loaded.table), loaded.rows, loaded.rejected) == ([], 0, 0)


def test_files_with_different_headers_are_put_together_by_name(spark, store, tmp_path):
    (tmp_path / "a.csv").write_text("Id,Name\n1,Ann\n")
    (tmp_path / "b.csv").write_text("NAME,ID,Count\nBob,2,5\n")
    both = read_landing(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    assert rows(load_table(both, SCHEMA, store, "t").table) == [("1", "Ann", None, None), ("2", "Bob", None, 5)]


@pytest.mark.parametrize("multi_line", [True, False])
def test_a_folder_with_two_headers_loads_both_by_name(spark, store, tmp_path, multi_line):
    folder = tmp_path / "t"
    folder.mkdir()
    (folder / "a.csv").write_text("Id,Name\n1,Ann\n")
    (folder / "b.csv").write_text("\ufeffName,Id\nBob,2\nshort\n")
    with gzip.open(folder / "c.csv.gz", "wt") as f:
        f.write("NAME,COUNT,ID,EXTRA\nCy,7,3,x\n4,5\n")
    (folder / "d.csv").write_text("Id,Name\n5,Eve\n")
    loaded = load_table(read_landing(spark, str(folder), multi_line=multi_line), SCHEMA, store, "t")
    assert sorted(rows(loaded.table)) == [("1", "Ann", None, None), ("2", "Bob", None, None), ("3", "Cy", None, 7), ("5", "Eve", None, None)]
    assert sorted(rows(loaded.rejects)) == [("4,5", "wrong number of fields"), ("short", "wrong number of fields")]


def test_a_file_that_cannot_be_read_is_set_aside(spark, store, tmp_path):
    folder = tmp_path / "t"
    folder.mkdir()
    (folder / "a.csv").write_text("Id,Name\n1,Ann\n")
    (folder / "b.csv.gz").write_bytes(b"this is not gzip")
    (folder / "c.csv").write_text("")
    loaded = load_table(read_landing(spark, str(folder)), SCHEMA, store, "t")
    assert rows(loaded.table) == [("1", "Ann", None, None)]
    found = sorted((reason, name.rsplit("/", 1)[1]) for name, reason in rows(loaded.rejects))
    assert found == [("file without a header", "b.csv.gz")]
    (folder / "a.csv").unlink()
    with pytest.raises(ValueError, match="no header line"):
        read_landing(spark, str(folder))


def test_an_extract_may_come_without_line_breaks_in_fields_and_compressed(spark, store, tmp_path):
    with gzip.open(tmp_path / "t.csv.gz", "wt") as f:
        f.write("Id,Name\n1,Ann\n2\n")
    loaded = load_table(read_landing(spark, str(tmp_path / "t.csv.gz"), multi_line=False), SCHEMA, store, "t")
    assert (rows(loaded.table), loaded.rejected) == ([("1", "Ann", None, None)], 1)


def test_missing_extract_is_skipped_and_missing_folder_is_an_error(spark, store, tmp_path):
    extracts = {"a.csv": ("a", SCHEMA), "b.csv": ("b", SCHEMA), "c.csv": ("c", SCHEMA)}
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "a.csv").write_text("Id\n1\n")
    with gzip.open(tmp_path / "landing" / "c.csv.gz", "wt") as f:
        f.write("Id\n1\n2\n")
    loads = load_extracts(spark, str(tmp_path / "landing"), extracts, store)
    assert {name: load.rows for name, load in loads.items()} == {"a": 1, "c": 2}
    with pytest.raises(MissingLanding):
        load_extracts(spark, str(tmp_path / "nowhere"), extracts, store)


def test_written_landing_files_read_back_as_they_were(spark, store, tmp_path):
    data = [("01", 'say "hi", now\nplease', Decimal("1.25"), 3), ("02", None, None, None), ("03", "back\\slash", Decimal("0.00"), -1)]
    df = spark.createDataFrame(data, SCHEMA).repartition(2)
    write_landing(df, str(tmp_path / "out"))
    files = list((tmp_path / "out").glob("*.csv.gz"))
    assert files
    loaded = load_table(read_landing(spark, str(tmp_path / "out")), SCHEMA, store, "t")
    assert sorted(rows(loaded.table)) == sorted(data)


def test_match_columns_uses_the_table_spelling(spark):
    df = spark.createDataFrame([("x", 1)], "name string, other int")
    assert df.select(*match_columns(df, SCHEMA)).columns == SCHEMA.fieldNames()
