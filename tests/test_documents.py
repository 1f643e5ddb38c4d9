import json

import pytest
from pyspark.sql import types as T

from starmart.sources import latest_distribution, read_catalog, read_pages, require_rows, resolve_latest_csv


def catalog(tmp_path, datasets):
    path = tmp_path / "data.json"
    path.write_text(json.dumps({"conformsTo": "x", "dataset": datasets}, indent=1))
    return str(path)


def dataset(title, *links):
    return {"title": title, "other": 1, "distribution": [{"mediaType": m, "downloadURL": u} for m, u in links]}


def test_newest_year_wins_and_its_first_csv_is_taken(spark, tmp_path):
    path = catalog(
        tmp_path,
        [
            dataset("Stays by provider : 2021", ("text/csv", "http://x/21.csv")),
            dataset("Stays by provider : 2023", ("application/json", "http://x/23.json"), (None, "http://x/23.CSV"), ("text/csv", "http://x/late")),
            dataset("Stays by provider : 2023", ("text/csv", "http://x/second.csv")),
            dataset("Other things : 2024", ("text/csv", "http://x/24.csv")),
            dataset("Stays by provider 99", ("text/csv", "http://x/99.csv")),
        ],
    )
    assert resolve_latest_csv(spark, path, "by provider") == "http://x/23.CSV"
    row = latest_distribution(read_catalog(spark, path), "by provider").first()
    assert (row.title, row.year) == ("Stays by provider : 2023", 2023)


def test_year_is_the_last_four_of_all_digits(spark, tmp_path):
    path = catalog(
        tmp_path,
        [dataset("A part 2 : 2019", ("text/csv", "u1")), dataset("A : 2020 v1", ("text/csv", "u2")), dataset("A 12", ("text/csv", "u3"))],
    )
    # '22019' -> 2019, '20201' -> 0201, '12' -> 0
    assert resolve_latest_csv(spark, path, "A") == "u1"


def test_errors_without_a_match_or_a_csv(spark, tmp_path):
    path = catalog(tmp_path, [dataset("A : 2020", ("application/json", "u.json")), {"title": "B : 2020"}])
    with pytest.raises(LookupError, match="no dataset"):
        resolve_latest_csv(spark, path, "C")
    for needle in ("A", "B"):
        with pytest.raises(LookupError, match="no CSV"):
            resolve_latest_csv(spark, path, needle)


def test_pages_are_one_table(spark, tmp_path):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "name")])
    pages = [
        {"results": [{"id": "1", "name": "a"}, {"id": "2", "name": None}], "count": 3},
        {"results": [{"id": "3", "surplus": "x"}]},
        {"results": []},
    ]
    for i, page in enumerate(pages):
        (tmp_path / f"page{i}.json").write_text(json.dumps(page, indent=2))
    df = read_pages(spark, str(tmp_path), schema)
    assert sorted(tuple(r) for r in df.collect()) == [("1", "a"), ("2", None), ("3", None)]
    assert require_rows(df, "pages").columns == ["id", "name"]


def test_no_rows_is_an_error(spark, tmp_path):
    (tmp_path / "page0.json").write_text('{"results": []}')
    schema = T.StructType([T.StructField("id", T.StringType())])
    with pytest.raises(LookupError):
        require_rows(read_pages(spark, str(tmp_path), schema), "pages")
