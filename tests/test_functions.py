import hashlib
import random
import re
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from starmart.functions import (
    guarded_ratio,
    in_list,
    label_by_member,
    label_by_range,
    label_by_threshold,
    map_values,
    null_tokens,
    round_stable,
    safe_corr,
    surrogate_key,
    title_case,
    try_float,
    try_number,
    weighted_avg,
)
from starmart.functions.text import TITLE_DELIMITERS
from starmart.plans.lookups import CENSUS_REGIONS, COMMON_CODES, CONDITIONS, OTHER, RURAL, SERVICE_LINES, URBANICITY


def texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")


def applied(df, column):
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_null_tokens_are_whole_cells_and_case_sensitive(spark):
    df = texts(spark, ["", "NA", "Not Available", "N/A", "na", " NA", "NAP", None, "7"])
    assert applied(df, null_tokens(F.col("x"))) == [None, None, None, "N/A", "na", " NA", "NAP", None, "7"]


def test_title_case_starts_words_after_punctuation_but_not_after_apostrophes(spark):
    cases = {
        "ST. MARY'S HOSPITAL-WEST/EAST (MAIN)": "St. Mary's Hospital-West/East (Main)",
        "A&B": "A&B",
        "north\tshore\nCLINIC": "North\tShore\nClinic",
        "  two  blanks ": "  Two  Blanks ",
        "ÉCOLE d'été": "École D'été",
        "1ST_care:unit+x": "1st_Care:Unit+X",
        "": "",
        None: None,
    }
    assert applied(texts(spark, list(cases)), title_case(F.col("x"))) == list(cases.values())


def test_title_case_on_many_made_up_names(spark):
    rng = random.Random(5)
    alphabet = "abcXYZ019éÖ'’ \t\n" + TITLE_DELIMITERS
    names = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(30))) for _ in range(3000)]

    def expected(name):
        out, start = [], True
        for c in name.lower():
            out.append(c.upper() if start else c)
            start = c.isspace() or c in TITLE_DELIMITERS
        return "".join(out)

    assert applied(texts(spark, names), title_case(F.col("x"))) == [expected(n) for n in names]


def test_try_number_on_many_made_up_cells(spark):
    rng = random.Random(6)
    cells = ["".join(rng.choice("0123456789.+-e ,N/Ax") for _ in range(rng.randrange(1, 7))) for _ in range(4000)]
    cells += [str(rng.randrange(-(10**6), 10**6) / 100) for _ in range(500)]

    def expected(cell):
        if not re.fullmatch(r"\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*", cell):
            return None
        number = Decimal(cell.strip())
        if number.adjusted() > 30:
            return None
        whole = int(number.quantize(Decimal(1), ROUND_HALF_UP))
        return whole if abs(whole) < 2**63 else None

    assert applied(texts(spark, cells), try_number(F.col("x"))) == [expected(c) for c in cells]


def test_try_number_rounds_trims_and_gives_null_for_odd_forms(spark):
    cases = {
        "12": 12, " 12 ": 12, "12.5": 13, "-12.5": -13, "1e3": 1000, "+7": 7, ".6": 1, "5.": 5,
        "N/A": None, "1,234": None, "": None, "NaN": None, "Infinity": None, "1.0d": None, "0x10": None,
        "1e40": None, "99999999999999999999": None, None: None,
    }
    assert applied(texts(spark, list(cases)), try_number(F.col("x"))) == list(cases.values())


def test_try_number_with_scale_keeps_decimals(spark):
    got = applied(texts(spark, ["12.345", "12", "x"]), try_number(F.col("x"), 2))
    assert got == [Decimal("12.35"), Decimal("12.00"), None]


def test_try_float(spark):
    cases = {"1.0123": 1.0123, " 2 ": 2.0, "1e-2": 0.01, "N/A": None, "1.0d": None, "NaN": None, "-Infinity": None}
    assert applied(texts(spark, list(cases)), try_float(F.col("x"))) == list(cases.values())


def test_guarded_ratio_is_null_on_zero_and_rounds_half_up(spark):
    df = spark.createDataFrame(
        [(0, Decimal("1.00"), Decimal("0.00")), (1, Decimal("2.01"), Decimal("2.00")), (2, None, Decimal("1.00"))],
        "i int, a decimal(14,2), b decimal(14,2)",
    )
    assert applied(df, guarded_ratio(F.col("a"), F.col("b"), 2)) == [None, Decimal("1.01"), None]


def test_round_stable_ignores_the_order_of_summation(spark):
    df = spark.createDataFrame([(0, 1.02085), (1, 1.0208499999999998), (2, 1.0208500000000003), (3, 2.5), (4, None)], "i int, x double")
    assert applied(df, round_stable(F.col("x"), 4)) == [1.0209, 1.0209, 1.0209, 2.5, None]
    assert applied(df, round_stable(F.col("x"), 0)) == [1.0, 1.0, 1.0, 3.0, None]


def test_map_values_keeps_unknown_codes_and_null(spark):
    df = texts(spark, ["READM-30-HF-HRRP", "readm-30-hf-hrrp", "READM-30-X", None, "READM-30-HIP-KNEE-HRRP"])
    assert applied(df, map_values(F.col("x"), CONDITIONS)) == [
        "Heart failure", "readm-30-hf-hrrp", "READM-30-X", None, "Hip/knee replacement",
    ]


def test_ranges_are_inclusive_at_both_ends_with_gaps_and_text_elsewhere(spark):
    for low, high, label in SERVICE_LINES:
        df = texts(spark, [f"{low:03d}", f"{high:03d}"])
        assert applied(df, label_by_range(try_number(F.col("x")), SERVICE_LINES, OTHER)) == [label, label]
    df = texts(spark, ["000", "015", "104", "999", "X12", None])
    assert set(applied(df, label_by_range(try_number(F.col("x")), SERVICE_LINES, OTHER))) == {OTHER}


def test_thresholds_send_null_and_text_to_the_default(spark):
    cases = {"1": "Metro", "3": "Metro", "3.1": "Micro", "6": "Micro", "6.1": RURAL, "10": RURAL, "abc": RURAL, None: RURAL}
    assert applied(texts(spark, list(cases)), label_by_threshold(try_float(F.col("x")), URBANICITY, RURAL)) == list(
        cases.values()
    )


def test_members(spark):
    cases = {"DC": "South", "NY": "Northeast", "HI": "West", "IL": "Midwest", "PR": OTHER, "ny": OTHER, None: OTHER}
    got = applied(texts(spark, list(cases)), label_by_member(F.col("x"), CENSUS_REGIONS, OTHER))
    assert got == list(cases.values())
    assert sum(map(len, CENSUS_REGIONS.values())) == 51


def test_in_list_is_never_null(spark):
    df = texts(spark, ["470", "0470", None, "775"])
    assert applied(df, in_list(F.col("x"), COMMON_CODES)) == [True, False, False, True]


def test_surrogate_key_hashes_text_with_a_stand_in_for_null(spark):
    df = spark.createDataFrame([(0, "a", 1), (1, None, 2), (2, "", 3)], "i int, x string, n int")
    null = "_dbt_utils_surrogate_key_null_"
    expected = [hashlib.md5(t.encode()).hexdigest() for t in ("a-1", f"{null}-2", "-3")]
    assert applied(df, surrogate_key(F.col("x"), F.col("n"))) == expected
    assert applied(df, surrogate_key(F.col("x")))[0] == hashlib.md5(b"a").hexdigest()


def test_weighted_avg_ignores_unknown_values_and_zero_weight(spark):
    df = spark.createDataFrame(
        [(Decimal("10.00"), 1), (Decimal("20.00"), 3), (None, 100), (Decimal("5.00"), None)], "v decimal(14,2), w bigint"
    )
    assert df.agg(weighted_avg(F.col("v"), F.col("w"))).first()[0] == 17.5
    assert df.where("w = 100").agg(weighted_avg(F.col("v"), F.col("w"))).first()[0] is None
    assert df.limit(0).agg(weighted_avg(F.col("v"), F.col("w"))).first()[0] is None


def test_safe_corr(spark):
    rows = [(1.0, 2.0), (2.0, 1.0), (3.0, 5.0), (4.0, 3.5), (None, 100.0), (100.0, None)]
    df = spark.createDataFrame(rows, "x double, y double")
    both = df.where("x is not null and y is not null")
    r = F.corr("x", "y")
    assert df.agg(safe_corr(F.col("x"), F.col("y"))).first()[0] == pytest.approx(both.agg(r).first()[0], abs=1e-12)
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert flat.agg(safe_corr(F.col("x"), F.col("y"))).first()[0] is None
    assert flat.limit(1).agg(safe_corr(F.col("x"), F.col("y"))).first()[0] is None


def test_round_stable_keeps_what_is_too_large_or_not_finite(spark):
    values = [1.0e30, -1.0e30, float("inf"), float("-inf"), 2.5, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    got = [r[0] for r in df.orderBy("i").select(round_stable(F.col("x"), 0)).collect()]
    assert got == [1.0e30, -1.0e30, float("inf"), float("-inf"), 3.0, None]
    with pytest.raises(ValueError, match="ten decimals"):
        round_stable(F.col("x"), 11)
