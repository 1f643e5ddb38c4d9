"""The trial queries once more, as SQL for DuckDB on the same tables."""

from __future__ import annotations

from ..functions.text import TITLE_DELIMITERS
from ..plans.lookups import CENSUS_REGIONS, COMMON_CODES, CONDITIONS, SERVICE_LINES, URBANICITY
from .extracts import MEASURES, RUCA_CODES, STATES
from .years_oracle import YEARS

_DELIMITER_CLASS = "[\\s" + "".join("\\" + c for c in TITLE_DELIMITERS).replace("'", "''") + "]"
_OTHER_CLASS = "[^" + _DELIMITER_CLASS[1:]


def _list(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def title(text: str) -> str:
    words = f"regexp_extract_all(lower({text}), '{_OTHER_CLASS}*{_DELIMITER_CLASS}|{_OTHER_CLASS}+')"
    # No real word begins with a sharp s; where a made-up one does, its title case has two letters. DuckDB's upper() keeps it, so
    # for that letter this SQL states what is wanted and is no independent check.
    first = "case when w[1] = 'ß' then 'Ss' else upper(w[1]) end"
    return f"array_to_string(list_transform({words}, lambda w: {first} || w[2:]), '')"


def padded(key: str, width: int) -> str:
    return f"lpad(cast({key} as varchar), cast(greatest({width}, length(cast({key} as varchar))) as integer), '0')"


def number(text: str) -> str:
    return f"try_cast(try_cast(case when {_is_number(text)} then {text} end as decimal(38,0)) as bigint)"


def real(text: str) -> str:
    return f"try_cast(case when {_is_number(text)} then {text} end as double)"


def _is_number(text: str) -> str:
    return f"regexp_full_match({text}, '\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*')"


def cases(branches: list[tuple[str, str]], default: str) -> str:
    return "case " + " ".join(f"when {c} then {v}" for c, v in branches) + f" else {default} end"


def service_line(n: str) -> str:
    return cases([(f"{n} between {a} and {b}", f"'{label}'") for a, b, label in SERVICE_LINES], "'Other'")


def census_region(state: str) -> str:
    return cases([(f"{state} in {_list(codes)}", f"'{label}'") for label, codes in CENSUS_REGIONS.items()], "'Other'")


def urbanicity(ruca: str) -> str:
    return cases([(f"{real(ruca)} <= {limit}", f"'{label}'") for limit, label in URBANICITY], "'Rural'")


def condition(measure: str) -> str:
    return cases([(f"{measure} = '{m}'", f"'{label}'") for m, label in CONDITIONS.items()], measure)


def cents(total: str) -> str:
    value = f"round(cast(({total}) * 100::decimal(3,0) as double) / quantity, 0)"
    return f"cast(cast({value} as decimal(16,0)) * 0.01::decimal(3,2) as decimal(14,2))"


def four_digits(top: str, bottom: str) -> str:
    value = f"round(10000.0::double * cast({top} as double) / cast({bottom} as double), 0)"
    return f"cast(cast(cast({value} as decimal(18,0)) * 0.0001::decimal(5,4) as decimal(18,4)) as varchar)"


def rounded(value: str, digits: int) -> str:
    return f"cast(round(cast({value} as decimal(38,10)), {digits}) as double)"


def exact_ratio(top: str, bottom: str, digits: int) -> str:
    """Two positive money amounts divided and rounded half up in whole numbers."""
    a, b, scale = f"cast({top} * 100 as hugeint)", f"cast({bottom} * 100 as hugeint)", 10**digits
    halves = f"((2 * {scale} * {a} + {b}) // (2 * nullif({b}, 0)))"
    return f"cast({halves} as double) / {scale}"


_COVERED = "cast((p_size % 5 + 15) * 0.01::decimal(3,2) as decimal(3,2))"
_CODE = padded("(p_size - 1) * 18 + 2", 3)
_STATE = f"([{', '.join(repr(s) for s in STATES)}])[s_nationkey + 1]"

HOSPITALS = f"""
hospitals as (
  select s_suppkey, 'ST. MARY''S ' || upper(s_name) || '-WEST/EAST (MAIN)' as org,
         'PORT ' || upper(n_name) as city, n_name, s_nationkey, {_STATE} as state
  from supplier join nation on s_nationkey = n_nationkey
)"""

RAW_CHARGES = f"""{HOSPITALS},
charge_groups as (
  select l_suppkey, p_size,
         cast(sum(cast(l_quantity as bigint)) as bigint) as quantity,
         sum(cast(l_extendedprice as decimal(14,2))) as charge,
         cast(sum(cast(l_extendedprice as decimal(14,2)) * (1.00::decimal(3,2) - cast(l_discount as decimal(4,2))))
              as decimal(20,4)) as payment,
         cast(sum(cast(l_extendedprice as decimal(14,2)) * (1.00::decimal(3,2) - cast(l_discount as decimal(4,2)))
                  * (1.00::decimal(3,2) + cast(l_tax as decimal(4,2)))) as decimal(24,6)) as total
  from lineitem join part on l_partkey = p_partkey
  group by l_suppkey, p_size
),
raw_charges as (
  select {padded("l_suppkey", 6)} as ccn, org, city, n_name,
         {padded("l_suppkey * 37 % 100000", 5)} as zip,
         case when l_suppkey % 2 = 0 then lower(state) else state end as state,
         ([{", ".join(repr(r) for r in RUCA_CODES)}])[(l_suppkey + p_size % 2) % {len(RUCA_CODES)} + 1] as ruca,
         {_CODE} as drg_code, 'PROCEDURE GROUP ' || {_CODE} as drg_desc, quantity as n,
         {cents("charge")} as charge,
         case when (l_suppkey + p_size) % 89 = 7 then 0 else {cents(f"total * {_COVERED}")} end as total,
         case when (l_suppkey + p_size) % 97 = 5 then 0 else {cents(f"payment * {_COVERED}")} end as payment
  from charge_groups join hospitals on l_suppkey = s_suppkey
)"""

STG_CHARGES = f"""{RAW_CHARGES},
stg_charges as (
  select ccn, {title("org")} as provider_name, {title("city")} as provider_city, upper(state) as provider_state,
         zip as provider_zip, ruca as ruca_code, drg_code, drg_desc, n as total_discharges,
         charge as avg_covered_charge, total as avg_total_payment, payment as avg_medicare_payment,
         {exact_ratio("charge", "payment", 2)} as markup_ratio,
         {exact_ratio("payment", "total", 3)} as medicare_share
  from raw_charges where payment > 0
)"""


def _cell(text: str) -> str:
    return cases([("spot in (0)", "'N/A'"), ("spot in (1, 2)", "null")], text)


RAW_READMISSIONS = f"""
returns as (
  select l_suppkey, o_orderpriority, count(*) as n, count(*) filter (where l_returnflag = 'R') as returned
  from lineitem join orders on l_orderkey = o_orderkey
  group by l_suppkey, o_orderpriority
),
returns_all as (
  select o_orderpriority, sum(n) as all_n, sum(returned) as all_returned from returns group by o_orderpriority
),
returns_spot as (
  select *, (l_suppkey * 7 + cast(substr(o_orderpriority, 1, 1) as integer)) % 11 as spot
  from returns join returns_all using (o_orderpriority) join hospitals on l_suppkey = s_suppkey
),
raw_readmissions as (
  select org as facility_name,
         case when l_suppkey % 13 = 5 then 'H' else '' end || {padded("l_suppkey", 6)} as facility_id,
         case when l_suppkey % 17 = 3 then 'WY' else state end as state,
         {cases([(f"o_orderpriority = '{p}'", f"'{m}'") for p, m in MEASURES.items()], "o_orderpriority")} as measure,
         {_cell("cast(n as varchar)")} as discharges,
         {_cell(four_digits("returned::double * all_n::double", "n::double * all_returned::double"))} as ratio,
         {_cell(four_digits("returned * 100", "n"))} as predicted,
         {_cell(four_digits("all_returned * 100", "all_n"))} as expected,
         {_cell("cast(returned as varchar)")} as readmissions
  from returns_spot
)"""

STG_READMISSIONS = f"""{RAW_READMISSIONS},
stg_readmissions as (
  select facility_id as ccn, {title("facility_name")} as facility_name, upper(state) as state, measure as measure_raw,
         {condition("measure")} as condition, {number("discharges")} as discharges,
         {real("ratio")} as excess_readmission_ratio, {real("predicted")} as predicted_rate,
         {real("expected")} as expected_rate, {number("readmissions")} as readmissions
  from raw_readmissions where facility_id is not null
)"""

DIM_PROVIDER = f"""
dim_provider as (
  select md5(ccn) as provider_sk, ccn, provider_name, provider_city, provider_state, provider_zip,
         {urbanicity("ruca_code")} as urbanicity
  from (select ccn, max(provider_name) as provider_name, max(provider_city) as provider_city,
               max(provider_state) as provider_state, max(provider_zip) as provider_zip, max(ruca_code) as ruca_code
        from stg_charges group by ccn)
)"""

DIM_DRG = f"""
dim_drg as (
  select md5(drg_code) as drg_sk, drg_code, drg_desc, {service_line(number("drg_code"))} as service_line,
         drg_code in {_list(COMMON_CODES)} as is_common_drg
  from (select distinct drg_code, drg_desc from stg_charges)
)"""

DIM_GEOGRAPHY = f"""
dim_geography as (
  select md5(state_code) as geo_sk, state_code, {census_region("state_code")} as census_region
  from (select distinct provider_state as state_code from stg_charges where provider_state is not null)
)"""

FACT_CHARGES = """
fact_charges as (
  select c.ccn, c.drg_code, p.provider_sk, d.drg_sk, g.geo_sk, total_discharges, avg_covered_charge,
         avg_total_payment, avg_medicare_payment, markup_ratio, medicare_share,
         cast(avg_covered_charge as decimal(14,2)) * cast(total_discharges as decimal(18,0)) as wtd_covered_charge,
         cast(avg_medicare_payment as decimal(14,2)) * cast(total_discharges as decimal(18,0)) as wtd_medicare_payment
  from stg_charges c
  left join dim_provider p on c.ccn = p.ccn
  left join dim_drg d on c.drg_code = d.drg_code
  left join dim_geography g on c.provider_state = g.state_code
)"""

FACT_READMISSIONS = """
fact_readmissions as (
  select r.ccn, condition, measure_raw, p.provider_sk, g.geo_sk, discharges, readmissions, excess_readmission_ratio,
         predicted_rate, expected_rate
  from stg_readmissions r
  left join dim_provider p on r.ccn = p.ccn
  left join dim_geography g on r.state = g.state_code
  where excess_readmission_ratio is not null
)"""

CHARGES_SIDE = f"with {STG_CHARGES}, {DIM_PROVIDER}, {DIM_DRG}, {DIM_GEOGRAPHY}, {FACT_CHARGES}"
STAR = f"with {STG_CHARGES}, {STG_READMISSIONS}, {DIM_PROVIDER}, {DIM_DRG}, {DIM_GEOGRAPHY}, {FACT_CHARGES}, {FACT_READMISSIONS}"

COST_QUALITY = f"""{STAR},
cost_quality as (
  select provider_sk, mean_medicare_pay, mean_excess_readmit from (
    select provider_sk, cast(sum(wtd_medicare_payment) as double) / nullif(sum(total_discharges), 0)::double
           as mean_medicare_pay
    from fact_charges group by provider_sk)
  join (select provider_sk, avg(excess_readmission_ratio) as mean_excess_readmit
        from fact_readmissions group by provider_sk) using (provider_sk)
  where mean_excess_readmit is not null
),
quintiles as (
  select pay_quintile, count(*) as n_hospitals, {rounded("avg(mean_medicare_pay)", 0)} as avg_medicare_pay,
         {rounded("avg(mean_excess_readmit)", 4)} as avg_excess_readmit_ratio
  from (select *, ntile(5) over (order by mean_medicare_pay nulls last, provider_sk) as pay_quintile
        from cost_quality)
  group by pay_quintile
),
correlation as (
  select count(*) as n_hospitals, {rounded("corr(mean_medicare_pay, mean_excess_readmit)", 3)} as r from cost_quality
)"""


def _of_sums(top: str, bottom: str, digits: int) -> str:
    return rounded(f"cast(sum({top}) as double) / cast(sum({bottom}) as double)", digits)


_WEIGHTED = f"""
  cast(sum(total_discharges) as bigint) as discharges,
  {_of_sums("wtd_covered_charge", "total_discharges", 0)} as wavg_charge,
  {_of_sums("wtd_medicare_payment", "total_discharges", 0)} as wavg_medicare_pay,
  {_of_sums("wtd_covered_charge", "wtd_medicare_payment", 2)} as markup_ratio"""

MARKUP = f"""markup as (
  select service_line, {_WEIGHTED}
  from fact_charges f join dim_drg d on f.drg_sk = d.drg_sk
  group by service_line having sum(total_discharges) > 1000
)"""


def money(*columns: str) -> str:
    return ", ".join(f"cast({c} as double) as {c}" for c in columns)


def _failures(lines: list[tuple[str, str, str]], check: str = "") -> str:
    """Rows of (model, column, SQL that counts the failures)."""
    name = f"'{check}' as check_name, " if check else ""
    return " union all ".join(
        f"select {name}'{model}' as model, '{column}' as column_name, cast(({count}) as bigint) as failures"
        for model, column, count in lines
    )


def _where(table: str, condition: str) -> str:
    return f"select count(*) from {table} where {condition}"


def _repeated(table: str, columns: str, known: str = "true") -> str:
    return f"select count(*) from (select 1 from {table} where {known} group by {columns} having count(*) > 1)"


def _orphans(child: str, column: str, parent: str, field: str, nulls: bool = False) -> str:
    or_null = f" or {column} is null" if nulls else ""
    known = f"{column} is not null and {column} not in (select {field} from {parent} where {field} is not null)"
    return _where(child, f"({known}){or_null}")


_UNIQUE = [
    ("dim_provider", "provider_sk", _repeated("dim_provider", "provider_sk", "provider_sk is not null")),
    ("dim_provider", "ccn", _repeated("dim_provider", "ccn", "ccn is not null")),
    ("dim_drg", "drg_sk", _repeated("dim_drg", "drg_sk", "drg_sk is not null")),
    ("dim_drg", "drg_code", _repeated("dim_drg", "drg_code", "drg_code is not null")),
    ("dim_geography", "geo_sk", _repeated("dim_geography", "geo_sk", "geo_sk is not null")),
]
_NOT_NULL = [
    ("dim_provider", "provider_sk", _where("dim_provider", "provider_sk is null")),
    ("dim_provider", "ccn", _where("dim_provider", "ccn is null")),
    ("dim_drg", "drg_sk", _where("dim_drg", "drg_sk is null")),
    ("dim_drg", "drg_code", _where("dim_drg", "drg_code is null")),
    ("dim_drg", "service_line", _where("dim_drg", "service_line is null")),
    ("dim_geography", "geo_sk", _where("dim_geography", "geo_sk is null")),
    ("fact_inpatient_charges", "provider_sk", _where("fact_charges", "provider_sk is null")),
]
_REGIONS = _list([*CENSUS_REGIONS, "Other"])
_ACCEPTED = [
    ("dim_geography", "census_region", _where("dim_geography", f"census_region not in {_REGIONS}")),
    ("fact_readmissions", "condition", _where("fact_readmissions", f"condition not in {_list(list(CONDITIONS.values()))}")),
]
_RANGE = [
    ("fact_inpatient_charges", "avg_medicare_payment", _where("fact_charges", "avg_medicare_payment < 0")),
    ("fact_readmissions", "excess_readmission_ratio", _where("fact_readmissions", "excess_readmission_ratio < 0")),
]
_RELATIONS = [
    ("fact_inpatient_charges", "provider_sk", _orphans("fact_charges", "provider_sk", "dim_provider", "provider_sk")),
    ("fact_inpatient_charges", "drg_sk", _orphans("fact_charges", "drg_sk", "dim_drg", "drg_sk")),
    ("fact_readmissions", "provider_sk", _orphans("fact_readmissions", "provider_sk", "dim_provider", "provider_sk")),
]
_ALL_CHECKS = " union all ".join(
    _failures(lines, check)
    for check, lines in (
        ("unique", _UNIQUE),
        ("not_null", _NOT_NULL),
        ("accepted_values", _ACCEPTED),
        ("accepted_range", _RANGE),
        ("relationships", _RELATIONS),
    )
)



def _repeat(table: str, again: str, missing: str, columns: str) -> str:
    nulls = ", ".join(f"null as {c}" for c in columns.split())
    return f"""{table} as (select * from {table} union all select * from {table} where {again}
      union all select * replace ({nulls}) from {table} where {missing})"""


# The star spoilt by the rules of the query, under the names of its tables.
_DIRTY = f"""
{_repeat("dim_provider", "right(ccn, 1) = '7'", "right(ccn, 1) = '8'", "provider_sk ccn")},
{_repeat("dim_drg", "right(drg_code, 1) = '0'", "right(drg_code, 1) = '6'", "drg_sk drg_code service_line")},
repeated_geography as ({_repeat("dim_geography", "state_code > 'M'", "state_code < 'M'", "geo_sk").split(" as (", 1)[1]},
dim_geography as (
  select * replace (case when geo_sk is null then 'Nowhere' else census_region end as census_region) from repeated_geography),
fact_charges as (
  select * replace (
    case right(ccn, 1) when '1' then null when '2' then 'unknown' else provider_sk end as provider_sk,
    case when right(drg_code, 1) = '2' then -avg_medicare_payment else avg_medicare_payment end as avg_medicare_payment,
    case when right(drg_code, 1) = '4' then 'unknown' else drg_sk end as drg_sk) from fact_charges),
fact_readmissions as (
  select * replace (
    case when right(ccn, 1) = '1' then 'Unknown' else condition end as condition,
    case when right(ccn, 1) = '2' then -1 else excess_readmission_ratio end as excess_readmission_ratio,
    case when right(ccn, 1) = '3' then 'nobody' else provider_sk end as provider_sk) from fact_readmissions)"""

_ODD_NUMBERS = """case o_orderkey % 10 when 0 then 'N/A' when 1 then '' when 2 then '12.5' when 3 then ' 12 '
  when 4 then '1e3' when 5 then '1,234' when 6 then 'NaN' when 7 then '1.0d' when 8 then '-7.49'
  else cast(cast(o_totalprice as decimal(14,2)) as varchar) end"""

_TOKENS = """case o_orderkey % 6 when 0 then '' when 1 then 'NA' when 2 then 'Not Available' when 3 then 'N/A'
  when 4 then 'na' else o_orderpriority end"""

def _rounded_quantiles(value: str) -> str:
    v = f"cast({value} as double)"
    return ", ".join(f"{rounded(f'quantile_cont({v}, {p})', 4)} as {n}" for n, p in (("p10", 0.1), ("p50", 0.5), ("p90", 0.9)))


LINE_PERCENTILES = f"""
    select l_returnflag, count(*) as n, {_rounded_quantiles("l_extendedprice")}
    from lineitem group by l_returnflag"""

LINE_QUINTILES = """
    select pay_quintile, count(*) as n, min(l_extendedprice) as min_key, max(l_extendedprice) as max_key
    from (select l_extendedprice, ntile(5) over (order by l_extendedprice) as pay_quintile from lineitem)
    group by pay_quintile"""


def oracle_sql() -> dict[str, str]:
    landed = f"""
            with {HOSPITALS}, {RAW_READMISSIONS}
            select facility_name, facility_id, state, measure as measure_name, discharges as number_of_discharges,
                   cast(null as varchar) as footnote, ratio as excess_readmission_ratio, predicted as predicted_readmission_rate,
                   expected as expected_readmission_rate, readmissions as number_of_readmissions,
                   '07/01/2021' as start_date, '06/30/2024' as end_date
            from raw_readmissions"""
    return {
        "null_tokens": f"""
            select id, raw, case when raw in ('', 'NA', 'Not Available') then null else raw end as cleaned
            from (select o_orderkey as id, {_TOKENS} as raw from orders)""",
        "load_audit": f"""
            with {RAW_CHARGES}, {RAW_READMISSIONS}
            select (select count(*) from raw_charges) as n_charges,
                   (select count(*) from raw_readmissions) as n_readmissions""",
        "csv_load": landed,
        "csv_rejects": f"""
            select case when l_suppkey % 3 = 0 then 'Tot_Dschrgs is not a number' else 'DRG_Cd is missing' end
                     as reject_reason, {padded("l_suppkey", 6)} as told, count(*) as n_rows
            from (select distinct l_suppkey, p_size from lineitem join part on l_partkey = p_partkey)
            where l_suppkey % 3 < 2 and p_size % 5 = 0 group by 1, 2
            union all
            select 'wrong number of fields', {padded("s_suppkey", 6)} || line, 1
            from supplier, (values (',short'), (repeat(',long', 15))) as lines(line)""",
        "paged_json": landed,
        "latest_distribution": """
            select 'Orders by priority and day : ' || yr as title, cast(yr as bigint) as year,
                   'https://example.org/orders-' || yr || '.CSV' as url
            from (select max(year(o_orderdate)) as yr from orders)
            union all
            select 'Orders by clerk : ' || yr, cast(yr as bigint), null from (select max(year(o_orderdate)) as yr from orders)""",
        "stg_charges": f"""
            with {STG_CHARGES}
            select ccn, provider_name, provider_city, provider_state, provider_zip, ruca_code, drg_code, drg_desc,
                   total_discharges,
                   {money("avg_covered_charge", "avg_total_payment", "avg_medicare_payment")},
                   markup_ratio, medicare_share
            from stg_charges""",
        "stg_readmissions": f"with {HOSPITALS}, {STG_READMISSIONS} select * from stg_readmissions",
        "initcap_names": f"""
            select p_partkey, raw_name, {title("raw_name")} as clean_name
            from (select p_partkey, upper(p_name) || '-' || p_type || '/O''' || p_brand || ' (' || p_name || ')&co.'
                         as raw_name from part)""",
        "initcap_texts": f"select doc_id, {title('text')} as titled from documents",
        "try_cast_clean": f"""
            select id, raw, {number("raw")} as whole, {real("raw")} as real
            from (select o_orderkey as id, {_ODD_NUMBERS} as raw from orders)""",
        "condition_label": f"""
            select o_orderkey, measure, {condition("measure")} as condition
            from (select o_orderkey, {cases([(f"o_orderpriority = '{p}'", f"'{m}'")
                  for p, m in list(MEASURES.items())[:4]], "lower(o_orderpriority)")} as measure from orders)""",
        "service_line": f"""
            select code, {service_line(number("code"))} as service_line, count(*) as n_parts
            from (select case when p_partkey % 50 = 0 then 'X' || p_size
                              else {padded("p_partkey % 1000", 3)} end as code from part)
            group by all""",
        "census_region": f"""
            select s_suppkey, state_code, {census_region("state_code")} as census_region
            from (select s_suppkey, case when s_suppkey % 9 = 4 then null else {_STATE} end as state_code
                  from supplier)""",
        "urbanicity": f"""
            select c_custkey, ruca_code, {urbanicity("ruca_code")} as urbanicity
            from (select c_custkey, ([{", ".join(repr(r) for r in RUCA_CODES)}, null])[c_custkey % {len(RUCA_CODES) + 1} + 1]
                         as ruca_code from customer)""",
        "common_flag": f"""
            select p_partkey, drg_code, coalesce(drg_code in {_list(COMMON_CODES)}, false) as is_common_drg
            from (select p_partkey, case when p_partkey % 11 = 0 then null else {padded("p_partkey % 1000", 3)} end
                         as drg_code from part)""",
        "surrogate_keys": """
            select c_custkey, md5(cast(c_custkey as varchar)) as customer_sk,
                   md5(coalesce(segment, '_dbt_utils_surrogate_key_null_') || '-' || cast(c_nationkey as varchar))
                     as segment_sk
            from (select *, case when c_custkey % 7 = 3 then null else c_mktsegment end as segment from customer)""",
        "dim_provider": f"with {STG_CHARGES}, {DIM_PROVIDER} select * from dim_provider",
        "dim_drg": f"with {STG_CHARGES}, {DIM_DRG} select * from dim_drg",
        "dim_geography": f"with {STG_CHARGES}, {DIM_GEOGRAPHY} select * from dim_geography",
        "fact_charges": f"""
            {CHARGES_SIDE}
            select ccn, drg_code, provider_sk, drg_sk, geo_sk, total_discharges,
                   {money("avg_covered_charge", "avg_total_payment", "avg_medicare_payment")},
                   markup_ratio, medicare_share, {money("wtd_covered_charge", "wtd_medicare_payment")}
            from fact_charges""",
        "fact_readmissions": f"{STAR} select * from fact_readmissions",
        "q1_price_variation": f"""
            {CHARGES_SIDE}
            select count(*) as n_hospitals, min(c) as min_charge,
                   {rounded("quantile_cont(c, 0.1)", 4)} as p10_charge,
                   {rounded("quantile_cont(c, 0.5)", 4)} as median_charge,
                   {rounded("quantile_cont(c, 0.9)", 4)} as p90_charge, max(c) as max_charge,
                   {rounded("max(c) / nullif(min(c), 0)", 1)} as fold_difference,
                   {rounded("quantile_cont(m, 0.9) / nullif(quantile_cont(m, 0.1), 0)", 1)} as medicare_pay_p90_p10_ratio
            from (select cast(avg_covered_charge as double) as c, cast(avg_medicare_payment as double) as m
                  from fact_charges f join dim_drg d on f.drg_sk = d.drg_sk
                  join dim_provider p on f.provider_sk = p.provider_sk where d.drg_code = '470')""",
        "percentiles_by_group": f"""
            with {STG_CHARGES}
            select drg_code, count(*) as n, {_rounded_quantiles("avg_covered_charge")}
            from stg_charges group by drg_code""",
        "percentiles_scaled": LINE_PERCENTILES,
        "percentiles_sketched": LINE_PERCENTILES,
        "q2_markup": f"{CHARGES_SIDE}, {MARKUP} select * from markup",
        "markup_by_state": f"""
            {CHARGES_SIDE}
            select state_code, census_region, {_WEIGHTED}
            from fact_charges f join dim_geography g on f.geo_sk = g.geo_sk group by state_code, census_region""",
        "weighted_avg": f"""
            with {STG_CHARGES}
            select provider_state,
                   {_of_sums("cast(avg_covered_charge as decimal(14,2)) * cast(total_discharges as decimal(18,0))",
                             "total_discharges", 2)} as weighted,
                   {rounded("cast(sum(avg_covered_charge) as double) / count(*)", 2)} as naive
            from stg_charges group by provider_state""",
        "q3_cost_vs_quality": f"{COST_QUALITY} select * from quintiles",
        "cost_quality_corr": f"{COST_QUALITY} select * from correlation",
        "headline_metrics": f"""
            {COST_QUALITY}, {MARKUP}
            select (select {rounded("power(corr(mean_medicare_pay, mean_excess_readmit), 2)", 4)} from cost_quality) as r_squared,
                   (select {rounded("max(avg_medicare_pay) filter (where pay_quintile = 5)"
                                    " / max(avg_medicare_pay) filter (where pay_quintile = 1)", 1)} from quintiles)
                     as pay_ratio_q5_q1,
                   (select min(markup_ratio) from markup) as markup_min,
                   (select max(markup_ratio) from markup) as markup_max""",
        "leaders_per_group": f"""
            with {STG_CHARGES}
            select drg_code, ccn, cast(avg_covered_charge as double) as avg_covered_charge
            from stg_charges
            qualify row_number() over (partition by drg_code order by avg_covered_charge desc, ccn) = 1""",
        "ntile_scaled": LINE_QUINTILES,
        "ntile_sketched": LINE_QUINTILES,
        "ntile_100": LINE_QUINTILES.replace("ntile(5)", "ntile(100)"),
        "check_unique": f"""
            {STAR} {_failures([*_UNIQUE,
                ("fact_inpatient_charges", "drg_sk", _repeated("fact_charges", "drg_sk", "drg_sk is not null")),
                ("fact_inpatient_charges", "ccn", _repeated("fact_charges", "ccn", "ccn is not null"))])}""",
        "check_not_null": f"""
            {STAR} {_failures([*_NOT_NULL,
                ("fact_readmissions", "provider_sk", _where("fact_readmissions", "provider_sk is null")),
                ("fact_readmissions", "geo_sk", _where("fact_readmissions", "geo_sk is null")),
                ("stg_readmissions", "discharges", _where("stg_readmissions", "discharges is null"))])}""",
        "check_accepted_values": f"""
            {STAR} {_failures([*_ACCEPTED,
                ("dim_provider", "urbanicity", _where("dim_provider", "urbanicity not in ('Metro', 'Micro')"))])}""",
        "check_accepted_range": f"""
            {STAR} {_failures([*_RANGE,
                ("stg_readmissions", "excess_readmission_ratio",
                 _where("stg_readmissions", "excess_readmission_ratio <= 0.9 or excess_readmission_ratio >= 1.1"))])}""",
        "check_relationships": f"""
            {STAR} {_failures([*_RELATIONS,
                ("stg_readmissions", "ccn", _orphans("stg_readmissions", "ccn", "dim_provider", "ccn")),
                ("fact_readmissions strict", "provider_sk",
                 _orphans("fact_readmissions", "provider_sk", "dim_provider", "provider_sk", nulls=True))])}""",
        "check_grain": f"""
            {STAR} {_failures([
                ("fact_inpatient_charges", "ccn, drg_code", _repeated("fact_charges", "ccn, drg_code")),
                ("fact_readmissions", "ccn, measure_raw", _repeated("fact_readmissions", "ccn, measure_raw")),
                ("lineitem", "l_orderkey, l_linenumber", _repeated("lineitem", "l_orderkey, l_linenumber"))])}""",
        "unmatched_providers": f"""
            {STAR} select ccn, count(*) as n_rows from fact_readmissions where provider_sk is null group by ccn""",
        "check_freshness": """
            select 'events' as model, 'ts' as column_name,
                   cast(epoch_us(timestamp '2024-02-01 00:00:00') - epoch_us(max(ts)) as double) / 1000000
                     as age_seconds,
                   case when timestamp '2024-02-01 00:00:00' - max(ts) > interval 30 days then 'ERROR'
                        when timestamp '2024-02-01 00:00:00' - max(ts) > interval 1 day then 'WARN'
                        else 'PASS' end as status
            from events""",
        "dq_report": f"""
            {STAR}, checks as ({_ALL_CHECKS})
            select *, case when failures = 0 then 'PASS' else 'ERROR' end as status from checks""",
        "dq_report_dirty": f"""
            {STAR} select * from (
              with {_DIRTY}, checks as ({_ALL_CHECKS})
              select *, case when failures = 0 then 'PASS' when check_name = 'relationships' then 'WARN' else 'ERROR' end
                as status from checks)""",
        "markup_lattice": f"""
            {STAR}, placed as (
              select census_region, state_code, service_line, total_discharges, wtd_covered_charge, wtd_medicare_payment
              from fact_charges f join dim_drg d on f.drg_sk = d.drg_sk join dim_geography g on f.geo_sk = g.geo_sk
            )
            select case when level = '' then 'all' else level end as level, * exclude (level) from (
              select array_to_string(list_filter([
                       case when grouping(census_region) = 0 then 'census_region' end,
                       case when grouping(state_code) = 0 then 'state_code' end,
                       case when grouping(service_line) = 0 then 'service_line' end], lambda c: c is not null), ' x ') as level,
                     census_region, state_code, service_line, {_WEIGHTED}
              from placed
              group by grouping sets ((census_region, state_code, service_line), (census_region, state_code),
                (census_region, service_line), (census_region), (service_line), ()))""",
        **YEARS,
    }
