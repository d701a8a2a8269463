"""The same results as the named queries, as plain SQL over the source tables."""

from __future__ import annotations

_STG = """
select cast(o_orderkey as int) as orderid, cast(floor(o_totalprice) as int) as amount,
  cast(date_diff('day', date '1995-01-01', cast(o_orderdate as date)) + 1 as int) as dateid,
  cast(n_nationkey as int) as countryid, cast(substr(o_orderpriority, 1, 1) as int) as categoryid,
  cast(o_orderdate as date) as date, cast(year(o_orderdate) as int) as year,
  cast(quarter(o_orderdate) as int) as quarter,
  case o_orderkey % 7 when 0 then null when 1 then ''
    when 2 then cast(quarter(o_orderdate) as varchar)
    else 'Q' || cast(quarter(o_orderdate) as varchar) end as quartername,
  cast(month(o_orderdate) as int) as month, monthname(o_orderdate) as monthname,
  cast(day(o_orderdate) as int) as day, cast((dayofweek(o_orderdate) + 1) as int) as weekday,
  case o_orderkey % 5 when 0 then null when 1 then ''
    when 2 then cast((dayofweek(o_orderdate) + 1) as varchar)
    else dayname(o_orderdate) end as weekdayname,
  substr(o_orderpriority, 3) as category,
  case o_orderkey % 3 when 0 then '12' || r_name || '_' || chr(65 + n_nationkey) || '7'
    when 1 then r_name || '3_' || chr(65 + n_nationkey)
    else r_name || '_' || chr(65 + n_nationkey) end as country
from orders join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
"""

_CLEAN = """
select orderid, amount, dateid, countryid, categoryid, date, year, quarter,
  case when q in ('1', '2', '3', '4') then 'Q' || q else q end as quartername,
  month, monthname, day, weekday,
  case w when '1' then 'Sunday' when '2' then 'Monday' when '3' then 'Tuesday'
    when '4' then 'Wednesday' when '5' then 'Thursday' when '6' then 'Friday'
    when '7' then 'Saturday' else w end as weekdayname,
  category, regexp_replace(country, '[0-9]', '', 'g') as country
from (select *, coalesce(nullif(quartername, ''), cast(quarter as varchar)) as q,
        coalesce(nullif(weekdayname, ''), cast(weekday as varchar)) as w from {source}) filled
"""

_DATE = (
    "dateid, date, year, quarter, quartername, month, monthname, day, weekday, weekdayname"
)
_CATEGORY = "categoryid, category"
_COUNTRY = "countryid, country"
_FACT = "orderid, dateid, countryid, categoryid, amount"


def _with(select: str, **extra: str) -> str:
    steps = {
        "stg": _STG,
        "pending": "select * from stg where orderid > 0",
        "cleaned": _CLEAN.format(source="pending"),
        **extra,
    }
    listed = ",\n".join(f"{name} as ({text})" for name, text in steps.items())
    return f"with {listed}\n{select}"


def _first(columns: str, source: str) -> str:
    key, *rest = columns.split(", ")
    order = ", ".join(["orderid", *(f"{c} nulls first" for c in rest)])
    return (
        f"select {columns} from (select *, row_number() over"
        f" (partition by {key} order by {order}) as rn from {source}"
        f" where {key} is not null) ranked where rn = 1"
    )


def _batch(source: str, watermark: int, rows: int = 10000) -> str:
    return f"select * from {source} where orderid > {watermark} order by orderid limit {rows}"


def _even(columns: str) -> str:
    key = columns.split(", ")[0]
    return f"select * from ({_first(columns, 'cleaned')}) every_key where {key} % 2 = 0"


def _new(columns: str) -> str:
    key = columns.split(", ")[0]
    return _with(
        f"select * from found where {key} not in (select {key} from existing)",
        existing=_even(columns),
        found=_first(columns, "cleaned"),
    )


# Rows moved by an earlier transfer of 1,000 and one of 10,000.
_MOVED = _batch("cleaned", 0, 11000)


def _transferred(columns: str) -> str:
    key = columns.split(", ")[0]
    return _with(
        "select * from existing union all"
        f" select * from found where {key} not in (select {key} from existing)",
        batch=_MOVED,
        existing=_even(columns),
        found=_first(columns, "batch"),
    )


def _lloyd(iterations: int = 5, k: int = 4) -> str:
    steps = {
        "fact": _first(_FACT, "cleaned"),
        "totals": "select cast(count(*) as hugeint) as n,"
        " cast(sum(countryid) as hugeint) as s0,"
        " cast(sum(countryid * countryid) as hugeint) as q0,"
        " cast(sum(amount) as hugeint) as s1,"
        " cast(sum(cast(amount as hugeint) * amount) as hugeint) as q1 from fact",
        "spread": "select sqrt(cast(n * q0 - s0 * s0 as double) / cast(n * (n - 1) as double)) as d0,"
        " sqrt(cast(n * q1 - s1 * s1 as double) / cast(n * (n - 1) as double)) as d1 from totals",
        "c0": "select cast(row_number() over (order by orderid) - 1 as int) as id,"
        " cast(countryid as double) as x, cast(amount as double) as y"
        f" from (select * from fact order by orderid limit {k}) lowest",
    }

    def assign(step: int) -> str:
        gap_x, gap_y = "((cast(countryid as double) - x) / d0)", "((cast(amount as double) - y) / d1)"
        distance = f"{gap_x} * {gap_x} + {gap_y} * {gap_y}"
        return (
            "select orderid, countryid, amount,"
            f" min(struct_pack(d := {distance}, id := id)).id as cluster"
            f" from fact, spread, c{step} group by orderid, countryid, amount"
        )

    for step in range(iterations):
        steps[f"a{step}"] = assign(step)
        steps[f"c{step + 1}"] = (
            f"select c.id, coalesce(m.x, c.x) as x, coalesce(m.y, c.y) as y from c{step} c"
            " left join (select cluster, cast(sum(countryid) as double) / cast(count(*) as double)"
            " as x, cast(sum(amount) as double) / cast(count(*) as double) as y"
            f" from a{step} group by cluster) m on m.cluster = c.id"
        )
    return _with(assign(iterations), **steps)


_NUMBERED = (
    "select orderid, cast(count(*) as bigint) as copies,"
    " cast(floor((sum(count(*)) over (order by orderid) - count(*)) / 1000) + 1 as bigint)"
    " as batch_no from pending group by orderid"
)

_ORPHANS = """
select * from (
  select orderid, coalesce(dateid % 2 = 0, false) as has_dim_date,
    coalesce(categoryid % 2 = 0, false) as has_dim_category,
    coalesce(countryid % 2 = 0, false) as has_dim_country
  from fact
) checked where not (has_dim_date and has_dim_category and has_dim_country)
"""

_STAR = """
select country, year, quartername, count(*) as orders, cast(sum(amount) as bigint) as total_amount
from fact join dims_country using (countryid) join dims_date using (dateid)
group by country, year, quartername
"""


_CSV_REJECTS = """
select line, case orderid % 100 when 7 then 'amount' when 8 then 'date' when 9 then 'amount, date'
    else 'number of fields' end as reason
from (select orderid, concat_ws(',', orderid, case when orderid % 100 in (7, 9) then 'about ' else '' end || amount,
  dateid, countryid, categoryid, case when orderid % 100 in (8, 9) then '1995-13-01' else cast(date as varchar) end,
  year, quarter, coalesce(quartername, ''), month, monthname, day, weekday, coalesce(weekdayname, ''),
  category, country) || case when orderid % 100 = 10 then ',more' else '' end as line from stg)
where orderid % 100 between 7 and 10
"""

_SKETCHED = ("amount", "dateid", "countryid", "categoryid", "orderid")
_SKETCHES = " union all ".join(
    f"select '{n}' as column_name, count(*) as rows, count(*) - count({n}) as missing,"
    f" count(distinct {n}) as distinct_values, true as distinct_good, true as quantiles_good from stg"
    for n in _SKETCHED
)


def _moved(name: str) -> str:
    """The exact largest difference of ranks between each later quarter of the ids and the first."""
    return f"""
select cast(b as int) as batch, '{name}' as column_name, max(abs(upto / total - first_upto / first_total)) > 0.25 as moved
from (select b, v, sum(n) over (partition by b order by v) as upto, sum(n) over (partition by b) as total,
        sum(n0) over (partition by b order by v) as first_upto, sum(n0) over (partition by b) as first_total
      from (select b, v, count(*) filter (k = b)::double as n, count(*) filter (k = 0)::double as n0
            from (select {name} as v, least(orderid * 4 // (max(orderid) over () + 1), 3) as k from stg) valued,
              (select unnest([1, 2, 3]) as b) batches
            where k in (0, b) group by b, v) counted) ranked
group by b"""


_DRIFT = " union all ".join(map(_moved, _SKETCHED))

# The name with the smallest order id of each day; a version begins where it changes.
_HISTORY = {
    "daily": "select countryid, dateid, arg_min(country, orderid) as country from stg group by countryid, dateid",
    "changes": "select *, lag(country) over w is distinct from country or row_number() over w = 1 as begins"
    " from daily window w as (partition by countryid order by dateid)",
    "history": "select countryid, country, dateid as valid_from,"
    " lead(dateid) over (partition by countryid order by dateid) as valid_to from changes where begins",
}


def _quality(stage: str, source: str) -> str:
    weekdays = "'Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday'"
    counts = {
        "missing_weekdays": "coalesce(weekdayname, '') = ''",
        "unnamed_weekdays": f"weekdayname <> '' and weekdayname not in ({weekdays})",
        "missing_quarters": "coalesce(quartername, '') = ''",
        "unnamed_quarters": "quartername <> '' and quartername not in ('Q1', 'Q2', 'Q3', 'Q4')",
        "countries_with_digits": "regexp_matches(country, '[0-9]')",
    }
    return (
        f"select '{stage}' as stage, count(*) as rows, "
        + ", ".join(f"count(*) filter (where {c}) as {name}" for name, c in counts.items())
        + f" from {source}"
    )


def _exists() -> str:
    def line(name: str, rows: str) -> str:
        listed = f"select count(*) > 0 from duckdb_views() where view_name = '{name}'"
        return f"select '{name}' as table_name, ({listed}) as found, {rows} as row_count"

    lines = [
        line(name, f"(select count(*) from {name})")
        for name in ("orders", "customer", "nation", "region")
    ]
    return " union all ".join([*lines, line("no_such_table", "0")])


_KEYS = {
    "dim_date": "dateid",
    "dim_category": "categoryid",
    "dim_country": "countryid",
    "fact_orders": "orderid",
}
_LENGTHS = {
    "sales_staging_cleaned": {
        "quartername": 2, "monthname": 50, "weekdayname": 50, "category": 50, "country": 50,
    },
    "dim_date": {"quartername": 2, "monthname": 50, "weekdayname": 50},
    "dim_category": {"category": 50},
    "dim_country": {"country": 50},
}


def _damaged() -> str:
    holes = {"dateid": 11, "categoryid": 13, "countryid": 17}
    longer = {"quartername": 7, "monthname": 9, "weekdayname": 10, "category": 14, "country": 15}
    columns = [f"case when orderid % {m} <> 0 then {n} end as {n}" for n, m in holes.items()]
    columns += [
        f"case when orderid % {m} = 0 then repeat({n}, 20) else {n} end as {n}"
        for n, m in longer.items()
    ]
    return f"select orderid, {', '.join(columns)} from cleaned"


def _key_violations() -> str:
    return " union all ".join(
        f"select '{table}' as table_name, {key} as key_value, count(*) as copies from cleaned"
        f" where {key} is not null group by {key} having count(*) > 1"
        for table, key in _KEYS.items()
    )


def _null_violations() -> str:
    return " union all ".join(
        f"select '{table}' as table_name, orderid, '{key}' as column_name from damaged"
        f" where {key} is null"
        for table, key in _KEYS.items()
    )


def _length_violations() -> str:
    return " union all ".join(
        f"select '{table}' as table_name, orderid, '{name}' as column_name,"
        f" cast(length({name}) as int) as characters from damaged where length({name}) > {length}"
        for table, lengths in _LENGTHS.items()
        for name, length in lengths.items()
    )


def oracle_sql() -> dict[str, str]:
    fact = {"fact": _first(_FACT, "cleaned")}
    fact_query = _with("select * from fact", **fact)
    dates = _with(_first(_DATE, "cleaned"))
    categories = _with(_first(_CATEGORY, "cleaned"))
    countries = _with(_first(_COUNTRY, "cleaned"))
    cleaned_batch = {"batch": _batch("stg", 0), "fixed": _CLEAN.format(source="batch")}
    cleaned_batch_2 = {"batch": _batch("stg", 10000), "fixed": _CLEAN.format(source="batch")}
    whole = {"fixed": _CLEAN.format(source="stg")}
    stddev = {
        **fact,
        "spread": "select stddev_samp(countryid) as d0, stddev_samp(amount) as d1 from fact",
    }
    star_sales = _with(
        _STAR, **fact, dims_date=_first(_DATE, "cleaned"), dims_country=_first(_COUNTRY, "cleaned")
    )
    return {
        "scan_fact": fact_query,
        "batch_first": _with(_batch("stg", 0)),
        "batch_second": _with(_batch("stg", 10000)),
        "dim_key_scan": _with(
            "select 'dim_date' as dimension, dateid as id from (select distinct dateid from cleaned)"
            " union all select 'dim_category', categoryid from"
            " (select distinct categoryid from cleaned)"
            " union all select 'dim_country', countryid from"
            " (select distinct countryid from cleaned)"
        ),
        "high_watermark": _with("select coalesce(max(orderid), 0) as max_orderid from cleaned"),
        "table_exists": _exists(),
        "csv_load": _with(
            "select * replace (nullif(quartername, '') as quartername,"
            " nullif(weekdayname, '') as weekdayname, nullif(country, '') as country,"
            " nullif(category, '') as category, nullif(monthname, '') as monthname) from stg"
        ),
        "csv_rejects": _with(_CSV_REJECTS),
        "append_cleaned": _with("select * from cleaned"),
        "overwrite_result": _lloyd(),
        "project_fact": _with(f"select {_FACT} from cleaned"),
        "project_date": _with(f"select {_DATE} from cleaned"),
        "filter_after_watermark": _with("select * from stg where orderid > 0"),
        "find_missing_names": _with(
            "select orderid, weekday, weekdayname, quarter, quartername from stg"
            " where weekdayname is null or weekdayname = ''"
            " or quartername is null or quartername = ''"
        ),
        "new_date_keys": _new(_DATE),
        "new_category_keys": _new(_CATEGORY),
        "new_country_keys": _new(_COUNTRY),
        "batch_min_orderid": _with(
            "select min(orderid) as min_orderid from batch", batch=_batch("stg", 0)
        ),
        "row_count": _with("select count(*) as row_count from stg"),
        "dedup_date": dates,
        "dedup_category": categories,
        "dedup_country": countries,
        "dedup_fact": fact_query,
        "feature_stddev": _with(
            "select round(d0, 6) as countryid_stddev, round(d1, 6) as amount_stddev from spread",
            **stddev,
        ),
        "clean_country": _with(
            "select orderid, regexp_replace(country, '\\d+', '', 'g') as country from stg"
        ),
        "fill_weekdayname": _with(
            "select orderid, coalesce(nullif(weekdayname, ''), cast(weekday as varchar))"
            " as weekdayname from stg"
        ),
        "clean_weekdayname": _with("select orderid, weekdayname from fixed", **whole),
        "fill_quartername": _with(
            "select orderid, coalesce(nullif(quartername, ''), cast(quarter as varchar))"
            " as quartername from stg"
        ),
        "clean_quartername": _with("select orderid, quartername from fixed", **whole),
        "features": _with(
            "select orderid, cast(countryid as double) as countryid,"
            " cast(amount as double) as amount from fact",
            **fact,
        ),
        "scaled_features": _with(
            "select orderid, round(countryid / d0, 6) as countryid,"
            " round(amount / d1, 6) as amount from fact, spread",
            **stddev,
        ),
        "kmeans_result": _with(
            "select orderid, countryid, amount, true as in_range, true as is_nearest from fact",
            **fact,
        ),
        "kmeans_summary": _with(
            "select count(*) as rows, cast(4 as bigint) as clusters, true as good from fact", **fact
        ),
        "kmeans_seeded_summary": _with(
            "select count(*) as rows, cast(4 as bigint) as clusters, true as good from fact", **fact
        ),
        "lloyd_assignment": _lloyd(),
        "clean_batch": _with("select * from fixed", **cleaned_batch),
        "clean_batch_2": _with("select * from fixed", **cleaned_batch_2),
        "transfer_dim_date": _transferred(_DATE),
        "transfer_dim_category": _transferred(_CATEGORY),
        "transfer_dim_country": _transferred(_COUNTRY),
        "transfer_fact": _with(_first(_FACT, "batch"), batch=_MOVED),
        "pipeline_final_fact": fact_query,
        "pipeline_final_dim_date": dates,
        "pipeline_final_dim_category": categories,
        "pipeline_final_dim_country": countries,
        "backlog_fact": fact_query,
        "stream_final_fact": fact_query,
        "stream_state_fact": fact_query,
        "loop_resumed_fact": fact_query,
        "sliced_final_fact": fact_query,
        "sketch_report": _with(_SKETCHES),
        "batch_drift": _with(_DRIFT),
        "missing_order_ids": _with(
            "select orderid from cleaned where not (orderid % 10 <> 3 and orderid % 1000 >= 70)"
        ),
        "dim_history": _with("select * from history", **_HISTORY),
        "fact_as_of": _with(
            f"select {', '.join(f'fact.{n}' for n in _FACT.split(', '))}, country from fact"
            " left join history on fact.countryid = history.countryid and fact.dateid >= valid_from"
            " and fact.dateid < coalesce(valid_to, 2147483647)",
            **fact,
            **_HISTORY,
        ),
        "batch_assignment": _with(_NUMBERED),
        "batch_ranges": _with(
            "select batch_no, min(orderid) as first_orderid, max(orderid) as last_orderid,"
            " cast(sum(copies) as bigint) as rows from numbered group by batch_no",
            numbered=_NUMBERED,
        ),
        "pk_violations": _with(_key_violations()),
        "null_key_violations": _with(_null_violations(), damaged=_damaged()),
        "length_violations": _with(_length_violations(), damaged=_damaged()),
        "dim_conflicts": _with(
            "select countryid, count(distinct country) as distinct_values from stg"
            " where countryid is not null group by countryid"
            " having count(distinct country) > 1"
        ),
        "star_sales_by_country_quarter": star_sales,
        "star_sales_maintained": star_sales,
        "orphan_facts": _with(_ORPHANS, **fact),
        "quality_report": _with(
            _quality("raw", "stg") + " union all " + _quality("cleaned", "fixed"), **whole
        ),
    }
