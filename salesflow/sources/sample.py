"""Raw staging rows derived from order, customer, nation and region tables.

The text columns are damaged by order id, so that every cleaning rule has work to do and any
SQL engine can derive the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_RAW = """
select case when o_orderkey between -2147483648 and 2147483647 then cast(o_orderkey as int)
    else cast(raise_error('an order id does not fit into 32 bits') as int) end as orderid,
   cast(floor(o_totalprice) as int) as amount,
  cast(date_diff(cast(o_orderdate as date), date'1995-01-01') + 1 as int) as dateid,
  cast(n_nationkey as int) as countryid, cast(substr(o_orderpriority, 1, 1) as int) as categoryid,
  cast(o_orderdate as date) as date, cast(year(o_orderdate) as int) as year,
  cast(quarter(o_orderdate) as int) as quarter,
  case o_orderkey % 7 when 0 then null when 1 then ''
    when 2 then cast(quarter(o_orderdate) as string)
    else 'Q' || cast(quarter(o_orderdate) as string) end as quartername,
  cast(month(o_orderdate) as int) as month, date_format(o_orderdate, 'MMMM') as monthname,
  cast(day(o_orderdate) as int) as day, cast(dayofweek(o_orderdate) as int) as weekday,
  case o_orderkey % 5 when 0 then null when 1 then ''
    when 2 then cast(dayofweek(o_orderdate) as string)
    else date_format(o_orderdate, 'EEEE') end as weekdayname,
  substr(o_orderpriority, 3) as category,
  case o_orderkey % 3 when 0 then '12' || r_name || '_' || chr(65 + n_nationkey) || '7'
    when 1 then r_name || '3_' || chr(65 + n_nationkey)
    else r_name || '_' || chr(65 + n_nationkey) end as country
from {orders} join {buyers} on o_custkey = c_custkey
"""


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw rows. Spark chooses how to join by the sizes of the tables."""

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    # Few nations and regions meet the customers first, so that orders are joined once, by the
    # customer, and never by one of the few values of a nation.
    places = table("nation").join(table("region"), F.expr("n_regionkey = r_regionkey"))
    buyers = (
        table("customer")
        .join(places, F.expr("c_nationkey = n_nationkey"))
        .select("c_custkey", "n_nationkey", "r_name")
    )
    return spark.sql(_RAW, orders=table("orders"), buyers=buyers)
