"""Bronze fixtures derived from the driver's TPC-H-like tables.

The same SQL text runs in Spark and in DuckDB (the test oracle), so both engines
validate identical raw rows.  Each statement derives one all-text bronze dataset
from ``supplier``/``customer``/``orders``/``lineitem``/``part`` and injects
defects (blank and missing ids, unknown references, bad dates and amounts,
decimal commas, repeated keys) so that every data-quality rule fires.
Row counts grow with the input tables.
"""

from __future__ import annotations

SOURCE_TABLES = ("supplier", "customer", "orders", "lineitem", "part")

ADAPTER_SQL: dict[str, str] = {
    "funds": """
select ' F'||cast(k as varchar(20))||' ' as fund_id, s_name as fund_name,
 case when k%20=3 then 'Hedge' when k%20=13 then null else split_part('Equity,Bond,Mixed',',',cast(k%3+1 as int)) end as fund_type,
 case when k%25=7 then 'GBP' else split_part('EUR,USD,SEK',',',cast(k%3+1 as int)) end as base_currency,
 case when k%30=11 then '15/01/2010' else '20'||lpad(cast(k%20 as varchar(20)),2,'0')||'-01-15' end as inception_date,
 case when k%40=17 then 'Suspended' when k%7=0 then 'Closed' else 'Active' end as status,
 case when k%40=27 then 'US' when k%2=0 then 'LU' else 'IE' end as domicile,
 'Manager '||cast(k%12 as varchar(20)) as fund_manager,
 case when k%50=33 then 'Extreme' else split_part('Low,Medium,High',',',cast(k%3+1 as int)) end as risk_level
from (select s_suppkey as k, s_name from supplier union all select s_suppkey, s_name||' bis' from supplier where s_suppkey%50=8) t
""",
    "investors": """
select case when k%97=5 then '   ' when k%89=4 then null else 'I'||cast(k as varchar(20)) end as investor_id,
 case when k%101=9 then '  ' else ' '||c_name end as investor_name,
 case when k%60=10 then 'US' when k%60=11 then null else split_part('LU,DE,FR,NL,BE,CH,AT,SE,DK,FI,IE,ES,IT,PL',',',cast(c_nationkey%14+1 as int)) end as country,
 case when k%70=12 then 'Unknown' else split_part('Low,Medium,High',',',cast(k%3+1 as int)) end as risk_profile,
 case when k%80=13 then '2020-13-01' else '2020-'||lpad(cast(k%12+1 as varchar(20)),2,'0')||'-05' end as onboarding_date,
 case when k%90=14 then 'Pending' when k%5=0 then 'Inactive' else 'Active' end as status,
 case when k%110=15 then 'Retail' else split_part('Institutional,Pension Fund,Asset Manager,Insurance,Family Office',',',cast(k%5+1 as int)) end as investor_type
from (select c_custkey as k, c_name, c_nationkey from customer union all select c_custkey, c_name, c_nationkey from customer where c_custkey%120=16) t
""",
    "transactions": """
select case when k%211=1 then '  ' else 'T'||cast(k as varchar(20)) end as transaction_id,
 case when k%223=2 then 'F999999' when k%227=3 then '  ' else 'F'||cast(k%(select count(*) from supplier) as varchar(20)) end as fund_id,
 case when k%229=4 then 'I999999' when k%233=5 then null else 'I'||cast(o_custkey as varchar(20)) end as investor_id,
 case when k%239=6 then '1998/10/03' else cast(cast(o_orderdate as date) as varchar(20)) end as transaction_date,
 case when k%241=7 then 'Fee' else split_part('Subscription,Redemption,Switch,Dividend',',',cast(k%4+1 as int)) end as transaction_type,
 case when k%251=8 then 'abc' when k%257=9 then '-5.00' when k%263=10 then '0' when k%269=11 then null else cast(cast(o_totalprice as decimal(18,2)) as varchar(20)) end as amount,
 case when k%271=12 then 'GBP' when k%277=13 then null else split_part('EUR,USD,SEK',',',cast(k%3+1 as int)) end as currency
from (select o_orderkey as k, o_custkey, o_orderdate, o_totalprice from orders union all select o_orderkey, o_custkey, o_orderdate, o_totalprice from orders where o_orderkey%281=14) t
""",
    "positions": """
select case when h%283=0 then '' else 'P'||cast(l_orderkey as varchar(20))||'-'||cast(l_linenumber as varchar(20))||'-'||cast(l_partkey as varchar(20))||'-'||cast(l_suppkey as varchar(20)) end as position_id,
 case when h%293=6 then 'F999999' when h%347=7 then '  ' else 'F'||cast(l_suppkey as varchar(20)) end as fund_id,
 case when h%349=8 then 'I999999' when h%353=9 then null else 'I'||cast(l_partkey%(select count(*) from customer) as varchar(20)) end as investor_id,
 case when h%359=10 then '01.02.2000' else cast(cast(date_trunc('month',l_shipdate) as date) as varchar(20)) end as valuation_date,
 case when h%307=1 then 'Crypto' else split_part('Equity,Bond,Cash,ETF,Alternative',',',cast(l_partkey%5+1 as int)) end as asset_class,
 case when h%311=2 then 'n/a' when h%313=3 then '0' when h%3=0 then replace(cast(cast(l_quantity as decimal(18,4)) as varchar(30)),'.',',') else cast(cast(l_quantity as decimal(18,4)) as varchar(30)) end as units,
 case when h%317=4 then '1.234,50' when h%331=5 then '-1' when h%2=0 then replace(cast(cast(l_extendedprice as decimal(18,2)) as varchar(30)),'.',',') else cast(cast(l_extendedprice as decimal(18,2)) as varchar(30)) end as market_value,
 case when h%367=11 then 'GBP' when h%373=12 then null else split_part('EUR,USD,SEK',',',cast(h%3+1 as int)) end as currency
from (select *, l_orderkey*7+l_linenumber as h from lineitem union all select *, l_orderkey*7+l_linenumber as h from lineitem where l_orderkey%379=1) t
""",
    "market_prices": """
select case when k%61=5 then '  ' else 'A'||cast(k%500 as varchar(20)) end as asset_id,
 case when k%67=6 then 'F999999' when k%71=7 then null else 'F'||cast(k%(select count(*) from supplier) as varchar(20)) end as fund_id,
 case when k%73=8 then '2024-02-30' when k%79=9 then null else '2024-03-'||lpad(cast(p_size%28+1 as varchar(20)),2,'0') end as price_date,
 case when k%83=10 then 'x' when k%89=11 then '0' else cast(cast(p_retailprice as decimal(18,4)) as varchar(30)) end as close_price,
 case when k%97=12 then 'GBP' else split_part('EUR,USD,SEK',',',cast(k%3+1 as int)) end as currency
from (select p_partkey as k, p_size, p_retailprice from part union all select p_partkey, p_size, p_retailprice from part where p_partkey%53=3) t
""",
}
