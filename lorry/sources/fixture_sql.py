"""Fixture adapter: the driver's star-schema tables re-shaped into the
freight-operations tables the reports read.

These are *test fixtures*, not report logic: each entry is one portable
SELECT that Spark SQL and DuckDB both accept, with ``{name}`` placeholders
for the tables it reads.  Spark fills the placeholders with DataFrames
(``spark.sql(text, orders=df, ...)``); the DuckDB oracle fills them with
view names.  Sharing the text guarantees both engines see the same input
rows; the reports themselves are written independently on each side.

Fixed values: fixture adapter definitions (FIXTURES.md section 2), widened
with derived columns for the inter-company, gross-margin and carrier-contract
reports.  Fractions of money are taken in decimal arithmetic
(``cast(cast(x as decimal(18,2)) * 0.1 as decimal(18,2))``): multiplying the
double first rounds differently in the two engines at half-cent ties.  Keep them in this order: later views read earlier ones.
"""

from __future__ import annotations

import string

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)

FIXTURES: dict[str, str] = {
    "tlorder": """
select o_orderkey as detail_line_id,
  'C' || lpad(cast(o_orderkey - case when o_orderkey % 5 = 4 then 4 else 0 end as varchar(12)), 8, '0')
      || case when o_orderkey % 5 = 4 then '.1' else '' end as bill_number,
  case when o_orderkey % 5 = 4 then o_orderkey - 4 end as copy_dlid,
  case when o_orderkey % 11 = 0 then null when o_orderkey % 13 = 0 then -1
       else year(o_orderdate) * 100 + month(o_orderdate) end as interface_status_f,
  case when o_orderpriority = '5-LOW' then 'Child' else 'False' end as extra_stops,
  o_custkey as bill_to_code, o_custkey as origin, (o_custkey + o_orderkey % 2) as destination,
  cast(o_totalprice as decimal(18,2)) as total_charges,
  cast(cast(o_totalprice as decimal(18,2)) * 0.8 as decimal(18,2)) as charges,
  cast(cast(o_totalprice as decimal(18,2)) * 0.1 as decimal(18,2)) as xcharges,
  cast(cast(o_totalprice as decimal(18,2)) * 0.05 as decimal(18,2)) as tax_1,
  cast(cast(o_totalprice as decimal(18,2)) * 0.05 as decimal(18,2)) as tax_2,
  cast(o_orderdate as date) as actual_delivery,
  'N' || cast(o_orderkey % 7 as varchar(4)) as origname,
  o_orderkey % 25 as start_zone,
  'N' || cast(o_orderkey % 6 as varchar(4)) as destname,
  o_orderkey % 24 as end_zone,
  o_orderkey % 3 as site_id,
  case when o_orderkey % 7 = 0 then o_orderkey + 1 end as master_order,
  'EQ' || cast(o_orderkey % 4 as varchar(4)) as requested_equipmen,
  cast(o_orderdate as date) as bill_date,
  case when o_orderstatus = 'F' then 'BILLED' else 'OPEN' end as current_status,
  'Street ' || cast(o_custkey % 97 as varchar(6)) as origaddr1,
  case when o_orderkey % 2 = 0 then 'Unit ' || cast(o_orderkey % 9 as varchar(4)) end as origaddr2,
  'City ' || cast(o_custkey % 40 as varchar(4)) as origcity,
  'P' || cast(o_custkey % 5 as varchar(4)) as origprov,
  'PC' || cast(o_custkey % 300 as varchar(4)) as origpc,
  'Contact ' || cast(o_custkey % 11 as varchar(4)) as origcontact,
  '555-' || lpad(cast(o_custkey % 10000 as varchar(8)), 4, '0') as origphone,
  'shipper' || cast(o_custkey as varchar(12)) || '@example.com' as origemail,
  'Road ' || cast((o_custkey + o_orderkey % 2) % 89 as varchar(6)) as destaddr1,
  case when o_orderkey % 3 = 0 then 'Dock ' || cast(o_orderkey % 5 as varchar(4)) end as destaddr2,
  'City ' || cast((o_custkey + o_orderkey % 2) % 40 as varchar(4)) as destcity,
  'P' || cast((o_custkey + o_orderkey % 2) % 5 as varchar(4)) as destprov,
  'PC' || cast((o_custkey + o_orderkey % 2) % 300 as varchar(4)) as destpc,
  'Receiver ' || cast(o_custkey % 13 as varchar(4)) as destcontact,
  '555-' || lpad(cast((o_custkey + 7) % 10000 as varchar(8)), 4, '0') as destphone,
  'consignee' || cast(o_custkey as varchar(12)) || '@example.com' as destemail,
  cast(o_orderkey % 900 + 100 as decimal(18,2)) as distance,
  o_orderkey % 26 as pallets,
  case when o_orderkey % 10 = 0 then 'True' else 'False' end as tarp,
  case when o_orderkey % 15 = 0 then 'True' else 'False' end as high_value,
  case when o_orderkey % 12 = 0 then 'True' else 'False' end as dangerous_goods,
  case when o_orderkey % 4 = 0 then null else o_orderdate end as pick_up_by,
  o_orderdate as pick_up_by_end,
  case when o_orderkey % 4 = 1 then null else o_orderdate end as deliver_by,
  o_orderdate as deliver_by_end,
  case when o_orderkey % 3 = 0 then 'True' else 'False' end as pick_up_appt_req,
  'False' as pick_up_appt_made,
  case when o_orderkey % 3 = 1 then 'True' else 'False' end as delivery_appt_req,
  'False' as delivery_appt_made,
  o_orderdate as pick_up_appt,
  o_orderdate as delivery_appt,
  'Caller ' || cast(o_custkey % 13 as varchar(4)) as callname,
  o_orderdate as actual_pickup,
  'OP' || cast(o_orderkey % 5 as varchar(4)) as op_code,
  o_orderkey % 26 as rollup_pallets,
  cast(o_totalprice as decimal(18,2)) as rollup_weight,
  cast(o_orderkey % 50 as decimal(18,2)) as rollup_cube,
  case when o_custkey % 4 = 0 then 'USD' else 'CAD' end as currency_code,
  'Agent ' || cast(o_custkey % 7 as varchar(4)) as sales_agent,
  'user' || cast(o_orderkey % 3 as varchar(4)) as created_by
from {orders}
""",
    "client": """
select c_custkey as client_id, case when c_custkey % 10 = 0 then null else c_name end as user3,
  8 as open_time, 17 as close_time
from {customer}
""",
    "billgl": """
select l_orderkey as detail_line_id,
  case when l_returnflag = 'R' then '02' else '01' end || '-'
    || case l_linenumber when 1 then '2200' when 2 then '2210' when 3 then '3000' when 4 then '3100' else '4000' end
    || '-00' as acct_code,
  cast(l_extendedprice as decimal(18,2)) * case when l_linestatus = 'F' then -1 else 1 end as amount
from {lineitem}
""",
    "trace": """
select l_orderkey as detail_number,
  case l_linenumber when 1 then 'P' when 2 then '1' when 3 then '9' when 4 then 'B' when 5 then '2' when 6 then 'Y' else 'K' end as trace_type,
  'N' || cast(l_partkey as varchar(12)) as trace_number, l_returnflag as trace_desc
from {lineitem}
""",
    "reg_audit": """
select distinct year(o_orderdate) * 100 + month(o_orderdate) as source_audit,
  'Billing Register' as source_reg, 0 as company_id
from {orders} where o_orderdate < timestamp '2001-07-01 00:00:00'
""",
    "legsum": """
select l_orderkey * 10 + l_linenumber as ls_leg_id, l_orderkey - l_orderkey % 3 as ls_trip_number,
  (l_orderkey % 3) * 10 + l_linenumber as ls_leg_seq, nullif(min(l_suppkey) % 5, 4) as ls_interliner,
  cast(sum(l_quantity) as bigint) as ls_leg_dist, min(l_partkey) % 25 as ls_from_zone,
  max(l_suppkey) % 26 as ls_to_zone, 'Nation ' || cast(min(l_partkey) % 25 as varchar(4)) as lego_zone_desc,
  'Nation ' || cast(max(l_suppkey) % 26 as varchar(4)) as legd_zone_desc,
  case when min(l_returnflag) = 'R' then 'E' else 'L' end as ls_mt_loaded,
  'D' || cast(min(l_partkey) % 50 as varchar(4)) as ls_driver,
  'U' || cast(min(l_partkey) % 40 as varchar(4)) as ls_power_unit,
  min(l_shipdate) as ls_planned_departure, max(l_shipdate) as ls_expected_date,
  count(*) as ls_num_pu, count(*) + 1 as ls_num_del
from {lineitem} group by l_orderkey, l_linenumber
""",
    "ilegdtl": """
select distinct l_orderkey * 10 + l_linenumber as ild_leg_id, 'F' as ild_res_type, l_orderkey as ild_fb_id,
  l_orderkey - l_orderkey % 3 as ild_trip_number
from {lineitem}
union all
select distinct l_orderkey * 10 + l_linenumber, case when l_linenumber % 2 = 1 then 'D' else 'I' end,
  cast(null as bigint), l_orderkey - l_orderkey % 3
from {lineitem}
""",
    "trip": """
select ls_trip_number as trip_number, min(ls_from_zone) as origin_zone,
  max(case when ls_to_zone < 25 then ls_to_zone end) as destination_zone,
  'Nation ' || cast(min(ls_from_zone) as varchar(4)) as orig_zone_desc,
  'Nation ' || cast(max(case when ls_to_zone < 25 then ls_to_zone end) as varchar(4)) as dest_zone_desc
from {legsum} group by ls_trip_number
""",
    "zone": """
select n_nationkey as zone_id, n_name as short_description, 'P' || cast(n_regionkey as varchar(4)) as province,
  case when n_nationkey % 3 = 0 then 'True' else 'False' end as is_terminal,
  'Terminal Rd ' || cast(n_nationkey as varchar(4)) as address1,
  case when n_nationkey % 2 = 0 then 'Suite ' || cast(n_nationkey as varchar(4)) end as address2,
  'Hub ' || cast(n_nationkey as varchar(4)) as city,
  'Z' || lpad(cast(n_nationkey as varchar(4)), 3, '0') as postal_code
from {nation}
""",
    "order_interliner": """
select l_orderkey * 10 + l_linenumber as order_interliner_id, min(l_suppkey) as interliner_id,
  l_orderkey as detail_line_id, l_orderkey * 10 + l_linenumber as legid,
  case when l_orderkey % 4 = 0 then l_orderkey + 1 else 0 end as child_detail_line_id,
  case when l_orderkey % 8 = 0 then 'S' else 'M' end as child_type,
  case when min(l_linestatus) = 'F' then 'S' else 'I' end as interface_status,
  'PB' || cast(min(l_partkey) as varchar(12)) as probill, cast(min(l_shipdate) as date) as src_approval_date,
  sum(cast(l_extendedprice as decimal(18,2))) as amount,
  sum(cast(cast(l_extendedprice as decimal(18,2)) * 0.9 as decimal(18,2))) as adjusted_amount
from {lineitem} group by l_orderkey, l_linenumber
""",
    "order_interliner_userfields": """
select order_interliner_id from {order_interliner} where order_interliner_id % 17 <> 0
""",
    "vendor": """
select s_suppkey as vendor_id, case when s_suppkey % 10 = 0 then null else s_name end as user3, s_name as name
from {supplier}
""",
    "ip_gl": """
select l_orderkey * 10 + l_linenumber as order_interliner_id,
  case when l_returnflag = 'R' then 'Other Register' else 'IP Source Register' end as source_type,
  case when l_linenumber % 2 = 0 then '01-4000-00' else '01-2200-00' end as acct_code,
  case when l_linestatus = 'F' then cast(l_extendedprice as decimal(18,2)) else cast(0 as decimal(18,2)) end as debit_amt,
  case when l_linestatus = 'F' then cast(0 as decimal(18,2)) else cast(l_extendedprice as decimal(18,2)) end as credit_amt
from {lineitem}
""",
    "ap_bill": """
select o_orderkey as ap_bill_id,
  case when o_orderkey % 11 = 0 then 0 else year(o_orderdate) * 100 + month(o_orderdate) end as source_audit,
  case when o_orderstatus = 'P' then 'Other Register' else 'IP Register' end as source_reg,
  'B' || lpad(cast(o_orderkey as varchar(12)), 8, '0') as bill_number, o_custkey % 10 as vendor_id,
  cast(o_orderdate as date) as tx_date, 'R' || cast(o_custkey as varchar(12)) as tx_reference,
  cast(o_totalprice as decimal(18,2)) as tx_amt,
  case when o_orderkey % 4 = 0 then 'Credit' else 'Invoice' end as tx_type
from {orders}
""",
    "ap_bill_exp": """
select detail_line_id as ap_bill_id, acct_code as gl_acct_id, abs(amount) as tx_amt from {billgl}
""",
    "tldtl": """
select l_orderkey as order_id, l_linenumber as sequence, l_linenumber as sort_order,
  'PU' || l_returnflag as pallet_units, case when l_linenumber = 7 then 1 else 0 end as pick_id,
  case when l_linenumber = 6 then 1 else 0 end as deficit, cast(l_quantity as decimal(18,2)) as length_1,
  'goods ' || l_returnflag as description, cast(l_quantity as int) as pieces,
  case when l_linestatus = 'F' then cast(l_quantity as int) end as temperature,
  cast(l_quantity as int) % 4 as pallets,
  cast(l_quantity * 10 as decimal(18,2)) as weight, 'LB' as weight_units, 'FT' as length_units,
  cast(8 as decimal(18,2)) as width, 'FT' as width_units,
  cast(l_linenumber as decimal(18,2)) as height, 'FT' as height_units,
  cast(l_quantity * 2 as decimal(18,2)) as cube, 'CF' as cube_units,
  case when l_linestatus = 'F' then 'F' end as temperature_units,
  case when l_linestatus = 'F' then 'True' else 'False' end as temp_controlled,
  case when l_linenumber = 3 then 'UN' || cast(1000 + l_partkey % 3000 as varchar(8)) end as un_number
from {lineitem}
""",
    "dr_stmt_report": """
select user_id * 100 + day(ts) as statement_id,
  case when user_id % 2 = 0 then 'COMPANY DRIVER' else 'Owner/Operator' end as pay_type,
  cast(ts as date) as statement_date,
  sum(cast(value as decimal(18,2)) * case when event_type = 'error' then -3 else 1 end) as check_amt
from {events} group by user_id, cast(ts as date), day(ts)
""",
    "driverpay": """
select user_id * 100 + day(ts) as statement_id, user_id as driver_id,
  cast(value as decimal(18,2)) as total_pay_amt, cast(event_id % 12 as decimal(9,2)) as hours,
  case event_type when 'view' then 'HOUR OVER' when 'click' then null else 'MILES' end as pay_code,
  event_id % 4 as rule_id, cast(ts as date) as leg_date, cast(ts as date) as paid_date
from {events} where event_type <> 'error'
""",
    "driverdeductions": """
select user_id * 100 + day(ts) as statement_id, user_id as driver_id, cast(value as decimal(18,2)) * 3 as ded_amt
from {events} where event_type = 'error'
""",
    "driver": """
select distinct user_id as driver_id, 'Driver ' || lpad(cast(user_id as varchar(12)), 6, '0') as name from {events}
""",
    "drv_rule_mile": """
select 0 as rule_id, 'SUBSISTANCE' as user1 union all select 1, null union all select 2, 'MILES'
""",
    "legdtl": """
select distinct l_orderkey * 10 + l_linenumber as ld_leg_id, 'P' as ld_pd, 'F' as ld_type, l_orderkey as ld_fb_id,
  l_linenumber as ld_pd_order
from {lineitem} where l_linenumber % 2 = 0
union all
select distinct l_orderkey * 10 + l_linenumber, 'D', 'F', l_orderkey, l_linenumber + 1
from {lineitem} where l_linenumber % 3 <> 0
""",
    "odrstat": """
select l_orderkey as order_id,
  case l_linenumber when 1 then 'ARRSHIP' when 2 then 'BR-ARRSHIP' when 3 then 'DEPSHIP' when 4 then 'ARRCONS'
    when 5 then 'BR-DEPCONS' when 6 then 'DEPCONS' else 'OTHER' end as status_code,
  l_shipdate as changed
from {lineitem}
""",
    "site": """
select 0 as site_id, 'Control' as site_name union all select 1, 'Trucking'
""",
    "tlorder_splits": """
select o_orderkey as detail_line_id, o_orderkey - 1 as orig_detail_line_id from {orders} where o_orderkey % 9 = 3
""",
    "notes": """
select 'TLORDER' as prog_table, case when o_orderkey % 2 = 0 then '1' else '2' end as note_type,
  cast(o_orderkey as varchar(12)) as id_key, 'note ' || o_orderstatus as the_note
from {orders} where o_orderkey % 3 = 0
union all
select 'CLIENT', 'D', cast(c_custkey as varchar(12)), 'directions ' || c_mktsegment
from {customer} where c_custkey % 4 <> 0
""",
    "eqclass": """
select 'EQ0' as code, 'DRY VAN' as codedesc union all select 'EQ1', 'REEFER' union all select 'EQ2', 'FLATBED'
""",
    "edi_ace_res_codes": """
select 'PR' as seg_name, 1 as ele_nbr, '1' as value, 'ACE port 1' as description
union all select 'PR', 1, '2', 'ACE port 2' union all select 'XX', 1, '1', 'wrong'
""",
    "edi_aci_res_codes": """
select 'PR' as seg_name, 1 as ele_nbr, '1' as value, 'ACI port 1' as description
union all select 'PR', 2, '1', 'wrong'
""",
    "tlorder_customs": """
select o_orderkey as detail_line_id, 'True' as default_broker,
  case when o_orderkey % 3 = 0 then 'CA' when o_orderkey % 3 = 1 then 'US' end as orig_country,
  cast(o_orderkey % 4 as varchar(4)) as port_of_entry,
  'Broker ' || cast(o_orderkey % 5 as varchar(4)) as customs_name,
  '555-01' || cast(o_orderkey % 10 as varchar(4)) as customs_phone,
  case when o_orderkey % 2 = 0 then '555-0199' end as customs_fax,
  'broker' || cast(o_orderkey % 5 as varchar(4)) || '@example.com' as customs_email,
  'Customs Way ' || cast(o_orderkey % 5 as varchar(4)) as customs_addr1,
  case when o_orderkey % 2 = 1 then 'Floor 2' end as customs_addr2,
  'Border ' || cast(o_orderkey % 3 as varchar(4)) as customs_city,
  'P' || cast(o_orderkey % 5 as varchar(4)) as customs_prov,
  'BC' || cast(o_orderkey % 50 as varchar(4)) as customs_pc,
  'Agent ' || cast(o_orderkey % 4 as varchar(4)) as customs_contact
from {orders} where o_orderkey % 6 < 3
""",
    "shipinstruct": """
select 0 as instruction_id, 'P' as applies_to, 'call ahead' as instruction
union all select 1, 'D', 'tailgate' union all select 2, 'B', 'keep dry'
""",
    "tlshipinstruct": """
select o_orderkey as order_id, o_orderkey % 4 as instruction_id,
  case when o_orderkey % 5 = 0 then 'False' else 'True' end as active
from {orders}
""",
    "rpt_gross_margin": """
select ls_trip_number as trip, ls_leg_seq as leg, ls_leg_dist as leg_miles, ls_mt_loaded as empty_loaded,
  ls_interliner as carrier_id,
  cast(ls_leg_dist as decimal(18,4)) * 3 as revenue_total, cast(ls_leg_dist as decimal(18,4)) * 2 as total_cost,
  cast(ls_leg_dist as decimal(18,4)) as margin, ls_trip_number + ls_leg_seq % 3 as max_dlid,
  ls_trip_number as min_dlid,
  'TR' || cast(ls_trip_number % 30 as varchar(6)) as truck,
  case when ls_leg_seq % 5 = 0 then null else 'TL' || cast(ls_leg_id % 40 as varchar(6)) end as trailer,
  case when ls_leg_seq % 4 = 0 then null else ls_trip_number % 170 end as driver1_id,
  case when ls_leg_seq % 3 = 0 then ls_leg_id % 150 end as driver2_id,
  cast(ls_leg_dist as decimal(18,4)) * 2.1234 as revenue_ship,
  cast(ls_leg_dist as decimal(18,4)) * 0.5555 as revenue_fsc,
  cast(ls_leg_dist as decimal(18,4)) * 0.3211 as revenue_acc,
  cast(ls_leg_dist as decimal(18,4)) * 1.1111 as ip_ship,
  cast(ls_leg_dist as decimal(18,4)) * 0.4444 as ip_fsc,
  cast(ls_leg_dist as decimal(18,4)) * 0.2345 as ip_acc,
  cast(ls_leg_dist as decimal(18,4)) * 1.79 as ip_total,
  cast(ls_leg_dist as decimal(18,4)) * 0.2105 as dp
from {legsum}
""",
}


def dependencies(name: str) -> list[str]:
    """Names a fixture reads, in first-use order."""
    names = [f for _, f, _, _ in string.Formatter().parse(FIXTURES[name]) if f]
    return list(dict.fromkeys(names))


def closure(names) -> list[str]:
    """All fixtures (not base tables) needed for ``names``, dependencies first."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in BASE_TABLES or n in order:
            return
        for d in dependencies(n):
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return order
