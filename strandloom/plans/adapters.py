"""Domain tables derived from the driver's tables, for both engines."""

from __future__ import annotations

from strandloom.plans.catalog import adapter

TEXT = "cast(cast({} as decimal(18,2)) as string)"

adapter("log", f"""select event_id, 'run' || cast(cast(floor(event_id / 1e3) as bigint) as string) as run_id, event_id % 1000 as event_seq,
  cast(floor(event_id / 1e3) as bigint) as append_seq, <ts> as ts, 'c' || cast(user_id % 3 as string) as compilation, 'T' || cast(user_id as string) as tsid,
  'D' || cast(user_id % 20 as string) as dataset_id, event_type as field, cast(null as string) as old_value, false as old_present,
  case when event_id % 10 <> 0 then {TEXT.format("value")} end as new_value, event_id % 10 <> 0 as new_present,
  case when event_id % 3 = 0 then 'sheet' when event_id % 3 = 1 then 'lipd' else 'curator' end as source, 'a' || cast(user_id % 7 as string) as actor from {{events}}""")
adapter("base", f"""select 'C' || cast(c_custkey as string) as tsid, 'D' || cast(c_nationkey as string) as dataset_id, c_custkey as k, 'c_name' as field, c_name as value from {{customer}}
  union all select 'C' || cast(c_custkey as string), 'D' || cast(c_nationkey as string), c_custkey, 'c_mktsegment', c_mktsegment from {{customer}}
  union all select 'C' || cast(c_custkey as string), 'D' || cast(c_nationkey as string), c_custkey, 'c_acctbal', {TEXT.format("c_acctbal")} from {{customer}}
  union all select 'C' || cast(c_custkey as string), 'D' || cast(c_nationkey as string), c_custkey, 'c_nationkey', cast(c_nationkey as string) from {{customer}}
  union all select 'C' || cast(c_custkey as string), 'D' || cast(c_nationkey as string), c_custkey, 'c_comment', c_mktsegment || ' note' from {{customer}}""")
adapter("sheet", """select tsid, dataset_id, k, field, case when k % 11 = 0 then '' when k % 13 = 0 then '<<CLEAR>>' when k % 7 = 0 then value || ' edited'
  when k % 23 = 0 then value || chr(10) when k % 29 = 0 and field = 'c_acctbal' then value || '0' else value end as value from {base} where k % 17 <> 0""")
adapter("file_cells", """select tsid, dataset_id, k, field, case when k % 5 = 0 and k % 7 = 0 then value || ' edited' when k % 5 = 0 then value || ' changed'
  when k % 31 = 0 then '' else value end as value from {base} where k % 19 <> 0""")
adapter("registry", """select * from (values
  ('c_name', 'merged', 'curator', true, 'column', 'text', 'paleoData_name', 'data', 20, 40, cast(null as string)),
  ('c_mktsegment', 'merged', 'shared', false, 'dataset', 'text', 'archiveType', 'root', 10, 30, cast(null as string)),
  ('c_acctbal', 'merged', 'machine', false, 'column', 'number', cast(null as string), 'data', 21, 25, cast(null as string)),
  ('c_nationkey', 'key', 'key', false, 'dataset', 'number', cast(null as string), 'root', 2, 60, cast(null as string)),
  ('site', 'synonym', 'curator', false, 'dataset', 'text', 'c_name', 'root', 3, 12, cast(null as string)),
  ('siteName', 'synonym', 'curator', false, 'dataset', 'text', 'c_name', 'root', 4, 55, cast(null as string)),
  ('orphan', 'synonym', 'curator', false, 'dataset', 'text', 'nowhere', 'root', 100, 1, cast(null as string)),
  ('odd', 'strange', 'nobody', true, 'column', 'text', cast(null as string), 'root', 11, 0, cast(null as string)),
  ('lac_csm_unit', 'csm', 'shared', false, 'column', 'text', cast(null as string), 'csm', 50, 5, 'lac_csm_unit'),
  ('lac_unit', 'csm', 'shared', false, 'column', 'text', cast(null as string), 'csm', 51, 5, 'unit'),
  ('odd', 'unused', 'machine', false, 'column', 'text', cast(null as string), 'root', 12, 0, cast(null as string))
  ) as r(qc_name, role, ownership, nullable, cardinality, type, canonical, grp, group_order, n_filled, csm_flat_key)""")
adapter("field_names", """select distinct field from {base} union select 'site' union select 'siteName' union select 'odd' union select 'nowhere'""")
adapter("lines", """select *, row_number() over (partition by l_orderkey order by l_partkey, l_suppkey, l_linenumber, l_extendedprice) as n from {lineitem}""")
adapter("series", """select case when l_orderkey % 89 = 0 and n = 1 then cast(null as string) when l_orderkey % 97 = 0 then 'dup-' || cast(n as string) || '-' || cast(l_orderkey % 5 as string)
  when l_orderkey % 83 = 0 then 'twin-' || cast(l_orderkey as string) else cast(l_orderkey as string) || '-' || cast(n as string) end as tsid,
  'O' || cast(l_orderkey as string) as dataset_id, n, l_returnflag || l_linestatus as variable, l_suppkey, cast(l_partkey as string) as item, l_quantity, l_extendedprice,
  <array>('c' || cast(l_suppkey % 3 as string), case when l_returnflag = 'R' then 'cR' end, case when l_linestatus = 'F' then 'cF' end) as compilations from {lines}""")
adapter("clean_series", """select cast(l_orderkey as string) || '-' || cast(n as string) as tsid, 'O' || cast(l_orderkey as string) as dataset_id, n, l_returnflag || l_linestatus as variable,
  <array>('c' || cast(l_suppkey % 3 as string), case when l_returnflag = 'R' then 'cR' end, case when l_linestatus = 'F' then 'cF' end) as compilations, l_suppkey from {lines}""")
adapter("datasets", """select case when o_orderkey % 79 = 0 then cast(null as string) when o_orderkey % 97 = 0 then 'Odup' || cast(o_orderkey % 4 as string) else 'O' || cast(o_orderkey as string) end as datasetId,
  case when o_orderkey % 73 = 0 then '' when o_orderkey % 61 = 0 then 'Ntwin' else 'N' || cast(o_orderkey as string) end as dataSetName, 'f' || cast(o_orderkey as string) as file,
  case when o_orderkey % 67 = 0 then 'X' || cast(o_orderkey % 3 as string) else 'N' || cast(o_orderkey as string) end as fileDataSetName,
  case when o_orderkey % 101 = 0 then 'bad zip' end as parse_error, 'N' || cast(o_orderkey as string) as name, o_orderkey, o_custkey from {orders}""")
adapter("scan_old", """select 'd' || cast(doc_id as string) as name, md5(text) as md5 from {documents}""")
adapter("scan_new", """select 'd' || cast(doc_id as string) as name, md5(case when doc_id % 9 = 0 then text || ' new' else text end) as md5 from {documents} where doc_id % 31 <> 0
  union all select 'e' || cast(doc_id as string), md5(text) from {documents} where doc_id % 37 = 0""")
adapter("vocab", """select * from (values
  ('type', 'ECONOMY', 'cheap', 1), ('type', 'ECONOMY', 'low cost', 2), ('type', 'STANDARD', 'std', 3), ('type', 'LARGE', 'big', 4), ('type', 'SMALL', 'big', 5), ('type', 'PROMO', 'Promotion', 6),
  ('event', 'click', 'tap', 7), ('event', 'purchase', 'buy', 8), ('event', 'sign up', 'signup', 9)) as v(vocab_key, name, synonym, place)""")
adapter("vocab_input", """select 'type' as vocab_key, case when p_partkey % 7 = 0 then lower(p_type) when p_partkey % 11 = 0 then ' ' || p_type || chr(9) when p_partkey % 13 = 0 then 'cheap'
  when p_partkey % 17 = 0 then 'BIG' when p_partkey % 19 = 0 then '' when p_partkey % 23 = 0 then p_name else p_type end as value, 'D' || cast(p_size as string) as dataset_id, 'T' || cast(p_partkey as string) as tsid from {part}
  union all select 'event', case when event_id % 5 = 0 then upper(event_type) else event_type end, 'D' || cast(user_id as string), 'E' || cast(event_id as string) from {events}""")
adapter("decisions", """select * from (values
  ('type', 'MEDIUM', 'new_term', 'MEDIUM', cast(null as string), cast(null as string)), ('type', 'big', 'synonym', 'LARGE', cast(null as string), cast(null as string)),
  ('type', 'red widget', 'decompose', 'PROMO', 'color', 'red'), ('event', 'view', 'new_term', 'look', 'mode', 'passive'), ('event', 'error', 'ignore', cast(null as string), cast(null as string), cast(null as string))
  ) as d(vocab_key, value, decision, target, also_field, also_value)""")
adapter("review", """select vocab_key, value, case when n % 4 = 0 then decision end as decision, case when n % 4 = 0 then target end as target, also_field, also_value,
  case when n % 3 = 0 then 'high' when n % 3 = 1 then 'medium' end as confidence, case when n % 5 <> 0 then 'synonym' end as proposed, case when n % 5 <> 0 then 'LARGE' end as proposed_target from
  (select 'type' as vocab_key, p_name as value, min(p_partkey) as n, case when min(p_partkey) % 8 = 0 then 'synonym' when min(p_partkey) % 12 = 0 then 'new_term' else 'decompose' end as decision,
   case when min(p_partkey) % 16 = 0 then 'NOWHERE' else 'LARGE' end as target, case when min(p_partkey) % 20 = 0 then 'color' end as also_field, case when min(p_partkey) % 40 = 0 then 'red' end as also_value from {part} group by p_name, p_size) x""")
adapter("sites", """select 'c' || cast(c_custkey as string) as id, (c_custkey * 37 % 18000) / 1e2 - 90 as lat, (c_custkey * 53 % 36000) / 1e2 - 180 as lon, c_mktsegment as name, 'n' || cast(c_nationkey % 3 as string) as kind,
  cast(c_custkey % 1000 as double) as first, cast(c_custkey % 1000 + 10 + c_nationkey * 20 as double) as last,
  case when c_custkey % 3 = 0 then 'doi' || cast(c_nationkey % 4 as string) else '' end as doi, <array>('v' || cast(c_custkey % 3 as string), 'v' || cast(c_custkey % 5 as string), 'w') as vars, <array>('t' || cast(c_custkey % 700 as string)) as tsids from {customer}
  union all select 's' || cast(s_suppkey as string), (s_suppkey * 370 % 18000) / 1e2 - 89.9e0, (s_suppkey * 530 % 36000) / 1e2 - 179.8e0, s_name, 'n' || cast(s_nationkey % 3 as string), cast(s_suppkey as double), cast(s_suppkey + 200 as double), 'doi1', <array>('v1', 'w'), <array>('u' || cast(s_suppkey as string)) from {supplier}""")
adapter("order_hashes", """select distinct 'O' || cast(l_orderkey as string) as dataset_id, md5(cast(l_partkey % 300 as string)) as hash, l_orderkey from {lineitem}""")
adapter("leaves_old", """select 'P' || cast(p_partkey % 50 as string) as dataset, case when p_partkey % 6 = 0 then cast(null as string) else 'T' || cast(p_partkey as string) end as tsid, 'p.' || cast(p_partkey as string) as path,
  case when p_partkey % 41 = 0 then cast(null as string) else p_name end as value from {part} where p_partkey % 37 <> 0""")
adapter("leaves_new", """select 'P' || cast(p_partkey % 50 as string) as dataset, case when p_partkey % 6 = 0 then cast(null as string) else 'T' || cast(p_partkey as string) end as tsid, 'p.' || cast(p_partkey as string) as path,
  case when p_partkey % 9 = 0 then p_name || '!' when p_partkey % 43 = 0 then cast(null as string) else p_name end as value from {part} where p_partkey % 31 <> 0""")
adapter("doc_old", """select 'D' || cast(p_size as string) as dataset_id, cast(p_partkey as string) || '.price' as path, 'price' as field, cast(cast(p_retailprice as decimal(18,2)) as string) as value from {part} where p_partkey % 23 <> 0
  union all select 'D' || cast(p_size as string), cast(p_partkey as string) || '.name', case when p_partkey % 17 = 0 then 'md5' else 'name' end, p_name from {part}""")
adapter("doc_new", """select 'D' || cast(p_size as string) as dataset_id, cast(p_partkey as string) || '.price' as path, 'price' as field, case when p_partkey % 3 = 0 then cast(cast(p_retailprice as decimal(18,3)) as string) when p_partkey % 11 = 0 then cast(cast(p_retailprice + 1 as decimal(18,2)) as string)
  else cast(cast(p_retailprice as decimal(18,2)) as string) end as value from {part}
  union all select 'D' || cast(p_size as string), cast(p_partkey as string) || '.name', case when p_partkey % 17 = 0 then 'md5' else 'name' end, case when p_partkey % 13 = 0 then p_name || 's' else p_name end from {part} where p_partkey % 29 <> 0""")
adapter("version_cases", """select c_custkey as k, case when c_custkey % 5 = 0 then cast(null as string) else cast(c_custkey % 3 as string) || '_' || cast(c_nationkey as string) || '_' || cast(c_custkey % 11 as string) end as prev,
  <array>('a', 'b', case when c_custkey % 4 = 0 then 'c' end) as before, <array>('b', 'a', case when c_custkey % 6 = 0 then 'd' end, 'a') as now, c_custkey % 7 = 0 as publish from {customer}""")
adapter("versions", """select 'g' || cast(l_suppkey as string) as dataset_id, cast(l_linenumber as string) || '.' || cast(l_partkey % 13 as string) || '.' || cast(l_orderkey % 17 as string) as version from {lineitem}
  union all select 'empty', cast(null as string)""")
adapter("ledger", """select 'c' || cast(o_custkey % 9 as string) as compilation, o_orderkey as ledger_seq, cast(o_orderkey % 4 as string) || '_' || cast(o_custkey % 10 as string) || '_' || cast(o_orderkey % 7 as string) as version, o_custkey as n_members from {orders}""")
adapter("entries", """select 'T' || cast(l_orderkey as string) as tsid, n as pos, l_returnflag as scope from {lines}""")
adapter("field_cells", """select 'D' || cast(c_nationkey as string) as dataset_id, 'T' || cast(c_custkey as string) as tsid,
  case c_custkey % 8 when 0 then 'geo_latitude' when 1 then 'pub2_title' when 2 then 'paleoData_units' when 3 then 'climateInterpretation2_variable' when 4 then 'interpretation1_scope' when 5 then 'calibration_method' when 6 then 'chronData_units' else 'archiveType' end as field,
  case when c_custkey % 9 = 0 then 'TRUE' when c_custkey % 10 = 0 then cast(null as string) when c_custkey % 4 = 0 then cast(cast(c_acctbal as decimal(18,1)) as string) else c_mktsegment end as value from {customer}""")
adapter("receipts", """select 'run' || cast(cast(floor(event_id / 1e3) as bigint) as string) as run_id, 'f' || cast(user_id as string) as file, case when event_type = 'click' then 'add' when event_type = 'error' then 'delete' else 'replace' end as action, event_id from {events}""")
adapter("compilation_cells", """select compilation, tsid, field, value from (select 'c' || cast(l_suppkey % 4 as string) as compilation, 'T' || cast(l_partkey as string) as tsid, 'f' || cast(l_linenumber as string) as field,
  case when l_suppkey % 3 = 0 then l_returnflag || '-' || l_linestatus when l_suppkey % 3 = 1 then lower(l_returnflag) || l_linestatus else 'x' end as value from {lineitem}) q""")
