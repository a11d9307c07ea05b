"""What the round trips of ``deskmeter.round_trip`` must give, from the tables they began with."""

from __future__ import annotations

from deskmeter.oracle import _KPIS, _W_CLEAN, _W_FCT, CLEAN, PRED, TICKETS

ORACLE: dict[str, str] = {}

ORACLE["events_any_layout"] = r"""
select case l_orderkey % 3 when 0 then 'minified' when 1 then 'indented' else 'escaped' end as layout, l_orderkey as ticket_id,
  count(*)::bigint as n_events, strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S') as last_ts,
  md5(string_agg('é },' || chr(10) || '  { "' || l_returnflag || '" \" [[' || l_linestatus || '}', '|' order by l_linenumber, l_shipdate, l_returnflag, l_linestatus)) as actors_md5
from lineitem group by l_orderkey"""

#: Columns of the tables that are written as text.
_COLUMNS = {
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                 "l_returnflag", "l_linestatus", "l_shipdate"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
}


def _kind(table: str, position: int, column: str) -> str:
    tests = {
        "boolean": "lower(c) in ('true', 'false')",
        "bigint": r"try_cast(c as bigint) is not null and not contains(c, '.') and not contains(lower(c), 'e')",
        "double": "try_cast(c as double) is not null and not isnan(try_cast(c as double)) and isfinite(try_cast(c as double))",
        "date": "try_cast(c as date) is not null and length(c) = 10",
        "timestamp": "try_cast(c as timestamp) is not null",
    }
    whens = " ".join(f"when bool_and({test}) then '{name}'" for name, test in tests.items())
    return (f"select '{table}' as table_name, {position}::bigint as position, '{column}' as column_name, "
            f"case when count(c) = 0 then 'string' {whens} else 'string' end as type_name from (select {column}::varchar as c from {table})")


ORACLE["sniffed_schema"] = " union all ".join(
    _kind(table, i, column) for table, columns in _COLUMNS.items() for i, column in enumerate(columns))

ORACLE["sniffed_rows"] = "select * replace (strftime(ts, '%Y-%m-%d %H:%M:%S') as ts) from events"

ORACLE["csv_tickets"] = f"""with {TICKETS} select * replace (ticket_id::varchar as ticket_id, customer_id::varchar as customer_id,
  agent_id::varchar as agent_id, strftime(created_at, '%Y-%m-%d %H:%M:%S') as created_at) from tickets"""

ORACLE["jsonl_messages"] = """select doc_id::varchar as ticket_id, 're: ' || left(text, 20) as subject, md5(text) as body_md5, '' as agent_note, lang
from documents"""

ORACLE["published_formats"] = """select fmt, (select count(*) from customer)::bigint as n_written, customer.* replace (c_nationkey::bigint as c_nationkey)
from customer, (values ('parquet'), ('orc'), ('json'), ('csv'), ('table')) f(fmt)"""

ORACLE["lake_layers"] = _W_CLEAN + """select ticket_id, left(created_date, 7) || '-01' as created_date, priority, (select count(*) from lineitem)::bigint as n_raw,
  (select count(*) from clean)::bigint as n_curated from clean"""

ORACLE["stored_predictions"] = f"with {CLEAN},{PRED}" + """ select ticket_id::varchar as ticket_id, sla_breach_real as y_true, proba_breach,
  sla_breach_previsto as y_pred, modelo from pred"""

ORACLE["staging_view"] = _W_CLEAN + "select category, count(*)::bigint as n_rows from clean where priority = 'Alta' group by category"


#: The filters of ``cards_from_cells`` as conditions.
_CONDITIONS = [
    "true", *(f"priority = '{p}'" for p in ("Crítica", "Alta", "Média", "Baixa")), *(f"channel = '{c}'" for c in ("Email", "Chat", "Redes Sociais")),
    *(f"created_month = {m}" for m in (1, 6, 12)), "created_month in (1, 2, 3)", "category = 'Cancelamento'", "category in ('Faturamento', 'Bug / Defeito')",
    "priority in ('Alta', 'Crítica') and channel = 'Email'", "priority = 'Baixa' and created_month = 7", "category = 'Cancelamento' and channel = 'Chat'",
    "priority = 'Média' and category = 'Faturamento' and created_month in (4, 5)", "true", "priority = 'Urgente'",
    "priority = 'Alta' and category = 'Cancelamento' and channel = 'Email' and created_month = 3", "priority = 'absent'",
]
_FIGURES = _KPIS.replace("total_chamados", "chamados")
ORACLE["cards_from_cells"] = _W_FCT + " union all ".join(
    f"""select {i}::bigint as filter, 'total' as dimensao, null::varchar as valor, {_FIGURES} from fct where {condition}
    union all select {i}::bigint, 'priority', priority, {_FIGURES} from fct where {condition} group by priority"""
    for i, condition in enumerate(_CONDITIONS))

ORACLE["lake_versions"] = _W_CLEAN + """, m as (select ticket_id, left(created_date, 7) as month, priority, reopened from clean)
  select ticket_id, month, priority, case when month like '%-06' then 2 else reopened end::bigint as reopened,
    (select count(distinct month) from m)::bigint as written_0, 0::bigint as written_1,
    (select count(distinct month) from m where month like '%-06')::bigint as written_2 from m"""
