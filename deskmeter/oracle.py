"""The same queries as plain SQL over the warehouse tables, for checking results.

Each statement is independent of the Spark code: it starts from the tables and computes
the answer by the textbook definition.
"""

from __future__ import annotations

from deskmeter import domain

# fixed values: as in the published data dictionary and the derived tables
CHANNELS = ["Email", "Chat", "Telefone", "Formulário Web", "Redes Sociais"]
PRODUCTS = ["Plataforma Web", "App Mobile", "API", "Integrações", "Faturamento", "Relatórios"]
CATEGORIES = [
    "Acesso e Conta", "Problema Técnico", "Bug / Defeito", "Faturamento",
    "Dúvida / Como Fazer", "Solicitação de Recurso", "Cancelamento",
]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _pick(index: str, values: list[str]) -> str:
    whens = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values))
    return f"case {index} {whens} end"


def _scaled(x: str, digits: int) -> str:
    scale = f"{10 ** digits}e0"
    return f"(round(({x}) * {scale}) / {scale})"


def _binary(x: str, digits: int) -> str:
    """Decimal rounding decided by the exact binary value of the double column ``x``."""
    scale = float(10 ** digits)
    wide = 134217729.0 * scale
    high = wide - (wide - scale)
    low = scale - high
    s, h, l, big = (f"{v:.1f}::double" for v in (scale, high, low, 134217729.0))
    p = f"({x} * {s})"
    xh = f"({x} * {big} - ({x} * {big} - {x}))"
    xl = f"({x} - {xh})"
    err = f"((({xh} * {h} - {p}) + {xh} * {l} + {xl} * {h}) + {xl} * {l})"
    f = f"floor({p})"
    part = f"({p} - {f})"
    return (
        f"(({f} + case when {part} > 0.5e0 then 1e0 when {part} < 0.5e0 then 0e0 when {err} > 0 then 1e0 "
        f"when {err} < 0 then 0e0 when {f} % 2 <> 0 then 1e0 else 0e0 end) / {s})"
    )


def _count(text: str, term: str) -> str:
    return f"((length({text}) - length(replace({text}, '{term}', ''))) // {len(term)})"


def _any(text: str, terms) -> str:
    return "case when " + " or ".join(f"contains({text}, '{t}')" for t in terms) + " then 1 else 0 end::bigint"


_PAD = "case when o_orderkey % 10 = 3 then '  ' || ({x}) || ' ' else ({x}) end"
_PRIORITY = (
    "case when o_orderkey % 97 = 5 then null when o_orderkey % 97 = 6 then 'Urgente' "
    "when o_orderpriority = '1-URGENT' then 'Crítica' when o_orderpriority = '2-HIGH' then 'Alta' "
    "when o_orderpriority = '3-MEDIUM' then 'Média' else 'Baixa' end"
)

TICKETS = f"""
li as (select l_orderkey, sum(l_quantity) q, min(l_quantity) mq,
    max(case when l_returnflag = 'R' then 1 else 0 end) ro from lineitem group by l_orderkey),
tickets as (select o_orderkey as ticket_id,
    o_orderdate + to_minutes(floor(o_totalprice)::bigint % 1440) as created_at,
    {_PAD.format(x=_pick('o_custkey % 5', CHANNELS))} as channel,
    {_pick('o_orderkey % 6', PRODUCTS)} as product,
    {_PAD.format(x=_pick('(o_orderkey * 31 + o_custkey) % 7', CATEGORIES))} as category,
    {_PAD.format(x=_PRIORITY)} as priority,
    c_mktsegment as customer_tier, o_custkey as customer_id, o_custkey % 40 as agent_id, r_name as region,
    floor(o_totalprice)::bigint % 100 as backlog_at_creation,
    mq * 6 as first_response_minutes, q * 8 as resolution_minutes,
    coalesce(ro, 0)::bigint as reopened,
    case when o_orderstatus <> 'P' then 1 + o_orderkey % 5 end as csat_score
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey left join li on l_orderkey = o_orderkey)"""

CLEAN = TICKETS + """,
trimmed as (select * replace (trim(channel) as channel, trim(product) as product, trim(category) as category,
    trim(priority) as priority, trim(customer_tier) as customer_tier, trim(region) as region) from tickets),
timed as (select *, (csat_score is null)::bigint as csat_missing,
    strftime(created_at, '%Y-%m-%d') as created_date, hour(created_at)::bigint as created_hour,
    (isodow(created_at) - 1)::bigint as created_weekday, month(created_at)::bigint as created_month,
    case priority when 'Crítica' then 240 when 'Alta' then 480 when 'Média' then 1440
      when 'Baixa' then 2880 end::bigint as sla_minutes from trimmed),
clean as (select *, case when resolution_minutes > sla_minutes then 1 else 0 end::bigint as sla_breach from timed)"""


def _text(urgency, refund, cancel, error) -> str:
    hits = " + ".join(_count("f", t) for t in urgency)
    return f"""
body as (select doc_id as ticket_id, coalesce(text, '') as b from documents),
folded as (select *, strip_accents(lower(b)) as f,
    length(b) - length(regexp_replace(b, '\\p{{L}}', '', 'g')) as letters,
    length(b) - length(regexp_replace(b, '\\p{{Lu}}', '', 'g')) as uppers from body),
ratio as (select *, case when letters = 0 then 0e0 else uppers::double / letters::double end as r from folded),
textf as (select ticket_id, length(b)::bigint as body_len,
    len(regexp_extract_all(lower(b), '[\\p{{L}}\\p{{N}}_]+'))::bigint as word_count,
    {_count('b', '?')}::bigint as num_question, {_count('b', '!')}::bigint as num_exclam,
    {_binary('r', 4)} as upper_ratio, ({hits})::bigint as urgency_hits,
    {_any('f', refund)} as kw_refund, {_any('f', cancel)} as kw_cancel, {_any('f', error)} as kw_error from ratio)"""


TEXT = _text(domain.URGENCY_TERMS, domain.REFUND_TERMS, domain.CANCEL_TERMS, domain.ERROR_TERMS)

LOGS = """
logf as (select l_orderkey as ticket_id, count(*)::bigint as n_events,
    greatest(0, count(case when l_linenumber <> 5 and l_linenumber <> 6 then 1 end) - 1)::bigint as n_status_changes,
    max(case when l_returnflag = 'R' then 1 else 0 end)::bigint as reopened_from_log
  from lineitem group by l_orderkey)"""

_TEST = f"md5('{domain.SEED}:' || {{key}}) < '40000000000000000000000000000000'"
_IS_TEST = _TEST.format(key="ticket_id")

PRED = f"""
scored as (select ticket_id, sla_breach, round_even(((ticket_id * 37) % 1000 * 0.0006e0 + sla_breach * 0.35e0) * 10000e0, 0)
    / 10000e0 as proba_breach from clean where {_IS_TEST}),
pred as (select ticket_id, sla_breach as sla_breach_real, proba_breach,
    (proba_breach >= 0.5e0)::bigint as sla_breach_previsto, 'svm' as modelo from scored)"""

_TICKET_COLUMNS = """ticket_id, strftime(created_at, '%Y-%m-%d %H:%M:%S') as created_at, created_date, created_hour,
created_weekday, created_month, channel, product, category, priority, customer_tier, region, customer_id, agent_id,
backlog_at_creation, first_response_minutes, resolution_minutes, reopened, csat_score, csat_missing, sla_minutes,
sla_breach"""

FCT = f""",{TEXT},{LOGS},
fct as (select c.*, x.* exclude (ticket_id), l.* exclude (ticket_id)
  from (select {_TICKET_COLUMNS} from clean) c
  left join textf x on c.ticket_id = x.ticket_id left join logf l on c.ticket_id = l.ticket_id)"""

_BAND = """case when proba_breach >= 0.7e0 then 'Alto' when proba_breach >= 0.4e0 then 'Médio'
    when proba_breach is not null then 'Baixo' else 'Sem score' end"""

MART = f""",{PRED},
mart as (select f.*, p.proba_breach, p.sla_breach_previsto, {_BAND} as faixa_risco
  from fct f left join pred p on f.ticket_id = p.ticket_id)"""
FPRED = f""",{PRED},
fpred as (select p.ticket_id, sla_breach_real, sla_breach_previsto, proba_breach, modelo, priority, category, product,
    customer_tier, channel, resolution_minutes, sla_minutes from pred p join fct f on p.ticket_id = f.ticket_id)"""

_W_CLEAN = f"with {CLEAN} "
_W_TEXT = f"with {TEXT} "
_W_FCT = f"with {CLEAN}{FCT} "
_W_MART = f"with {CLEAN}{FCT}{MART} "
_W_FPRED = f"with {CLEAN}{FCT}{FPRED} "
_W_BOTH = _W_MART + f""", fpred as (select p.ticket_id, sla_breach_real, p.sla_breach_previsto from pred p
    join fct f on p.ticket_id = f.ticket_id) """

_DECISION = ", ".join(domain.DECISION_COLUMNS)
_TEXT_NAMES = ", ".join(domain.TEXT_FEATURES)
_LOG_NAMES = ", ".join(domain.LOG_FEATURES)
_W_ML = f"""with {CLEAN},{TEXT},{LOGS},
ml as (select c.{', c.'.join(domain.DECISION_COLUMNS)}, c.sla_breach, {_TEXT_NAMES}, {_LOG_NAMES}
  from clean c join textf x on c.ticket_id = x.ticket_id join logf l on c.ticket_id = l.ticket_id) """

_RATE = _scaled("avg(sla_breach) * 100", 1) + " as taxa_violacao_pct"
_HOURS = _scaled("avg(resolution_minutes) / 60", 1)
_SEVERITY = "case priority when 'Crítica' then 1 when 'Alta' then 2 when 'Média' then 3 else 4 end"
_KPIS = f"""count(*)::bigint as total_chamados, {_RATE},
    {_scaled('avg(resolution_minutes)', 1)} as tempo_medio_resolucao_min,
    {_scaled('avg(first_response_minutes)', 1)} as tempo_medio_1a_resposta_min,
    {_scaled('avg(reopened) * 100', 1)} as taxa_reabertura_pct, {_scaled('avg(csat_score)', 2)} as csat_medio"""


def _by(column: str, name: str | None = None, extra: str = "") -> str:
    return (
        f"{_W_FCT} select {column} as {name or column}, count(*)::bigint as chamados, {_RATE}{extra} "
        f"from fct group by {column}"
    )


_QUEUE = f"""select ticket_id, priority as prioridade, category as categoria, product as produto,
    customer_tier as tier, {_scaled('proba_breach', 3)} as prob_violacao, faixa_risco from mart
    where faixa_risco = 'Alto' {{where}} order by proba_breach desc, ticket_id limit 50"""

# -- scores of simple rules: (model, id, y_true, score, y_pred)
_W_SCORES = f"""with {CLEAN},{PRED},
base as (select p.ticket_id as id, p.sla_breach_real as y_true, p.proba_breach, c.backlog_at_creation / 100e0 as backlog,
    coalesce(c.priority in ({_quoted(domain.URGENT_PRIORITIES)}), false) as urgent
  from pred p join clean c on p.ticket_id = c.ticket_id),
scores as (
  select 'cut_050' as model, id, y_true, proba_breach as score, (proba_breach >= 0.5e0)::bigint as y_pred from base
  union all select 'cut_070', id, y_true, proba_breach, (proba_breach >= 0.7e0)::bigint from base
  union all select 'backlog', id, y_true, backlog, (backlog >= 0.5e0)::bigint from base
  union all select 'priority', id, y_true, urgent::int::double, urgent::bigint from base) """


def _div(a: str, b: str) -> str:
    return f"coalesce({a}::double / nullif({b}, 0)::double, 0e0)"


_METRICS = f""",
cells as (select model, count(*) filter (y_true = 1 and y_pred = 1)::bigint as tp,
    count(*) filter (y_true <> 1 and y_pred = 1)::bigint as fp, count(*) filter (y_true = 1 and y_pred <> 1)::bigint as fn,
    count(*) filter (y_true <> 1 and y_pred <> 1)::bigint as tn from scores group by model),
parts as (select *, {_div('(tp + tn)', '(tp + fp + fn + tn)')} as a, {_div('tp', '(tp + fp)')} as p,
    {_div('tp', '(tp + fn)')} as r, {_div('(2 * tp)', '(2 * tp + fp + fn)')} as f from cells),
measured as (select model, tp, fp, fn, tn, {_binary('a', 4)} as accuracy, {_binary('p', 4)} as "precision",
    {_binary('r', 4)} as recall, {_binary('f', 4)} as f1 from parts) """
_AUC = f""",
ranks as (select model, y_true, (2 * rank() over (partition by model order by score)
      + count(*) over (partition by model, score) - 1) / 2e0 as mid from scores),
sums as (select model, sum(mid) filter (y_true = 1) as s, count(*) filter (y_true = 1)::double as np,
    count(*) filter (y_true <> 1)::double as nn from ranks group by model),
areas as (select model, (s - np * (np + 1) / 2e0) / nullif(np * nn, 0) as area from sums),
auc as (select model, {_binary('area', 4)} as roc_auc from areas) """
_EVALUATED = """select m.model, accuracy, "precision", recall, f1, roc_auc from measured m join auc u on m.model = u.model"""


def _agreement(left: str, right: str, pairs: str) -> str:
    side = "(select {c} from ev where model = '{m}') as {c}_{s}"
    sides = ", ".join(
        side.format(c=c, m=m, s=s) for c in ("f1", "roc_auc") for m, s in ((left, "left"), (right, "right"))
    )
    return f""", ev as ({_EVALUATED}), sides as (select {sides}),
        diffs as (select *, f1_right - f1_left as df, roc_auc_right - roc_auc_left as da from sides),
        same as (select avg((a.y_pred = b.y_pred)::int)::double as g from {pairs})
        select {_binary('g', 4)} as agreement, f1_left, f1_right, roc_auc_left, roc_auc_right,
        {_binary('df', 4)} as diff_f1, {_binary('da', 4)} as diff_roc_auc from diffs, same"""


# -- neighbours
_W_KNN = f"""with e as (select vec_id as id, embedding::double[] as v, (label = 1)::bigint as label,
    {_TEST.format(key='vec_id')} as te from embeddings),
pairs as (select q.id, q.label as y_true, t.id as neighbour, t.label,
    round(list_sum(list_transform(list_zip(q.v, t.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 9) as d2
  from e q join e t on q.te and not t.te),
ranked as (select *, row_number() over (partition by id order by d2, neighbour) as rank from pairs),
near as (select * from ranked where rank <= {domain.NEIGHBOURS}),
votes as (select id, any_value(y_true) as y_true, avg(label) as score, (avg(label) >= 0.5)::bigint as y_pred
  from near group by id) """

ORACLE: dict[str, str] = {
    "source_row_counts": f"""with {TICKETS} select 'tickets' as source, count(*)::bigint as n_rows from tickets
        union all select 'messages', count(*) from documents union all select 'events', count(*) from lineitem""",
    "clean_categoricals": _W_CLEAN + f"select ticket_id, {', '.join(domain.CATEGORICAL)} from clean",
    "ticket_date_parts": _W_CLEAN + """select ticket_id, strftime(created_at, '%Y-%m-%d %H:%M:%S') as created_at,
        created_date, created_hour, created_weekday, created_month from clean""",
    "event_date_parts": """select event_id, strftime(ts, '%Y-%m-%d') as created_date, hour(ts)::bigint as created_hour,
        (isodow(ts) - 1)::bigint as created_weekday, month(ts)::bigint as created_month from events""",
    "sla_minutes_lookup": _W_CLEAN + "select ticket_id, priority, sla_minutes from clean",
    "sla_breach_flag": _W_CLEAN + "select ticket_id, resolution_minutes, sla_minutes, sla_breach from clean",
    "text_lengths": _W_TEXT + "select ticket_id, body_len, word_count from textf",
    "text_punctuation": _W_TEXT + "select ticket_id, num_question, num_exclam from textf",
    "text_upper_ratio": _W_TEXT + "select ticket_id, upper_ratio from textf",
    "text_urgency_hits": _W_TEXT + "select ticket_id, urgency_hits from textf",
    "text_keyword_flags": _W_TEXT + "select ticket_id, kw_refund, kw_cancel, kw_error from textf",
    "text_features": _W_TEXT + "select * from textf",
    "text_custom_terms": f"with {_text(['the', 'and', 'ing', 'data', 'on the'], ['pay'], ['stop'], ['fail', 'miss'])} "
        "select ticket_id, urgency_hits, kw_refund, kw_cancel, kw_error from textf",
    "log_features_flat": f"with {LOGS} select * from logf",
    "log_features_nested": """with w as (select doc_id as ticket_id, string_split(text, ' ') as words from documents)
        select ticket_id, len(words)::bigint as n_events,
        greatest(0, len(list_filter(words, lambda w: length(w) % 3 = 2)) - 1)::bigint as n_status_changes,
        (len(list_filter(words, lambda w: length(w) = 13)) > 0)::bigint as reopened_from_log from w""",
    "stg_tickets": _W_CLEAN + f"select {_TICKET_COLUMNS} from clean",
    "stg_text_features": _W_TEXT + "select * from textf",
    "stg_log_features": f"with {LOGS} select * from logf",
    "stg_predictions": f"with {CLEAN},{PRED} select * from pred",
    "dim_date": _W_CLEAN + """select distinct created_date as date_key, year(created_at)::bigint as ano,
        month(created_at)::bigint as mes, day(created_at)::bigint as dia, dayofweek(created_at)::bigint as dia_semana
        from clean""",
    "dim_product": _W_CLEAN + """select row_number() over (order by product) as product_key, product
        from (select distinct product from clean)""",
    "dim_category": _W_CLEAN + """select row_number() over (order by category) as category_key, category
        from (select distinct category from clean)""",
    "dim_channel": _W_CLEAN + """select row_number() over (order by channel) as channel_key, channel
        from (select distinct channel from clean)""",
    "fct_tickets": _W_FCT + "select * from fct",
    "fct_predictions": _W_FPRED + "select * from fpred",
    "mart_ticket_decision": _W_MART + "select * from mart",
    "mart_ml_features": _W_FCT + f"select {_DECISION}, {_TEXT_NAMES}, {_LOG_NAMES}, sla_breach from fct",
    "ml_features_inner": _W_ML + "select * from ml",
    "risk_band": f"with {CLEAN},{PRED} select ticket_id, proba_breach, {_BAND} as faixa_risco from pred",
    "kpi_global": _W_FCT + f"select {_KPIS} from fct",
    "kpi_global_hours": _W_FCT + f"""select count(*)::bigint as chamados, {_scaled('avg(sla_breach) * 100', 1)} as
        taxa_violacao_sla_pct, {_HOURS} as tempo_medio_resolucao_h,
        {_scaled('avg(first_response_minutes)', 0)} as tempo_medio_1a_resposta_min,
        {_scaled('avg(csat_score)', 2)} as csat_medio, {_scaled('avg(reopened) * 100', 1)} as taxa_reabertura_pct from fct""",
    "card_ticket_count": _W_FCT + "select count(*)::bigint as chamados from fct",
    "card_breach_rate": _W_FCT + f"select {_RATE} from fct",
    "card_resolution_hours": _W_FCT + f"select {_HOURS} as horas from fct",
    "breach_by_category": _by("category"),
    "breach_by_priority": _by("priority", extra=f", {_SEVERITY}::bigint as ordem"),
    "breach_by_channel": _by("channel"),
    "breach_by_month": _by("created_month", "mes"),
    "breach_by_all_dims": _W_FCT + " union all ".join(
        f"select '{label}' as dimensao, {value} as valor, count(*)::bigint as chamados, {_RATE} from fct {group}"
        for label, value, group in [
            ("priority", "priority", "group by priority"), ("category", "category", "group by category"),
            ("channel", "channel", "group by channel"), ("month", "created_month::varchar", "group by created_month"),
            ("total", "null", ""),
        ]
    ),
    "risk_distribution": _W_MART + """select faixa_risco, count(*)::bigint as chamados,
        case faixa_risco when 'Alto' then 1 when 'Médio' then 2 else 3 end::bigint as ordem
        from mart where faixa_risco <> 'Sem score' group by faixa_risco""",
    "top_risk_12": _W_MART + f"""select ticket_id, priority, category, channel, product, customer_tier,
        {_scaled('proba_breach', 3)} as prob_violacao from mart where faixa_risco = 'Alto'
        order by proba_breach desc, ticket_id limit 12""",
    "risk_queue_50": _W_MART + _QUEUE.format(where=""),
    "risk_queue_50_filtered": _W_MART
        + _QUEUE.format(where="and priority in ('Alta', 'Crítica') and channel = 'Email'"),
    "kpi_rate_filtered_priority": _W_FCT + f"select {_RATE} from fct where priority = 'Crítica'",
    "kpi_rate_filtered_category": _W_FCT
        + f"select {_RATE} from fct where category in ('Cancelamento', 'Bug / Defeito')",
    "kpi_rate_filtered_channel": _W_FCT + f"select {_RATE} from fct where channel = 'Redes Sociais'",
    "kpi_rate_filtered_month": _W_FCT + f"select {_RATE} from fct where created_month in (1, 2)",
    "confusion_matrix": _W_FPRED + """select sla_breach_real as real, sla_breach_previsto as previsto,
        count(*)::bigint as n from fpred group by 1, 2""",
    "confusion_matrix_labeled": _W_FPRED + """select
        case sla_breach_real when 1 then 'Violou (real)' else 'Não violou (real)' end as real,
        case sla_breach_previsto when 1 then 'Violou (previsto)' else 'Não violou (previsto)' end as previsto,
        count(*)::bigint as chamados from fpred group by 1, 2""",
    "dashboard_document_json": _W_BOTH + f""",
        k as (select {_KPIS} from fct),
        d_cat as (select category, count(*)::bigint as chamados, {_RATE} from fct group by category),
        d_pri as (select priority, count(*)::bigint as chamados, {_RATE} from fct group by priority),
        d_cha as (select channel, count(*)::bigint as chamados, {_RATE} from fct group by channel),
        d_mes as (select created_month as mes, count(*)::bigint as chamados, {_RATE} from fct group by created_month),
        d_ris as (select faixa_risco, count(*)::bigint as chamados from mart where faixa_risco <> 'Sem score' group by 1),
        d_con as (select sla_breach_real as real, sla_breach_previsto as previsto, count(*)::bigint as n
          from fpred group by 1, 2),
        d_top as (select * from mart where faixa_risco = 'Alto' order by proba_breach desc, ticket_id limit 12)
        select to_json({{
          'kpis': (select k from k),
          'por_categoria': (select list(d order by d.taxa_violacao_pct desc, d.category nulls last) from d_cat d),
          'por_prioridade': (select list(d order by {_SEVERITY.replace('priority', 'd.priority')},
              d.priority nulls last) from d_pri d),
          'por_canal': (select list(d order by d.chamados desc, d.channel nulls last) from d_cha d),
          'por_mes': (select list(d order by d.mes) from d_mes d),
          'distribuicao_risco': (select list(d order by case d.faixa_risco when 'Alto' then 1 when 'Médio' then 2
              else 3 end) from d_ris d),
          'matriz_confusao': (select list(d order by d.real, d.previsto) from d_con d),
          'top_risco': (select list({{'ticket_id': d.ticket_id, 'priority': d.priority, 'category': d.category,
              'channel': d.channel, 'product': d.product, 'customer_tier': d.customer_tier,
              'prob_violacao': {_scaled('d.proba_breach', 3)}}} order by d.proba_breach desc, d.ticket_id) from d_top d)
        }})::varchar as document""",
    "dq_not_null": _W_FCT + " union all ".join(
        f"""select 'not_null' as test, 'fct_tickets' as model, '{c}' as "column",
        count(*) filter ({c} is null)::bigint as failures from fct"""
        for c in ("ticket_id", "priority", "body_len", "n_events", "csat_score")
    ),
    "dq_unique": """select l_orderkey as ticket_id, count(*)::bigint as n_rows from lineitem
        where l_orderkey is not null group by 1 having count(*) > 1""",
    "dq_accepted_values": _W_FCT + f"""select 'accepted_values' as test, 'fct_tickets' as model, 'priority' as "column",
        count(*) filter (priority not in ({_quoted(domain.PRIORITIES)}))::bigint as failures from fct
        union all select 'accepted_values', 'fct_tickets', 'sla_breach',
        count(*) filter (sla_breach not in (0, 1)) from fct""",
    "dq_relationships": f"""with {LOGS} select ticket_id, n_events from logf
        where ticket_id not in (select doc_id from documents)""",
    "split_hash": _W_CLEAN + f"select ticket_id, ({_IS_TEST})::bigint as is_test from clean",
    "majority_class": _W_CLEAN + f"""select sla_breach as majority, count(*)::bigint as n_rows from clean
        where not ({_IS_TEST}) group by 1 order by n_rows desc, majority limit 1""",
    "holdout_lookup": _W_CLEAN + f"""select ticket_id, priority,
        (priority in ({_quoted(domain.URGENT_PRIORITIES)}))::bigint as urgent from clean where {_IS_TEST}""",
    "classification_metrics": _W_SCORES + _METRICS + "select * from measured",
    "roc_auc_exact": _W_SCORES + _AUC + "select * from auc",
    "champion_model": _W_SCORES + _METRICS + _AUC + _EVALUATED + """ order by f1 desc,
        case m.model when 'cut_050' then 1 when 'cut_070' then 2 when 'backlog' then 3 else 4 end limit 1""",
    "roc_curve": _W_SCORES + f""", steps as (select model, score, count(*) filter (y_true = 1) as p,
        count(*) filter (y_true <> 1) as n from scores group by 1, 2),
        running as (select model, score, sum(p) over w as cp, sum(n) over w as cn, sum(p) over (partition by model) as ap,
          sum(n) over (partition by model) as an from steps
          window w as (partition by model order by score desc rows unbounded preceding))
        select model, score as threshold, {_scaled('cp::double / ap::double', 9)} as tpr,
        {_scaled('cn::double / an::double', 9)} as fpr from running""",
    "minmax_score": f"""with s as (select min(value) as lo, max(value) as hi from events)
        select event_id, {_scaled('case when hi > lo then (value - lo) / (hi - lo) else 0e0 end', 9)} as score
        from events, s""",
    "predictions": _W_SCORES + """, b as (select * from scores where model = 'backlog'),
        s as (select min(score) as lo, max(score) as hi from b)
        select id as ticket_id, y_true, round_even((score - lo) / (hi - lo) * 10000e0, 0) / 10000e0 as proba_breach,
        y_pred, 'backlog' as modelo from b, s""",
    "label_metrics": "with scores as (select 'toxic' as model, quality as y_true, toxic as y_pred, "
        "toxic::double as score from labels)" + _METRICS + _AUC + _EVALUATED,
    "rule_agreement": _W_SCORES + _METRICS + _AUC + _agreement(
        "cut_050", "priority", "scores a join scores b on a.id = b.id and a.model = 'cut_050' and b.model = 'priority'"),
    "knn_topk": _W_KNN + "select id, rank, neighbour, d2 from near",
    "knn_topk_blocked": _W_KNN + "select id, rank, neighbour, d2 from near",
    "knn_vote": _W_KNN + f"select id, {_scaled('score', 6)} as score, y_pred from votes",
    "knn_predict": _W_KNN + ", scores as (select 'knn_sklearn' as model, * from votes)" + _METRICS + _AUC + _EVALUATED,
    "model_agreement": _W_KNN + ", scores as (select 'knn' as model, * from votes)" + _METRICS + _AUC + _agreement(
        "knn", "knn", "votes a join votes b on a.id = b.id"),
    "stream_log_features": f"with {LOGS} select * from logf",
    "stream_daily_breach": """select strftime(ts, '%Y-%m-%d') as day, event_type, count(*)::bigint as n_rows,
        sum((value > 10)::int)::bigint as n_flagged from events group by 1, 2""",
}

# -- statements assembled from lists
for _name, _rule in (
    ("baseline_majoritaria", "(select sla_breach from clean where not (" + _IS_TEST
     + ") group by 1 order by count(*) desc, 1 limit 1)"),
    ("baseline_regra_prioridade", f"coalesce((priority in ({_quoted(domain.URGENT_PRIORITIES)}))::bigint, 0)"),
):
    ORACLE["baseline_majority" if "maj" in _name else "baseline_priority_rule"] = (
        _W_CLEAN + f""", scores as (select '{_name}' as model, ticket_id as id, sla_breach as y_true,
        {_rule} as y_pred, ({_rule})::double as score from clean where {_IS_TEST})""" + _METRICS + _AUC + _EVALUATED
    )

ORACLE["onehot_categories"] = _W_CLEAN + "select ticket_id, " + ", ".join(
    f"""coalesce(({column} = '{v}')::bigint, 0) as "{column}_{v}\""""
    for column, values in (
        ("channel", CHANNELS), ("product", PRODUCTS), ("category", CATEGORIES),
        ("priority", [*domain.PRIORITIES, "Urgente"]), ("customer_tier", SEGMENTS), ("region", REGIONS),
    )
    for v in values
) + " from clean"

_TRAIN_MOMENTS = ", ".join(
    f"avg({c}) as mean_{c}, case when stddev_samp({c}) = 0 then 1e0 else stddev_samp({c}) end as std_{c}"
    for c in domain.NUMERIC
)
_W_MOMENTS = _W_ML + f", m as (select {_TRAIN_MOMENTS} from ml where not ({_IS_TEST})) "
ORACLE["feature_moments"] = _W_MOMENTS + "select " + ", ".join(
    f"{_scaled(f'{k}_{c}', 6)} as {k}_{c}" for c in domain.NUMERIC for k in ("mean", "std")
) + " from m"
ORACLE["zscore_numeric"] = _W_MOMENTS + "select ticket_id, " + ", ".join(
    f"{_scaled(f'({c} - mean_{c}) / std_{c}', 6)} as {c}" for c in domain.NUMERIC
) + " from ml, m"

_SPLIT = _W_CLEAN + f""",
q as (select sla_breach as y, count(*) as n, sum(count(*)) over () as a, ceil(sum(count(*)) over () * 0.25e0) as t
  from clean group by 1),
sh as (select *, floor(n * t / a) as fl, n * t / a - floor(n * t / a) as rest from q),
quota as (select y, fl + case when row_number() over (order by rest desc, y) <= t - sum(fl) over () then 1 else 0 end
  as n_test from sh),
split as (select ticket_id, sla_breach, (row_number() over (partition by sla_breach
    order by md5('{domain.SEED}:' || ticket_id), ticket_id) <= n_test)::bigint as is_test
  from clean join quota on sla_breach = y) """
ORACLE["split_exact"] = _SPLIT + "select * from split"
ORACLE["split_counts"] = _SPLIT + "select sla_breach, is_test, count(*)::bigint as n_rows from split group by 1, 2"
ORACLE["run_summary"] = _SPLIT + f""", s as (select count(*) filter (is_test = 0)::bigint as n_train,
    count(*) filter (is_test = 1)::bigint as n_test, avg(sla_breach) filter (is_test = 1) as p from split)
    select n_train, n_test, {_binary('p', 4)} as test_prevalence, ({len(domain.NUMERIC)} + (select {" + ".join(f"count(distinct {c})" for c in domain.CATEGORICAL)} from clean))::bigint
    as n_features from s"""

_CHECKS = [
    ("not_null", "stg_tickets", "ticket_id", "select 1 from clean where ticket_id is null"),
    ("unique", "stg_tickets", "ticket_id", "select 1 from clean group by ticket_id having count(*) > 1"),
    ("not_null", "stg_predictions", "ticket_id", "select 1 from pred where ticket_id is null"),
    ("not_null", "fct_tickets", "ticket_id", "select 1 from fct where ticket_id is null"),
    ("unique", "fct_tickets", "ticket_id", "select 1 from fct group by ticket_id having count(*) > 1"),
    ("accepted_values", "fct_tickets", "priority",
     f"select 1 from fct where priority not in ({_quoted(domain.PRIORITIES)})"),
    ("accepted_values", "fct_tickets", "sla_breach", "select 1 from fct where sla_breach not in (0, 1)"),
    ("not_null", "fct_predictions", "ticket_id", "select 1 from fpred where ticket_id is null"),
    ("relationships", "fct_predictions", "ticket_id",
     "select 1 from fpred where ticket_id is not null and ticket_id not in (select ticket_id from fct)"),
    ("not_null", "mart_ticket_decision", "ticket_id", "select 1 from mart where ticket_id is null"),
]
_REPORT = _W_BOTH + ", counted as (" + " union all ".join(
    f"""select '{k}' as test, '{m}' as model, '{c}' as "column", count(*)::bigint as failures from ({sql})"""
    for k, m, c, sql in _CHECKS
) + "), report as (select *, case when failures = 0 then 'PASS' else 'ERROR' end as status from counted) "
ORACLE["dq_report"] = _REPORT + "select * from report"
ORACLE["dq_totals"] = _REPORT + """select count(*) filter (status = 'PASS')::bigint as passed,
    count(*) filter (status = 'ERROR')::bigint as errors from report"""

_SIDES = _W_ML + f"""select (select count(*) from ml where not ({_IS_TEST}))::bigint as n_train, (select count(*) from ml where {_IS_TEST})::bigint as n_test,
  (select count(*) from ml where {_IS_TEST} and sla_breach = 1)::bigint as n_positive, 1::bigint as above_floor, 1::bigint as improved"""
ORACLE["svm_exact"] = _SIDES + ", 0::bigint as violators, 0::bigint as out_of_bounds, 1::bigint as balanced"
ORACLE["network_trained"] = _SIDES + ", 1::bigint as ended"

_WIDE = [*domain.CATEGORICAL, "customer_id", "agent_id"]
_PAIRS = " union all ".join(f"select ticket_id, {i} as place, {c}::varchar as value from clean where {c} is not null" for i, c in enumerate(_WIDE))
ORACLE["onehot_sparse"] = _W_CLEAN + f""", pairs as ({_PAIRS}),
  known as (select place, value, row_number() over (order by place, value) - 1 as index from (select distinct place, value from pairs)),
  ones as (select ticket_id, string_agg(index::varchar, ',' order by index) as indices from pairs p join known k on p.place = k.place and p.value = k.value group by 1)
  select c.ticket_id, coalesce(indices, '') as indices from clean c left join ones o on c.ticket_id = o.ticket_id"""
ORACLE["stream_daily_final"] = """select strftime(ts, '%Y-%m-%d') as day, event_type, count(*)::bigint as n_rows, count(*) filter (value > 10)::bigint as n_flagged,
  1::bigint as told_once, (ts::date < (select max(ts)::date - 2 from events))::bigint as closed from events group by strftime(ts, '%Y-%m-%d'), event_type, ts::date"""

from deskmeter import oracle_io  # noqa: E402

ORACLE.update(oracle_io.ORACLE)
