"""Fixed business values of the support desk."""

# --- fixed values: must equal the published data dictionary ---------------
SLA_MINUTES = {"Crítica": 240, "Alta": 480, "Média": 1440, "Baixa": 2880}
PRIORITIES = ["Baixa", "Média", "Alta", "Crítica"]
CATEGORICAL = ["channel", "product", "category", "priority", "customer_tier", "region"]
URGENCY_TERMS = [
    "urgente", "parado", "imediato", "agora", "critico", "nao funciona",
    "perdendo", "prejuizo", "travado", "caiu", "fora do ar", "erro",
    "bloqueado", "reembolso", "cancelar", "insatisfeito", "ja",
]
REFUND_TERMS = ["reembolso", "cobrad"]
CANCEL_TERMS = ["cancel"]
ERROR_TERMS = ["erro", "nao funciona", "defeito"]

TEXT_FEATURES = [
    "body_len", "word_count", "num_question", "num_exclam", "upper_ratio",
    "urgency_hits", "kw_refund", "kw_cancel", "kw_error",
]
LOG_FEATURES = ["n_events", "n_status_changes", "reopened_from_log"]
TICKET_NUMERIC = [
    "backlog_at_creation", "first_response_minutes", "reopened",
    "created_hour", "created_weekday", "created_month",
]
NUMERIC = TICKET_NUMERIC + TEXT_FEATURES + LOG_FEATURES
# known at the decision point; resolution_minutes and csat_score are outcomes
DECISION_COLUMNS = ["ticket_id", *CATEGORICAL, *TICKET_NUMERIC]
TARGET = "sla_breach"

HIGH_RISK = 0.7
MEDIUM_RISK = 0.4
NO_SCORE = "Sem score"
RISK_BANDS = ["Alto", "Médio", "Baixo"]
URGENT_PRIORITIES = ["Alta", "Crítica"]

SEED = 42
TEST_FRACTION = 0.25
NEIGHBOURS = 15
# order in which equal F1 values are resolved
CANDIDATE_MODELS = ["knn_hardcode", "knn_sklearn", "svm", "mlp"]
# ---------------------------------------------------------------------------
