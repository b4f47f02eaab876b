"""Values that have to equal the published ones for results to agree."""

# --- fixed values: rules on instalments and targets ---
FULL_PAYMENT_RATIO = 0.98
MAX_RATIO = 5.0
CURED_MAX_DAYS_PAST_DUE = 15
UNKNOWN_DAYS_PAST_DUE = 999
DEFAULT_HORIZON_DAYS = 60
DEFAULT_MIN_HISTORY = 2
MISSING_CATEGORY = "__MISSING__"
MAX_CATEGORY_LEVELS = 80

# --- fixed values: action labels, priorities, tiers and channels ---
ACTION_AUTO_MESSAGE = "WhatsApp/SMS automático"
ACTION_PRIORITY_CALL = "Llamada prioritaria"
ACTION_CALL_AGREEMENT = "Llamada + propuesta de convenio"
ACTION_AUTO_REMINDER = "Recordatorio automático y monitoreo"
ACTION_SPECIALIST = "Oferta de descuento / gestión especializada"
ACTION_DEFER = "Automatizar y postergar"
ACTION_MANUAL = "Revisar manualmente"
PRIORITY_HIGH, PRIORITY_MEDIUM, PRIORITY_LOW = "Alta", "Media", "Baja"
P_TIERS = ("Baja", "Media", "Alta")
AMOUNT_TIERS = ("Bajo", "Medio", "Alto")
CHANNEL_AUTO, CHANNEL_CALL, CHANNEL_SPECIALIST, CHANNEL_MANUAL = (
    "automatico", "llamada", "especializada", "manual",
)
CHANNEL_PATTERNS = {
    CHANNEL_SPECIALIST: "descuento|especializada|especialista",
    CHANNEL_CALL: "llamada|telef",
    CHANNEL_AUTO: "whatsapp|sms|automático|automatico|monitoreo|postergar|recordatorio",
}
REVIEW_ACTION_PATTERN = "(?i)descuento|especializada"

# --- fixed values: reason texts, in the order they are given ---
REASON_AMOUNT = "monto vencido alto"
REASON_LATE = "historial con alta frecuencia de atraso"
REASON_PARTIAL = "pagos parciales recurrentes"
REASON_RATIO = "deterioro reciente en ratio de pago"
REASON_BUREAU = "señal externa de atraso en bureau"
REASON_POS = "atrasos históricos en POS/CASH"
REASON_CARD = "atrasos históricos en tarjeta"
REASON_DEFAULT = "priorización por valor esperado neto"

# --- fixed values: back-test strategies and fractions ---
TOP_FRACTIONS = (0.05, 0.10, 0.20, 0.30)
STRATEGY_AMOUNT = "Mayor monto vencido"
STRATEGY_DPD = "Mayor DPD"
STRATEGY_P = "Mayor prob. regularización"
STRATEGY_RECOVERY = "Mayor recuperación esperada"
STRATEGY_NET = "Mayor valor neto esperado"
STRATEGY_KIND = "deterministica"
RANDOM_KIND = "aleatoria_simulada"

# --- fixed values: names a model may not use ---
NOT_A_FEATURE = (
    "cured_in_horizon", "recovered_in_horizon", "cured_in_horizon_60d", "recovered_in_horizon_60d",
    "TARGET", "has_future_observation", "credit_id", "customer_id",
    "pay_day", "payment", "days_before_due", "overpay_amount",
)
POLICY_EXCLUDED = (
    "CODE_GENDER", "DAYS_BIRTH", "AGE_YEARS", "CNT_CHILDREN", "CNT_FAM_MEMBERS", "NAME_FAMILY_STATUS",
    "TARGET", "customer_id", "credit_id", "bureau_id", "has_future_observation",
)
IDENTIFIER_PATTERNS = (
    "rut", "dni", "passport", "pasaporte", "nombre", "apellido", "email", "correo", "phone",
    "telefono", "celular", "address", "direccion", "domicilio", "device_id", "ip_address",
)

# --- fixed values: profiling hints and thresholds ---
SENSITIVE_HINTS = ("gender", "birth", "children", "family", "fam_", "name_family_status", "code_gender")
LEAKAGE_HINTS = (
    "target", "future", "horizon", "cured_in_horizon", "recovered_in_horizon",
    "has_future_observation", "prob_", "pred", "score",
)

# --- fixed values: columns of the written portfolio, in their published order, under the names used here ---
OUTPUT_COLUMNS = (
    "customer_id", "credit_id", "instalment_no", "relative_due_day", "amount_due", "days_past_due", "payment_ratio",
    "unpaid_amount", "p_cure", "p_cure_raw", "p_cure_untreated", "amount_pred", "amount_pred_capped",
    "expected_recovery", "baseline_recovery", "incremental_benefit", "action_cost", "expected_net_value", "action",
    "priority", "needs_human_review", "reason_codes", "p_tier", "amount_tier", "cured_in_horizon",
    "recovered_in_horizon", "hist_count", "hist_late_rate", "hist_partial_rate", "hist_dpd_mean", "hist_dpd_max",
    "roll3_late_rate", "roll6_late_rate", "last_dpd", "last_ratio",
)
