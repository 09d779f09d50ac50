"""Word lists, thresholds, tables and formats the results depend on.

Everything here is data. Operators take these as defaults and accept other values
as parameters, so a platform with its own naming passes its own.
"""

# -- fixed values: signal contract -------------------------------------------------
SIGNAL_NAMES = [
    "service_error_rate", "service_latency_p95", "container_resource_usage",
    "application_log_event", "distributed_trace_error_event", "pod_oom_event",
    "service_unhealthy", "queue_backlog", "service_throughput_rps",
    "container_restart_count", "secret_expiry_warning",
    "db_connection_pool_saturation", "cpu", "latency", "mem", "diskio", "socket",
    "workload", "error", "latency-50", "latency-90",
]
LOG_SIGNAL_NAMES = ["application_log_event", "distributed_trace_error_event"]

# signal, hot days, emit delay limit in seconds, events per second per tenant
SIGNAL_LIMITS = [
    ("service_error_rate", 7, 10, 100),
    ("service_latency_p95", 7, 10, 100),
    ("service_throughput_rps", 7, 10, 100),
    ("application_log_event", 14, 5, 200),
    ("distributed_trace_error_event", 14, 5, 150),
    ("container_resource_usage", 7, 15, 50),
    ("pod_oom_event", 14, 5, 10),
    ("container_restart_count", 7, 15, 30),
    ("service_unhealthy", 14, 5, 10),
    ("queue_backlog", 7, 10, 50),
    ("db_connection_pool_saturation", 7, 15, 50),
    ("secret_expiry_warning", 7, 60, 5),
]
COLD_DAYS = 90

# -- fixed values: fault families, in match order ----------------------------------
FAULT_TOKENS = {
    "cpu": ["cpu", "processor", "core"],
    "mem": ["mem", "memory", "oom", "rss", "heap", "container_resource_usage"],
    "disk": ["disk", "diskio", "disk_io", "io", "iops", "fs", "filesystem"],
    "socket": ["socket", "connection", "conn", "fd", "file_descriptor", "tcp"],
    "loss": ["loss", "packet", "error", "error_rate", "unavailable", "reset",
             "refused", "deadline", "no healthy", "dropped"],
    "delay": ["latency", "delay", "p95", "p90", "p99", "timeout", "duration", "slow"],
}
FAULT_WEIGHTS = {"cpu": 1.2, "mem": 2.0, "disk": 3.5, "socket": 5.5, "loss": 3.2, "delay": 0.9}
LOG_EVIDENCE_WEIGHT = 12.0
RANK_EVIDENCE_WEIGHT = 1.5
FAULT_SCORE_MIN = 1.0

# -- fixed values: detection and root-cause parameters ------------------------------
EWMA_ALPHA = 0.1
EWMA_THRESHOLD = 5.0
BASELINE_ROWS = 100
STD_REG_MULTIPLIER = 0.05
STD_REG_ADDITIVE = 0.05
ANALYSIS_BEFORE = 30
ANALYSIS_AFTER = 10
SMOOTHING_ROWS = 15
DEVIATION_ROWS = 30
Z_THRESHOLD = 3.0
Z_CAP = 500.0
CORRELATION_THRESHOLD = 0.4
LOG_WEIGHT_OTHER = 1.0
LOG_WEIGHT_COLOCATED = 3.0
LOG_SCORE_MULTIPLIER = 15.0
RANK_CONFIDENCE = 0.90
SCORE_CONFIDENCE_BASE = 0.70
SCORE_CONFIDENCE_DIVISOR = 200.0
SCORE_CONFIDENCE_MAX = 0.95
NOTHING_FOUND_CONFIDENCE = 0.50
HAZARD = 50
FOREST_TREES = 100
FOREST_SAMPLE = 256
FOREST_MULTIPLIER = 6.0
LOG_ERROR_KEYWORDS = (
    "(error|exception|fail|timeout|exhaust|limit|abort|invalid|refused|conn|crash|oom|kill)"
)
LOG_ERROR_LEVELS = ["error", "warning", "fatal", "warn"]
TEMPLATE_SIMILARITY = 0.4

# -- fixed values: verification thresholds -----------------------------------------
VERIFY_ERROR = 0.05
VERIFY_LATENCY = 0.5
VERIFY_REGRESSION = 0.10

# -- fixed values: alert admission ---------------------------------------------------
ADMITTED_ALERTS = ["PodOOMKilled", "PodCrashLooping", "ServiceStuck", "SQSQueueBacklog"]
ALERT_SIGNAL = {
    "PodOOMKilled": "pod_oom_event",
    "PodCrashLooping": "container_restart_count",
    "ServiceStuck": "service_unhealthy",
}
DEFAULT_ALERT_SIGNAL = "queue_backlog"
# namespace, tenant id, cooldown seconds
NAMESPACES = [
    ("tenant-payment", "00000000-0000-0000-0000-000000000001", 180),
    ("tenant-checkout", "00000000-0000-0000-0000-000000000002", 300),
]
DEFAULT_COOLDOWN = 300
BREAKER_FAILURES = 3
BREAKER_WINDOW = 3600

# -- fixed values: scrub rules, in order (pattern, replacement) ----------------------
SCRUBBED = "[SCRUBBED]"
SCRUB_RULES = [
    (r"(?i)\bBearer\s+[A-Za-z0-9\-_]+\.[A-Za-z0-9\-_]+\.[A-Za-z0-9\-_.+/=]*", SCRUBBED),
    (r"(?i)\bBasic\s+[A-Za-z0-9+/=]{8,}", SCRUBBED),
    (r"\b(A[SK]IA|AIDA)[A-Z0-9]{16}\b", SCRUBBED),
    (r"""(?<=[=:"\s])[A-Za-z0-9/+=]{40}(?=["\s,}\]']|$)""", SCRUBBED),
    (r"""(?i)(["']?(?:password|passwd|pwd|secret_?key|api_?key|token|auth_?token)["']?\s*[:=]\s*)"""
     r"""(["']?)([^"'\s,}{)\]]{1,})\2""", "$1$2" + SCRUBBED + "$2"),
    (r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b", SCRUBBED),
    (r"\b(?:\d[ -]*?){13,19}\b", SCRUBBED),
]
SENSITIVE_KEYS = [
    "password", "passwd", "pwd", "secret", "secret_key", "api_key", "apikey", "token",
    "auth_token", "access_token", "refresh_token", "authorization", "credential",
    "credentials", "aws_secret_access_key", "aws_access_key_id", "private_key", "ssh_key",
]

# -- fixed values: log masks, in order ------------------------------------------------
LOG_MASKS = [
    (r"\d+\.\d+\.\d+\.\d+", "<IP>"),
    (r"[a-fA-F0-9]{8}-[a-fA-F0-9]{4}-[a-fA-F0-9]{4}-[a-fA-F0-9]{4}-[a-fA-F0-9]{12}", "<UUID>"),
    (r"\d+", "<NUM>"),
]

# -- fixed values: source conventions --------------------------------------------------
SERVICE_LABEL_KEYS = ["app.kubernetes.io/name", "app", "service", "k8s-app"]
POD_SUFFIX = r"-[a-f0-9]{8,10}-[a-z0-9]{5}$"
WORKLOAD_PATTERN = r"^(.+)-[a-z0-9]{5,10}-[a-z0-9]{5}$"
SLICE_BEFORE, SLICE_AFTER = 120, 30  # seconds around an inject time
RUN_FILES = ["inject_time.txt", "metrics.csv", "simple_metrics.csv", "logs.csv"]
FAULT_CONTRACT_SIGNAL = {
    "cpu": "container_resource_usage", "mem": "container_resource_usage",
    "delay": "service_latency_p95", "loss": "service_error_rate",
    "socket": "db_connection_pool_saturation", "disk": "container_resource_usage",
}
SAMPLE_FAULTS = ["cpu", "mem", "delay", "loss", "disk", "socket"]

# -- fixed values: runbooks ------------------------------------------------------------
FAULT_RUNBOOK = {
    "cpu": "CPUSaturationRecoveryRunbook",
    "mem": "MemoryLeakRecoveryRunbook",
    "delay": "NetworkLatencyRecoveryRunbook",
    "loss": "PacketLossRecoveryRunbook",
    "disk": "DiskIORecoveryRunbook",
    "socket": "SocketExhaustionRecoveryRunbook",
}
DEFAULT_RUNBOOK = "DefaultRecoveryRunbook"
# name, action, params, success conditions; pattern "urgent", one step, 25 % impact,
# 0.20 error rate and a 120 s verify window throughout
RUNBOOKS = [
    ("CPUSaturationRecoveryRunbook", "SCALE_REPLICAS", {"replicas": "3"}, ["pod_ready == true"]),
    ("MemoryLeakRecoveryRunbook", "PATCH_MEMORY_LIMIT",
     {"container": "main", "memory_request_mb": "512", "memory_limit_mb": "1024"},
     ["pod_ready == true", "restart_count_no_increase == true"]),
    ("NetworkLatencyRecoveryRunbook", "RESTART_DEPLOYMENT", {"grace_period_seconds": "30"},
     ["pod_ready == true", "service_latency_p95 < 200.0"]),
    ("PacketLossRecoveryRunbook", "RESTART_DEPLOYMENT", {"grace_period_seconds": "30"},
     ["pod_ready == true", "service_error_rate < 0.01"]),
    ("DiskIORecoveryRunbook", "RESTART_DEPLOYMENT", {"grace_period_seconds": "30"}, ["pod_ready == true"]),
    ("SocketExhaustionRecoveryRunbook", "SCALE_REPLICAS", {"replicas": "3"}, ["pod_ready == true"]),
    ("DefaultRecoveryRunbook", "RESTART_DEPLOYMENT", {"grace_period_seconds": "30"}, ["pod_ready == true"]),
]
TARGET_TEMPLATE = "deployment/{{target_service}}"
MAX_POD_IMPACT_PCT = 25
BREAKER_ERROR_RATE = 0.20
VERIFY_WINDOW_SECONDS = 120
SUPPRESSED_RUNBOOK = "CorrelatedSymptomSuppression"
SUPPRESSED_VERIFY_SECONDS = 10

# -- fixed values: decision contract ----------------------------------------------------
DECISION_KEYS = [
    "detect_assessment", "corrected_anomaly_context", "matched_runbook", "pattern_type",
    "action_plan", "blast_radius_config", "verify_policy",
]
PATTERN_TYPES = ["urgent", "deferred"]
ACTIONS = ["RESTART_DEPLOYMENT", "PATCH_MEMORY_LIMIT", "SCALE_REPLICAS", "ROLLOUT_UNDO", "ROTATE_SECRET"]
NEXT_ACTIONS = ["DONE", "RETRY", "ROLLBACK", "ESCALATE"]

# -- fixed values: call handling, cost and rollout limits ------------------------------
RETRY_WAITS = [1, 3]
RATE_LIMIT_WAIT = 5
DAILY_COST_CAP = 50.0
COST_WARN_SHARE = 0.8
# provider, dollars per million input tokens, per million output tokens
PROVIDER_RATES = [("openai", 2.5, 10.0), ("anthropic", 3.0, 15.0), ("bedrock", 3.0, 15.0)]
# endpoint, p99 limit in milliseconds
ENDPOINT_P99_MS = [("/v1/detect", 800), ("/v1/decide", 3000), ("/v1/verify", 1000)]
MAX_5XX_RATE = 0.01
# tier, alerts per minute
TIER_LIMITS = [("pro", 30), ("basic", 10)]
# lane, seconds from alert to outcome; share of incidents resolved without a person
LANE_SECONDS = [("fast", 15), ("slow", 120)]
AUTO_RESOLVED_SHARE = 0.60
HISTOGRAM_BOUNDS = [0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0]

# -- fixed values: sentences of verdicts, suppressions, verification and escalation ------
RANK_REASON = ("Diagnosed %s (%s) as root cause from aggregated fault evidence led by '%s' (z=%.1f, scores=%s). "
               "Top candidates: %s.")
SCORE_REASON = "Anomaly in %s (%s). Metric '%s' deviated significantly by %.1f standard deviations from the baseline."
SCORE_LOG_REASON = "Anomaly in %s (%s). Metric '%s' deviated by %.1f std devs. Metric '%s' correlates (r=%.2f) with error log: '%s'."
SCORE_PLAIN_REASON = "Anomaly detected in %s (%s) due to combined metric deviations and log correlation."
NO_CAUSE_REASON = "No strong metric deviation or log correlation found. Defaulting to %s cpu."
NO_ANOMALY_REASON = "No anomalies detected in the active telemetry window."
CORRELATED_PREFIX = "[CORRELATED ALERT] "
SYMPTOM_SUPPRESSED = "correlated downstream symptom of upstream %s"
DUPLICATE_SUPPRESSED = "duplicate alert for root-cause (already decided)"
HIGH_ERROR = "High error rate detected: %s = %s"
HIGH_LATENCY = "High latency detected: %s = %s"
OTHER_REGRESSION = "Regression detected in other service '%s': %s = %s"
ACTION_FAILED = "Healing action '%s' on '%s' failed to execute."
ACTION_CLEAN = "Target service recovered successfully without any regressions."
ACTION_REGRESSED = "Healing action caused regression: %s"
ACTION_UNRECOVERED = "Target service failed to recover: %s"
BREAKER_ESCALATION = ("The service '%s' in namespace '%s' has failed automatic self-healing %s times within 1 hour. "
                      "All automated healing actions for this service are suspended.")
