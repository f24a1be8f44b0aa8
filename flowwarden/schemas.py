"""Row layouts and fixed dimensions."""

from __future__ import annotations

from pyspark.sql import types as T

# The 39 numeric flow features in model order.
FEATURES = [
    "dur", "spkts", "dpkts", "sbytes", "dbytes", "rate", "sttl", "dttl",
    "sload", "dload", "sloss", "dloss", "sinpkt", "dinpkt", "sjit", "djit",
    "swin", "stcpb", "dtcpb", "dwin", "tcprtt", "synack", "ackdat", "smean",
    "dmean", "trans_depth", "response_body_len", "ct_srv_src", "ct_state_ttl",
    "ct_dst_ltm", "ct_src_dport_ltm", "ct_dst_sport_ltm", "ct_dst_src_ltm",
    "is_ftp_login", "ct_ftp_cmd", "ct_flw_http_mthd", "ct_src_ltm", "ct_srv_dst",
    "is_sm_ips_ports",
]
CATEGORICALS = ["proto", "service", "state"]

# Class ids, names and severities.
ATTACK_TYPES = {
    0: "Normal", 1: "DoS", 2: "Exploits", 3: "Fuzzers", 4: "Generic",
    5: "Reconnaissance", 6: "Shellcode", 7: "Worms", 8: "Backdoors", 9: "Analysis",
}
SEVERITIES = {
    "Normal": "info", "DoS": "high", "Exploits": "high", "Fuzzers": "medium",
    "Generic": "medium", "Reconnaissance": "low", "Shellcode": "high", "Worms": "medium",
    "Backdoors": "high", "Analysis": "low",
}
SEVERITY_LEVELS = ["high", "medium", "low", "info"]
# Both spellings occur in label maps; they must get the same severity.
SEVERITY_ALIASES = {"Backdoor": "high"}

# Training label ids (two spellings share one id).
TRAINING_LABELS = {
    "Normal": 0, "Fuzzers": 1, "Analysis": 2, "Backdoors": 3, "Backdoor": 3, "DoS": 4,
    "Exploits": 5, "Generic": 6, "Reconnaissance": 7, "Shellcode": 8, "Worms": 9,
}

# Category codes used when no fitted index is at hand; unknown values get 0.
CATEGORY_CODES = {
    "proto": {"tcp": 1, "udp": 2, "unas": 3, "arp": 4},
    "service": {"-": 1, "dns": 2, "http": 3, "ftp": 4, "ftp-data": 5, "smtp": 6, "ssh": 7},
    "state": {"FIN": 1, "INT": 2, "CON": 3, "REQ": 4},
}

HIGH_CONFIDENCE = 0.8
RECENT_CAP = 10_000
DEFAULT_SESSION = "local-session"

FLOW_SCHEMA = T.StructType(
    [T.StructField("dur", T.DoubleType())]
    + [T.StructField(c, T.StringType()) for c in CATEGORICALS]
    + [T.StructField(c, T.DoubleType()) for c in FEATURES[1:]]
    + [T.StructField("attack_cat", T.StringType()), T.StructField("label", T.IntegerType())]
)

# A message is a flow record with the source's own key and time, so that a replayed message
# always yields the same alert.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("session_id", T.StringType()),
    ]
    + FLOW_SCHEMA.fields
)

ALERT_SCHEMA = T.StructType(
    [
        T.StructField("session_id", T.StringType()),
        T.StructField("alert_time", T.TimestampType()),
        T.StructField("alert_id", T.StringType()),
        T.StructField("attack_type", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("src_ip", T.StringType()),
        T.StructField("dst_ip", T.StringType()),
        T.StructField("src_port", T.IntegerType()),
        T.StructField("dst_port", T.IntegerType()),
        T.StructField("protocol", T.StringType()),
        T.StructField("binary_prediction", T.IntegerType()),
        T.StructField("binary_probability", T.DoubleType()),
        T.StructField("attack_confidence", T.DoubleType()),
        T.StructField("sbytes", T.LongType()),
        T.StructField("dbytes", T.LongType()),
        T.StructField("rate", T.DoubleType()),
    ]
)
ALERT_KEY = ["session_id", "alert_time", "alert_id"]

SESSION_SCHEMA = T.StructType(
    [
        T.StructField("session_id", T.StringType()),
        T.StructField("dataset", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)
