"""Column names, classes and label rules of the flow record."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

LABEL = "Label"

# The 78 features of a flow record, in file order. Two raw headers
# share one name; the suffixes 34 and 55 are the positions Spark's CSV reader appends.
FEATURES = [
    "Destination Port",
    "Flow Duration",
    "Total Fwd Packets",
    "Total Backward Packets",
    "Total Length of Fwd Packets",
    "Total Length of Bwd Packets",
    "Fwd Packet Length Max",
    "Fwd Packet Length Min",
    "Fwd Packet Length Mean",
    "Fwd Packet Length Std",
    "Bwd Packet Length Max",
    "Bwd Packet Length Min",
    "Bwd Packet Length Mean",
    "Bwd Packet Length Std",
    "Flow Bytes/s",
    "Flow Packets/s",
    "Flow IAT Mean",
    "Flow IAT Std",
    "Flow IAT Max",
    "Flow IAT Min",
    "Fwd IAT Total",
    "Fwd IAT Mean",
    "Fwd IAT Std",
    "Fwd IAT Max",
    "Fwd IAT Min",
    "Bwd IAT Total",
    "Bwd IAT Mean",
    "Bwd IAT Std",
    "Bwd IAT Max",
    "Bwd IAT Min",
    "Fwd PSH Flags",
    "Bwd PSH Flags",
    "Fwd URG Flags",
    "Bwd URG Flags",
    "Fwd Header Length34",
    "Bwd Header Length",
    "Fwd Packets/s",
    "Bwd Packets/s",
    "Min Packet Length",
    "Max Packet Length",
    "Packet Length Mean",
    "Packet Length Std",
    "Packet Length Variance",
    "FIN Flag Count",
    "SYN Flag Count",
    "RST Flag Count",
    "PSH Flag Count",
    "ACK Flag Count",
    "URG Flag Count",
    "CWE Flag Count",
    "ECE Flag Count",
    "Down/Up Ratio",
    "Average Packet Size",
    "Avg Fwd Segment Size",
    "Avg Bwd Segment Size",
    "Fwd Header Length55",
    "Fwd Avg Bytes/Bulk",
    "Fwd Avg Packets/Bulk",
    "Fwd Avg Bulk Rate",
    "Bwd Avg Bytes/Bulk",
    "Bwd Avg Packets/Bulk",
    "Bwd Avg Bulk Rate",
    "Subflow Fwd Packets",
    "Subflow Fwd Bytes",
    "Subflow Bwd Packets",
    "Subflow Bwd Bytes",
    "Init_Win_bytes_forward",
    "Init_Win_bytes_backward",
    "act_data_pkt_fwd",
    "min_seg_size_forward",
    "Active Mean",
    "Active Std",
    "Active Max",
    "Active Min",
    "Idle Mean",
    "Idle Std",
    "Idle Max",
    "Idle Min",
]

# The label rules, first match wins (LIKE patterns, case-sensitive).
LABEL_RULES = [
    ("BENIGN%", "BENIGN"),
    ("%DDoS%", "DDoS"),
    ("%PortScan%", "PortScan"),
    ("%Heartbleed%", "Heartbleed"),
    ("%DoS%", "DoS"),
    ("%Web Attack%", "WebAttack"),
    ("%XSS%", "WebAttack"),
    ("%SQL Injection%", "WebAttack"),
    ("%Brute Force%", "WebAttack"),
    ("%FTP-Patator%", "BruteForce"),
    ("%SSH-Patator%", "BruteForce"),
    ("%Bot%", "BotNet"),
]
DEFAULT_CLASS = "BENIGN"

# What the training set leaves out, keeps whole and thins.
EXCLUDED_CLASS = "Heartbleed"
RARE_CLASSES = ["WebAttack", "BotNet"]
COMMON_FRACTION = 0.1

# The short literal decoding list, for callers that want its exact answers
# in place of the fitted model's own labels.
LITERAL_DECODE_LABELS = ["BENIGN", "DoS", "WebAttack", "BruteForce", "BotNet", "DDoS"]
UNKNOWN_CLASS = "Unknown"

# Features shown next to a prediction, and those of the stream probe.
DASHBOARD_FEATURES = [
    "Destination Port",
    "Flow Duration",
    "Flow Bytes/s",
    "Flow Packets/s",
    "Total Fwd Packets",
    "Total Backward Packets",
]
PROBE_FEATURES = ["Destination Port", "Flow Duration", "Flow Bytes/s"]

PREDICTED = "Predicted_Attack"


def string_schema(names: Iterable[str]) -> T.StructType:
    """Nullable STRING fields, the form in which CSV and JSON text is first read."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def flow_schema(
    features: Iterable[str] = FEATURES, label: str | None = LABEL, numeric: bool = False
) -> T.StructType:
    """Fields of a flow file: text, or with ``numeric`` DOUBLE features."""
    kind = T.DoubleType() if numeric else T.StringType()
    fields = [T.StructField(n, kind, True) for n in features]
    return T.StructType([*fields, *(string_schema([label]) if label else [])])


def quoted(name: str) -> str:
    """Back-tick quoted name, safe for spaces, slashes, dots and back-ticks."""
    return "`" + name.replace("`", "``") + "`"
