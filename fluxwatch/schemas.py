"""Explicit schemas. Nothing in the package infers a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "double": T.DoubleType(), "int": T.IntegerType(), "long": T.LongType(), "string": T.StringType(), "boolean": T.BooleanType(),
}


def _struct(ddl: str) -> T.StructType:
    """A flat DDL text as a schema, without a session."""
    fields = (item.split(" ") for item in ddl.split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


# Field names, types and their order are those of the records.

# Packet log: one row per transmitted or received packet.
PACKET = _struct(
    "timestamp_s double, flow_id long, src_ip string, dst_ip string, port int, "
    "packet_size_bytes long, direction string, attack_type string, pqc_enabled int, "
    "kem_handshake_ms double, sig_sign_ms double, sig_verify_ms double"
)

# Flow record as it travels on the topic (unlabelled).
FLOW = _struct(
    "flow_id int, src_ip string, dst_ip string, src_port int, dst_port int, flow_duration double, "
    "total_fwd_packets int, total_bwd_packets int, flow_bytes_s double, flow_packets_s double, "
    "flow_iat_mean double, flow_iat_std double, flow_iat_max double, flow_iat_min double, "
    "fwd_pkt_len_mean double, fwd_pkt_len_std double, fwd_pkt_len_max double, "
    "fwd_pkt_len_min double, pqc_enabled boolean, kem_handshake_ms double, kem_pubkey_bytes int, "
    "kem_ciphertext_bytes int, sig_sign_ms double, sig_verify_ms double, sig_bytes int, "
    "timestamp string"
)

# Flow record with its label, as written for training.
LABELLED_FLOW = _struct(
    "Flow_ID int, Src_IP string, Dst_IP string, Src_Port int, Dst_Port int, Flow_Duration double, "
    "Total_Fwd_Packets int, Total_Bwd_Packets int, Flow_Bytes_s double, Flow_Packets_s double, "
    "Flow_IAT_Mean double, Flow_IAT_Std double, Flow_IAT_Max double, Flow_IAT_Min double, "
    "Fwd_Pkt_Len_Mean double, Fwd_Pkt_Len_Std double, Fwd_Pkt_Len_Max double, "
    "Fwd_Pkt_Len_Min double, PQC_Enabled int, KEM_Handshake_ms double, KEM_PubKey_Bytes int, "
    "KEM_Ciphertext_Bytes int, SIG_Sign_ms double, SIG_Verify_ms double, SIG_Bytes int, "
    "Attack_Type string"
)

# Model input, in the order the vector is assembled.
FEATURES = [
    "Flow_Bytes_s", "Flow_Packets_s",
    "Flow_IAT_Mean", "Flow_IAT_Std", "Flow_IAT_Max", "Flow_IAT_Min",
    "Fwd_Pkt_Len_Mean", "Fwd_Pkt_Len_Std", "Fwd_Pkt_Len_Max", "Fwd_Pkt_Len_Min",
    "Flow_Duration", "Total_Fwd_Packets",
    "KEM_Handshake_ms", "SIG_Sign_ms", "SIG_Verify_ms",
]

# Topic name -> training name, for the model's columns only.
TRAINING_NAMES = {name.lower(): name for name in FEATURES}

_DEFAULTS = {T.StringType(): "", T.BooleanType(): False, T.IntegerType(): 0, T.DoubleType(): 0.0}

# Value a missing field of a decoded flow takes.
FLOW_DEFAULTS = {f.name: _DEFAULTS[f.dataType] for f in FLOW.fields}
