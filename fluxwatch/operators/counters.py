"""Flow records from raw counters, and flow metadata attachment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluxwatch.config import MIN_DURATION_S, NORMAL
from fluxwatch.operators.features import MAX_ROWS


def flow_metrics_from_counters(counters: DataFrame) -> DataFrame:
    """Adds rates, gap (ms) and packet-length columns to per-flow counters.

    Needs ``tx_packets, rx_packets, tx_bytes, rx_bytes, duration_s, delay_sum_s``.
    The spreads are fixed fractions of the means, as counters hold no more.
    """
    given = F.col("duration_s")
    span = F.when(given <= 0, F.lit(MIN_DURATION_S)).otherwise(given)
    sent, got = F.col("tx_packets"), F.col("rx_packets")
    iat = F.when(got > 1, span / (got - 1) * F.lit(1000.0)).otherwise(F.lit(0.0))
    delay = F.when(
        got > 1, F.col("delay_sum_s") / got * F.lit(1000.0) * F.lit(2.0)
    ).otherwise(F.lit(0.0))
    length = F.when(sent > 0, F.col("tx_bytes") / sent).otherwise(F.lit(0.0))
    return counters.withColumns(
        {"flow_duration": span, "flow_iat_mean": iat, "fwd_pkt_len_mean": length}
    ).withColumns(
        {
            "flow_bytes_s": F.col("rx_bytes") / F.col("flow_duration"),
            "flow_packets_s": (got + sent) / F.col("flow_duration"),
            "flow_iat_std": F.col("flow_iat_mean") * F.lit(0.3),
            "flow_iat_max": delay,
            "flow_iat_min": F.col("flow_iat_mean") * F.lit(0.5),
            "fwd_pkt_len_std": F.col("fwd_pkt_len_mean") * F.lit(0.1),
            "fwd_pkt_len_max": F.col("fwd_pkt_len_mean") * F.lit(1.2),
            "fwd_pkt_len_min": F.col("fwd_pkt_len_mean") * F.lit(0.8),
        }
    )


def attach_metadata(
    flows: DataFrame,
    meta: DataFrame,
    on: list[str],
    label: str = "attack_type",
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Left-joins per-key metadata; a flow without any gets the label Normal.

    Of several ``meta`` rows for one key the smallest counts, so no flow is doubled. The size of ``meta`` is not known here, so it is not
    broadcast by hint: Spark does so where its statistics show that it fits. For
    the other case, keys with more than ``max_rows`` flows are split: their flows
    are spread over parts by a hash of the row, and their metadata row is repeated
    for each part. At most (all flows / max_rows) keys are split, which bounds the
    broadcast of their list.
    """
    others = [c for c in meta.columns if c not in on]
    meta = meta.groupBy(*on).agg(F.min(F.struct(*others)).alias("__row")).select(*on, "__row.*")
    sizes = flows.groupBy(*on).agg(F.count("*").alias("__n")).filter(F.col("__n") > max_rows)
    split = F.broadcast(
        sizes.select(
            *[F.col(k).alias(f"__hot_{k}") for k in on],
            F.ceil(F.col("__n") / F.lit(float(max_rows))).alias("__parts"),
        )
    )

    def with_parts(df: DataFrame) -> DataFrame:
        same = [F.col(k) == F.col(f"__hot_{k}") for k in on]
        return df.join(split, same, "left").drop(*[f"__hot_{k}" for k in on])

    parts = F.coalesce(F.col("__parts"), F.lit(1).cast("long"))
    # a missing key matches nothing, so its flows may go anywhere
    lost = F.greatest(*[F.col(k).isNull() for k in on], F.lit(False))
    spread = with_parts(flows).withColumn(
        "__part",
        F.pmod(F.xxhash64(*flows.columns), F.when(lost, F.lit(1024).cast("long")).otherwise(parts)),
    )
    copies = with_parts(meta).withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    joined = spread.drop("__parts").join(copies.drop("__parts"), [*on, "__part"], "left")
    return joined.drop("__part").withColumn(label, F.coalesce(F.col(label), F.lit(NORMAL)))
