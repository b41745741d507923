"""Data-quality checks (Q1-Q4) and the layer gate (Q5).

The declared column tests of the three layers, as Spark jobs: all
not-null / accepted-values / range checks of a layer fold into one
aggregate pass (one scan, partial aggregation); each uniqueness check is one
grouped count. The report has one row per check.

A layer that is written whole is checked as it is written (``Observed``): the
pass over its rows is the write, and only uniqueness scans it again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..config import ACCEPTED_CURRENCIES, AMOUNT_BUCKET_TOP, AMOUNT_BUCKETS, RISK_LABEL_ANOMALY, \
    RISK_LABEL_NORMAL, RISK_LABEL_SUSPICIOUS, RISK_LEVELS, QualityBounds


@dataclass(frozen=True)
class Check:
    column: str
    test: str             # not_null | unique | accepted_values | accepted_range
    values: tuple = ()
    lo: float | None = None
    hi: float | None = None

    def violation(self):
        c = F.col(self.column)
        if self.test == "not_null":
            return c.isNull()
        if self.test == "accepted_values":      # NULL passes
            return c.isNotNull() & ~c.isin(*self.values)
        if self.test == "accepted_range":       # inclusive, NULL passes
            cond = F.lit(False)
            if self.lo is not None:
                cond = cond | (c < self.lo)
            if self.hi is not None:
                cond = cond | (c > self.hi)
            return c.isNotNull() & cond
        raise ValueError(self.test)


def layer_checks(b: QualityBounds = QualityBounds()) -> dict[str, list[Check]]:
    cur = tuple(ACCEPTED_CURRENCIES)
    buckets = tuple(lbl for _, lbl in AMOUNT_BUCKETS) + (AMOUNT_BUCKET_TOP,)
    return {
        "bronze": [
            Check("transaction_id", "not_null"), Check("transaction_id", "unique"),
            Check("card_id", "not_null"),
            Check("amount", "not_null"), Check("amount", "accepted_range", lo=b.min_amount, hi=b.bronze_max_amount),
            Check("currency", "not_null"), Check("currency", "accepted_values", cur),
        ],
        "silver": [
            Check("transaction_id", "not_null"), Check("transaction_id", "unique"),
            Check("card_id", "not_null"), Check("user_id", "not_null"),
            Check("amount", "not_null"), Check("amount", "accepted_range", lo=b.min_amount, hi=b.silver_max_amount),
            Check("currency", "not_null"), Check("currency", "accepted_values", cur),
            Check("amount_bucket", "not_null"), Check("amount_bucket", "accepted_values", buckets),
            Check("tx_hour", "not_null"), Check("tx_hour", "accepted_range", lo=0, hi=23),
            Check("is_high_risk_mcc", "not_null"), Check("is_high_risk_mcc", "accepted_values", (True, False)),
            Check("event_timestamp", "not_null"),
        ],
        "gold": [
            Check("transaction_id", "not_null"), Check("transaction_id", "unique"),
            Check("anomaly_score", "not_null"), Check("anomaly_score", "accepted_range", lo=0, hi=100),
            Check("risk_level", "not_null"), Check("risk_level", "accepted_values", tuple(RISK_LEVELS)),
            Check("risk_label", "not_null"),
            Check("risk_label", "accepted_values", (RISK_LABEL_ANOMALY, RISK_LABEL_SUSPICIOUS, RISK_LABEL_NORMAL)),
            Check("end_to_end_latency_ms", "accepted_range", lo=0, hi=b.latency_max_ms),
        ],
    }


def check_layer(df: DataFrame, layer: str, checks: list[Check]) -> DataFrame:
    """One row per check: layer, column_name, test, violations, passed."""
    rows = []
    scalar = [c for c in checks if c.test != "unique"]
    if scalar:
        agg = df.agg(*[F.count_if(c.violation()).alias(f"c{i}") for i, c in enumerate(scalar)])
        stack = ", ".join(f"'{c.column}', '{c.test}', c{i}" for i, c in enumerate(scalar))
        rows.append(agg.selectExpr(f"stack({len(scalar)}, {stack}) AS (column_name, test, violations)"))
    for c in checks:
        if c.test == "unique":      # dbt semantics: duplicated non-null values
            dup = (df.filter(F.col(c.column).isNotNull()).groupBy(c.column).count()
                     .filter(F.col("count") > 1).agg(F.count(F.lit(1)).alias("violations")))
            rows.append(dup.select(F.lit(c.column).alias("column_name"), F.lit("unique").alias("test"),
                                   "violations"))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.select(F.lit(layer).alias("layer"), "column_name", "test",
                      F.col("violations").cast("bigint").alias("violations"),
                      (F.col("violations") == 0).alias("passed"))


class Observed:
    """The scalar checks of a layer, counted on the rows that a write puts there.

    ``attach`` goes on the plan right before the write, above every shuffle, so the
    counts come from the tasks that write: one that is run again counts once.
    """

    def __init__(self, layer: str, checks: list[Check]):
        self.layer, self.checks = layer, checks
        self.scalar = [c for c in checks if c.test != "unique"]
        self.counts = Observation()

    def attach(self, df: DataFrame) -> DataFrame:
        return df.observe(self.counts, *[F.count_if(c.violation()).alias(f"c{i}") for i, c in enumerate(self.scalar)])

    def report(self, written: DataFrame) -> DataFrame:
        """The rows of ``check_layer``, the scalar ones from the finished write."""
        spark, got = written.sparkSession, self.counts.get
        rows = [(self.layer, c.column, c.test, int(got[f"c{i}"]), got[f"c{i}"] == 0) for i, c in enumerate(self.scalar)]
        out = spark.createDataFrame(rows, "layer string, column_name string, test string, violations bigint, passed boolean")
        unique = [c for c in self.checks if c.test == "unique"]
        return out.unionByName(check_layer(written, self.layer, unique)) if unique else out


def quality_report(layers: dict[str, DataFrame], bounds: QualityBounds = QualityBounds()) -> DataFrame:
    checks = layer_checks(bounds)
    out = None
    for name, df in layers.items():
        r = check_layer(df, name, checks[name])
        out = r if out is None else out.unionByName(r)
    return out


class QualityGateError(RuntimeError):
    pass


def gate(report: DataFrame, layer: str | None = None) -> None:
    """Q5: stop the chain when a layer fails a check (one small action)."""
    r = report if layer is None else report.filter(F.col("layer") == layer)
    failed = r.filter(~F.col("passed")).select("layer", "column_name", "test", "violations").collect()
    if failed:
        raise QualityGateError("; ".join(f"{f.layer}.{f.column_name} {f.test}: {f.violations}" for f in failed))
