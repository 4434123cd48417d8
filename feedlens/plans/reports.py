"""Report sinks (K2, K3, K4) as small DataFrames of lines.

Numbers stay distributed until here; each report has a fixed, small number
of rows (6, 7, or k), so only those rows ever reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions import formatting as fmt
from feedlens.operators.stats import STAT_COLUMNS


def processing_stats_lines(stats: DataFrame) -> DataFrame:
    """K2: ``(ordinal, metric, value, line)``, six rows from the one-row stats."""
    parts = []
    for i, ((key, label), col) in enumerate(zip(fmt.PROCESSING_LABELS, STAT_COLUMNS)):
        parts += [str(i + 1), f"'{key}'", f"'{label}'", f"cast({col} as bigint)"]
    stacked = stats.selectExpr(f"stack({len(STAT_COLUMNS)}, {', '.join(parts)}) as (ordinal, metric, label, value)")
    return stacked.select(
        F.col("ordinal").cast("int").alias("ordinal"),
        "metric",
        "value",
        F.format_string("%s: %d", F.col("label"), F.col("value")).alias("line"),
    )


def render_processing_stats(row: dict) -> str:
    """K2 text from the one collected statistics row (same lines as
    ``processing_stats_lines``)."""
    lines = [f"{label}: {int(row[col])}" for (_, label), col in zip(fmt.PROCESSING_LABELS, STAT_COLUMNS)]
    return fmt.PROCESSING_HEADER + "\n" + "\n".join(lines)


def entity_lines(top: DataFrame) -> DataFrame:
    """K4 + P6: ``(rank, line)`` for the top-k rows."""
    return top.select("rank", fmt.entity_line(F.col("entity_type"), F.col("entity_name"), F.col("n")).alias("line"))


def type_lines(stats: DataFrame) -> DataFrame:
    """K3 + P7: the total line (ordinal 0) then one line per type."""
    line = F.when(F.col("ordinal") == 0, F.format_string(fmt.TOTAL_LINE, F.col("n"))).otherwise(
        fmt.type_line(F.col("entity_type"), F.col("n"))
    )
    return stats.select("ordinal", line.alias("line"))


def rendered(lines: DataFrame, order: str, header: str, subheader_after: int | None = None) -> DataFrame:
    """One report as one row ``text``: header, newline, then the lines in order joined by
    newlines (so an empty report still ends with the newline after its header)."""
    sorted_lines = F.transform(F.array_sort(F.collect_list(F.struct(order, "line"))), lambda r: r["line"])
    if subheader_after is not None:
        rest = F.slice("lines", subheader_after + 1, F.greatest(F.size("lines"), F.lit(1)))
        body = F.concat(F.slice("lines", 1, subheader_after), F.array(F.lit(fmt.TYPE_SUBHEADER)), rest)
    else:
        body = F.col("lines")
    return lines.agg(sorted_lines.alias("lines")).select(F.concat(F.lit(header + "\n"), F.array_join(body, "\n")).alias("text"))


def render(lines: DataFrame, order: str, header: str, subheader_after: int | None = None) -> str:
    """Text of one report (bounded rows)."""
    return rendered(lines, order, header, subheader_after).first()["text"]
