"""Report line formats, as ``format_string`` expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: report texts that must equal the reference's output. ----
ENTITY_LINE = "[Type=%s] %s: %d apariciones"
TYPE_LINE = "    [%s]: %d"
DESCRIBE_LINE = "[%s] %s"
TOTAL_LINE = "Entidades totales: %d"
PROCESSING_HEADER = "============ ESTADÍSTICAS DE PROCESAMIENTO ============"
ENTITY_HEADER = "============ ENTIDADES NOMBRADAS MÁS FRECUENTES ============"
TYPE_HEADER = "============ ESTADÍSTICAS DE ENTIDADES ============"
TYPE_SUBHEADER = "Entidades por categoría:"
# Processing statistics: (key, label) in report order.
PROCESSING_LABELS = [
    ("feedsSuccess", "Feeds descargados exitosamente"),
    ("feedsFailed", "Feeds fallidos"),
    ("postsSuccess", "Posts descargados exitosamente"),
    ("postsFailed", "Posts fallidos"),
    ("postsFiltered", "Posts filtrados (vacíos/nulos)"),
    ("avgChars", "Largo promedio en posts"),
]
MALFORMED_SUBSCRIPTION_WARNING = "Warning: Skipping malformed subscription (missing 'name' or 'url' field)"
DOWNLOAD_WARNING = "Warning: Failed to download from '%s' (%s)"
PARSE_WARNING = "Warning: Failed to parse JSON from '%s'"
# --- end of fixed values ----------------------------------------------------


def entity_line(entity_type: Column, entity_name: Column, n: Column) -> Column:
    return F.format_string(ENTITY_LINE, entity_type, entity_name, n)


def type_line(entity_type: Column, n: Column) -> Column:
    return F.format_string(TYPE_LINE, entity_type, n)


def describe(entity_type: Column, entity_name: Column) -> Column:
    return F.format_string(DESCRIBE_LINE, entity_type, entity_name)
