"""Column expressions that assemble the text of a trace document."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracemill.functions.messages import strip

# Wording of the text layers.
UNNAMED_OPERATION = "Trace executed"
CONTEXT_LABEL = "Context: "
FLOW_LABEL = "Flow: "
SERVICE_LABEL = "Service: "
OUTCOME_LABEL = "Outcome: "
FLOW_ARROW = " → "
LAYER_SEPARATOR = ". "
ENTRY_SEPARATOR = "; "
ELLIPSIS = "..."


def http_operation(method: Column, pattern: Column, path: Column, duration_ms: Column) -> Column:
    target = F.coalesce(pattern, path, F.lit(""))
    return F.when(method != "", strip(F.concat_ws(" ", method, target))).when(
        duration_ms.isNotNull(), UNNAMED_OPERATION
    )


def context_line(entries: Column) -> Column:
    return F.when(F.size(entries) > 0, F.concat(F.lit(CONTEXT_LABEL), F.array_join(entries, ENTRY_SEPARATOR)))


def service_flow(services: Column) -> Column:
    return F.when(
        F.size(services) > 1, F.concat(F.lit(FLOW_LABEL), F.array_join(services, FLOW_ARROW))
    ).when(F.size(services) == 1, F.concat(F.lit(SERVICE_LABEL), F.element_at(services, 1)))


def outcome_line(outcome: Column, status: Column, duration_ms: Column) -> Column:
    words = F.nullif(F.replace(outcome, F.lit("_"), F.lit(" ")), F.lit(""))
    took = F.concat(duration_ms.cast("string"), F.lit("ms"))
    listed = F.concat_ws(", ", words, status.cast("string"), took)
    return F.when(listed != "", F.concat(F.lit(OUTCOME_LABEL), listed))


def assemble(layers: list[Column], max_chars: int | None) -> Column:
    """Join the non-NULL layers; array layers contribute each of their items."""
    text = F.concat_ws(LAYER_SEPARATOR, *layers)
    if max_chars is None:
        return text
    cut = F.concat(F.substring(text, 1, max_chars), F.lit(ELLIPSIS))
    return F.when(F.length(text) > max_chars, cut).otherwise(text)
