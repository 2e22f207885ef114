"""Engine parameters."""

from __future__ import annotations

import os
from dataclasses import dataclass, replace

# Substrings that mark a message as suspicious. Order matters,
# because matches are reported in list order.
SUSPICIOUS_KEYWORDS = (
    "timeout", "timed out", "connection refused", "connection reset",
    "unreachable", "broken pipe", "connection closed", "eof",
    "ssl error", "certificate", "handshake failed",
    "oom", "out of memory", "disk full", "no space",
    "stack overflow", "stackoverflow",
    "deadlock",
    "panic", "segfault", "crash", "fatal",
    "corruption", "corrupted",
    "null pointer", "nullptr", "nullpointerexception",
    "circuit breaker", "rate limit", "quota exceeded",
    "retry", "retrying", "fallback", "degraded",
    "unavailable", "rejected", "denied",
    "forbidden", "unauthorized", "permission denied",
    "failed to", "unable to", "could not", "cannot connect",
)

# The shorter list used when documents are prepared without a gate.
STANDALONE_KEYWORDS = (
    "timeout", "connection refused", "deadlock", "oom",
    "out of memory", "panic", "segfault", "unreachable",
    "failed to", "unable to", "retry", "crash", "fatal",
)

# Substrings that raise the severity score.
CRITICAL_KEYWORDS = (
    "timeout", "deadlock", "oom", "out of memory", "crash",
    "fatal", "panic", "segfault", "corruption", "unreachable",
)

# Environment variable -> parameter.
ENVIRONMENT = {
    "SEVERITY_THRESHOLD": "severity_threshold",
    "DEPLOY_WINDOW_MINUTES": "deploy_window_minutes",
    "COLD_START_BASELINE_COUNT": "cold_start_baseline_count",
    "MAX_SEMANTIC_CHARS": "max_semantic_chars",
    "FETCH_BATCH_SIZE": "fetch_batch_size",
    "FETCH_INTERVAL_MINUTES": "fetch_interval_minutes",
    "POISON_PILL_MAX_FAILURES": "poison_pill_max_failures",
    "CIRCUIT_BREAKER_THRESHOLD": "circuit_breaker_threshold",
}


@dataclass(frozen=True)
class EngineConfig:
    severity_threshold: int = 7
    deploy_window_minutes: int = 60
    cold_start_baseline_count: int = 3
    suspicious_keywords: tuple[str, ...] = SUSPICIOUS_KEYWORDS
    critical_keywords: tuple[str, ...] = CRITICAL_KEYWORDS
    #: Characters a document's text is cut at; None keeps the whole text.
    max_semantic_chars: int | None = None
    #: Lists in meta with more values than this stay out of the text; None admits all.
    max_listed_values: int | None = None
    #: Text before a colon names an error type up to this length; longer text is prose.
    error_prefix_chars: int = 50
    fetch_batch_size: int = 1000
    fetch_interval_minutes: int = 5
    poison_pill_max_failures: int = 3
    circuit_breaker_threshold: int = 3
    vector_size: int = 384
    #: Texts that a model is given at a time.
    embed_batch: int = 64
    #: Where only texts are made, a trace with more characters of lines than this has them as
    #: numbered pieces alone; None keeps every text whole. Documents are always whole.
    whole_text_chars: int | None = None
    #: Deployment windows count from the latest commit before the trace, not before the batch's time.
    deploy_as_of_trace: bool = False
    #: The same correlation ID in two projects is two traces.
    group_by_project: bool = False
    tag_levels: bool = False

    def __post_init__(self):
        if self.cold_start_baseline_count < 1:
            raise ValueError("cold_start_baseline_count must be at least 1")
        if self.max_semantic_chars is not None and self.max_semantic_chars < 1:
            raise ValueError("max_semantic_chars must be at least 1")

    @classmethod
    def from_env(cls, env=os.environ) -> "EngineConfig":
        return cls(**{field: int(env[name]) for name, field in ENVIRONMENT.items() if name in env})

    @classmethod
    def standalone(cls) -> "EngineConfig":
        """Parameters of the gate-free mode that only prepares documents."""
        return replace(cls(), suspicious_keywords=STANDALONE_KEYWORDS)

    @property
    def deploy_window_seconds(self) -> int:
        return self.deploy_window_minutes * 60
