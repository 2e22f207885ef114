"""Column expressions over one log row. All of them stay in generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Message patterns, in the order they are applied.
UUID = r"\b[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\b"
HEX = r"0x[0-9a-fA-F]+"
IP = r"\b\d{1,3}(\.\d{1,3}){3}(:\d+)?\b"
NUMBER = r"\b\d+\b"

# Class-name endings that identify an error type.
ERROR_SUFFIXES = (
    "Error", "Exception", "Timeout", "Failure", "Refused", "Denied", "Overflow", "Violation",
)

# Level names and their canonical form, lowest severity first.
LEVELS = ("debug", "info", "warn", "error", "fatal")
LEVEL_ALIASES = {
    "info": "info", "warn": "warn", "warning": "warn", "error": "error",
    "debug": "debug", "fatal": "fatal", "critical": "fatal",
}
WARN_RANK = LEVELS.index("warn")
ERROR_RANK = LEVELS.index("error")

# Whitespace in the sense of a Unicode-aware text library: Java's \s under (?U)
# lacks the four ASCII separators.
SPACE = r"[\s\x1c-\x1f]"


def unicode_aware(pattern: str) -> str:
    return "(?U)" + pattern


def strip(col: Column) -> Column:
    return F.regexp_replace(col, unicode_aware(rf"^{SPACE}+|{SPACE}+$"), "")


def normalize_message(message: Column) -> Column:
    """Template of a message: dynamic parts become placeholders."""
    steps = ((UUID, "<UUID>"), (HEX, "<HEX_ADDR>"), (IP, "<IP>"), (NUMBER, "<NUM>"))
    return reduce(
        lambda text, step: F.regexp_replace(text, unicode_aware(step[0]), step[1]), steps, message
    )


def normalize_for_dedup(message: Column) -> Column:
    """Grouping key under which messages count as the same line."""
    bare = reduce(
        lambda text, pattern: F.regexp_replace(text, unicode_aware(pattern), ""),
        (UUID, HEX, NUMBER),
        strip(F.lower(message)),
    )
    return strip(F.regexp_replace(bare, unicode_aware(f"{SPACE}+"), " "))


def normalize_level(raw: Column) -> Column:
    """Canonical level, or NULL for anything unknown."""

    def lookup(name: Column) -> Column:
        return F.coalesce(*[
            F.when(name.isin([a for a, target in LEVEL_ALIASES.items() if target == level]), level)
            for level in LEVELS
        ])

    # The regex only runs for the few values that need trimming.
    return F.coalesce(lookup(F.lower(raw)), lookup(F.lower(strip(raw))))


def level_rank(level: Column) -> Column:
    """Position in ``LEVELS``; NULL for an unknown level."""
    place = F.array_position(F.array(*map(F.lit, LEVELS)), level)
    return (F.nullif(place, F.lit(0)) - 1).cast("int")


def level_name(rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in LEVELS]), rank + 1)


def sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def contains_any(lowered: str, keywords) -> Column:
    """True when a lower-case message column contains one of the keywords.

    Takes a column, not an expression: an inlined ``lower`` would run once per
    keyword. Written as SQL because one parsed expression is far quicker to build
    than hundreds of column objects.
    """
    return F.expr(contains_any_sql(lowered, keywords))


def contains_any_sql(lowered: str, keywords) -> str:
    tests = [f"contains({lowered}, {sql_text(k)})" for k in keywords]
    return " OR ".join(["false", *tests])


# Separator of joined keywords; no message keyword contains a control character.
KEYWORD_SEPARATOR = "\x01"


def matched_keywords(lowered: str, keywords) -> Column:
    """Keywords found in a lower-case message, joined in list order; NULL when none.

    A joined string groups and sorts cheaply and stays in generated code.
    """
    return F.expr(matched_keywords_sql(lowered, keywords))


def matched_keywords_sql(lowered: str, keywords) -> str:
    hits = [f"if(contains({lowered}, {sql_text(k)}), {sql_text(k)}, NULL)" for k in keywords]
    joined = f"concat_ws('{KEYWORD_SEPARATOR}', {', '.join(hits or ['NULL'])})"
    return f"CASE WHEN {contains_any_sql(lowered, keywords)} THEN {joined} END"


def split_keywords(joined: Column) -> Column:
    none = F.array().cast("array<string>")
    return F.when(joined != "", F.split(joined, KEYWORD_SEPARATOR)).otherwise(none)


# Where a message has none of these, and its meta not this key, it names no error type.
TYPE_MARKS = (*ERROR_SUFFIXES, ":")
TYPE_KEY = "error_type"


def extract_error_type(message: Column, meta: Column, prefix_chars: int) -> Column:
    """Error class named by a message, or by ``error_type`` in its meta text.

    The text before a leading colon counts up to ``prefix_chars`` characters.

    An empty string means that the text before a leading colon was blank; it
    blocks the meta fallback and counts as no type.
    """
    # Substring tests decide first, so the regexes and the JSON parser only see
    # rows that can match them.
    pattern = rf"\b([A-Z][A-Za-z0-9]*(?:{'|'.join(ERROR_SUFFIXES)}))\b"
    may_name = reduce(lambda a, b: a | b, [F.contains(message, F.lit(x)) for x in ERROR_SUFFIXES])
    named = F.when(
        may_name, F.nullif(F.regexp_extract(message, unicode_aware(pattern), 1), F.lit(""))
    )
    head = strip(F.substring_index(message, ":", 1))
    short = ~F.contains(head, F.lit(" ")) & (F.length(head) <= prefix_chars)
    prefix = F.when(F.contains(message, F.lit(":")), F.when(short, head))
    from_meta = F.when(
        F.contains(meta, F.lit(TYPE_KEY)),
        scalar_text(F.try_variant_get(F.try_parse_json(meta), "$.error_type", "variant")),
    )
    return F.coalesce(named, prefix, from_meta)


def resolve_service(logger: Column, component: Column, project: Column) -> Column:
    def filled(col):
        return F.nullif(col, F.lit(""))

    return F.coalesce(filled(logger), filled(component), filled(project), F.lit("unknown-service"))


def quoted(text: Column) -> Column:
    """A string the way it prints inside a list."""
    body = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for char, escape in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        body = F.replace(body, F.lit(char), F.lit(escape))
    single, double = F.contains(text, F.lit("'")), F.contains(text, F.lit('"'))
    return (
        F.when(~single, F.concat(F.lit("'"), body, F.lit("'")))
        .when(~double, F.concat(F.lit('"'), body, F.lit('"')))
        .otherwise(F.concat(F.lit("'"), F.replace(body, F.lit("'"), F.lit("\\'")), F.lit("'")))
    )


def bracketed(items: Column) -> Column:
    """``['a', 'b']`` for an array of strings."""
    return F.concat(F.lit("["), F.array_join(F.transform(items, quoted), ", "), F.lit("]"))


def scalar_text(value: Column) -> Column:
    """Text of a JSON scalar: ``True`` and ``None``; lists and objects stay JSON."""
    kind = F.schema_of_variant(value)
    text = F.try_variant_get(value, "$", "string")
    return F.when(F.is_variant_null(value), "None").otherwise(
        F.when(kind == "BOOLEAN", F.initcap(text)).otherwise(text)
    )


def python_text(value: Column) -> Column:
    """As ``scalar_text``, with lists written ``['a', 1, True]``.

    Needs a lambda, which leaves generated code; keep it off the per-row path.
    """
    kind = F.schema_of_variant(value)

    def element(item: Column) -> Column:
        is_text = F.schema_of_variant(item) == "STRING"
        return F.when(is_text, quoted(scalar_text(item))).otherwise(scalar_text(item))

    items = F.try_variant_get(value, "$", "array<variant>")
    as_list = F.concat(F.lit("["), F.array_join(F.transform(items, element), ", "), F.lit("]"))
    return F.when(kind.startswith("ARRAY"), as_list).otherwise(scalar_text(value))
