"""Benchmark decontamination by template: find benchmark questions, also re-parameterised.

Numbers, units and names become typed placeholders; what is left is a template. A document is
hit by an item if a run of `run` template tokens (the whole item, if it is shorter) occurs in
both and the values in the run's placeholders map one to one. A word equals itself whether it
was taken for a name or not, so that copies in another case are found; a changed name must
look like a name in both.

Only DataFrame functions are used. A text's template is made by a few regular expressions over
the whole string. As any run of `run` tokens holds a window of `width` tokens that starts at a
multiple of `run - width + 1`, only those windows of documents are hashed; items give all
theirs, so no run is lost. Windows are hashed with names as placeholders and once more with
names as words; an item's first window also with its first word as a name. Windows are joined on the hash, the item side broadcast only if it
was counted to be small. Matches are then aligned by their offset, compared token by token and
checked for slots, on the few documents that have any.

Items of fewer than `LEAST` tokens have too few words for a template. With `short` they are found
by exact copies: all their tokens in a row, in any case. Without it they are not searched, for
callers that drop documents and would lose all that use such a phrase.

Defined results: null and empty texts have no tokens and hit nothing; items without tokens are
in no document; equal items each report their hits; repeated documents report alike; rows with
a null id are left out, as they cannot be named.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.llm.common import checkpointed

RUN, WIDTH = 13, 8
#: Tokens an item needs, and literal tokens a run needs: placeholders alone prove nothing.
LEAST, LITERALS = 6, 6
#: Item windows that may be broadcast, about 30 MB.
BROADCAST_WINDOWS = 1_000_000

NUMBER, NAME, UNIT = "\ue000", "\ue001", "\ue002"
MARKS = f"[{NUMBER}-{UNIT}]"
#: Units that are recognised after a number.
UNITS = (
    "mm", "cm", "dm", "m", "km", "in", "inch", "inches", "ft", "foot", "feet", "yd", "yards", "mi", "miles",
    "mg", "g", "kg", "t", "tons", "oz", "lb", "lbs", "pounds", "ml", "cl", "dl", "l", "liters", "litres", "gallons",
    "s", "sec", "seconds", "min", "minutes", "h", "hours", "days", "weeks", "months", "years",
    "dollars", "cents", "euros", "usd", "eur", "percent", "degrees", "km/h", "mph", "kwh", "kw", "w", "v", "hz",
)
#: Digits that do not continue a word; the look back stands behind the first digit, where it is rarely tried.
NUMBERS = r"\d(?<![\p{L}\p{N}]\d)\d*(?:[.,:/]\d+)*"
INSIDE = r"[\p{L}\p{N}]+(?:(?<=\p{N})[.,:/](?=\p{N})[\p{L}\p{N}]+)*"
BETWEEN = rf"(?:[^\p{{L}}\p{{N}}{NUMBER}-{UNIT}.,:/]|[.,:/](?!\p{{N}})|(?<!\p{{N}})[.,:/])+"


def marked(text: Column) -> Column:
    """Lower-case text with a mark before each number, unit and name.

    A name is a word with a capital inside a sentence: after a letter, digit, comma or semicolon.
    """
    units = "|".join(sorted(UNITS, key=len, reverse=True))
    out = F.regexp_replace(text, NUMBERS, f" {NUMBER}$0")
    out = F.regexp_replace(out, rf"({NUMBER}[\d.,:/]+) ?((?:{units}))(?![\p{{L}}\p{{N}}])", f"$1 {UNIT}$2")
    return F.lower(F.regexp_replace(out, r" (?<=[\p{L}\p{N},;] )(\p{Lu}\p{L}*)", f" {NAME}$1"))


def tokens(marked_text: Column) -> Column:
    """Words with their marks and values."""
    return F.array_remove(F.split(marked_text, BETWEEN), "")


def template(marked_text: Column) -> Column:
    """Words, and bare marks where a value stood; as many as `tokens`."""
    return tokens(F.regexp_replace(marked_text, f"({MARKS}){INSIDE}", "$1"))


def worded(marked_text: Column) -> Column:
    """The template with names as plain words."""
    return template(F.translate(marked_text, NAME, ""))


def name_first(template: Column) -> Column:
    """The template as it is where its first word, if it is one, counts as a name."""
    rest = F.slice(template, 2, F.greatest(F.size(template) - 1, F.lit(0)))
    return F.when(F.get(template, F.lit(0)).rlike(r"^[\p{L}\p{N}]+$"), F.concat(F.array(F.lit(NAME)), rest)).otherwise(template)


def windows(width: int, step: int, *templates: Column) -> Column:
    """By position, hashes of the `width` tokens from every `step`-th position on, of each of
    the equally long `templates`."""
    last = F.size(templates[0]) - width
    starts = F.when(last >= 0, F.sequence(F.lit(0), F.floor(last / step).cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda k: F.array_distinct(F.array(*(F.xxhash64(F.slice(t, k * step + 1, width)) for t in templates))))


def _hits(pairs: DataFrame, run: int) -> DataFrame:
    """Runs of an alignment whose slots map one to one, as long as possible.

    Tokens are compared to one letter each: 1 equal word, n equal name, 2 equal value in another
    slot, s another value in a slot of the same kind, 0 neither. A run may not hold a 0 nor two
    slots of which only the item's or only the document's values are equal; for each position,
    the last one before it that it may not share a run with gives the cuts.
    """
    position = F.sequence(F.greatest(F.lit(0), -F.col("shift")), F.least(F.size("item"), F.size("doc") - F.col("shift")) - 1)

    def compare(i: Column) -> Column:
        a, b = F.get("item", i), F.get("doc", i + F.col("shift"))
        x, y, mark, other = F.translate(a, NAME, ""), F.translate(b, NAME, ""), F.substring(a, 1, 1), F.substring(b, 1, 1)
        slot = mark.between(NUMBER, UNIT)
        code = (
            F.when(x == y, F.when(slot & (mark == other), F.when(mark == NAME, "n").otherwise("2")).otherwise("1"))
            .when(slot & (mark == other), "s").otherwise("0")
        )
        return F.struct(i.alias("at"), code.alias("code"), (slot & (code != "0")).alias("slot"), x.alias("item"), y.alias("doc"))

    aligned = pairs.withColumn("compared", F.transform(position, compare))
    aligned = aligned.withColumn("slots", F.filter("compared", lambda t: t["slot"]))

    def conflict(t: Column) -> Column:
        others = F.filter("slots", lambda o: (o["at"] < t["at"]) & ((o["item"] == t["item"]) != (o["doc"] == t["doc"])))
        return F.when(t["code"] == "0", t["at"]).when(t["slot"], F.coalesce(F.array_max(F.transform(others, lambda o: o["at"])), F.lit(-1))).otherwise(-1)

    # A run ends before each token that shortens it, and at the end of the alignment.
    piece = lambda start, end: F.struct(start.alias("start"), end.alias("end"))
    first, last = F.get("position", F.lit(0)), F.element_at("position", -1)
    none = F.array().cast("array<struct<start:int,end:int>>")
    aligned = aligned.withColumn("position", position)
    state = F.aggregate(
        F.transform("compared", lambda t: F.struct(t["at"].alias("at"), conflict(t).alias("bad"))),
        F.struct(first.alias("start"), none.alias("pieces")),
        lambda acc, t: F.when(
            t["bad"] >= acc["start"],
            F.struct((t["bad"] + 1).alias("start"), F.concat(acc["pieces"], F.array(piece(acc["start"], t["at"]))).alias("pieces")),
        ).otherwise(acc),
        lambda acc: F.concat(acc["pieces"], F.array(piece(acc["start"], last + 1))),
    )
    aligned = aligned.withColumn("first", first).withColumn("run", F.explode(state)).withColumn("n", F.col("run.end") - F.col("run.start"))
    needed = F.least(F.lit(run), F.size("item"))
    aligned = aligned.where(F.col("n") >= needed).withColumn("run_tokens", F.slice("compared", F.col("run.start") - F.col("first") + 1, F.col("n")))
    words = F.size(F.filter("run_tokens", lambda t: t["code"].isin("1", "n")))
    aligned = aligned.where(words >= F.least(F.lit(LITERALS), needed))
    slots = F.transform(F.filter("run_tokens", lambda t: t["slot"]), lambda t: F.struct(t["item"].alias("item"), t["doc"].alias("doc")))
    aligned = aligned.withColumn("slots", F.array_distinct(slots))
    same = F.forall("slots", lambda pair: pair["item"] == pair["doc"])
    return aligned.select(
        "doc_id", "item_id", F.col("n").cast("long").alias("n_matched"), F.size("item").cast("long").alias("n_item"),
        F.size("slots").cast("long").alias("n_slots"), same.alias("same_values"),
        (F.col("run.start") + F.col("shift")).cast("long").alias("first_token"),
    )


def unmarked(marked_text: Column) -> Column:
    """The tokens without their marks."""
    return F.transform(tokens(marked_text), lambda t: F.translate(t, NUMBER + NAME + UNIT, ""))


def _copies(plain: DataFrame, phrases: DataFrame, lengths: list[int]) -> DataFrame:
    """Hits of `phrases` (item_id, phrase, n) in `plain` (doc_id, text): documents that hold all
    tokens of one in a row. `lengths` are the values of n, below LEAST.

    Tokens hold no space, so that the joined words are an exact key. One row per document,
    item and place meets the map-side minimum; a phrase that all documents use costs a row each.
    """
    words = plain.select("doc_id", unmarked(marked(F.col("text"))).alias("words"))

    def places(n: int) -> Column:
        starts = F.when(F.size("words") >= n, F.sequence(F.lit(0), F.size("words") - n)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda k: F.struct(k.alias("at"), F.array_join(F.slice("words", k + 1, n), " ").alias("phrase")))

    spoken = words.select("doc_id", F.explode(F.concat(*map(places, lengths))).alias("place")).select("doc_id", "place.at", "place.phrase")
    found = spoken.join(phrases, "phrase").groupBy("doc_id", "item_id").agg(F.min("at").alias("at"), F.first("n").alias("n"))
    n = F.col("n").cast("long")
    return found.select(
        "doc_id", "item_id", n.alias("n_matched"), n.alias("n_item"), F.lit(0).cast("long").alias("n_slots"),
        F.lit(True).alias("same_values"), F.col("at").cast("long").alias("first_token"),
    )


def contaminated(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id",
                 item_text: str = "text", run: int = RUN, width: int = WIDTH, short: bool = False) -> DataFrame:
    """One row per document and item that share a run: doc_id, item_id, n_matched (tokens of
    the longest such run), n_item, n_slots, same_values (false: re-parameterised), first_token.

    With `short`, items below LEAST tokens are searched as exact copies, which have no slots.
    """
    every = items.where(F.col(item_id).isNotNull()).select(F.col(item_id).alias("item_id"), marked(F.col(item_text)).alias("marked"))
    named = every.select("item_id", tokens(F.col("marked")).alias("item"), template(F.col("marked")).alias("plain"), worded(F.col("marked")).alias("worded"))
    size, long = F.size("item"), F.size("item") >= LEAST
    brief = (size > 0) & ~long
    sizes = named.agg(
        F.min(F.when(long, size)).alias("least"), F.sum(F.when(long, size)).alias("all"),
        F.collect_set(F.when(brief, size)).alias("lengths"), F.count(F.when(brief, size)).alias("brief"),  # LEAST - 1 lengths at most
    ).first()
    named = named.where(long)
    shortest = min(run, sizes["least"] or run)
    width = min(width, shortest)
    step = shortest - width + 1
    ways = (F.col("plain"), F.col("worded"), name_first(F.col("plain")))
    asked = named.select("item_id", F.posexplode(windows(width, 1, *ways)).alias("at", "ways"))
    asked = asked.select("item_id", "at", F.explode("ways").alias("window")).distinct()
    if (sizes["all"] or 0) <= BROADCAST_WINDOWS:
        asked = F.broadcast(asked)
    plain = docs.where(F.col(doc_id).isNotNull() & F.col(text).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    hashed = plain.select("doc_id", F.xxhash64("text").alias("version"), marked(F.col("text")).alias("marked"))
    hashed = hashed.select("doc_id", "version", template(F.col("marked")).alias("plain"), worded(F.col("marked")).alias("worded"))
    hashed = hashed.select("doc_id", "version", F.posexplode(windows(width, step, F.col("plain"), F.col("worded"))).alias("k", "ways"))
    found = hashed.select("doc_id", "version", "k", F.explode("ways").alias("window")).join(asked, "window")
    found = checkpointed(found.select("doc_id", "version", "item_id", (F.col("k") * step - F.col("at")).alias("shift")).distinct())
    # Texts of the documents found: read again, as few of them are needed.
    texts = plain.withColumn("version", F.xxhash64("text")).distinct().join(found.select("doc_id", "version").distinct(), ["doc_id", "version"], "left_semi")
    texts = texts.select("doc_id", "version", tokens(marked(F.col("text"))).alias("doc"))
    pairs = found.join(texts, ["doc_id", "version"]).join(named.select("item_id", "item"), "item_id")
    hits = _hits(pairs, run)
    columns = ["n_matched", "n_item", "n_slots", "same_values", "first_token"]
    longest = F.max_by(F.struct(*columns), F.struct("n_matched", "same_values", -F.col("first_token")))
    hits = hits.groupBy("doc_id", "item_id").agg(longest.alias("best")).select("doc_id", "item_id", "best.*")
    if not short or not sizes["brief"]:
        return hits
    phrases = every.select("item_id", unmarked(F.col("marked")).alias("words"))
    phrases = phrases.where(F.size("words").between(1, LEAST - 1)).select("item_id", F.array_join("words", " ").alias("phrase"), F.size("words").alias("n"))
    if sizes["brief"] <= BROADCAST_WINDOWS:
        phrases = F.broadcast(phrases)
    return hits.unionByName(_copies(plain, phrases, sorted(sizes["lengths"])))
