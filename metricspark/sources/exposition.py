r"""Text exposition dumps to typed samples.

A dump is one row, cut into sections at its ``# TYPE`` lines. Where it has few declarations, its
lines carry them, the latest first, and take the first of their name up to their section, with
expressions that compile. Lines of other dumps are typed *inside the row*: they search the
declarations, sorted by name and place, by halves, so that nothing long is copied to each line. So
the work is one narrow pass over the text: no shuffle of lines, no window, and the order
dependence (the latest *earlier* declaration counts) is exact.

All repeated groups in the patterns are possessive, so that they run as loops and whole
texts of any size cannot overflow the stack of the pattern engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metricspark.functions.labels import label
from metricspark.functions.values import sample_kind, widen
from metricspark.schema import COUNTER, COUNTER_INTEGER, GAUGE

# Per declared kind, the name suffixes it registers and their series types.
FAMILY_TYPES = {
    "counter": (("", COUNTER_INTEGER),),
    "gauge": (("", GAUGE),),
    "summary": (("", COUNTER), ("_count", COUNTER_INTEGER), ("_sum", COUNTER)),
    "histogram": (("_bucket", COUNTER_INTEGER), ("_count", COUNTER_INTEGER), ("_sum", COUNTER)),
}

# Most names that a kind registers.
SLOTS = max(map(len, FAMILY_TYPES.values()))

#: Declarations up to which the lines of a dump carry them all.
CARRIED = 32

# How declaration and help lines begin.
TYPE_PREFIX = "# TYPE "
HELP_PREFIX = "# HELP "

# The characters Unicode counts as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_NEWLINE = r"\r?\n"
# A newline whose line does not end in a backslash.
_UNCONTINUED = r"\r?\n(?<!\\\n)(?<!\\\r\n)"
# One label at the front of the rest: name, =, any opening character, text up to the closing
# quote or the end, then a comma or the end.
_LABEL = (
    r'(?s)\G([^=]++)=.([^"\\]*+(?:\\.[^"\\]*+)*+)'
    r'(?:"(?:,|\z)|\\?\z)'
)
# A line that is no comment and not blank; and a TYPE line with name and kind, if it registers any.
_SAMPLE_LINE = r"(?mdU)^(?!#)[^\S\n]*+\S[^\n]*+"
_DECLARATION = (
    r"(?mdU)^" + TYPE_PREFIX + r"(?:(?:[^\S\n]* )?([^ \n]*\S[^ \n]*) (?:[^\S\n]* )?("
    + "|".join(FAMILY_TYPES) + r")(?= |$))?"
)
_LABELS_DONE = r"(?s)^[^=]*=?\z"


def read_exposition(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Dumps under ``target=…/scrape_ts=…/`` folders, one row per file."""
    reader = spark.readStream if streaming else spark.read
    files = reader.schema("value string, target string, scrape_ts bigint").format("text").option("wholetext", "true")
    return files.load(path).select(
        F.col("_metadata.file_path").alias("doc_id"),
        "target",
        "scrape_ts",
        F.lit("ok").alias("outcome"),
        F.col("value").alias("body"),
    )


def trimmed(text: Column) -> Column:
    """The text without white space around it. Trimming a set of characters is slow, so it is left out
    where a visible ASCII character stands at both ends."""
    plain = (text >= "!") & (text < "\x7f") & F.right(text, F.lit(1)).between("!", "~")
    return F.when(plain, text).otherwise(F.btrim(text, F.lit(WHITE_SPACE)))


def _continued(body: Column) -> Column:
    return body.contains("\\\n") | body.contains("\\\r\n")


def strip_help(body: Column) -> Column:
    """The lines of a dump without help texts.

    A help text goes on while its lines end in a backslash. Only dumps holding such a line
    end are cut into continued blocks; elsewhere help lines are plain comments.
    """
    cut = lambda block: F.regexp_replace(
        block, r"(?s)(^|\n)" + HELP_PREFIX + r".*", "$1"
    )
    blocks = F.transform(F.split(body, _UNCONTINUED), lambda b: F.split(cut(b), _NEWLINE))
    lines = F.when(_continued(body), F.flatten(blocks)).otherwise(F.split(body, _NEWLINE))
    return F.filter(lines, lambda line: ~line.startswith(HELP_PREFIX))


def _type_words(line: Column) -> Column:
    """The words of a TYPE line: the name is the third, the kind the fourth."""
    return F.filter(F.split(line, " "), lambda w: w.rlike(r"(?U)\S"))


def _registered(words: Column) -> Column:
    """The ``struct<name,series_type>`` entries a declaration registers; none for other kinds."""
    name, kind = F.get(words, F.lit(2)), F.get(words, F.lit(3))
    entry = lambda suffix, series_type: F.struct(
        (F.concat(name, F.lit(suffix)) if suffix else name).alias("name"), F.lit(series_type).alias("series_type")
    )
    chosen = F.when(kind.isNull(), None)
    for declared, parts in FAMILY_TYPES.items():
        chosen = chosen.when(kind == declared, F.array(*[entry(s, t) for s, t in parts]))
    return F.coalesce(chosen, F.array().cast("array<struct<name:string,series_type:string>>"))


def _is_sample_line(line: Column) -> Column:
    return ~line.startswith("#") & line.rlike(r"(?U)\S")


def _sample_lines(section: Column) -> Column:
    """The lines of a section for which ``_is_sample_line`` holds, by one run of a pattern."""
    return F.regexp_extract_all(section, F.lit(_SAMPLE_LINE), F.lit(0))


def _declared(docs: DataFrame) -> DataFrame:
    """Add what typing the lines of a dump needs.

    ``sections`` are its sample lines, cut at every TYPE line; the first has no declaration. The
    others are numbered from 1, and ``names`` and ``types`` hold SLOTS entries for each, the last section's
    first: what it registers, null where that is less. Dumps of more than CARRIED
    declarations have ``registry`` instead, ``struct<name,at,series_type>`` sorted by name and section, and
    ``halvings``, as often as its length can be halved.
    """
    body = F.col("body")
    # Elsewhere help lines are plain comments.
    text = F.when(_continued(body), F.array_join(strip_help(body), "\n")).otherwise(F.replace(body, F.lit("\r\n"), F.lit("\n")))
    found = docs.withColumn("text", text).withColumns(
        {
            "sections": F.transform(F.split(F.concat(F.lit("\n"), "text"), r"\n(?=" + TYPE_PREFIX + ")"), _sample_lines),
            "family": F.regexp_extract_all("text", F.lit(_DECLARATION), F.lit(1)),
            "kind": F.regexp_extract_all("text", F.lit(_DECLARATION), F.lit(2)),
        }
    )
    few = F.size("family") <= CARRIED
    slots = F.flatten(F.zip_with("family", "kind", lambda name, kind: F.array(*_slots(name, kind))))
    entry = lambda e, i: F.struct(
        e["name"].alias("name"), F.floor(i / SLOTS).cast("int").alias("at"), e["series_type"].alias("series_type")
    )
    listed = F.transform(slots, lambda e, i: entry(e, i + SLOTS))
    return (
        found.withColumns(
            {
                "latest": F.when(few, F.reverse(slots)),
                "registry": F.when(~few, F.sort_array(F.filter(listed, lambda e: e["name"].isNotNull()))),
            }
        )
        .withColumns(
            {
                "names": F.col("latest.name"),
                "types": F.col("latest.series_type"),
                "halvings": F.length(F.bin(F.size("registry").cast("bigint"))),
            }
        )
        .drop("text", "family", "kind", "latest")
    )


def _slots(name: Column, kind: Column) -> list[Column]:
    """The SLOTS entries ``struct<name,series_type>`` of a declaration, nulls if it registers fewer."""
    slots = []
    for i in range(SLOTS):
        registered = series_type = F.when(F.lit(False), "")
        for declared, parts in FAMILY_TYPES.items():
            if i < len(parts):
                suffix, its_type = parts[i]
                registered = registered.when(kind == declared, F.concat(name, F.lit(suffix)) if suffix else name)
                series_type = series_type.when(kind == declared, its_type)
        slots.append(F.struct(registered.alias("name"), series_type.alias("series_type")))
    return slots


def _first_word(line: Column) -> Column:
    return F.substring_index(F.ltrim(line), " ", 1)


def _head(line: Column) -> Column:
    """Name and labels of a sample line, not trimmed: up to the last ``}``, else the first word."""
    head = F.left(line, F.length(line) - F.length(F.substring_index(line, "}", -1)) - 1)
    return F.when(line.contains("}"), head).otherwise(_first_word(line))


def _name(head: Column) -> Column:
    return F.substring_index(trimmed(head), "{", 1)


def _halved(name: Column, at: Column) -> Column:
    """The series type of the last entry of ``name`` up to section ``at``: the registry's first
    entry above (name, at) is found by halving, and the one before it looked at."""

    def halve(span: Column, _: Column) -> Column:
        low, high = span["low"], span["high"]
        middle = F.shiftright(low + high, 1)
        entry = F.get("registry", middle)
        below = (entry["name"] < name) | ((entry["name"] == name) & (entry["at"] <= at))
        return F.struct(
            F.when((low < high) & below, middle + 1).otherwise(low).alias("low"),
            F.when((low < high) & below, high).otherwise(F.when(low < high, middle).otherwise(high)).alias("high"),
        )

    whole = F.struct(F.lit(0).alias("low"), F.size("registry").alias("high"))
    last = F.aggregate(F.sequence(F.lit(1), F.col("halvings")), whole, halve, lambda s: F.get("registry", s["low"] - 1))
    return F.when(last["name"] == name, last["series_type"])


def _place(name: Column, at: Column) -> Column:
    """Where a name comes first among the few declarations a line carries, counted from 1 behind those of
    later sections than its own; null if nowhere."""
    place = F.array_position(F.slice("names", F.size("names") - SLOTS * at + 1, SLOTS * at), name)
    return F.nullif(place, F.lit(0)).cast("int")


def typed_lines(docs: DataFrame) -> DataFrame:
    """Sample lines with ``line`` (their order in the dump), ``text`` and ``series_type``."""
    keep = [c for c in docs.columns if c != "body"]

    def each(made: Callable[[Column, Column], Column]) -> Column:
        return F.flatten(F.transform("sections", made))

    name = lambda t: _name(_head(t))
    searched = each(lambda lines, at: F.transform(F.transform(lines, name), lambda n: _halved(n, at)))
    lines = F.arrays_zip(
        F.flatten("sections").alias("text"),
        each(lambda lines, at: F.array_repeat(at, F.size(lines))).alias("at"),
        F.when(F.col("registry").isNotNull(), searched).otherwise(F.array().cast("array<string>")).alias("series_type"),
    )
    cut_up = _declared(docs.filter(F.col("body").isNotNull())).select(*keep, "names", "types", F.posexplode(lines).alias("line", "s"))
    # A column for each step, so that the compiled code holds none of them twice.
    named = cut_up.withColumn("head", _head(F.col("s.text"))).withColumn("name", _name(F.col("head")))
    first = F.size("names") - SLOTS * F.col("s.at")
    placed = named.withColumn("place", first + _place(F.col("name"), F.col("s.at")))
    found = F.when(F.col("names").isNull(), F.col("s.series_type")).otherwise(F.get("types", F.col("place") - 1))
    return placed.select(*keep, "line", "s.text", found.alias("series_type"))


def parse_lines(lines: DataFrame, counter_mode: str = "integer") -> DataFrame:
    """Typed lines to samples, plus ``ok``: false for lines to be skipped.

    After a ``}`` everything past the value is the time, so a third word spoils it; in plain
    words a fourth is ignored. The result goes through a one-row ``inline``, over which
    filters are not pushed: they would repeat the parsing.
    """
    if counter_mode not in ("integer", "float"):
        raise ValueError(f"unknown counter_mode {counter_mode!r}")
    text, rest, after = F.col("text"), F.col("rest"), F.col("after")
    braced = text.contains("}")
    behind = F.ltrim(text.substr(F.length(_first_word(text)) + F.length(text) - F.length(F.ltrim(text)) + 1, F.length(text)))
    # A column for each step, so that the compiled code holds none of them twice.
    raw = lines.withColumns({"head": _head(text), "rest": F.when(braced, F.substring_index(text, "}", -1)).otherwise(behind)})
    cut = raw.withColumns({"metric": trimmed(F.col("head")), "rest": F.when(braced, trimmed(rest)).otherwise(rest)})
    spaced = cut.withColumn(
        "after", F.when(rest.contains(" "), F.ltrim(rest.substr(F.instr(rest, " "), F.length(rest))))
    )
    parts = spaced.withColumns(
        {
            "name": F.substring_index("metric", "{", 1),
            "label_text": F.when(
                F.col("metric").contains("{"), F.substring(F.col("metric"), F.instr("metric", "{") + 1, F.length("metric"))
            ),
            "value_text": F.substring_index(rest, " ", 1),
            "ts_text": F.when(braced, after).otherwise(F.nullif(F.substring_index(after, " ", 1), F.lit(""))),
        }
    )
    parts = parts.withColumns({c: trimmed(F.col(c)) for c in ("value_text", "ts_text")})
    integer = F.col("series_type").endswith("Integer") & F.lit(counter_mode == "integer")
    no_labels = F.array().cast("array<struct<key:string,value:string>>")
    ts_text = F.col("ts_text")
    parsed = parts.withColumns(
        {
            "labels": F.when(F.col("label_text").isNull(), no_labels).otherwise(parse_labels(F.col("label_text"))),
            "value": F.when(F.col("series_type").isNotNull(), widen(F.col("value_text"), integer)),
            "own_ts": F.when(ts_text.rlike(r"^[+-]?[0-9]+$"), ts_text.try_cast("bigint")),
        }
    )
    ok = (
        F.col("labels").isNotNull() & F.col("value").isNotNull() & (ts_text.isNull() | F.col("own_ts").isNotNull())
    )
    columns = [*lines.columns, "name", "labels", "value", "own_ts", ok.alias("ok")]
    return parsed.select(F.inline(F.array(F.struct(*columns))))


def _declarations(docs: DataFrame, *columns: str) -> DataFrame:
    """Dumps with ``declared``, their TYPE lines as ``struct<line,words>``."""
    lines = F.filter(strip_help(F.col("body")), lambda line: line.startswith(TYPE_PREFIX))
    worded = F.transform(lines, lambda line, i: F.struct(i.alias("line"), _type_words(line).alias("words")))
    return docs.select(*columns, F.filter(worded, lambda d: F.size(d["words"]) >= 4).alias("declared"))


def metric_types(docs: DataFrame) -> DataFrame:
    """What each dump declares: ``doc_id, name, series_type, family, family_kind``, where
    ``name`` is a registered name and ``family`` the declared one. The last one counts.

    A dump is a row, so its entries are sorted by name and line inside it, and the last of each
    name is kept; nothing is shuffled.
    """

    def entries(d: Column) -> Column:
        return F.transform(
            _registered(d["words"]),
            lambda e: F.struct(
                e["name"].alias("name"), d["line"].alias("line"), e["series_type"].alias("series_type"),
                d["words"][2].alias("family"), d["words"][3].alias("family_kind"),
            ),
        )

    listed = _declarations(docs, "doc_id").select("doc_id", F.sort_array(F.flatten(F.transform("declared", entries))).alias("e"))
    last = F.filter("e", lambda e, i: ~e["name"].eqNullSafe(F.get("e", i + 1)["name"]))
    return listed.select("doc_id", F.inline(last)).drop("line")


def families(docs: DataFrame, *kinds: str) -> DataFrame:
    """Names declared as ``summary`` or ``histogram``, one row per declaration, with their kind."""
    chosen = F.filter("declared", lambda d: d["words"][3].isin(*kinds))
    named = F.transform(chosen, lambda d: F.struct(d["line"].alias("line"), d["words"][2].alias("family"), d["words"][3].alias("kind")))
    return _declarations(docs, "doc_id").select("doc_id", F.inline(named))


def unescape(value: Column) -> Column:
    r"""``\n`` to a newline, any other ``\c`` to ``c``."""
    newlines = F.regexp_replace(value, r"(?s)\G((?:[^\\]|\\[^n])*+)\\n", "$1\n")
    plain = F.regexp_replace(newlines, r"(?s)\\(.)", "$1")
    return F.when(value.contains("\\"), plain).otherwise(value)


def _label_value(tail: Column) -> Column:
    """The text of a label from what follows its opening sign: without the closing quote and
    comma or, where the end came first, without a backslash that escapes nothing.

    A quote or backslash behind an odd number of backslashes is part of the text."""
    shorter = lambda t, n: F.left(t, F.length(t) - n)
    escaped = lambda t: (F.length(t) - F.length(F.rtrim(t, F.lit("\\")))) % 2 == 1
    return (
        F.when(tail.endswith('",') & ~escaped(shorter(tail, 2)), shorter(tail, 2))
        .when(tail.endswith('"') & ~escaped(shorter(tail, 1)), shorter(tail, 1))
        .when(escaped(tail), shorter(tail, 1))
        .otherwise(tail)
    )


def parse_labels(text: Column) -> Column:
    """``k="v",…`` to a label list, null if anything is left over after the labels.

    The pattern runs over the text once; keys, values and the rest follow from what it found. Without
    a backslash, only the closing quote ends a value."""
    found = F.regexp_extract_all(text, F.lit(_LABEL), F.lit(0))

    def pair(part: Column) -> Column:
        key = F.substring_index(part, "=", 1)
        tail = F.substr(part, F.length(key) + 3)
        plain = F.substring_index(tail, '"', 1)
        return label(key, F.when(part.contains("\\"), unescape(_label_value(tail))).otherwise(plain))

    return F.element_at(
        F.transform(
            F.array(found),
            lambda parts: F.when(
                F.substr(text, F.length(F.array_join(parts, "")) + 1).rlike(_LABELS_DONE), F.transform(parts, pair)
            ),
        ),
        1,
    )


def parse_exposition(docs: DataFrame, counter_mode: str = "integer", timestamp_unit: str = "ms") -> DataFrame:
    """Dumps to samples; bad lines are skipped without failing their dump.

    ``own_ts`` is the sample's own time in the dump's unit, ``ts`` the same in seconds (null
    if it has none) and ``time`` the instant to store: its own, else the scrape's.
    """
    return parse_typed(typed_lines(docs), counter_mode, timestamp_unit)


def parse_typed(lines: DataFrame, counter_mode: str = "integer", timestamp_unit: str = "ms") -> DataFrame:
    """Typed lines to samples with their times and kinds, without the lines to be skipped."""
    samples = parse_lines(lines, counter_mode).filter("ok").drop("ok", "text")
    return with_sample_time(samples, timestamp_unit).withColumn("sample_kind", sample_kind(F.col("value")))


def with_sample_time(samples: DataFrame, timestamp_unit: str = "ms") -> DataFrame:
    if timestamp_unit == "ms":
        own = F.timestamp_millis("own_ts")
        seconds = F.floor(F.col("own_ts") / 1000)
    elif timestamp_unit == "s":
        own = F.timestamp_seconds("own_ts")
        seconds = F.col("own_ts")
    else:
        raise ValueError(f"unknown timestamp_unit {timestamp_unit!r}")
    return samples.withColumns(
        {"ts": seconds, "time": F.coalesce(own, F.timestamp_seconds("scrape_ts"))}
    )


def rejected_lines(docs: DataFrame, counter_mode: str = "integer") -> DataFrame:
    """The sample lines a parse skips."""
    return parse_lines(typed_lines(docs), counter_mode).filter("NOT ok").select("doc_id", "line", "text")
