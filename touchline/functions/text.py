"""Text, qualifier and keyword scalars.

Qualifiers are ``array<struct<type: struct<displayName: string>, value: string>>``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.schemas import QUALIFIERS

# The 19 keyword flags of the shot pipeline (output column, literal substring), in order.
SHOT_KEYWORD_FLAGS = [
    ("is_big_chance", "bigchance"),
    ("is_header", "head"),
    ("is_right_foot", "rightfoot"),
    ("is_left_foot", "leftfoot"),
    ("is_penalty", "penalty"),
    ("is_counter_attack", "fastbreak"),
    ("from_corner", "fromcorner"),
    ("is_volley", "volley"),
    ("first_touch", "firsttouch"),
    ("zone_small_box", "smallbox"),
    ("zone_box_centre", "boxcentre"),
    ("zone_out_of_box", "outofbox"),
    ("is_assisted", "assisted"),
    ("is_intentional_assist", "intentionalassist"),
    ("is_individual_play", "individualplay"),
    ("is_regular_play", "regularplay"),
    ("is_set_piece", "setpiece"),
    ("is_direct_freekick", "directfreekick"),
    ("is_throwin_set_piece", "throwinsetpiece"),
]

# The nine flags by regular expression over compact text.
SHOT_REGEX_FLAGS = {
    "is_big_chance": "bigchance", "is_header": "head|headed", "is_right_foot": "rightfoot", "is_left_foot": "leftfoot",
    "is_penalty": "penalty", "is_volley": "volley", "first_touch": "firsttouch", "from_corner": "fromcorner",
    "is_counter": "fastbreak|counterattack|counter"}
# Body part by first matching flag, and shot zone by first matching pattern over compact text.
BODY_PARTS = [("is_header", "Head"), ("is_right_foot", "Right foot"), ("is_left_foot", "Left foot")]
TEXT_ZONES = [("smallbox", "SmallBox"), ("boxcentre|boxcenter|boxleft|boxright", "Box"), ("outofbox", "OutOfBox")]

# Event types that count as a shot on target.
ON_TARGET_TYPES = ["SavedShot", "Goal"]

# Shot type keys and their labels, checked in this order (penalty, header, foot, other).
SHOT_TYPE_LABELS = {"penalty": "Penal", "header": "Cabeza", "foot": "Pie", "other": "Otro"}

# Token pattern and ignored tokens of the qualifier statistics.
TOKEN_PATTERN = "[a-z][a-z0-9_]{2,}"
IGNORED_TOKENS = ["zone", "center", "relatedeventid", "oppositerelatedevent", "goalmouthy", "goalmouthz",
                  "blockedx", "blockedy"]

# Result code map.
RESULT_CODES = {"H": 0, "D": 1, "A": 2}


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def qualifiers_to_text(q: str | Column) -> Column:
    """display name, then the value when it is non-empty, joined by spaces and lower-cased;
    a null list gives the empty string."""
    parts = F.transform(_c(q), lambda x: F.array_compact(F.array(
        F.when(F.length(x["type"]["displayName"]) > 0, x["type"]["displayName"]),
        F.when(F.length(x["value"]) > 0, x["value"]))))
    return F.coalesce(F.lower(F.array_join(F.flatten(parts), " ")), F.lit(""))


def qualifier_names(q: str | Column) -> Column:
    """display names as an array, nulls removed."""
    return F.filter(F.transform(_c(q), lambda x: x["type"]["displayName"]), lambda n: n.isNotNull())


def compact_text(c: str | Column) -> Column:
    """lower-case and drop everything but a-z0-9."""
    return F.regexp_replace(F.lower(F.coalesce(_c(c), F.lit(""))), "[^a-z0-9]+", "")


def keyword_flags(text: str | Column) -> dict[str, Column]:
    """one 0/1 column per literal substring (substring logic on purpose: ``head`` also matches
    longer words, ``setpiece`` matches ``throwinsetpiece``)."""
    t = F.coalesce(_c(text), F.lit(""))
    return {name: t.contains(lit).cast("int") for name, lit in SHOT_KEYWORD_FLAGS}


def regex_flags(text: str | Column, patterns: dict[str, str]) -> dict[str, Column]:
    """0/1 per regex alternation over (compact) text."""
    t = F.coalesce(_c(text), F.lit(""))
    return {name: t.rlike(p).cast("int") for name, p in patterns.items()}


def shot_type_key(penalty: str | Column, header: str | Column, left: str | Column, right: str | Column) -> Column:
    """first matching flag wins."""
    return (F.when(_c(penalty) == 1, F.lit("penalty"))
             .when(_c(header) == 1, F.lit("header"))
             .when((_c(left) == 1) | (_c(right) == 1), F.lit("foot"))
             .otherwise(F.lit("other")))


def body_part(flags: dict[str, Column]) -> Column:
    """body part of the first flag that is set, else ``Other``."""
    out = F.lit("Other")
    for name, value in reversed(BODY_PARTS):
        out = F.when(flags[name] == 1, F.lit(value)).otherwise(out)
    return out


def text_zone(text: str | Column) -> Column:
    """shot zone of the first pattern that compact text matches, else ``Unknown``."""
    out = F.lit("Unknown")
    for pattern, value in reversed(TEXT_ZONES):
        out = F.when(F.coalesce(_c(text), F.lit("")).rlike(pattern), F.lit(value)).otherwise(out)
    return out


def label_map(c: str | Column, mapping: dict, default=None) -> Column:
    """literal lookup through ``create_map``."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    value = F.create_map(*pairs)[_c(c)]
    return value if default is None else F.coalesce(value, F.lit(default))


def in_set(c: str | Column, values) -> Column:
    """F8: membership flag 0/1."""
    return _c(c).isin(list(values)).cast("int")


def token_set(text: str | Column) -> Column:
    """distinct tokens ``[a-z][a-z0-9_]{2,}`` of the lower-cased text, minus the ignored list."""
    toks = F.regexp_extract_all(F.lower(F.coalesce(_c(text), F.lit(""))), F.lit(TOKEN_PATTERN), 0)
    stop = F.array(*[F.lit(s) for s in IGNORED_TOKENS])
    return F.array_except(F.array_distinct(toks), stop)


def date_text(ts: str | Column) -> Column:
    """``yyyy-MM-dd``."""
    return F.date_format(_c(ts), "yyyy-MM-dd")


# The tokens of a literal: strings in either quotes with escapes, names, numbers, blanks, any other
# character; the parts of a string's content; and Python's names with their JSON words.
_TOKEN = r"""(?s)'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+"|[A-Za-z_][A-Za-z_0-9]*+|[-+]?[0-9][0-9_.eE]*+(?:(?<=[eE])[-+][0-9_]++)?|\s++|."""
_PART = r"(?s)\\x[0-9a-fA-F]{2}|\\.|[^\\]++"
_WORDS = {"None": "null", "True": "true", "False": "false", "null": "null", "true": "true", "false": "false"}


def _string_json(token: Column) -> Column:
    """A quoted token as a JSON string: escapes that JSON lacks are rewritten, double quotes are escaped."""
    parts = F.regexp_extract_all(F.substring(token, F.lit(2), F.length(token) - 2), F.lit(_PART), 0)
    return F.concat(F.lit('"'), F.array_join(F.transform(parts, lambda p: (
        F.when(p == "\\'", "'").when(F.startswith(p, F.lit("\\x")), F.concat(F.lit("\\u00"), F.substring(p, 3, 2)))
         .when(F.startswith(p, F.lit("\\")), p).otherwise(F.replace(p, F.lit('"'), F.lit('\\"'))))), ""), F.lit('"'))


def _once(value: Column, use) -> Column:
    """``use(value)``, with the value worked out once however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), 0)


def literal_json(t: Column) -> Column:
    """Python-literal text to JSON text, token by token: what lies inside a string is never taken for anything else.
    Tuples become lists, trailing commas go, JSON's own words pass; other words make the result no JSON."""
    tokens = F.filter(F.regexp_extract_all(t, F.lit(_TOKEN), 0), lambda x: F.trim(F.translate(x, "\n\r\t\f", "    ")) != "")

    def convert(x: Column, follows: Column) -> Column:
        word = F.lit("?")
        for name, json in _WORDS.items():
            word = F.when(x == name, json).otherwise(word)
        number = F.regexp_replace(F.regexp_replace(x, r"^\+|_", ""), r"\.$", ".0")
        closes = F.coalesce(follows, F.lit("")).isin("]", "}", ")")
        return (F.when(x.rlike("""^['"]."""), _string_json(x)).when(x.rlike("^[A-Za-z_]"), word).when(x.rlike("^[-+]?[0-9]"), number)
                 .when(x == "(", "[").when(x == ")", "]").when((x == ",") & closes, "").otherwise(x))

    return _once(tokens, lambda own: F.array_join(F.transform(own, lambda x, i: convert(x, F.get(own, i + 1))), ""))


def literal_items(text: str | Column) -> Column:
    """the items of JSON or, failing that, Python-literal text, as variants: those of a list, or an object alone. Null
    when the text is neither a list nor an object of either kind."""
    def items(parsed: Column) -> Column:
        return _once(F.schema_of_variant(parsed), lambda kind: F.when(F.startswith(kind, F.lit("ARRAY")), F.try_variant_get(parsed, "$", "array<variant>"))
                     .when(F.startswith(kind, F.lit("OBJECT")), F.array(parsed)))

    t = F.trim(_c(text))
    found = [_once(F.try_parse_json(p), items) for p in (t, F.when(t.rlike(r"^[\[{]"), literal_json(t)))]
    return F.coalesce(*found)


def _scalar_text(item: Column) -> Column:
    """Text of an item that is no object, null for one that counts as nothing (empty, zero, false, null)."""
    kind, s = F.schema_of_variant(item), F.try_variant_get(item, "$", "string")
    truth = F.when(kind == "BOOLEAN", F.when(s == "true", "True"))
    return F.when(kind == "BOOLEAN", truth).when(kind.rlike("^(BIGINT|DECIMAL|DOUBLE)") & (s.cast("double") == 0), F.lit(None)).when(s != "", s)


def _is_object(item: Column) -> Column:
    return F.startswith(F.schema_of_variant(item), F.lit("OBJECT"))


def _display_name(item: Column) -> Column:
    name = F.try_variant_get(item, "$.type.displayName", "string")
    return F.when(name != "", name)


def qualifier_items(text: str | Column) -> Column:
    """qualifier text parsed as JSON, else as a Python literal, in the typed form of the qualifier list; null
    when nothing parses."""
    items = F.filter(literal_items(text), _is_object)
    fields = QUALIFIERS.elementType["type"].dataType.fieldNames()
    return F.transform(items, lambda i: F.struct(F.struct(*[F.try_variant_get(i, f"$.type.{f}", "string").alias(f) for f in fields]).alias("type"),
                                                 F.try_variant_get(i, "$.value", "string").alias("value"))).cast(QUALIFIERS)


def qualifier_names_lenient(text: str | Column) -> Column:
    """F2 + F3 on raw text: display names of the parsed items, items that are no objects by their text; unparsable
    non-empty text is one name; null or blank text gives an empty list."""
    t = F.trim(_c(text))
    names = F.transform(literal_items(t), lambda i: F.when(_is_object(i), _display_name(i)).otherwise(_scalar_text(i)))
    return F.when(t.isNull() | (t == ""), F.array().cast("array<string>")).otherwise(F.coalesce(F.array_compact(names), F.array(t)))


def qualifiers_text_lenient(text: str | Column) -> Column:
    """F2 on raw text: lower-case token text of the parsed items (display name, then the value unless
    null or empty); unparsable non-empty text is kept as one token; null or blank gives ""."""
    t = F.trim(_c(text))

    def tokens(i: Column) -> Column:
        value = F.try_variant_get(i, "$.value", "string")
        return F.when(_is_object(i), F.array(_display_name(i), F.when(value != "", value))).otherwise(F.array(_scalar_text(i)))

    parts = F.array_compact(F.flatten(F.transform(literal_items(t), tokens)))
    return F.when(t.isNull() | (t == ""), F.lit("")).otherwise(F.lower(F.coalesce(F.array_join(parts, " "), t)))
