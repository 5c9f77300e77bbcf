"""Text column functions: normalisation, guarded numeric parsing, OSM parsers, addresses.

All are plain ``Column`` expressions (JVM side, codegen), no Python UDFs.

Regex notes (Java regex under Spark):
* ``$`` also matches before a final newline, so end anchors use ``\\z``;
* ``\\s`` is ASCII only, so whitespace uses an explicit Unicode class that
  matches the White_Space property (what the reference's string strip uses).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values.
# Unicode White_Space characters.
WS = (r"[\t\n\x{0B}\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}"
      r"\x{205F}\x{3000}]")
FT_TO_M = 0.3048
# Characters removed from OSM building:levels before parsing.
LEVELS_NOISE = r"`|''|\+|(PK)|>|±"
# Trailing street-type abbreviations expanded before address normalisation.
TRAILING_SUFFIXES = [("dr", "drive"), ("st", "street"), ("ct", "court"), ("ln", "lane"),
                     ("ave", "avenue"), ("rd", "road")]
# Address dictionaries (our own; long-hand forms in lower case): street types, directions, unit
# designators, and words that open a street name.
STREET_TYPES = {
    "aly": "alley", "ave": "avenue", "av": "avenue", "blvd": "boulevard", "cir": "circle",
    "ct": "court", "cv": "cove", "dr": "drive", "expy": "expressway", "fwy": "freeway",
    "hwy": "highway", "ln": "lane", "lp": "loop", "pkwy": "parkway", "pl": "place",
    "plz": "plaza", "rd": "road", "sq": "square", "st": "street", "ter": "terrace",
    "trl": "trail", "way": "way",
}
DIRECTIONS = {
    "n": "north", "s": "south", "e": "east", "w": "west",
    "ne": "northeast", "nw": "northwest", "se": "southeast", "sw": "southwest",
}
UNITS = {"apt": "apartment", "bldg": "building", "fl": "floor", "rm": "room", "ste": "suite", "unit": "unit", "#": "unit"}
NAME_OPENERS = {"st": "saint", "ft": "fort", "mt": "mount"}
# ---------------------------------------------------------------------------

NUMERIC_RE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
INTEGER_RE = r"^\s*[+-]?\d+\s*$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Remove leading and trailing Unicode whitespace."""
    return F.regexp_replace(_c(c), rf"^{WS}+|{WS}+\z", "")


def normalize_str(c) -> Column:
    """Strip surrounding whitespace, then lowercase."""
    return F.lower(strip_ws(c))


def null_if_empty_str(c) -> Column:
    """T2: '' -> null."""
    return F.nullif(_c(c), F.lit(""))


def concat_str(*cols, sep: str = " ") -> Column:
    """Join with ``sep`` skipping nulls (all null -> '')."""
    return F.concat_ws(sep, *[_c(c) for c in cols])


def to_double(c) -> Column:
    """M1: lenient cast to double; anything but a plain decimal number -> null.

    Spark's own cast would accept Java suffixes ('10f') and the reference's
    would reject surrounding spaces; this accepts surrounding spaces only (Q6).
    """
    c = _c(c)
    return F.when(c.rlike(NUMERIC_RE), strip_ws(c).try_cast("double"))


def to_int(c) -> Column:
    """M1: lenient cast to int; only optional sign and digits (Q5: '3.0' -> null)."""
    c = _c(c)
    return F.when(c.rlike(INTEGER_RE), strip_ws(c).try_cast("int"))


def parse_height(h) -> Column:
    """C4h: OSM ``height`` text -> metres.

    Ordered rules: '0'/'0.0' -> null; has ';' -> max of the numeric parts;
    has 'ft' -> feet (Q2: the documented meaning, metres, is built);
    has 'm' -> drop the first 'm' (Q3: '10 meters' -> null); ends with "'" ->
    feet; else a number. Negative -> null.
    """
    h = _c(h)
    v = (F.when(h.isin("0", "0.0"), F.lit(None).cast("double"))
         .when(h.contains(";"), F.array_max(F.transform(F.split(h, ";"), lambda x: to_double(x))))
         .when(h.contains("ft"), to_double(strip_ws(F.regexp_replace(h, r"ft\.?", ""))) * FT_TO_M)
         .when(h.contains("m"), to_double(strip_ws(F.regexp_replace(h, r"^([^m]*)m", "$1"))))
         .when(h.endswith("'"), to_double(strip_ws(F.regexp_replace(h, r"'\z", ""))) * FT_TO_M)
         .otherwise(to_double(strip_ws(h))))
    return F.when(v < 0, F.lit(None).cast("double")).otherwise(v)


def parse_levels(levels, classification) -> Column:
    """C4l: OSM ``building:levels`` text -> int.

    Noise characters are removed first (Q1: '>' is removed). Ordered rules:
    '0'/'Default' -> null; 'Bi-Level'/'Split' -> 2; ',' for a school -> null;
    '.5' -> integer part + 1; '1/2' -> number + 1; ',' -> number of parts;
    ';' -> max part; '-' -> max part (Q4: '-1' -> 1); else an integer
    ('3.0' -> null, Q5). Above 110 -> null.
    """
    lv = F.regexp_replace(_c(levels), LEVELS_NOISE, "")
    cls = _c(classification)
    v = (F.when(lv.isin("0", "Default"), F.lit(None).cast("int"))
         .when(lv.isin("Bi-Level", "Split"), F.lit(2))
         .when(lv.contains(",") & (cls == "school"), F.lit(None).cast("int"))
         .when(lv.contains(".5"), F.try_add(to_int(F.regexp_replace(lv, r"(?s)\.5.*", "")), F.lit(1)))
         .when(lv.rlike("1/2"), F.try_add(to_int(strip_ws(F.regexp_replace(lv, "1/2", ""))), F.lit(1)))
         .when(lv.contains(","), F.size(F.split(lv, ",")).cast("int"))
         .when(lv.contains(";"), F.array_max(F.transform(F.split(lv, ";"), lambda x: to_int(x))))
         .when(lv.contains("-"), F.array_max(F.transform(F.split(lv, "-"), lambda x: to_int(x))))
         .otherwise(to_int(lv)))
    return F.when(v > 110, F.lit(None).cast("int")).otherwise(v)


def expand_trailing_suffix(addr) -> Column:
    """Expand a trailing 'dr', 'st', 'ct', 'ln', 'ave' or 'rd' (one word at the end)."""
    a = _c(addr)
    for short, long_ in TRAILING_SUFFIXES:
        a = F.regexp_replace(a, rf"{WS}+{short}\z", f" {long_}")
    return a


def _let(value, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _words(mapping: dict[str, str]) -> Column:
    """Dictionary as a map column; long-hand forms stand for themselves."""
    both = {v: v for v in mapping.values()} | mapping
    return F.create_map(*[F.lit(x) for kv in sorted(both.items()) for x in kv])


def _part(condition, words: Column) -> Column:
    return F.when(condition, words).otherwise(F.array().cast("array<string>"))


def _street(tokens: Column, then) -> Column:
    """Read a street line from both ends: ``then(words, name)`` gets its long-hand words and its name.

    street = [pre-direction] name [type] [post-direction]. A direction or a type is only one if a name
    is left beside it, so 'E St' is the lettered street 'e street' and 'Ave B' is 'avenue b'; 'St', 'Mt'
    or 'Ft' before another word of the name is part of it ('St Marys Ave': 'saint marys avenue').
    """
    types, dirs, openers = _words(STREET_TYPES), _words(DIRECTIONS), _words(NAME_OPENERS)

    def known(mapping, word):
        return F.try_element_at(mapping, word)

    def head(x):
        return F.try_element_at(x, F.lit(1))

    def last(x):
        return F.try_element_at(x, F.lit(-1))

    def rest(x):
        return F.slice(x, 2, F.size(x))

    def but_last(x):
        return F.slice(x, F.lit(1), F.greatest(F.size(x) - 1, F.lit(0)))

    def ends(x):
        post = (F.size(x) >= 2) & known(dirs, last(x)).isNotNull() & ~((F.size(x) == 2) & known(types, head(x)).isNotNull())
        after = _part(post, F.array(known(dirs, last(x))))
        return _let(F.struct(F.when(post, but_last(x)).otherwise(x).alias("x"), after.alias("after")), typed)

    def typed(v):
        x = v["x"]
        has = (F.size(x) >= 2) & known(types, last(x)).isNotNull()
        kind = _part(has, F.array(known(types, last(x))))
        return _let(F.struct(F.when(has, but_last(x)).otherwise(x).alias("x"), F.concat(kind, v["after"]).alias("after")), led)

    def led(v):
        x = v["x"]
        has = (F.size(x) >= 2) & known(dirs, head(x)).isNotNull()
        before = _part(has, F.array(known(dirs, head(x))))
        return _let(F.struct(F.when(has, rest(x)).otherwise(x).alias("x"), before.alias("before"), v["after"].alias("after")), named)

    def named(v):
        x = v["x"]
        second = F.try_element_at(x, F.lit(2))
        numbered = known(types, head(x)).isNotNull() & second.rlike(r"^([a-z]|[0-9]+[a-z]?)\z")
        first = F.when(numbered, known(types, head(x))).otherwise(F.coalesce(known(openers, head(x)), head(x)))
        name = F.when(F.size(x) >= 2, F.concat(F.array(first), rest(x))).otherwise(x)
        return then(F.concat(v["before"], name, v["after"]), x)

    return _let(tokens, ends)


def normalize_address(addr) -> Column:
    """Normalise a postal address to lower-case long-hand form.

    lowercase -> punctuation to spaces -> trailing street type expanded -> tokens read as

        [building name] [number] street [unit designator, unit]

    with the street as in :func:`_street`. Line 2 starts at the first unit designator that follows a
    word and has a word after it. Words in other places stay as they are. An address that starts
    with a unit designator, or whose street name has no letter, is unusable: null, as is an empty
    result (Q15: lowercase first, trim at the end).
    """
    a = F.regexp_replace(F.regexp_replace(F.lower(_c(addr)), r"[.,;]", " "), "#", " # ")
    a = expand_trailing_suffix(strip_ws(F.regexp_replace(a, rf"{WS}+", " ")))
    units, types = _words(UNITS), _words(STREET_TYPES)
    number = r"^[0-9]+([a-z]|[-/][0-9]+)?\z"

    def lines(t):
        at = F.filter(F.sequence(F.lit(1), F.size(t)), lambda i: (i >= 2) & (i < F.size(t)) & F.try_element_at(units, F.element_at(t, i)).isNotNull())
        cut = F.coalesce(F.try_element_at(at, F.lit(1)), F.size(t) + 1)
        second = F.slice(t, cut, F.size(t))
        unit = F.transform(second, lambda w: F.coalesce(F.try_element_at(units, w), w))
        return _let(F.struct(F.slice(t, F.lit(1), cut - 1).alias("one"), unit.alias("two")), numbers)

    def numbers(v):
        one = v["one"]
        at = F.filter(F.sequence(F.lit(1), F.size(one)), lambda i: (i < F.size(one)) & F.element_at(one, i).rlike(number) & (
            (i == 1) | F.try_element_at(types, F.try_element_at(one, F.greatest(i - 1, F.lit(1)))).isNull()))
        at = F.coalesce(F.try_element_at(at, F.lit(1)), F.lit(0))
        return _let(F.struct(F.slice(one, F.lit(1), at).alias("head"), F.slice(one, at + 1, F.size(one)).alias("street"), v["two"].alias("two")), whole)

    def whole(v):
        def joined(words, name):
            usable = F.array_join(name, " ").rlike("[a-z]") & F.try_element_at(units, F.try_element_at(F.concat(v["head"], name), F.lit(1))).isNull()
            return F.when(usable, F.array_join(F.concat(v["head"], words, v["two"]), " "))
        return _street(v["street"], joined)

    return _let(F.split(a, " "), lines)
