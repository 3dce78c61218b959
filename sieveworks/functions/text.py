"""Tags in text: splitting, the canonical form, assembling prompts, counting and trimming tokens, JSON lines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tags that go first, tags that every prompt has, and what calls for extra negative tags.
QUALITY_TAGS = ("masterpiece", "best quality", "highres", "absurdres", "ultra-detailed")
POSE_TAGS = ("frontal face", "looking at viewer")
FACE_TAGS = ("close-up", "portrait")
DETAILED_EYES = "detailed eyes"
DETAILED_EYE_VALUES = ("heterochromia", "glowing eyes", "sparkling eyes", "empty eyes")
DEFAULT_MAX_LENGTH, SENTINEL_LENGTH = 77, 4096

PLAIN_SPACE = " \t\n\r"
#: What Python's str.strip() takes off.
SPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def strip(text: Column, plain: bool = False) -> Column:
    """Without white space at the ends; plain: only blank, tab, line feed and carriage return, as SQL trims."""
    return F.btrim(text, F.lit(PLAIN_SPACE if plain else SPACE))


def tokens(text: Column, plain: bool = False) -> Column:
    """PRJ-3: pieces between commas, stripped and lower-cased; empty ones stay."""
    return F.transform(F.split(text, ",", -1), lambda t: F.lower(strip(t, plain)))


def canonical_of(tokens: Column) -> Column:
    """PRJ-4: tokens that aren't empty, sorted, joined by a vertical bar; repeats stay."""
    return F.array_join(F.array_sort(F.filter(tokens, lambda t: t != "")), "|")


def hash_of(tokens: Column) -> Column:
    """PRJ-5: 16 hexadecimal digits of the canonical form's SHA-256."""
    return F.substring(F.sha2(canonical_of(tokens), 256), 1, 16)


def canonical(text: Column, plain: bool = False) -> Column:
    return canonical_of(tokens(text, plain))


def canonical_hash(text: Column, plain: bool = False) -> Column:
    return hash_of(tokens(text, plain))


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def _optional(value: Column) -> Column:
    return F.when(F.coalesce(value, F.lit("")) != "", F.array(value)).otherwise(_strings([]))


def positive(c: Callable[[str], Column] = F.col) -> Column:
    """PRJ-1: the positive prompt of a row of components, each named tag once, in the fixed order of parts."""
    styles = c("style_modifiers")
    parts = F.concat(
        F.filter(styles, lambda s: s.isin(*QUALITY_TAGS)),
        F.filter(styles, lambda s: ~s.isin(*QUALITY_TAGS)),
        F.split(c("subject"), ", ", -1),
        F.array(*[c(n) for n in ("hair_color", "hair_style", "eyes", "face_shape", "nose", "mouth", "expression")]),
        _optional(c("accessories")),
        _strings(POSE_TAGS),
        _optional(c("lighting")),
        _optional(c("background")),
    )
    return F.array_join(F.array_distinct(parts), ", ")


def negative(config: dict, c: Callable[[str], Column] = F.col) -> Column:
    """PRJ-2: the base, then the configured groups whose condition holds; a group that isn't configured or is empty adds nothing."""
    groups = config.get("conditional_negatives") or {}
    styles = F.transform(c("style_modifiers"), lambda s: F.lower(strip(s)))
    wanted = {
        "face_focus": F.arrays_overlap(styles, _strings(FACE_TAGS)),
        "detailed_eyes": F.array_contains(styles, DETAILED_EYES) | F.lower(strip(c("eyes"))).isin(*DETAILED_EYE_VALUES),
        "quality": F.lit(True),
        "anti_side_view": F.lit(True),
        "extreme_closeup": F.lit(True),
    }
    parts = [F.when(test, F.lit(", ".join(groups[name]))) for name, test in wanted.items() if groups.get(name)]
    return F.concat_ws(", ", F.lit(config["base_negative"]), *parts)


def word_count(text: Column) -> Column:
    """PRJ-7: words after commas became blanks, and two for the ends."""
    return F.size(F.filter(F.split(F.replace(text, F.lit(","), F.lit(" ")), r"(?U)[\s\x1c-\x1f]+"), lambda w: w != "")) + 2


def max_length(declared: int | None) -> int:
    """PRJ-8: a tokenizer's limit; none, and a stand-in for none, is 77."""
    return DEFAULT_MAX_LENGTH if declared is None or declared > SENTINEL_LENGTH else declared


def trim(text: Column, counters: list[tuple[Callable[[Column], Column], int]], plain: bool = False) -> Column:
    """PRJ-9: struct (text, trimmed): the longest prefix of tags that all counters (count, limit) accept.

    A blank text comes back untouched; without counters nothing is trimmed; if
    not even the first tag fits, it comes back alone; a text that fits has its
    spacing normalised all the same.
    """
    # Empty tags go.
    tags = F.filter(F.transform(F.split(text, ",", -1), lambda t: strip(t, plain)), lambda t: t != "")

    def fits(k: Column) -> Column:
        out = F.lit(True)
        for count, limit in counters:
            out = out & (count(F.array_join(F.slice(tags, F.lit(1), k), ", ")) <= limit)
        return out

    best = F.get(F.filter(F.sequence(F.greatest(F.size(tags), F.lit(1)), F.lit(1), F.lit(-1)), fits), F.lit(0))
    some = F.size(tags) > 0
    kept = F.array_join(F.slice(tags, F.lit(1), F.coalesce(best, F.lit(1))), ", ")
    return F.struct(
        F.when(some, kept).otherwise(text).alias("text"),
        (some & (best.isNull() | (best < F.size(tags)))).alias("trimmed"),
    )


def json_string(text: Column) -> Column:
    """A string as JSON in plain ASCII: what isn't is written as \\uXXXX, in surrogate pairs beyond the basic plane."""
    quoted = F.regexp_extract(F.to_json(F.struct(text.alias("x"))), r"(?s)^\{\"x\":(.*)\}$", 1)

    def escape(code: Column) -> Column:
        return F.concat(F.lit("\\u"), F.lower(F.lpad(F.hex(code), 4, "0")))

    def one(ch: Column) -> Column:
        code = F.ascii(ch)
        high, low = F.shiftright(code - 0x10000, 10) + 0xD800, (code - 0x10000).bitwiseAND(0x3FF) + 0xDC00
        return F.when(code < 128, ch).when(code < 0x10000, escape(code)).otherwise(F.concat(escape(high), escape(low)))

    plain = F.array_join(F.transform(F.split(quoted, ""), one), "")
    return F.when(text.isNull(), "null").when(quoted.rlike(r"[^\x00-\x7f]"), plain).otherwise(quoted)


def json_line(strings: list[str], numbers: list[str], order: list[str]) -> Column:
    """SNK-2: a record as a line with ", " and ": " between its parts, keys in the given order."""
    parts = []
    for name in order:
        value = json_string(F.col(name)) if name in strings else F.coalesce(F.col(name).cast("string"), F.lit("null"))
        parts.append(F.concat(F.lit(f'"{name}": '), value))
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))
