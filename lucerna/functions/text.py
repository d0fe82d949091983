"""Text normalization as Catalyst expressions: white space, slugs, name keys, stable ids, labels."""

from __future__ import annotations

import json
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _decomposed() -> tuple[str, str, list[tuple[str, str]]]:
    """Letters whose decomposition leaves one ASCII character, with that one, and those that leave several, with all of them."""
    one, several = [], []
    for c in range(0x80, 0x110000):
        if 0xAC00 <= c <= 0xD7A3 or 0xD800 <= c <= 0xDFFF:
            continue
        plain = unicodedata.normalize("NFKD", chr(c)).encode("ascii", "ignore").decode()
        if len(plain) == 1:
            one.append((chr(c), plain))
        elif plain:
            several.append((chr(c), plain))
    return "".join(a for a, _ in one), "".join(b for _, b in one), several


ACCENTED, PLAIN, LONGER = _decomposed()
#: Honorifics that name keys leave out.
HONORIFICS = ("prof", "professor", "professore", "professoressa", "dott", "dottor", "dottore", "dottoressa", "dr", "ing", "arch", "avv", "ssa")


#: Unicode white space and the separator controls, written out, as looking properties up costs more than comparing; and what is no ASCII.
BLANKS = r"[\x09-\x0d\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
BEYOND_ASCII = r"[^\x00-\x7F]"


def once(c, use) -> Column:
    """use(value), the value evaluated once a row: Spark puts an expression in every place that uses it, so uses of uses multiply."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def made(x: Column) -> Column:
    """The value as a row's generated column, which filters and later columns read.  A plain column would be made again in each of them."""
    return F.explode(F.array(x))


def collapse(c) -> Column:
    """Runs of Unicode white space (and the separator controls) become one blank, ends are trimmed, null is empty."""
    return F.coalesce(F.trim(F.regexp_replace(c, BLANKS, " ")), F.lit(""))


def none_if_empty(c) -> Column:
    return once(collapse(c), lambda t: F.when(t != "", t))


def _folds() -> tuple[str, str, list[tuple[str, str]]]:
    """Small letters that fold to another one, with that one, and those that fold to several."""
    pairs = [(chr(c), chr(c).casefold()) for c in range(0x80, 0x110000) if not 0xD800 <= c <= 0xDFFF and chr(c).lower() == chr(c) != chr(c).casefold()]
    one = [(a, b) for a, b in pairs if len(b) == 1]
    return "".join(a for a, _ in one), "".join(b for _, b in one), [(a, b) for a, b in pairs if len(b) > 1]


FOLDED, TO, APART = _folds()


def _class(pairs: list[tuple[str, str]]) -> str:
    """A class of the letters as ranges; ASCII is ruled out first, so that most characters are compared once and not with every range."""
    ranges: list[list[int]] = []
    for c in sorted(ord(a) for a, _ in pairs):
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return f"[{BEYOND_ASCII}&&[{''.join(f'\\x{{{a:x}}}-\\x{{{b:x}}}' for a, b in ranges)}]]"


def _apart(text: Column, pairs: list[tuple[str, str]]) -> Column:
    """Text with letters replaced by several; few texts hold such a letter, so only they are taken apart, and only such letters are looked up."""
    letters, held = F.from_json(F.lit(json.dumps(dict(pairs))), "map<string,string>"), F.lit(_class(pairs))
    spelled = lambda t: F.array_join(F.transform(F.split(t, ""), lambda x: F.when(F.rlike(x, held), letters[x]).otherwise(x)), "")
    return once(text, lambda t: F.when(F.rlike(t, held), spelled(t)).otherwise(t))


def casefold(c) -> Column:
    """Full case folding of Unicode."""
    return once(F.lower(c), lambda t: F.when(F.rlike(t, F.lit(BEYOND_ASCII)), _apart(F.translate(t, FOLDED, TO), APART)).otherwise(t))


def slug(c) -> Column:
    """ASCII letters and digits in lower case, everything else one hyphen; accents of Latin letters are dropped."""
    dropped = lambda t: F.regexp_replace(F.translate(_apart(t, LONGER), ACCENTED, PLAIN), BEYOND_ASCII, "")
    plain = F.lower(once(c, lambda t: F.when(F.rlike(t, F.lit(BEYOND_ASCII)), dropped(t)).otherwise(t)))
    return F.regexp_replace(F.regexp_replace(plain, "[^a-z0-9]+", "-"), "^-|-$", "")


def name_key(c) -> Column:
    """Sorted distinct slug tokens of two letters or more that are no honorifics; null unless there are two."""
    tokens = F.array_sort(F.array_distinct(F.filter(F.split(slug(c), "-"), lambda t: (F.length(t) > 1) & ~t.isin(*HONORIFICS))))
    return once(tokens, lambda ts: F.when(F.size(ts) >= 2, F.array_join(ts, "-")))


def person_id(name, email=None) -> Column:
    """Last token first; a single token as it is; else the local part of the address."""
    last_first = lambda ts: F.concat_ws("-", F.element_at(ts, -1), F.array_join(F.slice(ts, F.lit(1), F.size(ts) - 1), "-"))
    by_name = once(F.split(slug(name), "-"), lambda ts: F.when(F.size(ts) > 1, last_first(ts)).otherwise(F.nullif(F.get(ts, F.lit(0)), F.lit(""))))
    return by_name if email is None else F.coalesce(by_name, F.nullif(slug(F.substring_index(email, "@", 1)), F.lit("")))


def place_id(kind, name) -> Column:
    return slug(F.concat(F.lower(kind), F.lit("-"), name))


def room_id(name, code, building) -> Column:
    """Code or name without a leading `aula-`, and the building unless the id ends with it already."""
    base = F.regexp_replace(F.coalesce(once(slug(code), lambda s: F.nullif(s, F.lit(""))), slug(name)), "^aula-", "")
    joined = lambda x, b: F.when(b.isNull() | (b == "") | (x == b) | F.endswith(x, F.concat(F.lit("-"), b)), x).otherwise(F.concat(x, F.lit("-"), b))
    return once(F.struct(base.alias("base"), slug(building).alias("b")), lambda r: joined(r.base, r.b))


def split_alnum(c) -> Column:
    """Blanks between letters and digits of a code in capitals."""
    return F.regexp_replace(c, "(?<=[0-9])(?=[A-Z])|(?<=[A-Z])(?=[0-9])", " ")


def compact_code(c) -> Column:
    return F.upper(F.regexp_replace(c, r"[\s\-_./]+", ""))


def search_tokens(name, code, building) -> Column:
    """Sorted distinct tokens to look a room up by."""
    of_name = once(slug(name), lambda s: F.array(s, F.replace(s, F.lit("-"), F.lit("")), F.regexp_replace(s, "^aula-", "")))
    tokens = F.concat(F.coalesce(of_name, F.array().cast("array<string>")), F.array(F.lower(code), slug(building)))
    return F.array_sort(F.array_distinct(F.filter(tokens, lambda t: t.isNotNull() & (t != ""))))


def roman(c) -> Column:
    """Value of a Roman numeral."""
    value = F.create_map(*[F.lit(x) for pair in {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}.items() for x in pair])
    digits = F.filter(F.split(F.reverse(F.upper(c)), ""), lambda x: x != "")
    start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("before"))
    step = lambda a, x: F.struct((a.total + F.when(value[x] < a.before, -value[x]).otherwise(value[x])).alias("total"), value[x].alias("before"))
    return F.aggregate(digits, start, step, lambda a: a.total)


def strip_html(c) -> Column:
    return collapse(F.regexp_replace(c, "<[^>]*>", " "))


def room_tokens(name, code, room, building) -> Column:
    """Sorted distinct tokens of a room: slugs of its name, of what follows `aula ` and of its room, with hyphens and without, its code and its building's id."""
    after = F.when(F.startswith(casefold(name), F.lit("aula ")), slug(F.substring(name, 6, 1 << 30)))
    slugs = once(F.array(slug(name), after, slug(room)), lambda xs: F.concat(xs, F.transform(xs, lambda x: F.replace(x, F.lit("-"), F.lit("")))))
    tokens = F.concat(slugs, F.array(casefold(code), casefold(building)))
    return F.array_sort(F.array_distinct(F.filter(tokens, lambda t: t.isNotNull() & (t != ""))))
