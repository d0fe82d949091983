"""What free text says about rooms: building, floor, seats, codes and labels.  Cascades are data, the first rule that matches decides."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import casefold, collapse, none_if_empty, once, roman, slug

# Floor labels, words, phrases and patterns of the source texts.
FLOORS = ("Piano Terra", "Primo piano", "Secondo piano", "Terzo piano", "Quarto piano", "Quinto piano", "Sesto piano", "Settimo piano")
ELSEWHERE = "Altra collocazione"
FLOOR_WORDS = ("terra", "primo", "secondo", "terzo", "quarto", "quinto", "sesto", "settimo")
BRIDGES = (("ponte carrabile", "Sesto piano"), ("ponte pedonale", "Quarto piano"), ("ponte coperto", "Quarto piano"), ("sotto via", ELSEWHERE), ("sottovia", ELSEWHERE))
FLOOR_PATTERNS = (
    r"\b([ivxlcdm]+|[0-9]+)\s*[°ºo]?\s*piano\b",
    r"\b(terra|primo|secondo|terzo|quarto|quinto|sesto|settimo)\s+piano\b",
    r"\bpiano\s+(terra|primo|secondo|terzo|quarto|quinto|sesto|settimo)\b",
    r"\bpiano\s+([ivxlcdm]+|[0-9]+)\b",
)
CAPACITY_PATTERNS = (
    r"\b(?:capienza|posti|n[°º.]?\s*posti)\s*[:\-]?\s*([0-9]{1,4})(?:\s*(?:posti|persone))?\b",
    r"\b([0-9]{1,4})\s*(?:posti|persone)\b",
    r"\b(?:dotat[oa]\s+di\s+)?([0-9]{1,4})\s*(?:banchi\s+di\s+lavoro|postazioni)\b",
    r"^([0-9]{1,4})$",
)
BUILDINGS = (
    ("Cubo ", r"\bCubo\s+([0-9]{1,2})(?:\s*[-/]\s*|\s+)?([A-Za-z])?\b"),
    ("Cubi ", r"\bCubi\s+([0-9]{1,2}(?:-[0-9]{1,2})?[A-Za-z])()\b"),
    ("Capannone ", r"\bCapannone\s+([A-Za-z])()\b"),
    ("Ampliamento Polifunzionale", r"\bAmpliamento\s+Polifunzionale()()\b"),
    ("Orto Botanico", r"\bOrto\s+Botanico()()\b"),
)
BARE_CUBO = r"\b([0-9]{1,2}[A-Za-z])\b"
PLACE_WORDS = ("piano", "ponte", "ubicazione", "posizione", "luogo", "cubo")
CODED_BUILDING = r"\b(?:CH-)?([0-9]{1,2})-[0-9]{1,2}([A-Z])(?:-[0-9]{1,2}[A-Z])?\b"
ROOM_CODES = ("[A-Z]{1,4}[0-9]{1,4}[A-Z]?", "[0-9]{1,2}[A-Z][0-9]{0,2}[A-Z]?", "[A-Z][0-9]{1,3}")
ALIAS_CODES = ("[A-Z]{1,5}[0-9]{1,4}[A-Z]?", "[0-9]{1,3}[A-Z]{1,4}[0-9]{0,3}[A-Z]?", "[A-Z][0-9]{1,3}")
ROOM_NAME = r"(?iU)\b(Aula\s+[A-Za-z0-9][A-Za-z0-9'()\- ]{0,40})"
INLINE_CODE = r"\b([0-9]{1,2}[A-Za-z]\s*[0-9]{0,2}[A-Za-z]?)\b"
HEADER_WORDS = ("aula", "cubo", "ubicazione", "capienza", "dotazione", "posti", "attrezzature", "nome", "denominazione")
COORDINATED_FLOOR = r"\b(?:[A-Z]{1,4}-)?[0-9]{1,2}-([0-7])[A-Z](?:-[0-9]{1,2}[A-Z])?\b"
LAB_FLOOR = r"\bLAB\s*[0-9]{1,2}[A-Z][_-]([0-7])P\b"
CODE_FLOOR = r"\b[0-9]{1,2}[A-Z]\s*([0-7])[A-Z][0-9]?\b"


def holds(c, words) -> Column:
    """Whether the text holds one of the words."""
    out = F.lit(False)
    for w in words:
        out = out | F.contains(c, F.lit(w))
    return out


def cascade(rules, otherwise=None) -> Column:
    """The value of the first (condition, value) that holds; that value may be null."""
    out = F.lit(None) if otherwise is None else otherwise
    for condition, value in reversed(list(rules)):
        out = F.when(condition, value).otherwise(out)
    return out


def _group(c, pattern: str, i: int = 1) -> Column:
    return F.regexp_extract(c, f"(?iU){pattern}", i)


def _found(c, pattern: str) -> Column:
    return F.rlike(c, F.lit(f"(?iU){pattern}"))


def floor_of(n) -> Column:
    """Label of floor 0 to 7, null beyond."""
    return F.get(F.array(*[F.lit(x) for x in FLOORS]), n.cast("int"))


def floor_label(c) -> Column:
    """Bridge phrases, labels as they are, a number, Roman numeral or word before `piano`, then after it; null without any.

    A number before `piano` beyond 7 falls through to the later patterns.
    """

    def number(v):
        word = F.array_position(F.array(*[F.lit(x) for x in FLOOR_WORDS]), v)
        return F.when(word > 0, word.cast("int") - 1).when(v.rlike("^[0-9]+$"), F.try_to_number(F.substring(v, 1, 9), F.lit("999999999")).cast("int")).when(v != "", roman(v))

    def label(t):
        said = [(F.contains(t, F.lit(p)), F.lit(v)) for p, v in BRIDGES] + [(F.contains(t, F.lit(x.lower())), F.lit(x)) for x in (*FLOORS, ELSEWHERE)]
        read = F.when(_found(t, "piano"), F.coalesce(*[floor_of(once(_group(t, p), number)) for p in FLOOR_PATTERNS]))
        return cascade(said, read)

    return once(casefold(collapse(c)), label)


def floor_from_codes(name, room, code, building) -> Column:
    """Floor that the room's codes imply, given the building it had before any override; null if digits disagree."""
    one = lambda found: once(found, lambda x: F.when(F.size(F.array_distinct(x)) == 1, floor_of(F.get(x, F.lit(0)))))
    first = lambda up, p: F.when(_found(up, p), floor_of(F.regexp_extract(up, f"(?U){p}", 1)))
    every = lambda up, p: one(F.regexp_extract_all(up, p, F.lit(1)))
    own = [F.regexp_extract(building, "^cubo-([0-9]{1,2})([a-z])$", i) for i in (1, 2)]
    own_pattern = F.concat(F.lit(r"(?U)\b"), own[0], F.lit(r"\s*"), F.upper(own[1]), F.lit(r"\s*([0-7])(?:[A-Z][0-9]?)?\b"))

    def label(up):
        bridges = [(F.contains(F.lower(up), F.lit(p)), F.lit(v)) for p, v in BRIDGES[:2]]
        ground = F.when((building == "cubo-45b") & F.rlike(up, F.lit(r"(?U)\b45B0[0-9A-Z]\b")), F.lit(FLOORS[0]))
        return cascade(bridges, F.coalesce(first(up, COORDINATED_FLOOR), first(up, LAB_FLOOR), ground, every(up, F.lit(f"(?U){CODE_FLOOR}")), F.when(own[0] != "", every(up, own_pattern))))

    return once(F.upper(F.concat_ws(" ", name, room, code)), label)


def capacity(c) -> Column:
    """Seats, from the first pattern that matches, if they are from 1 to 5000; an unlikely first one is null and not passed over."""
    value = lambda t, p: once(_group(t, p).cast("int"), lambda n: F.when(n.between(1, 5000), n))
    return once(collapse(c), lambda t: cascade([(_found(t, p), value(t, p)) for p in CAPACITY_PATTERNS]))


def building_hint(c) -> Column:
    """Name of the building that the text mentions."""
    return once(collapse(c), _building_named)


def _building_named(t) -> Column:
    named = [(_found(t, p), F.concat(F.lit(head), F.upper(F.concat(_group(t, p, 1), _group(t, p, 2))))) for head, p in BUILDINGS]
    side, compact = _group(t, r"\bPolifunzionale\s+(Ovest|Est)\b"), F.regexp_replace(t, r"(?U)\s+", "")
    rest = [
        (side != "", F.concat(F.lit("Polifunzionale "), F.initcap(F.lower(side)))),
        (_found(t, r"\bPolifunzionale\b"), F.lit("Polifunzionale")),
        (F.rlike(compact, F.lit("^[0-9]{1,2}[A-Za-z]$")), F.concat(F.lit("Cubo "), F.upper(compact))),
        (_found(t, BARE_CUBO) & holds(casefold(t), PLACE_WORDS), F.concat(F.lit("Cubo "), F.upper(_group(t, BARE_CUBO)))),
    ]
    return cascade(named + rest)


def coded_hint(name, hint) -> Column:
    """The hint, made more precise by a code in the name where it has no letter or is missing."""
    def refined(up, h):
        coded = F.concat(F.lit("Cubo "), F.regexp_extract(up, f"(?U){CODED_BUILDING}", 1).cast("int").cast("string"), F.regexp_extract(up, f"(?U){CODED_BUILDING}", 2))
        refine = F.rlike(up, F.lit(f"(?U){CODED_BUILDING}")) & (h.isNull() | F.rlike(h, F.lit(r"(?i)^Cubo\s+[0-9]{1,2}$")))
        return F.when(refine, coded).otherwise(h)

    return once(F.struct(F.upper(name).alias("up"), hint.alias("hint")), lambda r: refined(r.up, r.hint))


def room_label(name) -> Column:
    """What follows `Aula `."""
    return once(name, lambda n: F.when(F.startswith(casefold(n), F.lit("aula ")), none_if_empty(F.substring(n, 6, 1 << 30))))


def short_code(name) -> Column:
    """The code in a name's room label."""
    return code_of(room_label(name))


def code_of(label) -> Column:
    """A room label of letters and a number, or of two to four single letters."""
    code = lambda room: F.rlike(F.replace(room, F.lit(" "), F.lit("")), F.lit("^[A-Za-z]{1,4}[0-9]{1,4}[A-Za-z]?$")) | F.rlike(room, F.lit(r"(?U)^(?:[A-Za-z]\s*){2,4}$"))
    return once(label, lambda room: F.when(code(room), F.upper(F.regexp_replace(room, r"(?U)\s+", ""))))


def _code_like(compact, limit: int, patterns) -> Column:
    return once(compact, lambda x: (F.length(x) <= limit) & F.rlike(x, F.lit(f"^(?:{'|'.join(patterns)})$")))


def is_room_code(c) -> Column:
    """As sources write codes, blanks aside."""
    return F.coalesce(_code_like(F.upper(F.regexp_replace(c, r"(?U)\s+", "")), 10, ROOM_CODES), F.lit(False))


def is_alias_code(c) -> Column:
    """As aliases accept codes: longer, and without any separator."""
    return F.coalesce(_code_like(F.upper(F.regexp_replace(c, r"(?U)[\s\-_./]+", "")), 12, ALIAS_CODES), F.lit(False))


def room_candidates(c) -> Column:
    """Room names in a cell: those that say `Aula`, else the parts that are codes, else the codes within."""
    named = lambda t: F.transform(F.regexp_extract_all(t, F.lit(ROOM_NAME), F.lit(1)), collapse)
    parts = lambda t: F.filter(F.transform(F.split(t, r"\s*[;,/|]\s*"), collapse), is_room_code)
    inline = lambda t: F.transform(F.regexp_extract_all(t, F.lit(INLINE_CODE), F.lit(1)), collapse)
    held = lambda x, rest: once(x, lambda y: F.when(F.size(y) > 0, y).otherwise(rest))
    return once(collapse(c), lambda t: held(named(t), held(parts(t), inline(t))))


def is_header_row(cells) -> Column:
    """Two short cells or more, one with a header word, none with a colon or a number."""
    odd = lambda x: F.contains(x, F.lit(":")) | F.rlike(x, F.lit(r"(?U)\b[0-9]{1,4}\b")) | (F.length(x) > 40)
    return (F.size(cells) >= 2) & F.exists(cells, lambda x: once(casefold(x), lambda t: holds(t, HEADER_WORDS))) & ~F.exists(cells, odd)


def columns_named(headers, words) -> Column:
    """Positions of the headers that hold one of the words."""
    return F.filter(F.transform(headers, lambda h, i: F.when(once(casefold(h), lambda t: holds(t, words)), i)), lambda i: i.isNotNull())


def cells_at(cells, positions) -> Column:
    """The cells at the positions that aren't empty."""
    return F.filter(F.transform(positions, lambda i: F.get(cells, i)), lambda x: x.isNotNull() & (x != ""))


def split_code(code) -> Column:
    """A code of letters and digits with blanks between them; null if there is nothing to part."""
    parted = lambda x: F.regexp_replace(x, r"(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})", " ")
    return once(code, lambda x: F.when(F.rlike(x, F.lit(r"^[\p{L}\p{N}]+$")), once(parted(x), lambda y: F.when(y != x, y))))


def alias_labels(name, room, code) -> Column:
    """Labels to find a room by, in order, the first of those that differ in case only."""
    given = F.struct(none_if_empty(name).alias("name"), none_if_empty(room).alias("room"), none_if_empty(code).alias("code"))
    return once(given, lambda x: _labels(x.getField("name"), x.room, x.code))


def _labels(name, room, code) -> Column:
    bare = lambda c: F.nullif(F.upper(F.regexp_replace(c, r"(?U)[\s\-_./]+", "")), F.lit(""))
    called = lambda c: F.rlike(c, F.lit(r"(?iU)^aula\s+"))
    aula = lambda c: F.concat(F.lit("Aula "), c)
    of_room = once(bare(room), lambda x: F.array(F.when(x != F.upper(room), x), split_code(x)))
    of_code = once(F.struct(bare(code).alias("c"), split_code(bare(code)).alias("s")), lambda x: F.array(x.c, aula(x.c), x.s, aula(x.s)))
    labels = F.concat(
        F.array(name, F.when(called(name), F.regexp_replace(name, r"(?iU)^aula\s+", "")), room),
        of_room, F.array(F.when(is_alias_code(room) & ~called(room), aula(room))), of_code,
        F.array(F.when(is_alias_code(name) & ~called(name), aula(name))),
    )
    return once(F.filter(F.transform(labels, none_if_empty), lambda x: x.isNotNull()), first_spellings)


def first_spellings(labels) -> Column:
    """The first of those that differ in case only."""
    return once(F.transform(labels, casefold), lambda folded: F.filter(labels, lambda x, i: F.array_position(folded, F.get(folded, i)) == i + 1))


def alias_id(kind, entity, normalized) -> Column:
    """normalized: the label's slug."""
    return slug(F.concat_ws("-", F.lit("alias"), F.lower(kind), entity, normalized))


# Words of resources that are no rooms, patterns and words of names, headings and segments.
NO_ROOM = ("nessun", "studio docente", "help desk", "sala consiglio", "calcio", "tennis", "padel", "palacus", "vibora", "chiodo")
PLAIN_NAME = r"^[A-Za-z0-9][A-Za-z0-9 .,_'()/\-]*$"
OCCASIONS = ("convegno", "evento", "giorni")
DEPARTMENT_PREFIX = r"^[A-Z]{2,8}\s+(?=[0-9]{1,2}[A-Za-z])"
GENERIC_HEADINGS = ("aule per ", "aule convegni", "laboratori didattici", "descrizione dei laboratori", "aule del dipartimento")
DETAIL_HEADINGS = ("responsabile", "preposto", "dotazione", "capienza", "ubicazione", "collocazione")
LOCATION_WORDS = ("ubicazione", "collocazione", "capienza", "posti", "attrezzature")
SEGMENT_START = r"(?iU)(Piano Terra|Primo piano|Secondo piano|Terzo piano|Quarto piano|Quinto piano|Sesto piano|Settimo piano|Altra collocazione)\s*(?:\([^)]*\))?\s*:\s*"
SEGMENT_NAME = r"(?iU)\b(Aula\s+[A-Za-z0-9][A-Za-z0-9'\- ]{0,40})"
SEGMENT_TAIL = r"(?iU)\b(Link informativo|Evento)\b.*$"
SIGNAL_CODE = r"(?U)\b[0-9]{1,2}[A-Za-z]\s*[0-9]?[A-Za-z]?\b"


def _starts(c, parts) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | F.startswith(c, F.lit(p))
    return out


def map_room_name(name) -> Column:
    """A name that starts with `Aula `, without what follows ` - ` if that tells of an occasion; else null."""
    tail = lambda n: F.when(F.contains(n, F.lit(" - ")), F.substring(n, F.instr(n, " - ") + 3, 1 << 30))
    cut = lambda n: F.when(once(casefold(tail(n)), lambda t: holds(t, OCCASIONS)), F.substring_index(n, " - ", 1)).otherwise(n)
    return once(once(none_if_empty(name), cut), lambda n: F.when(F.startswith(casefold(n), F.lit("aula ")), n))


def _outside_name(n, low) -> Column:
    """outside_room_name of a tidy name and the same casefolded, which names no resource that is no room."""
    within = _group(n, r"\b(Aula\s+[A-Za-z0-9][A-Za-z0-9'()\- ]{0,40})")
    code = F.when(is_room_code(n), F.concat(F.lit("Aula "), F.upper(F.regexp_replace(n, r"(?U)\s+", ""))))
    found = once(F.when(F.contains(low, F.lit("aula ")), F.nullif(within, F.lit(""))), lambda x: F.when(x.isNotNull(), map_room_name(x)).otherwise(code))
    return F.when(F.startswith(low, F.lit("aula ")), map_room_name(n)).otherwise(found)


def outside_room_name(name) -> Column:
    """Names of other sources: `Aula ...` from anywhere in them, codes with `Aula ` before; null for resources that are no rooms."""
    return once(none_if_empty(name), lambda n: once(casefold(n), lambda low: F.when(~holds(low, NO_ROOM), _outside_name(n, low))))


def department_room_name(name) -> Column:
    """Names of departments' pages: laboratories as they are, else as other sources', else `Aula ` and a plain name of 80 characters at most."""

    def named(n, low):
        plain = F.when((F.length(n) <= 80) & F.rlike(n, F.lit(PLAIN_NAME)), F.concat(F.lit("Aula "), n))
        return F.when(F.startswith(low, F.lit("laboratorio ")), n).when(~holds(low, NO_ROOM), F.coalesce(_outside_name(n, low), plain))

    return once(none_if_empty(F.regexp_replace(none_if_empty(name), DEPARTMENT_PREFIX, "")), lambda n: once(casefold(n), lambda low: named(n, low)))


def planner_room_name(name) -> Column:
    """Names of the planner, which lists rooms only: as other sources', else a plain name of 100 characters at most as it is."""
    plain = lambda n: F.when((F.length(n) <= 100) & F.rlike(n, F.lit(PLAIN_NAME)), n)
    return once(none_if_empty(name), lambda n: once(casefold(n), lambda low: F.when(~holds(low, NO_ROOM), F.coalesce(_outside_name(n, low), plain(n)))))


def is_generic_heading(c) -> Column:
    return F.coalesce(once(casefold(collapse(c)), lambda t: _starts(t, GENERIC_HEADINGS)), F.lit(False))


def is_entry_name(c) -> Column:
    """Whether a heading of an accordion names one room."""
    starts = lambda t: once(casefold(t), lambda low: _starts(low, ("aula ", "laboratorio ")))
    return once(collapse(c), lambda t: (t != "") & ~is_generic_heading(t) & (starts(t) | is_room_code(t)))


def is_laboratory_heading(c) -> Column:
    details = lambda t: once(casefold(t), lambda low: _starts(low, DETAIL_HEADINGS))
    return once(collapse(c), lambda t: (t != "") & ~is_generic_heading(t) & (F.length(t) <= 80) & ~F.contains(t, F.lit(":")) & ~details(t) & F.rlike(t, F.lit(PLAIN_NAME)))


def tells_location(c) -> Column:
    return F.coalesce(once(casefold(c), lambda t: holds(t, LOCATION_WORDS)), F.lit(False))


def tells_room(values) -> Column:
    """Whether an array of texts together names a room: the word, a code, or a code within."""
    return once(collapse(F.array_join(values, " ")), lambda t: (t != "") & (F.contains(casefold(t), F.lit("aula")) | is_room_code(t) | F.rlike(t, F.lit(SIGNAL_CODE))))


def floor_segments(text) -> Column:
    """array<struct<floor,text>>: what stands between a floor label with a colon and the next one; empty segments go."""
    marked = F.regexp_replace(F.regexp_replace(text, r"[\x01\x02]", " "), SEGMENT_START, "\x01$1\x02")
    parts = F.slice(F.split(marked, "\x01"), 2, 1 << 30)
    labels = F.array(*[F.lit(x) for x in (*FLOORS, ELSEWHERE)])
    same = lambda said: once(casefold(said), lambda t: F.get(F.filter(labels, lambda x: F.lower(x) == t), F.lit(0)))
    each = F.transform(parts, lambda p: F.struct(same(F.substring_index(p, "\x02", 1)).alias("floor"), collapse(F.substring_index(p, "\x02", -1)).alias("text")))
    return F.filter(each, lambda x: x.text != "")


def segment_rooms(text) -> Column:
    """Canonical names of the rooms that a segment lists."""
    found = F.transform(F.regexp_extract_all(text, F.lit(SEGMENT_NAME), F.lit(1)), lambda x: map_room_name(F.regexp_replace(collapse(x), SEGMENT_TAIL, "")))
    return F.filter(found, lambda x: x.isNotNull())


def quality_score(lat, lng, hint, floor, code, room, seats) -> Column:
    """How much a raw room tells: 3 for coordinates, 2 for building and floor, 1 for code, room and seats."""
    said = lambda c: F.nullif(c, F.lit("")).isNotNull()
    return sum((F.when(x, n).otherwise(0) for x, n in ((lat.isNotNull() & lng.isNotNull(), 3), (said(hint), 2), (said(floor), 2), (said(code), 1), (said(room), 1), (seats.isNotNull(), 1))), F.lit(0))
