"""Personal data in texts (operator 8), with built-in expressions only.

For each kind a regular expression proposes spans, a validator confirms them (Luhn for cards,
mod-97 for IBANs, ranges for the others), and words nearby raise the score. A kind that is
certain by its form is kept whatever stands around it; the others need a score of 0.5.

The expressions match what their plain forms in the comments match, in time linear in the text:
possessive repeats do not recurse, and a lookbehind keeps a long run of name characters or
digits from being tried at each of its places.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import column, texts_of

CONTEXT = 48
# Arrays of a text's hits are worked through in blocks of blocks, as taking a part out of an array
# goes through all of it; texts in stretches of so many characters, for the same reason.
BLOCK, LARGE = 128, 8192
STRETCH = 1024
KEPT_SCORE = 0.5
_LOCAL = r"[A-Za-z0-9._%+-]"
_IP_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


@dataclass(frozen=True)
class Kind:
    """pattern proposes, confirmed decides, score is what a confirmed span starts with; a span
    with one of context's words within CONTEXT characters gets 0.4 more. cue is text without
    which the pattern cannot match."""

    name: str
    pattern: str
    score: float
    context: str
    cue: str | None = None
    base: bool = True


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether digits (as text) pass the Luhn check: from the right, every second one doubled."""
    places = F.sequence(F.lit(1), F.length(number))
    doubled = F.array(*[F.lit(d) for d in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)])

    def add(total: Column, place: Column) -> Column:
        digit = F.substring(number, -place, F.lit(1)).cast("int")
        return total + F.when(place % 2 == 0, F.element_at(doubled, digit + 1)).otherwise(digit)

    return F.aggregate(places, F.lit(0), add) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN without spaces has remainder 1: its first four characters moved to the
    end, letters as 10 to 35."""
    turned = F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 4))

    def add(rest: Column, char: Column) -> Column:
        code = F.ascii(char)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise(
            (rest * 10 + code - 48) % 97
        )

    return F.aggregate(F.split(turned, "(?!^)(?!$)"), F.lit(0), add) == 1


# The plain forms of the base kinds are
#   email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#   ip     [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+), parts at most 255
#   card   [0-9]([\x20-]?[0-9])+, 14 to 19 digits passing Luhn
#   phone  \+[0-9][\x20().0-9-]+[0-9], 10 to 15 digits
# A card is a maximal run of digits with single separators, so its length is asked for at once.
KINDS = (
    Kind(
        "email",
        rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        0.9,
        "mail|contact|write|address",
        "@",
    ),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", 0.6, "ip|host|server|address", "."),
    Kind(
        "card",
        r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){13,18}+(?![\x20-]?[0-9])",
        0.8,
        "card|visa|master|amex|credit|debit|cvv",
    ),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0.6, "phone|tel|call|mobile|fax", "+"),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])",
        0.7,
        "iban|account|bank|konto|cuenta|compte",
        base=False,
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        0.3,
        "ssn|social|security|insurance",
        "-",
        base=False,
    ),
)


def _confirmed(kind: Kind, match: Column) -> Column:
    if kind.name == "ip":
        return match.rlike(rf"^{_IP_PART}(?:\.{_IP_PART}){{3}}$")
    if kind.name == "card":
        return luhn(_digits(match))
    if kind.name == "phone":
        return F.length(_digits(match)).between(10, 15)
    if kind.name == "iban":
        plain = F.translate(match, " ", "")
        return F.length(plain).between(15, 34) & mod97(plain)
    if kind.name == "ssn":
        return ~match.rlike("^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


def _computed(df: DataFrame, keep: list[str], columns: dict[str, Column]) -> DataFrame:
    """Columns worked out once; a plain select may be merged into what uses them and repeat them."""
    made = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select(*keep, F.inline(F.array(made)))


def _parts(array: Column, n: int) -> Column:
    """An array of parts of n elements."""
    firsts = F.filter(F.sequence(F.lit(1), F.size(array) + 1, F.lit(n)), lambda at: at <= F.size(array))
    return F.transform(firsts, lambda at: F.slice(array, at, F.lit(n)))


def _blocks(array: Column) -> Column:
    """An array of blocks of BLOCK elements."""
    return F.flatten(F.transform(_parts(array, LARGE), lambda large: _parts(large, BLOCK)))


def _scanned(blocks: Column, none: Column, step) -> Column:
    """Blocks of what step makes of all elements before each element, none of nothing."""

    def into(held: Column, one: Column) -> Column:
        return F.concat(held, F.array(step(F.element_at(held, -1), one)))

    totals = F.transform(blocks, lambda block: F.aggregate(block, none, step))
    before = F.aggregate(totals, F.array(none), into)
    inner = F.zip_with(blocks, F.slice(before, F.lit(1), F.size(blocks)), lambda block, first: F.struct(block.alias("b"), first.alias("f")))
    return F.transform(inner, lambda x: F.slice(F.aggregate(x.b, F.array(x.f), into), F.lit(1), F.size(x.b)))


def _hit_starts(kind: Kind) -> Column:
    """Where each hit begins: the sum of the sizes before every second one."""
    before = F.flatten(_scanned(F.col(f"blocks_{kind.name}"), F.lit(0), lambda x, y: x + y))
    return F.filter(before, lambda _, place: place % 2 == 1)


def _stretches(text: Column) -> Column:
    """The text in stretches of STRETCH characters."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{STRETCH}}}"), F.lit(0))


def _between(stretches: Column, first: Column, n: Column | int) -> Column:
    """n characters of the text from first, STRETCH at most; fewer at its end."""
    at = F.floor(first / STRETCH).cast("int")
    two = F.concat(F.coalesce(F.get(stretches, at), F.lit("")), F.coalesce(F.get(stretches, at + 1), F.lit("")))
    return F.substring(two, (first - at * STRETCH + 1).cast("int"), F.lit(n) if isinstance(n, int) else n)


def _sizes(kind: Kind) -> Column:
    """The lengths of gap and hit in turn, in code points; gap k stands before hit k."""
    hits = F.col(f"hits_{kind.name}")
    gaps = F.slice(F.split("text", kind.pattern, -1), 1, F.size(hits))
    both = F.zip_with(gaps, hits, lambda gap, hit: F.array(F.length(gap), F.length(hit)))
    return F.flatten(both)


def _spans(order: int, kind: Kind) -> Column:
    """The kind's confirmed spans."""

    def span(hit: Column, start: Column) -> Column:
        end = start + F.length(hit)
        return F.struct(
            start.alias("start"),
            F.lit(order).alias("place"),
            end.alias("end"),
            F.lit(kind.name).alias("kind"),
            (F.lit(kind.score) + F.when(_near(start, end, kind), 0.4).otherwise(0.0)).alias("score"),
            _confirmed(kind, hit).alias("confirmed"),
        )

    made = F.zip_with(f"hits_{kind.name}", f"starts_{kind.name}", span)
    wanted = lambda s: s.confirmed if kind.base else s.confirmed & (s.score >= KEPT_SCORE)
    return F.filter(made, wanted)


def _near(start: Column, end: Column, kind: Kind) -> Column:
    first = F.greatest(start - CONTEXT, F.lit(0))
    before = _between(F.col("stretches"), first, start - first)
    around = F.concat_ws(" ", before, _between(F.col("stretches"), end, CONTEXT))
    return F.lower(around).rlike(rf"(?<![a-z])(?:{kind.context})")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, spans: array of struct(start, place, end, kind, score, confirmed) by start,
    then kind in the order of KINDS. Offsets are code points, the end is exclusive.

    One row per row of docs. A null text is empty and has no spans; repeated rows get equal
    spans; an empty table gives an empty one; other columns are left out. Spans of different
    kinds may overlap.
    """
    return _with_spans(texts_of(docs, id_col, text_col), ["doc_id"])


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with its columns, spans in the text replaced by their kinds; a null text stays null."""
    carried = [f"carried_{number}" for number in range(len(docs.columns))]
    held = docs.select(
        *[column(name).alias(other) for name, other in zip(docs.columns, carried)],
        F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text"),
    )
    found = _redacted(_with_spans(held, carried), carried)
    return found.select(
        *[
            (F.when(F.col(c).isNotNull(), F.col("clean")) if name == text_col else F.col(c)).alias(name)
            for name, c in zip(docs.columns, carried)
        ]
    )


def _with_spans(df: DataFrame, carried: list[str]) -> DataFrame:
    """The carried columns, text and spans."""
    text, digit = F.col("text"), F.col("has_digit")
    nothing = F.array().cast("array<string>")
    df = _computed(df, [*carried, "text"], {"has_digit": text.rlike("[0-9]")})
    hits = {}
    for kind in KINDS:
        gate = F.lit(True) if kind.name == "email" else digit
        if kind.cue:
            gate = gate & F.contains(text, F.lit(kind.cue))
        found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
        hits[f"hits_{kind.name}"] = F.when(gate, found).otherwise(nothing)
    df = _computed(df, [*carried, "text"], hits)
    none, nested = F.array().cast("array<int>"), F.array().cast("array<array<int>>")
    some = F.greatest(*[F.size(name) for name in hits]) > 0
    df = _computed(df, [*carried, "text", *hits], {"stretches": F.when(some, _stretches(text)).otherwise(nothing)})
    steps = (
        ("sizes", _sizes, none),
        ("blocks", lambda kind: _blocks(F.col(f"sizes_{kind.name}")), nested),
        ("starts", _hit_starts, none),
    )
    kept = [*carried, "text", "stretches", *hits]
    for step, made, otherwise in steps:
        columns = {
            f"{step}_{kind.name}": F.when(F.size(f"hits_{kind.name}") > 0, made(kind)).otherwise(otherwise)
            for kind in KINDS
        }
        df = _computed(df, kept, columns)
        kept += columns
    spans = F.concat(*[_spans(order, kind) for order, kind in enumerate(KINDS)])
    return _computed(df, [*carried, "text"], {"spans": F.array_sort(spans)})


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    one = lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))
    return F.concat_ws(",", F.transform(spans, one))


def of_kind(spans: Column, *names: str) -> Column:
    return F.filter(spans, lambda s: s.kind.isin(*names))


def _redacted(df: DataFrame, carried: list[str]) -> DataFrame:
    """The carried columns, text, and clean: the text with each span replaced by its kind in
    brackets; where spans overlap, all they cover is replaced by the first one's kind."""
    keep = [*carried, "text", "spans"]
    df = _computed(df, keep, {"blocks": F.when(F.size("spans") > 0, _blocks(F.col("spans")))})
    ends = F.transform("blocks", lambda block: F.transform(block, lambda span: span.end))
    df = _computed(df, [*keep, "blocks"], {"ends": ends})
    df = _computed(df, [*keep, "blocks"], {"before": _scanned(F.col("ends"), F.lit(0), lambda x, y: F.greatest(x, y))})

    # Of each block the text from the end of all spans before it to its last one.
    own = lambda block, ends: F.struct(
        block.alias("b"),
        ends.alias("f"),
        F.substring(F.col("text"), ends[0] + 1, F.element_at(block, -1).start - ends[0]).alias("own"),
    )
    df = _computed(df, keep, {"prepared": F.zip_with("blocks", "before", own)})

    def replaced(x: Column) -> Column:
        piece = lambda span, done: F.when(
            span.start >= done,
            F.concat(
                F.substring(x.own, done - x.f[0] + 1, span.start - done), F.lit("["), F.upper(span.kind), F.lit("]")
            ),
        ).otherwise("")
        return F.array_join(F.zip_with(x.b, x.f, piece), "")

    end = F.array_max(F.transform("spans", lambda span: span.end))
    rest = F.substring(F.col("text"), end + 1, F.length("text"))
    clean = F.concat(F.array_join(F.transform("prepared", replaced), ""), rest)
    return _computed(df, [*carried, "text"], {"clean": F.coalesce(F.when(F.size("spans") > 0, clean), F.col("text"))})
