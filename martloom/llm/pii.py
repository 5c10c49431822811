"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Offsets are code points. They come from the text between the matches: `split` gives
the gaps, `regexp_extract_all` the matches, and running lengths give the positions.

The patterns find the same matches as the plain forms in the comments. Possessive
quantifiers and the look-behinds only stop the engine from trying again inside a run
that has already failed, which keeps long runs without a match linear.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import let


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    #: Score of a confirmed span without context.
    score: float
    #: Words that raise the score when they stand shortly before the span.
    context: str
    #: Spans below this score are not reported. Zero: context never decides.
    least: float = 0.0
    #: What may follow a match and belong to its span, at its longest. It is only looked at: spans may begin in it.
    ahead: str = ""


#: The kinds in the order of reports.
KINDS = (
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        0.9,
        r"e-?mail|mail|contact|correo|courriel",
    ),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 0.6, r"ip|host|server|address|login"),
    # [0-9]([\x20-]?[0-9])+
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", 0.8, r"card|visa|credit|karte|carte|tarjeta"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0.7, r"phone|tel|call|mobile|fax"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}", 0.9, r"iban|account|bank|konto|compte|cuenta",
         ahead=r"(?:[\x20]?[A-Z0-9]{4}){2,7}(?:[\x20]?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    # nine digits prove nothing by themselves: only context lifts them over the limit
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", 0.4, r"ssn|social|security", 0.6),
)
#: Characters of an account number, by country. Other codes may have any length.
LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU",
    31: "MT SC", 32: "LC", 33: "RU",
}
#: Code points before a span that are searched for context words, and what a find adds.
CONTEXT = 48
BONUS = 0.3
#: Lengths are summed in blocks, so a text with very many matches stays cheap.
BLOCK = 256


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True if the digits' Luhn sum is a multiple of ten."""
    each = F.transform(F.split(F.reverse(digits), "(?<=.)(?=.)"), lambda c, i: _luhn_digit(c.cast("int"), i))
    return F.aggregate(each, F.lit(0), lambda a, d: a + d) % 10 == 0


def _luhn_digit(digit: Column, index: Column) -> Column:
    twice = digit * 2
    return F.when(index % 2 == 0, digit).when(twice > 9, twice - 9).otherwise(twice)


def mod97(value: Column) -> Column:
    """True if the account number (letters as 10 to 35, first four characters last) leaves 1."""
    plain = F.regexp_replace(value, " ", "")
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    return (
        F.aggregate(
            F.split(turned, "(?<=.)(?=.)"),
            F.lit(0),
            lambda a, c: F.when(c >= "A", (a * 100 + F.ascii(c) - 55) % 97).otherwise((a * 10 + F.ascii(c) - 48) % 97),
        )
        == 1
    )


def confirmed(kind: str, value: Column) -> Column:
    """The check behind the pattern."""
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.lpad(p, 3, "0") <= "255"))
    if kind == "card":
        return let(_digits(value), lambda d: F.length(d).between(13, 19) & F.when(F.length(d) <= 19, luhn(d)))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    if kind == "iban":
        return F.length(F.regexp_replace(value, " ", "")).between(15, 34) & mod97(value)
    return F.lit(True)


def account(value: Column) -> Column:
    """The confirmed beginning of a proposed account number that ends at a word border, or null.

    The one of its country's length, or else the whole; of a country without a fixed length the longest. One in
    97 others passes by chance.
    """
    country = F.substring(value, 1, 2)
    length = F.coalesce(*[F.when(country.isin(codes.split()), n) for n, codes in LENGTHS.items()])

    def beginnings(words: Column) -> Column:
        lengths = F.sequence(F.size(words), F.lit(1), F.lit(-1))
        return F.transform(lengths, lambda n: F.array_join(F.slice(words, F.lit(1), n), " "))

    def chosen(passed: Column) -> Column:
        own = F.filter(passed, lambda b: F.length(F.replace(b, F.lit(" "), F.lit(""))) == length)
        longest = F.try_element_at(passed, F.lit(1))
        return F.coalesce(F.try_element_at(own, F.lit(1)), F.when(length.isNull() | (longest == value), longest))

    return let(F.filter(let(F.split(value, " "), beginnings), lambda b: confirmed("iban", b)), chosen)


def _apart(proposed: Column, kind: Kind) -> Column:
    """Confirmed spans that do not begin inside an earlier one, with scores by the context since that one."""
    start = F.expr("cast(array() as array<struct<kind:string,start:int,end:int,score:double>>)")

    def add(done: Column, s: Column) -> Column:
        since = F.coalesce(F.try_element_at(done, F.lit(-1))["end"], F.lit(0))
        near = F.right(s["near"], s["start"] - since)
        bonus = F.when(near.rlike(rf"\b(?:{kind.context})\b"), F.lit(BONUS)).otherwise(F.lit(0.0))
        fresh = F.struct(
            F.lit(kind.name).alias("kind"),
            s["start"].alias("start"),
            (s["start"] + s["size"]).alias("end"),
            F.least(F.lit(kind.score) + bonus, F.lit(1.0)).alias("score"),
        )
        return F.when(s["start"] >= since, F.concat(done, F.array(fresh))).otherwise(done)

    return F.aggregate(F.filter(proposed, lambda s: s["size"].isNotNull()), start, add)


def _found(text: Column, kind: Kind) -> Column:
    """array<struct<kind, start, end, score>> of one kind, by start."""
    pattern = f"{kind.pattern}(?=({kind.ahead}))" if kind.ahead else kind.pattern
    empty = F.expr("cast(array() as array<struct<kind:string,start:int,end:int,score:double>>)")

    def located(pair: Column) -> Column:
        matches = pair["matches"]
        lengths = F.zip_with(pair["gaps"], matches, lambda g, m: F.length(g) + F.coalesce(F.length(m), F.lit(0)))

        def placed(at: Column) -> Column:
            def one(m: Column, i: Column) -> Column:
                block = F.floor(i / BLOCK).cast("int")
                inside = F.slice(at["lengths"], block * BLOCK + 1, i - block * BLOCK)
                start = (
                    F.element_at(at["starts"], block + 1)
                    + F.aggregate(inside, F.lit(0), lambda a, x: a + x)
                    + F.length(F.element_at(pair["gaps"], i + 1))
                )
                before = F.lower(F.element_at(pair["gaps"], i + 1))
                near = F.substring(before, F.greatest(F.length(before) - CONTEXT + 1, F.lit(1)), F.lit(CONTEXT))
                if kind.ahead:
                    whole = F.concat(m, F.element_at(pair["ahead"], i + 1))
                    return F.struct(start.alias("start"), F.length(account(whole)).alias("size"), near.alias("near"))
                bonus = F.when(near.rlike(rf"\b(?:{kind.context})\b"), F.lit(BONUS)).otherwise(F.lit(0.0))
                return F.struct(
                    F.lit(kind.name).alias("kind"),
                    start.alias("start"),
                    (start + F.length(m)).alias("end"),
                    F.least(F.lit(kind.score) + bonus, F.lit(1.0)).alias("score"),
                    confirmed(kind.name, m).alias("ok"),
                )

            if kind.ahead:
                return _apart(F.transform(matches, one), kind)
            kept = F.filter(F.transform(matches, one), lambda s: s["ok"] & (s["score"] >= kind.least))
            return F.transform(
                kept,
                lambda s: F.struct(
                    s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["score"].alias("score")
                ),
            )

        def blocks(ls: Column) -> Column:
            sums = F.transform(
                F.sequence(F.lit(0), F.floor(F.size(ls) / BLOCK).cast("int")),
                lambda b: F.aggregate(F.slice(ls, b * BLOCK + 1, BLOCK), F.lit(0), lambda a, x: a + x),
            )
            return let(
                sums,
                lambda t: F.transform(
                    t, lambda _, b: F.aggregate(F.slice(t, F.lit(1), b), F.lit(0), lambda a, x: a + x)
                ),
            )

        return let(
            lengths, lambda ls: let(F.struct(ls.alias("lengths"), blocks(ls).alias("starts")), lambda at: placed(at))
        )

    def matched(matches: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        ahead = [F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias("ahead")] if kind.ahead else []
        return F.when(
            F.size(matches) > 0,
            let(F.struct(matches.alias("matches"), gaps.alias("gaps"), *ahead), located),
        ).otherwise(empty)

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), matched)


def spans(text: Column, kinds: tuple[Kind, ...] = KINDS) -> Column:
    """All confirmed spans of a text, by kind and then start: array<struct<kind, start, end, score>>.

    Code points, end exclusive. Spans of one kind do not overlap, those of different
    kinds may. Null and empty texts have none.
    """
    safe = F.coalesce(text, F.lit(""))
    return F.flatten(F.array(*[_found(safe, k) for k in kinds]))


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, scores.

    One row per row of `docs`; repeated rows repeat, null ids stay null, null texts
    count as empty, an empty table gives no rows, other columns are not read.
    """
    base = [k.name for k in KINDS[:4]]
    found = docs.select("doc_id", spans(F.col("text")).alias("found"))

    def joined(which: Column, *fields: str) -> Column:
        parts = F.transform(which, lambda s: F.concat_ws(":", *[s[f].cast("string") for f in fields]))
        return F.array_join(parts, ",")

    own = F.filter("found", lambda s: s["kind"].isin(base))
    counts = [F.size(F.filter("found", _is(k))).cast("long").alias(f"n_{k}") for k in base]
    return found.select(
        "doc_id", *counts,
        F.sha2(joined(own, "kind", "start", "end"), 256).alias("base_sha256"),
        joined(F.col("found"), "kind", "start", "end").alias("spans"),
        joined(F.col("found"), "kind", "start", "score").alias("scores"),
    )


def _is(kind: str):
    return lambda s: s["kind"] == kind


def masked(text: Column) -> Column:
    """The text with each span, or run of overlapping spans, replaced by its kind in brackets.

    Overlapping spans take the kind of the first one. Null stays null.
    """

    def merge(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"])
        fresh = F.struct(s["start"], s["end"], s["kind"])
        return F.when(
            (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] > s["start"]),
            F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(longer)),
        ).otherwise(F.concat(done, F.array(fresh)))

    def rebuilt(found: Column) -> Column:
        by_start = F.array_sort(F.transform(found, lambda s: F.struct(s["start"], s["end"], s["kind"])))
        start = F.expr("cast(array() as array<struct<start:int,end:int,kind:string>>)")
        merged = F.aggregate(by_start, start, merge)

        def pieces(ms: Column) -> Column:
            def piece(m: Column, i: Column) -> Column:
                since = F.when(i > 0, F.try_element_at(ms, i)["end"]).otherwise(F.lit(0))
                gap = F.substring(text, since + 1, m["start"] - since)
                return F.concat(gap, F.lit("["), F.upper(m["kind"]), F.lit("]"))

            tail = F.substring(text, F.element_at(ms, -1)["end"] + 1, F.length(text))
            return F.concat(F.array_join(F.transform(ms, piece), ""), tail)

        return let(merged, pieces)

    return let(spans(text), lambda found: F.when(F.size(found) > 0, rebuilt(found)).otherwise(text))
