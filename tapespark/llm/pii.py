"""Personal data in texts: patterns propose spans, checksums confirm, context adjusts the score.

Everything here is DataFrame expressions.  A pattern's places follow from ``split`` and
``regexp_extract_all`` with the same pattern: the text is piece, match, piece, match, ...,
piece, so a match starts where the lengths before it end.

Patterns use possessive repeats and, where a run of characters could be tried from each of
its positions, start only at the run's first character or at the end of the match before.
Both leave the matches as they are and keep the time linear in the text.

Nulls count as empty texts.  An empty table gives an empty table.  Repeated rows and ids are
kept as they are; each row is looked at on its own, whatever its length.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Entries per block of the two-level prefix sums.
BLOCK = 128


@dataclass(frozen=True)
class Kind:
    """One kind of span. ``needs``: what a text must hold for the pattern to be worth trying."""

    name: str
    pattern: str
    needs: str
    prior: float
    words: str
    base: bool = True


#: Characters of an account number, by country.
ACCOUNT_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC",
    33: "RU",
}
#: A number of its country's length, and one of another length or country: the longest run of
#: words, which stops before a listed one and may hold words that follow the number.
LISTED = "(?:" + "|".join(
    f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:\\x20?+[A-Z0-9]){{{n - 4}}}"
    for n, countries in ACCOUNT_LENGTHS.items()
) + ")(?![A-Za-z0-9])"
COUNTRIES = "|".join(" ".join(ACCOUNT_LENGTHS.values()).split())
UNLISTED = (
    rf"[A-Z]{{2}}[0-9]{{2}}(?:(?:\x20(?!{LISTED}))?[A-Z0-9]){{11,30}}(?![A-Za-z0-9])"
)

#: The patterns' meaning is given, order is the order of kinds.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         "@", 0.9, "e-?mail|mail|contact|write|correo|courriel|schreib"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         ".", 0.7, "ip|address|host|server|adresse|servidor"),
    Kind("card", r"[0-9](?:[\x20-]?+[0-9])++",
         "", 0.8, "card|visa|mastercard|credit|payment|karte|carte|tarjeta"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]",
         "+", 0.7, "phone|call|tel|mobile|fax|telefon|téléphone|teléfono"),
    Kind("iban", rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{LISTED}|{UNLISTED})",
         "", 0.9, "iban|account|bank|konto|compte|cuenta", base=False),
)
RANK = {kind.name: at for at, kind in enumerate(KINDS)}
#: Code points on either side of a span in which its context words count.
NEAR = 40


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    total = F.aggregate(
        F.transform(
            F.split(F.reverse(digits), "(?!^)(?!$)"),
            lambda d, i: F.when(i % 2 == 0, d.cast("int"))
            .otherwise((d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int")),
        ),
        F.lit(0),
        lambda a, x: a + x,
    )
    return total % 10 == 0


def mod97(text: Column) -> Column:
    """Whether an account number's rearranged digits leave 1 modulo 97."""
    plain = F.regexp_replace(text, "\x20", "")
    turned = F.concat(F.substring(plain, 5, 99), F.substring(plain, 1, 4))
    left = F.aggregate(
        F.split(turned, "(?!^)(?!$)"),
        F.lit(0),
        lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + c.cast("int")) % 97)
        .otherwise((a * 100 + F.ascii(c) - 55) % 97),
    )
    return left == 1


def account(text: Column) -> Column:
    """Length of the account number a match starts with, null if none of its ends fits."""
    ends = F.sequence(F.lit(15), F.greatest(F.length(text), F.lit(15)))

    def fits(end):
        number = F.substring(text, F.lit(1), end)
        long_enough = F.length(F.regexp_replace(number, "\x20", "")) >= 15
        cut = F.substring(text, end + 1, F.lit(1)).rlike("[A-Z0-9]") | number.endswith(" ")
        listed = text.rlike(f"^(?:{COUNTRIES})")
        return (end == F.length(text)) & mod97(text) | ~listed & long_enough & ~cut & mod97(number)

    return F.array_max(F.filter(ends, fits))


def confirmed(kind: str, text: Column) -> Column:
    """Whether a proposed span is one of its kind."""
    if kind == "ip":
        return text.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$")
    if kind == "card":
        digits = _digits(text)
        return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(text)).between(10, 15)
    if kind == "iban":
        return account(text).isNotNull()
    return F.lit(True)


def _extent(kind: str, match: Column) -> Column:
    """Length of the span that a confirmed match stands for."""
    return account(match) if kind == "iban" else F.length(match)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def _spans(kind: Kind, pieces: Column, matches: Column, blocks: Column, lengths: Column) -> Column:
    """Spans from the pieces between the matches; ``lengths`` holds piece + match lengths."""

    def span(match, i):
        whole = (i / BLOCK).cast("int")
        before = _sum(F.slice(blocks, 1, whole)) + _sum(
            F.slice(lengths, whole * BLOCK + 1, i - whole * BLOCK)
        )
        start = before + F.length(F.get(pieces, i))
        near = F.concat_ws(
            " ", F.right(F.get(pieces, i), F.lit(NEAR)), F.left(F.get(pieces, i + 1), F.lit(NEAR))
        )
        told = F.lower(near).rlike(rf"(?<![a-z])(?:{kind.words})")
        return F.struct(
            start.alias("start"),
            F.lit(RANK[kind.name]).alias("rank"),
            F.lit(kind.name).alias("kind"),
            (start + _extent(kind.name, match)).alias("end"),
            F.when(told, F.lit(min(1.0, kind.prior + 0.1))).otherwise(F.lit(kind.prior)).alias("score"),
            confirmed(kind.name, match).alias("kept"),
        )

    return F.filter(F.transform(matches, span), lambda s: s["kept"])


def _matches(kind: Kind, text: Column) -> Column:
    worth = F.contains(text, F.lit(kind.needs)) if kind.needs else text.rlike("[0-9]")
    return F.when(worth, F.regexp_extract_all(text, F.lit(kind.pattern), 0)).otherwise(
        F.array().cast("array<string>")
    )


def _lengths(pieces: Column, matches: Column) -> Column:
    return F.zip_with(
        pieces, matches,
        lambda p, m: F.coalesce(F.length(p), F.lit(0)) + F.coalesce(F.length(m), F.lit(0)),
    )


def _blocks(lengths: Column) -> Column:
    """Sums of BLOCK entries each, so that a prefix sum adds few blocks and few entries."""
    return F.transform(
        F.sequence(F.lit(0), (F.size(lengths) / BLOCK).cast("int")),
        lambda b: _sum(F.slice(lengths, b * BLOCK + 1, BLOCK)),
    )


def find_spans(docs: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """``docs`` with ``out``: array of (start, rank, kind, end, score, kept), sorted by start.

    Positions are code points, the end is exclusive.  All other columns pass through; names
    starting with ``__pii`` are used in between.
    """
    names = [kind.name for kind in KINDS]
    df = docs.withColumn("__pii", F.coalesce(F.col(text), F.lit("")))
    df = df.withColumns({f"__pii_m_{k.name}": _matches(k, F.col("__pii")) for k in KINDS})
    df = df.withColumns({
        f"__pii_p_{k.name}": F.when(
            F.size(f"__pii_m_{k.name}") > 0, F.split("__pii", k.pattern, -1)
        )
        for k in KINDS
    })
    df = df.withColumns({
        f"__pii_l_{n}": _lengths(F.col(f"__pii_p_{n}"), F.col(f"__pii_m_{n}")) for n in names
    })
    df = df.withColumns({f"__pii_b_{n}": _blocks(F.col(f"__pii_l_{n}")) for n in names})
    found = [
        F.coalesce(
            _spans(k, *(F.col(f"__pii_{part}_{k.name}") for part in "pmbl")), F.array()
        )
        for k in KINDS
    ]
    return df.withColumn(out, F.array_sort(F.concat(*found))).select(*docs.columns, out)


def _told(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def _count(name: str) -> Column:
    return F.size(F.filter("pii", lambda s: s["kind"] == name)).cast("long")


def report(docs: DataFrame) -> DataFrame:
    """Counts per kind, the digest of the base spans, all spans and their scores, per row."""
    spans = find_spans(docs.select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["rank"] < sum(k.base for k in KINDS))
    count = {kind.name: _count(kind.name) for kind in KINDS}
    return spans.select(
        "doc_id",
        *(count[k.name].alias(f"n_{k.name}") for k in KINDS if k.base),
        F.sha2(_told(base), 256).alias("base_sha256"),
        _told(F.col("pii")).alias("spans"),
        count["iban"].alias("n_iban"),
        F.array_max(F.transform("pii", lambda s: s["score"])).alias("top_score"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every confirmed span of ``text`` replaced by its kind, as ``[EMAIL]``.

    Kinds are replaced one after the other in their order, so where spans overlap the
    earlier kind wins.  Null texts stay null.
    """
    df = docs
    for kind in KINDS:
        df = df.withColumn("__pii_m", _matches(kind, F.col("text")))
        df = df.withColumn(
            "__pii_p", F.when(F.size("__pii_m") > 0, F.split("text", kind.pattern, -1))
        )
        told = F.array_join(_replaced(kind, F.col("__pii_p"), F.col("__pii_m")), "")
        df = df.withColumn("text", F.when(F.size("__pii_m") > 0, told).otherwise(F.col("text")))
    return df.select(*docs.columns)


def _replaced(kind: Kind, pieces: Column, matches: Column) -> Column:
    mark = F.lit(f"[{kind.name.upper()}]")

    def shown(match):
        if kind.name != "iban":
            return mark
        return F.concat(mark, F.substring(match, _extent(kind.name, match) + 1, F.length(match)))

    return F.zip_with(
        pieces, matches,
        # The last piece has no match after it.
        lambda p, m: F.concat(
            p, F.when(m.isNull(), F.lit("")).when(confirmed(kind.name, m), shown(m)).otherwise(m)
        ),
    )
