"""Personal data: patterns propose spans, checksums confirm them, context moves the score.

Everything is a column expression. ``regexp_extract_all`` gives the matches and
``split`` by the same pattern the text between them, so the running sum of lengths
gives every start and end in code points. The patterns never rescan a run of
characters: a match may only begin at the head of its run or where the last match
ended. A text without a piece that every match which counts must hold is not searched
at all: for a card that is sixteen digits with at most one separator between two.

Base kinds (email, ip, card, phone) stay as found and checked. IBANs are confirmed by
mod-97. National numbers (three, two and four digits) have no checksum: they need
words nearby that name them. Each span carries a score: the prior of its kind, plus
``CONTEXT_WEIGHT`` where one of the kind's words stands within ``NEARBY`` characters
before or after it; added kinds are kept from ``KEEP_SCORE`` on.

Null text is empty and has no spans. Rows are judged alone, so ties, repeats, empty
tables and extra columns have no effect; :func:`masked_documents` keeps all columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaseload.llm.common import text_or_empty

NEARBY = 40
CONTEXT_WEIGHT = 0.3
KEEP_SCORE = 0.6

# Splits a text into its characters.
EACH = "(?!^|$)"
LOCAL = "A-Za-z0-9._%+-"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    gate: str
    prior: float
    words: str


# Fixed patterns of the base kinds, each held to the heads of its runs, which is where
# the leftmost match begins; then the added kinds.
KINDS = (
    Kind("email", rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "@", 0.9, "mail|contact|write"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", 0.7, "address|host|server|ip"),
    Kind("card", r"[0-9][0-9 -]*[0-9]", r"(?:[0-9][ -]?+){15}[0-9]", 0.8, "card|visa|credit|pay"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9]", 0.7, "call|phone|tel|mobile|fax"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", r"[A-Z]{2}[0-9]{2}", 0.8, "iban|bank|account"),
    Kind("national_id", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"[0-9]{3}-[0-9]{2}-", 0.4, "ssn|social|security|taxpayer"),
)
BASE = ("email", "ip", "card", "phone")


def digits_of(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a text of digits passes the Luhn check."""
    values = F.transform(F.split(F.reverse(digits), EACH), lambda d: F.ascii(d) - 48)
    doubled = F.transform(
        values, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2)
    )
    return F.aggregate(doubled, F.lit(0), lambda total, d: total + d) % 10 == 0


def mod_97(found: Column) -> Column:
    """Whether an IBAN's rearranged digits leave 1 when divided by 97."""
    plain = F.replace(found, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))
    values = F.transform(F.split(turned, EACH), lambda c: F.ascii(c) - F.when(c <= "9", 48).otherwise(55))
    rest = F.aggregate(
        values, F.lit(0), lambda total, v: (total * F.when(v > 9, 100).otherwise(10) + v) % 97
    )
    return F.length(plain).between(15, 34) & (rest == 1)


def confirmed(kind: str, found: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(found, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(parts, lambda p: (F.length(p) < 4) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        digits = digits_of(found)
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits_of(found)).between(8, 15)
    if kind == "iban":
        return mod_97(found)
    return F.lit(True)


def searched(kind: Kind, text: Column) -> Column:
    """The text a kind's pattern runs on: of the same length, place by place.

    A card may hold one space or hyphen between two digits; any other is blotted out
    first, so a run of digits and separators is one plain character class.
    """
    return F.regexp_replace(text, "(?<![0-9])[ -]|[ -](?![0-9])", "x") if kind.name == "card" else text


def spans_of_kind(kind: Kind, text: Column) -> Column:
    """array<struct<kind, start, end, found, score>> in order of start."""
    where = searched(kind, text)
    matches = F.regexp_extract_all(where, F.lit(kind.pattern), F.lit(0))
    between = F.split(where, kind.pattern, -1)
    # Length up to and with each match: sums over pieces and matches in turn.
    steps = F.zip_with(
        matches,
        F.slice(between, 1, F.size(matches)),
        lambda m, b: F.struct(F.length(b).cast("bigint").alias("gap"), F.length(m).cast("bigint").alias("size"), m.alias("found")),
    )
    start_of = F.struct(
        F.lit(0).cast("bigint").alias("upto"),
        F.array().cast("array<struct<start:bigint,end:bigint,found:string>>").alias("spans"),
    )

    def add(acc: Column, step: Column) -> Column:
        start = acc["upto"] + step["gap"]
        span = F.struct(start.alias("start"), (start + step["size"]).alias("end"), step["found"].alias("found"))
        ok = confirmed(kind.name, step["found"])
        return F.struct(
            (start + step["size"]).alias("upto"),
            F.when(ok, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"),
        )

    checked = F.aggregate(steps, start_of, add)["spans"]

    def scored(span: Column) -> Column:
        begin = F.greatest(span["start"] - NEARBY, F.lit(0).cast("bigint"))
        around = F.concat_ws(
            " ",
            F.substr(text, (begin + 1).cast("int"), (span["start"] - begin).cast("int")),
            F.substr(text, (span["end"] + 1).cast("int"), F.lit(NEARBY)),
        )
        named = F.lower(around).rlike(rf"(?<![a-z])(?:{kind.words})")
        return F.struct(
            F.lit(kind.name).alias("kind"),
            span["start"].alias("start"),
            span["end"].alias("end"),
            (F.lit(kind.prior) + F.when(named, CONTEXT_WEIGHT).otherwise(0.0)).alias("score"),
        )

    listed = F.transform(checked, scored)
    if kind.name not in BASE:
        listed = F.filter(listed, lambda span: span["score"] >= KEEP_SCORE)
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,score:double>>")
    return F.when(text.rlike(kind.gate), listed).otherwise(none)


def spans(text: Column) -> Column:
    """All spans of a text, by kind in the order of ``KINDS``, then by start."""
    return F.concat(*[spans_of_kind(kind, text) for kind in KINDS])


def joined_spans(listed: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(
        F.transform(
            listed, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def found_in(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): the spans of every row."""
    return docs.select("doc_id", spans(text_or_empty("text")).alias("spans"))


def masked(text: Column, listed: Column) -> Column:
    """The text with each stretch covered by spans replaced by the name of its first span."""
    ordered = F.array_sort(
        F.transform(listed, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    pieces = F.aggregate(
        ordered,
        F.struct(F.lit(0).cast("bigint").alias("upto"), F.array().cast("array<string>").alias("out")),
        lambda acc, s: F.when(
            s["start"] >= acc["upto"],
            F.struct(
                s["end"].alias("upto"),
                F.concat(
                    acc["out"],
                    F.array(
                        F.substr(text, (acc["upto"] + 1).cast("int"), (s["start"] - acc["upto"]).cast("int")),
                        F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")),
                    ),
                ).alias("out"),
            ),
        ).otherwise(F.struct(F.greatest(acc["upto"], s["end"]).alias("upto"), acc["out"].alias("out"))),
    )
    rest = F.substr(text, (pieces["upto"] + 1).cast("int"))
    return F.when(F.size(listed) > 0, F.concat(F.array_join(pieces["out"], ""), rest)).otherwise(text)


def masked_documents(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs``; personal data in ``text`` is masked.

    A null text stays null. ``n_chars``, where the table has it, is counted anew.
    """
    text = F.when(F.col("text").isNotNull(), masked(F.col("text"), spans(F.col("text"))))
    done = docs.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind))
        done = done.withColumn("n_chars", changed)
    return done.select(docs.columns)
