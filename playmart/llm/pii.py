"""Personal data: patterns propose spans, checksums confirm them, context adjusts scores.

Column expressions only. Positions come from cutting the text at a pattern's
matches: the lengths of what lies between and of the matches add up to them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playmart.llm.common import documents

#: A proposed span of the added kinds stays from this score on.
THRESHOLD = 0.5
#: Characters before a span in which context words count, and what they add or take.
CONTEXT_CHARS, CONTEXT_WEIGHT = 40, 0.3

# The prescribed patterns, in forms that find the same matches without
# deep recursion or repeated starts inside one run of characters. A run of characters
# that may precede an @ is tried from its start only, or from the end of a match.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# A run of digits with single separators is matched whole or not at all, so its
# number of digits can be part of the pattern.
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
LOCAL_PHONE = r"(?<![0-9+(.-])(?<!\+[0-9]\x20)\([0-9]{3}\)\x20?[0-9]{3}-[0-9]{4}(?![0-9-])"
NATIONAL_PHONE = r"(?<![0-9+().-])(?<!\)\x20)(?<!\+[0-9]{1,3}\x20)[0-9]{3}[-.\x20][0-9]{3}[-.\x20][0-9]{4}(?![0-9-])"
SOCIAL = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
SECRET = r"(?i)\b(?:token|secret|passw(?:or)?d|api[_-]?key)\x20?[=:]\x20?[\"']?[A-Za-z0-9+/_=-]{16,}+[\"']?"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits pass the Luhn check: from the right, every second one is
    doubled, and the sum of all decimal digits is a multiple of ten."""
    each = F.split(F.reverse(digits(value)), "(?!^)(?!$)")
    doubled = F.transform(
        each,
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            F.when(d.cast("int") < 5, d.cast("int") * 2).otherwise(d.cast("int") * 2 - 9)
        ),
    )
    return F.aggregate(doubled, F.lit(0), lambda total, d: total + d) % 10 == 0


def mod_97(value: Column) -> Column:
    """Whether an account number passes: its first four characters moved to the end,
    letters read as 10 to 35, the number leaves 1 when divided by 97."""
    plain = F.regexp_replace(value, " ", "")
    moved = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))

    def put(rest: Column, c: Column) -> Column:
        letter = F.ascii(c) >= 65
        number = F.when(letter, F.ascii(c) - 55).otherwise(F.ascii(c) - 48)
        return (rest * F.when(letter, F.lit(100)).otherwise(F.lit(10)) + number) % 97

    return F.aggregate(F.split(moved, "(?!^)(?!$)"), F.lit(0), put) == 1


def small_parts(value: Column) -> Column:
    """Whether no part of a dotted number exceeds 255."""
    part = F.split(F.regexp_replace(value, r"(?<![0-9])0+(?=[0-9])", ""), r"\.")
    return F.forall(part, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255))


@dataclass(frozen=True)
class Kind:
    """A kind of personal data. ``needs``: what a text must contain to be searched.
    ``score``: what a confirmed match is worth without context; None keeps it always.
    ``context``: words before a match that speak for it; ``against``: those that do not."""

    name: str
    pattern: str
    needs: str | None = None
    check: object = None
    score: float | None = None
    context: str = ""
    against: str = ""


KINDS = [
    Kind("email", EMAIL, "@"),
    Kind("ip", IP, None, small_parts),
    Kind("card", CARD, None, luhn),
    Kind("phone", PHONE, "+", lambda v: F.length(digits(v)).between(10, 15)),
    Kind("iban", IBAN, None, mod_97, 0.7, "iban|account|konto|compte|cuenta"),
    Kind("local_phone", LOCAL_PHONE, "(", None, 0.6, "phone|call|tel|fax", "order|ticket|invoice|serial"),
    Kind("social", SOCIAL, None, None, 0.3, "ssn|social|security|insurance", "order|ticket|invoice|serial"),
    Kind("secret", SECRET, None, None, 0.6, "key|token|secret|password"),
    Kind("national_phone", NATIONAL_PHONE, None, None, 0.3, "phone|call|tel|fax", "order|ticket|invoice|serial"),
]
#: The first kinds are prescribed: a match that passes its check is never dropped.
BASE_KINDS = 4


def _matches(text: Column, kind: Kind, number: int) -> Column:
    """Confirmed spans of one kind: (start, kind_no, end, kind, score, value)."""
    between = F.split(text, kind.pattern, -1)
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    none = F.array().cast("array<struct<start:bigint,kind_no:int,end:bigint,value:string>>")

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["b"])
        end = start + F.coalesce(F.length(x["v"]), F.lit(0))
        span = F.struct(
            start.alias("start"), F.lit(number).alias("kind_no"), end.alias("end"), x["v"].alias("value")
        )
        return F.struct(
            end.alias("at"),
            F.when(x["v"].isNull(), acc["spans"]).otherwise(F.concat(acc["spans"], F.array(span))).alias("spans"),
        )

    zipped = F.arrays_zip(between.alias("b"), found.alias("v"))
    first = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("spans"))
    spans = F.aggregate(zipped, first, add, lambda acc: acc["spans"])
    if kind.check is not None:
        spans = F.filter(spans, lambda s: kind.check(s["value"]))
    base = 1.0 if kind.score is None else kind.score

    def scored(s: Column) -> Column:
        score = F.lit(base)
        held = F.least(s["start"], F.lit(CONTEXT_CHARS))
        before = F.lower(text.substr((s["start"] - held + 1).cast("int"), held.cast("int")))
        for words, weight in ((kind.context, CONTEXT_WEIGHT), (kind.against, -CONTEXT_WEIGHT)):
            if words:
                score = score + F.when(before.rlike(words), weight).otherwise(0.0)
        score = F.least(F.lit(1.0), F.round(score, 2))
        return F.struct(
            s["start"].alias("start"),
            s["kind_no"].alias("kind_no"),
            s["end"].alias("end"),
            F.lit(kind.name).alias("kind"),
            score.alias("score"),
            s["value"].alias("value"),
        )

    spans = F.transform(spans, scored)
    if kind.score is not None:
        spans = F.filter(spans, lambda s: s["score"] >= THRESHOLD)
    empty = F.array().cast(
        "array<struct<start:bigint,kind_no:int,end:bigint,kind:string,score:double,value:string>>"
    )
    searched = text.rlike(kind.pattern) if kind.needs is None else F.contains(text, F.lit(kind.needs))
    return F.when(searched, spans).otherwise(empty)


def find(docs: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """Add ``spans``: all personal data of the whole text, by start, kind and end.

    Each span has start and end (code points, end exclusive), kind, kind_no (the place
    in KINDS), score and value. Spans of different kinds may overlap. A null or empty
    text has none. Rows are judged each by itself: repeated rows get equal spans, an empty
    table stays empty, texts are read whole. Other columns stay; one that is called like ``spans`` is replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    each = [_matches(whole, kind, number) for number, kind in enumerate(KINDS)]
    return docs.withColumn(spans, F.array_sort(F.concat(*each)))


def mask(found: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """Replace every span in the text by its kind in brackets.

    Overlapping spans are replaced together, under the kind of the first. A null text
    stays null. The column ``spans`` stays.
    """
    whole = F.col(text)

    def put(acc: Column, s: Column) -> Column:
        between = whole.substr((acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        label = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] >= acc["at"], F.concat(acc["out"], between, label)).otherwise(acc["out"]).alias("out"),
        )

    def rest(acc: Column) -> Column:
        return F.concat(acc["out"], whole.substr((acc["at"] + 1).cast("int"), F.length(whole)))

    first = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    masked = F.when(F.size(spans) > 0, F.aggregate(F.col(spans), first, put, rest)).otherwise(whole)
    return found.withColumn(text, masked)


def _listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def _count(spans: Column, number: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind_no"] == number))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of all documents: counts, digest of the base spans, all spans."""
    found = find(documents(spark, sf_dir).select("doc_id", "text"))
    counts = [_count(F.col("spans"), n).cast("bigint").alias(f"n_{k.name}") for n, k in enumerate(KINDS[:BASE_KINDS])]
    base = F.filter("spans", lambda s: s["kind_no"] < BASE_KINDS)
    return found.select(
        "doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans")
    )
