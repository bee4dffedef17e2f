"""Personal data spans: patterns propose, checksums confirm, context words adjust.

Everything runs as column expressions in the JVM. A pattern's matches and the gaps
between them (the text split by the same pattern) give each span's place: the lengths
of the gaps and matches before it. Card numbers pass Luhn, IBANs mod 97, address parts
are at most 255; kind words near a span raise its score, other words lower it. The
four base kinds are kept at any score; the kinds added to them need `least`.

The patterns are written so that no start is tried twice: runs are possessive, and a
match begins where the last one ended (\\G) or where its run begins. That finds the
same leftmost matches and keeps long runs linear.

Defined results: null text = empty text = no spans; positions are code points, end
exclusive; spans of different kinds may overlap and are all reported; repeated rows
are searched each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.llm.common import clean, table

WINDOW = 40
LEAST = 0.5


@dataclass(frozen=True)
class Kind:
    """pattern proposes; hint is a substring or class that any match needs; score before context."""

    name: str
    pattern: str
    hint: str
    score: float
    near: str
    far: str = ""
    base: bool = True


LOCAL = "[A-Za-z0-9._%+-]"
#: Base kinds in the order that breaks ties of a start, then the added ones.
KINDS = [
    Kind("email", rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.9, "mail|contact|write|correo|courriel"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "[0-9]\\.[0-9]", 0.6, "host|server|address|ip|login", "version|release|section"),
    Kind("card", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])", "[0-9][ -]?[0-9]", 0.7, "card|visa|master|credit|karte|tarjeta|carte", "isbn|order|serial"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", "+", 0.6, "phone|call|tel|fax|mobile"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", "[A-Z]{2}[0-9]{2}", 0.8, "iban|bank|account|konto|cuenta|compte", base=False),
    Kind("ssn", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", "[0-9]-[0-9]", 0.35, "ssn|social|security", base=False),
]
NUMBER = {k.name: n for n, k in enumerate(KINDS)}
PART = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(x: Column) -> Column:
    """Whether the digits of x pass the Luhn check."""
    turned = F.split(F.reverse(_digits(x)), "")
    doubled = F.transform(turned, lambda d, i: F.when(i % 2 == 1, d.cast("int") * 2).otherwise(d.cast("int")))
    total = F.aggregate(doubled, F.lit(0), lambda a, d: a + F.when(d > 9, d - 9).otherwise(d))
    return total % 10 == 0


def mod97(x: Column) -> Column:
    """Whether an IBAN's rearranged number leaves 1 modulo 97."""
    plain = F.replace(x, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))
    values = F.transform(F.split(turned, ""), lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55))
    return F.aggregate(values, F.lit(0), lambda a, v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97) == 1


CONFIRM = {
    "email": lambda x: F.lit(True),
    "ip": lambda x: x.rlike(rf"^{PART}\.{PART}\.{PART}\.{PART}$"),
    "card": luhn,
    "phone": lambda x: F.length(_digits(x)).between(9, 15),
    "iban": mod97,
    "ssn": lambda x: F.lit(True),
}


def _total(parts: Column, n: Column) -> Column:
    return F.aggregate(F.slice(parts, F.lit(1), n), F.lit(0), lambda a, x: a + F.length(x))


def _of_kind(text: Column, kind: Kind) -> Column:
    """array<struct<start, kind_no, end, kind, value, score>> of one kind. The matches
    are bound to a lambda's variable, so each pattern runs once over a text, and the
    split only where something is confirmed."""

    def place(found: Column, kept: Column) -> Column:
        gaps = F.split(text, kind.pattern, -1)

        def span(held: Column, k: Column) -> Column:
            start = _total(held, k["at"] + 1) + _total(found, k["at"])
            end = start + F.length(k["value"])
            first = F.greatest(start - WINDOW, F.lit(0))
            around = F.lower(F.concat(F.substring(text, first + 1, start - first), F.lit(" "), F.substring(text, end + 1, F.lit(WINDOW))))
            score = F.lit(kind.score) + F.when(around.rlike(rf"\b(?:{kind.near})"), 0.2).otherwise(0.0)
            if kind.far:
                score = score - F.when(around.rlike(rf"\b(?:{kind.far})"), 0.3).otherwise(0.0)
            return F.struct(start.alias("start"), F.lit(NUMBER[kind.name]).alias("kind_no"), end.alias("end"),
                            F.lit(kind.name).alias("kind"), k["value"].alias("value"),
                            F.least(F.lit(1.0), F.round(score, 2)).alias("score"))

        return F.flatten(F.transform(F.array(gaps), lambda held: F.transform(kept, lambda k: span(held, k))))

    def confirmed(found: Column) -> Column:
        at = F.transform(found, lambda v, i: F.struct(v.alias("value"), i.alias("at")))
        return F.filter(at, lambda k: CONFIRM[kind.name](k["value"]))

    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    nested = F.transform(F.array(found), lambda f: F.flatten(F.transform(
        F.filter(F.array(confirmed(f)), lambda kept: F.size(kept) > 0), lambda kept: place(f, kept))))
    spans = F.flatten(nested)
    if not kind.base:
        spans = F.filter(spans, lambda s: s["score"] >= LEAST)
    hint = text.contains(kind.hint) if len(kind.hint) == 1 else text.rlike(kind.hint)
    return F.when(hint, spans).otherwise(F.array().cast(SPANS))


SPANS = "array<struct<start:int,kind_no:int,end:int,kind:string,value:string,score:double>>"


def spans_of(text: Column) -> Column:
    """All spans of a text by start, then kind."""
    return F.array_sort(F.concat(*(_of_kind(text, k).cast(SPANS) for k in KINDS)))


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) of every row: start, end, kind, value and score of each span."""
    rows = clean(df, id_col, text_col)
    return rows.select(F.col("doc_id").alias(id_col), spans_of(F.col("text")).alias("spans"))


def redacted(text: Column) -> Column:
    """The text with each span replaced by its kind in brackets; spans that overlap
    become one, named by the first."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a: Column, s: Column) -> Column:
        clear = s["start"] >= a["at"]
        piece = F.concat(F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"),
                        F.when(clear, F.concat(a["out"], piece)).otherwise(a["out"]).alias("out"))

    def whole(spans: Column) -> Column:
        return F.aggregate(spans, start, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))

    return F.transform(F.array(spans_of(text)), lambda s: F.when(F.size(s) > 0, whole(s)).otherwise(text))[0]


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op8_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin([k.name for k in KINDS if k.base]))

    def number(k: Kind) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == k.name)).cast("long").alias(f"n_{k.name}")

    count = [number(k) for k in KINDS if k.base]
    return found.select("doc_id", *count, F.sha2(_joined(base), 256).alias("base_sha256"),
                        _joined(F.col("spans")).alias("spans"))
