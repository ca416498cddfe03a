r"""Personal data spans: patterns propose, checksums confirm, context scores.

Only Column expressions are used.  A kind's pattern gives its matches
(``regexp_extract_all``) and the text between them (``split``); the lengths of
both, summed up, give the places in code points.  Numbers pass their checks
(octets to 255, Luhn, digit counts, ISO 7064 mod 97-10); then words close
before or after a match raise its score.  The base kinds email, ip, card and
phone keep every confirmed match whatever its score; iban and ssn are added
where the score reaches ``MIN_SCORE``.

The patterns are written so that no text makes them slow or deep: a match is
only tried where a run of its characters begins or the last match ended, and
repeats are possessive, which changes no match of these patterns.

Defined results: null and empty texts have no spans (the SHA-256 is that of
the empty string).  Repeated rows give repeated results; extra columns pass
through, and columns named like an output are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwise.llm.common import table

CONTEXT_CHARS = 40
CONTEXT_RAISE = 0.3
MIN_SCORE = 0.5
CHUNK = 256

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE_KINDS = KINDS[:4]

_LOCAL = "[A-Za-z0-9._%+-]"
_IBAN_REST = "(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": rf"(?<![A-Za-z0-9])[A-Z]{{2}}[0-9]{{2}}{_IBAN_REST}(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
# what a text must hold before the pattern itself is tried
HINTS = {
    "email": "@",
    "ip": r"[0-9]\.[0-9]++\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){13}",
    "phone": r"\+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}[A-Z0-9\x20]",
    "ssn": r"-[0-9]{2}-",
}
SCORES = {"email": 0.7, "ip": 0.5, "card": 0.7, "phone": 0.6, "iban": 0.8, "ssn": 0.3}
CONTEXT = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write|courriel|correo)\b",
    "ip": r"(?i)\b(?:ip|address|host|server|login|adresse|direcci[oó]n)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|carte|karte|tarjeta)\b",
    "phone": r"(?i)\b(?:phone|tel|telephone|call|mobile|fax|cell|telefon|t[eé]l[eé]phone|tel[eé]fono)\b",
    "iban": r"(?i)\b(?:iban|account|bank|konto|compte|cuenta)\b",
    "ssn": r"(?i)\b(?:ssn|social security|tax id|taxpayer)\b",
}


def digits_of(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True where the digits pass the Luhn check."""
    doubled = F.transform(
        F.reverse(F.split(digits, "")),
        lambda d, i: F.when(i % 2 == 1, F.when(d.cast("int") > 4, d.cast("int") * 2 - 9)
                            .otherwise(d.cast("int") * 2)).otherwise(d.cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def mod97(account: Column) -> Column:
    """True where an account number passes ISO 7064 mod 97-10."""
    plain = F.regexp_replace(account, " ", "")
    turned = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))
    value = lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    rest = F.aggregate(F.split(turned, ""), F.lit(0),
                       lambda a, c: (a * F.when(c.rlike("[0-9]"), 10).otherwise(100) + value(c)) % 97)
    return rest == 1


def confirmed(kind: str, hit: Column) -> Column:
    if kind == "ip":
        octet = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
        return hit.rlike(rf"^(?:{octet}\.){{3}}{octet}$")
    if kind == "card":
        digits = digits_of(hit)
        return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits_of(hit)).between(10, 15)
    if kind == "iban":
        return F.length(F.regexp_replace(hit, " ", "")).between(15, 34) & mod97(hit)
    if kind == "ssn":
        return ~hit.rlike("^(?:000|666|9)") & ~hit.rlike("-00-|-0000$")
    return F.lit(True)


def with_places(pieces: Column) -> Column:
    """pieces (gap, hit, after) -> the same with ``start``, summed up in chunks
    so that the work grows with the number of pieces, not its square."""
    step = lambda p: F.length(p["gap"]) + F.length(p["hit"])
    zero = F.lit(0)
    chunks = F.transform(
        F.when(F.size(pieces) > 0, F.sequence(F.lit(1), F.size(pieces), F.lit(CHUNK)))
        .otherwise(F.array().cast("array<int>")),
        lambda c: F.slice(pieces, c, F.lit(CHUNK)))
    lengths = F.transform(chunks, lambda ps: F.aggregate(ps, zero, lambda a, p: a + step(p)))
    begins = F.aggregate(
        lengths, F.struct(zero.alias("at"), F.array().cast("array<int>").alias("out")),
        lambda a, n: F.struct((a["at"] + n).alias("at"),
                              F.concat(a["out"], F.array(a["at"])).alias("out")))["out"]

    def places(ps: Column, begin: Column) -> Column:
        starts = F.aggregate(
            ps, F.struct(begin.alias("at"), F.array().cast("array<int>").alias("out")),
            lambda a, p: F.struct((a["at"] + step(p)).alias("at"),
                                  F.concat(a["out"], F.array(a["at"] + F.length(p["gap"])))
                                  .alias("out")))["out"]
        return F.zip_with(ps, starts, lambda p, s: F.struct(
            s.alias("start"), p["gap"].alias("gap"), p["hit"].alias("hit"),
            p["after"].alias("after")))

    return F.flatten(F.zip_with(chunks, begins, places))


def kind_spans(text: Column, kind: str) -> Column:
    """Confirmed spans of one kind: array of (start, rank, end, kind, score)."""
    rank = KINDS.index(kind)
    pattern = F.lit(PATTERNS[kind])
    gaps = F.split(text, PATTERNS[kind], -1)
    pieces = F.zip_with(
        F.regexp_extract_all(text, pattern, F.lit(0)),
        F.arrays_zip(gaps.alias("g"), F.slice(gaps, F.lit(2), F.size(gaps)).alias("a")),
        lambda h, g: F.struct(g["g"].alias("gap"), h.alias("hit"), g["a"].alias("after")))
    # the text after the last match is one gap more
    placed = F.filter(with_places(F.filter(pieces, lambda p: p["hit"].isNotNull())),
                      lambda p: confirmed(kind, p["hit"]))

    def scored(p: Column) -> Column:
        near = F.concat_ws(" ", F.right(p["gap"], F.lit(CONTEXT_CHARS)),
                           F.substring(p["after"], 1, CONTEXT_CHARS))
        value = F.least(F.lit(1.0), F.lit(SCORES[kind])
                        + F.when(near.rlike(CONTEXT[kind]), CONTEXT_RAISE).otherwise(0.0))
        return F.struct(p["start"].alias("start"), F.lit(rank).alias("rank"),
                        (p["start"] + F.length(p["hit"])).alias("end"),
                        F.lit(kind).alias("kind"), value.alias("score"))

    spans = F.transform(placed, scored)
    if kind not in BASE_KINDS:
        spans = F.filter(spans, lambda s: s["score"] >= MIN_SCORE)
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,score:double>>")
    return F.when(text.rlike(HINTS[kind]), spans).otherwise(none)


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``found`` (base and added spans), arrays of
    (start, rank, end, kind, score) by start, then kind as listed."""
    keep = [c for c in docs.columns if c not in ("base", "found")]
    value = F.coalesce(F.col(text), F.lit(""))
    each = docs.select(*keep, *[kind_spans(value, k).alias(f"_{k}") for k in KINDS])
    return each.select(
        *keep, F.sort_array(F.concat(*[F.col(f"_{k}") for k in BASE_KINDS])).alias("base"),
        F.sort_array(F.concat(*[F.col(f"_{k}") for k in KINDS])).alias("found"))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined with commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with each run of overlapping spans replaced by the kind of its
    first one, in square brackets."""
    none = F.array().cast("array<struct<start:int,end:int,kind:string>>")

    def joined(runs: Column, s: Column) -> Column:
        last = F.element_at(runs, -1)
        fresh = F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
        longer = F.struct(last["start"].alias("start"),
                          F.greatest(last["end"], s["end"]).alias("end"),
                          last["kind"].alias("kind"))
        return F.when((F.size(runs) > 0) & (s["start"] < F.get(runs, F.size(runs) - 1)["end"]),
                      F.concat(F.slice(runs, F.lit(1), F.size(runs) - 1), F.array(longer))
                      ).otherwise(F.concat(runs, F.array(fresh)))

    runs = F.aggregate(spans, none, joined)
    ends = F.concat(F.array(F.lit(0)), F.transform(runs, lambda r: r["end"]))
    kept = F.zip_with(
        F.concat(runs, F.array(F.lit(None).cast("struct<start:int,end:int,kind:string>"))), ends,
        lambda r, at: F.when(r.isNull(), F.substr(text, at + 1)).otherwise(
            F.concat(F.substr(text, at + 1, r["start"] - at), F.lit("["), F.upper(r["kind"]),
                     F.lit("]"))))
    return F.when(F.size(spans) > 0, F.array_join(kept, "")).otherwise(text)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return docs.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"))
