"""Personal data: regular expressions propose spans, checksums confirm them, context words adjust a score
(DataFrame functions only).

Every kind's matches are leftmost and non-overlapping.  ``split`` gives the text between matches and
``regexp_extract_all`` the matches; running sums of their lengths give code-point offsets.  Patterns that could start in
the middle of a long run of their own first class are anchored to the run's start or the end of the previous match
(``\\G``), and use possessive repeats, so that time is linear in the text however it looks; the matches are the same.

A proposed IBAN is cut to its country's length, so that capitals or digits after it don't hide it; one of a country that isn't
registered is reported only with a context word before it.  So are secrets: long runs of letters and digits, mixed as in
keys, are nothing by themselves and count behind a word such as ``token`` or ``key``.

Edge cases: null or empty text has no spans; null doc_id and repeated rows are kept as they are; very long texts take time in
proportion to their length, however many matches they have; matches of one kind don't overlap, those of unlike kinds may and are
all reported; extra columns are kept, whatever their names: only columns called ``pii_<kind>`` are replaced; an empty table
gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame, functions as F

from .shared import fresh


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    hint: str  # cheap test that any match implies
    valid: Callable[[Column], Column]
    base_score: float
    context: str  # beginnings of words before the match that raise its score
    least: float = 0.0  # spans with a lower score are not reported; 0 for the base kinds
    whole: Callable[[Column], Column] | None = None  # the pattern's match is a head, its group 1 what may follow; this gives the value that both hold, or null
    weak: Callable[[Column], Column] | None = None  # values that need a context word to be reported
    bonus: float = 0.2  # what a context word adds


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _characters(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def luhn(d: Column) -> Column:
    """Luhn's checksum over a string of digits."""
    total = F.aggregate(
        F.transform(F.reverse(_characters(d)), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int"))),
        F.lit(0),
        lambda a, x: a + x,
    )
    return total % 10 == 0


def mod97(m: Column) -> Column:
    """ISO 13616: the first four characters go last, letters count as 10 to 35, the number leaves 1 modulo 97."""
    s = F.upper(F.regexp_replace(m, "[\x20]", ""))
    turned = F.concat(F.substring(s, 5, 64), F.substring(s, 1, 4))
    rest = F.aggregate(
        _characters(turned),
        F.lit(0),
        lambda a, c: F.when(c.between("0", "9"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97),
    )
    return F.length(s).between(15, 34) & (rest == 1)


def mixed(m: Column) -> Column:
    """Letters and digits take turns, as in keys: at least four changes between them, and ten different characters."""
    turns = F.regexp_count(m, F.lit("[A-Za-z][0-9]|[0-9][A-Za-z]"))
    return (turns >= 4) & (F.size(F.array_distinct(_characters(m))) >= 10)


def _phone(m: Column) -> Column:
    return F.length(digits(m)).between(9, 15)


def _card(m: Column) -> Column:
    d = digits(m)
    return F.when(F.length(d).between(13, 19), luhn(d)).otherwise(F.lit(False))


def _ip(m: Column) -> Column:
    return F.forall(F.split(m, r"\."), lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3) & (F.substring(F.concat(F.lit("00"), F.regexp_replace(p, "^0+", "")), -3, 3) <= "255"))


#: ISO 13616: length of an IBAN by country
_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH CR HR LI LV",
    22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_REGISTERED = "^(?:" + "|".join(rf"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, c in _LENGTHS.items()) + ")(?![A-Za-z0-9])"
_COUNTRIES = "^(?:" + "|".join(c for v in _LENGTHS.values() for c in v.split()) + ")"


def _iban(run: Column) -> Column:
    """The IBAN that a run of capitals and digits begins with: as long as its country's are; for a country that isn't
    registered, the longest one with a valid checksum that ends at a border."""
    own = F.regexp_extract(run, _REGISTERED, 0)
    cut = lambda n: F.call_function("regexp_extract", run, F.concat(F.lit(r"^[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){"), n.cast("string"), F.lit("}(?![A-Za-z0-9])")), F.lit(0))
    some = F.filter(F.transform(F.sequence(F.lit(30), F.lit(11), F.lit(-1)), cut), lambda x: (x != "") & mod97(x))
    return F.when(run.rlike(_COUNTRIES), F.when((own != "") & mod97(own), own)).otherwise(F.get(some, F.lit(0)))


_EMAIL = "A-Za-z0-9._%+-"
KINDS = (
    Kind("email", rf"(?:\G|(?<![{_EMAIL}]))[{_EMAIL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", lambda m: F.lit(True), 0.8, r"mail|contact|write"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", _ip, 0.6, r"ip|server|host|address"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"(?:[0-9][\x20-]?){13}", _card, 0.7, r"card|visa|pay|credit"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", _phone, 0.6, r"phone|tel|call|mobile"),
    Kind("secret", r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{20,}+", r"[A-Za-z0-9_+/-]{20}", lambda m: mixed(m), 0.3, r"token|secret|key|passw|pwd|auth|bearer|credential", 0.5, bonus=0.4),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=((?:\x20?[A-Z0-9]){11,30}[A-Za-z0-9]?))", r"[A-Z]{2}[0-9]{2}", lambda m: F.lit(True), 0.6, r"iban|account|bank|konto", 0.5, _iban, lambda m: ~m.rlike(_COUNTRIES)),
)
BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "secret")
NEAR = 24


def _spans(k: Kind, own: dict[str, str]) -> Column:
    """The confirmed matches as array<struct<kind, start, end, value, score>>, from the kind's own columns."""
    matches, pieces, starts = (F.col(own[x]) for x in ("v" if k.whole else "m", "p", "a"))
    base = lambda m: F.lit(k.base_score) - F.when(k.weak(m), 0.2).otherwise(0.0) if k.weak else F.lit(k.base_score)
    near = lambda i: F.lower(F.substring(F.get(pieces, i), -NEAR, NEAR)).rlike(rf"(?<!\p{{L}})(?:{k.context})")
    found = F.transform(
        matches,
        lambda m, i: F.struct(
            F.lit(k.name).alias("kind"), F.get(starts, i).alias("start"), (F.get(starts, i) + F.length(m)).alias("end"), m.alias("value"),
            F.least(F.lit(1.0), base(m) + F.when(near(i), k.bonus).otherwise(0.0)).alias("score"),
        ),
    )
    good = F.filter(found, lambda s: k.valid(s["value"]) & (s["score"] >= k.least))
    if not k.whole:
        return good
    # heads may lie within an earlier value
    good = F.filter(good, lambda s: s["value"].isNotNull())
    return F.filter(good, lambda s, i: ~F.exists(F.slice(good, F.greatest(i - HEADS, F.lit(0)) + 1, F.least(i, F.lit(HEADS))), lambda x: x["end"] > s["start"]))


#: an IBAN holds at most 34 letters and digits with single blanks, so less than this many heads of four
HEADS = 17
#: matches whose offsets are summed up in one go
GO = 256


def _sums(steps: Column) -> Column:
    """struct<at: the sum of all steps (gap, len), out: the offset of each step's match>. Its array is copied for each step."""
    return F.aggregate(
        steps,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
        lambda acc, x: F.struct((acc["at"] + x["gap"] + x["len"]).alias("at"), F.concat(acc["out"], F.array(acc["at"] + x["gap"])).alias("out")),
    )


def _starts(m: str, p: str) -> Column:
    """Code-point offset of each match: running sums over the lengths of what stands between and of the matches; of many
    matches, within and then over stretches of GO."""
    steps = F.transform(m, lambda x, i: F.struct(F.length(F.get(F.col(p), i)).alias("gap"), F.length(x).alias("len")))
    parts = F.transform(F.sequence(F.lit(0), F.size(m) - 1, F.lit(GO)), lambda i: _sums(F.slice(steps, i + 1, GO)))
    begins = _sums(F.transform(parts, lambda x: F.struct(F.lit(0).alias("gap"), x["at"].alias("len"))))["out"]
    many = F.flatten(F.zip_with(parts, begins, lambda x, at: F.transform(x["out"], lambda y: y + at)))
    return F.when(F.size(m) <= GO, _sums(steps)["out"]).otherwise(many)


def find(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """Adds ``pii_<kind>``, an array<struct<kind, start, end, value, score>> in order of start, for each kind."""
    docs = docs.drop(*(f"pii_{k.name}" for k in kinds))
    own = {k.name: dict(zip("mpav", fresh(docs, *(f"pii_{k.name}_{x}" for x in "mpav")))) for k in kinds}
    t = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast("array<string>")
    may = {k.name: F.contains(t, F.lit(k.hint)) if k.hint == "@" else t.rlike(k.hint) for k in kinds}
    d = docs.withColumns({own[k.name]["m"]: F.when(may[k.name], F.regexp_extract_all(t, F.lit(k.pattern), F.lit(0))).otherwise(none) for k in kinds})
    some = {k.name: F.size(own[k.name]["m"]) > 0 for k in kinds}
    d = d.withColumns({own[k.name]["p"]: F.when(some[k.name], F.split(t, k.pattern, -1)).otherwise(none) for k in kinds})
    for k in kinds:
        if k.whole:
            after = F.when(some[k.name], F.regexp_extract_all(t, F.lit(k.pattern), F.lit(1))).otherwise(none)
            d = d.withColumn(own[k.name]["v"], F.transform(F.zip_with(own[k.name]["m"], after, lambda a, b: F.concat(a, b)), k.whole))
    d = d.withColumns({own[k.name]["a"]: F.when(some[k.name], _starts(own[k.name]["m"], own[k.name]["p"])).otherwise(F.array().cast("array<int>")) for k in kinds})
    d = d.withColumns({f"pii_{k.name}": _spans(k, own[k.name]) for k in kinds})
    return d.drop(*[c for names in own.values() for c in names.values()])


def digest(spans: list[Column]) -> Column:
    """kind:start:end, comma-joined, of arrays of spans."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.concat(*[F.transform(x, one) for x in spans]), ",")


def redact(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """docs with each kind's confirmed matches replaced by [KIND] in text, kinds one after another."""
    out = docs
    for k in kinds:
        (cut,) = fresh(docs, f"pii_{k.name}")
        mine = out.withColumnsRenamed({c: f"pii_own_{c}" for c in out.columns if c.lower() == f"pii_{k.name}"})
        found = find(mine, (k,)).withColumnRenamed(f"pii_{k.name}", cut + "_cut")
        t, spans = F.coalesce(F.col("text"), F.lit("")), F.col(cut + "_cut")
        end = lambda i: F.coalesce(F.get(spans, i)["end"], F.lit(0))  # noqa: B023, E731
        kept = F.transform(spans, lambda s, i: F.concat(F.substr(t, end(i - 1) + 1, s["start"] - end(i - 1)), F.lit(f"[{k.name.upper()}]")))  # noqa: B023
        tail = F.substr(t, end(F.size(spans) - 1) + 1, F.length(t))
        text = F.when(F.size(spans) > 0, F.concat(F.array_join(kept, ""), tail)).otherwise(F.col("text"))
        out = found.withColumn("text", text).drop(cut + "_cut").withColumnsRenamed({f"pii_own_{c}": c for c in docs.columns if c.lower() == f"pii_{k.name}"})
    return out
