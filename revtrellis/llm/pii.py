"""Personal data as spans, with built-in expressions only.

1. Regular expressions propose spans. Places come from cutting the text at the matches: a match starts behind all gaps
   and matches before it. Lengths are in code points.
2. Validators confirm them: parts of addresses, digit counts, Luhn for cards, mod-97 for account numbers (IBAN).
3. Context words near a span adjust its score.

The patterns are written so that a scan is linear: a run of characters is only entered at its start (or where the last
match ended), and repeats do not give back. They match what the plain forms would.

Base kinds and plain forms: email `[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`; ip, four numbers of at most 255;
card, 12 to 19 digits with single spaces or dashes between, passing Luhn; phone `\\+[0-9][ ().0-9-]+[0-9]`, 9 to 15 digits.
Further kinds. secret: a run of 20 or more letters, digits and `_+/=-` with letters, digits and eight different characters at
least; such a run may be any identifier, so only words before it (token, key, password and the like) lift its score above the
threshold. key: runs that begin like the access keys of known services. iban, as long as its country's numbers are (where a code has no length, up to the end of the run of capitals
and digits or the next number), so that what follows a number is not taken for a part of it. Its spans are looked ahead at:
every start of a word is tried, whatever the words before it look like. Of iban spans that overlap the first stays. Base
spans are never dropped; of the further ones only those stay that their validator confirms and that score MIN_SCORE or more.

Defined results: a null text counts as empty and has no spans; repeated rows are scanned each.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LOCAL = "[A-Za-z0-9._%+-]"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    #: a part of every match, to leave texts without it alone
    needs: str
    base: bool
    #: words that make a span near them more likely
    context: tuple[str, ...]
    prior: float
    #: characters a match takes if its span is looked ahead at, as group 1
    takes: int | None = None
    #: a cheaper pattern that every text with a match holds
    asks: str = "[0-9]"


#: Characters of an account number by country: the IBAN registry, and countries that use the form without being in it.
_IBAN_LENGTHS = {
    15: "NO",
    16: "BE",
    18: "DK FI FK FO GL NL SD",
    19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK",
    21: "CH CR HR LI LV",
    22: "BG BH DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES HN MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST",
    26: "DZ IR IS TR",
    27: "BF BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BJ BY CI CY DO GT HU LB ML MA NE NI PL SN SV TG",
    29: "BR EG PS QA UA",
    30: "JO KW MU YE",
    31: "MT SC",
    32: "LC",
    33: "RU",
}
_IBAN_FORMS = [f"(?:{c.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, c in _IBAN_LENGTHS.items()]
_IBAN_CODES = "|".join(_IBAN_LENGTHS.values()).replace(" ", "|")
#: Codes without a length; the run ends where a number of a country starts.
_IBAN_OTHERS = f"(?!{_IBAN_CODES})[A-Z]{{2}}[0-9]{{2}}(?:(?: (?!(?:{_IBAN_CODES})[0-9]{{2}}))?[A-Z0-9]){{11,30}}+"

#: A character of a secret.
_RUN = "[A-Za-z0-9_+/=-]"

KINDS = (
    Kind("email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", True, ("mail", "contact", "write"), 0.8),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", True, ("ip", "host", "server", "address"), 0.6),
    Kind("card", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])", "", True, ("card", "visa", "credit", "payment"), 0.6),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", "+", True, ("phone", "tel", "call", "mobile"), 0.7),
    Kind("iban", rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?=((?:{'|'.join([*_IBAN_FORMS, _IBAN_OTHERS])})(?![A-Za-z0-9])))[A-Z]{{2}}", "", False, ("iban", "account", "bank", "transfer"), 0.8, 2),
    Kind("secret", rf"(?<!{_RUN}){_RUN}{{20,}}+", "", False, ("token", "secret", "passw", "api[ _-]?key", "key", "bearer", "credential"), 0.45, asks=f"{_RUN}{{20}}"),
    Kind("key", r"(?<![A-Za-z0-9_])(?:AKIA[0-9A-Z]{16}|ghp_[A-Za-z0-9]{36}|xox[abp]-[A-Za-z0-9-]{10,}+)(?![A-Za-z0-9_])", "", False, ("key", "token", "secret"), 0.8, asks="AKIA|ghp_|xox[abp]-"),
)
CONTEXT_WINDOW = 48
CONTEXT_GAIN = 0.15
#: Spans of the further kinds that score less are left out.
MIN_SCORE = 0.5


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Does a string of digits pass Luhn's check? Every second digit from the right is doubled, nines are cast out of it."""
    places = F.sequence(F.lit(1), F.length(number))

    def add(total: Column, i: Column) -> Column:
        d = F.substring(number, -i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).otherwise(F.when(d < 5, d * 2).otherwise(d * 2 - 9))

    return F.when(F.length(number) > 0, F.aggregate(places, F.lit(0), add) % 10 == 0).otherwise(False)


def mod97(number: Column) -> Column:
    """Does an account number leave 1 modulo 97, its first four characters moved to the end and letters read as 10 to 35?"""
    plain = F.regexp_replace(number, " ", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def add(rest: Column, i: Column) -> Column:
        code = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(code < 65, rest * 10 + (code - 48)).otherwise(rest * 100 + (code - 55)) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        # at most 255 whatever the leading zeros
        return F.forall(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike(r"^(|[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return luhn(digits(match))
    if kind == "phone":
        return F.length(digits(match)).between(9, 15)
    if kind == "iban":
        return F.length(F.regexp_replace(match, " ", "")).between(15, 34) & mod97(match)
    if kind == "secret":
        return match.rlike("[0-9]") & match.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(match, ""))) >= 8)
    return F.lit(True)


def spans_of(text: Column, kind: Kind) -> Column:
    """Array of (start, end, kind, rank, score) of one kind, in text order; null text: null."""
    ahead = kind.takes is not None
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(int(ahead)))
    gaps = F.split(text, kind.pattern, -1)
    pair = F.zip_with(F.slice(gaps, 1, F.size(gaps) - 1), matches, lambda g, m: F.struct(F.length(g).alias("gap"), m.alias("match")))
    none = F.array().cast("array<struct<start:int,match:string>>")
    state = F.struct(F.lit(0).alias("at"), F.lit(0).alias("free"), none.alias("found"))

    def place(s: Column, p: Column) -> Column:
        start = s["at"] + p["gap"]
        good = _valid(kind.name, p["match"])
        if ahead:
            good = (start >= s["free"]) & good
        return F.struct(
            (start + (F.lit(kind.takes) if ahead else F.length(p["match"]))).alias("at"),
            F.when(good, start + F.length(p["match"])).otherwise(s["free"]).alias("free") if ahead else s["free"].alias("free"),
            # only what the validator confirms is kept, so the array stays as short as the answer
            F.when(good, F.concat(s["found"], F.array(F.struct(start.alias("start"), p["match"].alias("match"))))).otherwise(s["found"]).alias("found"),
        )

    placed = F.aggregate(pair, state, place, lambda s: s["found"])
    rank = KINDS.index(kind)

    def span(m: Column) -> Column:
        near = F.lower(F.substring(text, F.greatest(m["start"] - CONTEXT_WINDOW, F.lit(0)) + 1, F.least(m["start"], F.lit(CONTEXT_WINDOW))))
        told = near.rlike(r"\b(" + "|".join(kind.context) + r")")
        score = F.when(told, F.lit(min(1.0, kind.prior + CONTEXT_GAIN))).otherwise(F.lit(kind.prior - CONTEXT_GAIN))
        return F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), (m["start"] + F.length(m["match"])).alias("end"), F.lit(kind.name).alias("kind"), score.alias("score"))

    found = F.transform(placed, span)
    empty = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,score:double>>")
    candidate = text.contains(kind.needs) if kind.needs else text.rlike(kind.asks)
    return F.when(candidate, found).otherwise(empty)


def find_spans(docs: DataFrame, text_col: str = "text", out: str = "spans", min_score: float = MIN_SCORE) -> DataFrame:
    """The rows with their spans of all kinds, by start and then kind; further kinds below min_score are left out."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    parts = [spans_of(text, k) if k.base else F.filter(spans_of(text, k), lambda s: s["score"] >= min_score) for k in KINDS]
    return docs.withColumn(out, F.array_sort(F.concat(*parts)))


def redact(docs: DataFrame, text_col: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """The rows with every span replaced by its kind in angle brackets. Overlapping spans are merged and take the first one's kind."""
    text = F.col(text_col)
    found = find_spans(docs, text_col, "_spans", min_score)
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("at"))
    joined = F.aggregate(
        F.col("_spans"),
        start,
        lambda s, p: F.when(
            p["start"] >= s["at"],
            F.struct(F.concat(s["text"], F.substring(text, s["at"] + 1, p["start"] - s["at"]), F.lit("<"), p["kind"], F.lit(">")).alias("text"), p["end"].alias("at")),
        ).otherwise(F.struct(s["text"].alias("text"), F.greatest(s["at"], p["end"]).alias("at"))),
        lambda s: F.concat(s["text"], F.substring(text, s["at"] + 1, F.length(text))),
    )
    return found.withColumn(text_col, F.when(F.size("_spans") > 0, joined).otherwise(text)).drop("_spans")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """Per document: counts per base kind, SHA-256 of the base spans, all spans, each as kind:start:end, and their scores in the same order."""
    base = [k.name for k in KINDS if k.base]
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    found = find_spans(docs.select(F.col(id_col), F.col(text_col)), text_col, "_found", min_score)
    count = lambda name: F.size(F.filter("_found", lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")
    return found.select(
        id_col,
        *[count(name) for name in base],
        F.sha2(told(F.filter("_found", lambda s: s["kind"].isin(base))).cast("binary"), 256).alias("base_sha256"),
        told(F.col("_found")).alias("spans"),
        F.transform("_found", lambda s: s["score"]).alias("scores"),
    )
