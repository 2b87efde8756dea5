"""Personal data spans: regular expressions propose, checksums confirm, nearby words adjust a score.

All of it is column expressions. The matches of a pattern come from ``regexp_extract_all`` and the
pieces between them from ``split`` with the same pattern; a running sum of both lengths places each
match. Positions count code points from 0, ends are exclusive.

Edge cases: a null text counts as empty and has no spans; repeated rows are scanned one by one; an
empty table gives an empty result; columns of the input are kept unless the result replaces them.
Patterns hold no nested backtracking, so time stays in proportion to the text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.llm.registry import query, table

# Fixed values of the contract: base kinds in their order, each with its pattern.
BASE_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

# The same matches for a backtracking engine. A run of address characters or digits is entered at
# its start, or where the last match ended (\G), and never given back; a card pattern that takes
# whole digit runs of any length would have runs outside 13 to 19 digits dropped, so only those match.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# Kinds that the method adds to the base ones. An account number has its country's length, in groups
# of four; other codes take the longest run. The pattern consumes only the first four characters and
# captures the number ahead, so that no candidate hides the next.
IBAN_LENGTHS = {
    15: "NO",
    16: "BE",
    18: "DK FK FO FI GL NL SD",
    19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST",
    26: "DZ IR IS TR",
    27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG",
    29: "BR EG PS QA UA",
    30: "JO KW MU YE",
    31: "MT SC",
    32: "LC",
    33: "RU",
}
GROUPED = "|".join(
    rf"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (rf"\x20?[A-Z0-9]{{{n % 4}}}" if n % 4 else "")
    for n, codes in IBAN_LENGTHS.items()
)
OTHER = rf"(?!{'|'.join(IBAN_LENGTHS.values()).replace(' ', '|')})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{2,7}}(?:\x20?[A-Z0-9]{{1,3}})?"
IBAN = rf"(?<![A-Za-z0-9])(?=((?:{GROUPED}|{OTHER})(?![A-Za-z0-9])))[A-Z]{{2}}[0-9]{{2}}"
LOCAL_PHONE = r"(?<![0-9A-Za-z().+-])(?<!\+[0-9]{1,3}[\x20.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9A-Za-z-])"

# Words before a span that speak for its kind.
CONTEXT = {
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "local_phone": ("phone", "call", "tel", "mobile", "fax"),
}
REACH = 40  # characters before a span in which context counts
ACCEPTED = 0.5  # least score of an added span


@dataclass(frozen=True)
class Kind:
    """A pattern, characters of which every match holds one, a check of a match, and scores without and for context.

    With ``head``, the pattern consumes that many characters and its first group holds the match.
    """

    name: str
    pattern: str
    literals: str
    valid: Callable[[Column], Column]
    score: float = 1.0
    context: float = 0.0
    head: int = 0

    def used(self, match: Column) -> Column:
        return F.lit(self.head) if self.head else F.length(match)


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn checksum: from the right, every second digit is doubled."""
    doubled = F.transform(
        F.split(F.reverse(number), ""), lambda c, i: c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
    )
    total = F.aggregate(doubled, F.lit(0), lambda a, d: a + F.when(d > 9, d - 9).otherwise(d))
    return total % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an account number passes mod 97: its first four characters go last, letters count from 10."""
    plain = F.translate(iban, " ", "")
    moved = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))
    rest = F.aggregate(
        F.split(moved, ""),
        F.lit(0),
        lambda a, c: F.when(c <= "9", (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97),
    )
    return F.length(plain).between(15, 34) & (rest == 1)


def address_parts(ip: Column) -> Column:
    """Whether each dotted part is at most 255, whatever its leading zeros or length."""

    def small(part: Column) -> Column:
        plain = F.regexp_replace(part, "^0+", "")
        return (F.length(plain) <= 3) & (F.lpad(plain, 3, "0") <= "255")

    return F.forall(F.split(ip, r"\."), small)


KINDS = (
    Kind("email", EMAIL, "@", lambda m: F.lit(True)),
    Kind("ip", IP, ".", address_parts),
    Kind("card", CARD, "", lambda m: luhn(digits(m))),
    Kind("phone", PHONE, "+", lambda m: F.length(digits(m)).between(9, 15)),
    Kind("iban", IBAN, "", mod97, 0.6, 0.4, 4),
    Kind("local_phone", LOCAL_PHONE, "-.", lambda m: F.lit(True), 0.3, 0.4),
)
BASE = tuple(BASE_PATTERNS)
LIST = "array<struct<kind:string,start:int,end:int,score:double>>"


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Each element combined with all before it, in log2(size) passes; ``values`` is a column, not an expression."""
    shifts = F.filter(F.array(*[F.lit(1 << k) for k in range(30)]), lambda s: s < F.size(values))
    return F.aggregate(
        shifts,
        values,
        lambda acc, s: F.transform(acc, lambda v, i: F.when(i >= s, combine(v, F.get(acc, i - s))).otherwise(v)),
    )


def find_personal_data(df: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """Add ``out``: every span of ``text`` as (kind, start, end, score), by kind in order, then by start.

    Base kinds count by their pattern and check alone. An added span needs a score of 0.5 or more,
    to which context words nearby contribute, and must not overlap a base span.
    """
    body, kept = "__text", [c for c in df.columns if c != out]
    df = df.withColumn(body, F.coalesce(F.col(f"`{text}`"), F.lit("")))
    for k in KINDS:
        found = F.regexp_extract_all(F.col(body), F.lit(k.pattern), F.lit(1 if k.head else 0))
        if k.literals:
            held = reduce(Column.__or__, [F.contains(F.col(body), F.lit(c)) for c in k.literals])
            found = F.when(held, found).otherwise(F.array().cast("array<string>"))
        df = df.withColumn(f"__m_{k.name}", found)
    steps = {
        f"__l_{k.name}": F.when(
            F.size(f"__m_{k.name}") > 0,
            F.zip_with(
                f"__m_{k.name}",
                F.slice(F.split(F.col(body), k.pattern, -1), F.lit(1), F.size(f"__m_{k.name}")),
                lambda m, gap: k.used(m) + F.length(gap),
            ),
        ).otherwise(F.array().cast("array<int>"))
        for k in KINDS
    }
    df = df.withColumns(steps)
    df = df.withColumns({f"__e_{k.name}": running(F.col(f"__l_{k.name}"), lambda a, b: a + b) for k in KINDS})

    def spans(k: Kind) -> Column:
        placed = F.zip_with(
            f"__e_{k.name}",
            f"__m_{k.name}",
            lambda e, m: F.struct(m.alias("match"), (e - k.used(m)).alias("start"), (e - k.used(m) + F.length(m)).alias("end")),
        )

        def score(s: Column) -> Column:
            if not k.context:
                return F.lit(k.score)
            before = F.substring(F.col(body), F.greatest(s["start"] - REACH + 1, F.lit(1)), F.least(s["start"], F.lit(REACH)))
            return F.when(before.rlike(r"(?i)\b(?:" + "|".join(CONTEXT[k.name]) + ")"), k.score + k.context).otherwise(k.score)

        return F.transform(
            F.filter(placed, lambda s: k.valid(s["match"])),
            lambda s: F.struct(F.lit(k.name).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), score(s).alias("score")),
        ).cast(LIST)

    df = df.withColumn("__base", F.concat(*[spans(k) for k in KINDS if k.name in BASE]))
    added = F.concat(*[spans(k) for k in KINDS if k.name not in BASE])
    added = F.filter(
        added,
        lambda s: (s["score"] >= ACCEPTED)
        & ~F.exists(F.col("__base"), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )
    df = df.withColumn("__all", F.concat("__base", added))
    return df.select(*[F.col(f"`{c}`") for c in kept], F.col("__all").alias(out))


def redact(df: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """Replace each stretch of ``text`` covered by ``spans`` with the tag of its first span, as in ``<EMAIL>``.

    A text without spans, null included, is left as it is.
    """
    df = df.withColumn(
        "__s",
        F.sort_array(F.transform(F.col(spans), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.upper(s["kind"]).alias("kind")))),
    ).withColumn("__ends", F.transform("__s", lambda s: s["end"]))
    df = df.withColumn("__to", running(F.col("__ends"), F.greatest))
    body = F.col(f"`{text}`")

    def part(s: Column, i: Column) -> Column:
        at = F.coalesce(F.get("__to", i - 1), F.lit(0))
        return F.when(s["start"] < at, "").otherwise(
            F.concat(F.substring(body, at + 1, s["start"] - at), F.lit("<"), s["kind"], F.lit(">"))
        )

    tail = F.substr(body, F.element_at("__to", -1) + 1)
    masked = F.concat(F.array_join(F.transform("__s", part), ""), tail)
    return df.withColumn(text, F.when(F.size("__s") > 0, masked).otherwise(body)).drop("__s", "__ends", "__to")


def _count(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


_STEPS = {
    "email": "true",
    "ip": "len(list_filter(string_split(m, '.'), lambda p: cast(p as double) > 255)) = 0",
    "card": (
        "length(regexp_replace(m, '[^0-9]', '', 'g')) between 13 and 19 and list_sum(list_transform("
        "string_split(reverse(regexp_replace(m, '[^0-9]', '', 'g')), ''),"
        " lambda c, i: case when i % 2 = 1 then cast(c as int) else (2 * cast(c as int)) // 10 + (2 * cast(c as int)) % 10 end)) % 10 = 0"
    ),
    "phone": "length(regexp_replace(m, '[^0-9]', '', 'g')) between 9 and 15",
}


def _check_sql() -> str:
    """The base columns in DuckDB: matches and the pieces between them, numbered and summed."""
    kinds = " union all ".join(
        f"""select doc_id, row_id, '{kind}' kind, {n} place, i, m, valid,
            sum(length(gap) + length(m)) over (partition by row_id order by i) - length(m) s
        from (select doc_id, row_id, i, ms[i] m, gaps[i] gap, ({_STEPS[kind].replace('(m,', '(ms[i],')}) valid from (
            select doc_id, row_id, ms, gaps, unnest(generate_series(1, len(ms))) i from (
                select doc_id, row_id, regexp_extract_all(body, '{pattern}') ms, string_split_regex(body, '{pattern}') gaps from d)))"""
        for n, (kind, pattern) in enumerate(BASE_PATTERNS.items())
    )
    counts = ", ".join(f"count(*) filter (kind = '{k}') n_{k}" for k in BASE_PATTERNS)
    return f"""with d as (select doc_id, row_number() over () row_id, coalesce(text, '') body from documents),
    f as (select * from ({kinds}) where valid)
    select d.doc_id, {counts},
        sha256(coalesce(string_agg(concat(kind, ':', s::bigint, ':', s::bigint + length(m)), ',' order by place, i) filter (where kind is not null), '')) base_sha256
    from d left join f using (row_id) group by d.doc_id, d.row_id"""


@query("op8_personal_data")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's personal data: counts and hash of the base spans, and all spans."""
    found = find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    counts = [_count("spans", k).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


BASE_SQL = _check_sql()
