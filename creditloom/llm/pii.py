"""Personal data in texts, by SQL functions only: patterns propose, checksums confirm, nearby words adjust the score.

Base kinds, found leftmost and without overlap for each kind: email, ip (parts at most 255), card (14 to 19 digits
passing Luhn) and phone (10 to 15 digits). A match that fails its test is dropped, not tried again at another length.
Added kinds: iban (15 to 34 characters, remainder 1 by mod-97) and local, a ten-digit number without its country code,
which only a context word makes a phone number. A score starts at the kind's own value and rises by CONTEXT_BONUS
when a word of the kind stands in the CONTEXT_CHARS characters before the match, back to the last match of the kind;
added kinds are reported from THRESHOLD on, base ones whatever their score.

The patterns' possessive loops match what greedy ones would, since what follows a loop is never in its class, but
need no stack; and a run of one class is tried from its start only (or from where the last match ended), so long runs
cost linear time. Positions are in code points, ends exclusive. A null text counts as empty and has no spans. Rows are
independent: repeated rows and ids are fine, and other columns, whatever their names, are kept by :func:`find_pii`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.llm.spark_util import table

CONTEXT_CHARS = 48
CONTEXT_BONUS = 0.3
THRESHOLD = 0.6


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    value: float  # of the score, without context
    words: str  # pattern of context words
    base: bool = True


# The kinds, in the order in which spans at one place are listed.
KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.7, r"(?i)mail|contact|write|address"),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 0.6, r"(?i)host|server|address|login"),
    Kind("card", r"[0-9](?:[ -]?[0-9])++", 0.7, r"(?i)card|visa|credit|payment"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", 0.6, r"(?i)phone|tel|call|mobile|fax|contact"),
    Kind("iban", r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}", 0.7, r"(?i)iban|account|bank|transfer", base=False),
    Kind("local", r"[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}", 0.4, r"(?i)phone|call|mobile|fax|contact", base=False),
)
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn test; every second digit from the right counts as 2d, less 9 over 9."""
    back = F.reverse(digits)
    digit = lambda text, i: F.substring(text, i, F.lit(1)).cast("int")
    plain = F.aggregate(F.sequence(F.lit(1), F.length(digits), F.lit(2)), F.lit(0), lambda acc, i: acc + digit(back, i))
    twice = F.translate(back, "0123456789", "0246813579")
    doubled = F.aggregate(F.sequence(F.lit(2), F.length(digits), F.lit(2)), F.lit(0), lambda acc, i: acc + digit(twice, i))
    return (plain + doubled) % 10 == 0


def mod97(account: Column) -> Column:
    """The remainder by 97 of an account number whose first four characters move to the end, letters as 10 to 35."""
    moved = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4))

    def step(acc: Column, ch: Column) -> Column:
        value = F.conv(ch, 36, 10).cast("int")
        return F.when(ch == "", acc).otherwise((acc * F.when(value > 9, 100).otherwise(10) + value) % 97)

    return F.aggregate(F.split(moved, ""), F.lit(0), step)


def confirmed(kind: str, match: Column) -> Column:
    """Whether a match of a kind passes the kind's test."""
    digits = _digits(match)
    n = F.length(digits)
    if kind == "ip":
        return match.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        return F.when(n.between(14, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(10, 15)
    if kind == "iban":
        account = F.regexp_replace(match, " ", "")
        return F.when(F.length(account).between(15, 34), mod97(account) == 1).otherwise(F.lit(False))
    return F.lit(True)


_SPAN = "array<struct<start:int,place:int,end:int,kind:string,score:double>>"


def _spans(text: Column, found: Column, place: int) -> Column:
    """The confirmed spans of one kind, given its matches: the texts between them tell where they stand."""
    kind = KINDS[place]
    empty = F.array().cast(_SPAN)
    pieces = F.zip_with(F.split(text, kind.pattern, -1), found, lambda gap, match: F.struct(gap.alias("gap"), match.alias("match")))

    def step(acc: Column, x: Column) -> Column:
        gap, match = x["gap"], x["match"]
        begin = acc["at"] + F.length(gap)
        end = begin + F.length(match)
        score = F.least(F.lit(1.0), kind.value + F.when(F.right(gap, F.lit(CONTEXT_CHARS)).rlike(kind.words), CONTEXT_BONUS).otherwise(0.0))
        keep = match.isNotNull() & confirmed(kind.name, match)
        if not kind.base:
            keep = keep & (score >= THRESHOLD)
        one = F.concat(begin.cast("string"), F.lit(":"), end.cast("string"), F.lit(":"), score.cast("string"), F.lit(","))
        return F.struct(F.coalesce(end, acc["at"]).alias("at"), F.when(keep, F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    # spans are gathered as text: to extend a string copies bytes, to extend an array of structs copies objects
    walked = F.aggregate(pieces, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda acc: F.split(F.rtrim(acc["out"], F.lit(",")), ","))

    def parsed(one: Column) -> Column:
        part = F.split(one, ":")
        return F.struct(part[0].cast("int").alias("start"), F.lit(place).alias("place"), part[1].cast("int").alias("end"), F.lit(kind.name).alias("kind"), part[2].cast("double").alias("score"))

    walked = F.transform(F.filter(walked, lambda one: one != ""), parsed)
    return F.when(F.size(found) > 0, walked).otherwise(empty)


def find_pii(docs: DataFrame, text_col: str = "text", out: str = "pii") -> DataFrame:
    """``docs`` with an array of spans (start, place, end, kind, score), by start and then kind, in place of any such column."""
    kept = [c for c in docs.columns if c != out]
    text = F.coalesce(F.col("_text"), F.lit(""))
    found = docs.select(*kept, F.col(text_col).cast("string").alias("_text")).select("*", *(F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0)).alias(f"_found{i}") for i, k in enumerate(KINDS)))
    each = [_spans(text, F.col(f"_found{i}"), i) for i in range(len(KINDS))]
    return found.select(*kept, F.array_sort(F.concat(*each)).alias(out))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; of overlapping spans the first, then the longest, goes."""
    found = find_pii(docs, text_col, "_pii")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("text"))

    def step(acc: Column, x: Column) -> Column:
        text = F.concat(acc["text"], F.substring(F.col(text_col), acc["at"] + 1, x["start"] - acc["at"]), F.lit("["), x["kind"], F.lit("]"))
        return F.when(x["start"] < acc["at"], acc).otherwise(F.struct(x["end"].alias("at"), text.alias("text")))

    ordered = F.array_sort(F.transform("_pii", lambda x: F.struct(x["start"].alias("start"), (-x["end"]).alias("far"), x["end"].alias("end"), x["kind"].alias("kind"))))
    clean = F.aggregate(ordered, start, step, lambda acc: F.concat(acc["text"], F.substring(F.col(text_col), acc["at"] + 1, F.length(text_col))))
    return found.withColumn(text_col, F.when(F.size("_pii") > 0, clean).otherwise(F.col(text_col))).drop("_pii")


def listing(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "pii")
    count = lambda kind: F.size(F.filter("pii", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("pii", lambda x: x["place"] < sum(k.base for k in KINDS))
    return found.select("doc_id", *(count(k.name).alias(f"n_{k.name}") for k in KINDS if k.base), F.sha2(listing(base), 256).alias("base_sha256"), listing(F.col("pii")).alias("spans"))


def _sql() -> str:
    """The same by DuckDB, with the patterns as the contract writes them."""
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
        "iban": r"[A-Z]{2}[0-9]{2}( ?[A-Z0-9]){11,30}",
        "local": r"[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}",
    }
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    luhn_sql = f"""list_sum(list_transform(string_split(reverse({digits}), ''), lambda c, i: CASE WHEN i % 2 = 1 THEN c::INT
        ELSE translate(c, '0123456789', '0246813579')::INT END)) % 10 = 0"""
    account = "replace(m, ' ', '')"
    mod_sql = f"""list_reduce(list_prepend(0::BIGINT, list_transform(string_split(substr({account}, 5) || substr({account}, 1, 4), ''),
        lambda c: (strpos('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', c) - 1)::BIGINT)), lambda a, v: (a * (CASE WHEN v > 9 THEN 100 ELSE 10 END) + v) % 97) = 1"""
    tests = {
        "email": "true",
        "ip": "list_max(list_transform(string_split(m, '.'), lambda x: x::HUGEINT)) <= 255",
        "card": f"CASE WHEN length({digits}) BETWEEN 14 AND 19 THEN {luhn_sql} ELSE false END",
        "phone": f"length({digits}) BETWEEN 10 AND 15",
        "iban": f"CASE WHEN length({account}) BETWEEN 15 AND 34 THEN {mod_sql} ELSE false END",
        "local": f"regexp_matches(right(g, {CONTEXT_CHARS}), '{KINDS[5].words}')",
    }
    parts = []
    for i, kind in enumerate(KINDS):
        p = plain[kind.name]
        parts.append(
            f"""SELECT doc_id, '{kind.name}' AS kind, {i} AS place, s, s + length(m) AS e FROM (
            SELECT doc_id, unnest(f) AS m, unnest(g[:len(f)]) AS g, unnest(list_transform(f, lambda x, j:
              list_sum(list_transform(g[:j], lambda y: length(y))) + coalesce(list_sum(list_transform(f[:j - 1], lambda y: length(y))), 0))) AS s
            FROM (SELECT doc_id, regexp_extract_all(t, '{p}') AS f, string_split_regex(t, '{p}') AS g FROM docs) WHERE len(f) > 0) WHERE {tests[kind.name]}"""
        )
    return f"""WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), spans AS ({" UNION ALL ".join(parts)}),
    agg AS (SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{k.name}') AS n_{k.name}" for k in KINDS if k.base)},
      coalesce(string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, place) FILTER (place < 4), '') AS b,
      string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, place) AS spans FROM spans GROUP BY doc_id)
    SELECT doc_id, {", ".join(f"coalesce(n_{k.name}, 0)::BIGINT AS n_{k.name}" for k in KINDS if k.base)}, sha256(coalesce(b, '')) AS base_sha256,
      coalesce(spans, '') AS spans FROM documents LEFT JOIN agg USING (doc_id)"""


OP5_SQL = _sql()
