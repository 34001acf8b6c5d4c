r"""Personal data: regular expressions propose spans, checksums confirm them, context words weigh them.

Everything is an expression on one row, so nothing is shuffled and a long text costs no
more than its own length.  The expressions are written so that a start inside a longer
run is never tried (look-behind, or ``\G`` right after the last match) and repetition is
possessive: long runs of digits or letters take linear time and no deep recursion.
They find the same leftmost matches as the plain forms in ``PLAIN``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import whole

PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
IP_PARTS = rf"^{PART}\.{PART}\.{PART}\.{PART}$"
NEAR_BEFORE, NEAR_AFTER = 40, 20
SPAN_TYPE = "array<struct<kind:string,start:bigint,stop:bigint,value:string,score:double>>"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """The check sum of cards: from the right, every second digit is doubled and its digits added."""
    text = F.reverse(digits(value))
    doubled = F.translate(text, "0123456789", "0246813579")

    def add(total, i):
        return total + F.substr(F.when(i % 2 == 0, doubled).otherwise(text), i, F.lit(1)).cast("int")

    return F.aggregate(F.sequence(F.lit(1), F.length(text)), F.lit(0), add) % 10 == 0


def mod97(value: Column) -> Column:
    """The check of account numbers: four leading characters go last, letters count from 10, the rest is 1."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    moved = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))

    def step(rest, i):
        c = F.ascii(F.substr(moved, i, F.lit(1)))
        return F.when(c >= 65, (rest * 100 + c - 55) % 97).otherwise((rest * 10 + c - 48) % 97).cast("int")

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), step) == 1


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    needs: str  # a text without this cannot match
    valid: Callable[[Column], Column]
    score: float
    context: str
    base: bool = True


KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        lambda m: F.lit(True),
        0.8,
        "(?i)mail|contact|kontakt|correo|courriel|write to",
    ),
    Kind(
        "ip",
        r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        ".",
        lambda m: m.rlike(IP_PARTS),
        0.5,
        "(?i)address|adresse|host|server|login|client",
    ),
    Kind(
        "card",
        r"(?<![0-9])(?<![0-9][\x20-])(?=[0-9](?:[\x20-]?[0-9]){15})[0-9](?:[\x20-]?[0-9])++",
        "",
        lambda m: F.length(digits(m)).between(16, 19) & luhn(m),
        0.7,
        "(?i)card|karte|carte|tarjeta|visa|pay",
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        "+",
        lambda m: F.length(digits(m)).between(8, 15),
        0.6,
        "(?i)phone|call|telefon|tel|mobil",
    ),
    Kind(
        "iban",
        r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?",
        "",
        lambda m: F.length(F.replace(m, F.lit(" "), F.lit(""))).between(15, 34) & mod97(m),
        0.9,
        "(?i)iban|bank|account|konto|compte|cuenta",
        base=False,
    ),
)


def _spans(text: Column, kind: Kind) -> Column:
    """The valid matches of one kind with places in code points and a score."""
    possible = F.contains(text, F.lit(kind.needs)) if kind.needs else F.lit(True)
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    between = F.split(text, kind.pattern, -1)

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,stop:bigint,value:string>>").alias("spans"))

    def built(pair):
        numbered = F.transform(pair["matches"], lambda m, i: F.struct(m.alias("m"), i.alias("i")))

        def put(acc, x):
            first = acc["at"] + F.length(F.get(pair["between"], x["i"]))
            last = first + F.length(x["m"])
            span = F.struct(first.alias("start"), last.alias("stop"), x["m"].alias("value"))
            return F.struct(last.alias("at"), F.array_append(acc["spans"], span).alias("spans"))

        return F.aggregate(numbered, start, put)["spans"]

    # A one-element array gives the pair a name inside the expression, so that each regular expression runs once.
    pair = F.array(F.struct(matches.alias("matches"), between.alias("between")))
    found = F.when(possible & F.regexp_like(text, F.lit(kind.pattern)), F.flatten(F.transform(pair, built)))

    def score(s):
        lead = F.least(s["start"], F.lit(NEAR_BEFORE)).cast("int")
        near = F.concat(F.substr(text, (s["start"] - lead + 1).cast("int"), lead), F.lit(" "), F.substr(text, (s["stop"] + 1).cast("int"), F.lit(NEAR_AFTER)))
        value = F.lit(kind.score) + F.when(near.rlike(kind.context), 0.1).otherwise(0.0)
        return F.struct(F.lit(kind.name).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), s["value"].alias("value"), value.alias("score"))

    valid = F.filter(found, lambda s: kind.valid(s["value"]))
    return F.coalesce(F.transform(valid, score), F.array().cast(SPAN_TYPE))


def personal_data(docs: DataFrame, text: str = "text", out: str = "pii", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``docs`` with the array ``out`` of ``(kind, start, stop, value, score)``, by kind and then start.

    Matches of a kind are leftmost and do not overlap; one that fails its check is dropped
    and nothing inside it is tried again.  Kinds may overlap each other.  The score is the
    kind's own, raised by 0.1 if a context word stands within 40 characters before or 20
    after.  NULL and empty texts have an empty array; rows are judged alone, so repeated
    rows and extra columns change nothing.  A column named ``out`` is replaced.
    """
    return docs.withColumn(out, F.concat(*(_spans(whole(text), kind) for kind in kinds)))


def span_texts(spans: Column) -> Column:
    """``kind:start:stop`` joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def supported(spans: Column, kinds: tuple[Kind, ...] = KINDS) -> Column:
    """How many spans have a context word near."""
    by_kind = F.create_map(*(x for k in kinds for x in (F.lit(k.name), F.lit(k.score))))
    return F.size(F.filter(spans, lambda s: s["score"] > F.element_at(by_kind, s["kind"]))).cast("long")


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?",
}


def _sql() -> str:
    digits_of = "regexp_replace(v, '[^0-9]', '', 'g')"
    luhn_of = (
        f"list_sum(list_transform(range(1, len({digits_of}) + 1), lambda i: CASE WHEN i % 2 = 0 THEN "
        f"substr('0246813579', substr(reverse({digits_of}), i, 1)::INT + 1, 1)::INT ELSE substr(reverse({digits_of}), i, 1)::INT END)) % 10 = 0"
    )
    bare = "replace(v, ' ', '')"
    moved = f"(substr({bare}, 5) || substr({bare}, 1, 4))"
    codes = f"list_transform(range(1, len({moved}) + 1), lambda i: CASE WHEN ascii(substr({moved}, i, 1)) >= 65 THEN ascii(substr({moved}, i, 1)) - 55 ELSE ascii(substr({moved}, i, 1)) - 48 END)"
    valid = {
        "email": "true",
        "ip": f"regexp_matches(v, '{IP_PARTS}')",
        "card": f"len({digits_of}) BETWEEN 16 AND 19 AND {luhn_of}",
        "phone": f"len({digits_of}) BETWEEN 8 AND 15",
        "iban": f"len({bare}) BETWEEN 15 AND 34 AND list_reduce(list_prepend(0, {codes}), lambda r, c: (CASE WHEN c >= 10 THEN r * 100 ELSE r * 10 END + c) % 97) = 1",
    }
    parts = []
    for rank, kind in enumerate(KINDS):
        pattern = PLAIN[kind.name]
        parts.append(f"""
  SELECT n, {rank} AS k, '{kind.name}' AS kind, s, s + len(v) AS e, v,
    regexp_matches(substr(t, s - least(s, {NEAR_BEFORE}) + 1, least(s, {NEAR_BEFORE})) || ' ' || substr(t, s + len(v) + 1, {NEAR_AFTER}), '{kind.context}') AS near
  FROM (
    SELECT n, t, m[i] AS v, list_sum(list_transform(b[1:i], lambda x: len(x)))::BIGINT + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: len(x))), 0)::BIGINT AS s
    FROM (SELECT n, t, m, b, unnest(range(1, len(m) + 1)) AS i FROM (
      SELECT n, t, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS b FROM d) WHERE len(m) > 0)
  ) WHERE {valid[kind.name]}""")
    counts = ", ".join(f"count(*) FILTER (kind = '{k.name}') AS n_{k.name}" for k in KINDS)
    return f"""
WITH d AS (SELECT doc_id AS n, coalesce(text, '') AS t FROM documents), x AS ({' UNION ALL '.join(parts)}
), c AS (
  SELECT n, {counts}, count(*) FILTER (near) AS n_supported,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY k, s) FILTER (kind <> 'iban') AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY k, s) AS spans
  FROM x GROUP BY n
)
SELECT d.n AS doc_id, {', '.join(f'coalesce(n_{k.name}, 0)::BIGINT AS n_{k.name}' for k in KINDS)},
  coalesce(n_supported, 0)::BIGINT AS n_supported, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN c ON d.n = c.n
"""


SQL = _sql()
