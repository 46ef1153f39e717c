"""Rounding, rendering, canonical text and hashes, and typed reading of documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barloom.functions.keys import col

#: Version strings carry this many hex digits of each of their three digests.
VERSION_DIGITS = 16
VERSION_PATTERN = "^fmv1:([mb]):([0-9a-f]{16}):([0-9a-f]{16}):([0-9a-f]{16})$"
SHA256_PATTERN = "^[0-9a-f]{64}$"


def quantize(x: Column | str, places: int = 8) -> Column:
    """Half-even to `places`; negative zero is zero."""
    return F.bround(col(x).cast("decimal(38,18)"), places).cast(f"decimal(38,{places})")


def render(x: Column | str) -> Column:
    """Fixed-point text with eight places."""
    return quantize(x).cast("string")


def canonical_json(**fields: Column) -> Column:
    """A JSON object with its keys in order, without spaces, nulls kept."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def set_hash(rows: Column) -> Column:
    """An aggregate: SHA-256 of the JSON list of `rows` (JSON texts), in their order as text. The order of arrival is of no matter."""
    return sha256(F.concat(F.lit("["), F.array_join(F.array_sort(F.collect_list(rows)), ","), F.lit("]")))


def version_string(scope: str, identity: Column, inputs: Column, result: Column) -> Column:
    parts = [F.substring(F.regexp_replace(c, "^sha256:", ""), 1, VERSION_DIGITS) for c in (identity, inputs, result)]
    return F.concat_ws(":", F.lit("fmv1"), F.lit(scope), *parts)


def parse_version(version: Column | str) -> Column:
    """(scope, identity, inputs, result) or null where the text is no version."""
    v = col(version)
    names = ("scope", "identity", "inputs", "result")
    return F.when(v.rlike(VERSION_PATTERN), F.struct(*[F.regexp_extract(v, VERSION_PATTERN, i + 1).alias(n) for i, n in enumerate(names)]))


def half_even_ratio(n: Column, d: Column) -> Column:
    """n / d of whole decimals, rounded half-even to a whole decimal; d is positive."""
    q = F.floor(n / d).cast("decimal(38,0)")
    # The quotient may have been rounded; put it right by the remainder, which is exact.
    r = n - q * d
    q = q + F.when(r < 0, -1).when(r >= d, 1).otherwise(0).cast("decimal(1,0)")
    r = n - q * d
    up = (r * 2 > d) | ((r * 2 == d) & (F.pmod(q, F.lit(2).cast("decimal(1,0)")) == 1))
    return q + F.when(up, 1).otherwise(0).cast("decimal(1,0)")


def _ratio(n: Column, d: Column) -> Column:
    """n / d of decimals with eight places, rounded once."""
    whole = lambda c: (c.cast("decimal(18,8)") * F.lit(100000000).cast("decimal(9,0)")).cast("decimal(20,0)")
    units = half_even_ratio((whole(n) * F.lit(100000000).cast("decimal(9,0)")).cast("decimal(36,0)"), whole(d))
    return (units.cast("decimal(28,0)") * F.lit("0.00000001").cast("decimal(8,8)")).cast("decimal(38,8)")


def split_factors(old: Column, new: Column) -> tuple[Column, Column]:
    """(price factor, volume factor) of a split from `old` to `new` shares, eight places each."""
    return _ratio(old, new), _ratio(new, old)


def dividend_factor(close: Column, amount: Column) -> Column:
    """(close - amount) / close with eight places; null where the amount is not less than the close."""
    c, a = close.cast("decimal(18,8)"), amount.cast("decimal(18,8)")
    return F.when(a < c, _ratio(c - a, c))


def decimal_map(document: Column | str) -> Column:
    """A JSON object of numbers as map<string, decimal(38,18)>, digits exact; null if any value is no bare number.

    The text of each value is looked at before it is read: a number in quotes, a boolean or a null refuses the document.
    """
    d = col(document)
    number = "-?(0|[1-9][0-9]*)([.][0-9]+)?([eE][+-]?[0-9]+)?"
    member = f'\\s*"[^"\\\\]*"\\s*:\\s*{number}\\s*'
    return F.when(d.rlike(f"^\\s*[{{]{member}(,{member})*[}}]\\s*$"), F.from_json(d, "map<string,decimal(38,18)>"))


def parse_terms(event_type: Column, terms: Column) -> Column:
    """Typed terms of a corporate action from JSON text, or null where they are not valid.

    A split has two different positive whole share counts; a cash dividend a positive amount and a three-letter currency."""
    t = F.from_json(terms, "from_shares string, to_shares string, amount string, currency string")
    old, new = t["from_shares"].try_cast("bigint"), t["to_shares"].try_cast("bigint")
    amount = t["amount"].try_cast("decimal(28,8)")
    split = (event_type == "SPLIT") & (old > 0) & (new > 0) & (old != new)
    dividend = (event_type == "CASH_DIVIDEND") & (amount > 0) & t["currency"].rlike("^[A-Z]{3}$")
    none = lambda kind: F.lit(None).cast(kind)
    typed = lambda *v: F.struct(*[x.alias(n) for x, n in zip(v, ("from_shares", "to_shares", "amount", "currency"))])
    return F.when(split, typed(old, new, none("decimal(28,8)"), none("string"))).when(dividend, typed(none("bigint"), none("bigint"), amount, t["currency"]))


def reasons(**rules: Column) -> Column:
    """The names of the rules that hold, in order, joined by commas; null if none does."""
    found = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))
    return F.when(F.size(found) > 0, F.array_join(found, ","))


def first_violation(**rules: Column) -> Column:
    """The name of the first rule that holds; null if none does."""
    return F.coalesce(*[F.when(rule, F.lit(name)) for name, rule in rules.items()])
