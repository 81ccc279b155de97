"""Keyed pseudonyms that keep the format of a value, and their inverse, as Spark expressions.

The digits of a value, taken together, become other digits, and its ASCII letters other letters of the same case; all other characters
stay, so a card stays a card number and an address an address.  The map is a Feistel network: a run of
digits is cut in two halves, and in each round one half is moved by a keyed hash of the other, so that the same key undoes it
round by round.  Equal values of one entity type get equal pseudonyms under a key, also across tables.

* CREDIT_CARD: the last digit is the Luhn check digit of the others, before and after.
* PHONE_NUMBER: a country code (``+`` and digits at the start) stays.
* SECRET_TOKEN: letters a-f stay hexadecimal.

The key is text.  It is part of the query plan, so take it from a secret store and keep plans and event logs as safe as the data.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .spans import SUM, prefix_scan_sql
from .sqltext import apply, let, lit

ROUNDS = 10
#: Digits, and letters, that one network moves; longer values are moved piece by piece.
DIGIT_PIECE, LETTER_PIECE = 16, 12
COUNTRY_CODE = r"^\+[0-9]+"


def _struct(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"


# Nested lambdas cost the analyser passes, so values that do not depend on each other are bound together.

def _hash(key: str, radix: int, value: str) -> str:
    """60 bits of a keyed hash of a half, its round and what it belongs to."""
    parts = [lit(key), "x.entity_type", f"'{radix}'", "cast(size(word) as string)", "cast(piece as string)", "cast(r as string)", f"cast({value} as string)"]
    return f"cast(conv(substring(sha2(concat_ws('|', {', '.join(parts)}), 256), 1, 15), 16, 10) as bigint)"


def _moved(key: str, radix: int, piece: int, word: str, inverse: bool) -> str:
    """An array of symbols (numbers below the radix), moved forward or back, piece by piece."""
    number = lambda array: f"aggregate({array}, 0L, (n, y) -> n * {radix} + y)"
    power = lambda n: f"cast(power({radix}, {n}) as bigint)"
    sign = "-" if inverse else "+"
    left = f"pmod(s.a {sign} {_hash(key, radix, 's.b')} % p.u, p.u)"
    right = f"pmod(s.b {sign} {_hash(key, radix, 's.a')} % p.v, p.v)"
    step = f"if(r % 2 = 0, {_struct(a=left, b='s.b')}, {_struct(a='s.a', b=right)})"
    order = f"sequence({ROUNDS - 1}, 0)" if inverse else f"sequence(0, {ROUNDS - 1})"
    start = _struct(a=number("slice(p.part, 1, p.half)"), b=number("slice(p.part, p.half + 1, size(p.part) - p.half)"))
    symbol = f"cast(if(i < p.half, m.a div {power('p.half - 1 - i')}, m.b div {power('size(p.part) - 1 - i')}) % {radix} as int)"
    symbols = let("m", f"aggregate({order}, {start}, (s, r) -> {step})", f"transform(p.part, (y, i) -> {symbol})")
    n = f"least({piece}, size(word) - piece * {piece})"
    bound = _struct(part=f"slice(word, piece * {piece} + 1, {piece})", half=f"{n} div 2", u=power(f"{n} div 2"), v=power(f"{n} - {n} div 2"))
    pieces = f"transform(sequence(0, cast((size(word) - 1) div {piece} as int)), piece -> {let('p', bound, symbols)})"
    return let("word", word, f"if(size(word) = 0, word, flatten({pieces}))")


def _luhn_sum(digits: str) -> str:
    """Sum of the digits before a check digit: every second one from the right, the last one first, is doubled."""
    doubled = "if(y > 4, 2 * y - 9, 2 * y)"
    return f"aggregate(transform({digits}, (y, i) -> if((size({digits}) - i) % 2 = 1, {doubled}, y)), 0, (n, y) -> n + y)"


def pseudonym_sql(key: str, inverse: bool = False) -> str:
    """SQL of the pseudonym (or, ``inverse``, of the value behind it) of ``hit``, the text of span ``x``."""
    is_digit, is_letter = "c between '0' and '9' and length(c) = 1", "(c between 'a' and 'z' or c between 'A' and 'Z')"
    before = lambda rule: prefix_scan_sql(f"transform(w.chars, c -> cast({rule} as int))", SUM)
    checked = let("new", _moved(key, 10, DIGIT_PIECE, "slice(b.ds, 1, size(b.ds) - 1)", inverse), f"concat(new, array(cast(pmod(-({_luhn_sum('new')}), 10) as int)))")
    digits = f"if(x.entity_type = 'CREDIT_CARD' and size(b.ds) > 1, {checked}, {_moved(key, 10, DIGIT_PIECE, 'b.ds', inverse)})"
    hexa = "x.entity_type = 'SECRET_TOKEN' and forall(b.ls, y -> y < 6)"
    letters = f"if({hexa}, {_moved(key, 6, LETTER_PIECE, 'b.ls', inverse)}, {_moved(key, 26, LETTER_PIECE, 'b.ls', inverse)})"
    letter = "char(if(c between 'a' and 'z', 97, 65) + n.ls[b.lat[i] - 1])"
    each = f"transform(w.chars, (c, i) -> if({is_digit}, cast(n.ds[b.dat[i] - 1] as string), if({is_letter}, {letter}, c)))"
    bound = _struct(
        ds=f"transform(filter(w.chars, c -> {is_digit}), c -> cast(c as int))", ls=f"transform(filter(w.chars, c -> {is_letter}), c -> ascii(lower(c)) - 97)",
        dat=before(is_digit), lat=before(is_letter))
    body = let("b", bound, let("n", _struct(ds=digits, ls=letters), f"array_join({each}, '')"))
    head = f"if(x.entity_type = 'PHONE_NUMBER', regexp_extract(hit, {lit(COUNTRY_CODE)}, 0), '')"
    whole = _struct(head=head, chars=f"split(substring(hit, length({head}) + 1), '')")
    return let("w", whole, f"concat(w.head, if(size(w.chars) = 0, '', {body}))")


def pseudonym(value: Column, key: str, entity: str = "VALUE", inverse: bool = False) -> Column:
    """The pseudonym of a whole value (``inverse``: the value behind a pseudonym) under ``key``; null stays null."""
    cell = F.struct(value.cast("string").alias("hit"), F.lit(entity).alias("entity_type"))
    return apply(cell, let("hit", "x.hit", f"if(hit is null, null, {pseudonym_sql(key, inverse)})"), "x")
