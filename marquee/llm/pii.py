"""Format-preserving pseudonyms for personal data, in SQL functions only.

Validated values are permuted with a key inside their own format by a Feistel
network, so a pseudonym is as valid as the value was, equal values get equal
pseudonyms in every document (separators and letter case do not matter), and the
owner of the key can undo it:

* cards (Luhn): the digits before the check digit, which is computed anew; in a longer
  run of digits the groups that make up cards, and the other values beside them;
* IBANs (mod 97): the digits and letters after the check digits, which are computed anew;
* phone numbers (ten digits, perhaps after +1; without separators only if area code and
  exchange begin with 2 to 9): these two digits stay in 0 and 1 or in 2 to 9; social security numbers, IPv4 addresses;
* dates (year-month-day, day-month-year): a permutation of the 146,097 days of 1800
  to 2199, exactly 189 * 773; month/day/year where the day is 13 to 28, within that form;
* e-mail addresses: the letters and digits before the @.

A value is a row of symbols with a radix each.  Rounds take turns: one half gets
the other half's keyed SHA-256 added, symbol by symbol, modulo its radix.
Values that fail validation stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of
from .matches import bound, characters, rewritten

ROUNDS = 8
FIRST_DAY, DAYS = "1800-01-01", (189, 773)

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+){1,8}"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])"
DATE = (r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}-[0-9]{2}-[0-9]{4}"
        r"|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9]|[./-][0-9])")
IP = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"
PHONE = (r"(?<![0-9+])(?:\+?1[ .-]?)?(?:\(?[2-9][0-9]{2}\)?[ .-]?[2-9][0-9]{2}[ .-]?[0-9]{4}"
         r"|\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4})(?![0-9])")
CARD = r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,}+"     # with all digits beside it
CARD_LIKE = r"^[ -]?(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})$"
MOST_STEPS = 64
KINDS = {"email": EMAIL, "iban": IBAN, "date": DATE, "ip": IP, "ssn": SSN, "phone": PHONE, "card": CARD}
ANY = "|".join(f"(?:{p})" for p in KINDS.values())
GATE = r"@|[0-9](?:[ ().+/-]{0,3}[0-9]){3}|[A-Z]{2}[0-9]{2}[A-Z0-9]"   # part of every match


def feistel(symbols: Column, key: str, tweak: str, undo: bool = False) -> Column:
    """Keyed permutation of a row of (v, r) symbols; each v stays in 0 .. r - 1."""
    def one(half: Column, other: Column, r: Column) -> Column:
        told = F.concat_ws(":", F.lit(key), F.lit(tweak), r.cast("string"), F.array_join(other["v"].cast("array<string>"), ","))

        def add(told: Column) -> Column:
            def move(x: Column, i: Column) -> Column:
                by = F.conv(F.substring(F.sha2(F.concat_ws(":", told, i.cast("string")), 256), 1, 13), 16, 10).cast("long")
                return F.struct(F.pmod(x["v"] - by if undo else x["v"] + by, x["r"]).alias("v"), x["r"].alias("r"))
            return F.transform(half, move)

        return bound(told, add)

    def turn(acc: Column, r: Column) -> Column:
        odd = r % 2 == 1
        return F.struct(F.when(odd, acc["a"]).otherwise(one(acc["a"], acc["b"], r)).alias("a"),
                        F.when(odd, one(acc["b"], acc["a"], r)).otherwise(acc["b"]).alias("b"))

    def run(x: Column) -> Column:
        cut = F.floor(F.size(x) / 2).cast("int")
        start = F.struct(F.slice(x, F.lit(1), cut).alias("a"), F.slice(x, cut + 1, F.size(x)).alias("b"))
        order = F.array(*(F.lit(r) for r in (range(ROUNDS, 0, -1) if undo else range(1, ROUNDS + 1))))
        return F.aggregate(order, start, turn, lambda acc: F.concat(acc["a"]["v"], acc["b"]["v"]))

    return bound(symbols, run)


def _symbol(v: Column, r: int | Column) -> Column:
    return F.struct(v.cast("long").alias("v"), (r if isinstance(r, Column) else F.lit(r)).cast("long").alias("r"))


def _symbols(s: Column, key: str, tweak: str, undo: bool, first: tuple[int, ...] = ()) -> Column:
    """Letters and digits permuted within their kinds; at the places ``first`` (from 0) a digit stays in 0 and 1 or in 2 to 9."""
    def base(c: Column, i: Column) -> Column:
        kind = F.when(c >= 97, 97).when(c >= 65, 65).otherwise(48)
        return F.when(i.isin(*first) & (c >= 50), 50).otherwise(kind) if first else kind

    def symbol(c: Column, i: Column) -> Column:
        b = base(c, i)
        radix = F.when(b == 50, 8).when(b == 48, F.when(i.isin(*first), 2).otherwise(10) if first else 10).otherwise(26)
        return _symbol(c - b, radix)

    def run(codes: Column) -> Column:
        return F.array_join(F.zip_with(feistel(F.transform(codes, symbol), key, tweak, undo), F.transform(codes, base),
                                       lambda v, b: F.chr(v + b)), "")

    return bound(F.transform(characters(s), lambda c: F.ascii(c)), run)


def _refill(match: Column, symbols: Column, kept: str = "[^0-9]") -> Column:
    """``match`` with its characters outside ``kept`` replaced by ``symbols`` in turn."""
    def fill(told: Column) -> Column:
        def put(acc: Column, c: Column) -> Column:
            fixed = c.rlike(kept)
            return F.struct((acc["i"] + F.when(fixed, 0).otherwise(1)).alias("i"),
                            F.concat(acc["out"], F.when(fixed, c).otherwise(F.substr(told, acc["i"], F.lit(1)))).alias("out"))

        start = F.struct(F.lit(1).alias("i"), F.lit("").alias("out"))
        return F.aggregate(characters(match), start, put, lambda acc: acc["out"])

    return bound(symbols, fill)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn_digit(payload: Column) -> Column:
    """The check digit that follows ``payload``."""
    each = F.transform(F.reverse(characters(payload)), lambda c, i: F.when(i % 2 == 0, c.cast("int") * 2).otherwise(c.cast("int")))
    total = F.aggregate(each, F.lit(0), lambda acc, v: acc + F.when(v > 9, v - 9).otherwise(v))
    return F.pmod(10 - total % 10, F.lit(10)).cast("string")


def iban_digits(country: Column, account: Column) -> Column:
    """The two check digits of an IBAN."""
    def add(acc: Column, c: Column) -> Column:
        v = F.when(c >= 65, c - 55).otherwise(c - 48)
        return ((acc * F.when(v > 9, 100).otherwise(10) + v) % 97).cast("int")

    codes = F.transform(characters(F.concat(account, country, F.lit("00"))), lambda c: F.ascii(c))
    return F.lpad((98 - F.aggregate(codes, F.lit(0), add)).cast("string"), 2, "0")


def _payload(digits: Column) -> Column:
    return F.substr(digits, F.lit(1), F.length(digits) - 1)


def _valid_card(m: Column) -> Column:
    return bound(_digits(m), lambda d: F.length(d).between(13, 19) & (F.right(d, F.lit(1)) == luhn_digit(_payload(d))))


def _joined(groups: Column, i: Column, n: Column) -> Column:
    return F.array_join(F.slice(groups, i, n), "")


def card_spans(groups: Column) -> Column:
    """The cards in a run of digit groups as (i, n): first group, from 1, and number of groups.

    That is the whole run if it is a card, else, from the left, what is written like
    one, else the longest groups from the left that are valid.
    """
    size = F.size(groups)

    def search(like: bool) -> Column:
        def fits(m: Column) -> Column:
            return m.rlike(CARD_LIKE) & _valid_card(m) if like else _valid_card(m)

        def best(i: Column) -> Column:
            return F.array_max(F.filter(F.sequence(F.lit(1), F.least(F.lit(19), size - i + 1)),
                                        lambda n: bound(_joined(groups, i, n), fits)))

        def add(acc: Column, i: Column) -> Column:
            return F.when(i < acc["next"], acc).otherwise(bound(best(i), lambda n: F.when(n.isNull(), acc).otherwise(
                F.struct((i + n).alias("next"), F.concat(acc["out"], F.array(F.struct(i.alias("i"), n.alias("n")))).alias("out")))))

        start = F.struct(F.lit(1).alias("next"), F.array().cast("array<struct<i:int,n:int>>").alias("out"))
        return F.aggregate(F.sequence(F.lit(1), size), start, add, lambda acc: acc["out"])

    whole = F.array(F.struct(F.lit(1).alias("i"), size.alias("n")))
    return F.when(_valid_card(F.array_join(groups, "")), whole).otherwise(
        bound(search(True), lambda out: F.when(F.size(out) > 0, out).otherwise(search(False))))


def _groups(m: Column) -> Column:
    return F.regexp_extract_all(m, F.lit("[ -]?[0-9]+"), F.lit(0))


def _card(m: Column, key: str, undo: bool) -> Column:
    """The cards of a run of digits, and the dates, social security and phone numbers beside them.

    The run is changed until cards are found at the same places again, so that undoing finds them too.
    """
    beside = {k: KINDS[k] for k in ("date", "ssn", "phone")}
    pattern = "|".join(f"(?:{p})" for p in beside.values())

    def card(piece: Column) -> Column:
        new = bound(_symbols(_payload(_digits(piece)), key, "card", undo), lambda new: F.concat(new, luhn_digit(new)))
        return _refill(piece, new)

    def rest(groups: Column, i: Column, n: Column) -> Column:
        return bound(_joined(groups, i, n), lambda piece: rewritten(piece, pattern, lambda x: pseudonym(x, key, undo, beside), "[0-9]"))

    def once(v: Column, spans: Column) -> Column:
        def change(groups: Column) -> Column:
            def add(acc: Column, x: Column) -> Column:
                return F.struct((x["i"] + x["n"]).alias("at"), F.concat(
                    acc["out"], rest(groups, acc["at"], x["i"] - acc["at"]),
                    F.when(x["n"] > 0, bound(_joined(groups, x["i"], x["n"]), card)).otherwise("")).alias("out"))

            start = F.struct(F.lit(1).alias("at"), F.lit("").alias("out"))
            last = F.array(F.struct((F.size(groups) + 1).alias("i"), F.lit(0).alias("n")))
            return F.aggregate(F.concat(spans, last), start, add, lambda acc: acc["out"])

        return bound(_groups(v), change)

    def walk(spans: Column) -> Column:
        def step(acc: Column, _: Column) -> Column:
            return F.when(acc["done"], acc).otherwise(bound(once(acc["v"], spans), lambda v: F.struct(
                v.alias("v"), (bound(_groups(v), card_spans) == spans).alias("done"))))

        start = F.struct(m.alias("v"), F.lit(False).alias("done"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(MOST_STEPS)), start, step, lambda acc: acc["v"])

    return bound(bound(_groups(m), card_spans), walk)


def _iban(m: Column, key: str, undo: bool) -> Column:
    country, check, account = F.substring(m, 1, 2), F.substring(m, 3, 2), F.substr(m, F.lit(5))
    new = bound(_symbols(account, key, "iban", undo), lambda new: F.concat(country, iban_digits(country, new), new))
    return F.when(check == iban_digits(country, account), new).otherwise(m)


def _date(m: Column, key: str, undo: bool) -> Column:
    def parsed(form: str) -> Column:
        return F.try_to_timestamp(m, F.lit(form)).cast("date")

    def moved(form: str) -> Column:
        n = F.datediff(parsed(form), F.lit(FIRST_DAY).cast("date"))
        pair = F.array(_symbol(F.floor(n / DAYS[1]), DAYS[0]), _symbol(n % DAYS[1], DAYS[1]))
        return bound(feistel(pair, key, "date", undo), lambda new: F.date_format(
            F.date_add(F.lit(FIRST_DAY).cast("date"), (new[0] * DAYS[1] + new[1]).cast("int")), form))

    def inside(form: str) -> Column:
        return F.coalesce(parsed(form).between(F.lit(FIRST_DAY).cast("date"), F.lit("2199-12-31").cast("date")), F.lit(False))

    shape = F.regexp_replace(m, "[0-9]", "0")
    out = m
    for like, form in reversed([("0000-00-00", "yyyy-MM-dd"), ("0000/00/00", "yyyy/MM/dd"), ("00-00-0000", "dd-MM-yyyy"),
                                ("00/00/0000", "dd/MM/yyyy"), ("00.00.0000", "dd.MM.yyyy")]):
        out = F.when((shape == like) & inside(form), moved(form)).otherwise(out)
    # month first: only days that cannot be months, 13 to 28, which every month has
    month, day, year = (F.substring(m, at, n).cast("int") for at, n in ((1, 2), (4, 2), (7, 4)))
    triple = F.array(_symbol(year - 1800, 400), _symbol(month - 1, 12), _symbol(day - 13, 16))
    american = bound(feistel(triple, key, "date", undo), lambda new: F.concat(
        F.lpad((new[1] + 1).cast("string"), 2, "0"), F.lit("/"), (new[2] + 13).cast("string"), F.lit("/"), (new[0] + 1800).cast("string")))
    return F.when((shape == "00/00/0000") & month.between(1, 12) & day.between(13, 28) & year.between(1800, 2199), american).otherwise(out)


def _ip(m: Column, key: str, undo: bool) -> Column:
    parts = F.split(m, r"\.").cast("array<int>")
    new = feistel(F.transform(parts, lambda v: _symbol(v, 256)), key, "ip", undo)
    return F.when(F.array_max(parts) <= 255, F.array_join(new.cast("array<string>"), ".")).otherwise(m)


def _phone(m: Column, key: str, undo: bool) -> Column:
    digits = _digits(m)
    country, rest = F.substr(digits, F.lit(1), F.length(digits) - 10), F.right(digits, F.lit(10))
    return _refill(m, F.concat(country, _symbols(rest, key, "phone", undo, (0, 3))))


def _email(m: Column, key: str, undo: bool) -> Column:
    name, host = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
    new = _symbols(F.regexp_replace(name, "[^A-Za-z0-9]", ""), key, "email", undo)
    return F.concat(_refill(name, new, "[^A-Za-z0-9]"), F.lit("@"), host)


def _ssn(m: Column, key: str, undo: bool) -> Column:
    return _refill(m, _symbols(_digits(m), key, "ssn", undo))


CHANGES = {"email": _email, "iban": _iban, "date": _date, "ip": _ip, "ssn": _ssn, "phone": _phone, "card": _card}


def kind_of(match: Column, kinds: dict[str, str] = KINDS) -> Column:
    """Which of ``kinds`` a match belongs to: the first that fits it whole."""
    out = F.lit(None).cast("string")
    for kind in reversed(kinds):
        out = F.when(match.rlike(f"^(?:{kinds[kind]})$"), kind).otherwise(out)
    return out


def pseudonym(match: Column, key: str, undo: bool = False, kinds: dict[str, str] = KINDS) -> Column:
    """The pseudonym of one matched value, or the value itself if it is not valid."""
    def change(kind: Column) -> Column:
        out = match
        for name in kinds:
            out = F.when(kind == name, CHANGES[name](match, key, undo)).otherwise(out)
        return out

    return bound(kind_of(match, kinds), change)


def pseudonymise(docs: DataFrame, key: str, undo: bool = False) -> DataFrame:
    """All columns of ``docs`` with the personal data in ``text`` replaced.

    Null texts stay null, empty ones empty; other columns, clashing names
    among them, are passed on.  Every row is changed by itself.  With ``undo``
    and the same key the values come back.
    """
    text = F.col("text").cast("string")
    return docs.withColumn("text", rewritten(text, ANY, lambda m: pseudonym(m, key, undo), GATE))


def personal_values(text: Column | None = None) -> Column:
    """The matched values of a text, valid or not."""
    return F.regexp_extract_all(text_of() if text is None else text, F.lit(ANY), F.lit(0))
