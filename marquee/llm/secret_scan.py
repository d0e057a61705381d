"""Secret scan: patterns, and sliding-window Shannon entropy, in SQL functions only.

Candidates are runs of 20 or more letters, digits and +/_=- that hold a digit.
A window of 20 characters slides over each.  Its entropy is log2(20) - S / 20,
where S sums n * log2(n) over the counts n of its characters; a step changes
two counts, so S is kept up by the terms of those two.  The terms are
integers (multiples of 2**-20), so that no rounding depends on the order.
A run of windows with enough entropy for the candidate's character class makes
one span of kind ``entropy``.  Candidates on the allow-list are left out.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of
from .matches import PLACES, characters, located

ASSIGN = (r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"[0-9a-f]{24,}+"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{20,}+"

WINDOW = 20
UNIT = 1 << 20
TERMS = [0 if n < 2 else round(n * log2(n) * UNIT) for n in range(WINDOW + 1)]
# least entropy in bits, by class of character: hexadecimal, letters of one case with digits, all else
LEAST = {"hex": 2.9, "single": 3.5, "mixed": 3.7}
ALLOWED = [
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",   # UUIDs
    r"(?i)example|sample|placeholder|changeme|dummy|xxxx",
    r"(?i)0123456789|abcdefghijklmnop|1234567890",
    r"^[0-9+/_=-]+$",                                                                   # numbers, rulers, dates
    r"(?i)^(?:[a-z]{1,15}[-_/])+[a-z0-9]{1,5}$",                                        # paths and slugs
]


def entropy_runs(candidate: Column) -> Column:
    """(s, e) of the runs of windows with enough entropy, from the candidate's start."""
    limit = F.when(candidate.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), round((log2(WINDOW) - LEAST["hex"]) * WINDOW * UNIT)) \
        .when(candidate.rlike("^(?:[^A-Z]+|[^a-z]+)$"), round((log2(WINDOW) - LEAST["single"]) * WINDOW * UNIT)) \
        .otherwise(round((log2(WINDOW) - LEAST["mixed"]) * WINDOW * UNIT))
    terms = F.array(*(F.lit(t).cast("long") for t in TERMS))

    def seen(window: Column, c: Column) -> Column:
        return F.size(F.filter(window, lambda x: x == c))

    def term(n: Column) -> Column:
        return F.element_at(terms, n + 1)

    def found(chars: Column) -> Column:
        first = F.slice(chars, 1, WINDOW)
        whole = F.aggregate(F.array_distinct(first), F.lit(0).cast("long"), lambda acc, c: acc + term(seen(first, c)))
        runs = F.array().cast("array<struct<s:int,e:int>>")

        def hold(i: Column, s: Column, acc: Column | None) -> Column:
            high = s <= limit
            if acc is None:
                return F.struct(s.alias("sum"), F.when(high, 0).otherwise(-1).alias("s"), F.when(high, WINDOW).otherwise(-1).alias("e"), runs.alias("out"))
            new = high & (i > acc["e"])
            closed = F.concat(acc["out"], F.array(F.struct(acc["s"].alias("s"), acc["e"].alias("e"))))
            return F.struct(s.alias("sum"), F.when(new, i).otherwise(acc["s"]).alias("s"),
                            F.when(high, i + WINDOW).otherwise(acc["e"]).alias("e"),
                            F.when(new & (acc["e"] >= 0), closed).otherwise(acc["out"]).alias("out"))

        def step(acc: Column, i: Column) -> Column:
            both = F.slice(chars, i + 1, WINDOW - 1)
            out, into = seen(both, F.element_at(chars, i)), seen(both, F.element_at(chars, i + WINDOW))
            return hold(i, acc["sum"] - term(out + 1) + term(out) + term(into + 1) - term(into), acc)

        places = F.when(F.size(chars) > WINDOW, F.sequence(F.lit(1), F.size(chars) - WINDOW)).otherwise(F.array().cast("array<int>"))
        return F.aggregate(places, hold(F.lit(0), whole, None), step, lambda acc: F.when(
            acc["e"] >= 0, F.concat(acc["out"], F.array(F.struct(acc["s"].alias("s"), acc["e"].alias("e"))))).otherwise(acc["out"]))

    # transform over one element: the characters are made once and named
    return F.transform(F.array(characters(candidate)), found)[0]


def _told(places: Column, kind: int) -> Column:
    return F.transform(places, lambda p: F.struct(p["s"].alias("s"), F.lit(kind).alias("k"), p["e"].alias("e")))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, ("assign", "access", "hex", "entropy")))
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(
        ":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def scan(docs: DataFrame, allowed: list[str] | None = None) -> DataFrame:
    """doc_id and the arrays assign, access, hex, entropy of (s, e, hit) for every row of ``docs``.

    Places are code points, the end exclusive.  Null and empty texts have no
    matches; repeated rows are scanned alike; other columns are ignored.
    """
    patterns = ALLOWED if allowed is None else allowed
    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    text = F.col("text")
    told = kept.select(
        "doc_id",
        F.filter(located(text, ASSIGN), lambda p: F.length(F.regexp_extract(p["hit"], ASSIGN, 2)) >= 6).alias("assign"),
        located(text, ACCESS).alias("access"), located(text, HEX).alias("hex"), located(text, CANDIDATE).alias("candidates"))

    def free(p: Column) -> Column:
        out = F.lit(True)
        for pattern in patterns:
            out = out & ~p["hit"].rlike(pattern)
        return out

    runs = F.flatten(F.transform(F.filter("candidates", free), lambda p: F.transform(entropy_runs(p["hit"]), lambda r: F.struct(
        (p["s"] + r["s"]).alias("s"), (p["s"] + r["e"]).alias("e"), F.substr(p["hit"], r["s"] + 1, r["e"] - r["s"]).alias("hit")))))
    return told.select("doc_id", "assign", "access", "hex", F.when(F.size("candidates") > 0, runs).otherwise(F.array().cast(PLACES)).alias("entropy"))


def report(found: DataFrame) -> DataFrame:
    """Counts, the joined spans and the digest of the base spans, of ``scan``'s rows."""
    base = F.concat(_told(F.col("assign"), 0), _told(F.col("access"), 1), _told(F.col("hex"), 2))
    return found.select(
        "doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex", "entropy")),
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.concat(base, _told(F.col("entropy"), 3))).alias("spans"))
