"""N-gram Jaccard self-join with adaptive multi-match prefixes.

A document is the set of its distinct word shingles (64-bit hashes).  Texts
with equal sets are one *class* (its id is a 64-bit digest of the set), and
the join runs over classes, so exact copies are never paired.

Prefixes.  All sets are read in one order, that of the hashes.  Let the
l-prefix of a set of n shingles be its first n - ceil(t * n) + l.  Two sets of
similarity t or more share at least min(l1, l2) tokens of their prefixes.  A
first pass lists frequent shingles with their counts.  A document whose prefix
holds h *hot* ones (lists too costly to join) takes l = h + 1 + e: of the
shared tokens at most h are hot, so at least 1 + e others are shared, and hot
tokens need no list at all.  e grows with the estimated length of the lists
that the prefix meets, so dear prefixes must match more often before a pair is
verified.  Sets that are hot nearly all over (no such l exists) keep the hot
tokens of their 1-prefix and meet each other there: nothing is lost.

Pairs.  In every token's list all classes are first compared with a hub (a star, as many pairs as
rows): the class whose shingles are the most frequent ones, so that in a family of
copies it is the text they were made from.  Verified links are joined into
components, and only pairs of *different* components are formed in lists of
bounded numbers of pairs, with the multi-match count; a bound from their prefixes, then
the sets themselves decide.

Larger lists are never joined with themselves.  Their classes are compared with a *centre*: the shingles that most of the
hub's kin have, mostly the text that a family of copies was made from, whether it is there or not.  Let a class x lack the set A(x)
of its centre's h shingles and have the set B(x) beside them, and write o for what x and y have in common of both.  Then
|x n y| = |h| - |A(x)| - |A(y)| + o, and x and y are alike only if o >= C(x) + C(y) - K, with
C = (100 |A| + t |B|) / (100 + t) and K = (100 - t) |h| / (100 + t).  The class m of the least C stands for the centre: all that are alike to it
are *near*, and linked.  If x is not, C(x) + C(m) > K, so any y alike to it shares differences with it, more than C(x) - C(m) and more than
C(y) - C(m).  Where they share the first one, the differences that each has from there on bound o.  The differences, shingles beside the centre first, are new lists with prefixes of their own, in which the same is
done again, as long as that leaves fewer pairs than the lists had.  1 - similarity is a metric: of two classes that are alike both are at least INNER % alike to the centre, less the
100 - t % that they may differ, or neither is INNER % alike to it.  So only the former are listed by differences, and
classes that are not INNER % alike to the centre stay in the list for another one, to meet those that are not listed by differences.  A group of thousands of near copies thus costs its size, not its square; no link between components is lost.
Verification is exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.session import free_shuffles, release

from .common import content_key, doc_key, plain, shingle_sets, stage
from .components import components

LISTED = 8            # shingles counted this often are listed with their count
HOT = 48              # and hot from here on
MOST_LISTED = 1 << 18  # the list is shipped to every task, so its length is bounded; the rest count as rare
LARGE = 128           # pairs for two classes of a list, from which on it is not joined with itself
ROUNDS = 4            # of hubs and differences at most; what is large after them is paired in full
INNER = 65            # percent: a class this much alike to a centre needs no other centre
CENTRE = 128          # members of a hub, about, that are asked for its centre
MOST_EXTRA = 3
HELD_TOKENS = 1 << 21
BUCKETS = 1 << 18     # bound of the broadcast pre-filter of documents that need verification


def set_digest(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def frequent_shingles(docs: DataFrame, words: int = 5, listed: int = LISTED, most: int = MOST_LISTED) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and estimated counts of the most frequent shingles, at most ``most``.

    Every task counts the sets of some HELD_TOKENS tokens (equal sets once) and
    reports what occurs among them twice or more; the counts are only used to
    estimate costs.
    """
    def told(sets: list[np.ndarray]) -> pd.DataFrame:
        tokens, n = np.unique(np.concatenate([*sets, np.zeros(0, np.int64)]), return_counts=True)
        return pd.DataFrame({"token": tokens[n > 1], "n": n[n > 1]})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sets, seen, held = [], set(), 0
        for batch in batches:
            for tokens in shingle_sets(batch["text"], words):
                if len(tokens) and (d := set_digest(tokens)) not in seen:
                    seen.add(d)
                    sets.append(tokens)
                    held += len(tokens)
                    if held >= HELD_TOKENS:
                        yield told(sets)
                        sets, seen, held = [], set(), 0
        yield told(sets)

    found = docs.select("text").mapInPandas(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")) \
        .where(F.col("n") >= listed).orderBy(F.desc("n"), "token").limit(most).collect()
    found.sort()
    return np.array([r[0] for r in found], np.int64), np.array([r[1] for r in found], np.int64)


def estimates(tokens: np.ndarray, listed: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The listed counts of a set's tokens, 0 for others."""
    if not len(listed):
        return np.zeros(len(tokens), np.int64)
    at = np.minimum(np.searchsorted(listed, tokens), len(listed) - 1)
    return np.where(listed[at] == tokens, counts[at], 0)


def prefix(tokens: np.ndarray, est: np.ndarray, percent: int, hot_from: int = HOT) -> tuple[np.ndarray, int]:
    """The tokens under which a set is listed, and e (see the module's text); -1 if it is hot nearly all over."""
    n = len(tokens)
    need = -(-percent * n // 100)
    hot = est >= hot_from
    if not hot.any() and not est[:n - need + 1].any():
        return tokens[:n - need + 1], 0
    held = np.concatenate(([0], np.cumsum(hot)))
    l = np.arange(1, need + 1)
    fits = held[n - need + l]
    ok = np.flatnonzero(fits < l)
    if not len(ok):
        return np.concatenate((tokens[~hot], tokens[:n - need + 1][hot[:n - need + 1]])), -1
    end = n - need + ok[0] + 1
    cost = est[:end][~hot[:end]].sum()
    e = int(min(MOST_EXTRA, np.log2(1 + cost / 16)))
    while e and not (fits < l - e).any():
        e -= 1
    end = n - need + int(np.flatnonzero(fits < l - e)[0]) + 1
    return tokens[:end][~hot[:end]], e


def describe(docs: DataFrame, listed: np.ndarray, counts: np.ndarray, words: int, percent: int, hot: int) -> DataFrame:
    """Per document: doc_id, _key, class (0 without shingles), n, the mean count of its shingles and the listed prefix."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for tokens in shingle_sets(batch["text"], words):
                if len(tokens):
                    est = estimates(tokens, listed, counts)
                    tokens_in, e = prefix(tokens, est, percent, hot)
                    out.append((set_digest(tokens), len(tokens), e, float(est.mean()), tokens_in))
                else:
                    out.append((0, 0, 0, 0.0, tokens))
            got = pd.DataFrame(out, columns=["cls", "n", "e", "mid", "prefix"])
            yield plain(pd.concat([batch[["doc_id", "_key"]].reset_index(drop=True), got], axis=1))

    # ids travel as text: pandas turns integers with nulls among them into rounded floats
    told = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "_key", "text") \
        .mapInPandas(run, "doc_id string, _key long, cls long, n long, e int, mid float, prefix array<long>")
    return told.withColumn("doc_id", F.col("doc_id").cast("long"))


def _wanted(table: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    """The rows of ``table`` whose ``column`` is in ``wanted``.

    A broadcast table of buckets (at most BUCKETS rows) keeps most other rows out of the shuffle.
    """
    bucket = F.pmod(column, F.lit(BUCKETS)).alias("_bucket")
    near = table.withColumn("_bucket", bucket).join(F.broadcast(wanted.select(bucket).distinct()), "_bucket", "left_semi").drop("_bucket")
    return near.join(wanted.select(column), column, "left_semi")


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(cls, tokens) of the documents whose _key is wanted, at most one row for each class."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [*shingle_sets(batch["text"], words)]
            yield pd.DataFrame({"cls": [set_digest(s) for s in sets], "tokens": sets})

    return _wanted(docs.select("_key", "text"), wanted, "_key").select("text") \
        .mapInPandas(run, "cls long, tokens array<long>").dropDuplicates(["cls"])


def ends(pairs: DataFrame) -> DataFrame:
    """The classes of (a, b) pairs."""
    return pairs.select(F.col("a").alias("cls")).distinct().union(pairs.select(F.col("b").alias("cls")).distinct()).distinct()


def among(some: np.ndarray, others: np.ndarray) -> int:
    """How many of some occur among the others, which are sorted."""
    return int((others[np.minimum(np.searchsorted(others, some), len(others) - 1)] == some).sum()) if len(others) else 0


def possible(pairs: DataFrame, told: DataFrame, percent: int) -> DataFrame:
    """The (a, b) pairs that their listed prefixes do not rule out.

    A prefix holds all tokens of its set, hot ones aside, up to its last one.
    Up to the lesser of two last tokens, what one prefix has and the other
    lacks is not shared: that bounds the intersection from above.  Sets that
    are hot nearly all over are let through.  Only the upper halves of the tokens are
    sent: they keep the order, and those that coincide count as shared, so the bound still holds.
    """
    upper = F.transform("prefix", lambda t: F.shiftright(t, 32).cast("int")).alias("prefix")
    mine = _wanted(told.where("n > 0").select("cls", "n", "e", upper), ends(pairs), "cls").dropDuplicates(["cls"])
    one, two = (mine.select(F.col("cls").alias(x), F.col("n").alias(f"n{x}"), F.col("e").alias(f"e{x}"), F.col("prefix").alias(f"p{x}")) for x in "ab")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = np.ones(len(batch), bool)
            for i, (na, ea, x, nb, eb, y) in enumerate(zip(*(batch[c] for c in ("na", "ea", "pa", "nb", "eb", "pb")), strict=True)):
                if ea < 0 or eb < 0 or not len(x) or not len(y):
                    continue
                last = min(x[-1], y[-1])
                x, y = x[:np.searchsorted(x, last, side="right")], y[:np.searchsorted(y, last, side="right")]
                most = min(na - len(x) + among(x, y), nb - len(y) + among(y, x))
                keep[i] = 100 * most >= percent * (na + nb - most)
            yield batch.loc[keep, ["a", "b"]]

    return pairs.select("a", "b").join(one, "a").join(two, "b").mapInPandas(run, "a long, b long")


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) pairs of classes whose sets are at least ``percent`` % alike."""
    one = sets.select(F.col("cls").alias("a"), F.col("tokens").alias("ta"))
    two = sets.select(F.col("cls").alias("b"), F.col("tokens").alias("tb"))
    joined = pairs.select("a", "b").join(one, "a").join(two, "b").withColumn("both", F.size(F.array_intersect("ta", "tb")))
    return joined.where(100 * F.col("both") >= percent * (F.size("ta") + F.size("tb") - F.col("both"))).select("a", "b")


def grouped(docs: DataFrame, words: int = 5, percent: int = 75, hot: int = HOT) -> DataFrame:
    """doc_id, _key (of doc_id and text), n and root, the same for all linked rows and null for blank ones, of every row; stored."""
    keyed = doc_key(docs)
    listed, counts = frequent_shingles(keyed, words)
    told = stage(describe(keyed, listed, counts, words, percent, hot), "prefixes")

    free_shuffles(docs.sparkSession)

    rows = told.where("n > 0").select("cls", F.explode("prefix").alias("token"))
    # one count for each token is all that the large exchange carries; copies are told apart among what is left
    repeated = stage(rows.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("token"), "repeated")
    free_shuffles(docs.sparkSession)
    met = stage(rows.join(repeated, "token").distinct(), "met")     # one row for all copies of a class
    release(repeated)
    mids = told.where("n > 0").groupBy("cls").agg(F.first("mid").alias("mid"))
    lists = stage(_lists(met.join(mids, "cls").withColumns({
        "near": F.lit(False), "short": F.lit(True), **{c: F.lit(None).cast("int") for c in ("beside", "lacks", "due")}})), "lists")
    release(met)

    sizes = told.where("n > 0").groupBy("cls").agg(F.first("n").alias("n"), F.first("e").alias("e"), F.first("mid").alias("mid"), F.min("_key").alias("_key"))
    sizes = stage(sizes.join(lists.select("cls").distinct(), "cls", "left_semi"), "classes")
    alike = (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    large = lists.where("large")
    crowded = stage(large.select("cls").distinct(), "crowded")

    star = lists.where(~F.col("large") & (F.col("cls") != F.col("hub"))).select(
        F.least("hub", "cls").alias("a"), F.greatest("hub", "cls").alias("b")).distinct()
    a, b = (sizes.select(F.col("cls").alias(x), F.col("n").alias(f"n{x}")) for x in "ab")
    star = stage(star.join(a, "a").join(b, "b").where(alike).select("a", "b"), "star")
    likely = stage(possible(star, told, percent), "likely")
    free_shuffles(docs.sparkSession)
    links = [stage(verify(likely, _sets(keyed, sizes.join(ends(likely), "cls", "left_semi"), words), percent), "links")]
    release(likely)

    # lists to be paired; near: alike to the hub, short: within the half prefix
    # in lists of differences also what bounds the common ones from this token on: those left beside the centre and lacking, and what is due
    columns = ["token", "cls", "near", "short", "beside", "lacks", "due"]
    paired, done = [lists.where("not large").select(*columns)], [lists]
    for turn in range(ROUNDS):
        if large.isEmpty():
            break
        members = stage(large.select("hub", "cls").distinct(), "members")
        sets = stage(_sets(keyed, sizes.join(members.select("cls").distinct(), "cls", "left_semi"), words), "sets")
        centres = stage(_centres(members, sets, percent), "centres")
        spokes = members.join(centres.select("hub", "centre"), "hub").select("centre", "cls").distinct()
        apart_by = stage(_differences(spokes, centres.select("centre", "tokens").dropDuplicates(["centre"]), sets, percent), "differences")
        differing = stage(_listed(apart_by, percent), "differing")
        release(sets, apart_by)
        links.append(differing.where("near and cls <> nearest").select(F.col("nearest").alias("a"), F.col("cls").alias("b")))
        unfolded = differing.select("cls", "near", F.posexplode("listed").alias("at", "token"), "half", "centre", "beside", "lacks", "due") \
            .select(F.xxhash64("centre", "token").alias("token"), "cls", "near", (F.col("at") < F.col("half")).alias("short"), "due",
                    F.greatest(F.lit(0), F.col("beside") - F.col("at")).alias("beside"), F.least("lacks", F.col("lacks") + F.col("beside") - F.col("at")).alias("lacks"))
        # who cannot be alike to the one of the list that is nearest to the centre is not alike to any
        unfolded = unfolded.join(unfolded.groupBy("token").agg(F.min("due").alias("least")), "token") \
            .where(2 * (100 + percent) * (F.col("beside") + F.col("lacks")) >= F.col("due") + F.col("least")).drop("least")
        # two classes that are both listed by differences need not meet again: as long as no others are told apart, `near` says so
        apart = large.join(centres.select("hub", "centre"), "hub", "left").join(differing.select("centre", "cls", "inner"), ["centre", "cls"], "left") \
            .where("inner is null or not inner").withColumn("near", F.col("inner").isNotNull() if turn == 0 else F.col("near"))
        unfolded = unfolded.unionByName(apart.select(*columns)).join(sizes.select("cls", "mid"), "cls")
        unfolded = stage(_lists(unfolded), "unfolded")
        release(members, centres)
        done += [differing, unfolded]
        if _pairs_of(unfolded) >= _pairs_of(large):
            break       # what these classes have in common is not the hub's: they meet in the lists they were in
        paired.append(unfolded.where("not large").select(*columns))
        large = unfolded.where("large")
    if not large.isEmpty():
        paired.append(large.select(*columns))

    linked = stage(reduce(DataFrame.union, links), "linked")
    roots = components(linked)
    together = reduce(DataFrame.union, paired)
    # shared tokens are counted in the lists that are paired: a class of a larger list needs only one of them
    more = sizes.join(crowded.withColumn("crowded", F.lit(True)), "cls", "left").join(roots.withColumnRenamed("node", "cls"), "cls", "left").select(
        "cls", "n", F.when(F.col("crowded"), 0).otherwise(F.col("e")).alias("e"), F.coalesce("root", "cls").alias("root"))
    placed = together.join(more, "cls")
    mixed = placed.groupBy("token").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).where("r1 <> r2").select("token")
    placed = stage(placed.join(mixed, "token", "left_semi"), "placed")
    release(*done, crowded)

    def met(one: str, other: str, ordered: str) -> DataFrame:
        left, right = (placed.where(where).select("token", *(F.col(c).alias(f"{c}{x}") for c in ("cls", "root", "n", "e", "beside", "lacks", "due"))) for x, where in (("a", one), ("b", other)))
        # at the first difference that two classes share: all others lie behind it.  Both rows of a token have the same centre, or none
        enough = 2 * (100 + percent) * (F.least("besidea", "besideb") + F.least("lacksa", "lacksb")) >= F.col("duea") + F.col("dueb")
        return left.join(right, "token").where("roota <> rootb").where(ordered).where(alike).where(F.coalesce(enough, F.lit(True))) \
            .select("clsa", "clsb", "ea", "eb")

    # near ones meet those that are not; of these, the short ones each other
    pairs = met("not near and short", "not near and short", "clsa < clsb").union(met("near", "not near", "true"))
    pairs = pairs.groupBy(F.least("clsa", "clsb").alias("a"), F.greatest("clsa", "clsb").alias("b")) \
        .agg(F.count(F.lit(1)).alias("n"), F.first(F.least("ea", "eb")).alias("e")).where("n > e")
    pairs = stage(pairs.join(star, ["a", "b"], "left_anti").select("a", "b"), "pairs")
    release(placed, star)
    likely = stage(possible(pairs, told, percent), "likely")
    release(pairs)
    late = stage(verify(likely, _sets(keyed, sizes.join(ends(likely), "cls", "left_semi"), words), percent), "late")
    release(sizes, likely)

    # what the links between components add: roots are joined, not classes
    over = late.join(roots.withColumnsRenamed({"node": "a", "root": "ra"}), "a", "left").join(roots.withColumnsRenamed({"node": "b", "root": "rb"}), "b", "left") \
        .select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    joined = components(over.unionByName(linked))
    classes = told.select("doc_id", "_key", "n", F.when(F.col("n") > 0, F.col("cls")).alias("cls")) \
        .join(joined.withColumnRenamed("node", "cls"), "cls", "left").select("doc_id", "_key", "n", F.coalesce("root", "cls").alias("root"))
    classes = stage(classes, "grouped")
    release(told, linked, late)
    return classes


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 75, hot: int = HOT) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (doc_id, text; other columns are ignored).

    Two documents link when 100 * |intersection| >= percent * |union| of their
    shingle sets; component_id is the smallest doc_id reachable.  Null and
    blank texts have no shingles and are linked with nothing.  Repeated rows
    come back as often as they were given, in one component.  A null doc_id
    keeps its row; it never is a component's id unless all are null.
    """
    classes = grouped(docs, words, percent, hot)
    least = classes.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    return classes.join(least, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 75, hot: int = HOT) -> DataFrame:
    """The rows of ``docs``, all columns, without near duplicates: one row of every component stays.

    It is the one with the least doc_id, a null last, and among rows that share the id the one with
    the least content key; of rows equal in id and text one stays.  Blank and null texts are no duplicates of anything: all stay.
    """
    classes = grouped(docs, words, percent, hot)
    first = classes.where("root is not null").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_key")).alias("f"))
    keep = first.select(F.col("f._key").alias("_k")).union(classes.where("root is null").select("_key")).distinct()
    repeated = stage(classes.where("root is not null").groupBy("_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_key"), "repeated")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    keyed = docs.select(row, content_key().alias("_k"))
    kept = keyed.join(keep, "_k", "left_semi")
    again = repeated.select(F.col("_key").alias("_k"))
    once = kept.join(again, "_k", "left_semi").groupBy("_k").agg(F.first("_row").alias("_row"))
    return kept.join(again, "_k", "left_anti").select("_row").unionByName(once.select("_row")).select("_row.*")


def _lists(rows: DataFrame) -> DataFrame:
    """The rows of the tokens under which somebody may be paired, with the hub and whether the pairs are too many."""
    several = rows.groupBy("token").agg(F.max(F.struct("mid", "cls"))["cls"].alias("hub"), _met_in_full().alias("pairs"),
                                        F.count(F.lit(1)).alias("size")).where("pairs > 0")
    return rows.drop("mid").join(several.select("token", "hub", (F.col("pairs") > LARGE / 2 * F.col("size")).alias("large")), "token")


def _met_in_full() -> Column:
    """The pairs that the rows of a token make if its list is joined with itself."""
    near, far, short = F.count_if("near"), F.count_if(~F.col("near")), F.count_if(~F.col("near") & F.col("short"))
    return near * far + short * (short - 1) / 2


def _pairs_of(lists: DataFrame) -> float:
    return lists.groupBy("token").agg(_met_in_full().alias("pairs")).agg(F.sum("pairs")).first()[0] or 0


def _centres(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(hub, centre, tokens): of every hub the shingles that most of its kin have, and a digest of them.

    Kin are the hub and the members that are at least INNER less the slack alike to it.  Some CENTRE members of a hub are asked:
    any set of shingles serves as a centre, so this decides how long the lists get and not what is found.
    """
    one_in = members.groupBy("hub").agg(F.count(F.lit(1)).alias("size")).select("hub", F.greatest(F.lit(1), F.floor(F.col("size") / CENTRE)).alias("one_in"))
    asked = members.join(one_in, "hub").where((F.pmod(F.xxhash64("hub", "cls"), F.col("one_in")) == 0) | (F.col("cls") == F.col("hub"))).select("hub", "cls")
    kin = asked.join(sets.select(F.col("cls").alias("hub"), F.col("tokens").alias("th")), "hub").join(sets, "cls") \
        .withColumn("both", F.size(F.array_intersect("tokens", "th"))) \
        .where(100 * F.col("both") >= (INNER - 100 + percent) * (F.size("tokens") + F.size("th") - F.col("both")))
    many = kin.groupBy("hub").agg(F.count(F.lit(1)).alias("kin"))
    most = kin.select("hub", F.explode("tokens").alias("token")).groupBy("hub", "token").agg(F.count(F.lit(1)).alias("n")) \
        .join(many, "hub").where(2 * F.col("n") > F.col("kin"))
    told = most.groupBy("hub").agg(F.sort_array(F.collect_list("token")).alias("told"))
    # where no shingle is that common, the hub's own ones serve
    return members.select(F.col("hub").alias("cls")).distinct().join(sets, "cls").join(told.withColumnRenamed("hub", "cls"), "cls", "left") \
        .select(F.col("cls").alias("hub"), F.coalesce("told", "tokens").alias("tokens")).withColumn("centre", F.xxhash64("tokens"))


def _differences(spokes: DataFrame, centres: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """For the (centre, cls) that are INNER less the slack alike: inner, the differences, those beside the centre first,
    and `cost` and `slack`, which are C and K times 100 + percent."""
    both = spokes.join(centres.withColumnRenamed("tokens", "th"), "centre").join(sets, "cls") \
        .withColumn("beside", F.array_sort(F.array_except("tokens", "th"))).withColumn("lacks", F.array_sort(F.array_except("th", "tokens")))
    a, b, h = F.size("lacks"), F.size("beside"), F.size("th")

    def as_alike_as(share: int) -> Column:
        return 100 * (h - a) >= share * (h + b)

    return both.where(as_alike_as(INNER - 100 + percent)).select(
        "centre", "cls", as_alike_as(INNER).alias("inner"), F.concat("beside", "lacks").alias("all"), b.alias("beside"), a.alias("lacks"),
        (100 * a + percent * b).alias("cost"), ((100 - percent) * h).alias("slack"))


def _listed(differences: DataFrame, percent: int) -> DataFrame:
    """For the same (centre, cls): the nearest class to the centre, near (alike to that class), inner, and the differences under which the
    class is listed, of which `half` count among those that are not near.  Two classes are alike if 2 * (100 + percent) times the
    differences that they share is not less than the sum of what is `due`."""
    scale = 100 + percent
    nearest = differences.groupBy("centre").agg(F.min_by(F.struct("cls", "cost", "all"), F.struct("cost", "cls")).alias("m"))
    told = differences.join(nearest, "centre").withColumn(
        "near", scale * F.size(F.array_intersect("all", "m.all")) >= F.col("cost") + F.col("m.cost") - F.col("slack"))
    size = F.size("all")
    half = (size - F.floor((F.col("cost") - F.col("m.cost")) / scale)).cast("int")
    far = (size + 1 - F.greatest(F.lit(1), F.ceil((F.col("cost") + F.col("m.cost") - F.col("slack")) / scale))).cast("int")
    return told.withColumn("half", half).select(
        "centre", "cls", F.col("m.cls").alias("nearest"), "near", "inner", "half", "beside", "lacks", (2 * F.col("cost") - F.col("slack")).alias("due"),
        F.slice("all", F.lit(1), F.when(F.col("near"), F.col("half")).otherwise(F.greatest("half", far))).alias("listed"))
