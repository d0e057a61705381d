"""Toxicity: a weighted finite-state pattern grammar over the clauses of a text.

Words become classes (insult, threat, target, negation, report, other) and a
clause is read by a composition of transducers.  Each one passes its symbols
on, with a factor, to the next:

* negation: an insult or threat up to three words after a negation weighs 1/4;
* report: after a verb of reported speech the rest of the clause weighs 1/2;
* target: a person addressed up to four words before an insult raises it by a
  half; a threat counts in full only if the speaker makes it (I, we) to somebody
  addressed, who is its next word or the one after, or an object within two words
  before it.  Without a speaker, with a third person or over up to four words
  it weighs 1/4, and without anybody behind it nothing.  These are weak threats,
  as negated and reported ones are.

The weights of matched clauses add up to m and the score is 1 - exp(-m).  Weak
threats add at most one a clause, and in a text of more than WEAK_CLAUSES clauses
their sum is scaled down to that length.  What the labels say about a threat word lowers its weight.

Insults and their weights are learned: a term is a word, or a stem (the first
4 to 6 letters of a longer word, for inflected forms), that marks labelled
toxic texts.  Copies of one toxic text would make all of its words look toxic,
so a word also needs different words before it, and a stem different words
that have it, more of them the more texts there are.

Common terms are those that clean texts have too, though far more rarely: where words are
compounds, a toxic one's stem also arises by chance, and a language with few labels has few
texts to learn from.  They go through the same machines, but count by their share of a text's words:
FULL_RATE of them alone gives the score at which a text is predicted toxic.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.session import release

from .common import plain, small_batches, stage, text_of

SAMPLE_ROWS = 20_000   # at most about this many labelled rows are used for learning
LEAST_CONTEXTS = 4, 12  # contexts of a term in toxic texts, and toxic texts with it: an eighth of them within these bounds
MOST_CONTEXTS = 64     # contexts that one batch reports of a term; the upper bound above would be enough
LEAST_WEIGHT = 3.5     # log odds of a term
COMMON_LEAST = 6       # toxic texts and contexts of a common term, at most
COMMON_RATE = 3.0      # log of how many times as often as in clean texts a common term occurs in toxic ones
COMMON_WEIGHT = 2.0    # log odds of a common term
FULL_RATE = 0.008      # share of a text's words that suffices, if they are common terms
PADDING = 150          # words that are added to a text's length for that
STEMS = (4, 5, 6)
PREDICTED_FROM = 0.7
THREAT_WEIGHT = 1.5    # of a threat that no clean label speaks against
WEAK = 0.25            # share of it that a weak threat has
WEAK_CLAUSES = 8

THREATS = frozenset("kill murder hurt destroy beat stab shoot strangle umbringen töten toeten schlagen tuer tuerai frapper"
                    " matar matare mataré golpear".split())
TARGETS = frozenset("you your youre u ya they them he she him her du dich dir ihr euch sie tu toi vous te ti usted ustedes"
                    " vosotros ellos".split())
SECOND = frozenset("you u ya".split())
OBJECTS = frozenset("dich dir euch te vous".split())   # stand before the verb too
SPEAKERS = frozenset("i we im ill gonna ich wir je nous yo voy vamos".split())
SPOKEN = frozenset("tuerai mataré matare".split())     # threats whose form tells the speaker
NEGATIONS = frozenset("not never no dont isnt arent wasnt nicht kein keine keinen nie ne jamais nunca".split())
REPORTS = frozenset("said says reported quoted claimed alleged called sagte berichtete nannte dit disait rapporté dijo dice llamó".split())

WORD = re.compile(r"[^\W\d_]+")
CLAUSE = re.compile(r"[.!?;:,\n]+")


class Transducer:
    """A sequential machine: step(state, symbol) -> (state, symbol for the next machine, factor)."""

    def __init__(self, start, step):
        self.start, self.step = start, lru_cache(maxsize=4096)(step)

    def then(self, other: Transducer) -> Transducer:
        """The composition: ``other`` reads what this machine writes."""
        def step(state, symbol):
            one, passed, f = self.step(state[0], symbol)
            two, out, g = other.step(state[1], passed)
            return (one, two), out, f * g
        return Transducer((self.start, other.start), step)

    def weigh(self, symbols: list[str], weights: list[float]) -> tuple[float, float, float]:
        """Weight of the clause, that of its heaviest weak threat, and the number of its common terms."""
        state, total, weak, threat, plainly, common = self.start, 0.0, 0.0, 0.0, True, 0.0
        for symbol, weight in zip(symbols, weights, strict=True):
            state, out, factor = self.step(state, symbol)
            if symbol == "T":
                threat, plainly = weight * factor, factor == 1
            if out == "I":
                total += weight * factor
            elif out == "C":
                common += factor
            elif out == "T" and plainly:
                total += threat
            elif out in "TW":
                weak = max(weak, threat if out == "T" else WEAK * threat)
        return total, weak, common


def _negation(left: int, symbol: str):
    if symbol == "N":
        return 3, symbol, 1.0
    return max(left - 1, 0), symbol, 0.25 if left and symbol in "ICT" else 1.0


def _report(inside: bool, symbol: str):
    return inside or symbol == "R", symbol, 0.5 if inside and symbol in "ICT" else 1.0


def _target(state: tuple[int, bool, int, int], symbol: str):
    """Writes T for a full threat and W for a weak one, at the threat or at the target behind it."""
    left, speaker, before, gap = state
    later = max(left - 1, 0), speaker, max(before - 1, 0), max(gap - 1, 0)
    if symbol in "YDG":     # second person, second person as object, other
        near = gap >= 3
        out = "T" if near and speaker and symbol != "G" else "W" if near or gap and symbol != "G" else symbol
        return (4, speaker, 2 if symbol == "D" else later[2], 0), out, 1.0
    if symbol == "S":
        return (later[0], True, *later[2:]), symbol, 1.0
    if symbol == "T":
        return (*later[:3], 0 if before else 4), ("T" if speaker else "W") if before else "t", 1.0
    return later, symbol, 1.5 if left and symbol in "IC" else 1.0


def grammar() -> Transducer:
    return Transducer(0, _negation).then(Transducer(False, _report)).then(Transducer((0, False, 0, 0), _target))


def _weight(word: str, terms: dict[str, float]) -> float:
    """The weight of an insult, -1 for a common term, else 0."""
    forms = [word, *(word[:n] + "*" for n in STEMS if len(word) > n)]
    return max(terms.get(f, 0.0) for f in forms) or (-1.0 if any("~" + f in terms for f in forms) else 0.0)


def score(text: str, terms: dict[str, float], machine: Transducer, known: dict[str, float]) -> tuple[float, int]:
    """Score and number of matched clauses; ``known`` keeps the weight of words seen (0: no insult)."""
    lower = text.lower()
    marked = False
    for word in set(WORD.findall(lower)):
        weight = known.get(word)
        if weight is None:
            weight = _weight(word, terms)
            if len(known) < 200_000:
                known[word] = weight
        marked = marked or weight != 0 or word in THREATS
    total, faint, common, clauses, length, n_words = 0.0, 0.0, 0.0, 0, 0, 0
    if marked:
        for clause in CLAUSE.split(lower):
            symbols, weights = [], []
            for word in WORD.findall(clause):
                weight = known.get(word)
                if weight is None:
                    weight = _weight(word, terms)
                if not weight and word in SPOKEN:
                    symbols.append("S")
                    weights.append(0.0)
                symbols.append("I" if weight > 0 else "C" if weight < 0 else "T" if word in THREATS else "D" if word in OBJECTS else "Y" if word in SECOND
                               else "G" if word in TARGETS else "S" if word in SPEAKERS
                               else "N" if word in NEGATIONS else "R" if word in REPORTS else "O")
                weights.append(weight or terms.get("!" + word, THREAT_WEIGHT))
            m, weak, more = machine.weigh(symbols, weights)
            clauses += m + weak + more > 0
            length += bool(symbols)
            n_words += len(symbols)
            total += m
            faint += weak
            common += more
    total += faint * min(1, WEAK_CLAUSES / max(length, 1)) - np.log1p(-PREDICTED_FROM) * common / (n_words + PADDING) / FULL_RATE
    return float(-np.expm1(-total)), clauses


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that learning must not see: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn_terms(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> dict[str, float]:
    """Insult terms with their weights, from labelled documents that are not held out.

    At most about ``sample_rows`` labels are used, picked by a hash of the id:
    a bounded table that is broadcast.  Terms are counted on the executors;
    only the chosen ones come to the driver, no more than that sample can hold.

    Insults are terms that clean texts hardly have.  *Common* terms ("~" and the term) occur in clean
    texts as well, but far more often in toxic ones; they need fewer toxic texts, so a language with few labels has its own, and count by their
    share of a text's words.  A threat
    word that clean texts have too is among them, as "!" and the word, with
    THREAT_WEIGHT times the toxic texts' part in its use.
    """
    chosen = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")) \
        .where(~held_out() & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).dropDuplicates(["doc_id"])
    total = max(chosen.count(), 1)
    chosen = chosen.where(F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1_000_000)) < int(1e6 * min(1, sample_rows / total)))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")) \
        .join(F.broadcast(chosen), "doc_id").select("toxic", "text")

    n = {r[0]: r[1] for r in chosen.groupBy("toxic").count().collect()}
    pos, neg = n.get(1, 0), n.get(0, 0)
    least = min(max(LEAST_CONTEXTS[0], pos // 8), LEAST_CONTEXTS[1])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts, times, contexts = [Counter(), Counter()], [Counter(), Counter()], {}
            for toxic, text in zip(batch["toxic"], batch["text"], strict=True):
                words = WORD.findall(text.lower())
                terms = {word: [word, *(word[:n] + "*" for n in STEMS if len(word) > n)] for word in set(words)}
                counts[toxic].update(set(chain.from_iterable(terms.values())))
                times[toxic].update(chain.from_iterable(map(terms.get, words)))
                times[toxic][""] += len(words)
                if toxic:
                    for word, before in zip(words, ["", *words], strict=False):
                        contexts.setdefault(word, set()).add(before)
                        for stem in terms[word][1:]:
                            contexts.setdefault(stem, set()).add(word)
            rows = [(t, counts[1][t], counts[0][t], times[1][t], times[0][t], sorted(contexts.get(t, ()))[:MOST_CONTEXTS])
                    for t in counts[0].keys() | counts[1].keys() | {""}]
            yield plain(pd.DataFrame(rows, columns=["term", "pos", "neg", "pos_n", "neg_n", "contexts"]))

    docs_with = texts.mapInPandas(count, "term string, pos long, neg long, pos_n long, neg_n long, contexts array<string>").groupBy("term").agg(
        *(F.sum(c).alias(c) for c in ("pos", "neg", "pos_n", "neg_n")), F.size(F.array_distinct(F.flatten(F.collect_list("contexts")))).alias("contexts"))
    odds = F.log((F.col("pos") + 0.5) / (pos - F.col("pos") + 0.5)) - F.log((F.col("neg") + 0.5) / (neg - F.col("neg") + 0.5))
    docs_with = stage(docs_with, "terms")
    words = docs_with.where("term = ''").select("pos_n", "neg_n").first() or (0, 0)
    rate = F.log((F.col("pos_n") + 0.5) / (words[0] + 1)) - F.log((F.col("neg_n") + 0.5) / (words[1] + 1))
    few = min(least, COMMON_LEAST)
    rows = docs_with.where("term <> ''").withColumn("weight", odds).withColumn("threat", F.col("term").isin(*THREATS)).withColumn(
        "likely", (F.col("pos") >= least) & (F.col("contexts") >= least) & (F.col("weight") >= LEAST_WEIGHT) & (F.col("pos") >= 3 * F.col("neg"))) \
        .withColumn("common", (F.col("pos") >= few) & (F.col("contexts") >= few) & (F.col("weight") >= COMMON_WEIGHT) & (rate >= COMMON_RATE))
    found = rows.where("threat or likely or common").orderBy("term").collect()
    release(docs_with)
    terms = {r["term"]: min(1.5, r["weight"] / 4) for r in found if r["likely"]}
    terms |= {"~" + r["term"]: 1.0 for r in found if r["common"] and not r["likely"]}
    for r in found:
        if r["threat"] and not r["likely"] and r["neg"]:
            toxic, clean = (r["pos"] + 1) / (pos + 1), r["neg"] / (neg + 1)
            terms["!" + r["term"]] = THREAT_WEIGHT * toxic / (toxic + clean)
    return terms


def score_documents(docs: DataFrame, terms: dict[str, float]) -> DataFrame:
    """All columns of ``docs`` with score, predicted and n_clauses (in place of columns of these names).

    Null and empty texts score 0.  A table without terms scores threats only.
    Every row is scored by itself, repeated rows alike.
    """
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        machine, known = grammar(), {}
        for texts in batches:
            yield pd.DataFrame([score(t or "", terms, machine, known) for t in texts], columns=["score", "n_clauses"])

    small_batches(docs.sparkSession)
    scored = F.pandas_udf(run, "score double, n_clauses int")(text_of())
    kept = [c for c in docs.columns if c not in ("score", "predicted", "n_clauses", "_scored")]
    return docs.select(*(F.col(f"`{c}`") for c in kept), scored.alias("_scored")).select(
        *(F.col(f"`{c}`") for c in kept), F.col("_scored.score").alias("score"),
        (F.col("_scored.score") >= PREDICTED_FROM).cast("int").alias("predicted"), F.col("_scored.n_clauses").alias("n_clauses"))
