"""Whitening, conversation repair and packing against brute force, and odd input."""

import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import conversation_repair, pattern_packing, whitening
from marquee.llm.queries import op11_whitening, op12_conversation_repair, op13_pattern_packing


# ---- whitening

def whitened(vectors, weights):
    """n, deviations, eigenvalues and projections by plain numpy over the fit list."""
    x = np.array(vectors, dtype=object)
    w = np.array(weights, dtype=object)
    n, s = int(w.sum()), (x * w[:, None]).sum(0)
    far = (x * n - s).astype(float) / n
    cov = (far * np.array(weights, float)[:, None]).T @ far / n
    values, basis = np.linalg.eigh(cov)
    order = np.argsort(-values)
    return n, [int(((r * n - s) ** 2).sum()) for r in x], values[order], far @ basis[:, order] / np.sqrt(np.maximum(values[order], 1e-300))


def compare(rows, vectors, weights, components=8):
    n, deviations, values, expected = whitened(vectors, weights)
    for c in range(1, components + 1):
        mine = sorted((r.vec_id, r.whitened, r.deviation, r.n, r.explained) for r in rows if r.component == c)
        assert [(i, d, m) for i, _, d, m, _ in mine] == [(i, deviations[i], n) for i in range(len(vectors))]
        got, want = np.array([w for _, w, *_ in mine]), expected[:, c - 1]
        assert np.abs(got * np.sign(got @ want) - want).max() < 1e-7
        assert abs(mine[0][4] / (values[c - 1] / values.sum()) - 1) < 1e-9
    assert max(r.identity_error for r in rows) < 1e-9 and len({r.identity_error for r in rows}) == 1


@pytest.mark.parametrize("once", [False, True])
def test_whitening_equals_numpy(spark, once):
    rng = np.random.default_rng(3)
    some = (rng.normal(size=(300, 12)) * np.linspace(3, 0.4, 12) * 200).astype(int) + 100_000
    vectors = [v.tolist() for v in some] + [some[7].tolist()] * 1500
    weights = [1] * 1800
    if once:
        weights = [1] * 300 + [0] * 1500
    df = spark.createDataFrame([(i, v, 0.5) for i, v in enumerate(vectors)], "vec_id long, x array<long>, whitened double")
    compare(whitening.whiten(df, once=once).collect(), vectors, weights)


def test_whitening_query_equals_numpy(spark, small):
    table = spark.read.parquet(f"{small}/embeddings.parquet").collect()
    vectors = [[int(np.floor(1024 * float(c))) + 100_000 for c in r.embedding] for r in sorted(table, key=lambda r: r.vec_id)]
    assert [r.vec_id for r in sorted(table, key=lambda r: r.vec_id)] == list(range(len(vectors)))
    rows = op11_whitening(spark, small).collect()
    assert len(rows) == 8 * len(vectors)
    compare(rows, vectors, [1] * len(vectors))


def test_whitening_odd_rows(spark):
    kind = "vec_id long, embedding array<float>, key string"
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0, 0.5]), (2, [2.0, 1.0, -0.5]), (2, [2.0, 1.0, -0.5]), (None, [0.0, 0.0, 7.0]), (3, [4.0]), (4, []),
            (5, None), (6, [1.0, None]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [-inf, 1.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], kind)
    fit = df.where(whitening.valid(F.col("embedding"))).select("vec_id", whitening.quantised(F.col("embedding")).alias("x"))
    got = whitening.whiten(fit).collect()
    assert sorted((r.vec_id or 0, r.component) for r in got) == sorted((i, c) for i in (1, 2, 2, 0, 3, 4) for c in (1, 2, 3))
    assert len({r.n for r in got}) == 1 and got[0].n == 6
    assert whitening.whiten(fit.where("false")).collect() == []
    assert whitening.whiten(fit.where("vec_id = 2")).collect() == []      # no variance, no component
    assert whitening.whiten(fit.where("vec_id = 4")).collect() == []
    large = spark.createDataFrame([(i, [(-1) ** i * 2 ** 40, i]) for i in range(10)], "vec_id long, x array<long>")
    assert whitening.whiten(large).where("deviation is not null").count() == 0     # beyond a long


# ---- conversations

def cheapest(rows):
    """(cost, audit, repaired role:text lines) of rows (role, text, symbol) by trying every edit."""
    @lru_cache(None)
    def best(i, state, inserted):
        options = []
        if i == len(rows) and state in ("", "a"):
            options.append((0, "", ()))
        if inserted < 3:
            to = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
            cost, audit, out = best(i, to, inserted + 1)
            options.append((cost + 3, "I" + audit, ((to, None), *out)))
        if i < len(rows):
            role, text, must_go, cut = rows[i]
            cost, audit, out = best(i + 1, state, 0)
            options.append((cost + 4, "D" + audit, out))
            if not must_go:
                more = 3 * cut
                if (state, role[:1]) in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}:
                    cost, audit, out = best(i + 1, role[0], 0)
                    options.append((cost + more, "K" + audit, ((role, i), *out)))
                to = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
                cost, audit, out = best(i + 1, to, 0)
                options.append((cost + more + 3, "R" + audit, ((to, i), *out)))
        return min(options, default=(10 ** 9, "", ()))

    cost, audit, out = best(0, "", 0)
    names = {"u": "user", "a": "assistant"}
    lines = [f"{names.get(role, role) if len(role) < 2 else role}:{rows[i][1] if i is not None else ''}" for role, i in out]
    return cost, audit, lines


def repaired_by_hand(rows):
    """conv_id -> the report's values, for (conv_id, turn, role, text) rows after damage, in the operator's order."""
    out = {}
    for conv in {r[0] for r in rows}:
        def order(r):
            role, text = r[2], r[3]
            return (r[1] is not None, r[1] or 0, hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).hexdigest())
        mine = sorted(((c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv), key=order)
        seen, told, count = set(), [], [0, 0, 0]
        for _, _, role, text in mine:
            text_seen = re.sub(r"[\x20\x09-\x0D]", "", text)
            blank, dup = not text_seen, (role, text) in seen
            cut = not blank and not dup and text_seen[-1] not in ".!?"
            for k, f in enumerate((blank, dup and not blank, cut)):
                count[k] += f
            seen.add((role, text))
            told.append((role, text, blank or dup, cut))
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(told))
        cost, audit, lines = cheapest(tuple(told))
        out[conv] = (gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def talk(rng, n):
    roles = ["user", "assistant", "system", "tool", "", "uncle", None]
    texts = ["Hello there.", "What is it?", "cut off", "", " \n", "Again!", "more of it", None, "end. \t"]
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(roles) if rng.random() < 0.35 else ["user", "assistant"][turn % 2]
            text = rng.choice(texts) if rng.random() < 0.5 else f"Row {rng.randint(0, 10 ** 6)}."
            rows.append((conv if conv else None, rng.choice([turn, turn, turn * 2, None]), role, text))
            if rng.random() < 0.1:
                rows.append(rows[-1])
    return rows


def told(df_report, df_hash):
    hashes = {r.conv: r.repaired_sha256 for r in df_hash.collect()}
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit,
                        hashes.get(" " if r.conv_id is None else str(r.conv_id), hashlib.sha256(b"").hexdigest())) for r in df_report.collect()}


@pytest.mark.parametrize("chunk", [4096, 3])
def test_repairs_equal_trying_every_edit(spark, monkeypatch, chunk):
    monkeypatch.setattr(conversation_repair, "CHUNK", chunk)
    rows = talk(random.Random(8), 250)
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, part int").repartition(5)
    report, repaired = conversation_repair.repair(df)
    assert told(report, conversation_repair.digests(repaired)) == repaired_by_hand(rows)


def test_a_long_conversation_over_many_partitions(spark, monkeypatch):
    """One conversation of 30,000 rows, a third of them copies of one row, equals the same rows solved in one piece."""
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice([f"Row {t}.", "cut off", "Same.", ""])) for t in range(20_000)]
    rows += [(1, 5, "user", "Many.")] * 10_000 + [(2, 0, "user", "Hello.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    several = told(*(f(x) for f, x in zip((lambda x: x, conversation_repair.digests), conversation_repair.repair(df), strict=True)))
    monkeypatch.setattr(conversation_repair, "CHUNK", 10 ** 6)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        whole = told(*(f(x) for f, x in zip((lambda x: x, conversation_repair.digests), conversation_repair.repair(df), strict=True)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert several == whole and len(several[1][6]) >= 30_000
    assert several[2] == (0, 0, 0, 0, 0, 3, "KI", hashlib.sha256(b"user:Hello.\nassistant:").hexdigest())


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def test_conversation_query_equals_trying_every_edit(spark, small):
    for rows in ([tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()],):
        expected = repaired_by_hand(damaged(rows))
        nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
        got = {r.conv_id: tuple(r)[1:] for r in op12_conversation_repair(spark, small).collect()}
        assert got == {conv: expected.get(conv, nothing) for conv in {r[0] for r in rows}}


def test_damage_and_odd_conversations(spark):
    rows = talk(random.Random(10), 120) + [(7000 + i, 0, "user", "Only.") for i in range(60)]
    kind = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame(rows, kind)
    assert sorted(map(tuple, conversation_repair.damage(df).collect()), key=str) == sorted(damaged(rows), key=str)
    report, repaired = conversation_repair.repair(conversation_repair.damage(df))
    got = conversation_repair.report_all(df, report, conversation_repair.digests(repaired)).collect()
    expected, nothing = repaired_by_hand(damaged(rows)), (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert {r.conv_id: tuple(r)[1:] for r in got} == {c: expected.get(c, nothing) for c in {r[0] for r in rows}}
    report, repaired = conversation_repair.repair(df.where("false"))
    assert report.collect() == [] and repaired.collect() == []


# ---- packing

def check_packing(rows, docs, room=1024):
    """Pieces are those of every document, and sequences are gapless and not too long."""
    encode = pattern_packing.encoder(*pattern_packing.vocabulary_files())
    expected = []
    for doc, text in docs:
        ids = [*encode(text or ""), 2]
        cuts = [0, *range((len(ids) - 1) % room + 1, len(ids) + 1, room)]
        for k, (a, b) in enumerate(itertools.pairwise(cuts)):
            expected.append((doc, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=str) == sorted(expected, key=str)
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= room
    return len(held), sum(r.length for r in rows)


def test_packing_fills_sequences(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    n, total = check_packing(op13_pattern_packing(spark, small).collect(), docs)
    assert n <= 1.03 * -(-total // 1024)


def test_packing_odd_rows(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    packed = pattern_packing.pack(odd, keep_ids=True)
    check_packing(packed.collect(), rows)
    held = pattern_packing.sequences(packed).collect()
    assert all(len(r.ids) == sum(r.lengths) <= 1024 for r in held)
    assert pattern_packing.pack(none).collect() == []
    check_packing(pattern_packing.pack(odd, room=16).collect(), rows, room=16)


def test_plans_use_up_the_histogram_and_are_nearly_full():
    rng = np.random.default_rng(4)
    for sizes in (rng.integers(1, 1025, 30_000), rng.exponential(200, 20_000).astype(int) % 1024 + 1, np.full(9_999, 200), np.array([5]), np.array([], int)):
        histogram = np.bincount(sizes, minlength=1025)
        used, n = np.zeros(1025, int), 0
        for lengths, count in pattern_packing.plan(histogram):
            assert sum(lengths) <= 1024
            n += count
            for length in lengths:
                used[length] += count
        assert (used == histogram).all()
        one = sum(c for _, c in pattern_packing.pack_rest(histogram, 1024))
        assert n <= 1.005 * one + 1


def test_encoding_is_that_of_the_vocabulary_file(odd):
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(pattern_packing.vocabulary_files()[0])
    encode = pattern_packing.encoder(*pattern_packing.vocabulary_files())
    rng = random.Random(5)
    texts = ["", "a <|endoftext|> b", "\n\n  x \t y z", "é" * 5000, " " * 300_000, "naïve  café 123,456'll", " \u0085 x", "日本語テキスト", "퟿🙂"]
    texts += ["".join(chr(rng.choice([32, 32, 10, 97, 98, 39, 48, 233, 0x4E2D, 0x1F600])) for _ in range(200)) for _ in range(50)]
    for text in texts:
        assert list(encode(text)) == own.encode(text, add_special_tokens=False).ids
