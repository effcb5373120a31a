"""Conversation repair, URL cascade and whitening against brute force."""

import hashlib
import re
import zlib
from collections import defaultdict
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestream.llm import turn_repair, url_cascade, whitening

WHITE = " \t\n\x0b\x0c\r"

# --- conversation repair ---------------------------------------------------------


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        fault = zlib.crc32(key.encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def repair(rows):
    """Every cheapest repair by whole strings, for rows in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        solid = text.strip(WHITE)
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None)
        seen.add((role, text))
    # (rows done, state) → least (cost, audit, rows kept); states by what came last.
    moves = {"": "us", "s": "u", "u": "a", "a": "u"}
    layer = {"": (0, "", ())}

    def grown(layer):
        for _ in range(4):
            for state, (cost, audit, kept) in list(layer.items()):
                for letter in set(moves[state]) & set("ua"):
                    new = (cost + 5, audit + "I", (*kept, ({"u": "user", "a": "assistant"}[letter], "")))
                    layer[letter] = min(layer.get(letter, new), new)
        return layer

    for (_, role, text), fault in zip(rows, faults):
        nxt = {}

        def offer(state, new):
            nxt[state] = min(nxt.get(state, new), new)

        # All paths, inserts before the row included, so strings of one state are all there.
        for state, (cost, audit, kept) in grown(dict(layer)).items():
            offer(state, (cost + 2, audit + "D", kept))
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 if fault else 0
            for letter in moves[state]:
                if role[:1] == letter:
                    offer(letter, (cost + extra, audit + "K", (*kept, (role, text))))
                if letter in "ua":
                    name = {"u": "user", "a": "assistant"}[letter]
                    offer(letter, (cost + extra + 1, audit + "R", (*kept, (name, text))))
        layer = nxt
    cost, audit, kept = min(v for k, v in grown(layer).items() if k in ("", "a"))
    turns = {t for t, _, _ in rows if t is not None}
    letters = [r[:1] for _, r, _ in rows]
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(letters, letters[1:])),
        cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest(),
    )


def expected(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    return {conv: repair(sorted(damage(own), key=order)) for conv, own in groups.items()}


def got(turns):
    rows = turn_repair.audits(turn_repair.damaged(turns), F.col("absent")).collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r[1:]) for r in rows}


def test_repairs_given_conversations(spark, sf):
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    assert got(turns) == expected([tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()])


def test_repairs_random_conversations(spark):
    """Odd roles, repeats, white space, equal turns and nulls in any column."""
    rng = np.random.default_rng(5)
    roles, texts = ["user", "assistant", "system", "tool", "", None], ["a.", "b", "c! ", "", " \n", None, "d?", "e."]
    rows = []
    for conv in [*range(400), None]:
        for _ in range(rng.integers(1, 9)):
            turn = None if rng.random() < 0.1 else int(rng.integers(-3, 9))
            role = roles[int(rng.choice(6, p=[0.35, 0.35, 0.12, 0.08, 0.05, 0.05]))]
            rows.append((conv, turn, role, texts[int(rng.integers(8))] if rng.random() < 0.6 else f"{rng.integers(99)}."))
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    extra = turns.withColumns({c: F.lit(c) for c in ("kind", "back", "place", "conv", "fault", "absent", "copy", "seq")})
    assert got(extra) == expected(rows)


def test_long_conversation_over_many_batches(spark):
    rows = [(7, t, "user" if t % 2 == 0 else "assistant", f"text {t}." if t % 11 else "cut off") for t in range(30_000)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(8)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "777")
    try:
        found = got(turns)[7]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    edits = turn_repair.repaired(turns.limit(3))
    assert edits.columns == ["conv_id", "seq", "edit", "fault", "turn", "was_role", "role", "text"]
    # The brute force keeps whole strings, so it is held against a part of the rows.
    part = spark.createDataFrame(rows[:900], turns.schema).repartition(8)
    assert got(part) == expected(rows[:900])
    assert len(found[6]) >= 28_000 and set(found[6]) <= set("KRDI")


def test_no_conversations(spark):
    none = spark.createDataFrame([], "conv_id string, turn bigint, role string, text string")
    assert got(none) == {}


# --- urls --------------------------------------------------------------------------


def brute_rule(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    fits = [(len(h + p), v == "block", h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], ("block" if best[1] else "allow") if best else "allow"


URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/", "http://a.www.example.com/en/x?y=/z#t", "https://example.com", "x://example.com?/en/",
    "http://notexample.com/en/", "http://net/es/", "http://a.b.net/fr/1", "http://net/ES/", "a://b://c.net/es/", "http://É.com/é", "http://.com/", "http://com./x",
    "http://u:p@example.com:80/en/", "http://x.net/\nfr/", "http://example.com/en/" + "a" * 100_000,
]


def test_urls(spark):
    pages = spark.createDataFrame([(i if i else None, u) for i, u in enumerate(URLS)] * 2, "page_id bigint, url string")
    clashing = pages.withColumns({c: F.lit(1) for c in ("host", "path", "rule", "verdict", "_found", "_keys", "key", "a", "b")})
    rules = spark.createDataFrame(url_cascade.RULES, url_cascade.RULE_SCHEMA)
    rows = url_cascade.judge(clashing, rules).collect()
    assert len(rows) == 2 * len(URLS)
    for r in rows:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute_rule(r["_row"]["url"], url_cascade.RULES)
    assert url_cascade.judge(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in url_cascade.judge(pages, rules.limit(0)).collect()} == {"allow"}


@pytest.mark.parametrize("shard_bits", [url_cascade.SHARD_BITS, 4000])
def test_many_rules(spark, sf, shard_bits):
    """Half the hosts and a third of the paths of the pages are listed; also in several shards."""
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url")
    rules = set()
    for r in pages.collect():
        host, path, *_ = brute_rule(r["url"], [])
        if zlib.crc32(host.encode()) % 2:
            rules.add((host, "/", "block"))
        if zlib.crc32(path.encode()) % 3 == 0:
            rules.add((host.split(".", 1)[1], path, "allow"))
    rules |= {("nowhere.example", "/", "block"), (None, "/", "block"), ("com", "/", "other")}
    table = spark.createDataFrame(sorted(rules, key=str) * 2, url_cascade.RULE_SCHEMA)
    known = [r for r in rules if r[0] and r[2] != "other"]
    for r in url_cascade.judge(pages, table, shard_bits=shard_bits).collect():
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute_rule(r["_row"]["url"], known)


def test_cascade_is_exact_over_its_universe(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("key "), F.col("id").cast("string")).alias("key"))
    keyed = keys.select("key", *url_cascade.hashed(F.col("key")))
    member = F.crc32(F.col("key").cast("binary")) % 7 == 0
    # The universe is sized too small, so that many false positives must be mended.
    levels = url_cascade.build(keyed.where(member), keyed.union(keyed), 4000)
    rows = keyed.withColumn("member", member).toPandas()
    assert len(levels) > 3
    assert (url_cascade.listed(levels, rows["a"].to_numpy(), rows["b"].to_numpy()) == rows["member"]).all()
    assert url_cascade.build(keyed.where("false"), keyed, 10) == []


# --- whitening ---------------------------------------------------------------------


def brute_whiten(vectors):
    x = np.floor(np.array(vectors, np.float64) * 256)
    fit = np.unique(x, axis=0)
    n, centred = len(fit), fit - fit.mean(0)
    values, turn = np.linalg.eigh(centred.T @ centred / n)
    values, turn = values[::-1], turn[:, ::-1]
    deviation = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, fit.sum(0))) for row in x]
    return n, deviation, (x - fit.mean(0)) @ turn[:, :4] / np.sqrt(values[:4]), values[:4] / values.sum()


def test_whitens_given_vectors(spark, sf):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    held = vectors.orderBy("vec_id").collect()
    n, deviation, whitened, explained = brute_whiten([r["embedding"] for r in held])
    rows = defaultdict(dict)
    for r in whitening.components_of(vectors).collect():
        rows[r["vec_id"]][r["component"]] = r
    assert sorted(rows) == [r["vec_id"] for r in held]
    found = np.array([[rows[r["vec_id"]][c]["whitened"] for c in range(1, 5)] for r in held])
    signs = np.sign((found * whitened).sum(0))
    assert np.abs(found * signs - whitened).max() < 1e-9
    for r, d in zip(held, deviation):
        for c in range(1, 5):
            row = rows[r["vec_id"]][c]
            assert (row["n"], row["deviation"]) == (n, d)
            assert row["explained"] == pytest.approx(explained[c - 1], rel=1e-10) and row["identity_error"] < 1e-9


def test_whitens_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [None, 1.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (None, [0.5, -0.25]), (6, []), (7, [3.0]), (8, [-0.0, 0.001])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumns({c: F.lit(c) for c in ("x", "n", "_x", "_v", "component")})
    got = whitening.components_of(df).collect()
    # Different x: (256, 512), (128, -64), (0, 0) twice over, (768, 0).
    assert len(got) == 2 * 6 and {r["n"] for r in got} == {4} and {r["component"] for r in got} == {1, 2}
    n, deviation, whitened, explained = brute_whiten([[1, 2], [0.5, -0.25], [0, 0], [3, 0]])
    own = {(r["vec_id"], r["component"]): r for r in got}
    assert [own[v, 1]["deviation"] for v in (1, None, 6, 7)] == deviation and own[8, 1]["deviation"] == own[6, 1]["deviation"]
    assert [abs(own[v, 2]["whitened"]) for v in (1, None, 6, 7)] == pytest.approx(np.abs(whitened[:, 1]).tolist())
    assert whitening.components_of(df.limit(0)).count() == 0
    assert whitening.components_of(df.where("vec_id = 1")).count() == 0
    assert whitening.whiten(df.where("vec_id = 6")).count() == 1
    huge = spark.createDataFrame([(1, [1e18, 3.0]), (2, [-2e18, 1.0])], "vec_id bigint, embedding array<double>")
    assert {r["deviation"] for r in whitening.components_of(huge).collect()} == {None}
    assert whitening.whiten(huge).count() == 2


def test_eigenvectors_of_clustered_values():
    rng = np.random.default_rng(3)
    turn = np.linalg.qr(rng.normal(size=(24, 24)))[0]
    for values in (
        np.concatenate([[5, 5 + 1e-9, 5 + 3e-9, 5 - 2e-9], 3 + 1e-7 * np.arange(6), np.linspace(0.1, 1, 14)]),
        10.0 ** -np.arange(24), np.ones(24), np.concatenate([np.full(4, 7.0), np.zeros(20)]),
    ):
        matrix = turn @ np.diag(values) @ turn.T
        matrix = (matrix + matrix.T) / 2
        found, vectors = whitening.eigen(matrix)
        assert (np.diff(found) <= 0).all()
        assert np.abs(vectors.T @ vectors - np.eye(24)).max() < 1e-14
        assert np.abs(matrix @ vectors - vectors * found).max() < 4e-15 * values.max()


def test_exact_products():
    rng = np.random.default_rng(4)
    for size in (1 << 8, 1 << 25, 1 << 40, 1 << 62):
        x = rng.integers(-size, size, (300, 3))
        want = [[sum(int(a) * int(b) for a, b in zip(x[:, i], x[:, j])) for j in range(3)] for i in range(3)]
        assert whitening.exact_products(x).tolist() == want


def test_sums_do_not_depend_on_partitions(spark, sf):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    fit = vectors.select(whitening.whole(F.col("embedding")).alias("x")).distinct()
    one, many = fit.coalesce(1), fit.repartition(13)
    (n, sums), (m, others) = whitening.sums_of(one, 64), whitening.sums_of(many, 64)
    assert n == m and (sums == others).all()
    assert (whitening.covariance_of(one, n, sums) == whitening.covariance_of(many, n, sums)).all()


def test_kinds_of_rows_are_all_listed():
    """Options never lead out of the states, and every state may drop a row."""
    for kind, state in product(range(9), range(4)):
        own = turn_repair._options(kind)[state]
        assert (2, "D", state, 2) in own and all(0 <= q < 4 for _, _, q, _ in own)
