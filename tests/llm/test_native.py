"""Mixing, line de-duplication, weighted fingerprints and surrogates."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from conftest_llm import ODD
from pyspark.sql import functions as F

from lodestream.llm import line_dedup, mixing, surrogates, weighted_fingerprint

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def water(sizes):
    """Targets by sharing again and again, as the definition says."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        w = sum(weight[s] for s in order if s not in full)
        target = {s: 3 * sizes[s] if s in full else left * weight[s] / w for s in order}
        above = {s for s in order if s not in full and target[s] > 3 * sizes[s]}
        if not above:
            return target
        full |= above


def test_mix_targets_and_copies(documents):
    rows = mixing.copies(documents).collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * r["copies"]
        assert 0 <= r["copies"] <= 3
    goal = water(dict(sizes))
    largest = max(r["size"] for r in rows)
    for r in rows:
        assert r["target"] == pytest.approx(goal[r["source"]])
        assert r["source_size"] == sizes[r["source"]]
    for s in sizes:
        assert abs(taken[s] - goal[s]) <= 2 * largest
    assert sorted(map(str, rows)) == sorted(map(str, mixing.copies(documents.repartition(5)).collect()))


def test_mix_hot_source_is_close(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.expr("repeat('w ', CAST(1 + id % 97 AS INT))").alias("text"),
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"),
    )
    rows = mixing.copies(docs).groupBy("source", "target").agg(F.sum(F.col("size") * F.col("copies")).alias("taken")).collect()
    for r in rows:
        assert abs(r["taken"] - r["target"]) <= 200


def test_mix_odd_rows(odd, nothing):
    rows = mixing.copies(odd).collect()
    assert len(rows) == len(ODD)
    assert {r["size"] for r in rows if r["doc_id"] in (2, 3, 4)} == {0}
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns
    assert mixed.count() == sum(r["copies"] for r in rows)
    assert mixing.mix(nothing).count() == 0 and mixing.copies(nothing).count() == 0


def brute_lines(docs):
    """docs: list of (id, text); keeps lines without a similar earlier one."""
    seen, out = [], []
    for doc_id, text in docs:
        kept = []
        for line in (text or "").split("\n"):
            words = set(WORD.findall(line))
            if not (words and any(len(words & s) * 10 >= 8 * len(words | s) for s in seen)):
                kept.append(line)
            if words:
                seen.append(words)
        out.append((doc_id, "\n".join(kept)))
    return out


def test_line_dedup_against_brute_force(spark):
    import random

    rng = random.Random(4)
    vocabulary = [f"v{i}" for i in range(40)] + ["the"] * 10
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(1, 24))] for _ in range(12)]
    docs = []
    for i in range(60):
        lines = []
        for _ in range(rng.randint(1, 4)):
            line = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                line[rng.randrange(len(line))] = rng.choice(vocabulary)
            lines.append(" ".join(line))
        docs.append((i, "\n".join(lines)))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    got = sorted((r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(frame).collect())
    assert got == brute_lines(docs)


def test_line_dedup_large_group_of_near_copies(spark):
    # 600 lines that differ from each other in a word or two: longer postings than are met first.
    docs = [(i, " ".join(f"b{j}" if j != i % 30 else f"x{i}" for j in range(30))) for i in range(600)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    got = sorted((r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(frame).collect())
    assert got == brute_lines(docs)


def test_line_dedup_odd_rows(odd, nothing):
    rows = line_dedup.dedup_lines(odd)
    assert rows.columns == odd.columns
    got = [(r["doc_id"], r["text"]) for r in rows.collect()]
    assert len(got) == len(ODD)
    assert (2, None) in got and (None, None) in got and (3, "") in got and (4, " \t\n\r ") in got
    assert (6, "") in got
    assert got.count((1, ODD[0][1])) == 2
    assert line_dedup.dedup_lines(nothing).count() == 0


def jaccard(a, b):
    a, b = Counter(WORD.findall(a)), Counter(WORD.findall(b))
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 1.0


def test_fingerprints(documents):
    texts = sorted((r["doc_id"], r["text"]) for r in documents.collect())
    got = {r["doc_id"]: r for r in weighted_fingerprint.fingerprints(documents).collect()}
    errors = []
    for i, (doc_id, text) in enumerate(texts):
        following = texts[(i + 1) % len(texts)][1]
        q = len(text) // 4
        edited = text[: len(text) - q] + following[:q]
        row = got[doc_id]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        errors += [row["near_edited"] - jaccard(text, edited), row["near_next"] - jaccard(text, following)]
    assert abs(sum(errors) / len(errors)) < 0.01
    assert max(map(abs, errors)) < 0.4
    same = defaultdict(set)
    for doc_id, text in texts:
        same[text].add(got[doc_id]["fingerprint"])
    assert {len(s) for s in same.values()} == {1}


def test_fingerprints_odd_rows(odd, nothing, spark):
    rows = weighted_fingerprint.fingerprints(odd).collect()
    assert len(rows) == len(ODD)
    blank = {r["fingerprint"] for r in rows if r["doc_id"] in (2, 3, 4)}
    assert blank == {"f" * 8 * weighted_fingerprint.SAMPLES}
    assert len({r["fingerprint"] for r in rows if r["n_chars"] == len(ODD[0][1])}) == 1
    assert weighted_fingerprint.fingerprints(nothing).count() == 0
    one = weighted_fingerprint.fingerprints(spark.createDataFrame([(9, "only one text")], "doc_id bigint, text string")).first()
    assert one["near_next"] == 1.0
    apart = spark.createDataFrame([(-(2**63), "a b c d"), (2**63 - 1, "e f g h"), (0, "a b c d")], "doc_id bigint, text string")
    got = {r["doc_id"]: r["near_next"] for r in weighted_fingerprint.fingerprints(apart).collect()}
    assert got == {-(2**63): 1.0, 0: 0.0, 2**63 - 1: 0.0}


def test_fingerprints_of_clustered_missing_and_repeated_ids(spark):
    rows = [(i, f"a{i} b{i % 7} c d e f g h") for i in range(200)] + [(10**12, "far away from all others")]
    rows += [(None, f"no id {i % 40} but words to count") for i in range(100)] + [(7, f"same id {i // 2} and more of it") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = weighted_fingerprint.fingerprints(docs).collect()
    texts = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    expected = []
    for i, (doc_id, text) in enumerate(texts):
        q = len(text) // 4
        edited = text[: len(text) - q] + texts[(i + 1) % len(texts)][1][:q]
        expected.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == Counter(expected)
    # No task has most of the texts, wherever the ids lie.
    kept = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        placed = weighted_fingerprint.neighbours(docs, weighted_fingerprint.order(docs))
        sizes = [r["count"] for r in placed.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", kept)
    assert len(sizes) > 4 and max(sizes) < sum(sizes) / 3


PRIVATE = (
    "Call +1 (017) 555-7713 or +1-017-555-7713, mail Me.Too@mail7.example.com or ME.TOO@MAIL7.EXAMPLE.COM. "
    "Card 4111 1111 1111 1111, also 4111111111111111, not 1234567812345678; host 97.51.17.173. "
    'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" SSN 123-45-6789. Mr. Smith and Frau Anna Schmidt, Господин Иванов, Mrs. Smith.'
)


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10


def test_surrogates_keep_format_and_references(spark):
    docs = spark.createDataFrame([(1, PRIVATE), (2, "write me.too@mail7.example.com from 97.51.17.173")], "doc_id bigint, text string")
    got = {r["doc_id"]: r["text"] for r in surrogates.anonymise(docs).collect()}
    text = got[1]
    for secret in ("017", "me.too", "ME.TOO", "1111", "12345678", "97.51.17.173", "04dbebab", "6789", "Smith", "Schmidt", "Anna ", "Иванов"):
        assert secret not in text, secret
    phones = re.findall(r"\+\d[ -]\(?\d{3}\)?[ -]\d{3}-\d{4}", text)
    assert len(phones) == 2 and len({re.sub(r"\D", "", p) for p in phones}) == 1
    mails = re.findall(r"[\w.]+@[\w.]+\.(?:com|COM)", text)
    assert len(mails) == 2 and mails[0] == mails[1].lower() and mails[1].isupper() and mails[0] in got[2]
    spaced, plain, other = re.search(r"Card (\d{4} \d{4} \d{4} \d{4}), also (\d{16}), not (\d{16});", text).groups()
    assert spaced.replace(" ", "") == plain and luhn(plain) == 0 and luhn(other) != 0
    assert re.search(r"host (\S+)\.", text)[1].rstrip(".") in got[2]
    assert re.search(r'token = "[0-9a-f]{40}"', text)
    first, family, last = re.search(r"Mr\. (\w+) and Frau (\w+ \w+), Господин (?:[А-Я][а-я]+), Mrs\. (\w+)\.$", text).groups()
    assert first == last and family.split()[0] in {n for (g, s), ns in surrogates.GIVEN.items() if (g, s) == ("f", "latin") for n in ns}


def test_surrogates_are_distinct(spark):
    # More addresses of one shape than a first draw keeps apart.
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.format_string("%s@%s.org", F.char(F.lit(97) + F.col("id") % 26), F.format_string("a%d", F.floor(F.col("id") / 26))).alias("text"))
    before = [r["text"] for r in docs.collect()]
    after = [r["text"] for r in surrogates.anonymise(docs).collect()]
    assert len(set(after)) == len(set(before)) == 3000
    assert not set(after) & set(before)


def test_surrogates_odd_rows(odd, nothing):
    rows = surrogates.anonymise(odd)
    assert rows.columns == odd.columns
    assert sorted(map(str, rows.collect())) == sorted(map(str, odd.collect()))
    assert surrogates.anonymise(nothing).count() == 0


def test_surrogates_leave_the_rest_alone(documents):
    rows = {r["doc_id"]: r["text"] for r in documents.collect()}
    found = surrogates.anonymised(documents)
    for r in found.select("_row.doc_id", "_row.text", "n_entities").collect():
        if not r["n_entities"]:
            assert r["text"] == rows[r["doc_id"]]
        else:
            assert r["text"] != rows[r["doc_id"]] and len(r["text"].split()) == len(rows[r["doc_id"]].split())


def test_targets_of_a_giant_among_many_sources(spark):
    """Products of sizes and weights beyond a long: 200,000 small sources and one of 10^13 words."""
    sizes = spark.range(200_000).select(F.format_string("s%06d", "id").alias("source"), F.lit(10_000).cast("bigint").alias("size"))
    giant = spark.createDataFrame([("t", 10**13)], "source string, size bigint")
    goal = mixing.targets(sizes.union(giant)).collect()
    total = 200_000 * 10_000 + 10**13
    assert len(goal) == 200_001 and sum(r["target"] for r in goal) == pytest.approx(total)
    assert all(r["target"] <= 3 * r["source_size"] for r in goal)


def test_line_dedup_frequent_words_are_no_lists(spark, monkeypatch):
    """Lines that share frequent words without being similar do not meet; near copies still do."""
    import random

    monkeypatch.setattr(line_dedup, "COUNTED", 1)
    monkeypatch.setattr(line_dedup, "RARE", 2)
    monkeypatch.setattr(line_dedup, "FEW", 4)
    monkeypatch.setattr(line_dedup, "PAIRED", 20)
    rng = random.Random(9)
    vocabulary = [f"v{i}" for i in range(300)]
    base = [rng.sample(vocabulary, n) for n in [1, 2, 3, 4, 5, 12, 19, 20, 21, 24, 25, 26, 30, 70] * 4]
    lines = []
    for words in base:
        lines.append(words)
        for _ in range(4):
            near = [w for w in words if rng.random() > 0.06] + [rng.choice(vocabulary) for _ in range(rng.randint(0, 3))]
            rng.shuffle(near)
            lines.append(near)
    rng.shuffle(lines)
    docs = [(i, "  ".join(words) + "\n" + "\t".join(reversed(words)) + "\r\n") for i, words in enumerate(lines)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    got = sorted((r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(frame).collect())
    assert got == brute_lines(docs)


def test_line_dedup_unlike_lines_hardly_meet(spark, monkeypatch):
    """Frequent words of unlike lines made lists whose pairs follow the square of the number of lines."""
    import random

    monkeypatch.setattr(line_dedup, "COUNTED", 1)
    monkeypatch.setattr(line_dedup, "RARE", 2)
    rng = random.Random(5)
    unlike = [(i, " ".join(f"v{w}" for w in rng.sample(range(2000), 30))) for i in range(1500)]
    frame = spark.createDataFrame(unlike, "doc_id bigint, text string")
    table = line_dedup.rarity_table(frame)
    sets = line_dedup.token_sets(line_dedup.lines(line_dedup.keyed(frame)), table)
    met = "sum(count * (count - 1) / 2)"
    keys = line_dedup.postings(sets, 0.8).groupBy("t").count().selectExpr(met).first()[0]
    words = sets.select(F.explode(F.slice("s", 1, 7)).alias("t")).groupBy("t").count().selectExpr(met).first()[0]
    assert keys < words / 8


def test_rarity_is_counted_on_every_document(spark):
    """Every token of every document has the level of its whole count, not of a share of the documents."""
    from collections import Counter

    import numpy as np

    docs = [(i, f"common w{i % 50}\nv{i}\tw{i % 7} common") for i in range(400)] + [(900, None), (None, "lone  row")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    words = Counter(w for _, text in docs for w in (text or "").split())
    named = spark.createDataFrame([(w,) for w in words], "w string")
    bins = {r.w: r.b for r in named.select("w", F.xxhash64("w").bitwiseAND(F.lit(line_dedup.BINS - 1)).alias("b")).collect()}
    counts = Counter()
    for word, n in words.items():
        counts[bins[word]] += n
    levels = spark.range(1).select(line_dedup.rarity_table(frame).alias("levels")).first()["levels"]
    expected = np.zeros(line_dedup.BINS, int)
    for b, n in counts.items():
        expected[b] = np.floor(np.log2(n) * 3) + 1
    assert (np.array(levels) == expected).all()
