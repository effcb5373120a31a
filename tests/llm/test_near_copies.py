"""Near copies against brute force."""

import random

import pytest
from conftest_llm import ODD

import corpus_pipeline
from lodestream.llm import near_copies, simhash


def shingles(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_kept(rows):
    sets = [shingles(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 9 * len(a & b) >= 4 * (len(a) + len(b)):
                root[find(i)] = find(j)
    best = {}
    for i, (doc_id, _) in enumerate(rows):
        best[find(i)] = min(doc_id, best.get(find(i), doc_id))
    return sorted(best.values())


def near(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return words


def made(seed):
    """Copies with one to nine edited words, broken into lines at other places."""
    rng, texts = random.Random(seed), []
    for _ in range(12):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([3, 6, 40, 200, 400]))]
        texts += [words] * 2 + [near(rng, words, rng.randint(1, 9)) for _ in range(5)]
    common = [f"c{i}" for i in range(200)]
    texts += [near(rng, common, rng.randint(0, 3)) for _ in range(25)]
    rng.shuffle(texts)
    rows = []
    for i, words in enumerate(texts):
        cut = rng.randrange(len(words) + 1)
        rows.append((i, " ".join(words[:cut]) + "\n" + " ".join(words[cut:]).upper()))
    return rows + [(900, ""), (901, None), (902, " \n ")]


@pytest.mark.parametrize("few", [64, 3])
def test_near_copies_against_brute_force(spark, sf, monkeypatch, few):
    monkeypatch.setattr(near_copies, "FEW", few)
    monkeypatch.setattr(near_copies, "BEFORE", 1 if few == 3 else 4)
    rows = made(few)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    expected = brute_kept(rows)
    got = corpus_pipeline.dedup_documents(spark, docs, sf)
    assert sorted(r["doc_id"] for r in got.collect()) == expected
    assert len(expected) < len({frozenset(shingles(t)) for _, t in rows}) - 20


def test_near_copies_odd_rows(odd, nothing):
    single = near_copies.one_per_group(odd)
    assert single.columns == odd.columns
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in single.collect()) == [(False, 0), (False, 0), (True, -7), (True, 1), (True, 1), (True, 5)]
    assert near_copies.one_per_group(nothing).count() == 0
    assert len(ODD) > single.count()


def test_fingerprints_link_documents(spark, sf):
    """Texts whose fingerprints are at most two bits apart are one group, also through a similar third one."""
    rng = random.Random(4)
    # Most words of these texts are repeated filler, so edits leave the fingerprint, not the shingle set.
    filler = " ".join(["again and again"] * 300)
    texts = [f"{filler} {' '.join(f'u{rng.randrange(10**6)}' for _ in range(30))}" for _ in range(3)]
    prints = [simhash.simhash(t) for t in texts]
    assert all((prints[0] ^ p).bit_count() <= 2 for p in prints)
    rows = [(7, texts[0]), (3, texts[1]), (5, texts[2]), (9, texts[0] + " end"), (11, "something else altogether here")]
    assert brute_kept(rows) == [3, 5, 7, 11]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, source string").repartition(2)
    got = corpus_pipeline.dedup_documents(spark, docs, sf)
    assert got.columns == docs.columns
    assert sorted(r["doc_id"] for r in got.collect()) == [3, 11]


def test_rarity_of_shingles_is_counted_on_every_text(spark):
    """Every shingle of every text has the level of its whole count, not of a share of the texts."""
    import numpy as np

    rows = [(i, f"the same five words here w{i % 9} v{i}") for i in range(200)] + [(900, None), (901, "short")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    counts = np.zeros(near_copies.BINS, int)
    for _, text in rows:
        found = near_copies.shingle_set(text, 5) & np.uint64(near_copies.BINS - 1)
        np.add.at(counts, found.astype(int), 1)
    expected = np.where(counts > 0, np.floor(3 * np.log2(np.maximum(counts, 1)) + 1), 0)
    assert (near_copies.rarity_table(frame, 5) == expected).all()
