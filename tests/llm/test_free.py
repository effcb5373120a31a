"""Extraction, exact top-k, suffix arrays, classifier, packing, SimHash."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from conftest_llm import CLASHING, LONG, ODD
from pyspark.sql import functions as F

from lodestream.llm import bin_packing, dual_tree, html_crf, mil_quality, simhash, suffix_dedup
from lodestream.llm.shared import components, positions

PAGE = (
    '<html><head><title>x</title><script>if (a</p>b) {}</script></head><body><div id="cookie-notice"><p>We use cookies to improve.</p></div>'
    '<ul class="menu"><li><a href=/a>Home</a><li><a href=/b>News</a></ul><div class="post-content"><h1>The Title here</h1>'
    "<p>First paragraph is a long one,\n with some commas, &amp; text that goes on.<p>Second &eacute; <b>bold</b> &#x41;<br>line.</div>"
    '<div class="comments"><h3>Comments</h3><div class="comment"><p>I liked this article very much, thank you for it.</p></div></div>'
    "<form><input><button>Send</button></form><footer>&copy; 2020</footer></body></html>"
)


@pytest.fixture(scope="module")
def field(spark, sf):
    return html_crf.fit(spark.read.parquet(f"{sf}/pages.parquet"))


def test_extracts_articles_of_other_layouts(spark, sf, field):
    assert html_crf.main_text(PAGE, field) == (
        "The Title here\n\nFirst paragraph is a long one, with some commas, & text that goes on.\n\nSecond é bold A line."
    )
    wrong = total = 0
    for i, page in enumerate(r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").limit(60).collect()):
        for codes, labels in html_crf.labelled(page, 4, 10_000 + i):
            wrong += sum(a != b for a, b in zip(field.viterbi(codes), labels))
            total += len(labels)
    assert wrong / total < 0.01


def test_extracts_given_pages(spark, sf, field):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    for row in html_crf.extract(pages, field).join(pages.select("page_id", "html"), "page_id").collect():
        inside = [b.text for b in html_crf.blocks(row["html"]) if any(t == "article" for t, _ in b.path)]
        assert row["text"] == "\n\n".join(inside) and row["n_chars"] == len(row["text"])


def test_extract_odd_pages(spark, field):
    odd = ["", None, "<", "<p", "<p>cut off <a hre", "<!-- never closed <p>x</p>", "no markup at all", "<p>" * 3000 + "deep", "<p>" + "word " * 200_000 + "</p>", PAGE, PAGE]
    pages = spark.createDataFrame([(i if i else None, None, h) for i, h in enumerate(odd)], "page_id bigint, url string, html string").withColumn("text", F.lit(1))
    got = html_crf.extract(pages, field).collect()
    assert len(got) == len(odd) and all(r["text"] is not None for r in got)
    assert html_crf.extract(pages.limit(0), field).count() == 0


def test_viterbi_is_the_best_path(field):
    rng = np.random.default_rng(2)
    for n in range(1, 7):
        codes = [rng.integers(0, html_crf.DIMENSION, 3).tolist() for _ in range(n)]

        def score(labels):
            s = sum(field.emit[c][:, l].sum() for c, l in zip(map(np.array, codes), labels))
            return s + sum(field.step[a][b] for a, b in zip(labels, labels[1:]))

        best = max(score([k >> i & 1 for i in range(n)]) for k in range(1 << n))
        assert score(field.viterbi(codes)) == pytest.approx(best)


def brute_top(queries, data, k):
    out = set()
    for q, a in queries:
        scored = sorted((-int(np.dot(a, b)), i) for i, b in data if i != q and len(b) == len(a))
        out |= {(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)}
    return out


def test_top_k_against_brute_force(spark, sf):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    data = [(r["vec_id"], np.floor(np.array(r["embedding"], float) * 1024).astype(int)) for r in vectors.collect()]
    got = {tuple(r) for r in dual_tree.top_k(vectors.where("vec_id % 20 = 0"), vectors.repartition(5), 10, block=7).collect()}
    assert got == brute_top([d for d in data if d[0] % 20 == 0], data, 10)


def test_top_k_clustered_and_odd(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 3, (6, 8))
    rows = [(i, (centres[i % 6] + rng.normal(0, 0.02, 8)).tolist()) for i in range(3000)]
    rows += [(3000 + i, rows[0][1]) for i in range(15)] + [rows[5], rows[5]]
    bad = [(4000, None), (4001, [1.0, None]), (4002, [float("nan")] * 8), (4003, [float("inf")] + [0.0] * 7), (None, [1.0] * 8), (4100, [1.0, 2.0]), (4101, []), (4102, [2.0, 1.0])]
    frame = spark.createDataFrame(rows + bad, "vec_id bigint, embedding array<double>").withColumn("score", F.lit(1)).repartition(3)
    data = {i: np.floor(np.array(v) * 1024).astype(int) for i, v in rows + [b for b in bad if b[0] in (4100, 4101, 4102)]}
    got = {tuple(r) for r in dual_tree.top_k(frame.where("vec_id % 100 = 0"), frame, 10).collect()}
    assert got == brute_top([(i, v) for i, v in data.items() if i % 100 == 0], list(data.items()), 10)
    assert dual_tree.top_k(frame.limit(0), frame).count() == 0


def test_suffix_array_is_sorted():
    rng = random.Random(1)
    for _ in range(150):
        text = [rng.randint(1, rng.choice([1, 2, 3, 20])) for _ in range(rng.randint(0, 80))] + [0]
        sa = suffix_dedup.suffix_array(text, 21)
        assert sa == sorted(range(len(text)), key=lambda i: text[i:])
        data = bytes(text)
        common = suffix_dedup.permuted_prefixes(data, sa)
        for a, b in zip(sa, sa[1:]):
            n = common[b]
            assert data[a : a + n] == data[b : b + n] and data[a + n : a + n + 1] != data[b + n : b + n + 1]


def brute_bytes(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((bytes(c for c, g in zip(d, gone) if not g), len(d), sum(gone), runs))
    return out


@pytest.mark.parametrize("crowd", [4096, 2])
def test_suffix_dedup_against_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    rng = random.Random(6)

    def noise(n):
        return "".join(rng.choice("abcdefgh é") for _ in range(n))

    passages = [noise(n) for n in (300, 390, 400, 410, 700, 1500)]
    texts = [None, "", "x" * 399, "x" * 1300, "to " * 500, noise(900), noise(5000)]
    for _ in range(40):
        parts = [noise(rng.randint(0, 300))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            if rng.random() < 0.4:
                at = rng.randrange(len(p))
                p = p[:at] + "Z" + p[at + 1 :]
            if rng.random() < 0.3:
                p = p[rng.randrange(60) :]
            parts += [p, noise(rng.randint(0, 200))]
        texts.append("".join(parts))
    texts += [texts[6], texts[6][:2500] + "Q" + texts[6][2501:]]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    got = [tuple(r)[1:] for r in suffix_dedup.deduplicated(frame).orderBy("doc_id").collect()]
    assert [(bytes(k), *rest) for k, *rest in got] == brute_bytes(texts, 400)


def test_suffix_dedup_odd_rows(odd, nothing, spark):
    rows = suffix_dedup.deduplicated(odd).collect()
    assert len(rows) == len(ODD) and all(r["n_removed"] == 0 for r in rows)
    assert {bytes(r["kept"]).decode() for r in rows if r["doc_id"] == 5} == {LONG}
    assert suffix_dedup.deduplicated(nothing).count() == 0
    twice = spark.createDataFrame([(1, "ab " * 300), (1, "ab " * 300), (None, "k" + "xyz" * 200), (None, "j" + "xyz" * 200)], "doc_id bigint, text string")
    assert all(r["n_removed"] >= 599 for r in suffix_dedup.deduplicated(twice).collect())


def test_classifier_on_held_out_documents(spark, documents, sf):
    labels = spark.read.parquet(sf.replace("0.001", "0.01") + "/labels.parquet")
    docs = spark.read.parquet(sf.replace("0.001", "0.01") + "/documents.parquet")
    rows = mil_quality.judge(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows)
    good, bad = [r["score"] for r in rows if r["quality"]], [r["score"] for r in rows if not r["quality"]]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.97 and np.mean([g >= 0.3 for g in good]) > 0.97


def test_classifier_gradients():
    rng = np.random.default_rng(0)
    w = {"W": rng.normal(size=(4, 3)), "b": rng.normal(size=3), "V": rng.normal(size=(3, 3)), "U": rng.normal(size=(3, 3)), "a": rng.normal(size=3), "c": rng.normal(size=3), "d": rng.normal(size=1)}
    x, starts, y = rng.normal(size=(7, 4)), np.array([0, 2, 6]), np.array([1.0, 0.0, 1.0])

    def loss():
        p = mil_quality._forward(w, x, starts)["p"]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    g = mil_quality._gradients(w, x, starts, y, 0.0)
    for k, v in w.items():
        for at in np.ndindex(v.shape):
            old = v[at]
            v[at] = old + 1e-6
            up = loss()
            v[at] = old - 1e-6
            down = loss()
            v[at] = old
            assert g[k][at] == pytest.approx((up - down) / 2e-6, abs=1e-5)


def test_classifier_odd_rows(odd, nothing, spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (6, 0), (None, 1), (3, None), (5, 2)], "doc_id bigint, quality int")
    rows = mil_quality.judge(odd, labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert mil_quality.judge(odd, labels.limit(0)).where("score <> 0.5").count() == 0
    assert mil_quality.keep_good(odd, labels.limit(0)).columns == odd.columns
    assert mil_quality.judge(nothing, labels).count() == 0


def test_packing(spark, documents):
    rows = bin_packing.pack_documents(documents).collect()
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(bin_packing.tokenizer_path())
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    by_document, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_document[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_document) == set(texts)
    for doc_id, own in by_document.items():
        ids = tokenizer.encode(texts[doc_id], add_special_tokens=False).ids + [0]
        own.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(-(-len(ids) // 2048)))
        for r in own:
            part = ids[r["start"] : r["start"] + r["length"]]
            assert r["start"] == 2048 * r["piece"] and r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        assert sum(r["length"] for r in own) == len(ids)
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    counts = Counter(r["length"] for r in rows)
    assert len(by_sequence) <= bin_packing.lower_bound(counts, 2048) + 1


def test_bin_completion_finds_small_optima():
    rng = random.Random(3)

    def best(items, capacity):
        found = [len(items)]

        def go(i, rooms):
            if len(rooms) >= found[0]:
                return
            if i == len(items):
                found[0] = len(rooms)
                return
            for r in {x for x in rooms if x >= items[i]}:
                left = list(rooms)
                left.remove(r)
                go(i + 1, left + [r - items[i]])
            go(i + 1, rooms + [capacity - items[i]])

        go(0, [])
        return found[0]

    for _ in range(60):
        items = sorted((rng.randint(3, 17) for _ in range(rng.randint(1, 10))), reverse=True)
        used = bin_packing.bin_completion(dict(Counter(items)), 20)
        assert Counter(s for f, n in used for s in f for _ in range(n)) == Counter(items)
        assert all(sum(f) <= 20 for f, _ in used)
        assert sum(n for _, n in used) == best(items, 20)


def test_packing_odd_rows(odd, nothing):
    rows = bin_packing.pack_documents(odd).collect()
    assert len(rows) > len(ODD)
    assert sum(r["length"] for r in rows if r["doc_id"] in (2, 3, 4)) == 3
    assert bin_packing.pack_documents(nothing).count() == 0


def test_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(bin_packing.tokenizer_path())
    encoder = bin_packing.Encoder(bin_packing.tokenizer_path())
    for text in ["It's 'S don''t", "a\x1cb\x85c\xa0d", "ab  c\n\nd é Σας ΣΑΣ İx <|endoftext|>x", "x" * 200, "́a ́", "½ ²3 ªº µ ÿÀ", LONG[:5000]] + [o[1] or "" for o in ODD[:-3]]:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def brute_simhash(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints):
    root = {i: i for i in range(len(prints))}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 2:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def test_simhash_groups_against_brute_force(spark, documents):
    rows = documents.collect()
    rows += [(10_000 + i, r["text"] + " tail") for i, r in enumerate(rows)]
    frame = spark.createDataFrame([(r[0], r[1]) for r in rows], "doc_id bigint, text string")
    ids, prints = [r[0] for r in rows], [brute_simhash(r[1]) for r in rows]
    groups = brute_groups(prints)
    smallest = {}
    for i, g in zip(ids, groups):
        smallest[g] = min(i, smallest.get(g, i))
    expected = {i: (f"{p:016x}", smallest[g]) for i, p, g in zip(ids, prints, groups)}
    got = simhash.near_groups(frame).withColumn("fingerprint", simhash.hexadecimal(F.col("fingerprint"))).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == expected
    assert len(set(groups)) < len(rows) - 5


def test_links_find_all_pairs_within_the_radius(spark):
    rng = random.Random(2)
    prints = {rng.getrandbits(64) for _ in range(30)}
    for p in list(prints):
        for _ in range(3):
            q = p
            for b in rng.sample(range(64), rng.randint(1, 4)):
                q ^= 1 << b
            prints.add(q)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    roots = {r["node"]: r["root"] for r in components(simhash.links(spark.createDataFrame([(p,) for p in signed], "fingerprint bigint"))).collect()}
    groups = brute_groups(prints)
    by_root = {}
    for p, g in zip(signed, groups):
        assert by_root.setdefault(g, roots.get(p, p)) == roots.get(p, p)
    assert len(set(by_root.values())) == len(by_root)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (5, 5)], "u bigint, v bigint")
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    assert got == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}


def test_simhash_odd_rows(odd, nothing):
    rows = simhash.near_groups(odd).collect()
    assert len(rows) == len(ODD)
    assert {r["component_id"] for r in rows if r["doc_id"] in (2, 3, 4)} == {2}
    assert {r["component_id"] for r in rows if r["doc_id"] == 6} == {1}
    assert simhash.near_groups(nothing).count() == 0
    single = simhash.one_per_group(odd)
    assert single.columns == odd.columns
    assert simhash.one_per_group(nothing).count() == 0
    with pytest.raises(ValueError):
        simhash.links(odd, 3)


def test_positions_spread_a_hot_group(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("x"), F.when(F.col("id") % 3 > 0, "hot").alias("g"))
    got = defaultdict(list)
    for r in positions(rows, ["g"], ["x"]).collect():
        got[r["g"]].append((r["_pos"], r["x"]))
    for own in got.values():
        own.sort()
        assert [p for p, _ in own] == list(range(len(own)))
        assert [x for _, x in own] == sorted(x for _, x in own)


def test_clashing_names_are_there(odd):
    assert set(CLASHING) < set(odd.columns)
